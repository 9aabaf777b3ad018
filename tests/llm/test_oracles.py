"""The operators with SQL, against DuckDB on the same files."""

import duckdb
import pytest
from pyspark.sql import functions as F
from llm.helpers import SF, edge_docs
from ledgerline.llm import mixing, oracle, queries, sharding


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    df = queries.queries()[name](spark, SF)
    got = con.execute(queries.oracle_sql()[name])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([d[0] for d in got.description], got.fetchall())


def mixed(docs):
    return mixing.mix(docs).withColumn("first_shard", F.get("shards", F.lit(0))).drop("shards")


@pytest.mark.parametrize("run,sql", [(sharding.interleave, oracle.sharding()), (mixed, oracle.mixing())])
def test_edge_rows_match_the_sql(spark, tmp_path, run, sql):
    docs = edge_docs(spark)
    docs.coalesce(1).write.parquet(str(tmp_path / "docs"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/docs/*.parquet')")
    df = run(docs)
    got = con.execute(sql)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([d[0] for d in got.description], got.fetchall())
