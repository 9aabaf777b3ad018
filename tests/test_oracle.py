"""Every registered query against its DuckDB oracle (the driver's correctness gate)."""

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline.plans import registry

from paths import SF_SMALL
from tools.check_oracle import TABLES, canon as _canon

@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(registry.oracle_sql()) == set(registry.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["region", "revenue", "orders"] and len(rows) == 5


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert _canon(df.columns, srows) == _canon(ocols, orows)


@pytest.fixture(scope="module")
def orphans(spark):
    """sf0.001 with NULL and unmatched keys and a zero quantity added to the fact tables and to orders."""
    import shutil
    import tempfile

    root = tempfile.mkdtemp(prefix="ledgerline-orphans-")
    for t in TABLES:
        if t not in ("lineitem", "orders", "events"):
            shutil.copy(f"{SF_SMALL}/{t}.parquet", f"{root}/{t}.parquet")
    con = duckdb.connect()
    none = "CAST(NULL AS BIGINT)"
    con.execute(f"""COPY (SELECT * FROM read_parquet('{SF_SMALL}/lineitem.parquet')
        UNION ALL (SELECT * REPLACE (-7 AS l_orderkey) FROM read_parquet('{SF_SMALL}/lineitem.parquet') LIMIT 5)
        UNION ALL (SELECT * REPLACE (-8 AS l_partkey) FROM read_parquet('{SF_SMALL}/lineitem.parquet') LIMIT 4)
        UNION ALL (SELECT * REPLACE ({none} AS l_orderkey, {none} AS l_partkey)
                   FROM read_parquet('{SF_SMALL}/lineitem.parquet') LIMIT 3)
        UNION ALL (SELECT * REPLACE (0.0 AS l_quantity) FROM read_parquet('{SF_SMALL}/lineitem.parquet') LIMIT 2)
        ) TO '{root}/lineitem.parquet'""")
    con.execute(f"""COPY (SELECT * FROM read_parquet('{SF_SMALL}/orders.parquet')
        UNION ALL (SELECT * REPLACE (-7 AS o_orderkey, -9 AS o_custkey)
                   FROM read_parquet('{SF_SMALL}/orders.parquet') LIMIT 1)) TO '{root}/orders.parquet'""")
    con.execute(f"""COPY (SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')
        UNION ALL (SELECT * REPLACE (event_id + 10000000 AS event_id, -1 AS user_id)
                   FROM read_parquet('{SF_SMALL}/events.parquet') LIMIT 3)
        UNION ALL (SELECT * REPLACE ({none} AS event_id, {none} AS user_id)
                   FROM read_parquet('{SF_SMALL}/events.parquet') LIMIT 2)) TO '{root}/events.parquet'""")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return root, con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle_with_orphan_keys(spark, orphans, name):
    root, con = orphans
    df = E.queries()[name](spark, root)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    assert _canon(df.columns, srows) == _canon([d[0] for d in cur.description], cur.fetchall())


TIME_SENSITIVE = ["activity_heatmap", "device_trend_daily", "filtered_sess", "filtered_sess_fullday",
                  "latest_snapshot", "txn_enrich", "monthly_revenue", "kpi_summary", "quotes_stream_ingest"]


@pytest.mark.parametrize("name", TIME_SENSITIVE)
def test_query_is_independent_of_session_zone_and_ansi(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        srows = [tuple(r) for r in df.collect()]
        cols = df.columns
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.unset("spark.sql.ansi.enabled")
    cur = duck.execute(E.oracle_sql()[name])
    assert _canon(cols, srows) == _canon([d[0] for d in cur.description], cur.fetchall())
