"""Sharding by proportional stratified interleaving (DataFrame operations only).

Rows of each source are ranked in a seeded random order; a row's fractional
rank (its rank over its source's row count) spreads every source evenly over
[0, 1).  All rows are then sorted by fractional rank and cut into shards of
row counts at most one apart, so that every shard holds each source's share.

Ranks never put a source into one task: rows are numbered inside small cells
(leading hex digits of the seeded hash), and cells are offset by running sums
of their counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import cell_digits_for, pick, text_or_empty

LAW = "rows"


def seeded(seed: int, *cols: str):
    """A seeded hash as 32 hex digits: sorting by it shuffles the rows the same way every time."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("?"))
                                                     for c in cols]).cast("binary"))


def interleave(docs: DataFrame, *, n_shards: int = 24, seed: int = 17, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source", cell_digits: int | None = None,
               cuts: int | None = None) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard, source``.

    ``size`` is the text's UTF-8 bytes (NULL: none) plus 8.  ``cell_digits``
    hex digits split each source into 16**digits cells and ``cuts`` splits the
    sorted order; both only bound how many rows one task sorts, and follow from
    the row count (65,536 rows a cell or cut, about) if not given.

    NULL source: a source of its own.  NULL id or text: kept (text counts as
    empty).  Ties and repeated rows: ordered by hash, id, size and checksum,
    so rows that still tie are equal.  Empty table: no rows.  Extra columns
    are not read.
    """
    if cell_digits is None or cuts is None:
        n = docs.count()
        cell_digits = cell_digits or cell_digits_for(n)
        cuts = cuts or max(4096, n >> 16)
    rows = pick(docs, id=id_col, source=source_col, text=text_col).select(
        "id", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("stratum"), "source",
        (F.octet_length(text_or_empty("text")).cast("long") + 8).alias("size"),
        F.crc32(text_or_empty("text").cast("binary")).alias("crc"),
        seeded(seed, "id").alias("h"))
    rows = rows.withColumn("cell", F.substring("h", 1, cell_digits))

    in_stratum = Window.partitionBy("stratum")
    cells = (rows.groupBy("stratum", "cell").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("cell_start", F.sum("n").over(in_stratum.orderBy("cell")) - F.col("n"))
             .withColumn("stratum_rows", F.sum("n").over(in_stratum))
             .drop("n"))
    order = ["h", "id", "size", "crc"]
    in_cell = Window.partitionBy("stratum", "cell").orderBy(*order)
    lag = F.conv(F.substring(seeded(seed, "stratum"), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    ranked = (rows.withColumn("rn", F.row_number().over(in_cell) - 1)
              .join(cells, ["stratum", "cell"])
              .withColumn("fraction", ((F.col("cell_start") + F.col("rn")).cast("double") + lag)
                          / F.col("stratum_rows").cast("double"))
              .withColumn("cut", F.least(F.floor(F.col("fraction") * cuts), F.lit(cuts - 1)).cast("long")))

    per_cut = (ranked.groupBy("cut").agg(F.count(F.lit(1)).alias("n"))  # one row a cut
               .withColumn("cut_start", F.sum("n").over(Window.orderBy("cut")) - F.col("n"))
               .withColumn("total", F.sum("n").over(Window.partitionBy()))
               .drop("n"))
    in_cut = Window.partitionBy("cut").orderBy("fraction", "stratum", *order)
    placed = (ranked.withColumn("rn2", F.row_number().over(in_cut) - 1)
              .join(per_cut, "cut")
              .withColumn("place", F.col("cut_start") + F.col("rn2"))
              .withColumn("shard", F.expr(f"CAST((place * {n_shards}) div total AS INT)")))
    return placed.select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit(LAW).alias("law"),
        "shard", F.expr(f"place - (CAST(shard AS BIGINT) * total + {n_shards - 1}) div {n_shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "source")
