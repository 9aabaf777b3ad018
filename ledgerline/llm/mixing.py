"""Mixing sources to target weights by Sainte-Lague apportionment (DataFrame operations only).

The corpus total is split over the sources by weight; a source may be
repeated up to ``max_repeats`` times, and what it cannot give is shared again
by weight.  Targets become whole blocks of ``block_words`` words: seats go to
the sources with the highest quotients target / (2k + 1).  Seats are cut in
quotient order into ``n_shards`` runs, which gives each shard whole quotas
per source.  A source's documents, in seeded random order, form a ring of
words; from a seeded block on, each shard in turn takes its quota of
consecutive blocks.  Last, a source gets the words by which its blocks fall
short of its target, if these are fewer than a block, so that sources smaller
than a block are not left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, cell_digits_for, pick, text_or_empty
from ledgerline.llm.sharding import seeded

WEIGHTS = (5, 2, 1)


def word_count(col: str):
    """Number of words as a long; 0 for NULL."""
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """``stratum, source, source_size`` -> the same with ``idx, weight, cap, target``.

    One row per source.  Sources are weighted by code point order (NULL last),
    the weights repeating.  Water level: sources sorted by cap / weight are
    full as long as their cap lies below the level that the rest would share.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = (sizes.withColumn("idx", F.row_number().over(by_name) - 1)
         .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                            (F.col("idx") % len(weights) + 1).cast("int")).cast("double"))
         .withColumn("cap", F.col("source_size").cast("double") * max_repeats)
         .withColumn("ratio", F.col("cap") / F.col("weight")))
    everything = Window.partitionBy()
    before = Window.orderBy("ratio", "idx").rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("total", F.sum("source_size").over(everything).cast("double"))
         .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
         .withColumn("full", F.col("ratio") <= F.col("level")))
    water = F.min(F.when(~F.col("full"), F.struct("ratio", "idx", "level"))).over(everything)["level"]
    return (s.withColumn("target", F.when(F.col("full"), F.col("cap"))
                         .otherwise(F.least(F.col("cap"), F.col("weight") * water)))
            .select("stratum", "source", "source_size", "idx", "weight", "cap", "target", "total"))


def quotas(sized: DataFrame, *, block_words: int, n_shards: int, max_repeats: int = 3) -> DataFrame:
    """``stratum, shard, blocks, blocks_before``: whole blocks of each source in each shard.

    Seats are dealt one by one to the highest quotient target / (2k + 1)
    (ties: lower ``idx``).  Only quotients near the last seat can decide, so
    each source lists those around its even share; the rest are sure seats.
    The width of that list grows with the share times sources per seat, which
    keeps all lists together at a few rows per source and shard.
    """
    everything = Window.partitionBy()
    s = (sized.withColumn("sources", F.count(F.lit(1)).over(everything).cast("double"))
         .withColumn("limit", F.expr(f"({max_repeats} * source_size) div {block_words}")))
    cut = s.select("*", F.explode(F.sequence(F.lit(1), F.lit(n_shards))).alias("cut")).withColumn(
        "seats", F.expr(f"CAST(total AS BIGINT) div {block_words} * cut div {n_shards}"))
    per_cut = Window.partitionBy("cut")
    cut = (cut.withColumn("even", F.when(F.col("total") > 0, F.col("target") / F.col("total") * F.col("seats"))
                          .otherwise(0.0))
           .withColumn("slack", F.ceil(2 * F.col("even") * F.col("sources")
                                       / F.greatest(F.col("seats"), F.lit(1))) + 3)
           .withColumn("sure", F.greatest(F.lit(0), F.least(F.col("limit"), F.floor("even") - F.col("slack"))))
           .withColumn("most", F.least(F.col("limit"), F.floor("even") + F.col("slack")))
           .withColumn("open", F.col("seats") - F.sum("sure").over(per_cut)))
    lists = (cut.filter(F.col("most") > F.col("sure"))
             .select("cut", "stratum", "idx", "target", "open",
                     F.explode(F.sequence(F.col("sure"), F.col("most") - 1)).alias("k"))
             .withColumn("quotient", F.col("target") / (2 * F.col("k") + 1))
             .withColumn("turn", F.row_number().over(per_cut.orderBy(F.desc("quotient"), "idx", "k")))
             .filter(F.col("turn") <= F.col("open"))
             .groupBy("cut", "stratum").agg(F.count(F.lit(1)).alias("won")))
    upto = (cut.select("cut", "stratum", "sure").join(lists, ["cut", "stratum"], "left")
            .withColumn("upto", F.col("sure") + F.coalesce(F.col("won"), F.lit(0))))
    earlier = F.coalesce(F.lag("upto").over(Window.partitionBy("stratum").orderBy("cut")), F.lit(0))
    return upto.select("stratum", (F.col("cut") - 1).alias("shard"), (F.col("upto") - earlier).alias("blocks"),
                       earlier.alias("blocks_before"))


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = 3, block_words: int = 16,
        n_shards: int = 8, seed: int = 29, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", cell_digits: int | None = None) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target, taken, copies, shards, weight, blocks``.

    ``taken`` counts the words the mix takes of the document, repeats
    included (never over ``max_repeats`` times its size); ``copies`` counts
    how often its first word is taken, which is the whole number of times to
    write the document, and ``shards`` names the shard of each copy: that in
    whose quota its first word lies.  ``blocks`` is the quota of the source.

    NULL text: size 0, taken 0.  NULL source: a source of its own, last.
    NULL ids and repeated rows are kept; rows that tie in hash, id and size
    are equal but for their place in the ring.  Empty table: no rows.  Extra
    columns are not read, and of a very long text only its words are counted.
    The windows over sources hold one row per source (times shards), not
    documents.  ``cell_digits`` hex digits of the seeded hash cut a source into
    cells, which bound the rows one task sorts; from the row count if not given.
    """
    rows = pick(docs, id=id_col, source=source_col, text=text_col).select(
        "id", "source", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("stratum"),
        word_count("text").alias("size"), seeded(seed, "id").alias("h"))
    mixed = mix_sized(rows, weights=weights, max_repeats=max_repeats, block_words=block_words,
                      n_shards=n_shards, seed=seed, cell_digits=cell_digits or cell_digits_for(docs.count()))
    return mixed.withColumnRenamed("id", "doc_id")


def repeat_documents(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = 3,
                     block_words: int = 16, n_shards: int = 8, seed: int = 29, id_col: str = "doc_id",
                     text_col: str = "text", source_col: str = "source", cell_digits: int | None = None) -> DataFrame:
    """The mix as documents: every row of ``docs``, all its columns, as many times as ``mix`` says (0 to
    ``max_repeats``).  Documents without words are not taken.  NULLs, ties and
    repeated rows as in ``mix``; very long texts are only counted and carried.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"),
                       F.coalesce(F.concat(F.lit("s"), docs[source_col]), F.lit("n")).alias("stratum"),
                       word_count(docs[text_col]).alias("size"),
                       F.struct(*[docs[c] for c in docs.columns]).alias("row")).withColumn("h", seeded(seed, "id"))
    mixed = mix_sized(rows, weights=weights, max_repeats=max_repeats, block_words=block_words, n_shards=n_shards,
                      seed=seed, cell_digits=cell_digits or cell_digits_for(docs.count()))
    return (mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("row.*"))


def mix_sized(rows: DataFrame, *, weights, max_repeats, block_words, n_shards, seed, cell_digits) -> DataFrame:
    """``mix`` for rows ``id, source, stratum, size, h`` (and whatever else they carry)."""
    rows = rows.withColumn("cell", F.substring("h", 1, cell_digits))
    cells = rows.groupBy("stratum", "source", "cell").agg(F.sum("size").alias("cell_size"))
    sized = targets(cells.groupBy("stratum", "source").agg(F.sum("cell_size").alias("source_size")),
                    weights=weights, max_repeats=max_repeats)
    # Per source: its blocks, and where each shard's run of them ends, counted from the first.
    blocks = (quotas(sized, block_words=block_words, n_shards=n_shards, max_repeats=max_repeats)
              .groupBy("stratum").agg(F.sum("blocks").alias("blocks"), F.sort_array(F.collect_list(
                  F.struct("shard", (F.col("blocks_before") + F.col("blocks")).alias("upto")))).alias("runs")))
    first = F.conv(F.substring(seeded(seed, "stratum"), 1, 8), 16, 10).cast("long")
    plan = (sized.join(blocks, "stratum")
            .withColumn("ring_from", F.pmod(first, F.greatest(F.expr(f"source_size div {block_words}"), F.lit(1)))
                        * block_words)
            .withColumn("rest", F.greatest(F.lit(0), F.least(
                F.lit(block_words - 1),
                F.floor(F.col("target") + 1e-6).cast("long") - F.col("blocks") * block_words)))
            .withColumn("ring_to", F.col("ring_from") + F.col("blocks") * block_words + F.col("rest"))
            .withColumn("runs", F.expr(f"transform(runs, r -> ring_from + r.upto * {block_words})"))
            .select("stratum", "source_size", "target", "weight", "blocks", "ring_from", "ring_to", "runs"))
    starts = (cells.withColumn("cell_start", F.sum("cell_size").over(
        Window.partitionBy("stratum").orderBy("cell")) - F.col("cell_size"))
        .select("stratum", "cell", "cell_start").join(plan, "stratum"))
    in_cell = (Window.partitionBy("stratum", "cell").orderBy("h", "id", "size")
               .rowsBetween(Window.unboundedPreceding, 0))
    placed = (rows.withColumn("upto", F.sum("size").over(in_cell))
              .join(starts, ["stratum", "cell"])
              .withColumn("at", F.col("cell_start") + F.col("upto") - F.col("size")))

    def covered(ring: str, width: str) -> str:
        """Words of [at, at + width) that lie before ``ring`` on the unrolled ring."""
        return (f"({ring} div source_size) * {width}"
                f" + least({width}, greatest(0L, {ring} % source_size - at))")

    taken = (f"CASE WHEN size = 0 THEN 0L ELSE {covered('ring_to', 'size')} - ({covered('ring_from', 'size')}) END")
    copies = (f"CASE WHEN size = 0 THEN 0L ELSE {covered('ring_to', '1L')} - ({covered('ring_from', '1L')}) END")
    # The k-th copy's first word on the unrolled ring; a run's end belongs to the next shard, the rest to the last.
    first = "(at + CASE WHEN at < ring_from THEN source_size ELSE 0L END)"
    shards = (f"CASE WHEN copies = 0 THEN array() ELSE transform(sequence(0L, copies - 1), k -> least({n_shards - 1}, "
              f"CAST(size(filter(runs, e -> e <= {first} + k * source_size)) AS INT))) END")
    return (placed.withColumn("taken", F.expr(taken)).withColumn("copies", F.expr(copies))
            .withColumn("shards", F.expr(shards).cast("array<int>"))
            .drop("cell", "upto", "cell_start", "at", "ring_from", "ring_to", "runs", "h", "stratum"))
