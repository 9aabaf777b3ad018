"""Document fingerprints by winnowing (DataFrame operations only).

A text's words (lower-cased) are hashed once each; from these come rolling
hashes of every ``k`` consecutive words; from every ``window`` consecutive
hashes the smallest is kept, the rightmost one on ties, with its position.
Any passage of ``k + window - 1`` words that two texts share therefore leaves
the same hash in both fingerprints.

The rolling hash is the cyclic polynomial: a run's hash is its words' hashes,
each rotated by the number of words after it, joined by xor.  The hash of a
run so follows from those of its two parts, and runs of 2, 4, 8 ... words are
built from one another for all places at once, whatever ``k``.  The minimum
over a window is built by the same doubling, on the places of the hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import pick, range_bounds, range_number, shuffle_parts, text_or_empty

K = 5
WINDOW = 8


def _rotated(x: str, by: int) -> str:
    """SQL: the long ``x`` rotated left."""
    by %= 64
    return f"(shiftleft({x}, {by}) | shiftrightunsigned({x}, {64 - by}))" if by else x


def _with_rolling(df: DataFrame, words: str, out: str, k: int) -> DataFrame:
    """Adds ``out``: the hash of the ``k`` words from every place of ``words`` on (too near the end: NULL)."""
    power, spare = f"{out}_p", f"{out}_s"
    df = df.withColumn(power, F.col(words))
    length, done = 1, 0  # words in a run of ``power``; words in a run of ``out`` so far
    while True:
        if k & length:
            if done:  # the words of ``out``, then a run of ``power`` after them
                df = df.withColumn(spare, F.expr(
                    f"zip_with({out}, slice({power}, {done + 1}, size({power})), (x, y) -> {_rotated('x', length)} ^ y)"))
                df = df.drop(out).withColumnRenamed(spare, out)
            else:
                df = df.withColumn(out, F.col(power))
            done += length
        if done == k:
            return df.drop(power)
        df = df.withColumn(power, F.expr(
            f"transform({power}, (x, i) -> {_rotated('x', length)} ^ get({power}, i + {length}))"))
        length *= 2


def with_fingerprint(df: DataFrame, text: str, out: str, *, k: int = K, window: int = WINDOW) -> DataFrame:
    """Adds ``out``: the kept hashes of ``text`` and their word positions, two arrays of one struct, by position.

    A text of fewer than ``k`` words has its whole sequence as its only hash;
    a text without words has an empty fingerprint, a NULL text counts as
    empty.  Texts of any length are taken whole.
    """
    w, g, m = f"__{out}_w", f"__{out}_g", f"__{out}_m"
    # An array that a lambda looks into stands twice in its step, or the optimizer would put the array's own
    # expression into the lambda and work it out again for every element.
    out_df = df.withColumn(w, F.transform(F.filter(
        F.split(F.lower(text_or_empty(text)), r"[\x20\x09-\x0D]+"), lambda x: x != ""), lambda x: F.xxhash64(x)))
    out_df = _with_rolling(out_df, w, g, k)
    out_df = out_df.withColumn(g, F.expr(
        f"CASE WHEN size({w}) = 0 THEN array() WHEN size({w}) < {k} THEN array(xxhash64({w}))"
        f" ELSE slice({g}, 1, greatest(1, size({w}) - {k - 1})) END"))
    # Place of each window's smallest hash; a later place wins a tie; beyond the end there is nothing to win.
    out_df = out_df.withColumn(m, F.expr(f"transform({g}, (x, i) -> i)"))
    span = 1
    while span < window:
        shift = min(span, window - span)
        later = f"get({m}, i + {shift})"
        out_df = out_df.withColumn(m, F.expr(
            f"transform({m}, (p, i) -> if(get({g}, {later}) <= get({g}, p), {later}, p))"))
        span += shift
    # Short texts: fewer hashes than a window give the one minimum of all.
    out_df = out_df.withColumn(m, F.expr(
        f"array_distinct(slice({m}, 1, greatest(1, size({g}) - {window - 1})))"))
    out_df = out_df.withColumn(out, F.expr(
        f"named_struct('hashes', transform({m}, p -> get({g}, p)), 'positions', {m})"))
    return out_df.drop(w, g, m)


def hashes(fingerprint: str) -> str:
    """SQL: the distinct hashes of a fingerprint, without positions."""
    return f"array_distinct({fingerprint}.hashes)"


def positions(fingerprint: str) -> str:
    """SQL: the kept word positions of a fingerprint."""
    return f"{fingerprint}.positions"


def as_text(fingerprint: str) -> str:
    """SQL: ``hash@position`` items in position order; the hash in hex."""
    return (f"concat_ws(' ', zip_with({fingerprint}.hashes, {fingerprint}.positions,"
            f" (x, p) -> concat(lower(hex(x)), '@', p)))")


def likeness(a: str, b: str) -> str:
    """SQL: Jaccard likeness of two arrays of distinct hashes; 1 if both are empty."""
    both = f"size(array_intersect({a}, {b}))"
    return (f"CASE WHEN size({a}) = 0 AND size({b}) = 0 THEN 1.0D"
            f" ELSE CAST({both} AS DOUBLE) / (size({a}) + size({b}) - {both}) END")


def with_next(df: DataFrame, key: str, columns: list[str], tie: str, n_ranges: int | None = None) -> DataFrame:
    """Adds ``next_<column>``: the values of the next row in descending ``key`` order (the last row: of the first).

    Rows are cut into ranges of near equal count, each sorted by itself; the
    highest row of a range is also copied into the range above, where it
    follows that range's lowest row.  So the rows are shuffled once and no
    task sees more than a range.  NULL keys come last.  Rows with equal keys
    stand in the order of a hash of ``tie``, which must settle all of ``columns``.
    """
    spark = df.sparkSession
    keys = df.select(key)
    bounds = range_bounds(keys, key, n_ranges or 4 * shuffle_parts(spark))
    ranged = df.withColumn("__range", range_number(key, bounds))
    order = [F.desc_nulls_last(key), F.desc("__tie")]
    ranged = ranged.withColumn("__tie", F.xxhash64(tie))
    # The first row of each range, found on the narrow columns (one row a range: at most len(bounds) + 2).
    heads = (ranged.groupBy("__range")
             .agg(F.max(F.struct(F.col(key).alias("k"), F.col("__tie").alias("t"))).alias("head")))
    above = Window.orderBy(F.desc("__range"))
    heads = (heads.withColumn("to", F.lag("__range").over(above))
             .withColumn("to", F.coalesce("to", F.min("__range").over(Window.partitionBy())))
             .select(F.col("__range").alias("__from"), F.col("head.k").alias("__k"), F.col("head.t").alias("__t"),
                     F.col("to").alias("__to")))
    tagged = ranged.join(F.broadcast(heads), (F.col("__range") == F.col("__from"))
                         & F.col(key).eqNullSafe(F.col("__k")) & (F.col("__tie") == F.col("__t")), "left")
    # Rows that tie with a head are equal to it, so a copy more of a ghost changes nothing.
    copies = tagged.withColumn("__at", F.explode(F.when(
        F.col("__to").isNull(), F.array(F.struct(F.col("__range").alias("r"), F.lit(False).alias("ghost"))))
        .otherwise(F.array(F.struct(F.col("__range").alias("r"), F.lit(False).alias("ghost")),
                           F.struct(F.col("__to").alias("r"), F.lit(True).alias("ghost"))))))
    copies = copies.withColumn("__range", F.col("__at.r")).withColumn("__ghost", F.col("__at.ghost"))
    within = Window.partitionBy("__range").orderBy("__ghost", *order)
    out = copies.select(*df.columns, "__ghost", *[F.lead(c).over(within).alias(f"next_{c}") for c in columns])
    return out.filter(~F.col("__ghost")).drop("__ghost")


def fingerprint_documents(docs: DataFrame, *, k: int = K, window: int = WINDOW, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, text, fingerprint`` (kept hashes and positions) of every document.

    NULL text: empty, with an empty fingerprint.  Equal texts have equal
    fingerprints.  Repeated rows are kept.  Extra columns are not read.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", text_or_empty("text"))
    return with_fingerprint(rows.withColumn("n_chars", F.length("text").cast("long")), "text", "fingerprint",
                            k=k, window=window)


def compare_edited(docs: DataFrame, *, k: int = K, window: int = WINDOW, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Each document's fingerprint against its edited text's and the next document's.

    Edited text: the last floor(n_chars / 2) code points replaced by the first
    as many (or all) of the next document in descending id order (after the
    last: the first).  Columns ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``; likeness is Jaccard over the
    kept hashes.  A table of one row has itself as next; no rows give none.
    """
    own = fingerprint_documents(docs, k=k, window=window, id_col=id_col, text_col=text_col)
    own = own.withColumn("kept", F.expr(hashes("fingerprint")))
    paired = with_next(own, "doc_id", ["text", "kept"], tie="text")
    # A single range with a single row follows itself.
    paired = paired.withColumn("edited", F.expr(
        "concat(substring(text, 1, CAST(n_chars - n_chars div 2 AS INT)),"
        " substring(next_text, 1, CAST(n_chars div 2 AS INT)))")).drop("text", "next_text")
    paired = with_fingerprint(paired, "edited", "edited_fp", k=k, window=window)
    paired = paired.withColumn("__e", F.expr(hashes("edited_fp")))
    return paired.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.expr(as_text("fingerprint")).alias("fingerprint"),
        F.expr(as_text("edited_fp")).alias("edited_fingerprint"),
        F.expr(likeness("kept", "__e")).alias("near_edited"),
        F.expr(likeness("kept", "next_kept")).alias("near_next"))
