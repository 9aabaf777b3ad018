"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Unit vectors x are rounded to s * q with integer q in -127..127 and
e = |x - s q|.  For two vectors, |x.y - (s q).(s' q')| <= e' + e |s' q'|, so
only pairs whose integer product plus that bound reaches the threshold are
computed again in double precision.  Vectors are compared inside their label
in tiles of at most ``2 * tile`` vectors; a tile returns a count per vector
and each vector's smallest linked neighbour set, never its pairs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, pick
from ledgerline.llm.graph import components, roots

TILE = 1024


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(integers as float, scale, error norm, norm of the rounded vector) of unit rows."""
    scale = np.abs(unit).max(axis=1) / 127.0
    q = np.rint(unit / scale[:, None])
    rounded = q * scale[:, None]
    error = np.linalg.norm(unit - rounded, axis=1)
    # float32 products of int8 values are exact up to 1,040 dimensions (sums below 2**24).
    kind = np.float32 if unit.shape[1] <= 1040 else np.float64
    return q.astype(kind), scale, error, np.linalg.norm(rounded, axis=1)


def linked_pairs(x: np.ndarray, rows: np.ndarray, cols: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i of ``rows``, j of ``cols``) of vectors ``x`` with cosine >= threshold, by bounded products."""
    # Scaled by a power of two near the largest component, which changes no cosine: squares of very large or small
    # components neither overflow nor vanish.
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    norms = np.sqrt(np.einsum("ij,ij->i", x, x))
    unit = x / norms[:, None]
    q, scale, error, size = quantise(unit)
    slack = 1e-9  # far above the rounding of the double products themselves
    found_i, found_j = [], []
    for at in range(0, len(rows), 256):
        r = rows[at: at + 256]
        product = (q[r] @ q[cols].T).astype(np.float64)
        product *= scale[r][:, None]
        product *= scale[cols][None, :]
        product += error[cols][None, :] + error[r][:, None] * size[cols][None, :]
        i, j = np.nonzero(product >= threshold - slack)
        for cut in range(0, len(i), 1 << 15):
            a, b = r[i[cut: cut + (1 << 15)]], cols[j[cut: cut + (1 << 15)]]
            cosine = np.einsum("ij,ij->i", x[a], x[b]) / (norms[a] * norms[b])
            keep = cosine >= threshold
            found_i.append(a[keep])
            found_j.append(b[keep])
    empty = np.zeros(0, np.int64)
    return (np.concatenate(found_i) if found_i else empty), (np.concatenate(found_j) if found_j else empty)


def _tile(threshold: float):
    def run(table):
        import pyarrow as pa

        rep = table.column("rep").to_numpy()
        block = table.column("block").to_numpy()
        copies = table.column("copies").to_numpy()
        vectors = table.column("vector").combine_chunks()
        x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rep), -1)
        order = np.argsort(rep)  # roots() then yields the smallest id
        rep, block, copies, x = rep[order], block[order], copies[order], x[order]
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        rows = np.flatnonzero(block == low)
        cols = np.flatnonzero(block == high)
        i, j = linked_pairs(x, rows, cols, threshold)
        if low == high:
            keep = i < j
            i, j = i[keep], j[keep]
        links = (np.bincount(i, weights=copies[j], minlength=len(rep))
                 + np.bincount(j, weights=copies[i], minlength=len(rep))).astype(np.int64)
        root = rep[roots(len(rep), i, j)]
        has = links > 0
        return pa.table({"rep": rep[has], "root": root[has], "links": links[has]})

    return run


def near_duplicates(vectors: DataFrame, *, threshold: float = 0.98, tile: int = TILE, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per input row.

    Two vectors link if their labels are equal and not NULL, their lengths are
    equal and their cosine in double precision is at least ``threshold``.
    Vectors that are NULL, empty, zero or hold NULL, NaN or infinite
    components link with nothing.  Equal vectors of a label are compared once
    and counted in full.  Repeated rows are vectors of their own.  A row
    without an id links with nothing and has a NULL component.  Empty table:
    no rows.
    """
    scratch = Scratch(vectors.sparkSession, "embeddings")
    rows = pick(vectors, vec_id=id_col, vector=vector_col, label=label_col)
    rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    usable = F.expr("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0"
                    " AND NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
                    " AND exists(vector, x -> x != 0)")
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    good = rows.filter("usable")
    classes = scratch.save(good.groupBy("label", "vector")
                           .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
                           .withColumn("width", F.size("vector")), "classes")
    blocks = (classes.groupBy("label", "width").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("blocks", F.expr(f"CAST((n + {tile - 1}) div {tile} AS INT)")).drop("n"))
    dealt = (classes.join(blocks, ["label", "width"])
             .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")))
    found = scratch.save(
        dealt.select("label", "width", "low", "high", "rep", "block", "copies", "vector")
        .groupBy("label", "width", "low", "high")
        .applyInArrow(_tile(threshold), "rep bigint, root bigint, links bigint"), "tiles")
    groups = components(found.select("rep", "root"), scratch)
    # Saved, so that the join's two sides are plain shuffles and a class of very many copies can be split.
    per_class = scratch.save(
        classes.select("label", "vector", "rep", "copies")
        .join(found.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left")
        .join(groups, F.col("rep") == F.col("node"), "left")
        .select("label", "vector", F.coalesce("component", "rep").alias("component_id"),
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "linked")
    linked = good.join(per_class, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                             F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
