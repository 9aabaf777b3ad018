"""Near-duplicate documents by SuperMinHash, banding, exact verification and grouping.

Every document is a set of distinct k-word shingles.  SuperMinHash gives each
shingle, round by round, one slot of its own random permutation and a value
``round + uniform``; a slot keeps its smallest value.  Rounds stop for a
document as soon as no later value can be smaller than any it holds.

1. Equal sets become one class (two independent 64-bit sums over the set).
2. Bands of signature rows put classes into buckets.  In each bucket every
   member is compared, on full sets, with the bucket's smallest member.
3. Buckets whose members are not yet all connected are compared in full, in
   blocks, skipping pairs that are already connected.
4. Links become groups by union-find inside tasks and star contraction
   between them.

So a bucket of near copies costs one comparison per member, and no pair that
shares a bucket goes untested unless its two documents are already in one
group.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words
from ledgerline.llm.common import Scratch, pick, release_memory, shuffle_parts, string_bytes, text_or_empty
from ledgerline.llm.graph import components, roots

SHINGLE = 5
SLICE_BYTES = 1 << 20  # texts are hashed in slices of about this size (one text at least)

_GOLDEN = 0x9E3779B97F4A7C15


def super_minhash(values: np.ndarray, sizes: np.ndarray, slots: int) -> np.ndarray:
    """(texts, slots) signatures; a value holds its round above and 32 random bits below.

    Slots of an empty set hold the largest number.
    """
    texts = len(sizes)
    empty = np.iinfo(np.uint64).max
    h = np.full(texts * slots, empty, np.uint64)
    if len(values) == 0:
        return h.reshape(texts, slots)
    owner = np.repeat(np.arange(texts, dtype=np.int64), sizes)

    def draw(x, j):
        r = words.mix(x + np.uint64(_GOLDEN * (j + 1) % (1 << 64)))
        to = np.uint64(j) + (((r & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j)) >> np.uint64(32))
        return (np.uint64(j) << np.uint64(32)) | (r >> np.uint64(32)), to.astype(np.int64)

    value, to = draw(values, 0)
    np.minimum.at(h, owner * slots + to, value)
    permutation = None
    for j in range(1, slots):
        top = h.reshape(texts, slots).max(axis=1)
        going = top >= (np.uint64(j) << np.uint64(32))
        going &= sizes > 0
        if not going.any():
            break
        if permutation is None:  # only elements of unfinished texts get one
            use = going[owner]
            values, owner, to = values[use], owner[use], to[use]
            permutation = np.tile(np.arange(slots, dtype=np.uint16 if slots > 255 else np.uint8), (len(values), 1))
            at = np.arange(len(values))
            permutation[at, to] = 0
            permutation[at, 0] = to
        else:
            use = going[owner]
            if not use.all():
                values, owner, permutation = values[use], owner[use], permutation[use]
                at = np.arange(len(values))
        value, to = draw(values, j)
        slot = permutation[at, to].copy()
        permutation[at, to] = permutation[:, j]
        permutation[:, j] = slot
        np.minimum.at(h, owner * slots + slot.astype(np.int64), value)
    return h.reshape(texts, slots)


def slices(offsets: np.ndarray):
    """Row ranges of about SLICE_BYTES of text each."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, side="right")) - 1
        stop = min(n, max(stop, start + 1))
        yield start, stop
        start = stop


def shingle_batches(column, k: int):
    """(first row, last row, distinct shingles, set sizes) for slices of an Arrow text column without NULLs."""
    flat, offsets = string_bytes(column)
    for start, stop in slices(offsets):
        part = flat[offsets[start]: offsets[stop]]
        hashes, counts = words.word_hashes(part, offsets[start: stop + 1] - offsets[start])
        values, sizes = words.shingle_sets(hashes, counts, k)
        yield start, stop, values, sizes


def set_sums(values: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Two independent 64-bit sums over each set."""
    ends = np.cumsum(sizes)
    out = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(words.mix(values ^ np.uint64(salt)), out=total[1:])
        out.append((total[ends] - total[ends - sizes]).view(np.int64))
    return out


def signatures(rows: DataFrame, *, k: int, bands: int, band_rows: int) -> DataFrame:
    """``doc_id, text, mark`` -> ``doc_id, mark, n_shingles, sum1, sum2, bands`` (band keys as longs)."""
    slots = bands * band_rows

    def sign(batches):
        import pyarrow as pa

        for batch in batches:
            for start, stop, values, sizes in shingle_batches(batch.column(1), k):
                h = super_minhash(values, sizes, slots)
                keys = np.zeros((len(sizes), bands), np.uint64)
                for b in range(bands):
                    key = np.full(len(sizes), b + 1, np.uint64)
                    for r in range(band_rows):
                        key = words.mix(key * np.uint64(0xD6E8FEB86659FD93) + h[:, b * band_rows + r])
                    keys[:, b] = key
                sums = set_sums(values, sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), batch.column(2).slice(start, stop - start),
                     pa.array(sizes, pa.int64()), pa.array(sums[0]), pa.array(sums[1]),
                     pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).ravel()), bands)
                     .cast(pa.list_(pa.int64()))],
                    names=["doc_id", "mark", "n_shingles", "sum1", "sum2", "bands"])
        release_memory()

    return rows.mapInArrow(sign, "doc_id bigint, mark bigint, n_shingles bigint, sum1 bigint, sum2 bigint, "
                                 "bands array<bigint>")


def shingle_table(rows: DataFrame, *, k: int) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, n_shingles, sum1, sum2, shingles`` (sorted distinct 64-bit hashes as binary)."""

    def build(batches):
        import pyarrow as pa

        for batch in batches:
            for start, stop, values, sizes in shingle_batches(batch.column(1), k):
                ends = np.cumsum(sizes)
                sets = [values[e - n: e].tobytes() for e, n in zip(ends, sizes)]
                sums = set_sums(values, sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), pa.array(sizes, pa.int64()), pa.array(sums[0]),
                     pa.array(sums[1]), pa.array(sets, pa.binary())],
                    names=["doc_id", "n_shingles", "sum1", "sum2", "shingles"])
        release_memory()

    return rows.mapInArrow(build, "doc_id bigint, n_shingles bigint, sum1 bigint, sum2 bigint, shingles binary")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify_star(percent: int):
    """Compares a bucket centre with members; rows: centre's own set (member = centre) and the members'."""

    def run(table):
        import pyarrow as pa

        member = table.column("member").to_numpy()
        centre = table.column("centre")[0].as_py()
        sets = table.column("shingles").to_pylist()
        own = np.frombuffer(sets[int(np.flatnonzero(member == centre)[0])], np.uint64)
        good = [m for m, s in zip(member.tolist(), sets)
                if m != centre and _similar(own, np.frombuffer(s, np.uint64), percent)]
        return pa.table({"u": pa.array(good, pa.int64()), "v": pa.array([centre] * len(good), pa.int64())})

    return run


def _verify_block(percent: int):
    """Links between members of two blocks that are not connected yet; returns a forest of them."""

    def run(table):
        import pyarrow as pa

        ids = table.column("member").to_numpy()
        group = table.column("component").to_numpy()
        block = table.column("block").to_numpy()
        order = np.lexsort([ids, group])
        ids, block = ids[order], block[order]
        _, label = np.unique(group[order], return_inverse=True)
        raw = table.column("shingles").to_pylist()
        sets = [np.frombuffer(raw[i], np.uint64) for i in order]
        sizes = np.array([len(s) for s in sets])
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        # Shingles of one member only can not be shared: the others become columns of a 0/1 matrix.
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), sizes)
        values, column, seen = np.unique(flat, return_inverse=True, return_counts=True)
        shared = seen[column] > 1
        number = np.cumsum(seen > 1) - 1
        column, owner = number[column[shared]], owner[shared]
        both = np.zeros((len(sets), len(sets)), np.float32)
        by_column = np.argsort(column, kind="stable")
        column, owner = column[by_column], owner[by_column]
        for start in range(0, int(seen[seen > 1].size), 4096):
            a, b = np.searchsorted(column, [start, start + 4096])
            m = np.zeros((len(sets), 4096), np.float32)
            m[owner[a:b], column[a:b] - start] = 1
            both += m @ m.T
        both = np.rint(both).astype(np.int64)
        union = sizes[:, None] + sizes[None, :] - both
        link = 100 * both >= percent * union
        link &= label[:, None] != label[None, :]
        link &= (block[:, None] == low) & (block[None, :] == high)
        i, j = np.nonzero(link)
        # A forest over the known components: equal connections are returned once.
        n = int(label.max()) + 1
        root = roots(n, label[i], label[j])
        out_u, out_v = [], []
        first = np.full(n, -1)
        first[label[::-1]] = np.arange(len(label))[::-1]
        for c in np.flatnonzero(root != np.arange(n)):
            out_u.append(int(ids[first[c]]))
            out_v.append(int(ids[first[root[c]]]))
        return pa.table({"u": pa.array(out_u, pa.int64()), "v": pa.array(out_v, pa.int64())})

    return run


KEY = ["sum1", "sum2", "n_shingles"]


def group_rows(docs: DataFrame, *, percent: int = 85, k: int = SHINGLE, bands: int = 20, band_rows: int = 6,
               block: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, mark, n_shingles, class, group, component_id``: one row per input row.

    ``mark`` is a checksum of the text (``text_mark``); ``class`` numbers the
    distinct shingle sets, ascending with their smallest id, and ``group`` is
    the smallest class reachable.  Rows are told apart by id and set, so
    several texts of one id are documents of their own.
    """
    scratch = Scratch(docs.sparkSession, "neardup")
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"),
        text_mark("text").alias("mark"))
    signed = scratch.save(signatures(rows, k=k, bands=bands, band_rows=band_rows), "signed")
    usable = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy(*KEY).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    classes = scratch.save(
        classes.repartitionByRange(shuffle_parts(docs.sparkSession), "rep", *KEY).sortWithinPartitions("rep", *KEY)
        .withColumn("class", F.monotonically_increasing_id()), "classes")
    in_bands = classes.select(F.col("class").alias("member"), F.explode("bands").alias("bucket"))
    buckets = in_bands.groupBy("bucket").agg(F.min("member").alias("centre"), F.count(F.lit(1)).alias("members"))
    buckets = buckets.filter("members > 1")
    placed = scratch.save(in_bands.join(buckets, "bucket"), "buckets")

    # Every bucket's members against its smallest one.  The members of a large bucket are dealt to several
    # tasks, each with the centre's own set.
    stars = scratch.save(placed.filter("member != centre").groupBy("centre", "member")
                         .agg(F.max("members").alias("n")), "stars")
    wanted = stars.select(F.col("member").alias("class")).union(stars.select("centre")).distinct()
    wanted = classes.join(wanted, "class", "left_semi").select("class", F.col("rep").alias("doc_id"), *KEY)
    wanted = scratch.save(wanted, "wanted")
    texts = rows.select("doc_id", "text").join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = scratch.save(shingle_table(texts, k=k).join(wanted, ["doc_id", *KEY]).select("class", "shingles")
                        .dropDuplicates(["class"]), "sets")
    salted = stars.withColumn("salt", F.when(F.col("n") > 512, F.pmod(F.xxhash64("member"), F.expr("(n + 255) div 256")))
                              .otherwise(F.lit(0).cast("long"))).drop("n")
    asked = salted.select("centre", "salt", "member").union(
        salted.select("centre", "salt", F.col("centre").alias("member")).distinct())
    links = scratch.save(asked.join(sets, F.col("member") == F.col("class")).drop("class")
                         .groupBy("centre", "salt").applyInArrow(_verify_star(percent), "u bigint, v bigint"), "links")
    groups = components(links, scratch)

    # Buckets that hold more than one group: all pairs of different groups, in blocks.
    labelled = (placed.join(groups, F.col("member") == F.col("node"), "left")
                .withColumn("component", F.coalesce("component", "member"))
                .select("bucket", "member", "component", "members"))
    mixed = (labelled.groupBy("bucket")
             .agg(F.min("component").alias("a"), F.max("component").alias("b"), F.first("members").alias("members"),
                  F.sum(F.xxhash64("member").cast("decimal(20,0)")).alias("who"))
             .filter("a != b AND members > 2")
             # Buckets of the same members need one comparison.
             .groupBy("who", "members").agg(F.min("bucket").alias("bucket")))
    rest = (labelled.join(mixed.select("bucket", F.col("members").alias("size")), "bucket")
            .withColumn("blocks", F.expr(f"CAST((size + {block - 1}) div {block} AS INT)"))
            .withColumn("block", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
            .select("bucket", "low", "high", "member", "component", "block"))
    rest_links = scratch.save(
        rest.join(sets, F.col("member") == F.col("class")).drop("class")
        .groupBy("bucket", "low", "high").applyInArrow(_verify_block(percent), "u bigint, v bigint"), "rest")
    groups = components(links.union(rest_links), scratch)
    scratch.drop(sets)

    # Classes ascend with their smallest ids, so the smallest class of a group has the group's smallest id.
    smallest = classes.select(F.col("class").alias("group"), F.col("rep").alias("component_id"))
    # Saved, so that the join's two sides are plain shuffles and a class of very many copies can be split.
    found = scratch.save(classes.select(*KEY, "class").join(groups, F.col("class") == F.col("node"), "left")
                         .select(*KEY, "class", F.coalesce("component", "class").alias("group"))
                         .join(smallest, "group"), "grouped")
    grouped = usable.join(found, KEY).select("doc_id", "mark", "n_shingles", "class", "group", "component_id")
    none = F.lit(None).cast("long")
    alone = signed.filter("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "mark", "n_shingles", none.alias("class"), none.alias("group"), F.col("doc_id").alias("component_id"))
    return grouped.union(alone)


def text_mark(text_col: str):
    """A checksum of a text, NULL like empty; with the id it tells rows apart."""
    return F.xxhash64(text_or_empty(text_col))


def group_documents(docs: DataFrame, *, percent: int = 85, k: int = SHINGLE, bands: int = 20, band_rows: int = 6,
                    block: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per input row.

    Documents link when 100 * intersection >= ``percent`` * union of their
    shingle sets, confirmed on full sets.  With ``bands`` of ``band_rows``
    signature rows a pair at 0.85 similarity shares no band (and is missed)
    with probability (1 - 0.85**6)**20 < 1e-4.

    A text of fewer than ``k`` words is one shingle; a text without words, or
    NULL, links with nothing.  Rows with NULL ids link with nothing and have a
    NULL component.  Repeated rows of one id are one document with as many
    rows; several texts of one id are documents of their own.  Equal sets tie
    to the smallest id.  Of a very long text a task holds the word and shingle
    hashes.  Empty table: no rows.  Extra columns are not read.
    """
    grouped = group_rows(docs, percent=percent, k=k, bands=bands, band_rows=band_rows, block=block, id_col=id_col,
                         text_col=text_col)
    return grouped.select("doc_id", "n_shingles", "component_id",
                          F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def first_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Whole rows of ``docs``, one of each group (``group_rows``): that of the smallest id.

    Rows without an id stay; of texts without words one a (id, text) stays.
    Of several texts of one id in a group one stays (by checksum), of those in
    different groups one each.
    """
    grouped = group_rows(docs, id_col=id_col, text_col=text_col, **how).filter("doc_id IS NOT NULL")
    firsts = (grouped.filter("class = group AND doc_id = component_id")
              .groupBy("class").agg(F.min(F.struct("doc_id", "mark")).alias("k")).select("k.doc_id", "k.mark"))
    keep = firsts.union(grouped.filter("class IS NULL").select("doc_id", "mark")).distinct()
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_mark(docs[text_col]).alias("mark"),
                       F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    kept = rows.filter("doc_id IS NOT NULL").join(keep, ["doc_id", "mark"], "left_semi").dropDuplicates(["doc_id", "mark"])
    return kept.union(rows.filter("doc_id IS NULL")).select("row.*")
