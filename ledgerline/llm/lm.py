"""Language-model scoring: self-attention over subword ids beside corpus word counts.

1. Texts are read once, in blocks of rows. A block keeps its distinct words
   (hash and subword ids) and every document as indexes into them.
2. Word counts: each block's words go to hash ranges, are added up over all
   training documents, and come back as totals aligned with the block.
3. Subword statistics over all training documents (id counts, pairs of the
   commonest ids) give every id a class and an input vector; the attention
   model is trained on all windows of the training documents, in one pass dealt
   over rounds and tasks; the tasks' parameters are averaged after each round.
4. Scoring: per word, the probability is a mixture of the attention model's
   (class by attention, id within its class by counts after the id before)
   and the word's share of the corpus; overlapping windows score each id once.

The driver receives the id counts, summed pair counts (``TOP`` squared) and
averaged parameters: all bounded by the vocabulary.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import attention, words
from ledgerline.llm.common import (
    Scratch, crc_mod, pick, shuffle_parts, string_bytes, string_offsets, text_or_empty,
)
from ledgerline.llm.neardup import slices
from ledgerline.llm.tokens import broadcast_file, encoder, tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
IDS = 50257
END = 50256           # also the start mark
BLOCK_ROWS = 2048     # documents of a block, at most
BLOCK_BYTES = 1 << 24  # text bytes of a block, at most (one document at least)
HASHED = 1 << 18       # words hashed at once
RANGE_WORDS = 1 << 20  # entries (distinct words of a block) of a hash range, about
TOP, NEIGHBOURS = 2048, 64
SINGLES, CLUSTERS = 12, 8   # classes: frequent ids alone; clusters of the ids that start a word, and of the others
INPUTS = 16
ROUNDS = 2
BACKOFF = 5.0         # weight of p(id | class) against the counts after the previous id
TASK_WINDOWS = 51200  # training windows of a task (at most twice as many): 400 steps a pass
ROW_WINDOWS = 64      # windows dealt together
LOCAL = 0.75          # weight of the attention model in a word's mixture

_BLOCK = ("block bigint, doc_ids binary, no_id binary, trained binary, counts binary, words binary, "
          "hashes binary, id_counts binary, ids binary, train_counts binary")


def blocks(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, text, trained`` -> one row per block of documents (arrays as bytes)."""
    file = broadcast_file(rows.sparkSession, tokenizer)

    def build(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        enc = encoder(file.value, "byte", ordinary=True)
        number = TaskContext.get().partitionId() << 32
        schema = pa.schema([(n, pa.int64() if n == "block" else pa.binary())
                            for n in (f.split()[0] for f in _BLOCK.split(", "))])
        for batch in batches:
            offsets = string_offsets(batch.column(1))
            at = 0
            while at < batch.num_rows:
                fits = int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, side="right")) - 1
                stop = min(at + BLOCK_ROWS, max(fits, at + 1))
                part = batch.slice(at, stop - at)
                yield pa.RecordBatch.from_pylist([{"block": number, **_block(part, enc)}], schema=schema)
                number += 1
                at = stop

    return rows.mapInArrow(build, _BLOCK)


def _block(part, enc) -> dict:
    flat, offsets = string_bytes(part.column(1))
    flat = words.LOWER[flat]
    hashes, counts, starts, stops = [], [], [], []
    for a, b in slices(offsets):
        base = offsets[a]
        piece = flat[base: offsets[b]]
        s, e, n = words.word_spans(piece, offsets[a: b + 1] - base)
        for k in range(0, len(s), HASHED):
            own_s, own_e = s[k: k + HASHED], e[k: k + HASHED]
            hashes.append(words.span_hashes(piece[own_s[0]: own_e[-1]], own_s - own_s[0], own_e - own_s[0]))
        counts.append(n)
        starts.append(s + base)
        stops.append(e + base)
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    first, index = words.distinct(hashes)
    ascending = np.argsort(hashes[first])
    first, distinct = first[ascending], hashes[first[ascending]]
    place_of = np.empty(len(first), np.int64)
    place_of[ascending] = np.arange(len(first))
    index = place_of[index]
    none = np.zeros(0, np.int64)
    per, ids = enc.spaced(flat, np.concatenate([none, *starts])[first], np.concatenate([none, *stops])[first])
    trained = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
    seen = np.bincount(index[np.repeat(trained, counts)], minlength=len(distinct))
    keys = part.column(0)
    return {
        "doc_ids": keys.fill_null(0).to_numpy().astype("<i8").tobytes(),
        "no_id": keys.is_null().to_numpy(zero_copy_only=False).tobytes(),
        "trained": trained.tobytes(), "counts": counts.astype("<i8").tobytes(),
        "words": index.astype("<u4").tobytes(), "hashes": distinct.tobytes(),
        "id_counts": per.astype("<u4").tobytes(), "ids": ids.astype("<u2").tobytes(),
        "train_counts": seen.astype("<i8").tobytes()}


def word_totals(saved: DataFrame, scratch: Scratch) -> tuple[DataFrame, int, int]:
    """(``block, totals`` aligned with the block's words, training tokens N, distinct training tokens V without ends).

    Words meet by hash range; there are as many ranges as the entries counted
    ask for, about ``RANGE_WORDS`` each.
    """
    entries = (saved.agg(F.sum(F.length("train_counts"))).head()[0] or 0) // 8
    ranges = max(4 * shuffle_parts(saved.sparkSession), -(-entries // RANGE_WORDS))

    def deal(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                h = np.frombuffer(row["hashes"], np.uint64)
                c = np.frombuffer(row["train_counts"], "<i8")
                to = ((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)  # hashes ascend, so ranges do
                cuts = np.searchsorted(to, np.arange(ranges + 1, dtype=np.uint64))
                full = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full.astype(np.int32)), pa.array(np.full(len(full), row["block"], np.int64)),
                     pa.array([h[cuts[r]: cuts[r + 1]].tobytes() for r in full], pa.binary()),
                     pa.array([c[cuts[r]: cuts[r + 1]].tobytes() for r in full], pa.binary())],
                    names=["range", "block", "hashes", "counts"])

    def add(key, table):
        import pyarrow as pa

        h = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
        c = np.concatenate([np.frombuffer(x, "<i8") for x in table.column("counts").to_pylist()])
        _, index = words.distinct(np.concatenate(h))
        total = np.bincount(index, weights=c).astype(np.int64)
        mine = np.split(total[index], np.cumsum([len(x) for x in h])[:-1])
        n = len(h)
        return pa.table({"range": pa.array([key[0].as_py()] * n, pa.int32()), "block": table.column("block"),
                         "totals": pa.array([m.astype("<i8").tobytes() for m in mine], pa.binary()),
                         "known": pa.array([int((total > 0).sum())] + [0] * (n - 1), pa.int64()),
                         "seen": pa.array([int(total.sum())] + [0] * (n - 1), pa.int64())})

    dealt = saved.select("block", "hashes", "train_counts").mapInArrow(
        deal, "range int, block bigint, hashes binary, counts binary")
    parts = scratch.save(dealt.groupBy("range").applyInArrow(
        add, "range int, block bigint, totals binary, known bigint, seen bigint"), "totals")
    sums = parts.agg(F.sum("seen").alias("n"), F.sum("known").alias("v")).head()

    def gather(key, table):
        import pyarrow as pa

        order = np.argsort(table.column("range").to_numpy())
        pieces = table.column("totals").to_pylist()
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()),
                         "totals": pa.array([b"".join(pieces[i] for i in order)], pa.binary())})

    return (parts.select("range", "block", "totals").groupBy("block").applyInArrow(gather, "block bigint, totals binary"),
            sums["n"] or 0, sums["v"] or 0)


def _texts(row: dict, only_trained: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all texts with start and end marks, ids per text, words per text, ids per word)."""
    counts = np.frombuffer(row["counts"], "<i8")
    index = np.frombuffer(row["words"], "<u4")
    if only_trained:
        trained = np.frombuffer(row["trained"], bool)
        index, counts = index[np.repeat(trained, counts)], counts[trained]
    # The marks are two more words of one id each, before the first and after the last word of every text.
    per = np.append(np.frombuffer(row["id_counts"], "<u4").astype(np.int64), 1)
    ids = np.append(np.frombuffer(row["ids"], "<u2"), np.uint16(END))
    ends = np.cumsum(counts + 2)
    inside = np.ones(len(index) + 2 * len(counts), bool)
    inside[ends - counts - 2] = inside[ends - 1] = False
    every = np.full(len(inside), len(per) - 1, np.uint32)
    every[inside] = index
    n = per[every]
    word_end = np.cumsum(n)
    total = int(word_end[-1]) if len(n) else 0
    kind = np.int32 if max(total, len(ids)) < 1 << 31 else np.int64  # places, in as few bytes as hold them
    source = np.repeat(((np.cumsum(per) - per)[every] - (word_end - n)).astype(kind), n)
    source += np.arange(total, dtype=kind)
    return ids.take(source), np.diff(word_end[ends - 1], prepend=0), counts, n[inside]


def _sum_vectors(table):
    """Adds up float vectors of equal ``id``."""
    import pyarrow as pa

    ids = table.column("id").to_numpy()
    values = np.stack([np.frombuffer(x, "<f4") for x in table.column("value").to_pylist()])
    keys, index = np.unique(ids, return_inverse=True)
    total = np.zeros((len(keys), values.shape[1]), np.float64)
    np.add.at(total, index, values)
    return pa.table({"id": pa.array(keys, pa.int64()),
                     "value": pa.array([t.astype("<f4").tobytes() for t in total], pa.binary())})


def _summed(vectors: DataFrame, groups: int) -> DataFrame:
    return (vectors.withColumn("part", F.pmod("id", F.lit(groups))).groupBy("part")
            .applyInArrow(_sum_vectors, "id bigint, value binary"))


@dataclass(frozen=True)
class Model:
    parameters: np.ndarray
    classes_of: np.ndarray   # class of each id
    log_inside: np.ndarray   # log p(id | its class)
    vectors: np.ndarray      # input vector of each id
    rank: np.ndarray         # rank of each id
    log_after: np.ndarray    # log p(id | its class, the id before), by ranks

    @property
    def classes(self) -> int:
        return int(self.classes_of.max()) + 1


def id_counts(saved: DataFrame) -> np.ndarray:
    """How often each id occurs in the training documents, end marks included."""

    def count(batches):
        import pyarrow as pa

        total = np.zeros(IDS, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                per = np.frombuffer(row["id_counts"], "<u4").astype(np.int64)
                seen = np.frombuffer(row["train_counts"], "<i8")
                total += np.bincount(np.frombuffer(row["ids"], "<u2"), weights=np.repeat(seen, per),
                                     minlength=IDS).astype(np.int64)
                total[END] += int(np.frombuffer(row["trained"], bool).sum())
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["id", "n"])

    found = (saved.select("id_counts", "ids", "train_counts", "trained").mapInArrow(count, "id bigint, n bigint")
             .groupBy("id").agg(F.sum("n").alias("n")).collect())  # at most IDS rows
    out = np.zeros(IDS, np.int64)
    for r in found:
        out[r["id"]] = r["n"]
    return out


def ranks(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the commonest ids, at most ``TOP``; rank of every id, ``TOP`` for all others)."""
    top = np.argsort(-counts, kind="stable")[:TOP]
    top = top[counts[top] > 0]
    rank = np.full(IDS, TOP, np.int64)
    rank[top] = np.arange(len(top))
    return top, rank


def pair_counts(saved: DataFrame, rank: np.ndarray) -> np.ndarray:
    """Counts of rank pairs, earlier id by row."""

    def walk(batches):
        import pyarrow as pa

        pairs = np.zeros((TOP + 1, TOP + 1), np.float32)
        for batch in batches:
            for row in batch.to_pylist():
                tokens, lengths, _, _ = _texts(row, only_trained=True)
                r = rank[tokens]
                keys = r[:-1] * (TOP + 1)
                keys += r[1:]
                pairs += np.bincount(keys, minlength=pairs.size).reshape(pairs.shape)
                # A text's start mark follows nothing: between texts are an end and a start mark, which are one id.
                pairs[rank[END], rank[END]] -= max(len(lengths) - 1, 0)
        some = np.flatnonzero(pairs.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([pairs[i].tobytes() for i in some],
                                                                   pa.binary())], names=["id", "value"])

    found = saved.select("trained", "counts", "words", "id_counts", "ids").mapInArrow(walk, "id bigint, value binary")
    out = np.zeros((TOP + 1, TOP + 1))
    for r in _summed(found, 32).collect():  # at most TOP + 1 rows
        out[r["id"]] = np.frombuffer(r["value"], "<f4")
    return out


def cut_windows(tokens: np.ndarray) -> np.ndarray:
    """(n, WIDTH + 1) windows that predict every token but the first once; the last is filled up with ``MISSING``."""
    n = -(-max(len(tokens) - 1, 0) // attention.WIDTH)
    if not n:
        return np.zeros((0, attention.WIDTH + 1), np.uint16)
    padded = np.full(n * attention.WIDTH + 1, attention.MISSING, np.uint16)
    padded[: len(tokens)] = tokens
    return np.lib.stride_tricks.sliding_window_view(padded, attention.WIDTH + 1)[:: attention.WIDTH]


def training_windows(saved: DataFrame, turn: int, turns: int) -> DataFrame:
    """``id, value``: each block's share ``turn`` of ``turns`` of its training windows, in shuffled order.

    A row holds up to ``ROW_WINDOWS`` windows; ``id`` is a hash of block and row.
    """

    def deal(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                windows = cut_windows(_texts(row, only_trained=True)[0])
                windows = windows[np.random.default_rng(row["block"]).permutation(len(windows))[turn::turns]]
                starts = range(0, len(windows), ROW_WINDOWS)
                block = words.mix(np.array([row["block"] + 1], np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.mix(block + np.arange(len(starts), dtype=np.uint64)).view(np.int64)),
                     pa.array([windows[a: a + ROW_WINDOWS].tobytes() for a in starts], pa.binary())],
                    names=["id", "value"])

    return saved.select("block", "trained", "counts", "words", "id_counts", "ids").mapInArrow(
        deal, "id bigint, value binary")


def _clusters(x: np.ndarray, weight: np.ndarray, k: int, rng) -> np.ndarray:
    """k-means with weights; fewer rows than clusters: each its own."""
    if len(x) <= k:
        return np.arange(len(x))
    centres = x[rng.choice(len(x), k, replace=False, p=weight / weight.sum())]
    for _ in range(25):
        nearest = ((x ** 2).sum(1)[:, None] - 2 * x @ centres.T + (centres ** 2).sum(1)[None]).argmin(axis=1)
        for c in range(k):
            own = nearest == c
            if own.any():
                centres[c] = np.average(x[own], axis=0, weights=weight[own])
    return nearest


def classes_and_vectors(counts: np.ndarray, top: np.ndarray, pairs: np.ndarray, starts_word: np.ndarray
                        ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each id, log p(id | class), input vector of each id)."""
    rng = np.random.default_rng(3)
    near = np.concatenate([pairs[:NEIGHBOURS, :TOP].T, pairs[:TOP, :NEIGHBOURS]], axis=1)
    rows = near[: len(top)] + 0.1
    dims = INPUTS - 2
    low = np.zeros((0, dims))
    if len(top):
        share = rows / rows.sum(axis=1, keepdims=True)
        info = np.maximum(np.log(share / (rows.sum(axis=0) / rows.sum())), 0)
        basis = np.linalg.svd(info - info.mean(axis=0), full_matrices=False)[2]
        low = (info - info.mean(axis=0)) @ basis[:dims].T
        low = low / (low.std(axis=0) + 1e-9)
    # Classes: the commonest ids and the end alone, then clusters, then two for all rarer ids.
    out = np.where(starts_word, 0, 1).astype(np.int64)
    at = 2
    alone = np.zeros(IDS, bool)
    for i in [END, *[t for t in top.tolist() if t != END][:SINGLES]]:
        out[i], alone[i] = at, True
        at += 1
    weight = np.sqrt(counts[top].astype(float))
    for kind in (True, False):
        own = np.flatnonzero((starts_word[top] == kind) & ~alone[top])
        if len(own):
            number = _clusters(low[own], weight[own], CLUSTERS, rng)
            out[top[own]] = at + np.unique(number, return_inverse=True)[1]
            at = int(out.max()) + 1
    smooth = counts + 0.1
    log_inside = np.log(smooth) - np.log(np.bincount(out, weights=smooth, minlength=at))[out]
    vectors = np.zeros((IDS, INPUTS), np.float32)
    vectors[top, :dims] = low
    vectors[:, dims] = starts_word
    vectors[END, dims + 1] = 1
    return out, log_inside.astype(np.float32), vectors


def after(pairs: np.ndarray, top: np.ndarray, classes_of: np.ndarray, log_inside: np.ndarray) -> np.ndarray:
    """log p(id | class, id before) of the common ids: pair counts backed off to p(id | class)."""
    own = classes_of[top]
    in_class = np.zeros((TOP + 1, int(classes_of.max()) + 1))
    np.add.at(in_class.T, own, pairs[:, : len(top)].T)
    out = np.zeros((TOP + 1, TOP + 1), np.float32)
    out[:, : len(top)] = np.log((pairs[:, : len(top)] + BACKOFF * np.exp(log_inside[top])[None])
                                / (in_class[:, own] + BACKOFF))
    return out


def fit(saved: DataFrame, tokenizer: str) -> Model:
    """The model of the training documents in ``saved`` blocks."""
    import json

    spark = saved.sparkSession
    counts = id_counts(saved)
    top, rank = ranks(counts)
    pairs = pair_counts(saved, rank)
    with open(tokenizer, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    starts_word = np.zeros(IDS, bool)
    starts_word[[i for piece, i in vocabulary.items() if piece.startswith("Ġ") and i < IDS]] = True
    classes_of, log_inside, vectors = classes_and_vectors(counts, top, pairs, starts_word)
    log_after = after(pairs, top, classes_of, log_inside)
    classes = int(classes_of.max()) + 1
    flat = attention.initial(INPUTS, np.bincount(classes_of, weights=counts, minlength=classes))
    n = -(-int(counts.sum() + counts[END]) // attention.WIDTH)  # windows (a few more: one tail a block)
    turns = ROUNDS if n >= ROUNDS * TASK_WINDOWS else 1  # a small corpus is seen whole in each round,
    passes = -(-TASK_WINDOWS // max(n, 1))               # and again until it gave as many steps as a task has
    tasks = max(1, n // turns // TASK_WINDOWS)
    for turn in range(ROUNDS if n else 0):
        sent = spark.sparkContext.broadcast((flat, vectors, classes_of))

        def local(batches):
            import pyarrow as pa
            from pyspark import TaskContext

            start, vec, cls = sent.value
            rows = sorted((k, v) for b in batches for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            if not rows:
                return
            tokens = np.frombuffer(b"".join(v for _, v in rows), "<u2").reshape(-1, attention.WIDTH + 1)
            part = TaskContext.get().partitionId()
            got = attention.train(start, tokens, vec, cls, classes, steps=passes * -(-len(tokens) // attention.BATCH),
                                  seed=1000 * turn + part)
            weighted = np.append(got * len(tokens), len(tokens)).astype("<f4")
            yield pa.RecordBatch.from_arrays([pa.array([part % 16], pa.int64()),
                                              pa.array([weighted.tobytes()], pa.binary())], names=["id", "value"])

        dealt = training_windows(saved, turn % turns, turns).repartition(tasks, "id")
        sums = np.zeros(len(flat) + 1)
        for r in _summed(dealt.mapInArrow(local, "id bigint, value binary"), 16).collect():  # at most 16 rows
            sums += np.frombuffer(r["value"], "<f4")
        flat = (sums[:-1] / sums[-1]).astype(np.float32)
    return Model(flat, classes_of, log_inside, vectors, rank, log_after)


def _score_block(model: Model, row: dict, totals: np.ndarray, n_train: int, distinct: int, ends: int,
                 table: np.ndarray | None = None):
    tokens, lengths, counts, per_word = _texts(row)
    log_p = attention.score(model.parameters, tokens, lengths, model.vectors, model.classes_of, model.classes,
                            table=table)
    r = model.rank[tokens]
    before = np.concatenate([[model.rank[END]], r[:-1]]) if len(r) else r
    before *= TOP + 1
    before += r
    log_p += np.where(r < TOP, model.log_after.ravel().take(before), model.log_inside[tokens])
    begins = np.cumsum(lengths) - lengths
    log_p[begins] = 0
    index = np.frombuffer(row["words"], "<u4").astype(np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    whole = n_train + 0.5 * (distinct + 1)

    def base(c):
        return np.log((c + 0.5) / whole)

    share_of = base(totals.astype(np.float64))  # of the block's distinct words

    # Sums of ids' log probabilities per word: all ids but marks, in order.
    running = np.zeros(len(log_p) + 1)
    np.cumsum(log_p, out=running[1:])
    word_end = np.cumsum(per_word) + 2 * owner + 1
    local = running[word_end] - running[word_end - per_word]
    c = totals[index]
    shares = share_of[index]
    mixed = np.where(c > 0, np.logaddexp(np.log(LOCAL) + local, np.log(1 - LOCAL) + shares),
                     np.log(LOCAL) + local)
    last = log_p[begins + lengths - 1].astype(np.float64)
    end_share = float(base(float(ends)))
    end_mixed = np.logaddexp(np.log(LOCAL) + last, np.log(1 - LOCAL) + end_share)
    texts = len(counts)
    ten = np.log(10)
    base_score = (np.bincount(owner, weights=shares, minlength=texts) + end_share) / ten
    score = (np.bincount(owner, weights=mixed, minlength=texts) + end_mixed) / ten
    known = np.bincount(owner, weights=c > 0, minlength=texts).astype(np.int64) + int(ends > 0)
    return counts + 1, known, base_score, score


def score_documents(docs: DataFrame, *, tokenizer: str | None = None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: one row per document.

    Scores are log10 probabilities of the whole text, its end included.
    Training documents are those whose crc32(id as text) modulo 5 is not 1.
    NULL text: empty, the end alone.  NULL ids are kept (as empty id text).
    Repeated rows count and score each time; ties do not matter.  No training
    tokens: base scores come from the smoothing alone.  A block of rows holds
    up to ``BLOCK_BYTES`` of text; of a longer text a task holds all ids.
    Empty table: no rows.  Extra columns are not read.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or tokenizer_path(VOCABULARY)
    scratch = Scratch(spark, "lm")
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"),
        (crc_mod("doc_id", 5) != 1).alias("trained"))
    saved = scratch.save(blocks(rows, tokenizer), "blocks")
    totals, n_words, v_words = word_totals(saved, scratch)

    def trained(batches):
        import pyarrow as pa

        n = sum(int(np.frombuffer(x, bool).sum()) for b in batches for x in b.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    ends = saved.select("trained").mapInArrow(trained, "n bigint").agg(F.sum("n")).head()[0] or 0
    n_train, distinct = n_words + ends, v_words + (ends > 0)
    model = spark.sparkContext.broadcast(fit(saved, tokenizer))

    def score(batches):
        import pyarrow as pa

        m = model.value
        table = attention.entries(m.parameters, m.vectors, m.classes)  # once for all blocks of the task
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                total = np.frombuffer(row["totals"], "<i8") if row["totals"] is not None else np.zeros(0, np.int64)
                n, known, base_score, value = _score_block(m, row, total, n_train, distinct, ends, table)
                texts = len(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(row["doc_ids"], "<i8"), pa.int64(),
                              mask=np.frombuffer(row["no_id"], bool)),
                     pa.array(~np.frombuffer(row["trained"], bool)), pa.array(n, pa.int64()),
                     pa.array(known, pa.int64()), pa.array(np.full(texts, n_train), pa.int64()),
                     pa.array(base_score), pa.array(value)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    joined = saved.select("block", "doc_ids", "no_id", "trained", "counts", "words", "id_counts", "ids").join(
        totals, "block", "left").drop("block")
    return joined.mapInArrow(score, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
                                    "train_tokens bigint, base_score double, score double")
