"""Importance resampling of documents towards a target set, exact to the last rank.

1. Both texts' hashed word runs (1 to ``ORDERS`` words) are counted in
   ``BUCKETS`` buckets; each bucket gets a gain, the floored log ratio of its
   shares.  All gains are one array, so a text's weight is an array lookup
   and a sum.
2. A document's score is its weight plus Gumbel noise drawn from its id: the
   highest scores are a sample without replacement in proportion to weights.
3. Ranks come from parallel sorting by regular sampling.  Rows are dealt to
   runs of about ``run_rows`` rows, each sorted in a task; every run gives
   as many regular samples as there are runs; the sorted samples give the
   splitters; each run is cut at the splitters, a task merges what it gets
   of all runs, and prefix counts over the segments turn places into ranks.

The driver receives the bucket counts, the splitters (runs - 1) and the
segments' row counts.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, pick, string_bytes, text_or_empty
from ledgerline.llm.words import LOWER

BUCKETS = 10_000
ORDERS = 3
SLICE_BYTES = 1 << 20
SHORT = 32  # bytes of words whose checksums are computed together

_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[:0x80] = False
_WORD_BYTE[0x30:0x3A] = True
_WORD_BYTE[0x61:0x7B] = True


# --- checksums of joined words ----------------------------------------------

def _byte_table() -> np.ndarray:
    """crc32 step of every byte (reflected polynomial 0xEDB88320)."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_STEP = _byte_table()


def _push(crc: np.ndarray, byte) -> np.ndarray:
    return _STEP[(crc ^ byte) & np.uint32(255)] ^ (crc >> np.uint32(8))


def _shift_tables(longest: int) -> np.ndarray:
    """[n, b, v]: the state after n zero bytes, if before only byte b of the state was set, to v."""
    out = np.zeros((longest + 1, 4, 256), np.uint32)
    for b in range(4):
        out[0, b] = np.arange(256, dtype=np.uint32) << np.uint32(8 * b)
    for n in range(1, longest + 1):
        out[n] = _push(out[n - 1], np.uint32(0))
    return out


_SHIFT = _shift_tables(SHORT)


def _shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """States after ``n`` more zero bytes each (the checksum is linear)."""
    out = np.empty_like(crc)
    short = n <= SHORT
    whole = bool(short.all())
    c, k = (crc, n) if whole else (crc[short], n[short])
    moved = _SHIFT[k, 0, c & np.uint32(255)]
    for b in range(1, 4):
        moved ^= _SHIFT[k, b, (c >> np.uint32(8 * b)) & np.uint32(255)]
    if whole:
        return moved
    out[short] = moved
    for i in np.flatnonzero(~short).tolist():
        out[i] = _zeros(int(crc[i]), int(n[i]))
    return out


def _zeros(state: int, n: int) -> int:
    """One state after ``n`` zero bytes, by zlib (its start and end inversions undone)."""
    block = bytes(min(n, 1 << 16))
    crc = state ^ 0xFFFFFFFF
    while n:
        part = block[: min(n, len(block))]
        crc = zlib.crc32(part, crc)
        n -= len(part)
    return crc ^ 0xFFFFFFFF


_START_CACHE = _shifted(np.full(SHORT + 1, 0xFFFFFFFF, np.uint32), np.arange(SHORT + 1))


def _begun(n: np.ndarray) -> np.ndarray:
    """What crc32's start value becomes after ``n`` bytes."""
    if (n <= SHORT).all():
        return _START_CACHE[n]
    return _shifted(np.full(len(n), 0xFFFFFFFF, np.uint32), n)


def word_states(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Checksum states of the words' bytes, from a zero state."""
    size = ends - starts
    out = np.zeros(len(starts), np.uint32)
    going = np.flatnonzero(size <= SHORT)
    going = going[np.argsort(size[going], kind="stable")[::-1]]  # the longest first: those still going are a prefix
    length = size[going]
    state = np.zeros(len(going), np.uint32)
    base = starts[going]
    for j in range(int(length[0]) if len(going) else 0):
        n = int(np.searchsorted(-length, -j, side="left"))  # words longer than j
        state[:n] = _push(state[:n], flat[base[:n] + j])
    out[going] = state
    for i in np.flatnonzero(size > SHORT).tolist():
        raw = flat[starts[i]: ends[i]].tobytes()
        out[i] = zlib.crc32(raw, 0xFFFFFFFF) ^ 0xFFFFFFFF  # crc32 starts from the complement
    return out


def hashed_runs(flat: np.ndarray, cuts: np.ndarray, before: tuple | None = None):
    """(text number, bucket) of every run of 1 to ``ORDERS`` words, the words per text, and the last words.

    ``flat`` holds lower-cased bytes, ``cuts`` the texts' places in it.
    ``before`` (states, sizes) are the last words of the same text, if the
    first text is the rest of one; runs that lie in them alone are not given
    again.
    """
    n = len(flat)
    texts = len(cuts) - 1
    letter = _WORD_BYTE[flat]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    last = letter.copy()
    last[:-1] &= ~letter[1:]
    inner = cuts[(cuts > 0) & (cuts < n)]
    first[inner] = letter[inner]
    last[inner - 1] = letter[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    owner = np.searchsorted(cuts[1:-1], starts, side="right")
    state, size = word_states(flat, starts, ends), ends - starts
    counts = np.bincount(owner, minlength=texts)
    held = 0
    if before is not None:
        held = len(before[0])
        state, size = np.concatenate([before[0], state]), np.concatenate([before[1], size])
        owner = np.concatenate([np.zeros(held, owner.dtype), owner])
    numbers, buckets = [], []
    joined, width, whose = state, size, owner
    for order in range(1, ORDERS + 1):
        if order > 1:
            # Runs of `order` words: those of one word less, a space, and the word that follows.
            same = owner[order - 1:] == whose[: max(len(state) - order + 1, 0)]
            at = np.flatnonzero(same)
            spaced = _push(joined[at], np.uint32(32))
            follow = at + order - 1
            run = np.zeros(len(state) - order + 1 if len(state) >= order else 0, np.uint32)
            long = np.zeros(len(run), np.int64)
            run[at] = _shifted(spaced, size[follow]) ^ state[follow]
            long[at] = width[at] + 1 + size[follow]
            joined, width, whose = run, long, np.where(same, owner[order - 1:], -1)
        keep = whose >= 0
        if held:
            keep[: max(held - order + 1, 0)] = False  # given with the words before
        crc = joined[keep] ^ _begun(width[keep]) ^ np.uint32(0xFFFFFFFF)
        numbers.append(whose[keep])
        buckets.append((crc % np.uint32(BUCKETS)).astype(np.int64))
    tail = owner == texts - 1 if len(owner) else np.zeros(0, bool)
    rest = (state[tail][-(ORDERS - 1):], size[tail][-(ORDERS - 1):])
    return np.concatenate(numbers), np.concatenate(buckets), counts, rest


def text_slices(flat: np.ndarray, offsets: np.ndarray):
    """(first text, bytes, cuts, whether it goes on in the next) of about ``SLICE_BYTES`` each.

    A long text is cut between words; only a single word may be longer.
    """
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, side="right")) - 1
        if stop > start:
            yield start, flat[offsets[start]: offsets[stop]], offsets[start: stop + 1] - offsets[start], False
            start = stop
            continue
        at, end = int(offsets[start]), int(offsets[start + 1])
        while at < end:
            cut = min(at + SLICE_BYTES, end)
            while cut < end:
                gap = np.flatnonzero(~_WORD_BYTE[LOWER[flat[cut: cut + SLICE_BYTES]]])
                if len(gap):
                    cut += int(gap[0])
                    break
                cut = min(cut + SLICE_BYTES, end)
            yield start, flat[at: cut], np.array([0, cut - at]), cut < end
            at = cut
        start += 1


def batch_runs(column):
    """(text number, bucket, words per text with its number) of an Arrow text column without NULLs, slice by slice."""
    flat, offsets = string_bytes(column)
    carried = None
    for start, part, cuts, goes_on in text_slices(flat, offsets):
        number, bucket, counts, rest = hashed_runs(LOWER[part], cuts, carried)
        carried = rest if goes_on else None
        yield start, number, bucket, counts


# --- weights ------------------------------------------------------------------

def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many runs of all ``text`` rows fall into each bucket."""

    def count(batches):
        import pyarrow as pa

        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, bucket, _ in batch_runs(batch.column(0)):
                total += np.bincount(bucket, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bucket", "n"])

    found = (texts.mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket")
             .agg(F.sum("n").alias("n")).collect())  # at most BUCKETS rows
    out = np.zeros(BUCKETS, np.int64)
    for r in found:
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of every bucket."""
    s_all, t_all = float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + BUCKETS) / ((s + 1.0) * (t_all + BUCKETS))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def gumbel(h: np.ndarray) -> np.ndarray:
    """floor(-1000 ln(-ln((h + 0.5) / 2**32))) of 32-bit numbers."""
    return np.array([math.floor(-1000 * math.log(-math.log((x + 0.5) / 4294967296))) for x in h.tolist()], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, *, seed: int) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, n_words, n_features, weight, score``."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)  # BUCKETS numbers

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            n_words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
            for start, number, bucket, counts in batch_runs(batch.column(2)):
                stop = start + len(counts)
                n_words[start: stop] += counts
                features[start: stop] += np.bincount(number, minlength=len(counts))
                # Sums of floored numbers, exact below 2**53.
                by_text = np.bincount(number, weights=sent.value[bucket], minlength=len(counts))
                weight[start: stop] += by_text.astype(np.int64)
            score = weight + gumbel(batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(features), pa.array(weight), pa.array(score)],
                names=["doc_id", "n_words", "n_features", "weight", "score"])

    own = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    noise = F.conv(F.substring(F.sha2(own.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return docs.select("doc_id", noise.alias("h"), "text").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


# --- ranks --------------------------------------------------------------------

KEY = 25  # bytes: highest score first, then ids ascending with NULL last, then the row


def sort_keys(score: np.ndarray, ids: np.ndarray, no_id: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Byte strings that sort as (score descending, id ascending, NULL ids last, row)."""
    flip = np.uint64(1 << 63)
    out = np.zeros((len(score), KEY), np.uint8)
    out[:, :8] = (~(score.view(np.uint64) ^ flip)).astype(">u8").view(np.uint8).reshape(-1, 8)
    out[:, 8] = no_id
    out[:, 9:17] = (ids.view(np.uint64) ^ flip).astype(">u8").view(np.uint8).reshape(-1, 8)
    out[:, 17:] = row.astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.reshape(-1).view(f"S{KEY}")


def _bytes(keys: np.ndarray):
    import pyarrow as pa

    raw = np.frombuffer(np.ascontiguousarray(keys).tobytes(), np.uint8)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(KEY), len(keys), [None, pa.py_buffer(raw)]).cast(pa.binary())


def _keys(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), f"S{KEY}")


def merged(pieces: list[np.ndarray]) -> np.ndarray:
    """One ascending array of several: neighbours are merged pairwise, each key placed by its rank in the other."""
    while len(pieces) > 1:
        joined = []
        for a, b in zip(pieces[::2], pieces[1::2]):
            out = np.empty(len(a) + len(b), a.dtype)
            out[np.arange(len(a)) + np.searchsorted(b, a, side="left")] = a
            out[np.arange(len(b)) + np.searchsorted(a, b, side="right")] = b
            joined.append(out)
        pieces = joined + (pieces[-1:] if len(pieces) % 2 else [])
    return pieces[0]


def ranked(rows: DataFrame, scratch: Scratch, *, run_rows: int = 1 << 21) -> DataFrame:
    """``row, doc_id, score`` -> ``row, rank``: 1 for the highest score; ties to smaller ids, NULL ids last.

    ``row`` must differ from row to row; it decides between repeated rows.
    Runs and segments hold about ``run_rows`` rows (25 bytes each), a segment
    at most twice that; the samples are runs squared.
    """
    n = rows.count()
    runs = max(1, -(-n // run_rows))

    def sort_run(key, table):
        import pyarrow as pa

        ids = table.column("doc_id")
        keys = np.sort(sort_keys(table.column("score").to_numpy(), ids.fill_null(0).to_numpy(),
                                 ids.is_null().to_numpy(), table.column("row").to_numpy()))
        step = max(1, len(keys) // runs)
        sample = np.zeros(len(keys), bool)
        sample[step - 1:: step] = True
        return pa.table({"run": pa.array(np.full(len(keys), key[0].as_py(), np.int64)),
                         "place": pa.array(np.arange(len(keys))), "key": _bytes(keys), "sample": pa.array(sample)})

    dealt = rows.select("row", "doc_id", "score", F.pmod(F.xxhash64("row"), F.lit(runs)).alias("run"))
    sorted_runs = scratch.save(dealt.groupBy("run").applyInArrow(
        sort_run, "run bigint, place bigint, key binary, sample boolean"), "runs")

    def choose(key, table):
        import pyarrow as pa

        keys = np.sort(_keys(table.column("key")))
        at = np.arange(1, runs) * len(keys) // runs
        return pa.table({"key": _bytes(keys[at]) if len(keys) else pa.array([], pa.binary())})

    splitters: list[bytes] = []
    if runs > 1:
        samples = sorted_runs.filter("sample").select(F.lit(0).alias("all"), "key")
        splitters = sorted({r["key"] for r in samples.groupBy("all").applyInArrow(choose, "key binary").collect()})

    def cut(batches):
        import pyarrow as pa

        bounds = np.array(splitters, f"S{KEY}")
        for batch in batches:
            to = np.searchsorted(bounds, _keys(batch.column(2)), side="left")
            yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int64)), *batch.columns],
                                             names=["segment", "run", "place", "key"])

    exchanged = sorted_runs.select("run", "place", "key").mapInArrow(
        cut, "segment bigint, run bigint, place bigint, key binary")

    def merge(key, table):
        import pyarrow as pa

        run, place = table.column("run").to_numpy(), table.column("place").to_numpy()
        keys = _keys(table.column("key"))
        order = np.lexsort([place, run])  # each run's piece as it was sorted
        keys = keys[order]
        whole = merged(np.split(keys, np.flatnonzero(np.diff(run[order])) + 1))
        row = whole.view(np.uint8).reshape(-1, KEY)[:, 17:].copy().view(">u8").astype(np.int64).reshape(-1)
        return pa.table({"segment": pa.array(np.full(len(row), key[0].as_py(), np.int64)), "row": pa.array(row),
                         "inside": pa.array(np.arange(1, len(row) + 1))})

    found = scratch.save(exchanged.groupBy("segment").applyInArrow(merge, "segment bigint, row bigint, inside bigint"),
                         "segments")
    scratch.drop(sorted_runs)
    counts = {r["segment"]: r["n"] for r in found.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts = np.concatenate([[0], np.cumsum([counts.get(s, 0) for s in range(len(splitters) + 1)])]).tolist()
    before = F.array(*[F.lit(x).cast("long") for x in starts])
    return found.select("row", (F.element_at(before, (F.col("segment") + 1).cast("int")) + F.col("inside")).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 5, least_words: int = 20, seed: int = 42,
             run_rows: int = 1 << 21, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text") -> DataFrame:
    """``doc_id, n_features, weight, score, rank``: one row per document.

    Of the N documents of ``least_words`` words or more, the floor(``percent``
    N / 100) with the highest scores are drawn and ranked 1, 2, 3, ...; all
    others have a NULL rank.  Words are runs of a-z (A-Z lower-cased), 0-9 and
    anything outside ASCII.

    NULL and empty text: no words, weight 0.  NULL ids: noise of the empty
    id, after all other ids among ties.  Repeated rows are ranked each.  An
    empty target or table is fine: no rows give no rows.  Very long texts are
    taken in slices cut between words.  Extra columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "resample")
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    gain = gains(bucket_counts(rows.select("text")),
                 bucket_counts(pick(target, text=target_text).select(text_or_empty("text").alias("text"))))
    scored = scratch.save(weigh(rows, gain, seed=seed).withColumn("row", F.monotonically_increasing_id()), "scored")
    able = scored.filter(F.col("n_words") >= least_words).select("row", "doc_id", "score")
    wanted = percent * able.count() // 100
    drawn = ranked(able, scratch, run_rows=run_rows).filter(F.col("rank") <= wanted)
    return scored.join(drawn, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
