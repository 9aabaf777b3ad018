"""Best-fit packing by sum of squares: documents into sequences of at most ``capacity`` tokens.

A piece goes to the open sequence (or a new one) for which the sum over all
residual gaps of the squared number of open sequences with that gap becomes
smallest.  Only documents longer than a sequence are cut; full pieces are
sequences of their own.

Pieces are packed in groups (by a hash of document and piece), largest first
in a group; the sequences a group leaves badly filled are dissolved and their
pieces packed again with those of other groups, until they fit one group or
``levels`` is reached.  A group holds about ``group_pieces`` pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, pick, release_memory
from ledgerline.llm.tokens import broadcast_file, encode_batch, encoder, tokenizer_path

CAPACITY = 4096
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
MEMORY = 700_000  # words a worker remembers

_PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, *, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: every document's token pieces.

    NULL text: empty, its end id alone.  Only documents of more than
    ``capacity`` ids are cut.  Repeated rows and NULL ids are kept.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    file = broadcast_file(docs.sparkSession, tokenizer)

    def cut(batches):
        import pyarrow as pa

        enc = encoder(file.value, "word", memory=MEMORY)
        end = np.array([end_id], "<u4").tobytes()
        width = 4 * capacity
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out: list[tuple] = []
            for row, tokens in encode_batch(enc, batch.column(1)):
                tokens += end
                for at in range(0, len(tokens), width):
                    part = tokens[at: at + width]
                    out.append((ids[row], at // width, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*out)) if out else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])
        release_memory()

    return rows.mapInArrow(cut, _PIECE)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item, placed in the given order.

    ``open_[g]`` counts the open bins with residual gap g.  Moving a bin from
    gap g to g - s changes the sum of squares by 2 (open_[g - s] - open_[g]) + 2
    (full bins are closed and count nothing); a new bin by 2 open_[C - s] + 1.
    Ties: the smallest gap.
    """
    counts = np.zeros(capacity + 1, np.int64)
    bins_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(lengths), np.int64)
    n_bins = 0
    for i, s in enumerate(lengths.tolist()):
        had = counts[s:capacity]
        delta = 2 * (counts[: capacity - s] - had) + 2
        best, gap = None, capacity
        if len(delta):
            if counts[s]:
                delta[0] = 1 - 2 * counts[s]  # the bin becomes full and is closed
            delta = np.where(had > 0, delta, np.iinfo(np.int64).max)
            at = int(delta.argmin())
            if had[at] > 0:
                best, gap = int(delta[at]), at + s
        fresh = 1 + 2 * int(counts[capacity - s]) if s < capacity else 0
        if best is None or fresh < best:
            b, gap = n_bins, capacity
            n_bins += 1
        else:
            b = bins_at[gap].pop()
            counts[gap] -= 1
        out[i] = b
        left = gap - s
        if left:
            counts[left] += 1
            bins_at[left].append(b)
    return out


def _packer(capacity: int, level: int, least_fill: int):
    """Packs one group; sequences filled below ``least_fill`` get a NULL id."""

    def run(key, table):
        import pyarrow as pa

        group = key[0].as_py()
        lengths = table.column("length").to_numpy()
        # A fixed order of the rows, whatever order the shuffle delivers.
        order = np.lexsort([table.column("row").to_numpy(), lengths])[::-1]
        bins = np.empty(len(lengths), np.int64)
        bins[order] = sum_of_squares(lengths[order], capacity)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        by_bin = order[np.argsort(bins[order], kind="stable")]
        before = np.cumsum(lengths[by_bin]) - lengths[by_bin]
        offset = np.empty(len(lengths), np.int64)
        first = np.cumsum(fill) - fill
        offset[by_bin] = before - first[bins[by_bin]]
        ids = (np.int64(level) << 56) + (np.int64(group) << 28) + bins
        bad = fill[bins] < least_fill
        return table.drop_columns(["group"]).append_column(
            "sequence_id", pa.array(ids, pa.int64(), mask=bad)).append_column("offset", pa.array(offset, pa.int64()))

    return run


def pack(parts: DataFrame, scratch: Scratch, *, capacity: int = CAPACITY, group_pieces: int = 4096,
         fill: float = 0.99, levels: int = 3) -> DataFrame:
    """``parts`` (with ``length`` from 1 to ``capacity``) plus ``sequence_id`` and ``offset``.

    ``row`` numbers the saved rows, so groups and results stay the same when
    a task runs again.  Rows that are equal may swap places.  No rows: none.
    """
    columns = parts.columns
    saved = scratch.save(parts.withColumn("row", F.monotonically_increasing_id()), "pieces")
    whole = F.col("length") == capacity
    done = [saved.filter(whole).withColumn("sequence_id", -(F.col("row") + 1)).withColumn("offset", F.lit(0).cast("long"))]
    rest = saved.filter(~whole)
    for level in range(1, levels + 1):
        n_groups = -(-rest.count() // group_pieces)
        last = level == levels or n_groups <= 1
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
        grouped = rest.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(max(1, n_groups))).cast("long"))
        packed = scratch.save(grouped.groupBy("group").applyInArrow(
            _packer(capacity, level, 0 if last else int(fill * capacity)),
            schema + ", sequence_id bigint, offset bigint"), f"packed-{level}")
        done.append(packed.filter(F.col("sequence_id").isNotNull()))
        if last:
            break
        rest = packed.filter(F.col("sequence_id").isNull()).drop("sequence_id", "offset")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, *, tokenizer: str | None = None, capacity: int = CAPACITY,
                   end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole documents as pieces in sequences: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    NULL text: empty, its end id alone; NULL ids, repeated rows and ties are
    kept and packed each by itself.  A very long text is encoded in parts cut
    between words.  Empty table: no rows.  Extra columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    found = pieces(docs, tokenizer=tokenizer or tokenizer_path(VOCABULARY), capacity=capacity, end_id=end_id,
                   id_col=id_col, text_col=text_col)
    return pack(found, scratch, capacity=capacity)
