"""Token-id output: a wavelet matrix per shard, and flat files with a separator scan.

Documents are range-partitioned and sorted by id, so partition numbers and
the order inside them follow the ids; a task encodes its documents one after
another and cuts its stream into shards of about ``shard_tokens`` ids.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, pick, shuffle_parts
from ledgerline.llm.tokens import broadcast_file, encode_batch, encoder, tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
SHARD_TOKENS = 1 << 21


# --- the wavelet matrix -----------------------------------------------------

class WaveletMatrix:
    """Succinct sequence of ids: one bit plane per id bit, highest bit first.

    On each plane the sequence is stably parted into zeros and ones, and the
    next plane holds the next bit in that order.  ``planes`` are packed bits,
    ``zeros`` the zeros of each plane, ``ranks`` the ones before every
    ``BLOCK`` bits; all three are in the shard files.  A shard holds fewer
    than 2**32 ids.
    """

    BLOCK = 512

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray] | None = None):
        self.n, self.planes, self.zeros = n, planes, zeros
        self._ranks = ranks

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> "WaveletMatrix":
        planes, zeros = [], []
        now = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        for level in range(bits - 1, -1, -1):
            one = (now & now.dtype.type(1 << level)) != 0
            planes.append(np.packbits(one))
            low = np.flatnonzero(~one)  # places, not masks: several times faster to gather by
            zeros.append(len(low))
            now = np.concatenate([now[low], now[np.flatnonzero(one)]])
        return cls(len(ids), planes, zeros)

    @property
    def ranks(self) -> list[np.ndarray]:
        if self._ranks is None:
            step = self.BLOCK // 8
            self._ranks = []
            for plane in self.planes:
                per = np.bitwise_count(plane)
                sums = np.add.reduceat(per, np.arange(0, len(per), step), dtype=np.int64)
                self._ranks.append(np.concatenate([[0], np.cumsum(sums)]).astype("<u4"))
        return self._ranks

    def _bit(self, level: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[level][at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1

    def _rank1(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place of a plane."""
        at = np.asarray(at, np.int64)
        block = at // self.BLOCK
        out = self.ranks[level][block].astype(np.int64)
        plane = self.planes[level]
        first = block * (self.BLOCK // 8)
        whole = (at >> 3) - first
        for j in range(self.BLOCK // 8):  # bytes of the block before the place
            use = whole > j
            if not use.any():
                break
            out[use] += np.bitwise_count(plane[first[use] + j])
        rest = (at & 7).astype(np.uint8)
        part = np.flatnonzero(rest)
        out[part] += np.bitwise_count(plane[at[part] >> 3] >> (8 - rest[part]).astype(np.uint8))
        return out

    def access(self, at) -> np.ndarray:
        """The ids at the given places."""
        at = np.asarray(at, np.int64).copy()
        out = np.zeros(len(at), np.int64)
        for level in range(len(self.planes)):
            bit = self._bit(level, at)
            ones = self._rank1(level, at)
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
            out = (out << 1) | bit
        return out

    def _range(self, symbol: int, start: int, stop: int) -> tuple[int, int]:
        for level in range(len(self.planes)):
            ends = self._rank1(level, np.array([start, stop]))
            if symbol >> (len(self.planes) - 1 - level) & 1:
                start, stop = (self.zeros[level] + ends).tolist()
            else:
                start, stop = start - int(ends[0]), stop - int(ends[1])
        return start, stop

    def rank(self, symbol: int, stop: int) -> int:
        """How often ``symbol`` occurs before place ``stop``."""
        low, high = self._range(symbol, 0, stop)
        return high - low

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def _select(self, level: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Places of the k-th ones (or zeros) of a plane, from 0."""
        ones = self.ranks[level].astype(np.int64)
        before = ones if bit else np.arange(len(ones)) * self.BLOCK - ones
        block = np.searchsorted(before, k, side="right") - 1
        out = np.empty(len(k), np.int64)
        step = self.BLOCK // 8
        plane = np.concatenate([self.planes[level], np.zeros(-len(self.planes[level]) % step, np.uint8)])
        rows = plane.reshape(-1, step)
        for at in range(0, len(k), 4096):
            own = block[at: at + 4096]
            bits = np.unpackbits(rows[own], axis=1)
            seen = np.cumsum(bits == bit, axis=1)
            left = (k[at: at + 4096] - before[own])[:, None]
            out[at: at + 4096] = own * self.BLOCK + (seen == left + 1).argmax(axis=1)
        return out

    def select(self, symbol: int, k) -> np.ndarray:
        """Places of the k-th occurrences (from 0), by select from the last plane up."""
        low, high = self._range(symbol, 0, self.n)
        k = np.atleast_1d(np.asarray(k, np.int64))
        if len(k) and (k.min() < 0 or k.max() >= high - low):
            raise IndexError(f"{symbol} occurs {high - low} times")
        at = low + k
        for level in range(len(self.planes) - 1, -1, -1):
            bit = symbol >> (len(self.planes) - 1 - level) & 1
            at = self._select(level, bit, at - self.zeros[level] if bit else at)
        return at

    def occurrences(self, symbol: int) -> np.ndarray:
        """All places of ``symbol``, ascending."""
        return self.select(symbol, np.arange(self.count(symbol)))

    def tokens(self) -> np.ndarray:
        """The whole sequence: planes undone from the last to the first."""
        out = np.zeros(self.n, np.uint32 if len(self.planes) > 16 else np.uint16)
        for i, level in enumerate(range(len(self.planes) - 1, -1, -1)):
            one = np.unpackbits(self.planes[level], count=self.n).view(bool)
            z = self.zeros[level]
            out[z:] |= out.dtype.type(1 << i)
            back = np.empty_like(out)
            back[np.flatnonzero(~one)] = out[:z]
            back[np.flatnonzero(one)] = out[z:]
            out = back
        return out


_SHARD = ("part int, shard int, n_tokens bigint, bits int, doc_ids binary, no_id binary, starts binary, "
          "zeros binary, planes array<binary>, ranks array<binary>")


def _in_id_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows in ascending id order across partitions (NULL ids first; equal ids by text)."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    n = shuffle_parts(docs.sparkSession)
    return rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text")


def _streams(batches, enc, end: bytes, shard_tokens: int):
    """(ids of documents, lengths, token bytes) of each shard of a sorted partition."""
    ids: list = []
    parts: list[bytes] = []
    held = 0
    for batch in batches:
        keys = batch.column(0).to_pylist()
        for row, tokens in encode_batch(enc, batch.column(1)):
            ids.append(keys[row])
            parts.append(tokens + end)
            held += len(parts[-1]) // 4
            if held >= shard_tokens:
                yield ids, parts
                ids, parts, held = [], [], 0
    if ids:
        yield ids, parts


def _partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def write_wavelet(docs: DataFrame, path: str, *, tokenizer: str, end_id: int, shard_tokens: int = SHARD_TOKENS,
                  id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes one Parquet file per shard: planes, zero and rank counts, and the documents' places.

    Shards follow ascending ids: by ``part``, then ``shard``.  A shard ends
    with the document that reaches ``shard_tokens``.
    """
    spark = docs.sparkSession
    file = broadcast_file(spark, tokenizer)

    def build(batches):
        import pyarrow as pa

        enc = encoder(file.value, "byte")
        end = np.array([end_id], "<u4").tobytes()
        part = _partition()
        schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_tokens", pa.int64()),
                            ("bits", pa.int32()), ("doc_ids", pa.binary()), ("no_id", pa.binary()),
                            ("starts", pa.binary()), ("zeros", pa.binary()), ("planes", pa.list_(pa.binary())),
                            ("ranks", pa.list_(pa.binary()))])
        for shard, (ids, parts) in enumerate(_streams(batches, enc, end, shard_tokens)):
            tokens = np.frombuffer(b"".join(parts), "<u4")
            bits = max(1, int(tokens.max()).bit_length())
            wm = WaveletMatrix.build(tokens, bits)
            starts = np.cumsum([0] + [len(p) // 4 for p in parts])
            none = np.array([i is None for i in ids])
            keys = np.array([0 if i is None else i for i in ids], "<i8")
            yield pa.RecordBatch.from_pylist([{
                "part": part, "shard": shard, "n_tokens": wm.n, "bits": bits, "doc_ids": keys.tobytes(),
                "no_id": none.tobytes(), "starts": starts.astype("<i8").tobytes(), "zeros": np.array(wm.zeros, "<i8").tobytes(),
                "planes": [p.tobytes() for p in wm.planes], "ranks": [r.tobytes() for r in wm.ranks]}], schema=schema)

    (_in_id_order(docs, id_col, text_col).mapInArrow(build, _SHARD)
     .write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path))


def open_shard(row: dict) -> WaveletMatrix:
    return WaveletMatrix(row["n_tokens"], [np.frombuffer(p, np.uint8) for p in row["planes"]],
                         np.frombuffer(row["zeros"], "<i8").tolist(),
                         [np.frombuffer(r, "<u4") for r in row["ranks"]])


def read_documents(spark, path: str) -> DataFrame:
    """Per document, from the shard files: ``doc_id, start, n_tokens, ids_crc32, part, shard``."""
    shards = spark.read.schema(_SHARD).parquet(path)

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                tokens = open_shard(row).tokens().astype("<u4")
                starts = np.frombuffer(row["starts"], "<i8")
                keys = np.frombuffer(row["doc_ids"], "<i8")
                crc = [zlib.crc32(tokens[a:b]) for a, b in zip(starts[:-1], starts[1:])]
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64(), mask=np.frombuffer(row["no_id"], bool)),
                     pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["shard"], np.int32)),
                     pa.array(starts[:-1], pa.int64()), pa.array(np.diff(starts), pa.int64()),
                     pa.array(crc, pa.int64())],
                    names=["doc_id", "part", "shard", "local_start", "n_tokens", "ids_crc32"])

    found = shards.mapInArrow(read, "doc_id bigint, part int, shard int, local_start bigint, n_tokens bigint, "
                                    "ids_crc32 bigint")
    places = before(shards.select("part", "shard", "n_tokens"), "shard")
    return (found.join(places, ["part", "shard"])
            .select("doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32",
                    "part", "shard"))


def before(blocks: DataFrame, inner: str) -> DataFrame:
    """``part, <inner>, before``: tokens in all blocks before each block.

    Two prefix sums: inside each part, and over the parts' totals (one row a part).
    """
    totals = (blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
              .withColumn("part_start", F.sum("n").over(Window.orderBy("part")) - F.col("n")).drop("n"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy(inner)) - F.col("n_tokens")
    return (blocks.withColumn("inside", inside).join(totals, "part")
            .select("part", inner, (F.col("part_start") + F.col("inside")).alias("before")))


def wavelet_documents(docs: DataFrame, *, tokenizer: str | None = None, end_id: int = 2,
                      shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the shard files of ``docs`` and returns what they hold per document.

    NULL text: empty, its end id alone.  NULL ids come first, rows of one id
    by text.  Repeated rows are written again.  A string of a special token
    inside a text gives that token, as in a plain library call.  A very long
    text is encoded in parts cut between words and makes one shard.  Empty
    table: no shard, no rows.  Extra columns are not read.
    """
    spark = docs.sparkSession
    path = Scratch(spark, "wavelet").path("shards")
    write_wavelet(docs, path, tokenizer=tokenizer or tokenizer_path(VOCABULARY), end_id=end_id,
                  shard_tokens=shard_tokens, id_col=id_col, text_col=text_col)
    return read_documents(spark, path)


# --- flat files and the separator scan --------------------------------------

def id_type(largest: int) -> str:
    """numpy type of ids in flat files."""
    return "<u2" if largest < 1 << 16 else "<u4"


def shared_file(path: str):
    """(file system, path on it) of a shared folder's file, on any executor."""
    from pyarrow import fs

    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_flat(docs: DataFrame, path: str, *, tokenizer: str, end_id: int, file_tokens: int = SHARD_TOKENS,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes flat files of little-endian ids, nothing else; returns a lazy ``part, file, ordinal, doc_id``.

    Ids take 16 bits if ``end_id`` (the vocabulary's largest id) fits, else
    32.  Documents keep the order in which they are read, so nothing is
    shuffled.  Each document is followed by ``end_id``.  A file is written under a name
    of its attempt and then moved, so a task that runs again leaves the same
    files.
    """
    file = broadcast_file(docs.sparkSession, tokenizer)
    kind = id_type(end_id)

    def write(batches):
        import uuid

        import pyarrow as pa

        enc = encoder(file.value, "byte", ordinary=True)
        end = np.array([end_id], "<u4").tobytes()
        part = _partition()
        store, folder = shared_file(path)
        store.create_dir(folder, recursive=True)
        for number, (ids, parts) in enumerate(_streams(batches, enc, end, file_tokens)):
            name = f"{folder}/part-{part:06d}-{number:06d}.ids"
            attempt = f"{folder}/_{uuid.uuid4().hex}"
            with store.open_output_stream(attempt) as out:
                for part_ids in parts:
                    out.write(np.frombuffer(part_ids, "<u4").astype(kind).tobytes())
            store.move(attempt, name)
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, number, np.int32)),
                 pa.array(np.arange(n)), pa.array(ids, pa.int64())], names=["part", "file", "ordinal", "doc_id"])

    return pick(docs, doc_id=id_col, text=text_col).mapInArrow(
        write, "part int, file int, ordinal bigint, doc_id bigint")


def scan_separators(spark, path: str, *, end_id: int, block_tokens: int = 1 << 18) -> DataFrame:
    """``part, file, ordinal, start, n_tokens`` of every document in flat files, found by their separators alone.

    Every block of ``block_tokens`` ids is searched by itself (all places of
    ``end_id`` at once); a document may lie across any number of blocks.  The
    blocks' counts and last places, scanned in order, tell each separator its
    ordinal and the place where its document began.  Ids after the last
    separator of a file belong to no document.
    """
    name = F.element_at(F.split("path", "/"), -1)
    kind = id_type(end_id)
    width = np.dtype(kind).itemsize * block_tokens
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*.ids").load(path)
             .select("path", "length")
             .withColumn("part", F.regexp_extract(name, r"part-(\d+)-", 1).cast("int"))
             .withColumn("file", F.regexp_extract(name, r"-(\d+)\.ids", 1).cast("int")))
    blocks = (files.withColumn("block", F.explode(F.sequence(F.lit(0), F.expr(f"CAST((length - 1) div {width} AS INT)"))))
              .filter(F.col("length") > 0)
              .repartition(F.col("part"), F.col("file"), F.col("block")))

    def search(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                store, place = shared_file(row["path"])
                with store.open_input_file(place) as f:
                    f.seek(row["block"] * width)
                    ids = np.frombuffer(f.read(min(width, row["length"] - row["block"] * width)), kind)
                at = np.flatnonzero(ids == end_id) + row["block"] * block_tokens
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]], pa.int32()), pa.array([row["file"]], pa.int32()),
                     pa.array([row["block"]], pa.int32()), pa.array([len(at)], pa.int64()),
                     pa.array([int(at[-1]) if len(at) else None], pa.int64()),
                     pa.array([at.tolist()], pa.list_(pa.int64()))],
                    names=["part", "file", "block", "found", "last", "ends"])

    found = blocks.select("path", "length", "part", "file", "block").mapInArrow(
        search, "part int, file int, block int, found bigint, last bigint, ends array<bigint>")
    earlier = (Window.partitionBy("part", "file").orderBy("block")
               .rowsBetween(Window.unboundedPreceding, -1))
    found = (found.withColumn("ordinal_from", F.coalesce(F.sum("found").over(earlier), F.lit(0)))
             .withColumn("open_at", F.coalesce(F.max("last").over(earlier) + 1, F.lit(0))))
    ends = found.select("part", "file", "ordinal_from", "open_at", "ends", F.posexplode("ends").alias("i", "end_at"))
    start = F.when(F.col("i") == 0, F.col("open_at")).otherwise(F.expr("get(ends, i - 1)") + 1)
    return ends.select("part", "file", (F.col("ordinal_from") + F.col("i")).alias("ordinal"), start.alias("start"),
                       (F.col("end_at") + 1 - start).alias("n_tokens"))


def count_tokens(docs: DataFrame, *, tokenizer: str | None = None, end_id: int = 50256,
                 file_tokens: int = SHARD_TOKENS, block_tokens: int = 1 << 18, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Token counts by separator scan: ``doc_id, start, n_tokens, part, file, ordinal``.

    Writes the documents as flat files in the order they are read, scans
    these, and gives each found document the id that was written there.  ``n_tokens`` includes the end
    id; ``start`` counts all ids before it.  ``end_id`` must be one that no
    text can yield.  NULL text: empty.  Empty table: no files, no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "flat")
    path = scratch.path("ids")
    written = scratch.save(write_flat(docs, path, tokenizer=tokenizer or tokenizer_path(VOCABULARY), end_id=end_id,
                                      file_tokens=file_tokens, id_col=id_col, text_col=text_col), "documents")
    if written.isEmpty():
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, part int, file int, "
                                         "ordinal bigint")
    found = scratch.save(scan_separators(spark, path, end_id=end_id, block_tokens=block_tokens), "scan")
    places = before(found.groupBy("part", "file").agg(F.sum("n_tokens").alias("n_tokens")), "file")
    return (found.join(written, ["part", "file", "ordinal"]).join(places, ["part", "file"])
            .select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "part", "file",
                    "ordinal"))
