"""Helpers shared by the operators: input columns, shared scratch tables, ascending ranges."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_dir

# The white space that separates words: space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Python workers on this machine find the package even if it is not installed.

    On a cluster the package is installed or sent along (``--py-files``); the
    extra path does no harm there.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = list(filter(None, env.get("PYTHONPATH", "").split(os.pathsep)))
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under internal names (so that no extra column can clash)."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def crc_mod(id_col: str | Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor`` (a NULL id counts as empty text)."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % divisor


class Scratch:
    """Intermediate tables in the cluster's shared checkpoint folder.

    ``save`` runs the plan once, writes it as Parquet and reads it back: the
    lineage is cut, and a lost executor costs only the tasks that read it.
    ``drop`` deletes a table that no later plan reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_dir(spark, name)
        self._n = 0
        self._paths: dict[int, str] = {}

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = self._paths.pop(id(df), None)
        if path is not None:
            self.delete(path)

    def delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release_memory() -> None:
    """Gives back what this worker holds but no longer uses; for the end of a task's work."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cell_digits_for(rows: int, per_cell: int = 1 << 16) -> int:
    """Hex digits of a seeded hash (2 at least) that cut ``rows`` rows into cells of about ``per_cell`` or fewer."""
    digits = 2
    while rows > per_cell * 16 ** digits:
        digits += 1
    return digits


def range_bounds(ids: DataFrame, key: str, n_ranges: int) -> list[int]:
    """At most ``n_ranges - 1`` ascending cut points that split ``key`` into ranges of near equal count.

    One pass over the key column alone; the driver receives ``n_ranges`` numbers.
    """
    if n_ranges < 2:
        return []
    fractions = [i / n_ranges for i in range(1, n_ranges)]
    row = ids.agg(F.percentile_approx(F.col(key), fractions, max(10_000, 20 * n_ranges)).alias("b")).head()
    return sorted(set(row["b"] or []))


def range_number(key: str, bounds: list[int]) -> Column:
    """Number of the range a key lies in (0 for the lowest; a NULL key goes to range -1).

    Two short scans of about sqrt(ranges) cut points each, not one of all.
    """
    if not bounds:
        return F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.lit(0))
    step = max(1, int(len(bounds) ** 0.5))
    heads = F.array(*[F.lit(b).cast("long") for b in bounds[::step]])
    every = F.array(*[F.lit(b).cast("long") for b in bounds])
    passed = F.size(F.filter(heads, lambda b: b < F.col(key)))
    block = F.greatest(passed - 1, F.lit(0)) * step
    inside = F.size(F.filter(F.slice(every, block + 1, F.lit(step)), lambda b: b < F.col(key)))
    return F.when(F.col(key).isNull(), F.lit(-1)).otherwise((block + inside).cast("int"))


def string_offsets(array):
    """Offsets of an Arrow string array as int64 (slices included)."""
    import numpy as np
    import pyarrow as pa

    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    raw = np.frombuffer(array.buffers()[1], dtype=kind) if len(array) else np.zeros(1, kind)
    return raw[array.offset: array.offset + len(array) + 1].astype(np.int64)


def string_bytes(array):
    """(bytes as uint8, offsets from 0) of an Arrow string array without NULLs."""
    import numpy as np

    offsets = string_offsets(array)
    data = array.buffers()[2] if len(array) else None
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0]: offsets[-1]], offsets - offsets[0]

