"""Sinks: CSV and Parquet tables, sets of tables written all or nothing, persistence (K2-K5)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources.files import is_finished
from ledgerline.sources.schemas import QUOTES

TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV folder with a header line (one file per task, written in parallel)."""
    (df.write.mode(mode)
     .option("header", True)
     .option("dateFormat", "yyyy-MM-dd")
     .option("timestampNTZFormat", TIMESTAMP_TEXT)
     .csv(path))
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Iterable[str] = ()) -> str:
    writer = df.write.mode(mode)
    cols = list(partition_by)
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(path)
    return path


MANIFEST = "_current.json"


def write_set(spark: SparkSession, root: str, frames: Mapping[str, DataFrame], force: bool = False,
              fmt: str = "csv") -> dict[str, str]:
    """Write a set of tables, all or nothing, unless the current set has them all.

    Returns the tables' folders.  Mirrors the reference: when ``force`` is
    false and every table exists, nothing is written; otherwise every table is
    rewritten (a per-table ``mode("ignore")`` would keep a stale table next to
    fresh ones).

    Tables go to a folder of their own under ``root/_sets``; one manifest,
    replaced by an atomic rename when the last table is finished, names the
    set that readers see (``current_set``).  A run that dies half way changes
    nothing for them, and the next call writes again.  The set before the
    current one stays for readers that are still on it; older ones go.
    """
    old = _manifest(spark, root)
    if not force and old is not None and set(frames) <= set(old["tables"]) and all(
            is_finished(spark, p) for p in _paths(root, old).values()):
        return {name: path for name, path in _paths(root, old).items() if name in frames}
    new = {"set": uuid.uuid4().hex, "previous": old and old["set"], "tables": sorted(frames)}
    paths = _paths(root, new)
    for name, df in frames.items():
        (write_csv if fmt == "csv" else write_parquet)(df, paths[name], mode="errorifexists")
    replace_text(spark, f"{root.rstrip('/')}/{MANIFEST}", json.dumps(new))
    if old is not None and old["previous"]:
        target = _hadoop_path(spark, f"{root.rstrip('/')}/_sets/{old['previous']}")
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    return paths


def current_set(spark: SparkSession, root: str) -> dict[str, str]:
    """Folders of the tables of the set that was finished last; empty if there is none."""
    manifest = _manifest(spark, root)
    return {} if manifest is None else _paths(root, manifest)


def _paths(root: str, manifest: dict) -> dict[str, str]:
    return {name: f"{root.rstrip('/')}/_sets/{manifest['set']}/{name}" for name in manifest["tables"]}


def _manifest(spark: SparkSession, root: str) -> dict | None:
    text = read_text(spark, f"{root.rstrip('/')}/{MANIFEST}")
    return None if text is None else json.loads(text)


def _hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, on any file system Spark knows; None if there is none."""
    jvm = spark.sparkContext._jvm
    target = _hadoop_path(spark, path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Replaces a small file as a whole: written beside it, then renamed over it."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = _hadoop_path(spark, path)
    fs = target.getFileSystem(conf)
    target = fs.makeQualified(target)
    beside = _hadoop_path(spark, f"{target.toString()}.{uuid.uuid4().hex}")
    stream = fs.create(beside)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(beside, target, over)


def persist_tables(frames: Mapping[str, DataFrame], warm: Iterable[str] | None = None,
                   level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> dict[str, DataFrame]:
    """Persist hot tables (memory, spilling to disk) and warm the named ones.

    Opt-in and owned by the caller, who unpersists.  Warming runs one count
    per table.  Returns ``{name: persisted frame}``.
    """
    out = {name: df.persist(level) for name, df in frames.items()}
    for name in (warm if warm is not None else out.keys()):
        out[name].count()
    return out


def register_quotes_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Expose the quote history folder as a catalog table (``CREATE TABLE IF NOT EXISTS``).

    The table is external (Parquet at ``path``) with the fixed 8-column
    schema, so SQL users can query it by name; the ingest stream keeps
    appending to the same folder and readers see every committed batch.
    """
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=QUOTES)
    return spark.table(name)
