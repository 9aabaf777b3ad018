"""Quote ingestion with Structured Streaming.

The reference polls a price feed every 10 s, types each batch on Spark,
collects it to the driver and appends it to SQLite.  Here the feed lands as
JSON documents ``{"data": [{...}, ...]}`` in a folder; a streaming query
reads new documents, explodes ``data``, parses numbers safely, stamps the
micro-batch time and appends to a Parquet table.  Nothing goes through the
driver, and the file sink's checkpoint + commit log give restarts without
duplicate rows.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.functions.expressions import parse_number
from ledgerline.sources.schemas import (
    QUOTE_NUMBER_FIELDS,
    QUOTE_TEXT_FIELDS,
    RAW_QUOTE,
    RAW_QUOTE_DOC,
)

POLL_SECONDS = 10
STORED = "stored"  # name of the count that every batch reports


def feed_rows(docs: DataFrame) -> DataFrame:
    """One row per element of each document's ``data`` array.

    A document without ``data`` (or with an empty array) yields no rows;
    keys outside the declared schema are dropped, missing keys become NULL.
    """
    return docs.select(F.inline(F.col("data")))


def ingest_time():
    """Time of the micro-batch as UTC wall clock (``timestamp_ntz``).

    ``current_timestamp`` is fixed per micro-batch, so every row of a batch
    gets the same stamp.  It is built from the instant, so neither the session
    time zone nor a clock change moves it.
    """
    return F.expr("timestampadd(MICROSECOND, unix_micros(current_timestamp()), TIMESTAMP_NTZ '1970-01-01 00:00:00')")


def typed_quotes(rows: DataFrame, stamp: bool = True) -> DataFrame:
    """Text quote rows -> typed rows; malformed numbers become NULL, rows are kept."""
    cols = [F.col(c).cast("string").alias(c) for c in QUOTE_TEXT_FIELDS]
    cols += [parse_number(c).alias(c) for c in QUOTE_NUMBER_FIELDS]
    if stamp:
        cols.append(ingest_time().alias("timestamp"))
    return rows.select(*cols)


def land_batch(rows: DataFrame, landing_dir: str, rows_per_document: int = 1) -> None:
    """Write quote rows as feed documents (JSON lines) into ``landing_dir``.

    Used for backfills and tests.  With the default every row becomes its own
    one-element document, which keeps every document bounded whatever the
    input size; larger ``rows_per_document`` groups consecutive rows of a task.
    """
    struct = F.struct(*[F.col(c).cast("string").alias(c) for c in RAW_QUOTE.fieldNames()])
    if rows_per_document <= 1:
        docs = rows.select(F.array(struct).alias("data"))
    else:
        # Consecutive rows of one task share a document: the id is unique and
        # grows within a task, so ``id div k`` never groups rows of two tasks.
        bucket = F.expr(f"monotonically_increasing_id() div {int(rows_per_document)}")
        docs = (rows.select(bucket.alias("_doc"), struct.alias("q"))
                .groupBy("_doc").agg(F.collect_list("q").alias("data")).select("data"))
    docs.write.mode("append").json(landing_dir)


def read_feed(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of landed feed documents."""
    reader = spark.readStream.schema(RAW_QUOTE_DOC)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.json(landing_dir)


def start_ingest(spark: SparkSession, landing_dir: str, table_path: str, checkpoint_dir: str,
                 poll_seconds: int = POLL_SECONDS, available_now: bool = False,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest stream: landed documents -> typed, stamped rows -> Parquet.

    ``available_now`` processes what has landed and stops (the reference's
    ``--test`` single batch); otherwise a micro-batch runs every
    ``poll_seconds`` until stopped.
    """
    typed = typed_quotes(feed_rows(read_feed(spark, landing_dir, max_files_per_trigger)))
    counted = typed.observe(STORED, F.count(F.lit(1)).alias("rows"))
    writer = (counted.writeStream.format("parquet")
              .outputMode("append")
              .option("path", table_path)
              .option("checkpointLocation", checkpoint_dir))
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{int(poll_seconds)} seconds")
    return writer.start()


def note_batches(query: StreamingQuery, seen: dict[int, int]) -> dict[int, int]:
    """Adds the rows that each of the query's recent batches stored, by batch number, to ``seen``.

    The rows are counted by the batch itself (``Dataset.observe``), so nothing
    is read back, and rows that others add to the table do not count.  A batch
    that the sink had already committed before a restart is not run again and
    counts 0.
    """
    for progress in query.recentProgress:
        observed = progress.observedMetrics.get(STORED)
        rows = observed["rows"] if observed is not None else 0
        seen[progress.batchId] = max(seen.get(progress.batchId, 0), rows)
    return seen


def ingest_once(spark: SparkSession, landing_dir: str, table_path: str, checkpoint_dir: str,
                timeout_seconds: float | None = None,
                max_files_per_trigger: int | None = None) -> int:
    """Process everything landed so far, then stop; return the rows stored by this run.

    The caller treats 0 as failure (the reference exits with status 1 when a
    test batch stores nothing).  Running it again on the same checkpoint
    stores nothing twice.  ``max_files_per_trigger`` splits a large backlog
    into several bounded micro-batches.
    """
    query = start_ingest(spark, landing_dir, table_path, checkpoint_dir, available_now=True,
                         max_files_per_trigger=max_files_per_trigger)
    until = None if timeout_seconds is None else time.monotonic() + timeout_seconds
    seen: dict[int, int] = {}
    try:
        # Far more often than the hundred batches that a query remembers can pass.
        while not query.awaitTermination(0.5):
            note_batches(query, seen)
            if until is not None and time.monotonic() > until:
                raise TimeoutError("ingest did not finish in time")
        return sum(note_batches(query, seen).values())
    finally:
        if query.isActive:
            query.stop()


@dataclass(frozen=True)
class Polled:
    """What a polling run did: rows per batch, and the trigger times as epoch seconds."""

    batches: dict[int, int]
    started: tuple[float, ...]

    @property
    def rows(self) -> int:
        return sum(self.batches.values())

    @property
    def empty(self) -> int:
        """Batches that stored nothing."""
        return sum(1 for rows in self.batches.values() if rows == 0)

    def paced(self, poll_seconds: float) -> bool:
        """Whether at most one batch began in each poll interval (intervals begin at multiples of the poll time)."""
        turns = [int((t + 0.02) // poll_seconds) for t in self.started]
        return all(a < b for a, b in zip(turns, turns[1:]))


def poll_for(spark: SparkSession, landing_dir: str, table_path: str, checkpoint_dir: str, seconds: float,
             poll_seconds: int = POLL_SECONDS, max_files_per_trigger: int | None = None) -> Polled:
    """Poll every ``poll_seconds`` for about ``seconds``, take in all that had landed by then, and stop cleanly.

    A poll that finds nothing new starts no batch.  A failed batch raises.
    """
    query = start_ingest(spark, landing_dir, table_path, checkpoint_dir, poll_seconds=poll_seconds,
                         max_files_per_trigger=max_files_per_trigger)
    seen: dict[int, int] = {}
    started: dict[int, float] = {}

    def note():
        note_batches(query, seen)
        for p in query.recentProgress:
            if p.numInputRows:
                started.setdefault(p.batchId, _epoch(p.timestamp))

    try:
        until = time.monotonic() + seconds
        while time.monotonic() < until and not query.awaitTermination(min(0.5, poll_seconds)):
            note()
        query.processAllAvailable()
    finally:
        query.stop()
    note()
    ran = {b: n for b, n in seen.items() if b in started}
    return Polled(ran, tuple(started[b] for b in sorted(started)))


def _epoch(text: str) -> float:
    return datetime.fromisoformat(text.replace("Z", "+00:00")).timestamp()
