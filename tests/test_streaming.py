"""Structured Streaming ingest: landed feed documents -> Parquet history."""

import json
import os
from datetime import datetime, timezone

from pyspark.sql import functions as F

from ledgerline.sources import adapters as A
from ledgerline.sources.files import load_quotes
from ledgerline.streaming.ingest import ingest_once, land_batch, poll_for, start_ingest

from paths import SF_SMALL


def _land_text(spark, path, docs):
    """Drop one JSON-lines file of feed documents into the landing folder (test only)."""
    folder, name = os.path.split(path)
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}.tmp", "w") as fh:
        fh.write("\n".join(json.dumps(d) for d in docs) + "\n")
    os.rename(f"{folder}/.{name}.tmp", f"{folder}/{name}.json")  # atomic publish


def test_available_now_ingest_and_restart(spark, tmp_root):
    landing, table, ckpt = f"{tmp_root}/landing", f"{tmp_root}/table", f"{tmp_root}/ckpt"
    land_batch(A.raw_quotes(spark, SF_SMALL), landing)
    stored = ingest_once(spark, landing, table, ckpt, timeout_seconds=300)
    n_events = A.table(spark, SF_SMALL, "events").count()
    assert stored == n_events
    history = load_quotes(spark, table)
    assert history.count() == n_events
    # one stamp per micro-batch; the error events carry "n/a" market caps -> NULL
    assert history.select("timestamp").distinct().count() >= 1
    n_errors = A.table(spark, SF_SMALL, "events").filter(F.col("event_type") == "error").count()
    assert history.filter(F.col("marketCapUsd").isNull()).count() == n_errors
    # rerun on the same checkpoint: nothing new, nothing duplicated
    assert ingest_once(spark, landing, table, ckpt, timeout_seconds=300) == 0
    assert load_quotes(spark, table).count() == n_events


def test_backlog_of_more_than_a_hundred_batches_is_counted_in_full(spark, tmp_root):
    landing, table, ckpt = f"{tmp_root}/landing", f"{tmp_root}/table", f"{tmp_root}/ckpt"
    for i in range(105):
        _land_text(spark, f"{landing}/b{i:03d}", [{"data": [{"id": "a", "symbol": f"S{i}", "priceUsd": "1"}]}])
    assert ingest_once(spark, landing, table, ckpt, max_files_per_trigger=1) == 105


def test_stamp_does_not_depend_on_the_session_zone(spark):
    from ledgerline.streaming.ingest import ingest_time
    zone = spark.conf.get("spark.sql.session.timeZone")
    stamps = []
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            stamps.append(spark.range(1).select(ingest_time().alias("t")).collect()[0].t)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    assert all(abs((now - t).total_seconds()) < 300 for t in stamps)


def test_new_documents_are_appended(spark, tmp_root):
    landing, table, ckpt = f"{tmp_root}/landing", f"{tmp_root}/table", f"{tmp_root}/ckpt"
    _land_text(spark, f"{landing}/b1", [{"data": [{"id": "bitcoin", "symbol": "BTC", "priceUsd": "10"}]}])
    assert ingest_once(spark, landing, table, ckpt, timeout_seconds=300) == 1
    _land_text(spark, f"{landing}/b2", [{"data": [{"id": "ethereum", "symbol": "ETH", "priceUsd": "2"},
                                                  {"id": "bitcoin", "symbol": "BTC", "priceUsd": "11"}]}])
    assert ingest_once(spark, landing, table, ckpt, timeout_seconds=300) == 2
    rows = load_quotes(spark, table).orderBy("timestamp", "symbol").collect()
    assert [(r.symbol, r.priceUsd) for r in rows][0] == ("BTC", 10.0)
    assert sorted((r.symbol, r.priceUsd) for r in rows) == [("BTC", 10.0), ("BTC", 11.0), ("ETH", 2.0)]


def test_empty_and_missing_data_store_nothing(spark, tmp_root):
    landing, table, ckpt = f"{tmp_root}/landing", f"{tmp_root}/table", f"{tmp_root}/ckpt"
    _land_text(spark, f"{landing}/b1", [{"data": []}, {"status": "error"}])
    assert ingest_once(spark, landing, table, ckpt, timeout_seconds=300) == 0
    assert load_quotes(spark, table).count() == 0


def test_processing_time_trigger_runs_until_stopped(spark, tmp_root):
    landing, table, ckpt = f"{tmp_root}/landing", f"{tmp_root}/table", f"{tmp_root}/ckpt"
    _land_text(spark, f"{landing}/b1", [{"data": [{"id": "a", "symbol": "A", "priceUsd": "1"}]}])
    query = start_ingest(spark, landing, table, ckpt, poll_seconds=1)
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert load_quotes(spark, table).count() == 1


def test_land_batch_groups_rows_per_document(spark, tmp_root):
    landing = f"{tmp_root}/landing"
    raw = A.raw_quotes(spark, SF_SMALL)
    land_batch(raw, landing, rows_per_document=100)
    from ledgerline.sources.schemas import RAW_QUOTE_DOC
    docs = spark.read.schema(RAW_QUOTE_DOC).json(landing)
    sizes = docs.select(F.size("data").alias("n"))
    assert sizes.agg(F.max("n")).collect()[0][0] <= 100
    assert sizes.agg(F.sum("n")).collect()[0][0] == raw.count()


def test_cli_once_exit_status(spark, tmp_root):
    from ledgerline.streaming.__main__ import main as cli
    landing, table, ckpt = f"{tmp_root}/landing", f"{tmp_root}/table", f"{tmp_root}/ckpt"
    os.makedirs(landing)
    import unittest.mock as mock
    with mock.patch.object(spark, "stop"):  # keep the shared test session alive
        assert cli(["--landing", landing, "--table", table, "--checkpoint", ckpt, "--once"]) == 1
        _land_text(spark, f"{landing}/b1", [{"data": [{"id": "a", "symbol": "A", "priceUsd": "1"}]}])
        assert cli(["--landing", landing, "--table", table, "--checkpoint", ckpt, "--once"]) == 0


def test_history_table_by_name(spark, tmp_root):
    from ledgerline.sinks.writers import register_quotes_table
    landing, table, ckpt = f"{tmp_root}/landing", f"{tmp_root}/table", f"{tmp_root}/ckpt"
    _land_text(spark, f"{landing}/b1", [{"data": [{"id": "a", "symbol": "A", "priceUsd": "1"}]}])
    ingest_once(spark, landing, table, ckpt, timeout_seconds=300)
    name = "quotes_history_" + os.path.basename(tmp_root).replace("-", "_")
    df = register_quotes_table(spark, name, table)
    assert len(df.columns) == 8
    assert spark.sql(f"SELECT count(*) AS n FROM {name}").collect()[0].n == 1


def test_backlog_in_bounded_batches_one_stamp_per_batch(spark, tmp_root):
    landing, table, ckpt = f"{tmp_root}/landing", f"{tmp_root}/table", f"{tmp_root}/ckpt"
    for i in range(3):
        _land_text(spark, f"{landing}/b{i}", [{"data": [{"id": f"a{i}", "symbol": f"S{i}", "priceUsd": "1"},
                                                        {"id": f"b{i}", "symbol": f"T{i}", "priceUsd": "2"}]}])
    assert ingest_once(spark, landing, table, ckpt, timeout_seconds=300, max_files_per_trigger=1) == 6
    rows = load_quotes(spark, table).collect()
    stamps = {}
    for r in rows:
        stamps.setdefault(r.symbol[1], set()).add(r.timestamp)  # file index -> stamps
    assert all(len(v) == 1 for v in stamps.values())  # both rows of a batch share one stamp
    assert len({next(iter(v)) for v in stamps.values()}) >= 2  # separate batches, separate stamps


def _quote(symbol):
    return {"id": symbol.lower(), "symbol": symbol, "priceUsd": "1"}


def test_status_counts_only_the_runs_own_rows(spark, tmp_root):
    """Two ingests side by side, and rows that someone else adds: each run reports what it stored itself."""
    import threading

    roots = [f"{tmp_root}/{i}" for i in range(2)]
    for i, root in enumerate(roots):
        for n in range(3):
            _land_text(spark, f"{root}/landing/b{n}", [{"data": [_quote(f"S{k}") for k in range(5 + i)]}])
    got = {}

    def run(i):
        root = roots[i]
        got[i] = ingest_once(spark, f"{root}/landing", f"{root}/table", f"{root}/ckpt", 300, max_files_per_trigger=1)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert got == {0: 15, 1: 18}
    # Another checkpoint on the same table: the sink takes its batch 0 for the one it has, stores nothing, and 0 is said.
    _land_text(spark, f"{tmp_root}/late/b", [{"data": [_quote("X")]}])
    assert ingest_once(spark, f"{tmp_root}/late", f"{roots[0]}/table", f"{tmp_root}/late-ckpt", 300) == 0
    assert load_quotes(spark, f"{roots[0]}/table").count() == 15


def test_status_reads_nothing_back(spark, tmp_root):
    """The history is not read for the status: an unreadable old file does not matter."""
    landing, table, ckpt = f"{tmp_root}/landing", f"{tmp_root}/table", f"{tmp_root}/ckpt"
    _land_text(spark, f"{landing}/b1", [{"data": [_quote("A")]}])
    assert ingest_once(spark, landing, table, ckpt, timeout_seconds=300) == 1
    for name in os.listdir(table):
        if name.endswith(".parquet"):
            with open(f"{table}/{name}", "wb") as fh:
                fh.write(b"spoilt")
    _land_text(spark, f"{landing}/b2", [{"data": [_quote("B"), _quote("C")]}])
    assert ingest_once(spark, landing, table, ckpt, timeout_seconds=300) == 2


def test_polling_keeps_its_pace_and_stops_cleanly(spark, tmp_root):
    landing, table, ckpt = f"{tmp_root}/landing", f"{tmp_root}/table", f"{tmp_root}/ckpt"
    for i in range(3):
        _land_text(spark, f"{landing}/b{i}", [{"data": [_quote(f"S{i}")] if i != 1 else []}])
    before = {q.id for q in spark.streams.active}
    ran = poll_for(spark, landing, table, ckpt, seconds=7, poll_seconds=2, max_files_per_trigger=1)
    assert {q.id for q in spark.streams.active} <= before
    assert ran.rows == 2 and len(ran.batches) == 3 and ran.empty == 1  # idle polls start no batch
    assert len(ran.started) == 3 and ran.paced(2) and not ran.paced(1000)
    assert load_quotes(spark, table).select("timestamp").distinct().count() == 2  # one stamp a batch with rows
    again = poll_for(spark, landing, table, ckpt, seconds=1, poll_seconds=1)
    assert again.rows == 0 and not again.batches and load_quotes(spark, table).count() == 2


def test_reader_stays_at_its_commit_while_batches_land(spark, tmp_root):
    landing, table, ckpt = f"{tmp_root}/landing", f"{tmp_root}/table", f"{tmp_root}/ckpt"
    _land_text(spark, f"{landing}/b1", [{"data": [_quote("A"), _quote("B")]}])
    ingest_once(spark, landing, table, ckpt, timeout_seconds=300)
    pinned = load_quotes(spark, table)
    assert pinned.count() == 2
    _land_text(spark, f"{landing}/b2", [{"data": [_quote("C"), _quote("D"), _quote("E")]}])
    ingest_once(spark, landing, table, ckpt, timeout_seconds=300)
    # A file that no commit names (a batch that died) is not seen either.
    pinned.write.parquet(f"{tmp_root}/stray")
    for name in os.listdir(f"{tmp_root}/stray"):
        if name.endswith(".parquet"):
            os.rename(f"{tmp_root}/stray/{name}", f"{table}/stray-{name}")
    assert pinned.count() == 2 and sorted(r.symbol for r in pinned.collect()) == ["A", "B"]
    assert load_quotes(spark, table).count() == 5


def test_history_table_before_any_data(spark, tmp_root):
    from ledgerline import operators as ops
    from ledgerline.sinks.writers import register_quotes_table
    name = "quotes_empty_" + os.path.basename(tmp_root).replace("-", "_")
    df = register_quotes_table(spark, name, f"{tmp_root}/table")
    assert df.count() == 0 and len(df.columns) == 8
    assert ops.latest_snapshot(df).columns == ops.latest_snapshot(A.quotes(spark, SF_SMALL)).columns
    assert register_quotes_table(spark, name, f"{tmp_root}/table").count() == 0  # a second time: as it is
    spark.sql(f"DROP TABLE {name}")
