"""Structured Streaming ingest of landed quote batches."""

from ledgerline.streaming.ingest import (
    feed_rows,
    ingest_once,
    land_batch,
    read_feed,
    start_ingest,
    poll_for,
    typed_quotes,
)

__all__ = ["feed_rows", "ingest_once", "land_batch", "read_feed", "start_ingest",
           "poll_for", "typed_quotes"]
