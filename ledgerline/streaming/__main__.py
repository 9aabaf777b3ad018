"""Command line for the quote ingest stream.

    python -m ledgerline.streaming --landing DIR --table DIR --checkpoint DIR [--once]
                                   [--poll-seconds 10] [--max-files-per-trigger N]

``--once`` processes what has landed and exits with status 1 when nothing was
stored (the reference's ``--test`` mode); otherwise a micro-batch runs every
``--poll-seconds`` until interrupted.  Paths must be on storage every executor
can reach.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ledgerline.streaming.ingest import POLL_SECONDS, ingest_once, start_ingest


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m ledgerline.streaming")
    parser.add_argument("--landing", required=True, help="folder the feed documents land in")
    parser.add_argument("--table", required=True, help="Parquet history table folder")
    parser.add_argument("--checkpoint", required=True, help="stream checkpoint folder")
    parser.add_argument("--once", action="store_true", help="one available-now run, then exit")
    parser.add_argument("--poll-seconds", type=int, default=POLL_SECONDS)
    parser.add_argument("--max-files-per-trigger", type=int, default=None)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("ledgerline-ingest").getOrCreate()
    try:
        if args.once:
            stored = ingest_once(spark, args.landing, args.table, args.checkpoint,
                                 max_files_per_trigger=args.max_files_per_trigger)
            print(f"stored {stored} quote rows")
            return 0 if stored > 0 else 1
        query = start_ingest(spark, args.landing, args.table, args.checkpoint,
                             poll_seconds=args.poll_seconds,
                             max_files_per_trigger=args.max_files_per_trigger)
        try:
            query.awaitTermination()
        except KeyboardInterrupt:
            query.stop()
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
