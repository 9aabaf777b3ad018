"""Retail and market-quote analytics on Spark DataFrames.

Every public function takes Spark ``DataFrame`` objects (and plain Python
parameters) and returns lazy ``DataFrame`` objects; collecting is left to
the caller.  Sub-packages:

* ``sources``   - declared schemas, CSV/Parquet readers, test-table adapters,
                  seeded generators built on ``spark.range``
* ``sinks``     - CSV/Parquet writers, write-if-absent, persist helpers
* ``functions`` - column expressions (month key, revenue, stock health,
                  safe number parsing, HALF_UP rounding, formatting)
* ``operators`` - filters, aggregates, windows, top-k, quote analytics
* ``streaming`` - Structured Streaming ingest of landed quote batches
* ``plans``     - composite dashboard views and the query registry
"""

from ledgerline.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
