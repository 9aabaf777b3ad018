"""Sinks: CSV/Parquet writers, sets written all or nothing, persistence."""

from ledgerline.sinks.writers import (
    current_set,
    persist_tables,
    register_quotes_table,
    write_csv,
    write_parquet,
    write_set,
)

__all__ = ["current_set", "persist_tables", "register_quotes_table", "write_csv", "write_parquet", "write_set"]
