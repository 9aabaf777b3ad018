"""Declared schemas for every canonical table.

Nothing is inferred: schema inference costs an extra pass over the input and
can mis-type columns (a text id column of ``T1, T2`` was inferred as a
timestamp in a probe).
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(18, 2)
PERCENT = DecimalType(5, 1)

# Retail transactions, one row per order line.
TXN = StructType([
    StructField("transaction_id", StringType(), True),
    StructField("date", DateType(), True),
    StructField("region", StringType(), True),
    StructField("category", StringType(), True),
    StructField("product_id", StringType(), True),
    StructField("units", IntegerType(), True),
    StructField("unit_price", MONEY, True),
    StructField("discount_pct", PERCENT, True),
    StructField("customer_id", StringType(), True),
    StructField("revenue", MONEY, True),
])

# Columns derived on load from ``date``.
TXN_DERIVED = ("year_month", "month_num", "year")

# Web sessions, one row per session.  Timestamps are wall-clock
# (``timestamp_ntz``) so that hour and weekday never depend on the session
# time zone.
SESS = StructType([
    StructField("session_id", StringType(), True),
    StructField("timestamp", TimestampNTZType(), True),
    StructField("user_id", StringType(), True),
    StructField("device", StringType(), True),
    StructField("page_views", IntegerType(), True),
    StructField("session_duration_s", IntegerType(), True),
    StructField("converted", IntegerType(), True),
    StructField("region", StringType(), True),
    StructField("hour", IntegerType(), True),
    StructField("day_of_week", StringType(), True),
])

# Inventory, one row per product.
INV = StructType([
    StructField("product_id", StringType(), True),
    StructField("category", StringType(), True),
    StructField("stock_units", IntegerType(), True),
    StructField("reorder_level", IntegerType(), True),
    StructField("unit_cost", MONEY, True),
    StructField("supplier", StringType(), True),
    StructField("health", StringType(), True),
])

# Device names (the test sessions pick one by ``props.k % 3``) and the feed's field names.
DEVICES = ("Desktop", "Mobile", "Tablet")
QUOTE_TEXT_FIELDS = ("id", "symbol", "name")
QUOTE_NUMBER_FIELDS = ("priceUsd", "marketCapUsd", "volumeUsd24Hr", "changePercent24Hr")

# One element of the feed's ``data`` array: every used key is nullable text.
RAW_QUOTE = StructType(
    [StructField(c, StringType(), True) for c in QUOTE_TEXT_FIELDS + QUOTE_NUMBER_FIELDS]
)

# A landed feed document: ``{"data": [ {...}, ... ]}``; other keys ignored.
RAW_QUOTE_DOC = StructType([
    StructField("data", ArrayType(RAW_QUOTE), True),
])

# Typed quote history: text ids, double numbers, ingest time (UTC wall clock).
QUOTES = StructType(
    [StructField(c, StringType(), True) for c in QUOTE_TEXT_FIELDS]
    + [StructField(c, DoubleType(), True) for c in QUOTE_NUMBER_FIELDS]
    + [StructField("timestamp", TimestampNTZType(), True)]
)

QUOTE_COLUMNS = tuple(f.name for f in QUOTES.fields)
