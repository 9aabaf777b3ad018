"""Registered queries over the driver tables, each with its DuckDB oracle.

Every entry reads the whole driver tables (through the adapters) and returns
a lazy DataFrame.  Column names and types match the oracle SQL exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerline import operators as ops
from ledgerline.functions.expressions import decimals_to_double, half_up, line_revenue, parse_number, ratio
from ledgerline.operators.filters import Filters
from ledgerline.plans import oracle as O, views
from ledgerline.session import scratch_dir
from ledgerline.sinks.writers import register_quotes_table, write_csv, write_parquet
from ledgerline.sources import adapters as A
from ledgerline.sources.files import load_inventory, load_quotes, load_sessions, load_transactions, reject_counts
from ledgerline.streaming.ingest import ingest_once, ingest_time, land_batch, poll_for

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFn
    sql: str | None  # None: rows-only check


# Filter parameters used by the filtered queries (fixed test values).
TXN_FILTER = dict(start_date="1996-01-01", end_date="1998-06-30", region="EUROPE", category="PROMO")
SESS_FILTER = dict(start_date="2024-01-05", end_date="2024-01-20", region="ASIA")
SYMBOLS = ("U1", "U7", "U42")
# A start bound alone: orders and events lie years apart, and both have rows after it.
TAB_FILTER = Filters(start_date="1997-01-01", region="AMERICA", category="STANDARD")
_TAB_TXN = "date >= DATE '1997-01-01' AND region = 'AMERICA' AND category = 'STANDARD'"
_TAB_SESS = "timestamp >= TIMESTAMP '1997-01-01 00:00:00' AND region = 'AMERICA'"


def _txn(spark, sf, *cols):
    return A.transactions(spark, sf, cols)


def _sess(spark, sf, *cols):
    return A.sessions(spark, sf, cols)


# --- sources -------------------------------------------------------------

def q_csv_transactions(spark, sf):
    path = write_csv(A.transactions(spark, sf, [f for f in A.TXN_COLUMNS
                                                if f not in ("year_month", "month_num", "year")]),
                     scratch_dir(spark, "txn-csv"))
    return decimals_to_double(load_transactions(spark, path))


def q_csv_sessions(spark, sf):
    path = write_csv(A.sessions(spark, sf), scratch_dir(spark, "sess-csv"))
    return load_sessions(spark, path)


def q_csv_inventory(spark, sf):
    path = write_csv(A.inventory(spark, sf), scratch_dir(spark, "inv-csv"))
    return decimals_to_double(load_inventory(spark, path))


def q_csv_rejects(spark, sf):
    """Bad values per column of an inventory CSV some of whose numbers are spoilt."""
    spoilt = A.inventory(spark, sf).select(
        "product_id", "category",
        F.expr("CASE WHEN health = 'Out of Stock' THEN 'none' ELSE CAST(stock_units AS STRING) END AS stock_units"),
        F.expr("CASE WHEN reorder_level = 12 THEN '12.5' ELSE CAST(reorder_level AS STRING) END AS reorder_level"),
        F.expr("CASE WHEN reorder_level < 13 THEN concat('$', unit_cost) ELSE CAST(unit_cost AS STRING) END AS unit_cost"),
        "supplier", "health")
    path = write_csv(spoilt, scratch_dir(spark, "rejects-csv"))
    return reject_counts(load_inventory(spark, path, on_bad="null", bad_column="bad"), "bad")


def q_quotes_poll(spark, sf):
    """A polling run in a checkable form: all rows stored in paced batches, one stamp a batch, stopped cleanly."""
    landing, table = scratch_dir(spark, "feed"), scratch_dir(spark, "quotes-history")
    land_batch(A.raw_quotes(spark, sf).repartition(4), landing)
    others = {q.id for q in spark.streams.active}
    ran = poll_for(spark, landing, table, scratch_dir(spark, "ingest-ckpt"), seconds=0, poll_seconds=1,
                   max_files_per_trigger=1)
    stored = load_quotes(spark, table)
    return stored.agg(
        F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) == F.lit(ran.rows)).alias("reported"),
        (F.countDistinct("timestamp") == F.lit(len(ran.batches) - ran.empty)).alias("stamp_per_batch"),
        F.lit(ran.paced(1)).alias("paced"),
        F.lit({q.id for q in spark.streams.active} <= others).alias("stopped"))


def q_quotes_catalog(spark, sf):
    """The history as a catalog table: made before any data, read empty with all columns, then with the data."""
    path = scratch_dir(spark, "quotes-catalog") + "/history"
    name = "ledgerline_quotes_" + uuid.uuid4().hex
    empty = register_quotes_table(spark, name, path)
    rows_before, columns_before = empty.count(), len(empty.columns)
    write_parquet(A.quotes(spark, sf), path, mode="append")
    spark.catalog.refreshTable(name)
    table = spark.table(name)
    found = table.agg(F.lit("after").alias("phase"), F.lit(len(table.columns)).alias("columns"),
                      F.count(F.lit(1)).alias("rows"), F.countDistinct("symbol").alias("symbols"))
    spark.sql(f"DROP TABLE {name}")  # external: its files stay
    first = spark.createDataFrame([("before", columns_before, rows_before, 0)], found.schema)
    return first.unionByName(found)


def q_quotes_scan(spark, sf):
    path = write_parquet(A.quotes(spark, sf), scratch_dir(spark, "quotes"))
    return load_quotes(spark, path)


def _ingested(spark, sf):
    landing = scratch_dir(spark, "feed")
    table = scratch_dir(spark, "quotes-history")
    land_batch(A.raw_quotes(spark, sf), landing)
    ingest_once(spark, landing, table, scratch_dir(spark, "ingest-ckpt"))
    return load_quotes(spark, table)


def q_quotes_stream_ingest(spark, sf):
    return _ingested(spark, sf).drop("timestamp")


def q_quotes_ingest_stamp(spark, sf):
    """The ingest stamps in a checkable form: one batch, so one stamp, never NULL and not in the future."""
    return _ingested(spark, sf).agg(
        F.count(F.lit(1)).alias("rows"), F.count("timestamp").alias("stamped"),
        F.countDistinct("timestamp").alias("stamps"),
        F.coalesce(F.max("timestamp") <= ingest_time(), F.lit(True)).alias("past"))


def q_quotes_typed(spark, sf):
    raw = A.raw_quotes(spark, sf)
    return raw.select(*[F.col(c) for c in ("id", "symbol", "name")],
                      *[parse_number(c).alias(c) for c in
                        ("priceUsd", "marketCapUsd", "volumeUsd24Hr", "changePercent24Hr")])


# --- projections ---------------------------------------------------------

def q_txn_enrich(spark, sf):
    return _txn(spark, sf, "transaction_id", "date", "year_month", "month_num", "year")


def q_line_revenue(spark, sf):
    t = _txn(spark, sf, "transaction_id", "date", "units", "unit_price", "discount_pct")
    return decimals_to_double(t.withColumn(
        "seasonal_revenue", line_revenue("units", "unit_price", "discount_pct", "date")))


# --- filters -------------------------------------------------------------

def q_filtered_txn(spark, sf):
    txn = A.transactions(spark, sf)
    return decimals_to_double(ops.filter_transactions(txn, **TXN_FILTER))


def q_filtered_sess(spark, sf):
    return ops.filter_sessions(A.sessions(spark, sf), **SESS_FILTER)


def q_filtered_sess_fullday(spark, sf):
    return ops.filter_sessions(A.sessions(spark, sf), end_day_inclusive=True, **SESS_FILTER)


# --- aggregates ----------------------------------------------------------

def q_kpi_summary(spark, sf):
    txn = _txn(spark, sf, "transaction_id", "revenue", "discount_pct")
    sess = _sess(spark, sf, "session_id", "converted")
    return ops.kpi_summary(txn, sess)


def q_kpi_cards(spark, sf):
    return ops.kpi_cards(q_kpi_summary(spark, sf))


def q_region_bar_labels(spark, sf):
    return ops.with_money_label(q_revenue_by_region(spark, sf), "revenue")


def q_market_cap_labels(spark, sf):
    top = ops.top_assets(ops.latest_snapshot(A.quotes(spark, sf)), 10)
    return ops.with_money_label(top.select("symbol", "marketCapUsd"), "marketCapUsd")


def q_kpi_summary_filtered(spark, sf):
    f = TAB_FILTER
    txn = _txn(spark, sf, "transaction_id", "revenue", "discount_pct", "date", "region", "category")
    t = ops.filter_transactions(txn, f.start_date, f.end_date, f.region, f.category)
    # Sessions: date range on the raw events, counted per user, then the region.
    by_user = A.session_rollup(spark, sf, (), prefilter=lambda ev: ops.filter_sessions(ev, f.start_date, f.end_date))
    s = ops.filter_sessions(by_user, region=f.region)
    return ops.kpi_summary(t, s)


def _orders(spark, sf, *cols):
    return A.order_rollup(spark, sf, cols)


def q_monthly_revenue(spark, sf):
    m = ops.monthly_revenue(_orders(spark, sf, "year_month"))
    return m.withColumn("revenue", F.col("revenue").cast(DoubleType()))


def q_revenue_by_region(spark, sf):
    return ops.revenue_by_region(_orders(spark, sf, "region"))


def q_revenue_by_category(spark, sf):
    return ops.revenue_by_category(A.product_rollup(spark, sf))


def q_activity_long(spark, sf):
    return ops.activity_long(_sess(spark, sf, "session_id", "day_of_week", "hour"))


def q_activity_heatmap(spark, sf):
    return ops.activity_heatmap(_sess(spark, sf, "session_id", "day_of_week", "hour"))


def q_activity_heatmap_region(spark, sf):
    # Counting per user and cell first would shrink the events little and shuffle them twice.
    sess = ops.filter_sessions(_sess(spark, sf, "session_id", "day_of_week", "hour", "region"), region="EUROPE")
    return ops.activity_heatmap(sess)


def q_device_trend(spark, sf):
    return ops.device_trend(_sess(spark, sf, "session_id", "timestamp", "device"))


def q_device_trend_daily(spark, sf):
    return ops.device_trend(_sess(spark, sf, "session_id", "timestamp", "device"), grain="day")


def q_discount_vs_revenue(spark, sf):
    return ops.discount_vs_revenue(A.product_rollup(spark, sf))


def q_inventory_health_counts(spark, sf):
    return ops.health_counts(A.inventory(spark, sf))


def q_category_share(spark, sf):
    cat = ops.revenue_by_category(A.product_rollup(spark, sf))
    return ops.share_of_total(cat, "category", "revenue")


def q_health_share(spark, sf):
    return ops.share_of_total(ops.health_counts(A.inventory(spark, sf)), "health", "count")


def q_filter_domain(spark, sf):
    regions = ops.filter_domains(A.transaction_regions(spark, sf), ["region"])
    categories = ops.filter_domains(A.transaction_categories(spark, sf), ["category"])
    return regions.unionByName(categories)


def q_row_counts(spark, sf):
    return ops.row_counts({
        "transactions": _txn(spark, sf, "transaction_id"),
        "sessions": _sess(spark, sf, "session_id"),
        "inventory": A.inventory(spark, sf),
    })


# --- windows, top-k ------------------------------------------------------

def q_revenue_over_time(spark, sf):
    return ops.revenue_over_time(_orders(spark, sf, "year_month"))


def q_mom_growth(spark, sf):
    return ops.mom_growth(_orders(spark, sf, "year_month"))


def q_mom_growth_clean(spark, sf):
    return ops.mom_growth_clean(ops.mom_growth(_orders(spark, sf, "year_month")))


def q_top_products(spark, sf):
    return ops.top_products(A.product_rollup(spark, sf), n=10)


def q_top_products_table(spark, sf):
    return ops.top_products_table(q_top_products(spark, sf))


def q_inventory_value(spark, sf):
    return decimals_to_double(ops.inventory_value(A.inventory(spark, sf)))


def q_latest_snapshot(spark, sf):
    return ops.latest_snapshot(A.quotes(spark, sf))


def q_top_assets(spark, sf):
    return ops.top_assets(ops.latest_snapshot(A.quotes(spark, sf)), 10)


def q_asset_cards(spark, sf):
    return ops.asset_cards(ops.latest_snapshot(A.quotes(spark, sf)), 4)


def q_price_history(spark, sf):
    return ops.price_history(A.quotes(spark, sf))


def q_price_history_subset(spark, sf):
    return ops.price_history(A.quotes(spark, sf), list(SYMBOLS))


def q_price_history_top5(spark, sf):
    quotes = A.quotes(spark, sf)
    return ops.history_of_top(ops.price_history(quotes), ops.latest_snapshot(quotes), 5)


# --- the dashboard's tabs under a filter -----------------------------------

def _overview(spark, sf):
    txn = _txn(spark, sf, "transaction_id", "date", "year_month", "region", "category", "revenue", "discount_pct")
    return views.overview(txn, _sess(spark, sf, "session_id", "timestamp", "region", "converted"), TAB_FILTER)


def _trends(spark, sf):
    sess = _sess(spark, sf, "session_id", "timestamp", "region", "device", "hour", "day_of_week")
    return views.trends(_txn(spark, sf, "date", "year_month", "region", "category", "revenue"), sess, TAB_FILTER)


def _deep_dive(spark, sf):
    txn = _txn(spark, sf, "transaction_id", "date", "region", "category", "product_id", "units", "revenue",
               "discount_pct")
    return views.deep_dive(txn, A.inventory(spark, sf), TAB_FILTER)


def _quotes_tab(spark, sf):
    return views.quotes_view(A.quotes(spark, sf))


def q_tab_overview_levels(spark, sf):
    """The one pass behind the overview: revenue in all, per month, per region and per category."""
    levels = _overview(spark, sf).base("levels")
    return levels.select(
        "level", *ops.LEVELS[1:], F.round("revenue", 2).cast(DoubleType()).alias("revenue"),
        F.col("line_count").alias("orders"),
        half_up(ratio(F.col("revenue"), F.col("revenue_count")), 2).alias("avg_order_value"),
        half_up(ratio(F.col("discount_pct"), F.col("discount_pct_count")), 1).alias("avg_discount"))


def _frame(tab, name: str) -> QueryFn:
    def run(spark, sf):
        return decimals_to_double(tab(spark, sf)[name])
    return run


# --- oracle SQL ----------------------------------------------------------

_hu, _mean, _money = O.hu, O.mean, O.money

_HEAT_COLS = ",\n       ".join(
    f"NULLIF(count(session_id) FILTER (WHERE hour = {h}), 0) AS h{h:02d}" for h in range(24))

_TXN_ROW = ("transaction_id, date, region, category, product_id, units, "
            "CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_pct AS DOUBLE) AS discount_pct, "
            "customer_id, CAST(revenue AS DOUBLE) AS revenue")
_SESS_ROW = ("session_id, timestamp, user_id, device, page_views, session_duration_s, converted, "
             "region, hour, day_of_week")
_INV_ROW = ("product_id, category, stock_units, reorder_level, CAST(unit_cost AS DOUBLE) AS unit_cost, "
            "supplier, health")

_MONTHLY = "monthly AS (SELECT year_month, round(sum(revenue), 2) AS revenue, count(transaction_id) AS orders FROM txn GROUP BY year_month)"
_MOM = (_MONTHLY, """mom AS (
  SELECT year_month, CAST(revenue AS DOUBLE) AS revenue, CAST(prev AS DOUBLE) AS prev_revenue,
         """ + _hu("CAST(revenue - prev AS DOUBLE) / NULLIF(CAST(prev AS DOUBLE), 0) * CAST(100 AS DOUBLE)", 2)
        + """ AS growth_pct
  FROM (SELECT year_month, revenue, lag(revenue) OVER (ORDER BY year_month NULLS FIRST) AS prev FROM monthly) t
)""")

_TOP = """top AS (
  SELECT CAST(rnk AS BIGINT) AS rank, product_id, category, CAST(total_revenue AS DOUBLE) AS total_revenue,
         total_units, orders
  FROM (SELECT product_id, category, round(sum(revenue), 2) AS total_revenue,
               CAST(sum(units) AS BIGINT) AS total_units, count(transaction_id) AS orders,
               rank() OVER (ORDER BY round(sum(revenue), 2) DESC) AS rnk
        FROM txn GROUP BY product_id, category) t
  WHERE rnk <= 10
)"""


def _signed_pct(expr: str, digits: int) -> str:
    return (f"CASE WHEN {expr} IS NULL THEN NULL "
            f"ELSE printf('%+.{digits}f%%', {expr}) END")


def _money_text(expr: str, digits: int) -> str:
    return f"CASE WHEN {expr} IS NULL THEN NULL ELSE '$' || format('{{:,.{digits}f}}', {expr}) END"


def _direction(expr: str) -> str:
    return f"CASE WHEN {expr} >= 0 THEN 'up' ELSE 'down' END"


_QUOTE_TYPED = """SELECT id, symbol, name, priceUsd,
       CASE WHEN event_type = 'error' THEN NULL ELSE marketCapUsd END AS marketCapUsd,
       volumeUsd24Hr, changePercent24Hr FROM quotes"""


QUERIES: tuple[Query, ...] = (
    # sources
    Query("csv_transactions", q_csv_transactions, O.txn_sql(f"SELECT {_TXN_ROW}, year_month, month_num, year FROM txn")),
    Query("csv_sessions", q_csv_sessions, O.sess_sql(f"SELECT {_SESS_ROW} FROM sess")),
    Query("csv_inventory", q_csv_inventory, O.inv_sql(f"SELECT {_INV_ROW} FROM inv")),
    Query("csv_rejects", q_csv_rejects, O.inv_sql("""
SELECT 'stock_units' AS "column", count(*) AS rejects FROM inv WHERE health = 'Out of Stock' HAVING count(*) > 0
UNION ALL SELECT 'reorder_level', count(*) FROM inv WHERE reorder_level = 12 HAVING count(*) > 0
UNION ALL SELECT 'unit_cost', count(*) FROM inv WHERE reorder_level < 13 HAVING count(*) > 0""")),
    Query("quotes_poll", q_quotes_poll, O.quotes_sql(
        "SELECT count(*) AS rows, true AS reported, true AS stamp_per_batch, true AS paced, true AS stopped FROM quotes")),
    Query("quotes_catalog", q_quotes_catalog, O.quotes_sql(
        "SELECT 'before' AS phase, 8 AS columns, CAST(0 AS BIGINT) AS rows, CAST(0 AS BIGINT) AS symbols "
        "UNION ALL SELECT 'after', 8, count(*), count(DISTINCT symbol) FROM quotes")),
    Query("quotes_scan", q_quotes_scan, O.quotes_sql(
        "SELECT id, symbol, name, priceUsd, marketCapUsd, volumeUsd24Hr, changePercent24Hr, timestamp FROM quotes")),
    Query("quotes_stream_ingest", q_quotes_stream_ingest, O.quotes_sql(_QUOTE_TYPED)),
    Query("quotes_typed", q_quotes_typed, O.quotes_sql(_QUOTE_TYPED)),
    Query("quotes_ingest_stamp", q_quotes_ingest_stamp, O.quotes_sql(
        "SELECT count(*) AS rows, count(*) AS stamped, CAST(least(count(*), 1) AS BIGINT) AS stamps, true AS past "
        "FROM quotes")),
    # projections
    Query("txn_enrich", q_txn_enrich, O.txn_sql(
        "SELECT transaction_id, date, year_month, month_num, year FROM txn")),
    Query("line_revenue", q_line_revenue, O.txn_sql(
        "SELECT transaction_id, date, units, CAST(unit_price AS DOUBLE) AS unit_price, "
        "CAST(discount_pct AS DOUBLE) AS discount_pct, "
        "CAST(CAST(round(CAST(units AS DECIMAL(10,0)) * unit_price * ((100 - discount_pct) * 0.01) * "
        "(CASE month(date) WHEN 12 THEN 1.5 WHEN 11 THEN 1.3 ELSE 1.0 END), 2) AS DECIMAL(18,2)) AS DOUBLE) "
        "AS seasonal_revenue FROM txn")),
    # filters
    Query("filtered_txn", q_filtered_txn, O.txn_sql(
        f"SELECT {_TXN_ROW}, year_month, month_num, year FROM txn "
        "WHERE date >= DATE '1996-01-01' AND date <= DATE '1998-06-30' "
        "AND region = 'EUROPE' AND category = 'PROMO'")),
    Query("filtered_sess", q_filtered_sess, O.sess_sql(
        f"SELECT {_SESS_ROW} FROM sess WHERE timestamp >= TIMESTAMP '2024-01-05 00:00:00' "
        "AND timestamp <= TIMESTAMP '2024-01-20 00:00:00' AND region = 'ASIA'")),
    Query("filtered_sess_fullday", q_filtered_sess_fullday, O.sess_sql(
        f"SELECT {_SESS_ROW} FROM sess WHERE timestamp >= TIMESTAMP '2024-01-05 00:00:00' "
        "AND timestamp < TIMESTAMP '2024-01-21 00:00:00' AND region = 'ASIA'")),
    # aggregates
    Query("kpi_summary", q_kpi_summary, O.both_sql(f"""
SELECT t.*, s.* FROM
  (SELECT {_money('revenue')} AS total_revenue, count(transaction_id) AS total_orders,
          {_hu(_mean('revenue'), 2)} AS avg_order_value, {_hu(_mean('discount_pct'), 1)} AS avg_discount
   FROM txn) t,
  (SELECT count(session_id) AS total_sessions,
          {_hu(_mean('converted') + ' * CAST(100 AS DOUBLE)', 2)} AS conversion_rate FROM sess) s""")),
    Query("kpi_summary_filtered", q_kpi_summary_filtered, O.both_sql(f"""
SELECT t.*, s.* FROM
  (SELECT {_money('revenue')} AS total_revenue, count(transaction_id) AS total_orders,
          {_hu(_mean('revenue'), 2)} AS avg_order_value, {_hu(_mean('discount_pct'), 1)} AS avg_discount
   FROM txn WHERE {_TAB_TXN}) t,
  (SELECT count(session_id) AS total_sessions,
          {_hu(_mean('converted') + ' * CAST(100 AS DOUBLE)', 2)} AS conversion_rate FROM sess
   WHERE {_TAB_SESS}) s""")),
    Query("kpi_cards", q_kpi_cards, O.both_sql(f"""
SELECT {_money_text('total_revenue', 0)} AS total_revenue_text,
       format('{{:,}}', total_orders) AS total_orders_text,
       {_money_text('avg_order_value', 2)} AS avg_order_value_text,
       CAST(conversion_rate AS VARCHAR) || '%' AS conversion_rate_text
FROM (SELECT {_money('revenue')} AS total_revenue, count(transaction_id) AS total_orders,
             {_hu(_mean('revenue'), 2)} AS avg_order_value FROM txn) t,
     (SELECT {_hu(_mean('converted') + ' * CAST(100 AS DOUBLE)', 2)} AS conversion_rate FROM sess) s""")),
    Query("region_bar_labels", q_region_bar_labels, O.txn_sql(
        f"SELECT region, revenue, orders, {_money_text('revenue', 0)} AS label FROM "
        f"(SELECT region, {_money('revenue')} AS revenue, count(transaction_id) AS orders "
        "FROM txn GROUP BY region) r")),
    Query("market_cap_labels", q_market_cap_labels, O.snapshot_sql(
        f"SELECT symbol, marketCapUsd, {_money_text('marketCapUsd', 0)} AS label FROM "
        "(SELECT * FROM snapshot ORDER BY marketCapUsd DESC NULLS LAST, symbol ASC NULLS LAST LIMIT 10) s")),
    Query("monthly_revenue", q_monthly_revenue, O.txn_sql(
        f"SELECT year_month, {_money('revenue')} AS revenue, count(transaction_id) AS orders "
        "FROM txn GROUP BY year_month")),
    Query("revenue_by_region", q_revenue_by_region, O.txn_sql(
        f"SELECT region, {_money('revenue')} AS revenue, count(transaction_id) AS orders "
        "FROM txn GROUP BY region")),
    Query("revenue_by_category", q_revenue_by_category, O.txn_sql(
        f"SELECT category, {_money('revenue')} AS revenue FROM txn GROUP BY category")),
    Query("activity_long", q_activity_long, O.sess_sql(
        "SELECT day_of_week, hour, count(session_id) AS sessions FROM sess GROUP BY day_of_week, hour")),
    Query("activity_heatmap", q_activity_heatmap, O.sess_sql(f"""
SELECT d.day_of_week, d.day_index, {', '.join(f'h.h{h:02d}' for h in range(24))}
FROM (SELECT * FROM (VALUES ('Monday', 1), ('Tuesday', 2), ('Wednesday', 3), ('Thursday', 4),
                            ('Friday', 5), ('Saturday', 6), ('Sunday', 7)) v(day_of_week, day_index)) d
LEFT JOIN (SELECT day_of_week, {_HEAT_COLS} FROM sess GROUP BY day_of_week) h
  ON d.day_of_week = h.day_of_week""")),
    Query("activity_heatmap_region", q_activity_heatmap_region, O.sess_sql(f"""
SELECT d.day_of_week, d.day_index, {', '.join(f'h.h{h:02d}' for h in range(24))}
FROM (SELECT * FROM (VALUES ('Monday', 1), ('Tuesday', 2), ('Wednesday', 3), ('Thursday', 4),
                            ('Friday', 5), ('Saturday', 6), ('Sunday', 7)) v(day_of_week, day_index)) d
LEFT JOIN (SELECT day_of_week, {_HEAT_COLS} FROM sess WHERE region = 'EUROPE' GROUP BY day_of_week) h
  ON d.day_of_week = h.day_of_week""")),
    Query("device_trend", q_device_trend, O.sess_sql(
        "SELECT strftime(timestamp, '%Y-%m') AS year_month, device, count(session_id) AS sessions "
        "FROM sess GROUP BY 1, 2")),
    Query("device_trend_daily", q_device_trend_daily, O.sess_sql(
        "SELECT strftime(timestamp, '%Y-%m-%d') AS day, device, count(session_id) AS sessions "
        "FROM sess GROUP BY 1, 2")),
    Query("discount_vs_revenue", q_discount_vs_revenue, O.txn_sql(
        f"SELECT product_id, category, {_hu(_mean('discount_pct'), 1)} AS avg_discount, "
        f"{_money('revenue')} AS total_revenue, CAST(sum(units) AS BIGINT) AS total_units "
        "FROM txn GROUP BY product_id, category")),
    Query("inventory_health_counts", q_inventory_health_counts, O.inv_sql(
        "SELECT health, count(*) AS count FROM inv WHERE health IS NOT NULL GROUP BY health")),
    Query("category_share", q_category_share, O.txn_sql(
        "SELECT category, CAST(revenue AS DOUBLE) AS revenue, "
        + _hu("CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER () AS DOUBLE) * CAST(100 AS DOUBLE)", 2)
        + " AS share_pct FROM (SELECT category, round(sum(revenue), 2) AS revenue FROM txn GROUP BY category) c")),
    Query("health_share", q_health_share, O.inv_sql(
        "SELECT health, n AS count, "
        + _hu("CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) * CAST(100 AS DOUBLE)", 2)
        + " AS share_pct FROM (SELECT health, count(*) AS n FROM inv WHERE health IS NOT NULL GROUP BY health) h")),
    Query("filter_domain", q_filter_domain, O.txn_sql("""
SELECT 'region' AS field, CAST(0 AS BIGINT) AS position, 'All' AS value
UNION ALL
SELECT 'region', CAST(row_number() OVER (ORDER BY region) AS BIGINT), region
FROM (SELECT DISTINCT region FROM txn WHERE region IS NOT NULL) r
UNION ALL
SELECT 'category', CAST(0 AS BIGINT), 'All'
UNION ALL
SELECT 'category', CAST(row_number() OVER (ORDER BY category) AS BIGINT), category
FROM (SELECT DISTINCT category FROM txn WHERE category IS NOT NULL) c""")),
    Query("row_counts", q_row_counts, O.with_ctes(O.GEO, O.TXN, O.SESS, O.INV) + """
SELECT 'transactions' AS "table", count(*) AS n FROM txn
UNION ALL SELECT 'sessions', count(*) FROM sess
UNION ALL SELECT 'inventory', count(*) FROM inv"""),
    # windows and top-k
    Query("revenue_over_time", q_revenue_over_time, O.txn_sql(
        "SELECT year_month, CAST(revenue AS DOUBLE) AS revenue, orders, "
        + _hu("avg(revenue) OVER (ORDER BY year_month NULLS FIRST ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)", 2)
        + " AS rolling_avg FROM monthly", _MONTHLY)),
    Query("mom_growth", q_mom_growth, O.txn_sql("SELECT * FROM mom", *_MOM)),
    Query("mom_growth_clean", q_mom_growth_clean, O.txn_sql(
        f"SELECT *, {_direction('growth_pct')} AS direction, "
        f"{_signed_pct('growth_pct', 1)} AS label FROM mom WHERE growth_pct IS NOT NULL", *_MOM)),
    Query("top_products", q_top_products, O.txn_sql("SELECT * FROM top", _TOP)),
    Query("top_products_table", q_top_products_table, O.txn_sql(
        "SELECT rank AS \"#\", product_id AS \"Product\", category AS \"Category\", "
        f"{_money_text('total_revenue', 0)} AS \"Revenue\", total_units AS \"Units\", orders AS \"Orders\" FROM top",
        _TOP)),
    Query("inventory_value", q_inventory_value, O.inv_sql(
        f"SELECT {_INV_ROW}, CAST(CAST(round(CAST(stock_units AS DECIMAL(10,0)) * unit_cost, 2) "
        "AS DECIMAL(18,2)) AS DOUBLE) AS stock_value FROM inv")),
    Query("latest_snapshot", q_latest_snapshot, O.snapshot_sql("SELECT * FROM snapshot")),
    Query("top_assets", q_top_assets, O.snapshot_sql(
        "SELECT * FROM snapshot ORDER BY marketCapUsd DESC NULLS LAST, symbol ASC NULLS LAST LIMIT 10")),
    Query("asset_cards", q_asset_cards, O.snapshot_sql(
        f"SELECT symbol, {_money_text('priceUsd', 2)} AS price_text, "
        f"{_signed_pct('changePercent24Hr', 2)} AS change_text, "
        f"{_direction('changePercent24Hr')} AS direction FROM "
        "(SELECT * FROM snapshot ORDER BY marketCapUsd DESC NULLS LAST, symbol ASC NULLS LAST LIMIT 4) s")),
    Query("price_history", q_price_history, O.quotes_sql(
        "SELECT symbol, timestamp, priceUsd FROM quotes")),
    Query("price_history_subset", q_price_history_subset, O.quotes_sql(
        "SELECT symbol, timestamp, priceUsd FROM quotes WHERE symbol IN ('U1', 'U7', 'U42')")),
    Query("price_history_top5", q_price_history_top5, O.snapshot_sql(
        "SELECT symbol, timestamp, priceUsd FROM quotes WHERE symbol IN "
        "(SELECT symbol FROM snapshot ORDER BY marketCapUsd DESC NULLS LAST, symbol ASC NULLS LAST LIMIT 5)")),
)


_BY_NAME = {q.name: q for q in QUERIES}


def _level_sql(level: str) -> str:
    keys = ", ".join(k if k == level else f"CAST(NULL AS VARCHAR) AS {k}" for k in ops.LEVELS[1:])
    sql = (f"SELECT '{level}' AS level, {keys}, {_money('revenue')} AS revenue, count(transaction_id) AS orders, "
           f"{_hu(_mean('revenue'), 2)} AS avg_order_value, {_hu(_mean('discount_pct'), 1)} AS avg_discount FROM txn")
    return sql + (" HAVING count(*) > 0" if level == ops.LEVELS[0] else f" GROUP BY {level}")


_LEVELS_SQL = O.under_filters(O.txn_sql(" UNION ALL ".join(_level_sql(x) for x in ops.LEVELS)), _TAB_TXN, _TAB_SESS)


def _tab(prefix: str, tab, frames: dict[str, str], filtered: bool = True) -> list[Query]:
    """A tab's frames as queries; a frame's SQL is that of the query it corresponds to, over the filtered rows."""
    out = []
    for frame, same_as in frames.items():
        sql = _BY_NAME[same_as].sql
        if filtered:
            sql = O.under_filters(sql, _TAB_TXN, _TAB_SESS)
        out.append(Query(f"{prefix}_{frame}", _frame(tab, frame), sql))
    return out


QUERIES += (Query("tab_overview_levels", q_tab_overview_levels, _LEVELS_SQL),)
QUERIES += tuple(
    _tab("tab_overview", _overview, {
        "kpis": "kpi_summary", "revenue_over_time": "revenue_over_time", "revenue_by_region": "revenue_by_region",
        "revenue_by_category": "revenue_by_category", "category_share": "category_share"})
    + _tab("tab_trends", _trends, {
        "heatmap": "activity_heatmap", "device_trend": "device_trend", "mom_growth": "mom_growth",
        "mom_growth_bars": "mom_growth_clean"})
    + _tab("tab_deep_dive", _deep_dive, {
        "discount_vs_revenue": "discount_vs_revenue", "top_products": "top_products",
        "top_products_table": "top_products_table", "inventory": "inventory_value",
        "health_counts": "inventory_health_counts", "health_share": "health_share"})
    + _tab("tab_quotes", _quotes_tab, {
        "snapshot": "latest_snapshot", "cards": "asset_cards", "market_cap_top": "top_assets",
        "history": "price_history", "history_top": "price_history_top5"}, filtered=False))


def queries() -> dict[str, QueryFn]:
    return {q.name: q.run for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {q.name: q.sql for q in QUERIES if q.sql is not None}
