"""Global and grouped retail aggregates.

Sums of money are exact decimal sums rounded to cents and returned as
double; ratios are double quotients rounded HALF_UP.  Every aggregate is a
partial (map-side) + final hash aggregate, so a hot group key costs one
partial row per task, not a skewed shuffle.

Sum/count aggregates also accept transactions rolled up per order (a
``line_count`` column next to summed ``revenue``), see
``sources.adapters.order_rollup``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType

from ledgerline.functions.expressions import (
    exact_money,
    format_money,
    half_up,
    mean_of,
    money_total,
    month_key,
)

LINE_COUNT = "line_count"


def line_count(df: DataFrame):
    """Count of transaction lines: ``count(transaction_id)`` on line-level rows,
    or the sum of ``line_count`` on rows rolled up per order."""
    if LINE_COUNT in df.columns:
        return F.expr(f"coalesce(sum({LINE_COUNT}), 0L)")  # a count is 0, never NULL
    return F.count("transaction_id")


def session_count(df: DataFrame):
    """Count of sessions: ``count(session_id)`` on raw rows, or the sum of
    ``session_count`` on rows rolled up per user and key."""
    if "session_count" in df.columns:
        return F.expr("coalesce(sum(session_count), 0L)")  # a count is 0, never NULL
    return F.count("session_id")


def measure_mean(df: DataFrame, name: str):
    """Mean of a measure: ``sum / count`` on line rows; on rolled-up rows
    ``sum(name) / sum(name_count)`` (the rollup keeps both)."""
    count_col = f"{name}_count"
    if count_col in df.columns:
        return F.expr(f"try_divide(CAST(sum(`{name}`) AS DOUBLE), CAST(sum(`{count_col}`) AS DOUBLE))")
    return mean_of(name)


KPI_COLUMNS = ("total_revenue", "total_orders", "avg_order_value", "avg_discount",
               "total_sessions", "conversion_rate")


def transaction_kpis(txn: DataFrame) -> DataFrame:
    """One row: total revenue, order count, average order value, average discount."""
    return txn.agg(
        money_total(txn, "revenue").cast(DoubleType()).alias("total_revenue"),
        F.count("transaction_id").alias("total_orders"),
        half_up(mean_of("revenue"), 2).alias("avg_order_value"),
        half_up(mean_of("discount_pct"), 1).alias("avg_discount"),
    )


def session_kpis(sess: DataFrame) -> DataFrame:
    """One row: session count and conversion rate in percent."""
    return sess.agg(
        session_count(sess).alias("total_sessions"),
        half_up(measure_mean(sess, "converted") * F.lit(100.0), 2).alias("conversion_rate"),
    )


LEVELS = ("total", "year_month", "region", "category")


def revenue_levels(txn: DataFrame) -> DataFrame:
    """Revenue of all transactions, per month, per region and per category, in one pass.

    ``level, year_month, region, category, revenue, revenue_count, line_count,
    discount_pct, discount_pct_count``: the key of a row's level is set (NULL
    is a value of its own), the other keys are NULL.  Lines are first added up
    per (month, region, category), with partial sums in the map tasks, and the
    grouping sets then run over those cells, so no line is expanded.  Money
    sums are exact.  No transactions: no rows.
    """
    month = F.col("year_month") if "year_month" in txn.columns else month_key("date")
    keys = LEVELS[1:]
    cells = (txn.withColumn("year_month", month).groupBy(*keys)
             .agg(F.sum(exact_money(txn, "revenue")).alias("revenue"), F.count("revenue").alias("revenue_count"),
                  line_count(txn).alias(LINE_COUNT), F.sum("discount_pct").alias("discount_pct"),
                  F.count("discount_pct").alias("discount_pct_count")))
    sums = ("revenue", "revenue_count", LINE_COUNT, "discount_pct", "discount_pct_count")
    grouped = (cells.groupingSets([[], *[[F.col(k)] for k in keys]], *[F.col(k) for k in keys])
               .agg(F.grouping_id().alias("_gid"), *[F.sum(c).alias(c) for c in sums]))
    # A key's bit is set where the key is added up; the first key has the highest bit.
    level = F.when(F.col("_gid") == 3, keys[0]).when(F.col("_gid") == 5, keys[1]).when(F.col("_gid") == 6, keys[2])
    return grouped.select(level.otherwise(LEVELS[0]).alias("level"), *keys, *sums)


def at_level(levels: DataFrame, level: str) -> DataFrame:
    """The rows of one level of ``revenue_levels``, in the columns of rolled-up transactions."""
    if level not in LEVELS:
        raise ValueError(f"unknown level: {level!r}")
    return levels.filter(F.col("level") == level)


def level_kpis(levels: DataFrame) -> DataFrame:
    """``transaction_kpis`` from ``revenue_levels``; one row, also when there are no transactions."""
    total = at_level(levels, LEVELS[0])
    return total.agg(
        money_total(total, "revenue").cast(DoubleType()).alias("total_revenue"),
        line_count(total).alias("total_orders"),
        half_up(measure_mean(total, "revenue"), 2).alias("avg_order_value"),
        half_up(measure_mean(total, "discount_pct"), 1).alias("avg_discount"))


def kpi_summary(txn: DataFrame, sess: DataFrame) -> DataFrame:
    """The six headline KPIs as a one-row frame.

    The two one-row aggregates are stacked and collapsed (``max`` ignores the
    NULL half of each column) instead of being cross-joined.  Empty input
    gives NULL sums/averages and zero counts.
    """
    return joined_kpis(transaction_kpis(txn), sess)


def joined_kpis(transactions: DataFrame, sess: DataFrame) -> DataFrame:
    """``kpi_summary`` from a one-row frame of transaction KPIs and the sessions."""
    t = transactions.selectExpr(
        "*", "CAST(NULL AS BIGINT) AS total_sessions", "CAST(NULL AS DOUBLE) AS conversion_rate")
    s = session_kpis(sess).selectExpr(
        "CAST(NULL AS DOUBLE) AS total_revenue", "CAST(NULL AS BIGINT) AS total_orders",
        "CAST(NULL AS DOUBLE) AS avg_order_value", "CAST(NULL AS DOUBLE) AS avg_discount", "*")
    return t.unionByName(s).agg(*[F.expr(f"max({c}) AS {c}") for c in KPI_COLUMNS])


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """Display text of the four headline cards, formatted as the dashboard shows them.

    ``$1,234`` revenue, ``1,234`` orders, ``$1,234.56`` average order value
    and the conversion rate as its plain decimal text plus ``%``.  NULL KPIs
    (empty filter result) stay NULL instead of failing.
    """
    orders = F.col("total_orders")
    rate = F.col("conversion_rate")
    return kpis.select(
        format_money("total_revenue", 0).alias("total_revenue_text"),
        F.when(orders.isNotNull(), F.format_number(orders, 0)).alias("total_orders_text"),
        format_money("avg_order_value", 2).alias("avg_order_value_text"),
        F.when(rate.isNotNull(), F.concat(rate.cast(StringType()), F.lit("%")))
        .alias("conversion_rate_text"))


def with_money_label(df: DataFrame, value: str, label: str = "label") -> DataFrame:
    """Add the bar label ``$1,234`` (whole dollars) of a money column."""
    return df.withColumn(label, format_money(value, 0))


def monthly_revenue(txn: DataFrame, with_orders: bool = True) -> DataFrame:
    """Per ``year_month``: revenue (decimal, cents) and order-line count.

    Revenue stays decimal here because later windows (rolling mean, growth)
    work on the rounded monthly value.
    """
    month = F.col("year_month") if "year_month" in txn.columns else month_key("date")
    aggs = [money_total(txn, "revenue").alias("revenue")]
    if with_orders:
        aggs.append(line_count(txn).alias("orders"))
    return txn.groupBy(month.alias("year_month")).agg(*aggs)


def revenue_by(txn: DataFrame, key: str, with_orders: bool = True) -> DataFrame:
    """Revenue (and order lines) per ``key``, revenue descending."""
    aggs = [money_total(txn, "revenue").alias("revenue_dec")]
    if with_orders:
        aggs.append(line_count(txn).alias("orders"))
    out = (txn.groupBy(key).agg(*aggs)
           .withColumn("revenue", F.col("revenue_dec").cast(DoubleType())))
    cols = [key, "revenue"] + (["orders"] if with_orders else [])
    return out.orderBy(F.desc("revenue_dec"), F.asc(key)).select(*cols)


def revenue_by_region(txn: DataFrame) -> DataFrame:
    return revenue_by(txn, "region", with_orders=True)


def revenue_by_category(txn: DataFrame) -> DataFrame:
    return revenue_by(txn, "category", with_orders=False)


def filter_domain(txn: DataFrame, column: str) -> DataFrame:
    """Choices of one filter list: ``All`` at position 0, then sorted distinct values."""
    return filter_domains(txn, [column]).drop("field")


def filter_domains(txn: DataFrame, columns) -> DataFrame:
    """``(field, position, value)`` for several filter lists in one pass over ``txn``.

    Each row contributes one ``(field, value)`` pair per column; ``distinct``
    runs as a partial + final aggregate, so a column with few values (region)
    ships a handful of rows per task whatever the table size.  Numbering then
    runs per field over the distinct values only.  ``All`` comes first.
    """
    columns = list(columns)
    if len(columns) == 1:
        pairs = txn.select(F.lit(columns[0]).alias("field"), F.col(columns[0]).cast(StringType()).alias("value"))
    else:
        each = F.explode(F.array(*[
            F.struct(F.lit(c).alias("field"), F.col(c).cast(StringType()).alias("value"))
            for c in columns]))
        pairs = txn.select(each.alias("p")).select("p.field", "p.value")
    values = pairs.dropna(subset=["value"]).distinct()
    order = Window.partitionBy("field").orderBy("value")
    numbered = values.select("field", F.row_number().over(order).cast(LongType()).alias("position"),
                             "value")
    firsts = txn.sparkSession.createDataFrame(
        [(c, 0, "All") for c in columns], "field string, position bigint, value string")
    return firsts.unionByName(numbered).orderBy("field", "position")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, n)`` per named frame; each count is a partial + final aggregate."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
             for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
