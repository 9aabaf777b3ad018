"""Time trends: activity by weekday x hour, device mix, monthly windows.

The two ordered windows (rolling mean, month-over-month growth) have no
partition key, so Spark runs them in one task.  They are only ever applied
to the monthly aggregate (one row per month), never to raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerline.functions.expressions import DAY_ORDER, direction, format_percent, half_up
from ledgerline.operators.metrics import monthly_revenue, session_count

HOURS = tuple(range(24))


def hour_column(h: int) -> str:
    return f"h{h:02d}"


def activity_long(sess: DataFrame) -> DataFrame:
    """Sessions per (day_of_week, hour)."""
    return (sess.groupBy("day_of_week", "hour")
            .agg(session_count(sess).alias("sessions")))


def activity_heatmap(sess: DataFrame) -> DataFrame:
    """Weekday x hour matrix of session counts.

    Seven rows Monday..Sunday (``day_index`` 1..7) and one column per hour
    ``h00``..``h23``; an empty cell is NULL and a weekday without sessions is
    an all-NULL row.  One flat aggregate: 24 conditional counts per weekday
    over the sessions and seven rows without a session.
    """
    counted = "session_count" in sess.columns
    one = "session_count" if counted else "CASE WHEN session_id IS NOT NULL THEN 1L END"
    days = sess.selectExpr("day_of_week", "CAST(hour AS INT) AS hour", f"CAST({one} AS BIGINT) AS n")
    names = ", ".join(f"'{d}'" for d in DAY_ORDER)
    template = sess.sparkSession.range(len(DAY_ORDER)).selectExpr(
        f"element_at(array({names}), CAST(id AS INT) + 1) AS day_of_week", "CAST(NULL AS INT) AS hour",
        "CAST(NULL AS BIGINT) AS n")
    hours = [hour_column(h) for h in HOURS]
    return (days.filter(F.col("day_of_week").isin(*DAY_ORDER)).unionByName(template)
            .groupBy("day_of_week")
            .agg(*[F.expr(f"nullif(sum(CASE WHEN hour = {h} THEN n END), 0L) AS {c}") for h, c in zip(HOURS, hours)])
            .select("day_of_week", F.expr(f"array_position(array({names}), day_of_week)").cast("int").alias("day_index"),
                    *hours)
            .orderBy("day_index"))


GRAINS = {"month": ("year_month", "yyyy-MM"), "day": ("day", "yyyy-MM-dd")}


def _period(sess: DataFrame, grain: str):
    name, fmt = GRAINS[grain]
    return F.col(name) if name in sess.columns else F.date_format("timestamp", fmt).alias(name)


def session_cells(sess: DataFrame, grain: str = "month") -> DataFrame:
    """Sessions per weekday, hour, period and device, which the heatmap and the device trend can both start from."""
    return (sess.groupBy("day_of_week", "hour", _period(sess, grain), "device")
            .agg(session_count(sess).alias("session_count")))


def device_trend(sess: DataFrame, grain: str = "month") -> DataFrame:
    """Sessions per period x device, ordered by period then device."""
    name, _ = GRAINS[grain]
    return (sess.groupBy(_period(sess, grain), "device")
            .agg(session_count(sess).alias("sessions"))
            .orderBy(name, "device"))


def _month_order() -> Window:
    return Window.orderBy("year_month")


def revenue_over_time(txn: DataFrame) -> DataFrame:
    """Monthly revenue, order lines and the 3-month trailing mean.

    The mean covers the current and the two previous *observed* months
    (missing months are not filled) and is taken over the revenue already
    rounded to cents.
    """
    monthly = monthly_revenue(txn, with_orders=True)
    trailing = _month_order().rowsBetween(-2, Window.currentRow)
    rolling = F.avg(F.col("revenue")).over(trailing)
    return (monthly
            .select("year_month",
                    F.col("revenue").cast(DoubleType()).alias("revenue"),
                    "orders",
                    half_up(rolling, 2).alias("rolling_avg"))
            .orderBy("year_month"))


def mom_growth(txn: DataFrame) -> DataFrame:
    """Month-over-month growth in percent against the previous observed month.

    The first month and months after a zero month get NULL growth.
    """
    monthly = monthly_revenue(txn, with_orders=False)
    prev = F.lag("revenue", 1).over(_month_order())
    with_prev = monthly.select("year_month", "revenue", prev.alias("prev_revenue"))
    change = (F.col("revenue") - F.col("prev_revenue")).cast(DoubleType())
    growth = F.try_divide(change, F.col("prev_revenue").cast(DoubleType())) * F.lit(100.0)
    return (with_prev
            .select("year_month",
                    F.col("revenue").cast(DoubleType()).alias("revenue"),
                    F.col("prev_revenue").cast(DoubleType()).alias("prev_revenue"),
                    half_up(growth, 2).alias("growth_pct"))
            .orderBy("year_month"))


def mom_growth_clean(mom: DataFrame) -> DataFrame:
    """Growth rows with a value, plus the bar colour class and signed label."""
    return (mom.dropna(subset=["growth_pct"])
            .withColumn("direction", direction("growth_pct"))
            .withColumn("label", format_percent("growth_pct", 1, signed=True)))
