"""Eager aggregation: rolled-up inputs give exactly the line-level results."""

import re

import pytest

from ledgerline import operators as ops
from ledgerline.sources import adapters as A

from paths import SF_MID


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_order_rollup_matches_line_level(spark):
    lines = A.transactions(spark, SF_MID, ["transaction_id", "revenue", "region", "year_month"])
    orders = A.order_rollup(spark, SF_MID, ["region", "year_month"])
    assert same(ops.revenue_by_region(lines), ops.revenue_by_region(orders))
    assert same(ops.monthly_revenue(lines), ops.monthly_revenue(orders))
    assert same(ops.revenue_over_time(lines), ops.revenue_over_time(orders))
    assert same(ops.mom_growth(lines), ops.mom_growth(orders))


def test_order_rollup_filters_on_order_columns(spark):
    lines = A.transactions(spark, SF_MID, ["transaction_id", "revenue", "region", "date"])
    orders = A.order_rollup(spark, SF_MID, ["region", "date"])
    f = dict(start_date="1997-01-01", end_date="1998-12-31", region="ASIA")
    assert same(ops.revenue_by_region(ops.filter_transactions(lines, **f)),
                ops.revenue_by_region(ops.filter_transactions(orders, **f)))


def test_product_rollup_matches_line_level(spark):
    lines = A.transactions(spark, SF_MID, ["transaction_id", "product_id", "category", "revenue",
                                           "units", "discount_pct"])
    products = A.product_rollup(spark, SF_MID)
    assert same(ops.discount_vs_revenue(lines), ops.discount_vs_revenue(products))
    assert same(ops.top_products(lines, 10), ops.top_products(products, 10))
    assert same(ops.revenue_by_category(lines), ops.revenue_by_category(products))


def test_rollup_rejects_line_level_columns(spark):
    with pytest.raises(ValueError):
        A.order_rollup(spark, SF_MID, ["category"])


@pytest.mark.parametrize("build", [
    lambda spark: ops.revenue_by_region(A.order_rollup(spark, SF_MID, ["region"])),
    lambda spark: ops.top_products(A.product_rollup(spark, SF_MID), 10),
])
def test_lineitem_is_shuffled_once_without_broadcast(spark, build):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = build(spark)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    # Walk up from the lineitem scan: exactly one exchange until the join.
    lines = plan.splitlines()
    scan = next(i for i, l in enumerate(lines) if "FileScan parquet [l_" in l)
    join = max(i for i, l in enumerate(lines[:scan]) if "SortMergeJoin" in l)
    between = lines[join:scan]
    indent = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
    exchanges = [l for l in between if "Exchange hashpartitioning(l_" in l]
    assert len(exchanges) == 1, "\n".join(between)
    assert re.search(r"HashAggregate\(keys=\[l_(orderkey|partkey)", "\n".join(between))
    assert indent > 0


def test_cents_revenue_equals_decimal_revenue_on_every_line(spark):
    from pyspark.sql import functions as F
    li = A.table(spark, SF_MID, "lineitem")
    dec = F.round(F.col("l_extendedprice").cast("decimal(18,2)")
                  * (F.lit(1) - F.col("l_discount").cast("decimal(5,2)")), 2)
    cents = A.line_revenue_cents()
    bad = li.filter((dec * 100).cast("bigint") != cents).count()
    assert bad == 0


def test_cents_half_up_away_from_zero(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(10.05, 0.5), (-10.05, 0.5), (0.01, 0.5), (-0.01, 0.5)],
                               "l_extendedprice double, l_discount double")
    # 10.05 x 0.5 = 5.025 -> 5.03 ; -5.025 -> -5.03 ; 0.005 -> 0.01 ; -0.005 -> -0.01
    got = [r.c for r in df.select(A.line_revenue_cents().alias("c")).collect()]
    assert got == [503, -503, 1, -1]


def test_session_rollup_matches_raw_sessions(spark):
    raw = A.sessions(spark, SF_MID, ["session_id", "day_of_week", "hour", "region", "converted"])
    rolled = A.session_rollup(spark, SF_MID, ("day_of_week", "hour"))
    for region in ("EUROPE", "ASIA"):
        assert same(ops.activity_heatmap(ops.filter_sessions(raw, region=region)),
                    ops.activity_heatmap(ops.filter_sessions(rolled, region=region)))
    assert same(ops.activity_long(raw), ops.activity_long(rolled))
    by_user = A.session_rollup(spark, SF_MID, ())
    from ledgerline.operators.metrics import session_kpis
    assert same(session_kpis(raw), session_kpis(by_user))


def test_session_rollup_prefilter_keeps_filter_semantics(spark):
    raw = A.sessions(spark, SF_MID, ["session_id", "timestamp", "region", "converted"])
    f = dict(start_date="2024-01-03", end_date="2024-01-17")
    rolled = A.session_rollup(spark, SF_MID, (), prefilter=lambda ev: ops.filter_sessions(ev, **f))
    from ledgerline.operators.metrics import session_kpis
    for region in (None, "AMERICA"):
        assert same(session_kpis(ops.filter_sessions(raw, region=region, **f)),
                    session_kpis(ops.filter_sessions(rolled, region=region)))


def test_rolled_up_counts_are_zero_on_empty_input(spark):
    from ledgerline.operators.metrics import session_kpis
    rolled = A.session_rollup(spark, SF_MID, ()).filter("region = 'NOWHERE'")
    r = session_kpis(rolled).collect()[0]
    assert (r.total_sessions, r.conversion_rate) == (0, None)
    orders = A.order_rollup(spark, SF_MID, ["region"]).filter("region = 'NOWHERE'")
    assert orders.agg(ops.metrics.line_count(orders).alias("n")).collect()[0].n == 0
