"""Properties over the driver tables and the generators."""

from pyspark.sql import functions as F

from ledgerline import operators as ops
from ledgerline.plans import registry
from ledgerline.sources import adapters as A
from ledgerline.sources import synth

from paths import SF_MID


def test_regions_sum_to_total(spark):
    regions = registry.q_revenue_by_region(spark, SF_MID).collect()
    kpis = registry.q_kpi_summary(spark, SF_MID).collect()[0]
    assert round(sum(r.revenue for r in regions), 2) == kpis.total_revenue
    assert sum(r.orders for r in regions) == kpis.total_orders


def test_shares_sum_to_hundred(spark):
    shares = registry.q_category_share(spark, SF_MID).collect()
    assert abs(sum(r.share_pct for r in shares) - 100.0) < 0.05


def test_heatmap_sums_to_session_count(spark):
    heat = registry.q_activity_heatmap(spark, SF_MID)
    total = heat.select(sum(F.coalesce(F.col(f"h{h:02d}"), F.lit(0)) for h in range(24)).alias("s")) \
        .agg(F.sum("s")).collect()[0][0]
    assert total == A.table(spark, SF_MID, "events").count()


def test_top_n_has_at_least_min_n_groups(spark):
    top = registry.q_top_products(spark, SF_MID).collect()
    assert len(top) >= 10
    ranks = [r["rank"] for r in top]
    assert ranks == sorted(ranks) and ranks[0] == 1
    revenues = [r.total_revenue for r in top]
    assert revenues == sorted(revenues, reverse=True)


def test_monthly_windows_agree(spark):
    rot = {r.year_month: r for r in registry.q_revenue_over_time(spark, SF_MID).collect()}
    mom = {r.year_month: r for r in registry.q_mom_growth(spark, SF_MID).collect()}
    assert rot.keys() == mom.keys()
    assert all(rot[k].revenue == mom[k].revenue for k in rot)


def test_filter_domain_starts_with_all(spark):
    rows = registry.q_filter_domain(spark, SF_MID).filter("field = 'region'").orderBy("position").collect()
    assert rows[0].value == "All" and rows[0].position == 0
    assert [r.value for r in rows[1:]] == sorted(r.value for r in rows[1:])


def test_generators_follow_distributions(spark):
    txn = synth.transactions(spark, 20_000)
    stats = txn.agg(F.avg(F.col("discount_pct").cast("double")).alias("disc"),
                    F.percentile_approx(F.col("unit_price").cast("double"), 0.5).alias("median_price"),
                    F.min("units").alias("umin"), F.max("units").alias("umax"),
                    F.avg((F.col("region") == "North America").cast("int")).alias("na"),
                    F.min("date").alias("d0"), F.max("date").alias("d1")).collect()[0]
    assert abs(stats.disc - 8.0) < 0.3          # Beta(2,8) x 40 has mean 8
    assert abs(stats.median_price - 33.1) < 2.0  # exp(3.5)
    assert (stats.umin, stats.umax) == (1, 14)
    assert abs(stats.na - 0.35) < 0.02
    assert str(stats.d0) == "2023-01-01" and str(stats.d1) == "2024-12-31"
    sess = synth.sessions(spark, 20_000)
    s = sess.agg(F.avg("converted").alias("conv"), F.min("session_duration_s").alias("dmin"),
                 F.max("session_duration_s").alias("dmax"),
                 F.avg((F.col("device") == "Desktop").cast("int")).alias("desk")).collect()[0]
    assert abs(s.conv - 0.18) < 0.015 and abs(s.desk - 0.45) < 0.02
    assert s.dmin >= 5 and s.dmax <= 1800
    inv = synth.inventory(spark)
    assert inv.count() == 500 and inv.select("product_id").distinct().count() == 500
    assert inv.filter(F.col("health").isNull()).count() == 0


def test_generators_do_not_depend_on_partitioning(spark):
    a = synth.transactions(spark, 3_000, num_partitions=1)
    b = synth.transactions(spark, 3_000, num_partitions=7)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    c = synth.sessions(spark, 3_000, num_partitions=3)
    d = synth.sessions(spark, 3_000, num_partitions=5)
    assert c.exceptAll(d).count() == 0


def test_generated_revenue_formula(spark):
    txn = synth.transactions(spark, 2_000)
    seasonal = F.when(F.month("date") == 12, 1.5).when(F.month("date") == 11, 1.3).otherwise(1.0)
    approx = F.col("units") * F.col("unit_price").cast("double") * \
        (1 - F.col("discount_pct").cast("double") / 100) * seasonal
    worst = txn.select(F.max(F.abs(F.col("revenue").cast("double") - approx))).collect()[0][0]
    assert worst <= 0.005 + 1e-9


def test_operators_run_on_generated_tables(spark):
    txn = synth.transactions(spark, 5_000).withColumn("year_month", F.date_format("date", "yyyy-MM"))
    sess = synth.sessions(spark, 5_000)
    assert ops.revenue_over_time(txn).count() == 24
    assert ops.activity_heatmap(sess).count() == 7
    assert ops.device_trend(sess).count() == 24 * 3


def test_adapter_column_subsets_agree_with_full_tables(spark):
    full = A.transactions(spark, SF_MID)
    for cols in (["transaction_id", "revenue"], ["transaction_id", "product_id", "category", "units"],
                 ["transaction_id", "date", "region", "year_month"], ["transaction_id", "customer_id"]):
        part = A.transactions(spark, SF_MID, cols)
        assert part.exceptAll(full.select(*cols)).count() == 0
        assert part.count() == full.count()
    sess_full = A.sessions(spark, SF_MID)
    for cols in (["session_id", "device"], ["session_id", "region", "hour"]):
        assert A.sessions(spark, SF_MID, cols).exceptAll(sess_full.select(*cols)).count() == 0
