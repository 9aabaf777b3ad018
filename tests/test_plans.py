"""Plan shape: pushdown, pruning, window limits, no Python in the core."""

import pathlib
import re

from pyspark.sql import functions as F

from ledgerline import operators as ops
from ledgerline.plans import registry, views
from ledgerline.sources import adapters as A

from paths import SF_SMALL

ROOT = pathlib.Path(__file__).resolve().parents[1] / "ledgerline"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString() + "\n" + \
        df._jdf.queryExecution().optimizedPlan().toString()


def exchanges(df, **conf):
    """Exchanges of the plan without AQE."""
    conf = {"spark.sql.adaptive.enabled": "false", **conf}
    for k, v in conf.items():
        df.sparkSession.conf.set(k, v)
    try:
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            df.sparkSession.conf.unset(k)
    return re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (\w+)", text)


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def test_top_products_ranks_only_the_first_rows(spark):
    text = plan_text(registry.q_top_products(spark, SF_SMALL))
    window = text[text.index("Window"):]
    assert "TakeOrderedAndProject" in window


def scans(df, table="lineitem", **conf):
    """How often the plan without AQE reads a table (a reused exchange reads nothing again)."""
    conf = {"spark.sql.adaptive.enabled": "false", **conf}
    for k, v in conf.items():
        df.sparkSession.conf.set(k, v)
    try:
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            df.sparkSession.conf.unset(k)
    return len(re.findall(rf"FileScan parquet [^\n]*{table}.parquet", text)), text


def test_top_products_read_the_lines_once(spark):
    for conf in ({}, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        n, text = scans(registry.q_top_products(spark, SF_SMALL), **conf)
        assert n == 1 and "ReusedExchange" in text, text
        assert scans(registry.queries()["tab_deep_dive_top_products"](spark, SF_SMALL), **conf)[0] == 1


def test_tab_frames_start_from_one_pass(spark):
    """Each frame reads the lines once; stored bases leave no scan of the tables in the frames."""
    for name, fn in registry.queries().items():
        if name.startswith("tab_overview") or name in ("tab_trends_mom_growth", "tab_trends_mom_growth_bars"):
            assert scans(fn(spark, SF_SMALL))[0] == 1, name
    sess = A.sessions(spark, SF_SMALL)
    txn = A.transactions(spark, SF_SMALL)
    store = views.in_folder(spark)
    tabs = (views.overview(txn, sess, share=store), views.trends(txn, sess, share=store),
            views.deep_dive(txn, A.inventory(spark, SF_SMALL), share=store))
    for tab in tabs:
        assert tab["_shared"]  # stored here: the only reads of the tables
        for name, df in tab.items():
            if name not in ("_shared", "kpis"):
                assert scans(df)[0] == 0 and scans(df, "events")[0] == 0, name
    assert scans(tabs[0]["kpis"])[0] == 0 and scans(tabs[0]["kpis"], "events")[0] == 1


def test_levels_add_up_cells_not_lines(spark):
    """The grouping sets run over (month, region, category) cells: the partial aggregate lies below the expand."""
    text = registry.q_tab_overview_levels(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Expand") < text.rindex("Aggregate")  # printed top-down


def test_heatmap_is_one_aggregate(spark):
    assert exchanges(registry.q_activity_heatmap(spark, SF_SMALL)) == ["rangepartitioning", "hashpartitioning"]


def test_region_heatmap_shuffles_events_once(spark):
    plain = exchanges(registry.q_activity_heatmap_region(spark, SF_SMALL), **NO_BROADCAST)
    # The sort, the aggregate, and one exchange per side of the joins with user, nation and region.
    assert len(plain) <= 2 + 2 + 4


def test_filter_domain_never_aggregates_lines(spark):
    text = registry.q_filter_domain(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LeftSemi") >= 3 and "Generate explode" not in text


def test_hot_user_is_split_at_run_time(spark, tmp_root):
    """A user with a third of the events: AQE splits the line-level join."""
    import shutil
    for name in ("region", "nation", "customer"):
        shutil.copy(f"{SF_SMALL}/{name}.parquet", f"{tmp_root}/{name}.parquet")
    events = A.table(spark, SF_SMALL, "events")
    hot = events.limit(1).select("user_id").collect()[0].user_id
    wide = events.crossJoin(spark.range(60)).withColumn("event_id", F.monotonically_increasing_id())
    wide = wide.withColumn("user_id", F.expr(f"CASE WHEN event_id % 3 = 0 THEN {hot}L ELSE user_id END"))
    wide.drop("id").repartition(16).write.parquet(f"{tmp_root}/events.parquet")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = A.sessions(spark, tmp_root, ["session_id", "user_id", "region"])
        df.write.parquet(f"{tmp_root}/out")
        assert df.count() == wide.count()
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "skew=true" in plan


def test_latest_snapshot_limits_each_task_before_the_shuffle(spark):
    df = ops.latest_snapshot(A.quotes(spark, SF_SMALL))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    exchange = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(symbol" in l)
    partial = next(i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Partial" in l)
    final = next(i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Final" in l)
    # Printed top-down: Final above the exchange, Partial (run in every map task) below it.
    assert final < exchange < partial


def test_filters_reach_the_scan(spark):
    txn = A.transactions(spark, SF_SMALL, ["revenue", "date", "region", "category"])
    df = ops.filter_transactions(txn, "1996-01-01", "1996-12-31", "EUROPE", "PROMO")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", text)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(r_name,EUROPE\)", text)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(p_type,PROMO\)", text)


def test_scan_reads_only_needed_columns(spark):
    df = registry.q_revenue_by_category(spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    lineitem = [s for s in schemas if "l_extendedprice" in s]
    assert lineitem and all("l_shipdate" not in s and "l_comment" not in s and "l_tax" not in s
                            for s in lineitem)


def test_unneeded_dimensions_are_not_joined(spark):
    df = A.transactions(spark, SF_SMALL, ["product_id", "revenue"])
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text


def test_no_python_udfs_in_registered_plans(spark):
    for name, fn in registry.queries().items():
        if name.startswith(("csv_", "quotes_")) and name != "quotes_typed":
            continue  # these write intermediate files when called
        text = plan_text(fn(spark, SF_SMALL))
        for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
            assert marker not in text, (name, marker)


def test_core_never_collects():
    pattern = re.compile(r"\.(collect|toPandas|toLocalIterator)\(")
    offenders = [str(p) for p in ROOT.rglob("*.py") if "llm" not in p.parts and pattern.search(p.read_text())]
    assert offenders == []


def test_semi_join_broadcasts_only_the_bounded_side(spark):
    quotes = A.quotes(spark, SF_SMALL)
    df = ops.history_of_top(ops.price_history(quotes), ops.latest_snapshot(quotes), 5)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in text
