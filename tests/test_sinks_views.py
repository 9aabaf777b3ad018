"""Sinks (CSV round trip, write-if-absent, persist) and composite views."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline import operators as ops
from ledgerline.plans import views
from ledgerline.sinks.writers import current_set, persist_tables, write_csv, write_set
from ledgerline.sources import adapters as A
from ledgerline.sources import synth
from ledgerline.sources.files import (
    is_finished, load_inventory, load_sessions, load_transactions, reject_counts,
)

from paths import SF_SMALL


def test_csv_round_trip_keeps_values(spark, tmp_root):
    txn = A.transactions(spark, SF_SMALL, [c for c in A.TXN_COLUMNS
                                           if c not in ("year_month", "month_num", "year")])
    back = load_transactions(spark, write_csv(txn, f"{tmp_root}/txn")).drop("year_month", "month_num", "year")
    assert back.columns == txn.columns
    back = back.select(*[F.col(f.name).cast(f.dataType) for f in txn.schema])
    assert back.exceptAll(txn).count() == 0 and txn.exceptAll(back).count() == 0
    sess = A.sessions(spark, SF_SMALL)
    sback = load_sessions(spark, write_csv(sess, f"{tmp_root}/sess"))
    assert sback.exceptAll(sess).count() == 0
    inv = A.inventory(spark, SF_SMALL)
    iback = load_inventory(spark, write_csv(inv, f"{tmp_root}/inv"))
    iback = iback.select(*[F.col(f.name).cast(f.dataType) for f in inv.schema])
    assert iback.exceptAll(inv).count() == 0


def test_reference_style_csv_timestamps(spark, tmp_root):
    path = f"{tmp_root}/ref_sessions.csv"
    with open(path, "w") as fh:
        fh.write("session_id,timestamp,user_id,device,page_views,session_duration_s,converted,"
                 "region,hour,day_of_week\n")
        fh.write("SESS-00000000,2023-01-01 00:00:00,USR-000001,Mobile,3,50,1,Europe,0,Sunday\n")
        fh.write("SESS-00000001,2023-01-01 00:13:08.869860982,USR-000002,Desktop,2,60,0,Europe,0,Sunday\n")
    rows = load_sessions(spark, path).collect()
    assert [r.timestamp.isoformat() for r in rows] == ["2023-01-01T00:00:00", "2023-01-01T00:13:08.869860"]


def _file(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return f"{folder}/{name}"


def test_csv_columns_match_by_name_without_loss(spark, tmp_root):
    path = _file(tmp_root, "inv.csv", "extra,category,product_id,unit_cost,stock_units,supplier,reorder_level,health",
                 "x,Books,P1,12.345,7,S,10,Low Stock", "y,Toys,P2,99999999999999999.5,,S,10,")
    a, b = load_inventory(spark, path).collect()
    assert (a.product_id, a.category, float(a.unit_cost), a.stock_units) == ("P1", "Books", 12.345, 7)
    assert str(b.unit_cost) == "99999999999999999.500000" and b.stock_units is None and b.health is None


INV_HEADER = "product_id,category,stock_units,reorder_level,unit_cost,supplier,health"


def test_bad_csv_values_fail_by_default(spark, tmp_root):
    """One rule for numbers and dates: text that is not exactly such a value names its column."""
    lines = {"unit_cost": ("P1,Books,1,2,1.2345678,S,", "P1,Books,1,2,abc,S,"),
             "stock_units": ("P1,Books,1.5,2,1,S,", "P1,Books,99999999999,2,1,S,", "P1,Books,x,2,1,S,")}
    for column, bad in lines.items():
        for i, line in enumerate(bad):
            path = _file(tmp_root, f"{column}{i}.csv", INV_HEADER, line)
            with pytest.raises(Exception, match=f"{column}: not"):
                load_inventory(spark, path).collect()
    path = _file(tmp_root, "sess.csv", "session_id,timestamp,user_id,device,page_views,session_duration_s,converted,"
                 "region,hour,day_of_week", "S1,2023-02-30 00:00:00,U,Mobile,3,50,1,Europe,0,Sunday")
    with pytest.raises(Exception, match="timestamp: not"):
        load_sessions(spark, path).collect()
    with pytest.raises(ValueError):
        load_sessions(spark, path, on_bad="drop")
    path = _file(tmp_root, "missing.csv", "product_id,category", "P1,Books")
    with pytest.raises(Exception, match="stock_units"):
        load_inventory(spark, path).collect()


def test_bad_csv_values_are_kept_as_null_and_counted(spark, tmp_root):
    path = _file(tmp_root, "inv.csv", INV_HEADER, "P1,Books,x,2,1.25,S,", "P2,Books,7,,abc,S,", 'P3,Books,"",2.5,1,S,',
                 "P4,Books,x, ,1e3,S,ok")
    rows = load_inventory(spark, path, on_bad="null", bad_column="bad")
    got = {r.product_id: (r.stock_units, r.reorder_level, r.unit_cost and float(r.unit_cost), r.bad)
           for r in rows.collect()}
    assert got == {"P1": (None, 2, 1.25, ["stock_units"]), "P2": (7, None, None, ["unit_cost"]),
                   "P3": (None, None, 1.0, ["reorder_level"]), "P4": (None, None, 1000.0, ["stock_units"])}
    assert {r["column"]: r.rejects for r in reject_counts(rows, "bad").collect()} == \
        {"stock_units": 2, "unit_cost": 1, "reorder_level": 1}
    assert "bad" not in load_inventory(spark, path, on_bad="null").columns


def test_scratch_needs_a_shared_folder_off_one_machine():
    from ledgerline import session
    assert session._one_machine("local") and session._one_machine("local[8]")
    assert not session._one_machine("local-cluster[3,2,1024]") and not session._one_machine("spark://host:7077")
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Cluster(), "x")


def _sizes(n_transactions):
    return dict(n_transactions=n_transactions, n_sessions=50, n_products=20)


def test_generate_all_writes_only_when_needed(spark, tmp_root):
    out = f"{tmp_root}/raw"
    assert current_set(spark, out) == {}
    paths = synth.generate_all(spark, out, **_sizes(500))
    assert set(paths) == {"transactions", "sessions", "inventory"} and paths == current_set(spark, out)
    assert all(is_finished(spark, p) for p in paths.values())
    assert synth.generate_all(spark, out, **_sizes(700)) == paths  # all present: skipped
    assert load_transactions(spark, paths["transactions"]).count() == 500
    new = synth.generate_all(spark, out, force=True, **_sizes(700))
    assert load_transactions(spark, new["transactions"]).count() == 700
    assert load_transactions(spark, paths["transactions"]).count() == 500  # readers of the set before are not cut off
    synth.generate_all(spark, out, force=True, **_sizes(10))
    assert len(os.listdir(f"{out}/_sets")) == 2  # but the one before that is gone


def test_generate_all_rewrites_everything_when_one_is_missing(spark, tmp_root):
    out = f"{tmp_root}/raw"
    paths = synth.generate_all(spark, out, **_sizes(300))
    os.rename(f"{paths['inventory']}/_SUCCESS", f"{paths['inventory']}/_LOST")  # an unfinished table counts as absent
    new = synth.generate_all(spark, out, **_sizes(400))
    assert set(new.values()).isdisjoint(paths.values())
    assert load_transactions(spark, new["transactions"]).count() == 400
    assert load_inventory(spark, new["inventory"]).count() == 20


def test_a_set_that_dies_half_way_is_never_seen(spark, tmp_root):
    good = {"a": spark.range(3), "b": spark.range(4)}
    bad = {"a": spark.range(30), "b": spark.range(40).select(F.raise_error(F.lit("killed")).alias("id"))}
    first = f"{tmp_root}/first"
    with pytest.raises(Exception, match="killed"):
        write_set(spark, first, bad, fmt="parquet")
    assert os.path.exists(f"{first}/_sets") and current_set(spark, first) == {}  # the first table was finished
    assert {n: spark.read.parquet(p).count() for n, p in write_set(spark, first, good, fmt="parquet").items()} == \
        {"a": 3, "b": 4}
    paths = current_set(spark, first)
    with pytest.raises(Exception, match="killed"):
        write_set(spark, first, bad, force=True, fmt="parquet")
    assert current_set(spark, first) == paths  # the old set, whole
    assert {n: spark.read.parquet(p).count() for n, p in paths.items()} == {"a": 3, "b": 4}
    again = write_set(spark, first, {"a": spark.range(5), "b": spark.range(6)}, force=True, fmt="parquet")
    assert {n: spark.read.parquet(p).count() for n, p in current_set(spark, first).items()} == {"a": 5, "b": 6}
    assert current_set(spark, first) == again
    assert not [f for f in os.listdir(first) if f.startswith("_current.json.")]  # nothing left beside the manifest


def test_a_set_asked_for_more_tables_is_written_anew(spark, tmp_root):
    write_set(spark, tmp_root, {"a": spark.range(1)}, fmt="parquet")
    assert set(write_set(spark, tmp_root, {"a": spark.range(2), "b": spark.range(2)}, fmt="parquet")) == {"a", "b"}
    assert list(write_set(spark, tmp_root, {"b": spark.range(9)}, fmt="parquet")) == ["b"]
    assert spark.read.parquet(current_set(spark, tmp_root)["b"]).count() == 2


def test_persist_tables_warms_and_is_caller_owned(spark):
    frames = persist_tables({"inv": A.inventory(spark, SF_SMALL)})
    assert frames["inv"].is_cached
    frames["inv"].unpersist()


def test_views_match_operators(spark):
    txn = A.transactions(spark, SF_SMALL)
    sess = A.sessions(spark, SF_SMALL)
    inv = A.inventory(spark, SF_SMALL)
    f = ops.Filters(start_date="1996-01-01", end_date="1999-12-31", region="EUROPE")
    v1 = views.overview(txn, sess, f)
    assert set(v1) == {"kpis", "revenue_over_time", "revenue_by_region", "revenue_by_category",
                       "category_share", "_shared"}
    assert v1["revenue_by_region"].collect()[0].region == "EUROPE"
    v2 = views.trends(txn, sess, f)
    assert v2["heatmap"].count() == 7
    v3 = views.deep_dive(txn, inv, f, share=True)
    t = ops.filter_transactions(txn, "1996-01-01", "1999-12-31", "EUROPE")
    expected = ops.top_products(t, 10)
    assert v3["top_products"].exceptAll(expected).count() == 0
    assert v3["discount_vs_revenue"].exceptAll(ops.discount_vs_revenue(t)).count() == 0
    for df in v3["_shared"]:
        df.unpersist()
    v4 = views.quotes_view(A.quotes(spark, SF_SMALL))
    assert v4["cards"].count() == 4 and v4["market_cap_top"].count() == 10
    top5 = {r.symbol for r in ops.top_assets(v4["snapshot"], 5).collect()}
    assert {r.symbol for r in v4["history_top"].select("symbol").distinct().collect()} == top5


def test_dashboard_defaults():
    f = ops.Filters.dashboard_defaults()
    assert (str(f.start_date), str(f.end_date), f.region, f.category) == (
        "2023-01-01", "2024-12-31", "All", "All")
    assert ops.Filters() == ops.Filters(None, None, None, None)


def test_views_on_empty_quotes(spark, tmp_root):
    from ledgerline.sources.files import load_quotes
    v = views.quotes_view(load_quotes(spark, f"{tmp_root}/missing"))
    assert views.is_empty(v["snapshot"]) and v["history"].count() == 0
    assert v["cards"].columns == ["symbol", "price_text", "change_text", "direction"]
    assert F is not None


def test_views_share_intermediate_frames(spark):
    txn = A.transactions(spark, SF_SMALL)
    sess = A.sessions(spark, SF_SMALL)
    for view, bases in ((views.overview(txn, sess, share=True), 1), (views.trends(txn, sess, share=True), 2),
                        (views.quotes_view(A.quotes(spark, SF_SMALL), share=True), 1)):
        assert len(view["_shared"]) == bases and all(df.is_cached for df in view["_shared"])
        for df in view["_shared"]:
            df.unpersist()
    assert views.overview(txn, sess)["_shared"] == []


def test_tabs_give_the_same_rows_however_they_share(spark):
    """As plans, persisted, and stored; against the operators over the filtered lines themselves."""
    txn, sess, inv = A.transactions(spark, SF_SMALL), A.sessions(spark, SF_SMALL), A.inventory(spark, SF_SMALL)
    f = ops.Filters(start_date="1995-03-01", region="EUROPE")
    t, s = f.apply(txn, sess)
    want = {"kpis": ops.kpi_summary(t, s), "revenue_over_time": ops.revenue_over_time(t),
            "revenue_by_region": ops.revenue_by_region(t), "revenue_by_category": ops.revenue_by_category(t),
            "heatmap": ops.activity_heatmap(s), "device_trend": ops.device_trend(s, "day"),
            "mom_growth": ops.mom_growth(t), "discount_vs_revenue": ops.discount_vs_revenue(t),
            "top_products": ops.top_products(t, 10)}
    for share in (False, True, views.in_folder(spark)):
        tabs = (views.overview(txn, sess, f, share=share), views.trends(txn, sess, f, grain="day", share=share),
                views.deep_dive(txn, inv, f, share=share))
        for tab in tabs:
            for name in tab:
                if name in want:
                    assert tab[name].columns == want[name].columns
                    assert sorted(map(repr, tab[name].collect())) == sorted(map(repr, want[name].collect())), name
            for df in tab["_shared"]:
                df.unpersist()


def test_overview_of_nothing(spark):
    txn, sess = A.transactions(spark, SF_SMALL), A.sessions(spark, SF_SMALL)
    tab = views.overview(txn, sess, ops.Filters(region="nowhere"))
    row = tab["kpis"].collect()[0]
    assert (row.total_revenue, row.total_orders, row.avg_order_value, row.total_sessions) == (None, 0, None, 0)
    assert all(tab[n].count() == 0 for n in ("revenue_over_time", "revenue_by_region", "category_share"))


def test_null_keys_are_groups_of_a_level(spark):
    rows = [("T1", "2024-01-02", None, "Books", "10.00", "5.0"), ("T2", None, "EU", None, "2.50", None),
            ("T3", "2024-01-09", "EU", "Books", None, "1.0")]
    txn = spark.createDataFrame(rows, "transaction_id string, date string, region string, category string, "
                                      "revenue string, discount_pct string").selectExpr(
        "transaction_id", "CAST(date AS DATE) AS date", "region", "category",
        "CAST(revenue AS DECIMAL(18,2)) AS revenue", "CAST(discount_pct AS DECIMAL(5,1)) AS discount_pct")
    got = {(r.level, r.year_month or r.region or r.category): (r.revenue and float(r.revenue), r.line_count)
           for r in ops.revenue_levels(txn).collect()}
    assert got == {("total", None): (12.5, 3), ("year_month", "2024-01"): (10.0, 2), ("year_month", None): (2.5, 1),
                   ("region", None): (10.0, 1), ("region", "EU"): (2.5, 2), ("category", "Books"): (10.0, 2),
                   ("category", None): (2.5, 1)}


def test_persisted_frames_spill_and_are_released(spark):
    """K5: memory with spill to disk, warmed by a full read, gone after unpersist."""
    from pyspark import StorageLevel

    frames = persist_tables({"inv": A.inventory(spark, SF_SMALL), "txn": A.transactions(spark, SF_SMALL, ["revenue"])},
                            warm=["inv"])
    assert all(df.storageLevel == StorageLevel.MEMORY_AND_DISK for df in frames.values())
    tab = views.trends(A.transactions(spark, SF_SMALL), A.sessions(spark, SF_SMALL), share=True)
    held = [*frames.values(), *tab["_shared"]]
    assert all("InMemoryTableScan" in plan(df) for df in held)
    for df in held:
        df.unpersist(blocking=True)
    assert all(not df.is_cached and df.storageLevel == StorageLevel.NONE for df in held)
    assert "InMemoryTableScan" not in plan(A.inventory(spark, SF_SMALL))


def plan(df):
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


def test_scratch_space_lives_under_the_sessions_checkpoint_dir(spark):
    from ledgerline.session import ensure_checkpoint_dir, scratch_dir
    configured = spark.conf.get("spark.checkpoint.dir")
    assert configured  # set by the cluster (or, only when unset, by ensure_checkpoint_dir)
    assert ensure_checkpoint_dir(spark) == configured  # an existing setting is never replaced
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(configured.rstrip("/") + "/x-")
