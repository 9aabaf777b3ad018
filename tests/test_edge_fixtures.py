"""Hand-computed edge cases (FIXTURES.md section 4)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from ledgerline import operators as ops
from ledgerline.functions.expressions import (
    format_money,
    format_percent,
    half_up,
    line_revenue,
    parse_number,
    stock_health,
)
from ledgerline.sources.files import load_quotes
from ledgerline.sources.schemas import MONEY, PERCENT, QUOTE_COLUMNS, QUOTES, SESS, TXN
from ledgerline.streaming.ingest import feed_rows, typed_quotes


def txn_frame(spark, rows):
    """rows: (transaction_id, date, region, category, product_id, units, revenue)."""
    full = [(tid, d, reg, cat, prod, units, Decimal("1.00"), Decimal("5.0"), "CUST-1", Decimal(rev))
            for tid, d, reg, cat, prod, units, rev in rows]
    df = spark.createDataFrame(full, TXN)
    return df.withColumn("year_month", F.date_format("date", "yyyy-MM"))


def monthly_txn(spark, revenues):
    rows = [(f"T{i}", d, "Europe", "Books", "PROD-1", 1, r) for i, (d, r) in enumerate(revenues)]
    return txn_frame(spark, rows)


def test_rolling_mean_and_growth(spark):
    txn = monthly_txn(spark, [(dt.date(2024, 1, 5), "100"), (dt.date(2024, 2, 5), "150"),
                              (dt.date(2024, 3, 5), "0"), (dt.date(2024, 4, 5), "120")])
    rolling = [r.rolling_avg for r in ops.revenue_over_time(txn).collect()]
    assert rolling == [100.0, 125.0, 83.33, 90.0]
    growth = [r.growth_pct for r in ops.mom_growth(txn).collect()]
    assert growth == [None, 50.0, -100.0, None]


def test_missing_month_is_not_filled(spark):
    txn = monthly_txn(spark, [(dt.date(2024, 1, 5), "100"), (dt.date(2024, 3, 5), "120")])
    assert [r.rolling_avg for r in ops.revenue_over_time(txn).collect()] == [100.0, 110.0]
    assert [r.growth_pct for r in ops.mom_growth(txn).collect()] == [None, 20.0]


def test_growth_clean_drops_null_and_labels(spark):
    txn = monthly_txn(spark, [(dt.date(2024, 1, 5), "100"), (dt.date(2024, 2, 5), "102.25"),
                              (dt.date(2024, 3, 5), "50")])
    rows = ops.mom_growth_clean(ops.mom_growth(txn)).collect()
    assert [(r.growth_pct, r.direction, r.label) for r in rows] == [
        (2.25, "up", "+2.2%"), (-51.1, "down", "-51.1%")]


def test_rank_ties_keep_all_tied_rows(spark):
    rows = [(f"T{i}", dt.date(2024, 1, 1), "Europe", "Books", f"PROD-{i}", 1, rev)
            for i, rev in enumerate(["50", "40", "40", "30"])]
    top = ops.top_products(txn_frame(spark, rows), n=2).collect()
    assert [r["rank"] for r in top] == [1, 2, 2]


def test_top_products_rejects_bad_n(spark):
    with pytest.raises(ValueError):
        ops.top_products(monthly_txn(spark, [(dt.date(2024, 1, 1), "1")]), n=0)


def quotes_frame(spark, rows):
    full = [(sym, sym, sym, price, cap, None, None, ts) for sym, price, cap, ts in rows]
    return spark.createDataFrame(full, QUOTES)


def test_latest_per_symbol_and_order(spark):
    q = quotes_frame(spark, [
        ("BTC", 1.0, 5.0, dt.datetime(2024, 1, 1, 10, 0)),
        ("BTC", 2.0, 5.0, dt.datetime(2024, 1, 1, 10, 10)),
        ("ETH", 3.0, None, dt.datetime(2024, 1, 1, 10, 5)),
        ("SOL", 4.0, 9.0, dt.datetime(2024, 1, 1, 10, 1)),
    ])
    snap = ops.latest_snapshot(q).collect()
    assert [(r.symbol, r.timestamp) for r in snap] == [
        ("SOL", dt.datetime(2024, 1, 1, 10, 1)),
        ("BTC", dt.datetime(2024, 1, 1, 10, 10)),
        ("ETH", dt.datetime(2024, 1, 1, 10, 5))]
    assert [r.marketCapUsd for r in snap] == [9.0, 5.0, None]
    assert tuple(ops.latest_snapshot(q).columns) == QUOTE_COLUMNS


def test_symbol_filter_empty_list_means_all(spark):
    q = quotes_frame(spark, [("BTC", 1.0, 5.0, dt.datetime(2024, 1, 1)),
                             ("ETH", 3.0, 1.0, dt.datetime(2024, 1, 2))])
    assert ops.price_history(q, []).count() == 2
    assert ops.price_history(q, None).count() == 2
    assert [r.symbol for r in ops.price_history(q, ["ETH"]).collect()] == ["ETH"]


def sess_frame(spark, rows):
    """rows: (session_id, timestamp, region)."""
    full = [(sid, ts, "USR-1", "Mobile", 1, 60, 0, reg, ts.hour, ts.strftime("%A"))
            for sid, ts, reg in rows]
    return spark.createDataFrame(full, SESS)


def test_end_date_semantics(spark):
    day = dt.date(2024, 6, 30)
    txn = txn_frame(spark, [("T1", day, "Europe", "Books", "P", 1, "1"),
                            ("T2", day, "Europe", "Books", "P", 1, "1")])
    sess = sess_frame(spark, [("S1", dt.datetime(2024, 6, 30, 0, 0), "Europe"),
                              ("S2", dt.datetime(2024, 6, 30, 10, 0), "Europe")])
    t, s = ops.apply_filters(txn, sess, end_date="2024-06-30")
    assert t.count() == 2 and s.count() == 1
    _, s_full = ops.apply_filters(txn, sess, end_date="2024-06-30", end_day_inclusive=True)
    assert s_full.count() == 2


@pytest.mark.parametrize("choice", ["All", "", None])
def test_all_empty_none_mean_no_filter(spark, choice):
    txn = txn_frame(spark, [("T1", dt.date(2024, 1, 1), "Europe", "Books", "P", 1, "1"),
                            ("T2", dt.date(2024, 1, 1), "Asia-Pacific", "Toys", "P", 1, "1")])
    sess = sess_frame(spark, [("S1", dt.datetime(2024, 1, 1), "Europe"),
                              ("S2", dt.datetime(2024, 1, 1), "Asia-Pacific")])
    t, s = ops.apply_filters(txn, sess, region=choice, category=choice)
    assert (t.count(), s.count()) == (2, 2)


def test_category_filter_leaves_sessions(spark):
    txn = txn_frame(spark, [("T1", dt.date(2024, 1, 1), "Europe", "Books", "P", 1, "1"),
                            ("T2", dt.date(2024, 1, 1), "Europe", "Toys", "P", 1, "1")])
    sess = sess_frame(spark, [("S1", dt.datetime(2024, 1, 1), "Europe")])
    t, s = ops.apply_filters(txn, sess, category="Books")
    assert (t.count(), s.count()) == (1, 1)


def test_bad_date_rejected_before_spark(spark):
    with pytest.raises(ValueError):
        ops.filter_transactions(monthly_txn(spark, [(dt.date(2024, 1, 1), "1")]), start_date="2024-13-45")


def test_empty_input_kpis(spark):
    txn = spark.createDataFrame([], TXN)
    sess = spark.createDataFrame([], SESS)
    row = ops.kpi_summary(txn, sess).collect()
    assert len(row) == 1
    r = row[0]
    assert r.total_revenue is None and r.avg_order_value is None and r.avg_discount is None
    assert r.conversion_rate is None
    assert r.total_orders == 0 and r.total_sessions == 0


def test_kpis_small(spark):
    txn = txn_frame(spark, [("T1", dt.date(2024, 1, 1), "Europe", "Books", "P", 1, "10.00"),
                            ("T2", dt.date(2024, 1, 1), "Europe", "Books", "P", 1, "20.25")])
    sess = spark.createDataFrame(
        [(f"S{i}", dt.datetime(2024, 1, 1), "U", "Mobile", 1, 1, c, "Europe", 0, "Monday")
         for i, c in enumerate([1, 0, 0])], SESS)
    r = ops.kpi_summary(txn, sess).collect()[0]
    assert (r.total_revenue, r.total_orders, r.avg_order_value, r.avg_discount) == (30.25, 2, 15.13, 5.0)
    assert (r.total_sessions, r.conversion_rate) == (3, 33.33)


def test_heatmap_single_cell(spark):
    monday_3am = dt.datetime(2024, 1, 1, 3, 15)  # a Monday
    sess = sess_frame(spark, [("S1", monday_3am, "Europe"), ("S2", monday_3am, "Europe")])
    rows = ops.activity_heatmap(sess).collect()
    assert [r.day_of_week for r in rows] == [
        "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    cells = [(r.day_of_week, h, r[f"h{h:02d}"]) for r in rows for h in range(24)
             if r[f"h{h:02d}"] is not None]
    assert cells == [("Monday", 3, 2)]


def test_stock_health(spark):
    df = spark.createDataFrame([(0, 20), (5, 20), (20, 20)], "stock int, reorder int")
    got = [r.h for r in df.select(stock_health("stock", "reorder").alias("h")).collect()]
    assert got == ["Out of Stock", "Low Stock", "Healthy"]


def test_bad_and_missing_quote_numbers(spark, tmp_root):
    path = f"{tmp_root}/feed"
    docs = [
        '{"data": [{"id": "bitcoin", "symbol": "BTC", "name": "Bitcoin", "priceUsd": "1.5", '
        '"marketCapUsd": "x", "changePercent24Hr": "-0.5", "extra": "ignored"}]}',
    ]
    spark.sparkContext.parallelize(docs, 1).saveAsTextFile(path)
    from ledgerline.sources.schemas import RAW_QUOTE_DOC
    rows = typed_quotes(feed_rows(spark.read.schema(RAW_QUOTE_DOC).json(path))).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.priceUsd, r.marketCapUsd, r.volumeUsd24Hr, r.changePercent24Hr) == (1.5, None, None, -0.5)
    assert r.timestamp is not None


def test_missing_quotes_table_gives_typed_empty_frame(spark, tmp_root):
    df = load_quotes(spark, f"{tmp_root}/does-not-exist")
    assert df.count() == 0
    assert tuple(df.columns) == QUOTE_COLUMNS and len(df.columns) == 8


def test_half_up_rounding(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.675,), (4.0249999999999995,)], "x double")
    assert [r.r for r in df.select(half_up("x", 2).alias("r")).collect()] == [0.13, -0.13, 2.68, 4.03]
    dec = spark.createDataFrame([(Decimal("0.125"),), (Decimal("-0.125"),)], "x decimal(10,3)")
    assert [r.r for r in dec.select(half_up("x", 2).alias("r")).collect()] == [0.13, -0.13]


def test_formatting_matches_python(spark):
    values = [1234.5, 2.5, 0.125, 1234567.125, -0.04, 2.25, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select(format_money("x", 0).alias("m0"), format_money("x", 2).alias("m2"),
                     format_percent("x", 1, signed=True).alias("p")).collect()
    for v, r in zip(values, rows):
        if v is None:
            assert (r.m0, r.m2, r.p) == (None, None, None)
            continue
        assert r.m0 == f"${v:,.0f}"
        assert r.m2 == f"${v:,.2f}"
        assert r.p == f"{v:+.1f}%"


def test_parse_number_and_line_revenue(spark):
    df = spark.createDataFrame([("12.5", 3, Decimal("10.00"), Decimal("10.0"), dt.date(2024, 12, 1)),
                                ("n/a", 2, Decimal("9.99"), Decimal("0.0"), dt.date(2024, 11, 1)),
                                (None, 1, Decimal("1.00"), Decimal("0.0"), dt.date(2024, 5, 1))],
                               StructType([StructField("t", StringType()),
                                           StructField("units", IntegerType()),
                                           StructField("price", MONEY), StructField("disc", PERCENT),
                                           StructField("d", DateType())]))
    rows = df.select(parse_number("t").alias("n"),
                     line_revenue("units", "price", "disc", "d").alias("rev")).collect()
    assert [r.n for r in rows] == [12.5, None, None]
    # 3 x 10.00 x 0.9 x 1.5 = 40.50 ; 2 x 9.99 x 1.3 = 25.974 -> 25.97 ; 1.00
    assert [r.rev for r in rows] == [Decimal("40.50"), Decimal("25.97"), Decimal("1.00")]


def test_kpi_cards_match_python_formatting(spark):
    kpis = spark.createDataFrame(
        [(1234567.5, 12345, 15.125, 18.0), (None, 0, None, None)],
        "total_revenue double, total_orders bigint, avg_order_value double, conversion_rate double")
    rows = ops.kpi_cards(kpis).collect()
    r = rows[0]
    assert (r.total_revenue_text, r.total_orders_text, r.avg_order_value_text, r.conversion_rate_text) == (
        f"${1234567.5:,.0f}", f"{12345:,}", f"${15.125:,.2f}", f"{18.0}%")
    empty = rows[1]
    assert (empty.total_revenue_text, empty.total_orders_text, empty.conversion_rate_text) == (None, "0", None)


def test_money_total_is_exact(spark):
    import random
    from ledgerline.functions.expressions import money_total
    rng = random.Random(7)
    values = [Decimal(rng.randint(-10**9, 10**9)) / 100 for _ in range(5000)]
    values += [Decimal("99999999999999.99"), Decimal("-12345678901234.56"), Decimal("0.01"), None]
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "m decimal(28,2), g int")
    got = {r.g: r.t for r in df.groupBy("g").agg(money_total(df, "m").alias("t")).collect()}
    for g in range(3):
        want = sum((v for i, v in enumerate(values) if i % 3 == g and v is not None), Decimal(0))
        assert got[g] == want
    for rows in ([], [(None,)]):
        none = spark.createDataFrame(rows, "m decimal(18,2)")
        assert none.agg(money_total(none, "m").alias("t")).collect()[0].t is None


def test_money_total_rounds_the_sum_not_the_rows(spark):
    from ledgerline.functions.expressions import money_total
    for kind, value, want in (("decimal(18,6)", Decimal("0.004"), "4.00"), ("double", 0.004, "4.00"),
                              ("bigint", 3, "3000.00"), ("decimal(30,2)", Decimal("1e20"), "1e23"),
                              ("double", 1e14, "1e17")):
        df = spark.createDataFrame([(value,)] * 1000, f"m {kind}")
        assert df.agg(money_total(df, "m").alias("t")).collect()[0].t == Decimal(want)


def test_missing_change_is_down(spark):
    from ledgerline.functions.expressions import direction
    rows = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (None,)], "c double").select(direction("c").alias("d"))
    assert [r.d for r in rows.collect()] == ["up", "up", "down", "down"]


def test_share_keeps_the_type_of_its_value(spark):
    from ledgerline import operators as ops
    counts = spark.createDataFrame([("a", 3), ("b", 1)], "health string, count bigint")
    share = ops.share_of_total(counts, "health", "count")
    assert dict(share.dtypes)["count"] == "bigint"
    assert sorted((r.health, r[1], r.share_pct) for r in share.collect()) == [("a", 3, 75.0), ("b", 1, 25.0)]


def test_tied_products_all_rank(spark):
    from ledgerline import operators as ops
    rows = [(f"p{i:04d}", "c", Decimal("5.00") if i < 500 else Decimal("7.00"), 1, f"t{i}") for i in range(503)]
    txn = spark.createDataFrame(rows, "product_id string, category string, revenue decimal(18,2), units int, "
                                      "transaction_id string")
    top = ops.top_products(txn, 4).collect()
    assert len(top) == 503 and {r.rank for r in top} == {1, 4} and sum(r.rank == 1 for r in top) == 3
    assert {r.rank for r in ops.top_products(txn, 3).collect()} == {1}
