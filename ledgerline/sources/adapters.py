"""Canonical retail and quote tables derived from the driver's star schema.

``lineitem / orders / customer / nation / region / part / events`` stand in
for the reference's transactions, sessions, inventory and quote history.
Every ``lineitem`` row is a transaction and every ``events`` row a session:
dimensions are joined from the left, and a key without a match gives NULL
attributes.  Dimension keys are unique, so leaving out the join of a
dimension that the caller does not ask for changes no row.  A filter on an
attribute still turns its join into an inner one.

Join plan, chosen for a large cluster:

* ``nation`` and ``region`` are joined to ``customer`` first; both are tiny
  and fall under Spark's size-checked automatic broadcast, everything else is
  left to the planner and AQE (sort-merge join with skew splitting when a
  side is too large to broadcast).
* ``orders`` is enriched with the customer's region *before* it meets
  ``lineitem``, so the largest table is shuffled once, on ``l_orderkey``.
* ``part`` is joined only when category is needed (a second shuffle of the
  line rows on ``l_partkey`` that region/date queries avoid).
* ``orders`` is not joined at all when neither date, customer nor region is
  needed (product/category views read ``lineitem`` and ``part`` only).

Eager aggregation (``order_rollup``, ``product_rollup``, ``session_rollup``):
when a query's keys and filters are attributes of the order, the part or the
user, the fact rows are aggregated on that key *before* the join.  The
partial aggregate runs map-side, and the join sees one row per order / part /
(user, cell) instead of one per line or event; for orders and parts (and
users without further keys) the join reuses the aggregate's shuffle.  Sums, counts and means stay exact (the rollups carry
``line_count`` / ``session_count`` and ``*_count`` columns).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from decimal import Decimal

from pyspark.sql.types import DecimalType

from ledgerline.functions.expressions import (
    HEALTH_LOW,
    HEALTH_OK,
    HEALTH_OUT,
    with_date_parts,
)
from ledgerline.sources.schemas import DEVICES, QUOTE_COLUMNS, TXN, TXN_DERIVED

TXN_COLUMNS = tuple(f.name for f in TXN.fields) + TXN_DERIVED

_ORDER_COLUMNS = {"date", "customer_id", "region", *TXN_DERIVED}
_PART_COLUMNS = {"category"}


# Declared read schemas of the driver tables: no schema-inference job per read,
# and a changed file type fails loudly instead of flowing on silently.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``<sf_dir>/<name>.parquet``), read with its declared schema.

    Files are listed anew on every call, so files added later are seen.
    """
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``c_custkey -> r_name`` via nation and region."""
    geo = (table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
           .join(table(spark, sf_dir, "region").select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    return (table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "r_name"))


# Rolled-up revenue keeps the type an exact decimal sum of money would have.
ROLLED_MONEY = DecimalType(28, 2)

# Column expressions are written as Spark SQL text and applied with
# ``selectExpr``/``F.expr``: Catalyst sees the same expressions, and the
# driver builds each one with one JVM call instead of one per sub-expression.
_DEC_DISCOUNT = "CAST(l_discount AS DECIMAL(5,2))"
_LINE_REVENUE = (f"CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - {_DEC_DISCOUNT}), 2) "
                 "AS DECIMAL(18,2))")
_LINE_DISCOUNT = f"CAST({_DEC_DISCOUNT} * 100 AS DECIMAL(5,1))"
# price_c x (100 - discount_c) is exact in units of 1/10000; integral division
# by 100 with half-up rounding (away from zero) gives the cents of _LINE_REVENUE.
_X = ("(CAST(rint(l_extendedprice * 100D) AS BIGINT)"
      " * (100 - CAST(rint(l_discount * 100D) AS BIGINT)))")
_LINE_REVENUE_CENTS = f"CASE WHEN {_X} >= 0 THEN ({_X} + 50) div 100 ELSE -((50 - {_X}) div 100) END"
_K = "CAST(get_json_object(props, '$.k') AS INT)"
_DEVICE = ("element_at(array(" + ", ".join(f"'{d}'" for d in DEVICES) + f"), pmod({_K}, 3) + 1)")

_TXN_SQL = {
    "transaction_id": "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING))",
    "date": "CAST(o_orderdate AS DATE)",
    "region": "r_name",
    "category": "p_type",
    "product_id": "concat('PROD-', CAST(l_partkey AS STRING))",
    "units": "CAST(l_quantity AS INT)",
    "unit_price": "CAST(CAST(try_divide(l_extendedprice, l_quantity) AS DECIMAL(38,10)) AS DECIMAL(18,2))",
    "discount_pct": _LINE_DISCOUNT,
    "customer_id": "concat('CUST-', CAST(o_custkey AS STRING))",
    "revenue": _LINE_REVENUE,
}


def line_revenue_cents() -> Column:
    """round(l_extendedprice x (1 - l_discount), 2) as exact integer cents (long arithmetic).

    Prices and discounts carry at most two decimals (TPC-H money), so
    ``rint(x * 100)`` is their exact cent value.
    """
    return F.expr(_LINE_REVENUE_CENTS)


def cents_to_money(col: Column) -> Column:
    """Integer cents -> decimal(28,2), exactly."""
    return (col.cast(DecimalType(20, 0)) * F.lit(Decimal("0.01"))).cast(ROLLED_MONEY)


_CENTS_TO_MONEY = "CAST(CAST(revenue_cents AS DECIMAL(20,0)) * 0.01BD AS DECIMAL(28,2)) AS revenue"


def _select_sql(df: DataFrame, exprs: dict[str, str], names: Iterable[str]) -> DataFrame:
    return df.selectExpr(*[f"{exprs[c]} AS `{c}`" for c in names])


def transactions(spark: SparkSession, sf_dir: str,
                 columns: Iterable[str] | None = None) -> DataFrame:
    """Canonical transactions, one row per ``lineitem`` row.

    ``columns`` limits the output (and therefore the joins) to what a query
    reads; ``None`` means every canonical column.
    """
    wanted = tuple(columns) if columns is not None else TXN_COLUMNS
    unknown = set(wanted) - set(TXN_COLUMNS)
    if unknown:
        raise ValueError(f"unknown transaction columns: {sorted(unknown)}")
    need = set(wanted)

    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")

    if need & _ORDER_COLUMNS:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        if "region" in need:
            orders = (orders.join(customer_regions(spark, sf_dir),
                                  F.col("o_custkey") == F.col("c_custkey"), "left")
                      .drop("c_custkey"))
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if need & _PART_COLUMNS:
        lines = lines.join(table(spark, sf_dir, "part").select("p_partkey", "p_type"),
                           F.col("l_partkey") == F.col("p_partkey"), "left")

    base_cols = [c for c in wanted if c not in TXN_DERIVED]
    if need & set(TXN_DERIVED) and "date" not in base_cols:
        base_cols.append("date")
    out = _select_sql(lines, _TXN_SQL, base_cols)
    if need & set(TXN_DERIVED):
        out = with_date_parts(out)
    return out.select(*wanted)


def transaction_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``region`` of every customer with an order that has lines: distinct keys meet, never lines."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    buyers = (table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
              .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_custkey"))
    return (customer_regions(spark, sf_dir)
            .join(buyers, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
            .select(F.col("r_name").alias("region")))


def transaction_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``category`` of every part that has lines."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey")
    return (table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("category"))
            .join(lines, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("category"))


ORDER_LEVEL_COLUMNS = ("date", "customer_id", "region") + TXN_DERIVED


def order_rollup(spark: SparkSession, sf_dir: str, columns: Iterable[str] = ()) -> DataFrame:
    """Transactions rolled up to one row per order *before* the join (eager aggregation).

    For queries whose keys and filters are order-level (date, month,
    customer, region) and whose measures are sums and counts.  ``lineitem``
    is aggregated per ``l_orderkey`` first (map-side partial aggregate, then
    one shuffle on the key); the join with ``orders`` then reuses that hash
    partitioning, so the largest table is shuffled once and the join sees one
    row per order instead of one per line (about 4x fewer rows).

    Output: the requested order-level columns plus ``revenue`` (exact sum
    of the rounded line revenues) and ``line_count`` (lines in the order);
    the operators count ``line_count`` where they would count lines.  Line
    revenue is summed as integer cents (a long accumulator, about half the
    CPU of a wide-decimal sum) and turned into money once per order.
    """
    wanted = tuple(columns)
    unknown = set(wanted) - set(ORDER_LEVEL_COLUMNS)
    if unknown:
        raise ValueError(f"not order-level columns: {sorted(unknown)}")
    per_order = (table(spark, sf_dir, "lineitem")
                 .groupBy("l_orderkey")
                 .agg(F.expr(f"sum({_LINE_REVENUE_CENTS}) AS revenue_cents"),
                      F.expr("count(1) AS line_count")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if "region" in wanted:
        orders = (orders.join(customer_regions(spark, sf_dir),
                              F.col("o_custkey") == F.col("c_custkey"), "left")
                  .drop("c_custkey"))
    joined = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    base = [c for c in wanted if c not in TXN_DERIVED]
    if set(wanted) & set(TXN_DERIVED) and "date" not in base:
        base.append("date")
    out = joined.selectExpr(*[f"{_TXN_SQL[c]} AS `{c}`" for c in base], _CENTS_TO_MONEY,
                            "line_count")
    if set(wanted) & set(TXN_DERIVED):
        out = with_date_parts(out)
    return out.select(*wanted, "revenue", "line_count")


def product_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions rolled up to one row per product *before* the join with ``part``.

    For product/category queries (keys ``product_id`` and ``category`` are
    attributes of the part).  Without the rollup the line rows are shuffled
    twice at scale: on ``l_partkey`` for the join and again on the grouping
    keys.  Here they are shuffled once, by the per-part aggregate, whose hash
    partitioning the join with ``part`` reuses; the product id text is built
    once per product instead of once per line.

    Output: ``product_id, category`` plus the measures ``revenue`` (exact sum
    of rounded line revenue), ``units``, ``line_count``, ``discount_pct``
    (sum) and ``discount_pct_count`` (non-NULL count) - operators turn these
    back into totals and means.
    """
    per_part = (table(spark, sf_dir, "lineitem")
                .groupBy("l_partkey")
                .agg(F.expr(f"sum({_LINE_REVENUE_CENTS}) AS revenue_cents"),
                     F.expr("sum(CAST(l_quantity AS INT)) AS units"),
                     F.expr("count(1) AS line_count"),
                     F.expr(f"sum({_LINE_DISCOUNT}) AS discount_pct"),
                     F.expr(f"count({_LINE_DISCOUNT}) AS discount_pct_count")))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (per_part.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
            .selectExpr(f"{_TXN_SQL['product_id']} AS product_id", "p_type AS category",
                        _CENTS_TO_MONEY, "units", "line_count", "discount_pct",
                        "discount_pct_count"))


SESS_COLUMNS = ("session_id", "timestamp", "user_id", "device", "page_views",
                "session_duration_s", "converted", "region", "hour", "day_of_week")

_SESS_SQL = {
    "session_id": "CAST(event_id AS STRING)",
    "timestamp": "ts",
    "user_id": "concat('USR-', CAST(user_id AS STRING))",
    "device": _DEVICE,
    "page_views": f"CAST(pmod({_K}, 19) + 1 AS INT)",
    "session_duration_s": "least(1800, greatest(5, CAST(value * 10 AS INT)))",
    "converted": "CAST(event_type = 'purchase' AS INT)",
    "region": "r_name",
    "hour": "hour(ts)",
    "day_of_week": "date_format(ts, 'EEEE')",
}


def sessions(spark: SparkSession, sf_dir: str,
             columns: Iterable[str] | None = None) -> DataFrame:
    """Canonical sessions, one row per ``events`` row.

    ``device`` is picked by ``props.k % 3``, ``converted`` marks purchases and
    ``region`` (joined only if asked for) is the user's customer region.
    """
    wanted = tuple(columns) if columns is not None else SESS_COLUMNS
    unknown = set(wanted) - set(SESS_COLUMNS)
    if unknown:
        raise ValueError(f"unknown session columns: {sorted(unknown)}")
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type",
                                               "value", "props")
    if "region" in wanted:
        ev = (ev.join(customer_regions(spark, sf_dir), F.col("user_id") == F.col("c_custkey"), "left")
              .drop("c_custkey"))
    return _select_sql(ev, _SESS_SQL, wanted)


SESSION_ROLLUP_KEYS = ("day_of_week", "hour")


def session_rollup(spark: SparkSession, sf_dir: str, keys: Iterable[str] = ("day_of_week", "hour"),
                   with_region: bool = True,
                   prefilter: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Sessions rolled up per user and session-level keys *before* the region join.

    Region is an attribute of the user, so counts per (user, weekday, hour)
    can be taken first and joined to the customer regions afterwards: the
    join then sees at most one row per user and cell (168 for a heatmap)
    instead of one per event.  Output: the keys, ``region`` (if asked for),
    ``session_count``, ``converted`` (sum) and ``converted_count``; the
    session operators read these like the raw rows.  ``prefilter`` runs on
    the raw events (column ``timestamp``) before they are counted, e.g. a
    date range from ``operators.filter_sessions``.
    """
    keys = tuple(keys)
    unknown = set(keys) - set(SESSION_ROLLUP_KEYS)
    if unknown:
        raise ValueError(f"not session rollup keys: {sorted(unknown)}")
    ev = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "ts AS timestamp", "event_type")
    if prefilter is not None:
        ev = prefilter(ev)
    ev = ev.withColumnRenamed("timestamp", "ts")
    converted = _SESS_SQL["converted"]
    per_user = (ev.groupBy("user_id", *[F.expr(f"{_SESS_SQL[c]} AS `{c}`") for c in keys])
                .agg(F.expr("count(event_id) AS session_count"),
                     F.expr(f"sum({converted}) AS converted"),
                     F.expr(f"count({converted}) AS converted_count")))
    cols = [*keys, "session_count", "converted", "converted_count"]
    if with_region:
        per_user = per_user.join(customer_regions(spark, sf_dir),
                                 F.col("user_id") == F.col("c_custkey"), "left")
        cols.insert(len(keys), "r_name AS region")
    return per_user.selectExpr(*cols)


_INV_STOCK = "CAST(pmod(p_size, 50) AS INT)"
_INV_REORDER = "CAST(10 + pmod(p_partkey, 21) AS INT)"


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical inventory, one row per ``part`` row."""
    return table(spark, sf_dir, "part").selectExpr(
        "concat('PROD-', CAST(p_partkey AS STRING)) AS product_id",
        "p_type AS category",
        f"{_INV_STOCK} AS stock_units",
        f"{_INV_REORDER} AS reorder_level",
        "CAST(p_retailprice AS DECIMAL(18,2)) AS unit_cost",
        "p_brand AS supplier",
        f"CASE WHEN {_INV_STOCK} = 0 THEN '{HEALTH_OUT}' "
        f"WHEN {_INV_STOCK} < {_INV_REORDER} THEN '{HEALTH_LOW}' "
        f"WHEN {_INV_STOCK} IS NOT NULL AND {_INV_REORDER} IS NOT NULL THEN '{HEALTH_OK}' END AS health",
    )


_QUOTE_SQL = {
    "id": "concat('U', CAST(user_id AS STRING))",
    "symbol": "concat('U', CAST(user_id AS STRING))",
    "name": "concat('Asset ', CAST(user_id AS STRING))",
    "priceUsd": "value",
    "marketCapUsd": "value * CAST(user_id + 1000 AS DOUBLE)",
    "volumeUsd24Hr": "value * 24.0D",
    "changePercent24Hr": "value / 10.0D - 25.0D",
}


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed quote history: one quote per ``events`` row, symbol ``U<user_id>``."""
    return table(spark, sf_dir, "events").selectExpr(
        *[f"{_QUOTE_SQL[c]} AS `{c}`" for c in QUOTE_COLUMNS[:-1]], "ts AS timestamp")


def raw_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote rows as the feed sends them: every field is text.

    Error events carry ``n/a`` as market cap, so the typed view must turn
    malformed numbers into NULL without failing.
    """
    cols = []
    for c in QUOTE_COLUMNS[:-1]:
        text = f"CAST({_QUOTE_SQL[c]} AS STRING)"
        if c == "marketCapUsd":
            text = f"CASE WHEN event_type = 'error' THEN 'n/a' ELSE {text} END"
        cols.append(f"{text} AS `{c}`")
    return table(spark, sf_dir, "events").selectExpr(*cols, "event_id", "ts")
