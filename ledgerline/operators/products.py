"""Product-level views: discount vs revenue, top-N products.

Grouping keys are ``(product_id, category)`` as in the reference, so one
product may appear once per category it was sold under.  The operators take
line-level transactions or rows already rolled up per product (see
``sources.adapters.product_rollup``): totals are sums either way, counts
sum ``line_count`` and means divide by the kept ``*_count`` columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from ledgerline.functions.expressions import exact_money, format_money, half_up, money_total
from ledgerline.operators.metrics import line_count, measure_mean

PRODUCT_KEYS = ("product_id", "category")


def discount_vs_revenue(txn: DataFrame) -> DataFrame:
    """Per product x category: mean discount (1 dp), revenue, units sold."""
    return (txn.groupBy(*PRODUCT_KEYS)
            .agg(half_up(measure_mean(txn, "discount_pct"), 1).alias("avg_discount"),
                 money_total(txn, "revenue").cast(DoubleType()).alias("total_revenue"),
                 F.sum("units").cast(LongType()).alias("total_units")))


def product_cells(txn: DataFrame) -> DataFrame:
    """Line rows added up per product x category, in the columns the operators here read.

    One pass that both ``discount_vs_revenue`` and ``top_products`` can start
    from; sums stay exact, so their results are those over the lines.
    """
    money = exact_money(txn, "revenue")
    counted = "discount_pct_count" in txn.columns
    n_discount = F.sum("discount_pct_count") if counted else F.count("discount_pct")
    return (txn.groupBy(*PRODUCT_KEYS)
            .agg(F.sum(money).alias("revenue"), F.sum("units").cast(LongType()).alias("units"),
                 line_count(txn).alias("line_count"), F.sum("discount_pct").alias("discount_pct"),
                 n_discount.alias("discount_pct_count")))


def product_totals(txn: DataFrame) -> DataFrame:
    """Per product x category: revenue (decimal, cents), units, order lines."""
    return (txn.groupBy(*PRODUCT_KEYS)
            .agg(money_total(txn, "revenue").alias("total_revenue"),
                 F.sum("units").cast(LongType()).alias("total_units"),
                 line_count(txn).alias("orders")))


def top_products(txn: DataFrame, n: int = 10) -> DataFrame:
    """Products ranked by revenue with ``rank() <= n`` (ties share a rank).

    The first ``n`` rows (``TakeOrderedAndProject``) hold every total that can
    rank; they are ranked, and their distinct totals are joined back, so tied
    products, however many, never meet in one task.  Both uses of the totals
    ask for the same columns, so the lines are read and added up once
    (``ReusedExchange``).
    """
    return top_products_from_totals(product_totals(txn), n)


def top_products_from_totals(totals: DataFrame, n: int = 10) -> DataFrame:
    """``top_products`` on an existing ``product_totals`` frame (decimal revenue)."""
    if n < 1:
        raise ValueError("n must be at least 1")
    # Sorting by every column keeps the totals the same frame in both branches.
    first = (totals.orderBy(F.desc("total_revenue"), *PRODUCT_KEYS, "total_units", "orders").limit(n)
             .select(F.col("total_revenue").alias("_total")))
    ranks = first.withColumn("rank", F.rank().over(Window.orderBy(F.desc("_total")))).distinct()
    return (totals.join(ranks, F.col("total_revenue").eqNullSafe(F.col("_total")))
            .select(F.col("rank").cast(LongType()).alias("rank"), *PRODUCT_KEYS,
                    F.col("total_revenue").cast(DoubleType()).alias("total_revenue"),
                    "total_units", "orders")
            .orderBy("rank", "product_id", "category"))


# Display headers of the top-products table.
TABLE_HEADERS = (("rank", "#"), ("product_id", "Product"), ("category", "Category"),
                 ("total_revenue", "Revenue"), ("total_units", "Units"), ("orders", "Orders"))


def top_products_table(top: DataFrame) -> DataFrame:
    """Display projection of ``top_products``: ordered, renamed, revenue as ``$1,234``."""
    cols = []
    for name, header in TABLE_HEADERS:
        c = format_money(name, 0) if name == "total_revenue" else F.col(name)
        cols.append(c.alias(header))
    return top.select(*cols)
