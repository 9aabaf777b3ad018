"""Inventory value and health."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.expressions import stock_health, stock_value


def inventory_value(inv: DataFrame) -> DataFrame:
    """Inventory rows with ``stock_value`` (stock x unit cost, cents), by stock ascending.

    ``health`` is (re)computed from stock and reorder level when absent.
    """
    out = inv.withColumn("stock_value", stock_value("stock_units", "unit_cost"))
    if "health" not in inv.columns:
        out = out.withColumn("health", stock_health("stock_units", "reorder_level"))
    return out.orderBy("stock_units", "product_id")


def health_counts(inv: DataFrame) -> DataFrame:
    """Products per health state, most frequent first; missing states dropped."""
    return (inv.dropna(subset=["health"])
            .groupBy("health").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "health"))
