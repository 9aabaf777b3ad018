"""Share of total (A11): the "percent" of the dashboard's donut charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerline.functions.expressions import half_up


def share_of_total(grouped: DataFrame, label: str, value: str, digits: int = 2) -> DataFrame:
    """``(label, value, share_pct)`` with share_pct = 100 x value / sum(value).

    ``grouped`` must already be aggregated (one row per label); the total is
    a window over all of its rows, which runs in one task and is therefore
    never used on raw rows.  The sum is taken on the exact value (decimal or
    integer) before the division, and ``value`` keeps its type.
    """
    total = F.sum(F.col(value)).over(Window.partitionBy())
    share = F.try_divide(F.col(value).cast(DoubleType()), total.cast(DoubleType()))
    return grouped.select(
        F.col(label), F.col(value),
        half_up(share * F.lit(100.0), digits).alias("share_pct"))
