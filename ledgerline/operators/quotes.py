"""Quote analytics: latest row per symbol, price history, top assets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.expressions import direction, format_money, format_percent
from ledgerline.sources.schemas import QUOTE_COLUMNS

HISTORY_COLUMNS = ("symbol", "timestamp", "priceUsd")


def latest_snapshot(quotes: DataFrame) -> DataFrame:
    """Most recent row per symbol, largest market cap first (NULL cap last).

    Ties on the timestamp are broken by ``id`` then ``priceUsd`` so the
    result is deterministic.  ``row_number() == 1`` per symbol is planned
    as a partial ``WindowGroupLimit`` before the shuffle, so a symbol holding
    a third of all rows sends one row per task, not all of its rows.
    """
    order = Window.partitionBy("symbol").orderBy(
        F.desc_nulls_last("timestamp"), F.asc_nulls_last("id"), F.desc_nulls_last("priceUsd"))
    return (quotes.withColumn("_rn", F.row_number().over(order))
            .filter(F.col("_rn") == 1)
            .select(*QUOTE_COLUMNS)
            .orderBy(F.desc_nulls_last("marketCapUsd"), F.asc_nulls_last("symbol")))


def price_history(quotes: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """``(symbol, timestamp, priceUsd)`` ordered by time; optional symbol list.

    None or an empty list means every symbol.
    """
    df = quotes
    if symbols:
        df = df.filter(F.col("symbol").isin(list(symbols)))
    return df.select(*HISTORY_COLUMNS).orderBy("timestamp", "symbol")


def top_assets(snapshot: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest assets of a snapshot (``TakeOrderedAndProject``)."""
    return snapshot.orderBy(F.desc_nulls_last("marketCapUsd"), F.asc_nulls_last("symbol")).limit(k)


def history_of_top(history: DataFrame, snapshot: DataFrame, k: int = 5) -> DataFrame:
    """Price history restricted to the ``k`` largest assets of the snapshot.

    The right side is a limit, so its statistics are small and Spark's own
    size-checked broadcast applies; the semi join never multiplies history
    rows.
    """
    top = top_assets(snapshot, k).select("symbol")
    return (history.join(top, "symbol", "left_semi")
            .select(*HISTORY_COLUMNS).orderBy("timestamp", "symbol"))


def asset_cards(snapshot: DataFrame, k: int = 4) -> DataFrame:
    """KPI cards for the ``k`` largest assets: price ``$1,234.56``, signed change."""
    return top_assets(snapshot, k).select(
        "symbol",
        format_money("priceUsd", 2).alias("price_text"),
        format_percent("changePercent24Hr", 2, signed=True).alias("change_text"),
        direction("changePercent24Hr").alias("direction"))
