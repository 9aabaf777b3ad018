"""Composite views, one per dashboard tab (V1-V4).

A tab is a mapping of names to lazy frames; a frame is built when it is asked
for, and nothing is collected.  All frames of a tab that come from the
transactions start from one aggregate of the filtered lines (the levels of
the overview, the months of the trends, the products of the deep dive), and
those of the sessions from one of the filtered sessions.  ``share`` says how
these bases reach the frames:

* ``False``: as plans; each frame that runs reads the tables once.
* ``True``: persisted (memory, spilling to disk); the caller unpersists the
  frames listed under ``"_shared"`` when done.
* a function ``(frame, name) -> frame`` that stores a frame and reads it back
  (``in_folder``): the lines are read once for the whole tab, the lineage is
  cut, and a lost executor costs only what it was reading.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ledgerline import operators as ops
from ledgerline.operators.filters import Filters
from ledgerline.session import scratch_dir
from ledgerline.sinks.writers import write_parquet

Share = bool | Callable[[DataFrame, str], DataFrame]
SHARED = "_shared"


class Tab(Mapping):
    """Frames by name, each built once, when first asked for.

    ``bases`` are the aggregates that frames start from; they are built once
    too, and go through ``share`` then.
    """

    def __init__(self, share: Share, bases: dict[str, Callable[[], DataFrame]],
                 frames: dict[str, Callable[[Tab], DataFrame]]):
        self._share, self._bases, self._frames = share, bases, frames
        self._made: dict[str, DataFrame] = {}
        self._based: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._based:
            df = self._bases[name]()
            if callable(self._share):
                df = self._share(df, name)
            elif self._share:
                df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._based[name] = df
        return self._based[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name == SHARED:
            return [self.base(b) for b in self._bases] if self._share else []
        if name not in self._made:
            self._made[name] = self._frames[name](self)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter([*self._frames, SHARED])

    def __len__(self) -> int:
        return len(self._frames) + 1


def in_folder(spark: SparkSession) -> Callable[[DataFrame, str], DataFrame]:
    """Stores bases as Parquet in a fresh folder of the cluster's shared scratch space."""
    root = scratch_dir(spark, "tab")

    def store(df: DataFrame, name: str) -> DataFrame:
        return spark.read.schema(df.schema).parquet(write_parquet(df, f"{root}/{name}"))

    return store


def overview(txn: DataFrame, sess: DataFrame, filters: Filters = Filters(), share: Share = False) -> Tab:
    """Overview tab: KPIs, monthly revenue with rolling mean, region and category totals."""
    t, s = filters.apply(txn, sess)

    def level(name: str):
        return lambda tab: ops.at_level(tab.base("levels"), name)

    by_category = level("category")
    return Tab(share, {"levels": lambda: ops.revenue_levels(t)}, {
        "kpis": lambda tab: ops.joined_kpis(ops.level_kpis(tab.base("levels")), s),
        "revenue_over_time": lambda tab: ops.revenue_over_time(level("year_month")(tab)),
        "revenue_by_region": lambda tab: ops.revenue_by_region(level("region")(tab)),
        "revenue_by_category": lambda tab: ops.revenue_by_category(by_category(tab)),
        "category_share": lambda tab: ops.share_of_total(tab["revenue_by_category"], "category", "revenue"),
    })


def trends(txn: DataFrame, sess: DataFrame, filters: Filters = Filters(),
           grain: str = "month", share: Share = False) -> Tab:
    """Trends tab: weekday x hour heatmap, device mix over time, month-over-month growth."""
    t, s = filters.apply(txn, sess)
    bases = {"months": lambda: ops.monthly_revenue(t, with_orders=False),
             "cells": lambda: ops.session_cells(s, grain)}
    return Tab(share, bases, {
        "heatmap": lambda tab: ops.activity_heatmap(tab.base("cells")),
        "device_trend": lambda tab: ops.device_trend(tab.base("cells"), grain=grain),
        "mom_growth": lambda tab: ops.mom_growth(tab.base("months")),
        "mom_growth_bars": lambda tab: ops.mom_growth_clean(tab["mom_growth"]),
    })


def deep_dive(txn: DataFrame, inv: DataFrame, filters: Filters = Filters(), n: int = 10,
              share: Share = False) -> Tab:
    """Deep-dive tab: discount vs revenue, top-N products, inventory health.

    Inventory ignores the filters, as in the reference.
    """
    t = ops.filter_transactions(txn, filters.start_date, filters.end_date,
                                filters.region, filters.category)
    return Tab(share, {"products": lambda: ops.product_cells(t)}, {
        "discount_vs_revenue": lambda tab: ops.discount_vs_revenue(tab.base("products")),
        "top_products": lambda tab: ops.top_products(tab.base("products"), n),
        "top_products_table": lambda tab: ops.top_products_table(tab["top_products"]),
        "inventory": lambda tab: ops.inventory_value(inv),
        "health_counts": lambda tab: ops.health_counts(inv),
        "health_share": lambda tab: ops.share_of_total(tab["health_counts"], "health", "count"),
    })


def quotes_view(quotes: DataFrame, cards: int = 4, bars: int = 10,
                history_top: int = 5, share: Share = False) -> Tab:
    """Quotes tab: latest snapshot, KPI cards, top-N bars, price history of the leaders."""
    return Tab(share, {"snapshot": lambda: ops.latest_snapshot(quotes)}, {
        "snapshot": lambda tab: tab.base("snapshot"),
        "cards": lambda tab: ops.asset_cards(tab.base("snapshot"), cards),
        "market_cap_top": lambda tab: ops.top_assets(tab.base("snapshot"), bars),
        "history": lambda tab: ops.price_history(quotes),
        "history_top": lambda tab: ops.history_of_top(tab["history"], tab.base("snapshot"), history_top),
    })


def is_empty(df: DataFrame) -> bool:
    """Empty-state check for a view (one tiny job); the views themselves never need it."""
    return df.isEmpty()
