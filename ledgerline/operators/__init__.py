"""Operators: every function maps DataFrames to a lazy DataFrame."""

from ledgerline.operators.filters import ALL, Filters, apply_filters, filter_sessions, filter_transactions
from ledgerline.operators.inventory import health_counts, inventory_value
from ledgerline.operators.metrics import (
    LEVELS,
    at_level,
    filter_domain,
    filter_domains,
    joined_kpis,
    kpi_cards,
    kpi_summary,
    level_kpis,
    monthly_revenue,
    revenue_by,
    revenue_by_category,
    revenue_by_region,
    revenue_levels,
    row_counts,
    with_money_label,
)
from ledgerline.operators.products import (
    discount_vs_revenue,
    product_cells,
    product_totals,
    top_products,
    top_products_from_totals,
    top_products_table,
)
from ledgerline.operators.quotes import (
    asset_cards,
    history_of_top,
    latest_snapshot,
    price_history,
    top_assets,
)
from ledgerline.operators.shares import share_of_total
from ledgerline.operators.trends import (
    activity_heatmap,
    activity_long,
    device_trend,
    mom_growth,
    mom_growth_clean,
    revenue_over_time,
    session_cells,
)

__all__ = [
    "ALL", "Filters", "apply_filters", "filter_sessions", "filter_transactions",
    "health_counts", "inventory_value", "filter_domain", "filter_domains", "kpi_cards", "kpi_summary", "monthly_revenue", "with_money_label",
    "LEVELS", "at_level", "joined_kpis", "level_kpis", "revenue_levels", "product_cells", "session_cells",
    "revenue_by", "revenue_by_category", "revenue_by_region", "row_counts",
    "discount_vs_revenue", "product_totals", "top_products", "top_products_from_totals", "top_products_table",
    "asset_cards", "history_of_top", "latest_snapshot", "price_history", "top_assets",
    "share_of_total", "activity_heatmap", "activity_long", "device_trend", "mom_growth",
    "mom_growth_clean", "revenue_over_time",
]
