"""Column expressions."""

from ledgerline.functions.expressions import (
    DAY_ORDER,
    decimals_to_double,
    direction,
    format_money,
    format_percent,
    half_up,
    line_revenue,
    mean_of,
    money_total,
    month_key,
    parse_number,
    ratio,
    seasonal_factor,
    stock_health,
    stock_value,
    weekday_index,
    weekday_name,
    with_date_parts,
)

__all__ = [
    "DAY_ORDER", "decimals_to_double", "direction", "format_money", "format_percent",
    "half_up", "line_revenue", "mean_of", "money_total", "month_key", "parse_number",
    "ratio", "seasonal_factor", "stock_health", "stock_value", "weekday_index",
    "weekday_name", "with_date_parts",
]
