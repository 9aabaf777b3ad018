"""Column expressions shared by the operators.

All of them are built-in Spark expressions (JVM side, whole-stage codegen);
none runs Python per row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegralType

from ledgerline.sources.schemas import MONEY

# Fixed values that must match the reference dashboard.
DAY_ORDER = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
HEALTH_OUT = "Out of Stock"
HEALTH_LOW = "Low Stock"
HEALTH_OK = "Healthy"
SEASONAL_FACTORS = {12: Decimal("1.5"), 11: Decimal("1.3")}  # every other month: 1.0

# Ratios are rounded through this decimal so that HALF_UP applies to the
# shortest decimal form of the double (0.125 -> 0.13, -0.125 -> -0.13).
_RATIO_DECIMAL = DecimalType(38, 10)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def half_up(col: Column | str, digits: int) -> Column:
    """Round HALF_UP to ``digits`` places and return a double.

    Decimal input is rounded exactly; double input (a ratio) first goes to
    decimal(38,10), which removes binary noise such as 4.0249999999999995.
    """
    return F.round(_c(col).cast(_RATIO_DECIMAL), digits).cast(DoubleType())



def exact_money(df: DataFrame, name: str) -> Column:
    """A money column as a type whose sums are exact.

    Decimal and integer columns keep their own scale; binary numbers go
    through decimal(38,10).  The declared type decides, never a value.
    """
    kind = df.schema[name].dataType
    exact = F.col(name)
    if isinstance(kind, IntegralType):
        exact = exact.cast(DecimalType(20, 0))
    elif not isinstance(kind, DecimalType):
        exact = exact.cast(_RATIO_DECIMAL)
    return exact


def money_total(df: DataFrame, name: str) -> Column:
    """Exact sum of a money column, rounded once to cents, as decimal(38,2); NULL when there is no value."""
    return F.round(F.sum(exact_money(df, name)), 2).cast(DecimalType(38, 2))


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` in double; NULL when the denominator is 0."""
    return F.try_divide(numerator.cast(DoubleType()), denominator.cast(DoubleType()))


def _q(name: str) -> str:
    """A column name as a quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def mean_of(col: Column | str) -> Column:
    """Average of the non-NULL values as double(sum) / count (NULL when none)."""
    if isinstance(col, str):
        c = _q(col)
        return F.expr(f"try_divide(CAST(sum({c}) AS DOUBLE), CAST(count({c}) AS DOUBLE))")
    return ratio(F.sum(col), F.count(col))


# --- P1-P3: dates -----------------------------------------------------------

def month_key(col: Column | str) -> Column:
    """``yyyy-MM`` text key of a date or timestamp."""
    return F.date_format(_c(col), "yyyy-MM")


def with_date_parts(txn: DataFrame, date_col: str = "date") -> DataFrame:
    """Add ``year_month`` (text), ``month_num`` and ``year``."""
    d = f"`{date_col}`"
    return txn.withColumns({
        "year_month": F.expr(f"date_format({d}, 'yyyy-MM')"),
        "month_num": F.expr(f"month({d})"),
        "year": F.expr(f"year({d})"),
    })


def weekday_name(col: Column | str) -> Column:
    """English day name (``Monday``) of a date or timestamp."""
    return F.date_format(_c(col), "EEEE")


def weekday_index(col: Column | str) -> Column:
    """1 for Monday ... 7 for Sunday."""
    return F.weekday(_c(col)) + F.lit(1)


# --- P6-P9: money ------------------------------------------------------------

def seasonal_factor(date_col: Column | str) -> Column:
    """1.5 in December, 1.3 in November, 1.0 otherwise (decimal(2,1))."""
    m = F.month(_c(date_col))
    expr = F.lit(Decimal("1.0"))
    for month, factor in SEASONAL_FACTORS.items():
        expr = F.when(m == month, F.lit(factor)).otherwise(expr)
    return expr.cast(DecimalType(2, 1))


def line_revenue(units: Column | str, unit_price: Column | str,
                 discount_pct: Column | str, date_col: Column | str) -> Column:
    """round(units x unit_price x (1 - discount_pct/100) x seasonal, 2), exact decimal."""
    gross = _c(units).cast(DecimalType(10, 0)) * _c(unit_price)
    kept = (F.lit(Decimal("100")) - _c(discount_pct)) * F.lit(Decimal("0.01"))
    return F.round(gross * kept * seasonal_factor(date_col), 2).cast(MONEY)


def stock_value(stock_units: Column | str, unit_cost: Column | str) -> Column:
    """round(stock_units x unit_cost, 2) as money."""
    return F.round(_c(stock_units).cast(DecimalType(10, 0)) * _c(unit_cost), 2).cast(MONEY)


def stock_health(stock_units: Column | str, reorder_level: Column | str) -> Column:
    """0 -> Out of Stock; below the reorder level -> Low Stock; else Healthy."""
    s = _c(stock_units)
    return (F.when(s == 0, F.lit(HEALTH_OUT))
            .when(s < _c(reorder_level), F.lit(HEALTH_LOW))
            .when(s.isNotNull() & _c(reorder_level).isNotNull(), F.lit(HEALTH_OK)))


# --- P11: numbers arriving as text ---------------------------------------------

def parse_number(col: Column | str) -> Column:
    """Text -> double; malformed text gives NULL instead of failing the job."""
    return _c(col).try_cast(DoubleType())


# --- P16-P17: display ---------------------------------------------------------

def format_money(col: Column | str, digits: int = 0) -> Column:
    """``$1,234`` / ``$1,234.56``; NULL stays NULL.

    ``format_number`` rounds the binary value HALF_EVEN, as Python's
    ``f"{v:,.0f}"`` does (2.5 -> ``2``).
    """
    c = _c(col)
    return F.when(c.isNotNull(), F.concat(F.lit("$"), F.format_number(c, digits)))


def format_percent(col: Column | str, digits: int = 1, signed: bool = False) -> Column:
    """``12.3%`` or, signed, ``+1.2%`` / ``-0.4%``; NULL stays NULL.

    Rounds like Python's ``f"{v:+.1f}%"`` (HALF_EVEN on the binary value:
    2.25 -> ``+2.2%``).
    """
    c = _c(col)
    digits_text = F.regexp_replace(F.format_number(c, digits), ",", "")
    # The sign comes from the formatted text, so -0.0 prints "-0.0%" as Python does.
    sign = (F.when(digits_text.startswith("-"), F.lit("")).otherwise(F.lit("+"))
            if signed else F.lit(""))
    return F.when(c.isNotNull(), F.concat(sign, digits_text, F.lit("%")))


def direction(col: Column | str) -> Column:
    """``up`` for values >= 0, ``down`` for all others, a missing value included."""
    return F.when(_c(col) >= 0, F.lit("up")).otherwise(F.lit("down"))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Cast every decimal column to double (result tables carry doubles)."""
    return df.selectExpr(*[
        f"CAST({_q(f.name)} AS DOUBLE) AS {_q(f.name)}" if isinstance(f.dataType, DecimalType)
        else _q(f.name)
        for f in df.schema.fields
    ])
