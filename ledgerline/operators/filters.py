"""Dashboard filters.

Predicates are plain column comparisons against typed literals, so Catalyst
pushes them into the Parquet scan (``PushedFilters``) or below the joins of
the adapters.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "All"
# The dashboard's reset state.
DEFAULT_START = _dt.date(2023, 1, 1)
DEFAULT_END = _dt.date(2024, 12, 31)


def parse_day(value: str | _dt.date | _dt.datetime | None) -> _dt.date | None:
    """Accept a date, a datetime or ``YYYY-MM-DD[...]`` text; empty -> None.

    Malformed text raises ``ValueError`` here, before any Spark job runs.
    """
    if value is None or value == "":
        return None
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    text = str(value).strip()
    try:
        return _dt.date.fromisoformat(text[:10])
    except ValueError as err:
        raise ValueError(f"not a date: {value!r}") from err


def _active(choice: str | None) -> bool:
    return bool(choice) and choice != ALL


@dataclass(frozen=True)
class Filters:
    """Filter state; every part optional.  ``Filters()`` filters nothing."""

    start_date: str | _dt.date | None = None
    end_date: str | _dt.date | None = None
    region: str | None = None
    category: str | None = None
    end_day_inclusive: bool = False

    @classmethod
    def dashboard_defaults(cls) -> Filters:
        """The reset state: all regions, all categories, 2023-01-01 .. 2024-12-31."""
        return cls(DEFAULT_START, DEFAULT_END, ALL, ALL)

    def apply(self, txn: DataFrame, sess: DataFrame) -> tuple[DataFrame, DataFrame]:
        return apply_filters(txn, sess, self.start_date, self.end_date, self.region,
                             self.category, end_day_inclusive=self.end_day_inclusive)


def _where(df: DataFrame, conditions: list[Column]) -> DataFrame:
    """Apply all conditions as one conjunctive filter (one plan node, one analysis)."""
    if not conditions:
        return df
    return df.filter(reduce(lambda a, b: a & b, conditions))


def filter_transactions(txn: DataFrame, start_date=None, end_date=None,
                        region: str | None = None, category: str | None = None) -> DataFrame:
    """Inclusive date range on ``date``, region and category equality."""
    start, end = parse_day(start_date), parse_day(end_date)
    conditions = []
    if start is not None:
        conditions.append(F.col("date") >= F.lit(start))
    if end is not None:
        conditions.append(F.col("date") <= F.lit(end))
    if _active(region):
        conditions.append(F.col("region") == F.lit(region))
    if _active(category):
        conditions.append(F.col("category") == F.lit(category))
    return _where(txn, conditions)


def filter_sessions(sess: DataFrame, start_date=None, end_date=None,
                    region: str | None = None, end_day_inclusive: bool = False) -> DataFrame:
    """Date range on ``timestamp`` and region equality (no category on sessions).

    As in the reference, the end bound compares with *midnight* of the end
    day, so later sessions of that day are dropped; ``end_day_inclusive``
    keeps the whole day instead (``timestamp < end + 1 day``).
    """
    start, end = parse_day(start_date), parse_day(end_date)
    ts = F.col("timestamp")
    conditions = []
    if start is not None:
        conditions.append(ts >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        if end_day_inclusive:
            conditions.append(ts < F.lit(end + _dt.timedelta(days=1)).cast("timestamp_ntz"))
        else:
            conditions.append(ts <= F.lit(end).cast("timestamp_ntz"))
    if _active(region):
        conditions.append(F.col("region") == F.lit(region))
    return _where(sess, conditions)


def apply_filters(txn: DataFrame, sess: DataFrame, start_date=None, end_date=None,
                  region: str | None = None, category: str | None = None,
                  end_day_inclusive: bool = False) -> tuple[DataFrame, DataFrame]:
    """Apply the shared filter state to transactions and sessions.

    ``All``, empty text and None mean "no filter".  Category applies to
    transactions only.
    """
    return (filter_transactions(txn, start_date, end_date, region, category),
            filter_sessions(sess, start_date, end_date, region, end_day_inclusive))
