"""Seeded synthetic retail tables built as ``spark.range`` jobs.

Every value is a pure function of ``(row id, seed, column stream)``: a
uniform draw is ``u = (pmod(xxhash64(id, seed, stream), 2^53) + 0.5) / 2^53``.
The output therefore does not depend on the number of partitions or on task
retries, and generation scales out like any other map-only job.  Exact numpy
values of the reference are not reproduced; the distributions are.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType

from ledgerline.functions.expressions import (
    line_revenue,
    stock_health,
    weekday_name,
)
from ledgerline.sources.schemas import DEVICES, MONEY, PERCENT

# Fixed values that must match the reference generator.
REGIONS = ("North America", "Europe", "Asia-Pacific", "Latin America", "Middle East")
REGION_WEIGHTS = (0.35, 0.25, 0.25, 0.10, 0.05)
CATEGORIES = ("Electronics", "Apparel", "Home & Kitchen", "Sports", "Beauty", "Books", "Toys")
DEVICE_WEIGHTS = (0.45, 0.40, 0.15)
CONVERTED_WEIGHTS = (0.82, 0.18)  # for 0, 1
N_TRANSACTIONS = 50_000
N_SESSIONS = 80_000
N_PRODUCTS = 500
N_CUSTOMERS = 10_000
N_USERS = 10_000
SPAN_START = _dt.datetime(2023, 1, 1)
SPAN_END = _dt.datetime(2024, 12, 31)
DEFAULT_SEED = 42

# Word lists for supplier names (our own choice; any company-like names do).
_SURNAMES = ("Adams", "Baker", "Carter", "Dawson", "Ellis", "Foster", "Garcia", "Hayes",
             "Irwin", "Jensen", "Keller", "Lopez", "Morgan", "Nolan", "Owens", "Parker",
             "Quinn", "Reed", "Shaw", "Turner", "Vance", "Walsh", "Young", "Zimmer")
_SUFFIXES = ("Inc", "LLC", "Group", "Ltd", "PLC", "and Sons")

_TWO_53 = float(2 ** 53)


def uniform(seed: int, stream: int, id_col: str = "id") -> Column:
    """U(0,1) draw that depends only on (id, seed, stream)."""
    h = F.xxhash64(F.col(id_col), F.lit(seed), F.lit(stream))
    return (F.pmod(h, F.lit(2 ** 53)).cast("double") + F.lit(0.5)) / F.lit(_TWO_53)


def normal(seed: int, stream: int) -> Column:
    """Standard normal draw (Box-Muller on two uniform streams)."""
    u1, u2 = uniform(seed, stream), uniform(seed, stream + 1)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def lognormal(seed: int, stream: int, mu: float, sigma: float) -> Column:
    return F.exp(F.lit(mu) + F.lit(sigma) * normal(seed, stream))


def gamma_int(seed: int, first_stream: int, shape: int) -> Column:
    """Gamma(shape, 1) for an integer shape: sum of ``shape`` exponentials."""
    total = None
    for i in range(shape):
        term = -F.log(uniform(seed, first_stream + i))
        total = term if total is None else total + term
    return total


def beta_int(seed: int, first_stream: int, a: int, b: int) -> Column:
    """Beta(a, b) for integer shapes as X / (X + Y) with X~Gamma(a), Y~Gamma(b)."""
    x = gamma_int(seed, first_stream, a)
    y = gamma_int(seed, first_stream + a, b)
    return x / (x + y)


def weighted_choice(u: Column, values, weights) -> Column:
    """Pick ``values[i]`` with probability ``weights[i]`` (cumulative thresholds)."""
    expr = F.lit(values[-1])
    cum = 0.0
    bounds = []
    for v, w in zip(values[:-1], weights[:-1]):
        cum += w
        bounds.append((v, cum))
    for v, bound in reversed(bounds):
        expr = F.when(u < F.lit(bound), F.lit(v)).otherwise(expr)
    return expr


def uniform_choice(u: Column, values) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(u * F.lit(len(values))) + 1).cast(IntegerType()))


def uniform_int(u: Column, low: int, high_exclusive: int) -> Column:
    return (F.lit(low) + F.floor(u * F.lit(high_exclusive - low))).cast(IntegerType())


def even_instants(n: int, start: _dt.datetime = SPAN_START, end: _dt.datetime = SPAN_END) -> Column:
    """``n`` evenly spaced instants from ``start`` to ``end`` inclusive (wall clock)."""
    start_us = int((start - _dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    span_us = int((end - start).total_seconds()) * 1_000_000
    step = span_us / (n - 1) if n > 1 else 0.0
    micros = F.lit(start_us) + F.floor(F.col("id").cast("double") * F.lit(step)).cast("long")
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def padded(prefix: str, width: int, number: Column) -> Column:
    return F.format_string(f"{prefix}%0{width}d", number.cast("long"))


def _company(seed: int, stream: int) -> Column:
    pick = lambda s: uniform_choice(uniform(seed, s), _SURNAMES)
    form = uniform(seed, stream)
    suffix = uniform_choice(uniform(seed, stream + 1), _SUFFIXES)
    a, b, c = pick(stream + 2), pick(stream + 3), pick(stream + 4)
    return (F.when(form < 0.5, F.concat_ws(" ", a, suffix))
            .when(form < 0.8, F.concat_ws("-", a, b))
            .otherwise(F.concat(a, F.lit(", "), b, F.lit(" and "), c)))


def transactions(spark: SparkSession, n: int = N_TRANSACTIONS, seed: int = DEFAULT_SEED,
                 num_partitions: int | None = None) -> DataFrame:
    """Transactions (G1): one row per sale, dates evenly spread over 2023-2024."""
    base = spark.range(0, n, 1, num_partitions)
    date = F.to_date(even_instants(n))
    price = F.round(lognormal(seed, 10, 3.5, 0.8).cast(DecimalType(38, 10)), 2).cast(MONEY)
    discount = F.round((beta_int(seed, 20, 2, 8) * F.lit(40.0)).cast(DecimalType(38, 10)), 1).cast(PERCENT)
    out = base.select(
        padded("TXN-", 7, F.col("id")).alias("transaction_id"),
        date.alias("date"),
        weighted_choice(uniform(seed, 1), REGIONS, REGION_WEIGHTS).alias("region"),
        uniform_choice(uniform(seed, 2), CATEGORIES).alias("category"),
        padded("PROD-", 4, uniform_int(uniform(seed, 3), 1, N_PRODUCTS + 1)).alias("product_id"),
        uniform_int(uniform(seed, 4), 1, 15).alias("units"),
        price.alias("unit_price"),
        discount.alias("discount_pct"),
        padded("CUST-", 6, uniform_int(uniform(seed, 5), 1, N_CUSTOMERS + 1)).alias("customer_id"),
    )
    return out.withColumn("revenue", line_revenue("units", "unit_price", "discount_pct", "date"))


def sessions(spark: SparkSession, n: int = N_SESSIONS, seed: int = DEFAULT_SEED,
             num_partitions: int | None = None) -> DataFrame:
    """Sessions (G2): evenly spaced timestamps, weighted device/conversion/region."""
    base = spark.range(0, n, 1, num_partitions)
    ts = even_instants(n)
    duration = F.greatest(F.lit(5), F.least(
        F.lit(1800), (F.lit(-180.0) * F.log(uniform(seed, 105))).cast(IntegerType())))
    return base.select(
        padded("SESS-", 8, F.col("id")).alias("session_id"),
        ts.alias("timestamp"),
        padded("USR-", 6, uniform_int(uniform(seed, 101), 1, N_USERS + 1)).alias("user_id"),
        weighted_choice(uniform(seed, 102), DEVICES, DEVICE_WEIGHTS).alias("device"),
        uniform_int(uniform(seed, 103), 1, 20).alias("page_views"),
        duration.cast(IntegerType()).alias("session_duration_s"),
        weighted_choice(uniform(seed, 104), (0, 1), CONVERTED_WEIGHTS).cast(IntegerType()).alias("converted"),
        weighted_choice(uniform(seed, 106), REGIONS, REGION_WEIGHTS).alias("region"),
        F.hour(ts).alias("hour"),
        weekday_name(ts).alias("day_of_week"),
    )


def inventory(spark: SparkSession, n_products: int = N_PRODUCTS, seed: int = DEFAULT_SEED,
              num_partitions: int | None = None) -> DataFrame:
    """Inventory (G3): one row per product ``PROD-0001`` ... ``PROD-<n>``."""
    base = spark.range(1, n_products + 1, 1, num_partitions)
    stock = uniform_int(uniform(seed, 201), 0, 500)
    reorder = uniform_int(uniform(seed, 202), 20, 80)
    cost = F.round(lognormal(seed, 203, 3.0, 0.7).cast(DecimalType(38, 10)), 2).cast(MONEY)
    return base.select(
        padded("PROD-", 4, F.col("id")).alias("product_id"),
        uniform_choice(uniform(seed, 200), CATEGORIES).alias("category"),
        stock.alias("stock_units"),
        reorder.alias("reorder_level"),
        cost.alias("unit_cost"),
        _company(seed, 210).alias("supplier"),
        stock_health(stock, reorder).alias("health"),
    )


def generate_all(spark: SparkSession, out_dir: str, force: bool = False, seed: int = DEFAULT_SEED,
                 n_transactions: int = N_TRANSACTIONS, n_sessions: int = N_SESSIONS,
                 n_products: int = N_PRODUCTS) -> dict[str, str]:
    """Write the three tables as one set of CSV folders under ``out_dir`` unless all exist (K4); their folders."""
    from ledgerline.sinks.writers import write_set

    frames = {"transactions": transactions(spark, n_transactions, seed), "sessions": sessions(spark, n_sessions, seed),
              "inventory": inventory(spark, n_products, seed)}
    return write_set(spark, out_dir, frames, force=force, fmt="csv")
