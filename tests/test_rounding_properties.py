"""Property tests: rounding, display formatting, money formulas and date filters against plain Python rules."""

import datetime
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.functions.expressions import format_money, format_percent, half_up

FLOATS = st.floats(min_value=-1e9, max_value=1e9, allow_nan=False, allow_infinity=False)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
# Always included: signed zero, exact binary ties, near-ties and large values.
EDGES = [0.0, -0.0, 0.5, -0.5, 2.5, 0.125, -0.125, 2.675, 1234.5, -1234.5, 0.045, 999999999.5,
         -0.04, 0.005, 4.0249999999999995]


def _documented_half_up(x: float, digits: int) -> float:
    """HALF_UP of the shortest decimal form at 10 places, then at ``digits`` places."""
    ten = Decimal(repr(x)).quantize(Decimal(1).scaleb(-10), rounding=ROUND_HALF_UP)
    return float(ten.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


@SETTINGS
@given(values=st.lists(FLOATS, min_size=50, max_size=200), digits=st.sampled_from([0, 1, 2]))
def test_half_up_follows_documented_rule(spark, values, digits):
    values = EDGES + values
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r.r for r in df.select(half_up("x", digits).alias("r")).collect()]
    assert got == [_documented_half_up(v, digits) for v in values]


@SETTINGS
@given(values=st.lists(FLOATS, min_size=50, max_size=200))
def test_display_strings_match_python_fstrings(spark, values):
    values = EDGES + values
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select(format_money("x", 0).alias("m0"), format_money("x", 2).alias("m2"),
                     format_percent("x", 1, signed=True).alias("p1"),
                     format_percent("x", 2, signed=True).alias("p2")).collect()
    for v, r in zip(values, rows):
        assert r.m0 == f"${v:,.0f}", v
        assert r.m2 == f"${v:,.2f}", v
        assert r.p1 == f"{v:+.1f}%", v
        assert r.p2 == f"{v:+.2f}%", v


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(1, 14),
                               st.integers(1, 10**7),          # unit price in cents
                               st.integers(0, 400),            # discount in tenths of a percent
                               st.integers(1, 12)),            # month
                     min_size=50, max_size=200))
def test_line_revenue_matches_decimal_formula(spark, rows):
    import datetime as dt
    from ledgerline.functions.expressions import line_revenue
    data = [(u, Decimal(p) / 100, Decimal(d) / 10, dt.date(2024, m, 15)) for u, p, d, m in rows]
    df = spark.createDataFrame(data, "units int, price decimal(18,2), disc decimal(5,1), d date")
    got = [r.rev for r in df.select(line_revenue("units", "price", "disc", "d").alias("rev")).collect()]
    factor = {12: Decimal("1.5"), 11: Decimal("1.3")}
    want = [(u * p * (1 - d / 100) * factor.get(day.month, Decimal("1.0"))).quantize(
        Decimal("0.01"), rounding=ROUND_HALF_UP) for u, p, d, day in data]
    assert got == want


@SETTINGS
@given(stamps=st.lists(st.datetimes(min_value=datetime.datetime(2024, 6, 27),
                                    max_value=datetime.datetime(2024, 7, 3)),
                       min_size=30, max_size=120),
       inclusive=st.booleans())
def test_session_date_filter_matches_rule(spark, stamps, inclusive):
    import datetime as dt
    from ledgerline.operators.filters import filter_sessions
    start, end = dt.date(2024, 6, 28), dt.date(2024, 7, 1)
    stamps = [s.replace(microsecond=0) for s in stamps] + [dt.datetime(2024, 7, 1), dt.datetime(2024, 6, 28)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "id int, timestamp timestamp_ntz")
    got = sorted(r.id for r in filter_sessions(df, start, end, end_day_inclusive=inclusive).collect())
    lo = dt.datetime(2024, 6, 28)
    hi_ok = (lambda s: s < dt.datetime(2024, 7, 2)) if inclusive else (lambda s: s <= dt.datetime(2024, 7, 1))
    assert got == [i for i, s in enumerate(stamps) if s >= lo and hi_ok(s)]
