from __future__ import annotations

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from fareloom.functions import elapsed_micros, hour_floor, round_cents, rounded_int
from fareloom.operators.lookups import datetime_dimension
from pyspark.sql.types import DoubleType, LongType


def by_decimals(x: float) -> float:
    tenth_digit = Decimal(repr(x)).quantize(Decimal("1e-10"), ROUND_HALF_UP)
    return float(tenth_digit.quantize(Decimal("0.01"), ROUND_HALF_UP)) + 0.0


def test_round_cents_equals_decimal_rounding(spark):
    rng = random.Random(7)
    xs = [0.0, -0.001, 0.005, -0.005, 1.005, 2.675, 1.0049996, 24.694999999999997, 24.695000000000004, -5.125, 499.999]
    xs += [rng.uniform(-1000, 1000) for _ in range(3000)]
    xs += [rng.randrange(-(10**7), 10**7) / 1000 for _ in range(3000)]  # every tenth one is a tie
    xs += [n / 500.0 for n in range(0, 30000, 7)]
    xs += [rng.uniform(1e8, 1e13) for _ in range(500)]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").selectExpr("x", f"{round_cents('x')} AS r").collect()
    assert [(r.x, r.r) for r in rows] == [(x, by_decimals(x)) for x in xs]
    assert not any(str(r.r) == "-0.0" for r in rows)


def test_round_cents_outside_decimals(spark):
    rows = spark.createDataFrame([(1e300,), (-1e300,), (None,)], "x double").selectExpr(f"{round_cents('x')} AS r")
    assert [r.r for r in rows.collect()] == [1e300, -1e300, None]


def test_rounded_int(spark):
    df = spark.createDataFrame([(0.5, 1), (1.5, 2), (2.5, 3), (-0.5, 4), (-1.5, 5)], "x double, n bigint")
    x, n = rounded_int("x", DoubleType()), rounded_int("n", LongType())
    assert [tuple(r) for r in df.selectExpr(x, n).collect()] == [(0, 1), (2, 2), (2, 3), (0, 4), (-2, 5)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_ignore_the_session_zone(spark, conf, zone):
    """The clock skips 02:00 to 03:00 in New York on this day; half-hour zones shift truncated hours."""
    conf("spark.sql.session.timeZone", zone)
    a, b = dt.datetime(2025, 3, 9, 1, 30, 0, 123456), dt.datetime(2025, 3, 9, 2, 30)
    df = spark.createDataFrame([(a, b), (b, a), (dt.datetime(1950, 3, 9, 2, 10, 0, 5), b)], "a timestamp_ntz, b timestamp_ntz")
    rows = df.selectExpr(f"{hour_floor('a')} AS h", f"{elapsed_micros('a', 'b')} AS us").collect()
    assert [r.h for r in rows] == [dt.datetime(2025, 3, 9, 1), dt.datetime(2025, 3, 9, 2), dt.datetime(1950, 3, 9, 2)]
    assert [r.us for r in rows[:2]] == [3599876544, -3599876544]
    hours = {r.datetime_key: (r.datetime_hour, r.hour, r.weekday, r.is_weekend) for r in datetime_dimension(df, "a").collect()}
    assert hours[2] == (dt.datetime(2025, 3, 9, 1), 1, "Sunday", True)
    assert hours[3] == (dt.datetime(2025, 3, 9, 2), 2, "Sunday", True)
