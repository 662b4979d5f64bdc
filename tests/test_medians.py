from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fareloom.operators import impute_upper_median, medians, upper_medians
from fareloom.operators.medians import median_values

TINY = {"slots": 4}


def sorted_pick(values):
    kept = sorted(v for v in values if v is not None and not (isinstance(v, float) and math.isnan(v)))
    return kept[len(kept) // 2]


@pytest.mark.parametrize("limits", [{}, TINY])
@pytest.mark.parametrize(
    ("values", "median"),
    [([1, 2, 3, 4], 3), ([1, 2, 3], 2), ([5], 5), ([1, 1, 2, 9, 9, 10], 9), ([1, None, 3, None], 3)],
)
def test_small_lists(spark, values, median, limits):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    assert upper_medians(df, ["x"], **limits).first().x == median
    filled = [r.x for r in impute_upper_median(df, ["x"], **limits).collect()]
    assert filled == [median if v is None else v for v in values]


def test_no_values_is_an_error(spark):
    df = spark.createDataFrame([(None, 1)], "x int, y int")
    with pytest.raises(ValueError, match="x"):
        upper_medians(df, ["x", "y"])


def test_narrowing_over_unlike_columns(spark):
    rng = random.Random(3)
    rows = [
        (
            rng.gauss(0, 1e6),
            rng.choice([1.5, 1.5, 1.5, 2.5, None]),
            10 ** rng.uniform(-300, 300) * rng.choice([-1, 1]),
            rng.randrange(-(2**31), 2**31),
            rng.randrange(-(2**63), 2**63),
            2**60 + rng.randrange(5000),
            Decimal(rng.randrange(-(10**20), 10**20)).scaleb(-4),
            rng.choice([math.nan, 0.25, -7.0]),
            rng.choice([0.0, math.inf, -math.inf]),
        )
        for _ in range(4001)
    ]
    schema = "a double, b double, c double, d int, e bigint, f bigint, g decimal(30,4), h float, i double"
    df = spark.createDataFrame(rows, schema).repartition(5)
    found = median_values(df, list("abcdefghi"), slots=16)
    assert found == {c: sorted_pick([row[i] for row in rows]) for i, c in enumerate("abcdefghi")}


def test_a_hot_value_needs_no_sorting(spark):
    rows = [(7.0 if i % 3 else float(i),) for i in range(3000)]
    df = spark.createDataFrame(rows, "x double")
    assert median_values(df, ["x"], slots=8)["x"] == 7.0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False) | st.none(), min_size=1, max_size=40).filter(lambda v: any(x is not None for x in v)))
def test_any_doubles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert median_values(df, ["x"], **TINY)["x"] == sorted_pick(values)


def test_imputation_keeps_types_and_other_rows(spark):
    df = spark.createDataFrame([(1.5, None, "p"), (None, 4, "q"), (math.nan, 6, "r"), (9.5, 8, "s")], "x double, n int, t string")
    out = impute_upper_median(df, ["x", "n"])
    assert out.schema.simpleString() == "struct<x:double,n:int>"
    assert [tuple(r) for r in out.collect()] == [(1.5, 6), (9.5, 4), (9.5, 6), (9.5, 8)]


def median_scans(spark, monkeypatch, df, cols, **limits):
    """(medians, how often the input was read): every read comes through one of the two passes."""
    reads = []
    for name in ("outlines", "counted_values"):
        passed = getattr(medians, name)
        monkeypatch.setattr(medians, name, lambda *a, passed=passed, name=name: reads.append(name) or passed(*a))
    return medians.median_values(df, cols, **limits), reads


@pytest.mark.parametrize("spread", ["even", "exponents", "hot", "two"])
def test_the_input_is_read_twice_whatever_its_values(spark, monkeypatch, spread):
    """More rows than the sketch is exact for, so the bracket is a small part of them."""
    value = {
        "even": "rand(1) * 1e6",
        "exponents": "pow(10D, rand(2) * 600 - 300) * IF(rand(3) < 0.5, -1, 1)",
        "hot": "IF(id % 3 = 0, 7D, rand(4) * 20)",
        "two": "IF(id % 2 = 0, -1e308, 1e308)",
    }[spread]
    df = spark.range(0, 60_000, 1, 7).selectExpr(f"CAST({value} AS DOUBLE) AS x", "id * 1000003 % 9007199254740993 AS n")
    found, reads = median_scans(spark, monkeypatch, df, ["x", "n"], slots=8)
    rows = df.collect()
    assert found == {"x": sorted_pick([r.x for r in rows]), "n": sorted_pick([r.n for r in rows])}
    assert reads == ["outlines", "counted_values"]


def test_only_the_bracket_is_kept(spark, monkeypatch):
    kept = []
    stage = medians.stage
    monkeypatch.setattr(medians, "stage", lambda df, label: kept.append(stage(df, label)) or kept[-1])
    counts = []
    found_brackets = medians.brackets_of
    monkeypatch.setattr(medians, "brackets_of", lambda c, *a: counts.append(c.count()) or found_brackets(c, *a))
    df = spark.range(0, 200_000, 1, 7).selectExpr("rand(5) AS x")
    median_values(df, ["x"])
    assert len(kept) == 1 and counts[0] < 200_000 * 20 / medians.ACCURACY


def test_a_sketch_that_misses_costs_a_scan_and_not_the_result(spark, monkeypatch):
    outlines = medians.outlines
    wrong = lambda df, values: {c: medians.Outline(o.rows, 5.0, 6.0) for c, o in outlines(df, values).items()}
    monkeypatch.setattr(medians, "outlines", wrong)
    df = spark.createDataFrame([(float(i), i) for i in range(101)], "x double, n int")
    assert medians.median_values(df, ["x", "n"]) == {"x": 50.0, "n": 50}
