from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareloom.fixtures import trips_raw
from fareloom.operators import dense_key, keys
from fareloom.plans import build_dims, build_fact, earliest_trips
from fareloom.plans.fact import DURATION, TRIP_ORDER
from tests.trips import at, trip, trips


def ids_in_order(df, name, order):
    rows = sorted(df.collect(), key=lambda r: r[name])
    assert [r[name] for r in rows] == list(range(1, len(rows) + 1))
    found = [tuple(r[c] for c in order) for r in rows]
    assert found == sorted(found, key=lambda t: tuple((v is None, v) for v in t))
    return rows


@pytest.fixture
def many_ranges(conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")


def test_dense_key_over_many_ranges(spark, many_ranges):
    df = spark.range(0, 20_000, 1, 6).selectExpr("id", "CASE WHEN id % 50 = 0 THEN NULL ELSE id * 7919 % 1009 END AS a")
    rows = ids_in_order(dense_key(df, ["a", "id"], "k"), "k", ["a", "id"])
    assert len(rows) == 20_000


def test_a_hot_group_of_copies_is_spread(spark, many_ranges, monkeypatch):
    staged = {}

    def keep(df, label):
        staged["table"] = stage(df, label)
        return staged["table"]

    stage = keys.stage
    monkeypatch.setattr(keys, "stage", keep)
    df = spark.range(0, 30_000, 1, 6).selectExpr("CASE WHEN id % 3 = 0 THEN 500 ELSE id % 1000 END AS a")
    ids_in_order(dense_key(df, ["a"], "k"), "k", ["a"])
    sizes = [r["count"] for r in staged["table"].groupBy("_part").count().collect()]
    assert len(sizes) >= 12
    assert max(sizes) < 3 * 30_000 / 16  # the hot group alone is a third of all rows


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.range(0), ["id"], "k").count() == 0


@pytest.mark.parametrize("policy", ["code", "documented"])
def test_numbering_moves_only_what_does_not_follow(spark, many_ranges, monkeypatch, policy):
    """Neither the shuffle nor the staged table holds the duration, the hour key or, in the table, what tells equal trips apart."""
    staged = {}

    def keep(df, label):
        staged["columns"] = df.columns
        staged["plan"] = df._jdf.queryExecution().optimizedPlan().toString()
        return stage(df, label)

    stage = keys.stage
    monkeypatch.setattr(keys, "stage", keep)
    raw = trips(spark, [trip(**at("2025-06-01 10:15:00", m)) for m in (7.125, 0.5, 600, 7.125)] + [trip(trip_distance=1.005)])
    fact = build_fact(raw, build_dims(raw)["dim_datetime"], policy)
    assert staged["columns"] == [*[c for c in TRIP_ORDER if c != DURATION], "_part", "_place"]
    assert "datetime_key" not in staged["plan"] and DURATION not in staged["plan"]
    wanted = [0.5, 7.13, 7.13, 15.0, 600.0] if policy == "code" else [0.5, 7.13, 15.0]
    found = fact.orderBy("trip_id").collect()
    assert [r.trip_duration_min for r in found] == wanted and {r.datetime_key for r in found} == {1}


@pytest.mark.parametrize("policy", ["code", "documented"])
def test_trip_ids(spark, many_ranges, policy):
    raw = trips_raw(spark, "/root/testdata/sf0.001")
    hours = build_dims(raw)["dim_datetime"]
    fact = build_fact(raw, hours, policy)
    rows = ids_in_order(fact, "trip_id", ["pickup_datetime", "dropoff_datetime", "vendor_key"])
    head = earliest_trips(raw, hours, 25, policy).orderBy("trip_id").collect()
    assert head == rows[:25]
    again = {r.trip_id: r for r in build_fact(raw, hours, policy).collect()}
    assert [again[r.trip_id] for r in rows] == rows


def test_equal_trips_after_duplicate_removal_spread(spark, many_ranges):
    """Landed rows that differ only in columns the fact lacks are equal facts, and must still spread."""
    raw = trips(spark, [trip(extra=float(i)) for i in range(4000)])
    fact = build_fact(raw, build_dims(raw)["dim_datetime"], "documented")
    assert fact.agg(F.min("trip_id"), F.max("trip_id"), F.count_distinct("trip_id")).first() == (1, 4000, 4000)
    assert fact.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert fact.first().pickup_datetime == dt.datetime(2025, 6, 1, 10, 15)
