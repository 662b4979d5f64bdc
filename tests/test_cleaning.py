"""Cleaning rules on hand-written rows, and the fact columns they lead to."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fareloom.fixtures import trips_raw
from fareloom.operators import clean_trips, rejected_trips
from fareloom.plans import build_dims, build_fact, month_audit, reject_reasons, trip_measures
from tests.trips import BASE, at, trip, trips

START = BASE["tpep_pickup_datetime"]
LONGEST = dt.timedelta(minutes=600)
MICRO = dt.timedelta(microseconds=1)

# (change, kept under "code", kept under "documented")
CASES = {
    "base": ({}, True, True),
    "no pickup": ({"tpep_pickup_datetime": None}, False, False),
    "no dropoff": ({"tpep_dropoff_datetime": None}, False, False),
    "no pickup place": ({"pulocationid": None}, False, False),
    "no dropoff place": ({"dolocationid": None}, False, False),
    "last second of 2024": (at("2024-12-31 23:59:59"), False, True),
    "first second of 2025": (at("2025-01-01 00:00:00"), True, True),
    "dropoff in 2026": (at("2025-12-31 23:59:59", 20 + 1 / 60), True, False),
    "pickup in 2026": (at("2026-01-01 00:00:00"), False, False),
    "before 2015": (at("2014-12-31 23:59:59"), False, False),
    "dropoff a second early": ({"tpep_dropoff_datetime": START - dt.timedelta(seconds=1)}, False, False),
    "no time passed": ({"tpep_dropoff_datetime": START}, True, False),
    "600 minutes": ({"tpep_dropoff_datetime": START + LONGEST}, True, False),
    "just under 600 minutes": ({"tpep_dropoff_datetime": START + LONGEST - MICRO}, True, True),
    "just over 600 minutes": ({"tpep_dropoff_datetime": START + LONGEST + MICRO}, False, False),
    "no distance": ({"trip_distance": None}, True, True),
    "500 miles": ({"trip_distance": 500.0}, False, False),
    "just under 500 miles": ({"trip_distance": 499.999}, True, True),
    "negative distance": ({"trip_distance": -0.001}, False, False),
    "negative fare": ({"fare_amount": -0.01}, False, False),
    "negative total": ({"total_amount": -0.01}, False, False),
    "negative tip": ({"tip_amount": -0.01}, False, False),
    "negative tolls": ({"tolls_amount": -5.0}, True, True),
    "no amounts": (dict.fromkeys(["fare_amount", "tip_amount", "tolls_amount", "total_amount"]), True, True),
    "no codes": ({"vendorid": None, "payment_type": None}, True, True),
    "odd codes": ({"vendorid": 7, "payment_type": 0}, True, True),
}


@pytest.mark.parametrize("policy", ["code", "documented"])
def test_each_rule(spark, policy):
    names = list(CASES)
    # extra carries the case number through cleaning
    raw = trips(spark, [trip(**CASES[n][0], extra=float(i)) for i, n in enumerate(names)])
    kept = {names[int(row.extra)] for row in clean_trips(raw, policy).select("extra").collect()}
    wanted = {n for n, (_, code, documented) in CASES.items() if (code if policy == "code" else documented)}
    assert kept == wanted
    rejected = {names[int(row.extra)] for row in rejected_trips(raw, policy).select("extra").collect()}
    assert rejected == set(names) - wanted


def measured(spark, **changes):
    return trip_measures(trips(spark, [trip(**changes)])).first()


def test_base_values(spark):
    row = measured(spark)
    assert (row.trip_distance, row.trip_duration_min, row.fare_amount, row.tip_amount) == (3.46, 15.0, 12.35, 1.01)


def test_rules_judge_unrounded_values(spark):
    assert measured(spark, trip_distance=499.999).trip_distance == 500.0


def test_missing_values(spark):
    row = measured(
        spark, trip_distance=None, fare_amount=None, tip_amount=None, tolls_amount=None, total_amount=None,
        vendorid=None, payment_type=None,
    )
    assert [row.trip_distance, row.fare_amount, row.tip_amount, row.tolls_amount, row.total_amount] == [0.0] * 5
    assert (row.vendor_key, row.payment_type_key) == (-1, -1)


def test_negative_tolls_stay(spark):
    assert measured(spark, tolls_amount=-5.0).tolls_amount == -5.0


@pytest.mark.parametrize(
    ("riders", "stored"), [(None, 1), (0.0, 1), (-3.0, 1), (0.5, 1), (1.5, 2), (2.5, 2), (3.5, 4), (5.0, 5)]
)
def test_passenger_count(spark, riders, stored):
    assert measured(spark, passenger_count=riders).passenger_count == stored


def test_duplicates(spark):
    raw = trips(spark, [trip(), trip()]).unionByName(trips(spark, [trip()], "month_07"))
    assert clean_trips(raw).count() == 3
    assert clean_trips(raw, "documented").count() == 1
    record = rejected_trips(raw, "documented").first()
    assert (record.reject_reason, record.copies) == ("duplicate", 2)
    audit = {r.month_key: (r.raw_rows, r.clean_rows, r.removed_rows) for r in month_audit(raw, "documented").collect()}
    assert audit == {"month_06": (2, 1, 1), "month_07": (1, 0, 1)}


def test_copies_that_differ_only_in_passed_through_columns_are_no_duplicates(spark):
    raw = trips(spark, [trip(extra=1.0), trip(extra=2.0)])
    assert clean_trips(raw, "documented").count() == 2


def test_extra_columns_may_have_any_name(spark):
    raw = trips(spark, [trip(), trip(), trip(fare_amount=-1.0)]).withColumn("cbd fee, v1.2", F.lit(0.75))
    for policy, kept in (("code", 2), ("documented", 1)):
        clean = clean_trips(raw, policy)
        assert clean.columns[-1] == "cbd fee, v1.2"
        fact = build_fact(raw, build_dims(raw)["dim_datetime"], policy)
        assert clean.count() == fact.count() == kept
        assert rejected_trips(raw, policy).agg(F.sum("copies")).first()[0] == 3 - kept
        assert month_audit(raw, policy).first().clean_rows == kept


def test_a_measure_that_no_month_brought(spark):
    raw = trips(spark, [trip(), trip(fare_amount=-1.0)]).drop("tolls_amount", "passenger_count")
    with pytest.raises(AnalysisException):
        trip_measures(raw, "code")
    row = trip_measures(raw, "documented").first()
    assert (row.tolls_amount, row.passenger_count, row.fare_amount) == (0.0, 1, 12.35)
    assert [tuple(r) for r in month_audit(raw, "documented").collect()] == [("month_06", 2, 1, 1)]
    assert reject_reasons(raw, "documented").first().reject_reason == "fare_negative"


def test_a_row_is_blamed_on_the_first_rule_it_breaks(spark):
    raw = trips(spark, [trip(tpep_pickup_datetime=None, fare_amount=-1.0), trip(fare_amount=-1.0, tip_amount=-1.0)])
    found = {r.reject_reason: r.removed_rows for r in reject_reasons(raw).collect()}
    assert found == {"pickup_missing": 1, "fare_negative": 1}


@pytest.mark.parametrize("policy", ["code", "documented"])
def test_clean_and_rejected_add_up_to_raw(spark, policy):
    raw = trips_raw(spark, "/root/testdata/sf0.001")
    removed = rejected_trips(raw, policy).agg(F.sum("copies")).first()[0]
    by_reason = reject_reasons(raw, policy).agg(F.sum("removed_rows")).first()[0]
    by_month = month_audit(raw, policy).agg(F.sum("raw_rows"), F.sum("clean_rows"), F.sum("removed_rows")).first()
    clean = clean_trips(raw, policy).count()
    assert removed == by_reason == by_month[2]
    assert clean == by_month[1]
    assert clean + removed == by_month[0] == raw.count() == 6182
    assert clean == {"code": 4521, "documented": 4237}[policy]


def test_dimensions(spark):
    raw = trips(
        spark,
        [
            trip(**at("2025-01-04 13:10:00"), payment_type=5),
            trip(**at("2025-01-03 13:10:00"), vendorid=7, payment_type=0),
            trip(**at("2019-05-05 05:59:59"), pulocationid=264),
            trip(vendorid=None, payment_type=None, tpep_pickup_datetime=None),
        ],
    )
    dims = build_dims(raw)
    assert {tuple(r) for r in dims["dim_vendor"].collect()} == {
        (-1, "Unknown"),
        (1, "Creative Mobile Technologies"),
        (7, "Vendor 7"),
    }
    assert {tuple(r) for r in dims["dim_payment_type"].collect()} == {
        (-1, "Unknown"),
        (0, "Type 0"),
        (1, "Credit card"),
        (5, "Unknown"),
    }
    assert {tuple(r) for r in dims["dim_pickup_location"].collect()} == {
        (-1, -1, "Unknown"),
        (10, 10, "Zone 10"),
        (264, 264, "Zone 264"),
    }
    hours = {r.datetime_key: r for r in dims["dim_datetime"].collect()}
    assert set(hours) == {-1, 1, 2, 3}
    assert tuple(hours[-1])[1:] == (None, None, None, None, None, "Unknown", False)
    assert hours[1].datetime_hour == dt.datetime(2019, 5, 5, 5)  # an hour no fact has
    assert (hours[2].weekday, hours[2].is_weekend) == ("Friday", False)
    assert (hours[3].weekday, hours[3].is_weekend, hours[3].hour) == ("Saturday", True, 13)


def test_fact_without_its_hour_points_at_the_unknown_member(spark):
    raw = trips(spark, [trip(), trip(**at("2025-01-04 13:10:00"))])
    hours = build_dims(raw)["dim_datetime"].where("datetime_hour < timestamp_ntz'2025-02-01 00:00:00' OR datetime_key = -1")
    keys = {r.pickup_datetime: r.datetime_key for r in build_fact(raw, hours, keyed=False).collect()}
    assert keys == {dt.datetime(2025, 1, 4, 13, 10): 1, START: -1}
