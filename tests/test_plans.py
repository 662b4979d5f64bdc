"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_point
from fareloom import operators as ops
from fareloom import plans
from fareloom.fixtures import trips_raw

SF = "/root/testdata/sf0.001"


@pytest.fixture
def raw(spark):
    return trips_raw(spark, SF)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def spark_mode(df):
    return df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")


def scans(df):
    """(pushed filters, columns read) of every scan; the formatted plan does not cut them short."""
    text = df._jdf.queryExecution().explainString(spark_mode(df))
    found = re.findall(r"PushedFilters: \[(.*)\]\nReadSchema: struct<(.*)>", text)
    return [(pushed, set(re.findall(r"(\w+):", schema))) for pushed, schema in found]


def read_columns(df):
    return [columns for _, columns in scans(df)]


def test_rules_reach_the_reader(raw):
    ((pushed, _),) = scans(ops.clean_trips(raw))
    for column in ("tpep_pickup_datetime", "pulocationid", "trip_distance", "fare_amount", "total_amount", "tip_amount"):
        assert column in pushed
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in pushed and "Or(IsNull(fare_amount)" in pushed


def test_cleaning_and_rejects_do_not_shuffle(raw):
    for df in (ops.clean_trips(raw), ops.rejected_trips(raw), plans.trip_measures(raw)):
        assert "Exchange" not in plan(df)


def test_report_reads_only_its_columns(raw):
    df = plans.average_by_payment(plans.trip_measures(raw), plans.build_dim(raw, "dim_payment_type"))
    trips, codes = sorted(read_columns(df), key=len, reverse=True)
    assert codes == {"payment_type"}
    assert not trips & {"vendorid", "passenger_count", "tolls_amount", "ratecodeid", "extra", "airport_fee"}


def test_dimensions_read_one_column(raw):
    wanted = {"dim_vendor": "vendorid", "dim_pickup_location": "pulocationid", "dim_datetime": "tpep_pickup_datetime"}
    for name, column in wanted.items():
        assert read_columns(plans.build_dim(raw, name)) == [{column}]


def test_hour_lookup_is_the_broadcast_side(raw):
    text = plan(plans.build_fact(raw, plans.build_dim(raw, "dim_datetime"), keyed=False))
    assert re.search(r"BroadcastHashJoin \[datetime_hour#\w+\], \[datetime_hour#\w+\], LeftOuter, BuildRight", text)


def test_an_open_window_is_not_forced_to_broadcast(raw):
    import dataclasses

    from fareloom.plans.fact import hours_of_policy

    hours = plans.build_dim(raw, "dim_datetime")
    code = ops.POLICIES["code"]

    def hinted(policy):
        return "ResolvedHint" in hours_of_policy(hours, policy)._jdf.queryExecution().analyzed().toString()

    assert hinted(code)
    assert hinted(ops.POLICIES["documented"])
    assert not hinted(dataclasses.replace(code, pickup_before=None))


def test_no_trip_sized_input_meets_a_single_task(raw):
    """Single-task exchanges may carry partial aggregates, distinct hours or a limit's rows, never trips."""
    fact = plans.build_fact(raw, plans.build_dim(raw, "dim_datetime"))
    for df in (fact, plans.month_audit(raw), plans.reject_reasons(raw, "documented"), ops.clean_trips(raw, "documented")):
        for below in re.findall(r"Exchange SinglePartition.*\n(.*)", plan(df)):
            assert re.search(r"HashAggregate", below), below


def test_head_of_the_trips_is_a_top_k(raw):
    text = plan(plans.earliest_trips(raw, plans.build_dim(raw, "dim_datetime"), 20))
    assert "TakeOrderedAndProject" in text


def test_duplicate_removal_hashes_and_merges_before_the_shuffle(raw):
    for df in (ops.clean_trips(raw, "documented"), plans.month_audit(raw, "documented"), ops.rejected_trips(raw, "documented")):
        text = plan(df)
        assert "SortAggregate" not in text and text.count("HashAggregate") >= 2


def test_no_plan_uses_a_cross_join_or_python(spark):
    lazy = ["avg_fare_by_payment", "fact_trips", "fk_orphans", "table_counts", "trip_detail_top20", "month_audit_documented"]
    for name in lazy:
        text = plan(entry_point.queries()[name](spark, SF))
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
            assert word not in text, name


def test_rejects_take_one_scan(raw):
    for df in (
        ops.rejected_trips(raw),
        ops.rejected_trips(raw, "documented"),
        plans.reject_reasons(raw),
        plans.reject_reasons(raw, "documented"),
    ):
        assert plan(df).count("FileScan parquet") == 1


def test_expectations_are_lazy(raw):
    """Building them runs no job; a dimension's check reads its key alone."""
    tracker = raw.sparkSession.sparkContext.statusTracker()
    dims = plans.build_dims(raw)
    raw.sparkSession.sparkContext.setJobGroup("expectations", "expectations")
    checks = ops.expectations(raw, dims)
    assert tracker.getJobIdsForGroup("expectations") == []
    assert checks.where("NOT passed").isEmpty() and checks.count() == 15
    missing = ops.expectations(raw.drop("_month_key").where("false"), {n: d for n, d in dims.items() if n != "dim_vendor"})
    failed = {(r["check_name"], r["table_name"]) for r in missing.where("NOT passed").collect()}
    assert failed == {("has_rows", "raw"), ("has_column__month_key", "raw"), ("is_present", "dim_vendor")}
