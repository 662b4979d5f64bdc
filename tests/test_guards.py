"""Loads that must not replace what is there, and reports whose inputs break their rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from fareloom import operators as ops
from fareloom import plans
from fareloom.fixtures import trips_raw
from fareloom.schemas import FACT_TRIPS
from fareloom.sinks import write_raw
from fareloom.sources import query_tables, read_raw, read_star
from fareloom.sources.storage import Overtaken, current, publish
from tests.trips import trip, trips

SF = "/root/testdata/sf0.001"


@pytest.fixture
def star(spark):
    raw = trips_raw(spark, SF)
    dims = plans.build_dims(raw)
    return {**dims, "fact_trips": plans.build_fact(raw, dims["dim_datetime"])}


def test_empty_and_repeated_members_stop_a_refresh(spark, tmp_path):
    base = str(tmp_path / "star")
    plans.refresh_star(trips_raw(spark, SF), base)
    before = current(spark, base)
    with pytest.raises(ValueError, match="no members"):
        plans.refresh_star(trips(spark, []), base)
    with pytest.raises(ValueError, match="repeated"):
        plans.refresh_star(trips_raw(spark, SF).withColumn("vendorid", F.expr("IF(vendorid = 3, -1L, vendorid)")), base)
    assert current(spark, base) == before and read_star(spark, base)["fact_trips"].count() == 4521


def test_a_load_that_lost_a_month_is_refused(spark, tmp_path):
    raw, folder, base = trips_raw(spark, SF), str(tmp_path / "in"), str(tmp_path / "raw")
    for m in (1, 2):
        raw.where(f"_month_key = 'month_{m:02d}'").drop("_month_key").write.parquet(f"{folder}{m}/trips_2025-{m:02d}.parquet")
    both = folder + "{month}/trips_{year}-{month:02d}.parquet"
    _, report = plans.land_raw(spark, both, 2025, base, months=range(1, 4))
    rows = read_raw(spark, base).count()
    counts = {r["month"]: (r["status"], r["row_count"]) for r in report.collect()}
    per_month = {m: raw.where(f"_month_key = 'month_{m:02d}'").count() for m in (1, 2)}
    assert counts == {1: ("loaded", per_month[1]), 2: ("loaded", per_month[2]), 3: ("skipped", None)}
    one = folder + "1/trips_{year}-{month:02d}.parquet"
    with pytest.raises(ValueError, match="month_02"):
        plans.land_raw(spark, one, 2025, base)
    assert read_raw(spark, base).count() == rows
    plans.land_raw(spark, one, 2025, base, drop_months=True)
    assert 0 < read_raw(spark, base).count() < rows


def test_a_load_that_began_first_does_not_publish_last(spark, tmp_path):
    base = str(tmp_path / "raw")
    began, manifest = current(spark, base)
    write_raw(trips(spark, [trip()]), base)
    now = current(spark, base)
    with pytest.raises(Overtaken, match="published while"):
        publish(spark, base, began, manifest)
    assert current(spark, base) == now


def test_detail_has_n_rows_whatever_the_members(spark, star):
    repeated = {**star, "dim_vendor": star["dim_vendor"].union(star["dim_vendor"].where("vendor_key = -1"))}
    first = star["fact_trips"].orderBy("trip_id").first()
    lacking = {**star, "dim_vendor": star["dim_vendor"].where(f"vendor_key <> {first['vendor_key']}")}
    for dims in (repeated, lacking):
        ids = [r.trip_id for r in plans.trip_detail(star["fact_trips"], dims).collect()]
        assert len(ids) == 20 and ids == sorted(ids)
    assert len(plans.trip_detail(star["fact_trips"], star, 7).collect()) == 7


def test_checks_name_what_is_wrong(spark, star):
    keys = star["dim_vendor"]
    broken = keys.union(keys.where("vendor_key = 2")).union(spark.createDataFrame([(None, "x")], keys.schema))
    rows = {r["table_name"]: tuple(r)[1:] for r in ops.star_checks({**star, "dim_vendor": broken}).collect()}
    assert rows["dim_vendor"] == (7, 1, 1, 0) and len(rows) == 5
    lacking = ops.star_checks({**star, "dim_vendor": keys.where("vendor_key <> 2")}).where("table_name = 'dim_vendor'").first()
    assert lacking["members"] == 6 and lacking["orphan_rows"] == star["fact_trips"].where("vendor_key = 2").count() > 0
    empty = ops.star_checks({**star, "dim_vendor": keys.where("false")}).where("table_name = 'dim_vendor'").first()
    assert empty["members"] == 0


def test_orphans_of_an_empty_fact_are_five_zeros(spark, star):
    empty = spark.createDataFrame([], FACT_TRIPS)
    assert sorted(r["orphan_rows"] for r in ops.fk_orphans(empty, star).collect()) == [0] * 5


def test_means_on_the_stored_star_round_once(spark, star):
    amounts = spark.range(2_000_000).selectExpr(
        "1 AS payment_type_key", "IF(id < 999999, 0.01D, 0D) AS fare_amount", "0D AS tip_amount"
    )
    dim = star["dim_payment_type"]
    found = query_tables(spark, entry_point.PAYMENT_SQL, fact_trips=amounts, dim_payment_type=dim).first()
    report = plans.average_by_payment(amounts, dim).first()
    assert found["avg_fare"] == report["avg_fare"] == 0.0 and found["trips"] == report["trips"] == 2_000_000
