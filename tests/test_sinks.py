from __future__ import annotations

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fareloom.fixtures import trips_raw, trips_view
from fareloom.plans import average_by_payment, build_dims, build_fact, refresh_star, trip_detail
from fareloom.schemas import FACT_TRIPS, STAR
from fareloom.session import shared_dir
from fareloom.sinks import ensure_namespace, write_jdbc, write_raw, write_star
from fareloom.sinks.tables import OPEN_FILES
from fareloom.sources import read_raw, read_star, read_trips
from fareloom.sources.storage import drop_old_versions, published
from tests.trips import at, trip, trips

SF = "/root/testdata/sf0.001"


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    assert a.exceptAll(b.select(*a.columns)).isEmpty() and b.select(*a.columns).exceptAll(a).isEmpty()


def test_raw_is_stored_by_month_and_replaced(spark, tmp_path):
    base = str(tmp_path / "raw")
    raw = trips_raw(spark, SF)
    report = write_raw(raw, base)
    assert [tuple(r) for r in report.collect()] == [("taxi_trips", raw.count())]
    same(read_raw(spark, base, month_key=True), raw)
    assert "_month_key" not in read_raw(spark, base).columns
    months = {p.name for p in (tmp_path / "raw" / "taxi_trips").glob("load=*/_month_key=*")}
    assert months == {f"_month_key=month_{m:02d}" for m in range(1, 13)}

    write_raw(raw, base)  # again: same rows, not twice as many
    same(read_raw(spark, base, month_key=True), raw)
    write_raw(trips(spark, [trip()]), base)
    assert read_raw(spark, base).count() == 1


def test_no_rows_leave_the_raw_table_alone(spark, tmp_path):
    base = str(tmp_path / "raw")
    write_raw(trips(spark, [trip()]), base)
    assert write_raw(trips(spark, []), base).first().row_count == 0
    assert read_raw(spark, base).count() == 1


def test_reading_before_any_publication(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_raw(spark, str(tmp_path / "none"))


def test_files_can_be_kept_small(spark, tmp_path):
    write_raw(trips_raw(spark, SF).coalesce(1), str(tmp_path / "raw"), max_records_per_file=100)
    parts = list(Path(tmp_path).rglob("_month_key=month_01/*.parquet"))
    assert len(parts) >= 5


def staged_tables(spark):
    return {p.name for p in Path(shared_dir(spark)).glob("fareloom-dense-key-*")}


def test_star_refresh(spark, tmp_path):
    staged = staged_tables(spark)
    raw_base, base = str(tmp_path / "raw"), str(tmp_path / "star")
    raw = trips_raw(spark, SF)
    write_raw(raw, raw_base)
    report = {r.table_name: r.row_count for r in refresh_star(read_raw(spark, raw_base), base).collect()}
    tables = read_star(spark, base, views=True)
    assert staged_tables(spark) == staged
    assert list(report) == list(STAR)
    assert report == {name: df.count() for name, df in tables.items()}
    for name, schema in STAR.items():
        assert [(f.name, f.dataType) for f in tables[name].schema] == [(f.name, f.dataType) for f in schema]
    same(tables["fact_trips"], build_fact(raw, build_dims(raw)["dim_datetime"]))
    assert spark.sql("SELECT count(*) AS n FROM fact_trips").first().n == report["fact_trips"] == 4521
    detail = trip_detail(tables["fact_trips"], tables)
    assert [r.trip_id for r in detail.collect()] == list(range(1, 21))
    assert "LessThanOrEqual(trip_id,20)" in detail._jdf.queryExecution().executedPlan().toString()
    by_payment = average_by_payment(tables["fact_trips"], tables["dim_payment_type"])
    assert by_payment.agg(F.sum("trips")).first()[0] == tables["fact_trips"].where("payment_type_key <> -1").count()


def test_a_failed_load_keeps_the_published_star(spark, tmp_path):
    base = str(tmp_path / "star")
    raw = trips(spark, [trip()])
    write_star(spark, base, build_dims(raw), lambda stored: build_fact(raw, stored["dim_datetime"]))
    before, staged = published(spark, base), staged_tables(spark)

    def broken(stored):
        return build_fact(raw, stored["dim_datetime"]).withColumn("vendor_key", F.raise_error(F.lit("lost")).cast("int"))

    with pytest.raises(RuntimeError, match="fact_trips load failed"):
        write_star(spark, base, build_dims(raw), broken)
    with pytest.raises(RuntimeError, match="dim_vendor load failed"):
        lost = build_dims(raw)["dim_vendor"].withColumn("vendor_name", F.raise_error(F.lit("lost")).cast("string"))
        write_star(spark, base, {**build_dims(raw), "dim_vendor": lost}, lambda stored: None)
    assert staged_tables(spark) == staged
    assert published(spark, base) == before
    assert len(list((tmp_path / "star" / "versions").iterdir())) == len(before) == 1
    assert read_star(spark, base)["fact_trips"].count() == 1


def test_old_versions_go_on_request(spark, tmp_path):
    base = str(tmp_path / "raw")
    for n in (1, 2, 3):
        write_raw(trips(spark, [trip()] * n), base)
    old = published(spark, base)[:2]
    assert drop_old_versions(spark, base, keep=1) == old
    assert len(list((tmp_path / "raw" / "taxi_trips").glob("load=*/_month_key=*"))) == 1
    assert read_raw(spark, base).count() == 3
    with pytest.raises(ValueError):
        drop_old_versions(spark, base, keep=0)


def test_fact_layout_follows_pickup_time(spark, tmp_path):
    base = str(tmp_path / "star")
    raw = trips(spark, [trip(**at(f"2025-{m:02d}-{d:02d} 08:00:00")) for m in (3, 1, 2) for d in (9, 2, 5)])
    write_star(spark, base, build_dims(raw), lambda stored: build_fact(raw, stored["dim_datetime"]))
    months = {p.name for p in (tmp_path / "star").rglob("pickup_month=*")}
    assert months == {f"pickup_month=2025-0{m}-01" for m in (1, 2, 3)}
    fact = read_star(spark, base)["fact_trips"]
    assert fact.columns == FACT_TRIPS.fieldNames()
    assert [r.trip_id for r in fact.orderBy("pickup_datetime").collect()] == list(range(1, 10))
    assert fact.where(F.col("pickup_datetime") < dt.datetime(2025, 2, 1)).count() == 3


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_fact_files_are_sorted_and_a_time_range_prunes(spark, conf, tmp_path, zone):
    conf("spark.sql.session.timeZone", zone)
    base = str(tmp_path / "star")
    raw = trips_raw(spark, SF)
    write_star(spark, base, build_dims(raw), lambda stored: build_fact(raw, stored["dim_datetime"]))
    files = list((tmp_path / "star").rglob("pickup_month=*/*.parquet"))
    assert files
    for file in files:
        times = pq.read_table(file, columns=["pickup_datetime"])["pickup_datetime"].to_pylist()
        assert times == sorted(times)

    start, end = dt.datetime(2025, 3, 15, 6), dt.datetime(2025, 5, 1)
    found = read_trips(spark, base, start, end)
    everything = read_star(spark, base)["fact_trips"]
    inside = "pickup_datetime >= timestamp_ntz'2025-03-15 06:00:00' AND pickup_datetime < timestamp_ntz'2025-05-01'"
    same(found, everything.where(inside))
    assert {r[0] for r in found.selectExpr("month(pickup_datetime)").distinct().collect()} == {3, 4}
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_month" in text
    assert read_trips(spark, base, dt.datetime(2025, 12, 31, 12), dt.datetime(2026, 1, 1)).count() > 0


def test_namespace(spark):
    ensure_namespace(spark, "raw")
    ensure_namespace(spark, "raw")
    assert spark.catalog.databaseExists("raw")
    spark.sql("DROP DATABASE raw")


def test_jdbc_needs_its_driver(spark):
    """No database here: this only shows that the writer gets as far as looking for one."""
    with pytest.raises(Exception, match="No suitable driver"):
        write_jdbc(spark.range(1), "jdbc:nosuch:db", "raw.trips", {"user": "u", "password": "p"})


def test_mixed_rows_make_few_files(spark, tmp_path):
    raw = trips_raw(spark, SF).repartition(6)
    write_raw(raw, str(tmp_path / "few"), mixed=True)
    write_raw(raw, str(tmp_path / "many"))
    few, many = (len(list((tmp_path / name).rglob("*.parquet"))) for name in ("few", "many"))
    assert few == 12 < many
    same(read_raw(spark, str(tmp_path / "few")), read_raw(spark, str(tmp_path / "many")))


def test_all_rows_land_whatever_the_number_of_months(spark, tmp_path):
    """A task keeps a file open in each month; beyond OPEN_FILES months the rest is sorted. The option is put back."""
    option = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(option)
    for months in (12, OPEN_FILES + 5):
        raw = spark.range(0, 3_000, 1, 2).selectExpr("id AS vendorid", f"format_string('month_%02d', id % {months}) AS _month_key")
        base = tmp_path / f"raw-{months}"
        write_raw(raw, str(base))
        files = list(base.rglob("*.parquet"))
        assert len(files) == 2 * months and spark.conf.get(option) == before
        same(read_raw(spark, str(base), month_key=True), raw)


def test_the_landing_of_the_trips_is_not_shuffled(spark, tmp_path):
    """Each task of the scan writes its rows itself, one file a month, instead of handing all rows on by month."""
    d = tmp_path / "sf"
    spark.read.parquet(f"{SF}/lineitem.parquet").repartition(3).write.parquet(str(d / "lineitem.parquet"))
    tasks = spark.read.parquet(str(d / "lineitem.parquet")).rdd.getNumPartitions()
    raw = trips_raw(spark, str(d))
    files = {r[0] for r in raw.select(F.input_file_name()).distinct().collect()}
    assert tasks > 1 and len(files) == 12 * tasks
    same(raw, trips_view(spark, str(d)))
