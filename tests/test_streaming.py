from __future__ import annotations

import json
import shutil
import time
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fareloom.fixtures import trips_raw
from fareloom.plans import land_raw, refresh_star
from fareloom.sources import months, read_raw
from fareloom.streaming import compact_landed, drop_compacted, land_incremental, landing, read_landed
from tests.trips import trip, trips


def save(df, folder, month):
    df.drop("_month_key").write.parquet(f"{folder}/trips_2025-{month:02d}.parquet")


def land(spark, tmp_path):
    query = land_incremental(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log"), files_per_batch=3)
    query.awaitTermination()
    return read_landed(spark, str(tmp_path / "out"))


def test_lands_what_the_batch_job_lands_and_each_file_once(spark, tmp_path):
    raw = trips_raw(spark, "/root/testdata/sf0.001")
    for m in (1, 2):
        save(raw.where(f"_month_key = 'month_{m:02d}'"), tmp_path / "in", m)
    first = land(spark, tmp_path)
    assert first.count() == raw.where("_month_key <= 'month_02'").count()

    for m in (3, 4):
        save(raw.where(f"_month_key = 'month_{m:02d}'"), tmp_path / "in", m)
    landed = land(spark, tmp_path)
    land_raw(spark, str(tmp_path / "in") + "/trips_{year}-{month:02d}.parquet", 2025, str(tmp_path / "raw"))
    batch = read_raw(spark, str(tmp_path / "raw"), month_key=True)
    assert sorted(landed.columns) == sorted(batch.columns)
    assert landed.exceptAll(batch.select(*landed.columns)).isEmpty()
    assert landed.count() == batch.count()

    assert land(spark, tmp_path).count() == batch.count()  # nothing new

    from_stream = {tuple(r) for r in refresh_star(landed, str(tmp_path / "a")).collect()}
    assert from_stream == {tuple(r) for r in refresh_star(batch, str(tmp_path / "b")).collect()}
    assert ("dim_vendor", 8) in from_stream


def test_single_files_and_odd_spelling(spark, tmp_path):
    df = trips(spark, [trip(airport_fee=float("nan"))]).drop("_month_key").withColumnRenamed("airport_fee", "Airport_fee")
    df.coalesce(1).write.parquet(str(tmp_path / "made"))
    (tmp_path / "in").mkdir()
    part = next((tmp_path / "made").glob("part-*.parquet"))
    (tmp_path / "in" / "yellow_2025-07.parquet").write_bytes(part.read_bytes())
    row = land(spark, tmp_path).first()
    assert (row._month_key, row.airport_fee, row.fare_amount) == ("month_07", None, 12.345)


def test_drifted_files_land_as_in_the_batch_job(spark, tmp_path):
    raw = trips_raw(spark, "/root/testdata/sf0.001")
    month = lambda m: raw.where(f"_month_key = 'month_{m:02d}'")
    save(month(1).withColumn("cbd_congestion_fee", raw.fare_amount), tmp_path / "in", 1)
    save(month(2).withColumnRenamed("airport_fee", "Airport_fee "), tmp_path / "in", 2)
    save(month(3).withColumn("passenger_count", raw.passenger_count.cast("bigint")), tmp_path / "in", 3)
    land(spark, tmp_path)
    save(month(4).withColumn("vendorid", raw.vendorid.cast("int")).drop("tolls_amount"), tmp_path / "in", 4)
    month(5).drop("_month_key").write.parquet(str(tmp_path / "in" / "may.parquet"))
    landed = land(spark, tmp_path)
    land_raw(spark, str(tmp_path / "in") + "/trips_{year}-{month:02d}.parquet", 2025, str(tmp_path / "raw"), months=range(1, 5))
    batch = read_raw(spark, str(tmp_path / "raw"), month_key=True)
    assert sorted(landed.dtypes) == sorted(batch.dtypes) and "cbd_congestion_fee" in landed.columns
    assert landed.exceptAll(batch.select(*landed.columns)).isEmpty() and landed.count() == batch.count()
    skipped = spark.read.json(str(tmp_path / "out" / "skipped" / "*"))
    assert {r.path.split("/")[-2] for r in skipped.collect()} == {"may.parquet"}
    assert land(spark, tmp_path).count() == batch.count()


def same_rows(a, b):
    assert sorted(a.dtypes) == sorted(b.dtypes)
    assert a.exceptAll(b.select(*a.columns)).isEmpty() and a.count() == b.count()


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def months_one_by_one(spark, tmp_path, months):
    raw = trips_raw(spark, "/root/testdata/sf0.001")
    for m in months:
        month = raw.where(f"_month_key = 'month_{m:02d}'")
        save(month.drop("tolls_amount") if m % 3 == 0 else month, tmp_path / "in", m)
        landed = land(spark, tmp_path)
    return landed


def test_a_scan_per_schema_and_not_per_batch(spark, tmp_path):
    landed = months_one_by_one(spark, tmp_path, range(1, 8))
    assert len(list((tmp_path / "out" / "log").glob("0*"))) == 7 and scans(landed) == 2
    land_raw(spark, str(tmp_path / "in") + "/trips_{year}-{month:02d}.parquet", 2025, str(tmp_path / "raw"))
    same_rows(landed, read_raw(spark, str(tmp_path / "raw"), month_key=True))


def test_compaction_keeps_every_row_once(spark, tmp_path):
    out = str(tmp_path / "out")
    before = months_one_by_one(spark, tmp_path, range(1, 6))
    report = compact_landed(spark, out)
    assert len(report.collect()) == 4  # the last batch stays
    after = read_landed(spark, out)
    same_rows(after, before)
    assert drop_compacted(spark, out) == [r.batch for r in report.collect()]
    same_rows(read_landed(spark, out), after)
    assert drop_compacted(spark, out) == [] and compact_landed(spark, out, small=1).isEmpty()

    raw = trips_raw(spark, "/root/testdata/sf0.001")
    save(raw.where("_month_key = 'month_09'"), tmp_path / "in", 9)
    land(spark, tmp_path)
    again = compact_landed(spark, out)  # takes up what the first one made
    assert len(again.collect()) == 2
    drop_compacted(spark, out)
    assert read_landed(spark, out).count() == raw.where("_month_key IN ('month_09') OR _month_key < 'month_06'").count()
    assert len(list((tmp_path / "out" / "batches").iterdir())) == 2


def test_of_two_compactions_one_counts(spark, tmp_path):
    out = str(tmp_path / "out")
    before = months_one_by_one(spark, tmp_path, range(1, 5))

    def attempt(_):
        try:
            return compact_landed(spark, out).count()
        except RuntimeError:
            return None

    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(attempt, range(2)))
    assert 3 in done
    same_rows(read_landed(spark, out), before)


def test_a_batch_that_stopped_half_way_is_run_again(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    save(trips(spark, [trip()] * 3), tmp_path / "in", 6)
    log = landing.log_batch
    monkeypatch.setattr(landing, "log_batch", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(Exception, match="lost"):
        land(spark, tmp_path)
    with pytest.raises(FileNotFoundError):
        read_landed(spark, out)
    monkeypatch.setattr(landing, "log_batch", log)
    assert land(spark, tmp_path).count() == 3
    paths = [str(p) for p in (tmp_path / "in").iterdir()]
    landing.land_files(spark, paths, out, 0)  # logged already: left alone
    assert read_landed(spark, out).count() == 3


def test_thousands_of_batches_are_planned_in_seconds(spark, tmp_path):
    out = tmp_path / "out"
    save(trips(spark, [trip()]).coalesce(1), tmp_path / "in", 6)
    land(spark, tmp_path)
    (known,) = json.loads((out / "log" / "000000000000").read_text())["folders"].values()
    (part,) = (out / "batches").rglob("part-*.parquet")
    for n in range(1, 2000):
        folder = f"load={n:012d}/_month_key=month_06"
        (out / "batches" / folder).mkdir(parents=True)
        shutil.copy(part, out / "batches" / folder)
        (out / "log" / f"{n:012d}").write_text(json.dumps({"folders": {folder: known}, "replaces": []}))
    start = time.perf_counter()
    landed = read_landed(spark, str(out))
    text = landed._jdf.queryExecution().executedPlan().toString()
    assert time.perf_counter() - start < 20 and text.count("FileScan") == 1
    assert landed.count() == 2000
    assert compact_landed(spark, str(out)).count() == 1999 and drop_compacted(spark, str(out))
    assert len(list(Path(out / "batches").iterdir())) == 2 and read_landed(spark, str(out)).count() == 2000


def test_footers_of_many_files_are_read_by_one_job(spark, tmp_path):
    """Three hundred files with other columns and spellings; then some whose types differ, which costs a job for each cut."""
    (tmp_path / "in").mkdir()
    kinds = {
        "plain": trips(spark, [trip(airport_fee=1.0)]),
        "spelt": trips(spark, [trip(airport_fee=2.0)]).withColumnRenamed("airport_fee", "Airport_fee "),
        "extra": trips(spark, [trip(airport_fee=3.0)]).withColumn("cbd_fee", F.lit(0.75)),
    }
    made = {}
    for name, df in kinds.items():
        df.drop("_month_key").coalesce(1).write.parquet(str(tmp_path / "made" / name))
        (made[name],) = (tmp_path / "made" / name).glob("part-*.parquet")
    paths = []
    for n in range(300):
        path = tmp_path / "in" / f"{n:03d}_2025-{1 + n % 12:02d}.parquet"
        shutil.copy(made[list(kinds)[n % 3]], path)
        paths.append(str(path))
    sc = spark.sparkContext
    sc.setJobGroup("footers", "footers")
    groups = months.open_together(spark, paths)
    assert len(groups) == 1 and len(sc.statusTracker().getJobIdsForGroup("footers")) <= 2  # one lists the paths, one reads
    sc.setJobGroup("other", "other")
    landed = land(spark, tmp_path)
    assert landed.count() == 300 and landed.where("cbd_fee = 0.75").count() == 100
    fees = {r.airport_fee: r["count"] for r in landed.groupBy("airport_fee").count().collect()}
    assert fees == {1.0: 100, 2.0: 100, 3.0: 100}


def test_groups_are_cut_where_types_differ_or_a_file_is_broken(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(8):
        df = trips(spark, [trip()])
        if n == 2:
            df = df.withColumn("vendorid", F.col("vendorid").cast("int"))
        save(df, tmp_path / "in", n + 1)
    (tmp_path / "in" / "bad_2025-11.parquet").write_text("not parquet")
    paths = sorted(str(p) for p in (tmp_path / "in").iterdir())
    groups = months.open_together(spark, paths)
    assert sorted(p for g, _, _ in groups for p in g) == paths and len(groups) < len(paths)
    assert [g for g, table, reason in groups if table is None and "not a Parquet" in reason] == [[str(tmp_path / "in" / "bad_2025-11.parquet")]]
    landed = land(spark, tmp_path)
    assert landed.count() == 8 and landed.schema["vendorid"].dataType.simpleString() == "bigint"
    assert spark.read.json(str(tmp_path / "out" / "skipped" / "*")).count() == 1


def test_one_file_with_both_spellings_is_an_error(spark, tmp_path):
    df = trips(spark, [trip(airport_fee=1.0)]).withColumn(" Airport_fee", F.lit(2.0)).drop("_month_key")
    with pytest.raises(Exception, match="share a name"):
        months.normalise_together(df).collect()
