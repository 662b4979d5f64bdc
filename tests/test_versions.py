"""Published versions: loads that race, months shared between versions, loads without rows."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fareloom.fixtures import trips_raw
from fareloom.plans import land_raw
from fareloom.sinks import tables, write_raw
from fareloom.sinks.tables import LostMonths, write_months
from fareloom.sources import read_raw, storage
from fareloom.sources.storage import Overtaken, create_new, current, drop_old_versions, publish, published, read_manifest
from tests.trips import trip, trips

SF = "/root/testdata/sf0.001"


def of_month(spark, month, n=1, **changes):
    return trips(spark, [trip(**changes)] * n, f"month_{month:02d}")


def counts(spark, base):
    return {r["_month_key"]: r["count"] for r in read_raw(spark, base, month_key=True).groupBy("_month_key").count().collect()}


def files(base):
    return {p: p.stat().st_mtime_ns for p in Path(base).rglob("*.parquet")}


# racing loads


def test_a_file_is_created_once(spark, tmp_path):
    path = str(tmp_path / "log" / "000000000001")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: create_new(spark, path, b"%d" % k * 10_000), range(8)))
    assert won.count(True) == 1
    assert Path(path).read_bytes() == b"%d" % won.index(True) * 10_000
    assert [p.name for p in Path(path).parent.iterdir() if not p.name.endswith(".crc")] == ["000000000001"]


def test_a_store_without_links_creates_exclusively(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "RENAMING", ())

    class Other:
        def __init__(self, fs):
            self.fs = fs

        def getUri(self):
            return type("Uri", (), {"getScheme": lambda self: "s3a"})()

        def __getattr__(self, name):
            return getattr(self.fs, name)

    found = storage.hadoop_path
    monkeypatch.setattr(storage, "hadoop_path", lambda spark, path: (Other(found(spark, path)[0]), found(spark, path)[1]))
    path = str(tmp_path / "x")
    assert create_new(spark, path, b"one") and not create_new(spark, path, b"two")
    assert Path(path).read_bytes() == b"one"


def test_of_two_racing_loads_one_publishes(spark, tmp_path):
    """Both have written their rows before either publishes."""
    base = str(tmp_path / "raw")
    write_raw(of_month(spark, 6), base)
    began, _ = current(spark, base)

    def race(k):
        try:
            return publish(spark, base, began, {f"folder-{k}": {"month": f"month_{k:02d}"}})
        except Overtaken:
            return None

    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(race, range(6)))
    assert sorted(filter(None, numbers)) == [began + 1]
    assert published(spark, base) == [began, began + 1]


def test_a_slow_clock_hides_nothing(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "raw")
    write_raw(of_month(spark, 6), base)
    monkeypatch.setattr("time.time_ns", lambda: 1)
    monkeypatch.setattr("time.time", lambda: 1.0)
    write_raw(of_month(spark, 6, 3), base)
    assert read_raw(spark, base).count() == 3


def test_an_overtaken_load_leaves_nothing(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "raw")
    write_raw(of_month(spark, 6), base)
    store = tables.store_months

    def overtaken(*args, **how):
        monkeypatch.setattr(tables, "store_months", store)
        write_raw(of_month(spark, 6, 2), base)
        return store(*args, **how)

    monkeypatch.setattr(tables, "store_months", overtaken)
    with pytest.raises(Overtaken):
        write_raw(of_month(spark, 6, 5), base)
    assert read_raw(spark, base).count() == 2
    assert len(list(Path(base).glob("taxi_trips/load=*"))) == 2


# months shared between versions


def test_one_month_is_refreshed_and_the_others_shared(spark, tmp_path):
    base = str(tmp_path / "raw")
    for m in (1, 2, 3):
        of_month(spark, m, m).drop("_month_key").write.parquet(f"{tmp_path}/a/trips_2025-{m:02d}.parquet")
    again = of_month(spark, 2, 7).withColumn("cbd_fee", F.lit(0.75))
    again.drop("_month_key").write.parquet(f"{tmp_path}/b/trips_2025-02.parquet")
    land_raw(spark, f"{tmp_path}/a/trips_{{year}}-{{month:02d}}.parquet", 2025, base, months=range(1, 4))
    reader, before = read_raw(spark, base), files(base)

    _, report = land_raw(spark, f"{tmp_path}/b/trips_{{year}}-{{month:02d}}.parquet", 2025, base, months=[2, 5], keep_others=True)
    assert {r["month"]: (r["status"], r["row_count"]) for r in report.collect()} == {2: ("loaded", 7), 5: ("skipped", None)}
    assert counts(spark, base) == {"month_01": 1, "month_02": 7, "month_03": 3}
    new = {p for p in files(base) if p not in before}
    assert new and all("_month_key=month_02" in str(p) for p in new)
    assert {p: t for p, t in files(base).items() if p in before} == before
    assert reader.count() == 6  # a reader of the version before is undisturbed
    assert read_raw(spark, base).where("cbd_fee = 0.75").count() == 7

    assert drop_old_versions(spark, base, keep=1) == [1]
    assert counts(spark, base) == {"month_01": 1, "month_02": 7, "month_03": 3}
    assert len([p for p in before if p.exists()]) == len([p for p in before if "month_02" not in str(p)])


def test_refreshes_of_different_months_both_count(spark, tmp_path, monkeypatch):
    """The second to publish builds on the first; of the same month it is refused."""
    base = str(tmp_path / "raw")
    write_raw(of_month(spark, 1).union(of_month(spark, 2)).union(of_month(spark, 3)), base)
    store = tables.store_months

    def during(month):
        def overtaken(*args, **how):
            monkeypatch.setattr(tables, "store_months", store)
            write_months(of_month(spark, month, 4), base, [f"month_{month:02d}"], keep_others=True)
            return store(*args, **how)

        monkeypatch.setattr(tables, "store_months", overtaken)

    during(2)
    write_months(of_month(spark, 3, 5), base, ["month_03"], keep_others=True)
    assert counts(spark, base) == {"month_01": 1, "month_02": 4, "month_03": 5}
    during(3)
    with pytest.raises(Overtaken):
        write_months(of_month(spark, 3, 9), base, ["month_03"], keep_others=True)
    assert counts(spark, base) == {"month_01": 1, "month_02": 4, "month_03": 4}


def test_a_month_is_pruned_by_its_folder(spark, tmp_path):
    base = str(tmp_path / "raw")
    write_raw(trips_raw(spark, SF), base)
    text = read_raw(spark, base, month_key=True).where("_month_key = 'month_03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_month_key" in text and text.count("FileScan") == 1


# loads without rows


def test_a_load_without_rows_is_an_error(spark, tmp_path):
    base, template = str(tmp_path / "raw"), "/trips_{year}-{month:02d}.parquet"
    of_month(spark, 1, 5).drop("_month_key").write.parquet(f"{tmp_path}/a/trips_2025-01.parquet")
    of_month(spark, 1, 5).where("false").drop("_month_key").write.parquet(f"{tmp_path}/b/trips_2025-01.parquet")
    land_raw(spark, f"{tmp_path}/a{template}", 2025, base, months=[1])
    for keep_others in (False, True):
        with pytest.raises(ValueError, match="month_01"):
            land_raw(spark, f"{tmp_path}/b{template}", 2025, base, months=[1], keep_others=keep_others)
    assert read_raw(spark, base).count() == 5 and len(published(spark, base)) == 1


def test_a_month_re_issued_empty_does_not_go_unasked(spark, tmp_path):
    base, template = str(tmp_path / "raw"), "/trips_{year}-{month:02d}.parquet"
    for m, n in ((1, 5), (2, 3)):
        of_month(spark, m, n).drop("_month_key").write.parquet(f"{tmp_path}/a/trips_2025-{m:02d}.parquet")
        of_month(spark, m, n).where(f"{m} = 1").drop("_month_key").write.parquet(f"{tmp_path}/b/trips_2025-{m:02d}.parquet")
    land_raw(spark, f"{tmp_path}/a{template}", 2025, base, months=[1, 2])
    for keep_others in (False, True):
        with pytest.raises(LostMonths, match="month_02"):
            land_raw(spark, f"{tmp_path}/b{template}", 2025, base, months=[1, 2], keep_others=keep_others)
    assert counts(spark, base) == {"month_01": 5, "month_02": 3}
    land_raw(spark, f"{tmp_path}/b{template}", 2025, base, months=[1, 2], keep_others=True, drop_months=True)
    assert counts(spark, base) == {"month_01": 5}
    assert read_manifest(spark, base, 1).keys() != read_manifest(spark, base, 2).keys()
