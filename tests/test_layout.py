"""The layout for lookups by key: what a lookup reads, what it returns, and how even the files are."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fareloom.fixtures import trips_raw
from fareloom.operators.clustering import interleaved, rank_bounds, rank_text
from fareloom.plans import refresh_star
from fareloom.sinks import write_star
from fareloom.sources import lookup_trips, read_star
from fareloom.sources.storage import scratch_path

SF = "/root/testdata/sf0.1"
ZONES = (7, 132, 250)


@pytest.fixture(scope="module")
def stars(spark):
    """The same trips in both layouts, in row groups of the same size."""
    raw = trips_raw(spark, SF).drop("_month_key")
    found = {}
    for layout in ("time", "keys"):
        found[layout] = scratch_path(spark, f"star-{layout}")
        refresh_star(raw, found[layout], layout=layout, row_group_bytes=1 << 16)
    return found


def rows_scanned(df):
    """Rows that the scan hands on after it has skipped row groups and pages."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while not plan.nodeName().startswith("Scan"):
        plan = plan.executedPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def row_groups_with(star, column, value):
    """(row groups whose range holds the value, all of them)."""
    held = total = 0
    for file in star.rglob("fact_trips/**/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        place = meta.schema.to_arrow_schema().get_field_index(column)
        for k in range(meta.num_row_groups):
            stats = meta.row_group(k).column(place).statistics
            total += 1
            held += stats.min <= value <= stats.max
    return held, total


def local(path):
    return Path(path.removeprefix("file:").replace("//", "/"))


def test_a_location_lookup_reads_a_quarter_at_most(spark, stars):
    whole = read_star(spark, stars["keys"])["fact_trips"].count()
    for column in ("pu_location_key", "do_location_key"):
        for zone in ZONES:
            held, total = row_groups_with(local(stars["keys"]), column, zone)
            assert total > 100 and held < total / 4, (column, zone, held, total)
    scanned = {layout: rows_scanned(lookup_trips(spark, base, pu_location_key=132)) for layout, base in stars.items()}
    assert scanned["keys"] < whole / 4 < scanned["time"]


def test_lookups_return_the_same_rows_in_both_layouts(spark, stars):
    fact = read_star(spark, stars["time"])["fact_trips"]
    for keys in ({"pu_location_key": 132}, {"vendor_key": 2, "do_location_key": 7}, {"datetime_key": 4000}, {"trip_id": 77_777}):
        condition = " AND ".join(f"{k} = {v}" for k, v in keys.items())
        wanted = sorted(map(tuple, fact.where(condition).collect()))
        assert wanted and sorted(map(tuple, lookup_trips(spark, stars["keys"], **keys).collect())) == wanted
    assert lookup_trips(spark, stars["keys"], pu_location_key=100_000).isEmpty()
    for wrong in ({}, {"fare_amount": 1}):
        with pytest.raises(ValueError, match="not a key"):
            lookup_trips(spark, stars["keys"], **wrong)


def test_bloom_filters_tell_absent_keys(spark, stars):
    """Trip ids are spread along the curve, so their ranges skip little; the filters skip nearly all."""
    ids = {r.trip_id for r in read_star(spark, stars["keys"])["fact_trips"].select("trip_id").limit(3).collect()}
    for trip_id in ids:
        assert rows_scanned(lookup_trips(spark, stars["keys"], trip_id=trip_id)) < 50_000


def test_a_hot_place_is_dealt_over_many_files(spark, tmp_path, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    base = str(tmp_path / "star")
    fact = read_star(spark, scratch_star(spark))["fact_trips"].where("pickup_datetime < timestamp_ntz'2025-02-01'")
    hot = fact.withColumns({"pu_location_key": F.lit(1), "do_location_key": F.lit(1)})
    dims = {n: df for n, df in read_star(spark, scratch_star(spark)).items() if n != "fact_trips"}
    write_star(spark, base, dims, lambda stored: hot, layout="keys")
    files = list((tmp_path / "star").rglob("fact_trips/**/*.parquet"))
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in files]
    assert len(sizes) >= 12 and max(sizes) < 3 * sum(sizes) / 16


STAR: dict[str, str] = {}


def scratch_star(spark):
    if not STAR:
        STAR["base"] = scratch_path(spark, "star")
        refresh_star(trips_raw(spark, "/root/testdata/sf0.01").drop("_month_key"), STAR["base"])
    return STAR["base"]


def test_a_manifest_names_the_version_and_its_rows(spark, tmp_path):
    base = tmp_path / "star"
    report = refresh_star(trips_raw(spark, "/root/testdata/sf0.001").drop("_month_key"), str(base))
    (known,) = json.loads((base / "published" / "000000000001").read_text()).values()
    assert known["rows"] == {r["table_name"]: r["row_count"] for r in report.collect()}


def test_ranks_and_their_interleaving(spark):
    rng = random.Random(4)
    rows = [(rng.choice([5, 5, 5, rng.randrange(1000)]), rng.random()) for _ in range(4000)]
    df = spark.createDataFrame(rows, "a int, b double")
    bounds = rank_bounds(df, ["a", "b"], 3)
    assert len(bounds["b"]) == 7 and len(bounds["a"]) < 7  # one value fills several ranks
    a, b = rank_text("a", bounds["a"]), rank_text("b", bounds["b"])
    found = df.selectExpr("*", f"{a} AS ra", f"{b} AS rb").selectExpr("*", f"{interleaved(['ra', 'rb'], 3)} AS z").collect()
    for r in found:
        assert r.ra == sum(r.a >= x for x in bounds["a"]) and r.rb == sum(r.b >= x for x in bounds["b"]) < 8
        bits = "".join(x + y for x, y in zip(f"{r.ra:03b}", f"{r.rb:03b}", strict=True))
        assert r.z == int(bits, 2)
    per_rank = [sum(r.rb == k for r in found) for k in range(8)]
    assert max(per_rank) < 1.1 * min(per_rank)
    assert rank_bounds(df.where("false"), ["a"]) == {"a": []}


def test_bloom_filters_are_as_large_as_a_row_group_needs(spark, stars):
    """A filter for two keys costs a row group less than its rows do."""
    filters = rows = 0
    for file in local(stars["keys"]).rglob("fact_trips/**/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        rows += sum(meta.row_group(k).column(c).total_compressed_size for k in range(meta.num_row_groups) for c in range(meta.num_columns))
        filters += file.stat().st_size
    filters -= rows  # besides pages a file holds its filters, page indexes and footer
    assert 0 < filters < rows / 2, (filters, rows)
