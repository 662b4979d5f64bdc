from __future__ import annotations

import math
import time

import pytest
from pyspark.sql import functions as F

from fareloom.schemas import PEOPLE, RAW
from fareloom.sinks import write_csv
from fareloom.sources import months, nan_to_null, normalise_names, query_tables, read_csv, read_months, with_missing_columns
from tests.trips import trip, trips


def save(df, folder, month):
    df.drop("_month_key").write.parquet(f"{folder}/trips_2025-{month:02d}.parquet")


@pytest.fixture
def template(tmp_path):
    return str(tmp_path) + "/trips_{year}-{month:02d}.parquet"


def test_months_with_drifting_schemas(spark, tmp_path, template):
    one = trips(spark, [trip(airport_fee=1.0)]).withColumnRenamed("airport_fee", "Airport_fee ")
    two = trips(spark, [trip(airport_fee=2.0), trip(airport_fee=math.nan)]).withColumn("vendorid", F.col("vendorid").cast("int"))
    three = trips(spark, [trip()]).drop("tolls_amount").withColumn("cbd_fee", F.lit(0.75)).withColumn(
        "vendorid", F.col("vendorid").cast("double")
    )
    save(one, tmp_path, 1)
    save(two, tmp_path, 2)
    save(three, tmp_path, 4)
    (tmp_path / "trips_2025-05.parquet").write_text("not parquet")

    df, report = read_months(spark, template, 2025, range(1, 7))
    status = {r.month: (r.status, r.error is None) for r in report.collect()}
    assert status == {
        1: ("loaded", True),
        2: ("loaded", True),
        3: ("skipped", False),
        4: ("loaded", True),
        5: ("skipped", False),
        6: ("skipped", False),
    }
    assert set(df.columns) == {*RAW.fieldNames(), "cbd_fee", "_month_key"}
    assert df.schema["vendorid"].dataType.simpleString() == "double"
    rows = df.orderBy("_month_key", F.col("airport_fee").desc_nulls_last()).collect()
    assert [r._month_key for r in rows] == ["month_01", "month_02", "month_02", "month_04"]
    assert [r.airport_fee for r in rows] == [1.0, 2.0, None, None]
    assert [r.tolls_amount for r in rows] == [0.0, 0.0, 0.0, None]
    assert [r.cbd_fee for r in rows] == [None, None, None, 0.75]


def test_no_month_at_all(spark, template):
    with pytest.raises(ValueError, match="no month"):
        read_months(spark, template, 2025)


def test_names_that_collide(spark):
    df = spark.range(1).selectExpr("id AS Fee", "id AS ` fee`")
    with pytest.raises(ValueError, match="fee"):
        normalise_names(df)


def test_a_collision_is_not_a_skipped_month(spark, conf, tmp_path, template):
    conf("spark.sql.caseSensitive", "true")
    spark.range(1).selectExpr("id AS Fee", "id AS fee").write.parquet(f"{tmp_path}/trips_2025-01.parquet")
    with pytest.raises(ValueError, match="fee"):
        read_months(spark, template, 2025)


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(math.nan, 1, "x"), (2.0, None, None)], "a double, b int, c string")
    assert [tuple(r) for r in nan_to_null(df).collect()] == [(None, 1, "x"), (2.0, None, None)]


def test_missing_columns(spark):
    df = spark.createDataFrame([(None,), (3.0,)], "tip_amount double")
    rows = with_missing_columns(df, {"tip_amount": 0.0, "tolls_amount": 0.0}).collect()
    assert [tuple(r) for r in rows] == [(None, 0.0), (3.0, 0.0)]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(22.5, 7.25, 0, 3, 1, 0), (None, 71.28, 0, 1, 1, 1)], PEOPLE)
    write_csv(df, str(tmp_path / "people"))
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "people"), PEOPLE).collect()), key=str) == sorted(
        map(tuple, df.collect()), key=str
    )
    assert read_csv(spark, str(tmp_path / "people")).schema.fieldNames() == PEOPLE.fieldNames()


def test_sql_text_over_tables(spark):
    found = query_tables(spark, "SELECT count(*) AS n FROM {trips} WHERE vendorid = 1", trips=trips(spark, [trip(), trip(vendorid=2)]))
    assert found.first().n == 1


# errors


class Flaky:
    """A reader whose store does not answer so many times."""

    def __init__(self, spark, times):
        self.spark, self.times, self.calls = spark, times, 0
        self.read = self

    def parquet(self, path):
        self.calls += 1
        if self.calls <= self.times:
            raise OSError(f"connection reset while reading {path}")
        return self.spark.read.parquet(path)


def test_a_store_that_fails_twice_is_asked_again(spark, tmp_path):
    save(trips(spark, [trip()]), tmp_path, 1)
    path = f"{tmp_path}/trips_2025-01.parquet"
    flaky = Flaky(spark, 2)
    found, reason = months.open_parquet(flaky, path, pause=0.01)
    assert reason is None and found.count() == 1 and flaky.calls == 3


def test_a_store_that_does_not_answer_stops_the_load(spark, tmp_path, template, monkeypatch):
    save(trips(spark, [trip()]), tmp_path, 1)
    flaky = Flaky(spark, 99)
    with pytest.raises(OSError, match="in 3 tries: connection reset"):
        months.open_parquet(flaky, f"{tmp_path}/trips_2025-01.parquet", pause=0.01)
    assert flaky.calls == 3
    opened = months.open_parquet
    monkeypatch.setattr(months, "open_parquet", lambda s, p: opened(Flaky(s, 99) if "-02" in p else s, p, pause=0.01))
    with pytest.raises(OSError, match="2025-02"):
        read_months(spark, template, 2025, range(1, 4))


def test_missing_and_broken_months_are_not_tried_again(spark, tmp_path, template):
    save(trips(spark, [trip()]), tmp_path, 1)
    (tmp_path / "trips_2025-02.parquet").write_text("not parquet")
    (tmp_path / "trips_2025-03.parquet").write_bytes(b"PAR1" + b"x" * 200 + b"PAR1")
    (tmp_path / "trips_2025-04.parquet").mkdir()
    (tmp_path / "trips_2025-05.parquet").write_text("")
    start = time.perf_counter()
    _, report = read_months(spark, template, 2025, range(1, 7))
    why = {r.month: (r.status, r.error or "") for r in report.collect()}
    assert time.perf_counter() - start < 10 and why[1][0] == "loaded" and {s for m, (s, _) in why.items() if m > 1} == {"skipped"}
    for month, words in ((2, "not a Parquet file"), (3, "corrupted"), (4, "UNABLE_TO_INFER"), (5, "not a Parquet file"), (6, "PATH_NOT_FOUND")):
        assert words in why[month][1]
