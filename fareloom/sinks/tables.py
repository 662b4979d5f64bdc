"""Writers: the raw table, the star schema, CSV and JDBC."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any, TypeVar

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from fareloom.operators.clustering import interleaved, rank_bounds, rank_text
from fareloom.operators.quality import member_checks
from fareloom.schemas import DIMENSIONS, FACT_TRIPS, MONTH_KEY, PICKUP_MONTH, conform
from fareloom.sources.storage import Manifest, Overtaken, current, discard, dropping_scratch, new_load, publish

LOAD_REPORT = "table_name string, row_count bigint"
JDBC_BATCH = 50_000
SIDE_BY_SIDE = 8  # months written at a time
OPEN_FILES = 16  # months that a task writes to at a time
RAW_TABLE = "taxi_trips"
ROW_GROUP, LEAST_ROW = 128 << 20, 32  # bytes of a row group unless asked for, and of a stored fact row at least
HOURS_OF_MONTH = 31 * 24 + 1  # and the unknown hour

T = TypeVar("T")


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def observed_write(df: DataFrame, save: Callable[[DataFrame], None], counts: dict[str, Column]) -> dict[str, int]:
    """Write and take these aggregates in the same pass."""
    seen = Observation()
    save(df.observe(seen, *[count.alias(name) for name, count in counts.items()]))
    return seen.get


def counted_write(df: DataFrame, save: Callable[[DataFrame], None]) -> int:
    return observed_write(df, save, {"rows": F.count(F.lit(1))})["rows"]


def load(table: str, job: Callable[[], T]) -> T:
    try:
        return job()
    except Exception as exc:
        raise RuntimeError(f"{table} load failed: {exc}") from exc


def sized(writer: DataFrameWriter, max_records_per_file: int | None) -> DataFrameWriter:
    return writer.option("maxRecordsPerFile", max_records_per_file) if max_records_per_file else writer


@contextmanager
def files_kept_open(spark: SparkSession) -> Iterator[None]:
    """Inside the block a task that writes to several folders keeps a file open in each, and sorts its rows by folder only from the
    first one on that is beyond OPEN_FILES."""
    option = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(option)
    spark.conf.set(option, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.set(option, before)


class LostMonths(ValueError):
    """A load that would take months out of the table."""


def months_of(manifest: Manifest) -> dict[str, str]:
    """The folder of each month of a raw table's version."""
    return {known["month"]: folder for folder, known in manifest.items()}


def store_months(
    df: DataFrame,
    root: str,
    months: Sequence[str] | None,
    max_records_per_file: int | None = None,
    mixed: bool = False,
    counts: dict[str, Column] | None = None,
) -> Manifest:
    """Write rows by month key below `root`; returns what is known of each folder, relative to the one that holds `root`: its month,
    rows, schema and, where months are named, `counts`, aggregates over its rows.

    With the months named, each is a job of its own, side by side: its tasks write one folder, so nothing is sorted, and its rows
    are counted as they are written. Over read_months such a job opens the files of its month only. Without, a task writes to all its
    months side by side, unsorted up to OPEN_FILES, and rows are counted by the footers of the files. `mixed` makes fewer files at the
    cost of a shuffle: rows are brought together by month first, in tasks of a bounded size, so a large month is still written by many.
    """
    spark = df.sparkSession
    schema = df.drop(MONTH_KEY).schema.json()
    measures = {"rows": F.count(F.lit(1)), **(counts or {})}

    def store(month: str) -> dict[str, int]:
        rows = df.where(F.col(MONTH_KEY) == month).drop(MONTH_KEY)
        target = f"{root}/{MONTH_KEY}={month}"
        return observed_write(rows, lambda out: sized(out.write, max_records_per_file).mode("overwrite").parquet(target), measures)

    if months is not None:
        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            found = dict(zip(months, pool.map(store, months), strict=True))
    else:
        rows = df.hint("rebalance", F.col(MONTH_KEY)) if mixed else df
        with files_kept_open(spark):
            sized(rows.write, max_records_per_file).mode("overwrite").partitionBy(MONTH_KEY).parquet(root)
        stored = spark.read.schema(f"{MONTH_KEY} string").parquet(root).groupBy(MONTH_KEY).agg(F.count(F.lit(1)).alias("n"))
        found = {r[MONTH_KEY]: {"rows": r["n"]} for r in stored.collect()}  # one row per month
    load = root.rsplit("/", 1)[1]
    return {
        f"{load}/{MONTH_KEY}={month}": {"month": month, **known, "schema": schema}
        for month, known in found.items()
        if known["rows"]
    }


def write_months(
    df: DataFrame,
    base: str,
    months: Sequence[str] | None = None,
    keep_others: bool = False,
    drop_months: bool = True,
    **how: Any,
) -> dict[str, dict[str, Any]]:
    """Publish a version of the raw table with these rows; returns what is known of each month that was written, see store_months.

    `keep_others` leaves months that are not written as they are: the new version shares their folders with the one before, so a
    re-issued month costs that month. If another load has published meanwhile and its months are others, this one is built on it;
    else it is refused. Without `drop_months` a version that lacks a month of the one before is refused. With no rows at all the table
    that is there stays.
    """
    spark, base = df.sparkSession, base.rstrip("/")
    began = number, before = current(spark, base)
    root = f"{base}/{RAW_TABLE}/load={new_load()}"
    try:
        stored = load(RAW_TABLE, lambda: store_months(df, root, months, **how))
        made = {f"{RAW_TABLE}/{folder}": known for folder, known in stored.items()}
        written = {known["month"]: known for known in made.values()}
        if not written:
            discard(spark, root)
            return {}
        replaced = set(months or written)
        while True:
            others = {f: known for f, known in before.items() if keep_others and known["month"] not in replaced}
            lost = sorted(set(months_of(before)) - set(months_of(others)) - set(written))
            if lost and not drop_months:
                raise LostMonths(f"the load lacks months that the table holds: {', '.join(lost)}")
            try:
                publish(spark, base, number, others | made)
                return written
            except Overtaken:
                number, before = current(spark, base)
                seen, now = months_of(began[1]), months_of(before)
                if not keep_others or any(seen.get(m) != now.get(m) for m in replaced):
                    raise
    except Exception:
        discard(spark, root)
        raise


def write_raw(df: DataFrame, base: str, max_records_per_file: int | None = None, mixed: bool = False) -> DataFrame:
    """Replace the raw table with these rows, stored by month key, and report the rows written. With no rows at all the table that
    is there stays. See write_months."""
    written = write_months(df, base, max_records_per_file=max_records_per_file, mixed=mixed)
    return df.sparkSession.createDataFrame([(RAW_TABLE, sum(known["rows"] for known in written.values()))], LOAD_REPORT)


def time_layout(fact: DataFrame) -> DataFrame:
    """Rows by pickup month and time."""
    return fact.sortWithinPartitions(PICKUP_MONTH, "pickup_datetime")


def key_layout(fact: DataFrame) -> DataFrame:
    """Rows of a month along a curve through pickup and dropoff location, in ranges of even size, and by pickup time where they stand at
    one place of it.

    Reads the two location columns once for their ranks and shuffles the table once. Time and trip id are part of the order, so a hot
    place is dealt over as many files as it fills.
    """
    columns = ["pu_location_key", "do_location_key"]
    bounds = rank_bounds(fact, columns)
    ranks = [f"{rank_text(c, bounds[c])} AS _rank_{k}" for k, c in enumerate(columns)]
    cells = fact.selectExpr("*", *ranks).selectExpr(*fact.columns, f"{interleaved(['_rank_0', '_rank_1'])} AS _cell")
    order = [PICKUP_MONTH, "_cell", "pickup_datetime", "trip_id"]
    return cells.repartitionByRange(*order).sortWithinPartitions(*order).drop("_cell")


LAYOUTS = {"time": time_layout, "keys": key_layout}


def write_fact(
    fact: DataFrame,
    path: str,
    max_records_per_file: int | None = None,
    layout: str = "time",
    row_group_bytes: int | None = None,
) -> int:
    """Store the fact table by pickup month, in one of two layouts, so that file and row-group statistics let a filter skip what
    it does not need: `time` serves ranges of pickup time, `keys` also lookups by location. Bloom filters on the keys of many
    values tell row groups that lack one; the other keys' values are few, and row groups list them in their dictionaries. A filter
    is made for the values that a row group can hold: without that number each takes a megabyte, however small the row group.
    """
    months = conform(fact, FACT_TRIPS).withColumn(PICKUP_MONTH, F.trunc("pickup_datetime", "month"))

    def save(out: DataFrame) -> None:
        writer = sized(out.write, max_records_per_file).partitionBy(PICKUP_MONTH)
        if row_group_bytes:
            writer = writer.option("parquet.block.size", row_group_bytes)
        values = {"trip_id": (row_group_bytes or ROW_GROUP) // LEAST_ROW + 1, "datetime_key": HOURS_OF_MONTH}
        for key, most in values.items() if layout == "keys" else []:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", most)
        writer.parquet(path)

    return counted_write(LAYOUTS[layout](months), save)


def check_dimensions(tables: dict[str, DataFrame]) -> None:
    """Refuse dimensions without a member besides the unknown one, and keys that are null or repeated. Reads the stored
    dimensions once, in one job; fact keys are numbered without gaps and need no such check."""
    for row in member_checks(tables).collect():
        if not row["members"]:
            raise ValueError(f"{row['table_name']} has no members")
        if row["null_keys"] or row["repeated_keys"]:
            raise ValueError(f"{row['table_name']} has null keys or {row['repeated_keys']} repeated ones")


def write_star(
    spark: SparkSession,
    base: str,
    dims: dict[str, DataFrame],
    make_fact: Callable[[dict[str, DataFrame]], DataFrame],
    max_records_per_file: int | None = None,
    layout: str = "time",
    row_group_bytes: int | None = None,
) -> DataFrame:
    """Rebuild the star schema and report the rows of each table. `layout` is that of the fact table, see write_fact.

    Dimensions are stored first, as jobs side by side, and read back for `make_fact`, so facts carry stored
    keys. Tables staged for the fact table go once it is stored. The new version is published after the last
    table; if any fails, or a dimension fails its checks, it is dropped and readers keep the previous one.
    """
    version = f"versions/{new_load()}"
    began, path = current(spark, base)[0], f"{base.rstrip('/')}/{version}"

    def store(name: str) -> int:
        members = conform(dims[name], DIMENSIONS[name])
        return load(name, lambda: counted_write(members, lambda out: out.write.parquet(f"{path}/{name}")))

    def store_fact() -> int:
        stored = {name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in DIMENSIONS.items()}
        return write_fact(make_fact(stored), f"{path}/fact_trips", max_records_per_file, layout, row_group_bytes)

    try:
        with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
            rows = dict(zip(DIMENSIONS, pool.map(store, DIMENSIONS), strict=True))
        check_dimensions({n: spark.read.schema(d).parquet(f"{path}/{n}") for n, d in DIMENSIONS.items()})
        with dropping_scratch(spark):
            rows["fact_trips"] = load("fact_trips", store_fact)
        publish(spark, base, began, {version: {"rows": rows}})
    except Exception:
        discard(spark, path)
        raise
    return spark.createDataFrame(list(rows.items()), LOAD_REPORT)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header: a folder of part files, each written by its own task."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str], append: bool = False, connections: int = 8
) -> None:
    """Load a relational table in batches, over at most so many connections. The driver jar must be on the class path."""
    writer = df.write.mode("append" if append else "overwrite").option("batchsize", JDBC_BATCH)
    writer.option("numPartitions", connections).jdbc(url, table, properties=properties)
