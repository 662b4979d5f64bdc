"""Stored tables, CSV files and SQL text over either."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from fareloom.functions import moment
from fareloom.schemas import FACT_TRIPS, MONTH_KEY, PICKUP_MONTH, PRIMARY_KEYS, STAR
from fareloom.sources.storage import current_manifest, read_parts


def read_raw(spark: SparkSession, base: str, month_key: bool = False) -> DataFrame:
    """The landed trips. The month key is a partition column and not part of the table unless asked for."""
    parts = {folder.split("/", 1)[1]: known["schema"] for folder, known in current_manifest(spark, base).items()}
    raw = read_parts(spark, f"{base.rstrip('/')}/taxi_trips", parts).drop("load")
    return raw if month_key else raw.drop(MONTH_KEY)


def star_version(spark: SparkSession, base: str) -> str:
    """The folder of the published star schema: a refresh writes all its tables."""
    (version,) = current_manifest(spark, base)
    return f"{base.rstrip('/')}/{version}"


def read_star(spark: SparkSession, base: str, views: bool = False) -> dict[str, DataFrame]:
    """The published star schema; `views` also registers each table as a temporary view for SQL text."""
    version = star_version(spark, base)
    tables = {
        name: spark.read.parquet(f"{version}/{name}").select(*schema.fieldNames()) for name, schema in STAR.items()
    }
    if views:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
    return tables


def read_trips(spark: SparkSession, base: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Fact rows picked up in [start, end). Opens only the month folders the range touches, and in them skips
    files and row groups by their pickup times."""
    return (
        spark.read.parquet(f"{star_version(spark, base)}/fact_trips")
        .where(f"{PICKUP_MONTH} BETWEEN DATE'{start:%Y-%m}-01' AND DATE'{end:%Y-%m-%d}'")
        .where(f"pickup_datetime >= {moment(start)} AND pickup_datetime < {moment(end)}")
        .select(*FACT_TRIPS.fieldNames())
    )


def lookup_trips(spark: SparkSession, base: str, **keys: int) -> DataFrame:
    """Fact rows with these values of key columns. Where the table was stored in the `keys` layout, the reader skips the row groups
    whose ranges, dictionaries or bloom filters leave them out."""
    unknown = sorted(set(keys) - set(PRIMARY_KEYS.values()))
    if unknown or not keys:
        raise ValueError(f"not a key of the fact table: {', '.join(unknown) or 'none given'}")
    condition = " AND ".join(f"{key} = {int(value)}" for key, value in keys.items())
    return spark.read.parquet(f"{star_version(spark, base)}/fact_trips").where(condition).select(*FACT_TRIPS.fieldNames())


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header. With a schema there is no extra pass over the file to infer one."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def query_tables(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """SQL text in which {name} stands for a table."""
    return spark.sql(text, **tables)
