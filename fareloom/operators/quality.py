"""Checks on stored tables. Each returns one row per check, so a clean result is visible as zeros."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.schemas import DIMENSIONS, MONTH_KEY, PRIMARY_KEYS, REQUIRED_COLUMNS, UNKNOWN_KEY

FOREIGN_KEYS = {PRIMARY_KEYS[dim]: dim for dim in DIMENSIONS}


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of every table."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ]
    )


def key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, key_column, repeated_keys): how many key values occur more than once."""
    return union_all(
        [
            df.groupBy(PRIMARY_KEYS[name])
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(F.count_if(F.col("n") > 1).alias("repeated_keys"))
            .select(F.lit(name).alias("table_name"), F.lit(PRIMARY_KEYS[name]).alias("key_column"), "repeated_keys")
            for name, df in tables.items()
        ]
    )


def member_checks(dims: dict[str, DataFrame]) -> DataFrame:
    """(table_name, members, null_keys, repeated_keys) of each dimension: members besides the unknown one, whether a key
    is null (0 or 1), and how many key values occur more than once."""
    parts = []
    for name, df in dims.items():
        key = F.col(PRIMARY_KEYS[name])
        parts.append(
            df.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(
                F.count_if(key != UNKNOWN_KEY).alias("members"),
                F.count_if(key.isNull()).alias("null_keys"),
                F.count_if(F.col("n") > 1).alias("repeated_keys"),
            )
            .select(F.lit(name).alias("table_name"), "members", "null_keys", "repeated_keys")
        )
    return union_all(parts)


def star_checks(star: dict[str, DataFrame]) -> DataFrame:
    """The checks a refresh makes on its dimensions, with the fact rows that have no member there. Orphans do not stop a
    load: the schema has no foreign keys."""
    dims = {name: star[name] for name in DIMENSIONS}
    orphans = fk_orphans(star["fact_trips"], dims).select("table_name", "orphan_rows")
    return member_checks(dims).join(orphans, "table_name")


def null_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, null_rows) for every required column; one pass per table."""
    checks = []
    for name, df in tables.items():
        columns = REQUIRED_COLUMNS[name]
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        pairs = [x for c in columns for x in (F.lit(c), F.col(c))]
        unpivoted = F.stack(F.lit(len(columns)), *pairs).alias("column_name", "null_rows")
        checks.append(counts.select(F.lit(name).alias("table_name"), unpivoted))
    return union_all(checks)


def fk_orphans(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """(key_column, table_name, orphan_rows): fact rows whose key has no member.

    One pass over the fact table counts rows per key value, on the map side first, so what meets the
    dimensions is one row per distinct key, however unevenly the trips spread over keys. A fact table without rows
    has no orphans, which is five rows of 0.
    """
    columns = list(FOREIGN_KEYS)
    pairs = [x for c in columns for x in (F.lit(c), F.col(c))]
    used = (
        fact.select(F.stack(F.lit(len(columns)), *pairs).alias("key_column", "key_value"))
        .groupBy("key_column", "key_value")
        .agg(F.count(F.lit(1)).alias("fact_rows"))
    )
    members = union_all(
        [dims[dim].select(F.lit(c).alias("key_column"), F.col(c).alias("key_value")) for c, dim in FOREIGN_KEYS.items()]
    ).withColumn("found", F.lit(True))
    counted = (
        used.join(members, ["key_column", "key_value"], "left")
        .groupBy("key_column")
        .agg(F.sum(F.when(F.col("found").isNull(), F.col("fact_rows")).otherwise(0)).alias("orphan_rows"))
    )
    checks = fact.sparkSession.createDataFrame(list(FOREIGN_KEYS.items()), "key_column string, table_name string")
    return checks.join(counted, "key_column", "left").select(
        "key_column", "table_name", F.coalesce("orphan_rows", F.lit(0).cast("bigint")).alias("orphan_rows")
    )


def expectations(raw: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """(check_name, table_name, passed, observed) of the checks that follow each job step, as one lazy table: running it is one job.

    Emptiness takes one row, not a count, and a dimension needs a member besides the unknown one; the month
    count reads the partition column only.
    """
    spark = raw.sparkSession
    known: list[tuple[str, str, int]] = []
    counted: list[DataFrame] = []

    def count(check: str, table: str, df: DataFrame, observed: Column | None = None) -> None:
        number = F.count(F.lit(1)) if observed is None else observed
        row = df.agg(number.cast("bigint").alias("observed"))
        counted.append(row.select(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), "observed"))

    def check_column(table: str, df: DataFrame | None, column: str) -> None:
        known.append((f"has_column_{column}", table, int(df is not None and column in df.columns)))

    count("has_rows", "raw", raw.select(F.lit(1)).limit(1))
    check_column("raw", raw, MONTH_KEY)
    if MONTH_KEY in raw.columns:
        count("has_months", "raw", raw, F.count_distinct(MONTH_KEY))
    for table in DIMENSIONS:
        known.append(("is_present", table, int(table in dims)))
        if table in dims:
            members = dims[table].where(f"{PRIMARY_KEYS[table]} <> {UNKNOWN_KEY}")
            count("has_members", table, members.select(F.lit(1)).limit(1))
    check_column("dim_pickup_location", dims.get("dim_pickup_location"), "zone")
    check_column("dim_datetime", dims.get("dim_datetime"), "year")
    results = union_all([spark.createDataFrame(known, "check_name string, table_name string, observed bigint"), *counted])
    return results.select("check_name", "table_name", (F.col("observed") > 0).alias("passed"), "observed")
