"""What cleaning removed, by month and by reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.operators.cleaning import (
    CleaningPolicy,
    as_policy,
    keeps,
    reject_reason,
    trip_columns,
    with_measures,
)
from fareloom.schemas import MONTH_KEY


def month_audit(raw: DataFrame, policy: str | CleaningPolicy = "code") -> DataFrame:
    """(month_key, raw_rows, clean_rows, removed_rows) by month of the file.

    A trip found in several months counts as clean in the first of them when the policy drops duplicates.
    """
    p = as_policy(policy)
    raw = with_measures(raw, p)
    if p.drop_duplicates:
        audit = audit_without_duplicates(raw, p)
    else:
        audit = raw.groupBy(F.col(MONTH_KEY).alias("month_key")).agg(
            F.count(F.lit(1)).alias("raw_rows"), F.expr(f"count_if({keeps(p)}) AS clean_rows")
        )
    return audit.withColumn("removed_rows", F.col("raw_rows") - F.col("clean_rows")).orderBy("month_key")


def audit_without_duplicates(raw: DataFrame, policy: CleaningPolicy) -> DataFrame:
    landed = raw.groupBy(F.col(MONTH_KEY).alias("month_key")).agg(F.count(F.lit(1)).alias("raw_rows"))
    # The month as a number keeps the aggregation hash-based; a string minimum would sort the trips.
    month = F.substring(MONTH_KEY, -2, 2).cast("int")
    clean = (
        raw.where(keeps(policy))
        .groupBy(*trip_columns(raw))
        .agg(F.min(month).alias("month"))
        .groupBy("month")
        .agg(F.count(F.lit(1)).alias("clean_rows"))
        .select(F.concat(F.lit("month_"), F.lpad(F.col("month").cast("string"), 2, "0")).alias("month_key"), "clean_rows")
    )
    return landed.join(clean, "month_key", "left").select(
        "month_key", "raw_rows", F.coalesce("clean_rows", F.lit(0)).alias("clean_rows")
    )


def reject_reasons(raw: DataFrame, policy: str | CleaningPolicy = "code") -> DataFrame:
    """(reject_reason, removed_rows) with the first broken rule as the reason."""
    p = as_policy(policy)
    raw = with_measures(raw, p)
    if p.drop_duplicates:
        # One scan: broken rows merge into one row per reason on the map side, kept ones by their columns, to count copies.
        columns = trip_columns(raw)
        rejected = (
            raw.selectExpr(*columns, f"{reject_reason(p)} AS reject_reason")
            .selectExpr(*[f"IF(reject_reason IS NULL, {c}, NULL) AS {c}" for c in columns], "reject_reason")
            .groupBy(*columns, "reject_reason")
            .count()
            .selectExpr(
                "coalesce(reject_reason, 'duplicate') AS reject_reason", "IF(reject_reason IS NULL, count - 1, count) AS rows"
            )
            .where("rows > 0")
            .groupBy("reject_reason")
            .agg(F.sum("rows").alias("removed_rows"))
        )
    else:
        rejected = (
            raw.selectExpr(f"{reject_reason(p)} AS reject_reason")
            .where("reject_reason IS NOT NULL")
            .groupBy("reject_reason")
            .agg(F.count(F.lit(1)).alias("removed_rows"))
        )
    return rejected.orderBy("reject_reason")
