"""Reports over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.schemas import PRIMARY_KEYS, UNKNOWN_KEY


NAMED = ("dim_vendor", "dim_payment_type", "dim_datetime")
LAST_ID = 2**63 - 1


def with_members(trips: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The trips that have a member in every dimension the detail names."""
    for dim in NAMED:
        trips = trips.join(dims[dim].select(PRIMARY_KEYS[dim]), PRIMARY_KEYS[dim], "left_semi")
    return trips


def spelled_out(trips: DataFrame, dims: dict[str, DataFrame], n: int) -> DataFrame:
    """The first n rows by trip id with vendor, payment type and pickup hour spelled out.

    Trips without a member are left out before the n are picked, and n rows are taken again after the joins, where a
    repeated member would make more. Keys are matched first, which carries no labels through the top-k.
    """
    detail = with_members(trips, dims).orderBy("trip_id").limit(n)
    for dim in NAMED:
        detail = detail.join(dims[dim], PRIMARY_KEYS[dim])
    wanted = [
        "trip_id",
        "vendor_name",
        "payment_type_name",
        "year",
        "month",
        "weekday",
        "trip_distance",
        "fare_amount",
        "tip_amount",
        "total_amount",
    ]
    return detail.select(*wanted).orderBy("trip_id").limit(n)


def trip_detail(trips: DataFrame, dims: dict[str, DataFrame], n: int = 20) -> DataFrame:
    """spelled_out for a stored fact table. Ids are dense from 1, so ids up to n are enough if all those trips have
    members, which a subquery finds out from the few files that hold them; the bound then reaches the reader."""
    found = with_members(trips.where(f"trip_id <= {n}").select("trip_id", *[PRIMARY_KEYS[d] for d in NAMED]), dims)
    enough = found.agg(F.count(F.lit(1)).alias("rows")).select(
        F.when(F.col("rows") >= n, F.lit(n).cast("bigint")).otherwise(F.lit(LAST_ID)).alias("bound")
    )
    return spelled_out(trips.where(F.col("trip_id") <= enough.scalar()), dims, n)


def mean_cents(cents: str, trips: str) -> Column:
    """Whole-number mean rounded half up to a cent, then as a double. Cents of kept trips are never negative."""
    return F.expr(f"(2 * {cents} + {trips}) div (2 * {trips})") / 100.0


def average_by_payment(trips: DataFrame, dim_payment_type: DataFrame) -> DataFrame:
    """Trips, mean fare and mean tip per payment type, known types only, most trips first.

    Trips are summed by key before the dimension is joined, so the join meets one row per code. Sums are of
    whole cents: exact in any order, unlike sums of doubles.
    """

    def cents(column: str) -> Column:
        return F.sum(F.rint(F.col(column) * 100.0).cast("bigint"))

    by_key = (
        trips.where(F.col("payment_type_key") != UNKNOWN_KEY)
        .groupBy("payment_type_key")
        .agg(F.count(F.lit(1)).alias("trips"), cents("fare_amount").alias("fare"), cents("tip_amount").alias("tip"))
    )
    return (
        by_key.join(dim_payment_type, "payment_type_key")
        .groupBy("payment_type_name")
        .agg(F.sum("trips").alias("trips"), F.sum("fare").alias("fare"), F.sum("tip").alias("tip"))
        .select(
            "payment_type_name",
            "trips",
            mean_cents("fare", "trips").alias("avg_fare"),
            mean_cents("tip", "trips").alias("avg_tip"),
        )
        .orderBy(F.desc("trips"), "payment_type_name")
    )
