"""The fact table: cleaned trips with natural keys, rounded measures, the hour key and a dense trip id."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from fareloom.functions import elapsed_micros, hour_floor, round_cents, rounded_int
from fareloom.operators.cleaning import (
    DROPOFF,
    MEASURES,
    MICROS_PER_MINUTE,
    PICKUP,
    CleaningPolicy,
    as_policy,
    clean_trips,
    midnight,
    trip_columns,
)
from fareloom.operators.keys import dense_key, natural_key
from fareloom.schemas import FACT_TRIPS, UNKNOWN_KEY, conform

# Trip ids follow pickup time; the other columns settle ties. The hour key is left out as pickup decides it.
TRIP_ORDER = [
    "pickup_datetime",
    "dropoff_datetime",
    "vendor_key",
    "payment_type_key",
    "pu_location_key",
    "do_location_key",
    "passenger_count",
    "trip_distance",
    "trip_duration_min",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
]
DURATION = "trip_duration_min"
AMOUNTS = [c for c in MEASURES if c != "passenger_count"]
MOST_HOURS = 200_000  # about 23 years, a few megabytes: the largest hour lookup to broadcast
SPREAD = "_spread"


def trip_measures(raw: DataFrame, policy: str | CleaningPolicy = "code", spread: bool = False) -> DataFrame:
    """Cleaned trips with every fact column that depends on the trip alone.

    `spread` adds a column that tells equal trips apart, the same on every retry: the place in the scan, or
    after duplicate removal a hash of all landed columns.
    """
    p = as_policy(policy)
    clean = clean_trips(raw, p)
    # An absent column gets any type here, for Spark to report it by name.
    types = defaultdict(DoubleType, {f.name: f.dataType for f in clean.schema.fields})
    spread_columns = []
    if spread:
        apart = f"xxhash64({', '.join(trip_columns(clean))})" if p.drop_duplicates else "monotonically_increasing_id()"
        spread_columns = [f"{apart} AS {SPREAD}"]

    # Two steps, so that each amount is worked out once and then rounded.
    amounts = clean.selectExpr(
        f"{natural_key('vendorid', types['vendorid'])} AS vendor_key",
        f"{natural_key('payment_type', types['payment_type'])} AS payment_type_key",
        f"{natural_key('pulocationid', types['pulocationid'])} AS pu_location_key",
        f"{natural_key('dolocationid', types['dolocationid'])} AS do_location_key",
        f"{PICKUP} AS pickup_datetime",
        f"{DROPOFF} AS dropoff_datetime",
        f"greatest(coalesce({rounded_int('passenger_count', types['passenger_count'])}, 1), 1) AS passenger_count",
        f"{minutes(PICKUP, DROPOFF)} AS {DURATION}",
        *[f"coalesce(CAST({c} AS DOUBLE), 0D) AS {c}" for c in AMOUNTS],
        *spread_columns,
    )
    return amounts.selectExpr(
        *TRIP_ORDER[:7],
        *[f"{round_cents(c)} AS {c}" for c in TRIP_ORDER[7:]],
        *([SPREAD] if spread else []),
    )


def minutes(start: str, end: str) -> str:
    return f"{elapsed_micros(start, end)} / {MICROS_PER_MINUTE}D"


def hours_of_policy(dim_datetime: DataFrame, policy: CleaningPolicy) -> DataFrame:
    """(datetime_key, datetime_hour) of the hours a kept pickup can fall in.

    The policy's window bounds how many there are, so the broadcast rests on the calendar and not on how
    clean the data is. An open or very long window leaves the join strategy to the optimizer.
    """
    first, last = policy.pickup_from, policy.last_pickup_bound
    hours = dim_datetime.select("datetime_key", "datetime_hour").where(f"datetime_hour >= {midnight(first)}")
    if last is None:
        return hours
    hours = hours.where(f"datetime_hour < {midnight(last)}")
    at_most = (last - first) // dt.timedelta(hours=1)
    return F.broadcast(hours) if at_most <= MOST_HOURS else hours


def with_hour_key(trips: DataFrame, dim_datetime: DataFrame, policy: CleaningPolicy) -> DataFrame:
    """Add the key of the pickup hour, the unknown member's where the dimension has no such hour."""
    hours = hours_of_policy(dim_datetime, policy)
    return (
        trips.selectExpr("*", f"{hour_floor('pickup_datetime')} AS datetime_hour")
        .join(hours, "datetime_hour", "left")
        .selectExpr(*trips.columns, f"coalesce(datetime_key, {UNKNOWN_KEY}) AS datetime_key")
    )


def build_fact(
    raw: DataFrame, dim_datetime: DataFrame, policy: str | CleaningPolicy = "code", keyed: bool = True
) -> DataFrame:
    """The fact table. `keyed` numbers the trips, which writes one staged table; without it trip_id is absent.

    Numbering expects `raw` to be a stored table, as read_raw gives: equal trips are told apart by their place
    in the scan, which a retried task finds again. Duration and hour follow from the pickup and dropoff, which come first in the order,
    so both are worked out after the numbering and take no part in its shuffle or staged table.
    """
    p = as_policy(policy)
    trips = trip_measures(raw, p, spread=keyed)
    if not keyed:
        return with_hour_key(trips, dim_datetime, p).select(*[c for c in FACT_TRIPS.fieldNames() if c != "trip_id"])
    order = [c for c in TRIP_ORDER if c != DURATION]
    numbered = dense_key(trips.select(*order, SPREAD), order, "trip_id", tiebreak=SPREAD)
    timed = numbered.selectExpr("*", f"{minutes('pickup_datetime', 'dropoff_datetime')} AS {DURATION}")
    rounded = timed.withColumn(DURATION, F.expr(round_cents(DURATION)))
    return conform(with_hour_key(rounded, dim_datetime, p), FACT_TRIPS)


def earliest_trips(
    raw: DataFrame, dim_datetime: DataFrame, n: int, policy: str | CleaningPolicy = "code"
) -> DataFrame:
    """The fact rows with ids 1..n, with those ids, without numbering the rest: each task keeps its first n."""
    p = as_policy(policy)
    head = trip_measures(raw, p).orderBy(*TRIP_ORDER).limit(n)
    numbered = head.withColumn("trip_id", F.row_number().over(Window.orderBy(*TRIP_ORDER)).cast("bigint"))
    return conform(with_hour_key(numbered, dim_datetime, p), FACT_TRIPS)
