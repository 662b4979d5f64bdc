"""Hand-written trips: one base row and changes to it."""

from __future__ import annotations

import datetime as dt

from fareloom.schemas import RAW

BASE = {
    "vendorid": 1,
    "payment_type": 1,
    "pulocationid": 10,
    "dolocationid": 20,
    "tpep_pickup_datetime": dt.datetime(2025, 6, 1, 10, 15),
    "tpep_dropoff_datetime": dt.datetime(2025, 6, 1, 10, 30),
    "passenger_count": 2.0,
    "trip_distance": 3.456,
    "fare_amount": 12.345,
    "tip_amount": 1.005,
    "tolls_amount": 0.0,
    "total_amount": 15.0,
}


def trip(**changes):
    return {**dict.fromkeys(RAW.fieldNames()), **BASE, **changes}


def trips(spark, rows, month="month_06"):
    from pyspark.sql import functions as F

    ordered = [tuple(row[c] for c in RAW.fieldNames()) for row in rows]
    return spark.createDataFrame(ordered, RAW).withColumn("_month_key", F.lit(month))


def at(pickup: str, minutes: float = 15):
    start = dt.datetime.fromisoformat(pickup)
    return {"tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + dt.timedelta(minutes=minutes)}
