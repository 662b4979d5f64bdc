"""Views that shape the driver's tables like landed trips and the imputation sample, dirty values included.

One SQL text serves Spark and the SQL oracle; only the timestamp arithmetic and the source of copies differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fareloom.plans import refresh_star
from fareloom.schemas import MONTH_KEY
from fareloom.sinks import write_raw
from fareloom.sources import read_raw, read_star
from fareloom.sources.storage import scratch_path

SECONDS = "((l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 611953) % 32000000)"
LENGTH = "(CAST(l_quantity AS BIGINT) * ((l_orderkey % 23) - 1) * 37)"

TRIPS_RAW = """
SELECT CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE CAST(1 + l_partkey % 7 AS BIGINT) END AS vendorid,
 CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE @PICKUP@ END AS tpep_pickup_datetime,
 CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE @DROPOFF@ END AS tpep_dropoff_datetime,
 CASE WHEN l_partkey % 13 = 0 THEN NULL
  ELSE CAST(l_linenumber - 2 AS DOUBLE) + CASE WHEN l_partkey % 17 = 0 THEN 0.5 ELSE 0.0 END END AS passenger_count,
 CASE WHEN l_partkey % 43 = 0 THEN NULL
  ELSE l_extendedprice / 180.0 * CASE WHEN l_orderkey % 41 = 0 THEN -1.0 ELSE 1.0 END END AS trip_distance,
 CAST(l_linenumber AS DOUBLE) AS ratecodeid,
 l_returnflag AS store_and_fwd_flag,
 CASE WHEN l_partkey % 211 = 0 THEN NULL ELSE CAST(1 + l_partkey % 263 AS BIGINT) END AS pulocationid,
 CASE WHEN l_partkey % 67 = 1 THEN NULL
  ELSE CAST(1 + (l_suppkey * 31 + l_partkey) % 265 AS BIGINT) END AS dolocationid,
 CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE CAST((l_linenumber + l_orderkey) % 8 AS BIGINT) END AS payment_type,
 CASE WHEN l_partkey % 59 = 0 THEN NULL
  ELSE l_extendedprice / 500.0 * CASE WHEN l_orderkey % 53 = 0 THEN -1.0 ELSE 1.0 END END AS fare_amount,
 l_tax * 10.0 AS extra,
 CAST(0.5 AS DOUBLE) AS mta_tax,
 CASE WHEN l_partkey % 61 = 0 THEN NULL
  ELSE l_discount * 100.0 - CASE WHEN l_orderkey % 71 = 0 THEN 20.0 ELSE 0.0 END END AS tip_amount,
 CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_tax * 50.0 END AS tolls_amount,
 CAST(1.0 AS DOUBLE) AS improvement_surcharge,
 l_extendedprice / 500.0 + l_discount * 100.0 - CASE WHEN l_orderkey % 73 = 0 THEN 500.0 ELSE 0.0 END AS total_amount,
 CAST(2.5 AS DOUBLE) AS congestion_surcharge,
 CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE CAST(1.75 AS DOUBLE) END AS airport_fee,
 'month_' || lpad(CAST(1 + l_orderkey % 12 AS STRING), 2, '0') AS _month_key
FROM @LINES@ l
"""

PEOPLE_RAW = """
SELECT CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 80 AS DOUBLE) + 0.5 END AS Age,
 CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS Fare,
 CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_custkey % 3 AS INT) END AS Parch,
 CAST(1 + o_custkey % 3 AS INT) AS Pclass,
 CAST(o_orderkey % 4 AS INT) AS SibSp,
 CAST(o_orderkey % 2 AS INT) AS Survived,
 o_orderpriority AS Name
FROM @ORDERS@
"""

# Some lines come twice, as exact copies: in Spark by one scan that repeats rows, in the oracle by a union.
SPARK_LINES = "(SELECT *, explode(IF(l_partkey % 37 = 0, array(1, 2), array(1))) AS copy FROM {lineitem})"
DUCKDB_LINES = "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_partkey % 37 = 0)"


def spark_moment(seconds: str) -> str:
    return f"timestamp_ntz'2024-12-30 00:00:00' + make_dt_interval(0, 0, 0, {seconds})"


def duckdb_moment(seconds: str) -> str:
    return f"TIMESTAMP '2024-12-30 00:00:00' + to_seconds({seconds})"


def trips_text(moment, lines: str) -> str:
    return (
        TRIPS_RAW.replace("@PICKUP@", moment(SECONDS))
        .replace("@DROPOFF@", moment(f"({SECONDS} + {LENGTH})"))
        .replace("@LINES@", lines)
    )


LANDED: dict[tuple[str, str], DataFrame] = {}


def trips_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips as an expression over lineitem."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return spark.sql(trips_text(spark_moment, SPARK_LINES), lineitem=lineitem)


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips as a stored raw table, which is what cleaning and the dimensions read.

    Landed by the library's own writer on first use in an application and read back from there, so that filters
    meet stored columns and not the long expressions of the view. Every task of the scan writes to all months, so nothing is shuffled.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in LANDED:
        base = scratch_path(spark, "trips")
        write_raw(trips_view(spark, sf_dir), base)
        LANDED[key] = read_raw(spark, base, month_key=True)
    return LANDED[key]


STARS: dict[tuple[str, str, str], str] = {}


def stored_star(spark: SparkSession, sf_dir: str, policy: str = "code") -> dict[str, DataFrame]:
    """The star schema of the trips as published by a refresh, which runs on first use in an application."""
    return read_star(spark, star_folder(spark, sf_dir, policy))


def star_folder(spark: SparkSession, sf_dir: str, policy: str = "code") -> str:
    key = (spark.sparkContext.applicationId, sf_dir, policy)
    if key not in STARS:
        base = scratch_path(spark, "star")
        refresh_star(trips_raw(spark, sf_dir).drop(MONTH_KEY), base, policy)
        STARS[key] = base
    return STARS[key]


def people_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return spark.sql(PEOPLE_RAW.replace("@ORDERS@", "{orders}"), orders=orders)


TRIPS_DUCKDB = trips_text(duckdb_moment, DUCKDB_LINES)
PEOPLE_DUCKDB = PEOPLE_RAW.replace("@ORDERS@", "orders")
