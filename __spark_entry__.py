
from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fareloom import operators as ops
from fareloom import plans
from fareloom.fixtures import people_raw, star_folder, stored_star, trips_raw
from fareloom.schemas import DIMENSIONS, MONTH_KEY, PEOPLE
from fareloom.sinks import write_csv, write_raw
from fareloom.sources import lookup_trips, query_tables, read_csv, read_raw, read_star, read_trips, with_missing_columns
from fareloom.sources.months import normalise_names, union_months
from fareloom.sources.storage import scratch_path
from fareloom.streaming import compact_landed, drop_compacted, land_incremental, read_landed
from oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]

YEAR = 2025
PEOPLE_COLUMNS = PEOPLE.fieldNames()
CODE_COLUMNS = ["vendorid", "payment_type", "pulocationid", "dolocationid"]
FIRST_WITHOUT_TOLLS = "month_07"
RANGE = dt.datetime(2025, 3, 15, 6), dt.datetime(2025, 5, 1)
ROWS_PER_FILE = 1_000
REISSUED, REISSUED_KEEPS = 3, "payment_type IS NOT NULL"
PICKUP_ZONE, DROPOFF_ZONE = 132, 161
ROW_GROUP_BYTES = 1 << 18


def over_trips(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(trips_raw(spark, sf_dir))


def over_people(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(people_raw(spark, sf_dir))


def over_star(f: Callable[[dict[str, DataFrame]], DataFrame], policy: str = "code") -> Query:
    """A query over the stored star schema, which one refresh per application publishes."""
    return lambda spark, sf_dir: f(stored_star(spark, sf_dir, policy))


def dimension(name: str) -> Query:
    return over_trips(lambda raw: plans.build_dim(raw, name))


def fact(raw: DataFrame, policy: str = "code", keyed: bool = False) -> DataFrame:
    return plans.build_fact(raw, plans.build_dim(raw, "dim_datetime"), policy, keyed)


def payment_report(raw: DataFrame, policy: str = "code") -> DataFrame:
    return plans.average_by_payment(plans.trip_measures(raw, policy), plans.build_dim(raw, "dim_payment_type"))


def detail_report(raw: DataFrame) -> DataFrame:
    dims = {name: plans.build_dim(raw, name) for name in ("dim_vendor", "dim_payment_type", "dim_datetime")}
    return plans.spelled_out(plans.earliest_trips(raw, dims["dim_datetime"], 20), dims, 20)


def counts_per_table(raw: DataFrame) -> DataFrame:
    # Counting needs no hour keys: the hour lookup neither adds nor drops trips.
    return ops.table_counts({**plans.build_dims(raw), "fact_trips": plans.trip_measures(raw)})


def all_codes(raw: DataFrame) -> DataFrame:
    parts = [
        ops.distinct_codes(raw, c, "code").select(F.lit(c).alias("column_name"), "code") for c in CODE_COLUMNS
    ]
    return union_months(parts)


def rows_per_month(raw: DataFrame) -> DataFrame:
    return raw.groupBy(F.col(MONTH_KEY).alias("month_key")).agg(F.count(F.lit(1)).alias("row_count")).orderBy("month_key")


def totals_over_months(raw: DataFrame) -> DataFrame:
    return rows_per_month(raw).agg(F.sum("row_count").alias("row_count"), F.count(F.lit(1)).alias("months"))


def halves(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two halves of a year as published: spelling and types of columns differ, and the second lacks the tolls."""
    early = raw.where(F.col(MONTH_KEY) < FIRST_WITHOUT_TOLLS)
    late = raw.where(F.col(MONTH_KEY) >= FIRST_WITHOUT_TOLLS)
    return (
        early.withColumn("ratecodeid", F.col("ratecodeid").cast("int"))
        .withColumnRenamed("airport_fee", "Airport_fee ")
        .withColumnRenamed("vendorid", "VendorID"),
        late.drop("tolls_amount"),
    )


def drift_union(raw: DataFrame) -> DataFrame:
    return union_months([normalise_names(half) for half in halves(raw)])


def defaulted(raw: DataFrame) -> DataFrame:
    return union_months([with_missing_columns(normalise_names(half), {"tolls_amount": 0.0}) for half in halves(raw)])


def monthly_files(frames: list[DataFrame], folder: str | None = None) -> str:
    """Write the trips as one Parquet folder per month; returns the path template."""
    folder = folder or scratch_path(frames[0].sparkSession, "months")
    for frame in frames:
        name = F.format_string(f"trips_{YEAR}-%s.parquet", F.substring(MONTH_KEY, -2, 2))
        frame.withColumn("file", name).drop(MONTH_KEY).write.mode("append").partitionBy("file").parquet(folder)
    return folder + "/file=trips_{year}-{month:02d}.parquet"


def monthly_landing(raw: DataFrame) -> DataFrame:
    spark = raw.sparkSession
    base = scratch_path(spark, "raw")
    plans.land_raw(spark, monthly_files(list(halves(raw))), YEAR, base, months=range(0, 13))
    return read_raw(spark, base, month_key=True)


def landing_report(raw: DataFrame) -> DataFrame:
    """What happened to each month of a landing; month 0 is not there."""
    spark = raw.sparkSession
    files = monthly_files(list(halves(raw)))
    report = plans.land_raw(spark, files, YEAR, scratch_path(spark, "raw"), months=range(0, 13))[1]
    return report.select("month", "status", "row_count")


def reissue(raw: DataFrame) -> tuple[str, DataFrame]:
    """A raw table of twelve months, one of which has then been re-issued and refreshed alone; (its folder, the month report)."""
    spark = raw.sparkSession
    base = scratch_path(spark, "raw")
    plans.land_raw(spark, monthly_files(list(halves(raw))), YEAR, base)
    early, _ = halves(raw.where(F.col(MONTH_KEY) == f"month_{REISSUED:02d}").where(REISSUED_KEEPS))
    again = monthly_files([early.withColumn("reissued", F.lit(True))])
    return base, plans.land_raw(spark, again, YEAR, base, months=[REISSUED], keep_others=True)[1]


def month_refresh(raw: DataFrame) -> DataFrame:
    return read_raw(raw.sparkSession, reissue(raw)[0], month_key=True)


def refresh_report(raw: DataFrame) -> DataFrame:
    return reissue(raw)[1].select("month", "status", "row_count")


def kept_raw(raw: DataFrame) -> DataFrame:
    """Rows per month of the raw table after loads that found no month, or no rows, and were refused."""
    spark = raw.sparkSession
    base = scratch_path(spark, "raw")
    write_raw(raw, base)
    refused = 0
    for template in (f"{scratch_path(spark, 'none')}/{{year}}-{{month}}.parquet", monthly_files([raw.where("false")])):
        try:
            plans.land_raw(spark, template, YEAR, base)
        except ValueError:
            refused += 1
    if refused < 2:
        raise AssertionError("a load without rows was published")
    return rows_per_month(read_raw(spark, base, month_key=True))


def landing_audit(raw: DataFrame) -> DataFrame:
    """Rows per month before and after cleaning, counted by the load that landed them."""
    spark = raw.sparkSession
    files = monthly_files(list(halves(raw)))
    report = plans.land_raw(spark, files, YEAR, scratch_path(spark, "raw"), policy="code")[1]
    month = F.format_string("month_%02d", "month").alias("month_key")
    return report.select(month, F.col("row_count").alias("raw_rows"), "clean_rows", "removed_rows")


def sized_files(raw: DataFrame) -> DataFrame:
    """Rows per month of a raw table in files of limited size, and whether every file keeps the limit."""
    spark = raw.sparkSession
    base = scratch_path(spark, "raw")
    write_raw(raw, base, max_records_per_file=ROWS_PER_FILE)
    per_file = (
        read_raw(spark, base, month_key=True)
        .groupBy(F.col(MONTH_KEY).alias("month_key"), F.input_file_name().alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return per_file.groupBy("month_key").agg(
        F.sum("rows").alias("row_count"), (F.max("rows") <= ROWS_PER_FILE).alias("within_limit")
    )


def kept_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the star's tables after a refresh that was refused: those of the version before."""
    base = star_folder(spark, sf_dir)
    try:
        plans.refresh_star(trips_raw(spark, sf_dir).where("false"), base)
    except ValueError:
        return ops.table_counts(read_star(spark, base))
    raise AssertionError("a refresh without trips was published")


def refreshed(policy: str) -> Query:
    def run(raw: DataFrame) -> DataFrame:
        return plans.refresh_star(raw.drop(MONTH_KEY), scratch_path(raw.sparkSession, "star"), policy)

    return over_trips(run)


def streaming_landing(raw: DataFrame) -> DataFrame:
    spark = raw.sparkSession
    out = f"{scratch_path(spark, 'stream')}/raw"
    folder = monthly_files(list(halves(raw))).rsplit("/", 1)[0]
    land_incremental(spark, folder, out, f"{out}-log").awaitTermination()
    return read_landed(spark, out)


def compacted_landing(raw: DataFrame) -> DataFrame:
    """The landed trips after one batch per half of the year, small batches stored again as one."""
    spark = raw.sparkSession
    out = f"{scratch_path(spark, 'stream')}/raw"
    parts = [raw.where(F.col(MONTH_KEY).between(f"month_{m:02d}", f"month_{m + 2:02d}")) for m in (1, 4, 7, 10)]
    folder = scratch_path(spark, "months")
    for part, half in zip(parts, (0, 0, 1, 1), strict=True):
        monthly_files([halves(part)[half]], folder)
        land_incremental(spark, folder, out, f"{out}-log").awaitTermination()
    compact_landed(spark, out)
    drop_compacted(spark, out)
    return read_landed(spark, out)


CLUSTERED: dict[tuple[str, str], str] = {}


def clustered_star(spark: SparkSession, sf_dir: str) -> str:
    """A star whose fact table is stored for lookups by key, published on first use in an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in CLUSTERED:
        base = scratch_path(spark, "star")
        raw = trips_raw(spark, sf_dir).drop(MONTH_KEY)
        plans.refresh_star(raw, base, layout="keys", row_group_bytes=ROW_GROUP_BYTES)
        CLUSTERED[key] = base
    return CLUSTERED[key]


def looked_up(**keys: int) -> Query:
    return lambda spark, sf_dir: lookup_trips(spark, clustered_star(spark, sf_dir), **keys)


# Means of whole cents, rounded half up once; kept amounts are never negative.
PAYMENT_SQL = """
SELECT payment_type_name, trips, ((2 * fare + trips) DIV (2 * trips)) / 100D AS avg_fare,
 ((2 * tip + trips) DIV (2 * trips)) / 100D AS avg_tip
FROM (
 SELECT payment_type_name, count(*) AS trips, sum(CAST(rint(fare_amount * 100D) AS BIGINT)) AS fare,
  sum(CAST(rint(tip_amount * 100D) AS BIGINT)) AS tip
 FROM {fact_trips} JOIN {dim_payment_type} USING (payment_type_key)
 WHERE payment_type_key <> -1
 GROUP BY payment_type_name
) ORDER BY trips DESC, payment_type_name
"""


def payment_sql(star: dict[str, DataFrame]) -> DataFrame:
    tables = {name: star[name] for name in ("fact_trips", "dim_payment_type")}
    return query_tables(star["fact_trips"].sparkSession, PAYMENT_SQL, **tables)


def stored_detail(star: dict[str, DataFrame]) -> DataFrame:
    return plans.trip_detail(star["fact_trips"], star)


def orphans(star: dict[str, DataFrame]) -> DataFrame:
    return ops.fk_orphans(star["fact_trips"], star)


def csv_round_trip(people: DataFrame) -> DataFrame:
    spark = people.sparkSession
    path = f"{scratch_path(spark, 'csv')}/people_clean"
    write_csv(ops.impute_upper_median(people, PEOPLE_COLUMNS), path)
    return read_csv(spark, path, PEOPLE)


REGISTRY: dict[str, Query] = {
    # reports
    "avg_fare_by_payment": over_trips(payment_report),
    "avg_fare_by_payment_documented": over_trips(lambda raw: payment_report(raw, "documented")),
    "trip_detail_top20": over_trips(detail_report),
    # star schema
    **{name: dimension(name) for name in DIMENSIONS},
    "fact_trips": over_trips(fact),
    "fact_trips_documented": over_trips(lambda raw: fact(raw, "documented")),
    "fact_trips_keyed": over_trips(lambda raw: fact(raw, keyed=True)),
    "fact_trips_documented_keyed": over_trips(lambda raw: fact(raw, "documented", keyed=True)),
    # cleaning and its account
    "clean_trips": over_trips(ops.clean_trips),
    "clean_trips_documented": over_trips(lambda raw: ops.clean_trips(raw, "documented")),
    "rejected_trips": over_trips(ops.rejected_trips),
    "rejected_trips_documented": over_trips(lambda raw: ops.rejected_trips(raw, "documented")),
    "reject_reasons": over_trips(plans.reject_reasons),
    "reject_reasons_documented": over_trips(lambda raw: plans.reject_reasons(raw, "documented")),
    "month_audit": over_trips(plans.month_audit),
    "month_audit_documented": over_trips(lambda raw: plans.month_audit(raw, "documented")),
    # counts and checks
    "raw_count": over_trips(lambda raw: raw.agg(F.count(F.lit(1)).alias("row_count"))),
    "table_counts": over_trips(counts_per_table),
    "key_violations": over_star(ops.key_violations),
    "null_violations": over_star(ops.null_violations),
    "fk_orphans": over_star(orphans),
    "fk_orphans_documented": over_star(orphans, "documented"),
    "star_checks": over_star(ops.star_checks),
    "star_checks_documented": over_star(ops.star_checks, "documented"),
    "expectations": lambda spark, sf_dir: ops.expectations(trips_raw(spark, sf_dir), stored_star(spark, sf_dir)),
    # candidates and months
    "distinct_codes": over_trips(all_codes),
    "distinct_hours": over_trips(lambda raw: ops.distinct_hours(raw, "tpep_pickup_datetime", "pickup_datetime")),
    "month_keys": over_trips(lambda raw: raw.select(F.col(MONTH_KEY).alias("month_key")).distinct().orderBy("month_key")),
    "month_count": over_trips(lambda raw: raw.agg(F.count_distinct(MONTH_KEY).alias("months"))),
    "rows_per_month": over_trips(rows_per_month),
    "total_rows_over_months": over_trips(totals_over_months),
    "one_month": over_trips(lambda raw: raw.where(F.col(MONTH_KEY) == "month_03").drop(MONTH_KEY)),
    # sources and sinks
    "schema_drift_union": over_trips(drift_union),
    "missing_columns_default": over_trips(defaulted),
    "monthly_landing": over_trips(monthly_landing),
    "streaming_landing": over_trips(streaming_landing),
    "compacted_landing": over_trips(compacted_landing),
    "landing_report": over_trips(landing_report),
    "landing_audit": over_trips(landing_audit),
    "month_refresh": over_trips(month_refresh),
    "refresh_report": over_trips(refresh_report),
    "kept_raw": over_trips(kept_raw),
    "sized_files": over_trips(sized_files),
    "star_refresh": refreshed("code"),
    "star_refresh_documented": refreshed("documented"),
    "kept_version": kept_version,
    "stored_star_sql": over_star(payment_sql),
    "stored_trip_detail": over_star(stored_detail),
    "stored_trip_detail_documented": over_star(stored_detail, "documented"),
    "stored_table_counts_documented": over_star(ops.table_counts, "documented"),
    "stored_trips_range": lambda spark, sf_dir: read_trips(spark, star_folder(spark, sf_dir), *RANGE),
    "trips_of_pickup_zone": looked_up(pu_location_key=PICKUP_ZONE),
    "trips_of_dropoff_zone": looked_up(do_location_key=DROPOFF_ZONE),
    "trips_of_vendor_and_zone": looked_up(vendor_key=2, payment_type_key=1, pu_location_key=PICKUP_ZONE),
    # imputation
    "upper_medians": over_people(lambda people: ops.upper_medians(people, PEOPLE_COLUMNS)),
    "impute_upper_median": over_people(lambda people: ops.impute_upper_median(people, PEOPLE_COLUMNS)),
    "csv_round_trip": over_people(csv_round_trip),
}


# The operators on documents are a subpackage that may be absent; the rest of the library does without it. Anything else that goes wrong
# while importing them is an error.
try:
    import corpus_pipeline
    from fareloom.llm import registry as document_queries
except ModuleNotFoundError as absent:
    if absent.name not in ("corpus_pipeline", "fareloom.llm"):
        raise
    document_queries = None


def entry(spark: SparkSession) -> DataFrame:
    """The flagship query: trips, mean fare and mean tip per payment type."""
    return REGISTRY["avg_fare_by_payment"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    if document_queries is None:
        return dict(REGISTRY)
    return REGISTRY | document_queries.QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    if document_queries is None:
        return dict(ORACLES)
    found = ORACLES | document_queries.ORACLES
    return found if corpus_pipeline.ORACLE_SQL is None else found | {"pipeline": corpus_pipeline.ORACLE_SQL}
