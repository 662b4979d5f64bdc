"""DuckDB statements that compute each registered query from the same driver tables."""

from __future__ import annotations

from fareloom.fixtures import PEOPLE_DUCKDB, TRIPS_DUCKDB

MINUTES = "(epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) / CAST(60000000 AS DOUBLE)"

RULES = {
    "code": [
        ("pickup_missing", "tpep_pickup_datetime IS NOT NULL"),
        ("dropoff_missing", "tpep_dropoff_datetime IS NOT NULL"),
        ("pickup_location_missing", "pulocationid IS NOT NULL"),
        ("dropoff_location_missing", "dolocationid IS NOT NULL"),
        ("pickup_too_early", "tpep_pickup_datetime >= TIMESTAMP '2025-01-01'"),
        ("pickup_too_late", "tpep_pickup_datetime < TIMESTAMP '2026-01-01'"),
        ("dropoff_before_pickup", "tpep_pickup_datetime <= tpep_dropoff_datetime"),
        ("duration_out_of_range", f"{MINUTES} BETWEEN 0 AND 600"),
    ],
    "documented": [
        ("pickup_missing", "tpep_pickup_datetime IS NOT NULL"),
        ("dropoff_missing", "tpep_dropoff_datetime IS NOT NULL"),
        ("pickup_location_missing", "pulocationid IS NOT NULL"),
        ("dropoff_location_missing", "dolocationid IS NOT NULL"),
        ("pickup_too_early", "tpep_pickup_datetime >= TIMESTAMP '2015-01-01'"),
        ("dropoff_too_late", "tpep_dropoff_datetime < TIMESTAMP '2026-01-01'"),
        ("dropoff_before_pickup", "tpep_pickup_datetime <= tpep_dropoff_datetime"),
        ("duration_out_of_range", f"({MINUTES} > 0 AND {MINUTES} < 600)"),
    ],
}
AMOUNT_RULES = [
    ("distance_negative", "coalesce(trip_distance, 0) >= 0"),
    ("distance_too_long", "coalesce(trip_distance, 0) < 500"),
    ("fare_negative", "coalesce(fare_amount, 0) >= 0"),
    ("total_negative", "coalesce(total_amount, 0) >= 0"),
    ("tip_negative", "coalesce(tip_amount, 0) >= 0"),
]

VENDOR_NAME = """CASE k WHEN 1 THEN 'Creative Mobile Technologies' WHEN 2 THEN 'VeriFone Inc'
 ELSE 'Vendor ' || CAST(k AS VARCHAR) END"""
PAYMENT_NAME = """CASE k WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute'
 WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' ELSE 'Type ' || CAST(k AS VARCHAR) END"""
PEOPLE_COLUMNS = {
    "Age": "DOUBLE",
    "Fare": "DOUBLE",
    "Parch": "INTEGER",
    "Pclass": "INTEGER",
    "SibSp": "INTEGER",
    "Survived": "INTEGER",
}
# The columns of the fact table in their order, and the order of trips.
FACT_COLUMNS = (
    "vendor_key, payment_type_key, pu_location_key, do_location_key, datetime_key, pickup_datetime, dropoff_datetime, "
    "passenger_count, trip_distance, trip_duration_min, fare_amount, tip_amount, tolls_amount, total_amount"
)
TRIP_ORDER = (
    "pickup_datetime, dropoff_datetime, vendor_key, payment_type_key, pu_location_key, do_location_key, "
    "passenger_count, trip_distance, trip_duration_min, fare_amount, tip_amount, tolls_amount, total_amount"
)


def cents(x: str) -> str:
    """Rounded to cents as PostgreSQL does it: the double's first 15 digits as a decimal, half away from zero."""
    return f"CAST(round(CAST(format('{{:.15g}}', {x}) AS DECIMAL(38, 18)), 2) AS DOUBLE)"


def keeps(policy: str) -> str:
    return " AND ".join(f"({keep})" for _, keep in RULES[policy] + AMOUNT_RULES)


def reason(policy: str) -> str:
    cases = " ".join(f"WHEN ({keep}) IS NOT TRUE THEN '{name}'" for name, keep in RULES[policy] + AMOUNT_RULES)
    return f"CASE {cases} END"


def code_members(column: str) -> str:
    return f"SELECT DISTINCT CAST(trunc({column}) AS INTEGER) AS k FROM trips_raw WHERE {column} IS NOT NULL"


def clean(policy: str) -> str:
    pick = "SELECT DISTINCT * EXCLUDE (_month_key)" if policy == "documented" else "SELECT * EXCLUDE (_month_key)"
    return f"{pick} FROM trips_raw WHERE {keeps(policy)}"


def fact(policy: str) -> str:
    return f"""
SELECT coalesce(CAST(vendorid AS INTEGER), -1) AS vendor_key,
 coalesce(CAST(payment_type AS INTEGER), -1) AS payment_type_key,
 coalesce(CAST(pulocationid AS INTEGER), -1) AS pu_location_key,
 coalesce(CAST(dolocationid AS INTEGER), -1) AS do_location_key,
 coalesce(d.datetime_key, -1) AS datetime_key,
 tpep_pickup_datetime AS pickup_datetime,
 tpep_dropoff_datetime AS dropoff_datetime,
 greatest(coalesce(CAST(passenger_count AS INTEGER), 1), 1) AS passenger_count,
 {cents("coalesce(trip_distance, 0)")} AS trip_distance,
 {cents(MINUTES)} AS trip_duration_min,
 {cents("coalesce(fare_amount, 0)")} AS fare_amount,
 {cents("coalesce(tip_amount, 0)")} AS tip_amount,
 {cents("coalesce(tolls_amount, 0)")} AS tolls_amount,
 {cents("coalesce(total_amount, 0)")} AS total_amount
FROM ({clean(policy)}) r
LEFT JOIN dim_datetime d ON date_trunc('hour', r.tpep_pickup_datetime) = d.datetime_hour"""


def keyed_fact(policy: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {TRIP_ORDER}) AS trip_id, {FACT_COLUMNS} FROM fact_{policy}"


CTES = {
    "trips_raw": TRIPS_DUCKDB,
    "people_raw": PEOPLE_DUCKDB,
    "dim_vendor": f"""SELECT -1 AS vendor_key, 'Unknown' AS vendor_name
 UNION ALL SELECT k, {VENDOR_NAME} FROM ({code_members("vendorid")})""",
    "dim_payment_type": f"""SELECT -1 AS payment_type_key, 'Unknown' AS payment_type_name
 UNION ALL SELECT k, {PAYMENT_NAME} FROM ({code_members("payment_type")})""",
    "dim_pickup_location": f"""SELECT -1 AS pu_location_key, -1 AS location_id, 'Unknown' AS zone
 UNION ALL SELECT k, k, 'Zone ' || CAST(k AS VARCHAR) FROM ({code_members("pulocationid")})""",
    "dim_dropoff_location": f"""SELECT -1 AS do_location_key, -1 AS location_id, 'Unknown' AS zone
 UNION ALL SELECT k, k, 'Zone ' || CAST(k AS VARCHAR) FROM ({code_members("dolocationid")})""",
    "dim_datetime": """SELECT -1 AS datetime_key, CAST(NULL AS TIMESTAMP) AS datetime_hour, CAST(NULL AS INTEGER) AS year,
  CAST(NULL AS INTEGER) AS month, CAST(NULL AS INTEGER) AS day, CAST(NULL AS INTEGER) AS hour,
  'Unknown' AS weekday, FALSE AS is_weekend
 UNION ALL
 SELECT CAST(row_number() OVER (ORDER BY h) AS INTEGER), h, CAST(year(h) AS INTEGER), CAST(month(h) AS INTEGER),
  CAST(day(h) AS INTEGER), CAST(hour(h) AS INTEGER), dayname(h), isodow(h) >= 6
 FROM (SELECT DISTINCT date_trunc('hour', tpep_pickup_datetime) AS h FROM trips_raw
  WHERE tpep_pickup_datetime IS NOT NULL)""",
    "fact_code": fact("code"),
    "fact_documented": fact("documented"),
    "fact_trips": keyed_fact("code"),
}
NEEDS = {
    "trips_raw": [],
    "people_raw": [],
    "dim_vendor": ["trips_raw"],
    "dim_payment_type": ["trips_raw"],
    "dim_pickup_location": ["trips_raw"],
    "dim_dropoff_location": ["trips_raw"],
    "dim_datetime": ["trips_raw"],
    "fact_code": ["trips_raw", "dim_datetime"],
    "fact_documented": ["trips_raw", "dim_datetime"],
    "fact_trips": ["trips_raw", "dim_datetime", "fact_code"],
}
DIMS = {
    "dim_vendor": "vendor_key",
    "dim_payment_type": "payment_type_key",
    "dim_pickup_location": "pu_location_key",
    "dim_dropoff_location": "do_location_key",
    "dim_datetime": "datetime_key",
}
KEYS = {**DIMS, "fact_trips": "trip_id"}
REQUIRED = [
    ("dim_vendor", "vendor_key"),
    ("dim_vendor", "vendor_name"),
    ("dim_payment_type", "payment_type_key"),
    ("dim_payment_type", "payment_type_name"),
    ("dim_pickup_location", "pu_location_key"),
    ("dim_pickup_location", "location_id"),
    ("dim_dropoff_location", "do_location_key"),
    ("dim_dropoff_location", "location_id"),
    ("dim_datetime", "datetime_key"),
    ("fact_trips", "trip_id"),
]


def sql(body: str, *tables: str) -> str:
    """The statement with the named tables, and what they need, in front of it."""
    wanted: list[str] = []
    for table in tables:
        wanted += [t for t in [*NEEDS[table], table] if t not in wanted]
    return "WITH " + ",\n".join(f"{t} AS ({CTES[t]})" for t in wanted) + "\n" + body


def mean_by_payment(policy: str) -> str:
    mean = "CAST((2 * sum(CAST(round({0} * 100) AS BIGINT)) + count(*)) // (2 * count(*)) AS DOUBLE) / 100.0"
    return f"""SELECT payment_type_name, count(*) AS trips,
 {mean.format("fare_amount")} AS avg_fare, {mean.format("tip_amount")} AS avg_tip
FROM fact_{policy} JOIN dim_payment_type USING (payment_type_key)
WHERE payment_type_key <> -1 GROUP BY payment_type_name"""


def reject_counts(policy: str) -> str:
    text = f"""SELECT reject_reason, count(*) AS removed_rows
FROM (SELECT {reason(policy)} AS reject_reason FROM trips_raw) WHERE reject_reason IS NOT NULL GROUP BY reject_reason"""
    if policy == "documented":
        text += f"""
UNION ALL SELECT 'duplicate',
 (SELECT count(*) FROM trips_raw WHERE {keeps(policy)}) - (SELECT count(*) FROM ({clean(policy)}))"""
    return text


def audit(policy: str) -> str:
    if policy == "documented":
        kept = f"""SELECT month_key FROM (
 SELECT COLUMNS(* EXCLUDE (_month_key)), min(_month_key) AS month_key FROM trips_raw WHERE {keeps(policy)} GROUP BY ALL)"""
    else:
        kept = f"SELECT _month_key AS month_key FROM trips_raw WHERE {keeps(policy)}"
    return f"""SELECT r.month_key, r.n AS raw_rows, coalesce(c.n, 0) AS clean_rows, r.n - coalesce(c.n, 0) AS removed_rows
FROM (SELECT _month_key AS month_key, count(*) AS n FROM trips_raw GROUP BY 1) r
LEFT JOIN (SELECT month_key, count(*) AS n FROM ({kept}) GROUP BY 1) c USING (month_key)"""


def rejected(policy: str) -> str:
    text = f"""SELECT * EXCLUDE (_month_key), CAST(1 AS BIGINT) AS copies
FROM (SELECT *, {reason(policy)} AS reject_reason FROM trips_raw) WHERE reject_reason IS NOT NULL"""
    if policy == "documented":
        text += f"""
UNION ALL BY NAME SELECT *, 'duplicate' AS reject_reason FROM (
 SELECT * EXCLUDE (_month_key), count(*) - 1 AS copies FROM trips_raw WHERE {keeps(policy)} GROUP BY ALL) WHERE copies > 0"""
    return text


def table_counts(fact_table: str) -> str:
    tables = [(t, t) for t in DIMS] + [("fact_trips", fact_table)]
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}" for n, t in tables)


def orphan_rows(fact_table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{k}' AS key_column, '{t}' AS table_name, count(*) AS orphan_rows "
        f"FROM {fact_table} WHERE {k} NOT IN (SELECT {k} FROM {t})"
        for t, k in DIMS.items()
    )


def star_check_rows(fact_table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(DISTINCT {k}) FROM {t} WHERE {k} <> -1) AS members, "
        f"(SELECT count(DISTINCT {k} IS NULL) FROM {t} WHERE {k} IS NULL) AS null_keys, "
        f"(SELECT count(*) FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)) AS repeated_keys, "
        f"(SELECT count(*) FROM {fact_table} f WHERE NOT EXISTS (FROM {t} d WHERE d.{k} = f.{k})) AS orphan_rows"
        for t, k in DIMS.items()
    )


def expectation_rows() -> str:
    def row(check: str, table: str, observed: str) -> str:
        return (
            f"SELECT '{check}' AS check_name, '{table}' AS table_name, o > 0 AS passed, o AS observed "
            f"FROM (SELECT {observed} AS o)"
        )

    one = "CAST(1 AS BIGINT)"

    def filled(table: str) -> str:
        return f"(SELECT CAST(CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS BIGINT) FROM {table})"

    def members(dim: str) -> str:
        return filled(f"{dim} WHERE {DIMS[dim]} <> -1")

    rows = [
        row("has_rows", "raw", filled("trips_raw")),
        row("has_column__month_key", "raw", one),
        row("has_months", "raw", "(SELECT count(DISTINCT _month_key) FROM trips_raw)"),
    ]
    for dim in DIMS:
        rows += [row("is_present", dim, one), row("has_members", dim, members(dim))]
    rows += [row("has_column_zone", "dim_pickup_location", one), row("has_column_year", "dim_datetime", one)]
    return " UNION ALL ".join(rows)


def median(column: str, sql_type: str) -> str:
    return f"CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY {column} DESC) AS {sql_type})"


def drifted(table: str, filler: str = "NULL") -> str:
    """Trips of months 7 to 12 lack the tolls column."""
    tolls = f"CASE WHEN _month_key >= 'month_07' THEN {filler} ELSE tolls_amount END AS tolls_amount"
    return f"SELECT * REPLACE ({tolls}) FROM {table}"


REISSUED = "(_month_key <> 'month_03' OR payment_type IS NOT NULL)"
CODE_COLUMNS = ["vendorid", "payment_type", "pulocationid", "dolocationid"]
DETAIL = """SELECT f.trip_id, v.vendor_name, p.payment_type_name, d.year, d.month, d.weekday, f.trip_distance,
 f.fare_amount, f.tip_amount, f.total_amount
FROM fact_trips f JOIN dim_vendor v USING (vendor_key) JOIN dim_payment_type p USING (payment_type_key)
 JOIN dim_datetime d USING (datetime_key)
ORDER BY f.trip_id LIMIT 20"""
MEDIANS = ", ".join(f"{median(c, t)} AS {c}" for c, t in PEOPLE_COLUMNS.items())
FILLED = ", ".join(f"CAST(coalesce(p.{c}, m.{c}) AS {t}) AS {c}" for c, t in PEOPLE_COLUMNS.items())
STAR = [*DIMS, "fact_trips"]

ORACLES: dict[str, str] = {
    "avg_fare_by_payment": sql(mean_by_payment("code"), "fact_code", "dim_payment_type"),
    "avg_fare_by_payment_documented": sql(mean_by_payment("documented"), "fact_documented", "dim_payment_type"),
    "trip_detail_top20": sql(DETAIL, *STAR),
    "fact_trips": sql(f"SELECT {FACT_COLUMNS} FROM fact_code", "fact_code"),
    "fact_trips_documented": sql(f"SELECT {FACT_COLUMNS} FROM fact_documented", "fact_documented"),
    "fact_trips_keyed": sql("SELECT * FROM fact_trips", "fact_trips"),
    "fact_trips_documented_keyed": sql(keyed_fact("documented"), "fact_documented"),
    **{dim: sql(f"SELECT * FROM {dim}", dim) for dim in DIMS},
    "clean_trips": sql(clean("code"), "trips_raw"),
    "clean_trips_documented": sql(clean("documented"), "trips_raw"),
    "rejected_trips": sql(rejected("code"), "trips_raw"),
    "rejected_trips_documented": sql(rejected("documented"), "trips_raw"),
    "reject_reasons": sql(reject_counts("code"), "trips_raw"),
    "reject_reasons_documented": sql(reject_counts("documented"), "trips_raw"),
    "month_audit": sql(audit("code"), "trips_raw"),
    "month_audit_documented": sql(audit("documented"), "trips_raw"),
    "raw_count": sql("SELECT count(*) AS row_count FROM trips_raw", "trips_raw"),
    "table_counts": sql(table_counts("fact_code"), *DIMS, "fact_code"),
    "key_violations": sql(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{k}' AS key_column, count(*) AS repeated_keys "
            f"FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)"
            for t, k in KEYS.items()
        ),
        *STAR,
    ),
    "null_violations": sql(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS null_rows FROM {t} WHERE {c} IS NULL"
            for t, c in REQUIRED
        ),
        *STAR,
    ),
    "fk_orphans": sql(orphan_rows("fact_code"), "fact_code", *DIMS),
    "fk_orphans_documented": sql(orphan_rows("fact_documented"), "fact_documented", *DIMS),
    "star_checks": sql(star_check_rows("fact_code"), "fact_code", *DIMS),
    "star_checks_documented": sql(star_check_rows("fact_documented"), "fact_documented", *DIMS),
    "expectations": sql(expectation_rows(), *DIMS),
    "distinct_codes": sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST({c} AS INTEGER) AS code "
            f"FROM (SELECT DISTINCT {c} FROM trips_raw WHERE {c} IS NOT NULL)"
            for c in CODE_COLUMNS
        ),
        "trips_raw",
    ),
    "distinct_hours": sql(
        "SELECT DISTINCT date_trunc('hour', tpep_pickup_datetime) AS pickup_datetime FROM trips_raw "
        "WHERE tpep_pickup_datetime IS NOT NULL",
        "trips_raw",
    ),
    "month_keys": sql("SELECT DISTINCT _month_key AS month_key FROM trips_raw", "trips_raw"),
    "month_count": sql("SELECT count(DISTINCT _month_key) AS months FROM trips_raw", "trips_raw"),
    "rows_per_month": sql(
        "SELECT _month_key AS month_key, count(*) AS row_count FROM trips_raw GROUP BY _month_key", "trips_raw"
    ),
    "total_rows_over_months": sql(
        "SELECT count(*) AS row_count, count(DISTINCT _month_key) AS months FROM trips_raw", "trips_raw"
    ),
    "one_month": sql("SELECT * EXCLUDE (_month_key) FROM trips_raw WHERE _month_key = 'month_03'", "trips_raw"),
    "schema_drift_union": sql(drifted("trips_raw"), "trips_raw"),
    "missing_columns_default": sql(drifted("trips_raw", "0.0"), "trips_raw"),
    "monthly_landing": sql(drifted("trips_raw"), "trips_raw"),
    "streaming_landing": sql(drifted("trips_raw"), "trips_raw"),
    "compacted_landing": sql(drifted("trips_raw"), "trips_raw"),
    "landing_audit": sql(audit("code"), "trips_raw"),
    "month_refresh": sql(
        f"SELECT *, CASE WHEN _month_key = 'month_03' THEN TRUE END AS reissued FROM ({drifted('trips_raw')}) WHERE {REISSUED}",
        "trips_raw",
    ),
    "refresh_report": sql(
        f"SELECT CAST(3 AS INTEGER) AS month, 'loaded' AS status, count(*) AS row_count FROM trips_raw "
        f"WHERE _month_key = 'month_03' AND {REISSUED}",
        "trips_raw",
    ),
    "kept_raw": sql(
        "SELECT _month_key AS month_key, count(*) AS row_count FROM trips_raw GROUP BY _month_key", "trips_raw"
    ),
    "landing_report": sql(
        """SELECT CAST(0 AS INTEGER) AS month, 'skipped' AS status, CAST(NULL AS BIGINT) AS row_count
 UNION ALL SELECT CAST(right(_month_key, 2) AS INTEGER), 'loaded', count(*) FROM trips_raw GROUP BY _month_key""",
        "trips_raw",
    ),
    "sized_files": sql(
        "SELECT _month_key AS month_key, count(*) AS row_count, TRUE AS within_limit FROM trips_raw GROUP BY _month_key",
        "trips_raw",
    ),
    "star_refresh": sql(table_counts("fact_code"), *DIMS, "fact_code"),
    "star_refresh_documented": sql(table_counts("fact_documented"), *DIMS, "fact_documented"),
    "kept_version": sql(table_counts("fact_code"), *DIMS, "fact_code"),
    "stored_trip_detail_documented": sql(
        DETAIL.replace("FROM fact_trips f", f"FROM ({keyed_fact('documented')}) f"), "fact_documented", *DIMS
    ),
    "stored_table_counts_documented": sql(table_counts("fact_documented"), *DIMS, "fact_documented"),
    "stored_trips_range": sql(
        "SELECT * FROM fact_trips WHERE pickup_datetime >= TIMESTAMP '2025-03-15 06:00:00' "
        "AND pickup_datetime < TIMESTAMP '2025-05-01'",
        "fact_trips",
    ),
    "trips_of_pickup_zone": sql("SELECT * FROM fact_trips WHERE pu_location_key = 132", "fact_trips"),
    "trips_of_dropoff_zone": sql("SELECT * FROM fact_trips WHERE do_location_key = 161", "fact_trips"),
    "trips_of_vendor_and_zone": sql(
        "SELECT * FROM fact_trips WHERE vendor_key = 2 AND payment_type_key = 1 AND pu_location_key = 132", "fact_trips"
    ),
    "stored_star_sql": sql(mean_by_payment("code"), "fact_code", "dim_payment_type"),
    "stored_trip_detail": sql(DETAIL, *STAR),
    "upper_medians": sql(f"SELECT {MEDIANS} FROM people_raw", "people_raw"),
    "impute_upper_median": sql(
        f"SELECT {FILLED} FROM people_raw p CROSS JOIN (SELECT {MEDIANS} FROM people_raw) m", "people_raw"
    ),
    "csv_round_trip": sql(
        f"SELECT {FILLED} FROM people_raw p CROSS JOIN (SELECT {MEDIANS} FROM people_raw) m", "people_raw"
    ),
}
