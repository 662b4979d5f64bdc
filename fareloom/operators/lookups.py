"""Dimension members from landed codes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fareloom.functions import hour_floor, truncated_int
from fareloom.operators.keys import number_hours
from fareloom.schemas import DIM_DATETIME, UNKNOWN_KEY, UNKNOWN_LABEL, conform


def distinct_codes(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct non-null codes. Reads one column and merges on the map side before the shuffle."""
    return df.where(f"{column} IS NOT NULL").selectExpr(f"{truncated_int(column)} AS {name}").distinct()


def distinct_hours(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct non-null hours of a timestamp column."""
    return df.where(f"{column} IS NOT NULL").selectExpr(f"{hour_floor(column)} AS {name}").distinct()


def label_of(code: str, labels: dict[int, str], prefix: str) -> str:
    """The label of a known code, else the prefix and the code."""
    known = " ".join(f"WHEN {value} THEN '{label}'" for value, label in labels.items())
    return f"CASE {code} {known} ELSE concat('{prefix} ', {code}) END"


def with_unknown(members: DataFrame, *values: str) -> DataFrame:
    """The members and the unknown member, its values given in column order."""
    named = [f"{value} AS {column}" for value, column in zip(values, members.columns, strict=True)]
    return members.sparkSession.range(1).selectExpr(*named).union(members)


def code_dimension(
    df: DataFrame, code_col: str, key_col: str, label_col: str, labels: dict[int, str], prefix: str
) -> DataFrame:
    """Members keyed by their own code and labelled from a fixed table."""
    members = distinct_codes(df, code_col, key_col).selectExpr(
        key_col, f"{label_of(key_col, labels, prefix)} AS {label_col}"
    )
    return with_unknown(members, f"{UNKNOWN_KEY}", f"'{UNKNOWN_LABEL}'")


def location_dimension(df: DataFrame, code_col: str, key_col: str) -> DataFrame:
    """Zones keyed by their own id."""
    members = distinct_codes(df, code_col, key_col).selectExpr(
        key_col, f"{key_col} AS location_id", f"concat('Zone ', {key_col}) AS zone"
    )
    return with_unknown(members, f"{UNKNOWN_KEY}", f"{UNKNOWN_KEY}", f"'{UNKNOWN_LABEL}'")


def datetime_dimension(df: DataFrame, ts_col: str) -> DataFrame:
    """One member for every hour that occurs, numbered in time order."""
    members = number_hours(distinct_hours(df, ts_col, "datetime_hour"), "datetime_hour", "datetime_key").selectExpr(
        "datetime_key",
        "datetime_hour",
        "year(datetime_hour) AS year",
        "month(datetime_hour) AS month",
        "day(datetime_hour) AS day",
        "hour(datetime_hour) AS hour",
        "date_format(CAST(datetime_hour AS DATE), 'EEEE') AS weekday",
        "weekday(datetime_hour) >= 5 AS is_weekend",
    )
    nothing = [f"CAST(NULL AS {f.dataType.simpleString()})" for f in DIM_DATETIME.fields[1:6]]
    return with_unknown(conform(members, DIM_DATETIME), f"{UNKNOWN_KEY}", *nothing, f"'{UNKNOWN_LABEL}'", "FALSE")
