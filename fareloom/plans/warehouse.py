"""The two jobs end to end: land the raw table, rebuild the star schema."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fareloom.operators.cleaning import CleaningPolicy, as_policy, keeps
from fareloom.plans.dimensions import build_dims
from fareloom.plans.fact import build_fact
from fareloom.sinks import write_star
from fareloom.sinks.tables import LOAD_REPORT, RAW_TABLE, LostMonths, months_of, write_months
from fareloom.sources import read_months
from fareloom.sources.months import REPORT, month_label
from fareloom.sources.storage import current


def land_raw(
    spark: SparkSession,
    template: str,
    year: int,
    base: str,
    months: Iterable[int] = range(1, 13),
    drop_months: bool = False,
    keep_others: bool = False,
    policy: str | CleaningPolicy | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(load report, month report) of replacing the raw table with the months that can be read, or with `keep_others` of replacing
    these months only. The month report says what happened to each month and how many rows it brought, counted as they were written;
    with a cleaning policy also how many of them its rules keep and remove, which saves the audit its scan.

    A load without any row is an error and changes nothing. So is one that would take a month out of the table, because it
    could not be read or brought no rows, unless `drop_months` says that it may go.
    """
    trips, report = read_months(spark, template, year, months)
    found = report.collect()
    loaded = [month_label(r["month"]) for r in found if r["status"] == "loaded"]
    lost = sorted(set(months_of(current(spark, base)[1])) - set(loaded))
    if lost and not drop_months and not keep_others:  # else it is known when the rows have been counted
        raise LostMonths(f"the load lacks months that the table holds: {', '.join(lost)}")
    counts = {} if policy is None else {"clean_rows": rows_kept(trips, as_policy(policy))}
    written = write_months(trips, base, loaded, keep_others, drop_months, counts=counts)
    if not written:
        raise ValueError(f"no rows in {', '.join(loaded)}: the table stays as it is")
    names = {"rows": "row_count", **{c: c for c in counts}}

    def brought(r: Row) -> list[int | None]:
        return [written.get(month_label(r["month"]), {}).get(c, 0) if r["status"] == "loaded" else None for c in names]

    load = spark.createDataFrame([(RAW_TABLE, sum(known["rows"] for known in written.values()))], LOAD_REPORT)
    columns = ", ".join(f"{name} bigint" for name in names.values())
    months_report = spark.createDataFrame([(*r, *brought(r)) for r in found], f"{REPORT}, {columns}")
    return load, months_report.selectExpr("*", "row_count - clean_rows AS removed_rows") if counts else months_report


def rows_kept(trips: DataFrame, policy: CleaningPolicy) -> Column:
    """The rows that a policy's rules keep, as an aggregate."""
    if policy.drop_duplicates:
        raise ValueError(f"copies of a trip are not known while it is written: no audit by {policy.name} in the load")
    return F.count_if(F.expr(keeps(policy)))


def refresh_star(raw: DataFrame, base: str, policy: str | CleaningPolicy = "code", **layout: Any) -> DataFrame:
    """Rebuild and publish the star schema from a stored raw table, landed at once (read_raw) or file by file
    (the output of land_incremental); returns the rows of each table. `layout`, `row_group_bytes` and `max_records_per_file` say how the
    fact table is stored, see sinks.write_fact."""
    return write_star(
        raw.sparkSession,
        base,
        build_dims(raw),
        lambda stored: build_fact(raw, stored["dim_datetime"], policy),
        **layout,
    )
