"""Cleaning rules for landed trips, and the account of what they remove."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from fareloom.functions import elapsed_micros, moment, non_negative_or_null
from fareloom.schemas import MONTH_KEY
from fareloom.sources.months import with_missing_columns

MAX_MINUTES = 600
MAX_MILES = 500
MICROS_PER_MINUTE = 60_000_000
PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"
MEASURES = ["passenger_count", "trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount"]


@dataclass(frozen=True)
class CleaningPolicy:
    """Bounds are start-inclusive and end-exclusive; None leaves that side open."""

    name: str
    pickup_from: dt.date
    pickup_before: dt.date | None
    dropoff_before: dt.date | None
    strict_duration: bool
    drop_duplicates: bool
    fill_missing_columns: bool

    @property
    def last_pickup_bound(self) -> dt.date | None:
        """No kept pickup reaches this day: a pickup never follows its dropoff."""
        bounds = [b for b in (self.pickup_before, self.dropoff_before) if b is not None]
        return min(bounds) if bounds else None


POLICIES = {
    "code": CleaningPolicy("code", dt.date(2025, 1, 1), dt.date(2026, 1, 1), None, False, False, False),
    "documented": CleaningPolicy("documented", dt.date(2015, 1, 1), None, dt.date(2026, 1, 1), True, True, True),
}


def as_policy(policy: str | CleaningPolicy) -> CleaningPolicy:
    return POLICIES[policy] if isinstance(policy, str) else policy


def midnight(day: dt.date) -> str:
    return moment(dt.datetime.combine(day, dt.time()))


def rules(policy: str | CleaningPolicy) -> list[tuple[str, str]]:
    """(reason, keep condition) in the order in which a reject is blamed."""
    p = as_policy(policy)
    within = f"{elapsed_micros(PICKUP, DROPOFF)} {{}} {MAX_MINUTES * MICROS_PER_MINUTE}"

    found = [
        ("pickup_missing", f"{PICKUP} IS NOT NULL"),
        ("dropoff_missing", f"{DROPOFF} IS NOT NULL"),
        ("pickup_location_missing", "pulocationid IS NOT NULL"),
        ("dropoff_location_missing", "dolocationid IS NOT NULL"),
        ("pickup_too_early", f"{PICKUP} >= {midnight(p.pickup_from)}"),
    ]
    if p.pickup_before is not None:
        found.append(("pickup_too_late", f"{PICKUP} < {midnight(p.pickup_before)}"))
    if p.dropoff_before is not None:
        found.append(("dropoff_too_late", f"{DROPOFF} < {midnight(p.dropoff_before)}"))
    found.append(("dropoff_before_pickup", f"{PICKUP} <= {DROPOFF}"))
    # The order of pickup and dropoff already holds here, which leaves the zero and the upper end to check.
    if p.strict_duration:
        found.append(("duration_out_of_range", f"({PICKUP} < {DROPOFF} AND {within.format('<')})"))
    else:
        found.append(("duration_out_of_range", within.format("<=")))
    return found + [
        ("distance_negative", non_negative_or_null("trip_distance")),
        ("distance_too_long", f"(trip_distance IS NULL OR CAST(trip_distance AS DOUBLE) < {MAX_MILES})"),
        ("fare_negative", non_negative_or_null("fare_amount")),
        ("total_negative", non_negative_or_null("total_amount")),
        ("tip_negative", non_negative_or_null("tip_amount")),
    ]


def keeps(policy: str | CleaningPolicy) -> str:
    """The row-level rules as one condition. Filters read it as separate conjuncts and push them down."""
    return " AND ".join(condition for _, condition in rules(policy))


def reject_reason(policy: str | CleaningPolicy) -> str:
    """The first rule a row breaks, null for a row that passes."""
    cases = " ".join(f"WHEN ({keep}) IS NOT TRUE THEN '{reason}'" for reason, keep in rules(policy))
    return f"CASE {cases} END"


def trip_columns(raw: DataFrame) -> list[str]:
    """The landed columns, quoted: files may bring extra columns under any name."""
    return [f"`{c}`" for c in raw.columns if c != MONTH_KEY]


def with_measures(raw: DataFrame, policy: CleaningPolicy) -> DataFrame:
    """The landed trips with measures that no month brought filled with 0.0, where the policy says so."""
    return with_missing_columns(raw, dict.fromkeys(MEASURES, 0.0)) if policy.fill_missing_columns else raw


def clean_trips(raw: DataFrame, policy: str | CleaningPolicy = "code") -> DataFrame:
    """Rows that pass every rule, without the month key.

    Copies differ in no rule column, so filtering first removes the same rows and shuffles fewer. The
    aggregate behind distinct() merges copies on the map side, so a hot group of copies crosses the shuffle
    as one row per task.
    """
    p = as_policy(policy)
    raw = with_measures(raw, p)
    kept = raw.where(keeps(p)).select(*trip_columns(raw))
    return kept.distinct() if p.drop_duplicates else kept


def rejected_trips(raw: DataFrame, policy: str | CleaningPolicy = "code") -> DataFrame:
    """Every removed row with the reason; `copies` counts the rows a record stands for.

    One for a broken rule, and the copies beyond the first for a duplicate, so clean rows plus the sum of
    copies equals the raw rows.
    """
    p = as_policy(policy)
    raw = with_measures(raw, p)
    columns = trip_columns(raw)
    tagged = raw.selectExpr(*columns, f"{reject_reason(p)} AS reject_reason")
    if not p.drop_duplicates:
        return tagged.where("reject_reason IS NOT NULL").selectExpr("*", "1L AS copies")
    # One scan: broken rows go through the aggregate that finds copies, each as a group of its own by its place in the scan.
    place = "IF(reject_reason IS NULL, 0L, 1 + monotonically_increasing_id()) AS _place"
    return (
        tagged.selectExpr("*", place)
        .groupBy(*columns, "reject_reason", "_place")
        .count()
        .where("reject_reason IS NOT NULL OR count > 1")
        .selectExpr(
            *columns,
            "coalesce(reject_reason, 'duplicate') AS reject_reason",
            "IF(reject_reason IS NULL, count - 1, 1L) AS copies",
        )
    )
