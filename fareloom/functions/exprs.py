"""SQL expressions shared by the jobs. All are built-in functions, so they stay inside generated code.

They are text rather than Column objects: a projection then crosses to the JVM once, not once per operator.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql.types import DataType, IntegralType


def rounded_int(column: str, data_type: DataType) -> str:
    """Cast to int as PostgreSQL does: fractions round half to even. Whole types skip the detour through double."""
    return f"CAST({column} AS INT)" if isinstance(data_type, IntegralType) else f"CAST(rint({column}) AS INT)"


def truncated_int(column: str) -> str:
    """Cast to int towards zero."""
    return f"CAST({column} AS INT)"


def hour_floor(ts: str) -> str:
    """Start of the hour of a zone-less timestamp.

    date_trunc passes zone-less values through the session zone and moves hours that a clock change skips;
    a date plus whole hours does not.
    """
    return f"(CAST(CAST({ts} AS DATE) AS TIMESTAMP_NTZ) + make_dt_interval(0, hour({ts})))"


def moment(at: dt.datetime) -> str:
    """A zone-less literal. A Python datetime passed as a literal would go through the session zone."""
    return f"TIMESTAMP_NTZ'{at.isoformat(sep=' ')}'"


def elapsed_micros(start: str, end: str) -> str:
    """Microseconds between two zone-less timestamps. timestampdiff would apply the session zone."""
    return f"(({end} - {start}) DIV INTERVAL '0.000001' SECOND)"


def round_cents(x: str) -> str:
    """A double rounded half away from zero to two decimals, judged on its decimal reading: 1.005 gives 1.01.

    Going through decimals is exact but several times dearer than arithmetic, and only matters near a tie.
    Off a tie (more than 1e-4 cents away) counting whole cents gives the same double, so only near-ties, and
    amounts past 1e9 where doubles get coarse, take the decimal way. Amounts no decimal(38,10) holds have no
    cents and stay as they are.
    """
    half_up = f"(abs({x}) * 100D + 0.5D)"
    return (
        f"CASE WHEN abs({half_up} - rint({half_up})) > 1e-4D AND {half_up} < 1e11D"
        f" THEN CASE WHEN {x} < 0 THEN -floor({half_up}) ELSE floor({half_up}) END / 100D"
        f" ELSE coalesce(CAST(round(try_cast({x} AS DECIMAL(38, 10)), 2) AS DOUBLE), {x}) END"
    )


def non_negative_or_null(column: str) -> str:
    """coalesce(x, 0) >= 0, spelled so that it reaches the Parquet reader."""
    return f"({column} IS NULL OR CAST({column} AS DOUBLE) >= 0)"
