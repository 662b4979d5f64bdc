"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from fareloom.functions import rounded_int
from fareloom.schemas import UNKNOWN_KEY
from fareloom.sources.storage import stage

ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition in the low 33 bits


def natural_key(column: str, data_type: DataType) -> str:
    """The code itself as the key, the unknown member for a null."""
    return f"coalesce({rounded_int(column, data_type)}, {UNKNOWN_KEY})"


def number_hours(hours: DataFrame, column: str, name: str) -> DataFrame:
    """Dense int key 1..n over distinct hours in ascending order.

    The one-task window is bounded by the calendar, not by the data: distinct hours of a timestamp column
    number at most 8,784 a year whatever the row count.
    """
    return hours.withColumn(name, F.row_number().over(Window.orderBy(column)))


def dense_key(df: DataFrame, order: Sequence[str], name: str, tiebreak: Column | str | None = None) -> DataFrame:
    """Dense bigint key 1..N in `order` (nulls last), with no task holding more than its share of the rows.

    Rows are range-partitioned and sorted once and written to a table in the shared folder, together with
    their partition and place in it. A row's key is then its partition's offset plus its place, and the
    offsets come from one row count per partition. `tiebreak` comes after `order` so that one hot key, even a third of
    all rows being exact copies, spreads over many ranges. It must give a row the same value when a task is
    retried: the default, the row's place in the input, does so for plain scans; pass a hash of distinguishing
    columns after a shuffle. A tiebreak given as the name of a column is not part of the result, nor of the staged table.

    The written table fixes partition and place for good: a lost executor re-reads them, never re-derives them.
    """
    named = isinstance(tiebreak, str)
    tie, part, place = tiebreak if named else "_tie", "_part", "_place"
    columns = [c for c in df.columns if c != tie]
    keys = [F.col(c).asc_nulls_last() for c in order]
    ranged = (
        (df if named else df.withColumn(tie, F.monotonically_increasing_id() if tiebreak is None else tiebreak))
        .repartitionByRange(*keys, F.col(tie))
        .sortWithinPartitions(*keys, F.col(tie))
    )
    placed = stage(
        ranged.select(
            *columns,
            F.spark_partition_id().alias(part),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias(place),
        ),
        "dense-key",
    )
    # One row per range partition, so spark.sql.shuffle.partitions bounds this table and its broadcast.
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(part, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), part).select(
        (F.col("_offset") + F.col(place) + 1).alias(name), *columns
    )
