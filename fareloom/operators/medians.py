"""Exact upper medians (element n // 2 of the sorted non-null values) and imputation with them.

percentile_disc gives the same value but keeps every distinct value of a column in one aggregation buffer. Here the input is read
twice, whatever its values. The first pass counts values and keeps a mergeable rank sketch per column, whose two quantiles around
the middle bracket the wanted rank within a few ten-thousandths of the rows. The second counts the rows below the bracket and, value by
value, those inside it, into a small staged table. There each pass counts the bracket's values slot by slot, and the slot that
holds the wanted rank becomes the next bracket, until it holds one value; the lowest and highest value of a bracket never
share a slot, so each pass narrows it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
)

from fareloom.sources.storage import dropping_scratch, stage

SLOTS = 512  # of each kind, per column and pass; the driver reads back at most 2 * SLOTS rows per column
ACCURACY = 10_000  # a quantile of the sketch is off by at most one in this many ranks
MARGIN = 4  # such errors between the middle and either end of the bracket
LOG_SHIFT = 750.0  # makes the logarithm of any double's size positive: the smallest is about -744.4


@dataclass
class Bracket:
    """The values of a column that can still be the one of rank `rank` (from 0)."""

    low: Any
    high: Any
    rows: int
    below: int
    rank: int


def exact_type(data_type: DataType) -> DataType:
    """The type in which a column's values and their differences are compared."""
    if isinstance(data_type, (ByteType, ShortType, IntegerType, FloatType, DoubleType)):
        return DoubleType()
    if isinstance(data_type, LongType):
        return DecimalType(20, 0)
    if isinstance(data_type, DecimalType):
        return data_type
    raise TypeError(f"no median over {data_type.simpleString()}")


def present(column: str, data_type: DataType) -> Column:
    """The value in its exact type; NaN counts as missing."""
    value = F.col(column).cast(exact_type(data_type))
    if isinstance(data_type, (FloatType, DoubleType)):
        return F.when(~F.isnan(value), value)
    return value


@dataclass
class Outline:
    """What the first pass tells of a column. The sketch works on doubles: `low` and `high` bracket the wanted rank there."""

    rows: int
    low: float
    high: float

    @property
    def rank(self) -> int:
        return self.rows // 2


def outlines(df: DataFrame, values: dict[str, Column]) -> dict[str, Outline]:
    """The first pass. Where the margin is less than a row, the bracket is everything."""
    shares = [0.5 - MARGIN / ACCURACY, 0.5 + MARGIN / ACCURACY]
    measures = []
    for i, value in enumerate(values.values()):
        x = value.cast("double")
        measures += [F.count(value).alias(f"n{i}"), F.percentile_approx(x, shares, ACCURACY).alias(f"q{i}")]
    row = df.agg(*measures).first()
    empty = [c for i, c in enumerate(values) if row[f"n{i}"] == 0]
    if empty:
        raise ValueError(f"no values to take a median of in {', '.join(empty)}")
    found = {}
    for i, c in enumerate(values):
        n, (low, high) = row[f"n{i}"], row[f"q{i}"]
        found[c] = Outline(n, low, high) if n > ACCURACY else Outline(n, -math.inf, math.inf)
    return found


def counted_values(df: DataFrame, values: dict[str, Column], kinds: dict[str, int], found: dict[str, Outline]) -> DataFrame:
    """(column_name, v0, v1, .., rows): the second pass. Values inside their column's bracket with their rows, each in the v of its kind;
    the rows below a bracket have no value. Rows above it are left out. Copies merge on the map side."""
    cells = []
    n_kinds = max(kinds.values()) + 1
    for name, o in found.items():
        x = values[name].cast("double")
        inside = x.between(o.low, o.high)
        cells += [F.lit(name), F.when(x < o.low, True).when(inside, False)]
        cells += [F.when(inside, values[name]) if k == kinds[name] else F.lit(None) for k in range(n_kinds)]
    columns = [f"v{k}" for k in range(n_kinds)]
    return (
        df.select(F.stack(F.lit(len(found)), *cells).alias("column_name", "is_below", *columns))
        .where("is_below IS NOT NULL")
        .groupBy("column_name", *columns)
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def brackets_of(counted: DataFrame, columns: list[str], found: dict[str, Outline]) -> dict[str, Bracket]:
    """The brackets with their exact ends and the rows below them."""
    measures = [F.sum("rows").alias("rows")]
    for v in columns:
        inside = F.when(F.col(v).isNotNull(), F.col("rows"))
        measures += [F.sum(inside).alias(f"n_{v}"), F.min(v).alias(f"lo_{v}"), F.max(v).alias(f"hi_{v}")]
    result = {}
    for row in counted.groupBy("column_name").agg(*measures).collect():  # a row per column
        name = row["column_name"]
        for v in columns:
            if row[f"n_{v}"]:
                inside = row[f"n_{v}"]
                result[name] = Bracket(row[f"lo_{v}"], row[f"hi_{v}"], inside, row["rows"] - inside, found[name].rank)
    return result


def magnitude(x: float) -> float:
    """Grows with x over all finite doubles and is even in their logarithm; see log_slot."""
    return 0.0 if x == 0 else math.copysign(math.log(abs(x)) + LOG_SHIFT, x)


def even_slot(value: Column, b: Bracket, slots: int) -> Column:
    """Slots of equal width. Halving first keeps the width of a very wide bracket finite."""
    if isinstance(b.low, Decimal):
        share = (value - F.lit(b.low)).cast("double") / float(b.high - b.low)
    elif math.isinf(b.high - b.low):
        share = (value * 0.5 - b.low * 0.5) / (b.high * 0.5 - b.low * 0.5)
    else:
        share = (value - b.low) / (b.high - b.low)
    return F.least(F.floor(share * slots), F.lit(slots - 1))


def log_slot(value: Column, b: Bracket, slots: int) -> Column:
    """Slots of equal ratio. Java's log never falls as its argument grows, so neither does the slot."""
    x = value.cast("double")
    size = F.when(x == 0, 0.0).otherwise(F.signum(x) * (F.log(F.abs(x)) + LOG_SHIFT))
    low, high = magnitude(float(b.low)), magnitude(float(b.high))
    if not low < high:
        return F.lit(0)
    return F.least(F.greatest(F.floor((size - low) / (high - low) * slots), F.lit(0)), F.lit(slots - 1))


def slot_of(value: Column, b: Bracket, slots: int) -> Column:
    """Slot of a value within [low, high]: never falls as the value grows, and differs between low and high.

    Equal widths split most data well, but put everything in one slot where a few values are vastly larger;
    equal ratios split that. Both grow with the value, so together they make at most 2 * slots slots.
    Infinite ends take a slot of their own.
    """
    if isinstance(b.low, float) and (math.isinf(b.low) or math.isinf(b.high)):
        return F.when(value == float("-inf"), 0).when(value == float("inf"), 2).otherwise(1)
    return (even_slot(value, b, slots) * slots + log_slot(value, b, slots)).cast("int")


def narrowed(counted: DataFrame, v: str, brackets: dict[str, Bracket], slots: int) -> dict[str, Bracket]:
    """One pass over the counted values of one kind."""
    value = F.col(v)
    slot = inside = None
    for name, b in brackets.items():
        mine = F.col("column_name") == name
        held = mine & value.between(F.lit(b.low), F.lit(b.high))
        number = slot_of(value, b, slots)
        slot = F.when(mine, number) if slot is None else slot.when(mine, number)
        inside = held if inside is None else inside | held
    slots_of = (
        counted.where(inside)
        .groupBy("column_name", slot.alias("slot"))
        .agg(F.sum("rows").alias("rows"), F.min(v).alias("low"), F.max(v).alias("high"))
        .orderBy("column_name", "slot")
        .collect()  # at most 2 * SLOTS rows per column
    )
    found, passed = {}, {}
    for row in slots_of:
        name = row["column_name"]
        below = passed.setdefault(name, brackets[name].below)
        passed[name] = below + row["rows"]
        if below <= brackets[name].rank < passed[name]:
            found[name] = Bracket(row["low"], row["high"], row["rows"], below, brackets[name].rank)
    return found


def median_values(df: DataFrame, cols: Sequence[str], slots: int = SLOTS) -> dict[str, Any]:
    """The upper median of every column, in the column's own type. A column without values is an error."""
    types = {c: df.schema[c].dataType for c in cols}
    values = {c: present(c, types[c]) for c in cols}
    exact = list(dict.fromkeys(exact_type(types[c]) for c in cols))
    kinds = {c: exact.index(exact_type(types[c])) for c in cols}
    found = outlines(df, values)
    with dropping_scratch(df.sparkSession):
        medians = search(df, values, kinds, found, slots)
    return {c: as_python(medians[c], types[c]) for c in cols}


def search(
    df: DataFrame, values: dict[str, Column], kinds: dict[str, int], found: dict[str, Outline], slots: int
) -> dict[str, Any]:
    """The medians of columns whose brackets are known from the first pass."""
    counted = stage(counted_values(df, values, kinds, found), "median-brackets")
    columns = [f"v{k}" for k in range(max(kinds.values()) + 1)]
    open_brackets = brackets_of(counted, columns, found)
    missed = [c for c, b in open_brackets.items() if not b.below <= b.rank < b.below + b.rows]
    missed += [c for c in found if c not in open_brackets]
    if missed:  # beyond the sketch's bound, which its kind keeps; the values decide all the same
        wider = {c: Outline(o.rows, -math.inf, math.inf) if c in missed else o for c, o in found.items()}
        return search(df, values, kinds, wider, slots)
    medians: dict[str, Any] = {}
    while open_brackets:
        for name in [c for c, b in open_brackets.items() if b.low == b.high]:
            medians[name] = open_brackets.pop(name).low
        for k, v in enumerate(columns):
            mine = {c: b for c, b in open_brackets.items() if kinds[c] == k}
            if mine:
                open_brackets.update(narrowed(counted, v, mine, slots))
    return medians


def as_python(value: Any, data_type: DataType) -> Any:
    if isinstance(data_type, (ByteType, ShortType, IntegerType, LongType)):
        return int(value)
    return value


def upper_medians(df: DataFrame, cols: Sequence[str], **limits: int) -> DataFrame:
    """One row with the upper median of every column."""
    medians = median_values(df, cols, **limits)
    schema = StructType([StructField(c, df.schema[c].dataType) for c in cols])
    return df.sparkSession.createDataFrame([Row(**medians)], schema)


def impute_upper_median(df: DataFrame, cols: Sequence[str], **limits: int) -> DataFrame:
    """The named columns only, with missing values replaced by the column's upper median."""
    medians = median_values(df, cols, **limits)
    filled = []
    for c in cols:
        data_type = df.schema[c].dataType
        value = F.col(c)
        if isinstance(data_type, (FloatType, DoubleType)):
            value = F.when(~F.isnan(value), value)
        filled.append(F.coalesce(value, F.lit(medians[c]).cast(data_type)).alias(c))
    return df.select(*filled)
