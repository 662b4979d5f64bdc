"""Monthly Parquet files whose schemas drift, read as one table."""

from __future__ import annotations

import time
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from fareloom.schemas import MONTH_KEY

REPORT = "month int, path string, status string, error string"
NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
BROKEN_FILE = ("is not a Parquet file", "corrupted file", "org.apache.parquet")
TRIES, PAUSE = 3, 1.0  # of a read that fails; seconds before the second try
FOOTERS = 8  # footers read side by side


def month_path(template: str, year: int, month: int) -> str:
    return template.format(year=year, month=month)


def month_label(month: int) -> str:
    return f"month_{month:02d}"


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower-case and strip column names. Two columns that become one name are an error here, not at first use."""
    names = [c.lower().strip() for c in df.columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"columns share a name after normalisation: {', '.join(repeated)}")
    return df.toDF(*names)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null on the way in, so that later filters need not wrap columns and still push down."""
    return df.select(
        *[
            F.nullif(F.col(f"`{f.name}`"), F.lit(float("nan")).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, (FloatType, DoubleType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def union_months(frames: list[DataFrame]) -> DataFrame:
    """Union by name: absent columns become null, whole numbers widen to bigint or double where months differ."""
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), frames)


def why_skipped(exc: Exception) -> str | None:
    """Why a path holds no table, if the error says so: it is not there, or its files are no Parquet files. None for any other
    error, such as a store that does not answer: the table may well be there."""
    text = str(exc).strip()
    if isinstance(exc, AnalysisException) and exc.getCondition() in NOTHING_THERE:
        return text.splitlines()[0]
    causes = [line.strip() for line in text.splitlines() if line.strip().startswith("Caused by:")]
    if causes and any(sign in causes[-1] for sign in BROKEN_FILE):
        return causes[-1].removeprefix("Caused by: ")
    return None


def open_parquet(spark: SparkSession, path: str, tries: int = TRIES, pause: float = PAUSE) -> tuple[DataFrame | None, str | None]:
    """(table, None), or (None, reason) where there is none to read. Other errors are tried again, with pauses that double, and
    then raised."""
    for attempt in range(tries):
        try:
            return spark.read.parquet(path), None
        except Exception as exc:  # a missing path and a broken file raise different types
            reason = why_skipped(exc)
            if reason is not None:
                return None, reason
            if attempt + 1 == tries:
                raise OSError(f"{path} could not be read in {tries} tries: {str(exc).strip().splitlines()[0]}") from exc
            time.sleep(pause * 2**attempt)
    raise ValueError("no try at all")


def open_all(spark: SparkSession, paths: list[str]) -> list[tuple[DataFrame | None, str | None]]:
    """open_parquet of each path, some side by side: a footer is read by a job of one task."""
    with ThreadPoolExecutor(FOOTERS) as pool:
        return list(pool.map(lambda path: open_parquet(spark, path), paths))


def open_together(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], DataFrame | None, str | None]]:
    """(paths, table, reason): the paths in groups that read as one table, and those that hold none with the reason.

    Spark merges the footers of a group in one job of many tasks, whatever the number of files. A group whose columns have types that
    do not merge, or that holds a path without a table, is cut in two, down to single paths; so files that agree cost one job, and
    each that does not a few more.
    """
    if len(paths) == 1:
        return [(paths, *open_parquet(spark, paths[0]))]
    try:
        return [(paths, spark.read.option("mergeSchema", True).parquet(*paths), None)]
    except Exception:  # whatever it is, single paths tell
        half = len(paths) // 2
        return open_together(spark, paths[:half]) + open_together(spark, paths[half:])


def normalise_together(df: DataFrame) -> DataFrame:
    """normalise_names for a table of many files: columns that become one name are one column where they come from different files,
    and an error where a row has values in two of them."""
    spellings: dict[str, list[str]] = {}
    for c in df.columns:
        spellings.setdefault(c.lower().strip(), []).append(c)
    if len(spellings) == len(df.columns):
        return normalise_names(df)
    columns = []
    for name, cs in spellings.items():
        values = [F.col(quoted(c)) for c in cs]
        if len(cs) == 1:
            columns.append(values[0].alias(name))
            continue
        filled = sum((F.when(v.isNotNull(), 1).otherwise(0) for v in values), F.lit(0))
        clash = F.raise_error(F.lit(f"columns share a name after normalisation: {name}"))
        columns.append(F.when(filled > 1, clash).otherwise(F.coalesce(*values)).alias(name))
    return df.select(*columns)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_months(
    spark: SparkSession, template: str, year: int, months: Iterable[int] = range(1, 13)
) -> tuple[DataFrame, DataFrame]:
    """(trips, report): every month that can be read, marked with its month key, and what happened to each.

    A month that is missing or broken is skipped and reported; none at all is an error. A month that cannot be read for another reason
    stops the load after some tries: taken for missing, it would go from the table. Only file footers are read here.
    """
    frames, report = [], []
    paths = {month: month_path(template, year, month) for month in months}
    for (month, path), (found, reason) in zip(paths.items(), open_all(spark, list(paths.values())), strict=True):
        if found is None:
            report.append((month, path, "skipped", reason))
            continue
        frames.append(nan_to_null(normalise_names(found)).withColumn(MONTH_KEY, F.lit(month_label(month))))
        report.append((month, path, "loaded", None))
    if not frames:
        raise ValueError(f"no month of {year} could be read from {template}")
    return union_months(frames), spark.createDataFrame(report, REPORT)


def with_missing_columns(df: DataFrame, defaults: dict[str, float]) -> DataFrame:
    """Add the columns a month lacks, filled with a default. Columns it has keep their nulls."""
    absent = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df
