"""Helpers shared by the operators on documents."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.sources.storage import MADE, hadoop_path, scratch_path

SHIPPED: set[str] = set()  # applications whose executors have been sent this package


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: their Python need not have it on its path."""
    app = spark.sparkContext.applicationId
    if app in SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    token = MADE.set(None)  # executors that start later fetch it too, so it stays as long as the application
    try:
        path = f"{scratch_path(spark, 'code')}/{package.name}.zip"
    finally:
        MADE.reset(token)
    write_bytes(spark, path, packed.getvalue())
    spark.sparkContext.addPyFile(path)
    SHIPPED.add(app)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small file from the driver to any store that Spark knows."""
    fs, found = hadoop_path(spark, path)
    out = fs.create(found, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def open_file(path: str, mode: str):
    """A file in the shared folder: a mounted path, or any store that pyarrow knows by its address."""
    if path.startswith("file:") or "://" not in path:
        return open(re.sub("^file:/*", "/", path), mode)
    store, name = arrow_fs.FileSystem.from_uri(path)
    return store.open_input_stream(name) if mode == "rb" else store.open_output_stream(name)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that no working column can clash with a name of the input."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns])


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(quoted(column)).cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that what a Python helper builds from one stays small. An empty task gives nothing."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def byte_words(text: str | bytes | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased. bytes.split and bytes.lower know ASCII only, which is
    just this rule on UTF-8."""
    if text is None:
        return []
    return (text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text).lower().split()


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """The values of a string column as bytes, null as empty, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for value in column.cast(kind):
        yield value.as_py() or b""
