"""Staged tables and published versions, on whatever file system a path names."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import partial, reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from fareloom.session import shared_dir


MADE: ContextVar[list[str] | None] = ContextVar("MADE", default=None)
Manifest = dict[str, dict[str, Any]]  # what is known of each folder of a version


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as the executors see them."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder in the shared folder, removed when the session ends or the dropping_scratch block does."""
    path = f"{shared_dir(spark)}/fareloom-{label}-{uuid.uuid4().hex}"
    fs, found = hadoop_path(spark, path)
    fs.mkdirs(found)
    fs.deleteOnExit(found)
    made = MADE.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def dropping_scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch folders made inside the block at its end, when their rows have been written elsewhere."""
    made: list[str] = []
    token = MADE.set(made)
    try:
        yield
    finally:
        MADE.reset(token)
        for path in made:
            discard(spark, path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back, cutting the lineage."""
    spark = df.sparkSession
    path = f"{scratch_path(spark, label)}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# A table set is published in numbered versions. <base>/published/<number> is a version's manifest, which names the folders it is
# made of, relative to <base>; versions may share folders. The file for a number can be created once, so of two loads that began from
# the same version only one becomes the next: no clock takes part. Readers take the highest number.

NUMBER = "{:012d}"


RENAMING = ("hdfs", "viewfs", "abfs", "abfss")  # stores whose rename is one step and refuses a target that is there


class Overtaken(RuntimeError):
    """Another load has published since this one began."""


def new_load() -> str:
    """A name for a load's folders."""
    return uuid.uuid4().hex


def create_new(spark: SparkSession, path: str, data: bytes) -> bool:
    """Create a file, whole at once, unless it is there; False if it is.

    A finished file beside it is linked to the name (local files) or renamed to it (HDFS and the like), both of which fail if the name
    is taken. Object stores show a file when it is complete and need conditional writes for its creation to be exclusive.
    """
    fs, target = hadoop_path(spark, path)
    scheme = fs.getUri().getScheme()
    fs.mkdirs(target.getParent())
    if fs.exists(target):
        return False
    if scheme != "file" and scheme not in RENAMING:
        return written(fs, target, data)
    _, whole = hadoop_path(spark, f"{target.getParent().toString()}/.{uuid.uuid4().hex}")
    written(fs, whole, data)
    try:
        if scheme in RENAMING:
            return bool(fs.rename(whole, target))
        links = spark._jvm.java.nio.file.Files
        links.createLink(*[spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, whole)])
        return True
    except Py4JJavaError as exc:
        if "AlreadyExists" in str(exc.java_exception):
            return False
        raise
    finally:
        fs.delete(whole, False)


def written(fs, target, data: bytes) -> bool:
    try:
        out = fs.create(target, False)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
    except Py4JJavaError as exc:
        if "AlreadyExists" in str(exc.java_exception):
            return False
        raise
    return True


def read_file(spark: SparkSession, path: str) -> bytes:
    fs, found = hadoop_path(spark, path)
    stream = fs.open(found)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, in order; none if it is not there. Hidden files are left out."""
    fs, folder = hadoop_path(spark, path)
    if not fs.exists(folder):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(folder))
    return sorted(n for n in names if not n.startswith("."))


def published(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the published versions, oldest first."""
    return [int(n) for n in file_names(spark, f"{base.rstrip('/')}/published")]


def read_manifest(spark: SparkSession, base: str, number: int) -> Manifest:
    return json.loads(read_file(spark, f"{base.rstrip('/')}/published/{NUMBER.format(number)}"))


def current(spark: SparkSession, base: str) -> tuple[int, Manifest]:
    """(number, manifest) of the version that readers take; (0, {}) before the first."""
    numbers = published(spark, base)
    return (numbers[-1], read_manifest(spark, base, numbers[-1])) if numbers else (0, {})


def current_manifest(spark: SparkSession, base: str) -> Manifest:
    number, manifest = current(spark, base)
    if not number:
        raise FileNotFoundError(f"nothing published under {base}")
    return manifest


def publish(spark: SparkSession, base: str, after: int, manifest: Manifest) -> int:
    """Make a manifest the version after number `after`, the current one when the load began. If another load has published
    meanwhile, this one is refused, as it knows nothing of the other's rows."""
    number = after + 1
    path = f"{base.rstrip('/')}/published/{NUMBER.format(number)}"
    if published(spark, base)[-1:] > [after] or not create_new(spark, path, json.dumps(manifest, indent=1).encode()):
        raise Overtaken(f"{base}: another load published while this one ran")
    return number


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder this library made."""
    fs, found = hadoop_path(spark, path)
    fs.delete(found, True)


def drop_old_versions(spark: SparkSession, base: str, keep: int = 2) -> list[int]:
    """Remove all but the latest `keep` versions: first their manifests, then the folders that no kept version shares. Returns the
    numbers that went."""
    if keep < 1:
        raise ValueError("keep at least the current version")
    base = base.rstrip("/")
    versions = {number: read_manifest(spark, base, number) for number in published(spark, base)}
    old = list(versions)[:-keep]
    needed = {folder for number, manifest in versions.items() if number not in old for folder in manifest}
    unused = dict.fromkeys(folder for number in old for folder in versions[number] if folder not in needed)
    for number in old:
        discard(spark, f"{base}/published/{NUMBER.format(number)}")
    for folder in unused:
        discard(spark, f"{base}/{folder}")
    return old


# A table stored by month in many folders, each written by one load with its own schema.


def read_parts(spark: SparkSession, root: str, parts: dict[str, str]) -> DataFrame:
    """One table of folders below `root`, {<path with key=value folders>: schema as JSON}: a scan per distinct schema, whatever the
    number of folders. Columns that a schema lacks are null, whole numbers widen where schemas differ. Keys in the paths are
    text columns, which prune folders."""
    by_schema: dict[str, list[str]] = {}
    for folder, schema in parts.items():
        by_schema.setdefault(schema, []).append(folder)
    scans = []
    for schema, folders in by_schema.items():
        keys = [step.split("=", 1)[0] for step in folders[0].split("/") if "=" in step]
        known = StructType(StructType.fromJson(json.loads(schema)).fields + [StructField(k, StringType()) for k in keys])
        reader = spark.read.schema(known).option("basePath", root)
        scans.append(reader.parquet(*[f"{root}/{folder}" for folder in folders]))
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), scans)
