"""Incremental landing of monthly files.

Each batch is stored by month below <out>/batches/load=<batch>, and <out>/log/<batch> says what it holds: its folders, their rows and
the schema they were written in. Readers go by the log alone, so a batch counts once its entry is there, whole at once, and a
table of any number of batches is a scan per distinct schema. Compaction stores many small batches again as one, and its entry
takes the place of theirs.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareloom.schemas import MONTH_KEY
from fareloom.sinks.tables import store_months
from fareloom.sources.months import month_label, nan_to_null, normalise_together, open_together, union_months
from fareloom.sources.storage import NUMBER, Manifest, create_new, discard, file_names, hadoop_path, new_load, read_parts

MONTH_IN_PATH = re.compile(r"\d{4}-(\d{2})\.parquet(?:/|$)")  # a month is one file, or a folder of part files
SKIPPED = "path string, reason string"
SMALL = 1_000_000  # rows of a batch that compaction takes up
MERGED = "merged-"


def land_incremental(
    spark: SparkSession, src_dir: str, out: str, checkpoint: str, files_per_batch: int = 1_000
) -> StreamingQuery:
    """Land every file that is new since the last run in `out`, then stop. Read the result with read_landed.

    The stream carries file names; a batch reads its files as the batch job does, so extra columns,
    odd spellings and other types land as they do there. A batch that is run again replaces its folder, unless its log entry is
    there, so each file lands exactly once. Files whose path names no month, or that are no Parquet files, are listed in
    `out`/skipped and do not land; a file that cannot be read for another reason stops the stream. A file re-issued under its old name is not read again: replace the month with land_raw for that.
    """
    arriving = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(src_dir)
        .select("path")  # the contents are not read here
    )

    def land(batch: DataFrame, number: int) -> None:
        land_files(batch.sparkSession, [r["path"] for r in batch.collect()], out, number)  # files_per_batch rows at most

    return (
        arriving.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def land_files(spark: SparkSession, paths: list[str], out: str, number: int) -> None:
    """Write one batch. Its footers are merged by one job, or a few where types differ; the files of one month and group are one
    scan."""
    name = NUMBER.format(number)
    fs, entry = hadoop_path(spark, f"{out}/log/{name}")
    if fs.exists(entry):
        return
    months = {path: MONTH_IN_PATH.search(path) for path in paths}
    skipped = [(path, "its path names no month") for path, month in months.items() if month is None]
    named = {path: month_label(int(month[1])) for path, month in months.items() if month is not None}
    frames = []
    for group, table, reason in open_together(spark, list(named)) if named else []:
        if table is None:
            skipped += [(path, reason) for path in group]
            continue
        by_month: dict[str, list[str]] = defaultdict(list)
        for path in group:
            by_month[named[path]].append(path)
        for month, files in by_month.items():
            rows = nan_to_null(normalise_together(spark.read.schema(table.schema).parquet(*files)))
            frames.append(rows.withColumn(MONTH_KEY, F.lit(month)))
    if skipped:
        spark.createDataFrame(skipped, SKIPPED).write.mode("overwrite").json(f"{out}/skipped/{number}")
    if frames:
        folders = store_months(union_months(frames), f"{out}/batches/load={name}", sorted(set(named.values())))
        log_batch(spark, out, name, folders, [])


def log_batch(spark: SparkSession, out: str, name: str, folders: Manifest, replaces: list[str]) -> bool:
    """Write a log entry; False if there is one of that name."""
    return create_new(spark, f"{out}/log/{name}", json.dumps({"folders": folders, "replaces": replaces}).encode())


def read_log(spark: SparkSession, out: str) -> dict[str, dict]:
    """All entries by name, in order. One job reads them, however many there are."""
    if not file_names(spark, f"{out}/log"):
        raise FileNotFoundError(f"nothing landed under {out}")
    entries = spark.read.text(f"{out}/log", wholetext=True).select(F.input_file_name().alias("file"), "value").collect()
    return {name: json.loads(value) for name, value in sorted((e["file"].rsplit("/", 1)[1], e["value"]) for e in entries)}


def counted(log: dict[str, dict]) -> dict[str, Manifest]:
    """Folders of each batch that counts: those of the log less those that a compaction has replaced."""
    gone = {name for entry in log.values() for name in entry["replaces"]}
    return {name: entry["folders"] for name, entry in log.items() if name not in gone}


def read_batches(spark: SparkSession, out: str, batches: dict[str, Manifest]) -> DataFrame:
    parts = {folder: known["schema"] for folders in batches.values() for folder, known in folders.items()}
    if not parts:
        raise FileNotFoundError(f"no rows landed under {out}")
    return read_parts(spark, f"{out}/batches", parts).drop("load")


def read_landed(spark: SparkSession, out: str) -> DataFrame:
    """All batches as one table, by column name; columns a batch lacks are null, whole numbers widen where batches differ."""
    return read_batches(spark, out, counted(read_log(spark, out)))


def compact_landed(spark: SparkSession, out: str, small: int = SMALL) -> DataFrame:
    """Store batches of fewer than `small` rows again as one, in one schema; returns (batch, row_count) of those it replaced.

    The last batch stays, as a stream that stopped within it runs it again. Readers see the small batches or the one in their
    place, never both; of two compactions at a time one is discarded. The files stay for those who still read them until
    drop_compacted.
    """
    log = read_log(spark, out)
    batches = counted(log)
    sizes = {name: sum(known["rows"] for known in folders.values()) for name, folders in batches.items()}
    last = max((name for name in log if not name.startswith(MERGED)), default="")
    chosen = [name for name, rows in sizes.items() if rows < small and name != last]
    report = "batch string, row_count bigint"
    if len(chosen) < 2:
        return spark.createDataFrame([], report)
    name = f"{MERGED}{NUMBER.format(sum(n.startswith(MERGED) for n in log))}"
    root = f"{out}/batches/load={name}-{new_load()}"
    folders = store_months(read_batches(spark, out, {n: batches[n] for n in chosen}), root, None, mixed=True)
    if not log_batch(spark, out, name, folders, chosen):
        discard(spark, root)
        raise RuntimeError(f"{out}: another compaction ran at the same time")
    return spark.createDataFrame([(n, sizes[n]) for n in chosen], report)


def drop_compacted(spark: SparkSession, out: str) -> list[str]:
    """Remove the batches that compactions have replaced, entry and files; returns their names. The compactions' own entries
    stay and go on saying what they replaced."""
    log = read_log(spark, out)
    old = [name for name in log if name not in counted(log)]
    for name in old:
        for folder in {folder.split("/", 1)[0] for folder in log[name]["folders"]}:
            discard(spark, f"{out}/batches/{folder}")
        if not name.startswith(MERGED):
            discard(spark, f"{out}/log/{name}")
    return old
