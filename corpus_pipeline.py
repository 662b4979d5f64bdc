"""From raw documents to a training mix, stage by stage; each stage's rows are stored and read by the next.

Quality rules drop what passes the adaptive cutoffs of its language and source, and texts of 50 words or more that mostly repeat
themselves; near-dedup keeps one document of each class
(five-word shingles, similarity 0.8); decontamination cuts benchmark passages; the secret scan replaces credentials; mixing
emits each document as often as its source's target asks. All stages take and (but for the repetitions of the last) return the
columns of documents. Nulls, empty texts, repeated rows and extra columns: see the operators.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from fareloom.llm.common import read_table, ship_package
from fareloom.llm.credentials import redact
from fareloom.llm.decontaminate import decontaminate
from fareloom.llm.mixing import emit_mix
from fareloom.llm.near_dedup import deduplicate
from fareloom.llm.quality import keep_quality
from fareloom.sources.storage import MADE, discard, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

HELD: dict[str, list[str]] = {}  # by application: tables that the last stage's result was read from


def step(work: Stage) -> Stage:
    """A stage that first removes the intermediate tables of the one before: its result has been stored by then. Tables that
    `docs` itself still reads stay."""

    @wraps(work)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        app = spark.sparkContext.applicationId
        held, made = HELD.pop(app, []), []
        needed = docs.inputFiles() if held else []
        for path in held:
            folder = path.rsplit("/", 1)[1]
            if any(f"/{folder}/" in file for file in needed):
                made.append(path)
            else:
                discard(spark, path)
        token = MADE.set(made)
        try:
            return work(spark, docs, sf_dir)
        finally:
            MADE.reset(token)
            HELD[app] = made

    return run_step


@step
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs)


@step
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs)


@step
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


@step
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


@step
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return emit_mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scan),
    ("mixing", source_mix),
]

# No SQL for the whole: near-duplicate classes need an iteration and the mix a seeded offset. Tests compare it with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    made: list[str] = []
    for name, work in STAGES:
        result = work(spark, docs, sf_dir)
        token = MADE.set([])
        try:
            docs = stage(result, name.replace(" ", "-"))
            made += MADE.get()
        finally:
            MADE.reset(token)
        for path in made[:-1]:  # the next stage reads the last one only
            discard(spark, path)
        made = made[-1:]
    return docs
