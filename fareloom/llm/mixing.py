"""Mixing sources to target weights by systematic sampling.

A source's documents are put in one order; each is expected `target / size` times, and a running sum of these expectations
plus one random offset per source is taken over the order. A document is emitted once per whole number that the sum
crosses at it. The order is by size, so each stretch of sizes gives its share and a source's words stray from its target by
about the size of one document.

The running sum is the document's rank times the expectation. Ranks come from one range partitioning and the row
counts of its partitions, so no source, however large, meets in one task. Only one row per source, which is what the weights
are given for, passes through the driver.

Null texts and texts without words have size 0 and take part with no words. The null source is a source, the last one.
Equal rows stand next to each other, each emitted by its own rank. A source without words has the target 0.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from fareloom.llm.common import quoted, read_table, text_or_empty, whole_row
from fareloom.operators.keys import dense_key
from fareloom.sources.storage import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE, MOST = Fraction(3, 2), 2
SEED = 20_240_601
OFFSETS = 1 << 16  # offsets are multiples of one in this, so that sums over billions of rows stay exact


def targets(sizes: list[int], weights: list[int], share: Fraction = SHARE, most: int = MOST) -> list[Fraction]:
    """Words wanted of each source: by weight, at most `most` times its size, the excess shared again by weight."""
    left, found = share * sum(sizes), [Fraction(0)] * len(sizes)
    open_ones = list(range(len(sizes)))
    while open_ones:
        weight = sum(weights[i] for i in open_ones)
        full = [i for i in open_ones if left * weights[i] > most * sizes[i] * weight]
        if not full:
            for i in open_ones:
                found[i] = left * weights[i] / weight
            return found
        for i in full:
            found[i] = Fraction(most * sizes[i])
        left -= sum(found[i] for i in full)
        open_ones = [i for i in open_ones if i not in set(full)]
    return found


def cycled(place: int) -> int:
    """The weight of the source at this place of the order by code point."""
    return WEIGHTS[place % len(WEIGHTS)]


def plan_sources(sized: DataFrame, weight: Callable[[int], int], seed: int) -> DataFrame:
    """(source, source_size, target, rate, shift, earlier): what each source's documents are emitted by."""
    rows = (
        sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs"))
        .orderBy(F.col("source").asc_nulls_last()).collect()
    )
    wanted = targets([r["size"] for r in rows], [weight(i) for i in range(len(rows))])
    planned, earlier = [], 0
    for row, target in zip(rows, wanted, strict=True):
        shift = random.Random(f"{seed}:{row['source']!r}").randrange(OFFSETS) / OFFSETS
        rate = float(target / row["size"]) if row["size"] else 0.0
        planned.append((row["source"], row["size"], float(target), rate, shift, earlier))
        earlier += row["docs"]
    schema = StructType(
        [StructField("source", StringType()), StructField("source_size", LongType())]
        + [StructField(c, DoubleType()) for c in ("target", "rate", "shift")]
        + [StructField("earlier", LongType())]
    )
    return sized.sparkSession.createDataFrame(planned, schema)


def mix_sources(
    docs: DataFrame,
    source_col: str = "source",
    text_col: str = "text",
    carry: list[str] | None = None,
    weight: Callable[[int], int] = cycled,
    seed: int = SEED,
) -> DataFrame:
    """(row, size, source_size, target, copies), one row per document; `row` is the input row (only the columns `carry`, if
    given) and `copies` how often the mix takes it."""
    sized = stage(
        docs.select(
            whole_row(docs if carry is None else docs.select(*map(quoted, carry))).alias("row"),
            F.col(quoted(source_col)).cast("string").alias("source"),
            F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("bigint").alias("size"),
            F.xxhash64(*[F.col(quoted(c)) for c in docs.columns if c in (carry or docs.columns)]).alias("spread"),
        ),
        "sized",
    )
    sources = plan_sources(sized, weight, seed)
    ranked = dense_key(sized, ["source", "size", "spread"], "rank")
    sources = sources.withColumnRenamed("source", "name")
    place = F.col("rank") - F.col("earlier")

    def crossed(places):
        return F.floor(places * F.col("rate") + F.col("shift"))

    return ranked.join(sources, F.col("source").eqNullSafe(F.col("name"))).select(
        "row", "size", "source_size", "target", (crossed(place) - crossed(place - 1)).alias("copies")
    )


def emit_mix(docs: DataFrame, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself: each document as many times as it is taken."""
    mixed = mix_sources(docs, source_col, text_col).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select("row.*")


def op9_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )
