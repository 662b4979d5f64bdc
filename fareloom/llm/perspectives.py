"""Multi-party perspective rotation: a dialogue rendered once for each of its participants.

From a participant's perspective its own messages are the assistant's, those of others are a user's who is named, and system
messages stay what they are; the mask covers the participant's texts, each with its end marker, and nothing else.

A dialogue is one row per participant, whatever its length. Messages get their place from one range partitioning by conversation,
turn, speaker and text, not from a window per conversation; runs of RUN messages are rendered side by side, for each participant, and
only the finished runs of a participant's rendering meet, one row for RUN messages. With `part` set, a rendering comes in parts of that many
messages instead, each of which begins with the conversation's opening system messages.

A missing or empty role speaks as `unknown`; a null text is empty; the null conversation is one conversation; messages of the same
turn follow speaker and text, repeated rows included. A conversation in which only the system speaks has no
participant and so no rendering. Markers inside a text get a space so that they cannot pass for markers. An empty table gives no rows;
only the four named columns are read, so others cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareloom.llm.common import quoted, read_table
from fareloom.operators.keys import dense_key

RUN = 64  # messages rendered at a time
SALTS = 16
SYSTEM, NOBODY = "system", "unknown"
START, END = "<|im_start|>", "<|im_end|>"


def rendered_message(message: Column, speaker: Column) -> Column:
    """(segment, skip, own): the message as rendered, the length of its header, and whether the speaker is trained on it."""
    name = F.regexp_replace(message["speaker"], "[^A-Za-z0-9._-]", "_")
    header = (
        F.when(message["speaker"] == SYSTEM, F.lit("system"))
        .when(message["speaker"] == speaker, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), name))
    )
    opening = F.concat(F.lit(START), header, F.lit("\n"))
    return F.struct(
        F.concat(opening, message["text"], F.lit(END + "\n")).alias("segment"),
        F.length(opening).alias("skip"),
        (message["speaker"] == speaker).alias("own"),
    )


def placed_runs(messages: DataFrame, run: int) -> DataFrame:
    """(key, conv, run, messages): runs of a conversation's messages in order."""
    placed = dense_key(messages, ["conv", "turn", "speaker", "text"], "place")
    first = placed.groupBy("key").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    by_stretch = first.select("key", "first", F.explode(F.sequence(F.floor(F.col("first") / run), F.floor(F.col("last") / run))).alias("stretch"))
    return (
        placed.withColumn("stretch", F.floor(F.col("place") / run))
        .join(by_stretch, ["key", "stretch"])
        .groupBy("key", F.floor((F.col("place") - F.col("first")) / run).alias("run"))
        .agg(
            F.first("conv").alias("conv"),
            F.transform(
                F.sort_array(F.collect_list(F.struct("place", "speaker", "text"))),
                lambda m: F.struct(m["speaker"].alias("speaker"), m["text"].alias("text")),
            ).alias("messages"),
        )
    )


def salted(runs: DataFrame, facts: DataFrame) -> DataFrame:
    """Runs joined with facts of their conversation; the runs of a long one are dealt over SALTS tasks."""
    parts = facts.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    return runs.withColumn("salt", F.pmod(F.col("run"), F.lit(SALTS))).join(parts, ["key", "salt"]).drop("salt")


def with_opening(runs: DataFrame) -> DataFrame:
    """Runs that begin with the system messages that open their conversation; the first does already."""
    known = F.transform("messages", lambda m, i: F.when(m["speaker"] != SYSTEM, i))
    until = F.coalesce(F.array_min(F.filter(known, lambda i: i.isNotNull())), F.size("messages"))
    opening = runs.where("run = 0").select("key", F.slice("messages", F.lit(1), until).alias("opening"))
    return salted(runs, opening).withColumn(
        "messages", F.when(F.col("run") == 0, F.col("messages")).otherwise(F.concat("opening", "messages"))
    )


def rotate_perspectives(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    part: int | None = None,
) -> DataFrame:
    """(conv[, part], speaker, n_messages, n_trained, rendered, mask): a row for each conversation and each of its participants, or
    with `part` for each part of so many messages. `mask` lists the trained stretches of `rendered` as start-end, in code points, end
    exclusive."""
    said = F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))
    messages = turns.select(
        F.col(quoted(conv)).alias("conv"),
        F.coalesce(F.concat(F.lit("="), F.col(quoted(conv)).cast("string")), F.lit("")).alias("key"),
        F.col(quoted(turn)).alias("turn"),
        F.coalesce(F.nullif(F.col(quoted(role)).cast("string"), F.lit("")), F.lit(NOBODY)).alias("speaker"),
        F.regexp_replace(said, r"<\|im_(start|end)\|>", "<|im_$1 |>").alias("text"),
    )
    runs = placed_runs(messages, part or RUN)
    if part:
        runs = with_opening(runs)
    people = messages.where(F.col("speaker") != SYSTEM).select("key", F.col("speaker").alias("who")).distinct()
    shown = salted(runs, people).select(
        "key", "conv", "run", F.col("who").alias("speaker"), F.transform("messages", lambda m: rendered_message(m, F.col("who"))).alias("shown")
    )

    def add(state: Column, m: Column) -> Column:
        start, end = state["at"] + m["skip"], state["at"] + F.length(m["segment"]) - 1  # without the line end
        return F.struct(
            (state["at"] + F.length(m["segment"])).alias("at"),
            F.when(m["own"], F.concat(state["mask"], F.array(F.struct(start.alias("start"), end.alias("end")))))
            .otherwise(state["mask"]).alias("mask"),
        )

    none = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<start: int, end: int>>)").alias("mask"))
    rendered = shown.select(
        "key",
        "conv",
        "run",
        "speaker",
        F.size("shown").cast("bigint").alias("n_messages"),
        F.array_join(F.transform("shown", lambda m: m["segment"]), "").alias("rendered"),
        F.aggregate("shown", none, add)["mask"].alias("stretches"),
    )
    whole = rendered if part else joined_runs(rendered)
    return whole.select(
        "conv",
        *([F.col("run").alias("part")] if part else []),
        "speaker",
        "n_messages",
        F.size("stretches").cast("bigint").alias("n_trained"),
        "rendered",
        F.array_join(
            F.transform("stretches", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ","
        ).alias("mask"),
    )


def joined_runs(rendered: DataFrame) -> DataFrame:
    """The runs of each participant's rendering as one, their stretches moved to where the run stands."""
    earlier = Window.partitionBy("key", "speaker").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("rendered")).over(earlier), F.lit(0)).alias("at")
    moved = F.transform(
        "stretches", lambda s: F.struct((F.col("at") + s["start"]).alias("start"), (F.col("at") + s["end"]).alias("end"))
    )
    run = F.struct("run", "rendered", moved.alias("stretches"))
    return (
        rendered.select("*", at)
        .groupBy("key", "speaker")
        .agg(F.first("conv").alias("conv"), F.sum("n_messages").alias("n_messages"), F.sort_array(F.collect_list(run)).alias("runs"))
        .select(
            "conv",
            "speaker",
            "n_messages",
            F.array_join(F.transform("runs", lambda r: r["rendered"]), "").alias("rendered"),
            F.flatten(F.transform("runs", lambda r: r["stretches"])).alias("stretches"),
        )
    )


def op10_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate_perspectives(read_table(spark, sf_dir, "conversations")).withColumnRenamed("conv", "conv_id")


PERSPECTIVE_SQL = f"""
WITH messages AS (
 SELECT conv_id, turn, coalesce(nullif(role, ''), '{NOBODY}') AS speaker,
  regexp_replace(coalesce(text, ''), '<\\|im_(start|end)\\|>', '<|im_\\1 |>', 'g') AS text FROM conversations
), placed AS (
 SELECT conv_id, speaker, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, speaker, text) - 1 AS place
 FROM messages
), people AS (SELECT DISTINCT conv_id, speaker FROM messages WHERE speaker <> '{SYSTEM}'
), opened AS (
 SELECT p.conv_id, p.speaker, m.place, m.speaker = p.speaker AS own, m.text,
  '{START}' || CASE WHEN m.speaker = '{SYSTEM}' THEN 'system' WHEN m.speaker = p.speaker THEN 'assistant'
   ELSE 'user name=' || regexp_replace(m.speaker, '[^A-Za-z0-9._-]', '_', 'g') END || chr(10) AS opening
 FROM people p JOIN placed m ON m.conv_id IS NOT DISTINCT FROM p.conv_id
), shown AS (SELECT *, opening || text || '{END}' || chr(10) AS segment FROM opened
), ended AS (
 SELECT *, CAST(sum(length(segment)) OVER (PARTITION BY conv_id, speaker ORDER BY place) AS BIGINT) AS until FROM shown
)
SELECT conv_id, speaker, count(*) AS n_messages, count(*) FILTER (WHERE own) AS n_trained,
 string_agg(segment, '' ORDER BY place) AS rendered,
 coalesce(string_agg(CAST(until - length(segment) + length(opening) AS VARCHAR) || '-' || CAST(until - 1 AS VARCHAR), ','
  ORDER BY place) FILTER (WHERE own), '') AS mask
FROM ended GROUP BY conv_id, speaker
"""
