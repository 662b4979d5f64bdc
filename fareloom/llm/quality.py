"""Quality rules whose cutoffs follow each language and source.

Five measures of a text are sketched per language and source as counts over rounded values, of the documents that the base rule
leaves: whole numbers keep their six leading binary digits, so a quantile is off by at most 1/32 of itself, and sketches merge by adding
counts. A group's sketch is blended with its language's, scaled to the weight of BLEND documents, and with that of everything,
scaled to BLEND_ALL: a group of few documents follows its language, one of many itself, and one more document moves a cutoff by its own
weight. A cutoff is the median plus REACH times its distance to the HIGH quantile (for word length also below it, by the LOW one). There
are no least distances: where nine tenths of a group's texts have no symbols, one with symbols is beyond the cutoff.

A text is rejected when two of three kinds of measures are beyond their cutoffs: symbols, repetition (of words and of lines), shape (share
of capitals or length of words). One kind alone also happens to clean texts. A text without words is rejected too.

All of it is DataFrame expressions. Measures are taken once and stored, counted on the map side, and joined to cutoffs, of which
there is a row per language and source.

Null texts have no words; null languages and sources are groups of their own; repeated rows count as often as they occur. Texts of
any length are measured whole. An empty table has no cutoffs and no rows; where the base rule leaves no document at all, there are no
cutoffs and every text with words passes. The input row travels as one struct, so its columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.common import quoted, read_table, text_or_empty, whole_row
from fareloom.sources.storage import stage

WORD, GAP = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"
WINDOW = 3
MIN_WORDS, MOST_REPEATED = 50, 50  # of the base rule: words, and repeated words in a hundred
REPETITIVE = f"n_words >= {MIN_WORDS} AND 100 * n_repeat_words > {MOST_REPEATED} * n_words"  # its part on texts that are not short
FAILED = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words)"  # the base rule
REACH = 2
LOW, MIDDLE, HIGH = 15, 50, 85  # quantiles, in hundredths
BLEND, BLEND_ALL = 200, 50  # documents that a language's sketch, and that of everything, weigh in a group's
UNIT = 10_000  # weight of a document, so that shares of scaled sketches are whole numbers
DIGITS = 6
NONE = "\x00"  # stands for a null language or source

# All measures are whole numbers: thousandths, and hundredths of a character.
MEASURES = ["symbols", "repeats", "same_lines", "capitals", "length"]
KINDS = [
    "symbols > hi_symbols",
    "repeats > hi_repeats AND same_lines > hi_same_lines",
    "capitals > hi_capitals OR length > hi_length OR length < lo_length",
]
VOTES = " + ".join(f"CAST(coalesce({kind}, false) AS INT)" for kind in KINDS)
PASSES = f"n_words > 0 AND {VOTES} < 2"


def per_thousand(part: str, whole: str, scale: int = 1000) -> Column:
    return F.expr(f"CAST({scale} * {part} DIV greatest({whole}, 1) AS BIGINT)")


def measured(rows: DataFrame) -> DataFrame:
    """Adds to (row, lang, source, body) the base counts and the measures. Each step reads columns of the one before more than
    once, which keeps Spark from working them out again."""
    words = rows.withColumn("words", F.regexp_extract_all("body", F.lit(WORD), F.lit(0)))
    windows = words.select(
        *rows.columns,
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.when(
            F.size("words") >= WINDOW,
            F.transform(
                F.slice("words", 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))),
                lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
            ),
        )
        .otherwise(F.expr("CAST(array() AS array<bigint>)"))
        .alias("windows"),
        F.filter(F.split("body", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    # Most texts repeat no window; only the others are sorted to find which.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.sort_array(F.transform("windows", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    sorted_ = windows.select(
        *rows.columns,
        "n_words",
        "word_chars",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(repeats, ordered).alias("ordered"),
    )
    twice = F.filter(
        "ordered",
        lambda x, k: (F.get("ordered", k - 1)["g"] == x["g"]) | (F.get("ordered", k + 1)["g"] == x["g"]),
    )
    found = sorted_.select(
        *[c for c in sorted_.columns if c != "ordered"],
        F.sort_array(F.transform(twice, lambda x: x["i"])).alias("at"),
        F.length(F.regexp_replace("body", "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        F.length(F.regexp_replace("body", r"\P{Lu}+", "")).cast("bigint").alias("n_capitals"),
    )
    # A window covers three words, or as many as there are up to the next repeated window.
    reach = F.transform("at", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get("at", k + 1) - i, F.lit(WINDOW))))
    counted = found.withColumn(
        "n_repeat_words",
        F.coalesce(F.aggregate(reach, F.lit(0).cast("bigint"), lambda n, x: n + x), F.lit(0).cast("bigint")),
    ).drop("at", "body")
    return counted.withColumns(
        {
            "symbols": per_thousand("n_symbols", "word_chars"),
            "repeats": per_thousand("n_repeat_words", "n_words"),
            "same_lines": per_thousand("n_dup_lines", "n_lines"),
            "capitals": per_thousand("n_capitals", "word_chars"),
            "length": per_thousand("word_chars", "n_words", 100),
        }
    )


def rounded(value: str) -> str:
    """A whole number with its leading DIGITS binary digits."""
    shift = f"greatest(0, length(bin({value})) - {DIGITS})"
    return f"shiftleft(shiftright({value}, {shift}), {shift})"


def sketches(measures: DataFrame) -> DataFrame:
    """(lang, source, measure, value, docs): the counts of each group, a few hundred values at most. Documents that fail the base
    rule count nothing, but name their group."""
    pairs = ", ".join(f"'{m}', {rounded(m)}" for m in MEASURES)
    return (
        measures.where("n_words > 0")
        .select("lang", "source", F.expr(FAILED).alias("failed"), F.expr(f"stack({len(MEASURES)}, {pairs}) AS (measure, value)"))
        .groupBy("lang", "source", "measure", "value")
        .agg(F.count_if(~F.col("failed")).alias("docs"))
    )


def histograms(sketch: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, measure, name, name_total): the sketches merged by the keys, as lists of (value, docs)."""
    merged = sketch.groupBy(*keys, "measure", "value").agg(F.sum("docs").alias("docs"))
    entries = F.collect_list(F.struct("value", "docs"))  # as many entries as values
    return merged.groupBy(*keys, "measure").agg(entries.alias(name), F.sum("docs").alias(f"{name}_total"))


def weighted(name: str, weight: int | None) -> Column:
    """A histogram's (value, weight): UNIT for each document, or the whole scaled to `weight` documents."""
    total = F.greatest(F.col(f"{name}_total"), F.lit(1))

    def entry(x: Column) -> Column:
        share = x["docs"] * UNIT if weight is None else F.floor(x["docs"] * (weight * UNIT) / total)
        return F.struct(x["value"].alias("value"), share.cast("bigint").alias("weight"))

    return F.transform(name, entry)


def cutoffs(sketch: DataFrame) -> DataFrame:
    """(lang, source, lo_*, hi_*): the cutoffs of each language and source."""
    joined = (
        histograms(sketch, ["lang", "source"], "own")
        .join(histograms(sketch, ["lang"], "wide"), ["lang", "measure"])
        .join(histograms(sketch, [], "every"), "measure")
    )
    blended = F.concat(weighted("own", None), weighted("wide", BLEND), weighted("every", BLEND_ALL))
    gathered = joined.select("lang", "source", "measure", F.sort_array(blended).alias("h")).withColumn(
        "total", F.aggregate("h", F.lit(0).cast("bigint"), lambda n, x: n + x["weight"])
    )

    def quantile(hundredths: int) -> Column:
        """The least value that so many hundredths of the weight do not exceed; null without any weight."""

        def step(state: Column, x: Column) -> Column:
            seen = state["seen"] + x["weight"]
            reached = state["value"].isNull() & (100 * seen >= hundredths * F.col("total"))
            return F.struct(seen.alias("seen"), F.when(reached, x["value"]).otherwise(state["value"]).alias("value"))

        start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("value"))
        return F.when(F.col("total") > 0, F.aggregate("h", start, step)["value"])

    quantiles = gathered.select(
        "lang", "source", "measure", quantile(LOW).alias("low"), quantile(MIDDLE).alias("middle"), quantile(HIGH).alias("high")
    )
    fences = quantiles.selectExpr(
        "lang", "source", "measure", f"middle - {REACH} * (middle - low) AS lo", f"middle + {REACH} * (high - middle) AS hi"
    )
    pivoted = [F.max(F.when(F.col("measure") == m, F.col(end))).alias(f"{end}_{m}") for m in MEASURES for end in ("lo", "hi")]
    return fences.groupBy("lang", "source").agg(*pivoted)


def judge_quality(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    carry: list[str] | None = None,
) -> DataFrame:
    """(row, the measures, passes), one row per document; `row` is the input row or its columns `carry`, and `passes` the
    verdict of the adaptive cutoffs."""
    rows = docs.select(
        whole_row(docs if carry is None else docs.select(*map(quoted, carry))).alias("row"),
        *[
            F.coalesce(F.col(quoted(c)).cast("string"), F.lit(NONE)).alias(name)
            for c, name in ((lang_col, "lang"), (source_col, "source"))
        ],
        text_or_empty(text_col).alias("body"),
    )
    measures = stage(measured(rows), "measures")
    return measures.join(cutoffs(sketches(measures)), ["lang", "source"], "left").select(
        *[c for c in measures.columns if c not in ("lang", "source")], F.expr(PASSES).alias("passes")
    )


def keep_quality(docs: DataFrame, **columns: str) -> DataFrame:
    """The documents that pass the adaptive cutoffs and do not mostly repeat themselves."""
    return judge_quality(docs, **columns).where(f"passes AND NOT ({REPETITIVE})").select("row.*")


def op3_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.selectExpr("row.doc_id AS doc_id", *counts, f"{FAILED} AS base_failed", f"NOT {FAILED} AND passes AS kept")


def least_bits(value: str) -> str:
    shift = f"greatest(0, length(bin({value})) - {DIGITS})"
    return f"((({value}) >> {shift}) << {shift})"


def merged_sql(keys: str, level: str, weight: int | None) -> str:
    on = f"{keys}, measure" if keys else "measure"
    share = f"docs * {UNIT}" if weight is None else f"CAST(floor(docs * {weight * UNIT} / greatest(total, 1)) AS BIGINT)"
    return f"""{level} AS (
 SELECT *, {share} AS weight FROM (
  SELECT *, sum(docs) OVER (PARTITION BY {on}) AS total FROM (SELECT {on}, value, sum(docs) AS docs FROM sketch GROUP BY {on}, value)))"""


QUALITY_SQL = f"""
WITH texts AS (
 SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, chr(0)) AS lang, coalesce(source, chr(0)) AS source,
  coalesce(text, '') AS body FROM documents
), split AS (
 SELECT *, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS words,
  list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM texts
), places AS (
 SELECT rid, unnest(range(1, len(words) - 1)) AS i, words FROM split WHERE len(words) >= 3
), grams AS (SELECT rid, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM places
), twice AS (
 SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM grams) WHERE n > 1
), covered AS (
 SELECT rid, CAST(count(DISTINCT w) AS BIGINT) AS n_repeat_words
 FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS w FROM twice) GROUP BY rid
), counts AS (
 SELECT s.rid, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
  CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(length(regexp_replace(body, '\\P{{Lu}}+', '', 'g')) AS BIGINT) AS n_capitals,
  CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words
 FROM split s LEFT JOIN covered c ON c.rid = s.rid
), measures AS (
 SELECT *, 1000 * n_symbols // greatest(word_chars, 1) AS symbols, 1000 * n_repeat_words // greatest(n_words, 1) AS repeats,
  1000 * n_dup_lines // greatest(n_lines, 1) AS same_lines, 1000 * n_capitals // greatest(word_chars, 1) AS capitals,
  100 * word_chars // greatest(n_words, 1) AS length FROM counts
), long AS (
 {" UNION ALL ".join(f"SELECT lang, source, {FAILED} AS failed, '{m}' AS measure, {least_bits(m)} AS value FROM measures WHERE n_words > 0" for m in MEASURES)}
), sketch AS (SELECT lang, source, measure, value, count(*) FILTER (WHERE NOT failed) AS docs FROM long GROUP BY lang, source, measure, value
), {merged_sql("lang, source", "own", None)}, {merged_sql("lang", "wide", BLEND)}, {merged_sql("", "every", BLEND_ALL)}
, groups AS (SELECT DISTINCT lang, source FROM long
), blended AS (
 SELECT lang, source, measure, value, weight FROM own
 UNION ALL SELECT g.lang, g.source, w.measure, w.value, w.weight FROM groups g JOIN wide w ON w.lang = g.lang
 UNION ALL SELECT g.lang, g.source, e.measure, e.value, e.weight FROM groups g CROSS JOIN every e
), run AS (
 SELECT lang, source, measure, value, sum(weight) OVER (PARTITION BY lang, source, measure ORDER BY value) AS seen,
  sum(weight) OVER (PARTITION BY lang, source, measure) AS total FROM blended
), quantiles AS (
 SELECT lang, source, measure, {", ".join(f"min(value) FILTER (WHERE 100 * seen >= {n} * total) AS {name}" for n, name in ((LOW, "low"), (MIDDLE, "middle"), (HIGH, "high")))}
 FROM run WHERE total > 0 GROUP BY lang, source, measure
), fences AS (
 SELECT lang, source, {", ".join(f"max(middle - {REACH} * (middle - low)) FILTER (WHERE measure = '{m}') AS lo_{m}, max(middle + {REACH} * (high - middle)) FILTER (WHERE measure = '{m}') AS hi_{m}" for m in MEASURES)}
 FROM quantiles GROUP BY lang, source
), judged AS (
 SELECT m.*, {FAILED} AS base_failed, {PASSES} AS passes
 FROM measures m LEFT JOIN fences f ON f.lang = m.lang AND f.source = m.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND passes AS kept FROM judged
"""
