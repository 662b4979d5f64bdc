"""Secret scans that link the parts of a credential.

Base patterns find secrets that stand for themselves. Weaker ones find parts that alone prove nothing: long mixed tokens,
account names, and endpoints. A weak part is reported only if at most SCOPE code points lie between it and a complementary one
in the same text, on either side: a token needs an account or an endpoint, an account or an endpoint needs a secret. Weak parts
that overlap a base span are covered by it.

A pattern's matches and the text between them give the places; a running sum per text and pattern turns lengths into
places. Parts meet in an interval join on (text, stretch of BIN code points), so a text of any length is joined in
stretches, each of which holds a bounded number of matches. Everything is DataFrame expressions and joins.

Null and empty texts have no spans. Rows are told apart by their place in the input, so repeated rows and ids do not mix.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareloom.llm.common import quoted, read_table, text_or_empty, whole_row
from fareloom.sources.storage import stage

SCOPE, BIN = 256, 1024
MARK = "[SECRET]"

# The base patterns. Runs that are too short are left out by the pattern itself where that finds the same spans;
# a short assignment still uses up its text, so its length is checked afterwards.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
MIN_ASSIGNED = 12
BASE = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{14,}", "hex": "[0-9a-f]{16,}"}

TOKEN = "A-Za-z0-9+/_-"
WEAK = {
    "key": rf"(?<![{TOKEN}])(?=[{TOKEN}]*[0-9])(?=[{TOKEN}]*[a-z])(?=[{TOKEN}]*[A-Z])[{TOKEN}]{{24,}}={{0,2}}",
    "id": r"(?i)(?<![a-z0-9])(?:client|account|access|app|user|tenant)[_-]?(?:id|key[_-]?id|name)"
    r"""["']?\x20*[:=]\x20*["']?[a-z0-9_.@-]{4,}""",
    "url": r"(?i)(?<![a-z0-9])(?:https?|wss?|ftps?|amqps?|redis|mysql|mariadb|postgres(?:ql)?|mongodb(?:\+srv)?)"
    r"""://[^\x00-\x20"'<>]{3,}""",
}
ROLES = {"assign": "secret", "access": "account", "hex": "secret", "key": "secret", "id": "account", "url": "endpoint"}
ORDER = {kind: place for place, kind in enumerate(ROLES)}


def matches_of(kind: str, pattern: str) -> Column:
    """One entry per match of a pattern: its number, the length of the text before it, its own length, whether it counts."""
    found = F.regexp_extract_all("body", F.lit(pattern), F.lit(0))
    between = F.split("body", pattern, -1)
    if kind == "assign":
        good = F.transform(
            F.regexp_extract_all("body", F.lit(pattern), F.lit(2)), lambda value: F.length(value) >= MIN_ASSIGNED
        )
    else:
        good = F.transform(found, lambda m: F.lit(True))
    entries = F.transform(
        F.arrays_zip(found.alias("m"), F.slice(between, 1, F.size(found)).alias("b"), good.alias("g")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.length(x["b"]).cast("bigint").alias("gap"),
            F.length(x["m"]).cast("bigint").alias("size"),
            x["g"].alias("good"),
        ),
    )
    return F.when(F.col("body").rlike(pattern), entries)


def scan(docs: DataFrame, text_col: str, carry: list[str] | None) -> DataFrame:
    """(rid, row, body, m), stored: a row with the document and no match, and one for each match without the document."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        whole_row(docs if carry is None else docs.select(*map(quoted, carry))).alias("row"),
        text_or_empty(text_col).alias("body"),
    )
    none = F.expr("CAST(NULL AS struct<kind: string, i: int, gap: bigint, size: bigint, good: boolean>)")
    empty = F.expr("CAST(array() AS array<struct<kind: string, i: int, gap: bigint, size: bigint, good: boolean>>)")
    parts = [F.coalesce(matches_of(k, p), empty) for k, p in (BASE | WEAK).items()]
    spread = rows.select("rid", "row", "body", F.explode(F.concat(F.array(none), *parts)).alias("m"))
    first = F.col("m").isNull()
    kept = ["rid", F.when(first, F.col("row")).alias("row"), "m"]
    if carry is None:
        kept.insert(2, F.when(first, F.col("body")).alias("body"))
    return stage(spread.select(*kept), "matches")


def located(found: DataFrame) -> DataFrame:
    """(rid, kind, role, base, start, end) of the matches that count."""
    upto = Window.partitionBy("rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(upto)
    role = reduce(lambda c, k: c.when(F.col("kind") == k, ROLES[k]), list(ROLES)[1:], F.when(F.col("kind") == "assign", "secret"))
    return (
        found.where("m IS NOT NULL").select("rid", "m.*")
        .select("rid", "kind", "size", "good", end.alias("end"))
        .where("good")
        .select("rid", "kind", role.alias("role"), F.col("kind").isin(*BASE).alias("base"), F.expr("end - size AS start"), "end")
    )


def bins(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(F.floor(F.greatest(start, F.lit(0)) / BIN), F.floor(F.greatest(end - 1, F.lit(0)) / BIN)))


def linked_parts(spans: DataFrame) -> DataFrame:
    """The weak spans with a complementary part in their scope, by an interval join."""
    # Both sides are cut into the same stretches: a weak part with its scope around it and one more code point, which a part
    # at the full distance holds, and any part as it stands.
    reach = spans.where("NOT base").withColumn("bin", bins(F.col("start") - SCOPE - 1, F.col("end") + SCOPE + 1))
    parts = spans.select(
        "rid",
        bins(F.col("start"), F.col("end")).alias("bin"),
        F.col("role").alias("other"),
        F.col("base").alias("is_base"),
        F.col("start").alias("from"),
        F.col("end").alias("to"),
    )
    overlap = "`from` < end AND start < to"
    near = f"`to` >= start - {SCOPE} AND `from` <= end + {SCOPE} AND NOT ({overlap})"
    secret = "role = 'secret' AND other <> 'secret' OR role <> 'secret' AND other = 'secret'"
    return (
        reach.join(parts, ["rid", "bin"])
        .groupBy("rid", "kind", "start", "end")
        .agg(
            F.expr(f"bool_or(is_base AND {overlap})").alias("covered"),
            F.expr(f"bool_or({near} AND ({secret}))").alias("linked"),
        )
        .where("linked AND NOT covered")
        .select("rid", "kind", "start", "end")
    )


def find_secrets(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, spans): (rid, row, body) of every document, and (rid, kind, start, end) of every reported span, in code
    points. `row` is the input row, or its columns `carry` (then without `body`)."""
    found = scan(docs, text_col, carry)
    spans = located(found)
    reported = spans.where("base").select("rid", "kind", "start", "end").union(linked_parts(spans))
    return found.where("m IS NULL").drop("m"), reported


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with every reported span replaced by MARK, overlapping ones by one. Texts without spans, null included,
    stay as they are. A column n_chars is kept in step."""
    rows, spans = find_secrets(docs, text_col)
    before = Window.partitionBy("rid").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        spans.withColumn("done", F.coalesce(F.max("end").over(before), F.lit(0)))
        .groupBy("rid")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "done"))).alias("cuts"), F.max("end").alias("last"))
    )
    pieces = F.transform(
        F.filter("cuts", lambda c: (c["start"] >= c["done"])),
        lambda c: F.concat(F.substring("body", c["done"] + 1, c["start"] - c["done"]), F.lit(MARK)),
    )
    rest = F.substring("body", (F.col("last") + 1).cast("int"), F.length("body"))
    joined = rows.join(cuts, "rid", "left").withColumn("clean", F.concat(F.array_join(pieces, ""), rest))
    hit = F.col("cuts").isNotNull()
    out = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == text_col:
            value = F.when(hit, F.col("clean")).otherwise(value)
        elif c == "n_chars":
            value = F.when(hit, F.length("clean").cast(docs.schema[c].dataType)).otherwise(value)
        out.append(value.alias(c))
    return joined.select(*out)


def op2_credential_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, spans = find_secrets(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    place = reduce(lambda c, k: c.when(F.col("kind") == k, ORDER[k]), list(ORDER)[1:], F.when(F.col("kind") == "assign", 0))
    label = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    listed = (
        spans.groupBy("rid")
        .agg(
            *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ROLES],
            F.sort_array(F.collect_list(F.struct("start", place.alias("place"), label.alias("label")))).alias("all"),
        )
    )
    base = F.transform(F.filter("all", lambda s: s["place"] < len(BASE)), lambda s: s["label"])
    every = F.transform("all", lambda s: s["label"])
    return docs.join(listed, "rid", "left").select(
        F.col("row.doc_id").alias("doc_id"),
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in ROLES],
        F.sha2(F.coalesce(F.array_join(base, ","), F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce(F.array_join(every, ","), F.lit("")).alias("spans"),
    )
