"""Fill-in-the-middle documents, cut between lines by an indexable skip list.

A text's lines are the units of a skip list. A lane's links carry two widths, the units and the code points they pass over; the
bottom lane has a link per line, and a link of a higher lane spans those of the lane below up to the next node that was raised. From the
top lane down, the walk takes links while their units do not pass the wanted rank, so both cut ranks are reached exactly, and the
code points passed over are the cut's place in the text. Heights come from the line's number, so a text always gives the same list.

The cuts, the form and whether a text is left plain come from a digest of the seed and the id alone. Null texts are empty; empty texts
and texts that hold a marker stay plain. A null id counts as an empty string in the digest. Repeated rows give equal results, an
empty table none. A text of any length costs its lines once. The input row travels as one struct, so its columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from fareloom.llm.common import quoted, read_table, text_or_empty, whole_row

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
PERCENT, SPM_PERCENT = 100, 50
LINE = re.compile(r"[^\n]*\n|[^\n]+")
CUTS = "struct<n: bigint, prefix_chars: bigint, until_chars: bigint>"


class SkipList:
    """Units with widths in code points. A lane is a list of links (units, code points); the lane above joins the links
    between its nodes into one, and `places` says where in the lane below each of its links begins."""

    def __init__(self, widths: list[int]):
        self.units = len(widths)
        self.lanes: list[list[tuple[int, int]]] = [[(1, w) for w in widths]]
        self.places: list[list[int]] = []
        while len(self.lanes[-1]) > 4:
            links, begins, below = [], [], self.lanes[-1]
            begin = units = points = 0
            for k, (u, p) in enumerate(below):
                units, points = units + u, points + p
                if raised(k + 1, len(self.lanes)) or k + 1 == len(below):
                    links.append((units, points))
                    begins.append(begin)
                    begin, units, points = k + 1, 0, 0
            if len(links) == len(below):
                break
            self.lanes.append(links)
            self.places.append(begins)

    def seek(self, rank: int) -> int:
        """Code points of the first `rank` units."""
        if not 0 <= rank <= self.units:
            raise IndexError(rank)
        passed = points = at = 0
        for lane in range(len(self.lanes) - 1, -1, -1):
            links = self.lanes[lane]
            while at < len(links) and passed + links[at][0] <= rank:
                passed += links[at][0]
                points += links[at][1]
                at += 1
            if passed == rank:
                return points
            if lane:
                at = self.places[lane - 1][at]
        return points


def raised(node: int, lane: int) -> bool:
    """Whether a node of a lane is also one of the next: about one in four, by a hash of its number."""
    return ((node * 0x9E3779B1 + lane * 0x85EBCA77) & 0xFFFFFFFF) >> 30 == 0


def line_widths(text: str) -> list[int]:
    return [len(line) for line in LINE.findall(text)]


def cut_text(text: str, h1: int, h2: int) -> tuple[int, int, int]:
    """(units, code points of the prefix, code points of prefix and middle)."""
    units = SkipList(line_widths(text))
    ranks = sorted((h1 % (units.units + 1), h2 % (units.units + 1)))
    return units.units, units.seek(ranks[0]), units.seek(ranks[1])


def cut_batches(bodies: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for body, h1, h2 in bodies:
        found = [cut_text(t.as_py(), a.as_py(), b.as_py()) for t, a, b in zip(body, h1, h2, strict=True)]
        columns = [pa.array([f[k] for f in found], pa.int64()) for k in range(3)]
        yield pa.StructArray.from_arrays(columns, ["n", "prefix_chars", "until_chars"])


def digest_group(digest: Column, k: int) -> Column:
    """The k-th group of 8 hexadecimal digits as an unsigned number."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint")


def fill_in_middle(
    docs: DataFrame,
    percent: int = PERCENT,
    spm_percent: int = SPM_PERCENT,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(row, n, form, prefix_chars, middle_chars, output), one row per document: `percent` of them rearranged, of these
    `spm_percent` with the suffix first. `row` is the input row without its text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit(""))), 256)
    row = whole_row(docs.drop(text_col)) if len(docs.columns) > 1 else F.struct()
    hashed = docs.select(row.alias("row"), text_or_empty(text_col).alias("body"), digest.alias("digest")).select(
        "row", "body", *[digest_group(F.col("digest"), k).alias(f"h{k + 1}") for k in range(4)]
    )
    marked = F.col("body").contains(PREFIX) | F.col("body").contains(SUFFIX) | F.col("body").contains(MIDDLE)
    form = (
        F.when((F.col("body") == "") | marked | (F.col("h3") % 100 >= percent), "plain")
        .when(F.col("h4") % 100 < spm_percent, "spm")
        .otherwise("psm")
    )
    cuts = arrow_udf(cut_batches, CUTS)
    cut = hashed.select("row", "body", form.alias("form"), cuts("body", "h1", "h2").alias("cut"))
    until, whole = F.col("cut.until_chars"), F.length("body")
    parts = cut.select(
        "row",
        "body",
        "form",
        "cut.n",
        "cut.prefix_chars",
        (until - F.col("cut.prefix_chars")).alias("middle_chars"),
        F.substring("body", F.lit(1), F.col("cut.prefix_chars").cast("int")).alias("prefix"),
        F.substring("body", (F.col("cut.prefix_chars") + 1).cast("int"), (until - F.col("cut.prefix_chars")).cast("int")).alias("middle"),
        F.substring("body", (until + 1).cast("int"), whole).alias("suffix"),
    )
    p, s, m = F.concat(F.lit(PREFIX), "prefix"), F.concat(F.lit(SUFFIX), "suffix"), F.concat(F.lit(MIDDLE), "middle")
    output = F.when(F.col("form") == "plain", F.col("body")).when(F.col("form") == "psm", F.concat(p, s, m)).otherwise(F.concat(s, p, m))
    shown = F.col("form") != "plain"
    return parts.select(
        "row", "n", "form", F.when(shown, F.col("prefix_chars")).alias("prefix_chars"),
        F.when(shown, F.col("middle_chars")).alias("middle_chars"), output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text before it was rearranged, from the output and its form alone: no marker occurs in it but the three set."""

    def between(start: str, end: str) -> Column:
        return F.substring_index(F.substring_index(output, start, -1), end, 1)

    last = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(PREFIX, SUFFIX), last, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), last, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_indexable_skip_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return fill_in_middle(docs).select(
        "row.doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


FIM_SQL = f"""
WITH hashed AS (
 SELECT doc_id, coalesce(text, '') AS body, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents
), parsed AS (
 SELECT doc_id, body, regexp_extract_all(body, '[^\\n]*\\n|[^\\n]+') AS lines,
  CAST('0x' || digest[1:8] AS BIGINT) AS h1, CAST('0x' || digest[9:16] AS BIGINT) AS h2,
  CAST('0x' || digest[17:24] AS BIGINT) AS h3, CAST('0x' || digest[25:32] AS BIGINT) AS h4
 FROM hashed
), ranked AS (
 SELECT *, CAST(len(lines) AS BIGINT) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a,
  greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
  CASE WHEN body = '' OR contains(body, '{PREFIX}') OR contains(body, '{SUFFIX}') OR contains(body, '{MIDDLE}')
   OR h3 % 100 >= {PERCENT} THEN 'plain' WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
 FROM parsed
), parts AS (
 SELECT *, array_to_string(lines[1:a], '') AS p, array_to_string(lines[a + 1:b], '') AS m, array_to_string(lines[b + 1:], '') AS s
 FROM ranked
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
 CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
  ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256, sha256(body) AS restored_sha256
FROM parts
"""
