"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of the normalised test items. A document's words stream through it, and at each
word it knows the length of the longest run that ends there and occurs in an item. A run is a hit once it reaches an
item's limit: MIN_WORDS words, or COVERAGE of the item's words where that is less. Hit words are cut from the text.

Items go to the executors in blocks of about BLOCK_BYTES of text; a worker builds a block's automaton once, in flat arrays of some 30
bytes a state, and holds one at a time. Documents pass one block after the other, stored in between, so a long list of items needs
more passes, not more memory. An item larger than a block goes in parts that overlap by all but one word of the longest limit, so
no run is lost. Repeated items are one.

Null and empty texts have no words and no hits; items without words match nothing. Each row is judged alone, repeated ones
alike. Texts of any length stream word by word. An empty table gives no rows, no items no hits. The input row travels as one struct,
so its columns cannot clash.
"""

from __future__ import annotations

import math
import re
import uuid
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from fareloom.llm.common import quoted, read_table, slices, text_bytes, text_or_empty, whole_row
from fareloom.sources.storage import stage

MIN_WORDS, COVERAGE = 10, 1.0
BLOCK_BYTES = 8 << 20
NO_STATE = -1

# Letters and digits of ASCII and every byte of other characters stay; the rest separates words.
KEPT = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
FOLD = bytes(b if KEPT.fullmatch(bytes([b])) else 0x20 for b in range(256)).lower()


def plain_words(raw: bytes) -> list[bytes]:
    return raw.translate(FOLD).split()


class SuffixAutomaton:
    """States are classes of word runs that end at the same places of the items. A state's first edge is kept in arrays, further
    ones in `more`; likewise the limit that its own runs have to reach, as (words, item). `near` is the closest state on the way along
    suffix links, the state itself included, that has such a limit."""

    def __init__(self, items: Iterable[tuple[str, bytes, int]], min_words: int, coverage: float):
        """Of items or parts of items: (name, text, words of the whole item)."""
        self.number: dict[bytes, int] = {}
        self.names: list[str] = []
        self.symbol, self.target = array("i", [NO_STATE]), array("i", [NO_STATE])
        self.more: dict[int, dict[int, int]] = {}
        self.link, self.length = array("i", [NO_STATE]), array("i", [0])
        named: dict[str, int] = {}
        runs = []
        for name, raw, n_words in items:
            codes = array("i", [self.number.setdefault(w, len(self.number)) for w in plain_words(raw)])
            item = named.setdefault(name, len(named))
            runs.append((item, codes, min(min_words, max(1, math.ceil(coverage * n_words)))))
        self.names = list(named)
        for _, run, _ in runs:
            last = 0
            for c in run:
                last = self.extend(last, c)
        self.width, self.item = (array("i", [NO_STATE]) * len(self.link) for _ in range(2))
        self.further: dict[int, set[tuple[int, int]]] = {}
        self.least = min_words
        for item, run, width in runs:
            if len(run):
                self.least = min(self.least, width)
                for _, state, length in self.walk(run):
                    if length >= width:
                        while self.length[self.link[state]] >= width:
                            state = self.link[state]
                        self.limit(state, width, item)
        self.near = array("i", [NO_STATE]) * len(self.link)
        for state in np.argsort(np.frombuffer(self.length, np.int32), kind="stable").tolist()[1:]:
            # Links are shorter, so theirs are complete by now.
            self.near[state] = state if self.width[state] > 0 else self.near[self.link[state]]

    def limit(self, state: int, width: int, item: int) -> None:
        if self.width[state] < 0:
            self.width[state], self.item[state] = width, item
        elif (self.width[state], self.item[state]) != (width, item):
            self.further.setdefault(state, set()).add((width, item))

    def limits(self, state: int) -> Iterator[tuple[int, int]]:
        """(words, item) of the state and of those along its suffix links."""
        state = self.near[state]
        while state > 0:
            yield self.width[state], self.item[state]
            yield from self.further.get(state, ())
            state = self.near[self.link[state]]

    def edge(self, state: int, c: int) -> int:
        if self.symbol[state] == c:
            return self.target[state]
        further = self.more.get(state)
        return NO_STATE if further is None else further.get(c, NO_STATE)

    def set_edge(self, state: int, c: int, to: int) -> None:
        if self.symbol[state] in (c, NO_STATE):
            self.symbol[state], self.target[state] = c, to
        else:
            self.more.setdefault(state, {})[c] = to

    def extend(self, last: int, c: int) -> int:
        """Add word c after state `last`; returns the state of the whole run so far."""
        q = self.edge(last, c)
        if q >= 0:
            return q if self.length[q] == self.length[last] + 1 else self.split(last, c, q)
        new = self.add(self.length[last] + 1)
        p = last
        while p >= 0 and self.edge(p, c) < 0:
            self.set_edge(p, c, new)
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.edge(p, c)
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self.split(p, c, q)
        return new

    def add(self, length: int) -> int:
        self.symbol.append(NO_STATE)
        self.target.append(NO_STATE)
        self.link.append(0)
        self.length.append(length)
        return len(self.link) - 1

    def split(self, p: int, c: int, q: int) -> int:
        """Give the runs of q that are no longer than p's by one a state of their own."""
        copy = self.add(self.length[p] + 1)
        self.symbol[copy], self.target[copy] = self.symbol[q], self.target[q]
        if q in self.more:
            self.more[copy] = dict(self.more[q])
        self.link[copy] = self.link[q]
        self.link[q] = copy
        while p >= 0 and self.edge(p, c) == q:
            self.set_edge(p, c, copy)
            p = self.link[p]
        return copy

    def walk(self, run: Iterable[int]) -> Iterator[tuple[int, int, int]]:
        """(place, state, length) of the longest run of the items that ends at each place."""
        symbol, target, more, link, longest = self.symbol, self.target, self.more, self.link, self.length
        state = length = 0
        none: dict[int, int] = {}
        for place, c in enumerate(run):
            while True:
                to = target[state] if symbol[state] == c else more.get(state, none).get(c, NO_STATE)
                if to >= 0:
                    state = to
                    length += 1
                    break
                if not state:
                    break
                state = link[state]
                length = longest[state]
            yield place, state, length

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges [start, end) that hit, merged, and the items they hit."""
        get = self.number.get
        codes = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        # Only stretches of the items' own words can hold a run that is long enough.
        edge = np.flatnonzero(np.diff(np.concatenate(([0], codes >= 0, [0])).astype(np.int8)))
        ranges: list[tuple[int, int]] = []
        items: set[str] = set()
        for start, end in edge.reshape(-1, 2).tolist():
            if end - start < self.least:
                continue
            for place, state, length in self.walk(codes[start:end].tolist()):
                if length < self.least or self.near[state] < 0:
                    continue
                for width, item in self.limits(state):
                    if width <= length:
                        items.add(self.names[item])
                        ranges.append((start + place + 1 - width, start + place + 1))
        return merged(ranges), items


def merged(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def cut(raw: bytes, ranges: list[tuple[int, int]]) -> bytes:
    """The text without the words of the ranges and what stands between them."""
    places = [m.span() for m in KEPT.finditer(raw)]
    parts, done = [], 0
    for start, end in ranges:
        parts.append(raw[done : places[start][0]])
        done = places[end - 1][1]
    return b"".join(parts) + raw[done:]


BUILT: dict[tuple, SuffixAutomaton] = {}  # the one automaton that a worker holds


def automaton_of(block, min_words: int, coverage: float) -> SuffixAutomaton:
    """The automaton of a broadcast block of items, built on a worker's first use of the block."""
    key = (block.value[0], min_words, coverage)
    if key not in BUILT:
        BUILT.clear()
        BUILT[key] = SuffixAutomaton(block.value[1], min_words, coverage)
    return BUILT[key]


def mark_batches(
    block, min_words: int, coverage: float, body: str
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the hits of one block of items. `body` says what becomes of the text: kept, cut (of all hits) or dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            find = automaton_of(block, min_words, coverage).hits
            bodies, sizes, spans, found = [], [], [], []
            for raw, old_spans, old_items in zip(
                text_bytes(batch["body"]), batch["spans"].to_pylist(), batch["items"].to_pylist(), strict=True
            ):
                words = plain_words(raw)
                ranges, items = find(words)
                if old_spans:
                    ranges = merged([*ranges, *((s["start"], s["end"]) for s in old_spans)])
                sizes.append(len(words))
                spans.append([{"start": s, "end": e} for s, e in ranges])
                found.append(sorted({*old_items, *items}))
                if body == "cut" and ranges:
                    raw = cut(raw, ranges)
                bodies.append(None if body == "drop" else raw)
            columns = {
                "row": batch["row"],
                "body": pa.array(bodies, pa.binary()).cast(pa.string()),
                "n_words": pa.array(sizes, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "items": pa.array(found, pa.list_(pa.string())),
            }
            yield pa.record_batch(list(columns.values()), names=list(columns))

    return run


def split_items(part_bytes: int, overlap: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, raw) -> (id, part, n_words): an item's words in parts of about part_bytes, each beginning with the last `overlap` words
    of the one before, and the number of words of the whole item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for name, raw in zip(batch["id"].to_pylist(), text_bytes(batch["raw"]), strict=True):
                words = plain_words(raw)
                for start, end in word_parts(words, part_bytes, overlap):
                    out.append((name, b" ".join(words[start:end]), len(words)))
            types = (pa.string(), pa.binary(), pa.int64())
            yield pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=["id", "part", "n_words"])

    return run


def word_parts(words: list[bytes], part_bytes: int, overlap: int) -> Iterator[tuple[int, int]]:
    start = size = fresh = 0  # fresh: words beyond the overlap
    for i, w in enumerate(words):
        if fresh and size + len(w) + 1 > part_bytes:
            yield start, i
            start = max(start, i - overlap)
            size, fresh = sum(len(x) + 1 for x in words[start:i]), 0
        size += len(w) + 1
        fresh += 1
    if words:
        yield start, len(words)


def item_blocks(
    items: DataFrame, id_col: str, text_col: str, block_bytes: int, min_words: int
) -> Iterator[list[tuple[str, bytes, int]]]:
    """Distinct items, or their parts, in blocks of about block_bytes each, dealt by a hash. The driver holds one block's text."""
    named = items.select(
        F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("")).alias("id"),
        F.encode(text_or_empty(text_col), "UTF-8").alias("raw"),
    ).distinct()
    split = split_items(max(1, block_bytes // 4), min_words - 1)
    parts = stage(named.mapInArrow(split, "id string, part binary, n_words bigint"), "items")
    total = parts.agg(F.coalesce(F.sum(F.octet_length("part")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total // block_bytes))
    lot = F.pmod(F.xxhash64("id", "part"), F.lit(blocks))
    for b in range(blocks):
        yield [(r["id"], bytes(r["part"]), r["n_words"]) for r in parts.where(lot == b).collect()]


def mark_spans(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    carry: list[str] | None = None,
    item_id: str = "item_id",
    item_text: str = "text",
    min_words: int = MIN_WORDS,
    coverage: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
    keep_text: bool = True,
) -> DataFrame:
    """(row, body, n_words, spans, items) per document: the input row (only the columns `carry`, if given), the text
    without its hits (null unless `keep_text`), the number of words, the word ranges that hit and the sorted ids of the items hit, as
    strings."""
    spark = docs.sparkSession
    rows = docs.select(
        whole_row(docs if carry is None else docs.select(*map(quoted, carry))).alias("row"),
        text_or_empty(text_col).alias("body"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.expr("CAST(array() AS array<struct<start: bigint, end: bigint>>)").alias("spans"),
        F.expr("CAST(array() AS array<string>)").alias("items"),
    )
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    schema = StructType(
        [
            rows.schema["row"],
            StructField("body", StringType()),
            StructField("n_words", LongType()),
            StructField("spans", ArrayType(span)),
            StructField("items", ArrayType(StringType())),
        ]
    )
    blocks = item_blocks(items, item_id, item_text, block_bytes, min_words)
    block = next(blocks)
    while block is not None:
        after = next(blocks, None)
        body = "keep" if after is not None else "cut" if keep_text else "drop"
        sent = spark.sparkContext.broadcast((uuid.uuid4().hex, block))
        rows = rows.mapInArrow(mark_batches(sent, min_words, coverage, body), schema)
        if after is not None:
            rows = stage(rows, "marks")  # else the next pass would run in the same task, beside this one
        block = after
    return rows


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """The documents with hits cut from their text; one that has words but no others goes. Texts without hits, null included,
    stay as they are. A column n_chars is kept in step."""
    marked = mark_spans(docs, items, text_col, **limits)
    hit = F.size("spans") > 0
    covered = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    out = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == text_col:
            value = F.when(hit, F.col("body")).otherwise(value)
        elif c == "n_chars":
            value = F.when(hit, F.length("body").cast(docs.schema[c].dataType)).otherwise(value)
        out.append(value.alias(c))
    return marked.where(~hit | (covered < F.col("n_words"))).select(*out)


def op6_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The row keeps the id alone, so that the text crosses to Python once.
    marked = mark_spans(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), carry=["doc_id"], keep_text=False
    )
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return marked.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Windows of words compared as strings.
LEAK_SQL = f"""
WITH item_words AS (
 SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SQL_WORD}') AS w
 FROM benchmark
), item_windows AS (
 SELECT DISTINCT item, width, array_to_string(w[i:i + width - 1], ' ') AS run
 FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS i FROM (SELECT *, least({MIN_WORDS}, len(w)) AS width FROM item_words WHERE len(w) > 0))
), doc_words AS (
 SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SQL_WORD}') AS w
 FROM documents
), doc_windows AS (
 SELECT rid, width, i, array_to_string(w[i:i + width - 1], ' ') AS run FROM (
  SELECT d.*, x.width, unnest(range(1, len(w) - x.width + 2)) AS i FROM doc_words d JOIN (SELECT DISTINCT width FROM item_windows) x ON len(w) >= x.width)
), hits AS (SELECT rid, i, width, item FROM doc_windows JOIN item_windows USING (width, run)
), covered AS (
 SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(i, i + width)) AS place FROM (SELECT DISTINCT rid, i, width FROM hits)) GROUP BY rid
), named AS (
 SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
 sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered c ON c.rid = d.rid LEFT JOIN named n ON n.rid = d.rid
"""
