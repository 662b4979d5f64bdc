"""Token counts by byte-pair merging, without building identifiers.

A word starts as one symbol per byte. A heap holds its adjacent pairs that have a merge; the pair of lowest rank (the
leftmost of equals) is popped and joined in a linked list, and its new neighbours are pushed. Each merge removes one
symbol, so the count is the initial symbols less the merges. The count of a word depends on the word alone, so
tasks remember counts, up to a fixed number of words.

Null and empty texts have 0 bytes and 0 tokens. One word of any length costs n log n steps.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.common import quoted, read_table, slices, text_or_empty

REMEMBERED = 600_000  # words per Python worker
LIMIT = 2048

# The splitting pattern of the vocabulary file, once for ASCII texts and once for all. Texts are lower
# case by then, and white space is the Unicode property, which "\s" is not in either library.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
ALL_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where it is printable Latin-1, else the next free one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    stand_in, free = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in stand_in:
            stand_in[b], free = chr(free), free + 1
    return [stand_in[b] for b in range(256)]


class WordCounts(dict):
    """Number of tokens of a word, worked out on first use."""

    def __init__(self, merges: list[tuple[str, str]], word_end: str):
        self.symbols: dict[str, int] = {}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            self.merges.setdefault((self.number(a), self.number(b)), (rank, self.number(a + b)))
        letters = byte_symbols()
        self.inner = [self.number(s) for s in letters]
        self.last = [self.number(s + word_end) for s in letters]

    def number(self, symbol: str) -> int:
        return self.symbols.setdefault(symbol, len(self.symbols))

    def __missing__(self, word: str) -> int:
        raw = word.encode()
        n = len(raw) - self.merge(raw)
        self[word] = n
        return n

    def merge(self, raw: bytes) -> int:
        """Number of merges in a word."""
        merges, last = self.merges.get, len(raw) - 1
        symbol = [self.inner[b] for b in raw]
        symbol[last] = self.last[raw[last]]
        before, after = list(range(-1, last)), list(range(1, last + 2))
        heap = []
        for i in range(last):
            found = merges((symbol[i], symbol[i + 1]))
            if found:
                heap.append((found[0], i, found[1], symbol[i], symbol[i + 1]))
        heapq.heapify(heap)
        done = 0
        while heap:
            _, i, joined, left, right = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != left or j > last or symbol[j] != right:
                continue  # one of the two has been merged meanwhile
            symbol[i], symbol[j] = joined, -1
            after[i] = k = after[j]
            done += 1
            if k <= last:
                before[k] = i
                found = merges((joined, symbol[k]))
                if found:
                    heapq.heappush(heap, (found[0], i, found[1], joined, symbol[k]))
            h = before[i]
            if h >= 0:
                found = merges((symbol[h], joined))
                if found:
                    heapq.heappush(heap, (found[0], h, found[1], symbol[h], joined))
        return done


class TokenCounter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.counts = WordCounts(pairs, model["end_of_word_suffix"] or "")
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"] if t["special"]))

    def words(self, text: str) -> list[str]:
        if text.isascii():
            return ASCII_WORDS.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        return ALL_WORDS.findall(text.replace("Σ", "σ").lower())  # no final sigma: letters map one by one

    def count(self, text: str) -> int:
        """Tokens of a text. A special token's string in it is that one token."""
        pieces = self.special.split(text) if "<|" in text else [text]
        if len(self.counts) > REMEMBERED:
            self.counts.clear()
        return sum(sum(map(self.counts.__getitem__, self.words(p))) for p in pieces) + len(pieces) - 1


@lru_cache(maxsize=4)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_batches(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in slices(batches):
            tokens = pa.array([count(t.as_py()) for t in batch["body"]], pa.int64())
            yield pa.record_batch([batch["id"], batch["n_bytes"], tokens], names=["id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens), one row per document, in one narrow stage. `vocabulary` is a path on every executor."""
    body = text_or_empty(text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(
        F.col(quoted(id_col)).alias("id"), F.octet_length(body).cast("bigint").alias("n_bytes"), body.alias("body")
    ).mapInArrow(count_batches(vocabulary), f"id {id_type}, n_bytes bigint, n_tokens bigint")


def op5_bpe_heap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit")
    )
