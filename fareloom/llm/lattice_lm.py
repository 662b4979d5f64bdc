"""Document probability under a unigram model of subwords, summed over all segmentations.

The pieces and their first scores come from an existing vocabulary; rounds of expectation over the different training
words turn them into unigram probabilities. A word is a path through the lattice of its pieces; the sum over all paths is
found by a forward recursion in logarithms. Every byte is a piece, so every word has a path. Pieces never cross white
space, hence a document's score is the sum over its words plus the end.

Pieces alone know nothing of which words occur together with which frequency, so the lattice of a training word has one more
edge, from its start to its end: the word itself, by its count less a discount. What the discounts leave goes to the paths
through pieces. Their weights sum to one over all words, met or not:
P(word) = (max(c - d, 0) + (1 + d * V) * paths(word)) / (W + 1), with W training words, V different ones, and
d = n1 / (n1 + 2 * n2), estimated from the words met once and twice. A token is the end in (ends + 1) of (N + 2) cases.

Word statistics grow with the corpus and stay distributed. Only the FREQUENT most frequent words of at most SHORT bytes go to
the executors, so that table has a bounded size in bytes too; occurrences of all other words meet their statistics in a
join. A short word there holds less than one in FREQUENT of the training tokens. A longer one can hold any share, so its key
is dealt by a hash of the document into parts of less than one in SHARE of the training tokens, and its statistics are
repeated for each part: SHARE rows more over all words at most, of which only hashes and numbers pass through the driver.

Null and empty texts consist of the end alone. Null ids are scored like any other and are held out or not by the crc32
of an empty string. Repeated rows are scored each. Without training documents every count is 0.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.common import byte_words, quoted, read_table, slices, text_bytes, text_or_empty
from fareloom.sources.storage import stage

FREQUENT, SHORT = 200_000, 64  # words sent to the executors, and the most bytes of one
SHARE = 4096
HELD = 400_000  # different words that a task counts before it passes them on
LONG = 256  # longer words go through the recursion one by one
CELLS = 1 << 20  # lattice cells worked on at once
FOLDS, HELD_OUT = 7, 2
ROUNDS = 2  # of expectation

_draw = np.random.Generator(np.random.PCG64(7_001))
BYTE_CODES = _draw.integers(1, 2**64, 256, dtype=np.uint64)
BASE = int(_draw.integers(0, 2**64, dtype=np.uint64)) | 1


def surface_hash(piece: bytes) -> int:
    h = 0
    for b in piece:
        h = (h * BASE + int(BYTE_CODES[b])) & 0xFFFFFFFFFFFFFFFF
    return h


def read_vocabulary(path: str) -> dict[bytes, float]:
    """Piece surfaces and first weights: one over the rank that the vocabulary's scores state. A word's start is a
    space here. Pieces with a space elsewhere can never be met; single bytes come last and are always there."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    weights: dict[bytes, float] = {}
    for i in range(size):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        surface = model.id_to_piece(i).replace("▁", " ").encode()
        if b" " not in surface[1:]:
            weights[surface] = 1.0 / (1.0 - min(0.0, model.get_score(i)))
    for b in range(256):
        weights.setdefault(bytes([b]), 1.0 / (1.0 + size))
    return weights


@dataclass
class Pieces:
    """Piece hashes in order and the natural logarithm of each piece's probability."""

    keys: np.ndarray
    logs: np.ndarray
    lengths: list[int]

    @classmethod
    def of(cls, surfaces: list[bytes], weights: np.ndarray) -> Pieces:
        keys = np.array([surface_hash(s) for s in surfaces], np.uint64)
        order = np.argsort(keys)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces share a hash")
        return cls(keys[order], np.log(weights)[order], sorted({len(s) for s in surfaces}))


def log_sum(terms: np.ndarray) -> np.ndarray:
    top = terms.max(axis=1)
    return top + np.log(np.exp(terms - top[:, None]).sum(axis=1))


def lattice(words: np.ndarray, pieces: Pieces, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Log probabilities of words of one length, given as rows of bytes with the leading space; with weights also
    the expected number of uses of each piece."""
    n, size = words.shape
    prefix = np.zeros((n, size + 1), np.uint64)
    for i in range(size):
        prefix[:, i + 1] = prefix[:, i] * np.uint64(BASE) + BYTE_CODES[words[:, i]]
    powers = {l: np.uint64(pow(BASE, l, 1 << 64)) for l in pieces.lengths if l <= size}
    forward = np.full((n, size + 1), -np.inf)
    forward[:, 0] = 0.0
    edges: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
    for i in range(1, size + 1):
        edges[i] = []
        for l, power in powers.items():
            if l > i:
                break
            h = prefix[:, i] - prefix[:, i - l] * power
            at = np.minimum(np.searchsorted(pieces.keys, h), len(pieces.keys) - 1)
            known = pieces.keys[at] == h
            if known.any():
                edges[i].append((i - l, at, np.where(known, pieces.logs[at], -np.inf)))
        forward[:, i] = log_sum(np.stack([forward[:, j] + logs for j, _, logs in edges[i]], axis=1))
    if weights is None:
        return forward[:, size], None
    backward = np.full((n, size + 1), -np.inf)
    backward[:, size] = 0.0
    uses = np.zeros(len(pieces.keys))
    for i in range(size, 0, -1):
        for j, at, logs in edges[i]:
            onward = logs + backward[:, i]
            share = np.exp(forward[:, j] + onward - forward[:, size]) * weights
            uses += np.bincount(at, share, len(uses))
            backward[:, j] = np.logaddexp(backward[:, j], onward)
    return forward[:, size], uses


def long_lattice(word: bytes, pieces: Pieces, weight: float | None = None) -> tuple[float, np.ndarray | None]:
    """The same for one long word, in memory proportional to it."""
    known = dict(zip(pieces.keys.tolist(), range(len(pieces.keys)), strict=True))
    codes, mask = BYTE_CODES.tolist(), 0xFFFFFFFFFFFFFFFF
    powers = [(l, pow(BASE, l, 1 << 64)) for l in pieces.lengths]
    prefix = [0]
    for b in word:
        prefix.append((prefix[-1] * BASE + codes[b]) & mask)
    logs, size = pieces.logs.tolist(), len(word)
    forward, edges = [0.0] + [-math.inf] * size, [[] for _ in range(size + 1)]
    for i in range(1, size + 1):
        for l, power in powers:
            if l > i:
                break
            at = known.get((prefix[i] - prefix[i - l] * power) & mask)
            if at is not None:
                edges[i].append((i - l, at))
        terms = [forward[j] + logs[at] for j, at in edges[i]]
        top = max(terms)
        forward[i] = top + math.log(sum(math.exp(t - top) for t in terms))
    if weight is None:
        return forward[size], None
    uses, backward = np.zeros(len(logs)), [-math.inf] * size + [0.0]
    for i in range(size, 0, -1):
        for j, at in edges[i]:
            onward = logs[at] + backward[i]
            uses[at] += weight * math.exp(forward[j] + onward - forward[size])
            backward[j] = float(np.logaddexp(backward[j], onward))
    return forward[size], uses


def word_lattices(
    words: list[bytes], pieces: Pieces, weights: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray | None]:
    """Log probability of each word and, with weights, the expected uses of the pieces over all."""
    out, uses = np.empty(len(words)), None if weights is None else np.zeros(len(pieces.keys))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        if size > LONG:
            for r in rows.tolist():
                out[r], used = long_lattice(b" " + words[r], pieces, None if weights is None else float(weights[r]))
                if uses is not None:
                    uses += used
            continue
        step = max(1, CELLS // (size * min(size, len(pieces.lengths))))
        for start in range(0, len(rows), step):
            part = rows[start : start + step]
            block = np.frombuffer(b"".join(b" " + words[r] for r in part.tolist()), np.uint8).reshape(len(part), size)
            out[part], used = lattice(block, pieces, None if weights is None else weights[part])
            if uses is not None:
                uses += used
    return out, uses


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(held_out, body) -> (word, c): training counts; words seen only in held-out texts come with 0."""

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "c"]
        )

    counts: Counter = Counter()
    for batch in slices(batches):
        for held_out, raw in zip(batch["held_out"].to_pylist(), text_bytes(batch["body"]), strict=True):
            words = byte_words(raw)
            if held_out:
                for w in words:
                    counts[w] += 0
            else:
                counts.update(words)
            if len(counts) >= HELD:
                yield out(counts)
                counts = Counter()
    if counts:
        yield out(counts)


def expect(pieces: Pieces) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(word) -> (piece, uses): expected uses of each piece in the words of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(pieces.keys))
        for batch in batches:
            total += word_lattices(batch["word"].to_pylist(), pieces, np.ones(batch.num_rows))[1]
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["piece", "uses"])

    return run


@dataclass
class WholeWords:
    """What the edges of whole words need to know: training words, different ones, and the discount."""

    total: int
    different: int
    discount: float

    @classmethod
    def of(cls, total: int, different: int, once: int, twice: int) -> WholeWords:
        return cls(total, different, once / (once + 2 * twice) if once else 0.0)

    def join(self, counts: np.ndarray, paths: np.ndarray) -> np.ndarray:
        """Log probability of words by their counts and the log sums over their paths through pieces."""
        edge = np.maximum(counts - self.discount, 0.0)
        with np.errstate(divide="ignore"):
            both = np.logaddexp(np.log(edge), paths + math.log(1.0 + self.discount * self.different))
        return both - math.log(self.total + 1.0)


def weigh(pieces: Pieces, whole: WholeWords) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(word, c) -> (word, c, score): log10 of the word's probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs, _ = word_lattices(batch["word"].to_pylist(), pieces)
            logs = whole.join(batch["c"].to_numpy().astype(float), logs)
            yield pa.record_batch([batch["word"], batch["c"], pa.array(logs / math.log(10))], names=["word", "c", "score"])

    return run


def score_frequent(table) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(rid, id, held_out, body) -> a row per document and rare word; the first one also carries the document's sums over
    its frequent words. Without rare words the row names a word that cannot occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, scores = table.value
        place = dict(zip(words, range(len(words)), strict=True)).get
        base = np.log10(counts + 1.0)
        for batch in slices(batches):
            rows: list[tuple] = []
            origin: list[int] = []
            for i, raw in enumerate(text_bytes(batch["body"])):
                found = byte_words(raw)
                at = np.fromiter((place(w, -1) for w in found), np.int64, len(found))
                known = at[at >= 0]
                rare = Counter(found[j] for j in np.flatnonzero(at < 0).tolist())
                sums = (len(found), int((counts[known] > 0).sum()), float(base[known].sum()), float(scores[known].sum()))
                for word, n in (rare or {b" %d" % batch["rid"][i].as_py(): 0}).items():
                    rows.append((word, n, *sums))
                    origin.append(i)
                    sums = (0, 0, 0.0, 0.0)
            columns = list(zip(*rows, strict=True))
            types = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            keep = batch.select(["rid", "id", "held_out"]).take(pa.array(origin, pa.int64()))
            yield pa.record_batch(
                [*keep.columns, *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                names=["rid", "id", "held_out", "word", "n", "n_words", "known", "base", "score"],
            )

    return run


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def dealt_words(weighed: DataFrame, total: int) -> DataFrame:
    """(digest, parts): the hashes of the long words that hold a SHARE-th of the training tokens or more, and into how many
    parts their keys are dealt. Both sides of the join go by the hash, so words that share one are dealt alike."""
    parts = F.least(F.expr(f"1 + c * {SHARE} DIV {max(total, 1)}"), F.col("c")).cast("int")
    hot = weighed.where(F.octet_length("word") > SHORT).where(F.col("c") * SHARE >= max(total, 1)).where("c > 1")
    rows = hot.groupBy(F.xxhash64("word").alias("digest")).agg(F.max(parts).alias("parts")).collect()  # SHARE rows at most
    return weighed.sparkSession.createDataFrame([tuple(r) for r in rows], "digest bigint, parts int")


def with_parts(rows: DataFrame, dealt: DataFrame) -> DataFrame:
    """Adds `parts`, 1 for a word that is not dealt."""
    digest = F.when(F.octet_length("word") > SHORT, F.xxhash64("word"))
    joined = rows.withColumn("digest", digest).join(F.broadcast(dealt), "digest", "left")
    return joined.withColumn("parts", F.coalesce("parts", F.lit(1))).drop("digest")


def score_documents(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per document.

    `base_score` is the log10 probability under an add-one model of whole words, for comparison.
    """
    spark = docs.sparkSession
    named = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(quoted(id_col)).alias("id"),
        held_out(id_col).alias("held_out"),
        text_or_empty(text_col).alias("body"),
    )
    words = stage(
        named.select("held_out", "body").mapInArrow(count_words, "word binary, c bigint")
        .groupBy("word").agg(F.sum("c").alias("c")),
        "words",
    )
    train_docs = docs.where(~held_out(id_col)).count()
    seen = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        *[F.count_if(F.expr(test)).alias(name) for name, test in (("v", "c > 0"), ("once", "c = 1"), ("twice", "c = 2"))],
    ).first()
    n, v = seen["n"] + train_docs, seen["v"] + (train_docs > 0)

    first = read_vocabulary(vocabulary)
    surfaces, weights = list(first), np.array(list(first.values()))
    trained = Pieces.of(surfaces, weights / weights.sum())
    for _ in range(rounds):
        expected = words.where("c > 0").select("word").mapInArrow(expect(trained), "piece bigint, uses double")
        uses = np.ones(len(surfaces))  # add one; the driver reads back one row per piece of the vocabulary at most
        for row in expected.groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
            uses[row["piece"]] += row["uses"]
        trained = Pieces(trained.keys, np.log(uses / uses.sum()), trained.lengths)
    whole = WholeWords.of(seen["n"], seen["v"], seen["once"], seen["twice"])
    end_score, word_score = (math.log10((c + 1) / (n + 2)) for c in (train_docs, seen["n"]))

    weighed = stage(words.mapInArrow(weigh(trained, whole), "word binary, c bigint, score double"), "weighed")
    short = weighed.where(F.octet_length("word") <= SHORT)
    top = short.orderBy(F.desc("c"), "word").limit(FREQUENT).toArrow()
    table = spark.sparkContext.broadcast(
        (top["word"].to_pylist(), top["c"].to_numpy().astype(float), top["score"].to_numpy())
    )
    id_type = docs.schema[id_col].dataType.simpleString()
    parts = named.mapInArrow(
        score_frequent(table),
        f"rid bigint, id {id_type}, held_out boolean, word binary, n bigint, n_words bigint, known bigint, base double,"
        " score double",
    )
    dealt = dealt_words(weighed, seen["n"])
    parts = with_parts(parts, dealt).withColumn("part", F.expr("CAST(pmod(xxhash64(rid), parts) AS int)"))
    rare = with_parts(weighed, dealt).select(
        "word", F.col("c"), F.col("score").alias("each"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    zero = F.lit(0.0)
    return (
        parts.join(rare, ["word", "part"], "left")
        .groupBy("rid", "id", "held_out")
        .agg(
            F.sum("n_words").alias("n_words"),
            F.sum(F.col("known") + F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"),
            F.sum(F.col("base") + F.coalesce(F.col("n") * F.log10(F.col("c") + 1), zero)).alias("base"),
            F.sum(F.col("score") + F.coalesce(F.col("n") * F.col("each"), zero)).alias("score"),
        )
        .select(
            "id",
            "held_out",
            (F.col("n_words") + 1).alias("n_tokens"),
            (F.col("known") + int(train_docs > 0)).alias("n_known"),
            F.lit(n).cast("bigint").alias("train_tokens"),
            (F.col("base") + math.log10(train_docs + 1) - (F.col("n_words") + 1) * math.log10(n + v + 1)).alias("base_score"),
            (F.col("score") + F.col("n_words") * word_score + end_score).alias("score"),
        )
    )


def op1_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    scored = score_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return scored.withColumnRenamed("id", "doc_id")
