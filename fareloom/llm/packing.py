"""Packing documents into sequences of a fixed capacity by a grouping genetic algorithm on islands.

A document's token ids, with a closing id, are one piece, or several where it is longer than the capacity. Pieces are dealt at
random into blocks of a bounded number. A block is one packing problem, solved by several islands side by side, each a population of
packings: a child receives a run of whole well-filled bins of one parent; bins of the other parent that hold one of their pieces are
removed, as are some of its worst; and pieces left without a bin are put back by best fit, largest first. Between epochs the best
packing of each island migrates to the next island of its block. An island rests when its best needs no more bins than the tokens do.

Bins that stay open, with more room than 1 in 128, are emptied and their pieces dealt into new blocks, round by round, until they
fit one block or no quarter of them finds a closed bin. So sequences near the least number come out, though no task sees more
than a block. Seeds come from the block, island and epoch: a repeated task gives the same packing.

Null and empty texts are the closing id alone, one piece of length 1. Repeated rows are packed one by one. Texts of any length are
tokenised in stretches cut at a space, and no word over 64 bytes is remembered. Pieces of equal length are interchangeable and tell
nothing apart. An empty table gives no pieces. Only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import random
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareloom.llm.bpe_counts import ALL_WORDS, ASCII_WORDS
from fareloom.llm.common import quoted, read_table, slices, text_or_empty
from fareloom.sources.storage import stage

CAPACITY = 2048
CLOSING_ID = 0
BLOCK = 1_024  # pieces of a problem, on average; at most 65,535
ISLANDS, PACKINGS = 2, 4  # islands of a block, packings of an island
SEARCHES = 16  # islands that a task evolves, where that makes no more tasks than spark.sql.shuffle.partitions
EPOCHS, CHILDREN = 2, 16  # children that an island breeds in an epoch
STRAY = 0.1  # by which share an order strays from the pieces' sizes
OPEN = 128  # a bin with more room than 1 in this many is open

STRETCH = 1 << 20  # code points of a text that are tokenised at a time
REMEMBERED, OVERHEAD = 192 << 20, 160  # bytes of words and their ids per Python worker; bytes of an entry besides its contents
LONGEST = 64  # bytes of a word that is remembered

Bins = list[list[int]]
Packing = tuple[Bins, list[int]]  # bins, and the room left in each


# tokenising


class WordIds:
    """The ids of texts, word by word: a word's ids depend on the word alone, so those of short words are remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        vocabulary = self.model.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        special = [t.content for t in self.model.get_added_tokens_decoder().values() if t.special]
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")")
        self.known: dict[str, bytes] = {}
        self.held = 0

    def encode(self, text: str) -> bytes:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, all in one call: a word's last token is marked as a word's end."""
        raw = self.encode(" ".join(words))
        cuts = (np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 1) * 4
        if len(cuts) != len(words):
            return {w: self.encode(w) for w in words}
        starts = [0, *cuts[:-1].tolist()]
        return {w: raw[a:b] for w, a, b in zip(words, starts, cuts.tolist(), strict=True)}

    def ids_of_words(self, text: str) -> bytes:
        if text.isascii():
            words = ASCII_WORDS.findall(text.lower())
        else:
            words = ALL_WORDS.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        new = list(set(words).difference(self.known))
        if not new:
            return b"".join(map(self.known.__getitem__, words))
        found = self.learn(new)
        if self.held > REMEMBERED:
            found |= {w: self.known[w] for w in set(words).difference(found)}
            self.known, self.held = {}, 0
        long = {w: raw for w, raw in found.items() if len(w) > LONGEST // 4 and len(w.encode()) > LONGEST}
        short = found if not long else {w: raw for w, raw in found.items() if w not in long}
        self.known.update(short)
        self.held += OVERHEAD * len(short) + sum(map(len, short)) + sum(map(len, short.values()))
        if long:
            return b"".join([long[w] if w in long else self.known[w] for w in words])
        return b"".join(map(self.known.__getitem__, words))

    def stretches(self, text: str) -> Iterator[bytes]:
        """Ids of a text, stretch by stretch. A special token's string in it is that token."""
        start = 0
        while start < len(text):
            end = len(text)
            if end - start > STRETCH:
                space = text.find(" ", start + STRETCH)
                end = end if space < 0 else space
            part = text[start:end] if (start, end) != (0, len(text)) else text
            start = end
            if "<|" not in part:
                yield self.ids_of_words(part)
                continue
            for i, piece in enumerate(self.special.split(part)):
                yield self.encode(piece) if i % 2 else self.ids_of_words(piece)


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def cut(stretches: Iterator[bytes], closing: int, capacity: int) -> Iterator[bytes]:
    """The ids and the closing one, in pieces of the capacity; the last may be shorter."""
    size, held = 4 * capacity, b""
    for raw in stretches:
        held = held + raw if held else raw
        at = 0
        while len(held) - at > size:
            yield held[at : at + size]
            at += size
        held = held[at:]
    held += closing.to_bytes(4, "little")
    for at in range(0, len(held), size):
        yield held[at : at + size]


def piece_batches(
    path: str, closing: int, capacity: int, with_ids: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(path)
        for batch in slices(batches):
            row, piece, start, length, crc, raws = [], [], [], [], [], []
            for i, text in enumerate(batch["body"]):
                at = 0
                for k, raw in enumerate(cut(ids.stretches(text.as_py()), closing, capacity)):
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(raw) // 4)
                    crc.append(zlib.crc32(raw))
                    at += length[-1]
                    if with_ids:
                        raws.append(np.frombuffer(raw, "<u4").astype("<i4"))
            columns = [batch["id"].take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64())]
            columns += [pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(raws, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(columns, names=names)

    return run


def tokenised_pieces(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    closing: int = CLOSING_ID,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]), a row per piece. `vocabulary` is a path on every executor."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(quoted(id_col)).alias("id"), text_or_empty(text_col).alias("body")).mapInArrow(
        piece_batches(vocabulary, closing, capacity, with_ids), schema
    )


# packing a block


def best_fit(pieces: list[int], lengths: list[int], packing: Packing, capacity: int) -> None:
    """Put pieces, in this order, each into the bin it fills best. Bit f of `rooms` is set if a bin has room f."""
    bins, room = packing
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for b, f in enumerate(room):
        if f:
            by_room.setdefault(f, []).append(b)
            rooms |= 1 << f
    for i in pieces:
        need = lengths[i]
        fitting = rooms >> need
        if fitting:
            f = need + (fitting & -fitting).bit_length() - 1
            b = by_room[f].pop()
            if not by_room[f]:
                rooms ^= 1 << f
            bins[b].append(i)
        else:
            f, b = capacity, len(bins)
            bins.append([i])
            room.append(0)
        left = f - need
        room[b] = left
        if left:
            by_room.setdefault(left, []).append(b)
            rooms |= 1 << left


def cost(packing: Packing, capacity: int) -> tuple[int, int]:
    """Fewer bins are better, then bins whose fillings differ more: room in one place can still be used."""
    return len(packing[1]), -sum((capacity - f) ** 2 for f in packing[1])


def child(giver: Packing, taker: Packing, lengths: list[int], capacity: int, rng: random.Random) -> Packing:
    """A run of the giver's well-filled bins, the taker's bins that hold none of their pieces and that were not opened, and the rest
    by best fit, about in order of size. Bins with room are opened by chance."""
    (given, given_room), (kept, kept_room) = giver, taker
    filled = sorted(range(len(given)), key=given_room.__getitem__)[: max(1, len(given) // 2)]
    first, n = rng.randrange(len(filled)), rng.randint(1, max(1, len(filled) // 2))
    injected = [filled[(first + k) % len(filled)] for k in range(n)]
    bins, room = [list(given[b]) for b in injected], [given_room[b] for b in injected]
    placed = {i for b in bins for i in b}
    worst = sorted(range(len(kept)), key=kept_room.__getitem__, reverse=True)[: 3 + len(kept) // 16]
    opened = {b for b in worst if rng.random() < 0.5}
    displaced = []
    for b, pieces in enumerate(kept):
        if b in opened or not placed.isdisjoint(pieces):
            displaced += [i for i in pieces if i not in placed]
        else:
            bins.append(pieces[:])
            room.append(kept_room[b])
    displaced.sort(key=lambda i: lengths[i] * rng.uniform(1 - STRAY, 1 + STRAY), reverse=True)
    best_fit(displaced, lengths, (bins, room), capacity)
    return bins, room


def first_packings(lengths: list[int], capacity: int, rng: random.Random, n: int) -> list[Packing]:
    """Best fit in order of size, and in orders that stray from it."""
    found = []
    for k in range(n):
        order = sorted(range(len(lengths)), key=lambda i: lengths[i] * (1 + STRAY * k * rng.random()), reverse=True)
        packing: Packing = ([], [])
        best_fit(order, lengths, packing, capacity)
        found.append(packing)
    return found


def least_bins(lengths: list[int], capacity: int) -> int:
    return -(-sum(lengths) // capacity)


def evolve(population: list[Packing], lengths: list[int], capacity: int, rng: random.Random, children: int) -> list[Packing]:
    """The population, best first, after so many children: each takes the place of the worst unless it is worse, or no other than one
    that is there."""
    ranked = sorted(((cost(p, capacity), k, p) for k, p in enumerate(population)), key=lambda x: x[:2])
    least = least_bins(lengths, capacity)
    for k in range(children):
        if ranked[0][0][0] <= least or len(ranked) < 2:
            break
        giver, taker = rng.sample(range(len(ranked)), 2)
        bred = child(ranked[giver][2], ranked[taker][2], lengths, capacity, rng)
        new = (cost(bred, capacity), len(population) + k, bred)
        if new[0] <= ranked[-1][0] and all(new[0] != known[0] for known in ranked[:-1]):
            ranked = sorted([*ranked[:-1], new], key=lambda x: x[:2])
    return [p for _, _, p in ranked]


def as_genes(packing: Packing, n: int) -> np.ndarray:
    """The bin of each piece."""
    genes = np.empty(n, np.int32)
    for b, pieces in enumerate(packing[0]):
        genes[pieces] = b
    return genes


def as_packing(genes: list[int], lengths: list[int], capacity: int) -> Packing:
    bins: Bins = [[] for _ in range(max(genes) + 1)]
    room = [capacity] * len(bins)
    for i, b in enumerate(genes):
        bins[b].append(i)
        room[b] -= lengths[i]
    return bins, room


# islands

ISLAND = "block bigint, island int, lengths array<int>, population array<array<int>>, bins int, spread bigint"


def evolve_batches(
    epoch: int, capacity: int, packings: int, children: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An epoch of each island: rows (block, island, lengths, population, migrant), the last two empty at the beginning."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            out = []
            for row in batch.to_pylist():
                lengths, n = row["lengths"], len(row["lengths"])
                rng = random.Random(f"{row['block']}:{row['island']}:{epoch}")
                known = [as_packing(g, lengths, capacity) for g in row["population"] or []]
                if row["migrant"] is not None:
                    known = [*known[: packings - 1], as_packing(row["migrant"], lengths, capacity)]
                known = known or first_packings(lengths, capacity, rng, packings)
                ranked = evolve(known, lengths, capacity, rng, children)
                bins, spread = cost(ranked[0], capacity)
                genes = [as_genes(p, n) for p in ranked]
                out.append((row["block"], row["island"], lengths, genes, bins, spread))
            names = ["block", "island", "lengths", "population", "bins", "spread"]
            types = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32())), pa.int32(), pa.int64()]
            yield pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)

    return run


def solved_blocks(
    problems: DataFrame,
    blocks: int,
    capacity: int,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    packings: int = PACKINGS,
    children: int = CHILDREN,
) -> DataFrame:
    """(block, genes): the best packing that any island of a block found, of so many problems (block, lengths). Rows are small and each
    worth a search, so they are dealt out by number and not by size."""
    tasks = min(int(problems.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-blocks * islands // SEARCHES))
    none = [F.lit(None).cast("array<array<int>>").alias("population"), F.lit(None).cast("array<int>").alias("migrant")]
    lands = problems.select("block", F.explode(F.array(*map(F.lit, range(islands)))).alias("island"), "lengths", *none)
    lands = lands.repartition(tasks, "block", "island").mapInArrow(evolve_batches(0, capacity, packings, children), ISLAND)
    for epoch in range(1, epochs):
        elite = lands.select(
            "block", ((F.col("island") + 1) % islands).alias("island"), F.col("population")[0].alias("migrant")
        )
        lands = (
            lands.join(elite, ["block", "island"])
            .select("block", "island", "lengths", "population", "migrant")
            .repartition(tasks, "block", "island")
            .mapInArrow(evolve_batches(epoch, capacity, packings, children), ISLAND)
        )
    best = F.min_by(F.col("population")[0], F.struct("bins", "spread", "island"))
    return lands.groupBy("block").agg(best.alias("genes"))


def packed_round(pieces: DataFrame, number: int, blocks: int, capacity: int) -> DataFrame:
    """(rid, length, sequence_id, offset, is_open): one round over pieces (rid, length)."""
    block = F.pmod(F.xxhash64(F.lit(number), "rid"), F.lit(blocks)).alias("block")
    problems = stage(
        pieces.select(block, F.struct("rid", "length").alias("piece"))
        .groupBy("block").agg(F.sort_array(F.collect_list("piece")).alias("pieces")),
        "blocks",
    )
    lengths = F.transform("pieces", lambda p: p["length"].cast("int")).alias("lengths")
    genes = solved_blocks(problems.select("block", lengths), blocks, capacity)
    placed = (
        problems.join(genes, "block")
        .select("block", F.explode(F.arrays_zip("pieces", "genes")).alias("x"))
        .select("block", F.col("x.genes").alias("bin"), "x.pieces.rid", "x.pieces.length")
    )
    bin_rows = Window.partitionBy("block", "bin")
    before = bin_rows.orderBy("rid").rowsBetween(Window.unboundedPreceding, -1)
    # Round, block and bin share the 63 bits of a sequence id.
    sequence = F.shiftleft(F.lit(number).cast("bigint"), 56) + F.shiftleft("block", 16) + F.col("bin")
    return placed.select(
        "rid",
        "length",
        sequence.alias("sequence_id"),
        F.coalesce(F.sum("length").over(before), F.lit(0).cast("bigint")).alias("offset"),
        ((capacity - F.sum("length").over(bin_rows)) * OPEN > capacity).alias("is_open"),
    )


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """(rid, sequence_id, offset) of pieces (rid, length): ids of any numbers, places in the sequence without gaps."""
    full = F.col("length") == capacity
    done = [pieces.where(full).select("rid", (-1 - F.col("rid")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))]
    left, number = pieces.where(~full).select("rid", "length"), 0
    count = left.count()
    while count:
        blocks = -(-count // block)
        tried = stage(packed_round(left, number, blocks, capacity), "packed")
        still = tried.where("is_open").count()
        last = blocks == 1 or 4 * still > 3 * count
        done.append((tried if last else tried.where("NOT is_open")).select("rid", "sequence_id", "offset"))
        left, count, number = tried.where("is_open"), 0 if last else still, number + 1
    packed = done[0]
    for part in done[1:]:
        packed = packed.unionByName(part)
    return packed


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, block: int = BLOCK, with_ids: bool = False, **columns: str
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset), a row per piece."""
    pieces = stage(
        tokenised_pieces(docs, vocabulary, capacity, with_ids=with_ids, **columns).withColumn("rid", F.monotonically_increasing_id()),
        "pieces",
    )
    return pieces.join(pack_pieces(pieces, capacity, block), "rid").drop("rid")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_pieces, ids): the sequences' ids, of pieces packed with their ids."""
    return packed.groupBy("sequence_id").agg(
        F.count(F.lit(1)).alias("n_pieces"),
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"),
    )


def op11_grouping_genetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumnRenamed("id", "doc_id")
