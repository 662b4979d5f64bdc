"""Near-duplicate classes by min-max hashing.

Each hash function is evaluated once per shingle and gives two signature values, its minimum and its maximum over
the set, so 80 functions fill 160 places. The places are cut into 32 bands of five; documents that agree in a band
are candidates, and a candidate counts only after an exact comparison of the full shingle sets. At a similarity of
0.85 a pair misses all bands with a probability of 7e-9, at 0.8 of 3e-6.

Documents with the same words are one node from the start. A bucket of n nodes does not emit its n * n pairs. First, one node
of each bucket is compared with the rest; then, in a few rounds, a node of the bucket's largest class with those outside it;
a sketch of two bits per signature place rules out what is far off (a true link with a probability of 1e-7). Last, the
nodes that are still outside their bucket's largest class are compared with all others there: blocks of them are held in
memory while the others stream past, and only links that join two classes are passed on. Every pair of a bucket whose
classes differ is then compared, as one of the two is outside the largest class.

Nulls, empty texts and texts of white space: no words, no shingles, linked with nothing. Fewer words than a shingle:
the whole sequence is one shingle. Rows that repeat, also under one id, are copies. A null id can belong to a class, whose
id is the smallest that is not null (null if there is none).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from fareloom.llm.common import byte_words, quoted, read_table, slices, text_bytes, text_or_empty, whole_row
from fareloom.sources.storage import stage

FUNCTIONS = 80
BANDS, BAND_ROWS = 32, 5  # BANDS * BAND_ROWS == 2 * FUNCTIONS
ROUNDS = 1  # with nodes of the largest class
HELD, STREAMED = 256, 4096  # nodes that a block holds, and that stream past it in one task
WIDER = 16  # how many more comparisons may be made over a group of buckets to send its sets once, not once a bucket
FILTER_BITS = 1 << 27  # most bits of the filter on texts; beyond, it lets more pass, which the join after it removes
CHUNK = 1 << 16  # shingles hashed at once, so that the working arrays stay in the processor's cache

_seeds = np.random.Generator(np.random.PCG64(20_240_601))
MULTIPLIERS = _seeds.integers(0, 2**64, FUNCTIONS, dtype=np.uint64) | np.uint64(1)
MASKS = _seeds.integers(0, 2**64, FUNCTIONS, dtype=np.uint64)
STEP, SPREAD = _seeds.integers(0, 2**64, 2, dtype=np.uint64) | np.uint64(1)


def shingle_set(words: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; one of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(k, len(h))
    mixed = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):
        mixed = mixed * STEP + h[j : len(h) - width + 1 + j]
    mixed ^= mixed >> np.uint64(29)
    mixed *= SPREAD
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def min_max_signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row per non-empty set: the minima under all functions, then the maxima under the same evaluations."""
    x = np.concatenate(sets)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    out = np.empty((len(sets), 2 * FUNCTIONS), np.uint64)
    v = np.empty_like(x)
    for i in range(FUNCTIONS):
        np.bitwise_xor(x, MASKS[i], out=v)
        np.multiply(v, MULTIPLIERS[i], out=v)
        out[:, i] = np.minimum.reduceat(v, starts)
        out[:, FUNCTIONS + i] = np.maximum.reduceat(v, starts)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(sets, BANDS) keys; the band's number is part of the key."""
    cut = signatures.reshape(len(signatures), BANDS, BAND_ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :].repeat(len(cut), 0)
    for j in range(BAND_ROWS):
        keys = keys * STEP + cut[:, :, j]
        keys ^= keys >> np.uint64(31)
    return (keys * SPREAD).view(np.int64)


def sketches(signatures: np.ndarray) -> np.ndarray:
    """Two bits of each signature place, 32 places to a number."""
    cut = (signatures & np.uint64(3)).reshape(len(signatures), -1, 32)
    return (cut << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(axis=2, dtype=np.uint64).view(np.int64)


def most_differences(percent: int) -> int:
    """Places in which the sketches of two sets at the threshold differ, and six deviations more."""
    p = 0.75 * (1 - percent / 100)
    return math.ceil(2 * FUNCTIONS * p + 6 * math.sqrt(2 * FUNCTIONS * p * (1 - p)))


def node_of(words: list[bytes]) -> bytes | None:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None


def chunks_of(sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Ranges of non-empty sets of about CHUNK shingles; a larger set is a range of its own."""
    start, held = 0, 0
    for i, s in enumerate(sets):
        if held and held + len(s) > CHUNK:
            yield start, i
            start, held = i, 0
        held += len(s)
    if start < len(sets):
        yield start, len(sets)


def sign(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, rk, body) -> (id, rk, node, n_shingles, bands, sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            nodes, sets = [], []
            for raw in text_bytes(batch["body"]):
                words = byte_words(raw)
                nodes.append(node_of(words))
                sets.append(shingle_set(words, k))
            filled = [s for s in sets if len(s)]
            signatures = [min_max_signatures(filled[a:b]) for a, b in chunks_of(filled)]
            keys = [band_keys(x) for x in signatures]
            codes = [sketches(x) for x in signatures]

            def lists(parts: list[np.ndarray], width: int, sets: list[np.ndarray] = sets) -> pa.ListArray:
                ends = np.cumsum([0, *[width if len(s) else 0 for s in sets]])
                flat = np.concatenate(parts).ravel() if parts else np.empty(0, np.int64)
                return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))

            columns = {
                "id": batch["id"],
                "rk": batch["rk"],
                "node": pa.array(nodes, pa.binary()),
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "bands": lists(keys, BANDS),
                "sketch": lists(codes, FUNCTIONS // 16),
            }
            yield pa.record_batch(list(columns.values()), names=list(columns))

    return run


def filter_places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Three places of each 64-bit hash in a filter of so many bits, a power of two up to 2 ** 27."""
    return np.stack([(hashes >> np.uint64(shift)) & np.uint64(bits - 1) for shift in (0, 18, 36)])


def full_sets(k: int, keep) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(rk, body) -> (rk, shingles): the full set, packed, of each text that passes the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = keep.value
        for batch in slices(batches):
            hashes = np.fromiter((xxhash.xxh64_intdigest(x) for x in text_bytes(batch["rk"])), np.uint64, batch.num_rows)
            places = filter_places(hashes, 64 * len(bits))
            passed = ((bits[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1)).all(axis=0)
            batch = batch.filter(pa.array(passed))
            packed = [shingle_set(byte_words(raw), k).tobytes() for raw in text_bytes(batch["body"])]
            yield pa.record_batch([batch["rk"], pa.array(packed, pa.binary())], names=["rk", "shingles"])

    return run


def mark_places(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(rk) -> (word, mask): the bits of a filter that a task's keys set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.fromiter((xxhash.xxh64_intdigest(x) for x in text_bytes(batch["rk"])), np.uint64, batch.num_rows)
            places = filter_places(hashes, bits).ravel()
            masks = (np.uint64(1) << (places & np.uint64(63))).view(np.int64)
            yield pa.record_batch([pa.array((places >> np.uint64(6)).view(np.int64)), pa.array(masks)], names=["word", "mask"])

    return run


def key_filter(keys: DataFrame) -> np.ndarray:
    """A filter of bounded size that every key of the column `rk` passes."""
    n = keys.count()
    bits = 1 << max(12, min(FILTER_BITS.bit_length() - 1, (16 * n).bit_length()))
    words = keys.mapInArrow(mark_places(bits), "word bigint, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    out = np.zeros(bits // 64, np.uint64)
    for row in words.toLocalIterator():  # at most FILTER_BITS / 64 rows
        out[row["word"]] = np.array(row["mask"], np.int64).view(np.uint64)
    return out


def confirm(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(a, b, sa, sb) -> the pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for sa, sb in zip(batch["sa"], batch["sb"], strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (sa, sb))
                both = np.concatenate((x, y))
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                good.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def classes(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with a link; the label is the smallest node of its class.

    Alternates two steps that hang a node's neighbours on the smallest node it knows of, until nothing changes. Each
    step is a minimum per node and a join on the node, and each result a table in the shared folder.
    """
    seen = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        floor = down.groupBy("a").agg(F.min("b").alias("m"))
        hung = down.join(floor, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = hung.union(floor.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = stage(small, "links")
        found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == seen:
            break
        seen = tuple(found)
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)


def labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").select(*members.columns, F.coalesce("label", "node").alias("label"))


class Block:
    """Sets held in memory, to be met by sets that stream past."""

    def __init__(self, percent: int):
        self.percent = percent
        self.nodes: list[bytes] = []
        self.labels: list[bytes] = []
        self.sets: list[np.ndarray] = []
        self.values: np.ndarray | None = None
        self.parent: dict[bytes, bytes] = {}

    def hold(self, node: bytes, label: bytes, shingles: np.ndarray) -> None:
        self.nodes.append(node)
        self.labels.append(label)
        self.sets.append(shingles)

    def root(self, label: bytes) -> bytes:
        while (up := self.parent.get(label, label)) != label:
            label = up
        return label

    def meet(self, node: bytes, label: bytes, shingles: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
        """The links of a passing node that join two classes not yet joined here."""
        if not self.sets:
            return
        if self.values is None:
            joined = np.concatenate(self.sets)
            order = np.argsort(joined, kind="stable")
            self.sizes = np.array([len(x) for x in self.sets])
            self.values, self.owners = joined[order], np.repeat(np.arange(len(self.sets)), self.sizes)[order]
        start, end = (np.searchsorted(self.values, shingles, side) for side in ("left", "right"))
        width = end - start
        at = np.repeat(end - np.cumsum(width), width) + np.arange(width.sum())
        common = np.bincount(self.owners[at], minlength=len(self.sets))
        near = 100 * common >= self.percent * (self.sizes + len(shingles) - common)
        for i in np.flatnonzero(near).tolist():
            a, b = self.root(self.labels[i]), self.root(label)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                yield self.nodes[i], node


def close_blocks(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(block, passes, node, label, shingles), sorted by block with the held nodes first -> links (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, block = None, Block(percent)
        for batch in slices(batches, 512):
            links: list[tuple[bytes, bytes]] = []
            for now, passes, node, label, packed in zip(*batch.columns, strict=True):
                if now.as_py() != name:
                    name, block = now.as_py(), Block(percent)
                row = (node.as_py(), label.as_py(), np.frombuffer(packed.as_buffer(), np.uint64))
                if passes.as_py():
                    links += block.meet(*row)
                else:
                    block.hold(*row[:2], row[2].copy())
            ends = [pa.array([min(x) for x in links], pa.binary()), pa.array([max(x) for x in links], pa.binary())]
            yield pa.record_batch(ends, names=["a", "b"])

    return run


def close_buckets(now: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """The links left in buckets that hold several classes. `now`: (key, node, n, label, top), buckets of several only."""
    star = now.groupBy("key").agg(F.min("node").alias("a"))
    edges = stage(now.join(star, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct(), "links")
    if edges.isEmpty():
        return None
    near = classes(edges).withColumnRenamed("label", "area")
    placed = now.join(near, "node").withColumn("held", F.expr("label <> top"))
    per_bucket = placed.groupBy("area", "key").agg(F.count_if("held").alias("p"), F.count(F.lit(1)).alias("m"))
    dear = per_bucket.groupBy("area").agg(F.sum(F.expr("CAST(p * m AS DOUBLE)")).alias("apart"))
    once = placed.groupBy("area", "node").agg(F.bool_or("held").alias("held"))
    whole = once.groupBy("area").agg(F.count_if("held").alias("p"), F.count(F.lit(1)).alias("m"))
    # Sets of an area go out once where that does not make many more comparisons, else once for each of its buckets.
    choice = whole.join(dear, "area").select("area", F.expr(f"CAST(p * m AS DOUBLE) <= {WIDER} * apart AS together"))
    grouped = stage(
        placed.join(choice, "area")
        .groupBy("area", F.expr("IF(together, 0L, key) AS bucket"), "node")
        .agg(F.bool_or("held").alias("held"), F.min("label").alias("label")),
        "areas",
    )
    sizes = grouped.groupBy("area", "bucket").agg(
        F.expr(f"greatest(1, ceil(count_if(held) / {HELD})) AS blocks"), F.expr(f"ceil(count(*) / {STREAMED}) AS streams")
    )
    sized = grouped.join(sizes, ["area", "bucket"]).join(sets, "node")
    lot = "pmod(xxhash64(node), {})"
    to_last = "explode(sequence(0L, {} - 1))"
    held = sized.where("held").selectExpr(
        "area", "bucket", f"{lot.format('blocks')} AS x", f"{to_last.format('streams')} AS y", "false AS passes", "node", "label", "shingles"
    )
    passing = sized.selectExpr(
        "area", "bucket", f"{to_last.format('blocks')} AS x", f"{lot.format('streams')} AS y", "true AS passes", "node", "label", "shingles"
    )
    block = F.concat_ws(":", F.hex("area"), "bucket", "x", "y").alias("block")
    rows = held.union(passing).select(block, "passes", "node", "label", "shingles")
    ordered = rows.repartition("block").sortWithinPartitions("block", "passes")
    return stage(ordered.mapInArrow(close_blocks(percent), "a binary, b binary"), "links")


def linked_nodes(members: DataFrame, codes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, label) over all confirmed links. `members`: (key, node, n) of the buckets that hold several nodes; `codes`:
    (node, sketch)."""
    differ = " + ".join(
        f"bit_count((ca[{i}] ^ cb[{i}] | shiftrightunsigned(ca[{i}] ^ cb[{i}], 1)) & 6148914691236517205L)"
        for i in range(FUNCTIONS // 16)
    )

    def side(table: DataFrame, column: str, name: str, alias: str) -> DataFrame:
        return table.select(F.col("node").alias(name), F.col(column).alias(alias))

    def compared(hubs: DataFrame, rest: DataFrame) -> DataFrame:
        """The links of hubs (key, a, na) with nodes (key, b, nb) of their bucket."""
        pairs = (
            hubs.join(rest, "key")
            .where(f"a <> b AND 100 * least(na, nb) >= {percent} * greatest(na, nb)")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
        )
        likely = (
            pairs.join(side(codes, "sketch", "a", "ca"), "a")
            .join(side(codes, "sketch", "b", "cb"), "b")
            .where(f"{differ} <= {most_differences(percent)}")
            .select("a", "b")
        )
        confirmed = likely.join(side(sets, "shingles", "a", "sa"), "a").join(side(sets, "shingles", "b", "sb"), "b")
        return stage(confirmed.mapInArrow(confirm(percent), "a binary, b binary"), "links")

    def joined(links: DataFrame) -> DataFrame:
        return members.sparkSession.createDataFrame([], "node binary, label binary") if links.isEmpty() else classes(links)

    def several(labels: DataFrame) -> DataFrame:
        """The members of buckets that hold several classes, with their label and the bucket's largest class."""
        now = stage(labelled(members, labels), "members")
        per_class = now.groupBy("key", "label").agg(F.count(F.lit(1)).alias("held"))
        top = per_class.groupBy("key").agg(F.max(F.struct("held", "label")).alias("t"), F.count(F.lit(1)).alias("kinds"))
        return now.join(top.where("kinds > 1").select("key", F.col("t.label").alias("top")), "key")

    first = F.min(F.struct("node", "n")).alias("h")
    rest = members.select("key", F.col("node").alias("b"), F.col("n").alias("nb"))
    links = compared(members.groupBy("key").agg(first).selectExpr("key", "h.node AS a", "h.n AS na"), rest)
    labels = joined(links)
    for turn in range(ROUNDS):
        now = several(labels)
        one = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("draw"), "node", "n")).alias("h")
        hubs = now.where("label = top").groupBy("key").agg(one).selectExpr("key", "h.node AS a", "h.n AS na")
        outside = now.where("label <> top").select("key", F.col("node").alias("b"), F.col("n").alias("nb"))
        links = stars(labels).union(compared(hubs, outside))
        labels = joined(links)
    last = close_buckets(several(labels), sets, percent)
    return labels if last is None or last.isEmpty() else classes(stars(labels).union(last))


def stars(labels: DataFrame) -> DataFrame:
    """The links that say the same as the labels."""
    return labels.where("node <> label").select(F.col("label").alias("a"), F.col("node").alias("b"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 85
) -> DataFrame:
    """(id, node, n_shingles, label, component_id), one row per document; see the module's docstring.

    `node` stands for the document's words and `label` for its class (both null without words); `component_id` is the
    smallest id of the class.
    """
    body = text_or_empty(text_col)
    identity = F.col(quoted(id_col))
    # Names one row up to exact repetition, also where ids are null or used twice.
    rk = F.concat_ws(":", F.coalesce(identity.cast("string"), F.lit("-")), F.xxhash64(body).cast("string"))
    named = docs.select(identity.alias("id"), rk.alias("rk"), body.alias("body"))
    id_type = docs.schema[id_col].dataType.simpleString()
    signed = stage(
        named.mapInArrow(
            sign(k),
            f"id {id_type}, rk string, node binary, n_shingles bigint, bands array<bigint>, sketch array<bigint>",
        ),
        "signatures",
    )

    nodes = (
        signed.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min(F.struct("rk", "n_shingles", "bands", "sketch")).alias("one"))
        .select("node", "one.*")
    )
    spread = nodes.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    crowded = spread.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where("held > 1").select("key")
    members = stage(spread.join(crowded, "key"), "members")
    wanted = stage(
        members.select("node").distinct().join(nodes.select("node", "rk", "sketch"), "node"), "candidates"
    )
    # Texts are many and candidates few, so a filter that goes with the code picks the texts whose sets are sent.
    keep = docs.sparkSession.sparkContext.broadcast(key_filter(wanted.select("rk")))
    picked = named.select("rk", "body").mapInArrow(full_sets(k, keep), "rk string, shingles binary")
    sets = stage(
        picked.join(wanted.select("rk", "node"), "rk").groupBy("node").agg(F.first("shingles").alias("shingles")), "sets"
    )

    labels = linked_nodes(members, wanted.select("node", "sketch"), sets, percent)
    placed = labelled(signed.where("node IS NOT NULL").select("id", "node", "n_shingles"), labels)
    least = placed.groupBy("label").agg(F.min("id").alias("component_id"))
    alone = signed.where("node IS NULL").select(
        "id", "node", "n_shingles", F.lit(None).cast("binary").alias("label"), F.col("id").alias("component_id")
    )
    return placed.join(least, "label").select("id", "node", "n_shingles", "label", "component_id").union(alone)


def name_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, body, place) -> (row, node): without words, the row's place, which is shorter than a node."""
    for batch in slices(batches):
        nodes = [
            node_of(byte_words(raw)) or place.as_py().to_bytes(8, "big")
            for raw, place in zip(text_bytes(batch["body"]), batch["place"], strict=True)
        ]
        yield pa.record_batch([batch["row"], pa.array(nodes, pa.binary())], names=["row", "node"])


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """One document of each class, that with the smallest id; of rows that repeat an id and its words, one. Documents
    without words all stay."""
    rows = docs.select(whole_row(docs).alias("row"), text_or_empty(text_col).alias("body"))
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    named = StructType([rows.schema["row"], StructField("node", BinaryType())])
    rows = rows.mapInArrow(name_nodes, named).withColumn("id", F.col("row")[id_col].cast("string"))
    # The id is part of the key, so copies of one text spread over the tasks.
    key = F.concat_ws(":", F.hex("node"), F.coalesce("id", F.lit("-")))
    single = rows.select("row", F.octet_length("node").alias("size"), key.alias("key")).dropDuplicates(["key"])
    found = near_duplicates(docs, id_col, text_col, k, percent).where("node IS NOT NULL AND id <=> component_id")
    stay = (
        found.groupBy("label").agg(F.min("node").alias("node"), F.first("id").alias("id"))
        .select(F.concat_ws(":", F.hex("node"), F.coalesce(F.col("id").cast("string"), F.lit("-"))).alias("key"))
        .withColumn("stays", F.lit(True))
    )
    return single.join(stay, "key", "left").where("stays OR size = 8").select("row.*")


def op7_minmax_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", F.expr("id <=> component_id AS kept")
    )


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# All pairs that share a shingle, and all that is reached over links.
NEAR_SQL = f"""
WITH RECURSIVE words AS (
 SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
 SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
 FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
 SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON b.s = a.s AND b.doc_id <> a.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
 SELECT a, b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)
), reached AS (
 SELECT doc_id AS a, doc_id AS b FROM words UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, r.component_id, w.doc_id = r.component_id AS kept
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) r ON r.a = w.doc_id
"""
