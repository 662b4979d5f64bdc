"""The trie of conversations that begin alike, with totals over its subtrees by centroid decomposition.

A conversation is rebuilt: the first h turns of the one it was seeded from, then its own turns after its first h. Each distinct
sequence of first turns is a node. A node is known by a digest of four sums over its turns, each turn adding a number that depends on its
place, role and text; running sums are taken in stretches of SEGMENT turns, so one endless conversation spreads over many tasks.

Totals over subtrees go by the forest of parent edges. A component's centroid is its deepest node whose subtree holds half its weight or
more, a node weighing its conversations: such subtree weights need no iteration, as a conversation of n turns adds n - d + 1 at
depth d. Taking the centroid out splits the component: below it, each child's subtree is one; above it, what is left keeps its top, and
the weights on the path from the centroid to the top fall by the centroid's. The component's total below the centroid, itself included,
is added to every node on that path. A node's total is the sum of what it was given this way. Components heavier than LIMIT are
split by joins, one round for all of them, each round halving the heaviest; lighter ones, of at most LIMIT nodes, are decomposed in a task.

Digests of conversation lists are taken over chunks, written in order by many tasks, so a list of any length passes one
digest as few rows. Joins against a node that very many rows point at are salted.

Null roles and texts are empty, null turns come first, and messages of one turn follow role and the text's digest, repeated rows
included. A row without a conversation id belongs to no conversation. Texts of any length are only hashed and measured. A table without
conversations gives the root alone, without members. Four columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareloom.llm.common import quoted, read_table
from fareloom.operators.keys import dense_key
from fareloom.sources.storage import stage

FAMILY, DEEPEST = 5, 9  # conversations of a family are seeded from its first; fewer than DEEPEST turns are taken from it
SEGMENT = 1_024
LIMIT = 65_536  # weight, and so nodes at most, of a component that one task decomposes
SALTS = 32
CHUNK = 4_096  # conversations in a chunk of a list
LANES = range(4)
ROOT_NAME = ".".join("0" for _ in range(1 + len(LANES)))


def segment(depth: Column | str) -> Column:
    return F.floor(F.col(depth) / SEGMENT if isinstance(depth, str) else depth / SEGMENT)


def node_of(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(".", depth, *sums)))


# rebuilding


def ordered_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(messages (conv, i, role, said, n_bytes) with their place i from 0, conversations (conv, first, len))."""
    said = F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))
    messages = turns.where(F.col(quoted(conv)).isNotNull()).select(
        F.col(quoted(conv)).cast("bigint").alias("conv"),
        F.col(quoted(turn)).isNotNull().alias("has_turn"),
        F.col(quoted(turn)).alias("turn"),
        F.coalesce(F.col(quoted(role)).cast("string"), F.lit("")).alias("role"),
        F.sha2(said, 256).alias("said"),
        F.octet_length(said).cast("bigint").alias("n_bytes"),
    )
    placed = dense_key(messages, ["conv", "has_turn", "turn", "role", "said"], "place")
    convs = placed.groupBy("conv").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("len"))
    by_segment = convs.select(
        "conv", "first", F.explode(F.sequence(segment("first"), segment(F.col("first") + F.col("len") - 1))).alias("seg")
    )
    found = placed.withColumn("seg", segment("place")).join(by_segment, ["conv", "seg"])
    return found.select("conv", (F.col("place") - F.col("first")).alias("i"), "role", "said", "n_bytes"), convs


def rebuilt_turns(messages: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns (conv, depth, role, said, n_bytes) of the rebuilt conversations, depth from 1; (conv, len) of each)."""
    seeds = convs.select(F.col("conv").alias("base"), F.col("len").alias("base_len"))
    taken = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(DEEPEST)).alias("taken")
    known = (
        convs.withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
        .withColumn("taken", taken)
        .join(seeds, "base", "left")
        .withColumn("seeded", F.least("taken", F.coalesce("base_len", F.lit(0))))
        .withColumn("n", F.col("seeded") + F.greatest(F.col("len") - F.col("taken"), F.lit(0)))
    )
    # At most DEEPEST turns of a first conversation, and FAMILY conversations that take them.
    heads = messages.where(f"i < {DEEPEST} AND conv % {FAMILY} = 0").withColumnRenamed("conv", "base")
    first = known.select("conv", "base", "taken").join(heads, "base").where("i < taken")
    by_segment = known.where("len > taken").select(
        "conv", "taken", "seeded", F.explode(F.sequence(segment("taken"), segment(F.col("len") - 1))).alias("seg")
    )
    own = (
        messages.withColumn("seg", segment("i")).join(by_segment, ["conv", "seg"]).where("i >= taken")
        .withColumn("i", F.col("seeded") + F.col("i") - F.col("taken"))
    )
    columns = ["conv", (F.col("i") + 1).cast("bigint").alias("depth"), "role", "said", "n_bytes"]
    return first.select(*columns).unionByName(own.select(*columns)), known.select("conv", F.col("n").cast("bigint").alias("len"))


def prefix_paths(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv, seg, depth, node, parent, n_bytes, len): every conversation's nodes, the root among them."""
    spelled = F.concat_ws(":", "depth", F.length("role"), "role", "said")
    digest = turns.withColumn("seg", segment("depth")).withColumn("digest", F.sha2(spelled, 256))
    lanes = [F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"x{k}") for k in LANES]
    numbered = digest.select("conv", "seg", "depth", "n_bytes", *lanes)
    here = Window.partitionBy("conv", "seg").orderBy("depth")
    running = numbered.select("*", *[F.sum(f"x{k}").over(here).alias(f"y{k}") for k in LANES])
    totals = numbered.groupBy("conv", "seg").agg(*[F.sum(f"x{k}").alias(f"t{k}") for k in LANES])
    earlier = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("conv", "seg", *[F.coalesce(F.sum(f"t{k}").over(earlier), F.lit(0)).alias(f"b{k}") for k in LANES])
    spread = lengths.select("conv", "len", F.explode(F.sequence(F.lit(0).cast("bigint"), segment("len"))).alias("seg"))
    sums = [F.col(f"y{k}") + F.col(f"b{k}") for k in LANES]
    deep = (
        running.join(before, ["conv", "seg"])
        .join(spread, ["conv", "seg"])
        .select(
            "conv",
            "seg",
            "depth",
            node_of(F.col("depth"), sums).alias("node"),
            node_of(F.col("depth") - 1, [s - F.col(f"x{k}") for k, s in zip(LANES, sums, strict=True)]).alias("parent"),
            "n_bytes",
            "len",
        )
    )
    zero = F.lit(0).cast("bigint")
    tops = lengths.select(
        "conv", zero.alias("seg"), zero.alias("depth"), F.unhex(F.md5(F.lit(ROOT_NAME))).alias("node"),
        F.lit(None).cast("binary").alias("parent"), zero.alias("n_bytes"), "len",
    )
    return tops.unionByName(deep)


def trie_nodes(paths: DataFrame) -> DataFrame:
    """(node, conv, depth, parent, n_bytes, n_convs, weight, n_children), a row per distinct prefix; copies of a path merge on
    the map side."""
    nodes = paths.groupBy("node").agg(
        F.min("conv").alias("conv"),
        F.min("depth").alias("depth"),
        F.min("parent").alias("parent"),
        F.min("n_bytes").alias("n_bytes"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("len") - F.col("depth") + 1).alias("weight"),
    )
    nodes = stage(nodes, "trie")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    return nodes.join(children, "node", "left").fillna(0, ["n_children"])


# totals over subtrees


def salted(large: DataFrame, small: DataFrame, on: list[str], unique: list[str], how: str = "inner") -> DataFrame:
    """large joined with small on `on`, where a third of large may share one key: each row of small meets SALTS parts of it."""
    parts = small.withColumn("salt", F.explode(F.array(*[F.lit(k) for k in range(SALTS)])))
    return large.withColumn("salt", F.pmod(F.hash(*unique), F.lit(SALTS))).join(parts, [*on, "salt"], how).drop("salt")


def subtree_totals(nodes: DataFrame, paths: DataFrame, values: list[str], limit: int = LIMIT) -> DataFrame:
    """(node, *values): each of the nodes (node, conv, depth, parent, weight, *values) with sums over its subtree. `paths` has
    (conv, seg, depth, node, parent, len) of the nodes' conversations."""
    root = F.unhex(F.md5(F.lit(ROOT_NAME)))
    state = nodes.select("node", "conv", "depth", "parent", "weight", *values, root.alias("comp"))
    given = []
    while True:
        totals = state.groupBy("comp").agg(F.max("weight").alias("total"), F.min("depth").alias("top"))
        heavy = stage(totals.where(F.col("total") > limit), "heavy")
        if heavy.isEmpty():
            break
        tagged = salted(state, heavy, ["comp"], ["node"], "left")
        given.append(light_totals(tagged.where("total IS NULL"), values))
        state, added = split_components(stage(tagged.where("total IS NOT NULL"), "component"), paths, values)
        given.append(added)
    given.append(light_totals(state, values))
    every = given[0]
    for part in given[1:]:
        every = every.unionByName(part)
    return every.groupBy("node").agg(*[F.sum(v).alias(v) for v in values])


def split_components(state: DataFrame, paths: DataFrame, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """(what is left without the centroids, in its new components; what the centroids' paths were given)."""
    here = F.struct("node", "conv", "depth", "weight", "top", *values)
    centroids = state.where("2 * weight >= total").groupBy("comp").agg(F.max_by(here, "depth").alias("c"))
    centroids = stage(centroids.select("comp", F.col("c.node").alias("centroid"), *[
        F.col(f"c.{name}").alias(f"c_{name}") for name in ("conv", "depth", "weight", "top", *values)
    ]), "centroids")
    # The child on the way down from the centroid, for each conversation that goes on below it.
    going = salted(
        paths.select("conv", F.col("parent").alias("centroid"), F.col("node").alias("child"), "len"),
        centroids.select("comp", "centroid", "c_depth"), ["centroid"], ["conv"],
    )
    going = going.select(
        "comp", "conv", "child", "c_depth", F.explode(F.sequence(segment(F.col("c_depth") + 1), segment("len"))).alias("seg")
    )
    parted = state.withColumn("seg", segment("depth")).join(going, ["comp", "conv", "seg"], "left")
    below = F.coalesce(F.col("depth") > F.col("c_depth"), F.lit(False))
    parted = stage(parted.select(*state.columns, F.when(below, F.col("child")).alias("child")), "parted")
    sums = parted.where("child IS NOT NULL").groupBy("comp").agg(*[F.sum(v).alias(f"below_{v}") for v in values])
    amounts = centroids.join(sums, "comp", "left").select(
        "comp", "centroid", "c_conv", "c_depth", "c_weight", "c_top",
        *[(F.col(f"c_{v}") + F.coalesce(F.col(f"below_{v}"), F.lit(0))).alias(v) for v in values],
    )
    by_segment = amounts.withColumn("seg", F.explode(F.sequence(segment("c_top"), segment("c_depth")))).withColumnRenamed("c_conv", "conv")
    path = (
        paths.select("conv", "seg", "depth", "node").join(by_segment, ["conv", "seg"])
        .where("depth BETWEEN c_top AND c_depth")
        .select("node", (F.col("node") == F.col("centroid")).alias("taken"), "c_weight", *values)
    )
    path = stage(path, "centroid-path")
    lost = path.select("node", "taken", "c_weight")
    left = parted.join(lost, "node", "left").where("taken IS NULL OR NOT taken").select(
        "node", "conv", "depth", "parent", (F.col("weight") - F.coalesce("c_weight", F.lit(0))).alias("weight"), *values,
        F.coalesce("child", "comp").alias("comp"),
    )
    return stage(left, "parts"), path.select("node", *values)


def decompose(parents: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    """Sums over subtrees of a tree whose nodes stand after their parents (`parents` of the first is -1)."""
    totals = [np.zeros(len(parents), np.int64) for _ in values]
    plain = [v.tolist() for v in values]
    parent = parents.tolist()
    mark = [-1] * len(parent)  # the part a node falls to
    size = [0] * len(parent)
    todo = [list(range(len(parent)))]
    while todo:
        members = todo.pop()
        top = members[0]
        if len(members) == 1:
            for t, v in zip(totals, plain, strict=True):
                t[top] += v[top]
            continue
        for i in members:
            size[i] = 1
        for i in reversed(members[1:]):
            size[parent[i]] += size[i]
        half, centroid = len(members), top
        for i in members:  # parents first, so the last that holds half is the deepest
            if 2 * size[i] >= half:
                centroid = i
        parts: dict[int, list[int]] = {}
        for i in members:
            if i == centroid:
                mark[i] = -1
                continue
            if i == top:
                mark[i] = -2
            elif parent[i] == centroid:
                mark[i] = i
            else:
                mark[i] = mark[parent[i]]
            parts.setdefault(mark[i], []).append(i)
        below = [centroid, *(i for m, part in parts.items() if m >= 0 for i in part)]
        for t, v in zip(totals, plain, strict=True):
            amount = sum(v[i] for i in below)
            at = centroid
            while True:
                t[at] += amount
                if at == top:
                    break
                at = parent[at]
        todo.extend(parts.values())
    return totals


def light_batches(values: list[str]):
    names = ["comp", "node", "parent", *values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one component follow one another, parents first; a component is at most LIMIT rows."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch.select(names))
            table = pa.Table.from_batches(held).combine_chunks()
            comps = table["comp"].to_pylist()
            last = comps[-1]
            whole = len(comps)
            while whole and comps[whole - 1] == last:
                whole -= 1
            if whole:
                yield solve(table.slice(0, whole))
            held = table.slice(whole).to_batches()
        if held and sum(b.num_rows for b in held):
            yield solve(pa.Table.from_batches(held))

    def solve(table: pa.Table) -> pa.RecordBatch:
        """All these components at once: a component's top stands for the parent that is not among its nodes."""
        comps, node, parent = (table[c].to_pylist() for c in names[:3])
        amounts = [table[v].to_numpy() for v in values]
        found = [np.empty(len(comps), np.int64) for _ in values]
        start = 0
        for end in range(1, len(comps) + 1):
            if end < len(comps) and comps[end] == comps[start]:
                continue
            place = {n: k for k, n in enumerate(node[start:end])}
            parents = np.array([place.get(p, -1) for p in parent[start:end]], np.int64)
            for f, t in zip(found, decompose(parents, [a[start:end] for a in amounts]), strict=True):
                f[start:end] = t
            start = end
        return pa.record_batch([pa.array(node, pa.binary()), *[pa.array(f, pa.int64()) for f in found]], names=["node", *values])

    return run


def light_totals(state: DataFrame, values: list[str]) -> DataFrame:
    """(node, *values) of components that fit a task."""
    rows = state.select("comp", "depth", "node", "parent", *values).repartition("comp").sortWithinPartitions("comp", "depth")
    return rows.mapInArrow(light_batches(values), "node binary, " + ", ".join(f"{v} bigint" for v in values))


# lists of conversations


def chunk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, first, text) of rows (node, conv) in order: runs of one node, of at most CHUNK."""
    for batch in batches:
        nodes, convs = batch["node"].to_pylist(), batch["conv"].to_pylist()
        out, start = [], 0
        for end in range(1, len(nodes) + 1):
            if end == len(nodes) or nodes[end] != nodes[start] or end - start == CHUNK:
                out.append((nodes[start], convs[start], ",".join(map(str, convs[start:end]))))
                start = end
        columns = [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.string()))]
        yield pa.record_batch(columns, names=["node", "first", "text"])


def digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends_sha256) of chunks in order."""
    node, digest = None, None
    for batch in batches:
        done = []
        for name, text in zip(batch["node"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if name == node:
                digest.update(b"," + text.encode())
                continue
            if digest is not None:
                done.append((node, digest.hexdigest()))
            node, digest = name, hashlib.sha256(text.encode())
        yield digests(done)
    if digest is not None:
        yield digests([(node, digest.hexdigest())])


def digests(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    columns = [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())]
    return pa.record_batch(columns, names=["node", "ends_sha256"])


def ends_digests(paths: DataFrame) -> DataFrame:
    """(node, ends_sha256): the digest of the conversations that end at a node, in ascending order."""
    ends = paths.where("depth = len").select("node", "conv").repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")
    chunks = ends.mapInArrow(chunk_batches, "node binary, first bigint, text string")
    return chunks.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest_batches, "node binary, ends_sha256 string")


# the whole


def with_parent_conv(nodes: DataFrame) -> DataFrame:
    """Adds parent_conv, the parent's smallest conversation. Nodes with over a thousandth of all nodes as children, a thousand
    at most, are broadcast; so no key of the other join is hot."""
    kin = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"), "n_children")
    many = nodes.agg((F.count(F.lit(1)) / 1000).alias("many"))
    hot = F.broadcast(kin.where(F.col("n_children") > many.scalar()).drop("n_children"))
    cold = nodes.join(hot, "parent", "left_anti").join(kin.drop("n_children"), "parent", "left")
    return cold.unionByName(nodes.join(hot, "parent"))


def prefix_trie(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """(conv, depth, parent_conv, n_convs, n_children, n_leaves, saved, ends_sha256, n_bytes), a row per node. `conv` is the
    smallest conversation through it; `saved` are the bytes of last turns that members share, over the subtree."""
    messages, convs = ordered_turns(turns, conv, turn, role, text)
    paths = stage(prefix_paths(*rebuilt_turns(messages, convs)), "paths")
    nodes = stage(
        trie_nodes(paths).selectExpr(
            "*", "CAST(n_children = 0 AS BIGINT) AS n_leaves", "(n_convs - 1) * n_bytes AS saved"
        ),
        "nodes",
    )
    totals = subtree_totals(nodes, paths, ["n_leaves", "saved"], limit)
    found = (
        with_parent_conv(nodes.drop("n_leaves", "saved"))
        .join(totals, "node")
        .join(ends_digests(paths), "node", "left")
    )
    return found.select(
        "conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "n_bytes",
    )


def op13_centroid_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prefix_trie(read_table(spark, sf_dir, "conversations"))
    return found.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )


# The rebuilt paths as lists of digests, and every node's values summed over its ancestors one by one. CRC-32 bit by bit.
TRIE_SQL = f"""
WITH ordered AS (
 SELECT conv_id AS c, coalesce(role, '') AS role, sha256(coalesce(text, '')) AS said, strlen(coalesce(text, '')) AS n_bytes,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS i
 FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
 SELECT c, count(*) AS len, c - c % {FAMILY} AS base, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
   string_split(CAST(c AS VARCHAR), ''), lambda x: [CAST(ord(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)) % {DEEPEST} AS h
 FROM ordered GROUP BY c
), known AS (
 SELECT a.c, a.len, a.base, a.h, least(a.h, coalesce(b.len, 0)) AS m FROM convs a LEFT JOIN convs b ON b.c = a.base
), rebuilt AS (
 SELECT k.c, o.i + 1 AS d, o.role, o.said, o.n_bytes FROM known k JOIN ordered o ON o.c = k.base AND o.i < k.h
 UNION ALL
 SELECT k.c, k.m + o.i - k.h + 1, o.role, o.said, o.n_bytes FROM known k JOIN ordered o ON o.c = k.c AND o.i >= k.h
), paths AS (
 SELECT c, d, n_bytes, string_agg(role || ':' || said, '/') OVER (PARTITION BY c ORDER BY d) AS node,
  coalesce(string_agg(role || ':' || said, '/') OVER (PARTITION BY c ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')
   AS parent FROM rebuilt
 UNION ALL SELECT c, 0, 0, '', NULL FROM known
), ends AS (SELECT c, max(d) AS d FROM paths GROUP BY c
), nodes AS (
 SELECT p.node, p.d, any_value(p.parent) AS parent, any_value(p.n_bytes) AS n_bytes, min(p.c) AS c, count(*) AS n_convs,
  sha256(coalesce(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (WHERE e.d = p.d), '')) AS ends_sha256
 FROM paths p JOIN ends e ON e.c = p.c GROUP BY p.node, p.d
), kin AS (SELECT parent, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY parent, d
), valued AS (
 SELECT n.*, coalesce(k.n_children, 0) AS n_children, (n.n_convs - 1) * n.n_bytes AS saved
 FROM nodes n LEFT JOIN kin k ON k.parent = n.node AND k.d = n.d
), totals AS (
 SELECT a.node, a.d, CAST(count(*) FILTER (WHERE u.n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(u.saved) AS BIGINT) AS saved
 FROM valued u JOIN paths a ON a.c = u.c AND a.d <= u.d GROUP BY a.node, a.d
)
SELECT v.c AS conv_id, CAST(v.d AS BIGINT) AS depth, p.c AS parent_conv_id, v.n_convs, v.n_children, t.n_leaves,
 t.saved AS saved_tokens, v.ends_sha256
FROM valued v JOIN totals t ON t.node = v.node AND t.d = v.d LEFT JOIN nodes p ON p.node = v.parent AND p.d = v.d - 1
"""
