"""URL rules looked up in a sorted array of 64-bit digests.

A rule is a host and the start of a path, like `example.net/en/`. Rules are range-partitioned by digest, and each task writes its sorted
run into the shared folder: digests in order, the place of each string, and the strings, to be mapped into memory where they
are. Beside the rules there is such an index of their hosts, with the lengths of the paths that follow each. The driver knows of a run
its first digest and no more; no rule passes through it, and executors read the pages of a run that their probes touch.

Every suffix of a URL's host is looked up among the rules' hosts; those found are joined with the starts of the path that have a
length known for that host, and these keys are looked up among the rules. A look-up is one binary search in each run that digests
of the slice fall to, and a digest that is found counts only if the stored string equals the key. The longest rule wins,
of equally long ones that with the longer host.

Null URLs and those without `://` have an empty host and path and fit no rule. Rules repeated with other verdicts block.
Without a rule the verdict is `allow`. Rows are judged one by one, repeated ones alike. URLs of any length cost their host's dots
and the lengths known for its suffixes. An empty table of pages gives no rows; without rules all are allowed. The input row travels as one
struct, so its columns cannot clash.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fareloom.llm.common import open_file, quoted, read_table, slices, whole_row
from fareloom.sources.storage import scratch_path, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEED = 42  # of Spark's xxhash64
RUN = 1_000_000  # rules of a run
OPEN_RUNS = 64  # runs that a worker keeps mapped

# The rules the query judges by.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


class Run:
    """A run's file: the number of entries, their digests, their places, and the entries, each a key, a tab and a value."""

    def __init__(self, path: str):
        local = re.sub("^file:/*", "/", path)
        if os.path.exists(local):
            raw = np.memmap(local, np.uint8, "r")
        else:
            with open_file(path, "rb") as f:
                raw = np.frombuffer(f.read(), np.uint8)
        n = int(raw[:8].view(np.int64)[0])
        self.digests = raw[8 : 8 + 8 * n].view(np.int64)
        self.places = raw[8 + 8 * n : 16 + 16 * n].view(np.int64)
        self.strings = raw[16 + 16 * n :]

    def probe(self, digests: np.ndarray, keys: list[bytes], which: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(place in `which`, value) of the keys that are there."""
        at = np.searchsorted(self.digests, digests)
        near = np.minimum(at, len(self.digests) - 1)
        for k in np.flatnonzero(self.digests[near] == digests).tolist():
            value = self.value(int(at[k]), keys[which[k]], int(digests[k]))
            if value is not None:
                yield k, value

    def value(self, at: int, key: bytes, digest: int) -> bytes | None:
        """The value stored with a key, looked for among all entries of its digest."""
        while at < len(self.digests) and self.digests[at] == digest:
            found, _, value = self.strings[self.places[at] : self.places[at + 1]].tobytes().rpartition(b"\t")
            if found == key:
                return value
            at += 1
        return None


@lru_cache(maxsize=OPEN_RUNS)
def open_run(path: str) -> Run:
    return Run(path)


class DigestIndex:
    """Runs in order of their digests: (path, first digest) of each."""

    def __init__(self, runs: list[tuple[str, int]]):
        self.paths = [path for path, _ in runs]
        self.firsts = np.array([first for _, first in runs], np.int64)

    def find(self, keys: list[bytes]) -> Iterator[tuple[int, bytes]]:
        """(place in `keys`, value) of the keys that are there."""
        digests = np.fromiter((xxhash.xxh64_intdigest(k, SEED) for k in keys), np.uint64, len(keys)).view(np.int64)
        run_of = np.searchsorted(self.firsts, digests, "right") - 1
        for r in np.unique(run_of).tolist():
            if r >= 0:
                which = np.flatnonzero(run_of == r)
                for k, value in open_run(self.paths[r]).probe(digests[which], keys, which):
                    yield int(which[k]), value


class RuleIndex:
    """The rules, the hosts they are for, and the longest of these."""

    def __init__(self, rules: list[tuple[str, int]], hosts: list[tuple[str, int]], longest_host: int):
        self.rules, self.hosts, self.longest_host = DigestIndex(rules), DigestIndex(hosts), longest_host

    def suffixes(self, host: str) -> Iterator[str]:
        start = max(0, len(host) - self.longest_host)
        if start and host[start - 1] != ".":
            start = host.find(".", start) + 1 or len(host)
        while start < len(host):
            yield host[start:]
            start = host.find(".", start) + 1 or len(host)

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str | None, str | None]]:
        """(rule, verdict) of each URL."""
        named = [(i, suffix) for i, host in enumerate(hosts) for suffix in self.suffixes(host)]
        keys: list[tuple[int, str, int]] = []
        for j, lengths in self.hosts.find([suffix.encode() for _, suffix in named]):
            i, suffix = named[j]
            keys += [(i, suffix + paths[i][:n], len(suffix)) for n in map(int, lengths.split(b",")) if n <= len(paths[i])]
        best: list[tuple[tuple[int, int], str | None, str | None]] = [((-1, -1), None, None)] * len(hosts)
        for j, verdict in self.rules.find([key.encode() for _, key, _ in keys]):
            i, key, size = keys[j]
            rank = (len(key), size)
            if rank > best[i][0]:
                best[i] = (rank, key, verdict.decode())
        return [(rule, verdict) for _, rule, verdict in best]


def run_batches(folder: str, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(digest, entry) in order -> (path, first), a row per run written: of about `most` entries, all of a digest in one."""

    def close(digests: list[int], entries: list[bytes]) -> pa.RecordBatch:
        path = f"{folder}/{uuid.uuid4().hex}.run"
        places = np.cumsum([0, *map(len, entries)], dtype=np.int64)
        with open_file(path, "wb") as f:
            f.write(np.int64(len(digests)).tobytes() + np.array(digests, np.int64).tobytes() + places.tobytes())
            f.write(b"".join(entries))
        return pa.record_batch([pa.array([path]), pa.array([digests[0]], pa.int64())], names=["path", "first"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests: list[int] = []
        entries: list[bytes] = []
        for batch in batches:
            for digest, entry in zip(batch["digest"].to_pylist(), batch["entry"].to_pylist(), strict=True):
                if len(digests) >= most and digest != digests[-1]:
                    yield close(digests, entries)
                    digests, entries = [], []
                digests.append(digest)
                entries.append(entry)
        if digests:
            yield close(digests, entries)

    return run


def write_runs(entries: DataFrame, most: int = RUN) -> list[tuple[str, int]]:
    """(path, first digest) of the runs of (key, value) rows, in order; a row for every `most` of them comes to the driver."""
    folder = scratch_path(entries.sparkSession, "urls")
    entry = F.encode(F.concat("key", F.lit("\t"), "value"), "UTF-8").alias("entry")
    ready = stage(entries.select(F.xxhash64("key").alias("digest"), entry), "digests")
    parts = max(1, -(-ready.count() // most))
    ordered = ready.repartitionByRange(parts, "digest").sortWithinPartitions("digest", "entry")
    written = stage(ordered.mapInArrow(run_batches(folder, most), "path string, first bigint"), "runs")
    return [(r["path"], r["first"]) for r in written.orderBy("first").collect()]


def build_index(rules: DataFrame) -> RuleIndex:
    """The index of (rule, verdict) rows."""
    slash = F.instr("rule", "/")
    host = F.when(slash > 0, F.substring("rule", F.lit(1), slash - 1)).otherwise(F.col("rule"))
    path = F.substring("rule", F.length(host) + 1, F.length("rule"))
    ready = stage(
        rules.where("rule IS NOT NULL AND verdict IS NOT NULL")
        .select(F.translate(host, UPPER, LOWER).alias("host"), path.alias("path"), "verdict")
        .where("host <> ''")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict")),
        "rules",
    )
    lengths = F.array_join(F.sort_array(F.collect_set(F.length("path"))).cast("array<string>"), ",")  # as many as lengths
    longest = ready.agg(F.coalesce(F.max(F.length("host")), F.lit(0)).alias("n")).first()["n"]
    return RuleIndex(
        write_runs(ready.select(F.concat("host", "path").alias("key"), F.col("verdict").alias("value"))),
        write_runs(ready.groupBy(F.col("host").alias("key")).agg(lengths.alias("value"))),
        longest,
    )


def judge_batches(rules: RuleIndex) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = rules.judge(batch["host"].to_pylist(), batch["path"].to_pylist())
            columns = [pa.array([f[i] for f in found], pa.string()) for i in (0, 1)]
            yield pa.record_batch([*batch.columns, *columns], names=["row", "host", "path", "rule", "verdict"])

    return run


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", carry: list[str] | None = None) -> DataFrame:
    """(row, host, path, rule, verdict), one row per page; `row` is the input row or its columns `carry`."""
    host, path = host_and_path(F.col(quoted(url_col)).cast("string"))
    named = pages.select(
        whole_row(pages if carry is None else pages.select(*map(quoted, carry))).alias("row"),
        host.alias("host"),
        path.alias("path"),
    )
    text = [StructField(c, StringType()) for c in ("host", "path", "rule", "verdict")]
    judged = named.mapInArrow(judge_batches(build_index(rules)), StructType([named.schema["row"], *text]))
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit("allow")))


def op4_digest_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    judged = judge_urls(read_table(spark, sf_dir, "pages"), rules, carry=["page_id"])
    return judged.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


URL_SQL = f"""
WITH cut AS (
 SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
 SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut
), rules(rule, rule_host, rule_path, verdict) AS (
 VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), fits AS (
 SELECT page_id, host, path, rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) AS place
 FROM parts JOIN rules ON (host = rule_host OR right(host, length(rule_host) + 1) = '.' || rule_host)
  AND left(path, length(rule_path)) = rule_path
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.place = 1
"""
