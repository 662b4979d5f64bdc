"""WARC archives compressed record by record with a Zstandard dictionary of their own.

Each archive is one task's records, up to ROLL bytes. Its dictionary is trained on its own records (on all of them up to 100 times
the dictionary's size, beyond that on every so-manieth) and stands in a skippable frame at the file's start; each record
is a Zstandard frame, so it can be read alone by the place that the index gives. Where so few records come together that no
dictionary can be trained, the archive has none, as the format allows.

Of records with equal payloads of at least MIN_REVISIT bytes the one with the largest id is a response and the others revisit
it; if that id is used twice, both are responses. A null payload is empty. A null id is written without one and
counts as the smallest. Files belong to an archive set only if the index names them, so what a failed task left is never read.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.common import open_file, quoted, read_table
from fareloom.sources.storage import scratch_path, stage

MIN_REVISIT = 1_000
ROLL = 16 << 20
DICTIONARY = 32 << 10
ARCHIVES, MOST_TASKS = 2, 100_000  # archives that a task reads, as long as that makes no more tasks than these
LEVEL = 3
DATE = "2024-06-01T00:00:00Z"  # of every record unless given, so that reruns agree

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: str | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{payload_digest}')}>"


def record(page_id, url, payload: bytes, payload_digest: str, refers_to, date: str) -> bytes:
    """One WARC record. A revisit keeps the HTTP head and leaves out the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id, payload_digest),
        "WARC-Date": date,
        "WARC-Payload-Digest": f"sha1:{payload_digest}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if url is not None:
        head["WARC-Target-URI"] = quote(url, safe="%:/?#[]@!$&'()*+,;=~-._")
    if page_id is not None:
        head["X-Page-Id"] = page_id
    if refers_to is not None:
        head |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(refers_to, payload_digest), "X-Refers-To": refers_to}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def train(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    step = max(1, sum(map(len, records)) // (100 * DICTIONARY))
    try:
        return zstandard.train_dictionary(DICTIONARY, records[::step])
    except zstandard.ZstdError:
        return None


def pack(records: list[bytes]) -> tuple[bytes, list[tuple[int, int]]]:
    """An archive's bytes and each record's (offset, length) in it."""
    dictionary = train(records)
    out, places = bytearray(), []
    if dictionary is not None:
        raw = dictionary.as_bytes()
        out += struct.pack("<II", SKIPPABLE, len(raw)) + raw
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    for r in records:
        frame = compressor.compress(r)
        places.append((len(out), len(frame)))
        out += frame
    return bytes(out), places


def dictionary_of(archive: bytes | memoryview) -> zstandard.ZstdCompressionDict | None:
    if len(archive) >= 8:
        magic, size = struct.unpack("<II", bytes(archive[:8]))
        if magic == SKIPPABLE:
            return zstandard.ZstdCompressionDict(bytes(archive[8 : 8 + size]))
    return None


def records_of(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of each record of an archive."""
    reader = io.BufferedReader(
        zstandard.ZstdDecompressor(dict_data=dictionary_of(archive)).stream_reader(io.BytesIO(archive), read_across_frames=True),
        1 << 20,
    )
    while line := reader.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError("a record does not start where the last one ended")
        head = {}
        while (line := reader.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            head[name] = value.strip()
        block = reader.read(int(head["Content-Length"]))
        if reader.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut off")
        yield head, block


def write_batches(folder: str, date: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, url, payload, digest, refers_to) -> the index rows (archive, at, size) of what is written."""

    def close(records: list[bytes]) -> pa.RecordBatch:
        data, places = pack(records)
        path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        with open_file(path, "wb") as f:
            f.write(data)
        columns = [pa.array([path] * len(places)), *[pa.array(c, pa.int64()) for c in zip(*places, strict=True)]]
        return pa.record_batch(columns, names=["archive", "at", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, held = [], 0
        for batch in batches:
            for values in zip(*batch.columns, strict=True):
                page_id, url, payload, digest, refers_to = (v.as_py() for v in values)
                records.append(record(page_id, url, payload, digest, refers_to, date))
                held += len(records[-1])
                if held >= ROLL:
                    yield close(records)
                    records, held = [], 0
        if records:
            yield close(records)

    return run


def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(archive) -> (id, payload_bytes, payload_digest, record_type, refers_to, intact) of each record."""
    for batch in batches:
        for path in batch["archive"].to_pylist():
            with open_file(path, "rb") as f:
                archive = f.read()
            rows = []
            for head, block in records_of(archive):
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                kind = head["WARC-Type"]
                whole = kind == "revisit" or (len(payload) == size and hashlib.sha1(payload).hexdigest() == digest)
                rows.append((head.get("X-Page-Id"), size, digest, kind, head.get("X-Refers-To"), whole))
            types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                names=["id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"],
            )


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = DATE
) -> DataFrame:
    """Write one record per page into archives in `folder`; the stored index (archive, at, size), a row per record."""
    payload = F.coalesce(F.encode(F.col(quoted(payload_col)).cast("string"), "UTF-8"), F.lit(b""))
    named = pages.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(url_col)).cast("string").alias("url"), payload.alias("payload"))
    digested = named.withColumn("digest", F.sha1("payload")).withColumn(
        "same", F.when(F.octet_length("payload") >= MIN_REVISIT, F.concat(F.sha2("payload", 256), "digest"))
    )
    # Copies merge on the map side; what is left to join are the payloads that occur more than once.
    holders = (
        digested.where("same IS NOT NULL").groupBy("same")
        .agg(F.max("id").alias("holder"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("same", "holder")
    )
    refers_to = F.when(~F.col("id").eqNullSafe(F.col("holder")), F.col("holder").cast("string"))
    ready = digested.join(holders, "same", "left").select(
        F.col("id").cast("string").alias("id"), "url", "payload", "digest", refers_to.alias("refers_to")
    )
    return stage(ready.mapInArrow(write_batches(folder, date), "archive string, at bigint, size bigint"), "warc-index")


def read_archives(index: DataFrame, id_type: str = "bigint") -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to, intact), one row per record of the archives named."""
    named = index.select("archive").distinct()
    # Names are a few bytes each; left to size alone, one task would read all archives.
    tasks = max(1, min(MOST_TASKS, -(-named.count() // ARCHIVES)))
    read = named.repartition(tasks).mapInArrow(
        read_batches,
        "id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, intact boolean",
    )
    return read.withColumns({c: F.col(c).cast(id_type) for c in ("id", "refers_to")})


def op8_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    index = write_archives(pages, scratch_path(spark, "warc"))
    records = read_archives(index, pages.schema["page_id"].dataType.simpleString())
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


WARC_SQL = f"""
WITH payloads AS (
 SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, coalesce(html, '') AS payload FROM pages
), held AS (
 SELECT *, CASE WHEN payload_bytes >= {MIN_REVISIT} THEN max(page_id) OVER (PARTITION BY payload) END AS holder FROM payloads
)
SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
 CASE WHEN holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN holder <> page_id THEN holder END AS refers_to, TRUE AS intact
FROM held
"""
