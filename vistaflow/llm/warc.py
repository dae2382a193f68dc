"""WARC archives as seekable Zstandard bundles."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType,
)

from vistaflow.llm.arrow_text import record_batch, slices
from vistaflow.llm.spread import salted_left_join
from vistaflow.session import staged

REVISIT_BYTES = 1000
FRAME_BYTES = 1 << 20  # records of a frame, before compression
BUNDLE_BYTES = 16 << 20  # frames of a bundle, after compression
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

ENTRY = StructType([StructField("record_id", StringType()), StructField("frame", IntegerType()),
                    StructField("offset", IntegerType()), StructField("length", IntegerType())])
BUNDLE = StructType([StructField("bundle", StringType()), StructField("content", BinaryType()),
                     StructField("records", ArrayType(ENTRY))])
RECORD = StructType([
    StructField("record_id", StringType()), StructField("url", StringType()),
    StructField("payload_bytes", LongType()), StructField("payload_digest", StringType()),
    StructField("record_type", StringType()), StructField("refers_to", StringType()),
    StructField("payload", BinaryType()),
])


def record(record_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None,
           date: str = DATE) -> bytes:
    """One WARC record; a revisit has the payload's HTTP header only."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
    body = block.encode() + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}",
    ]
    if url is not None:
        lines.insert(4, "WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join([*lines, "", ""]).encode() + body + b"\r\n\r\n"


HEADER = re.compile(rb"([A-Za-z-]+):[ \t]*([^\r\n]*)\r\n")


def parse(data: memoryview | bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at an offset, and where the next one begins."""
    data = bytes(data) if at == 0 and not isinstance(data, bytes) else data
    stop = data.find(b"\r\n\r\n", at)
    if not data.startswith(b"WARC/1.", at) or stop < 0:
        raise ValueError(f"no record at offset {at}")
    headers = {k.decode().lower(): v.decode() for k, v in HEADER.findall(data, at, stop + 2)}
    begin = stop + 4
    end = begin + int(headers["content-length"])
    return headers, data[begin:end], end + 4


class Bundler:
    """Collects records into frames and frames into bundles."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES):
        import zstandard

        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frame_bytes, self.bundle_bytes = frame_bytes, bundle_bytes
        self._clear()

    def _clear(self):
        self.frames, self.sizes, self.entries = [], [], []
        self.open, self.open_size, self.total = [], 0, 0

    def add(self, record_id: str, data: bytes):
        self.entries.append((record_id, len(self.frames), self.open_size, len(data)))
        self.open.append(data)
        self.open_size += len(data)
        if self.open_size >= self.frame_bytes:
            self._close_frame()

    def _close_frame(self):
        if self.open:
            packed = self.compressor.compress(b"".join(self.open))
            self.frames.append(packed)
            self.sizes.append((len(packed), self.open_size))
            self.total += len(packed)
            self.open, self.open_size = [], 0

    def take(self, force: bool = False):
        """A finished bundle and its index, if one is full (or anything is left, with force)."""
        if force:
            self._close_frame()
        if not self.frames or not (force or self.total >= self.bundle_bytes):
            return None
        self._close_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        table += struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        footer = struct.pack("<II", SKIPPABLE, len(table)) + table
        done = b"".join(self.frames) + footer, self.entries
        self._clear()
        return done


def seek_table(content: bytes) -> list[tuple[int, int, int]]:
    """Offset, packed and plain size of each frame, from the footer."""
    count, flags, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE or flags:
        raise ValueError("no seek table")
    begin = len(content) - 9 - 8 * count
    rows, at = [], 0
    for packed, plain in struct.iter_unpack("<II", content[begin:-9]):
        rows.append((at, packed, plain))
        at += packed
    return rows


def read_frame(content: bytes, frame: int) -> bytes:
    """One frame alone; nothing before it is decompressed."""
    import zstandard

    at, packed, plain = seek_table(content)[frame]
    return zstandard.ZstdDecompressor().decompress(content[at : at + packed], max_output_size=plain)


def facts(headers: dict[str, str], block: bytes) -> dict:
    """What a record says; a response's size and digest are taken from its payload."""
    head, _, payload = block.partition(b"\r\n\r\n")
    name = headers["warc-record-id"][1:-1]
    row = {"record_id": name, "url": headers.get("warc-target-uri"), "record_type": headers["warc-type"]}
    if row["record_type"] == "response":
        return row | {"payload": payload, "payload_bytes": len(payload), "refers_to": None,
                      "payload_digest": hashlib.sha1(payload).hexdigest()}
    inner = {k.decode().lower(): v.decode() for k, v in HEADER.findall(head + b"\r\n")}
    return row | {"payload": None, "payload_bytes": int(inner["content-length"]),
                  "payload_digest": headers["warc-payload-digest"].partition(":")[2],
                  "refers_to": headers["warc-refers-to"][1:-1]}


def records_of(content: bytes) -> Iterator[dict]:
    """All records of a bundle, a frame at a time."""
    for frame in range(len(seek_table(content))):
        data, at = read_frame(content, frame), 0
        while at < len(data):
            headers, block, at = parse(data, at)
            yield facts(headers, block)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", frame_bytes: int = FRAME_BYTES,
            bundle_bytes: int = BUNDLE_BYTES, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Bundles with one WARC record per row: bundle (name), content, records (index).

    Of records with equal payloads of at least ``revisit_bytes``, the one with the largest id
    is the response and the others revisit it; equal means equal SHA-256, SHA-1 and length.
    Digests alone are grouped, in map tasks first, and the few groups of more than one come
    back by id, so payloads are moved once at most and never gathered by key. A bundle is a
    complete seekable Zstandard file: independent frames of whole records, then a seek table.
    ``records`` gives each record's frame and its place in it.

    Null html counts as empty. Null ids are written as ``urn:page:`` and are responses.
    Rows that repeat the id of a response are responses too. An empty table gives no bundle.
    Other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    html = F.coalesce(F.col(html_col), F.lit(""))
    slim = pages.select(F.col(id_col).alias("_id"), F.octet_length(html).alias("_bytes"),
                        F.sha2(html, 256).alias("_sha"), F.sha1(F.encode(html, "UTF-8")).alias("_sha1"))
    slim = slim.filter((F.col("_bytes") >= revisit_bytes) & F.col("_id").isNotNull())
    keys = ["_sha", "_sha1", "_bytes"]
    groups = slim.groupBy(*keys).agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    groups = groups.filter("_n > 1").drop("_n")
    revisits = (
        salted_left_join(slim, groups, keys, F.col("_id"))
        .filter("_keep <> _id").select("_id", "_sha", "_keep").distinct()
    )
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("url"), html.alias("html"),
                        F.sha2(html, 256).alias("_sha"))
    rows = rows.join(revisits, ["_id", "_sha"], "left").select(
        F.concat(F.lit("urn:page:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))).alias("id"),
        "url", "html", F.concat(F.lit("urn:page:"), F.col("_keep").cast("string")).alias("refers_to"))
    out = to_arrow_schema(BUNDLE)
    entry = pa.struct([(f.name, f.type) for f in to_arrow_schema(ENTRY)])

    def pack(content: bytes, entries: list) -> pa.RecordBatch:
        name = hashlib.sha256(content).hexdigest()[:32] + ".warc.zst"
        index = [dict(zip(("record_id", "frame", "offset", "length"), e)) for e in entries]
        return record_batch({
            "bundle": [name], "content": [content],
            "records": pa.array([index], pa.list_(entry)).cast(out.field("records").type)}, out)

    def write(batches):
        bundler = Bundler(frame_bytes, bundle_bytes)
        for batch in slices(batches, "html"):
            for row in batch.to_pylist():
                payload = row["html"].encode("utf-8")
                digest = hashlib.sha1(payload).hexdigest()
                bundler.add(row["id"], record(row["id"], row["url"], payload, digest, row["refers_to"]))
                done = bundler.take()
                if done:
                    yield pack(*done)
        done = bundler.take(force=True)
        if done:
            yield pack(*done)

    return rows.mapInArrow(write, BUNDLE)


def read_archive(bundles: DataFrame, payloads: bool = True, content: str = "content") -> DataFrame:
    """All records of bundles (a column of bytes): id, url, size, digest, type, refers_to.

    With ``payloads`` also the payload of responses. Works on ``archive``'s table and on
    files read with ``spark.read.format("binaryFile")``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = RECORD if payloads else StructType(RECORD.fields[:-1])
    out = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for value in batch.column(0):
                rows: list[dict] = []
                for row in records_of(value.as_py()):
                    rows.append(row)
                    if len(rows) >= 500:
                        yield record_batch({f.name: [r[f.name] for r in rows] for f in out}, out)
                        rows = []
                if rows:
                    yield record_batch({f.name: [r[f.name] for r in rows] for f in out}, out)

    return bundles.select(content).mapInArrow(run, schema)


def fetch(bundles: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The records with the ids of a table (record_id): one frame is read for each."""
    from pyspark.sql.pandas.types import to_arrow_schema

    places = bundles.select("bundle", F.explode("records").alias("r")).select("bundle", "r.*")
    wanted = places.join(record_ids.select("record_id").distinct(), "record_id")
    out = to_arrow_schema(RECORD)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                headers, block, _ = parse(read_frame(row["content"], row["frame"]), row["offset"])
                found = facts(headers, block)
                yield record_batch({f.name: [found[f.name]] for f in out}, out)

    return (
        wanted.select("bundle", "frame", "offset").join(bundles.select("bundle", "content"), "bundle")
        .select("content", "frame", "offset").mapInArrow(run, RECORD)
    )


def export_files(bundles: DataFrame, folder: str) -> None:
    """Write every bundle as a file of a shared folder (a URI that pyarrow can open).

    A file appears under its name, a hash of its content, only when it is whole, so a task
    that runs again writes the same file.
    """
    def save(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                part = f"{base}/_{row['bundle']}"
                with store.open_output_stream(part, compression=None) as stream:
                    stream.write(row["content"])
                store.move(part, f"{base}/{row['bundle']}")
            yield batch.select(["bundle"])

    names = bundles.select("bundle", "content").mapInArrow(save, "bundle string")
    names.write.format("noop").mode("overwrite").save()


def archived_pages(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Write all pages as bundles in the shared folder, read them back, one row per page."""
    bundles = staged(archive(pages, id_col), "bundles")
    prefix = len("urn:page:") + 1
    kind = pages.schema[id_col].dataType

    def number(column: str):
        return F.expr(f"nullif(substring({column}, {prefix}), '')").cast(kind)

    return read_archive(bundles, payloads=False).select(
        number("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"))


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     k AS (SELECT *, octet_length(encode(html)) AS payload_bytes,
                  max(page_id) OVER (PARTITION BY html) AS keep FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN keep END AS refers_to
FROM k
"""
