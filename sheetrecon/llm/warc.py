"""WARC records in seekable Zstandard bundles (operator 1).

Each task writes bundles: records are grouped into independent Zstandard
frames, and a skippable frame with the public seekable-format seek table ends
the file. A manifest maps each record to its bundle, frame and offset in the
frame. Readers take frames, not files: the seek table gives each its place.

Bundle names hold a random part, and only those that the committed manifest
names are read, so a lost executor or a second attempt leaves nothing wrong.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batched, materialize, scratch

#: Equal payloads of fewer bytes are each stored.
MIN_SHARED = 1000
#: Uncompressed bytes of a frame, compressed bytes of a bundle (both are passed by the last record).
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 256 << 20
#: The frame of the seek table, and the last four bytes of a seekable file.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "bundle string, frame int, frame_at long, frame_bytes long, record string, at long, bytes long"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; a ``file:`` URI may lack its slashes."""
    if path.startswith("file:"):
        path = re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(path)


def record(name: str, url: str | None, kind: str, refers_to: str | None, payload: bytes, digest: str) -> bytes:
    """One WARC record. A revisit holds the HTTP header only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]", " ", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Bundle:
    """A seekable file under way. ``rows`` fills with the manifest."""

    def __init__(self, folder: str):
        self.name = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.zst"
        files, path = opened(self.name)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = files.open_output_stream(path, compression=None)
        self.squeeze = zstandard.ZstdCompressor(level=3)
        self.frames: list[tuple[int, int]] = []
        self.held: list[tuple[str, bytes]] = []
        self.size = self.at = 0
        self.rows: list[tuple] = []

    def add(self, name: str, data: bytes) -> None:
        self.held.append((name, data))
        self.size += len(data)
        if self.size >= FRAME_BYTES:
            self.end_frame()

    def end_frame(self) -> None:
        if not self.held:
            return
        frame = self.squeeze.compress(b"".join([d for _, d in self.held]))
        self.out.write(frame)
        begin = 0
        for name, data in self.held:
            self.rows.append((self.name, len(self.frames), self.at, len(frame), name, begin, len(data)))
            begin += len(data)
        self.frames.append((len(frame), self.size))
        self.at += len(frame)
        self.held, self.size = [], 0

    def close(self) -> list[tuple]:
        self.end_frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()
        return self.rows


def seek_table(path: str) -> list[tuple[int, int, int, int]]:
    """(frame, at, compressed bytes, bytes) of each frame, from the footer."""
    files, name = opened(path)
    with files.open_input_file(name) as f:
        size = f.size()
        f.seek(size - 9)
        n, _, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        f.seek(size - 9 - 8 * n)
        table = f.read(8 * n)
    out, at = [], 0
    for i, (packed, plain) in enumerate(struct.iter_unpack("<II", table)):
        out.append((i, at, packed, plain))
        at += packed
    return out


def read_frame(path: str, at: int, size: int) -> bytes:
    files, name = opened(path)
    with files.open_input_file(name) as f:
        f.seek(at)
        return zstandard.ZstdDecompressor().decompress(f.read(size))


def parse_records(data: bytes):
    """(headers, payload bytes, stated payload length) of each record of a frame."""
    at = 0
    while at < len(data):
        body = data.index(b"\r\n\r\n", at) + 4
        lines = data[at:body - 4].decode().split("\r\n")[1:]
        headers = dict(line.split(": ", 1) for line in lines)
        end = body + int(headers["Content-Length"])
        payload = data.index(b"\r\n\r\n", body, end) + 4
        stated = int(re.search(rb"Content-Length: (\d+)", data[body:payload])[1])
        yield headers, data[payload:end], stated
        at = end + 4


def read_record(path: str, frame_at: int, frame_bytes: int, at: int, size: int):
    """One record by its manifest row: reads its frame only."""
    return next(parse_records(read_frame(path, frame_at, frame_bytes)[at:at + size]))


def judged(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """page_id, url, html, digest, kind, refers_to. The payload of a group is
    joined by its digest; only groups of more than one row are."""
    rows = batched(pages).select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html")).withColumn("digest", F.sha1("html"))
    shared = (rows.where(F.octet_length("html") >= MIN_SHARED).groupBy("digest")
              .agg(F.max("page_id").alias("holder"), F.count("*").alias("n")).where("n > 1").drop("n"))
    revisit = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    return (rows.join(shared, "digest", "left")
            .withColumn("kind", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col("holder"))).drop("holder"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Write the bundles into ``folder`` and return their manifest (a written table)."""
    rows = judged(pages, id_col, url_col, html_col).select(
        F.col("page_id").cast("string").alias("name"), "url", F.col("html").cast("binary").alias("payload"),
        "digest", "kind", F.col("refers_to").cast("string").alias("refers_to"))

    def run(batches):
        bundle = None

        def manifest(done):
            for i in range(0, len(done), 1 << 14):
                yield pa.record_batch(list(map(pa.array, zip(*done[i:i + (1 << 14)]))),
                                      names=[c.split()[0] for c in MANIFEST.split(", ")]).cast(arrow)

        arrow = pa.schema([(c.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[c.split()[1]])
                           for c in MANIFEST.split(", ")])
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256).to_pylist()
                for r in part:
                    bundle = bundle or Bundle(folder)
                    name = "" if r["name"] is None else r["name"]
                    bundle.add(name, record(name, r["url"], r["kind"], r["refers_to"], r["payload"], r["digest"]))
                    if bundle.at >= BUNDLE_BYTES:
                        yield from manifest(bundle.close())
                        bundle = None
        if bundle:
            yield from manifest(bundle.close())

    return materialize(rows.mapInArrow(run, MANIFEST), "warc-manifest")


def read_archives(spark: SparkSession, bundles: DataFrame) -> DataFrame:
    """Bundles (bundle string) -> per record: name, payload_bytes,
    payload_digest, record_type, refers_to. Frames are dealt out evenly; the
    payload of a response must have the stated digest."""
    def frames(batches):
        for batch in batches:
            found = [(path, at, size) for path in batch.column(0).to_pylist()
                     for _, at, size, _ in seek_table(path)]
            if found:
                yield pa.record_batch([pa.array(c) for c in zip(*found)], names=["bundle", "at", "size"])

    def records(batches):
        for batch in batches:
            for row in batch.to_pylist():
                out = []
                for h, payload, stated in parse_records(read_frame(row["bundle"], row["at"], row["size"])):
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    if h["WARC-Type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{h['WARC-Record-ID']}: the payload differs from its digest")
                    refers = h.get("WARC-Refers-To")
                    out.append((h["WARC-Record-ID"][10:-1], stated, digest, h["WARC-Type"], refers and refers[10:-1]))
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                      names=["name", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (bundles.repartition(n).mapInArrow(frames, "bundle string, at long, size long").repartition(n)
            .mapInArrow(records, "name string, payload_bytes long, payload_digest string, "
                                 "record_type string, refers_to string"))


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                       html_col: str = "html", folder: str | None = None) -> DataFrame:
    """Write a record per row of ``pages`` and read the archives back: page_id,
    payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload. Rows that repeat page_id and a payload are
    all the response if that page_id is the largest. Null page_ids revisit the
    largest id of their payload; where there is none, all are responses. Other
    columns are ignored; an empty table writes no bundle.
    """
    spark = pages.sparkSession
    manifest = write_archives(pages, folder or scratch(spark, "warc"), id_col, url_col, html_col)
    kind = pages.schema[id_col].dataType
    back = read_archives(spark, manifest.select("bundle").distinct())
    return back.select(F.when(F.col("name") != "", F.col("name")).cast(kind).alias("page_id"), "payload_bytes",
                       "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
