"""WARC records in seekable Zstandard bundles, written and read by Spark tasks.

A bundle is a file of independent Zstandard frames, each of whole WARC records, and ends in the
public seekable-format footer: a skippable frame with the compressed and plain size of every frame.
Any Zstandard tool can unpack it in full; with the footer a reader reaches one frame alone. The
manifest, a table, maps each record to its bundle, its frame and its place in the plain frame.

Tasks write bundles under names of their own and report them in the manifest, which Spark commits.
A lost or repeated task leaves a file that no manifest names. Bundles go to any file system that
pyarrow can open by URI; the folder has to be one all executors share.

Nulls and edges: a null payload is empty, a null identifier gives a record without one that neither
refers nor is referred to, a null address leaves its header out; repeated identifiers with equal
payloads are all responses. A long payload has a frame of its own. An empty table gives no bundle
and no rows. Extra columns are not stored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import settled, table
from kerbside.session import scratch_dir

FRAME_BYTES = 1 << 17
BUNDLE_BYTES = 1 << 25
LEVEL = 3
LEAST_REVISIT = 1000  # bytes from which an equal payload is stored once

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
SEEK_ENTRY, SEEK_ENTRY_BYTES = "<II", 8
SEEK_TAIL, SEEK_TAIL_BYTES = "<IBI", 9

URN = "urn:kerbside:page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FETCHED = "1970-01-01T00:00:00Z"
MANIFEST = (
    "record_id string, bundle string, frame_at long, frame_bytes long, record_at long, record_bytes long"
)


def _line_safe(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def encode_record(
    record_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None
) -> bytes:
    """A response record, or a revisit record where ``refers_to`` names the response."""
    head = [
        "HTTP/1.1 200 OK",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(payload)}",
        "",
        "",
    ]
    http = "\r\n".join(head).encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{URN}{'' if record_id is None else record_id}>",
        f"WARC-Date: {FETCHED}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_line_safe(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{URN}{refers_to}>"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def decode_records(data: bytes) -> Iterator[dict]:
    """Records of a plain frame: record_id, url, payload (null for a revisit), payload_bytes,
    payload_digest, record_type, refers_to. The digest of a response is that of what was read."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        fields = dict(x.split(": ", 1) for x in data[at:end].decode().split("\r\n")[1:])
        start = end + 4
        block = data[start : start + int(fields["Content-Length"])]
        at = start + len(block) + 4
        head, _, payload = block.partition(b"\r\n\r\n")
        revisit = fields["WARC-Type"] == "revisit"
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        stored = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        digest = stored if revisit else hashlib.sha1(payload).hexdigest()
        if digest != stored or not revisit and length != len(payload):
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        refers = fields.get("WARC-Refers-To")
        yield {
            "record_id": fields["WARC-Record-ID"][len(URN) + 1 : -1] or None,
            "url": fields.get("WARC-Target-URI"),
            "payload": None if revisit else payload,
            "payload_bytes": length,
            "payload_digest": digest,
            "record_type": fields["WARC-Type"],
            "refers_to": refers and refers[len(URN) + 1 : -1],
        }


class BundleWriter:
    """Collects records into frames and frames into one file; ``rows`` are its manifest."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/bundle-{uuid.uuid4().hex}.warc.zst"
        system, path = pafs.FileSystem.from_uri(self.uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(path, compression=None)
        self.pack = zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[tuple[int, int]] = []
        self.at, self.plain, self.held, self.rows = 0, 0, [], []

    def add(self, record_id: str | None, record: bytes) -> None:
        self.held.append((record_id, self.plain, record))
        self.plain += len(record)
        if self.plain >= FRAME_BYTES:
            self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        frame = self.pack.compress(b"".join(r for _, _, r in self.held))
        self.out.write(frame)
        self.rows += [(i, self.uri, self.at, len(frame), at, len(r)) for i, at, r in self.held]
        self.frames.append((len(frame), self.plain))
        self.at, self.plain, self.held = self.at + len(frame), 0, []

    def close(self) -> list[tuple]:
        self.flush()
        table_bytes = b"".join(struct.pack(SEEK_ENTRY, *f) for f in self.frames)
        tail = struct.pack(SEEK_TAIL, len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table_bytes) + len(tail)))
        self.out.write(table_bytes + tail)
        self.out.close()
        return self.rows


def seek_table(file, size: int) -> list[tuple[int, int]]:
    """(offset, compressed bytes) of each frame, from the footer."""
    file.seek(size - SEEK_TAIL_BYTES)
    n, _, magic = struct.unpack(SEEK_TAIL, file.read(SEEK_TAIL_BYTES))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end")
    file.seek(size - SEEK_TAIL_BYTES - n * SEEK_ENTRY_BYTES)
    sizes = [s for s, _ in struct.iter_unpack(SEEK_ENTRY, file.read(n * SEEK_ENTRY_BYTES))]
    return [(sum_, s) for sum_, s in zip(_running(sizes), sizes)]


def _running(sizes: Iterable[int]) -> Iterator[int]:
    at = 0
    for s in sizes:
        yield at
        at += s


def mark_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Pages with ``payload_digest`` and ``refers_to``, null for a response.

    Digests are grouped without the payloads; a payload with very many copies is one row there.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digested = pages.select("page_id", "url", "html", F.sha1(payload).alias("payload_digest"))
    narrow = settled(
        digested.filter(F.octet_length("html") >= least).select("page_id", "payload_digest"), "digests"
    )
    firsts = (
        narrow.groupBy("payload_digest")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("payload_digest", "refers_to")
    )
    revisits = narrow.join(firsts, "payload_digest").filter("page_id < refers_to").distinct()
    return digested.join(revisits, ["page_id", "payload_digest"], "left")


def write_bundles(marked: DataFrame, folder: str) -> DataFrame:
    """Write the marked pages as bundles under ``folder`` and return the manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        names = [f.split()[0] for f in MANIFEST.split(", ")]

        def told(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.string(), *[pa.int64()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for record_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                writer = writer or BundleWriter(folder)
                writer.add(record_id, encode_record(record_id, url, html or b"", digest, refers_to))
                if writer.at >= BUNDLE_BYTES:
                    yield told(writer.close())
                    writer = None
        if writer:
            yield told(writer.close())

    fields = marked.select(
        F.col("page_id").cast("string"),
        "url",
        F.col("html").cast("binary"),
        "payload_digest",
        F.col("refers_to").cast("string"),
    )
    return settled(fields.mapInArrow(run, MANIFEST), "warc-manifest")


RECORD = (
    "record_id string, url string, payload_bytes long, payload_digest string, record_type string,"
    " refers_to string"
)


def read_bundles(manifest: DataFrame, payload: bool = False) -> DataFrame:
    """All records of the manifest's bundles, frame by frame by the seek tables."""
    schema = RECORD + (", payload binary" if payload else "")
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = pafs.FileSystem.from_uri(uri)
                with system.open_input_file(path) as file:
                    for at, n in seek_table(file, file.size()):
                        file.seek(at)
                        rows = list(decode_records(unpack.decompress(file.read(n))))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r[x] for r in rows], kinds.get(x, pa.string())) for x in names], names
                        )

    # Few rows stand for much work. Dealt in turn to a number of tasks given, they are not gathered again
    # by size, and no earlier exchange passes for this one, as it may by key.
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bundles = manifest.select("bundle").distinct().repartition(tasks)
    return bundles.mapInArrow(run, schema)


def read_records(entries: DataFrame) -> DataFrame:
    """Single records by manifest rows: one seek, one frame and one slice each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for r in rows:
                system, path = pafs.FileSystem.from_uri(r["bundle"])
                with system.open_input_file(path) as file:
                    file.seek(r["frame_at"])
                    plain = unpack.decompress(file.read(r["frame_bytes"]))
                out.append(plain[r["record_at"] : r["record_at"] + r["record_bytes"]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["record_id"] for r in rows], pa.string()), pa.array(out, pa.binary())],
                ["record_id", "record"],
            )

    return entries.mapInArrow(run, "record_id string, record binary")


def as_uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC bundles and read back."""
    pages = table(spark, sf_dir, "pages")
    folder = as_uri(scratch_dir(spark, "warc"))
    manifest = write_bundles(mark_revisits(pages), folder)
    page_id = pages.schema["page_id"].dataType
    return read_bundles(manifest).select(
        F.col("record_id").cast(page_id).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(page_id).alias("refers_to"),
    )
