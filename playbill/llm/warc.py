"""WARC archives in seekable Zstandard bundles: write, index, read back, fetch one record.

A bundle is a sequence of independent Zstandard frames, each of whole WARC records, and then a
seek table in a skippable frame: the frames' compressed and decompressed sizes and a footer, as
in the public seekable format. The index maps a record to its bundle, frame and the offset in
the decompressed frame, so one record costs one seek and one frame.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.storage import scratch

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<II")
HEAD = struct.Struct("<II")

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Decompressed bytes after which a frame is closed, and compressed bytes after which a bundle is.
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit has no payload, only its length and digest."""
    clean = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if clean:
        head.append(f"WARC-Target-URI: {clean}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if refers_to is None else b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, payload) of each record of a decompressed frame from `at` on."""
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"no WARC record at {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        begin, size = end + 4, int(headers["Content-Length"])
        block = data[begin : begin + size]
        yield at, headers, block[block.index(b"\r\n\r\n") + 4 :]
        at = begin + size + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    body = b"".join(ENTRY.pack(*f) for f in frames) + FOOTER.pack(len(frames), 0, SEEKABLE_MAGIC)
    return HEAD.pack(SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of each frame of an open bundle."""
    size = file.size()
    file.seek(size - FOOTER.size)
    n, flags, magic = FOOTER.unpack(file.read(FOOTER.size))
    if magic != SEEKABLE_MAGIC or flags & 0x80:
        raise ValueError("no seek table")
    file.seek(size - FOOTER.size - n * ENTRY.size)
    found, at = [], 0
    for packed, plain in ENTRY.iter_unpack(file.read(n * ENTRY.size)):
        found.append((at, packed, plain))
        at += packed
    return found


def read_frame(file: pa.NativeFile, frame: tuple[int, int, int]) -> bytes:
    offset, packed, plain = frame
    file.seek(offset)
    return zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=plain)


class _Bundle:
    """One open bundle file; its index rows are valid once it is closed."""

    def __init__(self, root: str, level: int) -> None:
        fs, base = pafs.FileSystem.from_uri(root)
        fs.create_dir(base, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.file = fs.open_output_stream(f"{base}/{self.name}", compression=None)
        self.packer = zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.plain = self.packed = 0
        self.rows: list[tuple[int | None, str, int, int, int]] = []

    def add(self, page_id: int | None, data: bytes) -> None:
        self.rows.append((page_id, self.name, len(self.frames), self.plain, len(data)))
        self.open.append(data)
        self.plain += len(data)
        if self.plain >= FRAME_BYTES:
            self.end_frame()

    def end_frame(self) -> None:
        if self.open:
            frame = self.packer.compress(b"".join(self.open))
            self.file.write(frame)
            self.frames.append((len(frame), self.plain))
            self.packed += len(frame)
            self.open, self.plain = [], 0

    def close(self) -> pa.RecordBatch:
        self.end_frame()
        self.file.write(seek_table(self.frames))
        self.file.close()
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*self.rows, strict=True)], schema=INDEX)


INDEX = pa.schema([("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("frame_offset", pa.int64()), ("record_bytes", pa.int64())])


def _writer(root: str, level: int):
    def run(batches):
        bundle = None
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                bundle = bundle or _Bundle(root, level)
                bundle.add(page_id, record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), digest, refers_to))
                if bundle.packed >= BUNDLE_BYTES:
                    yield bundle.close()
                    bundle = None
        if bundle:
            yield bundle.close()

    return run


def write_archive(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 1000, level: int = 3) -> DataFrame:
    """Write bundles under root (any URI of a file system that driver and executors share).

    Returns the index (page_id, bundle, frame, frame_offset, record_bytes), already written beside
    them. Null html is empty. Of rows with equal payloads of at least least_bytes bytes, those with
    the largest id are responses and the others revisit it; shorter payloads are all responses. A
    null id is smaller than any other; a group whose ids are all null is all responses. Rows
    repeated with the largest id are all responses.

    Each task writes files of its own under fresh names and returns their index rows; the index
    is stored before it is used, so files of a task that was lost or ran twice are never named.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode(F.coalesce("html", F.lit("")), "utf-8")))
    sizes = rows.where(F.octet_length("html") >= least_bytes).groupBy("digest")
    again = sizes.agg(F.max("page_id").alias("target"), F.count("*").alias("n")).where("n > 1 and target is not null").select("digest", "target")
    marked = rows.join(again, "digest", "left").select("page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("target")), F.col("target")).alias("refers_to"))
    index = marked.mapInArrow(_writer(f"{root.rstrip('/')}/bundles", level), "page_id long, bundle string, frame int, frame_offset long, record_bytes long")
    index.write.parquet(f"{root.rstrip('/')}/index")
    return pages.sparkSession.read.parquet(f"{root.rstrip('/')}/index")


def _number(urn: str | None) -> int | None:
    value = (urn or "null").strip("<>").rpartition(":")[2]
    return None if value == "null" else int(value)


RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _as_row(headers: dict[str, str], payload: bytes, with_payload: bool) -> tuple:
    kind = headers["WARC-Type"]
    said = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if digest != said:
            raise ValueError(f"payload of {headers['WARC-Record-ID']} doesn't match its digest")
    else:
        size, digest = int(headers["X-Payload-Length"]), said
    return _number(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), payload if with_payload and kind == "response" else None, size, digest, kind, _number(headers.get("WARC-Refers-To"))


def _reader(root: str, with_payload: bool):
    def run(batches):
        fs, base = pafs.FileSystem.from_uri(root)
        for batch in batches:
            for bundle, frame in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with fs.open_input_file(f"{base}/{bundle}") as file:
                    data = read_frame(file, read_seek_table(file)[frame])
                rows = [_as_row(h, p, with_payload) for _, h, p in parse(data)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RECORDS, strict=True)], schema=RECORDS)

    return run


def read_archive(spark, root: str, with_payload: bool = True) -> DataFrame:
    """Every record of the bundles that the index under root names, frame by frame in parallel."""
    root = root.rstrip("/")
    frames = spark.read.parquet(f"{root}/index").select("bundle", "frame").distinct()
    return frames.mapInArrow(_reader(f"{root}/bundles", with_payload), "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")


def fetch(spark, root: str, page_id: int) -> list[tuple[dict[str, str], bytes]]:
    """Headers and payload of the records of one id: one index look-up, one frame each."""
    root = root.rstrip("/")
    fs, base = pafs.FileSystem.from_uri(f"{root}/bundles")
    found = []
    for row in spark.read.parquet(f"{root}/index").where(F.col("page_id") == page_id).toLocalIterator():
        with fs.open_input_file(f"{base}/{row.bundle}") as file:
            data = read_frame(file, read_seek_table(file)[row.frame])
        found.append(next((h, p) for _, h, p in parse(data, row.frame_offset)))
    return found


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back from the bundles."""
    root = scratch(spark, "warc")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), root)
    return read_archive(spark, root, with_payload=False).drop("url", "payload")


OP9_SQL = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
g as (select payload_digest as d, max(page_id) as target from p where payload_bytes >= 1000 group by 1)
select page_id, payload_bytes, payload_digest,
       case when target is null or page_id = target then 'response' else 'revisit' end as record_type,
       case when page_id <> target then target end as refers_to
from p left join g on payload_digest = d
"""
