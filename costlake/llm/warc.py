"""WARC archives as seekable Zstandard bundles: independent frames, a footer seek table, an index of record offsets.

``write`` makes a WARC 1.1 record of each page. Of pages with equal payloads of at least ``least`` bytes one is a response,
that of the largest id, and all others are revisits that name it and carry no payload; smaller ones are all responses. A
task packs its records into bundles: records are grouped into frames of about ``frame_bytes``, each compressed by itself;
the last frame maps every record's identifier to (frame, offset within the uncompressed frame, length); behind it
stands the seek table, a skippable frame with the sizes of all frames and a footer. So ``Bundle`` finds a record in any
seekable file by reading the table, the index and one frame, and any zstd tool still unpacks the whole file.

Files are written by Spark's own writer, one bundle to a file, with its commit protocol and to any storage that Spark
knows: the writer is that of text files, whose string is the bundle without its last byte and whose "line end" is
that byte (the footer's magic number ends a bundle). ``read`` gets them as binary files.

Results in special cases: null html is an empty payload. A null id or url has no header and reads as null. Of rows
that are equal in id, url and payload one is the response, the others are revisits of it. Control characters and
spaces in a url are percent-encoded. Pages of any length below 2 GB: a long record has a frame of its own. An
empty table gives no bundles, and no rows when read. Extra columns, also of clashing names, are not read.

At scale: payloads are known by SHA-256. Only one payload of each kind is moved, and copies meet in the map tasks
first. Rows without payloads are counted by (id, url, digest) and paired with their response: the digests of
over a ``HEAVY``-th of all rows, fewer than ``HEAVY``, are broadcast and their rows dealt out anew, so no key
gathers in one task; all others are joined by digest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.llm.frames import arrow_map, partitions, shared_folder, stored, texts

#: Payloads of over a HEAVY-th of all rows each are paired by broadcast; there are fewer than HEAVY of them.
HEAVY = 1000
#: Copies of one row that are dealt out together.
CHUNK = 1000
#: Fixed values of the seekable format: a skippable frame holds the table, which ends with a footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def _urn(name: uuid.UUID) -> str:
    return f"<urn:uuid:{name}>"


def record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """The bytes of a WARC record; headers without a value are left out."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, headers and block of each record in uncompressed bytes."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at) + 4
        headers = dict(line.split(": ", 1) for line in data[at:head - 4].decode().split("\r\n")[1:])
        end = head + int(headers["Content-Length"])
        yield at, end + 4 - at, headers, data[head:end]
        at = end + 4


class _Packer:
    """The frames of one bundle, as records come."""

    def __init__(self, run: uuid.UUID, part: int, number: int, frame_bytes: int, date: str, level: int) -> None:
        self.name = uuid.uuid5(run, f"{part}:{number}")
        self.frame_bytes, self.date = frame_bytes, date
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames, self.sizes, self.index, self.open, self.filled, self.n = [], [], [], [], 0, 0
        self.size = 0
        self.close([record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _urn(self.name)), ("WARC-Date", date),
                            ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")])

    def close(self, parts: list[bytes]) -> None:
        data = b"".join(parts)
        packed = self.zstd.compress(data)
        self.frames.append(packed)
        self.sizes.append((len(packed), len(data)))
        self.size += len(packed)

    def add(self, name: uuid.UUID | None, headers: list, block: bytes) -> None:
        name = name or uuid.uuid5(self.name, str(self.n))
        data = record([("WARC-Record-ID", _urn(name)), ("WARC-Date", self.date), *headers], block)
        self.index.append(f"{name} {len(self.frames)} {self.filled} {len(data)}")
        self.open.append(data)
        self.filled += len(data)
        self.n += 1
        if self.filled >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        if self.open:
            self.close(self.open)
            self.open, self.filled = [], 0

    def done(self) -> bytes:
        self.flush()
        self.close([record([("WARC-Type", "metadata"), ("WARC-Record-ID", _urn(uuid.uuid5(self.name, "index"))),
                            ("WARC-Date", self.date), ("WARC-Refers-To", _urn(self.name)), ("Content-Type", "text/plain")],
                           "\n".join(self.index).encode())])
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join([*self.frames, struct.pack("<II", SKIPPABLE, len(table)), table])


def _pack(run_id: str, frame_bytes: int, bundle_bytes: int, date: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, part, number, packer = uuid.UUID(run_id), TaskContext.get().partitionId(), 0, None

        def bundle() -> pa.RecordBatch:
            # the writer's line end is the last byte
            return pa.RecordBatch.from_arrays([pa.array([packer.done()[:-1]], pa.binary())], names=["bundle"])

        for batch in batches:
            page, url, key, sha1, n_bytes, refers_to = (batch.column(k).to_pylist() for k in range(6))
            for i, payload in enumerate(texts(batch.column(6))):
                packer = packer or _Packer(task, part, number, frame_bytes, date, level)
                revisit = refers_to[i] is not None
                kind = refers_to[i] if revisit else {}
                original = uuid.UUID(bytes=key[i][:16], version=5) if key[i] else None
                target = None if url[i] is None else _uri(url[i])
                packer.add(None if revisit else original, [
                    ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Target-URI", target),
                    ("WARC-Page-ID", None if page[i] is None else quote(page[i], safe="")),
                    ("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha1[i]).decode()),
                    ("WARC-Profile", PROFILE if revisit else None), ("WARC-Refers-To", _urn(original) if revisit else None),
                    ("WARC-Refers-To-Target-URI", _uri(kind["url"]) if kind.get("url") is not None else None),
                    ("WARC-Refers-To-Page-ID", quote(kind["page"], safe="") if kind.get("page") is not None else None),
                    ("Content-Type", "application/http; msgtype=response")], HTTP.format(n_bytes[i]).encode() + payload)
                if packer.size >= bundle_bytes:
                    yield bundle()
                    packer, number = None, number + 1
        if packer:
            yield bundle()

    return run


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _records(pages: DataFrame, least: int, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Page, url, key and SHA-1 of the payload, its bytes, what a revisit refers to, the payload of a response."""
    payload = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    base = pages.select(F.col(f"`{id_col}`").alias("page"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"),
                        F.octet_length(payload).cast("long").alias("n_bytes"))
    own = F.struct("page", "url")
    large = base.where(F.col("n_bytes") >= least).withColumn("key", F.unhex(F.sha2("payload", 256)))
    # equal payloads have equal keys, so any row's payload is that of the group
    first = large.groupBy("key").agg(F.max(own).alias("lead"), F.first("payload").alias("payload"), F.first("n_bytes").alias("n_bytes"))
    nothing = F.lit(None).cast("struct<page:string,url:string>").alias("refers_to")
    sha1 = F.unhex(F.sha1("payload")).alias("sha1")
    text = F.col("page").cast("string").alias("page")
    responses = first.select(F.col("lead.page").cast("string").alias("page"), "lead.url", "key", sha1, "n_bytes", nothing, "payload")
    if least > 0:
        small = base.where(F.col("n_bytes") < least)
        responses = responses.unionAll(small.select(text, "url", F.lit(None).cast("binary").alias("key"), sha1, "n_bytes", nothing, "payload"))

    rows = stored(large.withColumn("sha1", F.unhex(F.sha1("payload"))).groupBy("page", "url", "key", "sha1", "n_bytes").agg(F.count("*").alias("copies")),
                  "pages")
    groups = rows.groupBy("key").agg(F.max(own).alias("lead"), F.sum("copies").alias("n"))
    groups = stored(groups.where(F.col("n") > 1), "copies")
    total = rows.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    heavy = F.broadcast(groups.where(F.col("n") > total / HEAVY))
    light = groups.where(F.col("n") <= total / HEAVY)
    is_lead = F.col("page").eqNullSafe(F.col("lead.page")) & F.col("url").eqNullSafe(F.col("lead.url"))

    def copies(joined: DataFrame) -> DataFrame:
        """Chunks of the copies that are revisits: all but one of the leading row's."""
        joined = joined.withColumn("copies", F.col("copies") - is_lead.cast("long")).where(F.col("copies") > 0)
        return joined.withColumn("chunk", F.explode(F.expr(f"sequence(0L, copies - 1, {CHUNK}L)")))

    of_heavy = copies(rows.join(heavy, "key")).repartition(partitions(pages))
    of_light = copies(rows.join(heavy, "key", "left_anti").join(light, "key"))
    revisits = of_heavy.unionByName(of_light).withColumn("copy", F.explode(F.expr(f"sequence(chunk, least(chunk + {CHUNK - 1}, copies - 1))")))
    lead = F.struct(F.col("lead.page").cast("string").alias("page"), F.col("lead.url").alias("url")).alias("refers_to")
    return responses.unionAll(revisits.select(text, "url", "key", "sha1", "n_bytes", lead, F.lit(None).cast("string").alias("payload")))


def write(pages: DataFrame, least: int = 0, folder: str | None = None, frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 23,
          date: str = "1970-01-01T00:00:00Z", level: int = 3, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """Write all pages as bundles and return their folder, by default a new one in the shared folder.

    ``least``: payloads of fewer bytes are never revisits. ``bundle_bytes``: compressed bytes after which a task
    begins a new bundle.
    """
    run = uuid.uuid4()
    folder = folder or f"{shared_folder(pages.sparkSession)}/warc-{run.hex}"
    rows = _records(pages, least, id_col, url_col, html_col)
    bundles = arrow_map(rows, _pack(str(run), frame_bytes, bundle_bytes, date, level), "bundle binary")
    end = struct.pack("<I", SEEKABLE)[-1:].decode("latin-1")
    (bundles.select(F.col("bundle").cast("string")).write.option("maxRecordsPerFile", 1).option("lineSep", end)
     .option("encoding", "ISO-8859-1").option("compression", "none").text(folder))
    return folder


class Bundle:
    """Records of one bundle in a seekable file, by frame."""

    def __init__(self, file: BinaryIO) -> None:
        self.file = file
        end = file.seek(0, 2)
        file.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", file.read(9))
        each = 12 if flags & 0x80 else 8
        start = end - 9 - n * each - 8
        file.seek(max(0, start))
        table = file.read(8 + n * each)
        if magic != SEEKABLE or start < 0 or struct.unpack_from("<I", table)[0] != SKIPPABLE:
            raise ValueError("not a seekable bundle")
        self.sizes = [struct.unpack_from("<II", table, 8 + k * each) for k in range(n)]
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)

    def frame(self, k: int) -> bytes:
        """The uncompressed bytes of frame k; nothing else of the file is read."""
        self.file.seek(self.starts[k])
        return zstandard.ZstdDecompressor().decompress(self.file.read(self.sizes[k][0]), max_output_size=self.sizes[k][1])

    def index(self) -> dict[str, tuple[int, int, int]]:
        """Frame, offset in it and length of each record, by its identifier."""
        block = next(records(self.frame(len(self.sizes) - 1)))[3].decode()
        return {name: (int(k), int(at), int(length)) for name, k, at, length in (line.split(" ") for line in block.split("\n") if line)}

    def record(self, name: str) -> tuple[dict[str, str], bytes]:
        """Headers and block of the record of an identifier."""
        k, at, length = self.index()[name]
        return next(records(self.frame(k)[at:at + length]))[2:]


READ = ("bundle string, record_id string, frame long, offset long, length long, record_type string, page_id string, url string, "
        "payload_bytes long, payload_digest string, refers_to string, refers_to_record string, intact boolean, payload string")


def _read(payloads: bool, rows: int = 256):
    import io

    schema = pa.schema([("bundle", pa.string()), ("record_id", pa.string()), ("frame", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()),
                        ("record_type", pa.string()), ("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.string()), ("refers_to_record", pa.string()), ("intact", pa.bool_()),
                        ("payload", pa.string())])

    def plain(text: str | None) -> str | None:
        return None if text is None else unquote(text)

    def name(urn: str | None) -> str | None:
        return None if urn is None else urn[10:-1]

    def row(path: str, k: int, at: int, length: int, head: dict, block: bytes) -> tuple:
        kind, body, size, digest, intact = head["WARC-Type"], None, len(block), None, True
        if kind in ("response", "revisit"):
            http, _, body = block.partition(b"\r\n\r\n")
            size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
            digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
            if kind == "response":
                # what is returned is that of the payload as it was read
                found = base64.b32encode(hashlib.sha1(body).digest()).decode()
                intact, digest, size = found == digest and size == len(body), found, len(body)
        return (path, name(head["WARC-Record-ID"]), k, at, length, kind, plain(head.get("WARC-Page-ID")), head.get("WARC-Target-URI"), size, digest,
                plain(head.get("WARC-Refers-To-Page-ID")), name(head.get("WARC-Refers-To")), intact,
                body.decode() if payloads and kind == "response" else None)

    def out(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path, bundle = batch.column(0)[i].as_py(), Bundle(io.BytesIO(batch.column(1)[i].as_buffer()))
                done, size = [], 0
                for k in range(len(bundle.sizes)):
                    for at, length, head, block in records(bundle.frame(k)):
                        done.append(row(path, k, at, length, head, block))
                        size += len(block)
                        if len(done) >= rows or size >= 1 << 22:
                            yield out(done)
                            done, size = [], 0
                if done:
                    yield out(done)

    return run


def read(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """All records of a folder's bundles: where each lies, its type, page, url, payload's bytes and digest, and what it refers to.

    A response's bytes and digest are those of the payload as read, ``intact`` says whether they are the ones
    written; a revisit's are those of the full payload, by its headers. ``payloads``: also the responses' payloads.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return arrow_map(files, _read(payloads), READ)
