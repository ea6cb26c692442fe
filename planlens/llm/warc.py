"""WARC 1.1 archives: one gzip member per record, written and read one record at a time.

A record's payload may be stored once: later records of an equal payload are revisits,
which name the record that has it. The reader inflates member by member in small pieces, cuts
blocks by their Content-Length, and checks block and payload digests while they stream by; it
goes on with the next member after a damaged one.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planlens.llm import bloom
from planlens.session import settle, shared_folder

REVISIT_BYTES = 1000  # equal payloads of at least so many bytes are stored once
ARCHIVE_BYTES = 128 << 20  # a new archive is begun after so many
PIECE = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# -- one record ----------------------------------------------------------------


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _hex(digest: str | None) -> str | None:
    """``sha1:`` and base 32 or hexadecimal, to lower-case hexadecimal."""
    value = (digest or "").partition(":")[2].strip()
    if re.fullmatch("[0-9a-fA-F]{40}", value):
        return value.lower()
    try:
        return base64.b32decode(value.upper()).hex() if value else None
    except ValueError:
        return None


def record_id(page_id: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _line(value: str) -> str:
    """A header value on one line; line ends in it are escaped."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(
    page_id: str | None, url: str | None, payload: bytes, digest: str, date: str,
    refers_to: str | None = None, revisit: bool = False,
) -> bytes:
    """A response record, or a revisit of the record of page ``refers_to``, as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"WARC-Block-Digest: {_sha1(block)}", "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if page_id is not None:
        head.append(f"WARC-Page-ID: {_line(page_id)}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
        if refers_to is not None:
            head.append(f"WARC-Refers-To-Page-ID: {_line(refers_to)}")
    head.append(f"Content-Length: {len(block)}")
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return deflate.compress(whole) + deflate.flush()


class _Record:
    """Takes a record's inflated bytes as they come."""

    def __init__(self, keep_payload: bool) -> None:
        self.head: dict[str, str] | None = None
        self.buffer = bytearray()
        self.left = 0
        self.http: dict[str, str] | None = None
        self.block_sha, self.payload_sha = hashlib.sha1(), hashlib.sha1()
        self.payload_bytes = 0
        self.payload = bytearray() if keep_payload else None
        self.after = b""

    @staticmethod
    def _fields(lines: bytes) -> dict[str, str]:
        out = {}
        for line in lines.decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            out[name.strip().lower()] = value.strip()
        return out

    def feed(self, data: bytes) -> None:
        if self.head is None:
            self.buffer += data
            end = self.buffer.find(b"\r\n\r\n")
            if end < 0:
                return
            self.head = self._fields(bytes(self.buffer[:end]))
            self.left = int(self.head["content-length"])
            data = bytes(self.buffer[end + 4:])
            self.buffer.clear()
        block, data = data[:self.left], data[self.left:]
        self.left -= len(block)
        self.after += data
        self.block_sha.update(block)
        if self.http is None:
            self.buffer += block
            end = self.buffer.find(b"\r\n\r\n")
            if end < 0:
                return
            self.http = self._fields(bytes(self.buffer[:end]))
            block = bytes(self.buffer[end + 4:])
            self.buffer.clear()
        self.payload_sha.update(block)
        self.payload_bytes += len(block)
        if self.payload is not None:
            self.payload += block

    def row(self) -> dict:
        if self.head is None:
            raise ValueError("no record header")
        if self.left or self.after != b"\r\n\r\n":
            raise ValueError("block and Content-Length differ")
        head, http = self.head, self.http or {}
        kind, digest = head.get("warc-type"), _hex(head.get("warc-payload-digest"))
        block = _hex(head.get("warc-block-digest"))
        if block and block != self.block_sha.hexdigest():
            raise ValueError("block digest differs")
        stored = kind != "revisit"
        if stored and digest and digest != self.payload_sha.hexdigest():
            raise ValueError("payload digest differs")
        return {
            "record_id": head.get("warc-record-id"), "record_type": kind,
            "page_id": head.get("warc-page-id"), "url": head.get("warc-target-uri"),
            "date": head.get("warc-date"),
            "payload_bytes": self.payload_bytes if stored else int(http.get("content-length", 0)),
            "payload_digest": self.payload_sha.hexdigest() if stored else digest,
            "refers_to": head.get("warc-refers-to-page-id"),
            "refers_to_record": head.get("warc-refers-to"),
            "payload": bytes(self.payload) if stored and self.payload is not None else None,
            "error": None,
        }


def records(stream, keep_payload: bool = True) -> Iterator[dict]:
    """The records of an open archive, in order. A damaged one gives a row with its
    ``error`` alone. Held at once are a piece of the file and, if kept, one payload."""
    raw = b""
    while True:
        if not raw:
            raw = stream.read(PIECE)
            if not raw:
                return
        inflate, taken = zlib.decompressobj(31), _Record(keep_payload)
        begun = True  # the piece at hand starts with this member
        try:
            while True:
                pending = raw
                while not inflate.eof:
                    data = inflate.decompress(pending, PIECE)
                    taken.feed(data)
                    pending = inflate.unconsumed_tail
                    if not data and not pending:  # neither input nor held-back output is left
                        break
                if inflate.eof:
                    raw = inflate.unused_data
                    break
                raw, begun = stream.read(PIECE), False
                if not raw:
                    raise ValueError("archive ends within a record")
            row = taken.row()
        except (zlib.error, ValueError, KeyError) as problem:
            row = {"error": str(problem)}
            if inflate.eof:
                raw = inflate.unused_data
            else:  # look for the next member behind this one's first byte
                raw = _next_member(raw[1:] if begun else raw, stream)
        yield row


def _next_member(raw: bytes, stream) -> bytes:
    while True:
        at = raw.find(b"\x1f\x8b\x08")
        if at >= 0:
            return raw[at:]
        more = stream.read(PIECE)
        if not more:
            return b""
        raw = raw[-2:] + more


# -- archives on Spark -----------------------------------------------------------


def open_folder(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder that every executor reaches, and the path in it."""
    uri = re.sub(r"^s3[an]:", "s3:", uri)
    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    return pyarrow.fs.FileSystem.from_uri(uri)


def with_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, revisit, refers_to) of (page_id, url, html).

    Of equal payloads of ``least`` bytes or more the largest page_id has the response; a null
    id comes before all others, and rows that share the largest are all responses. Null html
    is the empty payload. Only pages whose payload may be a repeated one are moved.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    repeated = settle(
        rows.where(F.length("payload") >= least).groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("refers_to"))
        .where("n > 1").select("digest", "refers_to")
    )
    split = bloom.marked(rows, F.col("digest"), repeated.select("digest"), "_maybe")
    plain = split.where(~F.col("_maybe"))
    again = split.where("_maybe").join(repeated, "digest", "left")
    revisit = (F.length("payload") >= least) & F.col("refers_to").isNotNull() & ~F.col(
        "page_id").eqNullSafe(F.col("refers_to"))
    columns = ["page_id", "url", "payload", "digest"]
    return plain.select(
        *columns, F.lit(False).alias("revisit"), F.lit(None).cast(pages.schema["page_id"].dataType).alias("refers_to")
    ).union(again.select(*columns, F.coalesce(revisit, F.lit(False)), F.when(revisit, F.col("refers_to"))))


def write(pages: DataFrame, folder: str, *, date: str, least: int = REVISIT_BYTES) -> DataFrame:
    """Archives of ``pages`` (page_id, url, html) in ``folder``, a shared one.

    Returns (path, records, bytes) per archive. A retried task writes files of other names; only
    those of the attempt that succeeded are in the result, which is stored.
    """
    rows = with_revisits(pages, least).select(
        F.col("page_id").cast("string"), "url", "payload", "digest", "revisit",
        F.col("refers_to").cast("string"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        out, path, count, size, done = None, "", 0, 0, []
        for batch in batches:
            for row in zip(*[column for column in batch.columns]):
                page_id, url, payload, digest, revisit, refers_to = (x.as_py() for x in row)
                if out is None:
                    path, count, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(path, compression=None)
                member = record(page_id, url, payload, digest, date, refers_to, revisit)
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((path, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, count, size))
        name = lambda p: folder.rstrip("/") + p[len(root.rstrip("/")):]
        yield pa.RecordBatch.from_pydict({
            "path": pa.array([name(p) for p, _, _ in done], pa.string()),
            "records": pa.array([n for _, n, _ in done], pa.int64()),
            "bytes": pa.array([b for _, _, b in done], pa.int64()),
        })

    return settle(rows.mapInArrow(run, "path string, records long, bytes long"))


_ROW = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.string()),
    ("url", pa.string()), ("date", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("refers_to", pa.string()), ("refers_to_record", pa.string()),
    ("payload", pa.binary()), ("error", pa.string()),
])
_COLUMNS = (
    "record_id string, record_type string, page_id string, url string, date string, payload_bytes long, "
    "payload_digest string, refers_to string, refers_to_record string, payload binary, error string"
)


def read(archives: DataFrame, *, payloads: bool = True) -> DataFrame:
    """A row per record of the archives at ``path``, read in sequence by one task each.

    ``error`` is null for records whose framing and digests are right; a damaged record has
    nothing else. Without ``payloads`` that column is null.
    """
    paths = archives.select("path")
    paths = paths.repartition(max(1, paths.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = open_folder(path)
                rows, held = [], 0
                with system.open_input_stream(place, compression=None, buffer_size=PIECE) as stream:
                    for row in records(stream, payloads):
                        rows.append(row)
                        held += len(row.get("payload") or b"")
                        if len(rows) >= 4096 or held >= 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _ROW)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, _ROW)

    return paths.mapInArrow(run, _COLUMNS)


def new_folder(spark: SparkSession) -> str:
    """A folder of its own in the cluster's shared one."""
    return f"{shared_folder(spark)}/warc/{uuid.uuid4().hex}"
