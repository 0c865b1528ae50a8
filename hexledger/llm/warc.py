"""WARC archives: one gzip member a record, written by tasks and read back by byte ranges.

The reader is splittable. A task gets a byte range of a file, looks for gzip magic, takes a candidate for a
member only if it decodes to a WARC header, and owns the records that start inside its range, which it reads
to their end even beyond the range. So no index of the records is needed, and any cut of a file gives the
same rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexledger.llm.frames import bound_batches, counted, same
from hexledger.session import materialize, scratch_path

# Equal payloads of at least so many bytes are stored once.
MIN_REVISIT_BYTES = 0
# A file of a task is closed, and the next one begun, at this size.
FILE_BYTES = 256 << 20
SPLIT_BYTES = 8 << 20
# Tasks that share the ranges at most.
MOST_TASKS = 10_000
# Groups of equal payloads, (digest, smallest page), that are broadcast when there are at most so many.
BROADCAST_GROUPS = 200_000

_MAGIC = b"\x1f\x8b\x08"
_READ = 1 << 18
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"

RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "intact boolean, path string, offset long"
)


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path of the shared folder, whatever its scheme, and the path in it."""
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("/"):
        return pyarrow.fs.LocalFileSystem(), uri
    return pyarrow.fs.FileSystem.from_uri(uri)


def with_originals(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """`pages` with payload (html, null as empty), sha1, record_type and refers_to.

    Of rows with equal payloads of at least `min_bytes` bytes the one with the smallest page_id is the
    response; the others are revisits of it. Rows that share that page_id are all responses. Null ids come
    after all others; where all ids of a payload are null, all its rows are responses.
    """
    keyed = pages.drop("payload", "sha1", "record_type", "refers_to", "first_id").withColumn(
        "payload", F.coalesce("html", F.lit(""))
    )
    keyed = keyed.withColumn("sha1", F.sha1(F.col("payload").cast("binary")))
    shared = materialize(
        keyed.where(F.octet_length("payload") >= min_bytes)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("rows"))
        .where("rows > 1 AND first_id IS NOT NULL")
        .select("sha1", "first_id"),
        "equal-payloads",
    )
    joined = keyed.join(counted(shared, shared.count(), BROADCAST_GROUPS), "sha1", "left")
    revisit = F.col("first_id").isNotNull() & ~same(F.col("first_id"), F.col("page_id"))
    return joined.select(
        *keyed.columns,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(row: dict) -> bytes:
    """One WARC record. The HTTP header keeps the length of the full payload, which a revisit leaves out."""
    payload = row["payload"].encode()
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if row["record_type"] == "revisit" else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {_record_id(row['page_id'], digest)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if row["url"] is not None:
        # Bytes that a header line can't hold are percent-encoded, the percent sign among them.
        head.append(f"WARC-Target-URI: {quote(row['url'], safe=_URL_SAFE)}")
    if row["page_id"] is not None:
        head.append(f"Page-ID: {row['page_id']}")
    if row["record_type"] == "revisit":
        head += [
            f"WARC-Profile: {_PROFILE}",
            f"WARC-Refers-To: {_record_id(row['refers_to'], digest)}",
            f"Refers-To-Page-ID: {row['refers_to']}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL_SAFE = "".join(map(chr, range(0x21, 0x7F))).replace("%", "")


def write(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write one record per row of `pages` (page_id, url, html) and return the files: (path, bytes).

    The list of files holds those of the attempts that succeeded, so a task that was lost and run again
    leaves no record twice. An empty table writes no file. Other columns of `pages` are not stored.
    """
    spark = pages.sparkSession
    bound_batches(spark)
    folder = folder or scratch_path(spark, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        files: list[tuple[str, int]] = []
        sink, name, size = None, "", 0

        def close() -> None:
            if sink is not None:
                sink.close()
                files.append((f"{folder}/{name}", size))

        for batch in batches:
            for row in batch.to_pylist():
                if sink is None or size >= FILE_BYTES:
                    close()
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    sink = fs.open_output_stream(f"{root}/{name}", compression=None)
                member = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = member.compress(record(row)) + member.flush()
                sink.write(data)
                size += len(data)
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in files], pa.string()), pa.array([f[1] for f in files], pa.int64())],
            names=["path", "bytes"],
        )

    rows = with_originals(pages.select("page_id", "url", "html"), min_bytes).drop("html")
    return materialize(rows.mapInArrow(run, "path string, bytes long"), "warc-files")


def splits(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, first, after): the byte ranges of (path, bytes), spread over tasks."""
    ranges = files.agg(F.coalesce(F.sum(F.ceil(F.col("bytes") / split_bytes)), F.lit(0))).first()[0]
    return (
        files.where("bytes > 0")
        .selectExpr("path", "bytes", f"explode(sequence(0L, bytes - 1, {split_bytes}L)) AS first")
        .selectExpr("path", "first", f"least(first + {split_bytes}L, bytes) AS after")
        .repartition(min(max(int(ranges), 1), MOST_TASKS))  # a stated number: the rows are few, their work is not
    )


class _Window:
    """A moving window over a file: what has been read from `base` on."""

    def __init__(self, file, base: int) -> None:
        self.file, self.base, self.data = file, base, b""
        file.seek(base)

    def more(self) -> bool:
        read = self.file.read(_READ)
        self.data += read
        return bool(read)

    def drop(self, to: int) -> None:
        self.data, self.base = self.data[to - self.base :], to


def _member(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The content of the gzip member at `at` and where it ends; None if there is no WARC record."""
    inflate = zlib.decompressobj(31)
    content, fed = [], at - window.base
    checked = False
    while not inflate.eof:
        if fed >= len(window.data) and not window.more():
            return None
        try:
            content.append(inflate.decompress(window.data[fed:]))
        except zlib.error:
            return None
        fed = len(window.data)
        if not checked and sum(map(len, content)) >= 7:
            if not b"".join(content).startswith(b"WARC/1."):
                return None
            checked = True
    data = b"".join(content)
    end = window.base + fed - len(inflate.unused_data)
    return (data, end) if data.startswith(b"WARC/1.") else None


def members(file, first: int, after: int) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of the records that start in [first, after)."""
    window, at = _Window(file, first), first
    while at < after:
        found = window.data.find(_MAGIC, at - window.base)
        if found < 0:
            # The magic may begin in the last two bytes read.
            at = max(at, window.base + len(window.data) - len(_MAGIC) + 1)
            window.drop(min(at, window.base + len(window.data)))
            if not window.more():
                return
            continue
        at = window.base + found
        if at >= after:
            return
        window.drop(at)
        member = _member(window, at)
        if member is None:
            at += 1
            continue
        yield at, member[0]
        at = member[1]
        window.drop(at)


def parse(content: bytes) -> dict:
    """The fields of one record; `intact`: the payload has the digest and length that the header states."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind, digest, intact = fields["WARC-Type"], stated, True
    if kind == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        intact, length = digest == stated and len(payload) == length, len(payload)
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": int(fields["Page-ID"]) if "Page-ID" in fields else None,
        "url": None if url is None else _unquote(url),
        "record_type": kind,
        "refers_to": int(fields["Refers-To-Page-ID"]) if "Refers-To-Page-ID" in fields else None,
        "payload_bytes": length,
        "payload_digest": digest,
        "intact": intact,
        "payload": payload if kind == "response" else None,
    }


def _unquote(url: str) -> str:
    from urllib.parse import unquote

    return unquote(url)


def read(spark: SparkSession, files: DataFrame, payload: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of (path, bytes) files: RECORD, and with `payload` the bytes that a response holds.

    `payload_bytes` and `payload_digest` are those of the full payload: computed from it for a response, as
    stated in the header for a revisit. Files without records give no rows.
    """
    bound_batches(spark)
    schema = RECORD + (", payload binary" if payload else "")
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    arrow = pa.schema([(c.split()[0], types[c.split()[1]]) for c in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                fs, path = file_system(split["path"])
                rows, held = [], 0
                with fs.open_input_file(path) as file:
                    for offset, content in members(file, split["first"], split["after"]):
                        fields = parse(content) | {"path": split["path"], "offset": offset}
                        rows.append({n: fields[n] for n in names})
                        held += len(content) if payload else 200
                        if held >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return splits(files, split_bytes).mapInArrow(run, schema)
