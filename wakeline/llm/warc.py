"""WARC archives without repeated payloads.

Revisit resolution: each payload's digest is taken where the payload is read, and only headers (id, digest, bytes) are
shuffled. Of equal payloads the record with the smallest id is the response; a map-side ``min`` per digest
finds it, so that a payload which a third of all pages share is a few rows per task. Headers join that
original, and records are written with fresh headers into gzipped archives (one gzip member per record, the usual form):
a response holds the payload, a revisit refers to the response's record id and holds none. An archive becomes
visible by a rename after it is whole; the manifest that Spark commits says which archives count.

Defined cases: a null payload is empty; equal page ids with equal payloads are one response and revisits of it
with the same id; a null page id sorts last; payloads under ``least`` bytes are all responses; an empty table gives no
archives and no rows; other columns are ignored. Records without a URL get an ``urn:`` target.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.llm.common import by_batch, fresh_path, read
from wakeline.llm.token_files import put

#: Bytes of records (before gzip) after which a task begins another archive.
ARCHIVE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, sha: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{page_id}/{sha}/{copy}')}>"


def _head(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def record(page_id, copy: int, url, payload, sha: str, revisit: bool = False, original=None) -> bytes:
    """One WARC record; a revisit refers to page ``original`` and needs only the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c for c in url or "" if c > " ") or f"urn:page:{page_id}"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, sha, copy)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{sha}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(original, sha, 1)),
            ("X-Refers-To-Page-ID", "" if original is None else str(original)),
        ]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return _head(fields) + block + b"\r\n\r\n"


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of an archive, one record each."""
    view, at = memoryview(data), 0
    while at < len(view):
        one, out = zlib.decompressobj(31), []
        while not one.eof:
            if at >= len(view):
                raise ValueError("the archive ends inside a record")
            chunk = view[at : at + 16384]  # what is left over is copied, so feed little at a time
            out.append(one.decompress(chunk))
            at += len(chunk)
        at -= len(one.unused_data)
        yield b"".join(out)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def resolve(headers: DataFrame) -> DataFrame:
    """Distinct headers (key, page_id, sha) with ``original``, the smallest page id of that payload."""
    first = headers.groupBy("sha").agg(F.min("page_id").alias("original"))
    return headers.select("key", "sha").distinct().join(first, "sha")


def write_archives(
    pages: DataFrame,
    folder: str,
    least: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
) -> DataFrame:
    """Write the records of ``pages``; returns the manifest (archive, n_records)."""
    spark = pages.sparkSession
    data = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(payload_column), F.lit("")).cast("binary").alias("payload"),
    )
    data = data.withColumns({"sha": F.unhex(F.sha1("payload")), "bytes": F.length("payload").cast("long")})
    # Plain equality on a key without nulls, so that join and window share one shuffle of the payloads.
    data = data.withColumn("key", F.coalesce("page_id", F.lit(-(1 << 63))))
    rows = data.join(resolve(data.select("key", "page_id", "sha")), ["key", "sha"])
    # Rows alike in id and payload: the first is the record, the others revisit it.
    copy = F.row_number().over(Window.partitionBy("key", "sha").orderBy(F.col("page_id").asc_nulls_last(), "url"))
    rows = rows.withColumn("copy", copy)
    own = F.col("page_id").eqNullSafe(F.col("original")) & (F.col("copy") == 1)
    rows = rows.withColumn("revisit", (F.col("bytes") >= least) & ~own)
    rows = rows.select(
        "page_id", "copy", "url", F.when(~F.col("revisit"), F.col("payload")).alias("payload"), "bytes", "sha", "revisit", "original"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, n, size, out = TaskContext.get().partitionId(), 0, 0, 0, io.BytesIO()

        def flush() -> pa.RecordBatch:
            name = f"pages-{part:06d}-{seq:06d}.warc.gz"
            put(folder, name, out.getvalue())
            return pa.RecordBatch.from_pydict({"archive": [name], "n_records": pa.array([n], pa.int64())})

        for batch in batches:
            for r in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                page_id, copy, url, payload, length, sha, revisit, original = r
                body = _Length(length) if revisit else payload
                text = record(page_id, copy, url, body, base64.b32encode(sha).decode(), revisit, original)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                out.write(packer.compress(text) + packer.flush())
                n, size = n + 1, size + len(text)
                if size >= archive_bytes:
                    yield flush()
                    seq, n, size, out = seq + 1, 0, 0, io.BytesIO()
        if n:
            yield flush()

    rows.mapInArrow(work, "archive string, n_records long").write.parquet(f"{folder}/manifest")
    return spark.read.schema("archive string, n_records long").parquet(f"{folder}/manifest")


class _Length:
    """Stands for a payload of which only the length is known."""

    def __init__(self, n: int):
        self.n = n

    def __len__(self) -> int:
        return self.n


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per record; checks digests and counts."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for k in range(batch.num_rows):
            rows: dict[str, list] = {c: [] for c in ("archive", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")}
            for member in members(batch.column("content")[k].as_py()):
                fields, block = parse(member)
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(http.decode().rsplit("Content-Length: ", 1)[1].split("\r\n")[0])
                sha = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if fields["WARC-Type"] == "response" and (digest(payload) != sha or len(payload) != size):
                    raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
                original = fields.get("X-Refers-To-Page-ID")
                for c, v in zip(rows, (
                    batch.column("archive")[k].as_py(), int(fields["X-Page-ID"]) if fields["X-Page-ID"] else None, size, sha,
                    fields["WARC-Type"], int(original) if original else None,
                )):
                    rows[c].append(v)
            yield rows

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")
    found = by_batch(files, "archive string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long", work)
    listed = spark.read.schema("archive string, n_records long").parquet(f"{folder}/manifest").select("archive")
    return found.join(listed, "archive", "left_semi").drop("archive")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    write_archives(read(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder)


#: Base32 in SQL: the digest's 160 bits in 32 groups of five.
SQL = """
WITH hashed AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS sha FROM pages),
bits AS (
  SELECT page_id, body, sha,
         array_to_string(list_transform(range(0, 40), lambda i:
           lpad(bin(CAST('0x' || substr(sha, CAST(i AS INT) + 1, 1) AS INT)), 4, '0')), '') AS b
  FROM hashed),
named AS (
  SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
         array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
           + 16 * CAST(substr(b, CAST(5 * j AS INT) + 1, 1) AS INT) + 8 * CAST(substr(b, CAST(5 * j AS INT) + 2, 1) AS INT)
           + 4 * CAST(substr(b, CAST(5 * j AS INT) + 3, 1) AS INT) + 2 * CAST(substr(b, CAST(5 * j AS INT) + 4, 1) AS INT)
           + CAST(substr(b, CAST(5 * j AS INT) + 5, 1) AS INT), 1)), '') AS payload_digest
  FROM bits)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM named)
"""
