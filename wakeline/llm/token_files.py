"""Token ids of documents in binary files of patched frame-of-reference blocks.

Documents are dealt out by ranges of their id, in order, and encoded; each task cuts its ids into files of
about ``FILE_IDS`` ids at document ends. A file holds its documents' ids and lengths and the ids in blocks of
``BLOCK``: the block's minimum is subtracted, values are packed at the width that the ``PERCENTILE``-th
percentile needs, and what does not fit is stored in exception lists. A directory says where each block
starts, so that any block can be read alone. Files become visible by a rename after they are whole, have the same
name and content in every attempt, and are listed in a manifest that Spark commits.

File layout, little-endian: magic ``PFR1``; n_docs, n_ids, n_blocks (u64); doc ids (i64 each, and a byte each
that is 1 where the id is null); tokens per document (u64 each); directory of (offset u64, minimum u32, width
u16, exceptions u16, values u32) per block; blocks. A block is ``width`` bit planes, the lowest first, then
positions (u16) and high parts (u32) of the exceptions.

Defined cases: a null or empty text has the end id alone; equal doc ids are ordered by text; a null doc id comes
first; an empty table gives no files; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.llm.common import by_batch, fresh_path, parts, read
from wakeline.llm.encode import encoder, with_end
from wakeline.llm.words import slices

BLOCK = 4096
FILE_IDS = 2_000_000
PERCENTILE = 90
MAGIC = b"PFR1"
_ENTRY = np.dtype([("at", "<u8"), ("low", "<u4"), ("width", "<u2"), ("exceptions", "<u2"), ("values", "<u4")])


def pack(ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> tuple[np.ndarray, bytes]:
    """Directory (offsets from the first block) and bytes of the blocks."""
    n = len(ids)
    count = -(-n // block)
    entries = np.zeros(count, _ENTRY)
    if not n:
        return entries, b""
    values = np.pad(ids.astype(np.uint32), (0, count * block - n), mode="edge").reshape(count, block)
    low = values.min(axis=1)
    values = values - low[:, None]
    place = min(block - 1, block * percentile // 100)
    typical = np.partition(values, place, axis=1)[:, place]
    width = np.ceil(np.log2(typical.astype(np.float64) + 1)).astype(np.uint32)
    out: list[bytes] = [b""] * count
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        group = values[rows]
        planes = [np.packbits(((group >> np.uint32(b)) & 1).astype(np.uint8), axis=1) for b in range(w)]
        high = group >> np.uint32(w) if w < 32 else np.zeros_like(group)
        which, where = np.nonzero(high)
        first = np.searchsorted(which, np.arange(len(rows) + 1))
        for k, row in enumerate(rows):
            a, b = first[k], first[k + 1]
            out[row] = b"".join(
                [*(p[k].tobytes() for p in planes), where[a:b].astype("<u2").tobytes(), high[k, where[a:b]].astype("<u4").tobytes()]
            )
            entries["exceptions"][row] = b - a
    entries["low"], entries["width"], entries["values"] = low, width, block
    entries["values"][-1] = n - (count - 1) * block
    entries["at"] = np.concatenate(([0], np.cumsum([len(x) for x in out])[:-1]))
    return entries, b"".join(out)


def unpack(entries: np.ndarray, data: bytes, block: int = BLOCK) -> np.ndarray:
    """The ids of the given blocks; ``data`` is what the directory's offsets point into."""
    raw = np.frombuffer(data, np.uint8)
    out = np.zeros((len(entries), block), np.uint32)
    plane = -(-block // 8)
    for w in np.unique(entries["width"]):
        rows = np.flatnonzero(entries["width"] == w)
        at = entries["at"][rows].astype(np.int64)
        group = np.zeros((len(rows), block), np.uint32)
        for b in range(int(w)):
            bits = raw[(at + b * plane)[:, None] + np.arange(plane)]
            group |= np.unpackbits(bits, axis=1, count=block).astype(np.uint32) << np.uint32(b)
        out[rows] = group
        at += int(w) * plane
        for row, start, n in zip(rows, at, entries["exceptions"][rows].astype(np.int64)):
            if n:
                where = np.frombuffer(data, "<u2", n, start)
                out[row, where] |= np.frombuffer(data, "<u4", n, start + 2 * n) << np.uint32(w)
    out += entries["low"][:, None]
    last = int(entries["values"][-1]) if len(entries) else 0
    return out.reshape(-1)[: max(0, len(entries) - 1) * block + last]


def file_bytes(doc_ids: list, tokens: np.ndarray, ids: np.ndarray) -> bytes:
    entries, blocks = pack(ids)
    head = np.array([len(doc_ids), len(ids), len(entries)], "<u8").tobytes()
    names = np.array([x or 0 for x in doc_ids], "<i8").tobytes() + bytes(x is None for x in doc_ids)
    entries["at"] += len(MAGIC) + len(head) + len(names) + 8 * len(tokens) + entries.nbytes
    return b"".join([MAGIC, head, names, tokens.astype("<u8").tobytes(), entries.tobytes(), blocks])


class TokenFile:
    """A file's documents and blocks; ``ids(a, b)`` decodes only the blocks that hold those positions."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token file")
        self.data = data
        n_docs, self.n_ids, n_blocks = (int(x) for x in np.frombuffer(data, "<u8", 3, 4))
        at = 28
        names = np.frombuffer(data, "<i8", n_docs, at)
        null = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs)
        self.doc_ids = [None if z else int(x) for x, z in zip(names, null)]
        at += 9 * n_docs
        self.tokens = np.frombuffer(data, "<u8", n_docs, at).astype(np.int64)
        self.entries = np.frombuffer(data, _ENTRY, n_blocks, at + 8 * n_docs)
        self.starts = np.concatenate(([0], np.cumsum(self.tokens)))

    def ids(self, start: int, end: int) -> np.ndarray:
        if end <= start:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, -(-end // BLOCK)
        return unpack(self.entries[first:last], self.data)[start - first * BLOCK : end - first * BLOCK]


def put(folder: str, name: str, data: bytes) -> None:
    """Write a whole file under the shared folder, then rename it into place."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    system.create_dir(path, recursive=True)
    trial = f"{path}/_{uuid.uuid4().hex}"
    with system.open_output_stream(trial) as out:
        out.write(data)
    system.move(trial, f"{path}/{name}")


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str = "word_bpe_49k.json",
    folds: bool = True,
    end_id: int = 1,
    file_ids: int = FILE_IDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Encode and write; returns the manifest (file, part, seq, n_docs, n_ids), itself stored beside the files."""
    spark = docs.sparkSession
    data = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    data = data.repartitionByRange(parts(spark), "doc_id").sortWithinPartitions("doc_id", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        names: list = []
        chunks: list[np.ndarray] = []
        lengths: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal seq
            ids, tokens = np.concatenate(chunks), np.concatenate(lengths)
            name = f"tokens-{part:06d}-{seq:06d}.pfr"
            put(folder, name, file_bytes(names, tokens, ids))
            row = pa.RecordBatch.from_pydict(
                {"file": [name], "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_docs": [len(names)], "n_ids": [len(ids)]}
            )
            seq += 1
            names.clear(), chunks.clear(), lengths.clear()
            return row

        for batch in batches:
            text = batch.column("text")
            for i, j in slices(text):
                ids, starts = with_end(*encoder(tokenizer, folds)(text.slice(i, j - i)), end_id)
                names.extend(batch.column("doc_id").slice(i, j - i).to_pylist())
                chunks.append(ids)
                lengths.append(np.diff(starts))
                if sum(map(len, chunks)) >= file_ids:
                    yield flush()
        if names:
            yield flush()

    manifest = data.mapInArrow(work, "file string, part int, seq int, n_docs long, n_ids long")
    manifest.write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files that count, and how many ids come before each; one row per file of about two million ids."""
    files = spark.read.schema("file string, part int, seq int, n_docs long, n_ids long").parquet(f"{folder}/manifest")
    # Two steps, so that no window holds all files: within a part, then over the parts.
    inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = files.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = F.coalesce(F.sum("part_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = whole.select("part", before.alias("part_start"))
    return files.withColumn("inside", inside).join(whole, "part").withColumn("start", F.col("part_start") + F.col("inside")).drop("inside", "part_start")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for k in range(batch.num_rows):
            file = TokenFile(batch.column("content")[k].as_py())
            raw = memoryview(file.ids(0, file.n_ids).astype("<u4").tobytes())
            yield {
                "file": [batch.column("file")[k].as_py()] * len(file.doc_ids),
                "doc_id": file.doc_ids,
                "local": file.starts[:-1],
                "n_tokens": file.tokens,
                "ids_crc32": [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(file.starts[:-1].tolist(), file.starts[1:].tolist())],
            }

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfr").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    found = by_batch(files, "file string, doc_id long, local long, n_tokens long, ids_crc32 long", work)
    # Files are many times fewer than rows; Spark chooses the join by the manifest's size.
    return found.join(read_manifest(spark, folder).select("file", F.col("start").alias("file_start")), "file").select(
        "doc_id", (F.col("file_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "tokens")
    write_tokens(read(spark, sf_dir, "documents"), folder)
    return read_documents(spark, folder)
