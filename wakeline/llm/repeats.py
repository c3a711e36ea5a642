"""Repeated byte strings, found by column-wise construction of a suffix order with its common prefixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else. Column-wise construction
inserts one symbol of every string per round and updates the order of all suffixes and the common prefixes of
neighbours. Over whole texts that would take as many rounds as the longest text has bytes, one after the other. So the
strings are bounded stretches around anchors that hold everything to be compared:

* In each window of ``LENGTH`` bytes the ``GRAM``-byte string with the smallest hash (the leftmost of equals) is its
  anchor. Equal windows have equal anchors at the same place, so windows need only be compared around equal
  anchors, and each window belongs to one anchor.
* Anchors whose hash occurs once are done. For the others a stretch of text that holds all the anchor's windows is
  shuffled by the hash, and read in sorted order (Spark's sorted shuffle files are the external files).
* Stretches alike in bytes and anchor repeat each other as a whole; one of them goes on.
* An anchor hash with more than ``MOST`` anchors does not go to one task: its windows are dealt out by their own 128-bit
  hashes, counted with map-side aggregation, and those met twice are joined back. A task sends a window twice at most;
  a third one is known to be repeated where it is met. Which way a hash takes shapes the work, not the result.
* Stretches are aligned at the anchor. From the last column to the first, each round inserts the column's byte in
  front of every suffix: a stable pass by that byte over the last order gives the new one, and the common
  prefix of new neighbours is one more than the least one between them before. Neighbours with ``LENGTH`` or more
  common bytes start equal windows.

Equal texts are one text with a count; a text that occurs twice is repeated as a whole, and still a partner for others.

Defined cases: null text is empty; texts under ``LENGTH`` bytes stay whole; rows equal in id and text are two documents
like any others; an empty table gives an empty one; other columns are ignored. Texts are told apart by MD5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.common import by_batch, parts, read, stored
from wakeline.llm.words import _BYTE, SEGMENT, _powers, mix, ranges, raw, slices

LENGTH = 400
GRAM = 128
#: Stretches ordered together; a group of equal anchors is not split, and has at most ``MOST`` of them (about 3 KB each).
TOGETHER = 4096
MOST = 1 << 15
#: Shapes a task remembers having sent, and windows of very common anchors.
SENT = 1_000_000
WINDOWS = 500_000
_NONE = 256  # stands beyond a stretch's ends


def rolling(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` bytes from each position."""
    n = len(data) - k + 1
    out = np.empty(max(n, 0), np.uint64)
    up, down = _powers()
    step = SEGMENT - k
    for b in range(0, n, step):
        m = min(step, n - b)
        part = _BYTE[data[b : b + m + k - 1]]
        part *= up[: len(part)]
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part)))
        out[b : b + m] = (total[k : k + m] - total[:m]) * down[:m]
    return mix(out)


def least_in_windows(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by minima from the left and right ends of blocks."""
    n = len(keys)
    blocks = -(-n // width)
    full = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = keys
    grid = full.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).reshape(-1)
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Of each anchor its text, hash, place, and the first and last window it stands for (places in the text)."""
    windows = ranges(offsets[:-1], np.maximum(np.diff(offsets) - length + 1, 0))
    if not len(windows):
        return (np.zeros(0, np.int64),) * 5
    hashed = rolling(data, gram)
    # The hash's upper half, then the place: the smallest is the leftmost of the smallest.
    keys = (hashed & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashed), dtype=np.uint64)
    place = (least_in_windows(keys, length - gram + 1)[windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.append(first[1:], len(place)) - 1
    at, low, high = place[first], windows[first], windows[last]
    text = np.searchsorted(offsets, at, "right") - 1
    return text, hashed[at].view(np.int64), at - offsets[text], low - offsets[text], high - offsets[text]


def repeated_windows(rows: np.ndarray, first: np.ndarray, last: np.ndarray, length: int, middle: int) -> np.ndarray:
    """Which windows of aligned stretches occur twice: (stretch, bytes before the anchor) as booleans.

    ``rows``: a line of symbols per stretch, the anchor at column ``middle``; windows ``first`` to ``last`` bytes before
    the anchor belong to the stretch.
    """
    n, columns = rows.shape
    marks = np.zeros((n, middle + 1), bool)
    order, common = np.arange(n), np.zeros(n, np.int64)  # common[i]: with the suffix before, in order
    by_column = np.ascontiguousarray(rows.T)
    for c in range(columns - 1, -1, -1):
        symbol = by_column[c][order]
        pick = np.argsort(symbol, kind="stable")
        same = symbol[pick][1:] == symbol[pick][:-1]
        # The least common prefix between two places of the last order, by minima over powers of two.
        low, span = pick[:-1][same] + 1, np.diff(pick)[same]
        least = np.zeros(len(low), np.int64)
        level, width = common, 1
        while len(low):
            here = (span >= width) & (span < 2 * width)
            if here.any():
                least[here] = np.minimum(level[low[here]], level[low[here] + span[here] - width])
            if not (span >= 2 * width).any():
                break
            level = np.minimum(level[:-width], level[width:])
            width *= 2
        order = order[pick]
        common = np.zeros(n, np.int64)
        common[1:][same] = least + 1
        before = middle - c
        if 0 <= before <= middle:
            group = np.cumsum(common < length) - 1
            own = (first[order] <= before) & (before <= last[order])
            many = np.bincount(group[own], minlength=n) > 1
            marks[order[own & many[group]], before] = True
    return marks


def covered(group: dict[str, list], length: int, gram: int) -> dict | None:
    """Byte spans of the texts that repeated windows cover."""
    middle = length - gram
    n = len(group["at"])
    at, low, high = (np.array(group[c], np.int64) for c in ("at", "low", "high"))
    rows = np.full((n, middle + length), _NONE, np.uint16)
    for i, stretch in enumerate(group["stretch"]):
        a = middle - int(at[i] - low[i])
        rows[i, a : a + len(stretch)] = np.frombuffer(stretch, np.uint8)
    marks = repeated_windows(rows, at - high, at - low, length, middle)
    edge = np.diff(np.pad(marks.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    who, first = np.nonzero(edge == 1)
    last = np.nonzero(edge == -1)[1] - 1
    if not len(who):
        return None
    return {
        "print": [group["print"][i] for i in who.tolist()],
        "start": at[who] - last,
        "end": at[who] - first + length,
    }


def windows_apart(texts: DataFrame, length: int) -> DataFrame:
    """Repeated spans (print, start, end) of the windows of ``texts.common``, anchors too common for one task."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes: dict[bytes, int] = {}
        met: dict[bytes, int] = {}  # how often each window was met, up to 2
        for batch in batches:
            for k in range(batch.num_rows):
                data, name = memoryview(batch.column("text")[k].as_py().encode()), batch.column("print")[k].as_py()
                keys, starts, ends = [], [], []
                for p in batch.column("common")[k].as_py():
                    low, high = p["low"], p["high"]
                    if len(shapes) > SENT:
                        shapes.clear()
                    if len(met) > WINDOWS:
                        met.clear()
                    shape = hashlib.md5(data[low : high + length]).digest()
                    times = shapes.get(shape, 0)
                    shapes[shape] = times + 1
                    if times > 1:
                        # Both of the first ones have sent all their windows or found them repeated.
                        keys.append(None)
                        starts.append(low)
                        ends.append(high + length)
                        continue
                    joins = False  # does the last span end with the window before?
                    for start in range(low, high + 1):
                        key = xxhash.xxh3_128_digest(data[start : start + length])
                        times = met.get(key, 0)
                        if times < 2:
                            met[key] = times + 1
                            keys.append(key)
                            starts.append(start)
                            ends.append(start + length)
                            joins = False
                        elif joins:
                            ends[-1] = start + length
                        else:
                            keys.append(None)
                            starts.append(start)
                            ends.append(start + length)
                            joins = True
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array([name] * len(keys), pa.binary()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                    ["key", "print", "start", "end"],
                )

    found = texts.select("print", "text", "common").mapInArrow(send, "key binary, print binary, start long, end long")
    found = stored(found, "windows")
    keyed = found.where("key is not null")
    twice = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return keyed.join(twice, "key", "left_semi").drop("key").union(found.where("key is null").drop("key"))


def spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """Texts (print, n_bytes, copies, sha256, text) and repeated spans (print, start, end).

    ``docs`` has print and text. The text is kept only where it has an anchor that occurs elsewhere too.
    """
    spark = docs.sparkSession

    def find(batch: pa.RecordBatch) -> Iterator[dict]:
        column, names = batch.column("text"), batch.column("print")
        for i, j in slices(column):
            data, offsets = raw(column.slice(i, j - i))
            text, hashed, at, low, high = anchors(data, offsets, length, gram)
            yield {"hash": hashed, "print": names.slice(i, j - i).take(pa.array(text)), "at": at, "low": low, "high": high}

    found = stored(by_batch(docs, "hash long, print binary, at long, low long, high long", find), "anchors")
    # Two different places: the least and the greatest differ. Copies of a text are reduced before the shuffle.
    place = F.struct("print", "at")
    twice = found.groupBy("hash").agg(F.min(place).alias("x"), F.max(place).alias("y"), F.count("*").alias("n")).where("x <> y")
    twice = twice.select("hash", (F.col("n") > most).alias("common"))
    anchor = F.struct("hash", "at", "low", "high")
    wanted = found.join(twice, "hash").groupBy("print").agg(
        F.collect_set(F.when(~F.col("common"), anchor)).alias("anchors"), F.collect_set(F.when(F.col("common"), anchor)).alias("common")
    )
    whole = docs.groupBy("print").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    texts = whole.join(wanted, "print", "left").select(
        "print",
        "copies",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2("text", 256).alias("sha256"),
        F.when(F.col("anchors").isNotNull(), F.col("text")).alias("text"),
        *(F.when(F.size(c) > 0, F.col(c)).alias(c) for c in ("anchors", "common")),
    )
    texts = stored(texts, "texts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in batches:
            for k in range(batch.num_rows):
                data = batch.column("text")[k].as_py().encode()
                places = batch.column("anchors")[k].as_py()
                if len(sent) > SENT:
                    sent.clear()
                shapes, stretches = [], []
                for p in places:
                    stretch = data[p["low"] : p["high"] + length]
                    shape = hashlib.md5(b"%d/" % (p["at"] - p["low"]) + stretch).digest()
                    # Of like stretches a task sends the bytes once: periodic texts and common passages have many.
                    stretches.append(None if shape in sent else stretch)
                    shapes.append(shape)
                    sent.add(shape)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array([p[c] for p in places], pa.int64()) for c in ("hash", "at", "low", "high")),
                        pa.array([batch.column("print")[k].as_py()] * len(places), pa.binary()),
                        pa.array(shapes, pa.binary()),
                        pa.array(stretches, pa.binary()),
                    ],
                    ["hash", "at", "low", "high", "print", "shape", "stretch"],
                )

    stretches = texts.where("anchors is not null").select("print", "text", "anchors").mapInArrow(
        cut, "hash long, at long, low long, high long, print binary, shape binary, stretch binary"
    )
    dealt = stretches.repartition(parts(spark), "hash").sortWithinPartitions(
        "hash", "shape", F.col("stretch").isNull()
    )
    fields = ("print", "at", "low", "high", "stretch")

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: dict[str, list] = {c: [] for c in fields}  # one stretch of each shape
        found: dict[str, list] = {"print": [], "start": [], "end": []}
        current = shape = None  # hash and shape of the last row
        begun, alone = 0, False  # where the open group begins; is the last shape's first row the only one so far?

        def add(name: bytes, start: int, end: int) -> None:
            for column, value in zip(found.values(), (name, start, end)):
                column.append(value)

        def done(upto: int) -> Iterator[pa.RecordBatch]:
            nonlocal group, found
            part, group = {c: v[:upto] for c, v in group.items()}, {c: v[upto:] for c, v in group.items()}
            for out in (found, covered(part, length, gram) if upto else None):
                if out and len(out["print"]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out["print"], pa.binary()), pa.array(out["start"], pa.int64()), pa.array(out["end"], pa.int64())],
                        ["print", "start", "end"],
                    )
            found = {c: [] for c in found}

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("hash", "shape", *fields))
            for hashed, kind, name, at, low, high, stretch in zip(*columns):
                if hashed != current:
                    current, begun = hashed, len(group["at"])
                    if begun >= TOGETHER or len(found["print"]) >= TOGETHER:
                        yield from done(begun)
                        begun = 0
                if kind != shape:
                    shape, alone = kind, True
                    for c, value in zip(fields, (name, at, low, high, stretch)):
                        group[c].append(value)
                    continue
                # A stretch met again: all its windows are repeated, here and where it was met first.
                if alone:
                    add(group["print"][-1], group["low"][-1], group["high"][-1] + length)
                    alone = False
                add(name, low, high + length)
        yield from done(len(group["at"]))

    found = dealt.mapInArrow(order, "print binary, start long, end long")
    common = texts.where("common is not null")
    return texts, found if common.select("print").isEmpty() else found.union(windows_apart(common, length))


def without_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text", most: int = MOST
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) per row; ``kept`` is binary, since a cut may split a character."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("print"), text.alias("text"))
    texts, found = spans(rows.select("print", "text"), length, gram, most)
    found = found.groupBy("print").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    texts = texts.drop("anchors", "common").join(found, "print", "left")

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {c: [] for c in ("print", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for name, copies, n, sha, text, spans in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            if copies > 1 and n >= length:
                row = (name, n, n, 1, hashlib.sha256(b"").hexdigest(), b"")
            elif not spans:
                row = (name, n, 0, 0, sha, None)
            else:
                data = np.frombuffer(text.encode(), np.uint8)
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, [s["start"] for s in spans], 1)
                np.add.at(edge, [s["end"] for s in spans], -1)
                gone = np.cumsum(edge)[:n] > 0
                kept = data[~gone].tobytes()
                runs = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                row = (name, n, int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept)
            for column, value in zip(out.values(), row):
                column.append(value)
        yield out

    done = by_batch(
        texts.select("print", "copies", "n_bytes", "sha256", "text", "spans"),
        "print binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
        work,
    )
    return rows.drop("text").join(done, "print").drop("print")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The bytes left, so that a reader need not take a length of the input for one of the result.
    found = without_repeats(read(spark, sf_dir, "documents")).drop("kept")
    return found.withColumn("n_kept", F.col("n_bytes") - F.col("n_removed"))
