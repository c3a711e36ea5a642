"""Vector codes of one byte a part, by Ball k-means.

Each part of a vector has a codebook. A round gives every part its nearest entry and moves each entry to the mean of its
parts. The rounds keep the last round's entry of every part, and use that an entry and its parts make up a ball:

* the radius of entry j (the furthest of its parts) says which entries can take a part from it at all: its neighbours,
  those within twice the radius of it;
* parts nearer to j than half the way to the nearest neighbour are the stable core: they stay without a look at others;
* the rest lies in annular rings between half the ways to one neighbour and the next, and is compared with exactly the
  neighbours inside its ring. Rings are worked in groups of doubling size.

All comparisons are of whole squared distances, so ties (to the lower entry) come out as in a search of all entries.
After an entry has moved, its radius is at most the old one plus the way moved; that bound is what neighbours are chosen
by, which saves a pass over the data.

Vectors lie in a table of blocks, written anew with each round's entries, as are the sums of a task, so a lost executor costs its
tasks only. To the driver come sums per entry and dimension: as many numbers as the codebooks have, times two.

Defined cases: see :mod:`wakeline.llm.vectors` for what is kept; a dimension that the parts do not divide is filled up
with zeros; with fewer vectors than entries the codebook is shorter; equal ids are told apart by their vectors, a null
id is the greatest; entries without parts stay; an empty table gives an empty one; repeated rows count as often as they occur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from wakeline.llm.common import read, remove, stored
from wakeline.llm.vectors import block_schema, blocks, longest, unpacked

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024.0
#: Salts of the labels' sums, as one label may hold most rows.
SALTS = 16


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Whole squared distances, a row a point. Doubles do while every sum in between stays below 2^53."""
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if 4 * most * most * max(1, points.shape[1]) < 1 << 53 else np.int64
    p, e = points.astype(kind), entries.astype(kind)
    return (p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)[None, :]


def nearest(points: np.ndarray, entries: np.ndarray, step: int = 1 << 13) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each point by a look at all entries; the first round has no balls yet."""
    best, far = np.empty(len(points), np.int64), np.empty(len(points), np.int64)
    for i in range(0, len(points), step):
        d = squared(points[i : i + step], entries)
        best[i : i + step] = d.argmin(1)
        far[i : i + step] = d.min(1)
    return best, far


class Balls:
    """A part's entries with their neighbours: ``order[j]`` by distance from j, ``way[j]`` the squared distances."""

    def __init__(self, entries: np.ndarray, reach: np.ndarray):
        """``reach``: an upper bound of four times the squared radius of each entry's ball; below 0 for an empty one."""
        between = squared(entries, entries).astype(np.int64)
        np.fill_diagonal(between, np.iinfo(np.int64).max)  # an entry is not its own neighbour
        order = np.argsort(between, axis=1, kind="stable")
        way = np.take_along_axis(between, order, axis=1)
        count = (way <= reach[:, None]).sum(1)
        count = np.minimum(count, len(entries) - 1)
        self.entries = entries
        self.order = [o[:c] for o, c in zip(order, count)]
        self.way = [w[:c] for w, c in zip(way, count)]

    def move(self, points: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each point, which ``held`` says the last entry of."""
        gap = points.astype(np.int64) - self.entries[held]
        best, far = held.copy(), (gap * gap).sum(1)
        by_entry = np.argsort(held, kind="stable")
        begins = np.searchsorted(held[by_entry], np.arange(len(self.entries) + 1))
        for j in range(len(self.entries)):
            way = self.way[j]
            at = by_entry[begins[j] : begins[j + 1]]
            if not len(at) or not len(way):
                continue
            inside = np.searchsorted(way, 4 * far[at], "right")  # neighbours within twice the distance
            ring = 1
            while len(at := at[inside > 0]):  # without such neighbours: the stable core
                inside = inside[inside > 0]
                here = inside <= ring
                if here.any():
                    who, near = at[here], np.sort(self.order[j][: min(ring, len(way))])
                    d = squared(points[who], self.entries[near]).astype(np.int64)
                    k = d.argmin(1)
                    d, k = d[np.arange(len(who)), k], near[k]
                    better = (d < far[who]) | ((d == far[who]) & (k < best[who]))
                    best[who[better]], far[who[better]] = k[better], d[better]
                    inside[here] = 0
                ring *= 4
        return best, far


def cut(x: np.ndarray, parts: int) -> np.ndarray:
    """A (part, row, place) array of the vectors' parts, filled up with zeros."""
    width = -(-x.shape[1] // parts)
    x = np.pad(x, ((0, 0), (0, parts * width - x.shape[1])))
    return np.ascontiguousarray(x.reshape(len(x), parts, width).transpose(1, 0, 2))


def first_entries(table: DataFrame, dimension: int, entries: int) -> np.ndarray:
    """The vectors of the smallest ids, ascending, nulls last."""
    ids = table.select(F.explode("k_0").alias("id")).orderBy(F.col("id").asc_nulls_last()).limit(entries).collect()
    last = ids[-1]["id"] if len(ids) == entries else None
    schema = StructType().add("id", table.schema["k_0"].dataType.elementType).add("x", ArrayType(LongType()))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist() if last is None else _with(batch, last):
                x = unpacked(row["x"], dimension, row["n"]).astype(np.int64)
                at = [i for i, k in enumerate(row["k_0"]) if last is None or (k is not None and k <= last)]
                if at:
                    yield pa.RecordBatch.from_pydict({"id": [row["k_0"][i] for i in at], "x": x[at].tolist()}, schema=arrow)

    found = table.select("n", "x", "k_0").mapInArrow(run, schema)
    rows = found.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    return np.array([r["x"] for r in rows], np.int64).reshape(len(rows), dimension)


def _with(batch: pa.RecordBatch, last) -> Iterator[dict]:
    """The blocks that hold an id up to ``last``."""
    for i in range(batch.num_rows):
        least = pc.min(batch.column(2)[i].values).as_py()
        if least is not None and least <= last:
            yield batch.slice(i, 1).to_pylist()[0]


MORE = "held binary, far binary, of array<int>, count array<long>, total array<long>, reach array<long>"


def assigned(table: DataFrame, books: list[np.ndarray], reach: list[np.ndarray] | None, dimension: int) -> DataFrame:
    """The blocks with the entry (``held``, a byte a part) and squared distance of each part; at the end of a task a row
    without vectors says how many parts each entry got (``count`` of the entries ``of``, numbered over all parts), their
    sums (``total``) and the furthest one's squared distance.
    """
    parts = len(books)
    kept = [c for c in table.columns if c.startswith("k_")]
    schema = StructType(list(table.select("d", "n", "x", *kept).schema.fields) + list(StructType.fromDDL(MORE).fields))
    arrow = to_arrow_schema(schema)
    source = table.select("d", "n", "x", *kept, *(["held"] if reach is not None else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = None if reach is None else [Balls(b, r) for b, r in zip(books, reach)]
        count = [np.zeros(len(b), np.int64) for b in books]
        furthest = [np.full(len(b), -1, np.int64) for b in books]
        total = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for i in range(batch.num_rows):
                n = batch.column(1)[i].as_py()
                x = cut(unpacked(batch.column(2)[i].as_py(), dimension, n), parts)
                if balls is None:
                    found = [nearest(p, b) for p, b in zip(x, books)]
                else:
                    held = np.frombuffer(batch.column("held")[i].as_py(), np.uint8).reshape(parts, n).astype(np.int64)
                    found = [ball.move(p, h) for ball, p, h in zip(balls, x, held)]
                for p, (best, far), c, f, t in zip(x, found, count, furthest, total):
                    c += np.bincount(best, minlength=len(c))
                    np.maximum.at(f, best, far)
                    np.add.at(t, best, p.astype(np.int64))
                own = {f.name: batch.column(f.name).slice(i, 1) for f in list(arrow)[: 3 + len(kept)]}
                own |= {"held": pa.array([np.stack([b for b, _ in found]).astype(np.uint8).tobytes()], pa.binary())}
                own |= {"far": pa.array([sum(f for _, f in found).astype(np.int64).tobytes()], pa.binary())}
                yield pa.RecordBatch.from_arrays([own[f.name] if f.name in own else pa.nulls(1, f.type) for f in arrow], schema=arrow)
        used = np.flatnonzero(np.concatenate(count))
        if len(used):
            last = {"of": used, "count": np.concatenate(count)[used], "total": np.concatenate(total)[used].ravel(), "reach": np.concatenate(furthest)[used]}
            columns = [pa.array([last[f.name].tolist()], f.type) if f.name in last else pa.array([0], f.type) if f.name == "n" else pa.nulls(1, f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return source.mapInArrow(run, schema)


def moved(table: DataFrame, books: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Each entry at the mean of its parts, and four times its ball's squared radius there, at most."""
    sums = table.where("n = 0")
    size, width = len(books[0]), books[0].shape[1]
    each = sums.select(F.posexplode("total").alias("i", "total"), "of").select(
        F.get("of", F.floor(F.col("i") / width).cast("int")).alias("of"), (F.col("i") % width).alias("place"), "total"
    )
    each = each.groupBy("of", "place").agg(F.sum("total").alias("total"))
    entry = sums.select(F.explode(F.arrays_zip("of", "count", "reach")).alias("e")).groupBy("e.of")
    entry = entry.agg(F.sum("e.count").alias("count"), F.max("e.reach").alias("reach"))
    total, count, furthest = np.zeros((len(books) * size, width), object), np.zeros(len(books) * size, np.int64), np.full(len(books) * size, -1, np.int64)
    for of, place, value in each.collect():  # entries times dimensions
        total[of, place] = value
    for of, n, far in entry.collect():
        count[of], furthest[of] = n, far
    new, reach = [], []
    for k, book in enumerate(books):
        at = slice(k * size, (k + 1) * size)
        some = count[at] > 0
        fresh = book.copy()
        fresh[some] = (total[at][some] // count[at][some].astype(object)[:, None]).astype(np.int64)
        way = np.sqrt(((fresh - book).astype(np.float64) ** 2).sum(1))
        radius = np.sqrt(np.maximum(furthest[at], 0).astype(np.float64)) + way
        reach.append(np.where(some, np.ceil(4 * radius * radius * (1 + 1e-9)) + 1, -1).astype(np.int64))
        new.append(fresh)
    return new, reach


def vector_codes(
    df: DataFrame, vector: str = "embedding", kept: tuple[str, ...] = ("vec_id", "label"), parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE
) -> tuple[DataFrame, list[np.ndarray]]:
    """(``k_0``, ``k_1``, ... of the kept columns, code array<int>, error), and the codebooks. The first kept column is the id."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's number is one byte")
    table = stored(blocks(df, vector, list(kept), scale), "vectors")
    dimension = longest(table)
    schema = StructType([f for f in df.select(*(F.col(f"`{c}`").alias(f"k_{i}") for i, c in enumerate(kept))).schema.fields])
    schema = schema.add("code", ArrayType(IntegerType())).add("error", "long")
    if not dimension:
        return df.sparkSession.createDataFrame([], schema), []
    start, table = table, table.where(F.col("d") == dimension)
    books, reach = list(cut(first_entries(table, dimension, entries), parts)), None
    raw = None
    for _ in range(rounds):
        before, raw = raw, stored(assigned(table, books, reach, dimension), "vectors")
        remove(before or start)
        books, reach = moved(raw, books)
        table = raw.where("n > 0")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n = batch.column("n")[i].as_py()
                held = np.frombuffer(batch.column("held")[i].as_py(), np.uint8).reshape(parts, n)
                code = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * parts, pa.int32()), pa.array(held.T.ravel(), pa.int32()))
                own = [batch.column(f.name).slice(i, 1).flatten() for f in list(arrow)[:-2]]
                yield pa.RecordBatch.from_arrays([*own, code.cast(arrow.field("code").type), pa.array(np.frombuffer(batch.column("far")[i].as_py(), np.int64))], schema=arrow)

    last = assigned(table, books, reach, dimension).where("n > 0")
    result = stored(last.select("n", "held", "far", *(f"k_{i}" for i in range(len(kept)))).mapInArrow(run, schema), "codes")
    remove(raw)
    return result, books


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with the error summed over equal ``k_1``, nulls together."""
    salted = codes.withColumn("salt", F.pmod(F.xxhash64("k_0"), F.lit(SALTS)))
    sums = codes.groupBy(F.col("k_1").alias("label")).agg(F.sum("error").alias("label_error"))
    sums = sums.withColumn("salt_", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(sums, (F.col("salt") == F.col("salt_")) & F.col("k_1").eqNullSafe(F.col("label"))).drop("salt", "salt_", "label")


def op11_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes(read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    text = ",".join(str(x) for book in books for x in book.ravel().tolist())
    return with_label_error(codes).select(
        F.col("k_0").alias("vec_id"),
        F.lower(F.concat_ws("", F.transform("code", lambda c: F.lpad(F.hex(c), 2, "0")))).alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"),
    )


def _sql() -> str:
    """Every part next to every entry, round by round."""
    text = f"""
WITH sound AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
steps AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, x) AS r, vec_id, label, x FROM (
    SELECT vec_id, label, list_transform(embedding, lambda c: greatest(-33554432, least(33554432, floor({SCALE} * CAST(c AS DOUBLE))))) AS x
    FROM sound WHERE len(embedding) = (SELECT max(len(embedding)) FROM sound))),
parts AS MATERIALIZED (
  SELECT r, p, v, list_inner_product(v, v) AS q FROM (
    SELECT r, p, list_transform(range(w), lambda i: coalesce(x[p * w + i + 1], 0e0)) AS v
    FROM (SELECT r, x, (len(x) + {PARTS - 1}) // {PARTS} AS w FROM steps), range({PARTS}) AS t(p))),
book0 AS MATERIALIZED (SELECT p, r - 1 AS j, v, q FROM parts WHERE r <= {ENTRIES})"""
    for k in range(ROUNDS + 1):
        text += f""",
held{k} AS MATERIALIZED (
  SELECT r, p, min({{'d': CAST(a.q + b.q - 2 * list_inner_product(a.v, b.v) AS BIGINT), 'j': j}}) AS m
  FROM parts a JOIN book{k} b USING (p) GROUP BY r, p)"""
        if k < ROUNDS:
            text += f""",
sums{k} AS (
  SELECT p, m.j AS j, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
  FROM parts JOIN held{k} USING (r, p), unnest(range(1, len(v) + 1)) AS t(i) GROUP BY p, m.j, i),
means{k} AS (
  SELECT p, j, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS v FROM sums{k} GROUP BY p, j),
book{k + 1} AS MATERIALIZED (
  SELECT p, j, v, list_inner_product(v, v) AS q FROM (
    SELECT b.p, b.j, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN means{k} m USING (p, j)))"""
    return text + f""",
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', m.j), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM steps JOIN held{ROUNDS} USING (r) GROUP BY r, vec_id, label),
books AS (
  SELECT sha256(string_agg(array_to_string(list_transform(v, lambda c: CAST(CAST(c AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, j)) AS codebooks_sha256
  FROM book{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, books
"""


SQL = _sql()
