"""Documents dealt to shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has many points on a ring of 60-bit numbers, and so has every document one, by its id. A document belongs to
the next point clockwise, and to that point's shard unless the shard is full; then it goes on clockwise to the next point whose
shard is not. Capacities bound the load: without slack they add up to the number of documents, so every shard is
filled to its capacity and counts are at most one apart; with some slack fewer documents overflow.

Full shards are found from counts alone. All documents on the arc before a point wait at that point. In a round each shard
that is not full takes its waiting documents, in the order of the arcs' starts and of the documents' keys within an arc,
until it is full; what is left waits at the next point clockwise of a shard with room. A round places everything or
fills a shard, so there are at most as many rounds as shards, on as many numbers as the ring has points. The outcome is a list
of rank ranges of arcs, each with its shard, that does not grow with the documents.

Ranks within an arc: documents alike in id and text are counted first (a group of them takes successive ranks), groups are
counted by (arc, chunk of the key), the counts are summed up, and only groups of one chunk are ranked together. So neither
a hot id nor a hot text meets in one task. An id that moves keeps its place on the ring: another shard, or documents that come
and go, move the neighbouring arcs' documents and the overflow only.

Defined cases: a null id takes its place by its text (all null ids would be on one arc otherwise); a null text has no bytes and
differs from an empty one; equal rows are dealt one by one; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.llm.common import read, stored

SHARDS = 16
#: Points of a shard on the ring.
POINTS = 1024
#: Hexadecimal digits of a place on the ring: 60 bits.
PLACE = 15
SEED = "ring-1"
#: Ranges of arcs that are sent to every executor; there are as many as points, and one more for every full shard.
SMALL = 1 << 16


def ring(shards: int, points: int = POINTS, seed: str = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Places of all points, ascending, and their shards. A shard's points do not depend on how many shards there are."""
    at = [(int(hashlib.md5(f"{seed}/{s}/{i}".encode()).hexdigest()[:PLACE], 16), s) for s in range(shards) for i in range(points)]
    places, owner = zip(*sorted(at))
    return np.array(places, np.int64), np.array(owner, np.int64)


def capacities(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """Without slack the documents shared out evenly, one more to the first shards; else that much more for all."""
    if slack <= 0:
        return [total // shards + (s < total % shards) for s in range(shards)]
    return [-int(-(1 + slack) * total // shards)] * shards


def settled(waiting: dict[int, int], owner: np.ndarray, room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, rank after the last, shard, first slot) of where the documents of each arc end up."""
    points, room, filled = len(owner), list(room), [0] * len(room)
    # (point, arc, from, to): documents of an arc that wait at a point.
    queue = [(arc, arc, 0, n) for arc, n in sorted(waiting.items()) if n]
    out = []
    while queue:
        left = []
        for point, arc, low, high in sorted(queue, key=lambda q: (q[1], q[2])):
            shard = int(owner[point])
            take = min(room[shard], high - low)
            if take:
                out.append((arc, low, low + take, shard, filled[shard]))
                room[shard] -= take
                filled[shard] += take
            if low + take < high:
                left.append((point, arc, low + take, high))
        if not left:
            break
        # The next point clockwise with room, from each point, by one sweep against the clock.
        follow, found = np.empty(points, np.int64), -1
        for i in range(2 * points - 1, -1, -1):
            if i < points:
                follow[i] = found
            if room[int(owner[i % points])]:
                found = i % points
        if found < 0:
            raise ValueError("the shards have less room than there are documents")
        queue = [(int(follow[point]), arc, low, high) for point, arc, low, high in left]
    return out


def arc_of(place: Column, places: np.ndarray) -> Column:
    """The number of the first point at or after a place; past the last one it is point 0."""

    @F.pandas_udf("int")
    def find(values: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(places, values.to_numpy(np.int64)) % len(places)).astype(np.int32))

    return find(place)


def placed(groups: DataFrame, shards: int = SHARDS, points: int = POINTS, slack: float = 0.0, seed: str = SEED) -> DataFrame:
    """Of groups (``place`` on the ring, ``key`` of 32 hexadecimal digits that no other group has, ``n`` documents, ...):
    ``shard``, ``low`` and ``high``, the first and last slot there; a group cut by a full shard comes more than once.
    """
    spark = groups.sparkSession
    places, owner = ring(shards, points, seed)
    rows = stored(groups.withColumns({"arc": arc_of(F.col("place"), places), "chunk": F.substring("key", 1, 1)}), "ring")
    chunks = rows.groupBy("arc", "chunk").agg(F.sum("n").alias("n"))
    counts = chunks.groupBy("arc").agg(F.sum("n").alias("n")).collect()  # a row a point of the ring, at most
    waiting = {r["arc"]: r["n"] for r in counts}
    ranges = settled(waiting, owner, capacities(sum(waiting.values()), shards, slack))
    table = spark.createDataFrame(ranges, "arc_ int, from_ long, to_ long, shard int, slot_ long")
    if len(ranges) <= SMALL:
        table = F.broadcast(table)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("arc").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = chunks.select(F.col("arc").alias("arc_"), F.col("chunk").alias("chunk_"), before.alias("before_"))
    rows = rows.join(starts, (F.col("arc") == F.col("arc_")) & (F.col("chunk") == F.col("chunk_"))).drop("arc_", "chunk_")
    within = F.sum("n").over(Window.partitionBy("arc", "chunk").orderBy("key").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("rank_", F.col("before_") + F.coalesce(within, F.lit(0)))
    rows = rows.join(table, (F.col("arc") == F.col("arc_")) & (F.col("rank_") < F.col("to_")) & (F.col("rank_") + F.col("n") > F.col("from_")))
    low, high = F.greatest("rank_", "from_"), F.least(F.col("rank_") + F.col("n"), F.col("to_"))
    rows = rows.withColumns({"low": F.col("slot_") + low - F.col("from_"), "high": F.col("slot_") + high - F.col("from_") - 1})
    return rows.select(*groups.columns, "shard", "low", "high")


def place_and_key(name: Column, text_digest: Column, seed: str = SEED) -> tuple[Column, Column]:
    """A document's place on the ring, and a key that orders an arc."""
    own = F.coalesce(name.cast("string"), F.concat(F.lit("null:"), text_digest))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), own))
    return F.conv(F.substring(digest, 1, PLACE), 16, 10).cast("long"), F.md5(F.concat(own, F.lit("|"), text_digest))


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, points: int = POINTS, slack: float = 0.0, seed: str = SEED, id_column: str = "doc_id"
) -> DataFrame:
    """The rows of ``docs`` with ``__shard`` and ``__slot``, gapless from 0 in each shard.

    Wholly equal rows are kept once with their number, as long as they travel.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    digest = F.md5(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}))
    place, key = place_and_key(F.col(names[docs.columns.index(id_column)]), F.col("__digest"), seed)
    plain = plain.withColumn("__digest", digest).withColumns({"place": place, "key": key})
    pieces = placed(plain.groupBy("place", "key").agg(F.count("*").alias("n")), shards, points, slack, seed)
    one = plain.dropDuplicates(["key"]).select(F.struct(*names).alias("row"), F.col("key").alias("key_"))
    whole = one.join(pieces, F.col("key_") == F.col("key")).withColumn("__slot", F.explode(F.sequence("low", "high")))
    back = (F.col(f"row.{n}").alias(c) for n, c in zip(names, docs.columns))
    return whole.select(*back, F.col("shard").alias("__shard"), "__slot")


def write_shards(docs: DataFrame, folder: str, **options) -> None:
    """A Parquet folder per shard, its rows in the order of their slots and cut into files by ranges of slots."""
    rows = shard_documents(docs, **options)
    rows.repartitionByRange("__shard", "__slot").sortWithinPartitions("__shard", "__slot").write.partitionBy("__shard").parquet(folder)


def op12_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    digest = F.coalesce(F.md5("text"), F.lit("null"))
    place, key = place_and_key(F.col("doc_id"), digest)
    size = F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long")) + 1
    rows = docs.select("doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), place.alias("place"), key.alias("key"))
    groups = rows.groupBy("place", "key").agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("doc_id", "size", "text_crc32")))
    return placed(groups).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.explode(F.sequence("low", "high")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
