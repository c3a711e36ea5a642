"""Joins that survive a key holding a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import schema
from wakeline.functions.timeops import MICROS, col, micros
from wakeline.operators.sliced import look_around
from wakeline.session import stored

_SALT = "_salt"


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    salts: int = 16,
) -> DataFrame:
    """Equi-join of many rows to a table with few rows per key.

    Rows of one key are spread over ``salts`` parts by a hash of ``spread_by``;
    the lookup is repeated once per salt. Works for inner, left, semi and anti.
    As the salt is part of the join key, whatever follows on ``keys`` shuffles
    anyway, so adaptive execution remains free to split a part that is still large.
    """
    salted = rows.withColumn(
        _SALT, F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    )
    copies = lookup.withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return salted.join(copies, [*keys, _SALT], how).drop(_SALT)


#: A node of the interval tree has so many children.
FAN = 8
#: Depth of the tree: more than any span of time has buckets of a microsecond.
DEPTH = 21


def interval_nodes(first: Column, last: Column) -> Column:
    """The canonical nodes (level, node) of a tree over whole-numbered buckets that make up ``first`` to ``last``.

    At each level what sticks out beyond whole nodes of the next one is taken; at most ``2 (FAN - 1)`` nodes a level, so
    an interval has as many as the logarithm of its length asks for.
    """
    long = "long"

    def step(state: Column, level: Column) -> Column:
        low, high = state["low"], state["high"]
        up, down = F.ceil(low / FAN).cast(long), F.floor(high / FAN).cast(long)
        # No whole node of the next level inside: all that is left is taken here.
        ends = up >= down
        left_to, right_from = F.when(ends, high).otherwise(up * FAN), F.when(ends, high).otherwise(down * FAN)
        taken = F.concat(_range(low, left_to), _range(right_from, high))
        nodes = F.concat(state["nodes"], F.transform(taken, lambda n: F.struct(level.cast("int").alias("level"), n.alias("node"))))
        done = low >= high
        return F.struct(
            F.when(done | ends, high).otherwise(up).alias("low"),
            F.when(done | ends, high).otherwise(down).alias("high"),
            F.when(done, state["nodes"]).otherwise(nodes).alias("nodes"),
        )

    empty = F.array().cast("array<struct<level:int,node:bigint>>")
    start = F.struct(first.cast(long).alias("low"), (last + 1).cast(long).alias("high"), empty.alias("nodes"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(DEPTH)), start, step, lambda s: s["nodes"])


def _range(low: Column, high: Column) -> Column:
    """low .. high - 1 as an array, empty where that is nothing."""
    return F.when(high > low, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))


def in_interval(
    rows: DataFrame,
    intervals: DataFrame,
    *,
    key: str = "node_name",
    ts: str = "time",
    start: str = "start",
    stop: str = "stop",
    bucket_seconds: int = schema.DAY_SECONDS,
) -> DataFrame:
    """Rows inside an interval of the same key, both ends included.

    Buckets of time are the leaves of a tree with eight children to a node. An interval is cut into the nodes that make it up, a
    number that grows with the logarithm of its length, and a row looks for the one node of each level that holds it, which
    turns the range test into an equi-join on ``(key, level, node)`` plus a residual comparison. Rows look on those levels only
    that intervals use; for intervals of hours or days that is one. The cut intervals are stored.
    """
    width = F.lit(float(bucket_seconds * MICROS))
    first, last = F.floor(micros(start) / width), F.floor(micros(stop) / width)
    spans = intervals.filter(col(stop) >= col(start)).withColumn("_node", F.explode(interval_nodes(first, last)))
    spans = stored(spans.select(*intervals.columns, "_node.level", "_node.node"), "intervals")
    spans = spans.withColumnsRenamed({"level": "_level", "node": "_node"})
    used = sorted(r["_level"] for r in spans.select("_level").distinct().collect())  # DEPTH + 1 at most
    bucket = F.floor(micros(ts) / width)
    nodes = F.array(*(F.struct(F.lit(k).alias("level"), F.floor(bucket / float(FAN**k)).cast("long").alias("node")) for k in used or [0]))
    placed = rows.withColumn("_at", nodes[0]) if len(used) < 2 else rows.withColumn("_at", F.explode(nodes))
    placed = placed.select(*rows.columns, F.col("_at.level").alias("_level"), F.col("_at.node").alias("_node"))
    hit = placed.join(spans, [key, "_level", "_node"], "inner")
    return hit.filter((col(ts) >= col(start)) & (col(ts) <= col(stop))).drop("_level", "_node")


def nearest_in_time(
    rows: DataFrame,
    readings: DataFrame,
    *,
    key: str,
    ts: str,
    reading_ts: str,
    tolerance_seconds: int = schema.WEATHER_TOLERANCE_SECONDS,
    slice_seconds: int = schema.DAY_SECONDS,
) -> DataFrame:
    """Left join of each row to the reading closest in time within the tolerance.

    For readings on no fixed grid. Rows and readings are put in one time order
    and every row looks at the reading before and the one after it, so the work
    does not grow with how many readings lie in reach. Of two equally close
    readings the later wins, of several at one instant the smallest.
    """
    payload = [c for c in readings.columns if c not in (key, reading_ts)]
    unique = readings.groupBy(key, reading_ts).agg(
        F.min(F.struct(*(F.col(c) for c in payload), F.lit(1).alias("_there"))).alias("_r")
    )
    marks = unique.select(
        key,
        F.col(reading_ts).alias("_t"),
        F.lit(0).alias("_is_row"),
        F.struct(F.col(reading_ts).alias("at"), F.col("_r").alias("data")).alias("_reading"),
    )
    both = rows.withColumns({"_t": F.col(ts), "_is_row": F.lit(1)}).unionByName(
        marks, allowMissingColumns=True
    )
    found = look_around(
        both, {"_reading": ["prev", "next"]}, [key], "_t", ["_is_row"], slice_seconds=slice_seconds
    ).filter("_is_row = 1")
    reach = F.lit(tolerance_seconds * MICROS)
    back = micros("_t") - micros("_reading_prev.at")
    ahead = micros("_reading_next.at") - micros("_t")
    before = F.when(back <= reach, F.col("_reading_prev"))
    after = F.when((ahead <= reach) & (before.isNull() | (ahead <= back)), F.col("_reading_next"))
    picked = found.withColumn("_best", F.coalesce(after, before))
    return picked.select(
        *rows.columns,
        F.col("_best.at").alias(reading_ts),
        *(F.col(f"_best.data.{c}").alias(c) for c in payload),
    )


def matched(rows: DataFrame, ids: DataFrame, keys: Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    """Rows whose key is listed."""
    return salted_join(rows, ids.select(*keys).distinct(), keys, spread_by, "left_semi")


def unmatched(rows: DataFrame, ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not listed; an empty list keeps all.

    Neither side is copied: keys are made distinct first, and adaptive execution splits what is skewed.
    """
    return rows.join(ids.select(*keys).distinct(), list(keys), "left_anti")


def marked(rows: DataFrame, ids: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows with a boolean column: is the key listed? One join of the rows, where two selections would take two."""
    listed = ids.select(*keys).distinct().withColumn(name, F.lit(True))
    return rows.join(listed, list(keys), "left").withColumn(name, F.coalesce(name, F.lit(False)))


def rename_clashes(
    left: DataFrame, right: DataFrame, keys: Sequence[str], suffixes: tuple[str, str]
) -> tuple[DataFrame, DataFrame]:
    """Suffix the columns both sides hold besides the keys."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    return (
        left.withColumnsRenamed({c: c + suffixes[0] for c in shared}),
        right.withColumnsRenamed({c: c + suffixes[1] for c in shared}),
    )


def column_or_null(df: DataFrame, name: str) -> Column:
    return col(name) if name in df.columns else F.lit(None).cast("double")
