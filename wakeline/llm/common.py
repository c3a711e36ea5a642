"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.session import fresh_path, remove, stored

__all__ = ["bounds", "by_batch", "free", "fresh_path", "parts", "read", "release", "remove", "stored", "union_labels"]


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to be no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def bounds(df: DataFrame, column: str, n: int) -> list[int]:
    """Upper ends of ``n`` ranges with about equally many rows; one aggregate over one column."""
    share = [i / n for i in range(1, n)]
    if not share:
        return []
    found = df.agg(F.percentile_approx(F.col(column).cast("long"), share, 100 * n).alias("q")).first()
    return sorted(set(found["q"] or []))


def by_batch(df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], Iterator[dict]]) -> DataFrame:
    """``work`` on each Arrow batch; it yields dictionaries of equally long columns."""
    from pyspark.sql.types import StructType

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for out in work(batch):
                    yield record(out, arrow)
        release()

    return df.mapInArrow(run, schema)


def release() -> None:
    """Give freed memory back at the end of a task: a worker lives on, and the next stage's needs come on top."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def record(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type, from_pandas=False) for f in schema],
        schema=schema,
    )


def longs(column: pa.Array, missing: int = 0) -> np.ndarray:
    """A long column as numpy, whole numbers kept exact."""
    return column.cast(pa.int64()).fill_null(missing).to_numpy(zero_copy_only=False)


def ragged(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Lists cut out of ``values`` at ``offsets``."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def union_labels(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, label): the smallest node reachable over the undirected edges (a, b), for nodes with an edge.

    Alternating large-star and small-star steps: each replaces edges by edges to a smaller neighbour, keeps
    what is connected, and ends in one star per component after a logarithmic number of steps. Each step is
    written down, which cuts the lineage; neighbours are reduced by ``min`` before they are shuffled.
    """
    spark = edges.sparkSession
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = stored(edges, "edges")
    before = None
    for _ in range(most):
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        last, edges = edges, stored(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
        remove(last)
        # The same digest of all edges means that none has changed.
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            )
        before = now
    raise RuntimeError("components did not settle")
