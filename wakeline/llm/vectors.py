"""Vectors as blocks of rows: whole numbers in one binary column, so that an iterative job reads a matrix at a time.

A row is kept if its vector is not null, not empty, has no null or non-finite component, and is as long as the longest
such vector (a shorter one lacks components, which counts as null ones). Components are cut to whole numbers of steps
by ``floor(scale * x)``, and held within ``-LARGEST .. LARGEST``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructField, StructType

#: Components of a block at most: 4 to 16 MB of numbers.
CELLS = 1 << 21
#: Steps beyond which a component is held; sums of squares over a thousand dimensions still fit in 64 bits.
LARGEST = 1 << 25


def packed(matrix: np.ndarray) -> bytes:
    """The numbers in the fewest of 1, 2, 4 or 8 bytes each that hold them all."""
    low, high = (int(matrix.min()), int(matrix.max())) if matrix.size else (0, 0)
    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return matrix.astype(kind).tobytes()


def unpacked(data: bytes, dimension: int, rows: int) -> np.ndarray:
    kind = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}[len(data) // (dimension * rows)]
    return np.frombuffer(data, kind).reshape(rows, dimension)


def whole_numbers(column: pa.Array, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of steps) of the vectors without a fault, for each length among them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    lists = column.take(pa.array(there))
    values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null becomes NaN
    length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) if len(there) else there
    begin = np.cumsum(length) - length
    for d in np.unique(length[length > 0]).tolist():
        at = np.flatnonzero(length == d)
        matrix = values[begin[at][:, None] + np.arange(d)]
        sound = np.isfinite(matrix).all(axis=1)
        if sound.any():
            steps = np.clip(np.floor(matrix[sound] * scale), -LARGEST, LARGEST)
            yield there[at[sound]], steps.astype(np.int64)


def block_schema(df: DataFrame, kept: list[str], more: str = "") -> StructType:
    """``d``, ``n``, ``x`` and an array per kept column, nulls in it included; then further columns by DDL."""
    fields = list(StructType.fromDDL("d int, n int, x binary").fields)
    fields += [StructField(f"k_{i}", ArrayType(df.schema[c].dataType)) for i, c in enumerate(kept)]
    return StructType(fields + (list(StructType.fromDDL(more).fields) if more else []))


def blocks(df: DataFrame, vector: str, kept: list[str], scale: float) -> DataFrame:
    """Blocks of the vectors of ``df`` with the columns named in ``kept`` as ``k_0``, ``k_1``, ..."""
    schema = block_schema(df, kept)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in whole_numbers(batch.column(0), scale):
                d = matrix.shape[1]
                step = max(1, CELLS // d)
                for i in range(0, len(at), step):
                    rows = pa.array(at[i : i + step])
                    own = [listed(batch.column(1 + c).take(rows)) for c in range(len(kept))]
                    part = matrix[i : i + step]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([d], pa.int32()), pa.array([len(part)], pa.int32()), pa.array([packed(part)], pa.binary())]
                        + [pa.array(o, f.type) if not isinstance(o, pa.Array) else o.cast(f.type) for o, f in zip(own, list(arrow)[3:])],
                        schema=arrow,
                    )

    # Positions, not names, reach the task: a column of df may have any name.
    columns = [F.col(f"`{vector}`").alias("v"), *(F.col(f"`{c}`").alias(f"k_{i}") for i, c in enumerate(kept))]
    return df.select(*columns).mapInArrow(run, schema)


def listed(values: pa.Array) -> pa.Array:
    """One list of all the values."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def longest(stored_blocks: DataFrame) -> int:
    """The dimension: 0 without a block."""
    return stored_blocks.agg(F.max("d")).first()[0] or 0
