"""Whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

With X the centred rows, each step multiplies X by a direction v (a number a row), takes the part along the earlier left
vectors out, multiplies the rest by the transpose, and takes the earlier directions out of that. This gives orthonormal
V and U and a small upper bidiagonal B with X V = U B. The singular values of B give the eigenvalues of the covariance,
its right singular vectors turned by V the components.

A left vector has an entry per row and is never stored: it is X times a combination of the dimensions, which the driver knows, so
a task makes its own rows' entries anew. One pass over the rows yields, for the new left vector, its length, its products with
all earlier ones and its product with the rows. What reorthogonalisation takes off a left vector is known from these
sums and from those of earlier passes; directions are reorthogonalised twice where they are, as they are short.

With as many steps as dimensions (the default) no eigenvector is missed, and repeated eigenvalues are no exception: where the
rows have nothing left along a direction, the next one is taken at random across all earlier ones.

Rows lie in a table of blocks. Sums of tasks are added up by Spark, by their place in the sum; to the driver come (dimensions + steps)
numbers a pass.

Defined cases: see :mod:`wakeline.llm.vectors` for what is kept; components without spread (eigenvalue below 1e-20 of the
trace) are left out, as nothing can be divided by it; a deviation that 64 bits do not hold is null; equal and null ids are rows
like others; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wakeline.llm.common import read, stored
from wakeline.llm.vectors import blocks, longest, unpacked

SCALE, COMPONENTS = 64.0, 32
#: Added to every step; it moves the mean, not the result.
SHIFT = 1_000_000
#: Length of a vector, next to that of all rows, that is rounding only.
NOTHING = 1e-13
#: Vectors turned at once when the result is written out.
ROWS = 1 << 12


@dataclass
class Whitening:
    """``components`` are columns, by falling ``eigenvalues``; ``mean`` counts steps of 1 / ``scale``."""

    n: int
    sums: np.ndarray
    mean: np.ndarray
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float


def summed(table: DataFrame, size: int, dimension: int, work: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum over all blocks of ``work(block)``, ``size`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for n, x in zip(*(c.to_pylist() for c in batch.columns)):
                part = work(unpacked(x, dimension, n))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], ["part"])

    each = table.select("n", "x").mapInArrow(run, f"part array<{kind}>")
    rows = each.select(F.posexplode("part").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(size, np.int64 if kind == "long" else np.float64)
    for at, value in rows:
        out[at] = value
    return out


def without(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """What of ``vector`` is across the orthonormal columns of ``basis``; twice, as once leaves rounding along them."""
    for _ in range(2):
        vector = vector - basis @ (basis.T @ vector)
    return vector


def bidiagonal(table: DataFrame, mean: np.ndarray, norm: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(B, V) of the rows less ``mean``, whose squares add up to the square of ``norm``."""
    d = len(mean)
    chance = np.random.default_rng(13)

    def across(basis: np.ndarray) -> np.ndarray:
        while True:
            v = without(chance.normal(size=d), basis)
            if np.linalg.norm(v) > 1e-3:
                v = without(v / np.linalg.norm(v), basis)
                return v / np.linalg.norm(v)

    right = across(np.zeros((d, 0)))[:, None]
    left, back = np.zeros((d, 0)), np.zeros((d, 0))  # combinations that make the left vectors; their products with the rows
    b = np.zeros((steps, steps))
    for j in range(steps):
        way = right[:, j] - (b[j - 1, j] * left[:, j - 1] if j else 0.0)

        def products(x: np.ndarray, way=way, left=left) -> np.ndarray:
            x = x - mean
            u = x @ way
            return np.concatenate((x.T @ u, (x @ left).T @ u, [u @ u]))

        found = summed(table, d + j + 1, d, products)
        product, along, square = found[:d], found[d : d + j], found[-1]
        # The part along earlier left vectors goes, from the combination and from the sums alike.
        way, product = way - left @ along, product - back @ along
        length = np.sqrt(max(0.0, square - along @ along))
        if length <= NOTHING * norm:  # no row has anything along this direction
            length, way, product = 0.0, np.zeros(d), np.zeros(d)
        else:
            way, product = way / length, product / length
        b[j, j] = length
        left, back = np.column_stack((left, way)), np.column_stack((back, product))
        if j + 1 == steps:
            break
        rest = without(product - length * right[:, j], right)
        size = np.linalg.norm(rest)
        if size <= NOTHING * norm:
            right = np.column_stack((right, across(right)))
        else:
            rest = without(rest / size, right)
            b[j, j + 1] = size
            right = np.column_stack((right, rest / np.linalg.norm(rest)))
    return b, right


def fit(table: DataFrame, dimension: int, components: int = COMPONENTS, steps: int | None = None) -> Whitening:
    """The whitening of the stored blocks; fewer ``steps`` than dimensions give approximate components."""
    sums = summed(table, dimension + 1, dimension, lambda x: np.append(x.sum(0, dtype=np.int64), len(x)), "long")
    n, sums = int(sums[-1]), sums[:-1]
    mean = sums / n
    trace = float(summed(table, 1, dimension, lambda x: np.array([np.square(x - mean).sum()]))[0]) / n
    steps = min(dimension, steps or dimension)
    b, right = bidiagonal(table, mean, float(np.sqrt(n * trace)), steps)
    _, value, turn = np.linalg.svd(b)
    eigenvalues = value**2 / n
    some = np.flatnonzero(eigenvalues > 1e-20 * trace)[:components]
    return Whitening(n, sums, mean, eigenvalues[some], right @ turn.T[:, some], trace)


def identity_error(table: DataFrame, dimension: int, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened rows less the identity."""
    k = len(model.eigenvalues)
    turn = model.components / np.sqrt(model.eigenvalues)

    def moments(x: np.ndarray) -> np.ndarray:
        y = (x - model.mean) @ turn
        return np.concatenate(((y.T @ y).ravel(), y.sum(0)))

    found = summed(table, k * k + k, dimension, moments) / model.n
    covariance = found[: k * k].reshape(k, k) - np.outer(found[k * k :], found[k * k :])
    return float(np.abs(covariance - np.eye(k)).max(initial=0.0))


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exact."""
    far = n * x.astype(np.int64) - sums
    if np.square(far.astype(np.float64)).sum(1).max(initial=0) < 9e18:
        return pa.array(np.square(far).sum(1))
    whole = np.square(far.astype(object)).sum(1)
    return pa.array([v if v < 1 << 63 else None for v in whole], pa.int64())


def whitened_rows(table: DataFrame, dimension: int, model: Whitening) -> DataFrame:
    """(``k_0``, ..., component, deviation, whitened), a row per vector and component."""
    kept = [f for f in table.schema.fields if f.name.startswith("k_")]
    schema = StructType()
    for f in kept:
        schema = schema.add(f.name, f.dataType.elementType)
    schema = StructType(schema.fields + StructType.fromDDL("component int, deviation long, whitened double").fields)
    arrow = to_arrow_schema(schema)
    k = len(model.eigenvalues)
    turn = model.components / np.sqrt(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = [batch.column(2 + c).slice(i, 1).flatten() for c in range(len(kept))]
                x = unpacked(batch.column(1)[i].as_py(), dimension, batch.column(0)[i].as_py())
                for a in range(0, len(x), ROWS):
                    part = x[a : a + ROWS]
                    which = pa.array(np.repeat(np.arange(len(part)), k))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(o.slice(a, len(part)).take(which) for o in own),
                            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                            deviations(part, model.n, model.sums).take(which),
                            pa.array(((part - model.mean) @ turn).ravel()),
                        ],
                        schema=arrow,
                    )

    return table.select("n", "x", *(f.name for f in kept)).mapInArrow(run, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = stored(blocks(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", ["vec_id"], SCALE), "vectors")
    dimension = longest(table)
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not dimension:
        return spark.createDataFrame([], out)
    table = table.where(F.col("d") == dimension)
    model = fit(table, dimension)
    share = F.array(*(F.lit(float(e / model.trace)) for e in model.eigenvalues)) if len(model.eigenvalues) else F.lit(None)
    return whitened_rows(table, dimension, model).select(
        F.col("k_0").alias("vec_id"),
        "component",
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        (F.element_at(share, F.col("component")) if len(model.eigenvalues) else F.lit(None)).cast("double").alias("explained"),
        F.lit(identity_error(table, dimension, model)).alias("identity_error"),
    )
