"""Order statistics per key by refinement of the number's digits: no sort of a key, and no task that ranks more than a few
thousand rows, whatever share of them one key holds.

A double falls into ever finer cells: first its binary exponent with the first ten bits of its fraction, then thirteen bits more, then
thirteen more, then the number itself. Cells follow each other as numbers do. Rows per cell are counted at all four
depths (equal numbers meet on the map side), and a rank goes down from cell to cell: at each depth only the cells inside the chosen
one are added up, 2^13 at most, and at the last depth the numbers that agree in the first 36 bits, 2^16 at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.session import stored

#: Bits of the fraction in the first cell, and further ones in each next cell.
FIRST, NEXT = 10, 13
CELLS = ("_d1", "_d2", "_d3")


def digits(value: Column) -> list[Column]:
    """The cell of a double at each depth; monotone in the double, given the cells before.

    The exponent comes from a logarithm, which is off by one next to powers of two at most and monotone all the same;
    scaling by powers of two is exact.
    """
    size = F.abs(value)
    tiny = size < F.lit(2.0**-900)
    exponent = F.when(tiny, F.lit(-901.0)).otherwise(F.floor(F.log2(size)).cast("double"))
    # Two steps, as the power for a large exponent alone would leave the range of doubles.
    half = F.floor(exponent / 2)
    scaled = value * F.pow(F.lit(2.0), -half) * F.pow(F.lit(2.0), half - exponent)
    place = F.when(value < 0, -(exponent + 902.0)).otherwise(exponent + 902.0)
    fraction = scaled * F.lit(2.0**FIRST)
    first = F.floor(fraction)
    rest = (fraction - first) * F.lit(2.0**NEXT)
    second = F.floor(rest)
    third = F.floor((rest - second) * F.lit(2.0**NEXT))
    whole = (place * F.lit(2.0 ** (FIRST + 3)) + first).cast("long")
    none = F.lit(0).cast("long")
    zero = value == 0
    return [F.when(zero, none).otherwise(whole), F.when(zero, none).otherwise(second.cast("long")), F.when(zero, none).otherwise(third.cast("long"))]


def at_ranks(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str], ranks: dict[str, Column]) -> DataFrame:
    """Per key and column (``_c``) the number at each rank, as columns named like ``ranks``: expressions of ``_total``, from 1 on.

    Nulls and NaN do not count.
    """
    long = df.select(*keys, *(F.col(c).cast("double").alias(c) for c in columns)).unpivot(list(keys), list(columns), "_c", "_v")
    group = [*keys, "_c"]
    counts = long.where("_v is not null and not isnan(_v)").groupBy(*group, (F.col("_v") + F.lit(0.0)).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    depth = dict(zip(CELLS, digits(F.col("_v"))))
    leaves = stored(counts.withColumns(depth), "numbers")
    # All coarser counts from one expansion; the finest grouping has no more rows than there are numbers.
    tree = leaves.groupingSets(
        [[F.col(c) for c in [*group, *CELLS[:k]]] for k in (1, 2, 3)], *group, *CELLS
    ).agg(F.sum("_n").alias("_n"), F.grouping_id().alias("_level"))
    tree = stored(tree, "cells")
    top = {0: 3, 1: 2, 3: 1}  # absent cells, as bits, to depth

    def level(k: int) -> DataFrame:
        bits = next(b for b, d in top.items() if d == k)
        return tree.where(F.col("_level") == bits).select(*group, *CELLS[:k], "_n")

    # The first depth has a row per exponent and first bits of a key's numbers.
    first = level(1).withColumn("_total", F.sum("_n").over(Window.partitionBy(*group)))
    wanted = F.array(*(F.struct(F.lit(name).alias("which"), rank.cast("long").alias("rank")) for name, rank in ranks.items()))
    rows = first.withColumn("_w", F.explode(wanted)).select(*group, "_d1", "_n", F.col("_w.which").alias("_which"), F.col("_w.rank").alias("_rank"))
    chosen = _chosen(rows, [*group, "_which"], "_d1")
    for k in (2, 3):
        inside = level(k).join(chosen, [*group, *CELLS[: k - 1]])
        chosen = _chosen(inside, [*group, *CELLS[: k - 1], "_which"], CELLS[k - 1])
    last = _chosen(leaves.join(chosen, [*group, *CELLS]), [*group, *CELLS, "_which"], "_v")
    return last.groupBy(*group).agg(*(F.max(F.when(F.col("_which") == name, F.col("_v"))).alias(name) for name in ranks))


def _chosen(rows: DataFrame, part: Sequence[str], by: str) -> DataFrame:
    """Of each part the cell that holds the rank, and the rank within it."""
    upto = F.sum("_n").over(Window.partitionBy(*part).orderBy(by).rowsBetween(Window.unboundedPreceding, 0))
    found = rows.withColumn("_upto", upto).where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank")))
    return found.select(*part, by, (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank"))


def medians(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str]) -> DataFrame:
    """Exact median of each column per key; null where a key has no number in the column."""
    ranks = {"_low": F.floor((F.col("_total") + 1) / 2), "_high": F.floor(F.col("_total") / 2) + 1}
    found = at_ranks(df, columns, keys=keys, ranks=ranks).withColumn("_m", (F.col("_low") + F.col("_high")) / 2)
    return found.groupBy(*keys).agg(*(F.max(F.when(F.col("_c") == c, F.col("_m"))).alias(c) for c in columns))


def quantiles(df: DataFrame, column: str, shares: Sequence[float], *, keys: Sequence[str]) -> DataFrame:
    """Per key the smallest number that at least each share of the numbers does not exceed: ``q0``, ``q1``, ..."""
    ranks = {f"q{i}": F.greatest(F.ceil(F.col("_total") * F.lit(float(s))), F.lit(1)) for i, s in enumerate(shares)}
    return at_ranks(df, [column], keys=keys, ranks=ranks).drop("_c")
