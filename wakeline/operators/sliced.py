"""Ordered operators that never put one whole key into one task.

A window over a vessel, a trip or a side would process all its rows in a single
task, and one vessel may own a third of the data. Every operator here therefore
cuts a key into time slices, works inside ``(key, slice)``, reduces each slice
to one summary row, carries state across the summaries, and joins the carry back
on the same ``(key, slice)`` the rows are already partitioned by. The rows are
shuffled once; the summaries number one per key and slice.

The summary and the rows are two reads of the input. Feed these operators a
table, or ``stored()`` what is costly to compute.

Rows whose key or time is null belong to no sequence: they are kept, and get
null from the operators that number rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline import schema
from wakeline.functions.timeops import MICROS, micros

SLICE = "_slice"
_ALL = (Window.unboundedPreceding, Window.unboundedFollowing)
_UPTO = (Window.unboundedPreceding, 0)


def _descending(keys: Sequence[str], order: Sequence[str]):
    """Reverse window. Looking ahead as "up to here" in reverse order takes one
    pass; a frame that ends at unbounded following restarts at every row."""
    return Window.partitionBy(*keys).orderBy(*(F.desc_nulls_last(c) for c in order))


def slice_number(ts: str | Column, slice_seconds: int) -> Column:
    return F.floor(micros(ts) / F.lit(float(slice_seconds * MICROS)))


def over_slices(keys: Sequence[str], cut: str):
    """Window over the summaries of a key. Untimed rows form a group of their own.

    Filtering them out instead would push a filter into this branch only, and the
    rows would be scanned and shuffled a second time.
    """
    return Window.partitionBy(*keys, F.col(cut).isNull()).orderBy(cut)


def key_copies(keys: Sequence[str]) -> list[Column]:
    """The keys of a summary row once more, as aggregates.

    Joined on these instead of the keys, the summary side gets no "key is not
    null" filter pushed into its scan, so both sides can share one shuffle.
    """
    return [F.max(k).alias(f"_key_{k}") for k in keys]


def join_summary(rows: DataFrame, summary: DataFrame, keys: Sequence[str], cut: str) -> DataFrame:
    """Left join of rows to ``summary``, which holds ``key_copies`` and the slice as ``_cut``."""
    same = [F.col(k) == F.col(f"_key_{k}") for k in keys]
    return rows.join(summary, [*same, F.col(cut) == F.col("_cut")], "left")


def with_slices(df: DataFrame, ts: str, slice_seconds: int = schema.DAY_SECONDS) -> DataFrame:
    return df.withColumn(SLICE, slice_number(ts, slice_seconds))


# What can be looked up from a row, and the suffix of the resulting column.
PREV, NEXT, BEFORE, LAG = "prev", "next", "before", "lag"


def look_around(
    df: DataFrame,
    wanted: Mapping[str, Sequence[str]],
    keys: Sequence[str],
    ts: str,
    tie: Sequence[str] = (),
    *,
    slice_seconds: int | None = schema.DAY_SECONDS,
) -> DataFrame:
    """Values around each row of a key, all in one pass. ``wanted`` maps columns to

    ``prev``    nearest non-null value at or before the row
    ``next``    nearest non-null value at or after it
    ``before``  nearest non-null value strictly before it
    ``lag``     the preceding row's value, null or not

    and the results are named ``<column>_<what>``. ``slice_seconds=None`` uses
    plain windows, for keys bounded by construction (trips that end at midnight).
    """
    whole = slice_seconds is None
    part = [*keys] if whole else [*keys, SLICE]
    inside = Window.partitionBy(*part).orderBy(ts, *tie)
    reverse = _descending(part, [ts, *tie])
    upto, strictly = inside.rowsBetween(*_UPTO), inside.rowsBetween(Window.unboundedPreceding, -1)
    local = {}
    for c, kinds in wanted.items():
        if PREV in kinds:
            local[f"{c}_prev"] = F.last(c, ignorenulls=True).over(upto)
        if NEXT in kinds:
            local[f"{c}_next"] = F.last(c, ignorenulls=True).over(reverse.rowsBetween(*_UPTO))
        if BEFORE in kinds:
            local[f"{c}_before"] = F.last(c, ignorenulls=True).over(strictly)
        if LAG in kinds:
            local[f"{c}_lag"] = F.lag(c).over(inside)
    if whole:
        return df.withColumns(local)

    ends = {}
    for c, kinds in wanted.items():
        if PREV in kinds or BEFORE in kinds:
            ends[f"_{c}_last"] = F.last(c, ignorenulls=True).over(inside.rowsBetween(*_ALL))
        if NEXT in kinds:
            ends[f"_{c}_first"] = F.first(c, ignorenulls=True).over(inside.rowsBetween(*_ALL))
        if LAG in kinds:
            ends[f"_{c}_end"] = F.last(c).over(inside.rowsBetween(*_ALL))
    sliced = with_slices(df, ts, slice_seconds)
    summary = (
        sliced.select(*part, *(e.alias(name) for name, e in ends.items()))
        .groupBy(*part)
        .agg(*key_copies(keys), *(F.first(name).alias(name) for name in ends))
    )
    across = over_slices(keys, SLICE)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    later = across.orderBy(F.desc(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    carry = {}
    for name in ends:
        if name.endswith("_last"):
            carry[name + "_in"] = F.last(name, ignorenulls=True).over(earlier)
        elif name.endswith("_first"):
            carry[name + "_in"] = F.last(name, ignorenulls=True).over(later)
        else:
            carry[name + "_in"] = F.lag(name).over(across)
    copies = [f"_key_{k}" for k in keys]
    carried = summary.select(
        *copies, F.col(SLICE).alias("_cut"), *(e.alias(n) for n, e in carry.items())
    )

    needs_position = any(LAG in kinds for kinds in wanted.values())
    position = {"_rn": F.row_number().over(inside)} if needs_position else {}
    joined = join_summary(sliced.withColumns({**local, **position}), carried, keys, SLICE)
    out = []
    for c, kinds in wanted.items():
        if PREV in kinds:
            out.append(F.coalesce(f"{c}_prev", f"_{c}_last_in").alias(f"{c}_prev"))
        if NEXT in kinds:
            out.append(F.coalesce(f"{c}_next", f"_{c}_first_in").alias(f"{c}_next"))
        if BEFORE in kinds:
            out.append(F.coalesce(f"{c}_before", f"_{c}_last_in").alias(f"{c}_before"))
        if LAG in kinds:
            first = F.col("_rn") == 1
            out.append(F.when(first, F.col(f"_{c}_end_in")).otherwise(F.col(f"{c}_lag")).alias(f"{c}_lag"))
    return joined.select(*df.columns, *out)


def previous_row(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    ts: str,
    tie: Sequence[str] = (),
    *,
    slice_seconds: int | None = schema.DAY_SECONDS,
) -> DataFrame:
    """``<c>_lag``: the value of the preceding row of the key, null on its first row."""
    return look_around(df, {c: [LAG] for c in columns}, keys, ts, tie, slice_seconds=slice_seconds)


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: Sequence[str] = (),
    *,
    number: str = "row_no",
    total: str | None = None,
    slice_seconds: int = schema.DAY_SECONDS,
) -> DataFrame:
    """1-based position of each row in its key and, on request, the size of the key."""
    part = [*keys, SLICE]
    sliced = with_slices(df, ts, slice_seconds)
    inside = Window.partitionBy(*part).orderBy(ts, *tie)
    across = over_slices(keys, SLICE)
    counts = sliced.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(across.rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(
        *part,
        F.coalesce(before, F.lit(0)).alias("_before"),
        *([F.sum("_n").over(across.rowsBetween(*_ALL)).alias(total)] if total else []),
    )
    joined = sliced.withColumn("_rn", F.row_number().over(inside)).join(offsets, part, "left")
    return joined.select(
        *df.columns,
        (F.col("_before") + F.col("_rn")).alias(number),
        *([total] if total else []),
    )


def rolling_mean(
    df: DataFrame,
    value: str,
    rows: int,
    keys: Sequence[str],
    ts: str,
    tie: Sequence[str] = (),
    *,
    out: str | None = None,
    block_rows: int = 65536,
    slice_seconds: int = schema.DAY_SECONDS,
) -> DataFrame:
    """Mean of the last ``rows`` rows; null until there are that many or if one is null.

    Rows are numbered, cut into equal blocks, and the last ``rows - 1`` rows of a
    block are copied into the next, so each block is complete on its own.
    """
    out = out or value
    block = max(block_rows, rows)
    numbered = row_numbers(df, keys, ts, tie, number="_no", slice_seconds=slice_seconds)
    at = F.col("_no") - 1
    own = F.floor(at / block)
    spills = F.pmod(at, F.lit(block)) >= block - (rows - 1)
    spread = numbered.withColumn(
        "_block", F.explode(F.when(spills, F.array(own, own + 1)).otherwise(F.array(own)))
    ).withColumn("_home", F.col("_block").eqNullSafe(own))
    frame = Window.partitionBy(*keys, "_block").orderBy("_no").rowsBetween(-(rows - 1), 0)
    full = F.col("_no").isNotNull() & (F.count(value).over(frame) == rows)
    mean = F.when(full, F.avg(value).over(frame))
    return (
        spread.withColumn("_mean", mean)
        .filter("_home")
        .select(*(c for c in df.columns if c != out), F.col("_mean").alias(out))
    )
