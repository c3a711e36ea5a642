"""One ordered pass that numbers trips and looks around inside them.

Numbering trips, filling a gap from the neighbours in the trip, the change against the row before and the row's place in its trip
all walk along a vessel's rows and start afresh where a trip does. Done one after the other each costs a shuffle of
the rows, a summary and a join. Here a vessel is cut into time slices once. Within a slice, windows see the
segments between breaks; the last row of a slice's first and last segment tells all that the neighbouring slices need:

    number of breaks, first and last known value of each column, the row itself, how many rows

Such states of successive slices combine associatively, so windows over them (two rows a slice) give each slice the
number of the trip that runs into it and, per column, what is known before its first segment and after its last. The rows
are shuffled once, by key and slice, and that partitioning serves the windows, the states and the join.

Read the rows from a table or ``stored()``, with the columns named here only: then the states and the rows share one scan and one shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline import schema
from wakeline.functions.timeops import MICROS, micros
from wakeline.operators.sliced import BEFORE, LAG, NEXT, PREV, SLICE, join_summary, with_slices

_UPTO = (Window.unboundedPreceding, 0)
_EARLIER = (Window.unboundedPreceding, -1)


def segmented_scan(
    df: DataFrame,
    *,
    gap_seconds: int,
    look: Mapping[str, Sequence[str]] | None = None,
    keys: Sequence[str] = ("node_name",),
    ts: str = "ts",
    tie: Sequence[str] = (),
    inclusive: bool = False,
    break_at_midnight: bool = False,
    out: str = "trip_id",
    number: str | None = None,
    total: str | None = None,
    slice_seconds: int = schema.DAY_SECONDS,
) -> DataFrame:
    """``df`` with trips numbered 1, 2, ... as by ``trips.number_trips`` and, inside the trips, ``<column>_<what>`` as by
    ``sliced.look_around``; ``number`` is a row's place in its trip from 1 on, ``total`` the rows of the trip.

    Rows whose key or time is null get no trip; they see their like only.
    """
    look = dict(look or {})
    part = [*keys, SLICE]
    gap = F.lit(gap_seconds * MICROS)
    day = F.lit(float(schema.DAY_SECONDS * MICROS))

    def breaks(now: Column, before: Column) -> Column:
        step = now - before
        far = step >= gap if inclusive else step > gap
        if break_at_midnight:
            far = far | (F.floor(now / day) != F.floor(before / day))
        return F.when(before.isNull(), 0).when(far, 1).otherwise(0)

    in_slice = Window.partitionBy(*part).orderBy(ts, *tie)
    cut = with_slices(df, ts, slice_seconds).withColumn("_us", micros(ts))
    cut = cut.withColumn("_break", breaks(F.col("_us"), F.lag("_us").over(in_slice)))
    cut = cut.withColumn("_seg", F.sum("_break").over(in_slice.rowsBetween(*_UPTO)))
    segment = [*part, "_seg"]
    ahead = Window.partitionBy(*segment).orderBy(ts, *tie)
    back = Window.partitionBy(*segment).orderBy(*(F.desc_nulls_last(c) for c in (ts, *tie)))
    upto, strictly, from_here = ahead.rowsBetween(*_UPTO), ahead.rowsBetween(*_EARLIER), back.rowsBetween(*_UPTO)
    local = {
        "_rn": F.row_number().over(ahead),
        "_inner": F.sum("_break").over(Window.partitionBy(*part)),
        "_left": F.row_number().over(back),
    }
    for c in look:
        local[f"_{c}_prev"] = F.last(c, ignorenulls=True).over(upto)
        local[f"_{c}_next"] = F.last(c, ignorenulls=True).over(from_here)
        if BEFORE in look[c]:
            local[f"_{c}_before"] = F.last(c, ignorenulls=True).over(strictly)
        if LAG in look[c]:
            local[f"_{c}_lag"] = F.lag(c).over(ahead)
    rows = cut.withColumns(local)

    # The last row of a slice's first and last segment. There ``_prev`` is the last known value of the segment; its first known
    # one is that of a running first.
    state = {f"_{c}_first": F.first(c, ignorenulls=True).over(upto) for c in look}
    ends = rows.withColumns({**state, "_start": F.first("_us").over(upto)})
    ends = ends.where((F.col("_left") == 1) & ((F.col("_seg") == 0) | (F.col("_seg") == F.col("_inner"))))
    # Rows without a time are a group of their own; filtered out here only, they would be scanned and shuffled again.
    # All that follows is partitioned by these columns and more, so the states are shuffled once for all windows.
    own = [*keys, "_untimed"]
    ends = ends.withColumn("_untimed", F.col(SLICE).isNull())
    along = Window.partitionBy(*own).orderBy(SLICE, "_seg")
    before = F.lag("_us").over(along)
    opens = F.when(before.isNull(), 1).otherwise(breaks(F.col("_start"), before))
    # Each break inside a slice starts a trip; its last segment's trip comes after as many as there are breaks.
    ends = ends.withColumn("_new", F.when(F.col("_seg") == 0, opens).otherwise(F.col("_inner")))
    ends = ends.withColumn("_trip", F.sum("_new").over(along.rowsBetween(*_UPTO)))
    trip = Window.partitionBy(*own, "_trip").orderBy(SLICE, "_seg")
    earlier = trip.rowsBetween(*_EARLIER)
    later = Window.partitionBy(*own, "_trip").orderBy(F.desc(SLICE), F.desc("_seg")).rowsBetween(*_EARLIER)
    carried = {"_rows_before": F.coalesce(F.sum("_rn").over(earlier), F.lit(0)), "_rows": F.sum("_rn").over(Window.partitionBy(*own, "_trip"))}
    for c in look:
        carried[f"_{c}_back"] = F.last(f"_{c}_prev", ignorenulls=True).over(earlier)
        carried[f"_{c}_ahead"] = F.last(f"_{c}_first", ignorenulls=True).over(later)
        if LAG in look[c]:
            carried[f"_{c}_end"] = F.lag(c).over(trip)
    ends = ends.withColumns(carried)
    pack = F.struct(*(F.col(name) for name in carried))
    per_slice = ends.groupBy(*own, SLICE).agg(
        *(F.max(k).alias(f"_key_{k}") for k in keys),
        F.min("_trip").alias("_base"),
        F.max(F.when(F.col("_seg") == 0, pack)).alias("_into"),
        F.max(F.when(F.col("_seg") > 0, pack)).alias("_out_of"),
    )
    per_slice = per_slice.select(*(f"_key_{k}" for k in keys), F.col(SLICE).alias("_cut"), "_base", "_into", "_out_of")

    joined = join_summary(rows, per_slice, keys, SLICE)
    joined = joined.withColumn("_carry", F.when(F.col("_seg") == 0, F.col("_into")).when(F.col("_seg") == F.col("_inner"), F.col("_out_of")))
    found = [(F.col("_base") + F.col("_seg")).alias(out)]
    first = F.col("_rn") == 1
    for c, kinds in look.items():
        back_value = F.col("_carry")[f"_{c}_back"]
        values = {
            PREV: lambda c=c, b=back_value: F.coalesce(F.col(f"_{c}_prev"), b),
            NEXT: lambda c=c: F.coalesce(F.col(f"_{c}_next"), F.col("_carry")[f"_{c}_ahead"]),
            BEFORE: lambda c=c, b=back_value: F.coalesce(F.col(f"_{c}_before"), b),
            LAG: lambda c=c: F.when(first, F.col("_carry")[f"_{c}_end"]).otherwise(F.col(f"_{c}_lag")),
        }
        found += [values[kind]().alias(f"{c}_{kind}") for kind in kinds]
    known = F.col("_base").isNotNull()
    if number:
        found.append(F.when(known, F.col("_rn") + F.coalesce(F.col("_carry")["_rows_before"], F.lit(0))).alias(number))
    if total:
        here = F.col("_rn") + F.col("_left") - 1
        found.append(F.when(known, F.coalesce(F.col("_carry")["_rows"], here)).alias(total))
    return joined.select(*(c for c in df.columns if c not in (out, number, total)), *found)


def filled_with_deltas(
    df: DataFrame,
    columns: Sequence[str],
    deltas: Sequence[str],
    *,
    default: float = 0.0,
    number: str = "row_no",
    lags: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Trips, columns filled from the next known value of the trip, else the last, else ``default``, and ``<c>_Delta``: the change
    of the filled value against the row before, 0 on a trip's first row. ``lags`` of the columns get that row's filled value as
    ``<c>_lag``, null on a trip's first row. One ``segmented_scan``.

    The filled value of the row before is that row's own, else the next one known (which is also the next known from
    here), else the last one known before.
    """
    look = {c: [PREV, NEXT, *([BEFORE, LAG] if c in deltas or c in lags else [])] for c in columns}
    found = segmented_scan(df, look=look, number=number, **options)
    zero = F.lit(default)

    def filled(c: str) -> Column:
        return F.coalesce(f"{c}_next", f"{c}_prev", zero)

    leads = F.coalesce(F.col(number), F.lit(1)) == 1

    def last(c: str) -> Column:
        return F.coalesce(f"{c}_lag", f"{c}_next", f"{c}_before", zero)

    def change(c: str) -> Column:
        return F.when(leads, 0.0).otherwise(filled(c) - last(c))

    extra = [c for c in found.columns if c not in df.columns and not any(c == f"{x}_{k}" for x in columns for k in look[x])]
    return found.select(
        *(filled(c).alias(c) if c in columns else F.col(c) for c in df.columns),
        *extra,
        *(change(c).alias(f"{c}_Delta") for c in deltas),
        *(F.when(~leads, last(c)).alias(f"{c}_lag") for c in lags),
    )
