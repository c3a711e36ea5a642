"""Trips: numbering by gaps, endpoints, padded intervals, duration filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline import schema
from wakeline.functions.timeops import MICROS, col, micros, minutes_between, shift
from wakeline.operators.joins import salted_join
from wakeline.operators.sliced import SLICE, join_summary, key_copies, over_slices, with_slices


def number_trips(
    df: DataFrame,
    *,
    gap_seconds: int,
    keys: Sequence[str] = ("node_name",),
    ts: str = "time",
    tie: Sequence[str] = (),
    inclusive: bool = False,
    break_at_midnight: bool = False,
    out: str = "trip_id",
    slice_seconds: int = schema.DAY_SECONDS,
    slice_column: str | None = None,
) -> DataFrame:
    """Number the trips of each key 1, 2, ...; a new one starts after a gap.

    The gap test is ``>`` or, with ``inclusive``, ``>=``. Breaks inside a slice
    come from a window over ``(key, slice)``; whether a slice itself opens a trip
    follows from the last time of the slice before it; the offsets are a running
    sum over the slices. ``slice_column`` names a column that can serve as slice
    because it never falls as time rises, such as the date: what is partitioned
    by it afterwards needs no further shuffle.
    """
    cut = slice_column or SLICE
    part = [*keys, cut]
    gap = F.lit(gap_seconds * MICROS)
    day = F.lit(float(schema.DAY_SECONDS * MICROS))
    inside = Window.partitionBy(*part).orderBy(ts, *tie)
    across = over_slices(keys, cut)

    def breaks(now, before):
        step = now - before
        long_gap = step >= gap if inclusive else step > gap
        if break_at_midnight:
            long_gap = long_gap | (F.floor(now / day) != F.floor(before / day))
        return F.when(before.isNull(), 0).when(long_gap, 1).otherwise(0)

    local = (
        (df if slice_column else with_slices(df, ts, slice_seconds))
        .withColumn("_us", micros(ts))
        .withColumn("_break", breaks(F.col("_us"), F.lag("_us").over(inside)))
        .withColumn(
            "_seq", F.sum("_break").over(inside.rowsBetween(Window.unboundedPreceding, 0))
        )
    )
    edges = local.groupBy(*part).agg(
        *key_copies(keys),
        F.min("_us").alias("_first"), F.max("_us").alias("_last"), F.sum("_break").alias("_inner")
    )
    before = F.lag("_last").over(across)
    opened = edges.withColumn(
        "_opens", F.when(before.isNull(), 1).otherwise(breaks(F.col("_first"), before))
    )
    running = F.sum(F.col("_opens") + F.col("_inner")).over(
        across.rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = opened.select(
        *(f"_key_{k}" for k in keys),
        F.col(cut).alias("_cut"),
        (F.coalesce(running, F.lit(0)) + F.col("_opens")).alias("_base"),
    )
    return join_summary(local, offsets, keys, cut).select(
        *(c for c in df.columns if c != out), (F.col("_base") + F.col("_seq")).alias(out)
    )


def globally_numbered(
    df: DataFrame, *, key: str = "node_name", trip: str = "trip_id", out: str = "tripID"
) -> DataFrame:
    """One dense numbering over all vessels: vessel offset plus the trip's own number.

    The offsets are a running sum over one row per vessel, the only window here
    without a partition key; the rows themselves are joined back by vessel, salted.
    """
    totals = df.groupBy(key).agg(F.max(trip).alias("_n"))
    running = F.sum("_n").over(Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(key, F.coalesce(running, F.lit(0)).alias("_offset"))
    joined = salted_join(df, offsets, [key], [trip], "left")
    return joined.select(*df.columns, (F.col("_offset") + F.col(trip)).alias(out))


def trip_endpoints(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("node_name", "trip_id"),
    ts: str = "time",
    value: str = "value",
    tie: Sequence[str] = (),
) -> DataFrame:
    """First and last time of each trip with the non-null values read there."""
    at = F.struct(ts, *tie) if tie else col(ts)
    known = F.when(col(value).isNotNull(), at)
    return df.groupBy(*keys).agg(
        F.min(ts).alias("first_time"),
        F.max(ts).alias("last_time"),
        F.min_by(value, known).alias("first_value"),
        F.max_by(value, known).alias("last_value"),
    )


def trip_intervals(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("node_name", "trip_id"),
    ts: str = "time",
    padding_seconds: int = schema.DISCOVERY_PADDING_SECONDS,
) -> DataFrame:
    """One padded ``[start, stop]`` row per trip."""
    return df.groupBy(*keys).agg(
        shift(F.min(ts), -padding_seconds).alias("start"),
        shift(F.max(ts), padding_seconds).alias("stop"),
    )


def ranked_endpoints(intervals: DataFrame, *, start: str = "start", stop: str = "stop") -> DataFrame:
    """Long form of the intervals: one row per end, ``rank`` 0 for start and 1 for stop."""
    keys = [c for c in intervals.columns if c not in (start, stop)]
    ends = F.array(
        F.struct(F.lit(0).alias("rank"), F.lit("start").alias("edge"), F.col(start).alias("time")),
        F.struct(F.lit(1).alias("rank"), F.lit("stop").alias("edge"), F.col(stop).alias("time")),
    )
    return intervals.select(*keys, F.inline(ends))


def overall_span(intervals: DataFrame) -> DataFrame:
    return intervals.agg(F.min("start").alias("start"), F.max("stop").alias("stop"))


def trip_spans(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("node_name", "TRIP_ID"),
    ts: str = "ts",
    longer_than: float | None = schema.MIN_TRIP_MINUTES,
) -> DataFrame:
    """Duration of each trip in minutes, optionally only those strictly longer."""
    spans = df.groupBy(*keys).agg(
        F.min(ts).alias("time_min"), F.max(ts).alias("time_max")
    ).withColumn("timespan", minutes_between("time_min", "time_max"))
    return spans if longer_than is None else spans.filter(F.col("timespan") > longer_than)


def drop_short_trips(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("node_name", "TRIP_ID"),
    ts: str = "ts",
    longer_than: float = schema.MIN_TRIP_MINUTES,
    bounded: bool = False,
) -> DataFrame:
    """Rows of the trips that last long enough.

    ``bounded`` says that a key is small by construction (a day of one vessel):
    then a window finds the span without reading the input again.
    """
    if bounded:
        trip = Window.partitionBy(*keys)
        span = minutes_between(F.min(ts).over(trip), F.max(ts).over(trip))
        return df.withColumn("_span", span).filter(F.col("_span") > longer_than).drop("_span")
    long_enough = trip_spans(df, keys=keys, ts=ts, longer_than=longer_than).select(*keys)
    return salted_join(df, long_enough, keys, [ts], "left_semi")


def break_markers(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("node_name", "signal_instance", "trip_id"),
    ts: str = "time",
    offset_seconds: int = 1,
) -> DataFrame:
    """Rows plus a null row one second before and after each trip."""
    edges = df.groupBy(*keys).agg(F.min(ts).alias("_a"), F.max(ts).alias("_z"))
    markers = edges.select(
        *keys,
        F.explode(
            F.array(shift("_a", -offset_seconds), shift("_z", offset_seconds))
        ).alias(ts),
    )
    return df.unionByName(markers, allowMissingColumns=True)


def discover_trips(
    signal: DataFrame,
    *,
    start=None,
    stop=None,
    gap_seconds: int = schema.DISCOVERY_GAP_SECONDS,
    padding_seconds: int = schema.DISCOVERY_PADDING_SECONDS,
    tie: Sequence[str] = (),
    slice_seconds: int = schema.DAY_SECONDS,
) -> DataFrame:
    """Padded trip intervals of every vessel from the rows with a positive value."""
    active = signal.filter(F.col("value") > 0)
    if start is not None:
        active = active.filter(F.col("time") >= start)
    if stop is not None:
        active = active.filter(F.col("time") <= stop)
    slim = active.select("node_name", "time", *tie)
    numbered = number_trips(slim, gap_seconds=gap_seconds, tie=tie, slice_seconds=slice_seconds)
    return trip_intervals(numbered, padding_seconds=padding_seconds)
