"""Engine telemetry from long signals to the weather-joined, cleaned wide table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schema
from wakeline.functions import values as V
from wakeline.operators import impute, joins, reshape, trips, weather
from wakeline.session import stored


#: Stands for an absent measurement or alias.
UNNAMED = ""


def trip_signals(signals: DataFrame, intervals: DataFrame, **options) -> DataFrame:
    """Every measurement inside the trips of its vessel."""
    hit = joins.in_interval(signals, intervals, **options)
    return hit.select(*signals.columns, "trip_id")


def widen(
    df: DataFrame, signals: Sequence[str], *, geo: bool, tie: Sequence[str] = ()
) -> DataFrame:
    """One row per vessel, side and time. Only position rows may lack a side."""
    return reshape.pivot_first(
        df,
        keys=["node_name", "signal_instance", "time"],
        signals=signals,
        tie=tie,
        keep_null_keys=geo,
    )


def resampled(
    wide: DataFrame, signals: Sequence[str], *, step_seconds: int, date_before_round: bool = False
) -> DataFrame:
    return reshape.resample_mean(
        impute.fill_side(wide),
        keys=["node_name", "signal_instance"],
        values=signals,
        step_seconds=step_seconds,
        date_before_round=date_before_round,
    )


def trip_filled(
    even: DataFrame, signals: Sequence[str], *, gap_seconds: int = schema.TRIP_GAP_SECONDS
) -> DataFrame:
    """Number the trips (new day or long gap) and fill forward inside trip and side.

    Trips end at midnight, so vessel and date bound every window, and one shuffle
    on them serves the numbering and the filling.
    """
    numbered = trips.number_trips(
        even,
        gap_seconds=gap_seconds,
        ts="ts",
        tie=["signal_instance"],
        inclusive=True,
        break_at_midnight=True,
        out="TRIP_ID",
        slice_column="date",
    )
    return impute.fill(
        numbered,
        signals,
        keys=["node_name", "date", "TRIP_ID", "signal_instance"],
        order="forward",
        slice_seconds=None,
    )


def measurement_map(
    signals: DataFrame, *, group: str, alias: str = "signal_name_alias"
) -> DataFrame:
    """Per measurement and alias: is it a position, and which signal is meant. ``group`` has no nulls.

    One aggregation over three columns; a few rows come out, stored.
    """
    seen = signals.groupBy(group, alias).agg(
        F.bool_and(F.col("signal_instance").isNull()).alias("_no_side")
    )
    seen = stored(seen, "aliases")
    kinds = seen.groupBy(group).agg(F.bool_and("_no_side").alias("is_geo"))
    names = reshape.alias_map(seen, alias=alias)
    mapped = seen.select(group, alias).join(kinds, group).join(names, alias, "left")
    return stored(mapped, "measurements")


def engine_table(
    signals: DataFrame,
    wind: DataFrame,
    *,
    group: str = "measurement",
    discovery_signal: str = "RPM",
    discovery_gap_seconds: int = schema.DISCOVERY_GAP_SECONDS,
    padding_seconds: int = schema.DISCOVERY_PADDING_SECONDS,
    step_seconds: int = schema.RESAMPLE_STEP_SECONDS,
    gap_seconds: int = schema.TRIP_GAP_SECONDS,
    min_minutes: float = schema.MIN_TRIP_MINUTES,
    tie: Sequence[str] = (),
    hourly_weather: bool = True,
    slice_seconds: int = schema.DAY_SECONDS,
) -> DataFrame:
    """The whole batch job.

    ``signals`` is long telemetry with a ``group`` column naming the measurement
    a row came from. The wide scan runs once: positions and engine rows go through
    the pivot and the resampling together, and the even rows are stored before
    they part.
    """
    intervals = trips.discover_trips(
        signals.filter(F.col(group) == discovery_signal),
        gap_seconds=discovery_gap_seconds,
        padding_seconds=padding_seconds,
        tie=tie,
        slice_seconds=slice_seconds,
    )
    alias = "signal_name_alias"
    # Rows that name no measurement are one of their own, instead of none.
    signals = signals.withColumns({group: F.coalesce(group, F.lit(UNNAMED)), alias: F.coalesce(alias, F.lit(UNNAMED))})
    lookup = measurement_map(signals, group=group)
    # The lookup is stored, so Spark knows its size and picks the join; a skewed key is split while it runs.
    named = signals.join(lookup, [group, alias], "left")
    known = named.withColumn(alias, F.coalesce("resolved", alias)).drop("resolved")
    inside = trip_signals(known, intervals, bucket_seconds=slice_seconds)
    sided = inside.withColumn(
        "signal_instance",
        F.when(F.col("is_geo"), F.col("signal_instance")).otherwise(V.side_name("signal_instance")),
    ).filter(F.col("is_geo") | F.col("signal_instance").isNotNull())

    cell = ["node_name", "is_geo", "signal_instance"]
    wide = reshape.pivot_first(
        sided, keys=[*cell, "time"], signals=schema.SIGNALS, tie=tie, keep_null_keys=True
    )
    even = stored(
        reshape.resample_mean(
            impute.fill_side(wide), keys=cell, values=schema.SIGNALS, step_seconds=step_seconds
        ),
        "even",
    )
    engine = even.filter("not is_geo").drop("is_geo", *schema.GEO_SIGNALS)
    geo = even.filter("is_geo").drop("is_geo", *schema.ENGINE_SIGNALS)
    engine_filled = trip_filled(engine, schema.ENGINE_SIGNALS, gap_seconds=gap_seconds)
    geo_filled = trip_filled(
        impute.fill_constants(geo, {"SOG": 0.0}), schema.GEO_SIGNALS, gap_seconds=gap_seconds
    )
    lasting = trips.drop_short_trips(
        engine_filled,
        keys=["node_name", "date", "TRIP_ID"],
        longer_than=min_minutes,
        bounded=True,
    )
    merged = weather.merge_positions(lasting, geo_filled)
    return weather.add_weather(merged, wind, hourly=hourly_weather)
