"""GPS telemetry to wide per-second rows, disruption scoring and the map table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schema
from wakeline.functions import geo, severity
from wakeline.functions import values as V
from wakeline.functions.text import strip_prefix
from wakeline.functions.timeops import date_of, time_of_day
from wakeline.operators import cells, reshape, scoring, segments, sequences
from wakeline.session import stored

TRIP_KEYS = ("node_name", "tripID")


def gps_table(
    long: DataFrame,
    *,
    gap_seconds: int = schema.GPS_GAP_SECONDS,
    step_seconds: int = 1,
    signals: Sequence[str] = schema.GPS_SIGNALS,
    slice_seconds: int = schema.DAY_SECONDS,
    counted: bool = False,
) -> DataFrame:
    """Clean names, even seconds, trips, gaps filled, deltas, running flag; with ``counted`` also ``row_no``, ``trip_rows`` and the position before
    as ``LAT_lag`` and ``LON_lag``.

    ``slice_seconds`` is what one window task holds of a vessel: an hour for sensors of many readings a second.

    The even rows are stored: the scan and its aggregation run once. Trips, filling and deltas are one pass over them.
    """
    named = long.withColumn("signal_name_alias", strip_prefix("signal_name_alias"))
    wide = reshape.resample_gps(named, signals=signals, step_seconds=step_seconds)
    even = stored(wide.select("node_name", "ts", *signals), "gps-even")
    lags = [s for s in ("LAT", "LON") if counted and s in signals]
    moving = segments.filled_with_deltas(
        even,
        signals,
        [s for s in ("LAT", "LON", "SOG") if s in signals],
        gap_seconds=gap_seconds,
        out="tripID",
        total="trip_rows",
        lags=lags,
        slice_seconds=slice_seconds,
    )
    deltas = [c for c in moving.columns if c.endswith("_Delta")]
    placed = moving.withColumns({"date": date_of("ts"), "time": time_of_day("ts"), "RPM": V.is_running("RPM")})
    return placed.select("node_name", "ts", "date", "time", *signals, "tripID", *deltas, *(["row_no", "trip_rows", *(f"{s}_lag" for s in lags)] if counted else []))


def whole_windows(gps: DataFrame, rows: int) -> DataFrame:
    """Rows of whole windows, with their ``row_no``: a ``counted`` table is only filtered, another one numbered first."""
    if "trip_rows" not in gps.columns:
        return sequences.trim_to_multiple(gps, rows, keys=TRIP_KEYS)
    whole = F.col("trip_rows") - F.pmod(F.col("trip_rows"), F.lit(rows))
    return gps.filter(F.col("row_no") <= whole).drop("trip_rows")


def map_tables(
    gps: DataFrame,
    model: scoring.Scorer,
    *,
    rows: int = schema.GPS_WINDOW_ROWS,
    threshold: float = schema.GPS_SCORE_THRESHOLD,
    size: float = geo.CELL_SIZE,
    palette=severity.DARK,
) -> tuple[DataFrame, DataFrame]:
    """Coloured cells, and one summary row per flagged trip.

    The rows feed several branches, so they are written once to the shared folder.
    """
    gps = stored(gps, "gps")
    trimmed = stored(whole_windows(gps, rows), "whole")
    scored = scoring.score_windows(
        scoring.gps_features(trimmed), model, rows=rows, threshold=threshold, number="row_no"
    )
    flagged = stored(scoring.flagged_trips(scored), "flagged")
    rows_ = scoring.mark_flagged(trimmed, flagged)
    counts = cells.cell_counts(rows_, size=size)
    return cells.coloured_cells(counts, palette=palette, size=size), cells.trip_summary(rows_.filter("anomalous"))


def hourly_map_table(
    hours: DataFrame,
    model: scoring.Scorer,
    ranges: DataFrame,
    *,
    rows: int = schema.GPS_WINDOW_ROWS,
    threshold: float = schema.GPS_SCORE_THRESHOLD,
    gap_seconds: int = schema.GPS_GAP_SECONDS,
    size: float = geo.CELL_SIZE,
    palette=severity.DARK,
) -> DataFrame:
    """From long signals with ``date`` and ``hour`` to coloured cells of each hour.

    Each hour is worked on for itself, whatever other hours come with it: the hour is part of the vessel's key, trips
    and windows end with it, and a row belongs to the hour it was received for even if rounding moves its time.
    ``ranges`` are the model's (``scoring.gps_ranges``).
    """
    hour = F.concat("node_name", F.lit("@"), F.col("date").cast("string"), F.lit("@"), F.col("hour").cast("string"))
    table = gps_table(hours.withColumn("node_name", hour).drop("date", "hour"), gap_seconds=gap_seconds, counted=True)
    trimmed = stored(whole_windows(table, rows), "whole")
    features = scoring.gps_features(trimmed, ranges)
    scored = scoring.score_windows(features, model, rows=rows, threshold=threshold, number="row_no")
    marked = scoring.mark_flagged(trimmed, scoring.flagged_trips(scored))
    parts = F.split("node_name", "@")
    when = [F.element_at(parts, -2).cast("date").alias("date"), F.element_at(parts, -1).cast("int").alias("hour")]
    return cells.hourly_cells(marked, when=when, size=size, palette=palette)


def daily_map(hourly: DataFrame) -> DataFrame:
    """Worst colour per date and cell over the hourly map table."""
    return cells.worst_colour(hourly.filter(F.col("cell").isNotNull()))
