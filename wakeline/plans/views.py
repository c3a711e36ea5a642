"""Data behind the dashboard: comparison series, error scatter, heatmap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schema
from wakeline.functions import values as V
from wakeline.functions.timeops import date_of
from wakeline.operators import features, impute, reshape, scoring, sliced, trips
from wakeline.session import stored


def comparison_series(
    signal: DataFrame,
    *,
    smoothing_rows: int,
    gap_seconds: int = schema.COMPARISON_GAP_SECONDS,
    threshold: float = schema.Z_THRESHOLD,
    by: Sequence[str] = ("node_name", "date"),
    tie: Sequence[str] = (),
    slice_seconds: int = schema.DAY_SECONDS,
) -> DataFrame:
    """Port against starboard for every vessel and day of one feature.

    Trips are numbered, outliers beyond the day's distribution dropped, null rows
    put around each trip, and each side smoothed. ``signal`` is a scan of one
    feature (one day of one vessel, or all of them).
    """
    active = signal.filter(F.col("value") > 0).withColumn("date", date_of("time"))
    slim = active.select("node_name", "date", "time", "signal_instance", "value", *tie)
    numbered = trips.number_trips(
        slim, gap_seconds=gap_seconds, keys=by, tie=tie, out="TRIP_ID", slice_seconds=slice_seconds
    ).withColumn("signal_instance", V.side_name("signal_instance"))
    # Read for the distribution, the rows and the trips' ends: worked out once.
    numbered = stored(impute.fill_side(numbered), "series")
    kept = features.drop_outliers(
        numbered, ["value"], threshold=threshold, two_sided=False, by=by, spread_by=["time"]
    )
    marked = trips.break_markers(kept, keys=[*by, "signal_instance", "TRIP_ID"])
    return sliced.rolling_mean(
        marked,
        "value",
        smoothing_rows,
        [*by, "signal_instance"],
        "time",
        ["TRIP_ID", *tie],
        slice_seconds=slice_seconds,
    )


def error_scatter(
    errors: DataFrame, *, node: str | None = None, features: Sequence[str] = schema.ERROR_FEATURES
) -> DataFrame:
    """Feature values over date as points, for one vessel or all."""
    rows = errors if node is None else errors.filter(F.col("node_name") == node)
    return rows.select("node_name", "date", *features).unpivot(
        ["node_name", "date"], list(features), "feature", "value"
    )


def selectable_dates(errors: DataFrame, node: str) -> DataFrame:
    return reshape.distinct_values(errors.filter(F.col("node_name") == node), "date")


def heatmap(
    errors: DataFrame,
    *,
    features: Sequence[str] = schema.ERROR_FEATURES,
    dates: Sequence[str] = (),
) -> DataFrame:
    """Daily mean error by feature; wide over ``dates`` if given, else long."""
    daily = scoring.daily_errors(errors, features)
    return reshape.error_matrix(daily, features, long=not dates, dates=dates)
