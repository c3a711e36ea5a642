"""Engine rows with positions and the weather around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import schema
from wakeline.functions import geo
from wakeline.functions.timeops import MICROS, micros
from wakeline.operators.joins import column_or_null, nearest_in_time, rename_clashes

#: How far a reading may be, and the width of the buckets it is looked up by.
HALF_HOUR = schema.WEATHER_TOLERANCE_SECONDS * MICROS
WEATHER_COLUMNS = ("wind_velocity", "wind_angle", "alignment_factor")


def merge_positions(
    engine: DataFrame,
    positions: DataFrame,
    *,
    keys: Sequence[str] = ("node_name", "date", "time"),
    drop: Sequence[str] = ("TRIP_ID", "signal_instance", "ts"),
) -> DataFrame:
    """Left join of engine rows to the positions of the same vessel and period."""
    right = positions.drop(*drop)
    left, right = rename_clashes(engine, right, keys, ("_engine", "_geo"))
    return left.join(right, list(keys), "left")


def node_spans(df: DataFrame, *, ts: str = "ts") -> DataFrame:
    """Per vessel: first and last date and mean position, in one aggregation."""
    return df.groupBy("node_name").agg(
        F.to_date(F.min(ts)).alias("first_date"),
        F.to_date(F.max(ts)).alias("last_date"),
        F.avg("LAT").alias("LAT"),
        F.avg("LON").alias("LON"),
    )


def _half_hour(at: Column) -> Column:
    return F.floor(micros(at) / F.lit(float(HALF_HOUR))).cast("long")


def nearest_by_half_hours(df: DataFrame, readings: DataFrame, *, ts: str, reading_ts: str, key: str = "node_name") -> DataFrame:
    """Left join of each row to the vessel's nearest reading within half an hour, as an equi-join on half hours.

    What a row can match lies in its own half hour or is the last reading of the one before or the first of the one after; so each
    half hour carries its own readings and those two. For tables of a few readings an hour: a row looks through
    those of its half hour. Of two equally close readings the later wins, of several at one instant the smallest.
    """
    payload = [c for c in readings.columns if c not in (key, reading_ts)]
    own = F.struct(micros(reading_ts).alias("us"), *payload)
    home = _half_hour(F.col(reading_ts))
    placed = readings.select(
        key,
        own.alias("_r"),
        F.explode(
            F.array(*(F.struct((home + k).alias("half"), F.lit(k).alias("from")) for k in (0, 1, -1)))
        ).alias("_p"),
    )

    def when(k: int) -> Column:
        return F.when(F.col("_p.from") == k, F.col("_r"))

    # The last of the half hour before is the one with the greatest time and, among those, the smallest values.
    last = F.min(F.when(F.col("_p.from") == 1, F.struct((-F.col("_r.us")).alias("neg"), "_r")))["_r"]
    halves = placed.groupBy(key, F.col("_p.half").alias("_half")).agg(
        F.collect_set(when(0)).alias("_in"), last.alias("_before"), F.min(when(-1)).alias("_after")
    )
    around = F.array_append(F.array_append("_in", F.col("_before")), F.col("_after"))
    halves = halves.select(key, "_half", F.filter(around, lambda r: r.isNotNull()).alias("_around"))
    rows = df.withColumn("_half", _half_hour(F.col(ts)))
    joined = rows.join(halves, [key, "_half"], "left")
    now, reach = micros(ts), F.lit(HALF_HOUR)
    near = F.filter("_around", lambda r: F.abs(r["us"] - now) <= reach)
    ordered = F.transform(
        near, lambda r: F.struct(F.abs(r["us"] - now).alias("gap"), (-r["us"]).alias("later"), *(r[c].alias(c) for c in payload))
    )
    picked = joined.withColumn("_best", F.array_min(ordered))
    at = F.timestamp_micros(-F.col("_best.later")).cast("timestamp_ntz")
    return picked.select(*df.columns, at.alias(reading_ts), *(F.col(f"_best.{c}").alias(c) for c in payload))


def add_weather(
    df: DataFrame,
    weather: DataFrame,
    *,
    ts: str = "ts",
    hourly: bool = True,
) -> DataFrame:
    """Wind of the nearest reading within half an hour, and the alignment to the course.

    ``weather`` has ``node_name, date, wind_speed_10m, wind_direction_10m``, at any times and in any number per instant (the
    smallest counts). With a few readings an hour an equi-join does; ``hourly=False`` is for dense ones, and gives the same.
    Without positions the weather columns are null.
    """
    if "LAT" not in df.columns or "LON" not in df.columns:
        absent = F.lit(None).cast("double")
        return df.withColumns({c: absent for c in (*WEATHER_COLUMNS, "LAT", "LON")})
    readings = weather.select(
        "node_name", F.col("date").alias("_reading_ts"), "wind_speed_10m", "wind_direction_10m"
    )
    if hourly:
        joined = nearest_by_half_hours(df, readings, ts=ts, reading_ts="_reading_ts")
    else:
        joined = nearest_in_time(
            df, readings, key="node_name", ts=ts, reading_ts="_reading_ts"
        )
    return joined.select(
        *df.columns,
        F.col("wind_speed_10m").alias("wind_velocity"),
        F.col("wind_direction_10m").alias("wind_angle"),
        geo.alignment_factor(column_or_null(joined, "COG"), "wind_direction_10m").alias(
            "alignment_factor"
        ),
    )
