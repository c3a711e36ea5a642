"""Weather tables: hourly wind per vessel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline import schema
from wakeline.functions.timeops import MICROS, micros

WEATHER = T.StructType(
    [
        T.StructField("node_name", T.StringType()),
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("wind_speed_10m", T.DoubleType()),
        T.StructField("wind_direction_10m", T.DoubleType()),
    ]
)


def hourly_readings(readings: DataFrame) -> DataFrame:
    """One reading per vessel and full hour: the nearest within half an hour, and how far off it is.

    Of two as near the later counts, of several at one instant the smallest; a reading at half past serves both
    hours. Rows without vessel or time belong to no hour; ``without_place`` gives them.
    """
    hour = F.date_trunc("hour", "date").cast("timestamp_ntz")
    wind = ("wind_speed_10m", "wind_direction_10m")
    gap = F.abs(micros("date") - micros("_hour"))
    placed = readings.select(
        "node_name", "date", *wind, F.explode(F.array(hour, hour + F.expr("INTERVAL 1 HOUR"))).alias("_hour")
    ).withColumn("_gap", gap)
    near = placed.filter((F.col("_gap") <= schema.WEATHER_TOLERANCE_SECONDS * MICROS) & F.col("node_name").isNotNull())
    best = near.groupBy("node_name", "_hour").agg(
        F.min(F.struct("_gap", (-micros("date")).alias("_later"), *wind)).alias("_r")
    )
    return best.select(
        "node_name", F.col("_hour").alias("date"), *(f"_r.{c}" for c in wind), (F.col("_r._gap") / MICROS).alias("seconds_off")
    )


def without_place(readings: DataFrame) -> DataFrame:
    """Readings that no hour of a vessel can have: those without vessel or time."""
    return readings.filter("node_name is null or date is null")


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """A stored weather table, brought to full hours."""
    return hourly_readings(spark.read.schema(WEATHER).parquet(path))
