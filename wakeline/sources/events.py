"""Adapter: the ``events`` table read as vessel telemetry."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VESSELS = 8
DEVICES = 16
# Which measurement each event type stands for.
ALIASES = {
    "click": "RPM",
    "view": "SOG",
    "purchase": "FUELRATE",
    "error": "ENGTEMP",
    "signup": "COG",
}
GPS_ALIASES = {"view": "A_SOG", "signup": "X_Y_COG", "click": "E_RPM", "purchase": "CELL"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def _mapped(column: str, names: dict[str, str]):
    return F.create_map(*(F.lit(x) for pair in names.items() for x in pair))[F.col(column)]


def vessel_name() -> Column:
    return F.concat(F.lit("boat-"), F.pmod("user_id", F.lit(VESSELS)).cast("string"))


def as_telemetry(events: DataFrame) -> DataFrame:
    """Long telemetry plus ``event_id`` as a unique row key."""
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp_ntz").alias("time"),
        F.concat(F.lit("dev-"), F.pmod("user_id", F.lit(DEVICES)).cast("string")).alias("node_id"),
        vessel_name().alias("node_name"),
        _mapped("event_type", ALIASES).alias("signal_name_alias"),
        "value",
        F.when(
            ~F.col("event_type").isin("view", "signup"), F.pmod("event_id", F.lit(2)).cast("string")
        ).alias("signal_instance"),
    )


def as_positions(events: DataFrame) -> DataFrame:
    """``LAT-LON`` rows; the position comes from ``props``."""
    k = F.regexp_extract("props", r"(\d+)", 1).cast("bigint")
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp_ntz").alias("time"),
        F.concat(F.lit("dev-"), F.pmod("user_id", F.lit(DEVICES)).cast("string")).alias("node_id"),
        vessel_name().alias("node_name"),
        F.lit("LAT-LON").alias("signal_name_alias"),
        (F.lit(55.0) + F.lit(0.15) * F.pmod(k, F.lit(100))).alias("value_latitude"),
        (F.lit(10.0) + F.lit(0.15) * F.pmod(k * 7, F.lit(100))).alias("value_longitude"),
    )


def as_gps_signals(events: DataFrame) -> DataFrame:
    """Speed, course, engine speed and cell rows, named with device prefixes."""
    rows = as_telemetry(events.filter(F.col("event_type").isin(*GPS_ALIASES)))
    names = {ALIASES[e]: g for e, g in GPS_ALIASES.items()}
    return rows.withColumn("signal_name_alias", _mapped("signal_name_alias", names)).drop(
        "signal_instance"
    )


def as_weather(telemetry: DataFrame) -> DataFrame:
    """Hourly wind per vessel over its span, made from the hour number."""
    spans = telemetry.groupBy("node_name").agg(
        F.date_trunc("hour", F.min("time")).cast("timestamp_ntz").alias("_a"),
        F.date_trunc("hour", F.max("time")).cast("timestamp_ntz").alias("_z"),
    )
    hours = spans.select(
        "node_name",
        F.explode(
            F.sequence("_a", "_z", F.expr("INTERVAL 1 HOUR"))
        ).alias("date"),
    )
    n = F.timestamp_diff("HOUR", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("date"))
    return hours.select(
        "node_name",
        "date",
        F.pmod(n, F.lit(13)).cast("double").alias("wind_speed_10m"),
        F.pmod(n * 37, F.lit(360)).cast("double").alias("wind_direction_10m"),
    )


def telemetry(spark: SparkSession, folder: str) -> DataFrame:
    return as_telemetry(table(spark, folder, "events"))


def positions(spark: SparkSession, folder: str) -> DataFrame:
    return as_positions(table(spark, folder, "events"))


def gps_signals(spark: SparkSession, folder: str) -> DataFrame:
    return as_gps_signals(table(spark, folder, "events"))


def weather(spark: SparkSession, folder: str) -> DataFrame:
    return as_weather(telemetry(spark, folder))
