"""Inputs the registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.functions import values as V
from wakeline.plans import engine, gps
from wakeline.registry.base import ENGINE, HOURS2
from wakeline.session import stored
from wakeline.sources import events, scans

TIE = ["event_id"]


def tel(spark: SparkSession, folder: str) -> DataFrame:
    return events.telemetry(spark, folder)


def engine_wide(spark: SparkSession, folder: str) -> DataFrame:
    sided = tel(spark, folder).withColumn("signal_instance", V.side_name("signal_instance"))
    return engine.widen(sided, ENGINE, geo=False, tie=TIE)


def even(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly engine rows, stored as in the batch job."""
    return stored(engine.resampled(engine_wide(spark, folder), ENGINE, step_seconds=3600), "even")


def even_trips(spark: SparkSession, folder: str) -> DataFrame:
    from wakeline.operators import trips

    return trips.number_trips(
        even(spark, folder),
        gap_seconds=HOURS2,
        ts="ts",
        tie=["signal_instance"],
        inclusive=True,
        break_at_midnight=True,
        out="TRIP_ID",
        slice_column="date",
    )


def filled(spark: SparkSession, folder: str) -> DataFrame:
    return engine.trip_filled(even(spark, folder), ENGINE, gap_seconds=HOURS2)


def gps_long(spark: SparkSession, folder: str) -> DataFrame:
    signals = events.gps_signals(spark, folder)
    return scans.gps_scan(events.positions(spark, folder), [signals])


def gps_rows(spark: SparkSession, folder: str, counted: bool = False) -> DataFrame:
    return gps.gps_table(gps_long(spark, folder), gap_seconds=HOURS2, counted=counted)


def gps_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Positions and speed of the GPS rows, for queries with several branches."""
    rows = gps_rows(spark, folder, counted=True).select("node_name", "tripID", "ts", "LAT", "LON", "SOG", "LAT_lag", "LON_lag")
    return stored(rows, "gps")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return events.table(spark, folder, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")
    )


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return events.table(spark, folder, "lineitem")


