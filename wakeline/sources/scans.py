"""Catalog listing and filtered scans over telemetry tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline import schema
from wakeline.functions import values as V


def register_tables(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession) -> list[str]:
    """Names of the registered tables."""
    return sorted(t.name for t in spark.catalog.listTables())


def sample_table(df: DataFrame, n: int = 2, order: Sequence[str] = ()) -> DataFrame:
    """A few rows; with ``order`` always the same ones (a top-n, no full sort)."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def range_scan(df: DataFrame, start, stop, *, node: str | None = None) -> DataFrame:
    """Positive values in ``[start, stop]``, optionally of one vessel.

    Order is left to the consumer: sort at the sink, not here.
    """
    keep = (F.col("time") >= start) & (F.col("time") <= stop) & (F.col("value") > 0)
    if node is not None:
        keep = keep & (F.col("node_name") == node)
    return df.filter(keep)


def day_scan(df: DataFrame, date: str, *, node: str | None = None) -> DataFrame:
    """One day of positive values, midnight to midnight; the filter is on raw time."""
    start = F.lit(date).cast("timestamp_ntz")
    keep = (F.col("time") >= start) & (F.col("time") < start + F.expr("INTERVAL 1 DAY"))
    keep = keep & (F.col("value") > 0)
    if node is not None:
        keep = keep & (F.col("node_name") == node)
    return df.filter(keep).select("time", "node_name", "value", "signal_instance")


def split_positions(lat_lon: DataFrame) -> DataFrame:
    """Two value columns to two labelled rows per position."""
    keys = [c for c in lat_lon.columns if c not in ("value_latitude", "value_longitude", "signal_name_alias")]
    return lat_lon.withColumnsRenamed({"value_latitude": "A_LAT", "value_longitude": "A_LON"}).unpivot(
        keys, ["A_LAT", "A_LON"], "signal_name_alias", "value"
    )


def gps_scan(
    lat_lon: DataFrame,
    signals: Sequence[DataFrame],
    start: Column | None = None,
    stop: Column | None = None,
    *,
    sentinels: Sequence[float] = schema.SENTINELS,
) -> DataFrame:
    """All GPS measurements in ``[start, stop)`` as one long table without sentinels."""
    long = split_positions(lat_lon)
    columns = long.columns
    for table in signals:
        long = long.unionByName(table.select(*columns))
    keep = V.no_sentinels("value", sentinels)
    if start is not None:
        keep = keep & (F.col("time") >= start)
    if stop is not None:
        keep = keep & (F.col("time") < stop)
    return long.filter(keep)
