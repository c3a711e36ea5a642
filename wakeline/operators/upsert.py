"""Incremental maintenance of the merged table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.timeops import hour_of, micros, shift


def upsert(
    existing: DataFrame, new: DataFrame, *, ignore: Sequence[str] = ("TRIP_ID",)
) -> DataFrame:
    """Both tables without repeats on all columns but ``ignore``; the existing row wins.

    One aggregation on the compared columns: copies merge before the shuffle, so
    a row repeated many times does not end up in one task as many rows.
    """
    compared = [c for c in existing.columns if c not in ignore]
    kept = [c for c in existing.columns if c in ignore]
    both = existing.withColumn("_src", F.lit(0)).unionByName(
        new.select(*existing.columns).withColumn("_src", F.lit(1))
    )
    if len(kept) == 1:
        # Plain minima fit a hash aggregate; a struct would need a sorted one.
        old, fresh = (F.min(F.when(F.col("_src") == src, F.col(kept[0]))) for src in (0, 1))
        winner = F.when(F.min("_src") == 0, old).otherwise(fresh).alias(kept[0])
        return both.groupBy(*compared).agg(winner).select(*existing.columns)
    merged = both.groupBy(*compared).agg(F.min(F.struct("_src", *kept)).alias("_kept"))
    return merged.select(
        *(F.col(f"_kept.{c}").alias(c) if c in kept else c for c in existing.columns)
    )


def latest_date(df: DataFrame, date: str = "date") -> DataFrame:
    return df.agg(F.max(date).alias("latest"))


def since_latest(stored: DataFrame, incoming: DataFrame, date: str = "date") -> DataFrame:
    """Incoming rows from the last stored date on; everything while nothing is stored."""
    latest = latest_date(stored, date).scalar()
    return (
        incoming.withColumn("_latest", latest)
        .filter(F.col("_latest").isNull() | (F.col(date) >= F.col("_latest")))
        .drop("_latest")
    )


def catch_up(
    stored: DataFrame, incoming: DataFrame, *, date: str = "date", ignore: Sequence[str] = ("TRIP_ID",)
) -> DataFrame:
    """The dates touched by new rows, merged: overwrite just these date partitions."""
    latest = latest_date(stored, date).scalar()
    tail = stored.withColumn("_latest", latest).filter(F.col(date) >= F.col("_latest")).drop("_latest")
    return upsert(tail, since_latest(stored, incoming, date), ignore=ignore)


def freshness(df: DataFrame, as_of, *, ts: str = "ts") -> DataFrame:
    """Is the newest row an hour or more behind the current hour?

    ``as_of`` is a timestamp literal or expression handed in by the caller.
    """
    now = hour_of(as_of)
    newest = df.agg(F.max(ts).alias("newest"))
    return newest.select(
        (micros(now) - micros("newest") >= 3600 * 1_000_000).alias("stale"),
        now.alias("current_hour"),
        shift(now, -3600).alias("previous_hour"),
    )


def hour_pull(df: DataFrame, current_hour, *, ts: str = "time") -> DataFrame:
    """Rows of the hour before ``current_hour``, its start included and its end not."""
    return df.filter((F.col(ts) >= shift(current_hour, -3600)) & (F.col(ts) < current_hour))
