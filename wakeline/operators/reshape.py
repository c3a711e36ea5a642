"""Long to wide and back, resampling, alias resolution, unions and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import schema
from wakeline.functions import text
from wakeline.functions.timeops import (
    MICROS,
    col,
    date_of,
    from_micros,
    micros,
    round_half_even,
    time_of_day,
)
from wakeline.session import stored



def pivot_first(
    df: DataFrame,
    *,
    keys: Sequence[str],
    signals: Sequence[str],
    alias: str = "signal_name_alias",
    value: str = "value",
    tie: Sequence[str] = (),
    keep_null_keys: bool = False,
) -> DataFrame:
    """One column per signal holding its first non-null value.

    "First" is the smallest ``tie``, or the smallest value when none is given.
    Written as conditional aggregates, so one shuffle on the keys suffices and
    signals that never occur are null columns. Rows with a null key are dropped
    unless ``keep_null_keys``.
    """
    if not keep_null_keys:
        df = df.na.drop("any", subset=list(keys))

    def first(signal: str) -> Column:
        here = (col(alias) == signal) & col(value).isNotNull()
        if not tie:
            return F.min(F.when(here, col(value)))
        order = col(tie[0]) if len(tie) == 1 else F.struct(*tie)
        return F.min_by(value, F.when(here, order))

    return df.groupBy(*keys).agg(*(first(s).alias(s) for s in signals))


def pivot_mean(
    df: DataFrame,
    *,
    keys: Sequence[str],
    signals: Sequence[str],
    alias: str = "signal_name_alias",
    value: str = "value",
) -> DataFrame:
    """One column per signal holding its mean, in one aggregation."""
    return df.groupBy(*keys).agg(
        *(F.avg(F.when(col(alias) == s, col(value))).alias(s) for s in signals)
    )


def with_bucket(
    df: DataFrame,
    *,
    step_seconds: int,
    ts: str = "time",
    date_before_round: bool = False,
) -> DataFrame:
    """Replace ``ts`` by its even period: columns ``ts`` (bucket), ``date``, ``time``.

    With ``date_before_round`` the date is that of the raw time, so the last
    seconds of a day land at 00:00:00 of the same day.
    """
    bucket = from_micros(round_half_even(micros(ts), step_seconds))
    if date_before_round:
        day = F.lit(schema.DAY_SECONDS * MICROS)
        in_day = F.pmod(round_half_even(micros(ts), step_seconds), day)
        bucket = from_micros(micros(ts) - F.pmod(micros(ts), day) + in_day)
    rest = [c for c in df.columns if c not in (ts, "ts", "date", "time")]
    return (
        df.select(*rest, bucket.alias("ts"))
        .withColumns({"date": date_of("ts"), "time": time_of_day("ts")})
    )


def resample_mean(
    df: DataFrame,
    *,
    keys: Sequence[str],
    values: Sequence[str],
    step_seconds: int = schema.RESAMPLE_STEP_SECONDS,
    ts: str = "time",
    date_before_round: bool = False,
) -> DataFrame:
    """Mean of every value per key and even period."""
    placed = with_bucket(df, step_seconds=step_seconds, ts=ts, date_before_round=date_before_round)
    means = placed.groupBy(*keys, "ts").agg(*(F.avg(v).alias(v) for v in values))
    return means.select(
        *keys, "ts", date_of("ts").alias("date"), time_of_day("ts").alias("time"), *values
    )


def resample_gps(
    df: DataFrame,
    *,
    signals: Sequence[str] = schema.GPS_SIGNALS,
    step_seconds: int = 1,
    ts: str = "time",
) -> DataFrame:
    """Positions per vessel and second: mean per signal, signals side by side."""
    placed = with_bucket(df, step_seconds=step_seconds, ts=ts)
    wide = pivot_mean(placed, keys=["node_name", "ts"], signals=signals)
    return wide.select(
        "node_name", "ts", date_of("ts").alias("date"), time_of_day("ts").alias("time"), *signals
    )


def exact_alias(alias: str | Column, signals: Sequence[str] = schema.SIGNALS) -> Column:
    """The signal whose cleaned name equals the cleaned alias, else null."""
    pairs = [F.lit(x) for s in signals for x in (text.clean_name(s), s)]
    return F.create_map(*pairs)[text.clean_alias(alias)]


def alias_map(
    df: DataFrame,
    *,
    alias: str = "signal_name_alias",
    signals: Sequence[str] = schema.SIGNALS,
    cutoff: float = schema.FUZZY_CUTOFF,
) -> DataFrame:
    """``(alias, resolved)`` for the distinct aliases: exact, else closest, else unchanged."""
    names = {text.clean_name(s): s for s in signals}
    lookup = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    distinct = df.select(alias).na.drop().distinct()
    near = text.closest_key(text.clean_alias(alias), list(names), cutoff)
    return distinct.select(
        alias, F.coalesce(exact_alias(alias, signals), lookup[near], col(alias)).alias("resolved")
    )


def apply_alias_map(df: DataFrame, mapping: DataFrame, *, alias: str = "signal_name_alias") -> DataFrame:
    """Replace aliases by a stored map; Spark chooses the join by its size and splits skewed aliases."""
    joined = df.join(mapping, alias, "left")
    return joined.withColumn(alias, F.coalesce("resolved", alias)).select(*df.columns)


def resolve_aliases(
    df: DataFrame,
    *,
    alias: str = "signal_name_alias",
    signals: Sequence[str] = schema.SIGNALS,
    cutoff: float = schema.FUZZY_CUTOFF,
) -> DataFrame:
    """Fuzzy signal names to known ones; the map is built once over distinct names."""
    mapping = stored(alias_map(df, alias=alias, signals=signals, cutoff=cutoff), "aliases")
    return apply_alias_map(df, mapping, alias=alias)


def best_match_levenshtein(
    df: DataFrame,
    *,
    alias: str = "signal_name_alias",
    signals: Sequence[str] = schema.SIGNALS,
    cutoff: float = schema.FUZZY_CUTOFF,
) -> DataFrame:
    """Top match per distinct alias by edit-distance ratio; ties go to the largest key."""
    keys = F.array(*(F.lit(text.clean_name(s)) for s in signals))
    names = F.create_map(*(F.lit(x) for s in signals for x in (text.clean_name(s), s)))
    scored = (
        df.select(alias)
        .na.drop()
        .distinct()
        .select(alias, text.clean_alias(alias).alias("_clean"), F.explode(keys).alias("_key"))
        .withColumn("score", text.levenshtein_ratio("_clean", "_key"))
        .filter(F.col("score") >= cutoff)
    )
    top = scored.groupBy(alias).agg(F.max(F.struct("score", "_key")).alias("_top"))
    return top.select(
        alias, names[F.col("_top._key")].alias("match"), F.col("_top.score").alias("score")
    )


def dates_of(daily: DataFrame, date: str = "date") -> list[str]:
    """Every date of a daily table in order: one per day on record."""
    found = daily.select(col(date).cast("string").alias("d")).filter("d is not null").distinct()
    return sorted(r["d"] for r in found.collect())


def error_matrix(
    daily: DataFrame, features: Sequence[str], *, date: str = "date", long: bool = False,
    dates: Sequence[str] = (),
) -> DataFrame:
    """Heatmap data: feature by date.

    ``long`` gives ``(feature, date, value)``, the form that scales; the wide form
    has one column for each of the ``dates`` (all of them: ``dates_of``).
    """
    keys = [c for c in daily.columns if c not in (*features, date)]
    melted = daily.select(*keys, date, *features).unpivot(
        [*keys, date], list(features), "feature", "value"
    )
    if long:
        return melted
    return melted.groupBy(*keys, "feature").agg(
        *(F.max(F.when(col(date).cast("string") == d, F.col("value"))).alias(d) for d in dates)
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by name; columns absent on one side are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``.

    An aggregate rather than a ranking window, so copies collapse before the
    shuffle and a key with very many copies costs one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return picked.select(
        *(col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns)
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
