"""Model input: statistics, scaling, outliers, encoding, splitting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import schema
from wakeline.functions import values as V
from wakeline.functions.timeops import col
from wakeline.operators.joins import salted_join


def _one_row(stats: DataFrame) -> Column:
    """A one-row table as a struct usable in any expression (scalar subquery)."""
    return stats.select(F.struct(*stats.columns).alias("s")).scalar()


def moments(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation of each feature."""
    return df.groupBy(*by).agg(
        *(F.avg(f).alias(f"{f}_mean") for f in features),
        *(F.stddev_pop(f).alias(f"{f}_std") for f in features),
    )


def drop_outliers(
    df: DataFrame,
    features: Sequence[str],
    *,
    threshold: float = schema.Z_THRESHOLD,
    two_sided: bool = True,
    by: Sequence[str] = (),
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Rows whose z-score is below the threshold on every feature.

    A feature with no spread is ignored; a null value fails the test. The
    statistics are global, or per ``by`` (then joined back, salted by
    ``spread_by``).
    """
    stats = moments(df, features, by)
    if by:
        scored = salted_join(df, stats, by, spread_by or list(features), "left")
        stat = F.col
    else:
        scored = df.withColumn("_stats", _one_row(stats))
        stat = lambda name: F.col(f"_stats.{name}")
    keep = F.lit(True)
    for f in features:
        z = V.z_score(f, stat(f"{f}_mean"), stat(f"{f}_std"))
        inside = (F.abs(z) if two_sided else z) < threshold
        flat = (stat(f"{f}_std") == 0) & col(f).isNotNull()
        keep = keep & (flat | inside)
    return scored.filter(keep).select(*df.columns)


def z_scores(df: DataFrame, features: Sequence[str]) -> DataFrame:
    scored = df.withColumn("_stats", _one_row(moments(df, features)))
    return scored.select(
        *df.columns,
        *(
            V.z_score(f, F.col(f"_stats.{f}_mean"), F.col(f"_stats.{f}_std")).alias(f"{f}_z")
            for f in features
        ),
    )


def fit_min_max(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row of ranges; write it with any Spark writer to reuse it."""
    return df.agg(
        *(F.min(f).alias(f"{f}_min") for f in features),
        *(F.max(f).alias(f"{f}_max") for f in features),
    )


def apply_min_max(df: DataFrame, ranges: DataFrame, features: Sequence[str]) -> DataFrame:
    scaled = df.withColumn("_range", _one_row(ranges))
    return scaled.select(
        *(
            V.min_max(c, F.col(f"_range.{c}_min"), F.col(f"_range.{c}_max")).alias(c)
            if c in features
            else c
            for c in df.columns
        )
    )


def split_by_date(
    df: DataFrame, *, date: str = "date", split: str = schema.SPLIT_DATE
) -> tuple[DataFrame, DataFrame]:
    """Rows up to and including the date, and rows after it."""
    cut = F.lit(split).cast("date")
    return df.filter(col(date) <= cut), df.filter(col(date) > cut)


def encode_binary(df: DataFrame, column: str) -> DataFrame:
    """Alphabetical 0/1 codes if the column has exactly two values, else unchanged.

    Both values and their number come from one aggregate row. The column turns
    into text either way so that the schema does not depend on the data.
    """
    stats = df.agg(
        F.min(column).alias("low"),
        F.max(column).alias("high"),
        F.count_distinct(column).alias("n"),
    )
    two = F.col("_codes.n") == 2
    coded = (
        F.when(two & (col(column) == F.col("_codes.low")), "0")
        .when(two & (col(column) == F.col("_codes.high")), "1")
        .otherwise(col(column).cast("string"))
    )
    return (
        df.withColumn("_codes", _one_row(stats)).withColumn(column, coded).select(*df.columns)
    )


def select_features(df: DataFrame, features: Sequence[str], index: Sequence[str]) -> DataFrame:
    return df.select(*features, *index)


def training_set(
    df: DataFrame,
    *,
    features: Sequence[str] = schema.SCALED_FEATURES,
    index: Sequence[str] = ("node_name", "date", "time", "TRIP_ID"),
    side: str = "signal_instance",
    split: str = schema.SPLIT_DATE,
    threshold: float = schema.Z_THRESHOLD,
) -> DataFrame:
    """Complete rows without outliers, scaled by the range of the training dates.

    Column ``part`` says ``train`` or ``test``. The range is fitted on the
    training part only and applied to both.
    """
    clean = drop_outliers(df.na.drop("any"), features, threshold=threshold)
    train, _ = split_by_date(clean, split=split)
    scaled = apply_min_max(clean, fit_min_max(train, features), features)
    part = F.when(F.col("date") <= F.lit(split).cast("date"), "train").otherwise("test")
    return (
        scaled.withColumn(side, V.side_code(side))
        .select(*features, side, *index, part.alias("part"))
    )


def inference_set(
    df: DataFrame,
    ranges: DataFrame,
    *,
    features: Sequence[str] = schema.SCALED_FEATURES,
    index: Sequence[str] = ("node_name", "date", "time", "TRIP_ID"),
    side: str = "signal_instance",
) -> DataFrame:
    """Complete rows scaled by an existing range."""
    scaled = apply_min_max(df.na.drop("any"), ranges, features)
    return scaled.withColumn(side, V.side_code(side)).select(*features, side, *index)
