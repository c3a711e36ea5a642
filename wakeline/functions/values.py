"""Row-wise value expressions: coercion, recoding, residuals, scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import schema
from wakeline.functions.timeops import col


def to_number(text: str | Column) -> Column:
    """Double, or null where the text is no number or the number is NaN."""
    number = col(text).try_cast("double")
    return F.when(~F.isnan(number), number)


def no_sentinels(value: str | Column, sentinels: Sequence[float] = schema.SENTINELS) -> Column:
    """True unless the value is a sentinel; null values fail the test as in SQL."""
    keep = F.lit(True)
    for sentinel in sentinels:
        keep = keep & (col(value) != F.lit(sentinel))
    return keep


def side_name(instance: str | Column) -> Column:
    """Engine side: ``0`` is port, ``1`` starboard, anything else stays."""
    return F.when(col(instance) == "0", "P").when(col(instance) == "1", "SB").otherwise(col(instance))


def side_code(side: str | Column) -> Column:
    """Starboard 1, port 0, anything else null."""
    return F.when(col(side) == "SB", 1).when(col(side) == "P", 0)


def is_running(rpm: str | Column) -> Column:
    """1 where the engine turns, else 0; null counts as 0."""
    return F.when(col(rpm) > 0, 1).otherwise(0)


def binarise(value: str | Column, cut: float = 0.5) -> Column:
    return F.when(col(value) < cut, 0).otherwise(1)


def flag_score(score: str | Column, threshold: float = schema.GPS_SCORE_THRESHOLD) -> Column:
    return (col(score) >= threshold).cast("int")


def squared_residual(actual: str | Column, rebuilt: str | Column) -> Column:
    diff = col(actual) - col(rebuilt)
    return diff * diff


def absolute_residual(actual: str | Column, rebuilt: str | Column) -> Column:
    return F.abs(col(actual) - col(rebuilt))


def z_score(value, mean, deviation) -> Column:
    """Null where the deviation is 0."""
    return (col(value) - col(mean)) / F.nullif(col(deviation), F.lit(0.0))


def min_max(value, low, high) -> Column:
    """0..1 over the fitted range; a constant column gives 0 at its value."""
    span = col(high) - col(low)
    return (col(value) - col(low)) / F.when(span == 0, F.lit(1.0)).otherwise(span)


def ensure_columns(df: DataFrame, names: Sequence[str], default=None) -> DataFrame:
    """Add the columns a source did not deliver, as doubles holding ``default``."""
    missing = {n: F.lit(default).cast("double") for n in names if n not in df.columns}
    return df.withColumns(missing) if missing else df
