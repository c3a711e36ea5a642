"""Time expressions. Timestamps are wall-clock (NTZ) and read as UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
MICROS = 1_000_000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _session_is_utc() -> bool:
    session = SparkSession.getActiveSession()
    zone = session.conf.get("spark.sql.session.timeZone") if session else None
    return zone in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def micros(ts: str | Column) -> Column:
    """Microseconds of wall-clock time since the epoch.

    In a UTC session the zoned type holds just this number; elsewhere it is
    counted without a zone, which takes longer.
    """
    if _session_is_utc():
        return F.unix_micros(col(ts).cast("timestamp"))
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), col(ts).cast("timestamp_ntz"))


def from_micros(us: str | Column) -> Column:
    if _session_is_utc():
        return F.timestamp_micros(col(us)).cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", col(us), F.expr(_EPOCH))


def round_half_even(us: str | Column, step_seconds: int) -> Column:
    """Round a microsecond count to the nearest step; ties go to the even multiple.

    Exact in doubles below 2**53 microseconds: a tie divides to exactly one half,
    and the next microsecond is further from it than division can err.
    """
    step = step_seconds * MICROS
    return F.rint(col(us) / F.lit(float(step))).cast("bigint") * F.lit(step)


def round_time(ts: str | Column, step_seconds: int) -> Column:
    """Timestamp rounded to the step, ties to even."""
    return from_micros(round_half_even(micros(ts), step_seconds))


def seconds_between(start: str | Column, stop: str | Column) -> Column:
    return (micros(stop) - micros(start)) / F.lit(float(MICROS))


def minutes_between(start: str | Column, stop: str | Column) -> Column:
    return (micros(stop) - micros(start)) / F.lit(60.0 * MICROS)


def shift(ts: str | Column, seconds: int) -> Column:
    return F.timestamp_add("SECOND", F.lit(seconds), col(ts))


def date_of(ts: str | Column) -> Column:
    return F.to_date(col(ts))


def time_of_day(ts: str | Column) -> Column:
    return F.date_format(col(ts), "HH:mm:ss")


def seconds_of_day(hhmmss: str | Column) -> Column:
    """``HH:MM:SS`` text to seconds since midnight."""
    parts = F.split(col(hhmmss), ":")
    return (
        parts[0].cast("bigint") * 3600 + parts[1].cast("bigint") * 60 + parts[2].cast("bigint")
    )


def hour_of(ts: str | Column) -> Column:
    """Start of the hour, type kept."""
    return F.date_trunc("hour", col(ts)).cast("timestamp_ntz")


def previous_hour(ts: str | Column) -> Column:
    return shift(hour_of(ts), -3600)


def nearest_hour(ts: str | Column) -> Column:
    """Closest full hour; a reading at exactly hh:30 belongs to the later hour."""
    return hour_of(shift(ts, 30 * 60))


def parse_timestamp(text: str | Column) -> Column:
    """ISO-8601 text with any number of fraction digits; unreadable text becomes null."""
    return col(text).try_cast("timestamp_ntz")


def combine(date: str | Column, time: str | Column) -> Column:
    """Date column plus ``HH:MM:SS`` text to a timestamp."""
    return F.concat_ws(" ", col(date).cast("string"), col(time)).try_cast("timestamp_ntz")


def normalise_date(text: str | Column) -> Column:
    """Dates written as ``YYYY-MM-DD`` with or without a time part, as ``YYYY-MM-DD``."""
    return F.date_format(col(text).try_cast("timestamp_ntz"), "yyyy-MM-dd")


def _last_slice(start: str | Column, stop: str | Column, step: int) -> Column:
    return F.greatest(F.ceil(seconds_between(start, stop) / step) - 1, F.lit(0).cast("bigint"))


def slice_number(ts: str | Column, start: str | Column, stop: str | Column, days: int) -> Column:
    """The slice of ``date_slices`` that a time in ``[start, stop]`` lies in; null outside."""
    step = days * 24 * 3600
    place = F.least(F.floor(seconds_between(start, ts) / step), _last_slice(start, stop, step))
    return F.when((col(ts) >= col(start)) & (col(ts) <= col(stop)), place)


def date_slices(bounds: DataFrame, start: str, stop: str, days: int) -> DataFrame:
    """Cut each ``[start, stop]`` row into slices of ``days``; the last one is shorter.

    The number of slices is the length of the range over ``days``. A slice holds its start; the last one also holds
    its stop (``slice_number`` places rows so).
    """
    step = days * 24 * 3600
    cuts = F.sequence(F.lit(0).cast("bigint"), _last_slice(start, stop, step))
    return bounds.select("*", F.explode(cuts).alias("slice_no")).select(
        "slice_no",
        F.timestamp_add("SECOND", F.col("slice_no") * step, F.col(start)).alias("slice_start"),
        F.least(
            F.timestamp_add("SECOND", (F.col("slice_no") + 1) * step, F.col(start)), F.col(stop)
        ).alias("slice_stop"),
    )
