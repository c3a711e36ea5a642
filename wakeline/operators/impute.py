"""Filling gaps: constants, neighbours inside a trip, first differences, activity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schema
from wakeline.functions.timeops import MICROS, micros
from wakeline.functions.values import ensure_columns, to_number
from wakeline.operators.sliced import look_around, previous_row

_ORDERS = {
    "forward": ("prev",),
    "back_then_forward": ("next", "prev"),
    "forward_then_back": ("prev", "next"),
}


def fill(
    df: DataFrame,
    columns: Sequence[str],
    *,
    keys: Sequence[str],
    ts: str = "ts",
    tie: Sequence[str] = (),
    order: str = "forward",
    default: float | None = None,
    slice_seconds: int | None = schema.DAY_SECONDS,
) -> DataFrame:
    """Fill nulls from neighbouring rows of the key, then with ``default``.

    ``order`` is ``forward``, ``back_then_forward`` or ``forward_then_back``.
    """
    sides = _ORDERS[order]
    found = look_around(
        df, {c: sides for c in columns}, keys, ts, tie, slice_seconds=slice_seconds
    )
    extra = [] if default is None else [F.lit(default)]
    return found.select(
        *(
            F.coalesce(*(F.col(f"{c}_{s}") for s in sides), *extra).alias(c) if c in columns else c
            for c in df.columns
        )
    )


def fill_and_deltas(
    df: DataFrame,
    columns: Sequence[str],
    deltas: Sequence[str],
    *,
    keys: Sequence[str],
    ts: str = "ts",
    tie: Sequence[str] = (),
    default: float = 0.0,
    slice_seconds: int | None = schema.DAY_SECONDS,
) -> DataFrame:
    """``fill(order="back_then_forward")`` and then ``add_deltas``, in one pass.

    The filled value of the preceding row needs no second pass: it is that row's
    own value, else the next one known (which is also the next known from here),
    else the last one known before.
    """
    base = df.withColumn("_row", F.lit(1))
    wanted = {c: ["prev", "next", *(["before", "lag"] if c in deltas else [])] for c in columns}
    found = look_around(base, {**wanted, "_row": ["lag"]}, keys, ts, tie, slice_seconds=slice_seconds)
    zero = F.lit(default)

    def filled(c):
        return F.coalesce(f"{c}_next", f"{c}_prev", zero)

    def change(c):
        last = F.coalesce(f"{c}_lag", f"{c}_next", f"{c}_before", zero)
        return F.when(F.col("_row_lag").isNull(), 0.0).otherwise(filled(c) - last)

    return found.select(
        *(filled(c).alias(c) if c in columns else c for c in df.columns),
        *(change(c).alias(f"{c}_Delta") for c in deltas),
    )


def fill_constants(df: DataFrame, values: dict[str, float | str]) -> DataFrame:
    return df.na.fill(values)


def fill_event_flags(df: DataFrame, flags: Sequence[str] = schema.EVENT_FLAGS) -> DataFrame:
    """Every event flag present, null meaning not raised."""
    return ensure_columns(df, flags, 0.0).na.fill(0.0, subset=list(flags))


def fill_side(df: DataFrame, column: str = "signal_instance") -> DataFrame:
    return df.na.fill({column: "unknown"})


def add_deltas(
    df: DataFrame,
    columns: Sequence[str] = ("LAT", "LON", "SOG"),
    *,
    keys: Sequence[str],
    ts: str = "ts",
    tie: Sequence[str] = (),
) -> DataFrame:
    """``<c>_Delta``: change against the preceding row of the trip, 0 where there is none."""
    lagged = previous_row(df, columns, keys, ts, tie)
    return lagged.select(
        *df.columns,
        *(
            F.coalesce(F.col(c) - F.col(f"{c}_lag"), F.lit(0.0)).alias(f"{c}_Delta")
            for c in columns
        ),
    )


def time_steps(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("node_name",),
    ts: str = "time",
    tie: Sequence[str] = (),
) -> DataFrame:
    """Seconds since the preceding row, and whether the row starts a new day."""
    base = df.withColumns({"_us": micros(ts), "_day": F.to_date(ts)})
    lagged = previous_row(base, ["_us", "_day"], keys, ts, tie)
    return lagged.select(
        *df.columns,
        ((F.col("_us") - F.col("_us_lag")) / F.lit(float(MICROS))).alias("time_diff"),
        (F.col("_day_lag").isNull() | (F.col("_day") != F.col("_day_lag"))).alias("new_day"),
    )


def near_activity(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("node_name",),
    ts: str = "time",
    value: str = "value",
    tie: Sequence[str] = (),
    reach_seconds: int = schema.ACTIVITY_REACH_SECONDS,
) -> DataFrame:
    """Rows within reach after the last or before the next positive value."""
    coerced = df.withColumn(value, to_number(F.col(value)))
    marked = coerced.withColumn("_on", F.when(F.col(value) > 0, micros(ts)))
    found = look_around(marked, {"_on": ["prev", "next"]}, keys, ts, tie)
    reach = reach_seconds * MICROS
    near = (micros(ts) - F.col("_on_prev") <= reach) | (F.col("_on_next") - micros(ts) <= reach)
    return found.filter(near).select(*df.columns)
