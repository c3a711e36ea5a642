"""Fixed-length row sequences per trip, their padding and flattening."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schema
from wakeline.operators.sliced import row_numbers
from wakeline.session import stored


def trim_to_multiple(
    df: DataFrame,
    rows: int,
    *,
    keys: Sequence[str],
    ts: str = "ts",
    tie: Sequence[str] = (),
    number: str = "row_no",
) -> DataFrame:
    """Cut the tail of each trip so that its length is a multiple of ``rows``."""
    counted = row_numbers(df, keys, ts, tie, number=number, total="_total")
    whole = F.col("_total") - F.pmod(F.col("_total"), F.lit(rows))
    return counted.filter(F.col(number) <= whole).drop("_total")


def number_sequences(
    df: DataFrame,
    rows: int,
    *,
    keys: Sequence[str],
    ts: str = "ts",
    tie: Sequence[str] = (),
    whole_only: bool = False,
    number: str | None = None,
) -> DataFrame:
    """``row_no`` in the trip and ``seq_id`` of its chunk of ``rows`` rows. Rows that are numbered (and trimmed) already name
    the column in ``number``."""
    if number:
        counted = df if number == "row_no" else df.withColumn("row_no", F.col(number))
    elif whole_only:
        counted = trim_to_multiple(df, rows, keys=keys, ts=ts, tie=tie)
    else:
        counted = row_numbers(df, keys, ts, tie)
    return counted.withColumn("seq_id", F.floor((F.col("row_no") - 1) / rows))


def to_sequences(
    df: DataFrame,
    rows: int,
    features: Sequence[str],
    *,
    keys: Sequence[str],
    ts: str = "ts",
    tie: Sequence[str] = (),
    carry: Sequence[str] = (),
    whole_only: bool = False,
    number: str | None = None,
) -> DataFrame:
    """One row per chunk: ``length``, feature rows ``seq`` and row keys ``index``.

    Chunks hold at most ``rows`` rows, so no array grows with a trip. Rows
    without key or time have no place in a sequence.
    """
    numbered = number_sequences(df, rows, keys=keys, ts=ts, tie=tie, whole_only=whole_only, number=number)
    numbered = numbered.filter(F.col("seq_id").isNotNull())
    item = F.struct(
        "row_no",
        F.array(*(F.col(f).cast("double") for f in features)).alias("x"),
        F.struct("row_no", ts, *carry).alias("key"),
    )
    grouped = numbered.groupBy(*keys, "seq_id").agg(
        F.array_sort(F.collect_list(item)).alias("_items")
    )
    return grouped.select(
        *keys,
        "seq_id",
        F.size("_items").alias("length"),
        F.col("_items.x").alias("seq"),
        F.col("_items.key").alias("index"),
    )


def pad_sequences(
    df: DataFrame, *, length: int | None = None, width: int, pad: float = schema.PAD_VALUE
) -> DataFrame:
    """Append pad rows until all sequences are equally long.

    ``length`` defaults to the longest sequence present; the sequences are stored then, as they are read twice. The
    true length stays in ``length``.
    """
    if length is None:
        df = stored(df, "sequences")
        longest = df.agg(F.max("length")).scalar()
        df = df.withColumn("_longest", longest)
    else:
        df = df.withColumn("_longest", F.lit(length))
    filler = F.array_repeat(
        F.array_repeat(F.lit(float(pad)), width), F.col("_longest") - F.col("length")
    )
    return df.withColumn("seq", F.concat("seq", filler)).drop("_longest")


def flatten_sequences(
    df: DataFrame, features: Sequence[str], *, keys: Sequence[str], seq: str = "seq"
) -> DataFrame:
    """Back to one row per original row; padding goes by the carried length."""
    items = F.arrays_zip(F.slice(F.col(seq), F.lit(1), F.col("length")).alias("x"), "index")
    rows = df.select(*keys, "seq_id", F.explode(items).alias("_row"))
    return rows.select(
        *keys,
        "seq_id",
        F.col("_row.index.*"),
        *(F.col("_row.x")[i].alias(f) for i, f in enumerate(features)),
    )
