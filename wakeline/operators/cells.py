"""Map cells and per-trip movement metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.functions import geo, globe, severity
from wakeline.functions.timeops import col
from wakeline.operators import selection
from wakeline.operators.joins import salted_join
from wakeline.operators.sliced import previous_row
from wakeline.session import stored

TRIP_KEYS = ("node_name", "tripID")


def median_positions(df: DataFrame, *, keys: Sequence[str] = TRIP_KEYS) -> DataFrame:
    """Median latitude and longitude per trip."""
    return selection.medians(df, ["LAT", "LON"], keys=keys)


def _vessels(name: str):
    """Sorted distinct names as text; the set is merged before the shuffle."""
    return F.array_join(F.array_sort(F.collect_set(name)), ", ").alias("vessels")


def vessel_names(df: DataFrame, *, trip: Sequence[str], name: str = "node_name") -> DataFrame:
    """Vessels per trip."""
    return df.groupBy(*trip).agg(_vessels(name))


def _with_medians(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Every row with the median position of its trip."""
    medians = median_positions(df, keys=keys).withColumnsRenamed({"LAT": "_mlat", "LON": "_mlon"})
    return salted_join(df, medians, keys, [ts], "left")


#: The position before a row, where a table has it.
LAGS = ("LAT_lag", "LON_lag")


def _lags(df: DataFrame) -> list[str]:
    return [c for c in LAGS if c in df.columns]


def _with_legs(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str]) -> DataFrame:
    """Every row with the position before it in the trip; a table that has it already is taken as it is."""
    if set(LAGS) <= set(df.columns):
        return df
    return previous_row(df, ["LAT", "LON"], keys, ts, tie)


def max_distance_to_median(
    df: DataFrame, *, keys: Sequence[str] = TRIP_KEYS, ts: str = "ts", distance=geo.haversine_nm
) -> DataFrame:
    """Largest distance of a trip's rows to its median position."""
    placed = _with_medians(df.select(*keys, ts, "LAT", "LON"), keys, ts)
    away = placed.select(*keys, distance("LAT", "LON", "_mlat", "_mlon").alias("_d"))
    return away.groupBy(*keys).agg(F.max("_d").alias("max_distance"))


def max_speed(df: DataFrame, *, keys: Sequence[str] = TRIP_KEYS, speed: str = "SOG") -> DataFrame:
    return df.groupBy(*keys).agg(F.max(speed).alias("max_speed"))


def path_length(
    df: DataFrame,
    *,
    keys: Sequence[str] = TRIP_KEYS,
    ts: str = "ts",
    tie: Sequence[str] = (),
    distance=geo.haversine_nm,
) -> DataFrame:
    """Sum of the distances between consecutive rows of a trip."""
    lagged = _with_legs(df.select(*keys, ts, *tie, "LAT", "LON", *_lags(df)), keys, ts, tie)
    legs = lagged.select(*keys, distance("LAT_lag", "LON_lag", "LAT", "LON").alias("_d"))
    return legs.groupBy(*keys).agg(F.coalesce(F.sum("_d"), F.lit(0.0)).alias("total_distance"))


def trip_summary(
    df: DataFrame,
    *,
    keys: Sequence[str] = TRIP_KEYS,
    ts: str = "ts",
    tie: Sequence[str] = (),
    distance=geo.haversine_nm,
    digits: int = 2,
) -> DataFrame:
    """Median position, vessels and rounded metrics: all of them in one aggregation."""
    slim = df.select(*dict.fromkeys([*keys, "node_name", ts, *tie, "LAT", "LON", "SOG", *_lags(df)]))
    # Medians come from the rows as they are, so that the look-back is worked out once.
    medians = median_positions(slim, keys=keys).withColumnsRenamed({"LAT": "_mlat", "LON": "_mlon"})
    rows = salted_join(_with_legs(slim, keys, ts, tie), medians, keys, [ts], "left")
    # Where the name is part of the key there is one; else the set of a trip's names.
    names = F.max("_name").alias("vessels") if "node_name" in keys else _vessels("_name")
    measured = rows.select(
        *rows.columns,
        distance("LAT", "LON", "_mlat", "_mlon").alias("_away"),
        distance("LAT_lag", "LON_lag", "LAT", "LON").alias("_leg"),
    )
    trip = measured.select(*keys, F.col("node_name").alias("_name"), "_mlat", "_mlon", "_away", "_leg", "SOG")
    return trip.groupBy(*keys).agg(
        F.max("_mlat").alias("LAT"),
        F.max("_mlon").alias("LON"),
        names,
        F.round(F.max("_away"), digits).alias("max_distance"),
        F.round(F.max("SOG"), digits).alias("max_speed"),
        F.round(F.coalesce(F.sum("_leg"), F.lit(0.0)), digits).alias("total_distance"),
    )


def cell_counts(
    rows: DataFrame,
    *,
    flag: str = "anomalous",
    by: Sequence[str | Column] = (),
    keys: Sequence[str] = TRIP_KEYS,
    size: float = geo.CELL_SIZE,
    level: int | None = None,
    approx: bool = False,
) -> DataFrame:
    """Distinct flagged trips per cell (and ``by``); cells only other rows touch count 0. With ``level`` cells are
    those of the globe (:mod:`wakeline.functions.globe`).

    The distinct count runs in two aggregations, by (cell, trip) and by cell, so
    a busy harbour cell is spread over its trips. ``approx`` needs only one.
    """
    trip = F.when(F.col(flag), F.struct(*keys)).alias("_t")
    cell = geo.hex_cell("LAT", "LON", size) if level is None else globe.global_cell("LAT", "LON", level)
    placed = rows.select(*by, cell.alias("cell"), trip).filter("cell is not null")
    group = [c for c in placed.columns if c != "_t"]
    if approx:
        return placed.groupBy(*group).agg(
            F.approx_count_distinct(F.when(F.col("_t").isNotNull(), F.xxhash64("_t"))).alias("trips")
        )
    return placed.distinct().groupBy(*group).agg(F.count("_t").alias("trips"))


def hourly_cells(
    rows: DataFrame,
    *,
    ts: str = "ts",
    when: Sequence[str | Column] = (),
    size: float = geo.CELL_SIZE,
    palette=severity.DARK,
    **options,
) -> DataFrame:
    """Coloured cells per ``date`` and ``hour`` of rows with a flag; ``when`` replaces the two of ``ts``."""
    when = when or [F.to_date(ts).alias("date"), F.hour(ts).alias("hour")]
    counts = cell_counts(rows, by=when, size=size, **options)
    return counts.withColumn("colour", severity.severity_colour("trips", palette))


def numbered_keys(rows: DataFrame, keys: Sequence[str] = TRIP_KEYS, out: str = "trip_no") -> DataFrame:
    """(keys, ``out``): a whole number from 1 on for every distinct key, dense, without one task for all.

    Keys are put in order in ranges; each range is counted, and the counts before it are added.
    """
    spark = rows.sparkSession
    distinct = stored(rows.select(*keys).distinct(), "keys")
    dealt = distinct.repartitionByRange(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)
    placed = stored(dealt.select(*keys, F.spark_partition_id().alias("_part")), "keys")
    sizes = sorted(map(tuple, placed.groupBy("_part").count().collect()))  # a row a partition
    before, offsets = 0, {}
    for part, n in sizes:
        offsets[part] = before
        before += n
    start = F.create_map(*(F.lit(x) for pair in offsets.items() for x in pair))[F.col("_part")] if offsets else F.lit(0)
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    return placed.select(*keys, (start + within).cast("bigint").alias(out))


def trip_bitmaps(rows: DataFrame, numbers: DataFrame, *, by: Sequence[str], keys: Sequence[str] = TRIP_KEYS, flag: str = "anomalous") -> DataFrame:
    """Which flagged trips each cell had, as bitmaps that can be merged: (``by``, cell, bucket, trips).

    ``rows`` have ``cell``. A bitmap has 32,768 trips, one row per cell and bucket of trip numbers. Cells that only other trips
    touch have an empty one. Bits are set once a trip, cell and hour.
    """
    named = rows.where("cell is not null").select(*by, "cell", *keys, F.col(flag).alias("_flag")).distinct()
    placed = named.join(numbers, list(keys))
    bucket = F.when(F.col("_flag"), F.bitmap_bucket_number("trip_no")).otherwise(F.lit(1).cast("long"))
    position = F.when(F.col("_flag"), F.bitmap_bit_position("trip_no"))
    return placed.groupBy(*by, "cell", bucket.alias("bucket")).agg(F.bitmap_construct_agg(position).alias("trips"))


def merged_trips(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct trips per ``by`` and cell from stored bitmaps of finer times; the rows themselves are not needed."""
    merged = bitmaps.groupBy(*by, "cell", "bucket").agg(F.bitmap_or_agg("trips").alias("trips"))
    return merged.groupBy(*by, "cell").agg(F.sum(F.bitmap_count("trips")).alias("trips"))


def box_cells(
    bounds: DataFrame,
    *,
    step: float = 0.1,
    size: float = geo.CELL_SIZE,
    lat_min="lat_min",
    lat_max="lat_max",
    lon_min="lon_min",
    lon_max="lon_max",
) -> DataFrame:
    """Cells touched by a grid of points over a box; upper edges excluded.

    ``bounds`` has one row. Grid lines are unrolled one axis at a time with a
    repartition between, so a large box is worked on in parallel.
    """

    def ticks(low, high):
        n = F.ceil((col(high) - col(low)) / step)
        return F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1))

    rows = bounds.select(
        "*", F.explode(ticks(lat_min, lat_max)).alias("_i")
    ).repartition("_i")
    points = rows.select(
        (col(lat_min) + F.col("_i") * F.lit(step)).alias("lat"),
        col(lon_min).alias("_lon0"),
        F.explode(ticks(lon_min, lon_max)).alias("_j"),
    )
    return points.select(
        geo.hex_cell("lat", F.col("_lon0") + F.col("_j") * F.lit(step), size).alias("cell")
    ).distinct()


def coloured_cells(counts: DataFrame, *, palette=severity.DARK, size: float = geo.CELL_SIZE) -> DataFrame:
    """Cells with colour and outline."""
    return counts.withColumns(
        {
            "colour": severity.severity_colour("trips", palette),
            "boundary": geo.hex_boundary("cell", size),
        }
    )


def worst_colour(cells: DataFrame, *, keys: Sequence[str] = ("date", "cell")) -> DataFrame:
    """Worst colour of each cell over all its maps."""
    return cells.groupBy(*keys).agg(
        severity.rank_colour(F.max(severity.colour_rank("colour"))).alias("colour")
    )
