"""CSV discovery and reading, stage tables, whole-text maps."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline import schema
from wakeline.functions import severity
from wakeline.functions import values as V
from wakeline.functions.timeops import parse_timestamp
from wakeline.operators.joins import salted_join

DERIVED_FILES = ("geo_data.csv", "engine_data.csv")

_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.TELEMETRY])


def _csv(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return (
        spark.read.schema(_TEXT)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("ignoreCorruptFiles", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .csv(path)
    )


def _has_raw_files(spark: SparkSession, path: str, derived: Sequence[str]) -> bool:
    """Is there a CSV file that is not a derived one, with rows or without? Contents are not read."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(path)
        .select(F.element_at(F.split("path", "/"), -1).alias("name"))
    )
    return not found.filter(~F.col("name").isin(*derived)).isEmpty()


def read_csv_folder(
    spark: SparkSession, path: str, *, derived: Sequence[str] = DERIVED_FILES
) -> DataFrame:
    """Every telemetry CSV below a folder, with column ``file``.

    Names and types are fixed and headers skipped; unreadable values become
    null and unreadable files are skipped. Derived files count only if the
    folder holds nothing else.
    """
    lines = _csv(spark, path, "*.csv").withColumns(
        {"file": F.col("_metadata.file_path"), "_name": F.col("_metadata.file_name")}
    )
    chosen = lines.filter(~F.col("_name").isin(*derived)) if _has_raw_files(spark, path, derived) else lines
    return chosen.select(
        parse_timestamp("time").alias("time"),
        "node_id",
        "node_name",
        "signal_name_alias",
        V.to_number("value").alias("value"),
        "signal_instance",
        "file",
    )


def classify_files(
    df: DataFrame, *, group: str = "file", spread_by: Sequence[str] = ("time",)
) -> DataFrame:
    """Add ``is_geo``: true where no row of the file names an engine side."""
    kinds = df.groupBy(group).agg(F.bool_and(F.col("signal_instance").isNull()).alias("is_geo"))
    return salted_join(df, kinds, [group], spread_by, "left")


def split_geo_engine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Position rows, and engine rows with the side named."""
    geo = df.filter("is_geo").drop("is_geo")
    engine = df.filter("not is_geo").drop("is_geo")
    return geo, engine.withColumn("signal_instance", V.side_name("signal_instance"))


def write_trip_files(
    df: DataFrame, path: str, *, trips_per_folder: int = 1000, file_format: str = "parquet"
) -> DataFrame:
    """One folder per device, range of trips and measurement; hands back a scan.

    A folder per single trip would drown a file system in tiny files, so trips
    share folders and ``trip_id`` stays a column. Rebalancing gathers a folder's
    rows in one task unless there are many.
    """
    keys = ["node_id", "trips", "measurement"]
    placed = df.withColumn("trips", F.floor(F.col("trip_id") / trips_per_folder))
    (
        placed.hint("rebalance", *(F.col(k) for k in keys))
        .sortWithinPartitions(*keys, "trip_id", "time")
        .write.mode("overwrite")
        .partitionBy(*keys)
        .format(file_format)
        .save(path)
    )
    return df.sparkSession.read.schema(placed.schema).format(file_format).load(path).select(*df.columns)


def write_stage(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a stage and hand back a scan of it. Never the path ``df`` reads from."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], *, small: bool = False
) -> None:
    """Overwrite only the partitions that occur in ``df``.

    Rebalancing gathers small partitions into one file and splits large ones.
    ``small`` is for tables of many partitions with few rows each (map cells):
    these are spread over all cores, as opening the files is what takes time.
    """
    columns = [F.col(c) for c in partition_by]
    if small:
        placed = df.repartition(df.sparkSession.sparkContext.defaultParallelism, *columns)
    else:
        placed = df.hint("rebalance", *columns)
    (
        placed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def drop_partitions(spark: SparkSession, path: str, partitions: Sequence[str]) -> None:
    """Delete partition folders such as ``date=2024-01-08/hour=12``; one that is not there is no fault."""
    for partition in partitions:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{partition}")
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def read_texts(spark: SparkSession, path: str, *, pattern: str = "*.html") -> DataFrame:
    """Whole files as ``(path, value)``; roll-ups written beside their inputs are left out."""
    texts = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .text(path, wholetext=True)
    )
    return texts.select(F.col("_metadata.file_path").alias("path"), "value").filter(
        ~F.element_at(F.split("path", "/"), -1).startswith("aggregated")
    )


# The call that draws a polygon in a saved map, and its colour option.
POLYGON_CALL = "L.polygon("
COLOUR_OPTION = "color"


def extract_polygons(texts: DataFrame, *, text: str = "value") -> DataFrame:
    """One row per polygon: ``ring`` text, parsed ``coordinates`` of its outer ring and ``colour`` (null where it has none).

    The text is split at the drawing calls, so that no polygon can take what belongs to the next. A call's first
    argument is a nested array, which ends where its brackets are balanced, whatever blanks are in it; the JSON reader
    reads it, and what follows it, if that is an object.
    """
    keys = [c for c in texts.columns if c != text]
    # Whatever precedes the first call is no polygon.
    calls = F.slice(F.split(text, re.escape(POLYGON_CALL)), 2, 1 << 30)
    rows = texts.select(*keys, F.explode(calls).alias("_call")).withColumn("_call", F.ltrim(_flat("_call")))
    rows = rows.filter(F.col("_call").startswith("[")).withColumn("_parts", F.split("_call", r"\]"))
    opened = F.aggregate(
        F.col("_parts"),
        F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("end")),
        lambda s, part: F.struct(
            (s["depth"] + F.length(part) - F.length(F.replace(part, F.lit("["))) - 1).alias("depth"),
            (s["at"] + 1).alias("at"),
            F.when((s["end"] == 0) & (s["depth"] + F.length(part) - F.length(F.replace(part, F.lit("["))) == 1), s["at"] + 1)
            .otherwise(s["end"])
            .alias("end"),
        ),
    )
    # After the last bracket there is one part more than there are brackets; an end there means that none was found.
    end = opened["end"]
    rows = rows.withColumn("_end", F.when((end > 0) & (end < F.size("_parts")), end)).filter("_end is not null")
    ring = F.concat(F.array_join(F.slice("_parts", 1, F.col("_end")), "]"), F.lit("]"))
    rows = rows.withColumn("ring", ring)
    nested = F.col("ring").rlike(r"^\[\s*\[\s*\[")  # with holes: the first ring is the outer one
    outer = F.get(F.from_json("ring", "array<array<array<double>>>"), F.lit(0))
    rows = rows.withColumns(
        {
            "coordinates": F.when(nested, outer).otherwise(F.from_json("ring", "array<array<double>>")),
            "_rest": F.ltrim(F.expr("substring(_call, length(ring) + 1)")),
        }
    )
    options = F.ltrim(F.expr("substring(_rest, 2)"))
    colour = F.from_json(options, f"`{COLOUR_OPTION}` string")[COLOUR_OPTION]
    return (
        rows.withColumn("colour", F.when(F.col("_rest").startswith(",") & options.startswith("{"), colour))
        .filter(F.col("coordinates").isNotNull())
        .select(*keys, "ring", "colour", "coordinates")
    )


def _flat(text: str) -> Column:
    """Line breaks and tabs as blanks, which JSON does not mind."""
    return F.translate(text, "\n\r\t", "   ")


def daily_polygons(polygons: DataFrame) -> DataFrame:
    """Worst colour per ring over all maps."""
    return polygons.groupBy("ring").agg(
        severity.rank_colour(F.max(severity.colour_rank("colour"))).alias("colour")
    )
