"""Telemetry as streams. Event time is a zoned timestamp read in UTC."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wakeline import schema
from wakeline.functions.timeops import round_time
from wakeline.session import remove
from wakeline.session import stored as stored_table
from wakeline.sources.files import drop_partitions, replace_partitions


#: A time no reading has.
FAR_AHEAD = "2999-01-01 00:00:00"


def stream_table(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A parquet table as a stream, be it a folder of files or a single file."""
    batch = spark.read.parquet(path)
    reader = spark.readStream.schema(batch.schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    found = batch.select("_metadata.file_path").first()
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if found is not None and found["file_path"].endswith(f"/{name}"):
        return reader.option("pathGlobFilter", name).parquet(path.rstrip("/").rsplit("/", 1)[0])
    return reader.parquet(path)


def event_time(df: DataFrame, ts: str = "time") -> DataFrame:
    """Watermarks need a zoned timestamp."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def resample_stream(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("node_name", "signal_name_alias"),
    step_seconds: int = schema.RESAMPLE_STEP_SECONDS,
    delay: str = "1 hour",
    ts: str = "time",
    value: str = "value",
) -> DataFrame:
    """Mean per key and even period; a period is final once the watermark passes it."""
    bucket = round_time(F.col(ts).cast("timestamp_ntz"), step_seconds).cast("timestamp")
    placed = df.withColumn("bucket", bucket).withWatermark("bucket", delay)
    return placed.groupBy(*keys, "bucket").agg(
        F.avg(value).alias("value"), F.count(F.lit(1)).alias("n")
    )


def trip_stream(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("node_name",),
    gap_seconds: int = schema.GPS_GAP_SECONDS,
    delay: str = "1 hour",
    ts: str = "time",
) -> DataFrame:
    """Trip intervals as session windows; two rows exactly the gap apart stay together.

    Sessions are merged before the shuffle where the session setting
    ``spark.sql.sessionWindow.merge.sessions.in.local.partition`` allows it.
    """
    session = F.session_window(ts, f"{gap_seconds} seconds")
    return (
        df.withWatermark(ts, delay)
        .groupBy(*keys, session)
        .agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_time"), F.max(ts).alias("last_time"))
        .drop("session_window")
    )


def distinct_stream(
    df: DataFrame, keys: Sequence[str], *, delay: str = "1 hour", ts: str = "time"
) -> DataFrame:
    """First arrival of each key, remembered for the watermark delay."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def flush_row(spark: SparkSession, path: str, schema_of: DataFrame, ts: str = "ts") -> None:
    """Put a last file into a stream's folder whose only row lies far ahead of all others.

    It moves the watermark past everything, so that periods and sessions still open come out. The row itself has
    nothing but its time and never comes out, as nothing later closes its own period.
    """
    fields = schema_of.schema.fields
    kind = schema_of.schema[ts].dataType
    row = spark.range(1).select(
        *((F.lit(FAR_AHEAD).cast(kind) if f.name == ts else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields)
    )
    row.coalesce(1).write.mode("append").parquet(path)


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came later than the watermark allows and were left out of the state, by the last progress reports."""
    return sum(
        int(state["numRowsDroppedByWatermark"]) for p in query.recentProgress for state in p["stateOperators"]
    )


def run_available(
    df: DataFrame, path: str, checkpoint: str, *, mode: str = "append", partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Process what is there, write parquet, stop."""
    query = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query


def refresh(
    stream: DataFrame,
    body: Callable[[DataFrame], DataFrame],
    landing: str,
    path: str,
    checkpoint: str,
    *,
    ts: str = "time",
    every: str | None = None,
    small: bool = False,
) -> StreamingQuery:
    """Re-run a batch job for every hour that received rows.

    A pull is first stored under its date and its name (the stream's id and the batch number, so that a stream
    started anew does not overwrite another's pulls); then the whole hours it touches are read back (pruned to their dates),
    passed through ``body``, and their ``date``/``hour`` partitions replaced, or dropped where ``body`` gives none. Late
    rows therefore complete their hour, and a repeated batch changes nothing. ``small`` is for bodies that give few rows an hour. Runs
    once over everything available, or ``every`` so often (``"1 hour"``) until stopped; ``compact`` joins a
    landing folder's files.
    """
    run = F.md5(F.lit(checkpoint))

    def step(batch: DataFrame, number: int) -> None:
        name = F.concat(F.substring(run, 1, 12), F.lit(f"-{number}"))
        placed = batch.withColumns({"date": F.to_date(ts), "hour": F.hour(ts), "pull": name})
        (
            placed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date", "pull")
            .parquet(landing)
        )
        stored = batch.sparkSession.read.schema(placed.schema).parquet(landing)
        touched = stored.filter(F.col("pull") == name).select("date", "hour").distinct()
        hours = stored.join(touched, ["date", "hour"], "left_semi").drop("pull")
        result = stored_table(body(hours), "hours")
        replace_partitions(result, path, ["date", "hour"], small=small)
        # An hour that gives nothing any more must not keep what it gave before.
        empty = touched.join(result.select("date", "hour").distinct(), ["date", "hour"], "left_anti")
        drop_partitions(batch.sparkSession, path, [f"date={r['date']}/hour={r['hour']}" for r in empty.collect()])
        remove(result)

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    if every is None:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    return writer.trigger(processingTime=every).start()


def map_of_hour(table: DataFrame, date, hour: int) -> DataFrame:
    """One archived map: a partition-pruned read."""
    return table.filter((F.col("date") == F.lit(date).cast("date")) & (F.col("hour") == hour))
