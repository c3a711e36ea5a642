"""Streams with a state of their own: period means and densely numbered trips that are right after every batch.

Spark's windowed aggregates give a period or a session once the watermark has passed it, so the last ones come out only
when later rows move it on. Here each batch gives the present version of every period or trip it touched, and a table of
versions is read by taking the last one. After any batch the table equals the batch result over all rows so far.

A key remembers the newest time it has seen. What lies more than ``delay`` before that is final: it leaves the state, and rows that still come for it
go to a side output, ``kind = 'late'``, with how many they are. A key that has had no rows for ``idle`` of processing time is closed by
a timer. Rows are merged per task before they are dealt out by key, so a vessel with a third of the rows sends summaries.

The state store has to be RocksDB: ``stateful_session(spark)``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from wakeline import schema
from wakeline.functions.timeops import MICROS, round_time

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BATCH = "batch"


def stateful_session(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    return spark


class _Keyed(StatefulProcessor):
    """Newest time of a key, and a timer that closes it when nothing has come for a while."""

    def __init__(self, delay_seconds: float, idle_seconds: float | None):
        self.delay, self.idle = int(delay_seconds * MICROS), idle_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "us long")

    def horizon(self) -> int | None:
        """The time before which all is final."""
        return self.newest.get()[0] - self.delay if self.newest.exists() else None

    def seen(self, newest: int, timers) -> None:
        if not self.newest.exists() or newest > self.newest.get()[0]:
            self.newest.update((int(newest),))
        if self.idle is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + int(self.idle * 1000))

    def close(self) -> None:
        pass


class _Periods(_Keyed):
    """Sum and number per period; input (key..., bucket, total, n, newest)."""

    def __init__(self, keys: Sequence[str], delay_seconds: float, idle_seconds: float | None):
        super().__init__(delay_seconds, idle_seconds)
        self.keys = list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.sums = handle.getMapState("sums", "bucket long", "total double, n long, known long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        horizon, parts = self.horizon(), pd.concat(list(rows), ignore_index=True)
        late = parts["bucket"] < horizon if horizon is not None else pd.Series(False, index=parts.index)
        out = [{"bucket": int(b), "value": None, "n": int(n), "kind": "late"} for b, n in parts[late].groupby("bucket")["n"].sum().items()]
        for bucket, part in parts[~late].groupby("bucket"):
            place = (int(bucket),)
            total, n, known = self.sums.getValue(place) if self.sums.containsKey(place) else (0.0, 0, 0)
            # Rows without a number count, but have no sum; a period of such rows only has no mean.
            total = float(total) + float(part["total"].fillna(0.0).sum())
            n, known = int(n) + int(part["n"].sum()), int(known) + int(part["known"].sum())
            self.sums.updateValue(place, (total, n, known))
            out.append({"bucket": int(bucket), "value": total / known if known else None, "n": n, "kind": "period"})
        self.seen(parts["newest"].max(), timerValues)
        horizon = self.horizon()
        for (bucket,) in [b for b in self.sums.keys() if b[0] < horizon]:
            self.sums.removeKey((bucket,))
        yield self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.sums.clear()
        yield self._frame(key, [])

    def _frame(self, key, out: list[dict]) -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=["bucket", "value", "n", "kind"])
        frame["value"] = frame["value"].astype("float64")
        for name, value in zip(reversed(self.keys), reversed(key)):
            frame.insert(0, name, pd.Series([value] * len(frame), dtype=object))
        return frame


class _Trips(_Keyed):
    """Open trips and how many are closed; input (key..., first, last, n) of rows that belong together."""

    def __init__(self, keys: Sequence[str], gap_seconds: float, delay_seconds: float, idle_seconds: float | None):
        super().__init__(delay_seconds, idle_seconds)
        self.keys, self.gap = list(keys), int(gap_seconds * MICROS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.trips = handle.getValueState("open", "first array<long>, last array<long>, n array<long>")
        self.count = handle.getValueState("count", "closed long, given long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        horizon, parts = self.horizon(), pd.concat(list(rows), ignore_index=True)
        late = parts["last"] < horizon if horizon is not None else pd.Series(False, index=parts.index)
        out = [{"trip_id": None, "first": int(p.first), "last": int(p.last), "n": int(p.n), "kind": "late"} for p in parts[late][["first", "last", "n"]].itertuples(index=False, name="Part")]
        parts = parts[~late]
        closed, given = map(int, self.count.get()) if self.count.exists() else (0, 0)
        if len(parts):
            first, last, n = (parts[c].to_numpy(np.int64) for c in ("first", "last", "n"))
            if self.trips.exists():
                first, last, n = (np.concatenate((np.array(list(a), np.int64), b)) for a, b in zip(self.trips.get(), (first, last, n)))
            first, last, n = merged(first, last, n, self.gap)
            self.seen(int(last.max()), timerValues)
            numbers = closed + 1 + np.arange(len(first))
            out += [{"trip_id": int(i), "first": int(a), "last": int(b), "n": int(c), "kind": "trip"} for i, a, b, c in zip(numbers, first, last, n)]
            # Two trips that a row between them has joined leave a number that is no more.
            out += [{"trip_id": i, "first": None, "last": None, "n": 0, "kind": "trip"} for i in range(int(numbers[-1]) + 1, given + 1)]
            given = int(numbers[-1])
            done = int((last + self.gap < self.horizon()).sum())  # ascending, as they do not overlap
            closed += done
            self.trips.update(tuple(v[done:].tolist() for v in (first, last, n)))
            self.count.update((closed, given))
        yield self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.count.exists():
            given = int(self.count.get()[1])
            self.count.update((given, given))
        self.trips.clear()
        yield self._frame(key, [])

    def _frame(self, key, out: list[dict]) -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=["trip_id", "first", "last", "n", "kind"])
        for c in ("trip_id", "first", "last", "n"):
            frame[c] = frame[c].astype("Int64")
        for name, value in zip(reversed(self.keys), reversed(key)):
            frame.insert(0, name, pd.Series([value] * len(frame), dtype=object))
        return frame


def merged(first: np.ndarray, last: np.ndarray, n: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals joined where one begins no more than ``gap`` after all before it have ended; ascending."""
    order = np.argsort(first, kind="stable")
    first, last, n = first[order], np.maximum.accumulate(last[order]), n[order]
    new = np.flatnonzero(np.concatenate(([True], first[1:] - last[:-1] > gap)))
    ends = np.append(new[1:], len(first)) - 1
    return first[new], last[ends], np.add.reduceat(n, new)


def _per_task(df: DataFrame, schema_: StructType | str, work: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield work(frame)

    return df.mapInPandas(run, schema_)


def _with(keys: Sequence[str], df: DataFrame, ddl: str) -> StructType:
    return StructType([*(df.schema[k] for k in keys), *StructType.fromDDL(ddl).fields])


def period_means(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("node_name", "signal_name_alias"),
    step_seconds: int = schema.RESAMPLE_STEP_SECONDS,
    delay_seconds: float = 3600,
    idle_seconds: float | None = None,
    ts: str = "time",
    value: str = "value",
) -> DataFrame:
    """Versions (key..., bucket, value, n, kind) of the mean per even period, half-even rounded; ``late`` rows beside them."""
    stateful_session(df.sparkSession)
    bucket = F.unix_micros(round_time(F.col(ts).cast("timestamp_ntz"), step_seconds).cast("timestamp"))
    known = [F.col(k) for k in keys]
    rows = df.where(F.col(ts).isNotNull()).select(*known, bucket.alias("bucket"), F.unix_micros(F.col(ts).cast("timestamp")).alias("newest"), F.col(value).cast("double").alias("total"))
    partial = _with(keys, rows, "bucket long, total double, n long, known long, newest long")

    def combine(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.assign(n=1, known=frame["total"].notna().astype("int64"))
        grouped = frame.groupby([*keys, "bucket"], dropna=False, sort=False).agg(
            total=("total", "sum"), n=("n", "sum"), known=("known", "sum"), newest=("newest", "max")
        )
        return grouped.reset_index()[partial.fieldNames()]

    out = _with(keys, rows, "bucket long, value double, n long, kind string")
    mode = "None" if idle_seconds is None else "ProcessingTime"
    return _per_task(rows, partial, combine).groupBy(*keys).transformWithStateInPandas(
        _Periods(keys, delay_seconds, idle_seconds), out, "Update", mode
    )


def dense_trips(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("node_name",),
    gap_seconds: float = schema.GPS_GAP_SECONDS,
    delay_seconds: float = 3600,
    idle_seconds: float | None = None,
    ts: str = "time",
) -> DataFrame:
    """Versions (key..., trip_id, first, last, n, kind) of trips numbered 1, 2, ... per key, times in microseconds; a trip of no rows is no more."""
    stateful_session(df.sparkSession)
    rows = df.where(F.col(ts).isNotNull()).select(*keys, F.unix_micros(F.col(ts).cast("timestamp")).alias("first"))
    partial = _with(keys, rows, "first long, last long, n long")
    gap = int(gap_seconds * MICROS)

    def combine(frame: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for key, group in frame.groupby(list(keys), dropna=False, sort=False):
            at = group["first"].to_numpy(np.int64)
            first, last, n = merged(at, at, np.ones(len(at), np.int64), gap)
            part = pd.DataFrame({"first": first, "last": last, "n": n})
            for name, value in zip(keys, key):
                part[name] = pd.Series([None if value is None or value != value else value] * len(part), dtype=object)
            parts.append(part)
        return pd.concat(parts, ignore_index=True)[partial.fieldNames()]

    out = _with(keys, rows, "trip_id long, first long, last long, n long, kind string")
    mode = "None" if idle_seconds is None else "ProcessingTime"
    return _per_task(rows, partial, combine).groupBy(*keys).transformWithStateInPandas(
        _Trips(keys, gap_seconds, delay_seconds, idle_seconds), out, "Update", mode
    )


def run_versions(versions: DataFrame, path: str, checkpoint: str, *, every: str | None = None) -> StreamingQuery:
    """Store the versions of each batch under its number; a batch that is done again replaces itself."""

    def step(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    writer = versions.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint)
    if every is not None:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_versions(spark: SparkSession, path: str, versions: DataFrame) -> DataFrame:
    return spark.read.schema(StructType([*versions.schema.fields, StructField(BATCH, IntegerType())])).parquet(path)


def latest(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last version of each period or trip; late rows are left out, and what is no more."""
    payload = [c for c in table.columns if c not in (*keys, BATCH, "kind")]
    kept = table.where("kind <> 'late'").groupBy(*keys).agg(F.max_by(F.struct(*payload), F.col(BATCH)).alias("_v"))
    return kept.select(*keys, "_v.*").where("n > 0")


def late_rows(table: DataFrame) -> DataFrame:
    """What came too late, as it came."""
    return table.where("kind = 'late'")
