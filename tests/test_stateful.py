"""Streams with their own state: right after each batch, late rows beside them, closed keys."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.session import fresh_path
from wakeline.streaming import stateful

T0 = datetime.datetime(2024, 3, 1, tzinfo=datetime.timezone.utc)
SCHEMA = "node_name string, time timestamp, signal_name_alias string, value double"


class Feed:
    """Files handed to a stream one batch at a time."""

    def __init__(self, spark, make):
        self.spark, self.base, self.make = spark, fresh_path(spark, "feed"), make

    def push(self, rows):
        df = self.spark.createDataFrame([(n, str(T0 + datetime.timedelta(seconds=s)), a, v) for n, s, a, v in rows], "node_name string, t string, signal_name_alias string, value double")
        df.select("node_name", F.col("t").cast("timestamp").alias("time"), "signal_name_alias", "value").coalesce(1).write.mode("append").parquet(f"{self.base}/in")
        versions = self.make(self.spark.readStream.schema(SCHEMA).parquet(f"{self.base}/in"))
        stateful.run_versions(versions, f"{self.base}/out", f"{self.base}/checkpoint")
        return stateful.read_versions(self.spark, f"{self.base}/out", versions)


def trips_by_hand(rows, gap):
    out = {}
    for node in {r[0] for r in rows}:
        trips = []
        for s in sorted(r[1] for r in rows if r[0] == node):
            if trips and s - trips[-1][-1] <= gap:
                trips[-1].append(s)
            else:
                trips.append([s])
        out |= {(node, i + 1): (t[0], t[-1], len(t)) for i, t in enumerate(trips)}
    return out


def got_trips(table):
    start = int(T0.timestamp()) * 10**6
    return {(r.node_name, r.trip_id): ((r["first"] - start) // 10**6, (r["last"] - start) // 10**6, r.n) for r in stateful.latest(table, ["node_name", "trip_id"]).collect()}


def test_trips_are_right_after_every_batch(spark):
    """Rows out of order, one that joins two trips, one that starts an earlier one."""
    feed = Feed(spark, lambda s: stateful.dense_trips(s, gap_seconds=60, delay_seconds=10_000))
    rnd = random.Random(2)
    rows = [("a", s, "x", 1.0) for s in (0, 30, 100, 130, 1000)] + [("b", s, "x", 1.0) for s in (5, 500)]
    batches = [rows, [("a", 70, "x", 1.0), ("b", 200, "x", 1.0)], [("a", -500, "x", 1.0), ("c", 7, "x", None)], [(rnd.choice("abc"), rnd.randrange(-600, 3000), "x", 1.0) for _ in range(80)]]
    seen = []
    for batch in batches:
        seen += batch
        table = feed.push(batch)
        assert got_trips(table) == trips_by_hand(seen, 60)
        assert stateful.late_rows(table).count() == 0


def test_late_rows_go_aside_and_closed_trips_keep_their_number(spark):
    feed = Feed(spark, lambda s: stateful.dense_trips(s, gap_seconds=60, delay_seconds=600))
    feed.push([("a", s, "x", 1.0) for s in (0, 10, 200)])
    feed.push([("a", 5000, "x", 1.0)])
    table = feed.push([("a", 20, "x", 1.0), ("a", 25, "x", 1.0), ("a", 4700, "x", 1.0), (None, 3, "x", 1.0)])
    assert got_trips(table) == {("a", 1): (0, 10, 2), ("a", 2): (200, 200, 1), ("a", 3): (4700, 4700, 1), ("a", 4): (5000, 5000, 1), (None, 1): (3, 3, 1)}
    assert [(r.node_name, r.n) for r in stateful.late_rows(table).collect()] == [("a", 2)]


def test_periods_over_several_batches(spark):
    feed = Feed(spark, lambda s: stateful.period_means(s, step_seconds=10, delay_seconds=1000))
    rnd = random.Random(6)
    seen = []
    for _ in range(3):
        batch = [(rnd.choice("ab"), rnd.choice([5, 15, 25, rnd.randrange(300)]), rnd.choice(["x", None]), rnd.choice([None, float(rnd.randrange(9))])) for _ in range(60)]
        seen += batch
        table = feed.push(batch)
        expected = {}
        for node, s, alias, v in seen:
            low = s // 10 * 10  # half-even
            half = s - low
            bucket = low + 10 * (half > 5 or (half == 5 and low // 10 % 2 == 1))
            expected.setdefault((node, alias, bucket), []).append(v)
        start = int(T0.timestamp()) * 10**6
        got = {(r.node_name, r.signal_name_alias, (r.bucket - start) // 10**6): (r.n, r.value) for r in stateful.latest(table, ["node_name", "signal_name_alias", "bucket"]).collect()}
        assert set(got) == set(expected)
        for key, values in expected.items():
            known = [v for v in values if v is not None]
            assert got[key][0] == len(values)
            assert got[key][1] == (pytest.approx(sum(known) / len(known)) if known else None)


def test_late_periods_are_counted(spark):
    feed = Feed(spark, lambda s: stateful.period_means(s, step_seconds=10, delay_seconds=100))
    feed.push([("a", 0, "x", 1.0)])
    feed.push([("a", 1000, "x", 3.0)])
    table = feed.push([("a", 0, "x", 5.0), ("a", 1, "x", 5.0), ("a", 950, "x", 7.0)])
    rows = stateful.latest(table, ["node_name", "bucket"]).select("n", "value").collect()
    assert sorted((r.n, r.value) for r in rows) == [(1, 1.0), (1, 3.0), (1, 7.0)]
    assert [r.n for r in stateful.late_rows(table).collect()] == [2]


def test_merged_intervals():
    first, last, n = (np.array(v) for v in ([0, 100, 5, 300], [10, 120, 90, 300], [2, 3, 4, 1]))
    assert [v.tolist() for v in stateful.merged(first, last, n, 10)] == [[0, 300], [120, 300], [9, 1]]
    assert [v.tolist() for v in stateful.merged(first, last, n, 1)] == [[0, 100, 300], [90, 120, 300], [6, 3, 1]]
