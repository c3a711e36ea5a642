"""The composite scan against the single operators it stands for, and against plain Python."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from wakeline.operators import impute, segments, sliced, trips
from wakeline.session import stored

T0 = datetime.datetime(2024, 1, 1, 22, 0)


def rows_of(seed, n=400, span=3 * 86400):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        node = rnd.choice(["a", "a", "a", "b", "c"])
        at = T0 + datetime.timedelta(seconds=rnd.choice([rnd.randrange(span), rnd.randrange(4000)]))
        x = rnd.choice([None, None, float(rnd.randrange(50))])
        y = rnd.choice([None, float(rnd.randrange(50))])
        out.append((node, str(at), i, x, y, f"row {i}"))
    out += [(None, str(T0), 1000, 1.0, None, "no key"), ("a", None, 1001, 2.0, 3.0, "no time"), ("b", None, 1002, None, 4.0, "no time")]
    return out


def make(frame, rows):
    return stored(frame(rows, "node_name string, ts string, id int, x double, y double, note string").repartition(5))


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("options", [dict(gap_seconds=1800), dict(gap_seconds=600, inclusive=True, break_at_midnight=True), dict(gap_seconds=10**6)])
@pytest.mark.parametrize("slice_seconds", [3600, 86400])
def test_as_the_single_operators(frame, seed, options, slice_seconds):
    df = make(frame, rows_of(seed))
    look = {"x": ["prev", "next", "before", "lag"], "y": ["prev", "next"]}
    got = segments.segmented_scan(df, look=look, tie=["id"], out="trip", number="no", total="all", slice_seconds=slice_seconds, **options)
    numbered = trips.number_trips(df, tie=["id"], ts="ts", out="trip", **options)
    expected = sliced.look_around(numbered.where("trip is not null"), look, ["node_name", "trip"], "ts", ["id"])
    expected = sliced.row_numbers(expected, ["node_name", "trip"], "ts", ["id"], number="no", total="all")
    timed = got.where("trip is not null")
    assert sorted(map(str, timed.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
    rest = got.where("trip is null").select("id", "no", "all").collect()
    assert {(r.id, r.no, r["all"]) for r in rest} == {(1000, None, None), (1001, None, None), (1002, None, None)}


@pytest.mark.parametrize("seed", [5, 6])
def test_filled_and_deltas_as_one_after_the_other(frame, seed):
    df = make(frame, rows_of(seed))
    got = segments.filled_with_deltas(df, ["x", "y"], ["x"], gap_seconds=1800, tie=["id"], out="trip", slice_seconds=7200)
    numbered = trips.number_trips(df, gap_seconds=1800, tie=["id"], ts="ts", out="trip")
    expected = impute.fill_and_deltas(numbered, ["x", "y"], ["x"], keys=["node_name", "trip"], tie=["id"])
    columns = ["id", "trip", "x", "y", "x_Delta"]
    one, other = (sorted(map(str, d.where("trip is not null").select(*columns).collect())) for d in (got, expected))
    assert one == other


def test_plain_python(frame):
    rows = [r for r in rows_of(9) if r[0] and r[1]]
    df = make(frame, rows)
    got = {r.id: r for r in segments.segmented_scan(df, gap_seconds=900, look={"x": ["prev", "next", "lag"]}, tie=["id"], number="no", total="all", slice_seconds=1800).collect()}
    for node in "abc":
        mine = sorted((r for r in rows if r[0] == node), key=lambda r: (r[1], r[2]))
        trip, groups, last = 0, [], None
        for r in mine:
            at = datetime.datetime.fromisoformat(r[1])
            if last is None or (at - last).total_seconds() > 900:
                trip += 1
                groups.append([])
            groups[-1].append(r)
            last = at
        for k, group in enumerate(groups):
            for i, r in enumerate(group):
                g = got[r[2]]
                assert (g.trip_id, g.no, g["all"]) == (k + 1, i + 1, len(group))
                assert g.x_prev == next((q[3] for q in reversed(group[: i + 1]) if q[3] is not None), None)
                assert g.x_next == next((q[3] for q in group[i:] if q[3] is not None), None)
                assert g.x_lag == (group[i - 1][3] if i else None)


def plan_counts(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return final.count("Scan parquet"), final.count("Exchange hashpartitioning") - final.count("ReusedExchange [")


def test_one_scan_and_three_shuffles(spark, frame):
    df = make(frame, rows_of(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = segments.filled_with_deltas(df.select("node_name", "ts", "x", "y"), ["x", "y"], ["x"], gap_seconds=1800)
        scans, shuffles = plan_counts(found.where(F.col("ts").isNotNull() | F.lit(True)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert scans == 1 and shuffles <= 3
