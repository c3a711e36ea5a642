"""Trip numbering, intervals and joins at their boundaries."""

import random
from datetime import datetime, timedelta

import pytest

from wakeline.operators import joins, trips

DAY = "2024-03-01 "


def numbers(df, ts="time", out="trip_id"):
    return [r[out] for r in df.orderBy(ts).collect()]


def rows(frame, *times, node="a"):
    return frame([(node, t if "-" in t else DAY + t) for t in times], "node_name string, time string")


def test_strict_gap(frame):
    df = rows(frame, "10:00:00", "10:20:00", "10:40:01")
    assert numbers(trips.number_trips(df, gap_seconds=1200)) == [1, 1, 2]


def test_inclusive_gap(frame):
    df = rows(frame, "10:00:00", "10:30:00", "10:59:59")
    got = trips.number_trips(df, gap_seconds=1800, inclusive=True, break_at_midnight=True)
    assert numbers(got) == [1, 2, 2]


@pytest.mark.parametrize("slice_column", [None, "date"])
def test_day_break(frame, slice_column):
    from pyspark.sql import functions as F

    df = rows(frame, "2024-03-01 23:59:50", "2024-03-02 00:00:10", "2024-03-02 00:00:20")
    df = df.withColumn("date", F.to_date("time"))
    got = trips.number_trips(
        df, gap_seconds=1800, inclusive=True, break_at_midnight=True, slice_column=slice_column
    )
    assert numbers(got) == [1, 2, 2]


def test_midnight_does_not_break_by_default(frame):
    df = rows(frame, "2024-03-01 23:59:50", "2024-03-02 00:00:10")
    assert numbers(trips.number_trips(df, gap_seconds=300)) == [1, 1]


@pytest.mark.parametrize("slice_seconds", [60, 3600, 86400, 30 * 86400])
@pytest.mark.parametrize("inclusive", [True, False])
def test_numbering_does_not_depend_on_slices(frame, slice_seconds, inclusive):
    rng = random.Random(slice_seconds)
    data, want = [], {}
    for node in ("a", "b"):
        t, trip, prev = datetime(2024, 1, 1), 0, None
        for i in range(120):
            t += timedelta(seconds=rng.choice([0, 1, 300, 600, 601, 40000, 400000]))
            gap = None if prev is None else (t - prev).total_seconds()
            if gap is None or (gap >= 600 if inclusive else gap > 600):
                trip += 1
            prev = t
            data.append((node, str(t), i))
            want[node, i] = trip
    df = frame(data, "node_name string, time string, id int")
    got = trips.number_trips(
        df, gap_seconds=600, tie=["id"], inclusive=inclusive, slice_seconds=slice_seconds
    )
    assert {(r["node_name"], r["id"]): r["trip_id"] for r in got.collect()} == want


def test_rows_without_time_are_kept(frame):
    df = frame([("a", DAY + "10:00:00"), ("a", None)], "node_name string, time string")
    got = {r["time"]: r["trip_id"] for r in trips.number_trips(df, gap_seconds=60).collect()}
    assert got == {datetime(2024, 3, 1, 10): 1, None: None}


def test_global_numbers_are_dense(frame):
    df = frame(
        [("b", 1), ("b", 2), ("a", 1), ("a", 1), ("c", 1)], "node_name string, trip_id bigint"
    )
    got = {(r["node_name"], r["trip_id"], r["tripID"]) for r in trips.globally_numbered(df).collect()}
    assert got == {("a", 1, 1), ("b", 1, 2), ("b", 2, 3), ("c", 1, 4)}


def test_single_row_trip_interval(frame):
    df = trips.number_trips(rows(frame, "10:00:00"), gap_seconds=1200)
    row = trips.trip_intervals(df).first()
    assert (row["start"], row["stop"]) == (datetime(2024, 3, 1, 9, 50), datetime(2024, 3, 1, 10, 10))


def test_interval_ends_are_included(frame):
    spans = frame([("a", 1, DAY + "10:00:00", DAY + "10:10:00")], "node_name string, trip_id int, start string, stop string")
    df = rows(frame, "09:59:59", "10:00:00", "10:10:00", "10:10:01")
    hit = joins.in_interval(df, spans)
    assert sorted(r["time"].strftime("%H:%M:%S") for r in hit.collect()) == ["10:00:00", "10:10:00"]


def test_interval_over_several_days(frame):
    spans = frame([("a", 1, "2024-03-01 23:00:00", "2024-03-04 01:00:00")], "node_name string, trip_id int, start string, stop string")
    df = rows(frame, "2024-03-01 22:00:00", "2024-03-02 12:00:00", "2024-03-04 00:30:00", "2024-03-04 02:00:00")
    assert joins.in_interval(df, spans).count() == 2


@pytest.mark.parametrize("bounded", [True, False])
def test_short_trips(frame, bounded):
    df = frame(
        [("a", 1, DAY + "10:00:00"), ("a", 1, DAY + "10:10:00"), ("a", 2, DAY + "12:00:00"), ("a", 2, DAY + "12:10:01")],
        "node_name string, TRIP_ID int, ts string",
    )
    kept = trips.drop_short_trips(df, bounded=bounded)
    assert {r["TRIP_ID"] for r in kept.collect()} == {2} and kept.count() == 2


def test_break_markers(frame):
    df = frame([("a", "P", 1, DAY + "10:00:00", 5.0), ("a", "P", 1, DAY + "10:00:10", 6.0)],
               "node_name string, signal_instance string, trip_id int, time string, value double")
    got = [(r["time"].strftime("%H:%M:%S"), r["value"]) for r in trips.break_markers(df).orderBy("time").collect()]
    assert got == [("09:59:59", None), ("10:00:00", 5.0), ("10:00:10", 6.0), ("10:00:11", None)]


def test_empty_input(frame):
    df = frame([], "node_name string, time string")
    assert trips.number_trips(df, gap_seconds=60).count() == 0
    assert trips.trip_intervals(trips.number_trips(df, gap_seconds=60)).count() == 0


def test_nearest_half_hour(frame):
    from pyspark.sql import functions as F

    from wakeline.functions.timeops import nearest_hour

    df = rows(frame, "12:29:59", "12:30:00", "12:30:01")
    got = [r["h"].hour for r in df.orderBy("time").select(nearest_hour("time").alias("h")).collect()]
    assert got == [12, 13, 13]
    assert df.select(F.max(nearest_hour("time"))).first()[0] == datetime(2024, 3, 1, 13)


def test_nearest_reading_matches_brute_force(frame):
    rng = random.Random(3)
    base = datetime(2024, 1, 1)
    left = [(i, rng.choice("ab"), base + timedelta(seconds=rng.randrange(0, 40000, 100))) for i in range(60)]
    right = [(rng.choice("ab"), base + timedelta(seconds=rng.randrange(0, 40000, 300)), i) for i in range(25)]
    want = {}
    for i, node, t in left:
        near = [(abs((rt - t).total_seconds()), -rt.timestamp(), rid) for n, rt, rid in right
                if n == node and abs((rt - t).total_seconds()) <= 1800]
        want[i] = min(near)[2] if near else None
    rows_ = frame([(i, n, str(t)) for i, n, t in left], "id int, node_name string, time string")
    reads = frame([(n, str(t), r) for n, t, r in right], "node_name string, reading_time string, reading int")
    got = joins.nearest_in_time(rows_, reads, key="node_name", ts="time", reading_ts="reading_time", slice_seconds=7200)
    assert {r["id"]: r["reading"] for r in got.collect()} == want


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, how):
    left = spark.range(200).selectExpr("id", "id % 3 AS k")
    right = spark.createDataFrame([(0, "x"), (1, "y"), (9, "z")], "k bigint, v string")
    plain = left.join(right, "k", how)
    salted = joins.salted_join(left, right, ["k"], ["id"], how, salts=5)
    assert sorted(map(str, plain.select(*sorted(plain.columns)).collect())) == sorted(
        map(str, salted.select(*sorted(salted.columns)).collect())
    )
