"""Distinct trips from merged bitmaps against plain sets."""

import random

from wakeline.operators import cells


def test_days_from_hours(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("abc"), rnd.randrange(40000), rnd.randrange(3), rnd.randrange(5), rnd.choice(["x", "y", "z", None]), rnd.random() < 0.5) for _ in range(3000)]
    # A trip is flagged or not, whatever its rows.
    flags = {(r[0], r[1]): r[5] for r in rows}
    rows = [(*r[:5], flags[r[0], r[1]]) for r in rows] + [("q", 1, 0, 0, "quiet", False), ("q", 1, 0, 1, "quiet", False)]
    df = spark.createDataFrame(rows, "node_name string, tripID long, date int, hour int, cell string, anomalous boolean")
    numbers = cells.numbered_keys(df)
    found = [r.trip_no for r in numbers.collect()]
    assert sorted(found) == list(range(1, 1 + len({(r[0], r[1]) for r in rows})))
    hours = cells.trip_bitmaps(df, numbers, by=["date", "hour"])
    for by, at in ((["date"], lambda r: (r[2],)), (["date", "hour"], lambda r: (r[2], r[3])), ([], lambda r: ())):
        expected = {}
        for r in rows:
            if r[4] is not None:
                expected.setdefault((*at(r), r[4]), set()).update({(r[0], r[1])} if r[5] else set())
        got = {tuple(r)[:-1]: r.trips for r in cells.merged_trips(hours, by).collect()}
        assert got == {k: len(v) for k, v in expected.items()}


def test_many_trips_take_several_bitmaps(spark):
    df = spark.range(70000).selectExpr("'a' as node_name", "id as tripID", "1 as date", "id % 2 as hour", "'x' as cell", "true as anomalous")
    hours = cells.trip_bitmaps(df, cells.numbered_keys(df), by=["date", "hour"])
    assert hours.select("bucket").distinct().count() == 3
    assert [r.trips for r in cells.merged_trips(hours, ["date"]).collect()] == [70000]


def test_nothing(spark):
    df = spark.createDataFrame([], "node_name string, tripID long, date int, cell string, anomalous boolean")
    assert cells.merged_trips(cells.trip_bitmaps(df, cells.numbered_keys(df), by=["date"]), ["date"]).collect() == []
