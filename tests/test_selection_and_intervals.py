"""Order statistics by digits and intervals by tree nodes, against plain Python."""

import datetime
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.operators import joins, selection
from wakeline.session import stored

ODD = [0.0, -0.0, 1.0, -1.0, 2.0, 1.9999999999999998, 2.0000000000000004, 5e-324, -5e-324, 1e-310, 1.7976931348623157e308, -1.7e308, 4.0, 3.9999999999999996, 1e-300, 0.1, 0.30000000000000004, 0.3]


def test_digits_follow_the_numbers(spark):
    rng = np.random.default_rng(4)
    bits = rng.integers(-(2**63), 2**63 - 1, 4000, dtype=np.int64).view(np.float64)
    near = 57.0 + rng.normal(size=2000) * 1e-9
    numbers = sorted({v for v in [*bits[np.isfinite(bits)].tolist(), *near.tolist(), *ODD, *(2.0**k for k in range(-1000, 1000, 37))]})
    df = spark.createDataFrame([(v,) for v in numbers], "v double").coalesce(1)
    cells = [tuple(r)[1:] for r in df.select("v", *selection.digits(F.col("v"))).orderBy("v").collect()]
    assert all(a <= b for a, b in zip(cells, cells[1:]))
    # Numbers next to nothing share a cell, whose rank is taken among the numbers themselves.
    assert all(0 <= c[1] < 2**13 and 0 <= c[2] < 2**13 for v, c in zip(numbers, cells) if abs(v) > 1e-270)
    # Within the normal range no more than the last bits are left to the numbers themselves.
    assert len({c for v, c in zip(numbers, cells) if abs(v - 57) < 1e-6}) > 0.9 * len({round((v - 57) * 2.0**30) for v in numbers if abs(v - 57) < 1e-6}) / 2


@pytest.mark.parametrize("seed", [1, 2])
def test_medians_and_quantiles(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for key in ["a", "b", "c", "d", None]:
        for _ in range(rnd.choice([1, 2, 7, 500])):
            rows.append((key, rnd.choice([None, rnd.choice(ODD), rnd.gauss(57, 1e-8), rnd.uniform(-180, 180)]), float(rnd.randint(-3, 3))))
    rows += [("e", None, float("nan"))]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    got = {r.k: (r.x, r.y) for r in selection.medians(df, ["x", "y"], keys=["k"]).collect()}
    for key in {r[0] for r in rows}:
        for i in (1, 2):
            values = [r[i] for r in rows if r[0] == key and r[i] is not None and not math.isnan(r[i])]
            if values and key is not None:
                assert got[key][i - 1] == statistics.median(values)
            elif key in got and not values:
                assert got[key][i - 1] is None
    q = {r.k: tuple(r)[1:] for r in selection.quantiles(df, "y", [0.0, 0.1, 0.5, 0.9, 1.0], keys=["k"]).collect()}
    for key in "abcd":
        values = sorted(r[2] for r in rows if r[0] == key)
        assert q[key] == tuple(values[max(1, math.ceil(len(values) * s)) - 1] for s in (0.0, 0.1, 0.5, 0.9, 1.0))


def test_a_moored_vessel_is_not_one_task(spark):
    """A third of the rows on one key within a few metres: no cell holds more than a small part of them."""
    n = 60000
    at = F.when(F.col("id") % 3 == 0, 57 + F.rand(1) * 1e-4).otherwise(50 + F.rand(2) * 20)
    df = stored(spark.range(n).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 40).alias("k"), at.alias("x")))
    d = dict(zip(selection.CELLS, selection.digits(F.col("x"))))
    cells = df.withColumns(d)
    for k in (1, 2, 3):
        inside = cells.groupBy("k", *selection.CELLS[:k]).agg(F.count_distinct(selection.CELLS[k] if k < 3 else "x").alias("n"))
        assert inside.agg(F.max("n")).first()[0] <= 1 << 13
    rows = {}
    for r in df.collect():
        rows.setdefault(r.k, []).append(r.x)
    got = {r.k: r.x for r in selection.medians(df, ["x"], keys=["k"]).collect()}
    assert got == {k: statistics.median(v) for k, v in rows.items()}


def test_nodes_make_up_their_interval(spark):
    rnd = random.Random(7)
    spans = [(a := rnd.randrange(-10**6, 10**6), a + rnd.choice([0, 1, 7, 8, 63, 400, 10**5, 10**9])) for _ in range(200)] + [(0, 0), (-8, -1), (-1, 0)]
    df = spark.createDataFrame(spans, "a long, b long").select("a", "b", joins.interval_nodes(F.col("a"), F.col("b")).alias("nodes"))
    for r in df.collect():
        parts = sorted((n.node * 8**n.level, (n.node + 1) * 8**n.level) for n in r.nodes)
        assert parts[0][0] == r.a and parts[-1][1] == r.b + 1
        assert all(x[1] == y[0] for x, y in zip(parts, parts[1:]))
        assert len(parts) <= 14 * (1 + math.log(r.b - r.a + 1, 8))


def test_a_year_costs_its_logarithm(spark):
    year = spark.createDataFrame([(0, 364)], "a long, b long").select(joins.interval_nodes(F.col("a"), F.col("b")).alias("n"))
    assert len(year.first().n) <= 20


@pytest.mark.parametrize("bucket_seconds", [3600, 86400])
def test_rows_inside_intervals(frame, bucket_seconds):
    rnd = random.Random(3)
    t0 = datetime.datetime(2023, 12, 30)

    def at():
        return str(t0 + datetime.timedelta(seconds=rnd.choice([rnd.randrange(400 * 86400), 86400 * rnd.randrange(5), 3600 * rnd.randrange(9)])))

    rows = [(rnd.choice("abc"), at(), i) for i in range(300)] + [(None, at(), 1000), ("a", None, 1001)]
    spans = [(rnd.choice("abd"), *sorted((at(), at())), i) for i in range(60)] + [("a", str(t0), str(t0), 100), ("a", str(t0 + datetime.timedelta(1)), str(t0), 101), ("a", None, str(t0), 102)]
    got = joins.in_interval(
        frame(rows, "node_name string, time string, id int"), frame(spans, "node_name string, start string, stop string, span int"), bucket_seconds=bucket_seconds
    )
    expected = sorted((r[2], s[3]) for r in rows for s in spans if r[0] and r[0] == s[0] and r[1] and s[1] and s[1] <= r[1] <= s[2])
    assert sorted((r.id, r.span) for r in got.collect()) == expected


def test_no_intervals(frame):
    rows = frame([("a", "2024-01-01 00:00:00", 1)], "node_name string, time string, id int")
    none = frame([("a", "2024-01-01 00:00:00", "2024-01-01 00:00:00", 1)], "node_name string, start string, stop string, span int").limit(0)
    assert joins.in_interval(rows, none).collect() == []
