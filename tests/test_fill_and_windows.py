"""Fills, differences, rolling means, sequences."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wakeline.functions import timeops
from wakeline.operators import impute, reshape, sequences, sliced

T0 = datetime(2024, 3, 1, 10)


def series(frame, values, key="k", step=10):
    return frame(
        [(key, str(T0 + timedelta(seconds=step * i)), i, v) for i, v in enumerate(values)],
        "key string, ts string, id int, v double",
    )


def values(df, c="v"):
    return [r[c] for r in df.orderBy("ts", "id").collect()]


SLICES = [None, 20, 3600]


@pytest.mark.parametrize("slice_seconds", SLICES)
def test_forward_keeps_leading_null(frame, slice_seconds):
    df = series(frame, [None, 1.0, None, 2.0])
    got = impute.fill(df, ["v"], keys=["key"], slice_seconds=slice_seconds)
    assert values(got) == [None, 1.0, 1.0, 2.0]


@pytest.mark.parametrize("slice_seconds", SLICES)
def test_fill_both_ways(frame, slice_seconds):
    options = dict(keys=["key"], order="back_then_forward", default=0.0, slice_seconds=slice_seconds)
    assert values(impute.fill(series(frame, [None, 1.0, None]), ["v"], **options)) == [1.0, 1.0, 1.0]
    assert values(impute.fill(series(frame, [None, None]), ["v"], **options)) == [0.0, 0.0]


@pytest.mark.parametrize("order", ["forward", "back_then_forward", "forward_then_back"])
@pytest.mark.parametrize("slice_seconds", SLICES)
def test_fill_matches_pandas(frame, order, slice_seconds):
    import pandas as pd

    rng = random.Random(7)
    data = {k: [rng.choice([None, None, float(i)]) for i in range(60)] for k in "ab"}
    df = series(frame, data["a"], "a").unionByName(series(frame, data["b"], "b"))
    got = impute.fill(df, ["v"], keys=["key"], order=order, slice_seconds=slice_seconds)
    for k in "ab":
        s = pd.Series(data[k], dtype="float64")
        want = {"forward": s.ffill(), "back_then_forward": s.bfill().ffill(), "forward_then_back": s.ffill().bfill()}[order]
        assert values(got.filter(F.col("key") == k)) == [None if pd.isna(x) else x for x in want]


@pytest.mark.parametrize("slice_seconds", SLICES)
def test_fill_and_deltas_equals_two_steps(frame, slice_seconds):
    rng = random.Random(11)
    df = series(frame, [rng.choice([None, float(rng.randrange(9))]) for _ in range(80)])
    two = impute.add_deltas(
        impute.fill(df, ["v"], keys=["key"], order="back_then_forward", default=0.0), ["v"], keys=["key"]
    )
    one = impute.fill_and_deltas(df, ["v"], ["v"], keys=["key"], slice_seconds=slice_seconds)
    assert values(one) == values(two) and values(one, "v_Delta") == values(two, "v_Delta")
    assert values(one, "v_Delta")[0] == 0.0


@pytest.mark.parametrize("block", [1, 2, 4, 65536])
def test_rolling_null_rule(frame, block):
    df = series(frame, [1.0, 2.0, 3.0, None, 5.0])
    got = sliced.rolling_mean(df, "v", 3, ["key"], "ts", block_rows=block, slice_seconds=20)
    assert values(got) == [None, None, 2.0, None, None]


def test_rolling_matches_pandas(frame):
    import pandas as pd

    data = [float(i * i % 17) for i in range(100)]
    got = sliced.rolling_mean(series(frame, data), "v", 5, ["key"], "ts", block_rows=8, slice_seconds=70)
    want = pd.Series(data).rolling(5).mean()
    assert [None if x is None else round(x, 9) for x in values(got)] == [
        None if pd.isna(x) else round(x, 9) for x in want
    ]


def test_near_activity(frame):
    minutes = [0, 5, 11, 30, 42, 55, 60]
    vals = ["5", "0", "bad", "0", "0", "0", "3"]
    df = frame(
        [("a", str(T0 + timedelta(minutes=m)), v) for m, v in zip(minutes, vals)],
        "node_name string, time string, value string",
    )
    kept = impute.near_activity(df)
    assert [r["time"].minute for r in kept.orderBy("time").collect()] == [0, 5, 55, 0]


def test_event_flags(frame):
    df = frame([("a", None), ("b", 1.0)], "node_name string, E_CHECKENG double")
    got = impute.fill_event_flags(df).orderBy("node_name").collect()
    assert [r["E_CHECKENG"] for r in got] == [0.0, 1.0] and got[0]["E_OVERTEMP"] == 0.0


@pytest.mark.parametrize("length,windows", [(59, 0), (60, 1), (125, 2)])
def test_whole_windows(frame, length, windows):
    df = series(frame, [float(i) for i in range(length)])
    got = sequences.to_sequences(df, 60, ["v"], keys=["key"], whole_only=True)
    assert got.count() == windows and all(r["length"] == 60 for r in got.collect())


def test_chunks_pad_and_flatten(frame):
    """Lengths 30, 30, 5; a genuine -1 survives padding with -1."""
    data = [float(i) for i in range(65)]
    data[7] = -1.0
    chunks = sequences.to_sequences(series(frame, data), 30, ["v"], keys=["key"])
    assert [r["length"] for r in chunks.orderBy("seq_id").collect()] == [30, 30, 5]
    padded = sequences.pad_sequences(chunks, width=1)
    assert {len(r["seq"]) for r in padded.collect()} == {30}
    flat = sequences.flatten_sequences(padded, ["v"], keys=["key"])
    assert [r["v"] for r in flat.orderBy("row_no").collect()] == data


def test_half_even_rounding(frame):
    df = frame(
        [(i, f"2024-03-01 10:00:{s}") for i, s in enumerate(["05", "15", "25", "15.000001"])], "id int, ts string"
    )
    got = df.select("id", timeops.round_time("ts", 10).alias("r")).orderBy("id").collect()
    assert [r["r"].second for r in got] == [0, 20, 20, 20]


def test_time_functions_agree_outside_utc(spark, frame):
    """Wall-clock results do not depend on the session zone."""
    def run():
        df = frame([("2024-03-31 02:30:00.5",), ("2024-07-01 23:59:57",)], "ts string")
        return df.select(
            timeops.micros("ts").alias("us"), timeops.round_time("ts", 10).alias("r"), timeops.hour_of("ts").alias("h")
        ).orderBy("us").collect()

    utc = run()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert run() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("date_first,day", [(False, 2), (True, 1)])
def test_rounding_over_midnight(frame, date_first, day):
    df = frame([("a", "2024-03-01 23:59:57", 1.0)], "node_name string, time string, RPM double")
    got = reshape.resample_mean(df, keys=["node_name"], values=["RPM"], step_seconds=10, date_before_round=date_first)
    row = got.first()
    assert (row["date"].day, row["time"]) == (day, "00:00:00")


def test_pivot_null_key_and_missing_signal(frame):
    df = frame(
        [("a", None, DAYT, "SOG", 1.0), ("a", "P", DAYT, "RPM", None), ("a", "P", DAYT, "RPM", 2.0)],
        "node_name string, signal_instance string, time string, signal_name_alias string, value double",
    )
    keys = ["node_name", "signal_instance", "time"]
    engine = reshape.pivot_first(df, keys=keys, signals=["RPM", "ENG_HOURS"]).collect()
    assert len(engine) == 1 and engine[0]["RPM"] == 2.0 and engine[0]["ENG_HOURS"] is None
    geo = reshape.pivot_first(df, keys=keys, signals=["SOG"], keep_null_keys=True)
    assert geo.filter("signal_instance is null").first()["SOG"] == 1.0


DAYT = "2024-03-01 10:00:00"


def test_fuzzy_aliases(frame):
    names = ["Engine_Load_1", "ENGLOAD", "FUELRATE", "zzz"]
    df = frame([(n, DAYT) for n in names] + [("FUELRATE", DAYT)], "signal_name_alias string, time string")
    got = [r[0] for r in reshape.resolve_aliases(df).collect()]
    assert sorted(got) == sorted(["ENGINE_LOAD", "ENGINE_LOAD", "FUELRATE", "FUELRATE", "zzz"])


def test_alias_map(frame):
    df = frame([("x", DAYT), ("y", DAYT)], "signal_name_alias string, time string")
    mapping = df.select("signal_name_alias").withColumn("resolved", F.upper("signal_name_alias"))
    got = reshape.apply_alias_map(df, mapping)
    assert sorted(r["signal_name_alias"] for r in got.collect()) == ["X", "Y"]


def test_prefix(frame):
    from wakeline.functions.text import strip_prefix

    df = frame([("A_LAT",), ("X_Y_SOG",), ("COG",)], "a string")
    assert [r[0] for r in df.select(strip_prefix("a")).collect()] == ["LAT", "SOG", "COG"]


def test_first_per_key_is_deterministic(frame):
    df = frame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, None)], "k string, o int, v string")
    got = {r["k"]: r["v"] for r in reshape.first_per_key(df, ["k"], ["o"]).collect()}
    assert got == {"a": "y", "b": None}


def test_untimed_rows_survive_rolling_and_numbering(frame):
    df = frame([("k", None, 1.0), ("k", "2024-03-01 10:00:00", 2.0), ("k", "2024-03-01 10:00:01", 4.0)],
               "key string, ts string, v double")
    got = {r["ts"]: r["v"] for r in sliced.rolling_mean(df, "v", 2, ["key"], "ts").collect()}
    assert len(got) == 3 and got[None] is None and sorted(x or 0 for x in got.values()) == [0, 0, 3.0]
    numbered = sliced.row_numbers(df, ["key"], "ts", total="n")
    assert sorted((r["row_no"] or 0, r["n"] or 0) for r in numbered.collect()) == [(0, 0), (1, 2), (2, 2)]
    assert sequences.to_sequences(df, 2, ["v"], keys=["key"]).first()["length"] == 2
