"""Wind at odd times, polygons as maps are written, and hours that become empty."""

import random

import pytest
from pyspark.sql import functions as F

from wakeline.operators import weather
from wakeline.session import fresh_path
from wakeline.sources import files
from wakeline.sources import weather as tables
from wakeline.streaming import jobs

ROW = "node_name string, ts string, LAT double, LON double, COG double"
WIND = "node_name string, time string, wind_speed_10m double, wind_direction_10m double"


def at(minute):
    return f"2024-03-01 {12 + minute // 60:02d}:{minute % 60:02d}:00"


def nearest(minute, readings):
    near = [(abs(minute - m), -m, w) for m, w in readings if abs(minute - m) <= 30]
    return min(near)[2] if near else None


@pytest.mark.parametrize("hourly", [True, False])
@pytest.mark.parametrize("readings", [[(0, 9.0), (30, 1.0)], [(50, 4.0)], [(0, 1.0), (60, 2.0), (60, 1.5)], [(m, float(m)) for m in range(0, 180, 7)]])
def test_each_row_takes_the_nearest_reading(frame, hourly, readings):
    minutes = [-29, -1, 0, 1, 14, 15, 16, 29, 30, 31, 45, 59, 60, 80, 81, 89, 90, 91, 120, 150]
    rows = frame([("a", at(m + 60), 1.0, 2.0, 0.0) for m in minutes], ROW)
    wind = frame([("a", at(m + 60), w, 0.0) for m, w in readings] + [("b", at(60), 77.0, 0.0), ("a", None, 5.0, 0.0)], WIND).withColumnRenamed("time", "date")
    got = {str(r.ts): r.wind_velocity for r in weather.add_weather(rows, wind, hourly=hourly).collect()}
    assert got == {at(m + 60): nearest(m, readings) for m in minutes}


def test_both_paths_agree_on_random_times(frame):
    rnd = random.Random(4)
    rows = frame([("ab"[i % 2], at(rnd.randint(0, 600)), 1.0, 2.0, 0.0) for i in range(200)], ROW)
    wind = frame([("ab"[i % 2], at(rnd.randint(0, 600)), float(i), 1.0) for i in range(40)], WIND).withColumnRenamed("time", "date")
    one, other = (sorted(map(str, weather.add_weather(rows, wind, hourly=h).collect())) for h in (True, False))
    assert one == other


def test_hours_take_the_nearest_reading_within_half_an_hour(frame):
    wind = frame([("a", "2024-03-01 12:50:00", 3.0, 0.0), ("a", "2024-03-01 15:30:00", 8.0, 0.0), ("a", "2024-03-01 15:40:00", 9.0, 0.0), (None, at(0), 1.0, 0.0), ("a", None, 1.0, 0.0)], WIND)
    wind = wind.withColumnRenamed("time", "date")
    got = {str(r.date): (r.wind_speed_10m, r.seconds_off) for r in tables.hourly_readings(wind).collect()}
    assert got == {"2024-03-01 13:00:00": (3.0, 600.0), "2024-03-01 15:00:00": (8.0, 1800.0), "2024-03-01 16:00:00": (9.0, 1200.0)}
    assert tables.without_place(wind).count() == 2


def test_rings_end_where_their_brackets_do(spark):
    text = (
        'L.polygon([[1.0, 2.0], [3.0, 4.0] ], {"color": "#111111"}).addTo(m);'
        'L.polygon( [ [ [5, 6], [7, 8] ],\n [ [5.5, 6.5] ] ] , {"color": "#222222", "x": [[1]]}); L.polygon([[9, 9],[8, 8]);'
        'L.polygon([[1, 1]])'
    )
    found = files.extract_polygons(spark.createDataFrame([("a", text)], "path string, value string"))
    got = {r.ring.replace(" ", ""): (r.coordinates, r.colour) for r in found.collect()}
    assert got == {
        "[[1.0,2.0],[3.0,4.0]]": ([[1.0, 2.0], [3.0, 4.0]], "#111111"),
        "[[[5,6],[7,8]],[[5.5,6.5]]]": ([[5.0, 6.0], [7.0, 8.0]], "#222222"),
        "[[1,1]]": ([[1.0, 1.0]], None),
    }


def test_an_hour_that_becomes_empty_loses_its_map(spark, frame):
    """The second pull brings a row that takes the first hour's map away."""
    base = fresh_path(spark, "stale")
    schema = "node_name string, time timestamp, value double"

    def pull(rows):
        spark.createDataFrame(rows, "node_name string, t string, value double").select(
            "node_name", F.col("t").cast("timestamp").alias("time"), "value"
        ).coalesce(1).write.mode("append").parquet(f"{base}/in")

    def body(hours):
        """Hours with a negative value have no map."""
        sums = hours.groupBy("date", "hour").agg(F.sum("value").alias("total"), F.min("value").alias("least"))
        return sums.where("least >= 0").select("total", "date", "hour")

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        jobs.refresh(stream, body, f"{base}/landing", f"{base}/out", f"{base}/checkpoint")
        out = spark.read.schema("total double, date date, hour int").parquet(f"{base}/out")
        return {r.hour: r.total for r in out.collect()}

    pull([("a", "2024-03-01 10:05:00", 1.0), ("a", "2024-03-01 11:05:00", 2.0)])
    assert run() == {10: 1.0, 11: 2.0}
    pull([("a", "2024-03-01 10:06:00", -1.0)])
    assert run() == {11: 2.0}
    pull([("a", "2024-03-01 12:06:00", 4.0)])
    assert run() == {11: 2.0, 12: 4.0}


def test_rows_without_a_complete_key_are_counted(spark, tmp_path):
    from wakeline.sources import tables as errors

    path, refused = f"{tmp_path}/errors", f"{tmp_path}/refused"
    errors.make_error_table(spark, path)
    rows = [("a", "2024-03-01", 1.0), (None, "2024-03-01", 2.0), ("a", None, 3.0), (None, None, 4.0)]
    df = spark.createDataFrame(rows, "node_name string, d string, RPM double").withColumn("date", F.col("d").cast("date"))
    df = df.withColumns({f: F.lit(0.0) for f in errors.ERRORS.fieldNames() if f not in df.columns})
    assert errors.append_errors(spark, path, df, refused) == 3
    assert errors.append_errors(spark, path, df) == 3
    assert errors.read_error_table(spark, path).count() == 1
    assert sorted(r.RPM for r in errors.read_error_table(spark, refused).collect()) == [2.0, 3.0, 4.0]
