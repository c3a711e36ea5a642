"""Statistics, scaling, scoring, cells, tables and streams."""

import math
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline import schema
from wakeline.functions import geo, severity
from wakeline.functions import values as V
from wakeline.operators import cells, features, reshape, scoring, selection, upsert, weather
from wakeline.plans import gps, views
from wakeline.session import fresh_path
from wakeline.sources import files, scans, tables
from wakeline.streaming import jobs


def one(df, *cols):
    row = df.select(*cols).first()
    return tuple(row)


def test_alignment(frame):
    df = frame([(350.0, 10.0), (10.0, 350.0), (0.0, 180.0), (None, 5.0)], "h double, w double")
    got = [r[0] for r in df.select(geo.alignment_factor("h", "w")).collect()]
    assert got == [20 / 180, -20 / 180, 1.0, None]


def test_sentinels(frame):
    df = frame([(80.00861904,), (8191.875,), (None,), (5.0,)], "value double")
    assert [r[0] for r in df.filter(V.no_sentinels("value")).collect()] == [5.0]


def test_to_number(frame):
    df = frame([("1.5",), ("x",), ("NaN",), (None,)], "t string")
    assert [r[0] for r in df.select(V.to_number("t")).collect()] == [1.5, None, None, None]


def test_constant_feature_is_ignored(frame):
    df = frame([(1.0, float(i)) for i in range(5)], "c double, x double")
    assert features.drop_outliers(df, ["c", "x"]).count() == 5


def test_min_max_of_constant_is_zero(frame):
    df = frame([(4.0,), (4.0,)], "c double")
    scaled = features.apply_min_max(df, features.fit_min_max(df, ["c"]), ["c"])
    assert [r[0] for r in scaled.collect()] == [0.0, 0.0]


def test_outlier_sides(frame):
    df = frame([(0.0,)] * 30 + [(-100.0,)], "value double")
    assert features.drop_outliers(df, ["value"]).count() == 30
    assert features.drop_outliers(df, ["value"], two_sided=False).count() == 31


def test_encode_binary_needs_two_values(frame):
    two = frame([("P", 1), ("SB", 2), (None, 3)], "s string, i int")
    assert [r["s"] for r in features.encode_binary(two, "s").orderBy("i").collect()] == ["0", "1", None]
    three = frame([("a",), ("b",), ("c",)], "s string")
    assert sorted(r[0] for r in features.encode_binary(three, "s").collect()) == ["a", "b", "c"]


def merged(frame, n=400):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        x = rng.normal(size=len(schema.SCALED_FEATURES)).tolist()
        day = date(2024, 5, 1) + timedelta(days=i % 60)
        rows.append((f"b{i % 3}", "SB" if i % 2 else "P", day, f"10:00:{i % 60:02d}", i // 40, *x))
    cols = ", ".join(f"{f} double" for f in schema.SCALED_FEATURES)
    return frame(rows, "node_name string, signal_instance string, date date, clock string, TRIP_ID int, " + cols)


def test_training_set_keeps_rows_and_has_no_nulls(frame):
    df = merged(frame)
    index = ["node_name", "date", "clock", "TRIP_ID"]
    ready = features.training_set(df, index=index)
    clean = features.drop_outliers(df.na.drop("any"), schema.SCALED_FEATURES)
    assert ready.count() == clean.count()
    assert ready.na.drop("any").count() == ready.count()
    train, test = features.split_by_date(clean)
    assert train.count() + test.count() == clean.count()
    assert train.columns == test.columns
    assert ready.filter("part = 'train'").count() == train.count()
    low, high = one(ready.filter("part = 'train'"), F.min("RPM"), F.max("RPM"))
    assert (low, high) == (0.0, 1.0)


def test_inference_uses_the_given_range(frame):
    df = merged(frame, 50)
    ranges = features.fit_min_max(df, schema.SCALED_FEATURES)
    got = features.inference_set(df, ranges, index=["node_name", "date", "clock", "TRIP_ID"])
    assert got.count() == 50 and one(got, F.min("RPM"), F.max("RPM")) == (0.0, 1.0)


def test_reconstruction_error_falls_with_width(frame):
    df = merged(frame)
    names = list(schema.SCALED_FEATURES)
    train, later = features.split_by_date(df)
    errors = scoring.validation_errors(train, later, names, [1, 3, 5, 7])
    found = [r["error"] for r in errors.orderBy("k").collect()]
    assert found == sorted(found, reverse=True) and found[-1] < 1e-20
    assert scoring.best_bottleneck(errors) == 7


def test_model_round_trip(spark, frame):
    df = merged(frame, 100)
    names = list(schema.SCALED_FEATURES)
    model = scoring.fit_reconstruction(df, names)
    path = fresh_path(spark, "model")
    scoring.save_reconstruction(model, path)
    again = scoring.load_reconstruction(path)
    a, b = (scoring.reconstruct_linear(df, m).select("RPM_rebuilt").collect() for m in (model, again))
    assert a == b


def test_sequence_scores_stay_with_their_rows(frame):
    """Rows in any file order get the error of their own value."""
    t0 = datetime(2024, 3, 1)
    rows = [("a", 1, str(t0 + timedelta(seconds=i)), date(2024, 3, 1), float(i)) for i in reversed(range(65))]
    df = frame(rows, "node_name string, TRIP_ID int, ts string, date date, RPM double")
    errors = scoring.sequence_errors(df, ["RPM"], lambda cube: cube * 0.0, rows=30)
    got = sorted((r["ts"].minute * 60 + r["ts"].second, r["RPM"]) for r in errors.collect())
    assert got == [(i, float(i * i)) for i in range(65)]


def test_severity(frame):
    df = frame([(0,), (1,), (2,)], "n int")
    assert [r[0] for r in df.select(severity.severity_colour("n")).collect()] == ["#086e1f", "#FFFF00", "#910606"]
    day = frame([("c", "#086e1f"), ("c", "#FFFF00"), ("c", "#FF0000"), ("d", "#00FF00")], "cell string, colour string")
    got = {r["cell"]: r["colour"] for r in cells.worst_colour(day, keys=["cell"]).collect()}
    assert got == {"c": "#910606", "d": "#086e1f"}


def test_distances(frame):
    df = frame([(57.7, 11.9, 59.3, 18.1), (0.0, 0.0, 0.0, 1.0), (5.0, 5.0, 5.0, 5.0), (None, 0.0, 0.0, 0.0)],
               "a double, b double, c double, d double")
    args = ("a", "b", "c", "d")
    sphere, ellipsoid = zip(*((r[0], r[1]) for r in df.select(geo.haversine_nm(*args), geo.ellipsoidal_nm(*args)).collect()))
    # One degree of longitude on the equator is 60.1077 nautical miles on WGS-84.
    assert ellipsoid[1] == pytest.approx(60.10770, abs=1e-3) and ellipsoid[2] == 0.0 and ellipsoid[3] is None
    assert sphere[0] == pytest.approx(ellipsoid[0], rel=6e-3) and sphere[3] is None


def test_hex_cells_hold_their_points(frame):
    rng = np.random.default_rng(2)
    pts = [(float(a), float(b)) for a, b in zip(rng.uniform(54, 66, 300), rng.uniform(8, 24, 300))]
    df = frame(pts, "lat double, lon double").withColumn("cell", geo.hex_cell("lat", "lon"))
    stretch = math.cos(math.radians(geo.GRID_LATITUDE))
    for r in df.withColumn("ring", geo.hex_boundary("cell")).collect():
        ring = [(p["lon"] * stretch, p["lat"]) for p in r["ring"]]
        x, y = r["lon"] * stretch, r["lat"]
        cx, cy = (sum(p[i] for p in ring) / 6 for i in (0, 1))
        assert math.hypot(x - cx, y - cy) <= geo.CELL_SIZE + 1e-9
        assert len(ring) == 6
    again = df.withColumn("ring", geo.hex_boundary("cell")).select(
        "cell", F.aggregate("ring", F.lit(0.0), lambda s, p: s + p["lat"]).alias("la"),
        F.aggregate("ring", F.lit(0.0), lambda s, p: s + p["lon"]).alias("lo"))
    same = again.filter(geo.hex_cell(F.col("la") / 6, F.col("lo") / 6) != F.col("cell"))
    assert same.count() == 0


def test_exact_median(frame):
    rng = np.random.default_rng(5)
    data = {k: rng.normal(size=n).round(2).tolist() for k, n in (("a", 1), ("b", 2), ("c", 101), ("d", 100))}
    data["e"] = [3.0] * 50 + [1.0] * 50 + [None]
    df = frame([(k, v) for k, vs in data.items() for v in vs], "k string, v double")
    got = {r["k"]: r["v"] for r in selection.medians(df, ["v"], keys=["k"]).collect()}
    for k, vs in data.items():
        assert got[k] == pytest.approx(float(np.median([v for v in vs if v is not None])))


def gps_rows(frame, trips=3, n=8):
    t0 = datetime(2024, 3, 1)
    rows = []
    for trip in range(trips):
        for i in range(n):
            rows.append(("a", trip + 1, str(t0 + timedelta(hours=trip, seconds=i)),
                         55.0 + trip, 10.0 + 0.001 * i, 0.0, 0.001, float(trip), 90.0, 1, 2.0))
    return frame(rows, "node_name string, tripID bigint, ts string, LAT double, LON double, LAT_Delta double,"
                       " LON_Delta double, SOG double, COG double, RPM int, CELL double")


def test_no_anomaly_leaves_all_cells_green(frame):
    coloured, summary = gps.map_tables(gps_rows(frame), lambda cube: np.zeros(len(cube)), rows=4)
    assert {r["colour"] for r in coloured.collect()} == {"#086e1f"} and summary.count() == 0


def test_flagged_trip_colours_its_cell(frame):
    """Only the fastest trip scores 1; its cell holds one flagged trip."""
    coloured, summary = gps.map_tables(gps_rows(frame), lambda cube: cube[:, :, 4].max(axis=1), rows=4)
    assert sorted(r["trips"] for r in coloured.collect()) == [0, 0, 1]
    row = summary.first()
    assert (row["tripID"], row["vessels"], row["max_speed"]) == (3, "a", 2.0)
    assert row["total_distance"] == pytest.approx(0.23, abs=0.02)


def test_approximate_counts(frame):
    rows = gps_rows(frame).withColumn("anomalous", F.col("tripID") > 1)
    exact = cells.cell_counts(rows)
    rough = cells.cell_counts(rows, approx=True)
    key = lambda r: r["cell"]
    assert sorted(exact.collect(), key=key) == sorted(rough.collect(), key=key)


def test_upsert_keeps_existing_and_is_idempotent(frame):
    old = frame([("a", 1.0, 1), ("b", None, 2)], "node_name string, v double, TRIP_ID int")
    new = frame([("a", 1.0, 9), ("b", None, 9), ("c", 3.0, 9), ("c", 3.0, 8)], "node_name string, v double, TRIP_ID int")
    once = upsert.upsert(old, new)
    assert {tuple(r) for r in once.collect()} == {("a", 1.0, 1), ("b", None, 2), ("c", 3.0, 8)}
    assert {tuple(r) for r in upsert.upsert(once, new).collect()} == {tuple(r) for r in once.collect()}


def test_latest_date(frame):
    days = ["2023-02-01", "2023-02-02", "2023-02-03", "2023-03-01", "2024-08-01"]
    df = frame([(d,) for d in days], "date string").withColumn("date", F.col("date").cast("date"))
    assert upsert.latest_date(df).first()["latest"] == date(2024, 8, 1)
    late = upsert.since_latest(df, frame([("2024-07-31",), ("2024-08-01",), ("2024-08-02",)], "date string").withColumn("date", F.col("date").cast("date")))
    assert late.count() == 2


def test_first_catch_up_takes_everything(frame):
    empty = frame([], "date date, v int")
    new = frame([(date(2024, 1, 1), 1)], "date date, v int")
    assert upsert.catch_up(empty, new).count() == 1


@pytest.mark.parametrize("minute,stale", [("2024-03-01 11:00:00", False), ("2024-03-01 10:00:00", True)])
def test_freshness(frame, minute, stale):
    df = frame([(minute,)], "ts string")
    row = upsert.freshness(df, F.lit("2024-03-01 11:45:00").cast("timestamp_ntz")).first()
    assert row["stale"] is stale and row["previous_hour"] == datetime(2024, 3, 1, 10)


def test_classify(frame):
    df = frame([("f", None, "2024-01-01 00:00:00"), ("f", None, "2024-01-01 00:00:01"), ("g", None, "2024-01-01 00:00:02"), ("g", "1", "2024-01-01 00:00:03")],
               "file string, signal_instance string, time string")
    position, engine = files.split_geo_engine(files.classify_files(df))
    assert position.count() == 2 and {r["signal_instance"] for r in engine.collect()} == {None, "SB"}


def test_csv_folder(spark, tmp_path):
    (tmp_path / "n1").mkdir()
    (tmp_path / "n1" / "RPM.csv").write_text(
        "time,node_id,node_name,signal_name_alias,value,signal_instance\n"
        '2024-01-01T00:00:00Z,n1,"12, A",RPM,5.5,0\n2024-01-01T00:00:01.123456,n1,"12, A",RPM,oops,\n'
    )
    derived = "time,node_id,node_name,signal_name_alias,value,signal_instance\n2024-01-01,n1,x,RPM,1,0\n"
    (tmp_path / "geo_data.csv").write_text(derived)
    rows = files.read_csv_folder(spark, str(tmp_path)).orderBy("time").collect()
    assert [(r["node_name"], r["value"], r["signal_instance"]) for r in rows] == [("12, A", 5.5, "0"), ("12, A", None, None)]
    assert rows[0]["time"] == datetime(2024, 1, 1) and rows[1]["time"].microsecond == 123456


def test_csv_folder_with_derived_files_only(spark, tmp_path):
    (tmp_path / "geo_data.csv").write_text("time,node_id,node_name,signal_name_alias,value,signal_instance\n2024-01-01,n1,x,RPM,1,0\n")
    assert files.read_csv_folder(spark, str(tmp_path)).count() == 1


def test_error_table_keys_stay_unique(spark, frame):
    path = fresh_path(spark, "errors")
    tables.make_error_table(spark, path)
    rows = frame([("a", date(2024, 1, 1), *[1.0] * 5), ("a", date(2024, 1, 1), *[2.0] * 5)], tables.ERRORS)
    tables.append_errors(spark, path, rows)
    tables.append_errors(spark, path, rows)
    tables.make_error_table(spark, path)
    assert [r["RPM"] for r in tables.read_error_table(spark, path).collect()] == [1.0]


def test_errors_csv(spark, tmp_path):
    path = tmp_path / "errors.csv"
    path.write_text(',node_name,date,RPM,FUELRATE,ENGINE_LOAD,ENGTEMP,ENGOILPRES\n0,"1-2, A",2024-03-19,0.5,1,2,3,4\n1,"1-2, A",2024-03-20,0.7,1,2,3,4\n')
    df = tables.read_errors_csv(spark, str(path))
    wide = views.heatmap(df, dates=["2024-03-19", "2024-03-20"])
    row = wide.filter("feature = 'RPM'").first()
    assert (row["2024-03-19"], row["2024-03-20"]) == (0.5, 0.7)
    assert views.selectable_dates(df, "1-2, A").count() == 2
    assert views.error_scatter(df, node="nobody").count() == 0


def test_polygons_from_text(spark, tmp_path):
    shape = 'var p = L.polygon(\n  [[1.5, 2.0], [3.0, 4.0]],\n  {"a": 1, "color": "%s", "fill": true}\n).addTo(map_1);\n'
    (tmp_path / "h1.html").write_text("<html>" + shape % "#086e1f" + shape % "#FFFF00")
    (tmp_path / "aggregated_map.html").write_text(shape % "#910606")
    found = files.extract_polygons(files.read_texts(spark, str(tmp_path)))
    assert sorted(r["colour"] for r in found.collect()) == ["#086e1f", "#FFFF00"]
    assert found.first()["coordinates"] == [[1.5, 2.0], [3.0, 4.0]]
    assert files.daily_polygons(found).first()["colour"] == "#FFFF00"


def test_polygons_keep_their_own_colour(spark):
    """Without a colour, with nested options, with no options, and with text that is no polygon."""
    text = (
        'L.polygon([[1, 2], [3, 4]], {"weight": 1}).addTo(m); L.polygon( [[5, 6]] , {"style": {"color": "#111111"}, "color": "#222222"}).addTo(m);'
        'L.polygon([[7, 8]]).addTo(m); var o = {"color": "#333333"}; L.polygon(points, {"color": "#444444"});'
    )
    texts = spark.createDataFrame([("a", text), ("b", None), ("c", "nothing")], "path string, value string")
    found = {str(r["coordinates"]): r["colour"] for r in files.extract_polygons(texts).collect()}
    assert found == {"[[1.0, 2.0], [3.0, 4.0]]": None, "[[5.0, 6.0]]": "#222222", "[[7.0, 8.0]]": None}


def test_weather_out_of_reach_and_missing_positions(frame):
    rows = frame([("a", "P", "2024-03-01 10:00:00", 1.0, 2.0, 90.0)], "node_name string, signal_instance string, ts string, LAT double, LON double, COG double")
    wind = frame([("a", "2024-03-01 12:00:00", 5.0, 90.0)], "node_name string, time string, wind_speed_10m double, wind_direction_10m double").withColumnRenamed("time", "date")
    for hourly in (True, False):
        row = weather.add_weather(rows, wind, hourly=hourly).first()
        assert row["wind_velocity"] is None and row["alignment_factor"] is None
    row = weather.add_weather(rows.drop("LAT"), wind).first()
    assert row["wind_velocity"] is None and row["LAT"] is None


def test_merge_suffixes(frame):
    left = frame([("a", "d", "t", 1)], "node_name string, date string, clock string, x int")
    right = frame([("a", "d", "t", 2)], "node_name string, date string, clock string, x int")
    got = weather.merge_positions(left, right, keys=("node_name", "date", "clock")).first()
    assert (got["x_engine"], got["x_geo"]) == (1, 2)


def test_positions_become_two_rows(frame):
    df = frame([("2024-01-01 00:00:00", "n", "a", "LAT-LON", 80.00861904, 10.0)],
               "time string, node_id string, node_name string, signal_name_alias string, value_latitude double, value_longitude double")
    got = scans.gps_scan(df, []).collect()
    assert [(r["signal_name_alias"], r["value"]) for r in got] == [("A_LON", 10.0)]


def test_catalog(spark, frame):
    scans.register_tables(spark, {"tab_x": frame([(2,), (1,), (3,)], "v int")})
    assert "tab_x" in scans.list_tables(spark)
    assert [r["v"] for r in scans.sample_table(spark.table("tab_x"), 2, ["v"]).collect()] == [1, 2]


def test_stream_late_rows_complete_their_hour(spark, frame):
    """Two pulls for one hour: the second replaces the hour by all its rows."""
    base = fresh_path(spark, "late")
    body = lambda rows: rows.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("n"))
    for part in (["2024-01-01 10:05:00", "2024-01-01 11:05:00"], ["2024-01-01 10:55:00"]):
        frame([(t,) for t in part], "time string").coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = jobs.stream_table(spark, f"{base}/in")
        jobs.refresh(stream, body, f"{base}/landing", f"{base}/out", f"{base}/checkpoint")
    out = spark.read.schema("n bigint, date date, hour int").parquet(f"{base}/out")
    assert {(r["hour"], r["n"]) for r in out.collect()} == {(10, 2), (11, 1)}


def test_union_fills_absent_columns(frame):
    a, b = frame([(1,)], "x int"), frame([(2.0,)], "y double")
    assert {tuple(r) for r in reshape.union_all([a, b]).select("x", "y").collect()} == {(1, None), (None, 2.0)}
