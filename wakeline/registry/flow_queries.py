"""Incremental and streaming jobs, models, and whole flows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.functions import geo as G
from wakeline.operators import cells, features, scoring, sequences, trips, upsert
from wakeline.plans import engine, gps, views
from wakeline.registry import frames
from wakeline.registry.base import (
    ENGINE,
    ENGINE_CHAIN,
    GPS_LONG,
    HOURS2,
    SIDE,
    TEL,
    WX_ONLY,
    bucket,
    gps_chain,
    hex_sql,
    number_trips,
    query,
    rounded,
    s6,
    with_,
)
from wakeline.registry.frames import TIE
from wakeline.registry.join_queries import _FLAG, _METRICS, GPS, HOURLY, flagged, hourly_cells
from wakeline.session import fresh_path, stored
from wakeline.sources import events, files, scans
from wakeline.streaming import jobs, stateful

# --- incremental -------------------------------------------------------------------------


@query(
    "t01_freshness",
    """SELECT epoch_us(TIMESTAMP '2024-02-01 10:00:00') - epoch_us(max(ts)) >= 3600000000 AS stale,
      TIMESTAMP '2024-02-01 10:00:00' AS current_hour, TIMESTAMP '2024-02-01 09:00:00' AS previous_hour FROM events""",
)
def t01(spark, folder):
    as_of = F.lit("2024-02-01 10:23:45").cast("timestamp_ntz")
    return upsert.freshness(events.table(spark, folder, "events"), as_of)


@query(
    "t02_hour_pull",
    with_(TEL)
    + """SELECT event_id, time, value FROM tel
    WHERE time >= TIMESTAMP '2024-01-12 08:00:00' AND time < TIMESTAMP '2024-01-12 09:00:00'""",
)
def t02(spark, folder):
    hour = F.lit("2024-01-12 09:00:00").cast("timestamp_ntz")
    return upsert.hour_pull(frames.tel(spark, folder), hour).select("event_id", "time", "value")


def _event_stream(spark, folder):
    return jobs.event_time(events.as_telemetry(jobs.stream_table(spark, f"{folder}/events.parquet")))


@query(
    "t03_hourly_refresh",
    with_(TEL)
    + f"""SELECT CAST(time AS DATE) AS date, CAST(hour(time) AS INTEGER) AS hour, node_name, count(*) AS n_rows, {s6('avg(value)', 'value')}
    FROM tel GROUP BY ALL""",
)
def t03(spark, folder):
    """Every touched hour re-aggregated and its partition replaced."""
    base = fresh_path(spark, "refresh")

    def body(rows):
        return rows.groupBy("date", "hour", "node_name").agg(
            F.count(F.lit(1)).alias("n_rows"), F.avg("value").alias("value")
        )

    stream = _event_stream(spark, folder)
    jobs.refresh(stream, body, f"{base}/landing", f"{base}/out", f"{base}/checkpoint")
    out = spark.read.schema("node_name string, n_rows bigint, value double, date date, hour int").parquet(
        f"{base}/out"
    )
    return rounded(out.select("date", "hour", "node_name", "n_rows", "value"), "value")


#: Ranges a model was trained with: fixed, so that an hour's map does not depend on other hours.
_RANGES = {"LAT_Delta_x": (-15, 15), "LON_Delta_x": (-15, 15), "RPM_x": (0, 1), "SOG_x": (0, 500), "CELL_x": (0, 500)}
_HOUR_ROWS = 2


@query(
    "t03_hourly_maps",
    with_(
        gps_chain(
            GPS_LONG
            + ", hourly_long AS (SELECT * REPLACE (node_name || '@' || CAST(CAST(time AS DATE) AS VARCHAR) || '@' || hour(time) AS node_name) FROM gps_long)",
            "hourly_long",
        ),
        f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY node_name, tripID ORDER BY ts) AS row_no,
          count(*) OVER (PARTITION BY node_name, tripID) AS total FROM gps),
        trimmed AS (SELECT * EXCLUDE (total) FROM numbered WHERE row_no <= total - total % {_HOUR_ROWS}),
        hot AS (SELECT DISTINCT node_name, tripID FROM (SELECT node_name, tripID, avg(SOG / 500e0) AS score FROM trimmed
          GROUP BY node_name, tripID, (row_no - 1) // {_HOUR_ROWS}) WHERE score >= 0.3e0),
        placed AS ({hex_sql('LAT', 'LON', 'trimmed', '* EXCLUDE (CELL)')}),
        maps AS (SELECT CAST(split_part(p.node_name, '@', 2) AS DATE) AS date, CAST(split_part(p.node_name, '@', 3) AS INTEGER) AS hour, cell,
          count(DISTINCT CASE WHEN h.tripID IS NOT NULL THEN (p.node_name, p.tripID) END) AS trips
          FROM placed p LEFT JOIN hot h ON h.node_name = p.node_name AND h.tripID = p.tripID WHERE cell IS NOT NULL GROUP BY ALL)""",
    )
    + "SELECT *, CASE WHEN trips > 1 THEN '#910606' WHEN trips = 1 THEN '#FFFF00' ELSE '#086e1f' END AS colour FROM maps",
)
def t03_maps(spark, folder):
    """The hourly disruption job over a stream in several batches with late rows: each hour's map is that of all its rows."""
    base = fresh_path(spark, "hourly-maps")
    ranges = spark.range(1).select(
        *(F.lit(float(v)).alias(f"{f}_{end}") for f, pair in _RANGES.items() for end, v in zip(("min", "max"), pair))
    )

    def body(rows):
        long = scans.gps_scan(events.as_positions(rows), [events.as_gps_signals(rows)])
        hours = long.withColumns({"date": F.to_date("time"), "hour": F.hour("time")})
        return gps.hourly_map_table(hours, _speed_model(), ranges, rows=_HOUR_ROWS, threshold=0.3, gap_seconds=HOURS2)

    source = stored_batches(spark, folder, base)
    stream = _stored_stream(spark, base, source.schema)
    jobs.refresh(stream, body, f"{base}/landing", f"{base}/out", f"{base}/checkpoint", ts="ts")
    out = spark.read.schema("cell string, trips bigint, colour string, date date, hour int").parquet(f"{base}/out")
    return out.select("date", "hour", "cell", "trips", "colour")


@query(
    "t04_catch_up",
    with_(TEL)
    + """, rows AS (SELECT node_name, CAST(time AS DATE) AS date, time, value, event_id FROM tel),
    old AS (SELECT *, CAST(1 AS BIGINT) AS TRIP_ID FROM rows WHERE date <= DATE '2024-01-20' AND event_id % 2 = 0),
    new AS (SELECT *, CAST(2 AS BIGINT) AS TRIP_ID FROM rows WHERE date >= (SELECT max(date) FROM old))
    SELECT node_name, date, time, value, min(TRIP_ID) AS TRIP_ID
    FROM (SELECT * FROM old WHERE date >= (SELECT max(date) FROM old) UNION ALL SELECT * FROM new) GROUP BY ALL""",
)
def t04(spark, folder):
    """From the last stored date on, merged with what is stored of that date."""
    rows = frames.tel(spark, folder).select(
        "node_name", F.to_date("time").alias("date"), "time", "value", "event_id"
    )
    stored = rows.filter((F.col("date") <= F.lit("2024-01-20")) & (F.pmod("event_id", F.lit(2)) == 0))
    old = stored.drop("event_id").withColumn("TRIP_ID", F.lit(1).cast("bigint"))
    new = rows.drop("event_id").withColumn("TRIP_ID", F.lit(2).cast("bigint"))
    return upsert.catch_up(old, new)


def stored_batches(spark, folder, base):
    """The events in four parts, written at once by all tasks: a seventh of the rows is in a later part than its neighbours."""
    rows = events.table(spark, folder, "events")
    late = (F.pmod("event_id", F.lit(7)) == 0).cast("int")
    week = F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3))
    placed = rows.withColumn("_part", F.least(week + late, F.lit(3)))
    placed.hint("rebalance", "_part").write.partitionBy("_part").parquet(f"{base}/in")
    return rows


def _stored_stream(spark, base, schema, batches=3):
    """The stored events as a stream of about so many batches."""
    path = f"{base}/in"
    files_ = spark.read.schema(schema).parquet(path).select(F.input_file_name().alias("f")).distinct().count()
    reader = spark.readStream.schema(T.StructType([*schema.fields, T.StructField("_part", T.IntegerType())]))
    return reader.option("maxFilesPerTrigger", max(1, -(-files_ // batches))).parquet(path).drop("_part")


def _many_batches(spark, folder, base):
    """The stored batches as a stream, with a last file that closes everything."""
    rows = stored_batches(spark, folder, base)
    jobs.flush_row(spark, f"{base}/in/_part=9", rows)
    return jobs.event_time(events.as_telemetry(_stored_stream(spark, base, rows.schema, batches=2)))


#: Lateness the streams below allow for; their rows come up to two weeks late.
_DELAY = "30 days"


@query(
    "t05_stream_resample",
    with_(TEL)
    + f"""SELECT node_name, signal_name_alias, {bucket('time', 3600)} AS bucket, count(*) AS n, {s6('avg(value)', 'value')}
    FROM tel GROUP BY ALL""",
)
def t05(spark, folder):
    """All periods of a stream in several batches with late rows, the open ones flushed, equal the batch result."""
    base = fresh_path(spark, "resample")
    means = jobs.resample_stream(_many_batches(spark, folder, base), step_seconds=3600, delay=_DELAY)
    jobs.run_available(means, f"{base}/out", f"{base}/checkpoint")
    out = spark.read.schema(means.schema).parquet(f"{base}/out")
    return rounded(
        out.select(
            "node_name", "signal_name_alias", F.col("bucket").cast("timestamp_ntz").alias("bucket"), "n", "value"
        ),
        "value",
    )


@query(
    "t06_stream_trips",
    with_(TEL, f"t AS ({number_trips('tel', 1200)})")
    + """SELECT node_name, count(*) AS n, min(time) AS first_time, max(time) AS last_time FROM t GROUP BY node_name, trip_id""",
)
def t06(spark, folder):
    """All sessions of a stream in several batches with late rows, the open ones flushed."""
    base = fresh_path(spark, "sessions")
    found = jobs.trip_stream(_many_batches(spark, folder, base), gap_seconds=1200, delay=_DELAY)
    jobs.run_available(found, f"{base}/out", f"{base}/checkpoint")
    out = spark.read.schema(found.schema).parquet(f"{base}/out")
    return out.select(
        "node_name",
        "n",
        F.col("first_time").cast("timestamp_ntz").alias("first_time"),
        F.col("last_time").cast("timestamp_ntz").alias("last_time"),
    )


def _unflushed(spark, folder, base):
    rows = stored_batches(spark, folder, base)
    return jobs.event_time(events.as_telemetry(_stored_stream(spark, base, rows.schema, batches=3)))


_MONTH = 31 * 86400


@query(
    "t05_stateful_periods",
    with_(TEL)
    + f"""SELECT node_name, signal_name_alias, {bucket('time', 3600)} AS bucket, count(*) AS n, {s6('avg(value)', 'value')}
    FROM tel GROUP BY ALL""",
)
def t05_stateful(spark, folder):
    """Half-even periods kept in a state of their own: right after the last batch without a row that flushes them."""
    base = fresh_path(spark, "periods")
    versions = stateful.period_means(_unflushed(spark, folder, base), step_seconds=3600, delay_seconds=_MONTH)
    stateful.run_versions(versions, f"{base}/out", f"{base}/checkpoint")
    table = stateful.read_versions(spark, f"{base}/out", versions)
    found = stateful.latest(table, ["node_name", "signal_name_alias", "bucket"])
    return rounded(found.withColumn("bucket", F.timestamp_micros("bucket").cast("timestamp_ntz")), "value").select(
        "node_name", "signal_name_alias", "bucket", "n", "value"
    )


@query(
    "t06_dense_trips",
    with_(TEL, f"t AS ({number_trips('tel', 1200)})")
    + """SELECT node_name, trip_id, count(*) AS n, min(time) AS first_time, max(time) AS last_time FROM t
    WHERE node_name IS NOT NULL GROUP BY node_name, trip_id""",
)
def t06_dense(spark, folder):
    """Trips with dense numbers over several batches out of order."""
    base = fresh_path(spark, "trips")
    versions = stateful.dense_trips(_unflushed(spark, folder, base), gap_seconds=1200, delay_seconds=_MONTH)
    stateful.run_versions(versions, f"{base}/out", f"{base}/checkpoint")
    table = stateful.read_versions(spark, f"{base}/out", versions)
    found = stateful.latest(table, ["node_name", "trip_id"]).where("node_name is not null")
    when = {f"{c}_time": F.timestamp_micros(c).cast("timestamp_ntz") for c in ("first", "last")}
    return found.withColumns(when).select("node_name", "trip_id", "n", "first_time", "last_time")


@query("t07_stream_distinct", with_(TEL) + "SELECT event_id, node_name, value FROM tel")
def t07(spark, folder):
    """Every row sent twice, over several batches; each arrives once."""
    base = fresh_path(spark, "distinct")
    stream = _many_batches(spark, folder, base).select("event_id", "time", "node_name", "value")
    twice = stream.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    once = jobs.distinct_stream(twice.filter("event_id is not null"), ["event_id"], delay=_DELAY)
    jobs.run_available(once, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(once.schema).parquet(f"{base}/out").select("event_id", "node_name", "value")


@query(
    "t08_map_history",
    with_(GPS, _FLAG, HOURLY)
    + """, busiest AS (SELECT date, hour FROM coloured GROUP BY ALL ORDER BY count(*) DESC, date, hour LIMIT 1)
    SELECT date, hour, cell, trips, colour FROM coloured JOIN busiest USING (date, hour)""",
)
def t08(spark, folder):
    """The archived map of the hour with the most cells."""
    path = fresh_path(spark, "maps")
    table = hourly_cells(spark, folder)
    files.replace_partitions(table, path, ["date", "hour"], small=True)
    stored = spark.read.schema("cell string, trips bigint, colour string, date date, hour int").parquet(path)
    most = stored.groupBy("date", "hour").count().orderBy(F.desc("count"), "date", "hour").first()
    table = stored if most is None else jobs.map_of_hour(stored, most["date"], most["hour"])
    return table.select("date", "hour", "cell", "trips", "colour")


# --- models ------------------------------------------------------------------------------


def _mean_model():
    """A model that rebuilds a sequence as the mean of its rows; pad rows do not count."""

    def rebuild(cube):
        real = ~(cube == -1.0).all(axis=2, keepdims=True)
        total = np.where(real, cube, 0.0).sum(axis=1, keepdims=True)
        return np.broadcast_to(total / real.sum(axis=1, keepdims=True), cube.shape)

    return rebuild


_COMPLETE = (
    ", complete AS (SELECT *, row_number() OVER (PARTITION BY node_name, TRIP_ID ORDER BY ts, signal_instance) AS row_no"
    " FROM filled WHERE RPM IS NOT NULL AND ENGTEMP IS NOT NULL)"
)


@query(
    "m01_sequence_errors",
    with_(ENGINE_CHAIN) + _COMPLETE
    + f"""SELECT node_name, date, {s6('avg(r)', 'RPM')}, {s6('avg(e)', 'ENGTEMP')} FROM (
      SELECT node_name, CAST(ts AS DATE) AS date, pow(RPM - avg(RPM) OVER s, 2) AS r, pow(ENGTEMP - avg(ENGTEMP) OVER s, 2) AS e
      FROM complete WINDOW s AS (PARTITION BY node_name, TRIP_ID, (row_no - 1) // 5)) GROUP BY ALL""",
)
def m01(spark, folder):
    names = ["RPM", "ENGTEMP"]
    rows = frames.filled(spark, folder).select("node_name", "TRIP_ID", "ts", "date", "signal_instance", *names)
    errors = scoring.sequence_errors(
        rows.na.drop(), names, _mean_model(), tie=["signal_instance"], rows=5
    )
    return rounded(scoring.daily_errors(errors, names), *names)


@query(
    "m02_row_errors",
    with_(ENGINE_CHAIN) + _COMPLETE
    + f"""SELECT node_name, CAST(ts AS DATE) AS date, {s6('avg(abs(RPM - (RPM + ENGTEMP) / 2))', 'RPM')},
      {s6('avg(abs(ENGTEMP - (RPM + ENGTEMP) / 2))', 'ENGTEMP')} FROM complete GROUP BY ALL""",
)
def m02(spark, folder):
    names = ["RPM", "ENGTEMP"]
    rows = frames.filled(spark, folder).select("node_name", "date", *names).na.drop()
    rebuilt = scoring.reconstruct_rows(
        rows, names, lambda x: x.mean(axis=1, keepdims=True).repeat(x.shape[1], axis=1)
    )
    return rounded(scoring.daily_errors(scoring.absolute_errors(rebuilt, names), names), *names)


ROWS = 4
CUT = 0.2


def _speed_model():
    return lambda cube: cube[:, :, 4].mean(axis=1)


SCORED = f"""numbered AS (
  SELECT *, row_number() OVER (PARTITION BY node_name, tripID ORDER BY ts) AS row_no,
         count(*) OVER (PARTITION BY node_name, tripID) AS total FROM gps),
trimmed AS (SELECT * EXCLUDE (total) FROM numbered WHERE row_no <= total - total % {ROWS}),
windows AS (SELECT node_name, tripID, CAST((row_no - 1) // {ROWS} AS BIGINT) AS seq_id,
    avg((SOG - (SELECT min(SOG) FROM trimmed)) / (SELECT max(SOG) - min(SOG) FROM trimmed)) AS score FROM trimmed GROUP BY ALL),
hot AS (SELECT DISTINCT node_name, tripID FROM windows WHERE score >= {CUT}e0)"""


@query(
    "m03_gps_scoring",
    with_(GPS, SCORED)
    + f'SELECT node_name, tripID, seq_id, {s6("score", "score")}, CAST(score >= {CUT}e0 AS INTEGER) AS anomaly FROM windows',
)
def m03(spark, folder):
    return _gps_scores(spark, folder, _speed_model(), CUT)


def _gps_scores(spark, folder, model, threshold):
    rows = stored(frames.gps_rows(spark, folder, counted=True), "gps")
    features_ = scoring.gps_features(gps.whole_windows(rows, ROWS))
    return rounded(scoring.score_windows(features_, model, rows=ROWS, threshold=threshold, number="row_no"), "score")


#: How much each of the model's columns counts, in their order, and the score from which a window is marked.
_WEIGHTS = {"LAT_Delta": 0.3, "LON_Delta": 0.2, "RPM": 0.1, "COG": 0.05, "SOG": 0.25, "CELL": 0.1}
_ALL_CUT = 0.55


def _weighed(name: str, weight: float) -> str:
    if name == "RPM":
        return f"{weight}e0 * RPM"
    if name == "COG":
        return f"{weight}e0 * cos(radians(COG))"
    return f"{weight}e0 * ({name} - (SELECT min({name}) FROM trimmed)) / (SELECT max({name}) - min({name}) FROM trimmed)"


@query(
    "m03_six_features",
    with_(
        GPS,
        SCORED,
        f"""weighed AS (SELECT node_name, tripID, CAST((row_no - 1) // {ROWS} AS BIGINT) AS seq_id, row_no,
          {' + '.join(_weighed(n, w) for n, w in _WEIGHTS.items())} AS x FROM trimmed),
        scores AS (SELECT node_name, tripID, seq_id, avg(x) + max(x) / 10 AS score FROM weighed GROUP BY ALL)""",
    )
    + f"SELECT node_name, tripID, seq_id, {s6('score', 'score')}, CAST(score >= {_ALL_CUT}e0 AS INTEGER) AS anomaly FROM scores",
)
def m03_all(spark, folder):
    """A model that reads all six features: their weighed sum, its mean and its maximum over the window."""
    weights = np.array([_WEIGHTS[f] for f in scoring.GPS_FEATURES])

    def model(cube):
        weighed = cube @ weights
        return weighed.mean(axis=1) + weighed.max(axis=1) / 10

    return _gps_scores(spark, folder, model, _ALL_CUT)


_MODEL = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _lines(spark, folder):
    return frames.lineitem(spark, folder).select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("date"),
        *(F.col(f).cast("double").alias(f) for f in _MODEL),
    )


def _scaled_lines(spark, folder):
    rows = _lines(spark, folder)
    return features.apply_min_max(rows, features.fit_min_max(rows, _MODEL), _MODEL)


@query(
    "m04_linear_reconstruction",
    "SELECT l_orderkey, l_linenumber, true AS exact FROM lineitem",
)
def m04(spark, folder):
    """A bottleneck as wide as the input rebuilds every row."""
    rows = _scaled_lines(spark, folder)
    model = scoring.fit_reconstruction(rows, _MODEL, k=len(_MODEL))
    errors = scoring.squared_errors(scoring.reconstruct_linear(rows, model), _MODEL)
    worst = F.greatest(*(F.col(f) for f in _MODEL))
    return errors.select("l_orderkey", "l_linenumber", (worst < 1e-12).alias("exact"))


_TWO = ("l_quantity", "l_discount")


@query(
    "m05_bottleneck_size",
    "WITH raw AS (SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_quantity AS DOUBLE) AS x0, CAST(l_discount AS DOUBLE) AS y0 FROM lineitem), "
    "r AS (SELECT min(x0) AS xa, max(x0) AS xz, min(y0) AS ya, max(y0) AS yz FROM raw), "
    "s AS (SELECT date, (x0 - xa) / (xz - xa) AS x, (y0 - ya) / (yz - ya) AS y FROM raw, r), "
    "c AS (SELECT avg(x) AS mx, avg(y) AS my, var_pop(x) AS a, var_pop(y) AS d, covar_pop(x, y) AS b FROM s WHERE date <= DATE '2000-06-01'), "
    # The main direction of a symmetric 2x2 matrix has the angle atan2(2b, a - d) / 2.
    "v AS (SELECT *, cos(atan2(2 * b, a - d) / 2) AS u, sin(atan2(2 * b, a - d) / 2) AS w FROM c), "
    "e AS (SELECT avg((pow(x - mx, 2) + pow(y - my, 2) - pow((x - mx) * u + (y - my) * w, 2)) / 2) AS one FROM s, v WHERE date > DATE '2000-06-01') "
    "SELECT 1 AS k, round(one + 3.1e-8, 6) + 0e0 AS error FROM e UNION ALL SELECT 2, round(3.1e-8, 6) + 0e0",
)
def m05(spark, folder):
    """Validation error by bottleneck size over two features, whose main direction has a closed form."""
    train, later = features.split_by_date(_scaled_lines(spark, folder), split="2000-06-01")
    return rounded(scoring.validation_errors(train, later, _TWO, [1, 2]), "error")


@query(
    "m06_saved_model",
    "WITH raw AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS x0, CAST(l_discount AS DOUBLE) AS y0 FROM lineitem), "
    "r AS (SELECT min(x0) AS xa, max(x0) AS xz, min(y0) AS ya, max(y0) AS yz FROM raw), "
    "s AS (SELECT l_orderkey, l_linenumber, (x0 - xa) / (xz - xa) AS x, (y0 - ya) / (yz - ya) AS y FROM raw, r), "
    "c AS (SELECT avg(x) AS mx, avg(y) AS my, var_pop(x) AS a, var_pop(y) AS d, covar_pop(x, y) AS b FROM s), "
    "v AS (SELECT *, cos(atan2(2 * b, a - d) / 2) AS u, sin(atan2(2 * b, a - d) / 2) AS w FROM c), "
    "e AS (SELECT l_orderkey, l_linenumber, pow(x - mx, 2) + pow(y - my, 2) - pow((x - mx) * u + (y - my) * w, 2) AS error FROM s, v) "
    "SELECT l_orderkey, l_linenumber, round(error + 3.1e-8, 6) + 0e0 AS error, error >= 0.05e0 AS flagged FROM e",
)
def m06(spark, folder):
    """Ranges, a bottleneck of one, and a threshold, stored and reloaded together: errors by value."""
    raw = _lines(spark, folder)
    ranges = features.fit_min_max(raw, _TWO)
    scaled = features.apply_min_max(raw, ranges, _TWO)
    path = fresh_path(spark, "bundle")
    scoring.save_bundle(scoring.fit_reconstruction(scaled, _TWO, k=1), ranges, 0.05, path)
    model, saved, threshold = scoring.load_bundle(spark, path)
    again = features.apply_min_max(raw, saved, _TWO)
    errors = scoring.squared_errors(scoring.reconstruct_linear(again, model), _TWO)
    error = F.col(_TWO[0]) + F.col(_TWO[1])
    out = errors.select("l_orderkey", "l_linenumber", error.alias("error"), (error >= threshold).alias("flagged"))
    return rounded(out, "error")


_M7 = ("l_quantity", "l_extendedprice")


@query(
    "m07_training_set",
    "WITH rows AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date, l_linestatus, "
    + ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in _M7)
    + " FROM lineitem), s AS (SELECT "
    + ", ".join(f"avg({f}) AS {f}_m, stddev_pop({f}) AS {f}_d" for f in _M7)
    + " FROM rows), clean AS (SELECT rows.* FROM rows, s WHERE "
    + " AND ".join(f"abs(({f} - {f}_m) / {f}_d) < 1.6e0" for f in _M7)
    + "), r AS (SELECT "
    + ", ".join(f"min({f}) AS {f}_a, max({f}) AS {f}_z" for f in _M7)
    + " FROM clean WHERE date <= DATE '2000-06-01') SELECT l_orderkey, l_linenumber, date,"
    + " CASE l_linestatus WHEN 'O' THEN 1 ELSE 0 END AS signal_instance,"
    + " CASE WHEN date <= DATE '2000-06-01' THEN 'train' ELSE 'test' END AS part, "
    + ", ".join(s6(f"({f} - {f}_a) / ({f}_z - {f}_a)", f) for f in _M7)
    + " FROM clean, r",
)
def m07(spark, folder):
    rows = frames.lineitem(spark, folder).select(
        "l_orderkey",
        "l_linenumber",
        F.to_date("l_shipdate").alias("date"),
        F.when(F.col("l_linestatus") == "O", "SB").otherwise("P").alias("signal_instance"),
        *(F.col(f).cast("double").alias(f) for f in _M7),
    )
    ready = features.training_set(
        rows, features=_M7, index=["l_orderkey", "l_linenumber", "date"], split="2000-06-01", threshold=1.6
    )
    return rounded(ready, *_M7)


@query(
    "m08_port_starboard",
    with_(TEL)
    + f""", day AS (SELECT event_id, node_name, CAST(time AS DATE) AS date, time, signal_instance, value
      FROM tel WHERE signal_name_alias = 'RPM' AND value > 0),
    t AS ({number_trips('day', 600, by='node_name, date', out='TRIP_ID')}),
    kept AS (SELECT event_id, node_name, date, time, {SIDE} AS signal_instance, TRIP_ID, value FROM
      (SELECT *, avg(value) OVER d AS m, stddev_pop(value) OVER d AS s FROM t WINDOW d AS (PARTITION BY node_name, date))
      WHERE s = 0 OR (value - m) / s < 1.5e0),
    marked AS (SELECT * FROM kept
      UNION ALL SELECT NULL, node_name, date, min(time) - INTERVAL 1 SECOND, signal_instance, TRIP_ID, NULL FROM kept GROUP BY ALL
      UNION ALL SELECT NULL, node_name, date, max(time) + INTERVAL 1 SECOND, signal_instance, TRIP_ID, NULL FROM kept GROUP BY ALL)
    SELECT node_name, date, time, signal_instance, CASE WHEN count(value) OVER w = 2 THEN round(avg(value) OVER w + 3.1e-8, 6) + 0e0 END AS value
    FROM marked WINDOW w AS (PARTITION BY node_name, date, signal_instance ORDER BY time, TRIP_ID, event_id NULLS FIRST ROWS 1 PRECEDING)""",
)
def m08(spark, folder):
    """Engine speed of both sides, every vessel and day."""
    rpm = frames.tel(spark, folder).filter("signal_name_alias = 'RPM'")
    series = views.comparison_series(rpm, smoothing_rows=2, threshold=1.5, tie=TIE)
    return rounded(series.select("node_name", "date", "time", "signal_instance", "value"), "value")


_ERRORS = (
    ", errors AS (SELECT node_name, CAST(ts AS DATE) AS date, ts, (RPM - 100) * (RPM - 100) AS RPM,"
    " (FUELRATE - 100) * (FUELRATE - 100) AS FUELRATE, (ENGTEMP - 100) * (ENGTEMP - 100) AS ENGTEMP FROM filled)"
)


def full_errors(spark, folder):
    rows = frames.filled(spark, folder).withColumns({f"{f}_rebuilt": F.lit(100.0) for f in ENGINE})
    return scoring.squared_errors(rows, ENGINE)


@query(
    "m09_error_scatter",
    with_(ENGINE_CHAIN) + _ERRORS
    + f"""SELECT node_name, date, feature, {s6('value', 'value')} FROM (
      SELECT node_name, date, unnest(['RPM', 'FUELRATE', 'ENGTEMP']) AS feature, unnest([RPM, FUELRATE, ENGTEMP]) AS value FROM errors)""",
)
def m09(spark, folder):
    return rounded(views.error_scatter(full_errors(spark, folder), features=ENGINE), "value")


@query(
    "x03_batch_scorer",
    f"SELECT event_id, {s6('value * 2 + 1', 'value_rebuilt')} FROM events",
)
def x03(spark, folder):
    rows = events.table(spark, folder, "events").select("event_id", "value")
    scored = scoring.reconstruct_rows(rows, ["value"], lambda x: x * 2 + 1)
    return rounded(scored.select("event_id", "value_rebuilt"), "value_rebuilt")


# --- flows -------------------------------------------------------------------------------


@query(
    "c01_trip_discovery",
    with_(TEL, f"rpm AS (SELECT * FROM tel WHERE signal_name_alias = 'RPM' AND value > 0)", f"t AS ({number_trips('rpm', 1200)})")
    + """SELECT node_name, trip_id, min(time) - INTERVAL 10 MINUTE AS start, max(time) + INTERVAL 10 MINUTE AS stop
    FROM t GROUP BY ALL""",
)
def c01(spark, folder):
    rpm = frames.tel(spark, folder).filter("signal_name_alias = 'RPM'")
    return trips.discover_trips(rpm, tie=TIE)


_PAD, _GAP, _STEP = 1800, 3600, 600

C02_SQL = with_(
    TEL,
    WX_ONLY,
    "rpm AS (SELECT * FROM tel WHERE signal_name_alias = 'RPM' AND value > 0)",
    f"found AS ({number_trips('rpm', _GAP)})",
    f"""iv AS (SELECT node_name, trip_id, min(time) - INTERVAL {_PAD} SECOND AS a, max(time) + INTERVAL {_PAD} SECOND AS z
      FROM found GROUP BY ALL)""",
    "inside AS (SELECT t.* FROM tel t JOIN iv ON iv.node_name = t.node_name AND t.time >= iv.a AND t.time <= iv.z)",
    f"""e1 AS (SELECT node_name, {SIDE} AS signal_instance, time, """
    + ", ".join(f"arg_min(value, event_id) FILTER (signal_name_alias = '{s}') AS {s}" for s in ENGINE)
    + """ FROM inside WHERE signal_instance IS NOT NULL GROUP BY ALL)""",
    f"e2 AS (SELECT node_name, signal_instance, {bucket('time', _STEP)} AS ts, "
    + ", ".join(f"avg({s}) AS {s}" for s in ENGINE)
    + " FROM e1 GROUP BY ALL)",
    f"e3 AS ({number_trips('e2', HOURS2, ts='ts', tie='signal_instance', inclusive=True, midnight=True, out='TRIP_ID')})",
    "e4 AS (SELECT node_name, signal_instance, ts, TRIP_ID, "
    + ", ".join(f"last_value({s} IGNORE NULLS) OVER w AS {s}" for s in ENGINE)
    + " FROM e3 WINDOW w AS (PARTITION BY node_name, TRIP_ID, signal_instance ORDER BY ts ROWS UNBOUNDED PRECEDING))",
    """g1 AS (SELECT node_name, time, arg_min(value, event_id) FILTER (signal_name_alias = 'SOG') AS SOG,
      arg_min(value, event_id) FILTER (signal_name_alias = 'COG') AS COG FROM inside WHERE signal_instance IS NULL GROUP BY ALL)""",
    f"g2 AS (SELECT node_name, {bucket('time', _STEP)} AS ts, coalesce(avg(SOG), 0) AS SOG, avg(COG) AS COG FROM g1 GROUP BY ALL)",
    f"g3 AS ({number_trips('g2', HOURS2, ts='ts', tie='', inclusive=True, midnight=True, out='TRIP_ID')})",
    """g4 AS (SELECT node_name, ts, last_value(SOG IGNORE NULLS) OVER w AS SOG, last_value(COG IGNORE NULLS) OVER w AS COG
      FROM g3 WINDOW w AS (PARTITION BY node_name, TRIP_ID ORDER BY ts ROWS UNBOUNDED PRECEDING))""",
    """m AS (SELECT e4.*, g4.SOG, g4.COG, wx.wind_speed_10m AS wind_velocity,
        wx.wind_direction_10m % 360e0 - g4.COG % 360e0 AS d
      FROM e4 LEFT JOIN g4 USING (node_name, ts)
      LEFT JOIN wx ON wx.node_name = e4.node_name AND wx.date = date_trunc('hour', e4.ts + INTERVAL 30 MINUTE))""",
    """long_trips AS (SELECT node_name, TRIP_ID FROM e4 GROUP BY ALL HAVING epoch_us(max(ts)) - epoch_us(min(ts)) > 600000000)""",
) + (
    "SELECT node_name, signal_instance, ts, TRIP_ID, "
    + ", ".join(s6(s, s) for s in (*ENGINE, "SOG", "COG"))
    + ", wind_velocity, round(CASE WHEN d > 180 THEN d - 360 WHEN d < -180 THEN d + 360 ELSE d END / 180 + 3.1e-8, 6) + 0e0 AS alignment_factor"
    + " FROM m SEMI JOIN long_trips USING (node_name, TRIP_ID)"
)


@query("c02_engine_table", C02_SQL)
def c02(spark, folder):
    signals = frames.tel(spark, folder).withColumn("measurement", F.col("signal_name_alias"))
    table = engine.engine_table(
        signals,
        events.weather(spark, folder),
        discovery_gap_seconds=_GAP,
        padding_seconds=_PAD,
        step_seconds=_STEP,
        gap_seconds=HOURS2,
        tie=TIE,
    )
    names = (*ENGINE, "SOG", "COG", "alignment_factor")
    return rounded(
        table.select("node_name", "signal_instance", "ts", "TRIP_ID", *ENGINE, "SOG", "COG", "wind_velocity", "alignment_factor"),
        *names,
    )


_C03 = ("LAT", "LON", "SOG", "COG", "CELL", "LAT_Delta", "LON_Delta", "SOG_Delta")


@query(
    "c03_gps_table",
    with_(GPS)
    + f"SELECT node_name, ts, CAST(ts AS DATE) AS date, strftime(ts, '%H:%M:%S') AS time, tripID, RPM, {', '.join(s6(c, c) for c in _C03)} FROM gps",
)
def c03(spark, folder):
    return rounded(
        frames.gps_rows(spark, folder).select("node_name", "ts", "date", "time", "tripID", "RPM", *_C03), *_C03
    )


_HOT_CELLS = f"""placed AS ({hex_sql('LAT', 'LON', 'trimmed', '* EXCLUDE (CELL)')}),
counts AS (SELECT cell, count(DISTINCT CASE WHEN h.tripID IS NOT NULL THEN (p.node_name, p.tripID) END) AS trips
  FROM placed p LEFT JOIN hot h ON h.node_name = p.node_name AND h.tripID = p.tripID GROUP BY cell)"""


@query(
    "c04_disruption_cells",
    with_(GPS, SCORED, _HOT_CELLS)
    + """SELECT cell, trips, CASE WHEN trips > 1 THEN '#910606' WHEN trips = 1 THEN '#FFFF00' ELSE '#086e1f' END AS colour,
      CAST(6 AS INTEGER) AS corners FROM counts""",
)
def c04(spark, folder):
    coloured, _ = gps.map_tables(
        frames.gps_rows(spark, folder, counted=True), _speed_model(), rows=ROWS, threshold=CUT
    )
    return coloured.select("cell", "trips", "colour", F.size("boundary").alias("corners"))


@query(
    "c04_disruption_trips",
    with_(
        GPS,
        SCORED,
        "hot_rows AS (SELECT * FROM trimmed SEMI JOIN hot USING (node_name, tripID))",
        _METRICS.replace("FROM gps", "FROM hot_rows"),
    )
    + f"""SELECT node_name, tripID, {s6('mlat', 'LAT')}, {s6('mlon', 'LON')}, node_name AS vessels,
      round(max_distance, 2) + 0e0 AS max_distance, round(max_speed, 2) + 0e0 AS max_speed,
      round(total_distance, 2) + 0e0 AS total_distance
    FROM med JOIN far USING (node_name, tripID) JOIN path USING (node_name, tripID) JOIN fast USING (node_name, tripID)""",
)
def c04_trips(spark, folder):
    _, summary = gps.map_tables(
        frames.gps_rows(spark, folder, counted=True), _speed_model(), rows=ROWS, threshold=CUT
    )
    return rounded(summary, "LAT", "LON")


@query(
    "c05_mergeable_trips",
    with_(GPS, _FLAG, HOURLY)
    + """SELECT CAST(c.ts AS DATE) AS date, cell, count(DISTINCT CASE WHEN f.tripID IS NOT NULL THEN (c.node_name, c.tripID) END) AS trips
    FROM cells c LEFT JOIN flag f ON f.node_name = c.node_name AND f.tripID = c.tripID WHERE cell IS NOT NULL GROUP BY ALL""",
)
def c05_bitmaps(spark, folder):
    """Distinct anomalous trips per cell and day, from the stored bitmaps of its hours."""
    rows = stored(frames.gps_rows(spark, folder).select("node_name", "tripID", "ts", "LAT", "LON", "SOG"), "gps")
    marked = scoring.mark_flagged(rows, flagged(rows))
    placed = marked.withColumns({"date": F.to_date("ts"), "hour": F.hour("ts"), "cell": G.hex_cell("LAT", "LON")})
    hours = cells.trip_bitmaps(placed, cells.numbered_keys(rows), by=["date", "hour"])
    path = fresh_path(spark, "bitmaps")
    files.replace_partitions(hours, path, ["date", "hour"], small=True)
    kept = spark.read.schema("cell string, bucket bigint, trips binary, date date, hour int").parquet(path)
    return cells.merged_trips(kept, ["date"]).select("date", "cell", "trips")


@query(
    "c05_daily_map",
    with_(GPS, _FLAG, HOURLY)
    + """SELECT cell, CASE max(CASE WHEN trips > 1 THEN 2 ELSE trips END) WHEN 2 THEN '#910606' WHEN 1 THEN '#FFFF00'
      ELSE '#086e1f' END AS colour FROM hourly WHERE date = DATE '2024-01-08' GROUP BY ALL""",
)
def c05(spark, folder):
    """The stored hourly maps of a day, rolled up."""
    path = fresh_path(spark, "maps")
    files.replace_partitions(hourly_cells(spark, folder), path, ["date", "hour"], small=True)
    stored = spark.read.schema("cell string, trips bigint, colour string, date date, hour int").parquet(path)
    return gps.daily_map(stored.filter(F.col("date") == F.lit("2024-01-08").cast("date"))).drop("date")


@query(
    "c06_heatmap",
    with_(ENGINE_CHAIN) + _ERRORS
    + f"""SELECT node_name, date, feature, {s6('value', 'value')} FROM (
      SELECT node_name, date, unnest(['RPM', 'FUELRATE', 'ENGTEMP']) AS feature, unnest([avg(RPM), avg(FUELRATE), avg(ENGTEMP)]) AS value
      FROM errors GROUP BY node_name, date)""",
)
def c06(spark, folder):
    return rounded(views.heatmap(full_errors(spark, folder), features=ENGINE), "value")


def _ring(cell):
    """A cell outline the way saved maps spell it."""
    points = F.transform(
        G.hex_boundary(cell),
        lambda p: F.concat(F.lit("["), p["lat"].cast("string"), F.lit(", "), p["lon"].cast("string"), F.lit("]")),
    )
    return F.concat(F.lit("["), F.array_join(points, ", "), F.lit("]"))


def saved_maps(spark, folder):
    """One text file per date and hour holding its cells as map polygons."""
    path = fresh_path(spark, "html")
    shape = F.concat(
        F.lit("var p = L.polygon(\n    "),
        _ring("cell"),
        F.lit(',\n    {"bubblingMouseEvents": true, "color": "'),
        F.col("colour"),
        F.lit('", "fill": true, "fillColor": "'),
        F.col("colour"),
        F.lit('", "weight": 0.35}\n).addTo(map_0);'),
    )
    lines = hourly_cells(spark, folder).select("date", shape.alias("value"))
    lines.repartition("date").write.partitionBy("date").text(path)
    return files.read_texts(spark, path, pattern="*.txt")


@query(
    "f20_extract_polygons",
    with_(GPS, _FLAG, HOURLY)
    + """SELECT CAST(date AS VARCHAR) AS day, colour, count(*) AS polygons, CAST(sum(6) AS BIGINT) AS points
    FROM coloured GROUP BY ALL""",
)
def f20(spark, folder):
    found = files.extract_polygons(saved_maps(spark, folder))
    day = F.regexp_extract("path", "date=([0-9-]+)/", 1).alias("day")
    return found.groupBy(day, "colour").agg(
        F.count(F.lit(1)).alias("polygons"), F.sum(F.size("coordinates")).alias("points")
    )


