"""Joins, aggregations and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeline.functions import geo as G
from wakeline.functions import severity
from wakeline.functions import values as V
from wakeline.functions.timeops import col
from wakeline.operators import cells, features, joins, reshape, scoring, trips, upsert, weather
from wakeline.plans import engine
from wakeline.registry import frames
from wakeline.registry.base import (
    ENGINE,
    ENGINE_CHAIN,
    TEL,
    WX,
    WX_ONLY,
    bucket,
    ellipsoid,
    gps_chain,
    hav,
    hex_sql,
    number_trips,
    query,
    rounded,
    s6,
    with_,
)
from wakeline.registry.frames import TIE
from wakeline.session import stored
from wakeline.sources import events

RPM_TRIPS = (
    f"rpm_trips AS ({number_trips('(SELECT event_id, node_name, time FROM tel WHERE signal_name_alias = ' + chr(39) + 'RPM' + chr(39) + ' AND value > 0)', 1200)}),\n"
    "intervals AS (SELECT node_name, trip_id, min(time) - INTERVAL 10 MINUTE AS start,"
    " max(time) + INTERVAL 10 MINUTE AS stop FROM rpm_trips GROUP BY ALL)"
)


def rpm_intervals(spark, folder):
    rpm = frames.tel(spark, folder).filter("signal_name_alias = 'RPM'")
    return trips.discover_trips(rpm, tie=TIE)


@query(
    "j01_interval_join",
    with_(TEL, RPM_TRIPS)
    + """SELECT t.event_id, t.node_name, i.trip_id FROM tel t JOIN intervals i
    ON t.node_name = i.node_name AND t.time >= i.start AND t.time <= i.stop""",
)
def j01(spark, folder):
    hit = engine.trip_signals(frames.tel(spark, folder), rpm_intervals(spark, folder))
    return hit.select("event_id", "node_name", "trip_id")


GEO_EVEN = f"""geo_even AS (
  SELECT node_name, {bucket('time', 3600)} AS ts, avg(value) FILTER (signal_name_alias = 'SOG') AS SOG,
         avg(value) FILTER (signal_name_alias = 'COG') AS COG
  FROM tel WHERE signal_instance IS NULL GROUP BY ALL)"""


def geo_even(spark, folder):
    rows = frames.tel(spark, folder).filter(F.col("signal_instance").isNull())
    wide = engine.widen(rows, ("SOG", "COG"), geo=True, tie=TIE)
    return engine.resampled(wide, ("SOG", "COG"), step_seconds=3600)


@query(
    "j02_merge_positions",
    with_(ENGINE_CHAIN, GEO_EVEN)
    + f"""SELECT e.node_name, e.signal_instance, e.ts, {s6('e.RPM', 'RPM')}, {s6('g.SOG', 'SOG')}, {s6('g.COG', 'COG')}
    FROM even e LEFT JOIN geo_even g USING (node_name, ts)""",
)
def j02(spark, folder):
    merged = weather.merge_positions(frames.even(spark, folder), geo_even(spark, folder))
    out = merged.select("node_name", "signal_instance", "ts", "RPM", "SOG", "COG")
    return rounded(out, "RPM", "SOG", "COG")


@query(
    "j03_nearest_hour",
    with_(WX)
    + """SELECT t.event_id, w.wind_speed_10m AS wind_velocity, w.wind_direction_10m AS wind_angle FROM tel t
    LEFT JOIN wx w ON w.node_name = t.node_name AND w.date = date_trunc('hour', t.time + INTERVAL 30 MINUTE)""",
)
def j03(spark, folder):
    rows = frames.tel(spark, folder).withColumns({"LAT": F.lit(0.0), "LON": F.lit(0.0)})
    windy = weather.add_weather(rows, events.weather(spark, folder), ts="time")
    return windy.select("event_id", "wind_velocity", "wind_angle")


@query(
    "j03_nearest_gappy_hours",
    with_(TEL)
    + """, half AS (SELECT event_id, node_name, date_trunc('hour', time) + INTERVAL 30 MINUTE AS time FROM tel),
    readings AS (SELECT DISTINCT node_name, date_trunc('hour', time) AS rt, CAST(hour(time) AS DOUBLE) AS wind FROM tel
                 WHERE hour(time) % 3 <> 0)
    SELECT event_id, arg_min(wind, (gap, -epoch_us(rt))) AS wind
    FROM (SELECT h.event_id, r.rt, r.wind, abs(epoch_us(h.time) - epoch_us(r.rt)) AS gap FROM half h
          LEFT JOIN readings r ON r.node_name = h.node_name AND r.rt BETWEEN h.time - INTERVAL 30 MINUTE AND h.time + INTERVAL 30 MINUTE)
    GROUP BY event_id""",
)
def j03_gaps(spark, folder):
    """Rows at half past, readings on full hours with gaps, each reading twice."""
    tel = frames.tel(spark, folder)
    hour = F.date_trunc("hour", "time").cast("timestamp_ntz")
    rows = tel.select("event_id", "node_name", (hour + F.expr("INTERVAL 30 MINUTE")).alias("time"))
    readings = tel.filter(F.hour("time") % 3 != 0).select(
        "node_name", hour.alias("date"), F.hour("time").cast("double").alias("wind_speed_10m"), F.lit(0.0).alias("wind_direction_10m")
    ).distinct()
    rows = rows.withColumns({"LAT": F.lit(0.0), "LON": F.lit(0.0)})
    windy = weather.add_weather(rows, readings.union(readings), ts="time")
    return windy.select("event_id", F.col("wind_velocity").alias("wind"))


@query(
    "j03_nearest_odd_times",
    with_(TEL)
    + """, readings AS (
      SELECT node_name, date_trunc('hour', time) + to_minutes(CAST(m AS BIGINT)) AS rt, CAST((hour(time) * 7 + m) % 11 AS DOUBLE) AS wind
      FROM tel, (VALUES (0), (30), (50)) AS t(m) WHERE hour(time) % 4 <> 1 GROUP BY ALL)
    SELECT event_id, arg_min(wind, (gap, -epoch_us(rt))) AS wind
    FROM (SELECT h.event_id, r.rt, r.wind, abs(epoch_us(h.time) - epoch_us(r.rt)) AS gap FROM tel h
          LEFT JOIN readings r ON r.node_name = h.node_name AND r.rt BETWEEN h.time - INTERVAL 30 MINUTE AND h.time + INTERVAL 30 MINUTE)
    GROUP BY event_id""",
)
def j03_odd(spark, folder):
    """Readings at the hour, half past and ten to, with hours missing."""
    tel = frames.tel(spark, folder)
    hour = F.date_trunc("hour", "time").cast("timestamp_ntz")
    minute = F.explode(F.array(*(F.lit(m) for m in (0, 30, 50))))
    readings = tel.filter(F.hour("time") % 4 != 1).select("node_name", hour.alias("_h"), F.hour("time").alias("_n")).distinct()
    readings = readings.select("node_name", "_h", "_n", minute.alias("_m")).select(
        "node_name",
        (col("_h") + F.make_dt_interval(mins="_m")).alias("date"),
        ((F.col("_n") * 7 + F.col("_m")) % 11).cast("double").alias("wind_speed_10m"),
        F.lit(0.0).alias("wind_direction_10m"),
    )
    rows = tel.withColumns({"LAT": F.lit(0.0), "LON": F.lit(0.0)})
    windy = weather.add_weather(rows, readings, ts="time")
    return windy.select("event_id", F.col("wind_velocity").alias("wind"))


@query(
    "j03_nearest_any_grid",
    with_(TEL)
    + """, readings AS (SELECT event_id AS reading_id, node_name, time AS rt, value AS wind FROM tel WHERE signal_name_alias = 'SOG')
    SELECT event_id, arg_min(wind, (gap, -epoch_us(rt), reading_id)) FILTER (gap <= 1800000000) AS wind
    FROM (SELECT t.event_id, r.*, abs(epoch_us(t.time) - epoch_us(r.rt)) AS gap
          FROM tel t LEFT JOIN readings r ON r.node_name = t.node_name
            AND r.rt BETWEEN t.time - INTERVAL 30 MINUTE AND t.time + INTERVAL 30 MINUTE)
    GROUP BY event_id""",
)
def j03_any(spark, folder):
    """Irregular readings: the speed rows themselves serve as the readings."""
    rows = frames.tel(spark, folder).select("event_id", "node_name", "time", "signal_name_alias", "value")
    readings = rows.filter("signal_name_alias = 'SOG'").select(
        "node_name",
        col("event_id").alias("reading_id"),
        col("time").alias("reading_time"),
        col("value").alias("wind"),
    )
    near = joins.nearest_in_time(
        rows, readings, key="node_name", ts="time", reading_ts="reading_time"
    )
    return near.select("event_id", "wind")


@query(
    "j04_weather_alignment",
    with_(ENGINE_CHAIN, GEO_EVEN, WX_ONLY)
    + f"""SELECT node_name, signal_instance, ts, wind_velocity, wind_angle,
      round(CASE WHEN d > 180 THEN d - 360 WHEN d < -180 THEN d + 360 ELSE d END / 180 + 3.1e-8, 6) + 0e0 AS alignment_factor
    FROM (SELECT e.node_name, e.signal_instance, e.ts, w.wind_speed_10m AS wind_velocity, w.wind_direction_10m AS wind_angle,
            w.wind_direction_10m % 360e0 - g.COG % 360e0 AS d
          FROM even e LEFT JOIN geo_even g USING (node_name, ts)
          LEFT JOIN wx w ON w.node_name = e.node_name AND w.date = date_trunc('hour', e.ts + INTERVAL 30 MINUTE))""",
)
def j04(spark, folder):
    merged = weather.merge_positions(frames.even(spark, folder), geo_even(spark, folder))
    placed = merged.withColumns({"LAT": F.lit(0.0), "LON": F.lit(0.0)})
    windy = weather.add_weather(placed, events.weather(spark, folder))
    out = windy.select("node_name", "signal_instance", "ts", "wind_velocity", "wind_angle", "alignment_factor")
    return rounded(out, "alignment_factor")


GPS = gps_chain()


@query(
    "j05_span_centroid",
    with_(GPS)
    + f"""SELECT node_name, CAST(min(ts) AS DATE) AS first_date, CAST(max(ts) AS DATE) AS last_date,
      {s6('avg(LAT)', 'LAT')}, {s6('avg(LON)', 'LON')} FROM gps_wide GROUP BY node_name""",
)
def j05(spark, folder):
    wide = reshape.resample_gps(_named(spark, folder))
    return rounded(weather.node_spans(wide), "LAT", "LON")


def _named(spark, folder):
    from wakeline.functions.text import strip_prefix

    return frames.gps_long(spark, folder).withColumn(
        "signal_name_alias", strip_prefix("signal_name_alias")
    )


@query(
    "j06_drop_short_trips",
    with_(ENGINE_CHAIN)
    + """SELECT node_name, signal_instance, ts, TRIP_ID FROM filled SEMI JOIN (
      SELECT node_name, TRIP_ID FROM filled GROUP BY ALL HAVING epoch_us(max(ts)) - epoch_us(min(ts)) > 600000000)
    USING (node_name, TRIP_ID)""",
)
def j06(spark, folder):
    kept = trips.drop_short_trips(frames.filled(spark, folder))
    return kept.select("node_name", "signal_instance", "ts", "TRIP_ID")


# Trips whose fastest row beats 400: a stand-in for a model's verdict.
_FLAG = "flag AS (SELECT node_name, tripID FROM gps GROUP BY ALL HAVING max(SOG) > 400)"


def flagged(rows):
    return rows.groupBy("node_name", "tripID").agg(F.max("SOG").alias("_s")).filter("_s > 400")


@query(
    "j07_split_flagged",
    with_(GPS, _FLAG)
    + """SELECT node_name, ts, tripID, (node_name, tripID) IN (SELECT (node_name, tripID) FROM flag) AS anomalous FROM gps""",
)
def j07(spark, folder):
    rows = stored(frames.gps_rows(spark, folder).select("node_name", "ts", "tripID", "SOG"), "gps")
    return scoring.mark_flagged(rows, flagged(rows)).drop("SOG")


_METRICS = f"""med AS (SELECT node_name, tripID, median(LAT) AS mlat, median(LON) AS mlon FROM gps GROUP BY ALL),
far AS (SELECT node_name, tripID, max({hav('LAT', 'LON', 'mlat', 'mlon')}) AS max_distance
        FROM gps JOIN med USING (node_name, tripID) GROUP BY ALL),
path AS (SELECT node_name, tripID, coalesce(sum({hav('lat0', 'lon0', 'LAT', 'LON')}), 0) AS total_distance FROM (
  SELECT *, lag(LAT) OVER w AS lat0, lag(LON) OVER w AS lon0 FROM gps WINDOW w AS (PARTITION BY node_name, tripID ORDER BY ts))
  GROUP BY ALL),
fast AS (SELECT node_name, tripID, max(SOG) AS max_speed FROM gps GROUP BY ALL)"""


@query(
    "j08_trip_summary",
    with_(GPS, _METRICS)
    + f"""SELECT node_name, tripID, {s6('mlat', 'LAT')}, {s6('mlon', 'LON')}, node_name AS vessels,
      round(max_distance, 2) + 0e0 AS max_distance, round(max_speed, 2) + 0e0 AS max_speed,
      round(total_distance, 2) + 0e0 AS total_distance
    FROM med JOIN far USING (node_name, tripID) JOIN path USING (node_name, tripID) JOIN fast USING (node_name, tripID)""",
)
def j08(spark, folder):
    summary = cells.trip_summary(frames.gps_stored(spark, folder))
    return rounded(summary, "LAT", "LON")


@query(
    "j09_alias_map",
    with_(TEL)
    + """SELECT event_id, CASE WHEN event_type = 'error' THEN 'ENGTEMP' ELSE event_type END AS resolved FROM events""",
)
def j09(spark, folder):
    """Names spelled ``ENG_TEMP1`` map to the known signal, others stay."""
    e = events.table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "Eng_Temp1").otherwise(F.col("event_type")).alias("alias"),
    )
    exact = reshape.exact_alias("alias")
    mapping = e.select("alias").distinct().withColumn("resolved", F.coalesce(exact, "alias"))
    mapped = reshape.apply_alias_map(e, stored(mapping, "aliases"), alias="alias")
    return mapped.withColumnRenamed("alias", "resolved")


@query(
    "j10_keys_travel",
    with_(ENGINE_CHAIN)
    + f"SELECT node_name, signal_instance, ts, {s6('RPM * RPM', 'RPM')} FROM filled WHERE RPM IS NOT NULL",
)
def j10(spark, folder):
    """Errors against an all-zero model: every row gets its own square back."""
    rows = frames.filled(spark, folder).select("node_name", "signal_instance", "ts", "RPM").na.drop()
    rebuilt = scoring.reconstruct_rows(rows, ["RPM"], lambda x: x * 0.0)
    return rounded(scoring.squared_errors(rebuilt, ["RPM"]), "RPM")


# --- aggregations ------------------------------------------------------------------------


@query(
    "a01_pivot_first",
    with_(ENGINE_CHAIN)
    + "SELECT node_name, signal_instance, time, RPM, FUELRATE, ENGTEMP, CAST(NULL AS DOUBLE) AS ENG_HOURS FROM eng_wide",
)
def a01(spark, folder):
    sided = frames.tel(spark, folder).withColumn("signal_instance", V.side_name("signal_instance"))
    return engine.widen(sided, (*ENGINE, "ENG_HOURS"), geo=False, tie=TIE)


@query(
    "a02_pivot_geo",
    with_(TEL)
    + """SELECT node_name, signal_instance, time, arg_min(value, event_id) FILTER (signal_name_alias = 'SOG') AS SOG,
      arg_min(value, event_id) FILTER (signal_name_alias = 'COG') AS COG
    FROM tel WHERE signal_name_alias IN ('SOG', 'COG') GROUP BY ALL""",
)
def a02(spark, folder):
    rows = frames.tel(spark, folder).filter(F.col("signal_name_alias").isin("SOG", "COG"))
    return engine.widen(rows, ("SOG", "COG"), geo=True, tie=TIE)


@query(
    "a03_resample",
    with_(ENGINE_CHAIN)
    + f"""SELECT node_name, signal_instance, ts, CAST(ts AS DATE) AS date, strftime(ts, '%H:%M:%S') AS time,
      {s6('RPM', 'RPM')}, {s6('FUELRATE', 'FUELRATE')}, {s6('ENGTEMP', 'ENGTEMP')} FROM even""",
)
def a03(spark, folder):
    return rounded(frames.even(spark, folder), *ENGINE)


@query(
    "a03_resample_date_first",
    with_(ENGINE_CHAIN)
    + f"""SELECT node_name, signal_instance, date, time, {s6('avg(RPM)', 'RPM')} FROM (
      SELECT node_name, signal_instance, RPM, CAST(time AS DATE) AS date, strftime({bucket('time', 3600)}, '%H:%M:%S') AS time
      FROM eng_wide) GROUP BY ALL""",
)
def a03_date_first(spark, folder):
    rows = engine.resampled(
        frames.engine_wide(spark, folder), ("RPM",), step_seconds=3600, date_before_round=True
    )
    return rounded(rows.select("node_name", "signal_instance", "date", "time", "RPM"), "RPM")


@query(
    "a04_resample_gps",
    with_(GPS)
    + f"SELECT node_name, ts, {', '.join(s6(s, s) for s in ('LAT', 'LON', 'SOG', 'COG', 'RPM', 'CELL'))} FROM gps_wide",
)
def a04(spark, folder):
    wide = reshape.resample_gps(_named(spark, folder))
    return rounded(wide.drop("date", "time"), "LAT", "LON", "SOG", "COG", "RPM", "CELL")


_TEL_TRIPS = f"trips AS ({number_trips('tel', 1200)})"


def tel_trips(spark, folder):
    return trips.number_trips(frames.tel(spark, folder), gap_seconds=1200, tie=TIE)


@query(
    "a05_endpoints",
    with_(TEL, _TEL_TRIPS)
    + """SELECT node_name, trip_id, min(time) AS first_time, max(time) AS last_time,
      arg_min(value, (time, event_id)) AS first_value, arg_max(value, (time, event_id)) AS last_value
    FROM trips GROUP BY ALL""",
)
def a05(spark, folder):
    return trips.trip_endpoints(tel_trips(spark, folder), tie=TIE)


_INTERVALS = """SELECT node_name, trip_id, min(time) - INTERVAL 10 MINUTE AS start, max(time) + INTERVAL 10 MINUTE AS stop
    FROM trips GROUP BY ALL"""


@query("a06_trip_intervals", with_(TEL, _TEL_TRIPS) + _INTERVALS)
def a06(spark, folder):
    return trips.trip_intervals(tel_trips(spark, folder))


@query(
    "a07_overall_span",
    with_(TEL, _TEL_TRIPS, f"iv AS ({_INTERVALS})") + "SELECT min(start) AS start, max(stop) AS stop FROM iv",
)
def a07(spark, folder):
    return trips.overall_span(trips.trip_intervals(tel_trips(spark, folder)))


@query(
    "a08_timespans",
    with_(TEL, _TEL_TRIPS)
    + f"""SELECT node_name, trip_id, {s6('(epoch_us(max(time)) - epoch_us(min(time))) / 60e6', 'timespan')}
    FROM trips GROUP BY ALL HAVING epoch_us(max(time)) - epoch_us(min(time)) > 600000000""",
)
def a08(spark, folder):
    spans = trips.trip_spans(tel_trips(spark, folder), keys=["node_name", "trip_id"], ts="time")
    return rounded(spans.select("node_name", "trip_id", "timespan"), "timespan")


@query(
    "a09_node_span",
    with_(GPS)
    + f"""SELECT node_name, CAST(min(ts) AS DATE) AS first_date, CAST(max(ts) AS DATE) AS last_date,
      {s6('avg(LAT)', 'LAT')}, {s6('avg(LON)', 'LON')} FROM gps GROUP BY node_name""",
)
def a09(spark, folder):
    return rounded(weather.node_spans(frames.gps_rows(spark, folder)), "LAT", "LON")


@query(
    "a10_daily_error",
    with_(ENGINE_CHAIN)
    + f"""SELECT node_name, CAST(ts AS DATE) AS date, {s6('avg((RPM - 100) * (RPM - 100))', 'RPM')},
      {s6('avg((ENGTEMP - 100) * (ENGTEMP - 100))', 'ENGTEMP')} FROM filled GROUP BY ALL""",
)
def a10(spark, folder):
    rows = frames.filled(spark, folder).withColumns(
        {"RPM_rebuilt": F.lit(100.0), "ENGTEMP_rebuilt": F.lit(100.0)}
    )
    errors = scoring.squared_errors(rows, ["RPM", "ENGTEMP"])
    return rounded(scoring.daily_errors(errors, ["RPM", "ENGTEMP"]), "RPM", "ENGTEMP")


@query(
    "a11_daily_absolute_error",
    with_(ENGINE_CHAIN)
    + f"""SELECT node_name, CAST(ts AS DATE) AS date, {s6('avg(abs(RPM - 100))', 'RPM')},
      {s6('avg(abs(ENGTEMP - 100))', 'ENGTEMP')} FROM filled GROUP BY ALL""",
)
def a11(spark, folder):
    rows = frames.filled(spark, folder).withColumns(
        {"RPM_rebuilt": F.lit(100.0), "ENGTEMP_rebuilt": F.lit(100.0)}
    )
    errors = scoring.absolute_errors(rows, ["RPM", "ENGTEMP"])
    return rounded(scoring.daily_errors(errors, ["RPM", "ENGTEMP"]), "RPM", "ENGTEMP")


@query(
    "a12_heatmap_matrix",
    with_(ENGINE_CHAIN)
    + f"""SELECT node_name, feature, CAST(date AS VARCHAR) AS date, {s6('value', 'value')}
    FROM (SELECT node_name, date, unnest(['RPM', 'FUELRATE', 'ENGTEMP']) AS feature, unnest([r, f, e]) AS value
          FROM (SELECT node_name, CAST(ts AS DATE) AS date, avg(RPM) AS r, avg(FUELRATE) AS f, avg(ENGTEMP) AS e
                FROM even GROUP BY ALL)) WHERE value IS NOT NULL""",
)
def a12(spark, folder):
    """The matrix with a column for every date, turned back into rows to compare."""
    daily = stored(scoring.daily_errors(frames.even(spark, folder), ENGINE), "daily")
    dates = reshape.dates_of(daily)
    wide = reshape.error_matrix(daily, ENGINE, dates=dates)
    return rounded(wide.unpivot(["node_name", "feature"], dates, "date", "value").filter("value is not null"), "value")


_CELLS = f"cells AS ({hex_sql('LAT', 'LON', 'gps', '* EXCLUDE (CELL)')})"


@query(
    "a13_cell_trips",
    with_(GPS, _FLAG, _CELLS)
    + """SELECT cell, count(DISTINCT CASE WHEN f.tripID IS NOT NULL THEN (c.node_name, c.tripID) END) AS trips
    FROM cells c LEFT JOIN flag f ON f.node_name = c.node_name AND f.tripID = c.tripID GROUP BY cell""",
)
def a13(spark, folder):
    rows = frames.gps_stored(spark, folder)
    return cells.cell_counts(scoring.mark_flagged(rows, flagged(rows)))


@query(
    "a14_box_cells",
    with_(GPS, f"""box AS (SELECT floor(min(LAT)) AS a, ceil(max(LAT)) AS b, floor(min(LON)) AS c, ceil(max(LON)) AS d FROM gps_wide),
points AS (SELECT a + i * 0.1e0 AS lat, c + j * 0.1e0 AS lon FROM box,
           unnest(generate_series(0, CAST(ceil((b - a) / 0.1e0) AS BIGINT) - 1)) t(i),
           unnest(generate_series(0, CAST(ceil((d - c) / 0.1e0) AS BIGINT) - 1)) u(j)),
grid AS ({hex_sql('lat', 'lon', 'points')})""")
    + "SELECT DISTINCT cell FROM grid",
)
def a14(spark, folder):
    wide = reshape.resample_gps(_named(spark, folder))
    box = wide.agg(
        F.floor(F.min("LAT")).cast("double").alias("lat_min"),
        F.ceil(F.max("LAT")).cast("double").alias("lat_max"),
        F.floor(F.min("LON")).cast("double").alias("lon_min"),
        F.ceil(F.max("LON")).cast("double").alias("lon_max"),
    )
    return cells.box_cells(box)


@query(
    "a15_median_position",
    with_(GPS, _METRICS)
    + f"SELECT node_name, tripID, {s6('mlat', 'LAT')}, {s6('mlon', 'LON')} FROM med",
)
def a15(spark, folder):
    return rounded(cells.median_positions(frames.gps_stored(spark, folder)), "LAT", "LON")


@query(
    "a15_vessel_names",
    "SELECT event_type AS trip, string_agg(DISTINCT 'boat-' || (user_id % 8), ', ' ORDER BY 'boat-' || (user_id % 8)) AS vessels"
    " FROM events GROUP BY 1",
)
def a15_names(spark, folder):
    rows = events.table(spark, folder, "events")
    named = rows.select(F.col("event_type").alias("trip"), events.vessel_name().alias("node_name"))
    return cells.vessel_names(named, trip=["trip"])


@query(
    "a16_max_distance",
    with_(GPS, _METRICS) + f"SELECT node_name, tripID, {s6('max_distance', 'max_distance')} FROM far",
)
def a16(spark, folder):
    return rounded(cells.max_distance_to_median(frames.gps_stored(spark, folder)), "max_distance")


@query("a17_max_speed", with_(GPS, _METRICS) + f"SELECT node_name, tripID, {s6('max_speed', 'max_speed')} FROM fast")
def a17(spark, folder):
    return rounded(cells.max_speed(frames.gps_rows(spark, folder)), "max_speed")


@query(
    "a18_path_length",
    with_(GPS, _METRICS) + "SELECT node_name, tripID, round(total_distance + 3.1e-5, 3) + 0e0 AS total_distance FROM path",
)
def a18(spark, folder):
    lengths = cells.path_length(frames.gps_rows(spark, folder, counted=True))
    return lengths.withColumn("total_distance", F.round(F.col("total_distance") + F.lit(3.1e-5), 3))


@query(
    "a16_geodesic",
    with_(GPS, _METRICS, ellipsoid("away", "LAT", "LON", "mlat", "mlon", "(SELECT g.node_name, g.tripID, g.LAT, g.LON, m.mlat, m.mlon FROM gps g JOIN med m USING (node_name, tripID))"))
    + "SELECT node_name, tripID, round(max(enm) + 3.1e-5, 3) + 0e0 AS max_distance FROM away GROUP BY ALL",
)
def a16_geodesic(spark, folder):
    """Largest distance to the median position, on the ellipsoid."""
    far = cells.max_distance_to_median(frames.gps_stored(spark, folder), distance=G.ellipsoidal_nm)
    return far.withColumn("max_distance", F.round(F.col("max_distance") + F.lit(3.1e-5), 3) + F.lit(0.0))


@query(
    "a18_geodesic",
    with_(
        GPS,
        "steps AS (SELECT node_name, tripID, LAT, LON, lag(LAT) OVER w AS plat, lag(LON) OVER w AS plon FROM gps WINDOW w AS (PARTITION BY node_name, tripID ORDER BY ts))",
        ellipsoid("legs", "plat", "plon", "LAT", "LON", "steps"),
    )
    + "SELECT node_name, tripID, round(coalesce(sum(enm), 0) + 3.1e-5, 3) + 0e0 AS total_distance FROM legs GROUP BY ALL",
)
def a18_geodesic(spark, folder):
    """Path length on the ellipsoid."""
    rows = frames.gps_stored(spark, folder)
    lengths = cells.path_length(rows, distance=G.ellipsoidal_nm)
    return lengths.withColumn("total_distance", F.round(F.col("total_distance") + F.lit(3.1e-5), 3))


HOURLY = (
    _CELLS
    + """, hourly AS (
  SELECT CAST(c.ts AS DATE) AS date, CAST(hour(c.ts) AS INTEGER) AS hour, cell,
         count(DISTINCT CASE WHEN f.tripID IS NOT NULL THEN (c.node_name, c.tripID) END) AS trips
  FROM cells c LEFT JOIN flag f ON f.node_name = c.node_name AND f.tripID = c.tripID GROUP BY ALL),
coloured AS (SELECT *, CASE WHEN trips > 1 THEN '#910606' WHEN trips = 1 THEN '#FFFF00' ELSE '#086e1f' END AS colour FROM hourly)"""
)


def hourly_cells(spark, folder):
    """Coloured cells per date and hour."""
    rows = frames.gps_stored(spark, folder)
    return cells.hourly_cells(scoring.mark_flagged(rows, flagged(rows)))


@query(
    "a19_daily_severity",
    with_(GPS, _FLAG, HOURLY)
    + """SELECT date, cell, CASE max(CASE WHEN trips > 1 THEN 2 ELSE trips END) WHEN 2 THEN '#910606' WHEN 1 THEN '#FFFF00'
      ELSE '#086e1f' END AS colour FROM hourly GROUP BY ALL""",
)
def a19(spark, folder):
    return cells.worst_colour(hourly_cells(spark, folder))


@query("a20_distinct", with_(TEL) + "SELECT DISTINCT signal_name_alias FROM tel")
def a20(spark, folder):
    return reshape.distinct_values(frames.tel(spark, folder), "signal_name_alias")


@query(
    "a21_z_scores",
    f"""SELECT o_orderkey, {s6('(o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / (SELECT stddev_pop(o_totalprice) FROM orders)', 'o_totalprice_z')}
    FROM orders""",
)
def a21(spark, folder):
    z = features.z_scores(frames.orders(spark, folder).select("o_orderkey", "o_totalprice"), ["o_totalprice"])
    return rounded(z.select("o_orderkey", "o_totalprice_z"), "o_totalprice_z")


_LINE = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "a22_min_max",
    "WITH r AS (SELECT "
    + ", ".join(f"min({f}) AS {f}_a, max({f}) AS {f}_z" for f in _LINE)
    + " FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-06-01') SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        s6(f"({f} - {f}_a) / CASE WHEN {f}_z = {f}_a THEN 1e0 ELSE CAST({f}_z AS DOUBLE) - {f}_a END", f) for f in _LINE
    )
    + " FROM lineitem, r",
)
def a22(spark, folder):
    """Range of the early rows, applied to all."""
    rows = frames.lineitem(spark, folder)
    early = rows.filter(F.to_date("l_shipdate") <= F.lit("1998-06-01").cast("date"))
    scaled = features.apply_min_max(rows, features.fit_min_max(early, _LINE), _LINE)
    return rounded(scaled.select("l_orderkey", "l_linenumber", *_LINE), *_LINE)


@query("a23_latest_date", with_(TEL) + "SELECT CAST(max(time) AS DATE) AS latest FROM tel")
def a23(spark, folder):
    rows = frames.tel(spark, folder).withColumn("date", F.to_date("time"))
    return upsert.latest_date(rows)


# --- order and sets ----------------------------------------------------------------------


@query(
    "o01_sorted",
    with_(TEL) + "SELECT event_id, node_name, time FROM tel ORDER BY node_name, time, event_id",
)
def o01(spark, folder):
    return frames.tel(spark, folder).select("event_id", "node_name", "time").orderBy(
        "node_name", "time", "event_id"
    )


@query("o02_limit", with_(TEL) + "SELECT event_id, value FROM tel ORDER BY value DESC, event_id LIMIT 10")
def o02(spark, folder):
    rows = frames.tel(spark, folder).select("event_id", "value")
    return rows.orderBy(F.desc("value"), "event_id").limit(10)


_KEYS = {
    "rpm": "RPM", "fuelrate": "FUELRATE", "engineload": "ENGINE_LOAD", "engtemp": "ENGTEMP",
    "engoilpres": "ENGOILPRES", "enghours": "ENG_HOURS", "lat": "LAT", "lon": "LON", "sog": "SOG", "cog": "COG",
}
_KEY_ROWS = ", ".join(f"('{k}', '{v}')" for k, v in _KEYS.items())


@query(
    "o03_best_match",
    f"""WITH names AS (SELECT DISTINCT p_name AS alias, regexp_replace(replace(lower(p_name), '_', ''), '[0-9]', '', 'g') AS c FROM part),
    scored AS (SELECT alias, v AS match, k, 1e0 - levenshtein(c, k) / CAST(greatest(length(c), length(k)) AS DOUBLE) AS score
      FROM names, (VALUES {_KEY_ROWS}) t(k, v))
    SELECT alias, arg_max(match, (score, k)) AS match, {s6('max(score)', 'score')} FROM scored WHERE score >= 0.2e0 GROUP BY alias""",
)
def o03(spark, folder):
    names = events.table(spark, folder, "part").select(F.col("p_name").alias("alias"))
    return rounded(reshape.best_match_levenshtein(names, alias="alias", cutoff=0.2), "score")


@query(
    "u01_union",
    with_(TEL)
    + """SELECT event_id, value, CAST(NULL AS VARCHAR) AS signal_instance FROM tel WHERE signal_instance IS NULL
    UNION ALL SELECT event_id, NULL, signal_instance FROM tel WHERE signal_instance IS NOT NULL""",
)
def u01(spark, folder):
    rows = frames.tel(spark, folder)
    return reshape.union_all(
        [
            rows.filter(F.col("signal_instance").isNull()).select("event_id", "value"),
            rows.filter(F.col("signal_instance").isNotNull()).select("event_id", "signal_instance"),
        ]
    )


@query(
    "u02_first_per_key",
    with_(TEL)
    + """SELECT node_name, signal_name_alias, min(event_id) AS event_id, arg_min(value, event_id) AS value
    FROM tel GROUP BY ALL""",
)
def u02(spark, folder):
    rows = frames.tel(spark, folder).select("node_name", "signal_name_alias", "event_id", "value")
    return reshape.first_per_key(rows, ["node_name", "signal_name_alias"], ["event_id"])


@query(
    "u03_upsert",
    with_(TEL)
    + """, old AS (SELECT node_name, time, value, CAST(1 AS BIGINT) AS TRIP_ID FROM tel WHERE event_id % 3 < 2),
    new AS (SELECT node_name, time, value, CAST(2 AS BIGINT) AS TRIP_ID FROM tel WHERE event_id % 3 > 0)
    SELECT node_name, time, value, min(TRIP_ID) AS TRIP_ID FROM (SELECT * FROM old UNION ALL SELECT * FROM new) GROUP BY ALL""",
)
def u03(spark, folder):
    """Overlapping old and new rows; both ids present means the old one stays."""
    rows = frames.tel(spark, folder)
    third = F.pmod("event_id", F.lit(3))
    pick = lambda keep, trip: rows.filter(keep).select(
        "node_name", "time", "value", F.lit(trip).cast("bigint").alias("TRIP_ID")
    )
    return upsert.upsert(pick(third < 2, 1), pick(third > 0, 2))


@query(
    "u04_difference",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""",
)
def u04(spark, folder):
    customers = events.table(spark, folder, "customer").select("c_custkey", "c_name")
    large = frames.orders(spark, folder).filter("o_totalprice > 400000")
    buyers = large.select(F.col("o_custkey").alias("c_custkey"))
    return joins.unmatched(customers, buyers, ["c_custkey"])
