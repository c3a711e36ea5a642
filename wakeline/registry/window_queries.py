"""Ordered operators and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeline.functions import geo as G
from wakeline.functions import text
from wakeline.functions import timeops as tm
from wakeline.functions import values as V
from wakeline.operators import features, impute, reshape, scoring, sequences, sliced, trips
from wakeline.registry import frames
from wakeline.registry.base import (
    ENGINE,
    ENGINE_CHAIN,
    HOURS2,
    TEL,
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
from wakeline.sources import events

GPS = gps_chain()


def _trip_query(name, gap, out="trip_id", **options):
    sql_options = {k: v for k, v in options.items() if k in ("inclusive", "midnight")}

    @query(name, with_(TEL) + f"SELECT event_id, node_name, {out} FROM ({number_trips('tel', gap, out=out, **sql_options)})")
    def run(spark, folder):
        numbered = trips.number_trips(
            frames.tel(spark, folder),
            gap_seconds=gap,
            tie=TIE,
            inclusive=options.get("inclusive", False),
            break_at_midnight=options.get("midnight", False),
            out=out,
        )
        return numbered.select("event_id", "node_name", out)


_trip_query("w01_trips_gap20", 20 * 60)
_trip_query("w02_trips_daily", 30 * 60, out="TRIP_ID", inclusive=True, midnight=True)
_trip_query("w03_trips_gap10", 10 * 60, out="TRIP_ID")


@query(
    "w04_trips_global",
    with_(TEL, f"t AS ({number_trips('tel', 300)})")
    + """SELECT event_id, node_name, CAST(trip_id + coalesce(o, 0) AS BIGINT) AS "tripID" FROM t
    JOIN (SELECT node_name, sum(n) OVER (ORDER BY node_name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS o
          FROM (SELECT node_name, max(trip_id) AS n FROM t GROUP BY 1)) USING (node_name)""",
)
def w04(spark, folder):
    numbered = trips.number_trips(frames.tel(spark, folder), gap_seconds=300, tie=TIE)
    return trips.globally_numbered(numbered).select("event_id", "node_name", "tripID")


def _fill_sql(expr, source="even_trips", keys="node_name, TRIP_ID, signal_instance"):
    return (
        with_(ENGINE_CHAIN)
        + f"""SELECT node_name, signal_instance, ts, {expr} FROM {source}
    WINDOW p AS (PARTITION BY {keys} ORDER BY ts ROWS UNBOUNDED PRECEDING),
           n AS (PARTITION BY {keys} ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""
    )


def _prev(c):
    return f"last_value({c} IGNORE NULLS) OVER p"


def _next(c):
    return f"first_value({c} IGNORE NULLS) OVER n"


@query(
    "w05_forward_fill",
    with_(ENGINE_CHAIN)
    + f"SELECT node_name, signal_instance, ts, {', '.join(s6(c, c) for c in ENGINE)} FROM filled",
)
def w05(spark, folder):
    rows = frames.filled(spark, folder).select("node_name", "signal_instance", "ts", *ENGINE)
    return rounded(rows, *ENGINE)


@query("w06_back_then_forward", _fill_sql(s6(f"coalesce({_next('ENGTEMP')}, {_prev('ENGTEMP')})", "ENGTEMP")))
def w06(spark, folder):
    rows = impute.fill(
        frames.even_trips(spark, folder),
        ["ENGTEMP"],
        keys=["node_name", "TRIP_ID", "signal_instance"],
        order="back_then_forward",
    )
    return rounded(rows.select("node_name", "signal_instance", "ts", "ENGTEMP"), "ENGTEMP")


@query("w07_forward_then_back", _fill_sql(s6(f"coalesce({_prev('RPM')}, {_next('RPM')})", "RPM")))
def w07(spark, folder):
    rows = impute.fill(
        frames.even_trips(spark, folder),
        ["RPM"],
        keys=["node_name", "TRIP_ID", "signal_instance"],
        order="forward_then_back",
    )
    return rounded(rows.select("node_name", "signal_instance", "ts", "RPM"), "RPM")


@query(
    "w08_gps_fill",
    with_(GPS)
    + f"SELECT node_name, ts, tripID, {', '.join(s6(c, c) for c in ('LAT', 'LON', 'SOG', 'COG', 'CELL'))} FROM gps",
)
def w08(spark, folder):
    rows = frames.gps_rows(spark, folder)
    names = ("LAT", "LON", "SOG", "COG", "CELL")
    return rounded(rows.select("node_name", "ts", "tripID", *names), *names)


@query(
    "w09_fill_within_date",
    _fill_sql(
        s6(f"coalesce({_prev('FUELRATE')}, {_next('FUELRATE')})", "FUELRATE"),
        source="even",
        keys="node_name, signal_instance, CAST(ts AS DATE)",
    ),
)
def w09(spark, folder):
    rows = impute.fill(
        frames.even(spark, folder),
        ["FUELRATE"],
        keys=["node_name", "signal_instance", "date"],
        order="forward_then_back",
        slice_seconds=None,
    )
    return rounded(rows.select("node_name", "signal_instance", "ts", "FUELRATE"), "FUELRATE")


_DELTAS = ("LAT_Delta", "LON_Delta", "SOG_Delta")


@query(
    "w10_deltas",
    with_(GPS) + f"SELECT node_name, ts, {', '.join(s6(c, c) for c in _DELTAS)} FROM gps",
)
def w10(spark, folder):
    return rounded(frames.gps_rows(spark, folder).select("node_name", "ts", *_DELTAS), *_DELTAS)


@query(
    "w11_time_steps",
    with_(TEL)
    + """SELECT event_id, round((epoch_us(time) - epoch_us(lag(time) OVER w)) / 1e6 + 3.1e-8, 6) + 0e0 AS time_diff,
      coalesce(CAST(time AS DATE) <> CAST(lag(time) OVER w AS DATE), true) AS new_day
    FROM tel WINDOW w AS (PARTITION BY node_name ORDER BY time, event_id)""",
)
def w11(spark, folder):
    steps = impute.time_steps(frames.tel(spark, folder), tie=TIE)
    return rounded(steps.select("event_id", "time_diff", "new_day"), "time_diff")


@query(
    "w12_ranked_endpoints",
    with_(TEL, f"t AS ({number_trips('tel', 1200)})")
    + """, iv AS (SELECT node_name, trip_id, min(time) - INTERVAL 10 MINUTE AS a, max(time) + INTERVAL 10 MINUTE AS z FROM t GROUP BY ALL)
    SELECT node_name, trip_id, 0 AS rank, 'start' AS edge, a AS time FROM iv
    UNION ALL SELECT node_name, trip_id, 1, 'stop', z FROM iv""",
)
def w12(spark, folder):
    numbered = trips.number_trips(frames.tel(spark, folder), gap_seconds=1200, tie=TIE)
    return trips.ranked_endpoints(trips.trip_intervals(numbered))


@query(
    "w13_rolling_mean",
    with_(TEL)
    + """SELECT event_id, CASE WHEN count(v) OVER w = 5 THEN round(avg(v) OVER w + 3.1e-8, 6) + 0e0 END AS value
    FROM (SELECT *, CASE WHEN value > 2 THEN value END AS v FROM tel)
    WINDOW w AS (PARTITION BY node_name ORDER BY time, event_id ROWS 4 PRECEDING)""",
)
def w13(spark, folder):
    rows = frames.tel(spark, folder).select(
        "event_id", "node_name", "time", F.when(F.col("value") > 2, F.col("value")).alias("value")
    )
    smooth = sliced.rolling_mean(rows, "value", 5, ["node_name"], "time", TIE)
    return rounded(smooth.select("event_id", "value"), "value")


@query(
    "w13_rolling_orders",
    """SELECT o_orderkey, CASE WHEN count(o_totalprice) OVER w = 7 THEN round(avg(o_totalprice) OVER w + 3.1e-8, 6) + 0e0 END AS smooth
    FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey ROWS 6 PRECEDING)""",
)
def w13_orders(spark, folder):
    """Five large keys over seven years: month slices, blocks of rows."""
    rows = frames.orders(spark, folder).select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    smooth = sliced.rolling_mean(
        rows,
        "o_totalprice",
        7,
        ["o_orderpriority"],
        "o_orderdate",
        ["o_orderkey"],
        out="smooth",
        slice_seconds=30 * 24 * 3600,
    )
    return rounded(smooth.select("o_orderkey", "smooth"), "smooth")


_HOUR_TRIPS = f"t AS ({number_trips('tel', HOURS2)})"


def hour_trips(spark, folder):
    return trips.number_trips(frames.tel(spark, folder), gap_seconds=HOURS2, tie=TIE)


@query(
    "w14_break_markers",
    with_(TEL, _HOUR_TRIPS)
    + """SELECT node_name, trip_id, time, value FROM t
    UNION ALL SELECT node_name, trip_id, min(time) - INTERVAL 1 SECOND, NULL FROM t GROUP BY ALL
    UNION ALL SELECT node_name, trip_id, max(time) + INTERVAL 1 SECOND, NULL FROM t GROUP BY ALL""",
)
def w14(spark, folder):
    rows = hour_trips(spark, folder).select("node_name", "trip_id", "time", "value")
    return trips.break_markers(rows, keys=["node_name", "trip_id"])


_NUMBERED = """, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY node_name, trip_id ORDER BY time, event_id) AS row_no,
         count(*) OVER (PARTITION BY node_name, trip_id) AS total FROM t)"""


@query(
    "w15_trim",
    with_(TEL, _HOUR_TRIPS) + _NUMBERED
    + " SELECT event_id, node_name, trip_id, row_no FROM numbered WHERE row_no <= total - total % 5",
)
def w15(spark, folder):
    kept = sequences.trim_to_multiple(
        hour_trips(spark, folder), 5, keys=["node_name", "trip_id"], ts="time", tie=TIE
    )
    return kept.select("event_id", "node_name", "trip_id", "row_no")


def _sequence_rows(spark, folder, rows, whole_only):
    return sequences.to_sequences(
        hour_trips(spark, folder),
        rows,
        ["value"],
        keys=["node_name", "trip_id"],
        ts="time",
        tie=TIE,
        carry=TIE,
        whole_only=whole_only,
    )


_SEQ_SQL = """SELECT node_name, trip_id, CAST((row_no - 1) // {n} AS BIGINT) AS seq_id, CAST(count(*) AS INTEGER) AS length,
      round(arg_min(value, row_no) + 3.1e-8, 6) + 0e0 AS first_value, round(arg_max(value, row_no) + 3.1e-8, 6) + 0e0 AS last_value
    FROM numbered {where} GROUP BY ALL"""


def _sequence_ends(found):
    return rounded(
        found.select(
            "node_name",
            "trip_id",
            "seq_id",
            "length",
            F.col("seq")[0][0].alias("first_value"),
            F.element_at("seq", -1)[0].alias("last_value"),
        ),
        "first_value",
        "last_value",
    )


@query(
    "w16_whole_windows",
    with_(TEL, _HOUR_TRIPS) + _NUMBERED + _SEQ_SQL.format(n=4, where="WHERE row_no <= total - total % 4"),
)
def w16(spark, folder):
    return _sequence_ends(_sequence_rows(spark, folder, 4, True))


@query("w17_chunks", with_(TEL, _HOUR_TRIPS) + _NUMBERED + _SEQ_SQL.format(n=5, where=""))
def w17(spark, folder):
    return _sequence_ends(_sequence_rows(spark, folder, 5, False))


@query(
    "w18_padding",
    with_(TEL, _HOUR_TRIPS) + _NUMBERED
    + """, chunks AS (SELECT node_name, trip_id, (row_no - 1) // 5 AS seq_id, count(*) AS n, sum(value) AS total FROM numbered GROUP BY ALL)
    SELECT node_name, trip_id, CAST(seq_id AS BIGINT) AS seq_id, CAST(max(n) OVER () AS INTEGER) AS padded,
      round(total - (max(n) OVER () - n) + 3.1e-8, 6) + 0e0 AS total FROM chunks""",
)
def w18(spark, folder):
    padded = sequences.pad_sequences(_sequence_rows(spark, folder, 5, False), width=1)
    total = F.aggregate("seq", F.lit(0.0), lambda acc, x: acc + x[0])
    return rounded(
        padded.select("node_name", "trip_id", "seq_id", F.size("seq").alias("padded"), total.alias("total")),
        "total",
    )


@query(
    "w19_flatten",
    with_(TEL, _HOUR_TRIPS) + _NUMBERED + " SELECT event_id, node_name, trip_id, row_no, value FROM numbered",
)
def w19(spark, folder):
    """Padded and flattened again: the input comes back."""
    padded = sequences.pad_sequences(_sequence_rows(spark, folder, 5, False), length=5, width=1)
    flat = sequences.flatten_sequences(padded, ["value"], keys=["node_name", "trip_id"])
    return flat.select("event_id", "node_name", "trip_id", "row_no", "value")


@query(
    "w20_window_trip",
    with_(TEL, _HOUR_TRIPS) + _NUMBERED
    + """ SELECT node_name, CAST((row_no - 1) // 4 AS BIGINT) AS seq_id, trip_id, trip_id AS first_trip
    FROM numbered WHERE row_no <= total - total % 4 GROUP BY ALL""",
)
def w20(spark, folder):
    return scoring.window_trips(
        hour_trips(spark, folder), 4, trip="trip_id", keys=["node_name", "trip_id"], ts="time"
    )


# --- scalar functions --------------------------------------------------------------------


@query(
    "f01_clean_alias",
    "SELECT p_partkey, regexp_replace(replace(lower(p_brand || '_' || p_type), '_', ''), '[0-9]', '', 'g') AS clean FROM part",
)
def f01(spark, folder):
    part = events.table(spark, folder, "part")
    return part.select("p_partkey", text.clean_alias(F.concat_ws("_", "p_brand", "p_type")).alias("clean"))


@query(
    "f02_fuzzy_alias",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'ENGINE_LOAD' WHEN 'view' THEN 'FUELRATE'
      WHEN 'purchase' THEN 'ENGOILPRES' WHEN 'error' THEN 'zzz' ELSE 'SOG' END AS alias FROM events""",
)
def f02(spark, folder):
    """Misspelt names by event type, resolved by similarity over the distinct names."""
    spelt = {"click": "Engine_Lod_1", "view": "FUELRATES", "purchase": "ENG_OIL_PRES2", "error": "zzz", "signup": "S_O_G"}
    names = F.create_map(*(F.lit(x) for pair in spelt.items() for x in pair))
    rows = events.table(spark, folder, "events").select("event_id", names[F.col("event_type")].alias("alias"))
    return reshape.resolve_aliases(rows, alias="alias")


@query(
    "f03_strip_prefix",
    "SELECT o_orderkey, regexp_replace(regexp_replace(replace(o_orderpriority, '-', '_'), '^[^_]*_', ''), '^[^_]*_', '') AS name FROM orders",
)
def f03(spark, folder):
    dashed = F.replace("o_orderpriority", F.lit("-"), F.lit("_"))
    return frames.orders(spark, folder).select("o_orderkey", text.strip_prefix(dashed).alias("name"))


@query(
    "f04_parse_time",
    """SELECT event_id, ts AS parsed, CASE WHEN event_id % 5 > 0 THEN ts END AS partly,
      date_trunc('second', ts) AS combined, strftime(ts, '%Y-%m-%d') AS day FROM events""",
)
def f04(spark, folder):
    e = events.table(spark, folder, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    day, clock = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")
    partly = F.when(F.pmod("event_id", F.lit(5)) > 0, iso).otherwise(F.lit("not a time"))
    mixed = F.when(F.pmod("event_id", F.lit(2)) == 0, day).otherwise(F.concat(day, F.lit(" 00:00:00")))
    return e.select(
        "event_id",
        tm.parse_timestamp(iso).alias("parsed"),
        tm.parse_timestamp(partly).alias("partly"),
        tm.combine(day, clock).alias("combined"),
        tm.normalise_date(mixed).alias("day"),
    )


@query(
    "f05_date_and_time",
    "SELECT event_id, CAST(ts AS DATE) AS date, strftime(ts, '%H:%M:%S') AS time FROM events",
)
def f05(spark, folder):
    e = events.table(spark, folder, "events")
    return e.select("event_id", tm.date_of("ts").alias("date"), tm.time_of_day("ts").alias("time"))


@query(
    "f06_round_time",
    f"SELECT event_id, {bucket('ts', 10)} AS ten, {bucket('ts', 1)} AS one, {bucket('ts', 3600)} AS hour FROM events",
)
def f06(spark, folder):
    e = events.table(spark, folder, "events")
    return e.select(
        "event_id",
        tm.round_time("ts", 10).alias("ten"),
        tm.round_time("ts", 1).alias("one"),
        tm.round_time("ts", 3600).alias("hour"),
    )


@query(
    "f07_hours",
    "SELECT event_id, date_trunc('hour', ts) AS hour, date_trunc('hour', ts) - INTERVAL 1 HOUR AS previous FROM events",
)
def f07(spark, folder):
    e = events.table(spark, folder, "events")
    return e.select("event_id", tm.hour_of("ts").alias("hour"), tm.previous_hour("ts").alias("previous"))


@query(
    "f08_intervals",
    f"""SELECT event_id, ts + INTERVAL 10 MINUTE AS later, {s6("(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 60e6", "minutes")},
      {s6("(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6", "seconds")} FROM events""",
)
def f08(spark, folder):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    out = events.table(spark, folder, "events").select(
        "event_id",
        tm.shift("ts", 600).alias("later"),
        tm.minutes_between(start, "ts").alias("minutes"),
        tm.seconds_between(start, "ts").alias("seconds"),
    )
    return rounded(out, "minutes", "seconds")


@query(
    "f09_seconds_of_day",
    "SELECT event_id, CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS seconds FROM events",
)
def f09(spark, folder):
    e = events.table(spark, folder, "events")
    return e.select("event_id", tm.seconds_of_day(tm.time_of_day("ts")).alias("seconds"))


@query(
    "f10_date_slices",
    """WITH b AS (SELECT date_trunc('day', min(o_orderdate)) AS a, date_trunc('day', max(o_orderdate)) AS z FROM orders),
    s AS (SELECT i AS slice_no, a + i * INTERVAL 13 DAY AS slice_start, least(a + (i + 1) * INTERVAL 13 DAY, z) AS slice_stop
      FROM b, unnest(generate_series(0, CAST(ceil(date_diff('day', a, z) / 13e0) AS BIGINT) - 1)) t(i))
    SELECT slice_no, slice_start, slice_stop, (SELECT count(*) FROM orders
      WHERE o_orderdate >= slice_start AND (o_orderdate < slice_stop OR o_orderdate = (SELECT z FROM b) AND slice_stop = (SELECT z FROM b))) AS orders
    FROM s""",
)
def f10(spark, folder):
    """Slices of 13 days over the table's range, and the rows in each."""
    rows = frames.orders(spark, folder).select("o_orderdate")
    bounds = rows.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("z"))
    slices = tm.date_slices(bounds, "a", "z", 13)
    first = bounds.select("a").scalar()
    last = bounds.select("z").scalar()
    placed = (
        rows.withColumns({"_a": first, "_z": last})
        .groupBy(tm.slice_number("o_orderdate", "_a", "_z", 13).alias("slice_no"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    out = slices.join(placed, "slice_no", "left").na.fill(0, subset=["orders"])
    return out.withColumn("slice_no", F.col("slice_no").cast("bigint"))


@query(
    "f11_alignment",
    """SELECT event_id, round(CASE WHEN d > 180 THEN d - 360 WHEN d < -180 THEN d + 360 ELSE d END / 180 + 3.1e-8, 6) + 0e0 AS factor
    FROM (SELECT event_id, ((user_id * 37) % 360) - (value % 360) AS d FROM events)""",
)
def f11(spark, folder):
    wind = F.pmod(F.col("user_id") * 37, F.lit(360)).cast("double")
    e = events.table(spark, folder, "events")
    return rounded(e.select("event_id", G.alignment_factor("value", wind).alias("factor")), "factor")


@query("f12_cosine", f"SELECT event_id, {s6('cos(radians(value))', 'course')} FROM events")
def f12(spark, folder):
    e = events.table(spark, folder, "events")
    return rounded(e.select("event_id", G.cos_degrees("value").alias("course")), "course")


@query(
    "f13_scaling",
    f"""WITH s AS (SELECT min(value) AS a, max(value) AS z, avg(value) AS m, stddev_pop(value) AS d FROM events)
    SELECT event_id, {s6('(value - a) / (z - a)', 'scaled')}, {s6('(value - m) / d', 'z')} FROM events, s""",
)
def f13(spark, folder):
    rows = events.table(spark, folder, "events").select("event_id", "value")
    z = features.z_scores(rows, ["value"])
    scaled = features.apply_min_max(z, features.fit_min_max(rows, ["value"]), ["value"])
    return rounded(
        scaled.select("event_id", F.col("value").alias("scaled"), F.col("value_z").alias("z")), "scaled", "z"
    )


@query(
    "f14_residuals",
    f"SELECT event_id, {s6('(value - 100) * (value - 100)', 'squared')}, {s6('abs(value - 100)', 'absolute')} FROM events",
)
def f14(spark, folder):
    e = events.table(spark, folder, "events")
    out = e.select(
        "event_id",
        V.squared_residual("value", F.lit(100.0)).alias("squared"),
        V.absolute_residual("value", F.lit(100.0)).alias("absolute"),
    )
    return rounded(out, "squared", "absolute")


_OUT = ("l_quantity", "l_extendedprice")


@query(
    "f15_outliers_two_sided",
    "WITH s AS (SELECT "
    + ", ".join(f"avg({f}) AS {f}_m, stddev_pop({f}) AS {f}_d" for f in _OUT)
    + " FROM lineitem) SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem, s WHERE "
    + " AND ".join(f"abs((CAST({f} AS DOUBLE) - {f}_m) / {f}_d) < 1.5e0" for f in _OUT),
)
def f15(spark, folder):
    rows = frames.lineitem(spark, folder).select("l_orderkey", "l_linenumber", *_OUT)
    return features.drop_outliers(rows, _OUT, threshold=1.5)


@query(
    "f16_outliers_one_sided",
    """WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS d FROM events)
    SELECT event_id, value FROM events, s WHERE (value - m) / d < 3""",
)
def f16(spark, folder):
    rows = events.table(spark, folder, "events").select("event_id", "value")
    return features.drop_outliers(rows, ["value"], two_sided=False)


_LEGS = """legs AS (SELECT event_id, lat, lon, 55e0 + 0.01e0 * (event_id % 500) AS lat2, 12e0 + 0.01e0 * (event_id % 300) AS lon2 FROM pos)"""


def _legs(spark, folder):
    return events.positions(spark, folder).select(
        "event_id",
        F.col("value_latitude").alias("lat"),
        F.col("value_longitude").alias("lon"),
        (F.lit(55.0) + F.lit(0.01) * F.pmod("event_id", F.lit(500))).alias("lat2"),
        (F.lit(12.0) + F.lit(0.01) * F.pmod("event_id", F.lit(300))).alias("lon2"),
    )


@query(
    "f17_haversine",
    with_(GPS, _LEGS) + f"SELECT event_id, {s6(hav('lat', 'lon', 'lat2', 'lon2'), 'nm')} FROM legs",
)
def f17(spark, folder):
    legs = _legs(spark, folder)
    return rounded(legs.select("event_id", G.haversine_nm("lat", "lon", "lat2", "lon2").alias("nm")), "nm")


@query(
    "f17_ellipsoidal",
    with_(GPS, _LEGS, ellipsoid("far", "lat", "lon", "lat2", "lon2", "legs")) + "SELECT event_id, round(enm + 3.1e-5, 3) + 0e0 AS nm FROM far",
)
def f17_ellipsoidal(spark, folder):
    """Geodesics on the ellipsoid, by quadrature; the SQL has Vincenty's iteration, whose series ends at a tenth of a millimetre."""
    legs = _legs(spark, folder)
    nm = G.ellipsoidal_nm("lat", "lon", "lat2", "lon2")
    return legs.select("event_id", (F.round(nm + F.lit(3.1e-5), 3) + F.lit(0.0)).alias("nm"))


_CELLS = f"cells AS ({hex_sql('lat', 'lon', 'pos')})"


@query("f18_hex_cell", with_(GPS, _CELLS) + "SELECT event_id, cell FROM cells")
def f18(spark, folder):
    p = events.positions(spark, folder)
    return p.select("event_id", G.hex_cell("value_latitude", "value_longitude").alias("cell"))


@query(
    "f19_hex_boundary",
    with_(GPS, _CELLS)
    + f"""SELECT cell, CAST(i AS INTEGER) AS corner, {s6('0.9e0 * r + 0.6e0 * sin(radians(60e0 * i - 30))', 'lat')},
      {s6('(0.6e0 * sqrt(3e0) * (q + r / 2) + 0.6e0 * cos(radians(60e0 * i - 30))) / cos(radians(60e0))', 'lon')}, n_rows
    FROM (SELECT cell, count(*) AS n_rows, CAST(split_part(cell, ':', 1) AS DOUBLE) AS q, CAST(split_part(cell, ':', 2) AS DOUBLE) AS r
          FROM cells GROUP BY cell), generate_series(0, 5) t(i)""",
)
def f19(spark, folder):
    p = events.positions(spark, folder).select(G.hex_cell("value_latitude", "value_longitude").alias("cell"))
    counts = p.groupBy("cell").agg(F.count(F.lit(1)).alias("n_rows"))
    corners = counts.select("cell", "n_rows", F.posexplode(G.hex_boundary("cell")).alias("corner", "p"))
    out = corners.select("cell", "corner", F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon"), "n_rows")
    return rounded(out, "lat", "lon")


@query(
    "f21_round2",
    "SELECT o_orderkey, round(o_totalprice / 7, 2) + 0e0 AS price FROM orders",
)
def f21(spark, folder):
    return frames.orders(spark, folder).select(
        "o_orderkey", (F.round(F.col("o_totalprice") / 7, 2) + F.lit(0.0)).alias("price")
    )
