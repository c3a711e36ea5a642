"""Sources, sinks, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeline.functions import severity
from wakeline.functions import values as V
from wakeline.functions.timeops import col
from wakeline.operators import features, impute, trips
from wakeline.operators.weather import add_weather
from wakeline.registry import frames
from wakeline.registry.base import (
    ENGINE_CHAIN,
    GPS_LONG,
    NOT_SENTINEL,
    SIDE,
    TEL,
    WX,
    number_trips,
    query,
    rounded,
    s6,
    with_,
)
from wakeline.session import fresh_path
from wakeline.sources import events, files, scans, tables, weather

_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query(
    "s01_catalog",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _TABLES
    ),
)
def s01(spark, folder):
    """Row count of every table listed in the catalog."""
    prefix = "cat_"
    scans.register_tables(spark, {prefix + t: events.table(spark, folder, t) for t in _TABLES})
    listed = [t for t in scans.list_tables(spark) if t.startswith(prefix)]
    counts = [
        spark.table(t).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(t.removeprefix(prefix)).alias("table_name"), "n_rows"
        )
        for t in listed
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query(
    "s02_sample",
    with_(TEL) + "SELECT event_id, time, node_name, value FROM tel ORDER BY time, event_id LIMIT 2",
)
def s02(spark, folder):
    return scans.sample_table(
        frames.tel(spark, folder).select("event_id", "time", "node_name", "value"), 2, ["time", "event_id"]
    )


@query(
    "s03_range_scan",
    with_(TEL)
    + """SELECT event_id, time, node_name, signal_name_alias, value FROM tel
    WHERE time >= TIMESTAMP '2024-01-05 00:00:00' AND time <= TIMESTAMP '2024-01-20 00:00:00' AND value > 0""",
)
def s03(spark, folder):
    start, stop = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-05 00:00:00", "2024-01-20 00:00:00"))
    return scans.range_scan(frames.tel(spark, folder), start, stop).select(
        "event_id", "time", "node_name", "signal_name_alias", "value"
    )


@query(
    "s04_day_scan",
    with_(TEL)
    + """SELECT time, node_name, value, signal_instance FROM tel
    WHERE CAST(time AS DATE) = DATE '2024-01-10' AND node_name = 'boat-3' AND value > 0""",
)
def s04(spark, folder):
    return scans.day_scan(frames.tel(spark, folder), "2024-01-10", node="boat-3")


@query(
    "s05_gps_scan",
    with_(GPS_LONG)
    + f"SELECT event_id, time, node_id, node_name, signal_name_alias, value FROM gps_long WHERE {NOT_SENTINEL}",
)
def s05(spark, folder):
    return frames.gps_long(spark, folder).select(
        "event_id", "time", "node_id", "node_name", "signal_name_alias", "value"
    )


def _exported(spark, folder):
    """Telemetry written as CSV below the shared folder, one folder per event type."""
    path = fresh_path(spark, "csv")
    rows = frames.tel(spark, folder).select(
        F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time"),
        "node_id",
        "node_name",
        "signal_name_alias",
        "value",
        "signal_instance",
        F.col("signal_name_alias").alias("measurement"),
    )
    rows.write.option("header", True).partitionBy("measurement").csv(path)
    return path


_CSV_SQL = with_(TEL) + "SELECT time, node_id, node_name, signal_name_alias, value, signal_instance FROM tel"


@query("s06_csv_scan", _CSV_SQL)
def s06(spark, folder):
    return files.read_csv_folder(spark, _exported(spark, folder)).drop("file")


@query(
    "s07_csv_discovery",
    with_(TEL) + "SELECT signal_name_alias AS measurement, count(*) AS n_rows FROM tel GROUP BY 1",
)
def s07(spark, folder):
    """Files found below the export, told apart by the folder they lie in."""
    found = files.read_csv_folder(spark, _exported(spark, folder))
    measurement = F.regexp_extract("file", "measurement=([^/]+)/", 1).alias("measurement")
    return found.groupBy(measurement).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "s09_trip_files",
    with_(TEL, f"trips AS ({number_trips('tel', 1200)})")
    + "SELECT event_id, node_id, trip_id, signal_name_alias AS measurement, value FROM trips",
)
def s09(spark, folder):
    path = fresh_path(spark, "trip-files")
    numbered = trips.number_trips(frames.tel(spark, folder), gap_seconds=1200, tie=["event_id"])
    rows = numbered.withColumn("measurement", col("signal_name_alias"))
    stored = files.write_trip_files(
        rows.select("event_id", "time", "node_id", "trip_id", "measurement", "value"), path
    )
    return stored.drop("time")


@query(
    "s10_stage_table",
    with_(ENGINE_CHAIN) + f"SELECT node_name, signal_instance, ts, {s6('RPM', 'RPM')} FROM even",
)
def s10(spark, folder):
    stage = files.write_stage(frames.even(spark, folder), fresh_path(spark, "stage"))
    return rounded(stage.select("node_name", "signal_instance", "ts", "RPM"), "RPM")


_ERR_SQL = """err AS (
  SELECT node_name, CAST(time AS DATE) AS date,
         avg(value) FILTER (signal_name_alias = 'RPM') AS RPM,
         avg(value) FILTER (signal_name_alias = 'FUELRATE') AS FUELRATE,
         CAST(NULL AS DOUBLE) AS ENGINE_LOAD,
         avg(value) FILTER (signal_name_alias = 'ENGTEMP') AS ENGTEMP,
         CAST(NULL AS DOUBLE) AS ENGOILPRES
  FROM tel GROUP BY ALL)"""


def daily_values(spark, folder):
    """A daily table shaped like the error table."""
    from wakeline.operators.reshape import pivot_mean

    rows = frames.tel(spark, folder).withColumn("date", F.to_date("time"))
    return pivot_mean(rows, keys=["node_name", "date"], signals=tables.ERRORS.fieldNames()[2:])


@query(
    "s11_error_table",
    with_(TEL, _ERR_SQL)
    + f"SELECT node_name, date, {s6('RPM', 'RPM')}, {s6('FUELRATE', 'FUELRATE')}, {s6('ENGTEMP', 'ENGTEMP')} FROM err",
)
def s11(spark, folder):
    """Append twice; the key keeps the second append out."""
    path = fresh_path(spark, "errors")
    tables.make_error_table(spark, path)
    daily = daily_values(spark, folder)
    tables.append_errors(spark, path, daily.filter(F.dayofmonth("date") <= 15))
    tables.append_errors(spark, path, daily)
    stored = tables.read_error_table(spark, path)
    return rounded(
        stored.select("node_name", "date", "RPM", "FUELRATE", "ENGTEMP"), "RPM", "FUELRATE", "ENGTEMP"
    )


@query(
    "s12_all_errors",
    with_(TEL, _ERR_SQL)
    + f"""SELECT 'daily' AS grain, node_name, date, {s6('RPM', 'RPM')} FROM err
    UNION ALL SELECT 'full', node_name, CAST(time AS DATE), {s6('value', 'RPM')} FROM tel WHERE signal_name_alias = 'RPM'""",
)
def s12(spark, folder):
    full = frames.tel(spark, folder).filter("signal_name_alias = 'RPM'").select(
        "node_name", F.to_date("time").alias("date"), F.col("value").alias("RPM")
    )
    both = tables.read_all_errors(daily_values(spark, folder), full)
    return rounded(both.select("grain", "node_name", "date", "RPM"), "RPM")


@query(
    "s13_weather",
    with_(WX) + "SELECT node_name, date, wind_speed_10m, wind_direction_10m FROM wx",
)
def s13(spark, folder):
    return events.weather(spark, folder)


@query(
    "s13_weather_table",
    with_(TEL)
    + """, placed AS (SELECT node_name, time, value, unnest([date_trunc('hour', time), date_trunc('hour', time) + INTERVAL 1 HOUR]) AS date
      FROM tel WHERE signal_name_alias = 'SOG' AND value IS NOT NULL),
    near AS (SELECT *, abs(epoch_us(time) - epoch_us(date)) AS gap FROM placed)
    SELECT node_name, date, arg_min(value, (gap, -epoch_us(time), value)) AS wind_speed_10m,
      arg_min(value % 360, (gap, -epoch_us(time), value)) AS wind_direction_10m, min(gap) / 1e6 AS seconds_off
    FROM near WHERE gap <= 1800000000 GROUP BY ALL""",
)
def s13_table(spark, folder):
    """A weather table at odd times (the speed rows), written, read and brought to the nearest full hours."""
    path = fresh_path(spark, "weather")
    rows = events.telemetry(spark, folder).filter("signal_name_alias = 'SOG' and value is not null")
    rows.select(
        "node_name", F.col("time").alias("date"), F.col("value").alias("wind_speed_10m"),
        (F.col("value") % 360).alias("wind_direction_10m"),
    ).write.parquet(path)
    return weather.read_weather(spark, path)


@query(
    "s14_whole_text",
    "SELECT page_id // 50 AS bundle, CAST(sum(length(html) + 1) AS BIGINT) AS chars FROM pages GROUP BY 1",
)
def s14(spark, folder):
    """Pages bundled into text files, one line feed each, read back as whole texts."""
    path = fresh_path(spark, "texts")
    pages = events.table(spark, folder, "pages")
    bundled = pages.select(F.expr("page_id div 50").alias("bundle"), "html")
    bundled.repartition("bundle").write.partitionBy("bundle").text(path)
    found = files.read_texts(spark, path, pattern="*.txt")
    return found.groupBy(
        F.regexp_extract("path", "bundle=([0-9]+)/", 1).cast("bigint").alias("bundle")
    ).agg(F.sum(F.length("value")).alias("chars"))


# --- projections and filters -------------------------------------------------------------


@query(
    "p01_sentinels",
    with_(TEL) + f"SELECT event_id, value FROM tel WHERE {NOT_SENTINEL}",
)
def p01(spark, folder):
    return frames.tel(spark, folder).filter(V.no_sentinels("value")).select("event_id", "value")


@query(
    "p02_to_number",
    "SELECT event_id, TRY_CAST(replace(props, '{\"k\": ', '') AS DOUBLE) AS bad,"
    " TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE) AS good FROM events",
)
def p02(spark, folder):
    e = events.table(spark, folder, "events")
    return e.select(
        "event_id",
        V.to_number(F.replace("props", F.lit('{"k": '), F.lit(""))).alias("bad"),
        V.to_number(F.regexp_extract("props", r"(\d+)", 1)).alias("good"),
    )


@query(
    "p03_classify",
    with_(TEL)
    + """SELECT event_id, signal_name_alias, bool_and(signal_instance IS NULL) OVER (PARTITION BY signal_name_alias) AS is_geo
    FROM tel""",
)
def p03(spark, folder):
    rows = files.classify_files(frames.tel(spark, folder), group="signal_name_alias")
    return rows.select("event_id", "signal_name_alias", "is_geo")


@query("p04_side", with_(TEL) + f"SELECT event_id, {SIDE} AS side FROM tel")
def p04(spark, folder):
    return frames.tel(spark, folder).select("event_id", V.side_name("signal_instance").alias("side"))


@query(
    "p05_side_code",
    with_(TEL)
    + "SELECT event_id, CASE signal_instance WHEN '1' THEN 1 WHEN '0' THEN 0 END AS code FROM tel",
)
def p05(spark, folder):
    return frames.tel(spark, folder).select(
        "event_id", V.side_code(V.side_name("signal_instance")).alias("code")
    )


@query(
    "p06_binary_label",
    with_(TEL)
    + """SELECT event_id, signal_instance AS code, node_name AS vessel FROM tel""",
)
def p06(spark, folder):
    """Two sides get codes; vessels, being more than two, stay as they are."""
    sided = frames.tel(spark, folder).select(
        "event_id", V.side_name("signal_instance").alias("code"), col("node_name").alias("vessel")
    )
    return features.encode_binary(features.encode_binary(sided, "code"), "vessel")


@query(
    "p07_dropna",
    with_(ENGINE_CHAIN)
    + f"SELECT node_name, signal_instance, ts, {s6('RPM', 'RPM')}, {s6('FUELRATE', 'FUELRATE')} FROM even"
    + " WHERE RPM IS NOT NULL AND FUELRATE IS NOT NULL",
)
def p07(spark, folder):
    rows = frames.even(spark, folder).select("node_name", "signal_instance", "ts", "RPM", "FUELRATE")
    return rounded(rows.na.drop("any"), "RPM", "FUELRATE")


@query(
    "p08_constant_fill",
    with_(ENGINE_CHAIN)
    + f"SELECT node_name, signal_instance, ts, {s6('coalesce(RPM, 0)', 'RPM')}, {s6('coalesce(ENGTEMP, 0)', 'ENGTEMP')} FROM even",
)
def p08(spark, folder):
    rows = impute.fill_constants(frames.even(spark, folder), {"RPM": 0.0, "ENGTEMP": 0.0})
    return rounded(rows.select("node_name", "signal_instance", "ts", "RPM", "ENGTEMP"), "RPM", "ENGTEMP")


@query(
    "p09_event_flags",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 1e0 ELSE 0e0 END AS E_CHECKENG, 0e0 AS E_OVERTEMP FROM events""",
)
def p09(spark, folder):
    rows = events.table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.lit(1.0)).alias("E_CHECKENG")
    )
    return impute.fill_event_flags(rows).select("event_id", "E_CHECKENG", "E_OVERTEMP")


@query(
    "p10_unknown_side",
    with_(TEL) + "SELECT event_id, coalesce(signal_instance, 'unknown') AS signal_instance FROM tel",
)
def p10(spark, folder):
    return impute.fill_side(frames.tel(spark, folder)).select("event_id", "signal_instance")


@query(
    "p11_missing_columns",
    with_(ENGINE_CHAIN)
    + "SELECT node_name, signal_instance, ts, CAST(NULL AS DOUBLE) AS LAT, CAST(NULL AS DOUBLE) AS wind_velocity FROM even",
)
def p11(spark, folder):
    """No positions: the weather columns appear, empty."""
    rows = add_weather(frames.even(spark, folder), events.weather(spark, folder))
    return rows.select("node_name", "signal_instance", "ts", "LAT", "wind_velocity")


@query(
    "p12_running",
    with_(TEL)
    + "SELECT event_id, CASE WHEN signal_name_alias = 'RPM' AND value > 100 THEN 1 ELSE 0 END AS running FROM tel",
)
def p12(spark, folder):
    rpm = F.when(F.col("signal_name_alias") == "RPM", F.col("value") - 100)
    return frames.tel(spark, folder).select("event_id", V.is_running(rpm).alias("running"))


@query(
    "p13_date_split",
    """SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) <= DATE '1998-06-01' THEN 'train' ELSE 'test' END AS part
    FROM orders""",
)
def p13(spark, folder):
    rows = frames.orders(spark, folder).select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    train, test = features.split_by_date(rows, split="1998-06-01")
    return (
        train.withColumn("part", F.lit("train"))
        .unionByName(test.withColumn("part", F.lit("test")))
        .select("o_orderkey", "part")
    )


@query("p14_feature_order", "SELECT value, event_id, user_id FROM events")
def p14(spark, folder):
    e = events.table(spark, folder, "events")
    return features.select_features(e, ["value"], ["event_id", "user_id"])


@query(
    "p15_score_flag",
    "SELECT event_id, CAST(value / 500 >= 0.5e0 AS INTEGER) AS anomaly FROM events",
)
def p15(spark, folder):
    e = events.table(spark, folder, "events")
    return e.select("event_id", V.flag_score(F.col("value") / 500, 0.5).alias("anomaly"))


@query(
    "p16_severity",
    """SELECT event_id,
      CASE WHEN event_id % 4 > 1 THEN '#910606' WHEN event_id % 4 = 1 THEN '#FFFF00' ELSE '#086e1f' END AS dark,
      CASE WHEN event_id % 4 > 1 THEN '#FF0000' WHEN event_id % 4 = 1 THEN '#FFFF00' ELSE '#00FF00' END AS light
    FROM events""",
)
def p16(spark, folder):
    n = F.pmod(F.col("event_id"), F.lit(4))
    return events.table(spark, folder, "events").select(
        "event_id",
        severity.severity_colour(n).alias("dark"),
        severity.severity_colour(n, severity.LIGHT).alias("light"),
    )


@query(
    "p17_near_activity",
    with_(TEL)
    + """, marked AS (SELECT event_id, node_name, time, CASE WHEN value > 300 THEN epoch_us(time) END AS t, value - 300 AS value FROM tel)
    SELECT event_id, round(value + 3.1e-8, 6) + 0e0 AS value FROM (
      SELECT *, epoch_us(time) - last_value(t IGNORE NULLS) OVER (PARTITION BY node_name ORDER BY time, event_id
                  ROWS UNBOUNDED PRECEDING) AS back,
             first_value(t IGNORE NULLS) OVER (PARTITION BY node_name ORDER BY time, event_id
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - epoch_us(time) AS ahead FROM marked)
    WHERE back <= 600000000 OR ahead <= 600000000""",
)
def p17(spark, folder):
    rows = frames.tel(spark, folder).withColumn("value", F.col("value") - 300)
    kept = impute.near_activity(rows, tie=["event_id"])
    return rounded(kept.select("event_id", "value"), "value")


@query(
    "p18_binarise",
    "SELECT event_id, CASE WHEN value / 500 < 0.5e0 THEN 0 ELSE 1 END AS side FROM events",
)
def p18(spark, folder):
    e = events.table(spark, folder, "events")
    return e.select("event_id", V.binarise(F.col("value") / 500).alias("side"))


