"""Schemas, feature lists and default parameters."""

from __future__ import annotations

from pyspark.sql import types as T

TELEMETRY = T.StructType(
    [
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("node_id", T.StringType()),
        T.StructField("node_name", T.StringType()),
        T.StructField("signal_name_alias", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("signal_instance", T.StringType()),
    ]
)

# Signal names as they appear in vessel telemetry.
ENGINE_SIGNALS = ("RPM", "FUELRATE", "ENGINE_LOAD", "ENGTEMP", "ENGOILPRES", "ENG_HOURS")
GEO_SIGNALS = ("LAT", "LON", "SOG", "COG")
GPS_SIGNALS = ("LAT", "LON", "SOG", "COG", "RPM", "CELL")
SIGNALS = ENGINE_SIGNALS + GEO_SIGNALS
EVENT_FLAGS = (
    "E_CHECKENG",
    "E_HIGHBOOS",
    "E_LOWCOOLA",
    "E_LOWFUELP",
    "E_LOWOILLE",
    "E_LOWOILPR",
    "E_LOWSYSTE",
    "E_OVERTEMP",
)
ERROR_FEATURES = ("RPM", "FUELRATE", "ENGINE_LOAD", "ENGTEMP", "ENGOILPRES")
SCALED_FEATURES = ERROR_FEATURES + ("wind_velocity", "alignment_factor")

# Default thresholds.
RESAMPLE_STEP_SECONDS = 10
DISCOVERY_GAP_SECONDS = 20 * 60
DISCOVERY_PADDING_SECONDS = 10 * 60
TRIP_GAP_SECONDS = 30 * 60
COMPARISON_GAP_SECONDS = 10 * 60
GPS_GAP_SECONDS = 5 * 60
MIN_TRIP_MINUTES = 10
WEATHER_TOLERANCE_SECONDS = 30 * 60
ACTIVITY_REACH_SECONDS = 10 * 60
FUZZY_CUTOFF = 0.6
Z_THRESHOLD = 3.0
SPLIT_DATE = "2024-06-01"
SEQUENCE_ROWS = 30
GPS_WINDOW_ROWS = 60
GPS_SCORE_THRESHOLD = 0.994
SENTINELS = (80.00861904, 8191.875)
SCAN_SLICE_DAYS = 13
PAD_VALUE = -1.0

DAY_SECONDS = 24 * 60 * 60
