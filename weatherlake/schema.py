"""Observation schema, keys and indicator lists.

The typed observation is one METAR report: a station, the five time parts, a
position and 20 numeric plus 5 text indicators.  Both stored layouts hold the
same 34 columns; only their physical organisation differs (see
``weatherlake.sources.layouts``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the source data's conventions for results
# to match; they are stated once, here, in their natural order.
# ---------------------------------------------------------------------------

# Tokens that stand for a missing cell in the raw CSV (besides an empty cell).
NULL_TOKENS = ("null", "\t")

# Prefix pattern of the ``valid`` timestamp: year-month-day hour:minute.
# Anything after the minute (seconds, zone) is accepted and ignored; parts are
# not range checked.
VALID_PATTERN = r"^(\d+)-(\d+)-(\d+) (\d+):(\d+)"

TIME_PARTS = ("year", "month", "day", "hour", "minute")

# Column order of the stored tables.
OBS_COLUMNS = (
    "station", "year", "month", "day", "hour", "minute", "lon", "lat",
    "tmpf", "dwpf", "relh", "drct", "sknt", "p01i", "alti", "mslp", "vsby", "gust",
    "skyc1", "skyc2", "skyc3", "skyc4", "skyl1", "skyl2", "skyl3", "skyl4",
    "wxcodes", "ice_accretion_1hr", "ice_accretion_3hr", "ice_accretion_6hr",
    "peak_wind_gust", "peak_wind_drct", "peak_wind_time", "feel",
)

# The indicators that are text.
TEXT_INDICATORS = ("skyc1", "skyc2", "skyc3", "skyc4", "wxcodes")

# Indicators drawn by the batch snapshot, in the order of the original batch
# list ("alti" appears twice there; 26 distinct names).
SNAPSHOT_BATCH_INDICATORS = (
    "alti", "tmpf", "dwpf", "relh", "drct", "sknt", "p01i", "alti", "mslp", "vsby",
    "gust", "skyc1", "skyc2", "skyc3", "skyc4", "skyl1", "skyl2", "skyl3", "skyl4",
    "wxcodes", "feel", "ice_accretion_1hr", "ice_accretion_3hr", "ice_accretion_6hr",
    "peak_wind_gust", "peak_wind_drct", "peak_wind_time",
)

# The four k-means features, in feature order.
KMEANS_FEATURES = ("tmpf", "alti", "relh", "sknt")

# Temperature-like indicators, in degrees Fahrenheit.
FAHRENHEIT_INDICATORS = ("tmpf", "dwpf", "feel")

# ---------------------------------------------------------------------------
# Derived schema
# ---------------------------------------------------------------------------

NUMERIC_INDICATORS = tuple(c for c in OBS_COLUMNS
                           if c not in ("station", "lon", "lat", "peak_wind_time") + TIME_PARTS + TEXT_INDICATORS)


def _spark_type(name: str) -> T.DataType:
    if name in ("station",) + TEXT_INDICATORS:
        return T.StringType()
    if name in TIME_PARTS:
        return T.IntegerType()
    if name == "peak_wind_time":
        return T.TimestampType()
    return T.FloatType()


OBS_SCHEMA = T.StructType([T.StructField(c, _spark_type(c), True) for c in OBS_COLUMNS])

# Raw CSV columns: everything as text, ``valid`` instead of the time parts.
# A ``metar`` column (the raw report text) may also be present.
RAW_COLUMNS = ("station", "valid") + tuple(c for c in OBS_COLUMNS if c not in ("station",) + TIME_PARTS)

# Keys.  The by-position layout is keyed by position then time; the by-date
# layout by time.  The date key without a position lets stations reporting in
# the same minute overwrite each other, so our default date key adds it.
KEY_POSITION = ("lat", "lon") + TIME_PARTS
KEY_DATE_BARE = TIME_PARTS
KEY_DATE = TIME_PARTS + ("lat", "lon")

assert len(OBS_COLUMNS) == 34
assert len(set(NUMERIC_INDICATORS)) == 20 and len(set(SNAPSHOT_BATCH_INDICATORS)) == 26


def is_numeric_indicator(name: str) -> bool:
    return name in NUMERIC_INDICATORS


def is_text_indicator(name: str) -> bool:
    return name in TEXT_INDICATORS
