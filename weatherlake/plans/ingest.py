"""Registered ingest and upsert queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weatherlake import schema
from weatherlake.operators import upsert
from weatherlake.plans.catalog import register, with_o
from weatherlake.sources import fixtures as fx
from weatherlake.sources.metar_csv import metar_rejects, parse_metar

OBS_COLS = ("station", "year", "month", "day", "hour", "minute", "lat", "lon", "tmpf", "alti", "relh", "sknt")
ORDER_DESC = ", ".join(f"{c} DESC" for c in fx.OBS_ORDER)
ORDER_ROW = "(" + ", ".join(fx.OBS_ORDER) + ")"
ALL_O = ", ".join(OBS_COLS + ("l_orderkey", "l_partkey", "l_linenumber", "seq"))


# every stored column; the timestamp as text, which both engines write alike
FULL = tuple(c for c in schema.OBS_COLUMNS if c != "peak_wind_time")
FULL_SQL = ", ".join(FULL) + ", strftime(peak_wind_time, '%Y-%m-%d %H:%M:%S') AS peak_wind_time"


def _full(df, *more):
    return df.select(*FULL, F.date_format("peak_wind_time", "yyyy-MM-dd HH:mm:ss").alias("peak_wind_time"), *more)


@register("parse_metar", with_o(f"""
SELECT {FULL_SQL}, l_orderkey
FROM O WHERE l_orderkey % 17 <> 0"""))
def q_parse_metar(spark, sf_dir):
    raw = fx.raw_observations(spark, sf_dir)
    return _full(parse_metar(raw, strict=True, keep=("l_orderkey",)), "l_orderkey")


@register("parse_metar_lenient", with_o(f"""
SELECT {FULL_SQL.replace("tmpf,", "CASE WHEN l_orderkey % 7 > 1 THEN tmpf END AS tmpf,")}, l_orderkey
FROM O WHERE l_orderkey % 17 <> 0 AND l_orderkey % 13 <> 0 AND l_orderkey % 19 <> 0"""))
def q_parse_metar_lenient(spark, sf_dir):
    raw = fx.lenient_observations(spark, sf_dir)
    return _full(parse_metar(raw, strict=False, keep=("l_orderkey",)), "l_orderkey")


@register("parse_rejects", with_o("""
SELECT station, 'bad' AS valid, 'bad timestamp' AS reject_reason, l_orderkey
FROM O WHERE l_orderkey % 17 = 0"""))
def q_parse_rejects(spark, sf_dir):
    raw = fx.raw_observations(spark, sf_dir)
    return metar_rejects(raw).select("station", "valid", "reject_reason", "l_orderkey")


@register("parse_rejects_lenient", with_o("""
SELECT station, CASE WHEN l_orderkey % 17 = 0 OR l_orderkey % 19 = 0 THEN 'bad timestamp' ELSE 'null position' END AS reject_reason,
       l_orderkey
FROM O WHERE l_orderkey % 17 = 0 OR l_orderkey % 13 = 0 OR l_orderkey % 19 = 0"""))
def q_parse_rejects_lenient(spark, sf_dir):
    raw = fx.lenient_observations(spark, sf_dir)
    return metar_rejects(raw, strict=False).select("station", "reject_reason", "l_orderkey")


@register("valid_struct", with_o(f"""
SELECT {FULL_SQL}, metar, l_orderkey
FROM O WHERE l_orderkey % 17 <> 0"""))
def q_valid_struct(spark, sf_dir):
    raw = fx.raw_observations(spark, sf_dir)
    p = parse_metar(raw, strict=True, valid_struct=True, keep=("l_orderkey",))
    return _full(p.select("*", "valid.*"), "metar", "l_orderkey")


@register("upsert_by_date", with_o(f"""
SELECT {ALL_O} FROM (
  SELECT *, row_number() OVER (PARTITION BY year, month, day, hour, minute ORDER BY {ORDER_DESC}) AS rn
  FROM O) t
WHERE rn = 1"""))
def q_upsert_by_date(spark, sf_dir):
    obs = fx.observations(spark, sf_dir).select(*ALL_O.split(", "))
    return upsert.upsert_last(obs, schema.KEY_DATE_BARE, fx.OBS_ORDER)


@register("upsert_by_position", with_o(f"""
SELECT {ALL_O} FROM (
  SELECT *, row_number() OVER (PARTITION BY lat, lon, year, month, day, hour, minute ORDER BY {ORDER_DESC}) AS rn
  FROM O) t
WHERE rn = 1"""))
def q_upsert_by_position(spark, sf_dir):
    obs = fx.observations(spark, sf_dir).select(*ALL_O.split(", "))
    return upsert.upsert_last(obs, schema.KEY_POSITION, fx.OBS_ORDER)


PARTIAL_COLS = ("station", "lat", "lon", "tmpf", "alti", "relh", "sknt")


@register("upsert_partial", with_o(f"""
SELECT year, month, day, hour, minute,
  {", ".join(f"arg_max({c}, {ORDER_ROW}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in PARTIAL_COLS)}
FROM O GROUP BY year, month, day, hour, minute"""))
def q_upsert_partial(spark, sf_dir):
    obs = fx.observations(spark, sf_dir)
    cols = list(schema.TIME_PARTS) + list(PARTIAL_COLS)
    extra = [c for c in fx.OBS_ORDER if c not in cols]
    out = upsert.upsert_partial(obs.select(*cols, *extra), schema.KEY_DATE_BARE, fx.OBS_ORDER)
    return out.select(*cols)


@register("rows_sent_vs_kept", with_o("""
SELECT count(*) AS rows_sent,
       (SELECT count(*) FROM (SELECT DISTINCT year, month, day, hour, minute FROM O) d) AS rows_kept
FROM O"""))
def q_rows_sent_vs_kept(spark, sf_dir):
    return upsert.rows_sent_vs_kept(fx.observations(spark, sf_dir), schema.KEY_DATE_BARE)
