"""Registered scan and snapshot queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weatherlake.operators import snapshot
from weatherlake import schema
from weatherlake.plans.catalog import register, with_o
from weatherlake.sources import fixtures as fx
from weatherlake.sources import scan

Y, M, D = fx.SNAPSHOT_DATE
IDS = "station, lat, lon, year, month, day, hour, minute"


@register("snapshot", with_o(f"""
SELECT {IDS}, round_even(CAST(relh AS DOUBLE), 2) AS value
FROM O WHERE year = {Y} AND month = {M} AND day = {D} AND relh IS NOT NULL"""))
def q_snapshot(spark, sf_dir):
    return snapshot.snapshot(fx.observations(spark, sf_dir), "relh", Y, M, D)


@register("snapshot_minute", with_o(f"""
SELECT {IDS}, round_even(CAST(tmpf AS DOUBLE), 2) AS value
FROM O WHERE year = {Y} AND month = {M} AND day = {D} AND hour = 4 AND minute = 26 AND tmpf IS NOT NULL"""))
def q_snapshot_minute(spark, sf_dir):
    return snapshot.snapshot(fx.observations(spark, sf_dir), "tmpf", Y, M, D, 4, 26)


@register("snapshot_all", with_o("\nUNION ALL\n".join(
    f"SELECT {IDS}, '{c}' AS indicator, round_even(CAST({c} AS DOUBLE), 2) AS value "
    f"FROM O WHERE year = {Y} AND month = {M} AND day = {D} AND {c} IS NOT NULL"
    for c in schema.NUMERIC_INDICATORS)))
def q_snapshot_all(spark, sf_dir):
    return snapshot.snapshot_all(fx.observations(spark, sf_dir), Y, M, D)


@register("snapshot_all_text", with_o("\nUNION ALL\n".join(
    f"SELECT {IDS}, '{c}' AS indicator, {c} AS value FROM O WHERE year = {Y} AND month = {M} AND day = {D} AND {c} IS NOT NULL"
    for c in schema.TEXT_INDICATORS)))
def q_snapshot_all_text(spark, sf_dir):
    return snapshot.snapshot_all_text(fx.observations(spark, sf_dir), Y, M, D)


@register("by_day_range", with_o("""
SELECT station, year, month, day, hour, minute, lat, lon, tmpf, alti, relh, sknt
FROM O WHERE year = 1998 AND month = 9 AND day >= 1 AND day <= 15"""))
def q_by_day_range(spark, sf_dir):
    return scan.by_day_range(fx.observations(spark, sf_dir), 1998, 9, 1, 15,
                             ["station", "year", "month", "day", "hour", "minute", "lat", "lon",
                              "tmpf", "alti", "relh", "sknt"])


@register("by_month", with_o("""
SELECT station, day, hour, minute, lat, lon, relh
FROM O WHERE year = 1997 AND month = 2"""))
def q_by_month(spark, sf_dir):
    return scan.by_month(fx.observations(spark, sf_dir), 1997, 2,
                         ["station", "day", "hour", "minute", "lat", "lon", "relh"])


@register("at_minute", with_o("""
SELECT station, year, month, day, hour, minute, lat, lon, tmpf, alti, relh, sknt
FROM O WHERE year = 1996 AND month = 5 AND hour = 2 AND minute = 30"""))
def q_at_minute(spark, sf_dir):
    return scan.at_minute(fx.observations(spark, sf_dir), 1996, 5, None, 2, 30,
                          ["station", "year", "month", "day", "hour", "minute", "lat", "lon",
                           "tmpf", "alti", "relh", "sknt"])


@register("by_position", with_o(f"""
SELECT year, month, sknt FROM O
WHERE lat = CAST({fx.PROBE_LAT} AS FLOAT) AND lon = CAST({fx.PROBE_LON} AS FLOAT)"""))
def q_by_position(spark, sf_dir):
    return scan.by_position(fx.observations(spark, sf_dir), fx.PROBE_LAT, fx.PROBE_LON, "sknt")
