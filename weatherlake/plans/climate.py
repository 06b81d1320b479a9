"""Registered climatology queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weatherlake.operators import climate
from weatherlake.plans.catalog import F2C, POS, r6, register, with_o
from weatherlake.sources import fixtures as fx

LAT, LON, YEAR = fx.PROBE_LAT, fx.PROBE_LON, fx.PROBE_YEAR


@register("seasonal_mean", with_o(f"""
SELECT month, count(*) AS n_obs,
       round({F2C.format(x='avg(CAST(tmpf AS DOUBLE))')}, 6) AS mean
FROM O WHERE {POS} AND tmpf IS NOT NULL
GROUP BY month"""))
def q_seasonal_mean(spark, sf_dir):
    obs = fx.observations(spark, sf_dir)
    return climate.seasonal_mean(obs, "tmpf", LAT, LON, to_celsius=True).select("month", "n_obs", r6("mean"))


@register("seasonal_mean_rounded", with_o(f"""
SELECT month, count(*) AS n_obs,
       round({F2C.format(x='avg(round_even(CAST(tmpf AS DOUBLE), 1))')}, 6) AS mean
FROM O WHERE {POS} AND tmpf IS NOT NULL
GROUP BY month"""))
def q_seasonal_mean_rounded(spark, sf_dir):
    obs = fx.observations(spark, sf_dir)
    return (climate.seasonal_mean(obs, "tmpf", LAT, LON, pre_round=1, to_celsius=True)
            .select("month", "n_obs", r6("mean")))


@register("seasonal_mean_all_positions", with_o("""
SELECT lat, lon, month, count(*) AS n_obs, round(avg(CAST(relh AS DOUBLE)), 6) AS mean
FROM O WHERE relh IS NOT NULL
GROUP BY lat, lon, month"""))
def q_seasonal_mean_all(spark, sf_dir):
    obs = fx.observations(spark, sf_dir)
    return climate.seasonal_mean(obs, "relh").select("lat", "lon", "month", "n_obs", r6("mean"))


@register("monthly_mean", with_o(f"""
SELECT year, month, count(*) AS n_obs,
       round({F2C.format(x='avg(round_even(CAST(tmpf AS DOUBLE), 1))')}, 6) AS mean
FROM O WHERE {POS} AND tmpf IS NOT NULL
GROUP BY year, month"""))
def q_monthly_mean(spark, sf_dir):
    obs = fx.observations(spark, sf_dir)
    return (climate.monthly_mean(obs, "tmpf", LAT, LON, pre_round=1, to_celsius=True)
            .select("year", "month", "n_obs", r6("mean")))


@register("historical_stats", with_o(f"""
SELECT year, month, count(*) AS n_obs,
       round(avg(CAST(tmpf AS DOUBLE)), 6) AS mean,
       round(stddev_pop(CAST(tmpf AS DOUBLE)), 6) AS std
FROM O WHERE {POS} AND tmpf IS NOT NULL
GROUP BY year, month"""))
def q_historical_stats(spark, sf_dir):
    obs = fx.observations(spark, sf_dir)
    return climate.historical_stats(obs, "tmpf", LAT, LON).select("year", "month", "n_obs", r6("mean"), r6("std"))


@register("historical_stats_all_positions", with_o("""
SELECT lat, lon, year, month, count(*) AS n_obs,
       round(avg(CAST(sknt AS DOUBLE)), 6) AS mean,
       round(stddev_pop(CAST(sknt AS DOUBLE)), 6) AS std
FROM O WHERE sknt IS NOT NULL
GROUP BY lat, lon, year, month"""))
def q_historical_stats_all(spark, sf_dir):
    obs = fx.observations(spark, sf_dir)
    return (climate.historical_stats(obs, "sknt")
            .select("lat", "lon", "year", "month", "n_obs", r6("mean"), r6("std")))


@register("yearly_series", with_o(f"""
, m AS (
  SELECT year, month,
         {F2C.format(x='avg(round_even(CAST(tmpf AS DOUBLE), 1))')} AS mean
  FROM O WHERE {POS} AND tmpf IS NOT NULL
  GROUP BY year, month)
SELECT year, count(*) AS n_months, min(month) AS first_month, max(month) AS last_month,
       round(sum(mean), 6) AS sum_value
FROM m GROUP BY year"""))
def q_yearly_series(spark, sf_dir):
    obs = fx.observations(spark, sf_dir)
    s = climate.yearly_series(obs, "tmpf", LAT, LON, pre_round=1, to_celsius=True)
    return s.select(
        "year",
        F.size("series").cast("long").alias("n_months"),
        F.col("series")[0]["month"].alias("first_month"),
        F.element_at("series", -1)["month"].alias("last_month"),
        F.round(F.aggregate("series", F.lit(0.0), lambda acc, e: acc + e["value"]), 6).alias("sum_value"),
    )


@register("year_vs_seasonal", with_o(f"""
SELECT month,
       count(CASE WHEN year <> {YEAR} THEN 1 END) AS others_n,
       round(avg(CASE WHEN year <> {YEAR} THEN CAST(tmpf AS DOUBLE) END), 6) AS others_mean,
       count(CASE WHEN year = {YEAR} THEN 1 END) AS year_n,
       round(avg(CASE WHEN year = {YEAR} THEN CAST(tmpf AS DOUBLE) END), 6) AS year_mean
FROM O WHERE {POS} AND tmpf IS NOT NULL
GROUP BY month"""))
def q_year_vs_seasonal(spark, sf_dir):
    obs = fx.observations(spark, sf_dir)
    return (climate.year_vs_seasonal(obs, "tmpf", YEAR, LAT, LON)
            .select("month", "others_n", r6("others_mean"), "year_n", r6("year_mean")))


@register("year_vs_seasonal_all_positions", with_o(f"""
SELECT lat, lon, month,
       count(CASE WHEN year <> {YEAR} THEN 1 END) AS others_n,
       round(avg(CASE WHEN year <> {YEAR} THEN CAST(alti AS DOUBLE) END), 6) AS others_mean,
       count(CASE WHEN year = {YEAR} THEN 1 END) AS year_n,
       round(avg(CASE WHEN year = {YEAR} THEN CAST(alti AS DOUBLE) END), 6) AS year_mean
FROM O WHERE alti IS NOT NULL
GROUP BY lat, lon, month"""))
def q_year_vs_seasonal_all(spark, sf_dir):
    obs = fx.observations(spark, sf_dir)
    return (climate.year_vs_seasonal(obs, "alti", YEAR)
            .select("lat", "lon", "month", "others_n", r6("others_mean"), "year_n", r6("year_mean")))


@register("seasonal_pair", with_o(f"""
SELECT month,
       count(tmpf) AS tmpf_n,
       round({F2C.format(x='avg(CAST(tmpf AS DOUBLE))')}, 6) AS tmpf_mean,
       count(relh) AS relh_n,
       round(avg(CAST(relh AS DOUBLE)), 6) AS relh_mean
FROM O WHERE {POS} AND (tmpf IS NOT NULL OR relh IS NOT NULL)
GROUP BY month"""))
def q_seasonal_pair(spark, sf_dir):
    obs = fx.observations(spark, sf_dir)
    return (climate.seasonal_pair(obs, "tmpf", "relh", LAT, LON)
            .select("month", "tmpf_n", r6("tmpf_mean"), "relh_n", r6("relh_mean")))


@register("year_vs_seasonal_series", with_o(f"""
SELECT month, 'Seasonal mean' AS series, round(avg(CAST(tmpf AS DOUBLE)), 6) AS value
FROM O WHERE {POS} AND tmpf IS NOT NULL AND year <> {YEAR}
GROUP BY month
UNION ALL
SELECT month, '{YEAR} values' AS series, round(avg(CAST(tmpf AS DOUBLE)), 6) AS value
FROM O WHERE {POS} AND tmpf IS NOT NULL AND year = {YEAR}
GROUP BY month"""))
def q_year_vs_seasonal_series(spark, sf_dir):
    obs = fx.observations(spark, sf_dir)
    return climate.year_vs_seasonal_series(obs, "tmpf", YEAR, LAT, LON).select("month", "series", r6("value"))


# The flagship flow end to end: snap a position to the station dictionary
# built from the observations, then compare one year with the others there.
SNAP_LON, SNAP_LAT, SNAP_EPS = 34.4, -11.9, 1e-3


@register("year_vs_seasonal_snapped", with_o(f"""
, d AS (
  SELECT station, round_even(CAST(lat AS DOUBLE), 4) AS lat, round_even(CAST(lon AS DOUBLE), 4) AS lon
  FROM (SELECT *, row_number() OVER (PARTITION BY lat, lon ORDER BY year, month, day, hour, minute, station) AS rn
        FROM O WHERE lat IS NOT NULL AND lon IS NOT NULL) t
  WHERE rn = 1)
, c AS (SELECT station, lat, lon, sqrt(pow({SNAP_LON} - lon, 2) + pow({SNAP_LAT} - lat, 2)) AS dist FROM d)
, s AS (SELECT * FROM c
        ORDER BY CASE WHEN dist < {SNAP_EPS} THEN 0 ELSE 1 END, CASE WHEN dist < {SNAP_EPS} THEN 0.0 ELSE dist END,
                 lat, lon
        LIMIT 1)
, p AS (SELECT station,
               CASE WHEN dist < {SNAP_EPS} THEN {SNAP_LAT} ELSE lat END AS plat,
               CASE WHEN dist < {SNAP_EPS} THEN {SNAP_LON} ELSE lon END AS plon
        FROM s)
SELECT p.station AS station, month,
       count(CASE WHEN year <> {YEAR} THEN 1 END) AS others_n,
       round(avg(CASE WHEN year <> {YEAR} THEN CAST(tmpf AS DOUBLE) END), 6) AS others_mean,
       count(CASE WHEN year = {YEAR} THEN 1 END) AS year_n,
       round(avg(CASE WHEN year = {YEAR} THEN CAST(tmpf AS DOUBLE) END), 6) AS year_mean
FROM O JOIN p ON O.lat = CAST(p.plat AS FLOAT) AND O.lon = CAST(p.plon AS FLOAT)
WHERE tmpf IS NOT NULL
GROUP BY p.station, month"""))
def q_year_vs_seasonal_snapped(spark, sf_dir):
    from weatherlake.operators import stations
    obs = fx.observations(spark, sf_dir)
    dictionary = stations.station_dictionary(obs).withColumn("ord", F.struct("lat", "lon"))
    lon, lat, station = stations.snap_position(dictionary, SNAP_LON, SNAP_LAT, eps=SNAP_EPS, stored=True)
    return (climate.year_vs_seasonal(obs, "tmpf", YEAR, lat, lon)
            .select(F.lit(station).alias("station"), "month", "others_n", r6("others_mean"), "year_n",
                    r6("year_mean")))


# The history cut of the original: the first 100 rows of each position in
# time order (the limit is the feature), over all positions at once.
HISTORY_ROWS = 100
TIE_BREAK = ("l_orderkey", "l_partkey", "l_linenumber", "seq")


@register("historical_stats_first100", with_o(f"""
SELECT lat, lon, year, month, count(*) AS n_obs,
       round(avg(CAST(tmpf AS DOUBLE)), 6) AS mean,
       round(stddev_pop(CAST(tmpf AS DOUBLE)), 6) AS std
FROM (SELECT *, row_number() OVER (
        PARTITION BY lat, lon
        ORDER BY year, month, day, hour, minute, station, {", ".join(TIE_BREAK)}) AS rn
      FROM O) t
WHERE rn <= {HISTORY_ROWS} AND tmpf IS NOT NULL
GROUP BY lat, lon, year, month"""))
def q_historical_stats_first100(spark, sf_dir):
    obs = fx.observations(spark, sf_dir)
    return (climate.historical_stats(obs, "tmpf", limit=HISTORY_ROWS, tie_break=TIE_BREAK)
            .select("lat", "lon", "year", "month", "n_obs", r6("mean"), r6("std")))


@register("yearly_vs_seasonal_series", with_o(f"""
, v AS (SELECT year, month, round_even(CAST(tmpf AS DOUBLE), 1) AS x FROM O WHERE {POS} AND tmpf IS NOT NULL)
SELECT month, '{climate.SEASONAL_LABEL}' AS series, round({F2C.format(x='avg(x)')}, 6) AS value FROM v GROUP BY month
UNION ALL
SELECT month, concat(year, ' values') AS series, round({F2C.format(x='avg(x)')}, 6) AS value FROM v GROUP BY year, month"""))
def q_yearly_vs_seasonal_series(spark, sf_dir):
    obs = fx.observations(spark, sf_dir)
    return climate.yearly_vs_seasonal_series(obs, "tmpf", LAT, LON, to_celsius=True).select("month", "series", r6("value"))


@register("historical_stats_first100_position", with_o(f"""
SELECT year, month, count(*) AS n_obs, round(avg(CAST(tmpf AS DOUBLE)), 6) AS mean,
       round(stddev_pop(CAST(tmpf AS DOUBLE)), 6) AS std
FROM (SELECT * FROM O WHERE {POS}
      ORDER BY year, month, day, hour, minute, station, {", ".join(TIE_BREAK)} LIMIT {HISTORY_ROWS}) t
WHERE tmpf IS NOT NULL GROUP BY year, month"""))
def q_historical_stats_first100_position(spark, sf_dir):
    obs = fx.observations(spark, sf_dir)
    return (climate.historical_stats(obs, "tmpf", LAT, LON, limit=HISTORY_ROWS, tie_break=TIE_BREAK)
            .select("year", "month", "n_obs", r6("mean"), r6("std")))
