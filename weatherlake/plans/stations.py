"""Registered station queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weatherlake.operators import stations
from weatherlake.plans.catalog import r6, register, with_o
from weatherlake.sources import fixtures as fx

EPS = 3.0


@register("station_dictionary", with_o("""
SELECT station, round_even(CAST(lat AS DOUBLE), 4) AS lat, round_even(CAST(lon AS DOUBLE), 4) AS lon
FROM (SELECT *, row_number() OVER (PARTITION BY lat, lon ORDER BY year, month, day, hour, minute, station) AS rn
      FROM O WHERE lat IS NOT NULL AND lon IS NOT NULL) t
WHERE rn = 1"""))
def q_station_dictionary(spark, sf_dir):
    return stations.station_dictionary(fx.observations(spark, sf_dir))


def nearest_sql(eps: float, queries=fx.QUERY_ADAPTER, stations=fx.STATION_ADAPTER, table: str = "nation") -> str:
    return f"""
WITH q AS (SELECT {", ".join(queries)} FROM supplier),
s AS (SELECT {", ".join(stations)} FROM {table}),
c AS (SELECT q.qid, q.lon AS q_lon, q.lat AS q_lat, s.station, s.lon AS s_lon, s.lat AS s_lat, s.ord,
             sqrt(pow(q.lon - s.lon, 2) + pow(q.lat - s.lat, 2)) AS d
      FROM q CROSS JOIN s),
r AS (SELECT *, row_number() OVER (
        PARTITION BY qid
        ORDER BY CASE WHEN d < {eps} THEN 0 ELSE 1 END, CASE WHEN d < {eps} THEN 0.0 ELSE d END, ord) AS rn
      FROM c)
SELECT qid, station,
       CASE WHEN d < {eps} THEN q_lon ELSE s_lon END AS lon,
       CASE WHEN d < {eps} THEN q_lat ELSE s_lat END AS lat,
       round(d, 6) AS distance, d < {eps} AS within_eps
FROM r WHERE rn = 1"""


@register("nearest_station", nearest_sql(EPS))
def q_nearest_station(spark, sf_dir):
    out = stations.nearest_station(fx.query_positions(spark, sf_dir), fx.reference_stations(spark, sf_dir), eps=EPS)
    return out.select("qid", "station", "lon", "lat", r6("distance"), "within_eps")


@register("nearest_station_small_eps", nearest_sql(0.05))
def q_nearest_station_small_eps(spark, sf_dir):
    out = stations.nearest_station(fx.query_positions(spark, sf_dir), fx.reference_stations(spark, sf_dir),
                                   eps=0.05)
    return out.select("qid", "station", "lon", "lat", r6("distance"), "within_eps")


@register("nearest_station_far", nearest_sql(0.001, fx.FAR_QUERY_ADAPTER, fx.CLUSTER_ADAPTER, "customer"))
def q_nearest_station_far(spark, sf_dir):
    out = stations.nearest_station(fx.far_positions(spark, sf_dir), fx.clustered_stations(spark, sf_dir), eps=0.001)
    return out.select("qid", "station", "lon", "lat", r6("distance"), "within_eps")
