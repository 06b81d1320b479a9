"""Registered clustering queries.  The k-means oracle unrolls every Lloyd
iteration as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from weatherlake import schema
from weatherlake.operators import cluster
from weatherlake.plans.catalog import r6, register, with_o
from weatherlake.sources import fixtures as fx

Y, M, D1, D2 = fx.KMEANS_YEAR, fx.KMEANS_MONTH, fx.KMEANS_DAY1, fx.KMEANS_DAY2
K, N_ITER = 3, 100
FEATS = schema.KMEANS_FEATURES


def _features(spark, sf_dir):
    return cluster.station_features(fx.observations(spark, sf_dir), Y, M, D1, D2)


FEATURES_SQL = f""", f AS (
  SELECT round_even(CAST(lat AS DOUBLE), 4) AS lat, round_even(CAST(lon AS DOUBLE), 4) AS lon,
         count(*) AS n_obs,
         {", ".join(f"avg(CAST({c} AS DOUBLE)) AS {c}" for c in FEATS)}
  FROM O WHERE year = {Y} AND month = {M} AND day >= {D1} AND day <= {D2}
    AND {" AND ".join(f"{c} IS NOT NULL" for c in FEATS)}
  GROUP BY 1, 2)
, st AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATS)} FROM f)"""


def _z(expr: str, c: str) -> str:
    return f"CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({expr} - m_{c}) / s_{c} END"


@register("station_features", with_o(FEATURES_SQL + f"""
SELECT lat, lon, n_obs, {", ".join(f"round({c}, 6) AS {c}" for c in FEATS)} FROM f"""))
def q_station_features(spark, sf_dir):
    return _features(spark, sf_dir).select("lat", "lon", "n_obs", *[r6(c) for c in FEATS])


@register("feature_zscore", with_o(FEATURES_SQL + f"""
SELECT lat, lon, {", ".join(f"round({_z(c, c)}, 6) AS z_{c}" for c in FEATS)} FROM f, st"""))
def q_feature_zscore(spark, sf_dir):
    return cluster.feature_zscore(_features(spark, sf_dir)).select("lat", "lon", *[r6(f"z_{c}") for c in FEATS])


def kmeans_sql(k: int, n_iter: int) -> str:
    """Lloyd iterations unrolled: a{i} assigns with c{i-1}, c{i} updates."""
    dist = " + ".join(f"pow(p.z_{c} - {_z('c.' + c, c)}, 2)" for c in FEATS)
    parts = [FEATURES_SQL,
             f", p AS MATERIALIZED (SELECT f.*, {', '.join(f'{_z(c, c)} AS z_{c}' for c in FEATS)} FROM f, st)",
             f", c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY lat, lon) - 1 AS INTEGER) AS k, "
             f"{', '.join(FEATS)} FROM p ORDER BY lat, lon LIMIT {k})"]

    def assign(i: int) -> str:
        return (f", a{i} AS MATERIALIZED (SELECT * FROM ("
                f"SELECT *, row_number() OVER (PARTITION BY lat, lon ORDER BY d, k) AS rn FROM ("
                f"SELECT p.lat, p.lon, {', '.join('p.' + c for c in FEATS)}, c.k, sqrt({dist}) AS d "
                f"FROM p, c{i - 1} c, st) x) y WHERE rn = 1)")

    for i in range(1, n_iter + 1):
        parts.append(assign(i))
        parts.append(
            f", c{i} AS MATERIALIZED (SELECT c.k, "
            + ", ".join(f"coalesce(avg(a.{c}), c.{c}) AS {c}" for c in FEATS)
            + f" FROM c{i - 1} c LEFT JOIN a{i} a ON a.k = c.k GROUP BY c.k, "
            + ", ".join(f"c.{c}" for c in FEATS) + ")")
    parts.append(assign(n_iter + 1))
    return "".join(parts)


@register("kmeans_assign", with_o(kmeans_sql(K, N_ITER) + f"""
SELECT lat, lon, k AS cluster, 'cluster_' || CAST(k + 1 AS VARCHAR) AS label, round(d, 6) AS dist
FROM a{N_ITER + 1}"""))
def q_kmeans_assign(spark, sf_dir):
    res = cluster.kmeans_stations(_features(spark, sf_dir), K, N_ITER)
    return res.assignments.select("lat", "lon", "cluster", "label", r6("dist"))


@register("kmeans_inertia", with_o(kmeans_sql(K, N_ITER) + f"""
SELECT round(sum(d), 6) AS inertia, count(*) AS n_points FROM a{N_ITER + 1}"""))
def q_kmeans_inertia(spark, sf_dir):
    res = cluster.kmeans_stations(_features(spark, sf_dir), K, N_ITER)
    return res.assignments.agg(F.round(F.sum("dist"), 6).alias("inertia"), F.count(F.lit(1)).alias("n_points"))


@register("kmeans_members", with_o(kmeans_sql(K, N_ITER) + f"""
SELECT k AS cluster, 'cluster_' || CAST(k + 1 AS VARCHAR) AS label, count(*) AS n_members
FROM a{N_ITER + 1} GROUP BY k"""))
def q_kmeans_members(spark, sf_dir):
    return cluster.kmeans_stations(_features(spark, sf_dir), K, N_ITER).members()
