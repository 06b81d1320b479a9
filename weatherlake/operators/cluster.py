"""Station clustering: per-station feature means, standardisation and a
distributed, deterministic Lloyd k-means.

The observations are reduced once to one row per position
(``station_features``); that small frame is materialised and every iteration
is one job over it: assign each point to the nearest centroid (centroids are
constants in the expression, so the plan does not grow), then average the
members per cluster.  Only K x F numbers come back to the driver per
iteration.

Rules fixed for determinism:

- start centroids: the first K points by (lat, lon), or an explicit ``init``;
- features are standardised with the mean and *population* std of the
  station means (each station counts once); a feature with zero spread
  contributes 0 to every distance;
- distances are Euclidean in standardised space; ties go to the lower
  cluster index;
- centroids are updated as the mean of the members in raw units; an empty
  cluster keeps its centroid;
- at most ``n_iter`` iterations; once an assignment leaves every cluster its
  members (their count and a hash of their positions), later iterations would
  repeat it, so the loop stops there with the same result;
- inertia is the sum of the (unsquared) distances of the final assignment.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from weatherlake import schema
from weatherlake.functions.exprs import as_double, euclid, first_argmin, half_even, zscore
from weatherlake.session import materialize
from weatherlake.sources.scan import by_day_range


def station_features(obs: DataFrame, year: int, month: int, day1: int | None = None, day2: int | None = None,
                     features: Sequence[str] = schema.KMEANS_FEATURES, *, digits: int = 4) -> DataFrame:
    """Mean of each feature per position over a day range (whole month when
    days are omitted), on complete rows only.  Positions are rounded
    half-even to ``digits``.  Columns: lat, lon, n_obs, <features>.
    """
    df = by_day_range(obs, year, month, day1, day2).dropna(how="any", subset=list(features))
    return (df.groupBy(half_even("lat", digits).alias("lat"), half_even("lon", digits).alias("lon"))
            .agg(F.count(F.lit(1)).alias("n_obs"), *[F.avg(as_double(c)).alias(c) for c in features]))


def _stat_aggs(cols: Sequence[str]) -> list[Column]:
    aggs = []
    for c in cols:
        aggs += [F.avg(as_double(c)).alias(f"{c}_mean"), F.stddev_pop(as_double(c)).alias(f"{c}_std")]
    return aggs


def feature_stats(features: DataFrame, cols: Sequence[str] = schema.KMEANS_FEATURES) -> DataFrame:
    """One row: mean and population std of each feature over the stations
    (``<f>_mean``, ``<f>_std``)."""
    return features.agg(*_stat_aggs(cols))


def feature_zscore(features: DataFrame, cols: Sequence[str] = schema.KMEANS_FEATURES) -> DataFrame:
    """Standardised features ``z_<f>`` per station.

    The statistics are one scalar subquery (a struct), evaluated once and
    inlined as a constant: no join, nothing collected.
    Columns: lat, lon, z_<f>...
    """
    stats = feature_stats(features, cols)
    # Project the subquery once, then read its fields: each field access on
    # the subquery expression itself would plan a subquery of its own.
    with_stats = features.select("lat", "lon", *cols,
                                 stats.select(F.struct(*stats.columns)).scalar().alias("_s"))
    s = F.col("_s")
    return with_stats.select("lat", "lon",
                             *[zscore(c, s[f"{c}_mean"], s[f"{c}_std"]).alias(f"z_{c}") for c in cols])


@dataclass
class KMeansResult:
    centroids: list[list[float]]
    iterations: int
    converged: bool
    assignments: DataFrame

    def inertia(self) -> float:
        v = self.assignments.agg(F.sum("dist")).first()[0]
        return float(v) if v is not None else 0.0

    def members(self) -> DataFrame:
        """Stations per cluster: cluster, label, n_members (empty clusters
        are absent)."""
        return self.assignments.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n_members"))


UNROLLED = 32  # so many centroids are literals in the generated code; more are one array value


def _assign(points: DataFrame, centroids: list[list[float]], means: list[float], stds: list[float]) -> DataFrame:
    """Nearest centroid and distance for every point, the lowest number on ties.

    Few centroids are unrolled.  Many would make the plan and its generated
    code grow with their number, so they are one constant array that a
    higher-order function walks; both compute the same sums in the same order.
    """
    zs = [F.col(f"_z{i}") for i in range(len(means))]
    scaled = [[0.0 if s == 0 else (v - m) / s for v, m, s in zip(c, means, stds)] for c in centroids]
    if len(scaled) <= UNROLLED:
        dists = F.array(*[euclid(zs, [F.lit(v) for v in c]) for c in scaled])
    else:
        # Python writes floats so that they are read back exactly
        constant = F.from_json(F.lit(json.dumps(scaled)), "array<array<double>>")
        dists = F.transform(constant, lambda c: euclid(zs, [c[i] for i in range(len(zs))]))
    return (points.withColumn("_dists", dists).withColumn("cluster", first_argmin("_dists"))
            .withColumn("dist", F.array_min("_dists")).drop("_dists"))


def kmeans_stations(features: DataFrame, k: int, n_iter: int = 100, *,
                    cols: Sequence[str] = schema.KMEANS_FEATURES,
                    init: Sequence[Sequence[float]] | None = None) -> KMeansResult:
    """Cluster station feature rows (``lat, lon, <cols>``) into ``k`` groups.

    Returns the final centroids (raw units), the iterations run and the
    assignment frame: lat, lon, cluster (0-based), label (``cluster_<n>``,
    1-based), dist.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    cols = list(cols)
    # One pass over the observations: the station rows are materialised, and
    # their count and statistics come from that small frame in one job.
    base = materialize(features.select("lat", "lon", *[as_double(c).alias(c) for c in cols]))
    st = base.agg(F.count(F.lit(1)).alias("_n"), *_stat_aggs(cols)).first()
    n_points = int(st["_n"])
    means = [float(st[f"{c}_mean"]) if st[f"{c}_mean"] is not None else 0.0 for c in cols]
    stds = [float(st[f"{c}_std"]) if st[f"{c}_std"] is not None else 0.0 for c in cols]
    points = base.select(
        "*", *[zscore(c, F.lit(m), F.lit(s)).alias(f"_z{i}") for i, (c, m, s) in enumerate(zip(cols, means, stds))])
    if k > n_points:
        raise ValueError(f"k={k} is larger than the number of points ({n_points})")
    if init is None:
        first = points.orderBy("lat", "lon").limit(k).select(*cols).collect()
        centroids = [[float(r[c]) for c in cols] for r in first]
    else:
        centroids = [[float(v) for v in row] for row in init]
        if len(centroids) != k or any(len(r) != len(cols) for r in centroids):
            raise ValueError("init must hold k rows of one value per feature")

    iterations, converged, members = 0, False, None
    for _ in range(n_iter):
        assigned = _assign(points, centroids, means, stds)
        rows = assigned.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias("_n"),
                                               F.bit_xor(F.xxhash64("lat", "lon")).alias("_members")).collect()
        iterations += 1
        # the order of a distributed sum may change a mean's last digit, but not who is a member
        now = {r["cluster"]: (r["_n"], r["_members"]) for r in rows}
        if now == members:
            converged = True
            break
        members = now
        centroids = [list(c) for c in centroids]
        for r in rows:
            centroids[r["cluster"]] = [float(r[c]) for c in cols]

    final = _assign(points, centroids, means, stds).select(
        "lat", "lon", "cluster", F.concat(F.lit("cluster_"), (F.col("cluster") + 1).cast("string")).alias("label"),
        "dist")
    return KMeansResult(centroids, iterations, converged, final)
