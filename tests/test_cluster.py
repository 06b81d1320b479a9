import numpy as np
import pytest

from weatherlake.operators.cluster import feature_zscore, kmeans_stations, station_features

from obsrows import obs_frame

FEATS = ["tmpf", "alti", "relh", "sknt"]


def np_kmeans(x, k, n_iter):
    """The clustering rules written directly in NumPy."""
    mean, std = x.mean(0), x.std(0)
    z = lambda v: np.where(std == 0, 0.0, (v - mean) / np.where(std == 0, 1, std))
    c = x[:k].copy()
    for _ in range(n_iter):
        d = np.sqrt(((z(x)[:, None, :] - z(c)[None, :, :]) ** 2).sum(-1))
        lab = d.argmin(1)
        new = c.copy()
        for j in range(k):
            if (lab == j).any():
                new[j] = x[lab == j].mean(0)
        c = new
    d = np.sqrt(((z(x)[:, None, :] - z(c)[None, :, :]) ** 2).sum(-1))
    lab = d.argmin(1)
    return lab, d[np.arange(len(x)), lab], c


def feature_df(spark, x):
    rows = [(float(i), float(i % 3), *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "lat double, lon double, tmpf double, alti double, relh double, sknt double")


@pytest.mark.parametrize("seed,k", [(0, 3), (1, 4), (2, 1)])
def test_kmeans_matches_numpy(spark, seed, k):
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.normal(m, 1.0, size=(8, 4)) for m in (0, 5, 10)])
    res = kmeans_stations(feature_df(spark, x), k, n_iter=100)
    lab, dist, cent = np_kmeans(x, k, 100)
    got = sorted(res.assignments.collect(), key=lambda r: r.lat)
    assert [r.cluster for r in got] == list(lab)
    assert [r.label for r in got] == [f"cluster_{v + 1}" for v in lab]
    assert np.allclose([r.dist for r in got], dist)
    assert np.allclose(np.array(res.centroids), cent)
    assert res.inertia() == pytest.approx(dist.sum())


def test_zero_variance_and_empty_cluster(spark):
    x = np.array([[1.0, 5, 1, 1], [1.0, 5, 1, 1], [2.0, 5, 2, 1], [9.0, 5, 9, 1]])
    res = kmeans_stations(feature_df(spark, x), 3, n_iter=10)
    lab, dist, cent = np_kmeans(x, 3, 10)
    got = sorted(res.assignments.collect(), key=lambda r: r.lat)
    assert [r.cluster for r in got] == list(lab)
    assert np.allclose(np.array(res.centroids), cent)     # duplicated start: cluster 1 stays empty


def test_k_larger_than_points(spark):
    with pytest.raises(ValueError):
        kmeans_stations(feature_df(spark, np.ones((2, 4))), 3)


def test_features_and_zscore(spark):
    rows = [("A", 2011, 9, d, 0, 0, 1.0, 2.0, 50.0 + d, 80.0) for d in (1, 2, 20)]
    rows += [("B", 2011, 9, 1, 0, 0, 3.0, 4.0, 60.0, None)]           # incomplete row
    rows += [("C", 2011, 9, 3, 0, 0, 5.0, 6.0, 70.0, 90.0)]
    from pyspark.sql import types as T
    df = obs_frame(spark, [r + (30.0, 5.0) for r in rows], [("alti", T.FloatType()), ("sknt", T.FloatType())])
    f = {(r.lat, r.lon): r for r in station_features(df, 2011, 9, 1, 15).collect()}
    assert set(f) == {(1.0, 2.0), (5.0, 6.0)}
    assert f[(1.0, 2.0)].n_obs == 2 and f[(1.0, 2.0)].tmpf == pytest.approx(51.5)
    z = {(r.lat, r.lon): r for r in feature_zscore(station_features(df, 2011, 9, 1, 15)).collect()}
    assert z[(1.0, 2.0)].z_tmpf == pytest.approx(-1.0) and z[(5.0, 6.0)].z_tmpf == pytest.approx(1.0)
    assert z[(1.0, 2.0)].z_alti == 0.0                                   # zero spread


def test_many_centroids(spark):
    from weatherlake.operators import cluster
    rows = [(float(i % 90), float(i // 90), float(i % 7), float(i * 13 % 101), float(i % 11), float(i * 7 % 50)) for i in range(1500)]
    df = spark.createDataFrame(rows, "lat double, lon double, tmpf double, alti double, relh double, sknt double")
    many = kmeans_stations(df, 500, n_iter=2)
    assert many.assignments.select("cluster").distinct().count() <= 500 and len(many.centroids) == 500
    plan = many.assignments._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 200_000
    few = kmeans_stations(df, 20, n_iter=3)
    try:
        cluster.UNROLLED = 0
        walked = kmeans_stations(df, 20, n_iter=3)
    finally:
        cluster.UNROLLED = 32
    assert few.centroids == walked.centroids
    assert sorted(few.assignments.collect()) == sorted(walked.assignments.collect())
