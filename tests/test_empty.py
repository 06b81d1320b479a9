"""Empty inputs: every operator returns an empty result (or raises where the
rules say so) instead of failing on a missing group."""

import pytest

from weatherlake import schema
from weatherlake.operators import climate, cluster, snapshot, stations, upsert

from obsrows import obs_frame


def test_empty_inputs(spark):
    from pyspark.sql import types as T
    empty = obs_frame(spark, [], [("alti", T.FloatType()), ("sknt", T.FloatType()), ("seq", T.IntegerType())])
    assert climate.seasonal_mean(empty, "tmpf", 1.0, 2.0).count() == 0
    assert climate.year_vs_seasonal(empty, "tmpf", 2011).count() == 0
    assert climate.yearly_series(empty, "tmpf").count() == 0
    assert climate.historical_stats(empty, "tmpf", limit=5).count() == 0
    assert upsert.upsert_last(empty, schema.KEY_POSITION, "seq").count() == 0
    r = upsert.rows_sent_vs_kept(empty, schema.KEY_POSITION).first()
    assert (r.rows_sent, r.rows_kept) == (0, 0)
    assert stations.station_dictionary(empty).count() == 0
    assert snapshot.snapshot_all(empty, 2011, 9, 1).count() == 0
    feats = cluster.station_features(empty, 2011, 9)
    assert feats.count() == 0
    with pytest.raises(ValueError):
        cluster.kmeans_stations(feats, 2)
