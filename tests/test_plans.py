"""Plan properties the design relies on at scale, asserted on the physical
plans so that a regression shows up as a failing test."""

import re

from weatherlake import schema
from weatherlake.operators import climate, cluster, snapshot, stations, upsert
from weatherlake.sources import fixtures as fx
from weatherlake.sources.layouts import read_layout, write_by_date, write_by_position

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_upsert_combines_before_the_shuffle(spark):
    p = plan(upsert.upsert_last(fx.observations(spark, SF), schema.KEY_POSITION, fx.OBS_ORDER))
    # partial max_by below the exchange: copies of a hot key collapse map-side
    assert p.index("partial_max_by") > p.index("Exchange hashpartitioning")
    assert len(re.findall(r"Exchange", p)) == 1


def test_per_position_limit_is_cut_before_the_shuffle(spark):
    p = plan(climate.historical_stats(fx.observations(spark, SF), "sknt", limit=100))
    assert p.count("WindowGroupLimit") == 2


def test_first_rows_are_cut_by_counted_months(spark):
    p = plan(climate.historical_stats(fx.observations(spark, SF), "sknt", limit=100))
    assert "LeftSemi" in p and "partial_count" in p
    q = plan(stations.station_dictionary(fx.observations(spark, SF)))
    assert q.index("SortAggregate") < q.rindex("HashAggregate")  # only the small rest is sorted
    assert "partial_min" in q[q.rindex("HashAggregate"):]


def test_climatology_is_one_partial_final_aggregate(spark):
    p = plan(climate.year_vs_seasonal(fx.observations(spark, SF), "tmpf", 1998))
    assert len(re.findall(r"Exchange", p)) == 1
    assert "partial_avg" in p and "Join" not in p


def test_snapshots_do_not_shuffle(spark):
    p = plan(snapshot.snapshot_all(fx.observations(spark, SF), 1998, 9, 1))
    assert "Exchange" not in p and "Expand" in p


def test_zscore_plans_one_subquery(spark):
    f = cluster.station_features(fx.observations(spark, SF), 1998, 9, 1, 15)
    p = plan(cluster.feature_zscore(f))
    assert len(re.findall(r"Exchange", p)) <= 3
    assert "Join" not in p


def test_layout_scans_push_filters(spark, tmp_path):
    obs = fx.observations(spark, SF)
    write_by_position(obs, str(tmp_path / "p"), fx.OBS_ORDER)
    write_by_date(obs, str(tmp_path / "d"), fx.OBS_ORDER)
    p = plan(climate.seasonal_mean(read_layout(spark, str(tmp_path / "p")), "tmpf", fx.PROBE_LAT, fx.PROBE_LON))
    assert "EqualTo(lat,-12.0)" in p and "EqualTo(lon,34.5)" in p
    q = plan(snapshot.snapshot(read_layout(spark, str(tmp_path / "d")), "relh", 1998, 9, 1))
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ = 1998", q) and "(month#" in q
    assert "EqualTo(day,1)" in q


def test_nearest_station_never_plans_a_cross_join(spark):
    out = stations.nearest_station(fx.far_positions(spark, SF), fx.clustered_stations(spark, SF), eps=0.001)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
