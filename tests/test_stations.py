import math

import pytest
from hypothesis import given, settings, strategies as st

from weatherlake.operators.stations import load_stations, nearest_station, station_dictionary, write_stations

from obsrows import obs_frame


def brute(queries, stations, eps):
    """The dictionary scan: first station within eps (query coordinates),
    else the strict minimum distance, first in order on ties."""
    out = {}
    for qid, qlon, qlat in queries:
        best, best_d = None, math.inf
        hit = None
        for name, slon, slat, o in sorted(stations, key=lambda s: s[3]):
            d = math.sqrt((qlon - slon) ** 2 + (qlat - slat) ** 2)
            if d < eps:
                hit = (name, qlon, qlat, d, True)
                break
            if d < best_d:
                best_d, best = d, (name, slon, slat, d, False)
        out[qid] = hit or best
    return out


def run(spark, queries, stations, eps):
    q = spark.createDataFrame(queries, "qid long, lon double, lat double")
    s = spark.createDataFrame(stations, "station string, lon double, lat double, ord long")
    return {r.qid: (r.station, r.lon, r.lat, r.distance, r.within_eps)
            for r in nearest_station(q, s, eps=eps).collect()}


def test_early_accept_is_first_in_order_not_nearest(spark):
    stations = [("FAR", 0.0, 0.9, 1), ("NEAR", 0.0, 0.1, 2), ("OUT", 5.0, 5.0, 3)]
    got = run(spark, [(1, 0.0, 0.0)], stations, eps=1.0)
    assert got[1][0] == "FAR" and got[1][4] is True and got[1][1:3] == (0.0, 0.0)


def test_equal_distance_takes_lower_order(spark):
    stations = [("B", 2.0, 0.0, 2), ("A", -2.0, 0.0, 1), ("C", 0.0, 3.0, 3)]
    got = run(spark, [(7, 0.0, 0.0)], stations, eps=0.001)
    assert got[7][0] == "A" and got[7][1:3] == (-2.0, 0.0) and got[7][4] is False


def test_far_query_and_no_station(spark):
    stations = [("A", 0.0, 0.0, 1), ("B", 1.0, 1.0, 2)]
    got = run(spark, [(1, 500.0, -300.0), (2, float("nan"), 0.0)], stations, eps=0.001)
    assert got[1][0] == "B" and got[2][0] is None
    assert run(spark, [(1, 0.0, 0.0)], [], eps=0.1) == {1: (None, None, None, None, None)}


coords = st.floats(-20, 20, allow_nan=False, allow_infinity=False)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(coords, coords), min_size=1, max_size=12),
       st.lists(st.tuples(coords, coords), min_size=1, max_size=15),
       st.sampled_from([1e-3, 0.5, 3.0]))
def test_matches_brute_force(spark, stations, queries, eps):
    stations = [(f"S{i}", lon, lat, i) for i, (lon, lat) in enumerate(stations)]
    queries = [(i, lon, lat) for i, (lon, lat) in enumerate(queries)]
    got = run(spark, queries, stations, eps)
    want = brute(queries, stations, eps)
    for qid, w in want.items():
        g = got[qid]
        assert g[0] == w[0] and g[4] == w[4]
        assert g[3] == pytest.approx(w[3], abs=1e-12)


def test_station_dictionary_earliest(spark):
    rows = [("Z", 2011, 1, 2, 0, 0, 1.5, 2.5, None, None),
            ("Y", 2011, 1, 1, 5, 0, 1.5, 2.5, None, None),
            ("X", 2011, 1, 1, 5, 0, 1.5, 2.5, None, None),   # same instant: name decides
            ("W", 2010, 1, 1, 0, 0, -3.78941, 37.18972, None, None)]
    got = {(r.lat, r.lon): r.station for r in station_dictionary(obs_frame(spark, rows)).collect()}
    assert got == {(1.5, 2.5): "X", (-3.7894, 37.1897): "W"}


def test_station_file_round_trip(spark, tmp_path):
    f = tmp_path / "st.csv"
    f.write_text("station,lat,lon\nAAAA,-3.7894,37.1897\nBBBB,-6.8292,38.8833\n")
    st_df = load_stations(spark, str(f))
    rows = st_df.orderBy("ord").collect()
    assert [(r.station, r.lat, r.lon) for r in rows] == [("AAAA", 37.1897, -3.7894), ("BBBB", 38.8833, -6.8292)]
    write_stations(st_df, str(tmp_path / "out"))
    back = load_stations(spark, str(tmp_path / "out")).select("station", "lat", "lon").collect()
    assert sorted(tuple(r) for r in back) == [("AAAA", 37.1897, -3.7894), ("BBBB", 38.8833, -6.8292)]


def test_snap_position(spark):
    from weatherlake.operators.stations import snap_position
    s = spark.createDataFrame([("FAR", 0.0, 0.9, 1), ("NEAR", 0.0, 0.1, 2)], "station string, lon double, lat double, ord long")
    assert snap_position(s, 0.0, 0.0, eps=1.0) == (0.0, 0.0, "FAR")
    assert snap_position(s, 0.0, 0.0, eps=1e-4) == (0.0, 0.1, "NEAR")
    assert snap_position(s, 0.0, 0.0, eps=1.0, stored=True) == (0.0, 0.9, "FAR")
    with pytest.raises(ValueError):
        snap_position(s.limit(0), 0.0, 0.0)


def test_far_queries_do_not_meet_all_stations(spark):
    import random

    from weatherlake.operators import stations as m
    r = random.Random(0)
    near = [(f"S{i}", r.gauss(0, 0.01), r.gauss(0, 0.01), i) for i in range(2000)]
    queries = [(i, r.uniform(-1e4, 1e4), r.uniform(-1e4, 1e4)) for i in range(200)]
    q = spark.createDataFrame(queries, "qid long, q_lon double, q_lat double")
    st = spark.createDataFrame(near, "station string, s_lon double, s_lat double, s_ord long")
    assert m._candidates(q, st, 1e-3).count() <= 200 * 40  # all pairs would be 400,000
    far_out = st.union(spark.createDataFrame([("OUT", 1e9, 1e9, 5000), ("WEST", -1e30, 0.0, 5001)], st.schema))
    assert m._candidates(q, far_out, 1e-3).count() <= 200 * 40
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("far", "far queries")
    try:
        got = run(spark, queries, near, 1e-3)
        assert len(tracker.getJobIdsForGroup("far")) < 60
    finally:
        spark.sparkContext.setJobGroup("other", "other")
    want = brute(queries, near, 1e-3)
    assert all(got[i][0] == want[i][0] for i, _, _ in queries)


def test_positions_that_are_not_finite(spark):
    inf, nan = float("inf"), float("nan")
    stations = [("A", 0.0, 0.0, 1), ("I", inf, 0.0, 0), ("N", nan, 1.0, 2), ("B", 1.0, 1.0, 3)]
    got = run(spark, [(1, inf, 0.0), (2, 0.9, 0.9), (3, nan, nan), (4, 1e300, -1e300)], stations, 1e-3)
    assert got[1][0] is None and got[3][0] is None and got[2][0] == "B" and got[4][0] in ("A", "B")


def test_dense_circle_takes_the_first_in_order(spark):
    stations = [(f"S{i}", (i * 37 % 100) / 1000, (i * 61 % 100) / 1000, 1000 - i) for i in range(1000)]
    got = run(spark, [(1, 0.05, 0.05), (2, 0.3, 0.0)], stations, 0.02)
    want = brute([(1, 0.05, 0.05), (2, 0.3, 0.0)], stations, 0.02)
    assert got[1][0] == want[1][0] and got[2][0] == want[2][0]


def test_dictionary_keeps_its_order_when_written(spark, tmp_path):
    st_df = spark.createDataFrame([("Z", 2.0, 0.0, 1), ("A", -2.0, 0.0, 2), ("quote \"q\", \\", 9.0, 9.0, 3)],
                                  "station string, lon double, lat double, ord long")
    for k in range(2):
        write_stations(st_df.repartition(3), str(tmp_path / str(k)))
        back = load_stations(spark, str(tmp_path / str(k)))
        q = spark.createDataFrame([(1, 0.0, 0.0)], "qid long, lon double, lat double")
        assert nearest_station(q, back).first().station == "Z"
        assert {r.station for r in back.collect()} == {"Z", "A", "quote \"q\", \\"}


def test_many_stations_on_one_line_and_an_outlier(spark):
    import random
    r = random.Random(1)
    stations = [(f"S{i}", 5.0, i * 0.001, 3000 - i) for i in range(600)] + [("OUT", 1e9, -1e9, 0)]
    stations += [(f"T{i}", r.uniform(-1, 1), r.uniform(-1, 1), 10_000 + i) for i in range(300)]
    queries = [(k, r.uniform(-6, 6), r.uniform(-2, 2)) for k in range(60)] + [(100, 9e8, -9e8), (101, 5.0, 0.3)]
    for eps in (1e-3, 0.05):
        want = brute(queries, stations, eps)
        assert all(got[0] == want[k][0] for k, got in run(spark, queries, stations, eps).items())
