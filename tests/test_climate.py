import random
import statistics

import pytest
from hypothesis import given, settings, strategies as st

from weatherlake.functions.exprs import f_to_c, half_even, position_eq
from weatherlake.operators import climate

from obsrows import obs_frame

LAT, LON = -3.7894, 37.1897


def _rows():
    out = []
    rng = random.Random(7)
    for year in (2010, 2011, 2012):
        for month in (1, 2, 3):
            for day in (1, 2):
                t = None if (day == 2 and month == 3) else round(rng.uniform(30, 90), 2)
                out.append(("LEGR", year, month, day, 0, 0, LAT, LON, t, rng.uniform(10, 99)))
    out.append(("LEGR", 2011, 4, 1, 0, 0, LAT, LON, 70.0, 50.0))     # April only in 2011
    out.append(("XXXX", 2011, 1, 1, 0, 0, 1.0, 2.0, 10.0, 50.0))     # another position
    return out


def _py_float(x):
    import struct
    return struct.unpack("f", struct.pack("f", x))[0]


def test_float_position_equality(spark):
    df = obs_frame(spark, _rows())
    assert df.filter(position_eq(LAT, LON)).count() == 19
    from pyspark.sql import functions as F
    assert df.filter(F.col("lat") == LAT).count() == 0     # the double literal matches nothing


def test_seasonal_mean_matches_python(spark):
    df = obs_frame(spark, _rows())
    got = {r.month: r for r in climate.seasonal_mean(df, "tmpf", LAT, LON, to_celsius=True).collect()}
    rows = [r for r in _rows() if r[0] == "LEGR" and r[8] is not None]
    for m in (1, 2, 3, 4):
        vals = [_py_float(r[8]) for r in rows if r[2] == m]
        assert got[m].n_obs == len(vals)
        assert got[m].mean == pytest.approx((statistics.fmean(vals) - 32) * 5 / 9)


def test_pre_round_is_half_even(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(0.25,), (0.35,), (2.5,), (-0.25,)], "x float")
    got = [r[0] for r in df.select(half_even("x", 1)).collect()]
    assert got == [round(_py_float(v), 1) for v in (0.25, 0.35, 2.5, -0.25)]
    assert df.select(F.bround(F.lit(2.5), 0)).first()[0] == 2.0


def test_year_vs_seasonal_keeps_one_sided_months(spark):
    df = obs_frame(spark, _rows())
    got = {r.month: r for r in climate.year_vs_seasonal(df, "tmpf", 2011, LAT, LON).collect()}
    assert got[4].others_mean is None and got[4].year_mean == 70.0
    assert got[4].others_n == 0 and got[4].year_n == 1


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(2000, 2003), st.integers(1, 12), st.floats(-40, 120, width=32)),
                min_size=1, max_size=40), st.randoms())
def test_seasonal_properties(spark, rows, rnd):
    data = [("S", y, m, 1, 0, 0, 1.0, 2.0, v, 1.0) for y, m, v in rows]
    shuffled = data[:]
    rnd.shuffle(shuffled)
    a = climate.seasonal_mean(obs_frame(spark, data), "tmpf", 1.0, 2.0)
    b = climate.seasonal_mean(obs_frame(spark, shuffled), "tmpf", 1.0, 2.0)
    da = {r.month: (r.n_obs, r.mean) for r in a.collect()}
    db = {r.month: (r.n_obs, r.mean) for r in b.collect()}
    assert da.keys() == db.keys()
    for k in da:
        assert da[k][0] == db[k][0] and da[k][1] == pytest.approx(db[k][1], rel=1e-12, abs=1e-9)
    # count-weighted "other years" and "year" means give the all-years mean
    y = rows[0][0]
    vs = {r.month: r for r in climate.year_vs_seasonal(obs_frame(spark, data), "tmpf", y, 1.0, 2.0).collect()}
    for m, (n, mean) in da.items():
        r = vs[m]
        tot = (r.others_mean or 0) * r.others_n + (r.year_mean or 0) * r.year_n
        assert r.others_n + r.year_n == n
        assert tot / n == pytest.approx(mean, rel=1e-9, abs=1e-6)


def test_historical_stats_and_limit(spark):
    df = obs_frame(spark, _rows())
    full = {(r.year, r.month): r for r in climate.historical_stats(df, "tmpf", LAT, LON).collect()}
    vals = [_py_float(r[8]) for r in _rows() if r[0] == "LEGR" and r[1] == 2010 and r[2] == 1]
    assert full[(2010, 1)].std == pytest.approx(statistics.pstdev(vals))
    # first 5 rows of the position in time order, NULLs dropped after the cut
    lim = climate.historical_stats(df, "tmpf", LAT, LON, limit=5).collect()
    assert sum(r.n_obs for r in lim) == 5
    assert {(r.year, r.month) for r in lim} == {(2010, 1), (2010, 2), (2010, 3)}
    # all positions: same per-position cut through the window form
    allpos = climate.historical_stats(df, "tmpf", limit=5)
    legr = [r for r in allpos.collect() if abs(r.lat - LAT) < 1e-4]
    assert sorted((r.year, r.month, r.n_obs) for r in legr) == sorted((r.year, r.month, r.n_obs) for r in lim)


def test_yearly_series_sorted(spark):
    df = obs_frame(spark, _rows())
    s = {r.year: r.series for r in climate.yearly_series(df, "tmpf", LAT, LON).collect()}
    assert [e.month for e in s[2011]] == [1, 2, 3, 4]
    monthly = {(r.year, r.month): r.mean for r in climate.monthly_mean(df, "tmpf", LAT, LON).collect()}
    assert s[2011][3].value == monthly[(2011, 4)]


def test_seasonal_pair_null_skips(spark):
    rows = [("S", 2011, 1, 1, 0, 0, 1.0, 2.0, 50.0, None), ("S", 2011, 2, 1, 0, 0, 1.0, 2.0, None, 40.0)]
    got = {r.month: r for r in climate.seasonal_pair(obs_frame(spark, rows), "tmpf", "relh", 1.0, 2.0).collect()}
    assert got[1].relh_mean is None and got[1].tmpf_mean == pytest.approx(10.0)
    assert got[2].tmpf_mean is None and got[2].relh_mean == 40.0


def test_unknown_indicator_rejected(spark):
    with pytest.raises(ValueError):
        climate.seasonal_mean(obs_frame(spark, _rows()), "tmpf; drop table", LAT, LON)


def test_f_to_c(spark):
    from pyspark.sql import functions as F
    assert spark.range(1).select(f_to_c(F.lit(212.0))).first()[0] == pytest.approx(100.0)


def test_display_labels_and_celsius_guard(spark):
    from weatherlake.functions.exprs import position_label, year_month_label
    r = spark.createDataFrame([(2011, 9, -3.7894, 37.1897)], "year int, month int, lat double, lon double") \
        .select(year_month_label().alias("ym"), position_label().alias("pos")).first()
    assert (r.ym, r.pos) == ("2011-9", "-3.7894,37.1897")
    with pytest.raises(ValueError):
        climate.seasonal_mean(obs_frame(spark, _rows()), "relh", LAT, LON, to_celsius=True)


def test_plot_order_is_numeric(spark):
    rows = [("S", y, m, 1, 0, 0, 1.0, 2.0, 50.0, 1.0) for y, m in ((2011, 10), (2010, 2), (2011, 9), (2010, 11))]
    got = climate.plot_order(climate.monthly_mean(obs_frame(spark, rows), "tmpf", 1.0, 2.0)).collect()
    assert [(r.year, r.month) for r in got] == [(2010, 2), (2010, 11), (2011, 9), (2011, 10)]


def test_history_limit_tie_break(spark):
    from pyspark.sql import types as T
    # three rows tie on time and station; only the tie-break decides the cut
    rows = [("S", 2011, 1, 1, 0, 0, 1.0, 2.0, float(v), 1.0, k) for k, v in ((3, 30), (1, 10), (2, 20))]
    df = obs_frame(spark, rows, [("k", T.IntegerType())])
    got = climate.historical_stats(df, "tmpf", limit=2, tie_break=["k"]).first()
    assert got.n_obs == 2 and got.mean == pytest.approx(15.0)
