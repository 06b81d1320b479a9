import pytest

from weatherlake.operators.snapshot import snapshot, snapshot_all, snapshot_all_text

from obsrows import obs_frame


def _df(spark):
    from pyspark.sql import types as T
    rows = [("A", 2011, 9, 1, 1, 0, 1.0, 2.0, 50.125, 80.0, "FEW", None),
            ("B", 2011, 9, 1, 1, 0, 3.0, 4.0, None, 70.0, None, "RA"),
            ("C", 2011, 9, 1, 2, 0, 5.0, 6.0, 55.0, 60.0, "SCT", None)]
    return obs_frame(spark, rows, [("skyc1", T.StringType()), ("wxcodes", T.StringType())])


def test_snapshot_numeric_rounds_and_skips_null(spark):
    got = snapshot(_df(spark), "tmpf", 2011, 9, 1, 1, 0).collect()
    assert [(r.station, r.value) for r in got] == [("A", 50.12)]    # half-even


def test_snapshot_text(spark):
    got = snapshot(_df(spark), "skyc1", 2011, 9, 1, 1, 0).collect()
    assert [(r.station, r.value) for r in got] == [("A", "FEW")]


def test_snapshot_all_one_scan_long_form(spark):
    df = _df(spark)
    got = sorted((r.station, r.indicator, r.value) for r in snapshot_all(df, 2011, 9, 1, 1, 0).collect())
    assert got == [("A", "relh", 80.0), ("A", "tmpf", 50.12), ("B", "relh", 70.0)]
    text = sorted((r.station, r.indicator, r.value) for r in snapshot_all_text(df, 2011, 9, 1, 1, 0).collect())
    assert text == [("A", "skyc1", "FEW"), ("B", "wxcodes", "RA")]
    with pytest.raises(ValueError):
        snapshot_all(df, 2011, 9, 1, indicators=["peak_wind_time"])
