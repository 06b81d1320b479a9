import pytest

from weatherlake import schema
from weatherlake.sources import pruning, scan
from weatherlake.sources.layouts import insert_by_date, insert_by_position, read_layout, write_by_date, write_by_position

from obsrows import obs_frame


def _obs(spark, n=3000):
    from pyspark.sql import types as T
    rows = [(f"S{i % 30}", 2010 + i % 2, i % 3 + 1, i % 28 + 1, i % 24, i % 60, float(i % 10) - 4.5, float(i % 7), float(i), None, i) for i in range(n)]
    return obs_frame(spark, rows, extra_cols=[("seq", T.IntegerType())])


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("kind", ["flat", "striped", "date"])
def test_scans_read_few_files_and_lose_nothing(spark, tmp_path, kind):
    path = str(tmp_path / kind)
    if kind == "date":
        write_by_date(_obs(spark), path, "seq", partitions=12)
    else:
        write_by_position(_obs(spark), path, "seq", directories=kind == "striped", partitions=12)
    plain = read_layout(spark, path)
    total = len(plain.inputFiles())
    assert pruning.write_statistics(spark, path) == total and pruning.write_statistics(spark, path) == 0
    assert sorted(spark.read.parquet(path).inputFiles()) == sorted(plain.inputFiles())  # the table itself is as it was
    if kind == "date":
        got = pruning.by_day_range(spark, path, 2011, 2, 3, 5)
        assert 0 < len(got.inputFiles()) <= total // 4
        assert _rows(got) == _rows(scan.by_day_range(plain, 2011, 2, 3, 5)) and got.count() > 0
        one = plain.first()
        at = (one.year, one.month, one.day, one.hour, one.minute)
        assert _rows(pruning.at_minute(spark, path, *at)) == _rows(scan.at_minute(plain, *at))
        assert pruning.by_day_range(spark, path, 1900, 1).collect() == []
    else:
        got = pruning.by_position(spark, path, -1.5, 3.0, ["tmpf", "station"])
        assert 0 < len(got.inputFiles()) <= total // 3
        assert _rows(got) == _rows(scan.by_position(plain, -1.5, 3.0, ["tmpf", "station"])) and got.count() > 0
        assert pruning.by_position(spark, path, 80.0, 3.0).collect() == []


@pytest.mark.parametrize("kind", ["striped", "date"])
def test_files_it_does_not_list_are_read(spark, tmp_path, kind):
    from pyspark.sql import types as T
    path = str(tmp_path / kind)
    write, insert = (write_by_date, insert_by_date) if kind == "date" else (lambda *a: write_by_position(*a, directories=True), insert_by_position)
    write(_obs(spark, 600), path, "seq")
    read = lambda: _rows(pruning.by_position(spark, path, -1.5, 3.0, "tmpf") if kind == "striped"
                         else pruning.by_day_range(spark, path, 2011, 2, 2, 4, ["tmpf", "seq"]))
    assert pruning.files_with(spark, path, {}) == read_layout(spark, path).inputFiles()
    pruning.write_statistics(spark, path)
    before = read()
    more = obs_frame(spark, [("N", 2011, 2, 3, 0, 0, -1.5, 3.0, -7.0, None, 9999)], extra_cols=[("seq", T.IntegerType())])
    insert(more, path, "seq")
    after = read()
    assert len(after) == len(before) + 1 and (2011, 2, -7.0) in after or (-7.0, 9999) in after
    assert pruning.write_statistics(spark, path) > 0 and read() == after
    assert pruning.statistics(spark, path).count() == len(read_layout(spark, path).inputFiles())
    assert set(pruning.statistics(spark, path, ["lat"]).columns) == {"file", "rows", "lat_min", "lat_max"}


def test_statistics_of_null_and_nan(spark, tmp_path):
    rows = [("A", 2011, 1, 1, 0, 0, float("nan"), 1.0, 1.0, None), ("B", 2011, 1, 1, 0, 0, 2.0, None, 1.0, None), ("C", 2011, 1, 1, 0, 0, 3.0, 1.0, 1.0, None)]
    path = str(tmp_path / "p")
    write_by_position(obs_frame(spark, rows), path, None, key=schema.KEY_POSITION, partitions=1)
    pruning.write_statistics(spark, path)
    assert [r.year for r in pruning.by_position(spark, path, 3.0, 1.0).collect()] == [2011]


def test_names_are_cut_out_per_file(spark, tmp_path):
    """The rows are grouped by the path as it is; the regex sees one path per file."""
    path = str(tmp_path / "t")
    spark.range(20).selectExpr("cast(id as float) as lat").repartition(4).write.parquet(path)
    df = pruning.statistics(spark, path, ["lat"])
    rows = df.collect()
    assert sum(r["rows"] for r in rows) == 20 and all("/" not in r["file"] for r in rows)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    result, below = plan.split("\n", 1)
    assert result.startswith("Aggregate") and "regexp_extract" in result and "regexp_extract" not in below
