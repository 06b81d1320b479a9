import pytest
from hypothesis import given, settings, strategies as st

from weatherlake import schema
from weatherlake.operators import climate
from weatherlake.operators.upsert import rows_sent_vs_kept, upsert_last, upsert_partial
from weatherlake.sources import layouts
from weatherlake.sources.layouts import (_with_order, insert_by_date, insert_by_position, laid_out, read_layout, write_by_date,
                                        write_by_position)

from obsrows import obs_frame


def _rows():
    # (station, y, m, d, h, mi, lat, lon, tmpf, relh, seq)
    return [
        ("A", 2011, 9, 1, 1, 0, 1.5, 2.5, 50.0, 80.0, 1),
        ("B", 2011, 9, 1, 1, 0, 3.5, 4.5, 60.0, 70.0, 2),   # same minute, other station
        ("A", 2011, 9, 1, 1, 0, 1.5, 2.5, None, 81.0, 3),   # same position key, later, NULL tmpf
        ("A", 2012, 9, 2, 1, 0, 1.5, 2.5, 52.0, None, 4),
        ("B", 2012, 10, 2, 1, 0, 3.5, 4.5, 62.0, 72.0, 5),
    ]


def _frame(spark, rows=None):
    from pyspark.sql import types as T
    return obs_frame(spark, rows or _rows(), extra_cols=[("seq", T.IntegerType())])


def test_upsert_last_null_wins(spark):
    out = upsert_last(_frame(spark), schema.KEY_POSITION, "seq").orderBy("seq").collect()
    assert [r.seq for r in out] == [2, 3, 4, 5]
    assert out[1].tmpf is None and out[1].relh == 81.0


def test_upsert_partial_keeps_earlier(spark):
    out = upsert_partial(_frame(spark), schema.KEY_POSITION, "seq").filter("station='A' and year=2011").first()
    assert out.tmpf == 50.0 and out.relh == 81.0 and out.seq == 3


def test_bare_date_key_loses_same_minute(spark):
    out = upsert_last(_frame(spark), schema.KEY_DATE_BARE, "seq").filter("year=2011").collect()
    assert [r.seq for r in out] == [3]
    both = upsert_last(_frame(spark), schema.KEY_DATE, "seq").filter("year=2011").collect()
    assert sorted(r.seq for r in both) == [2, 3]


def test_rows_sent_vs_kept(spark):
    r = rows_sent_vs_kept(_frame(spark), schema.KEY_POSITION).first()
    assert (r.rows_sent, r.rows_kept) == (5, 4)


def test_missing_order_rejected(spark):
    with pytest.raises(ValueError):
        upsert_last(_frame(spark), schema.KEY_POSITION, [])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 2), st.one_of(st.none(), st.integers(0, 50))),
                min_size=1, max_size=25))
def test_upsert_idempotent_and_matches_python(spark, items):
    rows = [(f"S{k}", 2011, 9, 1, h, 0, 1.0, 2.0, None if v is None else float(v), 1.0, i)
            for i, (k, h, v) in enumerate(items)]
    from pyspark.sql import types as T
    df = obs_frame(spark, rows, extra_cols=[("seq", T.IntegerType())])
    once = upsert_last(df, schema.KEY_DATE_BARE, "seq")
    twice = upsert_last(once, schema.KEY_DATE_BARE, "seq")
    got = sorted(tuple(r) for r in once.collect())
    assert got == sorted(tuple(r) for r in twice.collect())
    expect = {}
    for r in rows:
        expect[r[1:6]] = r
    assert sorted(r.seq for r in once.collect()) == sorted(r[-1] for r in expect.values())


def test_layouts_round_trip_and_agree(spark, tmp_path):
    df = _frame(spark)
    rep_p = write_by_position(df, str(tmp_path / "pos"), "seq")
    rep_d = write_by_date(df, str(tmp_path / "date"), "seq")
    assert (rep_p.rows_sent, rep_p.rows_kept) == (5, 4)
    assert (rep_d.rows_sent, rep_d.rows_kept) == (5, 4)
    pos, date = read_layout(spark, str(tmp_path / "pos")), read_layout(spark, str(tmp_path / "date"))
    assert pos.columns[:6] == ["station", "year", "month", "day", "hour", "minute"]
    assert date.columns == pos.columns
    a = sorted(tuple(r) for r in climate.seasonal_mean(pos, "relh").collect())
    b = sorted(tuple(r) for r in climate.seasonal_mean(date, "relh").collect())
    assert a == b and len(a) == 3
    assert (tmp_path / "date" / "year=2011" / "month=9").is_dir()


def test_by_date_scan_prunes_partitions(spark, tmp_path):
    write_by_date(_frame(spark), str(tmp_path / "d"), "seq")
    from weatherlake.sources.scan import at_minute
    plan = at_minute(read_layout(spark, str(tmp_path / "d")), 2012, 10, 2)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters" in plan and "isnotnull(year" in plan and "(month" in plan


def test_write_layouts_one_pass(spark, tmp_path):
    from weatherlake.sources.layouts import write_layouts
    df = _frame(spark)
    rp, rd = write_layouts(df, str(tmp_path / "p"), str(tmp_path / "d"), "seq")
    assert (rp.rows_sent, rp.rows_kept) == (5, 4) and (rd.rows_sent, rd.rows_kept) == (5, 4)
    pos, date = read_layout(spark, str(tmp_path / "p")), read_layout(spark, str(tmp_path / "d"))
    assert sorted(tuple(r) for r in pos.collect()) == sorted(tuple(r) for r in date.collect())
    # the bare time key collapses same-minute stations, last write winning
    _, bare = write_layouts(df, str(tmp_path / "p2"), str(tmp_path / "d2"), "seq", date_key=schema.KEY_DATE_BARE)
    assert bare.rows_kept == 3
    kept = read_layout(spark, str(tmp_path / "d2")).filter("year = 2011").collect()
    assert [r.seq for r in kept] == [3]


def test_merge_into_stored_rows(spark, tmp_path):
    old, new = _rows()[:2] + _rows()[3:], [_rows()[2], ("C", 2013, 1, 1, 0, 0, 5.5, 6.5, 1.0, 1.0, 1)]
    for k, (write, suffix) in enumerate([(write_by_position, "p"), (write_by_date, "d")]):
        a, b = str(tmp_path / f"{suffix}a"), str(tmp_path / f"{suffix}b")
        write(_frame(spark, old), a, "seq")
        rep = write(_frame(spark, new), b, "seq", existing=read_layout(spark, a))
        assert (rep.rows_sent, rep.rows_kept) == (2, 5)
        got = read_layout(spark, b)
        assert got.groupBy(*schema.KEY_POSITION).count().filter("count > 1").count() == 0
        assert sorted(r.seq for r in got.collect()) == [1, 2, 3, 4, 5]  # the later row replaced the first
        assert got.filter("station = 'A' and year = 2011").first().tmpf is None
    with pytest.raises(ValueError):
        write_by_position(_frame(spark), str(tmp_path / "x"), None, existing=read_layout(spark, a))


def test_one_exchange_per_write_and_34_columns(spark, tmp_path):
    from weatherlake.sources.metar_csv import read_metar
    f = tmp_path / "a.csv"
    header = ",".join(schema.RAW_COLUMNS)
    f.write_text(header + "\n" + "\n".join(
        ",".join(["S1", f"2011-01-01 00:0{k}", "1.0", "2.0"] + ["1"] * (len(schema.RAW_COLUMNS) - 4)) for k in range(5)) + "\n")
    obs = read_metar(spark, str(f), strict=False)
    write_by_position(obs, str(tmp_path / "p"), partitions=2)
    assert spark.read.parquet(str(tmp_path / "p")).columns == list(schema.OBS_COLUMNS)
    for key, layout, directories in ((schema.KEY_POSITION, schema.KEY_POSITION, ()), (schema.KEY_DATE, schema.KEY_DATE, ("year", "month"))):
        out = laid_out(_with_order(obs, "_seq", None), key, layout, directories, unique=False, partitions=2)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1 and plan.count("Exchange rangepartitioning") == 1


def test_files_hold_disjoint_bands(spark, tmp_path):
    from pyspark.sql import functions as F
    obs = spark.range(0, 6000).select(
        F.concat(F.lit("S"), F.col("id") % 70).alias("station"), F.lit(2011).alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month"),
        (F.col("id") % 28 + 1).cast("int").alias("day"), (F.col("id") % 24).cast("int").alias("hour"), (F.col("id") % 60).cast("int").alias("minute"),
        (F.col("id") % 10 - 5.00000003).cast("float").alias("lat"), (F.col("id") % 7 + 0.5).cast("float").alias("lon"),
        F.lit(1.0).cast("float").alias("tmpf"), F.col("id").alias("seq"))
    write_by_position(obs, str(tmp_path / "p"), "seq", partitions=8)
    bands = (spark.read.parquet(str(tmp_path / "p")).groupBy(F.input_file_name().alias("f"))
             .agg(F.min(F.struct(*schema.KEY_POSITION)).alias("lo"), F.max(F.struct(*schema.KEY_POSITION)).alias("hi"),
                  F.count_distinct("lat", "lon").alias("n")).orderBy("lo").collect())
    assert len(bands) == 8 and all(a.hi < b.lo for a, b in zip(bands, bands[1:])) and max(b.n for b in bands) < 20


def test_close_positions_are_told_apart(spark, tmp_path):
    # all of these share a fixed-point value, two share the position; NaN and infinite ones are kept too
    rows = [(f"S{k}", 2011, 1, 1, 0, 0, lat, 0.0, float(k), None, k)
            for k, lat in enumerate([1e-9, 2e-9, 2e-9, 0.0, -0.0, float("nan"), float("inf"), 1e30])]
    rep = write_by_position(_frame(spark, rows), str(tmp_path / "p"), "seq", partitions=2)
    assert (rep.rows_sent, rep.rows_kept) == (8, 6)
    assert sorted(r.seq for r in read_layout(spark, str(tmp_path / "p")).collect()) == [0, 2, 4, 5, 6, 7]


def _files(folder):
    import os
    return {os.path.relpath(os.path.join(d, f), folder): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


@pytest.mark.parametrize("kind", ["date", "position"])
def test_insert_rewrites_only_what_it_touches(spark, tmp_path, kind):
    path = str(tmp_path / kind)
    rows = [(s, y, m, 1, 0, 0, lat, 2.5, 50.0, 80.0, k) for k, (s, y, m, lat) in enumerate(
        (s, y, m, lat) for s, lat in (("A", 1.5), ("B", -3.5)) for y in (2010, 2011) for m in (1, 2))]
    if kind == "date":
        write_by_date(_frame(spark, rows), path, "seq")
        insert, touched = insert_by_date, "year=2011/month=2/"
    else:
        write_by_position(_frame(spark, rows), path, "seq", directories=True)
        insert, touched = insert_by_position, "stripe=1/year=2011/"
    before = _files(path)
    # one row replaces (A, 2011, 2), with a NULL cell; one is new; the first has an older copy beside it
    new = [("A", 2011, 2, 1, 0, 0, 1.5, 2.5, 1.0, 1.0, 100), ("A", 2011, 2, 1, 0, 0, 1.5, 2.5, None, 81.0, 101),
           ("C", 2011, 2, 9, 0, 0, 1.25, 7.0, 60.0, None, 102)]
    rep = insert(_frame(spark, new), path, "seq")
    assert rep.rows_sent == 3
    after = _files(path)
    assert {f: t for f, t in before.items() if not f.startswith(touched)} == {f: t for f, t in after.items() if not f.startswith(touched)}
    assert not {f for f in before if f.startswith(touched)} & set(after)
    got = {(r.station, r.year, r.month, r.day): (r.tmpf, r.relh) for r in read_layout(spark, path).collect()}
    want = {(r[0], r[1], r[2], r[3]): (r[8], r[9]) for r in rows} | {("A", 2011, 2, 1): (None, 81.0), ("C", 2011, 2, 9): (60.0, None)}
    assert got == want and read_layout(spark, path).count() == len(want)
    insert(_frame(spark, new).limit(0), path, "seq")
    assert _files(path) == after
    with pytest.raises(ValueError):
        insert(_frame(spark, new), path, None)


def test_hot_position_is_split_across_files(spark, tmp_path):
    from pyspark.sql import functions as F
    # one position holds 90% of the rows: the range layout on (position, time)
    # spreads it over several files instead of one task
    hot = spark.range(0, 900).select(
        F.lit("H").alias("station"), F.lit(2011).alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month"),
        (F.col("id") % 28 + 1).cast("int").alias("day"), (F.col("id") % 24).cast("int").alias("hour"),
        (F.col("id") % 60).cast("int").alias("minute"), F.lit(1.5).cast("float").alias("lat"),
        F.lit(2.5).cast("float").alias("lon"), F.lit(50.0).cast("float").alias("tmpf"),
        F.lit(80.0).cast("float").alias("relh"), F.col("id").cast("int").alias("seq"))
    cold = hot.limit(100).withColumn("station", F.lit("C")).withColumn("lat", F.lit(3.5).cast("float"))
    write_by_position(hot.unionByName(cold), str(tmp_path / "p"), "seq", partitions=4)
    files = (read_layout(spark, str(tmp_path / "p")).filter("station = 'H'")
             .select(F.input_file_name().alias("f")).distinct().count())
    assert files >= 3


@pytest.mark.parametrize("hot_rows", [1, 20, 10_000])
def test_partial_upsert_of_hot_keys(spark, hot_rows):
    import random
    r = random.Random(7)
    value = lambda: r.choice([None, float(r.randint(0, 9))])
    rows = [("H" if i % 3 else f"S{i % 40}", 2011, 9, 1, 1, 0 if i % 3 else i % 2, 1.5, None if i % 5 else 2.5, value(), value() if i < 50 else None, i)
            for i in range(600)]
    r.shuffle(rows)
    out = upsert_partial(_frame(spark, rows).repartition(5), schema.KEY_POSITION, "seq", hot_rows=hot_rows)
    want = {}
    for row in sorted(rows, key=lambda x: x[-1]):
        key = row[6:8] + row[1:6]
        old = want.get(key, (None,) * len(row))
        want[key] = tuple(o if n is None else n for o, n in zip(old, row))
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want.values()))
    assert out.columns == _frame(spark, rows).columns


def test_partitions_grow_with_the_table(spark):
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    obs = spark.range(1000)
    assert layouts.partitions_for(obs, 16) == 16
    assert layouts.partitions_for(obs, 16, rows_each=30) == 34
    assert layouts.partitions_for(obs) is None
    assert layouts.partitions_for(obs, rows_each=1000 // session) is None
    assert layouts.partitions_for(obs, rows_each=10) == 100
    assert layouts.partitions_for(obs.limit(0), 16) == 16
