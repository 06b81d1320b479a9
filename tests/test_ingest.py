import datetime as dt
import pytest
from pyspark.errors import PySparkException

from weatherlake import schema
from weatherlake.operators.upsert import upsert_last, upsert_partial
from weatherlake.sources import fixtures as fx, metar_csv
from weatherlake.sources.metar_csv import metar_rejects, parse_metar, read_metar, read_raw

HEADER = "valid,station,lon,lat,tmpf,skyc1,peak_wind_time,relh"
ROWS = [
    "2011-09-01 01:00,AAA,37.1,-3.7,50.0,FEW,2011-09-01 00:50,80",   # normal
    "2011-09-01 01:30:59,AAA,37.1,-3.7,null,\t,null,81",              # seconds, null tokens
    "2011-9-1 1:5,BBB,37.5,-3.9,,,,",                                # unpadded, empty cells
    "bad,CCC,37.5,-3.9,60,,,",                                       # bad timestamp
    "2011-09-02 02:00,DDD,37.5,-3.9",                                # short row
    "2011-09-01 01:00,AAA,37.1,-3.7,51.0,SCT,,",                     # same key again, later
]


@pytest.fixture()
def csv_dir(tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    (d / "a.csv").write_text(HEADER + "\n" + "\n".join(ROWS) + "\n")
    return str(d)


def test_parse_cases(spark, csv_dir):
    df = read_metar(spark, csv_dir)
    assert set(df.columns) >= set(schema.OBS_COLUMNS)
    rows = df.drop("_seq").collect()
    assert len(rows) == 5
    a0 = next(r for r in rows if r.station == "AAA" and r.skyc1 == "FEW")
    a1 = next(r for r in rows if r.station == "AAA" and r.minute == 30)
    b = next(r for r in rows if r.station == "BBB")
    d = next(r for r in rows if r.station == "DDD")
    assert (a0.year, a0.month, a0.day, a0.hour, a0.minute) == (2011, 9, 1, 1, 0)
    assert a1.minute == 30 and a1.tmpf is None and a1.skyc1 is None and a1.peak_wind_time is None
    assert b.month == 9 and b.day == 1 and b.hour == 1 and b.minute == 5
    assert b.tmpf is None and b.skyc1 is None           # empty cells are NULL
    assert d.tmpf is None and d.relh is None            # short row
    assert a0.lat == pytest.approx(-3.7) and a0.lon == pytest.approx(37.1)
    assert a0.peak_wind_time is not None


def test_peak_wind_time_is_utc(spark, csv_dir):
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        micros = read_metar(spark, csv_dir).filter("skyc1 = 'FEW'").select(
            F.unix_micros("peak_wind_time")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    expected = dt.datetime(2011, 9, 1, 0, 50, tzinfo=dt.timezone.utc).timestamp() * 1_000_000
    assert micros == expected


def test_rejects(spark, csv_dir):
    rej = metar_rejects(read_raw(spark, csv_dir)).collect()
    assert [(r.station, r.reject_reason) for r in rej] == [("CCC", "bad timestamp")]


def test_strict_raises_on_non_number(spark, tmp_path):
    d = tmp_path / "m"
    d.mkdir()
    (d / "x.csv").write_text("station,valid,lat,lon,tmpf\nA,2011-09-01 01:00,1,2,M\n")
    with pytest.raises(PySparkException, match="unparsable METAR row .* at station A, valid 2011-09-01 01:00"):
        read_metar(spark, str(d), strict=True).collect()
    r = read_metar(spark, str(d), strict=False).first()
    assert r.tmpf is None


def test_null_position(spark, tmp_path):
    d = tmp_path / "p"
    d.mkdir()
    (d / "x.csv").write_text("station,valid,lat,lon,tmpf\nA,2011-09-01 01:00,null,2,3\nB,2011-09-01 01:00,1,2,3\n")
    with pytest.raises(PySparkException, match="NULL position or bad number. at station A"):
        read_metar(spark, str(d), strict=True).collect()
    assert [r.station for r in read_metar(spark, str(d), strict=False).collect()] == ["B"]
    rej = metar_rejects(read_raw(spark, str(d)), strict=False).collect()
    assert [(r.station, r.reject_reason) for r in rej] == [("A", "null position")]


def test_valid_struct_and_metar(spark, tmp_path):
    d = tmp_path / "v"
    d.mkdir()
    (d / "x.csv").write_text("station,valid,lat,lon,metar\nA,2011-09-01 01:07,1,2,LEGR 010107Z\n")
    r = read_metar(spark, str(d), valid_struct=True).first()
    assert tuple(r.valid) == (2011, 9, 1, 1, 7)
    assert r.metar == "LEGR 010107Z"


def test_file_order_last_write_wins(spark, csv_dir):
    obs = read_metar(spark, csv_dir)
    last = upsert_last(obs, schema.KEY_POSITION, "_seq").filter("station = 'AAA' and minute = 0").first()
    assert last.tmpf == pytest.approx(51.0) and last.skyc1 == "SCT"
    assert last.peak_wind_time is None                  # NULL replaces the earlier value
    part = upsert_partial(obs.withColumnRenamed("_seq", "_o"), schema.KEY_POSITION, "_o") \
        .filter("station = 'AAA' and minute = 0").first()
    assert part.tmpf == pytest.approx(51.0) and part.peak_wind_time is not None


def test_load_limit_takes_file_order(spark, csv_dir):
    raw = read_raw(spark, csv_dir, limit=2)
    assert [r.station for r in raw.orderBy("_seq").collect()] == ["AAA", "AAA"]


def test_column_order_free(spark, tmp_path):
    d = tmp_path / "o"
    d.mkdir()
    (d / "x.csv").write_text("tmpf,lon,valid,lat,station\n5,2,2011-09-01 01:00,1,A\n")
    r = read_metar(spark, str(d)).first()
    assert (r.station, r.lat, r.lon, r.tmpf) == ("A", 1.0, 2.0, 5.0)


def _write(path, text):
    path.write_text(text)
    return str(path)


def test_strict_holds_under_column_pruning(spark, tmp_path):
    f = _write(tmp_path / "a.csv", "station,valid,lat,lon,tmpf,relh\nS1,2011-01-01 00:00,,2,M,5\nS2,2011-01-01 00:01,1,2,3,5\n")
    df = read_metar(spark, f, strict=True)
    for columns in (["tmpf"], ["year", "month"], ["lat"], ["minute"], df.columns):
        with pytest.raises(Exception, match="unparsable METAR row"):
            df.select(*columns).collect()
    from weatherlake.operators import climate
    with pytest.raises(Exception, match="unparsable METAR row"):
        climate.seasonal_mean(df, "relh").collect()
    assert [r.relh for r in df.select("relh").collect()] == [5.0, 5.0]  # this column's own cells are fine
    assert df.count() == 2  # reads no column


def test_columns_by_name_across_files(spark, tmp_path):
    a = _write(tmp_path / "a.csv", "station,valid,lat,lon,tmpf,relh\nA,2011-01-01 00:00,1,2,50,99\n")
    b = _write(tmp_path / "b.csv", "station,valid,lat,lon,relh,tmpf\nB,2011-01-01 00:00,1,2,99,50\n")
    c = _write(tmp_path / "c.csv", "station,valid,lat,lon,tmpf\nC,2011-01-01 00:00,1,2,50\n")
    got = {r.station: (r.tmpf, r.relh) for r in read_metar(spark, [a, b, c]).collect()}
    assert got == {"A": (50.0, 99.0), "B": (50.0, 99.0), "C": (50.0, None)}
    with pytest.raises(Exception):
        read_metar(spark, str(tmp_path)).collect()  # one folder, differing headers


def test_quoting(spark, tmp_path):
    f = _write(tmp_path / "a.csv", 'station,valid,lat,lon,wxcodes,tmpf\n"a ""b"", c",2011-01-01 00:00,1,2,"x\\",7\n')
    r = read_metar(spark, f).first()
    assert (r.station, r.wxcodes, r.tmpf) == ('a "b", c', "x\\", 7.0)


def test_later_path_wins(spark, tmp_path):
    from weatherlake import schema
    from weatherlake.operators.upsert import upsert_last
    z = _write(tmp_path / "z.csv", "station,valid,lat,lon,tmpf\nA,2011-01-01 00:00,1,2,10\n")
    a = _write(tmp_path / "a.csv", "station,valid,lat,lon,tmpf\nA,2011-01-01 00:00,1,2,20\n")
    assert upsert_last(read_metar(spark, [z, a]), schema.KEY_POSITION, "_seq").first().tmpf == 20.0
    assert upsert_last(read_metar(spark, [a, z]), schema.KEY_POSITION, "_seq").first().tmpf == 10.0
    assert [r.tmpf for r in read_metar(spark, [z, a], limit=1).collect()] == [10.0]


def test_lenient_rejects_what_has_no_value(spark, tmp_path):
    f = _write(tmp_path / "a.csv", "station,valid,lat,lon,tmpf\nA,99999999999-01-01 00:00,1,2,1\nB,2011-01-01 00:00,1,null,1\n"
               "C,bad,1,2,1\nD,2011-01-01 00:00,1,2,1.5d\nE,2011-01-01 00:00,1,2,inf\nF,2011-01-01 00:00,1,2, 2.5 \n")
    raw = read_raw(spark, f)
    got = {r.station: r.tmpf for r in parse_metar(raw, strict=False).collect()}
    assert got == {"D": None, "E": float("inf"), "F": 2.5}
    reasons = {r.station: r.reject_reason for r in metar_rejects(raw, strict=False).collect()}
    assert reasons == {"A": "bad timestamp", "B": "null position", "C": "bad timestamp"}
    with pytest.raises(Exception, match="unparsable METAR row"):
        parse_metar(raw, strict=True).select("day").collect()


def _many(folder, n, rows=1):
    """``n`` files in two column orders; file k reports k."""
    folder.mkdir()
    return [_write(folder / f"{'ab'[k % 2]} {k:04d}.csv",
                   (f"station,valid,lat,lon,tmpf\nS,2011-01-01 00:00,1,2,{k}\n" if k % 2 else f"tmpf,lon,lat,valid,station\n{k},2,1,2011-01-01 00:00,S\n")
                   + "".join(f"S,2011-01-01 00:{i:02d},1,2,{k}\n" if k % 2 else f"{k},2,1,2011-01-01 00:{i:02d},S\n" for i in range(1, rows)))
            for k in range(n)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_scan_for_each_header(spark, tmp_path):
    paths = _many(tmp_path / "many", 300)
    raw = read_raw(spark, paths[::-1])
    assert _plan(raw).count("FileScan csv") == 2
    assert sorted(float(r.tmpf) for r in raw.collect()) == list(range(300))
    # the last path in the caller's list wins, whatever the file names are
    assert upsert_last(read_metar(spark, paths), schema.KEY_POSITION, "_seq").first().tmpf == 299
    assert upsert_last(read_metar(spark, paths[::-1]), schema.KEY_POSITION, "_seq").first().tmpf == 0


def test_paths_of_every_kind(spark, tmp_path):
    one = _many(tmp_path / "one+a b%20", 4)
    two = tmp_path / "two"
    two.mkdir()
    for k in range(3):
        _write(two / f"{k}.csv", f"station,valid,lat,lon,tmpf\nS,2011-01-01 00:00,1,2,{100 + k}\n")
    _write(two / "empty.csv", "")
    got = read_metar(spark, [str(two), f"file://{one[1]}", one[0], one[2]])
    assert sorted(r.tmpf for r in got.collect()) == [0, 1, 2, 100, 101, 102]
    assert [r.tmpf for r in got.orderBy("_seq").collect()] == [100, 101, 102, 1, 0, 2]
    assert sorted(r.tmpf for r in read_metar(spark, [str(two / "*.csv"), one[0]]).collect()) == [0, 100, 101, 102]
    with pytest.raises(ValueError, match="different headers"):
        read_raw(spark, [str(tmp_path / "one+a b%20"), str(two)])


@pytest.mark.parametrize("limit", [1, 5, 25, 100])
def test_a_limit_reads_the_first_files_only(spark, tmp_path, limit):
    paths = _many(tmp_path / "many", 40, rows=10)
    raw = read_raw(spark, paths, limit=limit)
    assert [(float(r.tmpf), r.valid[-2:]) for r in raw.orderBy("_seq").collect()] == [(k // 10, f"{k % 10:02d}") for k in range(limit)]
    folder = tmp_path / "same"
    folder.mkdir()
    for k in range(200):
        _write(folder / f"{k:03d}.csv", "station,valid,lat,lon,tmpf\n" + f"S,2011-01-01 00:00,1,2,{k}\n" * 40)
    spark.sparkContext.setJobGroup(f"limit {limit}", "first rows")
    raw = read_raw(spark, str(folder), limit=limit)
    assert sorted(float(r.tmpf) for r in raw.collect()) == [k // 40 for k in range(limit)]
    # what is read is at most the files of the last step, not the folder
    tracker, tasks = spark.sparkContext.statusTracker(), 0
    for job in tracker.getJobIdsForGroup(f"limit {limit}"):
        for stage in tracker.getJobInfo(job).stageIds:
            info = tracker.getStageInfo(stage)
            tasks += info.numTasks if info else 0
    assert tasks < 40


def test_a_limit_beyond_the_end(spark, tmp_path):
    paths = _many(tmp_path / "many", 3)
    assert read_raw(spark, paths, limit=50).count() == 3 and read_raw(spark, paths[:1], limit=0).count() == 0


def test_the_strict_message_names_what_is_wrong(spark, tmp_path):
    f = _write(tmp_path / "a.csv", "station,valid,lat,lon,tmpf\nA,99999999999-01-01 00:00,1,2,1\n")
    with pytest.raises(PySparkException, match="bad timestamp. at station A"):
        read_metar(spark, f).collect()
    f = _write(tmp_path / "b.csv", "station,valid,lat,lon,tmpf\nA,2011-01-01 00:00,1,2,x\n")
    with pytest.raises(PySparkException, match="bad value of tmpf. at station A"):
        read_metar(spark, f).collect()


def test_wide_parse_asks_for_methods_that_the_jvm_compiles(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    raw = spark.createDataFrame([("S1", "1998-09-01 10:30", "1.5", "2.5", "null")], "station string, valid string, lat string, lon string, tmpf string")
    for call in (parse_metar, metar_rejects):
        spark.conf.set(key, "65535")
        call(raw)
        assert spark.conf.get(key) == "8000"
        spark.conf.set(key, "4000")  # lower settings are kept
        call(raw)
        assert spark.conf.get(key) == "4000"
    spark.conf.unset(key)


def test_text_cells_made_behind_an_exchange_are_the_same(spark, tmp_path):
    rows = spark.range(40).selectExpr(
        "id as l_orderkey", "id * 3 as l_partkey", "cast(id % 7 as int) as l_linenumber", "id % 10 as l_suppkey",
        "date_add(date'1995-01-01', cast(id * 37 as int)) as l_shipdate", "cast(id as double) as l_quantity", "id * 10.0D as l_extendedprice",
        "cast(id % 8 as double) / 100 as l_discount", "cast(id % 6 as double) / 100 as l_tax", "'N' as l_returnflag")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    sf = str(tmp_path)
    moved = fx.raw_cells(fx.observations(spark, sf).repartitionByRange(5, "l_orderkey"))
    assert sorted(map(str, moved.collect())) == sorted(map(str, fx.raw_observations(spark, sf).collect()))


def test_headers_are_read_without_python_workers(spark, tmp_path, monkeypatch):
    for k, head in enumerate(("a,b", "b,a", "a,b")):
        (tmp_path / f"{k}.csv").write_text(head + "\n" + "1,2\n" * 500)

    def no_workers(*_, **__):
        raise AssertionError("lines go to Python")

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", no_workers)
    found = metar_csv.headers(spark, [str(tmp_path)])
    assert [r["file"].rpartition("/")[2] for r in found] == ["0.csv", "1.csv", "2.csv"]
    assert [r["header"] for r in found] == ["a,b", "b,a", "a,b"]


def test_number_suffixes(spark, tmp_path):
    raw = spark.createDataFrame([(x,) for x in ("1.5d", "1.5F", "inf", "-Infinity", "1e3", "null", "", "0.5f")], "x string")
    got = [r[0] for r in raw.select(metar_csv._number(raw.x)).collect()]
    assert got == [None, None, float("inf"), float("-inf"), 1000.0, None, None, None]


def test_first_rows_of_a_folder_put_in_order_as_narrow_rows(spark, tmp_path, monkeypatch):
    import random

    from weatherlake.plans import stores

    r = random.Random(3)
    rows = [(r.choice([None, *range(1, 90)]), r.randint(1, 40), r.randint(1, 9), k % 7 + 1, float(r.randint(1, 50)), r.choice([1.5, 2.5]), 0.04, 0.01,
             r.choice("ANR"), "O", dt.datetime(1998, 9, 1 + k % 28)) for k in range(900)]
    rows += rows[:30]
    r.shuffle(rows)
    lines = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                  "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    lines.repartition(5).write.parquet(str(tmp_path / "sf" / "lineitem.parquet"))
    folder = tmp_path / "csv"
    monkeypatch.setattr(stores, "shared_folder", lambda *_: str(folder))
    got = stores.q_csv_first_rows(spark, str(tmp_path / "sf")).collect()
    kept = sorted((x[0], x[3], x[1], x[5], f"S{x[2]}") for x in rows if x[0] is not None and x[0] % 17)
    assert sorted((x.l_orderkey, x.hour, x.station) for x in got) == sorted((x[0], x[1], x[4]) for x in kept[:100])
    # the whole table is there, in order, in less room than its text
    text = spark.read.text(str(folder))
    table = spark.read.option("header", True).option("escape", '"').csv(str(folder))
    assert table.count() == len(kept)
    assert sum(f.stat().st_size for f in folder.glob("part-*")) < sum(len(x.value) + 1 for x in text.collect()) / 2
    exchange = stores._cells_in_order(fx.table(spark, str(tmp_path / "sf"), "lineitem")).select(*schema.RAW_COLUMNS, "l_orderkey")
    plan = exchange._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "RepartitionByExpression":
        plan = plan.children().head()
    assert plan.output().size() <= 11
