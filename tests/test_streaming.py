import os

from weatherlake import schema
from weatherlake.streaming.ingest import read_current, start_ingest

COLS = ("station", "valid", "lat", "lon", "tmpf", "relh")


def _write(path, rows):
    with open(path, "w") as f:
        f.write(",".join(COLS) + "\n" + "\n".join(rows) + "\n")


def test_stream_ingest_upserts_across_batches(spark, tmp_path):
    src, table, ckpt = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "ckpt")
    src.mkdir()
    _write(src / "a.csv", ["A,2011-09-01 01:00,1.5,2.5,50,80",
                           "A,2011-09-01 01:00,1.5,2.5,51,81",        # same key, later in file
                           "B,2011-09-01 01:00,3.5,4.5,60,70",
                           "C,bad,3.5,4.5,60,70"])
    q = start_ingest(spark, str(src), table, ckpt, columns=COLS, max_files_per_trigger=1)
    q.awaitTermination(120)
    _write(src / "b.csv", ["A,2011-09-01 01:00,1.5,2.5,null,82",        # next batch overwrites, NULL included
                           "D,2011-10-01 00:00,5.5,6.5,40,30"])
    q = start_ingest(spark, str(src), table, ckpt, columns=COLS, max_files_per_trigger=1)
    q.awaitTermination(120)
    cur = {r.station: r for r in read_current(spark, table).collect()}
    assert set(cur) == {"A", "B", "D"}
    assert cur["A"].tmpf is None and cur["A"].relh == 82.0
    assert cur["D"].month == 10
    assert read_current(spark, table).columns == [c for c in schema.OBS_COLUMNS]
    assert os.path.isdir(os.path.join(table, "year=2011", "month=9"))


def test_replayed_batch_is_harmless(spark, tmp_path):
    src, table = tmp_path / "in", str(tmp_path / "table")
    src.mkdir()
    _write(src / "a.csv", ["A,2011-09-01 01:00,1.5,2.5,50,80"])
    for run in ("c1", "c2"):          # a fresh checkpoint replays the same file as batch 0
        start_ingest(spark, str(src), table, str(tmp_path / run), columns=COLS).awaitTermination(120)
    rows = read_current(spark, table).collect()
    assert len(rows) == 1 and rows[0].tmpf == 50.0
