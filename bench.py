"""Benchmark: every registered query at ``$BENCH_SF_DIR`` on
``local[$BENCH_CPUS]``, plus the CSV ingest into both stored layouts and
scans served from those layouts.

Each query runs once to warm up, then three times (once if it writes tables); the median is reported.
A run executes the whole plan through the ``noop`` sink (nothing is
collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from weatherlake import schema  # noqa: E402
from weatherlake.operators import climate, snapshot  # noqa: E402
from weatherlake.plans import REGISTRY, stores  # noqa: E402
from weatherlake.session import local_session  # noqa: E402
from weatherlake.sources import fixtures as fx  # noqa: E402
from weatherlake.sources.layouts import read_layout, write_layouts  # noqa: E402
from weatherlake.sources.metar_csv import read_metar  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def run(fn) -> float:
    t0 = time.perf_counter()
    df = fn()
    if df is not None:
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def timed(fn, repeat: int = REPEAT) -> float:
    run(fn)
    return statistics.median(run(fn) for _ in range(repeat))


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="weatherlake-bench-", dir="/tmp")
    spark = local_session(CPUS, shuffle_partitions=max(8, CPUS), scratch=os.path.join(scratch, "ckpt"))
    only = set(sys.argv[1:])
    times: dict[str, float] = {}
    failed: dict[str, str] = {}

    def entry(name: str, fn, repeat: int = REPEAT) -> None:
        """One timing; an entry that fails is reported beside the others."""
        try:
            times[name] = round(timed(fn, repeat), 3)
        except Exception as e:  # noqa: BLE001
            failed[name] = f"{type(e).__name__}: {e}"[:300]

    for name, query in REGISTRY.items():
        if not only or name in only:
            entry(name, lambda q=query: q.run(spark, SF_DIR), 1 if name in stores.WRITING else REPEAT)

    if not only or "ingest" in only:
        # Set-up (not timed): the observations as METAR CSV text files.
        csv_dir = os.path.join(scratch, "csv")
        raw = fx.raw_observations(spark, SF_DIR).drop("l_orderkey", "l_partkey", "l_linenumber", "seq")
        raw.write.option("header", True).option("escape", '"').csv(csv_dir)

        pos_dir, date_dir = os.path.join(scratch, "by_position"), os.path.join(scratch, "by_date")

        def ingest():
            write_layouts(read_metar(spark, csv_dir, strict=True), pos_dir, date_dir)

        entry("ingest_csv_to_layouts", ingest, 1)
        if "ingest_csv_to_layouts" in times:
            by_pos, by_date = read_layout(spark, pos_dir), read_layout(spark, date_dir)
            entry("layout_seasonal_mean",
                  lambda: climate.seasonal_mean(by_pos, "tmpf", fx.PROBE_LAT, fx.PROBE_LON, to_celsius=True))
            entry("layout_historical_all_positions", lambda: climate.historical_stats(by_pos, "sknt"))
            entry("layout_snapshot_all", lambda: snapshot.snapshot_all(by_date, *fx.SNAPSHOT_DATE))

    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": total, "unit": "sec",
        "queries": times, **({"failed": failed} if failed else {}),
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "spark": spark.version, "master": f"local[{CPUS}]",
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
        "repeat": REPEAT, "repeat_by_query": dict.fromkeys(["ingest_csv_to_layouts", *sorted(stores.WRITING)], 1), "statistic": "median",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
