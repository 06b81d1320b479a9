"""Registered queries that write a stored table, a file or CSV text, and read
it back.

They write below the session's checkpoint directory, each run into a folder of
its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weatherlake import schema
from weatherlake.operators import climate, stations
from weatherlake.plans.catalog import F2C, POS, register, with_o
from weatherlake.plans.ingest import FULL, FULL_SQL, ORDER_DESC, _full
from weatherlake.session import shared_folder
from weatherlake.sources import fixtures as fx, layouts, pruning
from weatherlake.sources.metar_csv import CSV_OPTIONS, read_metar, read_raw, parse_metar

#: Queries here that write whole tables before they read.
WRITING = frozenset(("layout_by_position", "layout_position_bands", "insert_by_date", "insert_by_position", "layout_by_day_range", "write_report",
                     "csv_round_trip", "csv_first_rows"))

#: Columns of the driver's table that order the writes; they are stored beside the observation.
ORDER = [c for c in fx.OBS_ORDER if c != "station"]
STORED = ", ".join(dict.fromkeys([*FULL, *ORDER]))


def _latest(key, where: str = "TRUE") -> str:
    return f"""(SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY {", ".join(key)} ORDER BY {ORDER_DESC}) AS rn FROM O WHERE {where}) t
WHERE rn = 1)"""


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.observations(spark, sf_dir).select(*schema.OBS_COLUMNS, *ORDER)


# --- the by-position table ---------------------------------------------------------------------

@register("layout_by_position", with_o(f"""
SELECT {STORED} FROM {_latest(schema.KEY_POSITION)} r WHERE {POS}"""))
def q_layout_by_position(spark, sf_dir):
    """Written as a whole, read at one position from the files that can hold it."""
    path = shared_folder(spark, "by-position")
    obs = _observations(spark, sf_dir)
    layouts.write_by_position(obs, path, fx.OBS_ORDER, partitions=layouts.partitions_for(obs, 16))
    pruning.write_statistics(spark, path)
    columns = [c for c in STORED.split(", ") if c not in ("year", "month")]
    return pruning.by_position(spark, path, fx.PROBE_LAT, fx.PROBE_LON, columns)


@register("layout_position_bands", with_o(f"""
SELECT CAST(count(*) AS BIGINT) AS rows_kept, CAST(count(DISTINCT (lat, lon)) AS BIGINT) AS positions, TRUE AS bands_disjoint
FROM {_latest(schema.KEY_POSITION)} r"""))
def q_layout_position_bands(spark, sf_dir):
    """The order that the table promises: files hold disjoint ranges of the key."""
    path = shared_folder(spark, "by-position")
    obs = _observations(spark, sf_dir)
    layouts.write_by_position(obs, path, fx.OBS_ORDER, partitions=layouts.partitions_for(obs, 16))
    table = spark.read.parquet(path)
    key = F.struct(*schema.KEY_POSITION)
    bands = table.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    in_order = Window.orderBy("lo")  # one row per file
    disjoint = bands.select((F.col("hi") < F.lead("lo").over(in_order)).alias("ok")).agg(F.every(F.coalesce("ok", F.lit(True))))
    return table.agg(F.count(F.lit(1)).alias("rows_kept"), F.count_distinct("lat", "lon").alias("positions")).select(
        "*", disjoint.scalar().alias("bands_disjoint"))


# --- loading into a stored table ---------------------------------------------------------------

# the load in two parts: the later reports of 1995 and 1998 come second, with lower order keys first in
# neither part, so rows of one key meet across the parts
SECOND = "year IN (1995, 1998) AND l_orderkey % 3 = 0"


def _merged(key) -> str:
    """What is stored after both parts: the last of the second part, else the last of the first."""
    by = ", ".join(key)
    return f"""(SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY CASE WHEN {SECOND} THEN 0 ELSE 1 END, {ORDER_DESC}) AS rn FROM O) t
WHERE rn = 1)"""


def _two_loads(spark, sf_dir):
    obs = _observations(spark, sf_dir)
    return obs.filter(f"NOT ({SECOND})"), obs.filter(SECOND)


@register("insert_by_date", with_o(f"""
SELECT {STORED} FROM {_merged(schema.KEY_DATE)} r"""))
def q_insert_by_date(spark, sf_dir):
    path = shared_folder(spark, "by-date")
    first, second = _two_loads(spark, sf_dir)
    partitions = layouts.partitions_for(first)
    layouts.write_by_date(first, path, fx.OBS_ORDER, partitions=partitions)
    layouts.insert_by_date(second, path, fx.OBS_ORDER, partitions=partitions)
    return layouts.read_layout(spark, path).select(*STORED.split(", "))


@register("insert_by_position", with_o(f"""
SELECT {STORED} FROM {_merged(schema.KEY_POSITION)} r"""))
def q_insert_by_position(spark, sf_dir):
    path = shared_folder(spark, "by-position")
    first, second = _two_loads(spark, sf_dir)
    partitions = layouts.partitions_for(first)
    layouts.write_by_position(first, path, fx.OBS_ORDER, directories=True, partitions=partitions)
    layouts.insert_by_position(second, path, fx.OBS_ORDER, partitions=partitions)
    return layouts.read_layout(spark, path).select(*STORED.split(", "))


@register("layout_by_day_range", with_o(f"""
SELECT {STORED} FROM {_latest(schema.KEY_DATE_BARE)} r WHERE year = {fx.KMEANS_YEAR} AND month = {fx.KMEANS_MONTH}
  AND day BETWEEN {fx.KMEANS_DAY1} AND {fx.KMEANS_DAY2}"""))
def q_layout_by_day_range(spark, sf_dir):
    """The by-date table under its bare key, read for some days from the files that can hold them."""
    path = shared_folder(spark, "by-date")
    obs = _observations(spark, sf_dir)
    layouts.write_by_date(obs, path, fx.OBS_ORDER, key=schema.KEY_DATE_BARE, partitions=layouts.partitions_for(obs))
    pruning.write_statistics(spark, path)
    return pruning.by_day_range(spark, path, fx.KMEANS_YEAR, fx.KMEANS_MONTH, fx.KMEANS_DAY1, fx.KMEANS_DAY2, STORED.split(", "))


@register("write_report", with_o(f"""
SELECT 'date' AS layout, (SELECT count(*) FROM O) AS rows_sent, (SELECT count(*) FROM {_latest(schema.KEY_DATE_BARE)} r) AS rows_kept
UNION ALL
SELECT 'position', (SELECT count(*) FROM O), (SELECT count(*) FROM {_latest(schema.KEY_POSITION)} r)"""))
def q_write_report(spark, sf_dir):
    """The rows sent and kept that the two writes report of themselves."""
    obs = _observations(spark, sf_dir)
    partitions = layouts.partitions_for(obs)
    position = layouts.write_by_position(obs, shared_folder(spark, "by-position"), fx.OBS_ORDER, partitions=partitions)
    date = layouts.write_by_date(obs, shared_folder(spark, "by-date"), fx.OBS_ORDER, key=schema.KEY_DATE_BARE, partitions=partitions)
    return (position.frame(spark).select(F.lit("position").alias("layout"), "*")
            .unionByName(date.frame(spark).select(F.lit("date").alias("layout"), "*")))


# --- CSV text ----------------------------------------------------------------------------------

@register("csv_round_trip", with_o(f"""
SELECT {FULL_SQL}, metar, l_orderkey
FROM O WHERE l_orderkey % 17 <> 0"""))
def q_csv_round_trip(spark, sf_dir):
    """The raw cells as CSV files of two column orders, scanned and parsed."""
    raw = fx.raw_observations(spark, sf_dir)
    columns = [*schema.RAW_COLUMNS, "metar", "l_orderkey"]
    folders = []
    for k, order in enumerate((columns, columns[::-1])):
        folders.append(shared_folder(spark, "csv"))
        raw.filter(F.col("l_orderkey") % 2 == k).select(*order).write.option("header", True).option("escape", '"').csv(folders[-1])
    obs = parse_metar(read_raw(spark, folders), strict=True, valid_struct=True, keep=("l_orderkey",))
    return _full(obs.select("*", "valid.*"), "metar", F.col("l_orderkey").cast("long").alias("l_orderkey"))


def _cells_in_order(lines: DataFrame) -> DataFrame:
    """Text cells of the reports, in order.  What is put in order are rows of the
    table, a quarter as wide; they become observations and then text behind the exchange."""
    rows = lines.filter("l_orderkey % 17 <> 0")
    order = [F.expr(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "concat('S', l_suppkey)")]
    return fx.raw_cells(fx.as_observations(rows.repartitionByRange(layouts.partitions_for(rows, 32), *order).sortWithinPartitions(*order)))


@register("csv_first_rows", with_o("""
SELECT station, year, month, day, hour, minute, lat, lon, l_orderkey FROM (
  SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, seq, station) AS rn FROM O WHERE l_orderkey % 17 <> 0) t
WHERE rn <= 100"""))
def q_csv_first_rows(spark, sf_dir):
    """The load limit: the first 100 reports of a folder of CSV files, in order."""
    folder = shared_folder(spark, "csv")
    cells = _cells_in_order(fx.table(spark, sf_dir, "lineitem")).select(*schema.RAW_COLUMNS, "l_orderkey")
    cells.write.option("header", True).option("escape", '"').option("compression", "lz4").csv(folder)
    obs = parse_metar(read_raw(spark, folder, limit=100), keep=("l_orderkey",))
    return obs.select("station", *schema.TIME_PARTS, "lat", "lon", F.col("l_orderkey").cast("long").alias("l_orderkey"))


@register("station_file_round_trip", """
WITH s AS (SELECT concat('S ', c_custkey, CASE WHEN c_custkey % 7 = 0 THEN ', "x"' ELSE '' END) AS station,
                  cast(c_custkey % 40 as double) * 0.25 AS lon, cast(c_custkey % 90 as double) * 0.5 AS lat, c_custkey % 500 AS ord, c_custkey FROM customer)
SELECT station, lat, lon, CAST(row_number() OVER (ORDER BY ord, station) AS INTEGER) AS place FROM s""")
def q_station_file_round_trip(spark, sf_dir):
    """A dictionary written as CSV text and read again: values, quotes, and
    the order of its rows."""
    rows = fx.table(spark, sf_dir, "customer").selectExpr(
        "concat('S ', c_custkey, case when c_custkey % 7 = 0 then ', \"x\"' else '' end) as station",
        "cast(c_custkey % 40 as double) * 0.25 as lon", "cast(c_custkey % 90 as double) * 0.5 as lat", "c_custkey % 500 as ord")
    path = shared_folder(spark, "stations")
    # many rows share an ord: the name decides
    stations.write_stations(rows.withColumn("ord", F.struct("ord", "station")), path)
    back = stations.load_stations(spark, path)  # a dictionary: one row per station
    return back.select("station", "lat", "lon", F.row_number().over(Window.orderBy("ord")).alias("place"))


# --- order -------------------------------------------------------------------------------------

@register("plot_order_month", with_o(f"""
SELECT CAST(row_number() OVER (ORDER BY month) AS INTEGER) AS place, month, round({F2C.format(x="avg(CAST(tmpf AS DOUBLE))")}, 6) AS value
FROM O WHERE {POS} AND tmpf IS NOT NULL GROUP BY month"""))
def q_plot_order_month(spark, sf_dir):
    """Months in plotting order; the place of a row is where the sorted frame has it."""
    df = climate.seasonal_mean(fx.observations(spark, sf_dir), "tmpf", fx.PROBE_LAT, fx.PROBE_LON, to_celsius=True)
    return _placed(climate.plot_order(df)).select("place", "month", F.round("mean", 6).alias("value"))


@register("plot_order_year_month", with_o(f"""
SELECT CAST(row_number() OVER (ORDER BY year, month) AS INTEGER) AS place, year, month FROM O WHERE {POS} AND sknt IS NOT NULL GROUP BY year, month"""))
def q_plot_order_year_month(spark, sf_dir):
    """Years and months as numbers, not as text."""
    df = climate.monthly_mean(fx.observations(spark, sf_dir), "sknt", fx.PROBE_LAT, fx.PROBE_LON)
    return _placed(climate.plot_order(df)).select("place", "year", "month")


def _placed(ordered: DataFrame) -> DataFrame:
    """Rows of a small sorted result with their place in it, from 1.  Row ids
    grow with partition and row, which is how a sorted frame is laid out."""
    return (ordered.withColumn("_id", F.monotonically_increasing_id())
            .withColumn("place", F.row_number().over(Window.orderBy("_id"))).drop("_id"))
