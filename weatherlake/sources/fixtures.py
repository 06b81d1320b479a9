"""Adapters that give the driver's test tables the observation shape.

The observation data itself is not shipped, so the test queries run on
``lineitem`` re-read as METAR observations (relation ``O`` below), on
``supplier`` as query positions and on ``nation`` as reference stations.  The
expressions are written as SQL text so the DuckDB oracle can use the very same
text; they are part of the test set-up, not of the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weatherlake.session import compiled_methods

# The adapter of the test tables, one expression per column.
OBS_ADAPTER = (
    "concat('S', l_suppkey) as station",
    "l_orderkey", "l_partkey", "l_linenumber",
    "cast(extract(year  from l_shipdate) as int) as year",
    "cast(extract(month from l_shipdate) as int) as month",
    "cast(extract(day   from l_shipdate) as int) as day",
    "l_linenumber as hour",
    "cast(l_orderkey % 60 as int) as minute",
    "cast(cast(l_suppkey % 10 as double) * 2.0 - 18.0 as float) as lat",
    "cast(27.0 + cast(l_suppkey % 7 as double) * 2.5 as float) as lon",
    "case when l_discount = 0.05 then null else cast(l_quantity * 1.3 + 30.0 as float) end as tmpf",
    "cast(29.0 + l_tax * 20.0 + l_suppkey * 0.01 as float) as alti",
    "case when l_tax = 0.03 then null else cast(l_extendedprice / 1050.0 as float) end as relh",
    "cast(l_quantity * 0.5 + l_suppkey % 10 as float) as sknt",
    "l_extendedprice as seq",
    "case when l_discount = 0.02 then null else cast(l_quantity - 5.25 as float) end as dwpf",
    "case when l_partkey % 11 = 0 then null else cast(l_partkey % 36 * 10 as float) end as drct",
    "case when l_discount = 0.01 then null else cast(l_tax * 2.0 as float) end as p01i",
    "case when l_suppkey % 5 = 0 then null else cast(1000.0 + l_quantity * 0.37 as float) end as mslp",
    "case when l_quantity = 10.0 then null else cast(l_linenumber * 1.5 as float) end as vsby",
    "case when l_linenumber > 1 then null else cast(l_quantity * 1.7 as float) end as gust",
    "case when l_partkey % 3 = 0 then null else cast(l_partkey % 50 * 100.0 as float) end as skyl1",
    "case when l_partkey % 4 = 0 then null else cast(l_partkey % 50 * 200.0 as float) end as skyl2",
    "case when l_partkey % 5 = 0 then null else cast(l_partkey % 50 * 300.0 as float) end as skyl3",
    "case when l_partkey % 6 = 0 then null else cast(l_partkey % 50 * 400.0 as float) end as skyl4",
    "case when l_linenumber % 2 = 0 then null else cast(l_tax * 1.1 as float) end as ice_accretion_1hr",
    "case when l_linenumber % 3 = 0 then null else cast(l_tax * 3.3 as float) end as ice_accretion_3hr",
    "case when l_linenumber % 4 = 0 then null else cast(l_tax * 6.6 as float) end as ice_accretion_6hr",
    "case when l_suppkey % 7 = 0 then null else cast(l_quantity * 2.1 as float) end as peak_wind_gust",
    "case when l_suppkey % 8 = 0 then null else cast(l_suppkey % 36 * 10 as float) end as peak_wind_drct",
    "case when l_tax = 0.04 then null else cast(l_quantity * 1.3 + 28.5 as float) end as feel",
    "case l_linenumber % 5 when 0 then null when 1 then 'FEW' when 2 then 'SCT' else 'BKN' end as skyc1",
    "case l_linenumber % 4 when 0 then null when 1 then 'OVC' else 'CLR' end as skyc2",
    "case when l_partkey % 9 = 0 then 'VV' end as skyc3",
    "case when l_partkey % 10 = 0 then 'NSC' end as skyc4",
    "case when l_quantity > 25.0 then concat('-RA BR ', l_linenumber) end as wxcodes",
    "case when l_suppkey % 6 = 0 then null else cast(l_shipdate as timestamp) end as peak_wind_time",
    "case when l_suppkey % 9 = 0 then null else concat('LE', l_suppkey, ' AUTO \"Q, ', l_returnflag) end as metar",
)
EXTRA = ("dwpf", "drct", "p01i", "mslp", "vsby", "gust", "skyl1", "skyl2", "skyl3", "skyl4", "ice_accretion_1hr",
         "ice_accretion_3hr", "ice_accretion_6hr", "peak_wind_gust", "peak_wind_drct", "feel", "skyc1", "skyc2", "skyc3", "skyc4",
         "wxcodes", "metar")

# Total order for "last written": all descending, no ties at any scale.
OBS_ORDER = ("l_orderkey", "l_partkey", "l_linenumber", "seq", "station")

# Raw-text adapter over O: a bad ``valid`` where l_orderkey % 17 = 0; a NULL
# tmpf becomes the token 'null' for even order keys, else a TAB.
RAW_ADAPTER = (
    "station",
    "case when l_orderkey % 17 = 0 then 'bad' else "
    "concat(year, '-', lpad(month, 2, '0'), '-', lpad(day, 2, '0'), ' ', "
    "lpad(hour, 2, '0'), ':', lpad(minute, 2, '0')) end as valid",
    "cast(lat as string) as lat",
    "cast(lon as string) as lon",
    "case when tmpf is not null then cast(tmpf as string) "
    "when l_orderkey % 2 = 0 then 'null' else '\t' end as tmpf",
    "cast(alti as string) as alti",
    "cast(relh as string) as relh",
    "cast(sknt as string) as sknt",
    "l_orderkey", "l_partkey", "l_linenumber", "seq",
    *(f"case when {c} is not null then cast({c} as string) when l_orderkey % 3 = 0 then 'null' else '' end as {c}" for c in EXTRA),
    "case when peak_wind_time is not null then date_format(peak_wind_time, 'yyyy-MM-dd HH:mm:ss') else 'null' end as peak_wind_time",
)

# The raw adapter with what only a lenient parse accepts: missing positions,
# text that is no number, and a year that does not fit an int.
LENIENT_ADAPTER = (
    "* except (lat, tmpf, valid)",
    "case when l_orderkey % 13 = 0 then 'null' else lat end as lat",
    "case when l_orderkey % 7 = 0 then '1.5d' when l_orderkey % 7 = 1 then 'M' else tmpf end as tmpf",
    "case when l_orderkey % 19 = 0 then '99999999999-01-01 00:00' else valid end as valid",
)

# Query positions and reference stations for the nearest-station join.
QUERY_ADAPTER = (
    "s_suppkey as qid",
    "s_acctbal / 1000.0 as lon",
    "cast(s_suppkey % 50 as double) as lat",
)
STATION_ADAPTER = (
    "n_name as station",
    "cast(n_nationkey % 5 * 2 as double) as lon",
    "cast(n_nationkey * 2 as double) as lat",
    "n_nationkey as ord",
)

# Positions far from all stations, and stations in one dense cluster with an
# outlier.
FAR_QUERY_ADAPTER = (
    "s_suppkey as qid",
    "s_acctbal * 10.0 + 200.0 as lon",
    "cast(s_suppkey % 50 as double) * 40.0 - 500.0 as lat",
)
CLUSTER_ADAPTER = (
    "concat('C', c_custkey) as station",
    "case when c_custkey = 1 then 500.0 else cast(c_custkey % 40 as double) * 0.01 end as lon",
    "case when c_custkey = 1 then 500.0 else cast(c_custkey % 1000 as double) * 0.0004 end as lat",
    "c_custkey as ord",
)

# Test parameters used by the registered queries.
PROBE_LAT, PROBE_LON = -12.0, 34.5
PROBE_YEAR = 1998
KMEANS_YEAR, KMEANS_MONTH, KMEANS_DAY1, KMEANS_DAY2 = 1998, 9, 1, 15
SNAPSHOT_DATE = (1998, 9, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_observations(lines: DataFrame) -> DataFrame:
    """Rows of ``lineitem`` as typed observations (relation ``O``)."""
    return lines.selectExpr(*OBS_ADAPTER)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_observations(table(spark, sf_dir, "lineitem"))


def raw_cells(obs: DataFrame) -> DataFrame:
    """Rows of ``O`` rendered back to METAR text cells, with bad dates and null tokens."""
    compiled_methods(obs.sparkSession)
    return obs.selectExpr(*RAW_ADAPTER)


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_cells(observations(spark, sf_dir))


def lenient_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_observations(spark, sf_dir).selectExpr(*LENIENT_ADAPTER)


def query_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(*QUERY_ADAPTER)


def reference_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(*STATION_ADAPTER)


def far_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(*FAR_QUERY_ADAPTER)


def clustered_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*CLUSTER_ADAPTER)


def sql_cte() -> str:
    """The adapter as a DuckDB/ANSI ``WITH`` clause defining ``O``."""
    return "O AS (SELECT " + ",\n  ".join(OBS_ADAPTER) + " FROM lineitem)"

