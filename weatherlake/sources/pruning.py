"""Statistics of stored files, and scans that read only the files they need.

A filter on a stored layout reaches Parquet, which skips row groups by their
statistics; but every file of the table (or of the directories that are left)
still has to be opened for them.  ``write_statistics`` keeps the least and
greatest value of the layout's columns per file in one small table beside the
files (``_statistics``, which readers of the table do not see).  The scans
here ask it first and hand Spark the files that can hold an answer.

The table only ever excludes files: one it does not list (written later, or by
another job) is always read, and one that is gone is not looked for.  It can
therefore be behind, but results cannot be wrong.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weatherlake import schema
from weatherlake.functions.exprs import float_lit
from weatherlake.session import materialize
from weatherlake.sources import scan
from weatherlake.sources.layouts import STRIPE, read_layout, stripe_of

FOLDER = "_statistics"
TIME = ("year", "month", "day", "hour", "minute")


# a file by its directories and name: one task writes files of one name into several directories
_RELATIVE = "(?:[^/=]+=[^/]*/)*[^/]*$"


def _name(file: str) -> str:
    return re.search(_RELATIVE, file)[0]


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/{FOLDER}"


def _known(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(_folder(path))
    except AnalysisException:  # none yet
        return None


def _files(spark: SparkSession, path: str, files: Sequence[str]) -> DataFrame:
    """Some files of a layout, with its directory columns."""
    return spark.read.option("basePath", path).parquet(*[unquote(f) for f in files])


def _per_file(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    bounds = [f(c).alias(f"{c}_{n}") for c in columns for f, n in ((F.min, "min"), (F.max, "max"))]
    # names are cut out of the paths once per file, not per row
    found = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *bounds)
    return found.withColumn("file", F.regexp_extract("file", _RELATIVE, 0))


def statistics(spark: SparkSession, path: str, columns: Sequence[str] = schema.KEY_POSITION) -> DataFrame:
    """One row per file of a stored layout: ``file`` (directories and name),
    ``rows``, and ``<c>_min`` / ``<c>_max`` of the columns.  Reads the columns
    named only; positions are compared as they are stored."""
    return _per_file(spark.read.parquet(path), columns)


def write_statistics(spark: SparkSession, path: str, columns: Sequence[str] = schema.KEY_POSITION) -> int:
    """Bring the table of statistics up to date: files that it lists keep
    their row, new ones are read, those gone are dropped.  Returns the number
    of files it read."""
    files = spark.read.parquet(path).inputFiles()
    known = _known(spark, path)
    if known is not None and not {f"{c}_min" for c in columns} <= set(known.columns):
        known = None
    listed = {r["file"] for r in known.select("file").collect()} if known is not None else set()
    new = [f for f in files if _name(f) not in listed]
    parts = [_per_file(_files(spark, path, new), columns)] if new else []
    if known is not None:
        present = spark.createDataFrame([(_name(f),) for f in files], "file string")
        parts.append(known.join(present, "file", "left_semi"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more.select(*out.columns))
    # a table cannot be replaced while it is read
    materialize(out).coalesce(1).write.mode("overwrite").parquet(_folder(path))
    return len(new)


def files_with(spark: SparkSession, path: str, wanted: Mapping[str, tuple[Column | None, Column | None]]) -> list[str]:
    """The files of a layout that can hold rows with every column of
    ``wanted`` between its bounds (inclusive; None is open)."""
    files, known = spark.read.parquet(path).inputFiles(), _known(spark, path)
    if known is None:
        return files
    out = F.lit(False)
    for c, (low, high) in wanted.items():
        if f"{c}_min" in known.columns:
            if low is not None:
                out = out | (F.col(f"{c}_max") < low)
            if high is not None:
                out = out | (F.col(f"{c}_min") > high)
    excluded = {r["file"] for r in known.filter(F.coalesce(out, F.lit(False))).select("file").collect()}
    return [f for f in files if _name(f) not in excluded]


def _read(spark: SparkSession, path: str, files: Sequence[str]) -> DataFrame:
    """Some files of a layout, with its directory columns; its empty frame for none."""
    if not files:
        return read_layout(spark, path).limit(0)
    df = _files(spark, path, files)
    known = [c for c in schema.OBS_COLUMNS if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in known])


def by_position(spark: SparkSession, path: str, lat: float, lon: float, columns: Sequence[str] | str = ()) -> DataFrame:
    """``scan.by_position`` on a stored layout, on the files that can hold the position."""
    here = {"lat": (float_lit(lat),) * 2, "lon": (float_lit(lon),) * 2}
    obs = _read(spark, path, files_with(spark, path, here))
    if STRIPE in obs.columns:
        obs = obs.filter(F.col(STRIPE) == stripe_of(float_lit(lat)))
    return scan.by_position(obs, lat, lon, columns)


def by_day_range(spark: SparkSession, path: str, year: int, month: int, day1: int | None = None, day2: int | None = None,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """``scan.by_day_range`` on a stored layout, on the files that can hold the days."""
    lit = lambda v: None if v is None else F.lit(v)
    wanted = {"year": (F.lit(year),) * 2, "month": (F.lit(month),) * 2, "day": (lit(day1), lit(day2))}
    return scan.by_day_range(_read(spark, path, files_with(spark, path, wanted)), year, month, day1, day2, columns)


def at_minute(spark: SparkSession, path: str, year: int, month: int, day: int | None = None, hour: int | None = None,
              minute: int | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """``scan.at_minute`` on a stored layout, on the files that can hold the instant."""
    wanted = {c: (F.lit(v),) * 2 for c, v in zip(TIME, (year, month, day, hour, minute)) if v is not None}
    return scan.at_minute(_read(spark, path, files_with(spark, path, wanted)), year, month, day, hour, minute, columns)
