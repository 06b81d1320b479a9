"""The two stored layouts of the observations, as Parquet.

- **by position**: files range-partitioned and sorted on
  ``(lat, lon, year, month, day, hour, minute)``.  Each file covers a narrow
  band of positions, disjoint from the others, so a position filter reads few
  files and row groups; a position with a huge history is split over several
  files by the time columns instead of landing in one task.  With
  ``directories=True`` the files stand in ``stripe=/year=`` directories (whole
  degrees of latitude), which is what inserting in place needs.
- **by date**: directories ``year=/month=`` (partition pruning), files
  range-partitioned and sorted on the full time key, so a day or minute
  filter skips row groups inside a month.

Both writes apply the table's key with last-write-wins semantics, which is what
inserting the rows in order into a keyed table leaves behind.  Each write is
one full-row exchange.  Spark normalises floating-point window keys, so a window
over ``lat`` and ``lon`` would not accept a range partitioning on them and
would shuffle again by hash, which undoes the layout.  Range, window and file
order therefore all use fixed-point coordinates (``fixed_point``): equal
positions have equal ones and they keep the order of the floats.  Positions
that share a fixed-point value are still told apart in the window's order.

``insert_by_date`` and ``insert_by_position`` load further rows into a stored
table: only the directories that the new rows touch are read, merged and
rewritten (staged by Spark's dynamic partition overwrite and swapped in at
commit); all other directories keep their files.

All report the number of rows sent and kept, measured with observed metrics on
the write job itself (no extra pass); ``WriteReport.frame`` gives them as a row.

The stored tables have the 34 columns of ``schema.OBS_COLUMNS`` (those that
the input has) and, where the input has them, further columns of the caller;
the scan's ``_seq`` is not stored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from weatherlake import schema
from weatherlake.sources.metar_csv import SEQ

Order = Sequence[str | Column] | str | Column | None

STRIPE = "stripe"
DATE_DIRECTORIES = ("year", "month")
POSITION_DIRECTORIES = (STRIPE, "year")


@dataclass(frozen=True)
class WriteReport:
    """What a write did: rows sent to the table, and rows that stood in the
    files it wrote when it was done."""

    rows_sent: int
    rows_kept: int

    def frame(self, spark: SparkSession) -> DataFrame:
        """The report as one row: ``rows_sent``, ``rows_kept``."""
        return spark.createDataFrame([(self.rows_sent, self.rows_kept)], "rows_sent long, rows_kept long")


def fixed_point(c: str | Column) -> Column:
    """A coordinate in units of 1e-7 degrees: equal coordinates give equal
    values and larger ones no smaller values, NaN the largest.  Coordinates
    closer than that may share a value."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double") * 1e7
    return F.floor(F.least(F.greatest(x, F.lit(-9e18)), F.lit(9e18))).cast("long")


def stripe_of(lat: str | Column) -> Column:
    """The directory of a position: its whole degree of latitude."""
    x = (F.col(lat) if isinstance(lat, str) else lat).cast("double")
    return F.floor(F.least(F.greatest(x, F.lit(-1e9)), F.lit(1e9))).cast("int")


def _ranked(order: Order) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in ([order] if isinstance(order, (str, Column)) else order or [])]


def _with_order(new: DataFrame, order: Order, existing: DataFrame | None) -> DataFrame:
    """New rows, and the stored ones before them, with the struct ``_order``."""
    rank = _ranked(order)
    if order is not None and not rank:
        raise ValueError("an explicit order is required to decide which write is last")
    df = new.select("*", F.struct(F.lit(1).alias("new"), *rank).alias("_order"))
    if existing is None:
        return df
    if order is None:
        raise ValueError("merging with stored rows needs the order of the new ones")
    kind = df.schema["_order"].dataType
    old = existing.select("*", F.struct(F.lit(0).alias("new"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields[1:]])
                          .alias("_order"))
    return old.unionByName(df, allowMissingColumns=True)


def laid_out(df: DataFrame, key: Sequence[str], layout: Sequence[str], directories: Sequence[str] = (), *,
             unique: bool, partitions: int | None = None, counted: Observation | None = None) -> DataFrame:
    """Rows in the order of the files: range-partitioned and sorted, the last
    row (by ``_order``) of each key unless the key is ``unique`` already.

    One exchange: the window partitions by the very expression of the ranges,
    one struct of the key (single columns would not do: where the caller's
    frame has a constant in one, Spark drops it from the window alone).
    ``counted`` observes the new rows right behind the exchange.
    """
    # directories first, so that a task writes few of them
    by = [*directories, *[c for c in layout if c not in directories]]
    real = [c for c in by if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))]
    if not unique:
        held = [c for c in by if c in key or c in directories]
        df = df.withColumn("_key", F.struct(*[fixed_point(c).alias(c) if c in real else F.col(c) for c in held]))
    ranges = by if unique else ["_key"]
    df = df.repartitionByRange(partitions, *ranges) if partitions else df.repartitionByRange(*ranges)
    if counted is not None:
        df = df.observe(counted, F.coalesce(F.sum(F.col("_order.new").cast("long")), F.lit(0)).alias("n"))
    if unique:
        return df.sortWithinPartitions(*by)
    exact = [c for c in real if c in key]
    same = F.struct(*[F.col(c) for c in exact], F.lit(0).alias("_"))
    df = df.withColumn("_next", F.lead(same).over(Window.partitionBy("_key").orderBy(*exact, "_order")))
    df = df.filter(F.col("_next").isNull() | ~F.col("_next").eqNullSafe(same)).drop("_next")
    # the window's order already; the writer asks for the directories by name
    return df.sortWithinPartitions(*directories, "_key", *[c for c in by if c not in held]).drop("_key")


def _write(obs: DataFrame, path: str, key: Sequence[str], order: Order, layout: Sequence[str], directories: Sequence[str],
           existing: DataFrame | None, partitions: int | None, max_records_per_file: int | None, *, insert: bool = False) -> WriteReport:
    strays = [d for d in directories if d not in key and not (d == STRIPE and "lat" in key)]
    if strays and order is not None:
        raise ValueError(f"rows of one key could lie in several directories: {strays} are not part of the key")
    # Counts are observed after the range exchange: the sampling job that
    # computes the range bounds runs the plan below it a second time.
    sent, kept = Observation("rows_sent"), Observation("rows_kept")
    df = _with_order(obs, order, existing)
    if STRIPE in directories:
        df = df.withColumn(STRIPE, stripe_of("lat"))
    out = laid_out(df, key, layout, directories, unique=order is None, partitions=partitions, counted=sent)
    w = out.observe(kept, F.count(F.lit(1)).alias("n")).drop("_order", SEQ).write.mode("overwrite")
    if insert:
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if directories:
        w = w.partitionBy(*directories)
    w.parquet(path)
    return WriteReport(int(sent.get["n"] or 0), int(kept.get["n"]))


def partitions_for(obs: DataFrame, least: int | None = None, *, rows_each: int = 1_000_000) -> int | None:
    """How many range partitions a write of ``obs`` needs, so that none grows
    with the table: ``least``, or one per ``rows_each`` rows if that is more.
    Without ``least``, None where the session's number of shuffle partitions
    will do (Spark then joins small ones).  Counts the rows, which reads no
    column of a Parquet table."""
    needed = -(-obs.count() // rows_each)
    if least is None:
        return needed if needed > int(obs.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None
    return max(least, needed)


def _position_layout(key: Sequence[str]) -> list[str]:
    return list(key) + [c for c in schema.TIME_PARTS if c not in key]


def _date_layout(key: Sequence[str]) -> list[str]:
    return list(schema.TIME_PARTS) + [c for c in key if c not in schema.TIME_PARTS]


def write_by_position(obs: DataFrame, path: str, order: Order = "_seq", *, key: Sequence[str] = schema.KEY_POSITION,
                      existing: DataFrame | None = None, directories: bool = False, partitions: int | None = None,
                      max_records_per_file: int | None = None) -> WriteReport:
    """Create or replace the by-position table.  ``order=None`` declares the
    key already unique and skips the upsert.

    ``existing`` holds the rows of a table that is already there: the new rows
    are inserted into them (on an equal key the new row wins, and only new
    rows count as sent).  ``path`` must then be another one than the table's:
    a Parquet table cannot be replaced while it is read.  With
    ``directories=True`` the table takes ``insert_by_position``."""
    return _write(obs, path, key, order, _position_layout(key), POSITION_DIRECTORIES if directories else (), existing, partitions,
                  max_records_per_file)


def write_by_date(obs: DataFrame, path: str, order: Order = "_seq", *, key: Sequence[str] = schema.KEY_DATE,
                  existing: DataFrame | None = None, partitions: int | None = None,
                  max_records_per_file: int | None = None) -> WriteReport:
    """Create or replace the by-date table, partitioned by year and month.

    The default key includes the position, so stations reporting in the same
    minute do not overwrite each other; pass ``schema.KEY_DATE_BARE`` for the
    time-only key where the last station in the minute wins.  ``existing`` as
    in ``write_by_position``.
    """
    return _write(obs, path, key, order, _date_layout(key), DATE_DIRECTORIES, existing, partitions, max_records_per_file)


def _touched(new: DataFrame, directories: Sequence[str]) -> Column | None:
    """The directories that rows of ``new`` belong to, as a condition on the
    directory columns alone, so it prunes the listing of files; None for no
    rows.  One value per directory reaches the driver: months, or degrees
    times years."""
    rows = new.select(*directories).distinct().collect()
    if not rows:
        return None
    known = [r for r in rows if None not in r]
    a, b = directories
    low = 0xFFFFFFFF
    packed = F.shiftleft(F.col(a).cast("long"), 32) + F.col(b).cast("long").bitwiseAND(F.lit(low))
    where = packed.isin(*[(r[0] << 32) + (r[1] & low) for r in known]) if known else F.lit(False)
    for r in rows:
        if None in r:
            where = where | (F.col(a).eqNullSafe(F.lit(r[0])) & F.col(b).eqNullSafe(F.lit(r[1])))
    return where


def _insert(obs: DataFrame, path: str, key: Sequence[str], order: Order, layout: Sequence[str], directories: Sequence[str],
            partitions: int | None, max_records_per_file: int | None) -> WriteReport:
    if order is None:
        raise ValueError("merging with stored rows needs the order of the new ones")
    spark = obs.sparkSession
    table = spark.read.parquet(path)
    missing = [d for d in directories if d not in table.columns]
    if missing:
        raise ValueError(f"the table at {path} has no directories by {missing}")
    new = obs.withColumn(STRIPE, stripe_of("lat")) if STRIPE in directories else obs
    touched = _touched(new, directories)
    if touched is None:
        return WriteReport(0, 0)
    stored = table.filter(touched)
    report = _write(obs, path, key, order, layout, directories, stored.drop(STRIPE), partitions, max_records_per_file, insert=True)
    spark.catalog.refreshByPath(path)
    return report


def insert_by_date(obs: DataFrame, path: str, order: Order = "_seq", *, key: Sequence[str] = schema.KEY_DATE,
                   partitions: int | None = None, max_records_per_file: int | None = None) -> WriteReport:
    """Load further rows into the by-date table at ``path``, in place.

    Only the months of the new rows are read and rewritten; on an equal key
    the new row wins.  ``key`` is the one the table was written with.  The
    rows are read twice (their months first), so hand on a stored or
    persisted frame where parsing them is dear.  Readers that have listed the
    files of a touched month before must list them anew.  An insert of no
    rows changes nothing.
    """
    return _insert(obs, path, key, order, _date_layout(key), DATE_DIRECTORIES, partitions, max_records_per_file)


def insert_by_position(obs: DataFrame, path: str, order: Order = "_seq", *, key: Sequence[str] = schema.KEY_POSITION,
                       partitions: int | None = None, max_records_per_file: int | None = None) -> WriteReport:
    """Load further rows into a by-position table that was written with
    ``directories=True``, in place: only the (degree of latitude, year)
    directories of the new rows are rewritten.  Otherwise as
    ``insert_by_date``."""
    return _insert(obs, path, key, order, _position_layout(key), POSITION_DIRECTORIES, partitions, max_records_per_file)


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """Read a stored layout back in the observation column order; partition
    columns come back as ints."""
    df = spark.read.parquet(path)
    known = [c for c in schema.OBS_COLUMNS if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in known])


def write_layouts(obs: DataFrame, position_path: str, date_path: str, order: Order = "_seq", *,
                  date_key: Sequence[str] = schema.KEY_DATE, partitions: int | None = None,
                  max_records_per_file: int | None = None) -> tuple[WriteReport, WriteReport]:
    """Create or replace both layouts.

    With the default date key (time and position, the same columns as the
    position key) the by-date table is written from the stored by-position
    rows, which are unique on it already.  With the bare time key it is
    written from the input: which row is last depends on the input order.
    Both reports count the rows of the input as sent.
    """
    rep_pos = write_by_position(obs, position_path, order, partitions=partitions,
                                max_records_per_file=max_records_per_file)
    same_key = set(date_key) == set(schema.KEY_POSITION)
    source = obs.sparkSession.read.parquet(position_path) if same_key else obs
    rep_date = write_by_date(source, date_path, None if same_key else order, key=date_key,
                             partitions=partitions, max_records_per_file=max_records_per_file)
    return rep_pos, WriteReport(rep_pos.rows_sent, rep_date.rows_kept)
