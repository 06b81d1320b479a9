"""METAR CSV ingest: raw text cells to typed observations, plus the rejects.

``read_raw`` is a distributed CSV scan that keeps every cell as text and adds
``_seq``, the row's position in the input: the rank of its path in the caller's
list, then (for a path that holds several files) the file name, the split
start and the row id within the split.  ``_seq`` orders rows in input order
without a sort, so "last written wins" can be decided later by any key.

``parse_metar`` turns text into the typed observation schema:

- ``valid`` must start with ``Y-M-D h:m`` (trailing seconds are accepted);
  other rows are dropped here and returned by ``metar_rejects``;
- the tokens ``null`` and TAB, and empty cells, become NULL;
- numbers are parsed as 32-bit floats, as Python's ``float`` reads them.
  ``strict=True`` raises on text that is not a number (as the original load
  aborts), ``strict=False`` makes it NULL;
- a NULL position cannot be stored under a position key, and a time part that
  does not fit an int has no value: ``strict`` raises, lenient mode sends the
  row to the rejects.

The strict checks stand in the columns themselves, so they hold whichever
columns a query reads: each number checks its own cell, and the time parts,
``lat`` and ``lon`` check that the row is usable.  ``count()`` reads no column
and counts the rows whose timestamp matches, without parsing them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from weatherlake import schema
from weatherlake.session import compiled_methods, materialize

SEQ = "_seq"

#: How METAR CSV is written: a header, and quotes within quoted cells as two quotes.  Files whose
#: header differs from the columns they are read by raise.
CSV_OPTIONS = {"header": "true", "inferSchema": "false", "enforceSchema": "false", "escape": '"', "mode": "PERMISSIVE"}


def read_raw(spark: SparkSession, path: str | Sequence[str], *, limit: int | None = None) -> DataFrame:
    """Scan METAR CSV files with a header; every column as text, by name.

    Each path (a file or a folder) is read by its own header; paths may order
    their columns differently, and a column that some lack is NULL there.
    Quoted cells may hold commas, and quotes as two quotes.  Several paths are
    read by one scan per different header (``headers``), however many they are.

    ``limit`` keeps the first ``limit`` rows in input order.  Files are then
    read in order, a few at a time, until that many rows are in hand, so a
    preview of a large folder reads its first files only.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if not paths:
        raise ValueError("no path given")
    if limit is not None:
        return _first_rows(spark, paths, limit)
    if len(paths) == 1:
        return _scan(spark, paths, {})
    return _scans(spark, paths)


def _scans(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All paths, one scan for each different header among them."""
    found = headers(spark, paths)
    ranks = _ranks([r["file"] for r in found], paths)
    if ranks is None:  # patterns and the like, which no file name shows: a scan for each path
        scans = [_scan(spark, [p], {}, rank) for rank, p in enumerate(paths)]
    else:
        by_path: dict[int, set[str]] = {}
        groups: dict[str, dict[str, int]] = {}
        for r in found:
            by_path.setdefault(ranks[r["file"]], set()).add(r["header"])
            groups.setdefault(r["header"], {})[r["file"]] = ranks[r["file"]]
        mixed = sorted(paths[rank] for rank, hs in by_path.items() if len(hs) > 1)
        if mixed:
            raise ValueError(f"files of one path have different headers: {mixed[0]}")
        scans = [_scan(spark, sorted(files), files) for _, files in sorted(groups.items())]
        if not scans:  # empty files only
            return _scan(spark, paths, {})
    raw = scans[0]
    for more in scans[1:]:
        raw = raw.unionByName(more, allowMissingColumns=True)
    return raw


def _scan(spark: SparkSession, paths: Sequence[str], ranks: dict[str, int], rank: int = 0) -> DataFrame:
    """One scan: columns by the header that all files share (a differing one
    raises).  With ``ranks`` the paths are files as Spark lists them, encoded
    as in URLs, and it gives the place of each in the caller's list."""
    raw = spark.read.options(**CSV_OPTIONS).csv([unquote(p) for p in paths] if ranks else list(paths))
    # a path that is one file needs no file name to keep its rows in order
    one_file = len(set(ranks.values())) == len(ranks) if ranks else len(raw.inputFiles()) <= 1
    file = F.col("_metadata.file_path")
    position = [(F.lit(None).cast("string") if one_file else file).alias("file"), F.col("_metadata.file_block_start").alias("offset"),
                F.monotonically_increasing_id().alias("row")]
    if len(set(ranks.values())) <= 1:
        return raw.select("*", F.struct(F.lit(next(iter(ranks.values()), rank)).alias("path"), *position).alias(SEQ))
    # row numbers are taken below the join, which may shuffle
    listed = spark.createDataFrame([(_plain(unquote(f)), k) for f, k in ranks.items()], "_listed string, _rank int")
    placed = raw.select("*", _plain_column(file).alias("_file"), F.struct(*position).alias("_at"))
    return placed.join(listed, F.col("_file") == F.col("_listed")).select(
        *raw.columns, F.struct(F.col("_rank").alias("path"), "_at.file", "_at.offset", "_at.row").alias(SEQ))


_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def _plain(path: str) -> str:
    """A path without scheme and authority, as files and callers name it alike."""
    return re.sub("/+", "/", re.sub(_AUTHORITY, "", path)).rstrip("/")


def _plain_column(file: Column) -> Column:
    return F.regexp_replace(F.url_decode(F.regexp_replace(F.regexp_replace(file, _AUTHORITY, ""), "[+]", "%2B")), "/+", "/")


def _ranks(files: Sequence[str], paths: Sequence[str]) -> dict[str, int] | None:
    """The place of each file in the caller's list of paths (the first that is
    the file or a folder above it); None where a file is under none of them."""
    place: dict[str, int] = {}
    for rank, p in enumerate(paths):
        place.setdefault(_plain(p), rank)
    out = {}
    for f in files:
        at = _plain(unquote(f))
        while at and at not in place:
            at = at.rpartition("/")[0]
        if not at:
            return None
        out[f] = place[at]
    return out


def headers(spark: SparkSession, paths: Sequence[str]) -> list[Row]:
    """The header line of every file: ``file``, ``header``, in one distributed
    pass over first lines.  Empty files have none.

    Each file is one partition, whose first row is kept by its id (the lower 33
    bits number the rows of a partition), so lines are neither built into rows
    for Python nor grouped.  What reaches the driver are the names that its file
    index holds already.
    """
    reader = spark.newSession()  # settings of its own: each file is one partition
    whole = str(1 << 40)
    reader.conf.set("spark.sql.files.maxPartitionBytes", whole)
    reader.conf.set("spark.sql.files.openCostInBytes", whole)
    text = reader.read.text(list(paths))
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                        F.monotonically_increasing_id().alias("row"), F.col("value").alias("header"))
    alone = text.rdd.getNumPartitions() >= len(text.inputFiles())
    if alone:
        lines = lines.filter(F.col("row").bitwiseAND(F.lit((1 << 33) - 1)) == 0)
    return (lines.groupBy("file").agg(F.min_by("header", F.struct("start", "row")).alias("header")).orderBy("file").collect())


def _first_rows(spark: SparkSession, paths: Sequence[str], limit: int) -> DataFrame:
    """The first rows in input order: files are read in order, twice as many
    each time, and later ones only while rows are missing."""
    parts, missing, step = [], limit, 1
    for rank, path in enumerate(paths):
        files = sorted(spark.read.text(path).inputFiles())
        while files:
            now, files = files[:step], files[step:]
            step *= 2
            last = not files and rank == len(paths) - 1
            part = _scan(spark, now, dict.fromkeys(now, rank)).orderBy(SEQ).limit(missing)
            parts.append(part if last else materialize(part))
            if not last:
                missing -= parts[-1].count()
                if missing <= 0:
                    break
        if missing <= 0:
            break
    raw = parts[0] if parts else _scan(spark, paths[:1], {})
    for more in parts[1:]:
        raw = raw.unionByName(more, allowMissingColumns=True)
    return raw


def _cell(raw: DataFrame, name: str) -> Column:
    """The text cell with null tokens and empty text as NULL; a column that
    the file lacks is all NULL."""
    if name not in raw.columns:
        return F.lit(None).cast("string")
    c = F.col(name)
    return F.when(c.isin(*schema.NULL_TOKENS, ""), F.lit(None).cast("string")).otherwise(c)


def _valid_prefix() -> Column:
    """The matched ``Y-M-D h:m`` prefix of ``valid``; empty when it does not
    match, NULL when ``valid`` is NULL.  One regex evaluation per row."""
    return F.regexp_extract(F.col("valid"), schema.VALID_PATTERN, 0)


def valid_ok(raw: DataFrame) -> Column:
    return F.coalesce(_valid_prefix() != F.lit(""), F.lit(False))


def _typed(name: str, text: Column) -> Column:
    """Parse a cleaned text cell into the column's type (NULL when it does
    not parse)."""
    if name in ("station", "metar") + schema.TEXT_INDICATORS:
        return text
    if name == "peak_wind_time":
        local = text.try_cast("timestamp_ntz")
        ts = F.make_timestamp(F.year(local), F.month(local), F.dayofmonth(local), F.hour(local),
                              F.minute(local), F.second(local).cast("decimal(8,6)"), F.lit("UTC"))
        return F.when(local.isNotNull(), ts)
    return _number(text)


def _number(text: Column) -> Column:
    """A cell as ``float`` reads it: Java's type suffixes (1.5d) are no numbers."""
    ends = lambda c: F.endswith(text, F.lit(c))
    suffix = (ends("d") | ends("D") | ends("f") | ends("F")) & (F.lower(F.substring(text, -3, 3)) != "inf")
    # a failed cast costs an exception, so the null tokens are looked at first
    return F.when(~(text.isin(*schema.NULL_TOKENS, "") | suffix), text.try_cast("float"))


def parse_metar(raw: DataFrame, *, strict: bool = True, valid_struct: bool = False,
                keep: Sequence[str] = ()) -> DataFrame:
    """Typed observations from a text DataFrame (column order free).

    ``valid_struct`` emits ``valid`` as a struct of the five time parts and
    keeps the raw ``metar`` text, instead of five separate columns.
    ``keep`` names extra columns passed through unchanged (``_seq`` always is).

    One filter and one projection.  Each output column is a self-contained
    expression on the raw cells, its strict check included, so no check is
    lost when a query reads only some columns.  (A chain of projections
    carrying text and typed copies of every column compiles to one method too
    large for the JIT.)
    """
    if "valid" not in raw.columns:
        raise ValueError("input has no 'valid' column")
    compiled_methods(raw.sparkSession)
    value_cols = [c for c in schema.OBS_COLUMNS if c not in schema.TIME_PARTS]
    text_cols = value_cols + (["metar"] if valid_struct else [])
    passthrough = [c for c in keep if c in raw.columns] + ([SEQ] if SEQ in raw.columns and SEQ not in keep else [])

    parts = F.split(_valid_prefix(), "[-: ]")
    part_text = {n: parts[i] for i, n in enumerate(schema.TIME_PARTS)}
    times = {n: t.try_cast("int") for n, t in part_text.items()}
    is_text = lambda c: c in ("station", "metar") + schema.TEXT_INDICATORS
    present = {c: (F.col(c) if c in raw.columns else F.lit(None).cast("string")) for c in text_cols}
    # Text cells map the null tokens to NULL; typed cells need no such step,
    # as the tokens do not parse and become NULL anyway.
    typed = {c: (_cell(raw, c) if is_text(c) else _typed(c, present[c])) for c in text_cols}

    def given(c: str) -> Column:
        return present[c].isNotNull() & ~present[c].isin(*schema.NULL_TOKENS, "")

    def typed_as(c: str) -> str:
        return "timestamp" if c == "peak_wind_time" else "float"

    def failure(what: str) -> Column:
        """A short message keeps the generated code small: station and time locate the row."""
        return F.raise_error(F.concat(F.lit(f"unparsable METAR row ({what}) at station "), F.coalesce(F.col("station"), F.lit("NULL")),
                                      F.lit(", valid "), F.col("valid")))

    no_position = typed["lat"].isNull() | typed["lon"].isNull()
    no_time = F.lit(False)
    for n in schema.TIME_PARTS:
        no_time = no_time | times[n].isNull()
    if strict:
        bad_time, bad_position = failure("bad timestamp"), failure("NULL position or bad number")
        times = {n: F.when(no_time, bad_time).when(no_position, bad_position).otherwise(t) for n, t in times.items()}
        for c in text_cols:
            if c in ("lat", "lon"):
                typed[c] = F.when(no_position, bad_position).when(no_time, bad_time).otherwise(typed[c])
            elif not is_text(c) and c in raw.columns:
                typed[c] = F.coalesce(typed[c], F.when(given(c), failure(f"bad value of {c}")).cast(typed_as(c)))

    cols: list[Column] = []
    for name in schema.OBS_COLUMNS:
        if name == "year":
            tcols = [times[n].alias(n) for n in schema.TIME_PARTS]
            cols.extend([F.struct(*tcols).alias("valid")] if valid_struct else tcols)
        elif name not in schema.TIME_PARTS:
            cols.append(typed[name].alias(name))
    if valid_struct:
        cols.append(typed["metar"].alias("metar"))
    usable = F.col("valid").rlike(schema.VALID_PATTERN)
    return raw.filter(usable if strict else usable & ~(no_time | no_position)).select(*cols, *passthrough)


def metar_rejects(raw: DataFrame, *, strict: bool = True) -> DataFrame:
    """The raw rows that ``parse_metar`` drops, with a ``reject_reason``.

    A row is rejected for a timestamp that does not match; in lenient mode
    also for a time part that does not fit an int, or a missing position
    (strict mode raises on both instead).
    """
    compiled_methods(raw.sparkSession)
    bad_time = ~valid_ok(raw)
    no_pos = F.lit(False)
    if not strict:
        parts = F.split(_valid_prefix(), "[-: ]")
        for i in range(len(schema.TIME_PARTS)):
            bad_time = bad_time | F.get(parts, F.lit(i)).try_cast("int").isNull()
        no_pos = _number(_cell(raw, "lat")).isNull() | _number(_cell(raw, "lon")).isNull()
    reason = F.when(bad_time, F.lit("bad timestamp")).when(no_pos, F.lit("null position"))
    return raw.filter(bad_time | no_pos).withColumn("reject_reason", reason)


def read_metar(spark: SparkSession, path: str | Sequence[str], *, strict: bool = True,
               valid_struct: bool = False, limit: int | None = None) -> DataFrame:
    """Scan and parse METAR CSV files; the result carries ``_seq`` (file order)."""
    return parse_metar(read_raw(spark, path, limit=limit), strict=strict, valid_struct=valid_struct)
