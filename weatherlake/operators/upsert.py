"""Upserts: what a keyed table holds after rows are written to it in order.

Writing a row on an existing key replaces the whole row, NULL cells included
(``upsert_last``).  A writer that leaves cells unset instead keeps the earlier
values of those cells (``upsert_partial``).

"In order" needs an explicit total order: distributed input has no row
number, so callers pass ordering columns (``_seq`` from the CSV scan, or any
unique combination).  ``upsert_last`` is one keyed aggregation with a partial
aggregate before the shuffle: where keys have many copies, each map task
collapses its own first, so a key holding a third of all rows ships one row per
task (on a nearly unique key the partial step saves nothing).
``upsert_partial`` needs the rows of a key in order and shuffles each once;
keys with very many rows are folded in chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weatherlake.session import materialize


def _order(order: Sequence[str | Column] | str | Column) -> Column:
    if isinstance(order, (str, Column)):
        order = [order]
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    if not cols:
        raise ValueError("an explicit order is required to decide which write is last")
    return F.struct(*cols)


def _check_key(df: DataFrame, key: Sequence[str]) -> None:
    missing = [k for k in key if k not in df.columns]
    if missing:
        raise ValueError(f"key columns not in input: {missing}")


def _group(df: DataFrame, key: Sequence[str]):
    """Group by a 64-bit hash of the key ahead of the key itself.  The groups
    are the same (the key columns still decide them), but the sort-based
    aggregate that ``max_by`` of a whole row needs then compares a
    near-unique 8-byte prefix instead of falling back to full comparisons of
    a composite key whose first column has few distinct values."""
    return df.groupBy(F.xxhash64(*[F.col(k) for k in key]).alias("_key_hash"), *key)


def upsert_last(df: DataFrame, key: Sequence[str], order: Sequence[str | Column] | str | Column,
                *, count_as: str | None = None) -> DataFrame:
    """One row per key: the row that is greatest in ``order`` (written last),
    with all its cells, NULLs included.  Column order is kept.

    ``count_as`` adds a column with the number of rows written on the key.
    """
    _check_key(df, key)
    payload = [c for c in df.columns if c not in key]
    n = [F.count(F.lit(1)).alias(count_as)] if count_as else []
    if not payload:
        return df.groupBy(*key).agg(*n) if n else df.select(*key).distinct()
    agg = _group(df, key).agg(F.max_by(F.struct(*payload), _order(order)).alias("_last"), *n)
    return agg.select(*[F.col(c) if c in key else F.col("_last")[c].alias(c) for c in df.columns],
                      *([count_as] if count_as else []))


def _last_set(df: DataFrame, key: Sequence[str], part: Sequence[str], order: Column) -> DataFrame:
    """Per key and part, the latest set value of every cell; ``order`` and
    further columns of the part are those of the last row."""
    so_far = Window.partitionBy(*key, *part).orderBy(order)
    kept = [c for c in df.columns if c not in key and c not in part]
    cells = [F.last(c, ignorenulls=True).over(so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(c) for c in kept]
    out = df.select(*key, *part, *cells, F.lead(F.lit(1)).over(so_far).alias("_next"))
    return out.filter(F.col("_next").isNull()).drop("_next")


def upsert_partial(df: DataFrame, key: Sequence[str], order: Sequence[str | Column] | str | Column, *,
                   hot_rows: int = 1_000_000) -> DataFrame:
    """One row per key where each cell is the latest non-NULL value written
    to it (NULL means "unset"); a cell never set stays NULL.

    Each row is shuffled once and carries its order once.  The rows of a key
    are sorted in place and read as a stream, so a key with many writes costs
    no memory.  "Latest set" is associative: rows of a key may be folded in
    consecutive chunks first and the chunks in their order then.  Keys with
    more than ``hot_rows`` rows are (their number is counted first, from the
    key columns alone): their rows are dealt out by ranges of ``order``, each
    chunk is folded by itself, and one row per chunk meets in the end.  The
    result is the same for any ``hot_rows``; it only bounds what one task reads.
    """
    _check_key(df, key)
    if hot_rows < 1:
        raise ValueError("hot_rows must be positive")
    written = df.withColumn("_order", _order(order))
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    hot = materialize(counts.select(*[F.col(k).alias(f"_hot_{k}") for k in key]))
    if hot.isEmpty():
        return _last_set(written, key, [], F.col("_order")).select(*df.columns)

    # few keys hold more than hot_rows rows each; null parts of a key are equal
    is_hot = F.lit(True)
    for k in key:
        is_hot = is_hot & F.col(k).eqNullSafe(F.col(f"_hot_{k}"))
    cold = _last_set(written.join(hot, is_hot, "left_anti"), key, [], F.col("_order"))
    chunks = (written.join(hot, is_hot, "left_semi").repartitionByRange("_order")
              .withColumn("_chunk", F.spark_partition_id()))
    folded = _last_set(chunks, key, ["_chunk"], F.col("_order"))
    return cold.select(*df.columns).unionByName(_last_set(folded, key, [], F.col("_chunk")).select(*df.columns))


def rows_sent_vs_kept(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows written (before key collapse) and rows the table keeps, in one
    pass: ``rows_sent``, ``rows_kept``."""
    _check_key(df, key)
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows_sent"), F.count(F.lit(1)).alias("rows_kept"))
