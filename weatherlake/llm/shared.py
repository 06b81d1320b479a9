"""Helpers that several operators of this package use."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def _shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a folder of our own is set only
    where neither the session nor the configuration has one (tests)."""
    if not spark.sparkContext.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


_last_sweep = [0.0]


def _sweep(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps.  It does so when
    the driver collects its garbage, which a driver with little to do hardly
    ever does by itself; asked for every few seconds at most."""
    if time.monotonic() - _last_sweep[0] > 4:
        gc.collect()
        spark.sparkContext._jvm.java.lang.System.gc()
        _last_sweep[0] = time.monotonic()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    _shared_folder(spark)
    out = df.checkpoint(eager=True)
    del df  # else its own shuffle files stay until a later sweep
    _sweep(spark)
    return out


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage of a large frame: a Parquet table in the shared folder,
    smaller than a checkpoint and read by column.  It stays there until the
    folder is cleared."""
    spark = df.sparkSession
    path = f"{_shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    del df
    _sweep(spark)
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def extended(schema: T.StructType, more: str) -> T.StructType:
    """A schema with further columns (as DDL) at its end."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(more).fields])


def tidy(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that gives unused memory back when its
    task ends: Python workers stay for later tasks."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only the C library of Linux has it
                ctypes.CDLL(None).malloc_trim(0)
    return wrapped


def smallest_by_hash(df: DataFrame, hashed: Column, n: int, *order: str) -> DataFrame:
    """At most ``n`` rows chosen by hash: a bounded sample, the same whenever
    the rows are the same.  Of a share of the hash range that holds four times as
    many rows on average those of smallest hash are taken, so neither the
    driver nor one task sees more than that, however many tasks there are."""
    total = df.count()
    share = max(total // (4 * n), 1)
    few = df.withColumn("_hash", hashed).filter(F.pmod(F.xxhash64("_hash"), F.lit(share)) == 0)
    return few.orderBy("_hash", *order).limit(n).drop("_hash")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has."""
    out = []
    for name in names:
        while name in df.columns or name in out:
            name += "_"
        out.append(name)
    return out


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], least: int, most_bytes: int | None = None) -> Iterator[pa.Table]:
    """Batches sorted by ``keys`` -> tables of whole groups, with about
    ``least`` rows or more each (the last may have fewer, and those that reach ``most_bytes``)."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(c).to_numpy() for c in keys], 1)
        differs = np.flatnonzero((k != k[-1]).any(1))
        at = int(differs[-1]) + 1 if len(differs) else 0  # where the last group of the batch starts
        goes_on = at == 0 and held and all(held[-1].column(c)[-1] == batch.column(c)[0] for c in keys)
        if not goes_on and rows + at and (rows + at >= least or most_bytes is not None and size + batch.nbytes >= most_bytes):
            yield pa.Table.from_batches(held + ([batch.slice(0, at)] if at else []))
            held, rows, size = [], 0, 0
            batch = batch.slice(at)
        held.append(batch)
        rows += batch.num_rows
        size += batch.nbytes
    if held:
        yield pa.Table.from_batches(held)


def modest_batches(spark: SparkSession) -> None:
    """Texts are long: smaller Arrow batches than the default keep the memory
    of executors and their Python workers low.  Lower settings are kept."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= 1000:
        spark.conf.set(key, "1000")


MOST_BITS = 1 << 27
_RANGES = 64


class Bloom:
    """A two-hash Bloom filter of a long column of hashes.

    About sixteen bits per key, at most ``MOST_BITS`` (16 MB).  The bits are
    set on the executors, one task per range of them; the driver gets the
    ranges, so a bounded number of bytes whatever the number of keys.  A full
    filter passes everything: it only saves shuffling rows that an exact join
    drops afterwards.
    """

    def __init__(self, keys: DataFrame, column: str):
        n = max(keys.count(), 1)
        self.bits = min(max(1 << (16 * n - 1).bit_length(), 1 << 16), MOST_BITS)
        width = self.bits // _RANGES
        slots = F.explode(F.array(F.expr(f"pmod({column}, {self.bits}L)"), F.expr(f"pmod(shiftright({column}, 32), {self.bits}L)")))
        parts = (keys.select(slots.alias("slot")).select(F.expr(f"cast(slot div {width} as int)").alias("at"), F.expr(f"slot % {width}").alias("slot"))
                 .repartition("at").sortWithinPartitions("at").mapInArrow(tidy(_bit_range(width)), "at int, bits binary").collect())
        packed = np.zeros(self.bits // 8, np.uint8)
        for r in parts:
            packed[r["at"] * (width // 8):(r["at"] + 1) * (width // 8)] |= np.frombuffer(bytes(r["bits"]), np.uint8)
        self.packed = keys.sparkSession.sparkContext.broadcast(packed)

    def test(self) -> Callable[[np.ndarray], np.ndarray]:
        """A function of int64 hashes: which of them may be among the keys."""
        packed, mask = self.packed, self.bits - 1

        def passes(keys: np.ndarray) -> np.ndarray:
            bits = packed.value

            def hit(slot: np.ndarray) -> np.ndarray:
                return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1

            out = hit(keys & mask)
            some = np.flatnonzero(out)
            out[some] = hit((keys[some] >> 32) & mask)
            return out

        return passes

    def condition(self, column: str | Column) -> Column:
        """The test as a condition on a long column."""
        test = self.test()

        @F.pandas_udf("boolean")
        def passes(s: pd.Series) -> pd.Series:
            return pd.Series(test(s.to_numpy(dtype=np.int64)))

        return passes(column)


def _bit_range(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, bits = None, np.zeros(0, bool)

        def out() -> pa.RecordBatch:
            packed = np.packbits(bits, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([packed], pa.binary())], names=["at", "bits"])

        for batch in batches:
            where, slot = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a in np.unique(where).tolist():
                if a != at:
                    if at is not None:
                        yield out()
                    at, bits = a, np.zeros(width, bool)
                bits[slot[where == a]] = True
        if at is not None:
            yield out()
    return run
