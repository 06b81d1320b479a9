"""Benchmark decontamination with spaced seeds.

Tokens are runs of letters and digits in lower case.  A seed is a window of
tokens hashed through a fixed mask that ignores some positions, so a changed
word under an ignored position does not hide a hit; several masks cover each
other's blind spots.  Hashes of the benchmark and of the documents are joined
(a Bloom filter of the benchmark's hashes first drops nearly all document
hashes on the executors).  Every hit fixes a diagonal, an offset of an item
against a document, on which the whole overlap is then checked token by token.

A document is contaminated by an item if, on one diagonal,

- a run of tokens that scores highest with +1 for an equal and -4 for a
  different token (so at least four fifths are equal) covers ``MIN_TOKENS``
  tokens, or
- the whole item lies on it and at least four fifths of its tokens are equal.

The second covers short items, and items of a little over ``MIN_TOKENS`` with a
changed word near an end.  Every position of a window is ignored by one of the
masks, so one changed word anywhere leaves a seed of every window intact.
Items that are shorter than the masks have masks of their own length, by the
same rule.  Items of fewer than ``LEAST_TOKENS`` tokens are too common to tell
a leak and are not searched (``least_tokens``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from weatherlake.llm import textarrays as ta
from weatherlake.llm.language import folded
from weatherlake.llm.shared import Bloom, cut, modest_batches, table, tidy
from weatherlake.llm.textarrays import U

# positions that count (1) or are ignored (0) in a window of tokens
MASKS = ("011100111", "101011110", "110111001", "110001111")
MIN_TOKENS = 13
LEAST_TOKENS = 5
UNIT = 256  # hits of a document verified at a time, about
_WITH_DIGITS = folded(np.arange(256, dtype=np.uint8))
_WITH_DIGITS[list(b"0123456789")] = list(b"0123456789")


def folded_tokens(data: np.ndarray) -> np.ndarray:
    """Bytes with letters in lower case, digits, and blanks for the rest of ASCII."""
    return folded(data, _WITH_DIGITS)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows one after another, and the row ranges."""
    low = folded_tokens(data)
    starts, ends, ranges = ta.spans(low != 0x20, offsets)
    return ta.hashes(low, starts, ends), ranges


def short_masks(n: int) -> list[str]:
    """Masks for items of ``n`` tokens: each ignores every third position."""
    return ["".join("0" if k % 3 == r else "1" for k in range(n)) for r in range(3)]


def seed_hashes(h: np.ndarray, ranges: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window that lies within its row, and its first token."""
    care = [k for k, c in enumerate(mask) if c == "1"]
    mult = ta.constants(int(mask, 2) + (len(mask) << 20), len(care) + 1) | U(1)
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    total = np.full(n, mult[-1], U)
    for k, m in zip(care, mult, strict=False):
        total += h[k:k + n] * m
    row_end = np.repeat(ranges[1:], np.diff(ranges))
    at = np.flatnonzero(row_end[:n] - np.arange(n) >= len(mask))
    return ta.mix(total[at]), at


def _seeder(masks: Sequence[str], bloom: Bloom | None) -> Callable:
    """(id, text) -> (key, id, position) of the seeds that the filter lets pass."""
    passes = bloom.test() if bloom else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = ta.buffers(batch.column(1))
            for i, j in ta.slices(offsets):
                h, ranges = tokens(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                row = np.repeat(np.arange(j - i), np.diff(ranges))
                for mask in masks:
                    key, at = seed_hashes(h, ranges, mask)
                    if passes is not None and len(key):
                        some = passes(key.view(np.int64))
                        key, at = key[some], at[some]
                    if len(key):
                        yield pa.RecordBatch.from_arrays(
                            [ta.longs(key), batch.column(0).take(pa.array(row[at] + i)), pa.array(at - ranges[row[at]])],
                            names=["key", "id", "position"])
    return run


def best_run(equal: np.ndarray) -> tuple[int, int, int]:
    """Start, end and equal tokens of the highest-scoring run (+1, -4);
    the first and longest one among equals."""
    total = np.concatenate(([0], np.cumsum(np.where(equal, 1, -4))))
    low = np.minimum.accumulate(total)
    gain = total - low
    end = int(len(gain) - 1 - np.argmax(gain[::-1]))
    start = int(np.argmax(total[:end + 1] == low[end]))
    return start, end, int(equal[start:end].sum())


def overlap(equal: np.ndarray, item: int, min_tokens: int) -> tuple[int, int, int] | None:
    """The overlap on a diagonal, of whose tokens ``equal`` says which agree:
    start, end and equal tokens; None if it does not tell a leak."""
    run = best_run(equal)
    if run[1] - run[0] >= min_tokens:
        return run
    if len(equal) == item and 5 * int(equal.sum()) >= 4 * item:
        return 0, item, int(equal.sum())
    return None


def _verifier(min_tokens: int) -> Callable:
    """(id, text, hits: array<struct<item, item_text, shift>>) -> confirmed overlaps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "item_id", "doc_start", "doc_end", "item_start", "overlap_tokens", "equal_tokens", "item_tokens"]
        for batch in batches:
            out: list[tuple] = []
            data, offsets = ta.buffers(batch.column(1))
            ids, hits = batch.column(0).to_pylist(), batch.column(2)
            for i, j in ta.slices(offsets):
                h, ranges = tokens(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                for r in range(i, j):
                    doc = h[ranges[r - i]:ranges[r - i + 1]]
                    found = hits[r].as_py()
                    best: dict = {}
                    item_data, item_offsets = ta.buffers(pa.array([x["item_text"] for x in found], pa.string()))
                    item_h, item_at = tokens(item_data, item_offsets)
                    for k, hit in enumerate(found):
                        item, shift = item_h[item_at[k]:item_at[k + 1]], hit["shift"]
                        a, b = max(0, -shift), min(len(item), len(doc) - shift)
                        told = overlap(item[a:b] == doc[a + shift:b + shift], len(item), min_tokens) if b > a else None
                        if told is None:
                            continue
                        start, end, equal = told
                        # the earliest of equally good ones, whichever order they come in
                        rank = (equal, end - start, -(a + start + shift), -(a + start))
                        if hit["item"] not in best or rank > best[hit["item"]][0]:
                            best[hit["item"]] = (rank, (ids[r], hit["item"], a + start + shift, a + end + shift,
                                                        a + start, end - start, equal, len(item)))
                    out += [v for _, v in best.values()]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(len(names))], names=names)
    return run


OVERLAPS = ("doc_id long, item_id long, doc_start long, doc_end long, item_start long, overlap_tokens long, "
            "equal_tokens long, item_tokens long")


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, id: str = "doc_id", text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", min_tokens: int = MIN_TOKENS,
                       least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """Overlaps of documents with benchmark items, the best one per pair of ids.

    Columns: ``doc_id``, ``item_id``, ``doc_start``, ``doc_end``,
    ``item_start`` (token positions), ``overlap_tokens``, ``equal_tokens``,
    ``item_tokens``.  Documents without overlap have no row.  Rows with a null
    id or text have none either; repeated rows count once, and rows that share
    an id are one document for this; an empty table on either side gives no
    rows.  Other columns of the inputs are ignored.
    """
    docs = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).dropna()
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).cast("string").alias("text")).dropna().distinct()

    # items too short for the masks get masks of their own length
    width = len(MASKS[0])
    count = items.mapInArrow(tidy(_count_tokens), "id long, text string, n long").filter(F.col("n") >= least_tokens)
    lengths = sorted(r.n for r in count.filter(F.col("n") < width).select("n").distinct().collect())
    kind = "key long, id long, position long"
    seeds = count.filter(F.col("n") >= width).select("id", "text").mapInArrow(tidy(_seeder(MASKS, None)), kind)
    for n in lengths:
        seeds = seeds.unionByName(count.filter(F.col("n") == n).select("id", "text").mapInArrow(tidy(_seeder(short_masks(n), None)), kind))
    seeds = cut(seeds.select("key", F.col("id").alias("item"), F.col("position").alias("item_position")))
    masks = [*MASKS, *[m for n in lengths for m in short_masks(n)]]

    bloom = Bloom(seeds.select("key"), "key")
    hits = docs.mapInArrow(tidy(_seeder(masks, bloom)), kind)
    diagonals = cut(hits.join(seeds, "key").select("id", "item", (F.col("position") - F.col("item_position")).alias("shift")).distinct())
    # a document with many hits is verified in several units, each with its text
    many = diagonals.groupBy("id").agg(F.ceil(F.count(F.lit(1)) / UNIT).alias("units")).filter("units > 1")
    unit = F.pmod(F.xxhash64("item", "shift"), F.coalesce("units", F.lit(1))).alias("unit")
    per_unit = (diagonals.join(many, "id", "left").select("id", unit, "item", "shift")
                .join(items.select(F.col("id").alias("item"), F.col("text").alias("item_text")), "item")
                .groupBy("id", "unit").agg(F.collect_list(F.struct("item", "item_text", "shift")).alias("hits")))
    texts = docs.filter(Bloom(diagonals.select(F.xxhash64("id").alias("h")), "h").condition(F.xxhash64("id")))
    found = texts.join(per_unit, "id").select("id", "text", "hits").mapInArrow(tidy(_verifier(min_tokens)), OVERLAPS)
    columns = [c.split()[0] for c in OVERLAPS.split(", ")]
    rank = F.struct(F.col("equal_tokens").alias("e"), F.col("overlap_tokens").alias("o"), (-F.col("doc_start")).alias("s"),
                    (-F.col("item_start")).alias("i"), F.struct(*columns[2:]).alias("row"))
    return found.groupBy("doc_id", "item_id").agg(F.max(rank).alias("b")).select("doc_id", "item_id", *[F.col(f"b.row.{c}").alias(c) for c in columns[2:]])


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, ranges = tokens(*ta.buffers(batch.column(1)))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.diff(ranges))], names=["id", "text", "n"])


def op2_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    modest_batches(spark)
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
