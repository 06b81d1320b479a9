"""Spelling variants: words one edit apart, by blocked Gram matrices.

A word is the vector of its letter counts.  One replaced code point changes the
squared distance of two such vectors by at most two, an inserted or deleted
one by one, so pairs farther apart than two are out; the squared distances of
a block of words are one matrix product in NumPy.  Pairs that are left are
verified on the code points.

Blocks hold words of two adjacent lengths, ``short`` and ``short + 1``.  All
pairs of such a block would be quadratic in the vocabulary, so each is divided
further, without loss: of two words one edit apart, either the first
``short // 2`` code points are equal or the last ``short - short // 2`` are.  A
word stands in the blocks of its beginning and of its end, for either length
it can be the shorter or the longer word of, and a pair that has both in
common counts in that of the beginning alone.  A block larger than ``TILE`` is
cut into tiles and every pair of tiles is a task's work of its own, so no task
holds more than two tiles however common a beginning is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weatherlake.llm.shared import cut, modest_batches, stored, table, tidy

TILE = 4096  # words of a tile
TOGETHER = 1024  # small blocks share a matrix product up to so many words

NEAR = "word string, n_near long, best_n long, best string"
_PLACE = ("block", "ti", "tj")


class _Words:
    """Words as code points, filled up with -1, from both ends."""

    def __init__(self, words: list[str]):
        self.length = np.array([len(w) for w in words], np.int64)
        width = int(self.length.max()) + 1
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        row = np.repeat(np.arange(len(words)), self.length)
        at = np.arange(len(points)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        self.left, self.right = np.full((len(words), width), -1), np.full((len(words), width), -1)
        self.left[row, at] = points
        self.right[row, self.length[row] - 1 - at] = points
        letters, letter = np.unique(points, return_inverse=True)
        self.counts = np.zeros((len(words), len(letters)), np.float32)
        np.add.at(self.counts, (row, letter), 1)
        self.norm = (self.counts ** 2).sum(1)

    def close(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (positions in ``a`` and ``b``) at a squared distance of at
        most two.  Counts are small whole numbers: exact in float32."""
        gram = self.counts[a] @ self.counts[b].T
        return np.nonzero(self.norm[a][:, None] + self.norm[b] - 2 * gram <= 2)

    def near(self, a: np.ndarray, b: np.ndarray, short: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which pairs are one edit apart and belong to this block."""
        la, lb = self.length[a], self.length[b]
        # different words differ somewhere before the fill of both
        first = (self.left[a] == self.left[b]).argmin(1)
        last = (self.right[a] == self.right[b]).argmin(1)
        one_edit = np.where(la == lb, first + last == la - 1, first + last >= np.minimum(la, lb))
        fits = (np.minimum(la, lb) == short) & (np.abs(la - lb) <= 1)
        half = short // 2
        return one_edit & fits & np.where(ends, (last >= short - half) & (first < half), first >= half)


def _best_of(rows: list[tuple], words: list[str], n: np.ndarray) -> pa.RecordBatch:
    """Pairs of positions -> per word how many are near, and the best of them."""
    a = np.concatenate([r[0] for r in rows] + [r[1] for r in rows])
    b = np.concatenate([r[1] for r in rows] + [r[0] for r in rows])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    start = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    size = np.diff(np.r_[start, len(a)])
    return pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in a[start]], pa.string()), pa.array(size, pa.int64()),
         pa.array(n[b[start]], pa.int64()), pa.array([words[i] for i in b[start]], pa.string())], names=["word", "n_near", "best_n", "best"])


def _pairs_of(words: list[str], n: np.ndarray, place: np.ndarray, tile: np.ndarray, short: np.ndarray,
              ends: np.ndarray) -> pa.RecordBatch | None:
    """Near pairs of some whole blocks.  ``place`` numbers the blocks; a block
    of a pair of tiles has two values of ``tile`` and pairs them only."""
    w = _Words(words)
    found = []
    for lo in range(0, len(words), TOGETHER):
        a = np.arange(lo, min(lo + TOGETHER, len(words)))
        b = np.arange(lo, len(words)) if place[a[0]] == place[-1] else np.arange(lo, np.searchsorted(place, place[a[-1]], "right"))
        i, j = w.close(a, b)
        i, j = a[i], b[j]
        keep = (i < j) & (place[i] == place[j])
        i, j = i[keep], j[keep]
        if len(i):
            # in a pair of different tiles only words of different tiles meet
            mixed = tile[i, 0] != tile[i, 1]
            keep = ~mixed | (tile[i, 2] != tile[j, 2])
            i, j = i[keep], j[keep]
        for part in np.array_split(np.arange(len(i)), len(i) // 100_000 + 1):
            x, y = i[part], j[part]
            if len(x):
                ok = w.near(x, y, short[x], ends[x])
                found.append((x[ok], y[ok]))
    return _best_of(found, words, n) if sum(len(f[0]) for f in found) else None


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block and pair of tiles -> near words, by word and block."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def run(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(parts)
        keys = np.stack([t.column(c).to_numpy() for c in _PLACE], 1)
        place = np.cumsum(np.r_[False, (keys[1:] != keys[:-1]).any(1)])
        tile = np.stack([t.column(c).to_numpy() for c in ("ti", "tj", "t")], 1)
        out = _pairs_of(t.column("word").to_pylist(), t.column("n").to_numpy(), place, tile, t.column("short").to_numpy().astype(np.int64),
                        t.column("ends").to_numpy(zero_copy_only=False).astype(bool))
        if out is not None:
            yield out

    def last_place(batch: pa.RecordBatch) -> int:
        """Where the last block of the batch starts."""
        keys = np.stack([batch.column(c).to_numpy() for c in _PLACE], 1)
        differs = np.flatnonzero((keys != keys[-1]).any(1))
        return int(differs[-1]) + 1 if len(differs) else 0

    def same(a: pa.RecordBatch, b: pa.RecordBatch) -> bool:
        return all(a.column(c)[-1] == b.column(c)[0] for c in _PLACE)

    for batch in batches:
        if not batch.num_rows:
            continue
        at = last_place(batch)
        if at == 0 and held and same(held[-1], batch):
            held.append(batch)
            rows += batch.num_rows
            continue
        if rows + at >= TOGETHER:
            whole = held + ([batch.slice(0, at)] if at else [])
            if whole:
                yield from run(whole)
            held, rows = [batch.slice(at)], batch.num_rows - at
        else:
            held.append(batch)
            rows += batch.num_rows
    if held:
        yield from run(held)


def _blocks(words: DataFrame) -> DataFrame:
    """Every word in its blocks: of its beginning and its end, as the shorter
    and as the longer word, and of large blocks in every pair of its tile."""
    length = F.length("word")
    placed = (words.select("word", "n", F.explode(F.array(length, length - 1)).alias("short"))
              .filter("short > 0")
              .select("word", "n", "short", F.explode(F.array(F.lit(False), F.lit(True))).alias("ends")))
    half = F.floor(F.col("short") / 2).cast("int")
    part = F.when(F.col("ends"), F.expr("right(word, short - cast(floor(short / 2) as int))")).otherwise(F.col("word").substr(F.lit(1), half))
    # equal hashes of different parts cost a comparison and change nothing: the parts themselves are compared
    placed = placed.withColumn("block", F.xxhash64("short", "ends", part))
    large = placed.groupBy("block").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > TILE)
    tiles = F.coalesce(F.ceil(F.col("size") / TILE).cast("int"), F.lit(1))
    dealt = placed.join(large, "block", "left").withColumn("tiles", tiles).withColumn("t", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    return (dealt.select("word", "n", "short", "ends", "block", "t", other.alias("o"))
            .select("word", "n", "short", "ends", "block", "t", F.least("t", "o").alias("ti"), F.greatest("t", "o").alias("tj")))


def near_words(words: DataFrame) -> DataFrame:
    """``words``: word (distinct, not null), n.  Columns ``word``, ``n_near``
    (how many others are one inserted, deleted or replaced code point away),
    ``best`` and ``best_n`` (the one of largest n, ties to the smallest in
    code-point order); words without any are not returned."""
    rows = _blocks(words.select("word", F.col("n").cast("long").alias("n")))
    dealt = rows.repartition("block", "ti", "tj").sortWithinPartitions("block", "ti", "tj")
    parts = dealt.mapInArrow(tidy(_near), NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b")
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("b.word").alias("best"), (-F.col("b.n")).alias("best_n"))


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """``word, form`` -> ``word, root``: the end of the chain of forms.

    n at least doubles (times ``ratio``) with every form, so a chain has at most log2 of
    the largest n links, and each round here doubles what a word has followed.
    """
    roots = cut(forms.select("word", F.col("form").alias("root")))
    followed, longest = 1, max(int(most), 1).bit_length()
    while followed < longest:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        roots = cut(roots.join(on, "root", "left").select("word", F.coalesce("_further", "root").alias("root")))
        followed *= 2
    return roots


def group_variants(words: DataFrame, *, ratio: float = 2.0) -> DataFrame:
    """Words with the form that each is a variant of.

    ``words``: ``word``, ``n`` (occurrences); rows with a null in either are
    left out and rows that repeat a word are added up.  Two words are near if
    they differ by exactly one inserted, deleted or replaced code point.  The
    ``form`` of a word is its near word of largest n (ties: the smallest in
    code-point order) if that n is at least ``ratio`` (2 or more) times its own; ``root``
    is where following forms ends, the word itself without a form.  Returns
    word, form, root, n, n_near, form_n; an empty table gives none.  Further
    columns of the input are not looked at.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    held = stored(words.select("word", "n").dropna().groupBy("word").agg(F.sum("n").cast("long").alias("n")).filter("n > 0"))
    most = held.agg(F.max("n")).first()[0] or 1
    near = near_words(held)
    is_form = F.col("best_n") >= F.lit(float(ratio)) * F.col("n")
    formed = stored(held.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best_n")).cast("long").alias("form_n")))
    roots = _roots(formed.filter("form is not null"), most)
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def count_words(docs: DataFrame, *, id: str = "doc_id", text: str = "text", least_length: int = 5, least_count: int = 3,
                seen_as: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Words of whole texts and how often they occur: ``word``, ``n``.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF, only A-Z
    lower-cased, of at least ``least_length`` code points and with
    ``least_count`` occurrences.  ``seen_as(doc id as text, run)`` may replace a
    run by what counts for it (it is not asked for runs that are too short
    already, so it may only shorten).  A null text has no words; a null id counts as empty text.
    """
    doc = F.coalesce(F.col(id).cast("string"), F.lit("")).alias("doc")
    runs = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit("[a-zÀ-ÿ]{%d,}" % least_length), F.lit(0))
    words = docs.filter(F.col(text).isNotNull()).select(doc, F.explode(runs).alias("run"))
    seen = seen_as(F.col("doc"), F.col("run")) if seen_as else F.col("run")
    return (words.select(seen.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter((F.col("n") >= least_count) & (F.length("word") >= least_length)))


def with_slips(every: int) -> Callable[[Column, Column], Column]:
    """Planted slips: where ``every`` divides h, the crc32 of ``<doc>:<run>``,
    the run lacks its code point h modulo its length."""
    def seen_as(doc: Column, run: Column) -> Column:
        h = F.crc32(F.concat(doc, F.lit(":"), run).cast("binary"))
        at = (h % F.length(run)).cast("int")
        lacking = F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))
        return F.when(h % every == 0, lacking).otherwise(run)
    return seen_as


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    modest_batches(spark)
    return group_variants(count_words(table(spark, sf_dir, "documents"), seen_as=with_slips(97)))
