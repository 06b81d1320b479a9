"""Language identification with a string kernel.

The kernel is the blended spectrum kernel on presence: two texts share a
feature for every byte n-gram (n = 1 to 3) that both contain, and the count is
divided by the geometric mean of their own counts.  Letters are folded to
lower case (those of ASCII and Latin-1; others count as they are) and all else of
ASCII is a blank, so numbers, markup and punctuation do not count.  N-grams are hashed to ``BUCKETS`` buckets.

A Nyström approximation keeps the kernel matrix small: every text is compared
with a fixed set of landmark texts only, in batches, as one matrix product.
One-versus-rest kernel ridge regression on these columns gives a margin per
language; the prediction is the largest margin, the score its softmax.

Training looks at a bounded sample: ``per_language`` texts of each language,
the smallest by a hash of their id.  Their presence bits (2 KB each) are all
that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weatherlake.llm import textarrays as ta
from weatherlake.llm.shared import extended, modest_batches, table, tidy

BUCKETS = 1 << 14
BATCH_ROWS = 64
UNKNOWN = "und"


def _fold_table() -> np.ndarray:
    t = np.full(256, 0x20, np.uint8)
    t[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    t[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    t[0x80:] = np.arange(0x80, 0x100)
    return t


_FOLD = _fold_table()


def folded(data: np.ndarray, table: np.ndarray = _FOLD) -> np.ndarray:
    """Bytes with ASCII and Latin-1 letters in lower case, blanks for the rest of ASCII."""
    out = table.take(data)
    if len(data) > 1:
        second = out[1:]
        upper = (data[:-1] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
        second[upper] += 0x20
    return out


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 0/1 row of n-gram buckets for every text."""
    rows = len(offsets) - 1
    x = np.zeros((rows, BUCKETS), np.float32)
    flat, text = x.reshape(-1), folded(data).astype(np.uint32)
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(offsets))
    gram = np.zeros(len(text), np.uint32)
    for n in (1, 2, 3):
        if len(text) < n:
            break
        gram = (gram[:len(text) - n + 1] << np.uint32(8)) | text[n - 1:]
        bucket = ((gram + np.uint32(n << 24)) * np.uint32(0x9E3779B1)) >> np.uint32(18)
        inside = row[n - 1:] == row[:len(row) - n + 1]
        flat[(row[:len(bucket)] * BUCKETS + bucket)[inside]] = 1
    return x


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    landmarks: np.ndarray  # packed presence bits, one row per landmark
    weights: np.ndarray  # landmarks x languages
    temperature: float = 0.25

    def scorer(self) -> Callable[[np.ndarray], np.ndarray]:
        """Presence rows -> probabilities per language, as two matrix products."""
        marks = np.unpackbits(self.landmarks, axis=1).astype(np.float32)
        marks = np.ascontiguousarray((marks / np.sqrt(np.maximum(marks.sum(1, keepdims=True), 1))).T)

        def score(x: np.ndarray) -> np.ndarray:
            own = np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
            margins = ((x @ marks) / own).astype(np.float64) @ self.weights / self.temperature
            e = np.exp(margins - margins.max(1, keepdims=True))
            return e / e.sum(1, keepdims=True)

        return score


def _batches(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    for i, j in ta.slices(offsets):
        for a in range(i, j, BATCH_ROWS):
            yield a, min(a + BATCH_ROWS, j)


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = ta.buffers(batch.column(1))
        for i, j in _batches(offsets):
            x = presence(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            packed = [r.tobytes() for r in np.packbits(x.astype(bool), axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(packed, pa.binary())], names=["lang", "bits"])


def fit_language_model(training: DataFrame, *, id: str = "doc_id", text: str = "text", lang: str = "lang",
                       per_language: int = 400, landmarks_per_language: int = 32, ridge: float = 1e-3) -> LanguageModel:
    """Fit on ``training``; rows with a null text, language or id are left
    out.  At most ``per_language`` texts of each language are used, one of
    each id (the smallest, where rows repeat an id)."""
    rows = (training.select(F.col(lang).alias("lang"), F.xxhash64(id).alias("h"), F.col(text).alias("text"), F.col(id).alias("id"))
            .filter("lang is not null and id is not null and text is not null").drop("id"))
    order = Window.partitionBy("lang").orderBy("h")
    ids = rows.select("lang", "h").distinct()
    # a share of each language that holds four times as many ids on average, so no task sorts
    # more; the shares are one row per language
    shares = ids.groupBy("lang").agg(F.greatest(F.floor(F.count(F.lit(1)) / (4 * per_language)), F.lit(1)).alias("share"))
    chosen = (ids.join(F.broadcast(shares), "lang").filter(F.pmod(F.xxhash64("h"), F.col("share")) == 0)
              .withColumn("r", F.row_number().over(order)).filter(F.col("r") <= per_language).select("lang", "h"))
    # bounded by per_language rows of each language, whatever the size of the table and however often an id repeats
    sample = (rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")
              .mapInArrow(tidy(_bits), "lang string, bits binary").collect())
    sample.sort(key=lambda r: (r.lang, bytes(r.bits)))
    languages = tuple(sorted({r.lang for r in sample}))
    if not languages:
        return LanguageModel((), np.zeros((0, BUCKETS // 8), np.uint8), np.zeros((0, 0)))
    bits = np.frombuffer(b"".join(bytes(r.bits) for r in sample), np.uint8).reshape(len(sample), -1)
    label = np.array([languages.index(r.lang) for r in sample])
    x = np.unpackbits(bits, axis=1).astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    picks = np.random.default_rng(7)
    marks = np.concatenate([np.sort(picks.permutation(np.flatnonzero(label == k))[:landmarks_per_language])
                            for k in range(len(languages))])
    kernel = (x @ x[marks].T).astype(np.float64)
    target = np.where(label[:, None] == np.arange(len(languages)), 1.0, -1.0)
    weight = 1.0 / np.bincount(label)[label]  # every language counts the same
    kw = kernel * weight[:, None]
    system = kw.T @ kernel + ridge * kernel[marks] + 1e-8 * np.eye(len(marks))
    return LanguageModel(languages, bits[marks], np.linalg.solve(system, kw.T @ target))


def _has_letter(batch: pa.Array, i: int, data: np.ndarray) -> bool:
    if np.any((data | 0x20) - 97 < 26):
        return True
    return bool(np.any(data >= 0x80)) and any(c.isalpha() for c in batch[i].as_py())


def identify_language(docs: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` (string) and ``score`` (0 to 1).

    The prediction reads the whole text and nothing else.  A null text, or one
    without any letter, is ``und`` with score 0, and so is every text if the
    model has seen no language.  Equal margins go to the first language in
    alphabetical order.  All rows and columns are kept; a column of the input
    with one of the two names is replaced.
    """
    docs = docs.drop("lang_pred", "score")
    schema = extended(docs.schema, "lang_pred string, score double")
    return docs.mapInArrow(tidy(_predictor(model, docs.columns.index(text))), schema)


def _predictor(model: LanguageModel, column: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            texts = batch.column(column)
            data, offsets = ta.buffers(texts)
            preds: list[str] = []
            scores = np.zeros(len(texts))
            for i, j in _batches(offsets):
                part, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                known = [_has_letter(texts, r, part[at[r - i]:at[r - i + 1]]) for r in range(i, j)]
                if not model.languages:
                    preds += [UNKNOWN] * (j - i)
                    continue
                p = score(presence(part, at))
                best = p.argmax(1)
                scores[i:j] = np.where(known, p[np.arange(j - i), best], 0.0)
                preds += [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(preds, pa.string()), pa.array(scores)],
                                             names=[*batch.schema.names, "lang_pred", "score"])

    return run


def is_held_out(id: str = "doc_id", modulus: int = 4, remainder: int = 2) -> Column:
    """Whether crc32 of the id as text leaves this remainder (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    modest_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", is_held_out())
    model = fit_language_model(docs.filter(~F.col("held_out")))
    return identify_language(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score")
