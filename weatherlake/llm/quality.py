"""Document quality from a linear-chain conditional random field over lines.

Every line has a hidden label, good or bad.  The potentials of a line are
linear in simple features of the line and of the lines before and after it
(shares of byte classes, word lengths, repeated words and lines, length); a
2 x 2 matrix scores neighbouring labels.  Forward-backward gives each line's
marginal; their mean, weighted by line length, is the quality of the document,
mapped to a probability by a logistic calibration.

Only documents are labelled, so in training every line carries its document's
label.  Training uses a bounded sample (``train_docs`` labelled documents, the
smallest by a hash of their id); line features (not texts) reach the driver.
All documents of a batch run through the chain together, one line at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from weatherlake.llm import textarrays as ta
from weatherlake.llm.language import is_held_out
from weatherlake.llm.shared import extended, modest_batches, smallest_by_hash, table, tidy

# byte classes: what stands in a text besides lower-case letters
_CLASSES = ["other", "lower", "upper", "digit", "blank", "point", "exclaim", "bar", "sign", "quote", "high"]
_OWN = len(_CLASSES) - 1 + 8  # shares, then length, words, word length, short, repeats, distinct words, end, start
_STEPS = (0.01, 0.05, 0.2)


def _class_table() -> np.ndarray:
    t = np.zeros(256, np.int64)
    groups = {1: range(97, 123), 2: range(65, 91), 3: range(48, 58), 4: [9, 10, 11, 12, 13, 32], 5: b".,;:?-", 6: b"!",
              7: b"|", 8: b"#$%&*+=<>@^~_/\\{}[]", 9: b"\"'()`", 10: range(128, 256)}
    for k, chars in groups.items():
        t[list(chars)] = k
    return t


_CLASS = _class_table()


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every non-blank line (lines x features, with those of the
    two neighbours), their lengths in bytes and the line ranges of the rows."""
    starts, ends, _ = ta.spans(data != 10, offsets)
    ws, we, wh, _ = ta.words(data, offsets)
    full = np.searchsorted(ws, ends) > np.searchsorted(ws, starts)
    starts, ends = starts[full], ends[full]
    ranges = np.searchsorted(starts, offsets)
    if len(starts) == 0:
        return np.zeros((0, 0), np.float32), np.zeros(0), ranges
    length = ends - starts
    line = np.repeat(np.arange(len(starts)), length)
    at = np.arange(len(line)) + np.repeat(starts - np.concatenate(([0], np.cumsum(length)[:-1])), length)
    k = len(_CLASSES)
    counts = np.bincount(line * k + _CLASS[data[at]], minlength=len(starts) * k).reshape(-1, k).astype(np.float32)
    first = np.searchsorted(ws, np.append(starts, len(data)))
    n_words = np.diff(first)
    shares = np.delete(counts, 4, axis=1) / np.maximum(counts.sum(1, keepdims=True) - counts[:, 4:5], 1)
    of_line = np.repeat(np.arange(len(starts)), n_words)
    keyed = np.sort((of_line.astype(np.uint64) << np.uint64(40)) | (wh >> np.uint64(24)))
    fresh = np.concatenate(([True], keyed[1:] != keyed[:-1])) if len(keyed) else np.zeros(0, bool)
    distinct = np.bincount((keyed[fresh] >> np.uint64(40)).astype(np.int64), minlength=len(starts))
    word_len = np.bincount(of_line, we - ws, minlength=len(starts)) / np.maximum(n_words, 1)
    short = np.bincount(of_line, (we - ws) <= 3, minlength=len(starts)) / np.maximum(n_words, 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(ranges))
    text_hash = ta.hashes(data, starts, ends) + row.astype(np.uint64)
    _, which, copies = np.unique(text_hash, return_inverse=True, return_counts=True)
    head = np.zeros(len(starts), bool)
    tail = np.zeros(len(starts), bool)
    full = np.flatnonzero(np.diff(ranges))
    head[ranges[full]] = True
    tail[ranges[full + 1] - 1] = True
    own = np.column_stack([shares, np.log1p(length) / 8, np.log1p(n_words) / 6, np.minimum(word_len, 30) / 10, short,
                           (copies[which] > 1), distinct / np.maximum(n_words, 1), tail, head]).astype(np.float32)
    bent = np.column_stack([own, *[own[:, 1:k - 1] > s for s in _STEPS], (own[:, k - 1 + 5:k - 1 + 6] < 0.5)]).astype(np.float32)
    before, after = np.zeros_like(bent), np.zeros_like(bent)
    before[1:], after[:-1] = bent[:-1], bent[1:]
    before[head], after[tail] = 0, 0
    return np.column_stack([np.ones(len(bent), np.float32), bent, before, after]), length.astype(float), ranges


def _padded(values: np.ndarray, ranges: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Line values of some rows as time x row, and which entries exist."""
    count = np.diff(ranges)[rows]
    t = int(count.max(initial=0))
    at = ranges[:-1][rows][None, :] + np.arange(t)[:, None]
    mask = np.arange(t)[:, None] < count[None, :]
    return np.where(mask, values[np.minimum(at, len(values) - 1)], 0.0), mask


def chain_marginals(gain: np.ndarray, mask: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward for two labels.

    ``gain``: log-odds of good from the line itself (time x row), ``pair``:
    2 x 2 transition scores.  Returns the marginals of good (time x row), the
    log partition function per row and expected transitions (2 x 2, summed).
    """
    t, n = gain.shape
    e = np.stack([np.zeros_like(gain), gain], -1)
    alpha, beta = np.empty((t, n, 2)), np.zeros((t, n, 2))
    alpha[0] = e[0]
    for i in range(1, t):
        step = np.logaddexp(alpha[i - 1][:, :1] + pair[0], alpha[i - 1][:, 1:] + pair[1]) + e[i]
        alpha[i] = np.where(mask[i][:, None], step, alpha[i - 1])
    for i in range(t - 2, -1, -1):
        ahead = e[i + 1] + beta[i + 1]
        step = np.logaddexp(pair[:, 0] + ahead[:, :1], pair[:, 1] + ahead[:, 1:])
        beta[i] = np.where(mask[i + 1][:, None], step, 0.0)
    z = np.logaddexp(alpha[-1][:, 0], alpha[-1][:, 1])
    # alpha stands still past a row's end, so its last value is the row's total
    good = np.where(mask, 1 / (1 + np.exp(np.clip(alpha[..., 0] + beta[..., 0] - alpha[..., 1] - beta[..., 1], -500, 500))), 0.0)
    moves = np.zeros((2, 2))
    if t > 1:
        for a in (0, 1):
            for b in (0, 1):
                lp = alpha[:-1, :, a] + pair[a, b] + e[1:, :, b] + beta[1:, :, b] - z
                moves[a, b] = np.exp(np.where(mask[1:], lp, -np.inf)).sum()
    return good, z, moves


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    pair: np.ndarray
    slope: float
    shift: float
    prior: float

    def documents(self, x: np.ndarray, length: np.ndarray, ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Raw quality (mean log-odds is calibrated from it), line marginals,
        and the probability per document."""
        rows = np.flatnonzero(np.diff(ranges))
        marginal = np.zeros(len(length))
        raw = np.full(len(ranges) - 1, np.nan)
        if len(rows):
            gain = x @ self.weights
            for part in np.array_split(rows[np.argsort(np.diff(ranges)[rows], kind="stable")], max(1, len(rows) // 256)):
                g, mask = _padded(gain, ranges, part)
                good, _, _ = chain_marginals(g, mask, self.pair)
                w, _ = _padded(length, ranges, part)
                raw[part] = (good * w).sum(0) / w.sum(0)
                at = ranges[:-1][part][None, :] + np.arange(len(mask))[:, None]
                marginal[at[mask]] = good[mask]
        p = 1 / (1 + np.exp(-(self.slope * _logit(raw) + self.shift)))
        return raw, marginal, np.where(np.isnan(raw), self.prior, p)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p) - np.log1p(-p)


def _fit_chain(x: np.ndarray, label: np.ndarray, ranges: np.ndarray, rounds: int, decay: float) -> tuple[np.ndarray, np.ndarray]:
    """Penalised conditional likelihood, by Adam on the whole sample."""
    rows = np.flatnonzero(np.diff(ranges))
    parts = np.array_split(rows[np.argsort(np.diff(ranges)[rows], kind="stable")], max(1, len(rows) // 256))
    w, pair = np.zeros(x.shape[1]), np.zeros((2, 2))
    m, v = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    y = np.repeat(label, np.diff(ranges)).astype(float)
    lines = max(len(y), 1)
    same = np.zeros((2, 2))
    for r in rows:
        same[int(label[r]), int(label[r])] += ranges[r + 1] - ranges[r] - 1
    for step in range(1, rounds + 1):
        gain, error, moves = x @ w, np.zeros(len(y)), np.zeros((2, 2))
        for part in parts:
            g, mask = _padded(gain, ranges, part)
            good, _, mv = chain_marginals(g, mask, pair)
            at = ranges[:-1][part][None, :] + np.arange(len(mask))[:, None]
            error[at[mask]] = y[at[mask]] - good[mask]
            moves += mv
        grad = np.concatenate([x.T @ error / lines - decay * w, ((same - moves) / lines - decay * pair).ravel()])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, pair = w + move[:-4], pair + move[-4:].reshape(2, 2)
    return w, pair


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic calibration, by damped Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * z + b)))
        s = p * (1 - p) + 1e-6
        grad = np.array([((y - p) * z).sum() - 1e-2 * a, (y - p).sum()])
        hess = np.array([[(s * z * z).sum() + 1e-2, (s * z).sum()], [(s * z).sum(), s.sum()]])
        move = np.clip(np.linalg.solve(hess, grad), -1, 1)
        a, b = a + move[0], b + move[1]
    return float(a), float(b)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = ta.buffers(batch.column(1))
        for i, j in ta.slices(offsets):
            x, length, ranges = line_features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i),
                 pa.array([x[a:b].astype(np.float16).tobytes() for a, b in zip(ranges[:-1], ranges[1:], strict=True)], pa.binary()),
                 pa.array([length[a:b].tobytes() for a, b in zip(ranges[:-1], ranges[1:], strict=True)], pa.binary())],
                names=["label", "x", "n"])


def fit_quality_model(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text",
                      label: str = "quality", train_docs: int = 3000, rounds: int = 120, decay: float = 1e-4) -> QualityModel:
    """Fit on the labelled documents (label 0 or 1; others, null ids and null
    texts are left out), at most ``train_docs`` of them, one text of each id (the
    smallest, where rows repeat an id).  Without both labels
    the score is constant: the share of label 1, or one half without any."""
    known = (labels.filter(F.col(label).isin(0, 1) & F.col(id).isNotNull()).groupBy(F.col(id).alias("id"))
             .agg(F.min(label).cast("int").alias("label")))
    chosen = smallest_by_hash(known, F.xxhash64("id"), train_docs, "id")
    # bounded by train_docs rows, whatever the size of the tables and however often an id repeats
    sample = (docs.select(F.col(id).alias("id"), F.col(text).alias("text")).filter("text is not null")
              .join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("label").alias("label"), F.min("text").alias("text")).select("label", "text").mapInArrow(tidy(_extract), "label int, x binary, n binary").collect())
    sample.sort(key=lambda r: (r.label, bytes(r.x)))
    y = np.array([r.label for r in sample], float)
    prior = float(y.mean()) if len(y) else 0.5
    length = np.frombuffer(b"".join(bytes(r.n) for r in sample), float)
    if len(set(y)) < 2 or len(length) == 0:
        flat = float(_logit(np.array(prior)))
        return QualityModel(np.zeros(1 + 3 * _width()), np.zeros((2, 2)), 0.0, flat, prior)
    ranges = np.concatenate(([0], np.cumsum([len(r.n) // 8 for r in sample])))
    x = np.frombuffer(b"".join(bytes(r.x) for r in sample), np.float16).reshape(len(length), -1).astype(np.float32)
    w, pair = _fit_chain(x, y, ranges, rounds, decay)
    raw, _, _ = QualityModel(w, pair, 1.0, 0.0, prior).documents(x, length, ranges)
    there = ~np.isnan(raw)
    slope, shift = _platt(_logit(raw[there]), y[there])
    return QualityModel(w, pair, slope, shift, prior)


def _width() -> int:
    x, _, _ = line_features(np.frombuffer(b"a", np.uint8), np.array([0, 1]))
    return (x.shape[1] - 1) // 3


def score_quality(docs: DataFrame, model: QualityModel, *, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (probability of label 1), ``predicted`` (1 if
    the score reaches ``threshold``) and ``line_good`` (the marginal of every
    non-blank line, in order).

    Null, empty and blank-line texts have no lines: they score the share of
    label 1 in training.  All rows and columns are kept; input columns with
    one of the three names are replaced.
    """
    docs = docs.drop("score", "predicted", "line_good")
    schema = extended(docs.schema, "score double, predicted int, line_good array<float>")
    column = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = ta.buffers(batch.column(column))
            for i, j in ta.slices(offsets):
                x, length, ranges = line_features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                _, marginal, p = model.documents(x, length, ranges)
                lines = pa.ListArray.from_arrays(pa.array(ranges.astype(np.int32)), pa.array(marginal.astype(np.float32)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(i, j - i).columns, pa.array(p), pa.array((p >= threshold).astype(np.int32)), lines],
                    names=[*batch.schema.names, "score", "predicted", "line_good"])

    return docs.mapInArrow(tidy(run), schema)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    modest_batches(spark)
    held_out = is_held_out("doc_id", 5, 0)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = fit_quality_model(docs, labels.filter(~held_out))
    return score_quality(docs.withColumn("held_out", held_out), model).select("doc_id", "held_out", "score", "predicted")
