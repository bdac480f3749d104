"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Statistics of whole texts (character classes, word lengths, repetition, entropy) are transformed
and standardised. Each class has a mean and a covariance shrunk towards the pooled one and towards
its diagonal; its Cholesky factor is computed once and gives Mahalanobis distances. The score is the
logistic of the log-density difference after a one-dimensional calibration on the training rows.

Defined cases: a null text is empty and gets the score its statistics (all zero) have; labels that
are null are not learned from, a doc_id with several labels counts as 1 if any is; without labels of
both classes every score is the share of label 1, or 0.5 if there are none. Repeated rows are scored
one by one; a null doc_id is not held out. Extra columns are ignored. A very long text is a slice of its own, which takes arrays of a
byte for each byte and of some words for each word. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, STEP, U64, id_array, id_column, slices, text_buffer, word_bounds, word_hashes
from .langid import held_out
from .repeats import WORDS

#: Labelled documents that are fitted on at most; shrinkage towards the pooled covariance and its diagonal.
SAMPLE, POOLED, DIAGONAL = 20_000, 0.1, 0.05
THRESHOLD = 0.7
NAMES = ("bytes", "words", "mean_word", "sd_word", "upper", "digit", "mark", "odd_mark", "newline", "sentence", "distinct", "same_line", "short", "entropy", "top_word", "other_byte", "capital", "same_pair", "marked_words", "long_word", "space")


def _class(letters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(letters)] = True
    return out


UPPER, DIGIT = _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class(b"0123456789")
MARK, ODD = _class(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"), _class(b"#$%&*+/<=>@[\\]^_`{|}~!")
STOP, OTHER = _class(b".?!"), np.arange(256) >= 128
ODD_END = ODD | _class(b"!")


def _per_row(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    out, some = np.zeros(len(off) - 1), off[:-1] < off[1:]
    if some.any():
        out[some] = np.add.reduceat(values, off[:-1][some], dtype=np.float64)
    return out


def _distinct(rows: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row, how many distinct keys it has and how often the most frequent one."""
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    if n == 1:  # a long text
        sizes = np.unique(keys, return_counts=True)[1]
        return np.array([float(len(sizes))]), np.array([float(sizes.max())])
    at = np.lexsort((keys, rows))
    r, k = rows[at], keys[at]
    new = np.concatenate([[True], (r[1:] != r[:-1]) | (k[1:] != k[:-1])])
    heads = np.flatnonzero(new)
    size = np.diff(np.append(heads, len(r)))
    most = np.zeros(n)
    np.maximum.at(most, r[heads], size)
    return np.bincount(r[heads], minlength=n).astype(float), most


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Rows by statistics, transformed but not standardised."""
    n = len(off) - 1
    starts, ends, words = word_bounds(data, off, IS_SPACE)
    size = np.diff(off).astype(float)
    count = np.diff(words).astype(float)
    length = (ends - starts).astype(float)
    row = np.repeat(np.arange(n), np.diff(words))
    hashes = word_hashes(data, starts, ends, WORDS, True)
    share = lambda table: _per_row(table[data], off) / np.maximum(size, 1)
    each = np.maximum(count, 1)
    mean = _per_row(length, words) / each
    spread = np.sqrt(np.maximum(_per_row(length**2, words) / each - mean**2, 0))
    last, first = (data[ends - 1], data[starts]) if len(starts) else (data[:0], data[:0])
    distinct, top = _distinct(row, hashes, n)
    pair_row, pairs = (row[1:], hashes[1:] * U64(3) + hashes[:-1]) if len(row) else (row, hashes)
    inside = pair_row == row[:-1] if len(row) else np.zeros(0, bool)
    pairs, pair_row = pairs[inside], pair_row[inside]
    distinct_pairs, _ = _distinct(pair_row, pairs, n)
    not_line = np.zeros(256, bool)
    not_line[10] = True
    line_starts, line_ends, lines = word_bounds(data, off, not_line)
    line_row = np.repeat(np.arange(n), np.diff(lines))
    distinct_lines, _ = _distinct(line_row, word_hashes(data, line_starts, line_ends, WORDS), n)
    n_lines = np.diff(lines).astype(float)
    histogram = np.zeros((n, 256))
    for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
        for low in range(a, b, STEP):  # counting widens what it counts to eight bytes
            histogram[i] += np.bincount(data[low : min(b, low + STEP)], minlength=256)
    p = histogram / np.maximum(size, 1)[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
    ratio = lambda a, b: a / np.maximum(b, 1)
    per_word = lambda hit: ratio(_per_row(hit, words), count)
    root = np.sqrt
    return np.column_stack(
        [
            np.log1p(size), np.log1p(count), np.log1p(mean), np.log1p(spread), root(share(UPPER)), root(share(DIGIT)), root(share(MARK)), root(share(ODD)), root(share(not_line)),
            root(per_word(STOP[last])), ratio(np.log1p(distinct), np.log1p(count) + 1e-9 + (count == 0)), root(1 - ratio(distinct_lines, n_lines) * (n_lines > 0) - (n_lines == 0)),
            per_word(length <= 3), entropy, root(ratio(top, count)), root(share(OTHER)), root(per_word(UPPER[first])), root(np.clip(1 - ratio(distinct_pairs, count - 1), 0, 1) * (count > 1)),
            root(per_word(ODD_END[last])), root(per_word(length > 20)), root(share(IS_SPACE)),
        ]
    )


@dataclass
class Gaussian:
    mean: np.ndarray
    factor: np.ndarray
    log_det: float

    @classmethod
    def of(cls, x: np.ndarray, pooled: np.ndarray) -> Gaussian:
        cov = np.cov(x.T, bias=True) if len(x) > 1 else pooled
        cov = (1 - POOLED) * cov + POOLED * pooled
        cov = (1 - DIAGONAL) * cov + DIAGONAL * np.diag(np.diag(cov)) + 1e-4 * np.eye(len(cov))
        factor = np.linalg.cholesky(cov)
        return cls(x.mean(axis=0), np.linalg.inv(factor), 2 * float(np.log(np.diag(factor)).sum()))

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.factor.T
        return -0.5 * ((z * z).sum(axis=1) + self.log_det)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    good: Gaussian | None
    bad: Gaussian | None
    slope: float
    offset: float

    def difference(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        d = self.good.log_density(z) - self.bad.log_density(z)
        return np.sign(d) * np.log1p(np.abs(d))

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.offset + (self.slope * self.difference(x) if self.good else np.zeros(len(x)))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def calibrate(d: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one number, by Newton steps with a little ridge."""
    w = np.array([1.0, 0.0])
    x = np.column_stack([d, np.ones(len(d))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w + np.linalg.solve(h, x.T @ (y - p) - 1e-3 * w)
    return max(float(w[0]), 1e-3), float(w[1])


def fit_rows(x: np.ndarray, y: np.ndarray) -> Model:
    k = x.shape[1] if x.ndim == 2 and len(x) else len(NAMES)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
        return Model(np.zeros(k), np.ones(k), None, None, 1.0, float(np.log(share / (1 - share))))
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    z = np.clip((x - mean) / scale, -8, 8)
    pooled = sum(np.cov(z[y == c].T, bias=True) * (y == c).mean() if (y == c).sum() > 1 else 0 for c in (0, 1)) + 1e-6 * np.eye(k)
    model = Model(mean, scale, Gaussian.of(z[y == 1], pooled), Gaussian.of(z[y == 0], pooled), 1.0, 0.0)
    model.slope, model.offset = calibrate(model.difference(x), y)
    return model


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 4 << 20):
        x = statistics(*text_buffer(batch.column(1)))
        yield pa.record_batch([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "x"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from at most sample labelled documents that are not held out, chosen by the hash of their ids."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    y_of = {r[0]: r[1] for r in chosen}
    ids = docs.sparkSession.createDataFrame([(i,) for i in y_of], "doc_id long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id", "left_semi").mapInArrow(_features, "doc_id long, x array<double>")
    # an id that several rows have is learned from once, so no more than the sample reaches the driver
    rows = rows.groupBy("doc_id").agg(F.min("x").alias("x")).toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    return fit_rows(np.array(rows.x.tolist()).reshape(len(rows), len(NAMES)), np.array([y_of[i] for i in rows.doc_id], float))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4 << 20):
            p = shared.value.score(statistics(*text_buffer(batch.column(1))))
            yield pa.record_batch([id_column(id_array(batch.column(0))), pa.array(p, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
