"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are folded (lower case, everything but letters and marks to spaces) and their n-grams of 1 to 3 characters, and 4
with an edge of a word, are hashed into BUCKETS. A batch becomes sorted (row, bucket) keys and their counts, so memory
follows the characters of a step and not rows times buckets. Document frequencies come from all documents that may be
learned from; the weights are trained on a sample of at most SAMPLE of them, and at most FLOOR more of each language so
that none is missed, by follow-the-regularised-leader with an elastic-net penalty, and a temperature is fitted on a fifth
of each language's sample that the weights have not seen.

Defined cases: a text that is null or has no letter is `und` with score 0; so is every text if nothing can be learned
from; very long texts are counted in steps of STEP bytes; bytes that are no UTF-8 count as spaces; repeated rows are
predicted one by one, ties between languages go to the first by name; a null doc_id is never learned from and is not
held out. Extra columns are ignored by `identify` and kept by `identified`. An empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, id_array, id_column, slices, text_buffer

BITS = 14
BUCKETS = 1 << BITS
#: Labelled documents that the weights are trained on at most, more of them for each language at most, and passes over them.
SAMPLE, FLOOR, EPOCHS = 4000, 50, 2
#: FTRL: step, its offset, L1 and L2.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-5
#: Label mass spread over all languages while the temperature is fitted.
SMOOTH = 0.02
#: Bytes of a slice of rows, and of a step within it: n-grams of a step are in memory at once.
SLICE, STEP = 1 << 18, 1 << 16
#: Code points that are looked up; those above are no letters.
KNOWN = 0x32400
SPACE = 32


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fold_table() -> np.ndarray:
    """For each code point its lower case if it is a letter or mark, else a space."""
    out = np.full(KNOWN + 1, SPACE, np.uint64)
    for c in range(KNOWN):
        if unicodedata.category(x := chr(c))[0] in "LM":
            out[c] = ord(x.lower()[0])
    return out


_FOLD: list[np.ndarray] = []


def folded(raw: bytes) -> np.ndarray:
    """The folded code points of a text."""
    if not _FOLD:
        _FOLD.append(fold_table())
    return _FOLD[0][np.minimum(np.frombuffer(raw.decode("utf-8").encode("utf-32-le", "surrogatepass"), "<u4"), KNOWN)]


def valid(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buffer with spaces for rows' bytes that are no UTF-8."""
    raw = data.tobytes()
    try:
        raw.decode("utf-8")
        return data, off
    except UnicodeDecodeError:
        rows = [raw[a:b].decode("utf-8", "replace").replace("\ufffd", " ").encode() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
        return np.frombuffer(b"".join(rows), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)


def _lead(data: np.ndarray, at: int) -> int:
    """The first place from at on where a character begins."""
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return min(at, len(data))


def summed(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and the sums of n (1 each if there is none)."""
    if n is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    size = np.diff(np.append(heads, len(keys))) if n is None else np.add.reduceat(n, heads) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], size


def ngrams(data: np.ndarray, off: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and count of all n-gram buckets, sorted by row and bucket; and which rows have a letter."""
    data, off = valid(data, off)
    rows, low, found = len(off) - 1, 0, []
    letters = np.zeros(rows, bool)
    kind = np.uint32 if rows < 1 << (32 - BITS) else np.uint64
    while low < len(data):
        high = _lead(data, min(len(data), low + step))
        stop = _lead(data, min(len(data), high + 12))  # three characters more at least
        code = folded(data[low:stop].tobytes())
        begins = np.concatenate([[0], np.cumsum((data[low:stop] & 0xC0) != 0x80)])
        size = np.diff(begins[np.clip(off, low, stop) - low])
        row = np.repeat(np.arange(rows, dtype=kind), size)
        letter, mine = code != SPACE, int(begins[high - low])
        letters |= np.bincount(row[letter], minlength=rows) > 0
        keys, h = [], np.zeros(len(code), U64)
        for n in range(1, 5):
            m = len(code) - n + 1
            if m <= 0:
                break
            h = h[:m] * U64(0x9E3779B97F4A7C15) + code[n - 1 :]
            ok = row[:m] == row[n - 1 :]
            ok[mine:] = False
            if n == 1:
                ok &= letter
            elif n == 4:
                ok &= ~(letter[:m] & letter[n - 1 :])
            bucket = (h[ok] + U64(n)) * U64(0xC2B2AE3D27D4EB4F) >> U64(64 - BITS)
            keys.append(row[:m][ok] << kind(BITS) | bucket.astype(kind))
        found.append(summed(np.concatenate(keys)))
        low = high
    keys, n = found[0] if len(found) == 1 else summed(*(np.concatenate(x) for x in zip(*found, strict=True))) if found else (np.zeros(0, kind), np.zeros(0, np.int64))
    return (keys >> kind(BITS)).astype(np.int64), (keys & kind(BUCKETS - 1)).astype(np.int64), n, letters


def weighted(row: np.ndarray, bucket: np.ndarray, n: np.ndarray, idf: np.ndarray, rows: int) -> np.ndarray:
    """TF-IDF values of unit length per row."""
    x = np.log1p(n) * idf[bucket]
    return x / np.maximum(np.sqrt(np.bincount(row, x * x, minlength=rows)), 1e-12)[row]


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, data: np.ndarray, off: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each row."""
        rows = len(off) - 1
        row, bucket, n, letters = ngrams(data, off)
        x = weighted(row, bucket, n, self.idf, rows)
        used = self.weights.any(axis=1)[bucket]
        row, bucket, x = row[used], bucket[used], x[used]
        z = np.column_stack([np.bincount(row, x * w[bucket], minlength=rows) for w in self.weights.T]) + self.bias
        p = softmax(z / self.temperature)
        best = p.argmax(axis=1)
        return [self.langs[k] if ok else "und" for k, ok in zip(best.tolist(), letters.tolist(), strict=True)], np.where(letters, p[np.arange(rows), best], 0.0)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with elastic net over sparse rows (buckets, values)."""
    z, n, w = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))
    bias, rate = np.zeros(classes), 0.1
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            zi, ni = z[at], n[at]
            wi = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            p = softmax((x @ wi + bias)[None])[0]
            p[labels[i]] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[at], n[at] = zi + g - sigma * wi, ni + g * g
            bias -= rate * p / np.sqrt(1 + i % 1000)
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    return w, bias


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Least mean negative log-likelihood of labels smoothed by SMOOTH, by golden section on the logarithm. Smoothing keeps
    it finite where every label is right."""
    if not len(labels):
        return 1.0
    target = np.full(logits.shape, SMOOTH / logits.shape[1])
    target[np.arange(len(labels)), labels] += 1 - SMOOTH
    loss = lambda t: -(target * np.log(np.maximum(softmax(logits / np.exp(t)), 1e-12))).sum(axis=1).mean()
    low, high, g = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(BUCKETS, np.int64), 0
    for batch in slices(batches, SLICE):
        data, off = text_buffer(batch.column(0))
        total += np.bincount(ngrams(data, off)[1], minlength=BUCKETS)
        n += batch.num_rows
    if n:
        yield pa.record_batch([pa.array(np.arange(BUCKETS + 1), pa.int32()), pa.array(np.append(total, n), pa.int64())], names=["bucket", "n"])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, SLICE):
        data, off = text_buffer(batch.column(0))
        row, bucket, n, _ = ngrams(data, off)
        cuts = np.searchsorted(row, np.arange(batch.num_rows + 1)).tolist()
        at, x = bucket.astype("<u2"), n.astype("<f4")
        yield pa.record_batch([batch.column(1), *(pa.array([v[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()) for v in (at, x))], names=["lang", "at", "x"])


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learns from docs with a lang and a text that are not held out; None if there are none."""
    learn = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    df = learn.select("text").mapInArrow(_frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    if not len(df):
        return None
    n = int(df.n[df.bucket == BUCKETS].iloc[0])
    found = np.zeros(BUCKETS)
    own = df[df.bucket < BUCKETS]
    found[own.bucket.to_numpy()] = own.n.to_numpy()
    idf = (np.log((1 + n) / (1 + found)) + 1).astype(np.float32)
    keyed = learn.select("lang", F.xxhash64("doc_id").alias("_h"), "doc_id")
    # the first of each language by hash in each of FLOOR parts, mostly in the sample anyway: one row for each from a task
    floor = keyed.groupBy("lang", F.pmod(F.xxhash64("_h"), F.lit(FLOOR)).alias("_part")).agg(F.min(F.struct("_h", "doc_id")).alias("m")).select("lang", "m.doc_id")
    chosen = {(r["lang"], r["doc_id"]) for df in (keyed.orderBy("_h", "doc_id", "lang").limit(sample), floor) for r in df.select("lang", "doc_id").collect()}
    ids = docs.sparkSession.createDataFrame(list(chosen), "lang string, doc_id long")
    texts = learn.join(F.broadcast(ids), ["lang", "doc_id"], "left_semi").groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    rows, compact = texts.select("text", "lang").mapInArrow(_sparse, "lang string, at binary, x binary"), []
    for lang, at, x in rows.toLocalIterator():
        at = np.frombuffer(at, "<u2")
        v = np.log1p(np.frombuffer(x, np.float32)) * idf[at]
        compact.append((hash_row(at), lang, at, v / max(float(np.sqrt((v * v).sum())), 1e-12)))
    compact.sort(key=lambda r: (r[0], r[1], r[3].tobytes()))
    langs = sorted({r[1] for r in compact})
    number, seen_of = {x: k for k, x in enumerate(langs)}, dict.fromkeys(langs, 0)
    labels, vectors, fifth = np.array([number[r[1]] for r in compact]), [r[2:] for r in compact], np.zeros(len(compact), bool)
    for i, r in enumerate(compact):
        fifth[i] = seen_of[r[1]] % 5 == 4
        seen_of[r[1]] += 1
    seen = np.flatnonzero(~fifth)
    w, bias = train([vectors[i] for i in seen], labels[seen], len(langs))
    logits = np.array([x @ w[at] + bias for i, (at, x) in enumerate(vectors) if fifth[i]]).reshape(-1, len(langs))
    return Model(langs, idf, w.astype(np.float32), bias.astype(np.float32), temperature(logits, labels[fifth]))


def hash_row(at: np.ndarray) -> int:
    return int((np.asarray(at, np.uint64) * np.uint64(0x9E3779B97F4A7C15)).sum() >> np.uint64(1))


def predictions(model: Model | None, data: np.ndarray, off: np.ndarray) -> tuple[list[str], np.ndarray]:
    if model is None:
        return ["und"] * (len(off) - 1), np.zeros(len(off) - 1)
    return model.predict(data, off)


def identify(docs: DataFrame, model: Model | None = None, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    model = model or fit(docs, sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            data, off = text_buffer(batch.column(1))
            lang, score = predictions(shared.value, data, off)
            yield pa.record_batch([id_column(id_array(batch.column(0))), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double").select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def identified(docs: DataFrame, least: float = 0.0, sample: int = SAMPLE) -> DataFrame:
    """docs without those that are `und` or whose language has a score under least; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            data, off = text_buffer(batch.column(batch.schema.get_field_index("text")))
            lang, score = predictions(shared.value, data, off)
            yield batch.filter(pa.array([x != "und" and s >= least for x, s in zip(lang, score.tolist(), strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
