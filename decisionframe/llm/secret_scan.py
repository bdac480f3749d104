"""Secret scans: fixed patterns, and a battery of randomness tests under false-discovery control.

Candidates are runs of 20 or more token characters outside the patterns' spans. For the encoding
inferred for each (hex, base32, base64) the battery takes three statistics over the places of its
letters in the alphabet, in byte order: how often letters recur (chi-squared of uniformity over the
alphabet), changes between the alphabet's halves (runs) and lag-one serial correlation. Each has two
p-values:

* as a random string; a candidate whose least one, corrected for three tests, is below GATE is none;
* as ordinary text, whose letter frequencies, rate of changes and correlation are counted over all
  shorter runs of all documents, beginning with PRIOR letters of fixed English frequencies. Three
  times the least of them, which needs no independence, is the candidate's p-value.

Benjamini-Hochberg at level FDR over the candidates of all documents, within bands of length (powers
of two, as the tests' power grows with length), decides.

Defined cases: null text is empty; repeated rows are scanned one by one; a null doc_id stays null; a
very long text is a slice of its own. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_array, id_column, slices, staged, text_buffer, word_bounds

#: The patterns and the least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX_LETTERS, TOKEN_LETTERS = b"0123456789abcdef", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX, LEAST_TOKEN = 6, 20, 24, 20
KINDS = ("assign", "access", "hex", "random")
KEYWORDS = (b"passw", b"secret", b"token", b"api")
#: English letter frequencies in per mille, a to z.
ENGLISH = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
#: Levels of the gate and of false discoveries; letters, changes and pairs that the counts begin with.
GATE, FDR, PRIOR = 1e-3, 0.01, 1000
PRIOR_CHANGES = 0.15
#: Histogram of -log10 p: steps per unit, and the last step.
FINE, LAST = 10, 400


def table_without(letters: bytes) -> np.ndarray:
    out = np.ones(256, bool)
    out[list(letters)] = False
    return out


NOT_HEX, NOT_TOKEN = table_without(HEX_LETTERS), table_without(TOKEN_LETTERS)
#: The alphabets in byte order; - and _ of the url-safe form stand for + and /.
BASE64 = b"+/0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE32 = b"234567ABCDEFGHIJKLMNOPQRSTUVWXYZ"
URL_SAFE = bytes.maketrans(b"-_", b"+/")
JOINTS = np.frombuffer(b"+/-_", np.uint8)
PLACE = np.full(256, -1, np.int64)
PLACE[list(BASE64)] = np.arange(64)
PLACE[list(b"-_")] = [0, 1]
SMALL = PLACE.astype(np.int8)
BATTERY = "start: long, end: long, band: int, size: int, n: long, pairs: long, changes: long, serial: double, random: double"


def normal_tail(z: float) -> float:
    """P(Z >= z)."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def uniform_tail(recur: float, n: int, size: int) -> float:
    """Chi-squared upper tail of uniformity over an alphabet, where letters recur in this many ordered pairs of n.
    With few letters a cell the statistic's exact mean and variance are matched by a scaled chi-squared (Wilson-Hilferty)."""
    x = size / n * (recur + n) - n
    mean, var = size - 1, 2 * (size - 1) * (n - 1) / n
    scale, df = var / (2 * mean), 2 * mean * mean / var
    z = (max(x, 0.0) / scale / df) ** (1 / 3) - (1 - 2 / (9 * df))
    return normal_tail(z / math.sqrt(2 / (9 * df)))


def binomial_tail(n: int, k: int, p: float) -> float:
    """P(X >= k)."""
    if k <= 0:
        return 1.0
    i = np.arange(k, n + 1, dtype=np.float64)
    steps = np.concatenate([[0.0], np.log((n - i[:-1]) / (i[:-1] + 1))])
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + np.cumsum(steps) + i * math.log(p) + (n - i) * math.log1p(-p)
    top = float(log.max())
    return min(1.0, math.exp(top) * float(np.exp(log - top).sum()))


def encoding(token: bytes) -> tuple[int, np.ndarray]:
    """Size of the inferred alphabet, and the places of the letters in it. Capitals alone are words rather than base32."""
    body = token.translate(URL_SAFE, b"=")
    low = body.lower()
    if not low.strip(HEX_LETTERS) and body in (low, body.upper()):
        return 16, np.array([HEX_LETTERS.index(c) for c in low], np.int64)
    if not body.strip(BASE32) and not body.isalpha():
        return 32, np.array([BASE32.index(c) for c in body], np.int64)
    return 64, PLACE[np.frombuffer(body, np.uint8)]


def battery(token: bytes) -> dict | None:
    """The statistics of a candidate and the least of its four p-values as a random string, corrected; None below the least length."""
    size, place = encoding(token)
    n = len(place)
    if n < LEAST_TOKEN:
        return None
    seen = np.bincount(place, minlength=size)
    recur = int((seen * (seen - 1)).sum())
    above = place >= size // 2
    changes = int((above[1:] != above[:-1]).sum())
    centred = place - place.mean()
    spread = float((centred**2).sum())
    serial = float((centred[1:] * centred[:-1]).sum()) / spread if spread else 1.0
    runs = math.erfc(abs(2 * changes - (n - 1)) / math.sqrt(2 * (n - 1)))
    # a random string's correlation has mean -1/n and variance of about 1/n
    correlated = math.erfc(abs(serial + 1 / n) * math.sqrt(n / 2))
    # of 64 letters four join words (+ / - _); more of them than chance has are paths and names
    raw = np.frombuffer(token.replace(b"=", b""), np.uint8)
    joints = np.isin(raw, JOINTS) if size == 64 else np.zeros(n, bool)
    random = min(1.0, 4 * min(uniform_tail(recur, n, size), runs, correlated, binomial_tail(n, int(joints.sum()), 2 / 64)))
    # as ordinary text a candidate is what stands between its joints
    body, word = place[~joints], np.cumsum(joints)[~joints]
    if len(body) < 2:
        return None
    seen, inside = np.bincount(body, minlength=size), word[1:] == word[:-1]
    half, centred = body >= size // 2, body - body.mean()
    spread = float((centred**2).sum())
    return {
        "band": len(token).bit_length(), "size": size, "n": len(body), "pairs": int((seen * (seen - 1)).sum()), "changes": int(((half[1:] != half[:-1]) & inside).sum()),
        "serial": float((centred[1:] * centred[:-1])[inside].sum()) / spread if spread else 1.0, "random": random,
    }


@dataclass(frozen=True)
class Ordinary:
    """Ordinary text: chances that two and that three letters are equal, of a change of halves, and the serial correlation."""

    two: float
    three: float
    change: float
    serial: float

    @classmethod
    def of(cls, letters: np.ndarray, pairs: float, changes: float, product: float) -> Ordinary:
        """From counts over a corpus: letters by place, pairs of neighbours, changes of halves, sum of products of neighbours' places."""
        letters = letters.astype(np.float64)
        letters[PLACE[list(range(97, 123))]] += PRIOR * np.array(ENGLISH) / sum(ENGLISH)
        share, place = letters / letters.sum(), np.arange(64)
        mean = float(share @ place)
        var = float(share @ (place - mean) ** 2)
        serial = (product - pairs * mean * mean) / (var * (pairs + PRIOR))
        return cls(float((share**2).sum()), float((share**3).sum()), (changes + PRIOR * PRIOR_CHANGES) / (pairs + PRIOR), serial)

    def tail(self, x: dict) -> float:
        """p-value of a candidate's statistics in ordinary text: fewer recurrences, more changes, less correlation."""
        n, m = x["n"], x["n"] * (x["n"] - 1)
        var = 2 * m * (self.two - self.two**2) + 4 * m * (n - 2) * (self.three - self.two**2)
        recur = normal_tail((m * self.two - x["pairs"]) / math.sqrt(max(var, 1e-9)))
        correlated = normal_tail((self.serial - x["serial"]) * math.sqrt(n))
        return min(1.0, 3 * min(recur, binomial_tail(n - 1, x["changes"], min(self.change, 0.5)), correlated))


def _counts(data: np.ndarray, off: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, int, int, int]:
    """Letters, pairs, changes and products over a slice's rows, but for the candidates' runs from starts to ends."""
    place = SMALL[data]
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        place[s:e] = -1
    there = place >= 0
    both = there[1:] & there[:-1]
    inner = off[(off > 0) & (off < len(data))]
    both[inner - 1] = False
    a, b = place[:-1][both], place[1:][both]
    return np.bincount(place[there], minlength=64), len(a), int(np.count_nonzero((a >= 32) != (b >= 32))), int((a.astype(np.int16) * b).sum(dtype=np.int64))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans and candidates of every document; the first row of a slice also carries the slice's counts."""
    for batch in slices(batches):
        data, off = text_buffer(batch.column(1))
        raw = data.tobytes()
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)])
        runs = {}
        for name, table, least in (("hex", NOT_HEX, LEAST_HEX), ("random", NOT_TOKEN, LEAST_TOKEN)):
            starts, ends, _ = word_bounds(data, off, table)
            long = ends - starts >= least
            starts, ends = starts[long], ends[long]
            if name == "random":
                letters, pairs, changed, product = _counts(data, off, starts, ends)
            runs[name] = (starts, ends, np.searchsorted(starts, off))
        base_all, found_all = [], []
        for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
            text = raw[a:b]
            low = text.lower()
            base, found, decoded = [], [], None
            # byte offsets turn into code points only in documents that have something
            if any(k in low for k in KEYWORDS):
                decoded = text.decode("utf-8", "replace")
                base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(decoded) if len(m[2]) >= LEAST_ASSIGN]
            if b"AKIA" in text:
                decoded = decoded if decoded is not None else text.decode("utf-8", "replace")
                base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(decoded) if m.end() - m.start() >= LEAST_ACCESS]
            for name in ("hex", "random"):
                starts, ends, rows = runs[name]
                taken = merged(base) if name == "random" else None
                for s, e in zip(starts[rows[i] : rows[i + 1]].tolist(), ends[rows[i] : rows[i + 1]].tolist(), strict=True):
                    first = int(points[s] - points[a])
                    if name == "hex":
                        base.append((first, 2, first + e - s))
                    elif not overlaps(taken, first, first + e - s) and (x := battery(raw[s:e])) and x["random"] >= GATE:
                        found.append({"start": first, "end": first + e - s, **x})
            base_all.append([{"start": x[0], "kind": x[1], "end": x[2]} for x in sorted(base)])
            found_all.append(found)
        counted = [{"letters": letters.tolist(), "pairs": pairs, "changes": changed, "product": product}] + [None] * (batch.num_rows - 1)
        yield pa.record_batch(
            [
                id_column(id_array(batch.column(0))),
                pa.array(base_all, pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))),
                pa.array(found_all, FOUND),
                pa.array(counted, pa.struct([("letters", pa.list_(pa.int64())), *((x, pa.int64()) for x in ("pairs", "changes", "product"))])),
            ],
            names=["doc_id", "base", "found", "counted"],
        )


FOUND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("band", pa.int32()), ("size", pa.int32()), *((x, pa.int64()) for x in ("n", "pairs", "changes")), ("serial", pa.float64()), ("random", pa.float64())]))


def merged(spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Starts, and the furthest end up to each, of (start, kind, end) by start."""
    spans = sorted(spans)
    return np.array([x[0] for x in spans], np.int64), np.maximum.accumulate(np.array([x[2] for x in spans], np.int64))


def overlaps(taken: tuple[np.ndarray, np.ndarray], start: int, end: int) -> bool:
    starts, ends = taken
    at = int(np.searchsorted(starts, end, "left"))
    return at > 0 and int(ends[at - 1]) > start


def thresholds(counts: list[tuple[int, int, int]], level: float) -> dict[int, int]:
    """Benjamini-Hochberg within each band from counts (band, bin, n): the first bin whose p-values are all discoveries."""
    out: dict[int, int] = {}
    for band in {c[0] for c in counts}:
        own = {b: n for x, b, n in counts if x == band}
        total, seen = sum(own.values()), 0
        for b in sorted(own, reverse=True):
            seen += own[b]
            if 10 ** (-b / FINE) <= level * seen / total:
                out[band] = b
    return out


def _judge(ordinary: Ordinary):
    """Adds to each candidate the bin of its p-value in ordinary text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"start": x["start"], "end": x["end"], "band": x["band"], "bin": min(LAST, int(-math.log10(max(ordinary.tail(x), 1e-300)) * FINE))} for x in own] for own in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("band", pa.int32()), ("bin", pa.int32())])))], names=["doc_id", "base", "found"])

    return run


def ordinary_text(found: DataFrame) -> Ordinary:
    """Sums over all documents: 64 letters and three numbers come to the driver."""
    c = found.where("counted is not null").select("counted.*")
    letters = dict(map(tuple, c.select(F.posexplode("letters").alias("place", "n")).groupBy("place").agg(F.sum("n")).collect()))
    pairs, changes, product = (float(x or 0) for x in c.agg(F.sum("pairs"), F.sum("changes"), F.sum(F.col("product").cast("double"))).first())
    return Ordinary.of(np.array([letters.get(i, 0) for i in range(64)]), pairs, changes, product)


def secret_spans(docs: DataFrame, level: float = FDR) -> DataFrame:
    """One row per document: doc_id, base and added spans as arrays of (start, kind, end) in code points, by start and kind."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans, bins = "base array<struct<start: long, kind: int, end: long>>", "found array<struct<start: long, end: long, band: int, bin: int>>"
    scanned = staged(rows.mapInArrow(_scan, f"doc_id long, {spans}, found array<struct<{BATTERY}>>, counted struct<letters: array<long>, pairs: long, changes: long, product: long>"), "secrets")
    found = scanned.select("doc_id", "base", "found").mapInArrow(_judge(ordinary_text(scanned)), f"doc_id long, {spans}, {bins}")
    counts = [tuple(r) for r in found.select(F.explode("found").alias("f")).groupBy("f.band", "f.bin").count().collect()]
    limits = thresholds(counts, level)

    def passed(x):
        hit = F.lit(False)
        for band, b in limits.items():
            hit = hit | ((x["band"] == band) & (x["bin"] >= b))
        return hit

    added = F.transform(F.filter("found", passed), lambda x: F.struct(x["start"].alias("start"), F.lit(3).alias("kind"), x["end"].alias("end")))
    return found.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def _text(column: str):
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(column, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def secret_digest(docs: DataFrame, level: float = FDR) -> DataFrame:
    found = secret_spans(docs, level)
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(_text("base"), 256).alias("base_sha256"), _text("spans").alias("spans"))
