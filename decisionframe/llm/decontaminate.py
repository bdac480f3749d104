"""Benchmark decontamination with broadcast sets of benchmark n-grams.

The benchmark's word windows become sets of word-number tuples that every task holds. The set is
built in slices of at most MAX_WORDS benchmark words; a larger benchmark is scanned slice by slice,
so what is broadcast stays bounded. A scan turns each text into word numbers, finds windows whose
rolling fingerprint is in the set, verifies the hit on the words themselves and marks all words of
the window.

Defined cases: null text has no words; an item of fewer words than the window is one window; items
and documents without words match nothing; equal items all count; repeated rows, and rows that share a
doc_id, are judged one by one, whatever the number of slices; a very long text is a slice of its own; a null
item_id counts as item "" in items_sha256; a null doc_id stays null. Extra columns are ignored, or kept by
remove_documents and remove_spans. Empty tables give an empty result, or one without hits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, id_array, id_column, mix, row_number, slices, staged, steady, text_buffer

#: Benchmark words in one broadcast slice.
MAX_WORDS = 500_000
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
BASE = 0x9E3779B97F4A7C15



def split_words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Windows:
    """The benchmark windows of one slice."""

    def __init__(self, items: list[tuple[str, str | None]], width: int) -> None:
        self.numbers: dict[bytes, int] = {}
        self.windows: dict[tuple[int, ...], set[int]] = defaultdict(set)
        self.names = [name for name, _ in items]
        for at, (_, text) in enumerate(items):
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in split_words((text or "").encode())]
            if ids:
                for k in range(max(1, len(ids) - width + 1)):
                    self.windows[tuple(ids[k : k + width])].add(at)
        self.windows = dict(self.windows)
        by_size = defaultdict(list)
        for w in self.windows:
            by_size[len(w)].append(w)
        self.prints = {n: np.unique(self.fingerprints(np.array(ws, U64).reshape(len(ws), n), n)) for n, ws in by_size.items()}
        #: A small bitmap in front of the sorted fingerprints.
        self.front = {}
        for n, p in self.prints.items():
            self.front[n] = np.zeros(1 << 20, bool)
            self.front[n][(p >> U64(44)).astype(np.int64)] = True

    @staticmethod
    def fingerprints(rows: np.ndarray, n: int) -> np.ndarray:
        """rows: either (m, n) windows or a flat sequence, of which all windows of n are taken."""
        flat = rows.ndim == 1
        m = len(rows) - n + 1 if flat else len(rows)
        h = np.zeros(m, U64)
        for j in range(n):
            h = h * U64(BASE) + (rows[j : j + m] if flat else rows[:, j])
        return mix(h)

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which words lie in an occurring window, and the items with occurring windows."""
        hit, found = np.zeros(len(words), bool), set()
        if not words or not self.windows:
            return hit, found
        get = self.numbers.get
        ids = np.array([get(w, 0) for w in words], U64)
        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        for n, prints in self.prints.items():
            if n > len(ids):
                continue
            at = np.flatnonzero(unknown[n:] == unknown[:-n])
            if not len(at):
                continue
            if len(at) * 4 < len(ids):
                h = self.fingerprints(ids[at[:, None] + np.arange(n)], n)
            else:
                h = self.fingerprints(ids, n)[at]
            at = at[near := self.front[n][(h >> U64(44)).astype(np.int64)]]
            h = h[near]
            place = np.minimum(np.searchsorted(prints, h), len(prints) - 1)
            for p in at[prints[place] == h].tolist():
                owners = self.windows.get(tuple(ids[p : p + n].tolist()))
                if owners:
                    hit[p : p + n] = True
                    found |= owners
        return hit, found


def benchmark_slices(items: DataFrame, most: int = MAX_WORDS) -> Iterator[list[tuple[str, str | None]]]:
    """The items in slices of at most most words, streamed to the driver one partition at a time."""
    held, words = [], 0
    for row in items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text").toLocalIterator():
        n = len(split_words((row[1] or "").encode()))
        if held and words + n > most:
            yield held
            held, words = [], 0
        held.append((row[0], row[1]))
        words += n
    yield held


def _scan(shared):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: Windows = shared.value
        for batch in slices(batches):
            data, off = text_buffer(batch.column(1))
            raw = data.tobytes()
            n_words, hits, names = [], [], []
            for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                words = split_words(raw[a:b])
                hit, found = windows.scan(words)
                n_words.append(len(words))
                hits.append(np.flatnonzero(hit).tolist())
                names.append([windows.names[i] for i in found])
            yield pa.record_batch([id_column(id_array(batch.column(0))), batch.column(2), pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(pa.int64())), pa.array(names, pa.list_(pa.string()))], names=["doc_id", "row", "n_words", "hits", "items"])

    return scan


def contamination(docs: DataFrame, items: DataFrame, width: int = 10, most_words: int = MAX_WORDS) -> DataFrame:
    """One row per row of docs: doc_id, n_words, hits (places of hit words), items (item_ids with occurring windows)."""
    docs = steady(docs)
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_number(docs).alias("row"))
    schema = "doc_id long, row long, n_words long, hits array<long>, items array<string>"
    scans = []
    for held in benchmark_slices(items, most_words):
        shared = spark.sparkContext.broadcast(Windows(held, width))
        scans.append(rows.mapInArrow(_scan(shared), schema))
    if len(scans) == 1:
        return scans[0].drop("row")
    # a row's findings in the slices meet again by its number; those of slices that found nothing stay behind
    found = staged(reduce(DataFrame.unionByName, (x.where("size(items) > 0") for x in scans)).drop("doc_id", "n_words"), "found")
    merged = found.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"), F.flatten(F.collect_list("items")).alias("items"))
    joined = scans[0].select("doc_id", "row", "n_words").join(merged, "row", "left")
    return joined.select("doc_id", "n_words", F.array_sort(F.coalesce("hits", F.array().cast("array<long>"))).alias("hits"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contamination_digest(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    found = contamination(docs, items, width)
    names = F.array_sort("items")
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """docs without the contaminated rows; all columns stay."""
    spark = docs.sparkSession
    columns = docs.columns
    kept = docs
    for held in benchmark_slices(items):
        kept = _filtered(kept, spark.sparkContext.broadcast(Windows(held, width)), columns)
    return kept


def _filtered(docs: DataFrame, shared, columns: list[str]) -> DataFrame:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: Windows = shared.value
        for batch in slices(batches):
            data, off = text_buffer(batch.column(batch.schema.get_field_index("text")))
            raw = data.tobytes()
            clean = [not windows.scan(split_words(raw[a:b]))[1] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema).select(*columns)


def remove_spans(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """docs with every hit word cut out of its text (white space and marks around it stay); null stays null."""
    spark = docs.sparkSession
    for held in benchmark_slices(items):
        shared = spark.sparkContext.broadcast(Windows(held, width))

        def cut(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            windows: Windows = shared.value
            for batch in slices(batches):
                at = batch.schema.get_field_index("text")
                out = []
                for text in batch.column(at).to_pylist():
                    raw = (text or "").encode()
                    folded = raw.translate(FOLD)
                    words = folded.split()
                    hit, found = windows.scan(words)
                    if not found:
                        out.append(text)
                        continue
                    kept, place, end = [], 0, 0
                    for w, h in zip(words, hit.tolist(), strict=True):
                        start = folded.index(w, place)
                        place = start + len(w)
                        if h:
                            kept.append(raw[end:start])
                            end = place
                    out.append((b"".join(kept) + raw[end:]).decode())
                yield batch.set_column(at, "text", pa.array(out, batch.schema.field(at).type))

        docs = docs.mapInArrow(cut, docs.schema)
    return docs
