"""Suffix-array dedup over bytes with a logarithmic index family.

Suffixes (taken at anchors, see repeats.py) arrive in batches, each sorted into a suffix array in
fingerprint order. A batch is merge-scanned against every level of the index: suffixes with equal
anchors either span equal bytes (a match of 400 bytes or more as a whole) or are noted for the
byte-wise comparison of their windows. Then the batch becomes a level, and levels of about equal
size are merged, so n batches leave O(log n) levels and every suffix is moved O(log n) times.

Defined cases: null text is empty; a text shorter than 400 bytes keeps all; rows that repeat a
doc_id are separate texts, so a long one of them repeats the other; a very long text is a slice of its own; a null doc_id stays null. Cuts
fall between bytes, not characters: the remaining bytes are kept as they are. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_array, id_column, slices, steady, text_buffer
from .repeats import AGAIN, CHUNK, SEVERAL, Groups, Spec, changes, order, removed_mask, repeated, with_spans

#: Bytes of a window; bytes of an anchor.
LENGTH, WIDTH = 400, 64


class LevelIndex(Groups):
    """Levels of suffix arrays; flags say what a suffix has met."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def add(self, c: np.ndarray) -> None:
        batch = order(c)
        self.meet(batch, batch)
        for level in self.levels:
            self.meet(level, batch)
        self.levels.append(batch)
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            top = self.levels.pop()
            self.levels[-1] = order(np.concatenate([self.levels[-1], top]))

    @staticmethod
    def meet(level: np.ndarray, batch: np.ndarray) -> None:
        """Merge-scan: flags on both sides the suffixes whose anchors agree, by whether their spans do."""
        own = level is batch
        both = level if own else np.concatenate([level[np.isin(level["a"], batch["a"])], batch[np.isin(batch["a"], level["a"])]])
        if not len(both):
            return
        both = order(both)
        new_a, new = changes(both["a"]), changes(both["a"], both["s"])
        group, cls = np.cumsum(new_a) - 1, np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        several = np.bincount(group[heads]) > 1
        several |= np.bitwise_or.reduceat(both["flag"] & SEVERAL, np.flatnonzero(new_a)) > 0
        again = np.bincount(cls) > 1
        again |= np.bitwise_or.reduceat(both["flag"] & AGAIN, heads) > 0
        anchors, spans = both["a"][new_a], both["s"][heads]
        # classes are sorted by (a, s): a suffix finds its own by its anchor's place and its span
        class_key = np.rec.fromarrays([both["a"][heads], spans], names="a,s")
        for side in (level,) if own else (level, batch):
            at = np.minimum(np.searchsorted(anchors, side["a"]), len(anchors) - 1)
            hit = anchors[at] == side["a"]
            side["flag"][hit] |= np.where(several[at[hit]], SEVERAL, 0)
            mine = np.rec.fromarrays([side["a"][hit], side["s"][hit]], names="a,s")
            c = np.searchsorted(class_key, mine)
            side["flag"][hit] |= np.where(again[c], AGAIN, 0)

    def finish(self, later: bool) -> tuple[np.ndarray, np.ndarray]:
        c = order(np.concatenate(self.levels)) if self.levels else np.zeros(0, CHUNK)
        first = changes(c["a"], c["s"])
        if later:
            head = np.flatnonzero(first)[np.cumsum(first) - 1]
            marked = (c["row"] != c["row"][head]) | (c["at"] != c["at"][head])
        else:
            marked = (c["flag"] & AGAIN) > 0
        return c[marked], c[first & ((c["flag"] & SEVERAL) > 0)]


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        data, off = text_buffer(batch.column(1))
        spans = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * batch.num_rows
        out: list[list] = [[], [], [], []]
        for a, b, own in zip(off[:-1].tolist(), off[1:].tolist(), spans, strict=True):
            text, gone, runs = data[a:b], 0, 0
            if own:
                mask = removed_mask(own, b - a)
                text, gone, runs = text[~mask], int(mask.sum()), int((mask & ~np.concatenate([[False], mask[:-1]])).sum())
            for c, v in zip(out, (b - a, gone, runs, hashlib.sha256(text.tobytes()).hexdigest()), strict=True):
                c.append(v)
        yield pa.record_batch([id_column(id_array(batch.column(0))), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def suffix_dedup(docs: DataFrame, length: int = LENGTH, width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    docs = steady(docs)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return with_spans(docs, repeated(docs, Spec(length, width, False, False), LevelIndex), _kept, schema)
