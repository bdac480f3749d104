"""Substring dedup over words by prefix-partitioned groups of suffixes.

Suffixes (taken at anchors, see repeats.py) are dealt out by prefixes: first by the anchor's fingerprint, and a group of more
than GROUP suffixes is split by more bits of it. In a group, suffixes are sorted by the fingerprints of their anchor and of the span that
follows; equal ones of 20 words or more are repeats, and all but the first in (doc_id, start) order are removed. These groups take the
place of the subtrees of a suffix tree: they hold its leaves by fingerprint, and no inner nodes or depths, as repeats of one fixed
length need none.

Defined cases: null text has no words; a document of fewer than 20 words keeps all; a null doc_id
sorts before all others; rows that repeat a doc_id are texts of their own, in one fixed order (within a file, its own),
so that all but the first repeat it; a very long text is a slice of its own and its windows are hashed in steps.
Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import IS_SPACE, U64, id_array, id_column, slices, steady, text_buffer, word_bounds
from .repeats import CHUNK, Groups, Spec, compare, order, removed_mask, repeated, with_spans

#: Words of a window; words of an anchor; suffixes from which one subtree is built.
LENGTH, WIDTH, GROUP = 20, 8, 1 << 18


class PrefixTrees(Groups):
    """Suffixes in groups by prefix: a group over the bound is split by the next bits of the prefix."""

    def __init__(self, most: int = GROUP) -> None:
        self.most, self.held = most, []

    def add(self, c: np.ndarray) -> None:
        self.held.append(c)

    def subtrees(self, c: np.ndarray, bits: int = 0) -> Iterator[np.ndarray]:
        if len(c) <= self.most or bits >= 64:
            yield order(c)
            return
        branch = (mixed(c["a"]) >> U64(max(0, 60 - bits))) & U64(15)
        for k in range(16):
            if len(part := c[branch == k]):
                yield from self.subtrees(part, bits + 4)

    def finish(self, later: bool) -> tuple[np.ndarray, np.ndarray]:
        marked, wanted = [np.zeros(0, CHUNK)], [np.zeros(0, CHUNK)]
        for tree in self.subtrees(np.concatenate(self.held)):
            hit, more, _ = compare(tree, later)
            marked.append(tree[hit])
            wanted.append(tree[more])
        return np.concatenate(marked), np.concatenate(wanted)


def mixed(a: np.ndarray) -> np.ndarray:
    """Prefix bits that differ within an owner's range."""
    return a * U64(0x9E3779B97F4A7C15)


def _kept(batches: Iterator[pa.RecordBatch], with_text: bool = False) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        data, off = text_buffer(batch.column(1))
        starts, ends, rows = word_bounds(data, off, IS_SPACE)
        raw = data.tobytes()
        spans = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * batch.num_rows
        out: list[list] = [[], [], [], []]
        for i, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)):
            if spans[i]:
                keep = np.flatnonzero(~removed_mask(spans[i], b - a)) + a
                text = b" ".join([raw[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)])
                gone = b - a - len(keep)
            else:
                text, gone = b" ".join(raw[off[i] : off[i + 1]].split()), 0
            for c, v in zip(out, (b - a, gone, hashlib.sha256(text).hexdigest(), text if with_text else None), strict=True):
                c.append(v)
        columns = [id_column(id_array(batch.column(0))), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if with_text:
            columns, names = [*columns, pa.array(out[3], pa.binary()).cast(pa.string())], [*names, "kept_text"]
        yield pa.record_batch(columns, names=names)


def substring_dedup(docs: DataFrame, length: int = LENGTH, width: int = WIDTH, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text (words joined by one space)."""
    docs = steady(docs)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    keep = _kept if not with_text else lambda batches: _kept(batches, True)
    return with_spans(docs, repeated(docs, Spec(length, width, True, True), PrefixTrees), keep, schema)
