"""Exact dedup by Golomb-coded fingerprint exchange.

Each block of rows hashes its normalised texts, sends the sorted fingerprints Rice-coded to the
owners of the hash ranges and gets bitmaps back that mark the fingerprints other rows share. Only
the suspects' texts are shuffled; they are grouped by their bytes, so a shared fingerprint alone
never makes two texts equal.

Defined cases: a null text is empty, and all texts without other characters than white space are
equal. A null doc_id sorts before all others. Rows that repeat a doc_id are told apart by their place in the
files and each count in group_size; of such rows with equal texts one is `kept`, the first where they share a file,
and the same row stays in exact_dedup. A very long text is a slice of its own.
Extra columns are ignored, or kept by exact_dedup. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, SPACES, U64, id_array, key_of, only_ids, parts_of, row_number, rows_without, slices, staged, steady, text_buffer

#: Rows of one block at most, and rows of all blocks for one owner on average: their fingerprints are held by one task.
BLOCK_ROWS, OWNED = 500_000, 2_000_000


def rice_encode(values: np.ndarray) -> bytes:
    """Sorted distinct 64-bit values: count, parameter, first value, quotients of the gaps in unary, remainders."""
    n = len(values)
    gaps = np.diff(values)
    mean = float(gaps.astype(np.float64).mean()) if n > 1 else 1.0
    r = max(0, int(np.floor(np.log2(max(mean * 0.6931, 1.0)))))
    quotient = (gaps >> U64(r)).astype(np.int64)
    unary = np.ones(int(quotient.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotient + 1) - 1] = 0
    rest = ((gaps[:, None] >> np.arange(r - 1, -1, -1, dtype=U64)) & U64(1)).astype(np.uint8)
    head = np.array([n, r, len(unary), int(values[0]) if n else 0], U64).tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(rest.ravel()).tobytes()


def rice_decode(blob: bytes) -> np.ndarray:
    n, r, m, first = (int(x) for x in np.frombuffer(blob[:32], U64))
    if not n:
        return np.zeros(0, U64)
    size = (m + 7) // 8
    unary = np.unpackbits(np.frombuffer(blob[32 : 32 + size], np.uint8))[:m]
    quotient = np.diff(np.concatenate([[-1], np.flatnonzero(unary == 0)])) - 1
    rest = np.zeros(n - 1, U64)
    if r:
        bits = np.unpackbits(np.frombuffer(blob[32 + size :], np.uint8))[: (n - 1) * r].reshape(n - 1, r)
        for j in range(r):
            rest = (rest << U64(1)) | bits[:, j].astype(U64)
    gaps = (quotient.astype(U64) << U64(r)) | rest
    return np.concatenate([[U64(first)], U64(first) + np.cumsum(gaps, dtype=U64)])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, rows = TaskContext.get().partitionId(), 0
    for batch in slices(batches):
        digests, prints = [], []
        data, off = text_buffer(batch.column(1))
        raw = data.tobytes()
        for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            digest = hashlib.sha256(raw[a:b].translate(None, SPACES))
            digests.append(digest.hexdigest())
            prints.append(digest.digest()[:8])
        block = (part << 24) + (rows + np.arange(batch.num_rows)) // BLOCK_ROWS
        rows += batch.num_rows
        yield pa.record_batch([batch.column(0), batch.column(2), pa.array(digests), pa.array(np.frombuffer(b"".join(prints), ">u8").astype(U64).view(np.int64)), pa.array(block, pa.int64())], names=["key", "row", "sha", "fp", "block"])


def _send(owners: int):
    """Of one block: its rows' distinct fingerprints, coded for each owner; those that repeat inside the block need no answer."""

    def send(group: pa.Table) -> pa.Table:
        block = group.column("block")[0].as_py()
        distinct = np.unique(group.column("fp").to_numpy().view(U64))
        owner = ((distinct >> U64(32)) * U64(owners)) >> U64(32)
        cuts = np.searchsorted(owner, np.arange(owners + 1, dtype=U64))
        there = [i for i in range(owners) if cuts[i] < cuts[i + 1]]
        return pa.table({"owner": pa.array(there, pa.int32()), "block": pa.array([block] * len(there), pa.int64()), "blob": pa.array([rice_encode(distinct[cuts[i] : cuts[i + 1]]) for i in there], pa.binary())})

    return send


def _answer(group: pa.Table) -> pa.Table:
    """At an owner: for each block a bitmap over its sorted fingerprints of those that other blocks have too."""
    lists = [rice_decode(x) for x in group.column("blob").to_pylist()]
    values, counts = np.unique(np.concatenate(lists), return_counts=True)
    shared = values[counts > 1]
    bitmaps = [np.packbits(np.isin(x, shared, assume_unique=True)).tobytes() for x in lists]
    return pa.table({"block": group.column("block"), "owner": group.column("owner"), "bitmap": pa.array(bitmaps, pa.binary())})


def _suspects(owners: int):
    def suspects(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"row": pa.array([], pa.int64())})
        prints = rows.column("fp").to_numpy().view(U64)
        distinct, inverse, counts = np.unique(prints, return_inverse=True, return_counts=True)
        owner = ((distinct >> U64(32)) * U64(owners)) >> U64(32)
        hit = counts > 1
        for o, bitmap in zip(answers.column("owner").to_pylist(), answers.column("bitmap").to_pylist(), strict=True):
            a, b = np.searchsorted(owner, np.array([o, o + 1], U64))
            hit[a:b] |= np.unpackbits(np.frombuffer(bitmap, np.uint8))[: b - a].astype(bool)
        return rows.select(["row"]).filter(pa.array(hit[inverse]))

    return suspects


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each distinct normalised text of a slice, with its best row: most code points, then smallest doc_id, then first row."""
    for batch in slices(batches):
        best: dict[bytes, list] = {}
        data, off = text_buffer(batch.column(1))
        raw = data.tobytes()
        for key, row, a, b in zip(id_array(batch.column(0)).tolist(), batch.column(2).to_pylist(), off[:-1].tolist(), off[1:].tolist(), strict=True):
            text = raw[a:b]
            norm, order = text.translate(None, SPACES), (-len(text.decode("utf-8", "replace")), key, row)
            if (seen := best.get(norm)) is None:
                best[norm] = [order, 1]
            else:
                seen[0], seen[1] = min(seen[0], order), seen[1] + 1
        yield pa.record_batch([pa.array(list(best), pa.binary()), pa.array([x[0][0] for x in best.values()], pa.int64()), pa.array([x[0][1] for x in best.values()], pa.int64()), pa.array([x[0][2] for x in best.values()], pa.int64()), pa.array([x[1] for x in best.values()], pa.int64())], names=["norm", "order", "key", "row", "n"])


def exact_groups(docs: DataFrame, owners: int | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    return _groups(steady(docs), owners).drop("row", "keep_row")


def _groups(docs: DataFrame, owners: int | None) -> DataFrame:
    """exact_groups of a steady frame, with the row_number of each row and of the one that stays."""
    spark = docs.sparkSession
    owners = owners or max(parts_of(spark), -(-docs.count() // OWNED))
    rows = docs.select(key_of().alias("key"), "text", row_number(docs).alias("row"))
    prints = staged(rows.mapInArrow(_fingerprints, "key long, row long, sha string, fp long, block long"), "fingerprints")
    small = prints.select("block", "row", "fp")
    sent = small.select("block", "fp").groupBy("block").applyInArrow(_send(owners), "owner int, block long, blob binary")
    answers = sent.groupBy("owner").applyInArrow(_answer, "block long, owner int, bitmap binary")
    marked = small.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_suspects(owners), "row long")
    suspects = staged(marked, "suspects")
    texts = only_ids(rows, suspects, "row").join(suspects, "row", "left_semi").select("key", "text", "row")
    groups = (
        texts.mapInArrow(_normalised, "norm binary, `order` long, key long, row long, n long")
        .groupBy("norm")
        .agg(F.min(F.struct("order", "key", "row")).alias("best"), F.sum("n").alias("n"))
        .where("n > 1")
        .select(F.sha2("norm", 256).alias("sha"), F.col("best.key").alias("keep"), F.col("best.row").alias("keep_row"), F.col("n").alias("size"))
    )
    groups = staged(groups, "groups")
    joined = prints.select("key", "row", "sha").join(groups, "sha", "left")
    keep = F.coalesce("keep", "key")
    return joined.select(
        F.when(F.col("key") != F.lit(NULL_ID), F.col("key")).alias("doc_id"),
        F.when(keep != F.lit(NULL_ID), keep).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (F.coalesce("keep_row", "row") == F.col("row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "row",
        F.coalesce("keep_row", "row").alias("keep_row"),
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of equal texts; all columns stay. Rows that repeat id and text are equal, too."""
    docs = steady(docs)
    return rows_without(docs, _groups(docs, None).where("row <> keep_row").select("row"))
