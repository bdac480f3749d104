"""Finds fixed-length windows of symbols (words or bytes) that occur more than once.

Windows are gathered in chunks: maximal runs of window starts that share the same anchor, the
smallest fingerprint of WIDTH consecutive symbols within the window. Equal windows have equal
anchors at equal places, so it is enough to compare chunks whose anchors agree:

1. A chunk is a suffix that begins at its anchor: fingerprint A of the anchor (the suffix's prefix,
   by which suffixes are dealt out) and S of all symbols that its windows span. Chunks with equal
   A and S repeat as wholes. Each task first compares its own chunks and sends on one for each A,
   so a prefix that a third of all rows has is sent once by each task.
2. Where one A has several S, the spans' own symbols go to the owner of A and windows are compared
   one by one, by two independent 64-bit fingerprints.

What a window's occurrences are judged on is the input alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, STEP, U64, Rolling, _in_bitmap, id_array, key_of, mix, only_ids, parts_of, row_number, slices, staged, text_buffer, word_bounds, word_hashes

FIRST, SECOND, WORDS = Rolling(11), Rolling(23), Rolling(53)
#: A chunk on its way: anchor, span, document, row, place of its first window, number of windows, flags.
CHUNK = np.dtype([("a", "<u8"), ("s", "<u8"), ("doc", "<i8"), ("row", "<i8"), ("at", "<i4"), ("n", "<i4"), ("flag", "<i4")])
#: Flags: the anchor has several spans; the chunk occurs elsewhere as a whole.
SEVERAL, AGAIN = 1, 2
#: Chunks that a task holds before it compares and sends them.
HELD = 300_000
MARK = "part int, kind int, row long, at long, n long, blob binary"


@dataclass(frozen=True)
class Spec:
    """length: symbols of a window; width: symbols of an anchor; words or bytes; later: the first occurrence stays."""

    length: int
    width: int
    words: bool
    later: bool


def symbols(spec: Spec, data: np.ndarray, off: np.ndarray) -> tuple[Callable[[int, int], np.ndarray], np.ndarray]:
    """What gives a range of the buffer's symbols as 64-bit values, and the rows' offsets in symbols."""
    if not spec.words:
        return lambda a, b: FIRST.table[data[a:b]], off
    starts, ends, rows = word_bounds(data, off, IS_SPACE)
    hashes = word_hashes(data, starts, ends, WORDS)
    return lambda a, b: hashes[a:b], rows


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def chunks(spec: Spec, values: Callable[[int, int], np.ndarray], off: np.ndarray, docs: np.ndarray, numbers: np.ndarray, step: int = STEP) -> Iterator[np.ndarray]:
    """The chunks of all rows. Works through the values in steps that overlap by a window."""
    length, width = spec.length, spec.width
    n = int(off[-1])
    for low in range(0, max(0, n - length + 1), step):
        part = values(low, min(n, low + step + length - 1))
        sums = FIRST.sums(part)
        places = np.arange(len(part) - width + 1)
        grams = mix(FIRST.ranges(sums, places, places + width))
        least = sliding_min((grams & U64(0xFFFFFFFFFF000000)) | places.astype(U64), length - width + 1)
        starts = np.arange(len(least)) + low
        row = np.searchsorted(off, starts, "right") - 1
        good = np.flatnonzero(starts + length <= off[row + 1])
        if not len(good):
            continue
        anchor = (least[good] & U64(0xFFFFFF)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], (np.diff(good) != 1) | (np.diff(anchor) != 0)]))
        begin, last, anchor = good[cut], good[np.concatenate([cut[1:], [len(good)]]) - 1], anchor[cut]
        out = np.empty(len(cut), CHUNK)
        # anchors are the smallest of many fingerprints: mixed once more, they are dealt out evenly
        out["a"] = mix(grams[anchor] ^ U64(0xA0761D6478BD642F))
        out["n"] = last - begin + 1
        out["s"] = mix(FIRST.ranges(sums, begin, last + length) ^ (mix(((anchor - begin) << 32 | out["n"]).astype(U64))))
        at = row[begin]
        out["doc"], out["row"], out["at"], out["flag"] = docs[at], numbers[at], begin + low - off[at], 0
        yield out


def order(c: np.ndarray) -> np.ndarray:
    return c[np.lexsort((c["at"], c["row"], c["doc"], c["s"], c["a"]))]


def changes(*columns: np.ndarray) -> np.ndarray:
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def compare(c: np.ndarray, later: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of chunks in order(): which are marked as wholes, which need their windows compared, and which are first in their class.
    Sets the flags of the first ones."""
    new_a, new = changes(c["a"]), changes(c["a"], c["s"])
    group, cls = np.cumsum(new_a) - 1, np.cumsum(new) - 1
    heads, first_of = np.flatnonzero(new), np.flatnonzero(new_a)
    head = heads[cls]
    size = np.bincount(cls)
    several = np.bincount(group[heads]) > 1
    several |= np.bitwise_or.reduceat(c["flag"] & SEVERAL, first_of) > 0
    if later:
        marked = (c["row"] != c["row"][head]) | (c["at"] != c["at"][head])
    else:
        again = (size > 1) | (np.bitwise_or.reduceat(c["flag"] & AGAIN, heads) > 0)
        marked = again[cls]
        c["flag"][heads] |= np.where(again, AGAIN, 0)
    c["flag"][heads] |= np.where(several[group[heads]], SEVERAL, 0)
    return marked, new & several[group], new


def marks(c: np.ndarray, length: int, kind: int, part: np.ndarray | int, blob: list[bytes] | None = None) -> pa.RecordBatch:
    """Kind 0: symbols to mark, from at on; kind 1: windows to compare; kind 2: what is for an owner."""
    n = len(c)
    part = np.broadcast_to(np.asarray(part, np.int32), n)
    return pa.record_batch([pa.array(part, pa.int32()), pa.array(np.full(n, kind, np.int32)), pa.array(c["row"].astype(np.int64)), pa.array(c["at"].astype(np.int64)), pa.array(c["n"].astype(np.int64) + (length - 1 if kind == 0 else 0)), pa.array(blob, pa.binary()) if blob else pa.nulls(n, pa.binary())], names=["part", "kind", "row", "at", "n", "blob"])


def joined_runs(c: np.ndarray, length: int) -> np.ndarray:
    """Marked chunks of one row that touch become one."""
    if not len(c):
        return c
    c = c[np.lexsort((c["at"], c["row"]))]
    row, at, end = c["row"], c["at"].astype(np.int64), c["at"].astype(np.int64) + c["n"] + length - 1
    rank = np.cumsum(changes(row)) - 1
    reach = np.maximum.accumulate(end + (rank << 40)) - (rank << 40)
    new = changes(row)
    new[1:] |= at[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    out = c[heads].copy()
    out["n"] = np.maximum.reduceat(end, heads) - at[heads] - (length - 1)
    return out


def _owner(a: np.ndarray, owners: int) -> np.ndarray:
    return (((a >> U64(32)) * U64(owners)) >> U64(32)).astype(np.int32)


def _flush(spec: Spec, held: list[np.ndarray], owners: int, salt: int) -> Iterator[pa.RecordBatch]:
    c = order(np.concatenate(held))
    marked, wanted, first = compare(c, spec.later)
    done = joined_runs(c[marked], spec.length)
    yield marks(done, spec.length, 0, (np.arange(len(done)) + salt) % owners)
    yield marks(c[wanted], spec.length, 1, _owner(c["a"][wanted], owners))
    send = c[first & changes(c["a"])]
    # the one sent for an anchor with several spans says so by its flag
    owner = _owner(send["a"], owners)
    cuts = np.searchsorted(owner, np.arange(owners + 1))
    there = [i for i in range(owners) if cuts[i] < cuts[i + 1]]
    head = np.zeros(len(there), CHUNK)
    yield marks(head, spec.length, 2, np.array(there, np.int32), [send[cuts[i] : cuts[i + 1]].tobytes() for i in there])


def _first_pass(spec: Spec, owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, salt = [], 0, TaskContext.get().partitionId() * 7919
        for batch in slices(batches):
            data, off = text_buffer(batch.column(1))
            values, rows = symbols(spec, data, off)
            for c in chunks(spec, values, rows, id_array(batch.column(2)), batch.column(0).to_numpy()):
                held.append(c)
                n += len(c)
            if n >= HELD:
                yield from _flush(spec, held, owners, salt)
                held, n = [], 0
        if n:
            yield from _flush(spec, held, owners, salt)

    return run


def _owner_pass(spec: Spec, owners: int, index: Callable[[], Groups]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, Groups] = {}
        for batch in batches:
            kind = batch.column(1).to_numpy()
            rest = batch.filter(pa.array(kind != 2))
            if rest.num_rows:
                yield rest
            sent = batch.filter(pa.array(kind == 2))
            for part, blob in zip(sent.column(0).to_pylist(), sent.column(5).to_pylist(), strict=True):
                groups.setdefault(part, index()).add(np.frombuffer(blob, CHUNK))
        for part in sorted(groups):
            marked, wanted = groups[part].finish(spec.later)
            yield marks(joined_runs(marked, spec.length), spec.length, 0, part)
            yield marks(wanted, spec.length, 1, part)

    return run


class Groups:
    """What an owner holds of the chunks sent to it. finish: those marked as wholes, and those whose windows are to be compared."""

    def add(self, c: np.ndarray) -> None:
        raise NotImplementedError

    def finish(self, later: bool) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError


def _spans(spec: Spec):
    """The bytes of the spans whose windows are to be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, off = text_buffer(batch.column(1))
            raw = data.tobytes()
            rows, bounds = off, ()
            if spec.words:
                starts, ends, rows = word_bounds(data, off, IS_SPACE)
                bounds = (starts, ends)
            out: list[list] = [[], [], [], [], []]
            for i, (row, doc, wanted) in enumerate(zip(batch.column(0).to_pylist(), id_array(batch.column(2)).tolist(), batch.column(3).to_pylist(), strict=True)):
                for x in wanted:
                    at, n, part = x["at"], x["n"], x["part"]
                    low, high = int(rows[i]) + at, int(rows[i]) + at + n + spec.length - 1
                    span = raw[bounds[0][low] : bounds[1][high - 1]] if spec.words else raw[low:high]
                    for c, v in zip(out, (part, row, doc, at, span), strict=True):
                        c.append(v)
            yield pa.record_batch([pa.array(out[0], pa.int32()), *(pa.array(c, pa.int64()) for c in out[1:4]), pa.array(out[4], pa.binary())], names=["part", "row", "doc", "at", "span"])

    return run


def repeated_windows(spec: Spec, spans: pa.Array, numbers: np.ndarray, docs: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Marks of the windows of these spans that occur again (or, if the first stays, occurred before) among them."""
    data, off = text_buffer(spans)
    values, rows = symbols(spec, data, off)
    before = np.concatenate([[0], np.cumsum(np.maximum(np.diff(rows) - spec.length + 1, 0))])
    total = int(before[-1])

    def windows(i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Spans of the windows with these numbers, and their places in them."""
        which = np.searchsorted(before, i, "right") - 1
        return which, i - before[which]

    # fingerprints of all windows, step by step; then a sixteenth of them at a time is sorted
    one, two = np.empty(total, U64), np.empty(total, U64)
    at_window = 0
    while at_window < total:
        which, place = windows(np.arange(at_window, min(total, at_window + STEP)))
        low = rows[which] + place
        first = int(low[0])
        low = low[: int(np.searchsorted(low, first + STEP, "left"))] - first
        part, stop = values(first, first + int(low[-1]) + spec.length), at_window + len(low)
        for out, rolling in ((one, FIRST), (two, SECOND)):
            out[at_window:stop] = mix(rolling.ranges(rolling.sums(part), low, low + spec.length))
        at_window = stop
    found = [np.zeros(0, CHUNK)]
    bucket = (one >> U64(60)).astype(np.uint8)
    for k in range(16):
        i = np.flatnonzero(bucket == k)
        if not len(i):
            continue
        which, place = windows(i)
        out = np.zeros(len(i), CHUNK)
        out["a"], out["s"], out["doc"], out["row"], out["at"], out["n"] = one[i], two[i], docs[which], numbers[which], at[which] + place, 1
        out = order(out)
        new = changes(out["a"], out["s"])
        cls = np.cumsum(new) - 1
        if spec.later:
            head = np.flatnonzero(new)[cls]
            hit = (out["row"] != out["row"][head]) | (out["at"] != out["at"][head])
        else:
            hit = np.bincount(cls)[cls] > 1
        found.append(joined_runs(out[hit], spec.length))
    return joined_runs(np.concatenate(found), spec.length)


def _window_pass(spec: Spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by("part")
        part = table.column("part").to_numpy()
        cuts = [*np.flatnonzero(changes(part)).tolist(), len(part)]
        numbers, docs, at = (table.column(c).to_numpy() for c in ("row", "doc", "at"))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield marks(repeated_windows(spec, pa.concat_arrays(table.column("span").slice(a, b - a).chunks), numbers[a:b], docs[a:b], at[a:b]), spec.length, 0, 0)

    return run


def repeated(docs: DataFrame, spec: Spec, index: Callable[[], Groups], owners: int | None = None) -> DataFrame:
    """Of a steady frame: row (its row_number), spans: array of packed (start << 32 | symbols) to remove. Only rows that have any."""
    spark = docs.sparkSession
    n = parts_of(spark)
    owners = owners or 4 * n
    rows = docs.select(row_number(docs).alias("row"), "text", key_of().alias("doc"))
    sent = rows.mapInArrow(_first_pass(spec, owners), MARK)
    first = staged(sent.repartitionById(n, F.expr(f"pmod(part, {n})")).mapInArrow(_owner_pass(spec, owners, index), MARK).drop("blob"), "chunks")
    wanted = first.where("kind = 1").groupBy("row").agg(F.collect_set(F.struct("at", "n", "part")).alias("wanted"))
    wanted = staged(wanted, "wanted")
    spans = only_ids(rows, wanted, "row").join(wanted, "row").select("row", "text", "doc", "wanted").mapInArrow(_spans(spec), "part int, row long, doc long, at long, span binary")
    second = spans.repartitionById(n, F.expr(f"pmod(part, {n})")).mapInArrow(_window_pass(spec), MARK)
    found = first.where("kind = 0").select("row", "at", "n").unionByName(second.select("row", "at", "n"))
    return staged(found.groupBy("row").agg(F.collect_set(F.shiftleft("at", 32).bitwiseOR(F.col("n"))).alias("spans")), "removed")


def with_spans(docs: DataFrame, removed: DataFrame, keep: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """keep over (doc, text, spans) of the rows that have spans, and over (doc, text) of all others; every row goes one way only."""
    rows = docs.select(row_number(docs).alias("row"), "text", key_of().alias("doc"))
    known = _in_bitmap(rows, removed, "row")
    joined = known.where("_hit").join(removed, "row", "left").select("doc", "text", "spans").mapInArrow(keep, schema)
    return joined.unionByName(known.where("not _hit").select("doc", "text").mapInArrow(keep, schema))


def removed_mask(spans: list[int] | None, n: int) -> np.ndarray:
    """Which of n symbols the packed spans cover."""
    edge = np.zeros(n + 1, np.int64)
    if spans is not None and len(spans):
        packed = np.asarray(spans, np.int64)
        start, size = packed >> 32, packed & 0xFFFFFFFF
        np.add.at(edge, np.minimum(start, n), 1)
        np.add.at(edge, np.minimum(start + size, n), -1)
    return np.cumsum(edge[:-1]) > 0
