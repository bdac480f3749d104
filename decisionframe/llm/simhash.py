"""SimHash near-dedup over BK-trees.

A document's fingerprint has a bit set where more than half of its shingles' XXH64 hashes have it. Documents whose fingerprints
differ in RADIUS bits at most are linked, and links make components.

Only distinct fingerprints are compared. Of BLOCKS blocks of bits, BLOCKS - RADIUS at least are equal in any linked pair; for each
choice of so many blocks a fingerprint has a key, and keys are dealt out to shards. A shard holds a forest of BK-trees, one tree for
each key, whose children are keyed by their integer Hamming distance to the parent; a search follows only edges whose distance is
within the radius of its own. A shard with more than NODES entries, as a frequent key makes, is split into chunks, and each chunk's
trees are sent to the others of its shard. So trees and tasks are bounded whatever the keys' frequencies, and nothing is sent to
tasks that can't have a link to it: with a broadcast of every tree to every task the work would grow with the square of the corpus.
Of the links that a search finds only a spanning forest leaves its task, so a dense group of near copies gives no pairs.

Defined cases: a null text and one without words have fingerprint zero, linked like any other. A text with fewer words than a
shingle has one shingle of all its words. A null doc_id sorts before all others and is returned as null. Rows that repeat a doc_id
are rows of their own, all returned. A very long text is hashed in steps. Extra columns are ignored, or kept by near_dedup. An
empty table gives an empty result.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, NULL_ID, U64, id_array, key_of, mix, row_number, rows_without, slices, staged, steady, text_buffer, word_bounds
from .components import components

#: Words of a shingle; bits that linked fingerprints may differ in; blocks that the 64 bits are cut into; seed of the hash.
SHINGLE, RADIUS, BLOCKS, SEED = 3, 3, 5, 42
#: Entries of a shard's trees that are aimed at, of a task before it sends them, of a search's frontier, and words hashed in a step.
NODES, HELD, FRONTIER, WORDS = 100_000, 1_000_000, 1 << 20, 50_000
ENTRY = np.dtype([("key", "<u8"), ("value", "<u8")])


def _votes(lowered: bytes, starts: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """How many shingles of these words have each bit set, and the number of shingles."""
    votes, total, digest = np.zeros(64, np.int64), 0, xxhash.xxh64_intdigest
    last = max(1, len(starts) - size + 1)
    for at in range(0, last, WORDS):
        stop = min(last, at + WORDS) + size - 1
        words = lowered[int(starts[at]) : int(ends[min(stop, len(ends)) - 1])].split()
        joined = b" ".join(words)
        bounds = np.cumsum([0, *(len(w) + 1 for w in words)]).tolist()
        if len(words) < size:
            found = [digest(joined, SEED)]
        else:
            found = [digest(joined[a : b - 1], SEED) for a, b in zip(bounds, bounds[size:], strict=False)]
        bits = np.unpackbits(np.array(found, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
        total += len(found)
    return votes, total


def _prints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, off = text_buffer(batch.column(1))
            starts, ends, rows = word_bounds(data, off, IS_SPACE)
            lowered, bits = data.tobytes().lower(), np.zeros((batch.num_rows, 64), bool)
            for i, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)):
                if a < b:
                    votes, total = _votes(lowered, starts[a:b], ends[a:b], size)
                    bits[i] = votes * 2 > total
            prints = np.packbits(bits, axis=1).view(">u8").ravel().astype(U64)
            yield pa.record_batch([batch.column(0), pa.array(prints.view(np.int64)), batch.column(2)], names=["id", "print", "row"])

    return run


def fingerprints(docs: DataFrame, size: int = SHINGLE, row=None) -> DataFrame:
    """id, print (the fingerprint's bits as a signed long), row."""
    rows = docs.select(key_of().alias("id"), "text", F.lit(0).cast("long").alias("row") if row is None else row.alias("row"))
    return rows.mapInArrow(_prints(size), "id long, print long, row long")


def masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """One mask for each choice of blocks of which one at least is equal in any two fingerprints within the radius."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(parts, blocks - radius)]


class Trees:
    """A forest of BK-trees: a node's value, each key's root, and children sorted by parent and distance to it."""

    def __init__(self, entries: np.ndarray) -> None:
        entries = entries[np.lexsort((entries["value"], entries["key"]))]
        same = np.zeros(len(entries), bool)
        same[1:] = (entries["key"][1:] == entries["key"][:-1]) & (entries["value"][1:] == entries["value"][:-1])
        entries = entries[~same]
        self.key, self.value = entries["key"].copy(), entries["value"].copy()
        n = len(entries)
        group = np.concatenate([[True], self.key[1:] != self.key[:-1]]) if n else np.zeros(0, bool)
        self.root_node = np.flatnonzero(group)
        self.root_key = self.key[self.root_node]
        parent_edge = np.full(n, -1, np.int64)
        # level by level: the first of a group is a node, the others are grouped by their distance to it
        head = self.root_node[np.cumsum(group) - 1] if n else self.root_node
        left = np.flatnonzero(~group)
        head = head[left]
        while len(left):
            place = head * 65 + np.bitwise_count(self.value[left] ^ self.value[head]).astype(np.int64)
            order = np.lexsort((left, place))
            left, place = left[order], place[order]
            new = np.concatenate([[True], place[1:] != place[:-1]])
            first = left[new]
            parent_edge[first] = place[new]
            head, left = first[np.cumsum(new) - 1][~new], left[~new]
        self.child = np.flatnonzero(parent_edge >= 0)
        self.child = self.child[np.argsort(parent_edge[self.child], kind="stable")]
        self.edge = parent_edge[self.child]

    def dump(self) -> bytes:
        out = io.BytesIO()
        for x in (self.key, self.value, self.root_node, self.root_key, self.child, self.edge):
            np.save(out, x, allow_pickle=False)
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> Trees:
        out, source = cls.__new__(cls), io.BytesIO(blob)
        out.key, out.value, out.root_node, out.root_key, out.child, out.edge = (np.load(source, allow_pickle=False) for _ in range(6))
        return out

    def search(self, keys: np.ndarray, values: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of queries and nodes of the same key that are within the radius, a part of them at a time."""
        if not len(self.root_key) or not len(keys):
            return
        at = np.minimum(np.searchsorted(self.root_key, keys), len(self.root_key) - 1)
        asked = np.flatnonzero(self.root_key[at] == keys)
        open_ = [(asked, self.root_node[at[asked]])]
        while open_:
            query, node = open_.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                open_ += [(query[half:], node[half:]), (query[:half], node[:half])]
                continue
            apart = np.bitwise_count(values[query] ^ self.value[node]).astype(np.int64)
            hit = apart <= radius
            if hit.any():
                yield query[hit], node[hit]
            low = np.searchsorted(self.edge, node * 65 + np.maximum(apart - radius, 0))
            high = np.searchsorted(self.edge, node * 65 + np.minimum(apart + radius, 64), "right")
            n = high - low
            some = np.flatnonzero(n)
            # a piece of the nodes whose children fit into a frontier
            for piece in np.split(some, np.flatnonzero(np.diff(np.cumsum(n[some]) // FRONTIER)) + 1):
                if len(piece):
                    count = n[piece]
                    within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                    open_.append((np.repeat(query[piece], count), self.child[np.repeat(low[piece], count) + within]))


class Forest:
    """Which of n things are joined; only a star for each joined group is kept."""

    def __init__(self, n: int) -> None:
        self.up, self.held, self.size = np.arange(n), [], 0

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        self.held.append((a, b))
        self.size += len(a)
        if self.size > FRONTIER:
            self.settle()

    def settle(self) -> None:
        if not self.held:
            return
        a, b = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.size = [], 0
        while True:
            x, y = self.up[a], self.up[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.up, np.maximum(x, y), np.minimum(x, y))
            while (self.up != (above := self.up[self.up])).any():
                self.up = above

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        self.settle()
        member = np.flatnonzero(self.up != np.arange(len(self.up)))
        return self.up[member], member


def _entries(radius: int, blocks: int, shards: int):
    """Keys of the fingerprints, packed by shard."""
    chosen = [U64(m) for m in masks(radius, blocks)]
    salts = mix(np.arange(1, len(chosen) + 1, dtype=U64))

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        values = np.concatenate(held)
        out = np.empty(len(values) * len(chosen), ENTRY)
        for i, mask in enumerate(chosen):
            part = out[i * len(values) : (i + 1) * len(values)]
            part["key"], part["value"] = mix((values & mask) ^ salts[i]), values
        shard = ((out["key"] >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        out, shard = out[order], shard[order]
        starts = [*np.flatnonzero(np.diff(shard, prepend=-1)).tolist(), len(shard)]
        cuts = [c for a, b in zip(starts, starts[1:], strict=False) for c in range(a, b, NODES // 4)] + [len(shard)]
        bounds = list(zip(cuts, cuts[1:], strict=False))
        yield pa.record_batch([pa.array([int(shard[a]) for a, _ in bounds], pa.int32()), pa.array([b - a for a, b in bounds], pa.int64()), pa.array([out[a:b].tobytes() for a, b in bounds], pa.binary())], names=["shard", "n", "entries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy().view(U64))
            n += batch.num_rows * len(chosen)
            if n >= HELD:
                yield from flush(held)
                held, n = [], 0
        if n:
            yield from flush(held)

    return run


FOUND = "shard int, chunk int, a long, b long, trees binary"


def _found(shard: int, chunk: int, a: np.ndarray, b: np.ndarray, trees: bytes | None) -> pa.Table:
    m, t = len(a), int(trees is not None)
    return pa.table({"shard": pa.array([shard] * (m + t), pa.int32()), "chunk": pa.array([chunk] * (m + t), pa.int32()), "a": pa.array([*a.view(np.int64).tolist(), *[None] * t], pa.int64()), "b": pa.array([*b.view(np.int64).tolist(), *[None] * t], pa.int64()), "trees": pa.array([*[None] * m, *([trees] if t else [])], pa.binary())})


def _grow(radius: int):
    """The trees of a chunk of a shard, its own links, and the trees themselves if other chunks must be compared with them."""

    def grow(group: pa.Table) -> pa.Table:
        trees = Trees(np.concatenate([np.frombuffer(x, ENTRY) for x in group.column("entries").to_pylist()]))
        forest = Forest(len(trees.value))
        for query, node in trees.search(trees.key, trees.value, radius):
            forest.join(query, node)
        root, member = forest.stars()
        several = group.column("chunks")[0].as_py() > 1
        return _found(group.column("shard")[0].as_py(), group.column("chunk")[0].as_py(), trees.value[root], trees.value[member], trees.dump() if several else None)

    return grow


def _across(radius: int):
    """Links between the chunks of a shard: one chunk's nodes are searched for in the other's trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, two in zip(batch.column(0), batch.column(1), strict=True):
                trees, others = Trees.load(one.as_py()), Trees.load(two.as_py())
                forest, n = Forest(len(trees.value) + len(others.value)), len(trees.value)
                for query, node in trees.search(others.key, others.value, radius):
                    forest.join(query + n, node)
                values = np.concatenate([trees.value, others.value]).view(np.int64)
                root, member = forest.stars()
                yield pa.record_batch([pa.array(values[root]), pa.array(values[member])], names=["a", "b"])

    return run


def links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, nodes: int = NODES) -> DataFrame:
    """a, b: links that join all fingerprints (prints has them once each, as `print`) that are within the radius, or a chain of such."""
    spark = prints.sparkSession
    shards = max(1, -(-prints.count() * len(masks(radius, blocks)) // nodes))
    sent = staged(prints.select("print").mapInArrow(_entries(radius, blocks, shards), "shard int, n long, entries binary"), "entries")
    sizes = sent.groupBy("shard").agg(F.ceil(F.sum("n") / F.lit(nodes * 2)).cast("int").alias("chunks"))
    dealt = sent.join(sizes, "shard").withColumn("chunk", F.pmod(F.xxhash64("entries"), F.col("chunks")).cast("int"))
    found = staged(dealt.groupBy("shard", "chunk").applyInArrow(_grow(radius), FOUND), "found")
    own = found.where("a is not null").select("a", "b")
    trees = found.where("trees is not null").select("shard", "chunk", "trees")
    x, y = trees.alias("x"), trees.alias("y")
    pairs = x.join(y, (F.col("x.shard") == F.col("y.shard")) & (F.col("x.chunk") < F.col("y.chunk"))).select(F.col("x.trees").alias("one"), F.col("y.trees").alias("two"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)  # a tree is some megabytes
    try:
        across = staged(pairs.mapInArrow(_across(radius), "a long, b long"), "across")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    return own.unionByName(across).where("a <> b").distinct()


def _linked(info: DataFrame, radius: int, blocks: int, nodes: int) -> DataFrame:
    """print, first (id and row of the component's first document) for every distinct fingerprint."""
    prints = staged(info.groupBy("print").agg(F.min(F.struct("id", "row")).alias("first")), "prints")
    comps = components(links(prints, radius, blocks, nodes))
    known = prints.join(comps.select(F.col("node").alias("print"), "comp"), "print", "left").select("print", "first", F.coalesce("comp", "print").alias("comp"))
    known = staged(known, "known")
    lowest = known.groupBy("comp").agg(F.min("first").alias("first"))
    return staged(known.drop("first").join(lowest, "comp").select("print", "first"), "firsts")


def near_components(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE, blocks: int = BLOCKS, nodes: int = NODES) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hexadecimal digits), component_id."""
    info = staged(fingerprints(docs, size), "prints")
    joined = info.join(_linked(info, radius, blocks, nodes), "print")
    null = F.lit(NULL_ID)
    first = F.col("first.id")
    return joined.select(F.when(F.col("id") != null, F.col("id")).alias("doc_id"), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), F.when(first != null, first).alias("component_id"))


def near_dedup(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """docs with one document of each component, the one with the smallest doc_id (of several such the first row); all columns stay."""
    docs = steady(docs)
    info = staged(fingerprints(docs, size, row_number(docs)), "prints")
    return rows_without(docs, info.join(_linked(info, radius, BLOCKS, NODES), "print").where("row <> first.row").select("row"))
