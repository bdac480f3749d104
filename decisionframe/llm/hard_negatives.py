"""Hard negatives by a Voronoi-partition distributed k-nearest-neighbour join.

Inner products become distances by an added norm: a row is (s, sqrt(M^2 - |s|^2)) with the largest norm M, an anchor is (a, 0), and
the larger the product, the smaller the distance. Rows are assigned to the cells of pivots, which are rows themselves, and packed
into blocks by cell, ring of distance to the pivot and, where a ring has more than BLOCK rows, a hash of the id. Anchors are assigned
to groups by the nearest of a few of these pivots. Two joins follow, one for the positives and one for the negatives:

1. Each anchor has a radius within which all rows lie that it can need: for the positives the distance within which the cells'
   own statistics (the smallest distances to the pivot by label and cell) promise as many rows of its label as it needs; for the
   negatives the distance of half the smallest score of its positives.
2. By the triangle inequality a cell's rows within the radius have a distance to the pivot between bounds, and the group's bounds
   are the widest of its anchors'. A block is replicated to the groups whose bounds its ring meets, and to no other.
3. Tasks read a group's anchors, then its blocks one by one, multiply whole blocks and keep the best of each anchor. Products are
   exact: in doubles where every sum is below 2**53, else in 64-bit integers; what does not fit these is an error.

In many dimensions without clusters no bound excludes much (all distances are alike), and the join is anchors by rows, in blocks;
results are exact either way. What the driver and each task learn is bounded: PIVOTS vectors, counts of their cells and rings, and
`nearest + 1` distances for each cell of at most LABELS labels (anchors of other labels have no radius and see every block).

Defined cases: a row without id, label or vector, or with a component that is null or not finite, takes no part. Of rows that share a
vec_id one takes part, the least by (label, vector). Vectors of unequal length count as padded by zeros. A positive with a negative score
has no negatives. Ties go to the smaller vec_id, equal vectors included. Extra columns are ignored; an empty table, one without
anchors and one with a single label give an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import parts_of, prepare, staged

#: Pivots at most, and rows a pivot that are aimed at; rows of a block and anchors of a group; labels whose statistics are shared.
PIVOTS, A_PIVOT, BLOCK, GROUP, LABELS = 1024, 2000, 4096, 1024, 64
#: Share of the radius and of M that a bound is widened by, beyond the errors of doubles.
SLACK = 1e-6
SCALE = 256


def prepared(embeddings: DataFrame) -> DataFrame:
    """id, label, v (whole numbers), is_anchor: op13's rows, labels and anchors."""
    e = F.col("embedding")
    sound = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull() & sound)
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    whole = F.transform(e, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return rows.select(F.col("vec_id").cast("long").alias("id"), label.alias("label"), whole.alias("v"), (F.col("vec_id") % 50 == 0).alias("is_anchor"))


@dataclass(frozen=True)
class Space:
    """What tasks know: dimensions, the largest norm, pivots as augmented rows, groups' pivots, and how to count exactly."""

    size: int
    norm: float
    pivots: np.ndarray
    groups: int
    store: str
    doubles: bool

    def to_rows(self, v: np.ndarray) -> np.ndarray:
        """Distances of rows to the pivots."""
        x = v.astype(np.float64)
        up = np.sqrt(np.maximum(self.norm**2 - (x * x).sum(axis=1), 0))
        return self.roots(2 * self.norm**2 - 2 * (x @ self.pivots[:, :-1].T + up[:, None] * self.pivots[:, -1]))

    def to_anchors(self, v: np.ndarray) -> np.ndarray:
        """Distances of anchors to the pivots."""
        x = v.astype(np.float64)
        return self.roots((x * x).sum(axis=1)[:, None] + self.norm**2 - 2 * x @ self.pivots[:, :-1].T)

    @staticmethod
    def roots(squares: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(squares, 0))

    def scores(self, a: np.ndarray, s: np.ndarray) -> np.ndarray:
        kind = np.float64 if self.doubles else np.int64
        return a.astype(kind) @ s.astype(kind).T


def _matrix(col: pa.Array, size: int) -> np.ndarray:
    """Lists of whole numbers as rows, padded by zeros."""
    n = np.diff(np.asarray(col.offsets)) if len(col) else np.zeros(0, np.int64)
    flat = col.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(col), size), np.int64)
    row = np.repeat(np.arange(len(col)), n)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


ROW = "id long, label long, vec binary, cell int, dist double"


def _assign(space: Space, anchors: bool):
    """Rows with their cell and the distance to its pivot; anchors with their group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(2), space.size)
            far = space.to_anchors(v)[:, : space.groups] if anchors else space.to_rows(v)
            cell = far.argmin(axis=1)
            packed = v.astype(space.store)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in packed], pa.binary()), pa.array(cell, pa.int32()), pa.array(far[np.arange(len(cell)), cell])], names=["id", "label", "vec", "cell", "dist"])

    return run


def _vectors(col: pa.ChunkedArray | pa.Array, space: Space) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), space.store).reshape(-1, space.size)


def _column(group: pa.Table, name: str) -> np.ndarray:
    return group.column(name).to_numpy()


PACKED = "block long, cell int, low double, high double, n int, blob binary"


def _pack_block(space: Space):
    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        dist = _column(group, "dist")
        blob = _column(group, "id").tobytes() + _column(group, "label").tobytes() + _vectors(group.column("vec"), space).tobytes()
        return pa.table({"block": [group.column("block")[0].as_py()], "cell": pa.array([group.column("cell")[0].as_py()], pa.int32()), "low": [dist.min()], "high": [dist.max()], "n": pa.array([len(dist)], pa.int32()), "blob": pa.array([blob], pa.binary())})

    return pack


ANCHORS = "grp long, low array<double>, high array<double>, n int, blob binary"


def _pack_group(space: Space, radius: Callable[[np.ndarray, np.ndarray, pa.Table], np.ndarray], more: tuple[str, ...]):
    """Anchors of a group and, by cell, the least and the largest distance to the pivot that a row of theirs can have."""

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        v = _vectors(group.column("vec"), space)
        far = space.to_anchors(v)
        reach = radius(v, far, group)
        reach = reach + SLACK * (reach + space.norm)
        low, high = (far - reach[:, None]).min(axis=0), (far + reach[:, None]).max(axis=0)
        blob = _column(group, "id").tobytes() + _column(group, "label").tobytes() + b"".join(_lists(group, c).tobytes() for c in more) + v.tobytes()
        return pa.table({"grp": [group.column("grp")[0].as_py()], "low": pa.array([low.tolist()], pa.list_(pa.float64())), "high": pa.array([high.tolist()], pa.list_(pa.float64())), "n": pa.array([len(v)], pa.int32()), "blob": pa.array([blob], pa.binary())})

    return pack


def _lists(group: pa.Table, name: str) -> np.ndarray:
    """Lists of equal length as rows."""
    return np.array(group.column(name).to_pylist(), np.int64)


def _best(score: np.ndarray, ids: np.ndarray, k: int, held: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row of score (what can't be taken is the least value) and of those held, by score, then smaller id."""
    none = _none(score)
    floor = held[0][:, -1]
    if score.shape[1] > k:
        floor = np.maximum(floor, np.partition(score, -k, axis=1)[:, -k])
    row, col = np.nonzero((score >= floor[:, None]) & (score > none))
    rows = np.concatenate([row, np.repeat(np.arange(len(score)), k)])
    values, names = np.concatenate([score[row, col], held[0].ravel()]), np.concatenate([ids[col], held[1].ravel()])
    order = np.lexsort((names, -values, rows))
    rows = rows[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    order = order[place < k]
    return values[order].reshape(-1, k), names[order].reshape(-1, k)


def _none(score: np.ndarray):
    return -np.inf if score.dtype == np.float64 else np.int64(-(2**62))


def _join(space: Space, k: int, lists: int, band: tuple[int, int] | None):
    """Over rows (grp, salt, kind, n, blob) sorted so: a group's anchors, then its blocks. Without a band the k best rows of an
    anchor's label are kept, with one the k best of other labels within it, for each positive."""
    kind = np.float64 if space.doubles else np.int64

    def fresh(n: int) -> tuple[np.ndarray, np.ndarray]:
        return np.full((n, k), _none(np.zeros(0, kind))), np.full((n, k), 2**63 - 1)

    def emit(anchor: tuple, held: list) -> Iterator[pa.RecordBatch]:
        ids, _, positives, scores, _ = anchor
        for i, (value, name) in enumerate(held):
            there = value > _none(value)
            row, col = np.nonzero(there)
            if len(row):
                own = (positives[row, i], scores[row, i]) if band else (np.zeros(len(row), np.int64),) * 2
                yield pa.record_batch([pa.array(x) for x in (ids[row], *own, name[row, col], value[row, col].astype(np.int64))], names=["anchor", "positive", "positive_score", "other", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, held = None, []
        for batch in batches:
            for what, n, blob in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), strict=True):
                raw = memoryview(blob.as_buffer())
                ids, labels = np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.int64, n, 8 * n)
                skip = 16 * n + (16 * n * lists if what == 0 else 0)
                v = np.frombuffer(raw, space.store, n * space.size, skip).reshape(n, space.size)
                if what == 0:
                    if anchor is not None:
                        yield from emit(anchor, held)
                    positives, scores = (np.frombuffer(raw, np.int64, n * lists, 16 * n + 8 * n * lists * i).reshape(n, lists) for i in range(2))
                    anchor, held = (ids.copy(), labels.copy(), positives.copy(), scores.copy(), v.copy()), [fresh(n) for _ in range(max(1, lists))]
                    continue
                names, own, _, scores, a = anchor
                for at in range(0, n, BLOCK):  # blocks are no larger but for chance
                    part = slice(at, at + BLOCK)
                    score = space.scores(a, v[part])
                    same = own[:, None] == labels[None, part]
                    none = _none(score)
                    if not band:
                        held[0] = _best(np.where(same & (names[:, None] != ids[None, part]), score, none), ids[part], k, held[0])
                        continue
                    score = np.where(same, none, score)
                    for i in range(lists):
                        p = scores[:, i : i + 1].astype(kind)
                        within = (score > none) & (100 * np.where(same, 0, score) >= band[0] * p) & (100 * np.where(same, 0, score) <= band[1] * p) & (p >= 0)
                        held[i] = _best(np.where(within, score, none), ids[part], k, held[i])
        if anchor is not None:
            yield from emit(anchor, held)

    return run


FOUND = "anchor long, positive long, positive_score long, other long, score long"


def _joined(groups: DataFrame, blocks: DataFrame, splits: int, run, name: str) -> DataFrame:
    """Each group's blocks, dealt out over its splits, meet its anchors."""
    spark = groups.sparkSession
    bounds = groups.select("grp", F.posexplode(F.arrays_zip("low", "high")).alias("cell", "b")).select("grp", "cell", F.col("b.low").alias("least"), F.col("b.high").alias("most"))
    meets = (F.col("x.cell") == F.col("y.cell")) & (F.col("x.high") >= F.col("y.least")) & (F.col("x.low") <= F.col("y.most"))
    pairs = blocks.select("block", "cell", "low", "high").alias("x").join(bounds.alias("y"), meets).select("grp", "block")
    sent = pairs.join(blocks.select("block", "n", "blob"), "block").select("grp", F.pmod(F.xxhash64("block"), F.lit(splits)).cast("int").alias("salt"), F.lit(1).alias("kind"), "n", "blob")
    heads = groups.select("grp", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("salt"), F.lit(0).alias("kind"), "n", "blob")
    dealt = heads.unionByName(sent).repartition(parts_of(spark), "grp", "salt").sortWithinPartitions("grp", "salt", "kind")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 8)  # a block may have a megabyte and more
    try:
        return staged(dealt.mapInArrow(run, FOUND), name)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def _space(rows: DataFrame, positives: int) -> tuple[Space | None, int, int]:
    """The space, and the numbers of rows and anchors."""
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    largest = F.aggregate("v", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x.cast("double"))))
    n, anchors, norm2, largest, size = rows.agg(F.count("*"), F.count_if("is_anchor"), F.max(norm2), F.max(largest), F.max(F.size("v"))).first()
    if not n or not anchors or not size:
        return None, n, anchors
    if 100 * size * largest**2 >= 2**62:
        raise ValueError("scores of these vectors don't fit into long integers")
    wanted = max(1, min(PIVOTS, -(-n // A_PIVOT)))
    chosen = rows.select("v", F.xxhash64("id").alias("h"), "id").orderBy("h", "id").limit(wanted).collect()
    v = np.zeros((len(chosen), size))
    for i, r in enumerate(chosen):
        v[i, : len(r["v"])] = r["v"]
    norm = float(np.sqrt(norm2)) * (1 + 1e-12)
    up = np.sqrt(np.maximum(norm**2 - (v * v).sum(axis=1), 0))
    store = "<i2" if largest < 2**15 else "<i4" if largest < 2**31 else "<i8"
    return Space(size, norm, np.column_stack([v, up]), max(1, min(len(chosen), -(-anchors // GROUP))), store, 100 * size * largest**2 < 2**53), n, anchors


def _blocks(rows: DataFrame, space: Space) -> DataFrame:
    """The rows in blocks by cell, ring and hash of the id."""
    spark = rows.sparkSession
    edges = rows.groupBy("cell").agg(F.percentile_approx("dist", [0.25, 0.5, 0.75], 200).alias("edges"))
    ringed = staged(rows.join(F.broadcast(spark.createDataFrame(edges.collect(), edges.schema)), "cell").withColumn("ring", F.size(F.filter("edges", lambda e: e < F.col("dist")))).drop("edges"), "ringed")
    base, table = 0, []
    for r in ringed.groupBy("cell", "ring").count().orderBy("cell", "ring").collect():
        salts = -(-r["count"] // BLOCK)
        table.append((r["cell"], r["ring"], base, salts))
        base += salts
    rings = F.broadcast(spark.createDataFrame(table, "cell int, ring int, base long, salts int"))
    dealt = ringed.join(rings, ["cell", "ring"]).withColumn("block", F.col("base") + F.pmod(F.xxhash64("id"), F.col("salts")))
    return staged(dealt.select("block", "cell", "id", "label", "vec", "dist").groupBy("block").applyInArrow(_pack_block(space), PACKED), "blocks")


def _near_by_label(rows: DataFrame, need: int) -> dict[int, list[tuple[int, float]]]:
    """For LABELS labels at most (cell, distance to its pivot) of the `need` rows of each cell that are nearest to it."""
    labels = [r["label"] for r in rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(LABELS).collect()]
    first = Window.partitionBy("label", "cell").orderBy("dist")
    ranked = rows.where(F.col("label").isin(labels)).select("label", "cell", "dist").withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= need)
    out: dict[int, list[tuple[int, float]]] = {}
    for r in ranked.collect():
        out.setdefault(r["label"], []).append((r["cell"], r["dist"]))
    return out


def mine(rows: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Of rows (id, label, v, is_anchor): anchor_id, positive_id, rank, negative_id, positive_score, negative_score, where
    low * positive_score <= 100 * negative_score <= high * positive_score."""
    spark = rows.sparkSession
    prepare(spark)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    one = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"), F.max("is_anchor").alias("is_anchor")).select("id", "r.label", "r.v", "is_anchor")
    one = staged(one, "vectors")
    space, _, n_anchors = _space(one, positives)
    if space is None:
        return spark.createDataFrame([], schema)
    assigned = staged(one.select("id", "label", "v").mapInArrow(_assign(space, False), ROW), "assigned")
    anchors = staged(one.where("is_anchor").select("id", "label", "v").mapInArrow(_assign(space, True), ROW), "anchors")
    blocks = _blocks(assigned, space)
    near = _near_by_label(assigned, positives + 1)
    sizes = spark.createDataFrame([(r["cell"], -(-r["count"] // GROUP)) for r in anchors.groupBy("cell").count().collect()], "cell int, chunks int")
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks"))
    grouped = anchors.join(F.broadcast(sizes), "cell").withColumn("grp", F.col("cell").cast("long") * F.lit(1 << 32) + chunk).drop("dist", "chunks")
    splits = max(1, -(-2 * parts_of(spark) * GROUP // max(n_anchors, GROUP)))

    def by_label(v: np.ndarray, far: np.ndarray, group: pa.Table) -> np.ndarray:
        label, out = _column(group, "label"), np.full(len(v), np.inf)
        for x in np.unique(label).tolist():
            known = near.get(x, ())
            if len(known) > positives:  # the anchor itself may be one of them
                cell, dist = (np.array(c) for c in zip(*known, strict=True))
                mine_ = np.flatnonzero(label == x)
                out[mine_] = np.partition(far[mine_][:, cell] + dist, positives, axis=1)[:, positives]
        return out

    def by_score(v: np.ndarray, far: np.ndarray, group: pa.Table) -> np.ndarray:
        score = _lists(group, "scores").astype(np.float64)
        least = np.where(score >= 0, score, np.inf).min(axis=1)
        x = v.astype(np.float64)
        return np.sqrt(np.maximum((x * x).sum(axis=1) + space.norm**2 - 2 * least * low / 100, 0))

    groups = staged(grouped.groupBy("grp").applyInArrow(_pack_group(space, by_label, ()), ANCHORS), "groups")
    found = _joined(groups, blocks, splits, _join(space, positives, 0, None), "positives")
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "other")
    best = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= positives)
    # lists of equal length; what is missing has a score below zero, and such positives have no negatives
    lists = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "other", "score"))).alias("p"), F.max("score").alias("top")).where("top >= 0")
    padded = lambda f, v: F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.coalesce(F.get("p", i)[f], F.lit(v).cast("long")))
    lists = lists.select(F.col("anchor").alias("id"), padded("other", -1).alias("positives"), padded("score", -1).alias("scores"))
    asked = staged(grouped.join(lists, "id").groupBy("grp").applyInArrow(_pack_group(space, by_score, ("positives", "scores")), ANCHORS), "asked")
    found = _joined(asked, blocks, splits, _join(space, negatives, positives, (low, high)), "negatives")
    first = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "other")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    return ranked.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

