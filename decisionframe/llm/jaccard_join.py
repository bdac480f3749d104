"""N-gram Jaccard join by parity sketches.

A document's set is its distinct word shingles as 64-bit fingerprints. XOR-hashing them into a sketch
of parity bits makes the Hamming distance of two sketches a lower bound of the symmetric difference,
which a Jaccard similarity of t or more bounds by (1 - t) / (1 + t) * (a + b). Per size band, the
sketch has so many parts that more than a number `spare` of them must be equal in any linked pair
(pigeonhole). So a document may leave out its `spare` first parts in any order that is the same for all
documents, and a linked pair still meets in one at least: first come parts with no bit set, which are not even
sent, then those that most documents share, as boilerplate and common passages make them.

Documents with equal sets are one class first. Equal parts meet at their owners, where each document
is paired with the smallest of its part only; these stars are verified and give components. Where
components still meet in a part, a few rounds of stars about other documents follow: first the one
that shares most parts, as an original does that all copies are near to, then random ones. Then the
pairs across components that a 512-bit sketch does not rule out are verified as well, so no link
between components is lost and no pairs are enumerated within them.

Defined cases: a document without words or a null text has an empty set and is linked with nothing;
one with fewer words than a shingle has one shingle of all its words; a null doc_id sorts before all
others and is returned as null; rows that repeat a doc_id are nodes of their own, told apart by their place in
the files; a very long text is a slice of its own; of equally small ids in a component the first row stays in near_dedup.
Extra columns are ignored, or kept by near_dedup. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import IS_SPACE, NULL_ID, U64, id_array, key_of, mix, only_ids, parts_of, row_number, rows_without, slices, staged, steady, text_buffer, without_ids, word_bounds, word_hashes
from .components import components
from .repeats import WORDS, changes

#: Words of a shingle; least similarity in hundredths.
SHINGLE, PERCENT = 4, 85
#: Parts that a document may leave out, as a share of the bound; places in a part, as a power of two.
RATIO_SPARE, PART_BITS = 0.4, 16
#: 64-bit words of the sketch that pairs across components are compared by.
SKETCH = 8
#: Rounds of stars before pairs across components are looked at.
ROUNDS = 4
#: A part key whose last bit tells a document's two size bands apart, a document, and how many parts of the band it may still leave out.
MEMBER = np.dtype([("key", "<u8"), ("doc", "<i8"), ("room", "<i4")])
#: Part keys that a task holds before it compares and sends them.
HELD = 1_000_000


def shingles(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle fingerprints of all rows, sorted within each row, and the rows' offsets in them."""
    starts, ends, rows = word_bounds(data, off, IS_SPACE)
    words = word_hashes(data, starts, ends, WORDS, True)
    count = np.diff(rows)
    n = len(count)
    row = np.repeat(np.arange(n), count)
    place = np.arange(len(words)) - np.repeat(rows[:-1], count)
    whole = place + size <= count[row]
    at = np.flatnonzero(whole)
    h = np.zeros(len(at), U64)
    for j in range(size):
        h = h * U64(0x9E3779B97F4A7C15) + words[at + j]
    h, owner = mix(h), row[at]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        extra = np.zeros(len(short), U64)
        for j in range(size - 1):
            there = count[short] > j
            extra[there] = mix(extra[there] * U64(3) + words[rows[short[there]] + j] + U64(j + 1))
        h, owner = np.concatenate([h, extra]), np.concatenate([owner, short])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = changes(owner, h)
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(n + 1))


def most_apart(a: float, b: float, percent: int) -> int:
    """The largest symmetric difference of linked sets of these sizes."""
    return int((100 - percent) * (a + b) / (100 + percent) + 1e-9)


class Bands:
    """Size bands: a linked pair's smaller set is in the band, its larger in the same or the next one."""

    def __init__(self, percent: int) -> None:
        self.percent, self.edges = percent, [1]
        while self.edges[-1] < 1 << 31:
            self.edges.append(max(self.edges[-1] + 1, (self.edges[-1] * 100 - 1) // percent + 1))

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.edges, size, "right")) - 1

    def shape(self, band: int) -> tuple[int, int]:
        """Parts of the band's sketch and how many of them a document may leave out."""
        apart = most_apart(self.edges[band + 1] - 1, self.edges[min(band + 2, len(self.edges) - 1)] - 1, self.percent)
        spare = int(apart * RATIO_SPARE)
        return apart + 1 + spare, spare


def part_keys(h: np.ndarray, band: int, shape: tuple[int, int]) -> tuple[np.ndarray, int]:
    """Keys of the parts that a document with these sorted shingles sends in this band, and how many more it may leave out."""
    parts, spare = shape
    x = (h >> U64(32)) * U64(parts)
    position = x >> U64(32 - PART_BITS)  # part number and bit within the part, ascending
    new = changes(position)
    heads = np.flatnonzero(new)
    odd = (np.diff(np.append(heads, len(h))) & 1) == 1
    bits = position[heads[odd]]  # the bits that are set
    part = (bits >> U64(PART_BITS)).astype(np.int64)
    key, empty = np.zeros(parts, U64), np.ones(parts, bool)
    first = np.flatnonzero(changes(part))
    if len(first):
        key[part[first]] = np.bitwise_xor.reduceat(mix(bits), first)
        empty[part] = False
    left_out = np.flatnonzero(empty)[:spare]
    salt = mix(np.arange(parts, dtype=U64) + U64(band << 32))
    key = mix(key ^ salt) & ~U64(1) | U64(band & 1)
    return np.delete(key, left_out), spare - len(left_out)


def sketches(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Parity sketches of 64 * SKETCH bits, one row of 64-bit words per document."""
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    bit = (h & U64(64 * SKETCH - 1)).astype(np.int64)
    odd = (np.bincount(row * (64 * SKETCH) + bit, minlength=n * 64 * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, 64 * SKETCH), axis=1).view("<i8").reshape(n, SKETCH)


INFO = "key long, id long, n long, one long, two long"


def _info(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            h, off = shingles(*text_buffer(batch.column(1)), size)
            total = np.concatenate([[U64(0)], np.cumsum(h, dtype=U64)])
            other = np.concatenate([[U64(0)], np.cumsum(mix(h ^ U64(0xA5A5A5A5A5A5A5A5)), dtype=U64)])
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(np.diff(off)), pa.array((total[off[1:]] - total[off[:-1]]).view(np.int64)), pa.array((other[off[1:]] - other[off[:-1]]).view(np.int64))], names=["key", "id", "n", "one", "two"])

    return run


SENT = "part int, blob binary"
STAR = "part_key long, head long, doc long, head_room long, room long"


def _stars(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first members of all keys by document, and each other member's star with the first of its key, as STAR."""
    m = m[np.lexsort((m["doc"], m["key"]))]
    m = m[changes(m["key"], m["doc"])]
    new = changes(m["key"])
    first = m[np.flatnonzero(new)]
    head = (np.cumsum(new) - 1)[~new]
    rest = m[~new]
    return first, np.column_stack([rest["key"].view(np.int64), first["doc"][head], rest["doc"], first["room"][head], rest["room"]]).astype("<i8").reshape(-1, 5)


def _send(percent: int, size: int, owners: int):
    """Part keys for their owners, one document for each key and task; the others of a key are starred with it here."""
    bands = Bands(percent)

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        first, star = _stars(np.concatenate(held))
        owner = ((first["key"] >> U64(32)) * U64(owners) >> U64(32)).astype(np.int64)
        cuts = np.searchsorted(owner, np.arange(owners + 1))
        there = [i for i in range(owners) if cuts[i] < cuts[i + 1]]
        parts, blobs = [i for i in there], [first[cuts[i] : cuts[i + 1]].tobytes() for i in there]
        for i, piece in enumerate(np.array_split(star, max(1, len(star) // 50_000))):
            if len(piece):
                parts.append(-1 - (i * 7919 + int(piece[0, 2]) & 0xFFFFFF))
                blobs.append(piece.tobytes())
        return pa.record_batch([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in slices(batches):
            h, off = shingles(*text_buffer(batch.column(1)), size)
            for doc, a, b in zip(id_array(batch.column(0)).tolist(), off[:-1].tolist(), off[1:].tolist(), strict=True):
                if a == b:
                    continue
                band = bands.of(b - a)
                for label in {band, max(0, band - 1)}:
                    keys, room = part_keys(h[a:b], label, bands.shape(label))
                    out = np.empty(len(keys), MEMBER)
                    out["key"], out["doc"], out["room"] = keys, doc, room
                    held.append(out)
                    n += len(out)
            if n >= HELD:
                yield flush(held)
                held, n = [], 0
        if n:
            yield flush(held)

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At the owners: members of a key from different tasks are starred with the smallest of them."""
    held: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if part < 0:
                yield _star_rows(np.frombuffer(blob, "<i8").reshape(-1, 5))
            else:
                held.setdefault(part, []).append(np.frombuffer(blob, MEMBER))
    for part in sorted(held):
        yield _star_rows(_stars(np.concatenate(held.pop(part)))[1])


def _star_rows(x: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.ascontiguousarray(x[:, k]), pa.int64()) for k in range(5)], names=["part_key", "head", "doc", "head_room", "room"])


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            h, off = shingles(*text_buffer(batch.column(1)), size)
            words = sketches(h, off)
            sets = [h[a:b].tobytes() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.record_batch([pa.array(id_array(batch.column(0))), pa.array(np.diff(off)), *(pa.array(np.ascontiguousarray(words[:, k])) for k in range(SKETCH)), pa.array(sets, pa.binary())], names=["key", "n", *(f"w{k}" for k in range(SKETCH)), "shingles"])

    return run


SETS = "key long, n long, " + ", ".join(f"w{k} long" for k in range(SKETCH)) + ", shingles binary"


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(s.as_buffer(), U64) for s in (x, y))
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                hit.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(hit, pa.bool_())], names=["a", "b", "linked"])

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs (a, b) with linked: whether their sets are as similar as asked."""
    own = sets.select("key", "shingles")
    one = pairs.join(own.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a")
    two = one.join(own.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b")
    return staged(two.select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long, linked boolean"), "verified")


def _ruled_in(percent: int) -> Column:
    """The sketches' Hamming distance is no more than linked sets of these sizes can differ by."""
    apart = sum((F.bit_count(F.col(f"l.w{k}").bitwiseXOR(F.col(f"r.w{k}"))) for k in range(1, SKETCH)), F.bit_count(F.col("l.w0").bitwiseXOR(F.col("r.w0"))))
    return (apart * (100 + percent) <= (F.col("l.n") + F.col("r.n")) * (100 - percent)) & (F.least("l.n", "r.n") * 100 >= F.greatest("l.n", "r.n") * percent)


def _members(stars: DataFrame) -> DataFrame:
    """part_key, doc: the parts that documents share, without those that each may leave out: the ones shared by most."""
    shared = staged(stars.select("part_key", "doc", "room").unionByName(stars.select("part_key", F.col("head").alias("doc"), F.col("head_room").alias("room"))).distinct(), "members")
    ranked = shared.join(shared.groupBy("part_key").agg(F.count("*").alias("heat")), "part_key")
    first = Window.partitionBy("doc", F.col("part_key").bitwiseAND(F.lit(1))).orderBy(F.col("heat").desc(), "part_key")
    kept = staged(ranked.withColumn("rank", F.row_number().over(first)).where("rank > room").select("part_key", "doc"), "kept")
    alone = kept.groupBy("part_key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("part_key")
    return staged(kept.join(alone, "part_key", "left_semi"), "members")


def _open(members: DataFrame, comps: DataFrame) -> DataFrame:
    """part_key, doc, comp of the parts in which documents of different components meet."""
    known = members.join(comps.select(F.col("node").alias("doc"), "comp"), "doc", "left").select("part_key", "doc", F.coalesce("comp", "doc").alias("comp"))
    mixed = known.groupBy("part_key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("part_key")
    return known.join(mixed, "part_key", "left_semi")


def _star_pairs(open_: DataFrame, r: int) -> DataFrame:
    """One partner (a < b) for each document: of the first ones by this round's order in its parts, the very first."""
    if r == 0:
        order = open_.groupBy("doc").agg((-F.count("*")).alias("o"))
        ranked = open_.join(order, "doc")
    else:
        ranked = open_.withColumn("o", F.xxhash64("doc", F.lit(r)))
    heads = ranked.groupBy("part_key").agg(F.min(F.struct("o", "doc", "comp")).alias("h"))
    first = open_.join(heads, "part_key").where("h.comp <> comp").groupBy("doc").agg(F.min("h").alias("h"))
    return first.select(F.least("doc", "h.doc").alias("a"), F.greatest("doc", "h.doc").alias("b")).distinct()


def linked_components(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, owners: int | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id."""
    return _components(steady(docs), percent, size, owners).select("doc_id", "n_shingles", "component_id")


def _components(docs: DataFrame, percent: int, size: int, owners: int | None = None) -> DataFrame:
    """linked_components of a steady frame, with the row_number of each row and of the one that stands for its component.
    Inside, a row is known by its number, `key`."""
    spark = docs.sparkSession
    n = parts_of(spark)
    owners = owners or 4 * n
    rows = docs.select(row_number(docs).alias("key"), "text")
    info = staged(docs.select(row_number(docs).alias("key"), "text", key_of().alias("id")).mapInArrow(_info(size), INFO), "sets")
    # equal sets are one class; its smallest document stands for it
    classes = info.where("n > 0").groupBy("n", "one", "two").agg(F.min("key").alias("rep"), F.count("*").alias("copies"))
    copies = staged(classes.where("copies > 1").drop("copies"), "classes")
    of_class = info.where("n > 0").join(copies, ["n", "one", "two"]).where("key <> rep").select("key", "rep")
    of_class = staged(of_class.groupBy("key").agg(F.min("rep").alias("rep")), "copies")
    sent = without_ids(rows, of_class.select("key"), "key").mapInArrow(_send(percent, size, owners), SENT)
    stars = staged(sent.repartitionById(n, F.expr(f"pmod(part, {n})")).mapInArrow(_meet, STAR), "stars")
    members = _members(stars)
    # each document's smallest partner first, which joins most groups
    heads = members.groupBy("part_key").agg(F.min("doc").alias("head"))
    nearest = staged(members.join(heads, "part_key").where("doc <> head").groupBy("doc").agg(F.min("head").alias("head")), "nearest")
    wanted = staged(members.select(F.col("doc").alias("key")).distinct(), "wanted")
    sets = staged(only_ids(rows, wanted, "key").join(wanted, "key", "left_semi").mapInArrow(_sets(size), SETS), "shingles")
    tried = verified(nearest.select(F.col("head").alias("a"), F.col("doc").alias("b")), sets, percent)
    edges = tried.where("linked").select("a", "b")
    comps = components(edges)
    for r in range(ROUNDS):
        # where components still meet: everyone against the document that shares most parts, then against random ones
        open_ = staged(_open(members, comps), "open")
        if not open_.take(1):
            break
        pairs = _star_pairs(open_, r)
        more = verified(pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti"), sets, percent)
        tried = tried.unionByName(more)
        if not more.where("linked").take(1):
            break
        edges = edges.unionByName(more.where("linked").select("a", "b"))
        comps = components(edges)
    # what is left: pairs across components that share a part
    open_ = _open(members, comps)
    members = staged(open_.withColumnRenamed("doc", "key").join(sets.drop("shingles"), "key"), "across")
    meet = (F.col("l.part_key") == F.col("r.part_key")) & (F.col("l.key") < F.col("r.key")) & (F.col("l.comp") != F.col("r.comp"))
    pairs = members.alias("l").join(members.alias("r"), meet & _ruled_in(percent)).select(F.col("l.key").alias("a"), F.col("r.key").alias("b"))
    more = verified(pairs.distinct().join(tried.select("a", "b"), ["a", "b"], "left_anti"), sets, percent).where("linked").select("a", "b")
    if more.take(1):
        comps = components(edges.unionByName(more))
    comp_of = comps.select(F.col("node").alias("rep"), "comp")
    roots = of_class.join(comp_of, "rep", "left").select("key", F.coalesce("comp", "rep").alias("root"))
    # a class of its own is known by its smallest member, which is no copy
    alone = of_class.select(F.col("rep").alias("key")).distinct().join(comps.select(F.col("node").alias("key")), "key", "left_anti").select("key", F.col("key").alias("root"))
    roots = staged(roots.unionByName(comps.select(F.col("node").alias("key"), F.col("comp").alias("root"))).unionByName(alone), "roots")
    first = roots.join(info.select("key", "id"), "key").groupBy("root").agg(F.min(F.struct("id", "key")).alias("first"))
    known = roots.join(first, "root").select("key", "first")
    null = F.lit(NULL_ID)
    joined = info.select("key", "id", "n").join(known, "key", "left")
    component = F.coalesce("first.id", "id")
    return joined.select(F.when(F.col("id") != null, F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"), F.when(component != null, component).alias("component_id"), F.col("key").alias("row"), F.coalesce("first.key", "key").alias("keep_row"))


def near_dedup(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """docs with one document of each component, the one with the smallest doc_id; all columns stay."""
    docs = steady(docs)
    return rows_without(docs, _components(docs, percent, size).where("row <> keep_row").select("row"))
