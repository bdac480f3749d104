"""Shared pieces: staged tables, Arrow text buffers and vectorised fingerprints."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null doc_id inside joins and sort orders.
NULL_ID = -(2**63)
#: White space of the word contracts: [\x20\x09-\x0D].
SPACES = b" \t\n\x0b\x0c\r"
U64 = np.uint64
#: Rows of an Arrow batch at most; bits of a bitmap of ids at most, as a power of two.
BATCH, LARGEST = 2000, 27


def stage_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables: spark.checkpoint.dir, or in local mode a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "decisionframe-stages")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{stage_dir(spark)}/decisionframe/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_of(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def key_of(name: str = "doc_id") -> Column:
    """doc_id as a long that is never null."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


#: Nodes of a plan whose rows can be told by their files and places there.
STEADY = {"Project", "Filter", "SubqueryAlias", "LogicalRelation"}


def steady(docs: DataFrame) -> DataFrame:
    """docs as rows of Parquet files, which have a place there for good; what is no plain read of such files is staged."""

    def plain(plan) -> bool:
        below = plan.children()
        return plan.getClass().getSimpleName() in STEADY and plan.deterministic() and all(plain(below.apply(i)) for i in range(below.size()))

    if plain(docs._jdf.queryExecution().analyzed()):
        try:
            docs.select(docs.metadataColumn("_metadata")["row_index"])
            return docs
        except AnalysisException:
            pass  # files that don't number their rows
    return staged(docs, "rows")


def _short(path: str) -> str:
    return re.sub("^([^:]*:)/+", r"\1/", path)


def file_slots(paths: list[str]) -> tuple[int, int]:
    """(seed, bits): by the top bits of the hash of path and seed all these files differ."""
    bits = max(16, 2 * len(paths).bit_length())
    for seed in range(10_000):
        if len({xxhash.xxh64_intdigest(f"{_short(p)}#{seed}", 42) >> (64 - bits) for p in paths}) == len(paths):
            return seed, bits
    raise ValueError(f"no seed tells {len(paths)} files apart")


def row_number(docs: DataFrame) -> Column:
    """Tells the rows of a steady frame apart, whatever their ids: the slot of the row's file and its place there.

    It depends on nothing but the files, so it is the same in every scan, however Spark cuts the files and whatever executors
    come and go. It rises along a file. A file with more rows than the bits left can count (2**47 with few files, 2**21 with two
    million) is an error, not a mix-up."""
    seed, bits = file_slots(docs.inputFiles())
    place, path = docs.metadataColumn("_metadata")["row_index"], docs.metadataColumn("_metadata")["file_path"]
    slot = F.shiftrightunsigned(F.xxhash64(F.concat(F.regexp_replace(path, "^([^:]*:)/+", "$1/"), F.lit(f"#{seed}"))), 64 - bits)
    room = 63 - bits
    place = F.when(place < F.lit(1 << room), place).otherwise(F.raise_error(F.lit("a file has too many rows to number")).cast("long"))
    return F.shiftleft(slot, room).bitwiseOR(place)


def _in_bitmap(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """docs with _hit: whether the key may be in ids (distinct). A bitmap of hashed keys tells; it has about 16 bits for each of
    ids, and LARGEST at most, so no more than 16 MB are broadcast whatever their number."""
    bits = min(LARGEST, max(16, (16 * ids.count()).bit_length()))
    at = lambda c: F.shiftrightunsigned(F.xxhash64(c), 64 - bits)
    bitmap = ids.select(at(F.col(key)).alias("h")).groupBy(F.bitmap_bucket_number("h").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("_bits"))
    bitmap = staged(bitmap, "bitmap")
    wide = docs.withColumn("_h", at(F.col(key))).withColumn("_bucket", F.bitmap_bucket_number("_h")).join(F.broadcast(bitmap), "_bucket", "left")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(bitmap_bit_position(_h) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.expr("shiftleft(1, cast(bitmap_bit_position(_h) % 8 as int))"))
    return wide.select(*docs.columns, F.coalesce(bit != 0, F.lit(False)).alias("_hit"))


def only_ids(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of docs whose key may be in ids. False positives stay in; an exact join must follow."""
    return _in_bitmap(docs, ids, key).where("_hit").drop("_hit")


def without_ids(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of docs whose key is not in ids. Only those that the bitmap can't tell are shuffled."""
    known = _in_bitmap(docs, ids, key)
    return known.where("not _hit").drop("_hit").unionByName(known.where("_hit").drop("_hit").join(ids.select(key), key, "left_anti"))


def rows_without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs, a steady frame, without the rows whose row_number is in gone (one column, distinct). The rows travel as one
    struct, so no column of docs can clash; texts are shuffled only where the bitmap can't tell."""
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), row_number(docs).alias("_key"))
    return without_ids(packed, staged(gone.toDF("_key"), "gone"), "_key").select("_row.*")


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows as one array, and the rows' offsets in it. Nulls are empty."""
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8)[off[0] : off[-1]] if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def id_array(col: pa.Array) -> np.ndarray:
    return col.cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)


def trim() -> None:
    """Gives the allocator's free memory back, as workers live on beside an executor's heap."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def slices(batches: Iterator[pa.RecordBatch], most: int = 1 << 19, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut by rows to about most bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_buffer(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end
    trim()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Rolling:
    """Polynomial fingerprints modulo 2**64 of any range of a sequence, from one prefix sum."""

    def __init__(self, seed: int) -> None:
        self.base = int(mix(np.array([seed * 2 + 1], U64))[0]) | 5
        self.inverse = pow(self.base, -1, 2**64)
        self.table = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))
        self.up = self.down = np.ones(1, U64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            self.up, self.down = (np.multiply.accumulate(np.concatenate([np.ones(1, U64), np.full(n - 1, b, U64)])) for b in (self.base, self.inverse))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums; values are 64-bit symbols."""
        self.grow(len(values) + 1)
        out = np.zeros(len(values) + 1, U64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Fingerprints of [start, end), not yet mixed."""
        return (sums[end] - sums[start]) * self.down[start]


def fold_table(lower: bool) -> bytes:
    return bytes(b + 32 if lower and 65 <= b <= 90 else b for b in range(256))


def word_bounds(data: np.ndarray, off: np.ndarray, is_space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in the buffer, and for each row the index of its first word (one more entry at the end)."""
    word = ~is_space[data]
    if not len(word):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    before = np.concatenate([[False], word[:-1]])
    first = off[:-1][off[:-1] < off[1:]]
    before[first] = False
    after = np.concatenate([word[1:], [False]])
    after[off[1:][off[:-1] < off[1:]] - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
#: Symbols per step of the byte fingerprints; bounds the memory of temporaries.
STEP = 1 << 16


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rolling: Rolling, lower: bool = False) -> np.ndarray:
    """A 64-bit fingerprint of each word."""
    table = rolling.table[np.frombuffer(fold_table(lower), np.uint8)]
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + STEP, "right")))
        low, high = int(starts[at]), int(ends[stop - 1])
        sums = rolling.sums(table[data[low:high]])
        out[at:stop] = rolling.ranges(sums, starts[at:stop] - low, ends[at:stop] - low) + (ends[at:stop] - starts[at:stop]).astype(U64)
        at = stop
    return mix(out)


def int_column(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(values, type=kind)


def id_column(values: np.ndarray) -> pa.Array:
    """Longs, with the stand-in for null turned back."""
    return pa.array(values, type=pa.int64(), mask=values == NULL_ID)


def workers_import(spark: SparkSession) -> None:
    """Python workers find this package where the driver has it, unless PYTHONPATH already names it."""
    top, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if top not in (path := env.get("PYTHONPATH", "")).split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (top, path) if x)


def prepare(spark: SparkSession) -> None:
    """Workers find the package, get Arrow batches of at most BATCH rows and give freed Arrow memory back at once, which keeps
    two workers beside an executor's heap small whatever the length of the texts."""
    workers_import(spark)
    spark.sparkContext.environment["ARROW_DEFAULT_MEMORY_POOL"] = "system"
    # large arrays are mapped by themselves, so freeing one gives its memory back; those of a step are smaller
    spark.sparkContext.environment["MALLOC_MMAP_THRESHOLD_"] = str(2 << 20)
    spark.sparkContext.environment["MALLOC_ARENA_MAX"] = "2"
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
