"""Exact first-wins dedup and the near-duplicate filter."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import h60, sha256
from ..functions.text import norm_text

MOST_BITS = 3
#: Of three blocks of a half's 32 bits, each choice of two: in one of the halves two blocks at least are equal where three bits differ.
TABLES = (0xFFFFFC00, 0xFFE003FF, 0x001FFFFF)
#: Members of a table's key that are compared with each other by one task; keys with more are split by salt.
HOT = 2000
#: Open pairs of the near-duplicate filter that the driver settles at most.
FEW = 100_000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that spark.checkpoint.dir names; in local mode, where that is unset, a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "decisionframe-stages")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """df written to a shared folder and read back."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """df's rows dealt out to tasks by the hash of key. A file of one row group is read by one task however it is cut, and what
    follows on a row without a shuffle would be done by that task alone."""
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return df.repartition(n, key)


def record_key(normed: Column | None = None) -> Column:
    """state, question and options in their order, normalised; the answer is no part of it. Of 256 bits, so that no two of any
    number of different records share one. normed is the normalised options, where they are there already."""
    options = F.array_join(F.transform("options", norm_text) if normed is None else normed, "|")
    return sha256(F.concat_ws("|", norm_text(F.col("state")), norm_text(F.col("question")), options))


def first_wins(df: DataFrame, key: Column, *order: str, but: tuple[str, ...] = ()) -> DataFrame:
    """One row for each key, the first by order, without the columns in `but`. An aggregate, so each task sends one row for a key
    at most and a hot key costs no more than others; a window would gather all its rows."""
    row = F.struct(*(c for c in df.columns if c not in but))
    best = df.groupBy(key.alias("_key")).agg(F.min_by(row, F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def grams(text: str, n: int = 3) -> list[str]:
    """Word n-grams of a normalised text; all of its words if there are fewer."""
    words = text.split()
    return [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]


def simhash(text: str) -> tuple[int, int]:
    """64-bit simhash of a normalised text as two 32-bit halves: a bit is set if more grams have it than not, by the first
    eight bytes of their md5."""
    digests = b"".join(hashlib.md5(g.encode()).digest()[:8] for g in grams(text))
    votes = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
    bits = np.packbits(votes.sum(axis=0) * 2 > len(votes))
    return int.from_bytes(bits[:4].tobytes(), "big"), int.from_bytes(bits[4:].tobytes(), "big")


def _simhashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        halves = [simhash(t) for t in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array([h for h, _ in halves], pa.int64()), pa.array([x for _, x in halves], pa.int64()), batch.column(2)], names=["key", "hi", "lo", "ex"])


def signatures(df: DataFrame, text: Column, key: str) -> DataFrame:
    """key, the simhash halves hi and lo, and ex, the hash of the normalised text. The texts are normalised in the JVM; hashing
    every gram once and voting by whole arrays is what built-in functions can't do without hashing a gram for each bit."""
    rows = spread(df.select(F.col(key).cast("string").alias("key"), text.alias("text")), "key")
    rows = rows.select("key", norm_text(F.col("text")).alias("text"))
    rows = rows.select("key", "text", h60(F.col("text")).alias("ex"))
    out = rows.mapInArrow(_simhashes, "key string, hi long, lo long, ex long")
    return out.select(F.col("key").cast(df.schema[key].dataType).alias(key), "hi", "lo", "ex")


def distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(f"{a}.hi").bitwiseXOR(F.col(f"{b}.hi"))) + F.bit_count(F.col(f"{a}.lo").bitwiseXOR(F.col(f"{b}.lo")))


def tabled(sig: DataFrame) -> DataFrame:
    """Each signature once for each table, with its key there: `table` and `block`. Signatures that differ in three bits at
    most share the key of a table, and keys have 21 or 22 bits, so few others do."""
    keys = F.array(*(F.col(c).bitwiseAND(F.lit(m)) for c in ("hi", "lo") for m in TABLES))
    return sig.select("*", F.posexplode(keys).alias("table", "block"))


def near_pairs(sig: DataFrame, key: str, most_bits: int = MOST_BITS, hot: int = HOT) -> DataFrame:
    """Pairs a < b with signatures at most most_bits (three, or fewer) apart. Equal signatures are paired with their smallest
    key only, so copies never pair with each other. Keys of one member meet nothing and are left out before the join; those with
    more than `hot` are split: a row goes to one salt, those that it is compared with to all of them."""
    if most_bits > MOST_BITS:
        raise ValueError(f"tables are made for {MOST_BITS} bits")
    reps = shared_table(sig.groupBy("hi", "lo").agg(F.min(key).alias(key)), "signatures")
    rows = tabled(reps)
    salts = rows.groupBy("table", "block").agg(F.ceil(F.count("*") / F.lit(hot)).cast("int").alias("salts"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    met = shared_table(rows.join(salts, ["table", "block"]), "tabled")
    x = met.withColumn("salt", F.pmod(F.xxhash64(key), F.col("salts")).cast("int")).alias("x")
    y = met.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).alias("y")
    equal = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("table", "block", "salt")]
    near = x.join(y, equal[0] & equal[1] & equal[2] & (F.col(f"x.{key}") < F.col(f"y.{key}")) & (distance("x", "y") <= most_bits))
    near = near.select(F.col(f"x.{key}").alias("a"), F.col(f"y.{key}").alias("b"), distance("x", "y").alias("bits")).distinct()
    same = sig.join(reps.withColumnRenamed(key, "_rep"), ["hi", "lo"]).where(F.col(key) > F.col("_rep")).select(F.col("_rep").alias("a"), F.col(key).alias("b"), F.lit(0).alias("bits"))
    return near.unionByName(same)


def _fallen(pairs: list) -> list[tuple]:
    """Of pairs a < b, all keys that a filter in key order drops."""
    gone = set()
    for a, b in sorted(pairs, key=lambda p: p[1]):
        if a not in gone:
            gone.add(b)
    return [(k,) for k in gone]


def fallen(pairs: DataFrame, key: str, few: int = FEW) -> DataFrame:
    """Of pairs a < b (a table), the keys that a filter in key order drops: those with an earlier neighbour that it keeps.

    Each round drops those with an earlier neighbour that has no undecided one itself. A round settles the smallest undecided key
    at least, and two links of a chain in key order; the rounds go on until none is undecided, or no more than `few` pairs are
    open, which the driver settles in key order at once."""
    undecided = shared_table(pairs.select(F.col("b").alias(key)).distinct(), "undecided")
    open_pairs, spark, kind = pairs, pairs.sparkSession, undecided.schema
    folder, written = shared_folder(spark, "falls"), []
    while undecided.take(1):
        last = open_pairs.limit(few + 1).count() <= few
        if last:
            falls = spark.createDataFrame(_fallen(open_pairs.select("a", "b").collect()), kind)
        else:
            free = open_pairs.join(undecided.select(F.col(key).alias("a")), "a", "left_anti")
            falls = free.select(F.col("b").alias(key)).distinct().join(undecided, key, "left_semi")
        falls.write.parquet(f"{folder}/{len(written)}")
        written.append(f"{folder}/{len(written)}")
        if last:
            break
        falls = spark.read.schema(kind).parquet(written[-1])
        open_pairs = shared_table(open_pairs.join(falls.select(F.col(key).alias("a")), "a", "left_anti").join(falls.select(F.col(key).alias("b")), "b", "left_anti"), "open")
        left = undecided.join(falls, key, "left_anti")
        blocked = open_pairs.join(left.select(F.col(key).alias("a")), "a", "left_semi").select(F.col("b").alias(key)).distinct()
        undecided = shared_table(left.join(blocked, key, "left_semi"), "undecided")
    return spark.read.schema(kind).parquet(*written) if written else undecided


def near_kept(sig: DataFrame, key: str, most_bits: int = MOST_BITS, few: int = FEW) -> DataFrame:
    """The keys that a filter keeps that takes rows in key order and compares each with those kept so far: a row falls if an
    earlier kept row has the same normalised text or a signature at most most_bits away. Rows with equal signatures or texts stand or
    fall with the first of them, so pairs are between first ones only."""
    # texts whose first row fell may be kept later by none: equal text means equal signature, so it falls too
    by_text = sig.groupBy("ex").agg(F.min(F.struct(key, "hi", "lo")).alias("m")).select(f"m.{key}", "m.hi", "m.lo")
    reps = shared_table(by_text.groupBy("hi", "lo").agg(F.min(key).alias(key)), "representatives")
    pairs = shared_table(near_pairs(reps, key, most_bits).select("a", "b"), "pairs")
    return reps.select(key).join(fallen(pairs, key, few), key, "left_anti")
