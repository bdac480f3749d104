"""Bounded scans, balanced samples, splits and shuffles; all by hash, so independent of order and partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import hash_order, moved, take
from ..functions.hashing import keyed, u01


def bounded_scan(df: DataFrame, key: str, n: int, seed: int = 1234) -> DataFrame:
    """Exactly n rows (or all) with the smallest hashes; a top-n, so no full sort."""
    return df.withColumn("_h", keyed("scan", str(seed), F.col(key))).orderBy("_h", key).limit(n).drop("_h")


def bounded_usable(df: DataFrame, usable: Column, key: str, n: int, seed: int = 1234) -> DataFrame:
    """A benchmark's fixed sample: n usable rows, the first in hash order. What is not usable takes no place."""
    return bounded_scan(df.where(usable), key, n, seed)


def scan_size(want: int) -> int:
    return max(want * 6, 20_000)


def sample_per_group(df: DataFrame, group: str, key: str, n: int, seed: int = 1234) -> DataFrame:
    """n rows of each group with the smallest hashes. The filter on the rank prunes within each task before the shuffle."""
    w = Window.partitionBy(group).orderBy(keyed("sample", str(seed), F.col(key)), F.col(key))
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).drop("_k")


def bucket_key() -> Column:
    """What a record is balanced by: its right options, lower case; '(none)' without any."""
    right = F.transform("answer", lambda i: F.lower(F.get("options", i)))
    return F.when(F.size("answer") == 0, F.lit("(none)")).otherwise(F.array_join(right, "|"))


def round_robin(df: DataFrame, bucket: Column | str, order: str, want: int) -> DataFrame:
    """Take the k-th row of each bucket in turn, buckets in order of their first row, until want rows are there."""
    df = df.withColumn("_bucket", F.col(bucket) if isinstance(bucket, str) else bucket)
    w = Window.partitionBy("_bucket").orderBy(order)
    ranked = df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= want)
    ranked = ranked.withColumn("_first", F.min(order).over(Window.partitionBy("_bucket")))
    return ranked.orderBy("_k", "_first").limit(want).drop("_bucket", "_k", "_first")


def split_of(id_: Column, source: Column, seed: int = 1234, test: float = 0.03, val: float = 0.03, held_out: tuple[str, ...] = ()) -> Column:
    u = u01("split", id_, str(seed))
    name = F.when(u < test, "test").when(u < test + val, "val").otherwise("train")
    return F.when(source.isin(*held_out), "zeroshot").otherwise(name) if held_out else name


def repeat_synthetic(df: DataFrame, times: int = 2) -> DataFrame:
    """Synthetic training rows come `times` times; `rep` numbers them."""
    n = F.when((F.col("split") == "train") & (F.col("kind") == "synth"), F.lit(times)).otherwise(1)
    return df.withColumn("rep", F.explode(F.sequence(F.lit(1), n)))


def shuffle_options(df: DataFrame) -> DataFrame:
    """Choice and multi options in hash order, answer and target with them."""
    free = F.col("type").isin("choice", "multi")
    order = F.when(free, hash_order(F.col("options"), F.concat(F.lit("opts:"), F.col("id")))).otherwise(F.sequence(F.lit(0), F.size("options") - 1))
    df = df.withColumn("_order", order)
    target = F.when(F.col("target").isNotNull(), take(F.col("target"), F.col("_order")))
    return df.withColumns({"options": take(F.col("options"), F.col("_order")), "answer": moved(F.col("answer"), F.col("_order")), "target": target}).drop("_order")


def permutations(df: DataFrame, n: int = 4, key: str = "id") -> DataFrame:
    """Each row with n orders of its options: permutation 0 keeps them; back maps shown places to places."""
    df = df.withColumn("perm", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    plain = F.sequence(F.lit(0), F.size("options") - 1)
    order = F.when(F.col("perm") == 0, plain).otherwise(hash_order(F.col("options"), F.concat_ws(":", F.lit("perm"), F.col("perm").cast("string"), F.col(key).cast("string"))))
    return df.withColumn("back", order).withColumn("shown", take(F.col("options"), F.col("back")))


def shuffled(df: DataFrame, seed: int = 1234, *keys: str) -> DataFrame:
    """A global order by hash of the keys."""
    return df.orderBy(keyed("order", str(seed), *(F.col(k) for k in keys)), *keys)
