"""Edits of a corpus and the history of benchmark results: small tables, replaced as wholes."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HISTORY = ("model", "benchmark", "suite", "type", "n", "acc", "macro_f1", "ece", "nll", "majority", "ms", "teacher_acc", "teacher_ms", "when")

#: Lengths of a moving rate's time that a window partition spans.
FRAME = 60


def delete(deleted: DataFrame, rows: DataFrame) -> DataFrame:
    """deleted (id, source) and the rows; an id is deleted once."""
    new = rows.select("id", "source").join(deleted.select("id"), "id", "left_anti").dropDuplicates(["id"])
    return deleted.select("id", "source").unionByName(new)


def restore(deleted: DataFrame, ids: list[str] | None = None, source: str = "") -> DataFrame:
    """deleted without these ids and without those of a source."""
    gone = F.lit(False)
    if ids:
        gone = gone | F.col("id").isin(ids)
    if source:
        gone = gone | (F.col("source") == source)
    return deleted.where(~gone)


def set_disabled(disabled: list[str], source: str, off: bool) -> list[str]:
    return sorted({*disabled, source} if off else {*disabled} - {source})


def digest(deleted_ids: list[str], disabled: list[str]) -> str:
    """What changes when the edits do; empty without any."""
    return hashlib.sha256("\n".join([*sorted(deleted_ids), "--", *sorted(disabled)]).encode()).hexdigest()[:12] if deleted_ids or disabled else ""


def upsert(history: DataFrame, fresh: DataFrame, keys: tuple[str, ...] = ("model", "benchmark")) -> DataFrame:
    """history with the rows of fresh in the place of those with equal keys."""
    return history.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh)


def previous_delta(history: DataFrame) -> DataFrame:
    """Each result with that of the model before it by name, on the same benchmark."""
    w = Window.partitionBy("benchmark").orderBy("model")
    return history.withColumn("previous", F.lag("model").over(w)).withColumn("delta", F.col("acc") - F.lag("acc").over(w))


def overview(records: DataFrame, deleted: DataFrame) -> DataFrame:
    """By source: records and how many of them are deleted."""
    gone = deleted.groupBy("source").agg(F.count("*").alias("deleted"))
    return records.groupBy("source").agg(F.count("*").alias("n")).join(gone, "source", "left").select("source", "n", F.coalesce("deleted", F.lit(0)).alias("deleted"))


def contaminated_benchmarks(benchmarks: DataFrame, sources: DataFrame) -> DataFrame:
    """benchmarks (name, dataset, split) against the sources (dataset, split) that were trained on."""
    both = benchmarks.join(sources.select("dataset", F.col("split").alias("s_split")), "dataset", "left")
    any_, same = F.bool_or(F.col("s_split").isNotNull()), F.bool_or(F.coalesce(F.col("s_split") == F.col("split"), F.lit(False)))
    return both.groupBy("name").agg(F.when(same, "YES - same split").when(any_, "other split only").otherwise("no").alias("in_training"))


def ema(rows: DataFrame, by: str, order: str, value: str, a: float = 0.97) -> DataFrame:
    """Exponential moving average by group: a fold over each group's ordered values."""
    folded = rows.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(order, value))).alias("s"))
    step = F.aggregate("s", F.lit(None).cast("double"), lambda acc, x: F.when(acc.isNull(), x[value]).otherwise(a * acc + (1 - a) * x[value]))
    return folded.select(by, F.size("s").cast("long").alias("n"), step.alias("ema"))


def moving_rate(rows: DataFrame, by: str, ts: str, seconds: int = 120) -> DataFrame:
    """Rows of the last seconds at each row, per second.

    Rows are counted by second first, so a frame has a row for each second at most; and frames are cut at buckets of FRAME times
    `seconds`: a second counts in its own bucket and, where the next one reaches back to it, there too, but is no row of it. So a type that
    most rows have is spread over its buckets, and no task holds all of it."""
    second, wide = F.unix_timestamp(F.col(ts).cast("timestamp")), FRAME * seconds
    at = rows.withColumn("_second", second)
    counted = at.groupBy(by, "_second").agg(F.count(F.lit(1)).alias("_n"))
    own = F.floor(F.col("_second") / F.lit(wide)).cast("long")
    reach = F.floor((F.col("_second") + F.lit(seconds)) / F.lit(wide)).cast("long")
    cut = counted.withColumn("_own", own).withColumn("_bucket", F.explode(F.when(F.col("_second").isNull(), F.array(F.lit(None).cast("long"))).otherwise(F.sequence(own, reach))))
    w = Window.partitionBy(by, "_bucket").orderBy("_second").rangeBetween(-seconds, 0)
    rates = cut.withColumn("rate", F.sum("_n").over(w) / F.lit(float(seconds))).where(F.col("_own").eqNullSafe(F.col("_bucket"))).select(F.col(by).alias("_by"), F.col("_second").alias("_at"), "rate")
    same = F.col(by).eqNullSafe(F.col("_by")) & F.col("_second").eqNullSafe(F.col("_at"))
    return at.join(rates, same).drop("_second", "_by", "_at")
