"""Selective risk: what error remains when only confident answers count."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .dedup import shared_table
from .metrics import single_rows

THRESHOLDS = (0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.97)


def answers(df: DataFrame) -> DataFrame:
    """id, conf, correct by row: for multi the least sure option and whether all are right."""
    single = single_rows(df).select("id", "conf", "correct")
    sure = F.transform("p", lambda x: F.greatest(x, 1 - x))
    right = F.forall(F.zip_with("p", "y", lambda x, y: (x >= 0.5).cast("int") == y), lambda v: v)
    return single.unionByName(df.where("type = 'multi'").select("id", F.array_min(sure).alias("conf"), right.cast("double").alias("correct")))


def selective(rows: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """threshold, coverage, error (null if nothing is covered)."""
    sums = rows.agg(F.count("*").alias("n"), *(x for i, t in enumerate(thresholds) for x in (F.count_if(F.col("conf") >= t).alias(f"k{i}"), F.sum(F.when(F.col("conf") >= t, 1 - F.col("correct")).otherwise(0.0)).alias(f"w{i}"))))
    each = F.explode(F.array(*(F.struct(F.lit(t).alias("threshold"), (F.col(f"k{i}") / F.col("n")).alias("coverage"), F.when(F.col(f"k{i}") > 0, F.col(f"w{i}") / F.col(f"k{i}")).alias("error")) for i, t in enumerate(thresholds))))
    return sums.select(each.alias("x")).select("x.*")


def risk_curve(rows: DataFrame, order: str = "id", step: int = 5, parts: int | None = None) -> DataFrame:
    """coverage (step..100 per cent), error among the round-half-even(n * c / 100) most confident, at least one; ties by order.

    Rows are range-partitioned by confidence; each partition's count and wrong sum, which are few, give the offsets, so no
    window runs over the whole table in one task."""
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select("conf", (1 - F.col("correct")).alias("wrong"), F.col(order).alias("o"))
    dealt = shared_table(rows.repartitionByRange(parts, F.desc("conf"), F.asc("o")).withColumn("part", F.spark_partition_id()), "dealt")
    sums = dealt.groupBy("part").agg(F.count("*").alias("k"), F.sum("wrong").alias("w"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("k0"), F.coalesce(F.sum("w").over(before), F.lit(0.0)).alias("w0"))
    n = sums.agg(F.sum("k").alias("n"))
    w = Window.partitionBy("part").orderBy(F.desc("conf"), "o")
    ranked = dealt.withColumns({"r": F.row_number().over(w), "c": F.sum("wrong").over(w.rowsBetween(Window.unboundedPreceding, 0))})
    ranked = ranked.join(F.broadcast(offsets), "part").select((F.col("r") + F.col("k0")).alias("k"), (F.col("c") + F.col("w0")).alias("wrong"))
    wanted = n.select(F.explode(F.sequence(F.lit(step), F.lit(100), F.lit(step))).alias("coverage"), "n").select("coverage", F.greatest(F.lit(1), F.bround(F.col("n") * F.col("coverage") / 100, 0).cast("long")).alias("k"))
    return wanted.join(ranked, "k").select("coverage", (F.col("wrong") / F.col("k")).alias("error"))
