"""Reports over finished work: audits, acceptance, funnels, early stopping, means and ratios, display rows, length batches.

Aggregates come first everywhere, so what is ranked or sorted whole is one row for each source, family, reason or benchmark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What a display row shows of a record's meta.
META = ("family", "domain", "difficulty", "why")


def audit_of(done: DataFrame, wanted: DataFrame) -> DataFrame:
    """By source: n and agreement over the audited rows (id, source, agree) whose id is still wanted. A null id is never wanted."""
    return done.join(wanted.select("id"), "id", "left_semi").groupBy("source").agg(F.count("*").alias("n"), F.avg(F.col("agree").cast("double")).alias("agree"))


def with_category(stats: DataFrame, categories: DataFrame, key: str) -> DataFrame:
    """stats with the category of its key. A key without one is an error, not a dropped row; categories has each key once."""
    known = categories.select(key, F.col("category").alias("_category"))
    missing = F.raise_error(F.concat(F.lit(f"no category for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return stats.join(known, key, "left").withColumn("category", F.coalesce("_category", missing)).drop("_category")


def family_acceptance(outcomes: DataFrame) -> DataFrame:
    """By type: least, median and greatest share of accepted rows among its families, and the first and last family by (share, name)."""
    families = outcomes.groupBy("type", "family").agg(F.avg(F.coalesce(F.col("accepted").cast("double"), F.lit(0.0))).alias("share"))
    place = F.struct("share", "family")
    return families.groupBy("type").agg(F.min("share").alias("least"), F.median("share").alias("median"), F.max("share").alias("greatest"), F.min(place)["family"].alias("lowest"), F.max(place)["family"].alias("highest"))


def funnel(outcomes: DataFrame) -> DataFrame:
    """Reasons by falling count, ties by name, with the share of all rows; a null reason stands for accepted rows."""
    counts = outcomes.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))
    whole = Window.partitionBy(F.lit(0))
    return counts.select("reason", "n", F.row_number().over(whole.orderBy(F.desc("n"), "reason")).alias("place"), (F.col("n") / F.sum("n").over(whole)).alias("share"))


def source_bars(predictions: DataFrame) -> DataFrame:
    """By source, best first: n, accuracy and chance (one over the number of options)."""
    bars = predictions.groupBy("source").agg(F.count("*").alias("n"), F.avg(F.col("correct").cast("double")).alias("acc"), F.avg(1 / F.col("n_options")).alias("chance"))
    return bars.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("acc"), "source")))


def early_stopping(evals: DataFrame, patience: int = 8) -> DataFrame:
    """By run: the step at which `patience` evaluations in a row were no better than the best before them (null: never), and
    the best nll and its first step until then. evals is (run, step, nll), a step once in a run; a null nll is no better.
    A window sorts one run's evaluations."""
    order = Window.partitionBy("run").orderBy("step")
    before = F.min("nll").over(order.rowsBetween(Window.unboundedPreceding, -1))
    better = F.col("nll").isNotNull() & (before.isNull() | (F.col("nll") < before))
    seen = evals.withColumn("_better", F.coalesce(better, F.lit(False)))
    since = seen.withColumn("_best_no", F.sum(F.col("_better").cast("int")).over(order))
    bad = F.row_number().over(Window.partitionBy("run", "_best_no").orderBy("step")) - F.when(F.col("_best_no") > 0, 1).otherwise(0)
    stop = F.min(F.when(F.col("_bad") >= patience, F.col("step"))).over(Window.partitionBy("run"))
    until = since.withColumn("_bad", bad).withColumn("stopped", stop).where("stopped is null or step <= stopped")
    return until.groupBy("run").agg(F.first("stopped").alias("stopped"), F.min("nll").alias("best"), F.max(F.when(F.col("_better"), F.col("step"))).alias("best_step"))


def benchmark_ratios(results: DataFrame, measures: Sequence[str] = ("acc",)) -> DataFrame:
    """One row for each benchmark with its measures and teacher_ms / ms as speedup, and a row 'Mean' of the measures over all."""
    rows = results.select("benchmark", *measures, F.try_divide("teacher_ms", "ms").alias("speedup"))
    mean = results.agg(*(F.avg(m).alias(m) for m in measures)).select(F.lit("Mean").alias("benchmark"), *measures, F.lit(None).cast("double").alias("speedup"))
    return rows.unionByName(mean)


def display_rows(outcomes: DataFrame) -> DataFrame:
    """Synthesis outcomes (jid, status, reason, type, p_answer, quality, record) as rows to look at. Where there is no record,
    the id comes from jid, texts are empty and the answer is null."""
    r = F.col("record")
    have = {f.name for f in outcomes.schema["record"].dataType["meta"].dataType.fields}
    meta = F.struct(*((r["meta"][k] if k in have else F.lit(None)).cast("string").alias(k) for k in META))
    return outcomes.select(
        F.coalesce(F.nullif(r["id"], F.lit("")), F.concat(F.lit("syn:"), F.col("jid").cast("string"))).alias("id"),
        F.coalesce(r["source"], F.lit("synth")).alias("source"),
        F.lit("synth").alias("kind"),
        "status",
        "reason",
        F.coalesce(F.nullif(r["type"], F.lit("")), F.col("type")).alias("type"),
        F.coalesce(r["state"], F.lit("")).alias("state"),
        F.coalesce(r["question"], F.lit("")).alias("question"),
        F.coalesce(r["options"], F.array().cast("array<string>")).alias("options"),
        r["answer"].alias("answer"),
        F.col("p_answer").alias("p"),
        "quality",
        meta.alias("meta"),
    )


def cost(state: str = "state", question: str = "question", options: str = "options") -> Column:
    """Characters of a record; what is null has none."""
    size = lambda c: F.coalesce(F.length(c), F.lit(0))
    return (size(F.col(state)) + size(F.col(question)) + F.aggregate(F.coalesce(options, F.array().cast("array<string>")), F.lit(0), lambda a, o: a + size(o))).cast("long")


def length_batches(records: DataFrame, ordinal: str, size: int = 128) -> DataFrame:
    """records dealt out by ranges of cost and sorted by it, with batch: `size` neighbours of one partition. ordinal is a
    column that says where a row stood; in_order() restores that."""
    dealt = records.withColumn("cost", cost()).repartitionByRange("cost", ordinal).sortWithinPartitions("cost", ordinal)
    # the ids of a partition's rows count up from partition << 33, in the order of the rows
    number = dealt.withColumn("_row", F.monotonically_increasing_id())
    low = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    return number.withColumn("batch", F.concat_ws(":", F.shiftright("_row", 33), F.floor(low / size))).drop("_row")


def in_order(rows: DataFrame, ordinal: str) -> DataFrame:
    return rows.orderBy(ordinal)
