"""Statistics of a corpus and of what made it, as tables; and the joins that show sources and benchmarks with all that is known of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def length_statistics(rows: DataFrame, by: list[str], length: Column, long: int) -> DataFrame:
    """By group: rows, sum, mean, median and 95th percentile of a length (linear between rows), and the share that is `long` or more."""
    c = length.cast("double")
    return rows.groupBy(*by).agg(F.count(c).alias("n"), F.sum(length.cast("long")).alias("total"), F.avg(c).alias("mean"), F.median(c).alias("median"), F.percentile(c, 0.95).alias("p95"), F.avg((length >= long).cast("double")).alias("long_share"))


def tried_accepted(outcomes: DataFrame, *by: str) -> DataFrame:
    """By group: jobs that were tried, and accepted ones. Rows without a group are left out."""
    rows = outcomes
    for c in by:
        rows = rows.where(F.col(c).isNotNull())
    return rows.groupBy(*by).agg(F.count("*").alias("tried"), F.count_if(F.col("status") == "accepted").alias("accepted"))


def accepted_statistics(outcomes: DataFrame) -> DataFrame:
    """Of the accepted outcomes (state, quality, p_answer, domain, relabeled), one row: rows, mean and median quality, mean
    probability of the answer, mean and median words of a state, domains, relabelled ones."""
    words = F.size(F.filter(F.split(F.coalesce("state", F.lit("")), r"\s+"), lambda w: w != "")).cast("double")
    rows = outcomes.where("status = 'accepted'").withColumn("_words", words)
    q = F.col("quality").cast("double")
    return rows.agg(
        F.count("*").alias("n"), F.avg(q).alias("quality_mean"), F.median(q).alias("quality_median"), F.avg(F.col("p_answer").cast("double")).alias("p_answer_mean"),
        F.avg("_words").alias("words_mean"), F.median("_words").alias("words_median"), F.count_distinct("domain").alias("domains"), F.count_if(F.col("relabeled").cast("boolean")).alias("relabeled"),
    )


def category_statistics(sources: DataFrame, categories: DataFrame) -> DataFrame:
    """sources (source, type, n) under their categories (source, category): by category and type sources and records. A source
    without a category is in none of its own, with a null."""
    return sources.join(categories, "source", "left").groupBy("category", "type").agg(F.count("*").alias("sources"), F.sum("n").alias("records"))


def audit_table(rows: DataFrame) -> DataFrame:
    """By source: rows, mean agreement, mean probability of the given answer, mean chance."""
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.avg(F.col("agree").cast("double")).alias("agree"), F.avg(F.col("p").cast("double")).alias("p"), F.avg(F.col("chance").cast("double")).alias("chance"))


def sources_overview(sources: DataFrame, markers: DataFrame, failed: DataFrame, audit: DataFrame, deleted: DataFrame, enabled: list[str], dropped: list[str] = (), held_out: list[str] = (), disabled: list[str] = ()) -> DataFrame:
    """sources (source, type, origin) with what is known of each: markers (source, n), failed (source, message), audit (source,
    agree, chance), deleted (source, a row a record). state is loaded, failed or pending, or excluded where it is not enabled."""
    gone = deleted.groupBy("source").agg(F.count("*").alias("deleted"))
    rows = sources.join(markers.select("source", "n"), "source", "left").join(failed.select("source", "message"), "source", "left").join(audit.select("source", "agree", "chance"), "source", "left").join(gone, "source", "left")
    state = F.when(~F.col("source").isin(list(enabled)), "excluded").when(F.col("n").isNotNull(), "loaded").when(F.col("message").isNotNull(), "failed").otherwise("pending")
    is_in = lambda names: F.col("source").isin(list(names))
    return rows.select(
        "source", "type", "origin", F.coalesce("n", F.lit(0)).alias("n"), state.alias("state"), F.coalesce("message", F.lit("")).alias("message"), "agree", "chance",
        is_in(dropped).alias("audit_dropped"), is_in(held_out).alias("held_out"), is_in(disabled).alias("disabled"), F.coalesce("deleted", F.lit(0)).alias("deleted"),
    )


def benchmark_overview(done: DataFrame, history: DataFrame, model: str, teacher: DataFrame | None = None, mark: str = "teacher_") -> DataFrame:
    """done (benchmark, acc and others) with the teacher's accuracy and the model before: of history (model, benchmark, acc), other
    models of the same class (teachers begin with `mark`), the greatest name; delta is what was gained on it."""
    same_class = F.col("model").startswith(mark) == F.lit(model.startswith(mark))
    before = history.where((F.col("model") != model) & same_class).groupBy("benchmark").agg(F.max_by(F.struct("model", "acc"), "model").alias("b"))
    before = before.select("benchmark", F.col("b.model").alias("previous"), F.col("b.acc").cast("double").alias("previous_acc"))
    out = done.join(before, "benchmark", "left").withColumn("delta", F.col("acc") - F.col("previous_acc")).drop("previous_acc")
    if teacher is None:
        return out.withColumn("teacher_acc", F.lit(None).cast("double"))
    return out.join(teacher.select("benchmark", F.col("acc").cast("double").alias("teacher_acc")), "benchmark", "left")


def suite_means(done: DataFrame) -> DataFrame:
    """By suite: benchmarks and mean accuracy; and `all`, the mean of the suites."""
    suites = done.groupBy("suite").agg(F.count("*").alias("benchmarks"), F.avg("acc").alias("acc"))
    return suites.unionByName(suites.agg(F.lit("all").alias("suite"), F.sum("benchmarks").alias("benchmarks"), F.avg("acc").alias("acc")).where("benchmarks is not null"))


def weakest_groups(groups: DataFrame, k: int = 4) -> DataFrame:
    """groups (benchmark, name, acc, n): of each benchmark the k with the least accuracy, by rank."""
    from pyspark.sql import Window

    w = Window.partitionBy("benchmark").orderBy("acc", "name")
    return groups.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
