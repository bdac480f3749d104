"""Accuracy and calibration metrics over predictions.

A prediction has type, source, p (array of probabilities), a (place of the answer; null for multi)
and y (array of 0/1 truths, for multi).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import argmax, expected, one_hot, total

BINS = 15
CORE = ("acc", "nll", "brier", "mean_conf")


def bin_of(conf: Column, bins: int = BINS) -> Column:
    """Bins (lo, hi]; the first includes 0."""
    return F.greatest(F.ceil(conf * bins), F.lit(1)).cast("int")


def truth(target: Column) -> Column:
    return F.transform(target, lambda x: (x > 0.5).cast("int"))


def single_rows(df: DataFrame) -> DataFrame:
    """Per-row metrics of single answers."""
    pa = F.get("p", F.col("a"))
    hot = one_hot(F.size("p"), F.array(F.col("a")))
    return df.where("type <> 'multi'").select(
        "*",
        F.array_max("p").alias("conf"),
        (argmax(F.col("p")) == F.col("a")).cast("double").alias("correct"),
        (-F.ln(F.greatest(pa, F.lit(1e-12)))).alias("row_nll"),
        total(F.zip_with("p", hot, lambda x, y: (x - y) * (x - y))).alias("row_brier"),
        F.abs(expected(F.col("p")) - F.col("a")).alias("row_mae"),
        (1.0 / F.size("p")).alias("row_chance"),
    )


def multi_rows(df: DataFrame) -> DataFrame:
    """Per-row metrics of multi answers, with the counts that add up over rows."""
    clipped = lambda x: F.least(F.greatest(x, F.lit(1e-12)), F.lit(1.0))
    k = F.size("p")
    nll = total(F.zip_with("p", "y", lambda x, y: -(F.ln(clipped(x)) * y + F.ln(clipped(1 - x)) * (1 - y)))) / k
    hit = F.zip_with("p", "y", lambda x, y: ((x >= 0.5).cast("int") == y).cast("int"))
    count = lambda f: F.aggregate(F.zip_with("p", "y", f), F.lit(0), lambda acc, v: acc + v.cast("int"))
    mean_y = F.aggregate("y", F.lit(0), lambda acc, v: acc + v) / k
    edge = lambda x: F.least(F.greatest(x, F.lit(1e-12)), F.lit(1.0) - 1e-12)
    return df.where("type = 'multi'").select(
        "*",
        k.alias("k"),
        F.forall(hit, lambda x: x == 1).cast("double").alias("exact"),
        nll.alias("row_nll"),
        F.aggregate(hit, F.lit(0), lambda acc, v: acc + v).alias("hits"),
        total(F.zip_with("p", "y", lambda x, y: (edge(x) - y) * (edge(x) - y))).alias("sum_brier"),
        total(F.transform("p", lambda x: F.greatest(x, 1 - x))).alias("sum_conf"),
        count(lambda x, y: (x >= 0.5) & (y == 1)).alias("tp"),
        count(lambda x, y: (x >= 0.5) & (y == 0)).alias("fp"),
        count(lambda x, y: (x < 0.5) & (y == 1)).alias("fn"),
        F.greatest(mean_y, 1 - mean_y).alias("row_chance"),
    )


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return 2 * tp / F.greatest(F.lit(1.0), 2 * tp + fp + fn)


def confidences(df: DataFrame, *keep: str) -> DataFrame:
    """keep (type and source if nothing is named), conf, correct: one row for each single answer and each option of a multi answer."""
    keep = keep or ("type", "source")
    single = single_rows(df).select(*keep, "conf", "correct")
    options = df.where("type = 'multi'").select(*keep, F.explode(F.arrays_zip("p", "y")).alias("o"))
    on = F.col("o.p") >= 0.5
    multi = options.select(*keep, F.when(on, F.col("o.p")).otherwise(1 - F.col("o.p")).alias("conf"), (on.cast("int") == F.col("o.y")).cast("double").alias("correct"))
    return single.unionByName(multi)


def reliability(conf: DataFrame, by: list[str] | None = None, bins: int = BINS) -> DataFrame:
    """Bins with their mean confidence, accuracy and size."""
    return conf.groupBy(*(by or []), bin_of(F.col("conf"), bins).alias("bin")).agg(F.avg("conf").alias("mean_conf"), F.avg("correct").alias("acc"), F.count("*").alias("n"))


def ece(conf: DataFrame, by: list[str] | None = None, bins: int = BINS) -> DataFrame:
    rel = reliability(conf, by, bins)
    value = (F.sum(F.col("n") * F.abs(F.col("acc") - F.col("mean_conf"))) / F.sum("n")).alias("ece")
    return rel.groupBy(*by).agg(value) if by else rel.agg(value)


def core(df: DataFrame, by: list[str]) -> DataFrame:
    """Single answers by group: n, acc, nll, brier, mean_conf, ece, mae, chance."""
    rows = single_rows(df)
    means = rows.groupBy(*by).agg(F.count("*").alias("n"), F.avg("correct").alias("acc"), F.avg("row_nll").alias("nll"), F.avg("row_brier").alias("brier"), F.avg("conf").alias("mean_conf"), F.avg("row_mae").alias("mae"), F.avg("row_chance").alias("chance"))
    return means.join(ece(rows.select(*by, "conf", "correct"), by), by)


def multi_core(df: DataFrame, by: list[str]) -> DataFrame:
    """Multi answers by group: acc is the exact match, nll is per row, brier and option_acc are per option."""
    rows = multi_rows(df)
    sums = rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg("exact").alias("acc"), F.avg("row_nll").alias("nll"), (F.sum("sum_brier") / F.sum("k")).alias("brier"), (F.sum("sum_conf") / F.sum("k")).alias("mean_conf"),
        (F.sum("hits") / F.sum("k")).alias("option_acc"), f1(F.sum("tp"), F.sum("fp"), F.sum("fn")).alias("f1"), F.avg("row_chance").alias("chance"),
    )
    return sums.join(ece(confidences(df.where("type = 'multi'"), *by), by), by)


def summarize(df: DataFrame) -> DataFrame:
    """scope (all, type, source), name, n, acc, nll, brier, ece, mean_conf. Over all, the single and multi figures are weighted
    by their sizes; a source with single answers leaves its multi rows out."""
    cols = ["n", "acc", "nll", "brier", "ece", "mean_conf"]
    all_ = df.withColumn("_all", F.lit("all"))
    parts = core(all_, ["_all"]).select(*cols).unionByName(multi_core(all_, ["_all"]).select(*cols))
    weighted = [(F.sum(F.col(c) * F.col("n")) / F.greatest(F.lit(1), F.sum("n"))).alias(c) for c in cols[1:]]
    overall = parts.agg(F.sum("n").alias("n"), *weighted).select(F.lit("all").alias("scope"), F.lit("all").alias("name"), *cols)
    types = core(df, ["type"]).select(F.lit("type").alias("scope"), F.col("type").alias("name"), *cols).unionByName(multi_core(df, ["type"]).select(F.lit("type").alias("scope"), F.col("type").alias("name"), *cols))
    one = core(df, ["source"])
    pure = multi_core(df, ["source"]).join(one.select("source"), "source", "left_anti")
    sources = one.select(F.lit("source").alias("scope"), F.col("source").alias("name"), *cols).unionByName(pure.select(F.lit("source").alias("scope"), F.col("source").alias("name"), *cols))
    return overall.unionByName(types).unionByName(sources)


def soft_cross_entropy(z: Column, target: Column) -> Column:
    """-sum target * log softmax(z)."""
    top = F.array_max(z)
    log_sum = F.ln(total(F.transform(z, lambda x: F.exp(x - top)))) + top
    return -total(F.zip_with(z, target, lambda x, t: t * (x - log_sum)))


def option_bce(z: Column, target: Column) -> Column:
    """Mean binary cross-entropy with logits held within 30."""
    held = F.transform(z, lambda x: F.least(F.greatest(x, F.lit(-30.0)), F.lit(30.0)))
    return total(F.zip_with(held, target, lambda x, t: F.greatest(x, F.lit(0.0)) - x * t + F.log1p(F.exp(-F.abs(x))))) / F.size(z)


def benchmark_single(df: DataFrame, by: str = "benchmark") -> DataFrame:
    """acc, macro_f1 over the classes seen in truth or prediction, ece, nll and the share of the commonest answer."""
    rows = single_rows(df).withColumn("pred", argmax(F.col("p")))
    base = rows.groupBy(by).agg(F.count("*").alias("n"), F.avg("correct").alias("acc"), F.avg("row_nll").alias("nll"))
    sides = rows.select(by, F.explode(F.array_distinct(F.array("a", "pred"))).alias("cls"), "a", "pred")
    is_a, is_p = F.col("a") == F.col("cls"), F.col("pred") == F.col("cls")
    n = lambda c: F.sum(c.cast("int"))
    per = sides.groupBy(by, "cls").agg(f1(n(is_a & is_p), n(~is_a & is_p), n(is_a & ~is_p)).alias("f1"))
    macro = per.groupBy(by).agg(F.avg("f1").alias("macro_f1"))
    majority = rows.groupBy(by, "a").count().groupBy(by).agg((F.max("count") / F.sum("count")).alias("majority"))
    return base.join(macro, by).join(majority, by).join(ece(rows.select(by, "conf", "correct"), [by]), by)


def benchmark_binary(df: DataFrame, by: str = "benchmark") -> DataFrame:
    """Precision, recall and F1 of the first option."""
    rows = single_rows(df).withColumn("pred", argmax(F.col("p")))
    n = lambda c: F.sum(c.cast("int"))
    tp, fp, fn = n((F.col("a") == 0) & (F.col("pred") == 0)), n((F.col("a") != 0) & (F.col("pred") == 0)), n((F.col("a") == 0) & (F.col("pred") != 0))
    return rows.groupBy(by).agg((tp / F.greatest(F.lit(1), tp + fp)).alias("precision"), (tp / F.greatest(F.lit(1), tp + fn)).alias("recall"), f1(tp, fp, fn).alias("f1"))


def benchmark_multi(df: DataFrame, threshold: float = 0.5, by: str = "benchmark") -> DataFrame:
    """Exact match, micro F1, macro F1 over labels with a positive, option accuracy, ECE with the predicted side's confidence,
    and the share of the commonest label set."""
    on = lambda x: x >= threshold
    options = df.where("type = 'multi'").select(by, F.posexplode(F.arrays_zip("p", "y")).alias("label", "o"), "id").select(by, "id", "label", on(F.col("o.p")).alias("on"), (F.col("o.y") == 1).alias("is"), F.col("o.p").alias("p"))
    n = lambda c: F.sum(c.cast("int"))
    tp, fp, fn = n(F.col("on") & F.col("is")), n(F.col("on") & ~F.col("is")), n(~F.col("on") & F.col("is"))
    micro = options.groupBy(by).agg(f1(tp, fp, fn).alias("micro_f1"), F.avg((F.col("on") == F.col("is")).cast("double")).alias("option_acc"))
    macro = options.groupBy(by, "label").agg(f1(tp, fp, fn).alias("f1"), n(F.col("is")).alias("pos")).where("pos > 0").groupBy(by).agg(F.avg("f1").alias("macro_f1"))
    exact = df.where("type = 'multi'").groupBy(by).agg(F.count("*").alias("n"), F.avg(F.forall(F.zip_with("p", "y", lambda x, y: on(x) == (y == 1)), lambda v: v).cast("double")).alias("acc"))
    sets = df.where("type = 'multi'").groupBy(by, "y").count().groupBy(by).agg((F.max("count") / F.sum("count")).alias("majority"))
    conf = options.select(by, F.when(F.col("on"), F.col("p")).otherwise(1 - F.col("p")).alias("conf"), (F.col("on") == F.col("is")).cast("double").alias("correct"))
    return exact.join(micro, by).join(macro, by, "left").join(sets, by).join(ece(conf, [by]), by)


def by_group(df: DataFrame, *by: str) -> DataFrame:
    return single_rows(df).groupBy(*by).agg(F.count("*").alias("n"), F.avg("correct").alias("acc"))


def permutation_agreement(perms: DataFrame, key: str = "id") -> DataFrame:
    """perms: key, perm, p over shown options, back, a. By permutation: accuracy and agreement with permutation 0."""
    picked = perms.select(key, "perm", "a", F.get("back", argmax(F.col("p"))).alias("pick"))
    base = picked.where("perm = 0").select(key, F.col("pick").alias("plain"))
    return picked.join(base, key).groupBy("perm").agg(F.avg((F.col("pick") == F.col("a")).cast("double")).alias("acc"), F.avg((F.col("pick") == F.col("plain")).cast("double")).alias("agree"))


def suite_means(results: DataFrame) -> DataFrame:
    """By suite: benchmarks and mean accuracy and ECE."""
    return results.groupBy("suite").agg(F.count("*").alias("benchmarks"), F.avg("acc").alias("acc"), F.avg("ece").alias("ece"))


def latency(times: DataFrame, by: str) -> DataFrame:
    """Median and 90th percentile of seconds, and rows per second."""
    return times.groupBy(by).agg(F.median("seconds").alias("median"), F.percentile("seconds", 0.9).alias("p90"), (F.sum("rows") / F.sum("seconds")).alias("per_second"))
