"""Train-time augmentation from lookups of descriptions, level names and criteria."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import keyed, u01
from ..functions.text import clean_text, with_criteria
from ..schema import MAX_OPTION

DESCRIPTIONS, TO_MULTI, LEVELS, CRITERIA, NO_ANSWER = 0.4, 0.05, 0.5, 0.3, 0.3
SUFFIX = " Select every option that applies (possibly none)."


def draw(what: str) -> Column:
    return u01("aug", what, F.col("id"))


def scale_key() -> Column:
    return F.concat_ws("|", "source", "question", F.array_join("options", "|"))


def augment(records: DataFrame, labels: DataFrame, levels: DataFrame, criteria: DataFrame, most: int = MAX_OPTION) -> DataFrame:
    """labels: source, names map(option, description); levels: key, names array; criteria: question, yes, no.
    The lookups are one row for a source, scale or question; Spark broadcasts them while they are small."""
    rows = records.withColumn("_scale", scale_key())
    rows = rows.join(labels.select("source", F.col("names").alias("_names")), "source", "left")
    rows = rows.join(levels.select(F.col("key").alias("id"), F.col("names").alias("_own")), "id", "left")
    rows = rows.join(levels.select(F.col("key").alias("_scale"), F.col("names").alias("_shared")), "_scale", "left")
    rows = rows.join(criteria.select("question", F.col("yes").alias("_yes"), F.col("no").alias("_no")), "question", "left")
    rows = to_multi(rows.withColumn("_known", F.col("_names").isNotNull() & F.forall("options", lambda o: F.map_contains_key("_names", o))))
    described = F.transform("options", lambda o: clean_text(F.concat(o, F.lit(": "), F.element_at("_names", o)), most))
    level = F.coalesce("_own", "_shared")
    is_label = F.col("type").isin("choice", "multi")
    options = (
        F.when(is_label & F.col("_known") & (draw("desc") < DESCRIPTIONS), described)
        .when((F.col("type") == "score") & (F.size(level) == F.size("options")) & (draw("levels") < LEVELS), level)
        .otherwise(F.col("options"))
    )
    has = F.coalesce(F.col("_yes"), F.col("_no")).isNotNull()
    question = F.when((F.col("type") == "binary") & has & (draw("criteria") < CRITERIA), with_criteria(F.col("question"), F.col("_yes"), F.col("_no"))).otherwise(F.col("question"))
    return rows.withColumns({"options": options, "question": question}).select(*records.columns)


def to_multi(rows: DataFrame, rate: float = TO_MULTI) -> DataFrame:
    """Some choices with three options or more become select-all questions; in some of these the right option gives way to
    another label (or goes, if there is none) and no answer is left. Needs _known and _names."""
    go = F.col("_known") & (F.col("type") == "choice") & (F.col("kind") == "real") & (F.size("options") >= 3) & (draw("multi") < rate)
    rows = rows.withColumn("_go", F.coalesce(go, F.lit(False))).withColumn("_none", F.col("_go") & (u01("tomulti", F.col("id")) < NO_ANSWER))
    pool = F.array_sort(F.array_except(F.map_keys("_names"), F.col("options")))
    other = F.get(pool, (keyed("other", F.col("id")) % F.greatest(F.size(pool), F.lit(1))).cast("int"))
    right = F.get("answer", F.lit(0))
    swapped = F.when(F.size(pool) > 0, F.transform("options", lambda o, i: F.when(i == right, other).otherwise(o))).otherwise(F.filter("options", lambda o, i: i != right))
    return rows.withColumns(
        {
            "options": F.when(F.col("_none"), swapped).otherwise(F.col("options")),
            "answer": F.when(F.col("_none"), F.array().cast("array<int>")).otherwise(F.col("answer")),
            "question": F.when(F.col("_go"), F.concat(F.regexp_replace("question", r"(?U:\s)+$", ""), F.lit(SUFFIX))).otherwise(F.col("question")),
            "type": F.when(F.col("_go"), F.lit("multi")).otherwise(F.col("type")),
            "target": F.when(F.col("_go"), F.lit(None)).otherwise(F.col("target")),
        }
    )


def describe_plan(records: DataFrame, chunk: int = 25) -> DataFrame:
    """What to ask descriptions for: chunks of a source's labels (3 to 150 of them, 50 rows or more), scales without digits,
    and questions that at least 20 yes/no records ask. kind, key, items."""
    real = records.where(F.col("kind") == "real")
    labels = real.where(F.col("type").isin("choice", "multi")).groupBy("source").agg(F.count("*").alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("options")))).alias("items"))
    labels = labels.where((F.col("n") >= 50) & F.size("items").between(3, 150))
    starts = F.sequence(F.lit(1), F.size("items"), F.lit(chunk))
    labels = labels.select(F.lit("labels").alias("kind"), F.col("source").alias("key"), F.explode(F.transform(starts, lambda i: F.slice("items", i, F.lit(chunk)))).alias("items"))
    scales = records.where(F.col("type") == "score").select(F.lit("levels").alias("kind"), scale_key().alias("key"), F.col("options").alias("items")).distinct()
    asked = real.where(F.col("type") == "binary").groupBy("question").count().where("count >= 20").select(F.lit("criteria").alias("kind"), F.col("question").alias("key"), F.array().cast("array<string>").alias("items"))
    return labels.unionByName(scales).unionByName(asked)


def fold_labels(rows: DataFrame) -> DataFrame:
    """Answers (source, ord, names map) to one map for each source; later answers win."""
    entries = rows.select("source", "ord", F.explode("names").alias("k", "v"))
    last = entries.groupBy("source", "k").agg(F.max_by("v", "ord").alias("v"))
    return last.groupBy("source").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("names"))


def fold_levels(rows: DataFrame) -> DataFrame:
    """Answers (key, ord, names array) to the names of each scale; the last answer stands."""
    return rows.groupBy("key").agg(F.max_by("names", "ord").alias("names"))


def fold_criteria(rows: DataFrame) -> DataFrame:
    """Answers (question, ord, yes, no) to what yes and no mean for each question; the last answer stands."""
    return rows.groupBy("question").agg(F.max_by(F.struct("yes", "no"), "ord").alias("c")).select("question", "c.yes", "c.no")


def fold_described(rows: DataFrame) -> Lookups:
    """Answers to a describe plan (kind, key, ord, names map, levels array, yes, no) to the three lookups of a build."""
    part = lambda kind: rows.where(F.col("kind") == kind)
    levels = fold_levels(part("levels").select("key", "ord", F.col("levels").alias("names")))
    return Lookups(fold_labels(part("labels").select(F.col("key").alias("source"), "ord", "names")), levels, fold_criteria(part("criteria").select(F.col("key").alias("question"), "ord", "yes", "no")))


class Lookups(NamedTuple):
    """What records are augmented by: labels (source, names), levels (key, names), criteria (question, yes, no)."""

    labels: DataFrame
    levels: DataFrame
    criteria: DataFrame
