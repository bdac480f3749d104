"""Predicates of the record pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import argmax, expected
from ..functions.text import norm_text

#: Patterns that mark a record as unfinished or as giving its answer away.
PLACEHOLDER = r"(?i)\[(?:[A-Z][A-Za-z ]{0,20}|insert[^\]]*|placeholder[^\]]*)\]|\{[a-z_]{2,30}\}|lorem ipsum|<[A-Z_]{3,}>|\bXXX+\b"
GIVEAWAY = r"(?i)\b(the (correct|right) (answer|option) is|answer\s*:\s*\w)"
COUNTED = r"(?i)\b(which|select|choose|pick|name|list)\s+(the\s+)?(one|two|three|four|five|six|both|\d+)\b|\b(two|three|four|five|\d+)\s+(of the |of these )?(options|tags|items|policies|requirements|topics|tools|teams|actions|fields|factors|categories)\b"


def structure_problem() -> Column:
    """The first structural fault of a synthetic record, or null."""
    s, q, o, t, a = (F.col(c) for c in ("state", "question", "options", "type", "answer"))
    right = norm_text(F.get(o, F.get(a, F.lit(0))))
    asked = norm_text(q)
    others = F.exists(F.filter(F.sequence(F.lit(0), F.size(o) - 1), lambda i: i != F.get(a, F.lit(0))), lambda i: F.contains(asked, norm_text(F.get(o, i))))
    long = F.exists(o, lambda x: F.length(x) > 160)
    return (
        F.when(F.length(s) < 40, "short_state")
        .when(s.rlike(PLACEHOLDER) | q.rlike(PLACEHOLDER) | F.exists(o, lambda x: x.rlike(PLACEHOLDER)), "placeholder")
        .when(s.rlike(GIVEAWAY) | q.rlike(GIVEAWAY), "giveaway")
        .when((t == "multi") & long, "long_option")
        .when((t == "multi") & q.rlike(COUNTED), "count_in_question")
        .when((t == "choice") & (F.length(right) >= 12) & F.contains(asked, right) & ~others, "answer_in_question")
        .when((t == "choice") & long, "long_option")
    )


def blind_agreement(p: Column, answer: Column) -> Column:
    """Per option, how much a multi judgement agrees with the answer."""
    return F.transform(p, lambda x, i: F.when(F.array_contains(answer, i), x).otherwise(1 - x))


def accepted(type_: Column, p: Column, answer: Column, least: float) -> Column:
    """Does a blind judgement bear the answer out? A score may be off by one level in expectation."""
    a = F.get(answer, F.lit(0))
    single = (argmax(p) == a) & (F.get(p, a) >= least)
    return F.when(type_ == "multi", F.array_min(blind_agreement(p, answer)) >= least).when(type_ == "score", F.abs(expected(p) - a) <= 1.0).otherwise(single)


def agreement(type_: Column, p: Column, answer: Column) -> Column:
    mean = F.aggregate(blind_agreement(p, answer), F.lit(0.0), lambda acc, x: acc + x) / F.size(p)
    return F.when(type_ == "multi", mean).otherwise(F.get(p, F.get(answer, F.lit(0))))


def exclude(records: DataFrame, deleted: DataFrame, disabled: list[str]) -> DataFrame:
    """Without deleted ids and disabled sources; 'synth' disables all synthetic records."""
    kept = records.join(deleted.select("id"), "id", "left_anti")
    if disabled:
        kept = kept.where(~F.col("source").isin(disabled))
    return kept.where(F.col("kind") != "synth") if "synth" in disabled else kept


def browse(records: DataFrame, deleted: DataFrame, source: str | None = None, needle: str = "", deleted_rows: str = "hide") -> DataFrame:
    """Records of a source whose state, question or options contain needle, with their deleted flag: hide, show or only."""
    rows = records.join(deleted.select("id", F.lit(True).alias("deleted")), "id", "left").withColumn("deleted", F.coalesce("deleted", F.lit(False)))
    if source:
        rows = rows.where(F.col("source") == source)
    if needle:
        rows = rows.where(F.contains(F.lower(F.concat_ws("\n", "state", "question", F.array_join("options", "\n"))), F.lit(needle.lower())))
    return rows if deleted_rows == "show" else rows.where(F.col("deleted") if deleted_rows == "only" else ~F.col("deleted"))


def page(rows: DataFrame, order: str, offset: int, limit: int) -> tuple[int, DataFrame]:
    """The total, and at most 200 rows from offset on."""
    return rows.count(), rows.orderBy(order).offset(offset).limit(min(200, limit))


def relevant(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows whose p reaches the threshold, most probable first."""
    return scored.where(F.col("p") >= threshold).orderBy(F.desc("p"))


def dropped_sources(audit: DataFrame, least: int = 20, slack: float = 0.15) -> DataFrame:
    """Sources whose audited agreement is worse than chance by more than the slack."""
    return audit.where((F.col("n") >= least) & (F.col("agree") < F.col("chance") - slack))
