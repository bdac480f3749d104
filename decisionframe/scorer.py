"""Scorers: anything that gives every option of a question a logit, in Arrow batches."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.arrays import sigmoid as sigmoid_column
from .functions.arrays import softmax as softmax_column
from .operators.dedup import shared_table

WORD = re.compile(r"\w+")


class Scorer(Protocol):
    #: Options that one call takes at most.
    cap: int

    def logits(self, state: str, question: str, options: list[str]) -> list[float] | None:
        """One logit for each option; None if one of them did not fit. A scorer may have logits_many(list of such), too."""


class LexicalScorer:
    """Overlap of an option's words with the state's and the question's, with a trace of its own to break ties. Deterministic."""

    cap = 10

    def __init__(self, sharpness: float = 4.0) -> None:
        self.sharpness = sharpness

    def logits(self, state: str, question: str, options: list[str]) -> list[float]:
        text = set(WORD.findall((state + " " + question).lower()))
        out = []
        for o in options:
            words = set(WORD.findall(o.lower()))
            out.append(self.sharpness * len(words & text) / math.sqrt(max(1, len(words))))
        return out


class CallableScorer:
    def __init__(self, f: Callable[[str, str, list[str]], list[float]], cap: int = 10) -> None:
        self.f, self.cap = f, cap

    def logits(self, state: str, question: str, options: list[str]) -> list[float]:
        return self.f(state, question, options)


def softmax(z: list[float], t: float = 1.0) -> list[float]:
    t = max(t, 1e-6)
    top = max(z)
    e = [math.exp((x - top) / t) for x in z]
    s = sum(e)
    return [x / s for x in e]


def sigmoid(z: list[float], t: float = 1.0) -> list[float]:
    return [1 / (1 + math.exp(-min(60.0, max(-60.0, x / max(t, 1e-6))))) for x in z]


#: How a group that does not fit is made smaller, and what is said when it can't be.
def smaller(size: int) -> int:
    return max(2, min(size - 1, 8) if size > 8 else size // 2)


UNFIT = "the options do not fit in the model's input - shorten them"


def many(scorer: Scorer, asked: list[tuple[str, str, list[str]]]) -> list[list[float] | None]:
    """The logits of many groups: by the scorer's own batch call where it has one."""
    whole = getattr(scorer, "logits_many", None)
    return whole(asked) if whole else [scorer.logits(*x) for x in asked]


def probabilities(scorer: Scorer, state: str, question: str, options: list[str], multi: bool = False, t: float = 1.0, size: int = 0) -> list[float]:
    """Probabilities of one record's options, of any number. More than the scorer takes are a tournament: groups are scored, each
    sends its best on, the finalists are scored again and have what they get there; the others of a group are scaled to its best one's
    final share. For multi, groups are scored on their own. Groups that do not fit are made smaller; pairs that don't raise."""
    size = min(size or scorer.cap, len(options))
    while True:
        groups = [list(range(i, min(i + size, len(options)))) for i in range(0, len(options), size)]
        scored = many(scorer, [(state, question, [options[i] for i in g]) for g in groups])
        if all(z is not None for z in scored):
            break
        if size <= 2:
            raise ValueError(UNFIT)
        size = smaller(size)
    if multi:
        return [p for z in scored for p in sigmoid(z, t)]
    local = [softmax(z, t) for z in scored]
    if len(groups) == 1:
        return local[0]
    seats = max(1, size // len(groups))
    finalists = [sorted(range(len(g)), key=lambda k, p=p: (-p[k], k))[:seats] for g, p in zip(groups, local, strict=True)]
    chosen = [g[k] for g, ks in zip(groups, finalists, strict=True) for k in ks]
    final = dict(zip(chosen, probabilities(scorer, state, question, [options[i] for i in chosen], False, t, size), strict=True))
    out = [0.0] * len(options)
    for g, p, ks in zip(groups, local, finalists, strict=True):
        scale = final[g[ks[0]]] / max(p[ks[0]], 1e-12)
        for k, i in enumerate(g):
            out[i] = final[i] if k in ks else p[k] * scale
    total = sum(out)
    return [x / total for x in out]


def score(rows: DataFrame, scorer: Scorer, temperatures: dict[str, float] | None = None) -> DataFrame:
    """rows (type, state, question, options and others) with p. Rows whose options the scorer takes at once are scored in
    batches, in the order of the partition; the others are played as rounds of relations (see tournament), if there are any."""
    ts, cap = temperatures or {}, scorer.cap
    schema = rows.select("*", F.lit(None).cast("array<double>").alias("p")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, asked = _asked(batch)
            there = [i for i, x in enumerate(asked) if x[2]]
            z = dict(zip(there, many(scorer, [asked[i] for i in there]), strict=True))
            p = []
            for i, (kind, x) in enumerate(zip(kinds, asked, strict=True)):
                t = ts.get(kind, 1.0)
                if i not in z:
                    p.append([])
                elif z[i] is None:  # does not fit as a whole
                    p.append(probabilities(scorer, *x, kind == "multi", t))
                else:
                    p.append(sigmoid(z[i], t) if kind == "multi" else softmax(z[i], t))
            yield batch.append_column("p", pa.array(p, pa.list_(pa.float64())))

    wide = F.coalesce(F.size("options"), F.lit(0)) > cap
    direct = rows.where(~wide).mapInArrow(run, schema)
    if not rows.where(wide).select("type").take(1):
        return direct
    return direct.unionByName(tournament(rows.where(wide), scorer, ts))


def _asked(batch: pa.RecordBatch) -> tuple[list, list[tuple[str, str, list[str]]]]:
    cols = {n: batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("type", "state", "question", "options")}
    return cols["type"], [(s or "", q or "", o or []) for s, q, o in zip(cols["state"], cols["question"], cols["options"], strict=True)]


def tournament(rows: DataFrame, scorer: Scorer, temperatures: dict[str, float] | None = None) -> DataFrame:
    """rows with p, for rows with more options than the scorer takes at once; the same as probabilities() of each.

    A round's relation has a row for each record and group, scored in whole batches whatever records the groups are of. Records
    whose groups do not all fit play the round again with smaller ones; those with several groups send their finalists to the next
    round; the others are through. Shares then go back from the last round to the first, a join for each."""
    ts, spark = temperatures or {}, rows.sparkSession
    base = shared_table(rows.withColumn("_uid", F.monotonically_increasing_id()), "wide")
    state = base.select("_uid", "type", F.coalesce("state", F.lit("")).alias("state"), F.coalesce("question", F.lit("")).alias("question"), "options")
    t = F.lit(1.0)
    for kind, value in ts.items():
        t = F.when(F.col("type") == kind, F.lit(value)).otherwise(t)
    open_ = state.select("_uid", F.lit(0).alias("level"), F.sequence(F.lit(0), F.size("options") - 1).alias("who"), F.least(F.lit(scorer.cap), F.size("options")).alias("size"))
    ended, rounds = [], []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = many(scorer, _asked(batch)[1])
            keep = [batch.column(batch.schema.get_field_index(n)) for n in ("_uid", "level", "size", "groups", "grp", "members", "type")]
            yield pa.record_batch([*keep, pa.array(z, pa.list_(pa.float64()))], names=["_uid", "level", "size", "groups", "grp", "members", "type", "z"])

    while open_.take(1):
        n = F.ceil(F.size("who") / F.col("size")).cast("int")
        cut = open_.withColumn("groups", n).select("_uid", "level", "size", "groups", F.posexplode(F.expr("transform(sequence(0, groups - 1), g -> slice(who, g * size + 1, size))")).alias("grp", "members"))
        asked = cut.join(state, "_uid").withColumn("options", F.transform("members", lambda i: F.get("options", i)))
        scored = shared_table(asked.mapInArrow(run, "_uid long, level int, size int, groups int, grp int, members array<int>, type string, z array<double>"), "scored")
        unfit = scored.where("z is null").select("_uid").distinct()
        if scored.where("z is null and size <= 2").take(1):
            raise ValueError(UNFIT)
        again = open_.join(unfit, "_uid", "left_semi").withColumn("size", F.greatest(F.lit(2), F.when(F.col("size") > 8, F.least(F.col("size") - 1, F.lit(8))).otherwise(F.floor(F.col("size") / 2))).cast("int"))
        fits = scored.join(unfit, "_uid", "left_anti")
        multi = F.col("type") == "multi"
        through = fits.where(multi | (F.col("groups") == 1)).select("_uid", "level", F.explode(F.arrays_zip("members", F.when(multi, sigmoid_column(F.col("z"), t)).otherwise(softmax_column(F.col("z"), t)).alias("p"))).alias("x"))
        ended.append(shared_table(through.select("_uid", "level", F.col("x.members").alias("i"), F.col("x.p").alias("p")), "through"))
        best = F.array_sort(F.transform("members", lambda m, k: F.struct((-F.get("local", k)).alias("o"), k.alias("k"), m.alias("i"))))
        played = fits.where(~multi & (F.col("groups") > 1)).withColumn("local", softmax_column(F.col("z"), t))
        played = played.withColumn("finalists", F.transform(F.slice(best, F.lit(1), F.greatest(F.lit(1), F.floor(F.col("size") / F.col("groups")).cast("int"))), lambda x: x["i"]))
        rounds.append(shared_table(played.select("_uid", "level", "size", "grp", "members", "local", "finalists"), "played"))
        after = rounds[-1].groupBy("_uid", "level", "size").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("grp", "finalists"))), lambda x: x["finalists"])).alias("who"))
        after = after.select("_uid", (F.col("level") + 1).alias("level"), "who", F.least("size", F.size("who")).alias("size"))
        open_ = shared_table(again.unionByName(after), "open")
    done, all_rounds = reduce(DataFrame.unionByName, ended), reduce(DataFrame.unionByName, rounds)
    known = None
    for level in range(all_rounds.agg(F.coalesce(F.max("level"), F.lit(-1))).first()[0] + 1, -1, -1):
        here = done.where(F.col("level") == level).select("_uid", "i", "p")
        if known is not None:
            final = known.groupBy("_uid").agg(F.map_from_entries(F.collect_list(F.struct("i", "p"))).alias("final"))
            back = all_rounds.where(F.col("level") == level).join(final, "_uid").withColumn("top", F.get("finalists", F.lit(0)))
            scale = F.element_at("final", F.col("top")) / F.greatest(F.lit(1e-12), F.get("local", F.array_position("members", F.col("top")).cast("int") - 1))
            shares = F.transform("members", lambda m, k: F.struct(m.alias("i"), F.coalesce(F.try_element_at("final", m), F.get("local", k) * F.col("scale")).alias("p")))
            back = back.withColumn("scale", scale).select("_uid", F.explode(shares).alias("x")).select("_uid", "x.i", "x.p")
            total = back.groupBy("_uid").agg(F.sum("p").alias("total"))
            here = here.unionByName(back.join(total, "_uid").select("_uid", "i", (F.col("p") / F.col("total")).alias("p")))
        known = shared_table(here, "known")
    p = known.groupBy("_uid").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "p"))), lambda x: x["p"]).alias("p"))
    return base.join(p, "_uid").select(*rows.columns, "p")
