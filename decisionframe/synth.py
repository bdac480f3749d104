"""Synthetic examples: jobs, a teacher, and the chain that verifies what it writes."""

from __future__ import annotations

import hashlib
import json
import random
import re
from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.arrays import soft_target
from .functions.hashing import keyed, pick, u01
from .functions.text import render_question
from .operators.filters import accepted, agreement, structure_problem
from .operators.dedup import near_kept, shared_table, signatures, spread
from .operators.statistics import audit_table as audit_table
from .schema import COLUMNS, invalid_reason, record

#: A small taxonomy; pass your own lists for more.
FAMILIES = {"binary": ["policy check", "eligibility", "safety"], "choice": ["routing", "intent", "diagnosis"], "score": ["severity", "quality"], "multi": ["tagging", "requirements"]}
DOMAINS = ["banking", "health", "logistics", "retail", "software", "travel"]
STYLES = ["email", "chat", "ticket", "report"]
DIFFICULTIES = ["easy", "medium", "hard"]
FENCE = re.compile(r"^\s*```[a-zA-Z]*\s*|\s*```\s*$")


def jobs(spark: SparkSession, shards: int, size: int, seed: int = 1234, multi_share: float = 0.4) -> DataFrame:
    """shards * size jobs, each from the hash of its shard, place and seed."""
    return jobs_on(spark.range(shards * size), "id", size, seed, multi_share)


def jobs_on(table: DataFrame, number: str, size: int, seed: int = 1234, multi_share: float = 0.4) -> DataFrame:
    """A job for each row of a table, told by its number (0 or more, once each); shards are of `size` numbers."""
    table = spread(table.select(F.col(number).alias("number")), "number")
    number = "number"
    rows = table.select(F.floor(F.col(number) / size).cast("long").alias("shard"), (F.col(number) % size).cast("long").alias("k"))
    key = F.concat_ws(":", F.lit(str(seed)), F.col("shard").cast("string"), F.col("k").cast("string"))
    type_ = F.when(u01("multi", key) < multi_share / 2, "multi").otherwise(pick(["binary", "choice", "score"], "type", key))
    rows = rows.withColumns({"_k": key, "type": type_})
    family = F.lit(None).cast("string")
    for t, names in FAMILIES.items():
        family = F.when(F.col("type") == t, pick(names, "family", F.col("_k"))).otherwise(family)
    n = F.when(F.col("type") == "binary", 2).when(F.col("type") == "score", 5).otherwise((keyed("n", F.col("_k")) % 4 + 3).cast("int"))
    rows = rows.withColumns({"family": family, "domain": pick(DOMAINS, "domain", F.col("_k")), "style": pick(STYLES, "style", F.col("_k")), "difficulty": pick(DIFFICULTIES, "difficulty", F.col("_k")), "n_options": n})
    target = F.when(F.col("type") == "multi", (keyed("true", F.col("_k")) % F.col("n_options")).cast("int")).otherwise((keyed("target", F.col("_k")) % F.col("n_options")).cast("int"))
    return rows.select(F.concat(F.lit("j"), F.substring(F.md5("_k"), 1, 12)).alias("jid"), "shard", "k", "type", "family", "domain", "style", "difficulty", "n_options", target.alias("target"), (keyed("seed", F.col("_k")) % 2**31).alias("seed"))


class Teacher(Protocol):
    def write(self, job: dict) -> str:
        """A JSON object for the job."""

    def judge(self, text: str, labels: list[str]) -> list[float] | None:
        """A probability for each label."""


#: Words of the fake teacher's options, what its states say, and the labels of a grade.
OWN = ("alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa")
SAID = re.compile(r" that concerns (.*?) in detail")
GRADES = ["1", "2", "3", "4", "5"]


class FakeTeacher:
    """Deterministic and offline. It writes plausible objects and agrees with itself most of the time; some objects are broken."""

    def __init__(self, faults: float = 0.1) -> None:
        self.faults = faults

    def write(self, job: dict) -> str:
        rng = random.Random(job["seed"])
        if rng.random() < self.faults:
            return rng.choice(["not json", '{"state": 3}', "{}"])
        options = [f"{job['domain']} {w}" for w in OWN][: job["n_options"]]
        n, t = job["n_options"], job["target"]
        true = sorted(rng.sample(range(n), t)) if job["type"] == "multi" else t
        named = ", ".join(options[i] for i in true) if job["type"] == "multi" else str(t)
        obj = {"state": f"A {job['style']} about {job['domain']} number {rng.randrange(10**9)} that concerns {named or 'nothing'} in detail.", "question": f"What holds for this {job['family']} case?", "why": "by construction"}
        if job["type"] == "binary":
            obj["answer"] = ("yes", "no")[t]
        elif job["type"] == "score":
            obj["answer"] = t + 1
        else:
            obj |= {"options": options, "answer": true}
        return "```json\n" + json.dumps(obj)[:-1] + ",}\n```"

    def judge(self, text: str, labels: list[str]) -> list[float]:
        """Reads what the state it wrote says, as a judge that sees no answer must; now and then it errs."""
        h = int.from_bytes(hashlib.md5(text.encode()).digest()[:4], "big") / 2**32
        said, last = SAID.search(text), text.rsplit("\n", 1)[-1]
        favourite = None
        if labels == GRADES:
            favourite = 3
        elif labels == ["yes", "no"] and said and last.isdigit():
            favourite = 0 if OWN[int(last)] in said[1] else 1
        elif said and said[1] in labels:
            favourite = labels.index(said[1])
        if favourite is None or h <= 0.1:
            favourite = int(h * 1e6) % len(labels)
        rest = 0.2 / max(1, len(labels) - 1)
        return [0.8 if i == favourite else rest for i in range(len(labels))]


def loose_json(text: str | None) -> object | None:
    """The JSON value in text: without a code fence, else the first balanced braces, trailing commas dropped."""
    body = FENCE.sub("", text or "")
    for candidate in (body, balanced(body)):
        for s in (candidate, re.sub(r",(\s*[}\]])", r"\1", candidate or "")):
            try:
                return json.loads(s)
            except (ValueError, TypeError):
                continue
    return None


def balanced(text: str) -> str | None:
    """The first {...} whose braces outside strings balance."""
    start = text.find("{")
    depth, quoted, escaped = 0, False, False
    for i in range(start, len(text)) if start >= 0 else ():
        c = text[i]
        if quoted:
            quoted, escaped = (c != '"' or escaped), c == "\\" and not escaped
        elif c == '"':
            quoted = True
        else:
            depth += (c == "{") - (c == "}")
            if not depth:
                return text[start : i + 1]
    return None


def label_probs(tokens: list[tuple[str, float]], labels: list[str], content: str = "") -> list[float] | None:
    """Shares of the labels among (token, log probability), tokens without marks around them; else the first letter of content."""
    import math

    weight = [sum(math.exp(lp) for t, lp in tokens if t.strip().strip(").:(").strip() == x) for x in labels]
    if not sum(weight):
        first = content.strip()[:1]
        weight = [float(x[:1] == first) for x in labels] if first else weight
    total = sum(weight)
    return [w / total for w in weight] if total else None


def written(job: dict, obj: object) -> tuple[dict | None, str]:
    """What a teacher's object says for a job, and 'ok' or why it cannot be used."""
    if not isinstance(obj, dict) or not isinstance(obj.get("state"), str) or not isinstance(obj.get("question"), str):
        return None, "bad_json"
    t, a, options = job["type"], obj.get("answer"), obj.get("options")
    whole = lambda x: isinstance(x, int) and not isinstance(x, bool)
    if t == "binary":
        a = str(a).strip().lower()
        if a not in ("yes", "no"):
            return None, "bad_answer"
        options, places = ["yes", "no"], [("yes", "no").index(a)]
        if places[0] != job["target"]:
            return None, "wrong_target"
    elif t == "score":
        try:
            level = int(a)
        except (TypeError, ValueError):
            return None, "bad_answer"
        if level - 1 != job["target"]:
            return None, "wrong_target"
        options, places = [str(i) for i in range(1, job["n_options"] + 1)], [level - 1]
    elif t == "multi":
        if not isinstance(options, list) or not isinstance(a, list) or not all(map(whole, a)):
            return None, "bad_json"
        if len(set(a)) != job["target"]:
            return None, "wrong_target"
        places = sorted(set(a))
    else:
        if not isinstance(options, list) or not whole(a):
            return None, "bad_json"
        places = [a]
    return {"state": obj["state"], "question": obj["question"], "options": [str(o) for o in options], "answer": places, "why": str(obj.get("why", ""))}, "ok"


WRITTEN = "jid string, type string, family string, domain string, difficulty string, state string, question string, options array<string>, answer array<int>, why string, reason string"


def write(job_rows: DataFrame, teacher: Teacher) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for job in batch.to_pylist():
                got, reason = written(job, loose_json(teacher.write(job)))
                out.append({k: job[k] for k in ("jid", "type", "family", "domain", "difficulty")} | (got or dict.fromkeys(("state", "question", "options", "answer", "why"))) | {"reason": reason})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([*((n, pa.string()) for n in ("jid", "type", "family", "domain", "difficulty", "state", "question")), ("options", pa.list_(pa.string())), ("answer", pa.list_(pa.int32())), ("why", pa.string()), ("reason", pa.string())]))

    return job_rows.mapInArrow(run, WRITTEN)


def judged(rows: DataFrame, teacher: Teacher, orders: int = 2) -> DataFrame:
    """records with p, the teacher's probabilities for the options: averaged over shuffled orders, asked one by one for multi;
    and quality, its expected grade from 1 to 5."""
    shown = rows.withColumn("_view", render_question(F.col("type"), F.col("state"), F.col("question"), F.col("options")))
    schema = shown.drop("_view").select("*", F.lit(None).cast("array<double>").alias("p"), F.lit(None).cast("double").alias("quality")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ps, grades = [], []
            for r in batch.select(["id", "type", "options", "answer", "_view"]).to_pylist():
                n, view = len(r["options"]), r["_view"]
                if r["type"] == "multi":
                    each = [teacher.judge(f"{view}\n{i}", ["yes", "no"]) for i in range(n)]
                    p = None if any(x is None for x in each) else [x[0] for x in each]
                else:
                    total, used = [0.0] * n, 0
                    rng = random.Random(r["id"])
                    last: list[int] = []
                    for k in range(1 if r["type"] == "score" else orders):
                        order = list(range(n))
                        if r["type"] != "score":
                            rng.shuffle(order)
                            order = order[::-1] if order == last else order
                        last = order
                        x = teacher.judge(f"{view}\n{k}", [str(i) for i in order])
                        if x is not None:
                            used += 1
                            for place, i in enumerate(order):
                                total[i] += x[place]
                    p = [x / used for x in total] if used else None
                grade = teacher.judge(view, GRADES)
                ps.append(p)
                grades.append(None if grade is None else sum((i + 1) * x for i, x in enumerate(grade)))
            yield batch.drop_columns(["_view"]).append_column("p", pa.array(ps, pa.list_(pa.float64()))).append_column("quality", pa.array(grades, pa.float64()))

    return shown.mapInArrow(run, schema)


def relabelled(p: Column, sure: float) -> Column:
    """The options that a confident judgement of multi options selects; null if one is unsure."""
    certain = F.forall(p, lambda x: (x >= sure) | (x <= 1 - sure))
    return F.when(certain, F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: F.get(p, i) >= 0.5))


def make_examples(job_rows: DataFrame, teacher: Teacher, least_p: float = 0.5, least_quality: float = 3.0, sure: float = 0.85, mix: float = 0.6) -> DataFrame:
    """RECORD columns, jid, family, status, reason, p, p_answer, quality: write, parse, check, judge, relabel, grade."""
    # written once: what is read of it, unread or unfit, would else be asked of the teacher three times
    raw = shared_table(write(job_rows, teacher), "written")
    why = F.create_map(F.lit("family"), "family", F.lit("domain"), "domain", F.lit("difficulty"), "difficulty", F.lit("why"), F.coalesce("why", F.lit("")))
    unread = raw.where("reason <> 'ok'")
    rec = record(raw.where("reason = 'ok'"), id=F.concat(F.lit("syn:"), "jid"), source=F.concat(F.lit("synth:"), "family"), type=F.col("type"), state=F.col("state"), question=F.col("question"), options=F.col("options"), answer=F.col("answer"), kind="synth", meta=why, keep=("jid", "family"))
    rec = rec.withColumn("reason", F.when(invalid_reason() != "ok", invalid_reason()).otherwise(structure_problem()))
    # so is what is checked: a filter on its reason would clean the texts anew for each rule that names them
    rec = shared_table(rec, "checked")
    seen = judged(rec.where("reason is null"), teacher)
    ok = lambda: accepted(F.col("type"), F.col("p"), F.col("answer"), least_p)
    fixed = F.when((F.col("type") == "multi") & ~ok(), relabelled(F.col("p"), sure))
    seen = seen.withColumn("_fixed", fixed)
    meta = F.when(F.col("_fixed").isNotNull(), F.map_concat("meta", F.create_map(F.lit("relabeled"), F.lit("true"), F.lit("writer_answer"), F.to_json("answer")))).otherwise(F.col("meta"))
    seen = seen.withColumn("meta", meta).withColumn("answer", F.coalesce("_fixed", "answer")).drop("_fixed")
    reason = F.when(F.col("p").isNull(), "judge_failed").when(~ok(), "teacher_disagrees").when(F.col("quality").isNull() | (F.col("quality") < least_quality), "low_quality").otherwise("ok")
    seen = seen.withColumn("reason", reason).withColumn("p_answer", F.round(agreement(F.col("type"), F.col("p"), F.col("answer")), 4))
    seen = seen.withColumn("target", F.when(F.col("reason") == "ok", soft_target(F.col("type"), F.col("p"), F.col("answer"), mix)))
    empty = {"p": F.lit(None).cast("array<double>"), "quality": F.lit(None).cast("double"), "p_answer": F.lit(None).cast("double")}
    fell = rec.where("reason is not null").withColumns(empty)
    lost = unread.select(*(F.lit(None).cast(rec.schema[c].dataType).alias(c) if c not in ("type",) else F.col(c) for c in COLUMNS), "jid", "family", "reason").withColumns(empty)
    out = seen.unionByName(fell).unionByName(lost)
    return out.withColumn("status", F.when(F.col("reason") == "ok", "accepted").otherwise("rejected"))


def salvage(outcomes: DataFrame, sure: float = 0.85) -> DataFrame:
    """Rejected multi rows on which the teacher is sure of every option, accepted with the teacher's labels."""
    rows = outcomes.where("status = 'rejected' and type = 'multi' and reason = 'teacher_disagrees'").withColumn("_fixed", relabelled(F.col("p"), sure))
    return rows.where("_fixed is not null").withColumns({"answer": F.col("_fixed"), "status": F.lit("accepted"), "reason": F.lit("ok")}).drop("_fixed")


def without_near(outcomes: DataFrame) -> DataFrame:
    """outcomes whose accepted records that come close to one accepted before (by jid) are rejected as duplicates: state and
    question are compared, by their signatures."""
    accepted = outcomes.where("status = 'accepted'")
    sig = shared_table(signatures(accepted, F.concat_ws(" || ", "state", "question"), "jid"), "signatures")
    doubled = accepted.select("jid").join(near_kept(sig, "jid"), "jid", "left_anti").select("jid", F.lit(True).alias("_doubled"))
    seen = outcomes.join(doubled, "jid", "left").withColumn("_doubled", F.coalesce("_doubled", F.lit(False)))
    told = {"status": F.when(F.col("_doubled"), "rejected").otherwise(F.col("status")), "reason": F.when(F.col("_doubled"), "duplicate").otherwise(F.col("reason"))}
    return seen.withColumns(told).select(*outcomes.columns)


def audit(records: DataFrame, teacher: Teacher) -> DataFrame:
    """id, source, agree, p, chance: a blind judgement of public records. agree is a share for multi."""
    seen = judged(records.select(*COLUMNS), teacher, 1).where("p is not null")
    agree = F.transform("p", lambda x, i: F.when(F.array_contains("answer", i), x).otherwise(1 - x))
    share = F.size(F.filter(agree, lambda a: a >= 0.5)) / F.size("p")
    single = (F.array_position("p", F.array_max("p")) - 1 == F.get("answer", F.lit(0))).cast("double")
    multi = F.col("type") == "multi"
    return seen.select("id", "source", F.when(multi, share).otherwise(single).alias("agree"), agreement(F.col("type"), F.col("p"), F.col("answer")).alias("p"), F.when(multi, 0.5).otherwise(1.0 / F.size("options")).alias("chance"))
