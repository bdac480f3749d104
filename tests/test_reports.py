"""Reports, single-set mappers and state rendering: nulls, ties, empty tables and errors."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from decisionframe.operators import reports as R
from decisionframe.serve import render
from decisionframe.sources import mappers as M


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_audit_and_category(spark):
    done = spark.createDataFrame([("a", "s", 1), ("b", "s", 0), ("c", "t", 1), (None, "t", 1)], "id string, source string, agree int")
    wanted = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    assert rows(R.audit_of(done, wanted)) == [("s", 2, 0.5)]
    stats, known = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n int"), spark.createDataFrame([("x", "X"), ("y", "Y")], "k string, category string")
    assert sorted(rows(R.with_category(stats, known, "k"))) == [("x", 1, "X"), ("y", 2, "Y")]
    with pytest.raises(Exception, match="no category for k y"):
        R.with_category(stats, known.where("k = 'x'"), "k").collect()


def test_funnel_acceptance_and_ratios(spark):
    out = spark.createDataFrame([("t", "f", 1, None), ("t", "f", 0, "b"), ("t", "g", None, "a"), ("u", "h", 1, "a"), ("t", "e", 0, "b")], "type string, family string, accepted int, reason string")
    assert rows(R.funnel(out)) == [("a", 2, 1, 0.4), ("b", 2, 2, 0.4), ("accepted", 1, 3, 0.2)]
    assert sorted(rows(R.family_acceptance(out))) == [("t", 0.0, 0.0, 0.5, "e", "f"), ("u", 1.0, 1.0, 1.0, "h", "h")]
    assert rows(R.funnel(out.where("false"))) == [] and rows(R.family_acceptance(out.where("false"))) == []
    results = spark.createDataFrame([("x", 0.5, 2.0, 8.0), ("y", 1.0, 0.0, None)], "benchmark string, acc double, ms double, teacher_ms double")
    assert sorted(rows(R.benchmark_ratios(results)), key=str) == [("Mean", 0.75, None), ("x", 0.5, 4.0), ("y", 1.0, None)]


def stop(values, patience):
    best, best_step, bad = None, None, 0
    for step, v in enumerate(values):
        if v is not None and (best is None or v < best):
            best, best_step, bad = v, step, 0
        else:
            bad += 1
            if bad >= patience:
                return step, best, best_step
    return None, best, best_step


def test_early_stopping(spark):
    rng = random.Random(1)
    runs = {r: [rng.choice([None, 1.0, 2.0, 3.0, 4.0, 5.0]) for _ in range(rng.randint(1, 25))] for r in range(40)} | {99: [None] * 4, 98: [2.0, 2.0, 2.0, 2.0]}
    evals = spark.createDataFrame([(r, i, v) for r, vs in runs.items() for i, v in enumerate(vs)], "run int, step int, nll double")
    got = {x[0]: x[1:] for x in rows(R.early_stopping(evals, 3).select("run", "stopped", "best", "best_step"))}
    assert got == {r: stop(vs, 3) for r, vs in runs.items()}


def test_length_batches(spark):
    texts = [("a" * random.Random(i).randint(0, 50), i) for i in range(300)] + [(None, 300)]
    df = spark.createDataFrame(texts, "state string, n int").withColumns({"question": F.lit("qq"), "options": F.array(F.lit("x"), F.lit(None).cast("string"))})
    got = R.length_batches(df, "n", 16).collect()
    assert all(r["cost"] == len(r["state"] or "") + 3 for r in got) and len(got) == 301
    by = {}
    for r in got:
        by.setdefault(r["batch"], []).append(r["cost"])
    assert all(len(x) <= 16 for x in by.values())
    spans = sorted((min(x), max(x)) for x in by.values())
    assert all(a[1] <= b[0] for a, b in zip(spans[:-1], spans[1:], strict=True))
    assert [r["n"] for r in R.in_order(R.length_batches(df, "n"), "n").collect()] == list(range(301))


@pytest.mark.parametrize("state", [{"a": "x", "b": None, "c": True, "d": 3}, ["one", "two"], [["p", "q"], ["r"]], {"k": ["ü", 'say "hi"\n']}, {"o": {"p": "1", "q": [1, 2]}}, "plain", None])
def test_render(spark, state):
    def want(s):
        if s is None or isinstance(s, str):
            return s or ""
        if isinstance(s, list):
            return "\n".join(map(want, s))
        return "\n".join(f"{k}: {v if v is None or isinstance(v, str | int) else json.dumps(v, ensure_ascii=False)}" for k, v in s.items())

    kinds = {"a": "struct<a:string,b:string,c:boolean,d:int>", "k": "struct<k:array<string>>", "o": "struct<o:struct<p:string,q:array<int>>>"}
    kind = kinds[next(iter(state))] if isinstance(state, dict) else "array<array<string>>" if isinstance(state, list) and isinstance(state[0], list) else "array<string>" if isinstance(state, list) else "string"
    df = spark.createDataFrame([(state,)], f"s {kind}")
    assert df.select(render(F.col("s"), df.schema["s"].dataType)).first()[0] == want(state)


def test_tools_and_lists(spark):
    system = 'You have\n{ "name": "find", "description": "Finds things", "parameters": {"properties": {"name": {"type": "string"}}}}\n{"name": "sum", "description": ""}'
    chats = ['USER: add up\n\n\nplease\n\n\nASSISTANT: <functioncall> {"name": "sum"} x\n\n\nASSISTANT: <functioncall> {"name": "find"}', "USER: hi\n\n\nASSISTANT: hello", 'USER: a\n\n\nASSISTANT: <functioncall> {"name": "gone"}', "ASSISTANT: b\n\n\nUSER: c", None]
    df = spark.createDataFrame([(i, system, c) for i, c in enumerate(chats)], "id int, s string, c string")
    got = {r["id"]: r for r in M.tool_choice(df, "t", "id", "s", "c").collect()}
    assert set(got) == {"t:0", "t:1"} and got["t:0"]["options"][got["t:0"]["answer"][0]] == "sum" and got["t:1"]["bucket"] == "none"
    assert sorted(got["t:0"]["options"]) == ["find", "no tool", "sum"] and "find: Finds things" in got["t:0"]["state"]
    lists = ["['it is', \"it's\"]", "['it\\'s', 'b']", "[]", "no list", None]
    assert [r[0] for r in spark.createDataFrame([(x,) for x in lists], "x string").select(M.python_list(F.col("x"))).collect()] == [["it is", "it's"], ["it's", "b"], [], None, None]


def test_faithful_and_graded(spark):
    df = spark.createDataFrame([(i, "k", "q", f"right {i}", f"wrong {i}") for i in range(30)] + [(99, None, None, "", "")], "id int, knowledge string, question string, right_answer string, hallucinated_answer string")
    got = M.faithful(df, "f", "id", "qa").collect()
    assert len(got) == 30 and all(("right" in r["state"]) == (r["answer"] == [0]) for r in got) and len({r["answer"][0] for r in got}) == 2
    assert M.faithful(df, "f", "id", "unknown").count() == 0
    legal = spark.createDataFrame([(1, " Yes ", "t" * 4000), (2, "no", "t"), (3, "maybe", "t"), (4, None, "t")], "id int, a string, t string")
    out = {r["id"]: r for r in M.graded_yes_no(legal, "l", "id", F.concat(F.lit("Clause: "), "t"), F.lit("Is it so in this clause?"), "a").collect()}
    assert {k: v["answer"] for k, v in out.items()} == {"l:1": [0], "l:2": [1]} and len(out["l:1"]["state"]) <= 3000
    assert {r["id"]: r["answer"] for r in M.graded_choice(legal, "l", "id", F.concat(F.lit("Clause: "), "t"), F.lit("Which one is it?"), "a", ("no", "maybe")).collect()} == {"l:2": [0], "l:3": [1]}
