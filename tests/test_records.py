"""Functions, mappers, validation and record operators."""

from __future__ import annotations

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from decisionframe.functions import arrays as A
from decisionframe.functions import text as X
from decisionframe.functions.tokens import assemble, byte_ids, truncated
from decisionframe.operators import augment, batching, dedup, filters, graph, sampling
from decisionframe.plans import build as plan
from decisionframe.schema import RECORD, invalid_reason
from decisionframe.sources import mappers as M


def rec(spark, *rows, cols=None):
    base = {"id": "r:0", "source": "s", "kind": "real", "type": "choice", "state": "", "question": "Which one is it?", "options": ["a", "b"], "answer": [0], "target": None, "meta": None}
    return spark.createDataFrame([tuple((base | {"id": f"r:{i}"} | r).values()) for i, r in enumerate(rows)], RECORD)


CASES = [
    ({"type": "free"}, "bad_type"),
    ({"options": ["<", ">"]}, "duplicate_options"),
    ({"options": ["a", " "]}, "bad_options"),
    ({"options": ["a"]}, "option_count"),
    ({"answer": [2]}, "answer_range"),
    ({"answer": []}, "answer_range"),
    ({"type": "multi", "answer": []}, "ok"),
    ({"type": "multi", "answer": [1, 1]}, "answer_range"),
    ({"question": "Why? ok"}, "short_question"),
    ({"type": "binary", "options": ["No", "Yes"]}, "binary_options"),
    ({"type": "binary", "options": ["Yes", "no"]}, "ok"),
    ({"type": "score", "options": ["1", "3"]}, "score_not_consecutive"),
    ({"type": "score", "options": ["low", "high"]}, "ok"),
    ({"target": [0.5, 0.6]}, "bad_target"),
    ({"type": "multi", "target": [0.5, 0.6]}, "ok"),
    ({"target": [1.0]}, "bad_target"),
    ({"options": None}, "bad_options"),
]


def test_validation(spark):
    got = rec(spark, *(c for c, _ in CASES)).select("id", invalid_reason().alias("r")).collect()
    assert {r["id"]: r["r"] for r in got} == {f"r:{i}": want for i, (_, want) in enumerate(CASES)}


def clean(s: str | None, most: int) -> str:
    s = (s or "").replace("\r\n", "\n").replace("\r", "\n")
    s = "".join(c for c in s if c in "\n\t" or ord(c) >= 32)
    s = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", s)).strip()
    if len(s) > most:
        cut = s[:most]
        at = cut.rfind(" ")
        s = (cut[:at] if at > 0.8 * most else cut).rstrip() + " ..."
    return s


TEXTS = [None, "", "  a\t b \r\n\r\n\r\n\r\nc\x07 ", "½ é café ‿  x ", "word " * 20, "x" * 50, "abcdefgh " + "y" * 30, "1234567890123456 8901234567"]


def test_text(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    for r in df.select("i", X.norm_text(F.col("t")).alias("n"), X.clean_text(F.col("t"), 20).alias("c")).collect():
        t = TEXTS[r["i"]]
        low = "".join(c if unicodedata.category(c)[0] in "LN" or c == "_" or c.isspace() else " " for c in (t or "").lower())
        assert r["n"] == " ".join(low.split()), t
        assert r["c"] == clean(t, 20), t
    shown = df.limit(1).select(X.humanize(F.lit("camelCase_with-marks")).alias("h"), X.first_text(F.lit(" \n"), F.lit(None), F.lit(" a ")).alias("f"), X.infer_type(F.array(F.lit("3"), F.lit("4"))).alias("s"), X.infer_type(F.array(F.lit("No"), F.lit("yes"))).alias("b"), X.infer_type(F.array(F.lit("3"), F.lit("5"))).alias("c")).first()
    assert tuple(shown) == ("camel Case with marks", "a", "score", "binary", "choice")


def test_arrays(spark):
    one = spark.createDataFrame([([1.0, 3.0, 2.0], "k")], "z array<double>, k string")
    z = F.col("z")
    r = one.select(A.softmax(z).alias("p"), A.softmax(z, 0.0).alias("hard"), A.concentration(F.array(F.lit(0.5), F.lit(0.5))).alias("c0"), A.concentration(F.array(F.lit(1.0))).alias("c1"), A.argmax(z).alias("a"), A.chosen(A.sigmoid(z), 0.8).alias("on")).first()
    assert abs(sum(r["p"]) - 1) < 1e-12 and r["hard"] == [0.0, 1.0, 0.0] and abs(r["c0"]) < 1e-12 and r["c1"] == 1.0 and r["a"] == 1 and r["on"] == [1, 2]
    t = lambda kind, n, a: A.hard_target(F.lit(kind), F.lit(n), F.array(*(F.lit(x) for x in a)).cast("array<int>"))
    r = one.select(t("score", 2, [0]).alias("two"), t("score", 5, [2]).alias("five"), t("multi", 3, []).alias("none"), A.soft_target(F.lit("choice"), F.array(F.lit(0.1), F.lit(0.2), F.lit(0.7)), F.array(F.lit(2)), 0.6).alias("soft")).first()
    assert r["two"] == pytest.approx([0.985, 0.015]) and r["five"] == pytest.approx([0.006, 0.07875, 0.8305, 0.07875, 0.006]) and r["none"] == pytest.approx([0.03] * 3) and r["soft"][2] > 0.85
    pool = F.array(*(F.lit(c) for c in "abcdefghij"))
    r = one.select(A.subset(F.lit("c"), pool, 4, F.col("k")).alias("s"), A.subset(F.lit("c"), F.slice(pool, 1, 3), 4, F.col("k")).alias("all")).first()
    assert len(set(r["s"])) == 4 and "c" in r["s"] and r["all"] == ["a", "b", "c"]


def shown(df):
    return df.select("*", F.transform("answer", lambda i: F.get("options", i)).alias("right")).collect()


def test_mappers(spark):
    df = spark.createDataFrame([(1, "A university.", 1, 0.3, "x"), (2, "A firm.", 0, 0.7, "y"), (3, " ", 1, 0.9, "x"), (4, "An artist.", None, 0.05, None), (5, "Odd.", 9, None, "x")], "id int, text string, label int, tox double, v string")
    names = ["Company", "EducationalInstitution", "Artist"]
    got = shown(M.classes(df, "c", "id", ["text"], "label", ["Which class is this?"], names, names=names))
    assert {r["id"]: r["right"] for r in got} == {"c:1": ["Educational Institution"], "c:2": ["Company"]}
    got = shown(M.binary(df, "b", "id", ["text"], "tox", M.banded(0.1, 0.5), ["Is it toxic at all?"]))
    assert {r["id"]: r["answer"] for r in got} == {"b:2": [0], "b:4": [1]}
    assert {r["id"]: r["right"] for r in shown(M.score(df, "s", "id", ["text"], "label", 0, 2, ["What level is it?"]))} == {"s:1": ["1"], "s:2": ["0"]}
    nli = spark.createDataFrame([(1, "p", "h", 2), (2, "p", "h", 7)], "id int, p string, h string, label int")
    assert [(r["id"], r["right"]) for r in shown(M.nli(nli, "n", "id", "p", "h", "label"))] == [("n:1", ["false"])]
    pairs = spark.createDataFrame([(i, f"good {i}", f"bad {i}") for i in range(20)] + [(90, "same", "same"), (91, " ", "x")], "id int, g string, b string")
    got = shown(M.pairwise(pairs, "p", "id", F.lit("Q"), F.col("g"), F.col("b"), ["Which response is better?"]))
    assert len(got) == 20 and {r["answer"][0] for r in got} == {0, 1}
    assert all((r["state"].index("good") < r["state"].index("bad")) == (r["answer"] == [0]) for r in got)
    flags = spark.createDataFrame([(1, "t", 1, 0), (2, "t", None, 1), (3, "t", 0, 0)], "id int, text string, a int, b int")
    got = shown(M.multi_labels(flags, "m", "id", ["text"], M.flags({"a": "A", "b": "B"}), ["A", "B"], ["Which labels apply?"]))
    assert {r["id"]: (r["right"], r["bucket"]) for r in got} == {"m:1": (["A"], 1), "m:3": ([], 0)}
    wide = spark.createDataFrame([(1, "t", [f"l{i}" for i in range(8)]), (2, "t", ["l1", "zz"]), (3, "t", ["l1", "l2"])], "id int, text string, l array<string>")
    got = shown(M.multi_labels(wide, "w", "id", ["text"], F.col("l"), [f"l{i}" for i in range(12)], ["Which labels apply?"], none_rate=0.0))
    assert [(r["id"], sorted(r["right"]), len(r["options"])) for r in got] == [("w:3", ["l1", "l2"], 8)]
    talk = spark.createDataFrame([(1, "Human: hi\n\nAssistant: a\n\nHuman: x\n\nAssistant: yes", "Human: hi\n\nAssistant: a\n\nHuman: x\n\nAssistant: no"), (2, "q\n\nAssistant: a", "other\n\nAssistant: b"), (3, "none", "none")], "id int, g string, b string")
    assert [r["id"] for r in shown(M.transcripts(talk, "t", "id", "g", "b", ["Which answer is better?"]))] == ["t:1"]
    mcq = spark.createDataFrame([(1, "Which is it?", (["x", "y"], ["A", "B"]), "B"), (2, "Which is it?", (["x", "y"], ["A", "B"]), "C")], "id int, q string, c struct<text:array<string>,label:array<string>>, k string")
    assert [r["right"] for r in shown(M.mcq_choices(mcq, "q", "id", "q", "c", "k"))] == [["y"]]
    hot = spark.createDataFrame([(1, ["x", "y"], [0, 1]), (2, ["x", "y"], [1, 1])], "id int, o array<string>, s array<int>")
    assert [r["right"] for r in shown(M.one_hot_choice(hot, "h", "id", F.lit(""), F.lit("Which is right?"), "o", "s"))] == [["y"]]
    aspects = spark.createDataFrame([(1, "t", (["food", "Food", "staff"], ["positive", "negative", "negative"])), (2, "t", (["food", "bar"], ["neutral", "neutral"]))], "id int, t string, a struct<term:array<string>,polarity:array<string>>")
    got = shown(M.aspect_sentiment(aspects, "a", "id", "t", "a"))
    assert len(got) == 1 and got[0]["right"] in (["food"], ["staff"])
    tools = spark.createDataFrame([(1, '{"name": "f"} {"name": "g"}', 'USER: do it\n\n<functioncall> {"name": "g"}'), (2, '{"name": "f"}', "USER: hi\n\nhello")], "id int, s string, c string")
    assert {r["id"]: (r["right"], r["bucket"]) for r in shown(M.tool_choice(tools, "t", "id", "s", "c"))} == {"t:1": (["g"], "tool"), "t:2": (["no tool"], "none")}


def test_sampling(spark):
    rows = spark.createDataFrame([(0, "a"), (1, "b"), (2, "b"), (3, "b"), (4, "b"), (5, "b")], "ord int, k string")
    assert [r["ord"] for r in sampling.round_robin(rows, "k", "ord", 4).collect()] == [0, 1, 2, 3]
    assert sampling.bounded_scan(rows, "ord", 3).count() == 3 and sampling.sample_per_group(rows, "k", "ord", 2).count() == 3
    r = rec(spark, {"options": list("abcdef"), "answer": [4], "target": [0.0, 0.0, 0.0, 0.1, 0.9, 0.0]}, {"type": "multi", "options": list("abc"), "answer": [0, 2]}, {"type": "score", "options": ["1", "2"], "answer": [1]})
    got = {x["id"]: x for x in shown(sampling.shuffle_options(r))}
    assert got["r:0"]["right"] == ["e"] and got["r:0"]["target"][got["r:0"]["answer"][0]] == 0.9 and sorted(got["r:1"]["right"]) == ["a", "c"] and got["r:2"]["options"] == ["1", "2"]


def test_dedup_and_near_duplicates(spark):
    rows = rec(spark, {"state": "Same text"}, {"state": "same, TEXT", "answer": [1]}, {"options": ["b", "a"], "state": "Same text"}).withColumn("row_ord", F.split_part("id", F.lit(":"), F.lit(2)).cast("int"))
    assert sorted(r["id"] for r in dedup.first_wins(rows, dedup.record_key(), "row_ord").collect()) == ["r:0", "r:2"]
    # a chain: 1 ~ 2, 2 ~ 3, 1 !~ 3 keeps 1 and 3; 4 copies 3
    sig = spark.createDataFrame([(1, 0, 0, 11), (2, 0, 0b111, 12), (3, 0, 0b111111, 13), (4, 0, 0b111111, 13), (5, 1 << 20, 7 << 8, 14)], "id long, hi long, lo long, ex long")
    assert sorted(r["id"] for r in dedup.near_kept(sig, "id").collect()) == [1, 3, 5]
    texts = spark.createDataFrame([(1, "the printer on floor two is out of toner again today"), (2, "the printer on floor two is out of toner again today "), (3, "payroll was paid one day late this month for all staff")], "id long, t string")
    assert sorted(r["id"] for r in dedup.near_kept(dedup.signatures(texts, F.col("t"), "id"), "id").collect()) == [1, 3]


def test_filters(spark):
    long = "A state that is certainly longer than forty characters."
    rows = rec(spark, {"state": "short"}, {"state": long + " [Name]"}, {"state": long + " The correct answer is b."}, {"state": long, "question": "Select two options that apply", "type": "multi"}, {"state": long, "question": "Is it the purple elephant here?", "options": ["purple elephant", "b"]}, {"state": long})
    assert [r[0] for r in rows.orderBy("id").select(filters.structure_problem()).collect()] == ["short_state", "placeholder", "giveaway", "count_in_question", "answer_in_question", None]
    p = spark.createDataFrame([("choice", [0.1, 0.2, 0.7], [2]), ("choice", [0.6, 0.1, 0.3], [2]), ("score", [0.0, 0.5, 0.5], [1]), ("multi", [0.9, 0.2], [0]), ("multi", [0.9, 0.6], [0])], "type string, p array<double>, a array<int>")
    assert [r[0] for r in p.select(filters.accepted(F.col("type"), F.col("p"), F.col("a"), 0.5)).collect()] == [True, False, True, True, False]


def test_graph(spark):
    none = None
    nodes = spark.createDataFrame([(k, t, none, none, "x", none, none, none) for k, t in zip("abcd", ("Alpha", "Beta", "Gamma", "Delta"), strict=True)], "id string, title string, label string, name string, cluster string, type string, summary string, formula string")
    edges = spark.createDataFrame([("e1", "a", "b", "maps_to", None, True), ("e2", "a", "a", "self", None, True), ("e3", "a", "z", "gone", None, True), ("e4", "a", "b", "maps_to", None, True)], "id string, source string, target string, relation string, kind string, directed boolean")
    got = shown(graph.graph_records(nodes, edges, negatives=2))
    assert len(got) == 1 and got[0]["right"] == ["Beta"] and got[0]["id"].startswith("sem:e1-") and sorted(got[0]["options"]) == ["Beta", "Delta", "Gamma"]


def test_build(spark):
    rows = rec(spark, *({"state": f"text {i}", "source": "held" if i % 10 == 0 else "s", "kind": "synth" if i % 3 == 0 else "real", "options": ["a", "b", "c"], "answer": [i % 3]} for i in range(90)), {"state": "TEXT 1", "options": ["a", "b", "c"]}, {"question": "no"})
    rows = rows.withColumns({"source_rank": F.lit(0), "row_ord": F.split_part("id", F.lit(":"), F.lit(2)).cast("int")})
    cfg = plan.Config(held_out=("held",))
    built = plan.build(rows, cfg).cache()
    assert built.where("rep = 1").count() == 90
    assert {r["split"] for r in built.where("source = 'held'").collect()} == {"zeroshot"}
    assert built.where("split <> 'train' and rep > 1").count() == 0 and built.where("split = 'train' and kind = 'synth' and rep = 2").count() > 0
    assert all(abs(sum(r["target"]) - 1) < 1e-9 for r in built.collect())
    assert {r["reason"]: r["n"] for r in plan.loss_stats(rows, built, cfg).collect()} == {"short_question": 1, "duplicate": 1}


def test_augment(spark):
    look = plan.Lookups(spark.createDataFrame([("s", {"a": "first", "b": "second", "c": "third", "d": "fourth"})], "source string, names map<string,string>"), spark.createDataFrame([], "key string, names array<string>"), spark.createDataFrame([], "question string, yes string, no string"))
    rows = rec(spark, *({"options": ["a", "b", "c"], "answer": [1]} for _ in range(400)))
    got = shown(augment.augment(rows, look.labels, look.levels, look.criteria))
    described = [r for r in got if r["options"][0].startswith("a: ")]
    multi = [r for r in got if r["type"] == "multi"]
    assert 100 < len(described) < 220 and 5 < len(multi) < 45 and all(r["question"].endswith(augment.SUFFIX) for r in multi)
    assert all(len(r["answer"]) in (0, 1) and (r["answer"] or len({x.split(":")[0] for x in r["options"]} & {"b"}) == 0) for r in multi)


def test_tokens_and_batches(spark):
    one = spark.createDataFrame([("qé", ["aa", "b"], "state")], "q string, o array<string>, s string")
    r = one.select(byte_ids(F.col("q")).alias("b"), assemble(F.col("q"), F.col("o"), F.col("s"), 64).alias("x"), assemble(F.col("q"), F.col("o"), F.col("s"), 11).alias("cut"), truncated(F.col("q"), F.col("o"), F.col("s"), 64).alias("t")).first()
    want = [1, *(4 + c for c in "qé".encode()), 2, 3, 4 + 97, 4 + 97, 3, 4 + 98, 2, *(4 + c for c in b"state"), 2]
    assert r["b"] == [4 + c for c in "qé".encode()] and r["x"]["ids"] == want and r["x"]["pos"] == [5, 8] and len(r["cut"]["pos"]) < 2 and not r["t"]
    assert batching.cut([9, 8, 3, 3, 3], 18) == [0, 0, 1, 1, 1]
    rows = spark.range(500).withColumn("n", F.col("id") % 50 + 1)
    got = batching.make_batches(rows, "id", "n", 200, chunk=100).toPandas()
    assert len(got) == 500 and all(g.length.max() * len(g) <= 200 for _, g in got.groupby(["chunk", "batch"]))
