"""Mappers of tables with layouts of their own, statistics and overviews, folded descriptions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from decisionframe.operators import augment, statistics
from decisionframe.plans import build
from decisionframe.schema import invalid_reason
from decisionframe.sources import bespoke


def records(spark, name, schema, rows):
    out = bespoke.mapped(name, spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"id long, {schema}"))
    assert out.where(invalid_reason() != "ok").count() == 0
    return {r["id"]: r for r in out.collect()}


def right(r):
    return [r["options"][i] for i in r["answer"]]


def test_mappers(spark):
    rows = [("E", "us", "a lamp", "bright and small", "desk lamp"), ("x", "us", "a lamp", "bright", "q"), ("i", "fr", "a lamp", "bright", "q"), ("c", None, "a bulb that fits", None, "desk lamp")]
    got = records(spark, "products", "esci_label string, product_locale string, product_title string, product_bullet_point string, query string", rows)
    assert {k: right(r) for k, r in got.items()} == {"products:0": ["exact match"], "products:3": ["complement"]}
    got = records(spark, "events", "premise string, question string, choice1 string, choice2 string, label int", [("The glass fell down.", "effect", "It broke.", "It flew.", 0), ("x", "why", "a", "b", 0), ("It rained all day.", "cause", "Sun.", "Clouds came.", 1), ("It rained.", "cause", "a", "b", 2)])
    assert {k: right(r) for k, r in got.items()} == {"events:0": ["It broke."], "events:2": ["Clouds came."]}
    assert got["events:0"]["question"] != got["events:2"]["question"]
    got = records(spark, "pleasant", "baseline string, less_pleasant string", [(f"I ate cake number {i}.", f"I ate stale cake number {i}.") for i in range(12)] + [("same", "same"), (None, "x")])
    assert len(got) == 12 and len({r["answer"][0] for r in got.values()}) == 2
    assert all(f"{right(r)[0]}: I ate cake" in r["state"] for r in got.values())
    got = records(spark, "traits", "scenario string, label int", [("She gave all her bread away. [SEP] generous", 1), ("He took it all for himself. [SEP] generous", 0), ("No trait here", 1), ("He left the room. [SEP] x", None)])
    assert {k: right(r) for k, r in got.items()} == {"traits:0": ["yes"], "traits:1": ["no"]} and "generous" in got["traits:0"]["question"]
    got = records(spark, "morals", "situation string, intention string, moral_action string, immoral_action string", [("A purse lies there.", "I want to help.", f"Bring it back {i}.", f"Keep it {i}.") for i in range(10)] + [("s", "i", "not specified", "x")])
    assert len(got) == 10 and all(right(r)[0].startswith("Bring") for r in got.values()) and len({r["answer"][0] for r in got.values()}) == 2
    turns = lambda x: [("user", "How do birds fly?"), ("assistant", x)]
    conv = "conversation_a array<struct<role:string,content:string>>, conversation_b array<struct<role:string,content:string>>, winner string, turn int"
    got = records(spark, "judged", conv, [(turns("By wings."), turns("No idea."), "model_a", 1), (turns("No idea."), turns("By wings."), "model_b", 1), (turns("a"), turns("b"), "tie", 1), (turns("a"), turns("b"), "model_a", 2), (turns("a")[:1], turns("b"), "model_a", 1)])
    assert len(got) == 2 and all(f"{right(r)[0]}: By wings." in r["state"] for r in got.values())
    got = records(spark, "facts", "question string, choices struct<text:array<string>,label:array<string>>, answerKey string, fact1 string, fact2 string", [("What floats on water?", (["wood", "iron"], ["A", "B"]), "A", "Wood is light.", "Light things float.")])
    assert right(got["facts:0"]) == ["wood"] and got["facts:0"]["state"] == "Wood is light. Light things float."
    exam = [("What is two and two?", ["three", "four"], 1), ("q", ["one"], 0), ("q", ["a", "b"], 2), ("q", None, 0)]
    got = records(spark, "exam", "question string, choices array<string>, answer int", exam)
    inside = bespoke.mapped("exam", spark.createDataFrame([(i, r) for i, r in enumerate(exam)], "id long, train struct<question:string,choices:array<string>,answer:int>")).collect()
    assert [right(r) for r in got.values()] == [right(r) for r in inside] == [["four"]]
    graded = "orig_score string, orig_criteria string, " + ", ".join(f"orig_score{k}_description string" for k in range(1, 6)) + ", orig_instruction string, orig_response string"
    got = records(spark, "graded", graded, [("4.0", "Is it polite?", *"abcde", "Say hello.", "Hello!"), ("6", "c", *"abcde", "i", "r"), ("x", "c", *"abcde", "i", "r")])
    assert [right(r) for r in got.values()] == [["4"]]
    with pytest.raises(ValueError, match="needs the columns"):
        bespoke.mapped("exam", spark.range(1))
    df = spark.createDataFrame([("play_music", None)], "scenario string, intent string")
    assert bespoke.replaced(df, "_intent", ["scenario", "intent"], {"_": " ", "play": "start"}).first()["_intent"] == "start music "


def test_overviews(spark):
    sources = spark.createDataFrame([(s, "choice", "local") for s in "abcd"], "source string, type string, origin string")
    made = statistics.sources_overview(
        sources, spark.createDataFrame([("a", 9)], "source string, n long"), spark.createDataFrame([("b", "no rows")], "source string, message string"), spark.createDataFrame([("a", 0.8, 0.25)], "source string, agree double, chance double"),
        spark.createDataFrame([("a",), ("a",), ("z",)], "source string"), ["a", "b", "c"], dropped=["b"], held_out=["a"],
    )
    got = {r["source"]: r.asDict() for r in made.collect()}
    assert {k: (r["state"], r["n"], r["deleted"]) for k, r in got.items()} == {"a": ("loaded", 9, 2), "b": ("failed", 0, 0), "c": ("pending", 0, 0), "d": ("excluded", 0, 0)}
    assert got["a"]["agree"] == 0.8 and got["a"]["held_out"] and got["b"]["audit_dropped"] and got["b"]["message"] == "no rows" and not got["a"]["disabled"]
    cats = statistics.category_statistics(sources.withColumn("n", F.lit(5)), spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "source string, category string"))
    assert {(r["category"], r["sources"], r["records"]) for r in cats.collect()} == {("x", 2, 10), ("y", 1, 5), (None, 1, 5)}
    done = spark.createDataFrame([("s", "p", 0.5), ("s", "q", 0.7), ("t", "r", 0.2)], "suite string, benchmark string, acc double")
    assert {(r["suite"], r["benchmarks"], round(r["acc"], 6)) for r in statistics.suite_means(done).collect()} == {("s", 2, 0.6), ("t", 1, 0.2), ("all", 3, 0.4)}
    history = spark.createDataFrame([("m1", "p", 0.3), ("m2", "p", 0.4), ("m9", "p", 0.9), ("teacher_z", "p", 0.1), ("m1", "q", 0.1)], "model string, benchmark string, acc double")
    rows = {r["benchmark"]: r for r in statistics.benchmark_overview(done, history, "m9", history.where("model = 'teacher_z'")).collect()}
    assert rows["p"]["previous"] == "m2" and rows["p"]["delta"] == pytest.approx(0.1) and rows["p"]["teacher_acc"] == 0.1 and rows["r"]["previous"] is None and rows["q"]["teacher_acc"] is None
    groups = spark.createDataFrame([("p", f"g{i}", i / 10, i) for i in range(6)], "benchmark string, name string, acc double, n int")
    assert [r["name"] for r in statistics.weakest_groups(groups, 2).orderBy("rank").collect()] == ["g0", "g1"]


def test_described(spark):
    rows = spark.createDataFrame(
        [("labels", "s", 1, {"a": "old", "b": "of b"}, None, None, None), ("labels", "s", 2, {"a": "new"}, None, None, None), ("levels", "k", 1, None, ["lo", "hi"], None, None), ("levels", "k", 2, None, ["low", "high"], None, None), ("criteria", "q?", 1, None, None, "it is", "it is not")],
        "kind string, key string, ord int, names map<string,string>, levels array<string>, yes string, no string",
    )
    found = augment.fold_described(rows)
    assert found.labels.first()["names"] == {"a": "new", "b": "of b"} and found.levels.first()["names"] == ["low", "high"] and found.criteria.first()["no"] == "it is not"
    assert [f.name for f in build.no_lookups(spark).levels.schema] == ["key", "names"]


def test_tools_are_anchored(spark):
    from decisionframe.sources import mappers as M

    system = 'Use these:\n{\n "name": "weather",\n "description": "tells it",\n "parameters": {"city": {"name": "nested", "type": "string"}}\n}\n{"name": "clock"}\n'
    df = spark.createDataFrame([(1, system, 'USER: Rain today?\n\n\nASSISTANT: <functioncall> {"name": "weather", "arguments": "{}"}\n\n\n')], "id long, system string, chat string")
    assert M.tool_choice(df, "t", "id", "system", "chat").first()["options"] == ["weather", "clock", "no tool"]
