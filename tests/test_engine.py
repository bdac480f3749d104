"""Metrics, calibration, coverage, serving, synthesis, sources, incremental stages and streams."""

from __future__ import annotations

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from decisionframe import serve, synth
from decisionframe.operators import calibrate, corpus, coverage, metrics
from decisionframe.plans import incremental
from decisionframe.scorer import CallableScorer, LexicalScorer, probabilities
from decisionframe.sources import readers, sinks
from decisionframe.streaming import ingest

PRED = "id long, type string, source string, z array<double>, p array<double>, a int, y array<int>"


def predictions(spark, n=200):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        z = rng.normal(size=4)
        p = np.exp(z) / np.exp(z).sum()
        rows.append((i, "choice", f"s{i % 3}", z.tolist(), p.tolist(), int(rng.choice(4, p=p)), None))
    for i in range(n, n + 60):
        z = rng.normal(size=3)
        p = 1 / (1 + np.exp(-z))
        rows.append((i, "multi", "m", z.tolist(), p.tolist(), None, [int(x) for x in rng.random(3) < p]))
    return spark.createDataFrame(rows, PRED), rows


def ece(conf, correct, bins=15):
    edges, out = np.linspace(0, 1, bins + 1), 0.0
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        m = (conf > lo) & (conf <= hi) if lo else (conf >= lo) & (conf <= hi)
        out += m.mean() * abs(correct[m].mean() - conf[m].mean()) if m.any() else 0
    return out


def test_metrics(spark):
    df, rows = predictions(spark)
    single = [r for r in rows if r[1] == "choice"]
    conf, right = np.array([max(r[4]) for r in single]), np.array([float(np.argmax(r[4]) == r[5]) for r in single])
    r = metrics.core(df, ["type"]).first()
    assert r["n"] == 200 and r["acc"] == pytest.approx(right.mean()) and r["ece"] == pytest.approx(ece(conf, right)) and r["nll"] == pytest.approx(np.mean([-math.log(x[4][x[5]]) for x in single]))
    multi = [r for r in rows if r[1] == "multi"]
    p, y = np.array([r[4] for r in multi]), np.array([r[6] for r in multi])
    m = metrics.multi_core(df, ["type"]).first()
    assert m["acc"] == pytest.approx(((p >= 0.5) == y).all(axis=1).mean()) and m["brier"] == pytest.approx(((p - y) ** 2).mean()) and m["ece"] == pytest.approx(ece(np.maximum(p, 1 - p).ravel(), ((p >= 0.5) == y).ravel().astype(float)))
    s = {(x["scope"], x["name"]): x for x in metrics.summarize(df).collect()}
    assert s["all", "all"]["ece"] == pytest.approx((200 * r["ece"] + 60 * m["ece"]) / 260) and len(s) == 7
    assert [x["bin"] for x in metrics.reliability(spark.createDataFrame([(0.0, 1.0), (1.0, 1.0)], "conf double, correct double")).orderBy("bin").collect()] == [1, 15]


def test_calibration(spark):
    df, rows = predictions(spark)
    single = [(np.array(r[3]), r[5]) for r in rows if r[1] == "choice"]
    want = calibrate.golden(lambda t: np.mean([-math.log(max(1e-12, (np.exp((z - z.max()) / t) / np.exp((z - z.max()) / t).sum())[a])) for z, a in single]))
    got = {r["type"]: r["temperature"] for r in calibrate.fit_temperatures(df, rounds=6).collect()}
    assert got["choice"] == pytest.approx(want, rel=1e-3)
    assert calibrate.temperature_grid(df.limit(29), [0.5, 1.0, 2.0]).first()["temperature"] == 1.0
    tie = spark.createDataFrame([(i, "multi", "m", None, [0.9, 0.1], None, [1, 0]) for i in range(40)], PRED)
    assert calibrate.best_threshold(tie).first()["threshold"] == 0.2


def test_coverage(spark):
    rows = spark.createDataFrame([(i, c, w) for i, (c, w) in enumerate([(0.9, 1.0), (0.8, 0.0), (0.8, 1.0), (0.5, 1.0), (0.3, 0.0)])], "id long, conf double, correct double")
    curve = {r["coverage"]: r["error"] for r in coverage.risk_curve(rows).collect()}
    assert len(curve) == 20 and curve[50] == 0.5 and curve[5] == 0.0 and curve[100] == pytest.approx(0.4)
    sel = {r["threshold"]: (r["coverage"], r["error"]) for r in coverage.selective(rows).collect()}
    assert sel[0.8] == (0.6, pytest.approx(1 / 3)) and sel[0.97] == (0.0, None)


def test_tournament():
    scorer = CallableScorer(lambda s, q, o: [float(x.split()[-1]) / 4 for x in o], cap=8)
    p = probabilities(scorer, "", "", [f"option {i}" for i in range(40)])
    assert len(p) == 40 and sum(p) == pytest.approx(1) and int(np.argmax(p)) == 39
    shy = CallableScorer(lambda s, q, o: None if len(o) > 3 else [0.0] * len(o), cap=10)
    assert sum(probabilities(shy, "", "", list("abcdefghijk"))) == pytest.approx(1)


def test_ask(spark):
    q = lambda t, i, c, th=None: (t, i, c, th)
    asked = {"flag": q("noul", "Is the sky blue?", {}), "level": q("score", "How much is it?", {str(i): "" for i in range(1, 6)}), "tags": q("multi", "Which ones apply?", {"sky": "the sky", "sea": ""}, 0.9), "bad": q("choice", "Only one?", {"x": ""}), "odd": q("nothing", "What is this?", {})}
    rows = spark.createDataFrame([("r", {"text": "the sky is blue"}, asked)], serve.REQUEST)
    a = serve.ask(rows).first()["answers"]
    assert a["bad"]["error"] and a["odd"]["error"].startswith("unknown type") and a["flag"]["error"] is None
    assert sum(a["level"]["probabilities"].values()) == pytest.approx(1, abs=1e-3) and 1 <= a["level"]["expected"] <= 5 and a["tags"]["selected"] == ["sky"]
    out = serve.decide(spark.createDataFrame([("1", "the sky", "Which is it?", ["sky", "sea"]), ("2", "", "Is it so?", None)], "id string, state string, question string, options array<string>"), LexicalScorer())
    assert [(r["type"], r["choice"]) for r in out.orderBy("id").collect()] == [("choice", "sky"), ("binary", "yes")]


def test_synthesis(spark):
    assert synth.loose_json('Sure:\n```\n{"grade": [2, 3,],}\n```\nDone.') == {"grade": [2, 3]} and synth.loose_json('so {"said": "a { and a } here", "n": {"k": null}} it is') == {"said": "a { and a } here", "n": {"k": None}} and synth.loose_json("none") is None
    p = synth.label_probs([("C.", -0.2), (" A", -1.9), ("It", -2.2), ("B", -6.0)], list("ABC"))
    assert sum(p) == pytest.approx(1) and p[2] > 0.8 and p[0] > p[1] and synth.label_probs([], list("AB"), " B") == [0.0, 1.0]
    jobs = synth.jobs(spark, 2, 60)
    assert jobs.select("jid").distinct().count() == 120
    out = synth.make_examples(jobs, synth.FakeTeacher()).cache()
    assert out.count() == 120
    good = out.where("status = 'accepted'").collect()
    assert len(good) > 40 and all(r["target"] and (r["type"] == "multi" or abs(sum(r["target"]) - 1) < 1e-9) for r in good)
    assert {r["reason"] for r in out.select("reason").distinct().collect()} >= {"ok", "bad_json"}
    assert ingest.closable_shards(jobs, out).count() == 2 and ingest.missing_jobs(jobs, out).count() == 0
    table = synth.audit_table(synth.audit(out.where("status = 'accepted'"), synth.FakeTeacher())).collect()
    assert table and all(r["agree"] > r["chance"] for r in table)


def test_sources(spark, tmp_path):
    for name in ("stock", "cheapest", "tags", "delay"):
        assert readers.toy(spark, name, 50).where(readers.invalid_reason() == "ok").count() == 50
    line = {"id": "x:1", "type": "choice", "state": "", "question": "Which one is it?", "options": ["a", "b"], "answer": 1}
    good, bad = tmp_path / "good.jsonl", tmp_path / "bad.jsonl"
    good.write_text(json.dumps(line) + "\n\n" + json.dumps(line | {"id": "x:2", "type": "multi", "answer": [0]}) + "\n")
    bad.write_text(json.dumps(line) + "\n" + '{"type": "choice"}\n')
    got = readers.load_records(spark, str(good)).orderBy("id").collect()
    assert [(r["source"], r["kind"], r["answer"]) for r in got] == [("import:good", "real", [1]), ("import:good", "real", [0])]
    with pytest.raises(ValueError, match="bad.jsonl:2: "):
        readers.load_records(spark, str(bad))
    (tmp_path / "rough.jsonl").write_text(json.dumps(line) + "\nnot json\n")
    assert readers.read_jsonl(spark, str(tmp_path / "rough.jsonl")).count() == 1 and readers.read_jsonl(spark, str(tmp_path / "absent.jsonl")).count() == 0
    source = readers.Source("s", "choice", lambda df: readers.records_of(df.select(*readers.COLUMNS)), configs={"a": lambda s: s.createDataFrame([(f"{i}", "s", "real", "choice", "", "Which one is it?", ["a", "b"], str(i % 2), None, None) for i in range(40)], ", ".join(f"{f.name} {f.dataType.simpleString() if f.name != 'answer' else 'string'}" for f in readers.RECORD.fields)), "gone": lambda s: s.read.parquet(str(tmp_path / "no"))})
    rows = readers.load(spark, source, 10).collect()
    assert len(rows) == 10 and sum(r["answer"] == [0] for r in rows) == 5
    assert sinks.write_jsonl(spark.range(7), str(tmp_path / "out")) == 7
    sinks.write_json(tmp_path / "v.json", {"a": 1})
    assert sinks.read_json(tmp_path / "v.json") == {"a": 1} and sinks.read_json(tmp_path / "none.json", 3) == 3


def test_incremental(tmp_path):
    ran = []
    stages = [incremental.Stage("a", lambda: ran.append("a"), ("x",)), incremental.Stage("b", lambda: ran.append("b"), ("y",), ("a",)), incremental.Stage("c", lambda: ran.append("c"), ("z",))]
    config, manifest = {"x": 1, "y": 2, "z": 3}, incremental.Manifest(tmp_path / "m.json")
    assert incremental.run_stages(stages, config, manifest) == ["a", "b", "c"] and incremental.run_stages(stages, config, manifest) == []
    assert incremental.run_stages(stages, config | {"x": 9}, incremental.Manifest(tmp_path / "m.json")) == ["a", "b"]
    r = incremental.Registry(tmp_path / "r.json")
    for n in ("m1", "m2", "n1"):
        r.add(n)
    r.promote("m1")
    assert r.resolve() == "m1" and r.resolve("n") == "n1" and r.prune(1) == ["m2"]
    with pytest.raises(KeyError):
        incremental.typed(config, {"nope": "1"})
    assert incremental.typed(config, {"x": "5"})["x"] == 5


def test_stream(spark, tmp_path):
    schema = "jid string, status string, type string"
    put = lambda name, rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    run = lambda: ingest.ingest(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "state"), retry=str(tmp_path / "retry")).awaitTermination()
    put("1", [("a", "accepted", "t"), ("b", "error", "t"), ("a", "accepted", "t")])
    run()
    put("2", [("a", "accepted", "t"), ("b", "accepted", "t"), ("c", "rejected", "u")])
    run()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["jid"] for r in out.collect()) == ["a", "b", "c"] and spark.read.json(str(tmp_path / "retry")).count() == 1
    assert ingest.enough(5, 10, 10, 10) and not ingest.enough(5, 30, 10, 10)


def test_corpus(spark):
    h = spark.createDataFrame([("m1", "b", 0.5), ("m2", "b", 0.7)], "model string, benchmark string, acc double")
    assert sorted((r["model"], r["acc"]) for r in corpus.upsert(h, h.where("model = 'm1'").withColumn("acc", F.lit(0.6))).collect()) == [("m1", 0.6), ("m2", 0.7)]
    assert [r["delta"] for r in corpus.previous_delta(h).orderBy("model").collect()] == [None, pytest.approx(0.2)]
    none = spark.createDataFrame([], "id string, source string")
    gone = corpus.delete(none, spark.createDataFrame([("1", "a"), ("2", "b")], "id string, source string"))
    assert [r["id"] for r in corpus.restore(gone, source="a").collect()] == ["2"] and corpus.digest([], []) == "" and corpus.set_disabled(["x"], "y", True) == ["x", "y"]
    b = spark.createDataFrame([("n1", "d1", "test"), ("n2", "d1", "train"), ("n3", "d9", "test")], "name string, dataset string, split string")
    flags = {r["name"]: r["in_training"] for r in corpus.contaminated_benchmarks(b, spark.createDataFrame([("d1", "train")], "dataset string, split string")).collect()}
    assert flags == {"n1": "other split only", "n2": "YES - same split", "n3": "no"}
