"""Questions and options that all rows share are cleaned once, and options are normalised at one look, as one by one."""

from __future__ import annotations

from pyspark.sql import functions as F

from decisionframe import catalog
from decisionframe.functions import text as X
from decisionframe.schema import invalid_reason
from decisionframe.sources import mappers as M

DATA = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_constants_are_literals_of_the_plan(spark):
    orders = catalog.priority_records(spark, DATA).select("question", "options")
    assert "[1,2,3,4,5] AS options" in plan_of(orders) and "regexp_replace" not in plan_of(orders).split("Filter")[0]
    docs = catalog.document_records(spark, DATA).select("question", "options")
    assert "[de,en,es,fr] AS options" in plan_of(docs)


def test_constants_are_cleaned_as_rows_are(spark):
    rows = spark.createDataFrame([(1, "text", " a_b\t\tC"), (2, "text", "dE"), (3, " ", "dE")], "id int, text string, label string")
    ask = ["  Which\r\none  is it?\n"] * 2
    got = M.classes(rows, "c", "id", ["text"], "label", ask, [" a_b\t\tC", "dE", "x" * 170], rename={"dE": " shown \t so"}).collect()
    assert [(r["id"], r["answer"]) for r in got] == [("c:1", [0]), ("c:2", [1])]
    assert {r["question"] for r in got} == {"Which\none is it?"}
    assert {tuple(r["options"]) for r in got} == {("a b C", "shown so", "x" * 160 + " ...")}


def test_options_at_one_look_and_one_by_one(spark):
    rows = [["A, b", " c!! "], ["", " ", None], ["a\nb", "c"], [], None, ["ΑΣ", "ΣΑ ", "é_1   x"], ["\n"], ["yes"]]
    df = spark.createDataFrame([(i, o) for i, o in enumerate(rows)], "i int, o array<string>").withColumn("l", X.norm_lines(F.col("o")))
    for r in df.select("i", X.norms(F.col("o"), F.col("l")).alias("new"), F.transform("o", X.norm_text).alias("old")).collect():
        assert r["new"] == r["old"], rows[r["i"]]


def test_steps_of_scores(spark):
    cases = [(["1", "2", "3"], "ok"), (["3", "4"], "ok"), (["1", "3"], "score_not_consecutive"), (["2", "1"], "score_not_consecutive"), (["99999999999", "2"], "score_not_consecutive"), (["2147483647", "2147483648"], "score_not_consecutive")]
    df = spark.createDataFrame([(str(i), "score", "s", "How much is it?", o, [0], None) for i, (o, _) in enumerate(cases)], "id string, type string, state string, question string, options array<string>, answer array<int>, target array<double>")
    assert [r["r"] for r in df.select("id", invalid_reason().alias("r")).orderBy("id").collect()] == [want for _, want in cases]
