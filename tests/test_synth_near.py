"""Jobs over a table, and duplicates inside the chain."""

from __future__ import annotations

from decisionframe import synth


def test_jobs_on_a_table_are_the_same_jobs(spark):
    one, two = synth.jobs(spark, 3, 20), synth.jobs_on(spark.range(60).selectExpr("id AS number", "'x' AS type"), "number", 20)
    assert sorted(one.collect()) == sorted(two.collect()) and one.select("jid").distinct().count() == 60


def test_doubled_examples_fall(spark):
    made = synth.make_examples(synth.jobs(spark, 2, 40), synth.FakeTeacher()).cache()
    base = {r["jid"]: (r["status"], r["reason"]) for r in made.collect()}
    first = sorted(j for j, (s, _) in base.items() if s == "accepted")[:5]
    # the same examples again under later ids, and a rejected one
    again = made.where(made.jid.isin(first)).selectExpr(*(f"concat('z', {c}) AS {c}" if c == "jid" else c for c in made.columns))
    got = {r["jid"]: (r["status"], r["reason"]) for r in synth.without_near(made.unionByName(again)).collect()}
    assert len(got) == len(base) + 5 and all(got["z" + j] == ("rejected", "duplicate") for j in first)
    assert all(got[j] == base[j] for j in first) and all(got[j] == x for j, x in base.items() if x[0] == "rejected")
    assert synth.without_near(made.limit(0)).collect() == []
