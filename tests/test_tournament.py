"""The tournament as relations against one record at a time, and that against the rules step by step."""

from __future__ import annotations

import math
import random

import pytest

from decisionframe import scorer as S

SCHEMA = "id long, type string, state string, question string, options array<string>, level int, i string"


def logits(state: str, question: str, options: list[str]) -> list[float] | None:
    """Groups of more than five with a long option do not fit."""
    if len(options) > 5 and any(len(o) > 8 for o in options) or state == "never":
        return None
    return [(len(state) * 7 + sum(map(ord, o)) * 13) % 41 / 9 for o in options]


def table():
    rng = random.Random(3)
    rows = []
    for i in range(60):
        n = rng.choice((1, 2, 9, 10, 11, 12, 20, 21, 57, 110, 255))
        options = [f"o{k}" + ("x" * 9 if i % 7 == 3 and k == n // 2 else "") for k in range(n)]
        rows.append((i, rng.choice(("choice", "multi", "score")), None if i == 5 else "s" * rng.randint(0, 30), "q", options, 1, "x"))
    return rows + [(60, "choice", "s", None, [], 1, "x"), (61, "choice", "s", "q", None, 1, "x")]


def test_relations_and_records_agree(spark):
    rows, scorer, ts = table(), S.CallableScorer(logits), {"choice": 1.7, "multi": 0.6}
    got = {r["id"]: r["p"] for r in S.score(spark.createDataFrame(rows, SCHEMA).repartition(4), scorer, ts).collect()}
    assert len(got) == len(rows) and got[60] == got[61] == []
    for i, kind, state, question, options, _, _ in rows[:60]:
        want = S.probabilities(scorer, state or "", question or "", options, kind == "multi", ts.get(kind, 1.0))
        assert got[i] == pytest.approx(want, abs=1e-12), (i, kind, len(options))
        assert kind == "multi" or sum(got[i]) == pytest.approx(1)


def test_finalists_have_their_final_share():
    z = [float(x) for x in (3, 1, 2, 0, 5, 4)]
    scorer = S.CallableScorer(lambda s, q, o: [z[int(x)] for x in o], cap=4)
    got = S.probabilities(scorer, "", "", [str(i) for i in range(6)])
    # groups 0-3 and 4-5; two finalists of each: 0, 2, 4, 5; the others follow their group's best
    e = {i: math.exp(z[i]) for i in range(6)}
    final = {i: e[i] / sum(e[k] for k in (0, 2, 4, 5)) for i in (0, 2, 4, 5)}
    out = {**final, 1: e[1] * final[0] / e[0], 3: e[3] * final[0] / e[0]}
    assert got == pytest.approx([out[i] / sum(out.values()) for i in range(6)])


def test_what_does_not_fit_is_an_error(spark):
    scorer = S.CallableScorer(logits)
    with pytest.raises(ValueError, match="do not fit"):
        S.probabilities(scorer, "never", "q", ["a", "b", "c"])
    with pytest.raises(ValueError, match="do not fit"):
        S.tournament(spark.createDataFrame([(1, "choice", "never", "q", [str(k) for k in range(30)], 1, "x")], SCHEMA), scorer)
    assert [S.smaller(k) for k in (40, 10, 9, 8, 5, 3, 2)] == [8, 8, 8, 4, 2, 2, 2]


def test_a_batch_call_is_used(spark):
    class Whole(S.CallableScorer):
        def logits_many(self, asked):
            assert len({len(o) for _, _, o in asked}) <= 2
            return [self.f(*x) for x in asked]

    rows = [(i, "choice", "s" * i, "q", [f"o{k}" for k in range(25)], 1, "x") for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    one, two = ({r["id"]: r["p"] for r in S.score(df, x(logits)).collect()} for x in (S.CallableScorer, Whole))
    assert one == two and len(one) == 20
