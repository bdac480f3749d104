"""Languages with few rows are learned."""

from __future__ import annotations

import random

from decisionframe.llm import langid
from tests.llm.test_operators import sentence


def test_rare_language_is_learned(spark):
    rng = random.Random(5)
    rows = [(i, sentence(rng, 12, "abcdef"), "aa") for i in range(600)] + [(1000 + i, sentence(rng, 12, "uvwxyz"), "zz") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    assert langid.SAMPLE >= 4000
    model = langid.fit(docs, sample=20)
    assert model.langs == ["aa", "zz"]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, model).collect()}
    assert all(got[i] == lang for i, _, lang in rows)
