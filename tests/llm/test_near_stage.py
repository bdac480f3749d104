"""The pipeline's near-duplicate stage links by five words and 0.8, not by op10's figures."""

from __future__ import annotations

import random

import corpus_pipeline
from tests.llm.test_operators import brute_components, sentence


def test_stage_links_by_five_words(spark):
    rng, rows = random.Random(6), []
    for base in range(8):
        words = sentence(rng, 200, "abcdefghijklmnop").split()
        rows.append((base * 10, " ".join(words)))
        for edits in (2, 3, 4, 5):
            w = list(words)
            for k in range(edits):
                w[20 + 30 * k] = f"edit{base}x{edits}y{k}"
            rows.append((base * 10 + edits, " ".join(w)))
    docs = spark.createDataFrame([(i, t, "aa", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    want, op10 = ({i for i, (_, c) in brute_components(rows, *by).items() if i == c} for by in ((5, 80), (4, 85)))
    stage = dict(corpus_pipeline.STAGES)["jaccard_join"]
    assert want != op10 and {r["doc_id"] for r in stage(spark, docs, "").collect()} == want
