"""The pipeline's stages keep clean documents, and run() returns the pieces of what they keep."""

from __future__ import annotations

import random

import corpus_pipeline
from tests.llm.test_operators import brute_components, sentence


def test_pipeline(spark, tmp_path):
    rng = random.Random(2)
    clean = [(i, sentence(rng, 60, "abcdefghijkl"), "aa") for i in range(30)]
    item = sentence(rng, 30, "mnopqrst")
    rows = [*clean, (50, "123 456", "aa"), (51, None, None), (52, clean[3][1] + " ", "aa"), (53, clean[4][1] + " more", "aa"), (54, sentence(rng, 20) + " " + item, "aa")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = docs
    expected = [{50, 51}, {3}, set(), {54}]
    left = {r[0] for r in rows}
    for (name, stage), gone in zip(corpus_pipeline.STAGES[:-1], expected, strict=True):
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
        left -= gone
        if name == "jaccard_join":
            left = {i for i, (_, c) in brute_components([(i, t) for i, t, _ in rows if i in left]).items() if i == c}
        assert {r["doc_id"] for r in kept.collect()} == left, name
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} == left
