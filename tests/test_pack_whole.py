"""The packed training rows take in all records."""

from __future__ import annotations

from decisionframe import catalog

DATA = "/root/testdata/sf0.001"


def test_pack_training_rows_has_documents(spark):
    rows = catalog.QUERIES["pack_training_rows"](spark, DATA).collect()
    kept = catalog.QUERIES["exact_dedup_first_wins"](spark, DATA).count()
    assert len({r["id"] for r in rows if r["id"].startswith("doc:")}) == kept and max(r["len"] for r in rows) == 512
