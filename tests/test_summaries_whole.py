"""The summaries take in all predictions."""

from __future__ import annotations

import duckdb
import pytest

from decisionframe import catalog

DATA = "/root/testdata/sf0.001"


def test_summaries_take_all_predictions(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    n = con.execute("SELECT count(*) FROM embeddings").fetchone()[0]
    overall = {(r["scope"], r["name"]): r["n"] for r in catalog.QUERIES["summarize_overall"](spark, DATA).collect()}
    assert overall == {("all", "all"): 2 * n, ("type", "choice"): n, ("type", "multi"): n}
    want = con.execute(f"""WITH {catalog.PRED}{catalog.MULTI}, rows_ AS (SELECT source, count(*) AS n, avg(exact) AS acc, avg(nll) AS nll FROM mr GROUP BY source),
options AS (SELECT source, avg(pow(p - y, 2)) AS brier, avg(greatest(p, 1 - p)) AS mean_conf FROM mo GROUP BY source)
SELECT source, count(*) AS n, avg(correct), avg(nll), avg(brier), avg(conf) FROM s1 GROUP BY source
UNION ALL SELECT 'multi-' || source, n, acc, nll, brier, mean_conf FROM rows_ JOIN options USING (source)""").fetchall()
    got = {r[0]: tuple(r[1:]) for r in catalog.QUERIES["summarize_by_source"](spark, DATA).collect()}
    assert got.keys() == {r[0] for r in want} and all(got[r[0]] == pytest.approx(r[1:], abs=2e-6) for r in want)
