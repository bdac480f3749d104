"""Only sources whose input has changed are made again; counted seconds do not depend on how frames are cut."""

from __future__ import annotations

import os
from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from decisionframe.operators import corpus
from decisionframe.plans import sources as P
from decisionframe.sources import mappers as M


def source(tmp_path, name, **settings):
    read = lambda spark: spark.read.schema("id long, text string, label int").parquet(str(tmp_path / name))
    make = lambda df: M.classes(df, "x", "id", ["text"], "label", [settings.get("ask", "Which one?")], ["red", "green"], names=["red", "green"])
    return P.Source(name, read, make, settings)


def times(path) -> dict[str, set[tuple[str, int]]]:
    return {d.name: {(f.name, os.stat(f).st_mtime_ns) for f in d.glob("*.parquet")} for d in path.glob("source=*")}


def test_only_changed_sources_are_made_again(spark, tmp_path):
    out = tmp_path / "built"
    table = lambda n, m: spark.createDataFrame([(i, f"text number {i} of a source", i % 2) for i in range(m)], "id long, text string, label int").write.mode("overwrite").parquet(str(tmp_path / n))
    for name, n in (("a", 8), ("b", 5), ("none", 0)):
        table(name, n)
    all_ = [source(tmp_path, x) for x in ("a", "b", "none", "missing")]
    said = P.build(spark, all_, str(out))
    assert said["a"] == said["b"] == "built" and said["none"] == "skipped: no usable rows" and said["missing"].startswith("skipped: ")
    first, n = times(out / "records"), {r["source"]: r["count"] for r in P.read(spark, str(out)).groupBy("source").count().collect()}
    assert set(first) == {"source=a", "source=b"} and n == {"a": 8, "b": 5}
    assert P.build(spark, all_[:2], str(out)) == {"a": "kept", "b": "kept"} and times(out / "records") == first
    table("b", 6)
    assert P.build(spark, all_[:2], str(out)) == {"a": "kept", "b": "built"}
    second = times(out / "records")
    assert second["source=a"] == first["source=a"] and second["source=b"].isdisjoint(first["source=b"])
    # settings count too; a source that gets worse keeps what it had
    table("b", 0)
    changed = [source(tmp_path, "a", ask="Which of these?"), all_[1]]
    assert P.build(spark, changed, str(out)) == {"a": "built", "b": "skipped: no usable rows"}
    assert times(out / "records")["source=b"] == second["source=b"] and P.read(spark, str(out)).count() == 14
    assert P.build(spark, [all_[1]], str(out), force=True) == {"b": "skipped: no usable rows"}


def test_moving_rate_across_buckets(spark, monkeypatch):
    start = datetime(2024, 1, 1)
    rows = [("a", start + timedelta(seconds=(i * i * 7) % 900, milliseconds=i)) for i in range(400)] + [("b", start), ("b", start), (None, start), ("c", None), ("c", None)]
    df = spark.createDataFrame([(i, *r, 5) for i, r in enumerate(rows)], "id int, kind string, ts timestamp, rate_ int")
    want = Counter()
    for i, (k, t) in enumerate(rows):
        near = sum(1 for l, u in rows if l == k and (u is None) == (t is None) and (t is None or 0 <= int(t.timestamp()) - int(u.timestamp()) <= 120))
        want[i, round(near / 120, 9)] += 1
    for frame in (60, 1, 2):
        monkeypatch.setattr(corpus, "FRAME", frame)
        got = corpus.moving_rate(df, "kind", "ts")
        assert Counter((r["id"], round(r["rate"], 9)) for r in got.collect()) == want and got.columns == [*df.columns, "rate"]
    assert corpus.moving_rate(df.where(F.lit(False)), "kind", "ts").collect() == []
