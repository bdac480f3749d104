"""Rows of one row group are dealt out to tasks; a batch's inputs are laid out at once, as byte by byte."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from decisionframe import catalog
from decisionframe.functions import tokens
from decisionframe.functions.text import clean_text

DATA = "/root/testdata/sf0.001"


def one(q, o, s, most, mq, mo):
    if o is None:
        return None, None
    b = lambda x, m=None: [4 + c for c in (x or "").encode()[:m]]
    ids, pos = [tokens.CLS, *b(q, mq), tokens.SEP], []
    for x in o:
        part = [tokens.MASK, *b(x, mo)]
        if len(ids) + len(part) + 2 > most:
            break
        pos.append(len(ids))
        ids += part
    room = max(most - len(ids) - 2, 0)
    return [*ids, tokens.SEP, *b(s)[:room], tokens.SEP], pos


def test_batches_are_laid_out_as_rows_are():
    rows = [("Which é?", ["a", None, "ccccc", "d"], "state ü " * 9), (None, ["x", "y"], None), ("q" * 40, ["z" * 30, "a"], "s"), ("no options", None, "s"), ("", [], ""), ("q", ["a" * 20, "b" * 20, "c"], "t" * 99)]
    cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.list_(pa.string()), pa.string()))]
    for most in (11, 24, 50, 512):
        for a in (0, 2):
            got = tokens.laid_out(*(c[a:] for c in cols), most, 16, 12).to_pylist()
            assert [(r["ids"], r["pos"]) for r in got] == [one(*r, most, 16, 12) for r in rows[a:]]
    assert tokens.laid_out(*(c[:0] for c in cols), 512, 16, 12).to_pylist() == []


def test_clean_text_of_clean_and_unclean(spark):
    texts = {"a b": "a b", " a": "a", "a ": "a", " a": "a", "a  b": "a b", "a\tb": "a b", "a\r\nb\rc": "a\nb\nc", "a\n\n\n\nb": "a\n\nb", "a\x00b": "ab", "": "", "a b": "a b", "a\x7fb": "a\x7fb", "a\n": "a"}
    df = spark.createDataFrame([(k, v) for k, v in texts.items()], "t string, want string")
    assert [r for r in df.withColumn("got", clean_text(F.col("t"))).collect() if r["got"] != r["want"]] == []
    assert spark.range(1).select(clean_text(F.lit(None))).first()[0] == ""


def test_records_are_spread_over_tasks(spark):
    for rows in (catalog.document_records, catalog.priority_records, catalog.toxic_records, catalog.all_records):
        assert rows(spark, DATA).select(F.spark_partition_id().alias("p")).distinct().count() > 4
