"""Rows that share a doc_id, or have none, are judged by their own texts; ids match the tokenizer on all of ASCII."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from decisionframe.llm import common, components, decontaminate, exact_dedup, jaccard_join, langid, packing, repeats, substring_dedup, suffix_dedup
from decisionframe.llm.queries import tokenizer_path

rng = random.Random(11)


def prose(n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n))


SHARED, OTHER, THIRD = prose(90), prose(90), prose(90)
#: Ids 5 and null stand for several different texts.
ROWS = [(1, SHARED), (5, OTHER), (5, SHARED + " " + prose(30)), (None, THIRD), (None, SHARED), (7, prose(90)), (9, THIRD + " tail")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").coalesce(1)


def test_repeats_by_row(docs):
    words = {t: len(t.split()) for _, t in ROWS}
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring_dedup.substring_dedup(docs).collect())
    # null sorts first, so its rows stay whole and the later copies of their passages go
    want = Counter([(1, 90, 90), (5, 90, 0), (5, words[ROWS[2][1]], 90), (None, 90, 0), (None, 90, 0), (7, 90, 0), (9, 91, 90)])
    assert got == want
    gone = sorted((r["n_bytes"], r["n_removed"]) for r in suffix_dedup.suffix_dedup(docs).collect())
    shared, third = len(SHARED.encode()), len(THIRD.encode())
    removed = [shared, 0, shared, third, shared, 0, third]
    assert gone == sorted((len(t.encode()), k if k >= 400 else 0) for (_, t), k in zip(ROWS, removed, strict=True))


def test_links_by_row(docs, spark):
    rows = [(5, OTHER), (5, THIRD), (9, THIRD + " tail"), (3, THIRD), (3, THIRD)]
    found = Counter((r["doc_id"], r["component_id"]) for r in jaccard_join.linked_components(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect())
    assert found == Counter([(5, 5), (5, 3), (9, 3), (3, 3), (3, 3)])
    kept = jaccard_join.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter([(5, OTHER), (3, THIRD)])
    kept = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter([(5, OTHER), (3, THIRD), (9, THIRD + " tail")])


def test_one_of_repeated_rows_is_kept(spark):
    rows = [(5, "a b"), (5, "a b"), (7, "a b"), (7, "ab"), (8, "c")]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == [(5, 5, 4), (5, 5, 4), (7, 5, 4), (7, 5, 4), (8, 8, 1)]
    assert sorted(r["doc_id"] for r in got if r["kept"]) == [5, 8]


def test_rows_keep_their_numbers_when_scans_are_cut_anew(spark, tmp_path, monkeypatch):
    """As on a cluster that grows and shrinks: every stage cuts the files in another way."""
    texts = [prose(60) for _ in range(12)]
    rows = [(i, texts[i % 12] + (" " + prose(25) if i % 3 else "")) for i in range(96)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    tasks = {
        "op1": lambda: substring_dedup.substring_dedup(docs), "op5": lambda: suffix_dedup.suffix_dedup(docs), "op9": lambda: exact_dedup.exact_groups(docs), "op10": lambda: jaccard_join.linked_components(docs),
        "op4": lambda: decontaminate.contamination(docs, spark.createDataFrame([("a", texts[0]), ("b", texts[1])], "item_id string, text string"), most_words=40),
    }
    still = {name: Counter(map(str, f().collect())) for name, f in tasks.items()}
    turn, plain = iter(range(10**6)), common.staged

    def staged(df, name):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", 2 + next(turn) % 5)
        return plain(df, name)

    for module in (common, repeats, exact_dedup, jaccard_join, decontaminate, components):
        monkeypatch.setattr(module, "staged", staged)
    small = {"spark.sql.files.minPartitionNum": None, "spark.sql.files.openCostInBytes": "16", "spark.sql.files.maxPartitionBytes": "4096"}
    for k, v in small.items():
        if v:
            spark.conf.set(k, v)
    try:
        for name, f in tasks.items():
            assert Counter(map(str, f().collect())) == still[name], name
    finally:
        for k in (*small, "spark.sql.leafNodeDefaultParallelism"):
            spark.conf.unset(k)


def test_file_slots_differ():
    paths = [f"file:///a/part-{i:05}.parquet" for i in range(3000)]
    seed, bits = common.file_slots(paths)
    assert bits == 24 and common.file_slots([p.replace("///", "/") for p in paths]) == (seed, bits)


def test_slices_of_the_benchmark_change_nothing(docs, spark):
    items = spark.createDataFrame([("a", " ".join(SHARED.split()[5:20])), ("b", " ".join(OTHER.split()[:12])), ("c", "nothing here")], "item_id string, text string")
    whole, cut = (Counter((r["doc_id"], r["n_words"], tuple(r["hits"]), tuple(sorted(r["items"]))) for r in decontaminate.contamination(docs, items, most_words=k).collect()) for k in (10_000, 13))
    assert whole == cut and sum(whole.values()) == len(ROWS)


def test_ids_match_the_tokenizer():
    ids = packing.Ids(tokenizer_path())
    pools = ["".join(map(chr, range(128))), "".join(map(chr, range(256))), "aZ'sTdre vemll09 \t\n\x1c\x85\xa0.,’“éÉ̈ß", "abcİIΣσς ½²٣漢字 ̀ﬁ　Kµªº"]
    assert ids.known
    for k in range(4000):
        x = "".join(rng.choices(pools[k % 4], k=rng.randint(1, 30)))
        assert ids.document(x.encode()) == packing.little_endian(ids.whole(x)), repr(x)


def test_ngrams_do_not_depend_on_steps():
    import numpy as np

    raw = ["größer x", "", "ΑΒΓ हिन्दी 漢字かな", "a" * 50 + " é" * 40, "123 !"]
    data = np.frombuffer("".join(raw).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(x.encode()) for x in raw])])
    one, many = langid.ngrams(data, off), langid.ngrams(data, off, 17)
    assert all((a == b).all() for a, b in zip(one, many, strict=True))
    assert one[3].tolist() == [True, False, True, True, False]
    # counted one by one: every character n-gram of a row
    fold = [[x if (x := chr(int(c))) != " " else " " for c in langid.folded(t.encode())] for t in raw]
    n = [sum(1 for k in (1, 2, 3, 4) for i in range(len(f) - k + 1) if (k != 1 or f[i] != " ") and (k != 4 or f[i] == " " or f[i + 3] == " ")) for f in fold]
    assert [int(one[2][one[0] == r].sum()) for r in range(len(raw))] == n
