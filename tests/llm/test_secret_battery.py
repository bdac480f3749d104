"""The battery and its false-discovery control: planted random strings are found, ordinary long runs are left alone."""

from __future__ import annotations

import random
import string

import numpy as np

from decisionframe.llm import secret_scan as S

ALPHABETS = {"base64": string.ascii_letters + string.digits + "+/", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "HEX": "0123456789ABCDEF"}
ORDINARY = ["internationalization", "a-very-long-lower-case-slug-of-plain-words-only", "getUserNameFromDatabaseConnection", "COUNTERREVOLUTIONARIES", "========================", "src/main/resources/application/config", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "1234567890123456789012345678901234567890"]
WORDS = ["the", "quick", "brown", "fox", "jumps", "over", "a", "lazy", "dog", "and", "Then", "sleeps", "under", "Trees", "until", "morning"]


def test_tails():
    assert abs(S.binomial_tail(10, 7, 0.5) - 176 / 1024) < 1e-12 and S.binomial_tail(10, 0, 0.2) == 1.0
    rng = np.random.default_rng(5)
    p = []
    for _ in range(2000):
        seen = np.bincount(rng.integers(0, 64, 40), minlength=64)
        p.append(S.uniform_tail(float((seen * (seen - 1)).sum()), 40, 64))
    assert 0.03 < np.mean(np.array(p) < 0.05) < 0.08


def test_overlaps():
    rng = random.Random(2)
    for _ in range(300):
        spans = [(a := rng.randint(0, 50), 0, a + rng.randint(1, 12)) for _ in range(rng.randint(0, 6))]
        start = rng.randint(0, 50)
        end = start + rng.randint(1, 12)
        assert S.overlaps(S.merged(spans), start, end) == any(a < end and start < b for a, _, b in spans)


def test_counts_match_brute_force():
    rows = [b"", b"ab cd", b"Ef", "é gh-i".encode(), b"", b"0123456789abcdefghijk", b"xy", b""]
    data, off = np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)])
    starts, ends, _ = S.word_bounds(data, off, S.NOT_TOKEN)
    long = ends - starts >= S.LEAST_TOKEN
    letters, pairs, changes, product = S._counts(data, off, starts[long], ends[long])
    assert [int(x) if np.isscalar(x) else x.tolist() for x in S._counts(data[:0], np.zeros(2, np.int64), starts[:0], ends[:0])][1:] == [0, 0, 0]
    runs = [b"ab", b"cd", b"Ef", b"gh-i", b"xy"]
    places = [[S.BASE64.index(c) for c in r.translate(S.URL_SAFE)] for r in runs]
    neighbours = [(a, b) for p in places for a, b in zip(p[:-1], p[1:], strict=True)]
    assert letters.sum() == sum(map(len, runs)) and pairs == len(neighbours)
    assert changes == sum((a >= 32) != (b >= 32) for a, b in neighbours) and product == sum(a * b for a, b in neighbours)


def test_planted(spark):
    rng = random.Random(8)
    rows, planted = [], {}
    for i in range(600):
        words = [rng.choice(WORDS) for _ in range(30)]
        if i % 3 == 0:
            name = rng.choice(list(ALPHABETS))
            planted[i] = "".join(rng.choice(ALPHABETS[name]) for _ in range(rng.choice((32, 40, 64, 120))))
            words[10] = planted[i]
        elif i % 3 == 1:
            words[10] = rng.choice(ORDINARY)
        rows.append((i, " ".join(words)))
    got = {r["doc_id"]: r["spans"] for r in S.secret_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    caught = sum(got[i] == f"random:{texts[i].index(s)}:{texts[i].index(s) + len(s)}" for i, s in planted.items())
    false = sum("random" in got[i] for i in texts if i not in planted)
    print("caught", caught, "of", len(planted), "false", false)
    assert caught >= 0.9 * len(planted) and false <= 0.02 * caught + 1


def test_empty_null_and_long(spark):
    schema = "doc_id long, text string, found string, base string, counted string, band int"
    assert S.secret_digest(spark.createDataFrame([], schema)).collect() == []
    long = "word " * 200_000 + "passwd=abcdef12"
    got = {r["doc_id"]: r for r in S.secret_digest(spark.createDataFrame([(None, None, "x", "y", "z", 1), (1, "", "x", "y", "z", 1), (2, long, None, None, None, None)], schema)).collect()}
    assert got[None]["spans"] == got[1]["spans"] == "" and got[2]["spans"] == f"assign:1000000:{len(long)}"


def test_paths_and_names_are_ordinary(spark):
    rng = random.Random(7)
    words = "usr local share lib core pkg main config build target node modules dist web assets static include kernel drivers net system common utils service model README v2 x86 2024 release client docs".split()
    made = {
        "path": lambda: "/" + "/".join("-".join(rng.choices(words, k=rng.choice((1, 1, 2, 5)))) for _ in range(rng.randint(3, 6))),
        "snake": lambda: "_".join(rng.choices(words, k=rng.randint(5, 7))), "slug": lambda: "-".join(rng.choices(words, k=rng.randint(5, 8))) + "-" + str(rng.randint(1, 99999)),
        "secret": lambda: "".join(rng.choices(string.ascii_letters + string.digits, k=rng.randint(24, 40))),
    }
    rows = [(i, kind, f"see {made[kind]()} and the rest of it") for i, kind in enumerate(list(made) * 100)]
    got = S.secret_digest(spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")).where("spans like '%random%'").collect()
    hit = [rows[r["doc_id"]][1] for r in got]
    assert hit.count("secret") >= 97 and hit.count("path") <= 3 and len(hit) - hit.count("secret") <= 15, {k: hit.count(k) for k in made}
