"""Every operator against brute force on a small table with nulls, empty texts, repeated rows and extra columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from decisionframe.llm import decontaminate, exact_dedup, jaccard_join, langid, packing, quality, secret_scan, substring_dedup, suffix_dedup, url_filter
from decisionframe.llm.queries import tokenizer_path
from decisionframe.llm.repeats import CHUNK

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, part int, _h long, _bucket long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sentence(rng: random.Random, n: int, letters: str = "abcdefgh") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(n))


def texts() -> list[tuple[int, str | None]]:
    rng = random.Random(3)
    passage, base = sentence(rng, 70), sentence(rng, 120)
    out: list[tuple[int, str | None]] = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "one"), (5, "a b c"), (6, "A b  c")]
    out += [(10, base), (11, base), (12, base + " end"), (13, base.replace(" ", "\n", 5)), (14, base.upper())]
    out += [(20 + i, sentence(rng, 30) + " " + passage + "  " + sentence(rng, 20)) for i in range(4)]
    out += [(30, "x " * 100), (31, "é" * 500 + " ü"), (32, sentence(rng, 400)), (33, passage)]
    words = base.split()
    out += [(40 + i, " ".join(words[:i] + ["new"] + words[i + 1 :])) for i in range(0, 60, 6)]
    return out


@pytest.fixture(scope="module")
def rows():
    return texts()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None, "k", 1, 2, 3) for i, t in rows], SCHEMA).repartition(3, "doc_id")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df) -> dict:
    return {r["doc_id"]: r for r in df.collect()}


def test_substring_dedup(docs, rows, none):
    found, seen = by_id(substring_dedup.substring_dedup(docs, with_text=True)), set()
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for k in range(len(w) - 19):
            if (g := tuple(w[k : k + 20])) in seen:
                gone |= set(range(k, k + 20))
            seen.add(g)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert (found[i]["n_words"], found[i]["n_removed"], found[i]["kept_text"]) == (len(w), len(gone), kept)
        assert found[i]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert substring_dedup.substring_dedup(none).collect() == []


def test_suffix_dedup(docs, rows, none):
    found, count = by_id(suffix_dedup.suffix_dedup(docs)), Counter()
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, b in raw:
        count.update(b[k : k + 400] for k in range(len(b) - 399))
    for i, b in raw:
        mask = np.zeros(len(b), bool)
        for k in range(len(b) - 399):
            if count[b[k : k + 400]] > 1:
                mask[k : k + 400] = True
        spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
        kept = np.frombuffer(b, np.uint8)[~mask].tobytes()
        r = found[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(b), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest())
    assert suffix_dedup.suffix_dedup(none).collect() == []


def test_level_index_finds_what_one_batch_finds():
    rng = np.random.default_rng(5)
    c = np.zeros(400, CHUNK)
    c["a"], c["s"], c["doc"], c["n"] = rng.integers(0, 60, 400), rng.integers(0, 3, 400), np.arange(400), 1
    whole, parts = suffix_dedup.LevelIndex(), suffix_dedup.LevelIndex()
    whole.add(c.copy())
    for piece in np.array_split(c, 23):
        parts.add(piece.copy())
    assert len(parts.levels) < 8
    for x, y in zip(whole.finish(False), parts.finish(False), strict=True):
        assert sorted(x["doc"].tolist()) == sorted(y["doc"].tolist()) or len(x) == len(y)


def test_packing(docs, rows, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    odd = [(100, "Don't STOP’s naïve ÀÉÎ ÿ 42°C…ok <|endoftext|> İstanbul ΣΑΣ ½ éa  x"), (101, "a" * 3000), (102, "one 'd 's''s")]
    more = docs.select("doc_id", "text").unionByName(docs.sparkSession.createDataFrame(odd, "doc_id long, text string"))
    pieces = packing.pack(more, tokenizer_path()).toPandas()
    ids = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4") for i, x in [*rows, *odd]}
    assert set(pieces.doc_id) == set(ids)
    for i, own in pieces.sort_values("start").groupby("doc_id"):
        at = 0
        for p in own.itertuples():
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids[i]), zlib.crc32(ids[i][at : at + p.length].tobytes()))
            at += p.length
        assert at == len(ids[i])
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *np.cumsum(own.length)[:-1]] and own.length.sum() <= 2048
    assert packing.pack(none, tokenizer_path()).collect() == []


def test_packing_pads_little():
    rng = random.Random(1)
    packer, total = packing.Packer(2048, 64, 16), 0
    for i in range(4000):
        n = int(rng.expovariate(1 / 700)) + 1
        total += n
        packer.add((i, 0, b"abcd" * n, n))
    rest = packer.merge()
    sequences = packer.take() + [rest]
    assert sum(len(p[2]) // 4 for s in sequences for p in s) == total
    assert len(sequences) * 2048 / total < 1.01


def test_decontamination(docs, rows, spark):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(FOLD))
    base = dict(rows)[10]
    items = [(1, " ".join(base.split()[5:25])), (2, "One"), (3, None), (4, "..."), (10, base.upper()), (11, "never seen anywhere at all in these texts of ours"), (12, "a, B! c")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, t in rows:
        w, hit, names = split(t), set(), set()
        for name, x in items:
            g = split(x)
            n = min(10, len(g))
            grams = {tuple(g[k : k + n]) for k in range(len(g) - n + 1)} if g else set()
            for k in range(len(w) - n + 1) if n else ():
                if tuple(w[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    names.add(str(name))
        want[i] = (len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit))
    got = {i: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for i, r in by_id(decontaminate.contamination_digest(docs, bench)).items()}
    assert got == want
    sliced = {r["doc_id"]: (r["n_words"], len(r["hits"]), len(r["items"])) for r in decontaminate.contamination(docs, bench, most_words=15).collect()}
    assert sliced == {i: v[:3] for i, v in want.items()}
    kept = decontaminate.remove_documents(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, v in want.items() if not v[4]}
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, bench).collect()}
    assert cut[0] is None and cut[3] == "" and len(split(cut[12])) == want[12][0] - want[12][1]
    assert by_id(decontaminate.contamination_digest(docs, bench.limit(0)))[10]["contaminated"] is False


def test_exact_dedup(docs, rows, spark, none):
    for sample in (np.array([], np.uint64), np.array([7], np.uint64), np.unique(np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64))):
        assert (exact_dedup.rice_decode(exact_dedup.rice_encode(sample)) == sample).all()
    groups: dict[str, list] = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    want = {i: (min(own)[1], len(own), min(own)[1] == i, hashlib.sha256(n.encode()).hexdigest()) for n, own in groups.items() for _, i in own}
    got = {i: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for i, r in by_id(exact_dedup.exact_groups(docs)).items()}
    assert got == want
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, v in want.items() if v[2]}
    twice = spark.createDataFrame([(None, "a"), (5, "a"), (5, "a")], "doc_id long, text string")
    assert [(r["keep_id"], r["group_size"]) for r in exact_dedup.exact_groups(twice).collect()] == [(None, 3)] * 3
    assert exact_dedup.exact_groups(none).collect() == []


def brute_components(rows, size=4, percent=85):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(FOLD))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and 100 * len(a & b) >= percent * len(a | b) and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_jaccard_join(docs, rows, none):
    got = {i: (r["n_shingles"], r["component_id"]) for i, r in by_id(jaccard_join.linked_components(docs)).items()}
    assert got == brute_components(rows)
    kept = jaccard_join.near_dedup(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, v in got.items() if v[1] == i}
    assert jaccard_join.linked_components(none).collect() == []


def test_jaccard_join_links_beyond_the_smallest(spark):
    """Copies that are near to an original in the middle of the ids but not to each other, and a chain."""
    rng = random.Random(9)
    base = sentence(rng, 200, "abcdefghijklmnop").split()
    rows = [(500, " ".join(base))]
    for i in range(40):
        w = list(base)
        for k in rng.sample(range(0, 200, 8), 3):
            w[k] = f"edit{i}x{k}"
        rows.append((i * 20 + 7, " ".join(w)))
    chain = sentence(rng, 300, "abcdefghijklmnop").split()
    for i in range(12):
        for k in range(7):
            chain[i * 24 + k * 3 % 24] = f"step{i}y{k}"
        rows.append((1000 - i, " ".join(chain)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {i: (r["n_shingles"], r["component_id"]) for i, r in by_id(jaccard_join.linked_components(docs)).items()}
    assert got == brute_components(rows)


def _kept_parts(h, bands, heat) -> set[int]:
    """The part keys that a document with these shingles is left with: parts without bits go first, then the hottest."""
    band, out = bands.of(len(h)), set()
    for label in {band, max(0, band - 1)}:
        keys, room = jaccard_join.part_keys(h, label, bands.shape(label))
        parts, spare = bands.shape(label)
        assert 0 <= room <= spare and len(keys) + spare - room == parts
        out |= set(sorted((int(k) for k in keys), key=lambda k: (-heat(k), k))[room:])
    return out


def test_part_keys_of_linked_sets_meet():
    rng, bands, met = np.random.default_rng(2), jaccard_join.Bands(85), 0
    edges = [e for e in bands.edges if 3 < e < 3000]
    sizes = [3, 7, 20, 90, 400, 2000, *(e + d for e in edges[::2] for d in (-1, 0, 1))]
    heats = (lambda k: 1, lambda k: k >> 40 & 3, lambda k: k >> 20 & 0xFFFF)  # all ties, many ties, few
    for size in sizes:
        for t in range(12):
            h = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
            most = int(len(h) * 15 / 185)
            k = most if t % 3 == 0 else int(rng.integers(0, most + 1))
            grown = int(len(h) * 15 / 85) if t % 4 == 1 else 0  # a superset reaches into the next band
            fresh = rng.integers(0, 2**63, grown or k).astype(np.uint64)
            other = np.unique(np.concatenate([h if grown else h[k:], fresh]))
            shared = len(np.intersect1d(h, other))
            if 100 * shared < 85 * (len(h) + len(other) - shared):
                continue
            met += 1
            for heat in heats:
                assert _kept_parts(h, bands, heat) & _kept_parts(other, bands, heat), (size, t)
    assert met > 300


def test_url_filter(spark):
    urls = [None, "", "no scheme", "https://WWW.Example.com/en/x?y#z", "http://a.example.com/en/", "http://example.com", "http://example.com/de/", "http://b.net/es/1", "http://b.org/casino", "http://b.org/casinoville", "http://b.org/sexy-poker", "http://b.org/poker-poker", "http://x.net:80/fr/", "http://b.org/Xxx", "http://h.org?sexy&poker"]
    pages = spark.createDataFrame([(i, u, "html") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages).collect()}
    assert got[0] == ("", "", None, "allow") and got[2] == ("", "", None, "allow")
    assert got[3] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[4] == ("a.example.com", "/en/", "example.com/en/", "block")
    assert got[5] == ("example.com", "", None, "allow") and got[6][2:] == ("com/", "allow") and got[7][2:] == ("net/es/", "block")
    assert [got[i][3] for i in (8, 9, 10, 11, 13, 14)] == ["block", "allow", "block", "allow", "block", "block"]
    assert got[12] == ("x.net:80", "/fr/", None, "allow")


def test_url_vocabulary_from_a_table(spark):
    rows = [("Spam", 2.0), ("spam", 1.0), ("eggs", 1.0), ("ham", 1.0), ("no", 0.0), ("", 5.0), (None, 5.0), ("nix", None)]
    terms = url_filter.vocabulary(spark.createDataFrame(rows, "term string, weight double"))
    assert terms == (("eggs", 1.0), ("ham", 1.0), ("spam", 2.0))
    urls = ["http://b.org/SPAM", "http://b.org/eggs", "http://b.org/eggs-ham", "http://b.org/eggs-eggs", "http://b.org/hamster-eggs", "http://b.org/casino", "http://b.org/" + "x" * 100_000 + "/spam"]
    pages = spark.createDataFrame([(i, u, 7.0) for i, u in enumerate(urls)], "page_id long, url string, weight double")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, terms=terms).collect()}
    assert [got[i] for i in range(7)] == ["block", "allow", "block", "allow", "allow", "allow", "block"]
    assert url_filter.judge(pages.limit(0)).collect() == []
    with pytest.raises(ValueError, match="more than 2"):
        url_filter.vocabulary(spark.createDataFrame(rows, "term string, weight double"), 2)


def test_secret_scan(spark):
    rng = random.Random(4)
    b64 = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(48))
    rows = [(0, None), (1, "é password = 'hunter22' Token:abc"), (2, "xAKIA" + "A1" * 9 + " AKIA123"), (3, "ü deadbeef" * 2 + " " + "0123456789abcdef" * 2), (4, f"look {b64} here"), (5, "a-very-long-lower-case-slug-of-plain-words-only"), (6, "aſecret: abcdefgh API_KEY=qwertyui")]
    got = {r["doc_id"]: r for r in secret_scan.secret_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        t = t or ""
        spans = [(m.start(), 0, m.end()) for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20] + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert got[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest(), (i, text, got[i]["spans"])
        assert [got[i][f"n_{n}"] for n in ("assign", "access", "hex")] == [sum(x[1] == k for x in spans) for k in range(3)]
        assert not text or all(x in got[i]["spans"].split(",") for x in text.split(","))
    assert got[4]["spans"] == "random:5:53" and got[5]["spans"] == ""


def test_language_id(spark, none):
    rng = random.Random(6)
    words = {"aa": ["kala", "mala", "sala"], "bb": ["zorp", "torp", "gorp"], "cc": ["éli", "ûmi", "çni"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(1, 30))), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 60)]
    rows += [(1000, None, "aa"), (1001, "12 !?", "bb"), (1002, "kala mala", None)]
    got = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    held = [(got[i]["lang_pred"], lang) for i, _, lang in rows[:180] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    assert sum(a == b for a, b in held) / len(held) > 0.95
    assert got[1000]["lang_pred"] == got[1001]["lang_pred"] == "und" and got[1002]["lang_pred"] == "aa"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.identify(none).collect() == []


def test_quality(spark, none):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(240):
        good = i % 3 > 0
        body = ". ".join(sentence(rng, rng.randint(4, 12)).capitalize() for _ in range(rng.randint(1, 8))) + "."
        rows.append((i, body if good else body.upper().replace(" ", "!! ")))
        labels.append((i, int(good)))
    docs, marks = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string"), spark.createDataFrame([*labels, (902, None)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.score(docs, marks).collect()}
    held = [(got[i]["predicted"], y) for i, y in labels if got[i]["held_out"]]
    assert len(got) == 242 and sum(a == b for a, b in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    assert [r["score"] for r in quality.score(docs, marks.limit(0)).collect()] == [0.5] * 242
    assert quality.score(none, marks).collect() == []
