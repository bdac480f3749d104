"""SimHash components, BK-trees and hashes against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from decisionframe.llm import simhash as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, print long, row string, key int"


def fingerprint(text: str | None) -> int:
    words = WORD.findall((text or "").translate(FOLD))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows) -> tuple[list[tuple], list]:
    """(doc_id, fingerprint, component_id) of every row, and the least id of every component."""
    prints, up = [fingerprint(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                up[find(i)] = find(j)
    low = {}
    key = lambda d: (d is not None, d or 0)
    for i, (d, _) in enumerate(rows):
        r = find(i)
        low[r] = min(low.get(r, d), d, key=key) if r in low else d
    return sorted(((d, f"{prints[i]:016x}", low[find(i)]) for i, (d, _) in enumerate(rows)), key=str), sorted(low.values(), key=str)


def table() -> list[tuple]:
    rng = random.Random(5)
    prose = lambda n: " ".join("".join(rng.choice("abcdEFGé") for _ in range(rng.randint(1, 5))) for _ in range(n))
    base = prose(400)
    words = base.split(" ")
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One"), (4, "one"), (5, "a B"), (6, "a  b"), (7, "a b c"), (None, base), (None, prose(9)), (9, base.upper() + " x"), (9, prose(50))]
    rows += [(20 + i, " ".join(words[:i] + ["new"] + words[i + 1 :])) for i in range(0, 300, 7)]
    chain = words
    for i in range(40):  # drifts away
        chain = chain[:]
        chain[(i * 37) % 400] = f"w{i}"
        rows.append((500 - i, "\x0b".join(chain)))
    return rows + [(900, "x " * 5000), (901, "x\x85y z ü"), (901, "x\x85y z ü")]


@pytest.fixture(scope="module")
def rows():
    return table()


def test_components(spark, rows):
    docs = spark.createDataFrame([(d, t, "l", None, 5, "r", 1) for d, t in rows], SCHEMA).repartition(3)
    want, firsts = brute(rows)
    assert len(firsts) < len(rows) - 30
    for blocks, nodes in ((5, S.NODES), (4, 60), (6, 25)):
        got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in S.near_components(docs, blocks=blocks, nodes=nodes).collect()), key=str)
        assert got == want, (blocks, nodes)
    kept = S.near_dedup(docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"] for r in kept.collect()), key=str) == firsts
    assert S.near_components(docs.limit(0)).collect() == []


def test_steps_change_nothing(monkeypatch, rows):
    text = rows[-3][1] + rows[8][1]
    data = text.encode()
    buffer, off = np.frombuffer(data, np.uint8), np.array([0, len(data)])
    starts, ends, _ = S.word_bounds(buffer, off, S.IS_SPACE)
    whole = S._votes(data.lower(), starts, ends, 3)
    monkeypatch.setattr(S, "WORDS", 7)
    cut = S._votes(data.lower(), starts, ends, 3)
    assert whole[1] == cut[1] == len(text.split()) - 2 and (whole[0] == cut[0]).all()


def test_trees_find_what_a_scan_finds(monkeypatch):
    rng = np.random.default_rng(3)
    values = rng.integers(0, 2**64, 300, np.uint64)
    near = values[:60, None] ^ (np.uint64(1) << rng.integers(0, 64, (60, 8)).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, (60, 8)).astype(np.uint64))
    values = np.unique(np.concatenate([values, near.ravel()]))
    entries = np.empty(2 * len(values), S.ENTRY)
    entries["key"], entries["value"] = np.tile(rng.integers(0, 4, len(values)), 2), np.tile(values, 2)  # entries twice are one
    for frontier in (1 << 20, 50):
        monkeypatch.setattr(S, "FRONTIER", frontier)
        trees = S.Trees.load(S.Trees(entries).dump())
        assert len(trees.value) == len(values) and len(trees.child) == len(values) - len(trees.root_node)
        # a child's edge is its distance to the parent
        assert (np.bitwise_count(trees.value[trees.child] ^ trees.value[trees.edge // 65]) == trees.edge % 65).all()
        found = {(int(q), int(n)) for x, y in trees.search(trees.key, trees.value, 3) for q, n in zip(x, y, strict=True)}
        apart = np.bitwise_count(trees.value[:, None] ^ trees.value[None])
        want = {(int(i), int(j)) for i, j in zip(*np.nonzero((apart <= 3) & (trees.key[:, None] == trees.key[None])), strict=True)}
        assert found == want and len(want) > len(values)


def test_masks_meet():
    rng = random.Random(1)
    for radius, blocks in ((3, 4), (3, 5), (3, 6), (2, 5)):
        chosen = S.masks(radius, blocks)
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), radius):
                b ^= 1 << bit
            assert any(a & m == b & m for m in chosen)
