"""URL filters: host and path rules first, then a weighted vocabulary counted by an Aho-Corasick automaton.

A strict term weighs LIMIT, a soft one half of it; each distinct term counts once, and only where no
letter stands right before or after it. A URL whose weight reaches LIMIT is blocked: one strict term
or two distinct soft ones.

Defined cases: a null URL or one without "://" has an empty host and path and is judged by the terms
in it alone; repeated rows are judged one by one; null page_ids stay. A very long URL is one pass of the automaton. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 2
#: The vocabulary, in natural order.
STRICT = ("bestiality", "camgirl", "camgirls", "casino", "casinos", "escort", "escorts", "hentai", "milf", "porn", "porno", "pornstar", "pornography", "redtube", "sexcam", "warez", "xhamster", "xnxx", "xvideos", "xxx", "youporn")
SOFT = ("adult", "babe", "babes", "bet", "betting", "cheap", "click", "crack", "dating", "erotic", "free", "gambling", "girls", "hot", "keygen", "lingerie", "nude", "pills", "poker", "sex", "sexy", "slots", "teen", "torrent", "viagra", "webcam")
#: Host, path and verdict of the rules.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
LOWER = {c: c + 32 for c in range(65, 91)}


Terms = tuple[tuple[str, float], ...]


def weighted(strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT) -> Terms:
    """Terms with their weights; a term in both lists is strict."""
    return tuple(({t: LIMIT / 2 for t in soft} | {t: float(LIMIT) for t in strict}).items())


def vocabulary(table: DataFrame, most: int = 1_000_000) -> Terms:
    """Terms with their weights from a table (term, weight), A-Z lower-cased: null and empty terms, and weights that are null or not
    above 0, have no effect; of a term's weights the largest counts. A table of more than `most` terms raises, as every task gets them."""
    rows = table.select(F.translate("term", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("t"), F.col("weight").cast("double").alias("w")).where("t <> '' and w > 0")
    found = rows.groupBy("t").agg(F.max("w").alias("w")).orderBy("t").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"the vocabulary has more than {most} terms")
    return tuple((r["t"], r["w"]) for r in found)


@cache
def automaton(terms: Terms):
    import ahocorasick

    found = ahocorasick.Automaton()
    for term, weight in terms:
        found.add_word(term, (term, weight))
    if len(found):
        found.make_automaton()
    return found


def weight_of(url: str, terms: Terms | None = None) -> float:
    """The summed weights of the distinct terms in the URL."""
    found = automaton(weighted() if terms is None else terms)
    if not len(found):
        return 0.0
    text = url.translate(LOWER)
    seen = {}
    for end, (term, weight) in found.iter(text):
        start = end + 1 - len(term)
        if not (start and text[start - 1].isalpha()) and not (end + 1 < len(text) and text[end + 1].isalpha()):
            seen[term] = weight
    return sum(seen.values())


def host_and_path(url: str | None) -> tuple[str, str]:
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    tail = rest[end:]
    stop = next((i for i, c in enumerate(tail) if c in "?#"), len(tail))
    return rest[:end].translate(LOWER), tail[:stop]


def rule_for(host: str, path: str, rules: dict[str, list[tuple[str, str]]]) -> tuple[str, str] | None:
    """The longest rule that fits: its string and verdict. Walks the host's own suffixes only."""
    best, at = None, 0
    while host:
        suffix = host[at:]
        for start, verdict in rules.get(suffix, ()):
            if path.startswith(start) and (best is None or len(suffix + start) > len(best[0])):
                best = (suffix + start, verdict)
        at = host.find(".", at) + 1
        if not at:
            break
    return best


def judge(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, terms: Terms | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict and the vocabulary's weight. terms are weighted() words, or a vocabulary()."""
    shared = pages.sparkSession.sparkContext.broadcast(weighted() if terms is None else terms)
    by_host: dict[str, list[tuple[str, str]]] = {}
    for host, path, verdict in rules:
        by_host.setdefault(host, []).append((path, verdict))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for url in batch.column(1).to_pylist():
                host, path = host_and_path(url)
                weight = weight_of(url or "", shared.value)
                rule = rule_for(host, path, by_host)
                verdict = rule[1] if rule else "block" if weight >= LIMIT else "allow"
                for c, v in zip(out, (host, path, rule[0] if rule else None, verdict, weight), strict=True):
                    c.append(v)
            yield pa.record_batch([batch.column(0), *(pa.array(c, pa.string()) for c in out[:4]), pa.array(out[4], pa.float64())], names=["page_id", "host", "path", "rule", "verdict", "weight"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url").mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, weight double")
