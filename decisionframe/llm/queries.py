"""The queries opN_<name> with their production parameters, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, exact_dedup, hard_negatives, jaccard_join, langid, packing, panes, quality, secret_scan, simhash, substring_dedup, suffix_dedup, url_filter
from .common import documents


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(documents(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path())


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_digest(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(documents(spark, sf_dir))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(documents(spark, sf_dir, "pages")).drop("weight")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(documents(spark, sf_dir))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_components(documents(spark, sf_dir))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(documents(spark, sf_dir))


def op12_window_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panes.panes(documents(spark, sf_dir, "clicks"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.prepared(documents(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_packing": op2_packing,
    "op3_quality": op3_quality,
    "op4_decontamination": op4_decontamination,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_secret_scan": op7_secret_scan,
    "op8_language_id": op8_language_id,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_simhash": op11_simhash,
    "op12_window_panes": op12_window_panes,
    "op13_hard_negatives": op13_hard_negatives,
}

def _terms(terms: tuple[str, ...]) -> list[str]:
    return [f"regexp_matches(u, '(^|[^\\p{{L}}]){t}($|[^\\p{{L}}])')" for t in terms]


ORACLE_SQL = {
    "op1_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(generate_series(1, len(w) - 19)) AS i, w FROM d WHERE len(w) >= 20),
k AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) AS n FROM p),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS q FROM k WHERE n > 1),
words AS (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS q FROM d),
left_over AS (SELECT words.doc_id, string_agg(x, ' ' ORDER BY words.q) AS kept, count(*) AS n FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.q = gone.q GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over ON d.doc_id = left_over.doc_id""",
    "op4_decontamination": r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(generate_series(1, greatest(1, len(w) - 9))) AS p FROM bw WHERE len(w) > 0),
bn AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS g FROM bs),
sizes AS (SELECT DISTINCT n FROM bn),
dp AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM dw, sizes WHERE len(w) >= n),
dn AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g FROM dp),
hits AS (SELECT DISTINCT doc_id, item_id, dn.n AS n, p FROM dn JOIN bn ON dn.n = bn.n AND dn.g = bn.g),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words ON dw.doc_id = words.doc_id LEFT JOIN items ON dw.doc_id = items.doc_id""",
    "op5_suffix_dedup": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, h, unnest(generate_series(0, length(h) // 2 - 400)) AS i FROM d WHERE length(h) >= 800),
k AS (SELECT doc_id, i, count(*) OVER (PARTITION BY md5(substr(h, 2 * i + 1, 800))) AS n FROM p),
r AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM k WHERE n > 1),
g AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM g GROUP BY doc_id, run),
gaps AS (SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS low, a AS high FROM spans UNION ALL SELECT doc_id, max(b), CAST(1 AS BIGINT) << 40 FROM spans GROUP BY doc_id),
cut AS (SELECT d.doc_id, string_agg(substr(h, 2 * low + 1, least(2 * (high - low), length(h))), '' ORDER BY low) AS kept FROM d JOIN gaps ON d.doc_id = gaps.doc_id GROUP BY d.doc_id),
n AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS runs FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(runs, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN cut ON d.doc_id = cut.doc_id""",
    "op9_exact_dedup": r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
r AS (SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM t)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r""",
}

ORACLE_SQL["op13_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM v AS a JOIN v AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 3"""
ORACLE_SQL["op10_jaccard_join"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - {jaccard_join.SHINGLE - 1}))) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {jaccard_join.SHINGLE - 1}], ' ') AS g FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM c JOIN n AS m ON m.doc_id = x JOIN n AS o ON o.doc_id = y WHERE 100 * shared >= {jaccard_join.PERCENT} * (m.n + o.n - shared)),
e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT reach.doc_id, b FROM reach JOIN e ON e.a = reach.other)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id"""

_STRICT, _SOFT = (_terms(x) for x in (url_filter.STRICT, url_filter.SOFT))
_HIT = " OR ".join(_STRICT) + " OR " + " + ".join(f"CAST({x} AS INTEGER)" for x in _SOFT) + " >= 2"
ORACLE_SQL["op6_url_filter"] = rf"""
WITH s AS (SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
  CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM s),
r AS (SELECT *, '.' || host AS dotted FROM h),
j AS (SELECT page_id, host, path, CASE
    WHEN dotted LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN dotted LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN dotted LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
    WHEN dotted LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN dotted LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule, {_HIT} AS hit FROM r)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN hit THEN 'block' ELSE 'allow' END AS verdict FROM j"""
