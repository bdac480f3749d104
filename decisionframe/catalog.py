"""Named queries over the test tables, each with its DuckDB twin where SQL can express it."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import arrays as A
from .functions import text as X
from .functions.hashing import keyed, u01
from .operators import augment, calibrate, corpus, coverage, dedup, filters, graph, metrics, reports, sampling, statistics
from .plans import build as plan
from .schema import invalid_reason
from .sources import mappers as M
from .sources.readers import distinct_values

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def workers_import(spark: SparkSession) -> None:
    """Python workers find this package where the driver has it."""
    top, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if top not in (path := env.get("PYTHONPATH", "")).split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (top, path) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table whose rows are dealt out to tasks, for work on each row that its file's row groups would give to a few."""
    return dedup.spread(table(spark, sf_dir, name), key)


def query(name: str, sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


# Pieces of SQL that several twins share.
def h60(x: str) -> str:
    return f"CAST('0x' || substr(md5({x}), 1, 15) AS BIGINT)"


def sql_u01(x: str) -> str:
    return f"(({h60(x)} % 100000) / 100000.0)"


SPACE = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_norm(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower(coalesce({x}, '')), '[^\p{{L}}\p{{N}}_\t\n\x0B\f\r ]', ' ', 'g'), '[\t\n\x0B\f\r ]+', ' ', 'g'))"


def sql_clean(x: str, most: int) -> str:
    s = rf"regexp_replace(regexp_replace(coalesce({x}, ''), '\r\n?', chr(10), 'g'), '[\x00-\x08\x0B-\x1F]', '', 'g')"
    s = rf"regexp_replace(regexp_replace({s}, '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')"
    s = sql_strip(s)
    cut = f"left({s}, {most})"
    return f"(CASE WHEN length({s}) > {most} THEN regexp_replace(CASE WHEN instr(reverse({cut}), ' ') > 0 AND {most} - instr(reverse({cut}), ' ') > {0.8 * most} THEN left({s}, {most} - instr(reverse({cut}), ' ')) ELSE {cut} END, '{SPACE}+$', '', 'g') || ' ...' ELSE {s} END)"


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_by_hash(values: str, key: str) -> str:
    """The list ordered by the hash of key:value."""
    return f"list_transform(list_sort(list_transform({values}, lambda o: {{'h': {h60(f'{key} || chr(58) || o')}, 'o': o}})), lambda s: s.o)"


def sql_subset(correct: str, pool: str, k: int, key: str) -> str:
    others = f"({sql_by_hash(f'list_filter({pool}, lambda p: p <> {correct})', f"'sub:' || {key}")})[1:{k - 1}]"
    return f"(CASE WHEN len({pool}) <= {k} THEN {pool} ELSE {sql_by_hash(f'list_append({others}, {correct})', f"'mix:' || {key}")} END)"


# --- text and hashing -------------------------------------------------------------------------------------------------


@query("norm_text_docs", f"SELECT doc_id, md5({sql_norm('text')}) AS norm FROM documents")
def norm_text_docs(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(X.norm_text(F.col("text"))).alias("norm"))


@query("clean_text_docs", f"SELECT doc_id, {sql_clean('text', 300)} AS cleaned FROM documents")
def clean_text_docs(spark, d):
    return table(spark, d, "documents").select("doc_id", X.clean_text(F.col("text"), 300).alias("cleaned"))


@query("humanize_names", r"SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(p_name || '_' || p_type || '-camelCase', '[_-]', ' ', 'g'), '([a-z])([A-Z])', '\1 \2', 'g'), '[\t\n\f\r ]+', ' ', 'g')) AS shown FROM part")
def humanize_names(spark, d):
    return table(spark, d, "part").select("p_partkey", X.humanize(F.concat("p_name", F.lit("_"), "p_type", F.lit("-camelCase"))).alias("shown"))


@query("stable_hash_split", f"SELECT doc_id, {h60("'split:' || doc_id || ':1234'")} AS h, CASE WHEN {sql_u01("'split:' || doc_id || ':1234'")} < 0.03 THEN 'test' WHEN {sql_u01("'split:' || doc_id || ':1234'")} < 0.06 THEN 'val' ELSE 'train' END AS split FROM documents")
def stable_hash_split(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", keyed("split", F.col("doc_id"), "1234").alias("h"), sampling.split_of(F.col("doc_id"), F.lit("")).alias("split"))


@query("strip_page_tags", r"SELECT page_id, md5(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[\t\n\x0B\f\r ]+', ' ', 'g'))) AS body FROM pages")
def strip_page_tags(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(X.strip_tags(F.col("html"))).alias("body"))


# --- mappers ----------------------------------------------------------------------------------------------------------
def shown(df: DataFrame) -> DataFrame:
    return df.select("id", "type", F.md5("state").alias("state_md5"), "question", F.array_join("options", "|").alias("options"), F.array_join("answer", ",").alias("answer"))


TOXIC = ["Is this text toxic?", "Would a moderator remove this text?"]


def sql_pick(values, key: str) -> str:
    return f"({sql_list(values)})[1 + {h60(f"'question:' || {key}")} % {len(values)}]"


@query(
    "map_binary_toxic",
    f"""SELECT 'toxic:' || d.doc_id AS id, 'binary' AS type, md5({sql_clean(sql_strip('text'), 3000)}) AS state_md5, {sql_pick(TOXIC, "('toxic:' || d.doc_id)")} AS question, 'yes|no' AS options, CASE WHEN toxic = 1 THEN '0' ELSE '1' END AS answer
FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE toxic IS NOT NULL AND {sql_strip('text')} <> ''""",
)
def map_binary_toxic(spark, d):
    return shown(toxic_records(spark, d))


def toxic_records(spark, d):
    docs = dealt(spark, d, "documents", "doc_id").join(table(spark, d, "labels"), "doc_id")
    return M.binary(docs, "toxic", "doc_id", ["text"], "toxic", 1, TOXIC)


@query("map_binary_banded", "SELECT 'band:' || event_id AS id, CASE WHEN value >= 60 THEN '0' ELSE '1' END AS answer FROM events WHERE (value >= 60 OR value <= 20) AND event_type <> ''")
def map_binary_banded(spark, d):
    return M.binary(table(spark, d, "events"), "band", "event_id", ["event_type"], "value", M.banded(20, 60), ["Is the value of this event high?"]).select("id", F.array_join("answer", ",").alias("answer"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "map_classes_segment",
    f"""WITH p AS (SELECT 'segment:' || c_custkey AS id, c_mktsegment AS c, {sql_subset('c_mktsegment', sql_list(SEGMENTS), 3, "('segment:' || c_custkey)")} AS o FROM customer WHERE list_contains({sql_list(SEGMENTS)}, c_mktsegment))
SELECT id, array_to_string(list_transform(o, lambda x: trim(x)), '|') AS options, CAST(list_position(o, c) - 1 AS VARCHAR) AS answer FROM p""",
)
def map_classes_segment(spark, d):
    out = M.classes(dealt(spark, d, "customer", "c_custkey"), "segment", "c_custkey", ["c_name"], "c_mktsegment", ["Which market segment is this customer in?"], SEGMENTS, most=3)
    return out.select("id", F.array_join("options", "|").alias("options"), F.array_join("answer", ",").alias("answer"))


LANGS = ["de", "en", "es", "fr"]


@query("map_classes_lang_subset", f"""SELECT 'lang:' || doc_id AS id, array_to_string({sql_list(['German', 'English', 'Spanish', 'French'])}, '|') AS options, CAST(list_position({sql_list(LANGS)}, lang) - 1 AS VARCHAR) AS answer FROM documents WHERE list_contains({sql_list(LANGS)}, lang) AND {sql_strip('text')} <> ''""")
def map_classes_lang_subset(spark, d):
    out = M.classes(dealt(spark, d, "documents", "doc_id"), "lang", "doc_id", ["text"], "lang", ["Which language is this text in?"], LANGS, rename={"de": "German", "en": "English", "es": "Spanish", "fr": "French"})
    return out.select("id", F.array_join("options", "|").alias("options"), F.array_join("answer", ",").alias("answer"))


@query("map_score_priority", "SELECT 'priority:' || o_orderkey AS id, '1|2|3|4|5' AS options, CAST(CAST(left(o_orderpriority, 1) AS INTEGER) - 1 AS VARCHAR) AS answer FROM orders WHERE TRY_CAST(left(o_orderpriority, 1) AS INTEGER) BETWEEN 1 AND 5")
def map_score_priority(spark, d):
    return priority_records(spark, d).select("id", F.array_join("options", "|").alias("options"), F.array_join("answer", ",").alias("answer"))


def priority_records(spark, d):
    orders = dealt(spark, d, "orders", "o_orderkey").withColumn("_text", F.concat_ws(" ", F.lit("Order of status"), "o_orderstatus", F.lit("and total"), F.col("o_totalprice").cast("decimal(18,2)").cast("string")))
    return M.score(orders, "priority", "o_orderkey", ["_text"], F.substring("o_orderpriority", 1, 1), 1, 5, ["How urgent is this order, 1 being most urgent?"])


@query("map_multi_flags", f"""SELECT 'flags:' || d.doc_id AS id, len(list_filter(['good', 'toxic'], lambda x: (x = 'good' AND quality = 1) OR (x = 'toxic' AND toxic = 1))) AS n_true, least(quality + toxic, 3) AS bucket FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL AND toxic IS NOT NULL AND {sql_strip('text')} <> ''""")
def map_multi_flags(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    out = M.multi_labels(docs, "flags", "doc_id", ["text"], M.flags({"quality": "good", "toxic": "toxic"}), ["good", "toxic"], ["Which of these apply to the text?"])
    return out.select("id", F.size("answer").cast("long").alias("n_true"), F.col("bucket").cast("long").alias("bucket"))


@query("map_multi_types_per_user", """WITH u AS (SELECT user_id, list_sort(list_distinct(list(event_type))) AS t FROM events WHERE event_type IS NOT NULL GROUP BY user_id), pool AS (SELECT list_sort(list_distinct(list(event_type))) AS p FROM events)
SELECT 'user:' || user_id AS id, len(t) AS n_true FROM u, pool WHERE len(t) <= 7 AND len(p) > 1""")
def map_multi_types_per_user(spark, d):
    events = table(spark, d, "events").where("event_type is not null")
    pool = distinct_values(events, "event_type", most=1000)["event_type"]
    users = events.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("seen")).withColumn("_text", F.concat(F.lit("user "), F.col("user_id").cast("string")))
    out = M.multi_labels(users, "user", "user_id", ["_text"], F.col("seen"), pool, ["Which events has this user caused?"], most=8, none_rate=0.0)
    return out.select("id", F.size("answer").cast("long").alias("n_true"))


@query(
    "map_pairwise_turns",
    f"""WITH t AS (SELECT conv_id, {sql_strip('text')} AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations WHERE role = 'assistant'),
p AS (SELECT a.conv_id, a.text AS good, b.text AS bad FROM t a JOIN t b ON a.conv_id = b.conv_id AND a.k = 1 AND b.k = 2)
SELECT 'pair:' || conv_id AS id, CAST({h60("'coin:pair:' || conv_id")} % 2 AS VARCHAR) AS answer FROM p WHERE good <> '' AND bad <> '' AND good <> bad""",
)
def map_pairwise_turns(spark, d):
    turns = table(spark, d, "conversations").where("role = 'assistant'").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t")).where(F.size("t") > 1)
    out = M.pairwise(turns, "pair", "conv_id", F.lit("Continue the conversation."), F.get("t", F.lit(0))["text"], F.get("t", F.lit(1))["text"], ["Which response came first?"])
    return out.select("id", F.array_join("answer", ",").alias("answer"))


@query("map_json_choice", """SELECT 'json:' || event_id AS id, 'k0|k1|k2|none' AS options, '3' AS answer FROM events WHERE props IS NOT NULL""")
def map_json_choice(spark, d):
    events = table(spark, d, "events").where("props is not null").withColumn("choices", F.struct(M.words(["k0", "k1", "k2", "none"]).alias("text"), M.words(["A", "B", "C", "D"]).alias("label"))).withColumns({"right": F.lit("D"), "asked": F.lit("Which key does the object lack?")})
    out = M.mcq_choices(events, "json", "event_id", "asked", "choices", "right", "props")
    return out.select("id", F.array_join("options", "|").alias("options"), F.array_join("answer", ",").alias("answer"))


@query(
    "validate_reasons",
    """SELECT CASE o_orderkey % 6 WHEN 0 THEN 'bad_type' WHEN 1 THEN 'duplicate_options' WHEN 2 THEN 'answer_range' WHEN 3 THEN 'short_question' WHEN 4 THEN 'score_not_consecutive' ELSE 'ok' END AS reason, count(*) AS n
FROM orders WHERE TRY_CAST(left(o_orderpriority, 1) AS INTEGER) BETWEEN 1 AND 5 GROUP BY 1""",
)
def validate_reasons(spark, d):
    fault = F.split_part("id", F.lit(":"), F.lit(2)).cast("long") % 6
    rows = priority_records(spark, d).withColumn("_f", fault)
    rows = rows.withColumns(
        {
            "type": F.when(F.col("_f") == 0, "free").otherwise(F.col("type")),
            "options": F.when(F.col("_f") == 1, M.words(["1", " 1!", "3", "4", "5"])).when(F.col("_f") == 4, M.words(["1", "2", "4", "5", "6"])).otherwise(F.col("options")),
            "answer": F.when(F.col("_f") == 2, F.array(F.lit(7))).otherwise(F.col("answer")),
            "question": F.when(F.col("_f") == 3, "Why? ok").otherwise(F.col("question")),
        }
    )
    return rows.select(invalid_reason().alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


# --- sampling, dedup, build -------------------------------------------------------------------------------------------


@query(
    "balanced_round_robin",
    """WITH k AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS k, min(o_orderkey) OVER (PARTITION BY o_orderpriority) AS f FROM orders)
SELECT o_orderkey, o_orderpriority FROM k ORDER BY k, f LIMIT 500""",
)
def balanced_round_robin(spark, d):
    return sampling.round_robin(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey", 500)


@query("bounded_scan", f"SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY {h60("'scan:1234:' || (l_orderkey * 8 + l_linenumber)")}, l_orderkey * 8 + l_linenumber LIMIT 1000")
def bounded_scan(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"))
    return sampling.bounded_scan(rows, "k", 1000).drop("k")


@query("sample_per_source", f"SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY {h60("'sample:1234:' || doc_id")}, doc_id) AS k FROM documents) WHERE k <= 10")
def sample_per_source(spark, d):
    return sampling.sample_per_group(table(spark, d, "documents").select("source", "doc_id"), "source", "doc_id", 10)


def document_records(spark, d) -> DataFrame:
    docs = dealt(spark, d, "documents", "doc_id")
    out = M.classes(docs, "doc", "doc_id", ["text"], "lang", ["Which language is this text in?"], LANGS)
    return out.withColumns({"source_rank": F.lit(0), "row_ord": F.split_part("id", F.lit(":"), F.lit(2)).cast("long")})


@query("exact_dedup_first_wins", f"SELECT min(doc_id) AS doc_id FROM documents WHERE list_contains({sql_list(LANGS)}, lang) AND {sql_strip('text')} <> '' GROUP BY {sql_norm(sql_clean(sql_strip('text'), 3000))}")
def exact_dedup_first_wins(spark, d):
    rows = dedup.first_wins(document_records(spark, d), dedup.record_key(), "source_rank", "row_ord")
    return rows.select(F.col("row_ord").alias("doc_id"))


SIGNATURES = f"""w AS (SELECT doc_id, list_filter(string_split({sql_norm('text')}, ' '), lambda x: x <> '') AS w, {h60(sql_norm('text'))} AS ex FROM documents),
g AS (SELECT doc_id, ex, unnest(list_transform(generate_series(1, greatest(len(w) - 2, 1)), lambda i: array_to_string(w[i:i + 2], ' '))) AS g FROM w),
m AS (SELECT doc_id, ex, CAST('0x' || substr(md5(g), 1, 8) AS BIGINT) AS h, CAST('0x' || substr(md5(g), 9, 8) AS BIGINT) AS l FROM g),
b AS (SELECT doc_id, ex, {", ".join(f"sum((h >> {b}) & 1) * 2 > count(*) AS h{b}, sum((l >> {b}) & 1) * 2 > count(*) AS l{b}" for b in range(32))} FROM m GROUP BY doc_id, ex),
sig AS (SELECT doc_id, ex, {" + ".join(f"CAST(h{b} AS BIGINT) * {1 << b}" for b in range(32))} AS hi, {" + ".join(f"CAST(l{b} AS BIGINT) * {1 << b}" for b in range(32))} AS lo FROM b)"""


def document_signatures(spark, d):
    return dedup.signatures(table(spark, d, "documents"), F.col("text"), "doc_id")


@query("simhash_signatures", f"WITH {SIGNATURES} SELECT doc_id, CAST(hi AS BIGINT) AS hi, CAST(lo AS BIGINT) AS lo FROM sig")
def simhash_signatures(spark, d):
    return document_signatures(spark, d).select("doc_id", "hi", "lo")


@query(
    "simhash_pairs",
    f"""WITH {SIGNATURES}, r AS (SELECT hi, lo, min(doc_id) AS doc_id FROM sig GROUP BY hi, lo)
SELECT a.doc_id AS a, b.doc_id AS b, CAST(bit_count(CAST(xor(a.hi, b.hi) AS BIGINT)) + bit_count(CAST(xor(a.lo, b.lo) AS BIGINT)) AS BIGINT) AS bits FROM r a JOIN r b ON a.doc_id < b.doc_id WHERE bit_count(CAST(xor(a.hi, b.hi) AS BIGINT)) + bit_count(CAST(xor(a.lo, b.lo) AS BIGINT)) <= 3
UNION ALL SELECT r.doc_id, s.doc_id, 0 FROM sig s JOIN r ON s.hi = r.hi AND s.lo = r.lo AND s.doc_id > r.doc_id""",
)
def simhash_pairs(spark, d):
    return dedup.near_pairs(dedup.shared_table(document_signatures(spark, d), "signatures"), "doc_id").select("a", "b", F.col("bits").cast("long").alias("bits"))


KEPT = f"""WITH RECURSIVE {SIGNATURES}, r AS (SELECT CAST(hi AS BIGINT) AS hi, CAST(lo AS BIGINT) AS lo, min(doc_id) AS doc_id FROM sig GROUP BY ALL),
near AS (SELECT b.doc_id AS doc_id, list(a.doc_id) AS before, row_number() OVER (ORDER BY b.doc_id) AS k FROM r AS a JOIN r AS b ON a.doc_id < b.doc_id AND bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)) <= 3 GROUP BY b.doc_id),
fold AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS gone UNION ALL SELECT near.k, CASE WHEN len(list_filter(before, lambda x: NOT list_contains(gone, x))) > 0 THEN list_append(gone, doc_id) ELSE gone END FROM fold JOIN near ON near.k = fold.k + 1)
SELECT doc_id FROM r WHERE NOT list_contains((SELECT arg_max(gone, k) FROM fold), doc_id)"""


@query("near_dup_kept", KEPT)
def near_dup_kept(spark, d):
    return dedup.near_kept(dedup.shared_table(document_signatures(spark, d), "signatures"), "doc_id")


@query("option_shuffle_invariant", f"""SELECT 'segment:' || c_custkey AS id, trim(c_mktsegment) AS shown FROM customer WHERE list_contains({sql_list(SEGMENTS)}, c_mktsegment)""")
def option_shuffle_invariant(spark, d):
    rows = M.classes(table(spark, d, "customer"), "segment", "c_custkey", ["c_name"], "c_mktsegment", ["Which market segment is this customer in?"], SEGMENTS)
    return sampling.shuffle_options(rows).select("id", F.get("options", F.get("answer", F.lit(0))).alias("shown"))


def all_records(spark, d) -> DataFrame:
    docs, orders = document_records(spark, d), priority_records(spark, d)
    ranked = lambda df, k: df.withColumns({"source_rank": F.lit(k), "row_ord": F.split_part("id", F.lit(":"), F.lit(2)).cast("long")})  # noqa: E731
    customers = M.classes(dealt(spark, d, "customer", "c_custkey"), "segment", "c_custkey", ["c_name"], "c_mktsegment", ["Which market segment is this customer in?"], SEGMENTS)
    synth = M.classes(dealt(spark, d, "part", "p_partkey"), "part", "p_partkey", ["p_name"], "p_brand", ["Which brand is this part of?"], [f"Brand#{i}{j}" for i in range(1, 6) for j in range(1, 6)]).withColumn("kind", F.lit("synth"))
    return docs.unionByName(ranked(orders, 1)).unionByName(ranked(customers, 2)).unionByName(ranked(synth, 3))


CONFIG = plan.Config(held_out=("segment",))
BUILT = f"""r AS (SELECT 'doc:' || min(doc_id) AS id, 'doc' AS source, 'real' AS kind, 'choice' AS type FROM documents WHERE list_contains({sql_list(LANGS)}, lang) AND {sql_strip('text')} <> '' GROUP BY {sql_norm(sql_clean(sql_strip('text'), 3000))}
UNION ALL SELECT 'priority:' || min(o_orderkey), 'priority', 'real', 'score' FROM orders WHERE TRY_CAST(left(o_orderpriority, 1) AS INTEGER) BETWEEN 1 AND 5 GROUP BY o_orderstatus, CAST(o_totalprice AS DECIMAL(18, 2))
UNION ALL SELECT 'segment:' || min(c_custkey), 'segment', 'real', 'choice' FROM customer WHERE list_contains({sql_list(SEGMENTS)}, c_mktsegment) GROUP BY {sql_norm('c_name')}),
s AS (SELECT *, CASE WHEN source = 'segment' THEN 'zeroshot' WHEN {sql_u01("'split:' || id || ':1234'")} < 0.03 THEN 'test' WHEN {sql_u01("'split:' || id || ':1234'")} < 0.06 THEN 'val' ELSE 'train' END AS split FROM r)"""


@query("build_split_stats", f"WITH {BUILT} SELECT split, type, count(*) AS n, count(*) FILTER (kind = 'synth') AS synthetic FROM s GROUP BY split, type")
def build_split_stats(spark, d):
    return plan.split_stats(plan.build(all_records(spark, d).where("kind = 'real'"), CONFIG, texts=False))


@query("build_per_source", f"WITH {BUILT} SELECT source, count(*) AS n FROM s GROUP BY source")
def build_per_source(spark, d):
    return plan.source_stats(plan.build(all_records(spark, d).where("kind = 'real'"), CONFIG, texts=False))


@query("build_with_synthetic")
def build_with_synthetic(spark, d):
    return plan.split_stats(plan.build(all_records(spark, d), CONFIG, texts=False))


@query("hard_targets", """SELECT o_orderkey, round(CASE k WHEN 0 THEN .97 * .85 + .006 WHEN 1 THEN .97 * (CASE WHEN p IN (0, 4) THEN .15 ELSE .075 END) + .006 ELSE .006 END, 6) AS beside, round(.97 * .85 + .006, 6) AS own
FROM (SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS INTEGER) - 1 AS p, 1 AS k FROM orders WHERE TRY_CAST(left(o_orderpriority, 1) AS INTEGER) BETWEEN 1 AND 5)""")
def hard_targets(spark, d):
    t = A.hard_target(F.col("type"), F.size("options"), F.col("answer"))
    a = F.get("answer", F.lit(0))
    rows = priority_records(spark, d).withColumn("t", t)
    return rows.select(F.split_part("id", F.lit(":"), F.lit(2)).cast("long").alias("o_orderkey"), F.round(F.get("t", F.when(a == 4, a - 1).otherwise(a + 1)), 6).alias("beside"), F.round(F.get("t", a), 6).alias("own"))


# --- predictions from embeddings: z_k = 50 * dot(embedding, mean embedding of label k) -----------------------------------
PRED = """c AS (SELECT label AS k, i, avg(x) AS m FROM (SELECT label, unnest(embedding) AS x, unnest(generate_series(1, len(embedding))) AS i FROM embeddings) GROUP BY label, i),
e AS (SELECT vec_id, label, unnest(embedding) AS x, unnest(generate_series(1, len(embedding))) AS i FROM embeddings),
dots AS (SELECT vec_id, label, k, 50 * sum(x * m) AS z FROM e JOIN c USING (i) GROUP BY vec_id, label, k),
z AS (SELECT vec_id, label AS a, list(z ORDER BY k) AS z FROM dots GROUP BY vec_id, label),
pr AS (SELECT vec_id, a, z, list_transform(z, lambda x: exp(x - list_max(z)) / list_sum(list_transform(z, lambda y: exp(y - list_max(z))))) AS p FROM z),
s1 AS (SELECT *, list_max(p) AS conf, CAST(list_position(p, list_max(p)) - 1 = a AS DOUBLE) AS correct, -ln(greatest(p[a + 1], 1e-12)) AS nll,
  list_sum(list_transform(generate_series(1, len(p)), lambda i: pow(p[i] - CASE WHEN i = a + 1 THEN 1 ELSE 0 END, 2))) AS brier, 'src' || (vec_id % 4) AS source FROM pr)"""
MULTI = """, m1 AS (SELECT vec_id, 'src' || (vec_id % 4) AS source, list_transform(z, lambda x: 1 / (1 + exp(-greatest(least(x / 10 - 1.5, 60), -60)))) AS p, list_transform(generate_series(0, len(z) - 1), lambda i: CASE WHEN i = a OR i = (a * 3 + 1) % 10 THEN 1 ELSE 0 END) AS y FROM pr),
mo AS (SELECT vec_id, source, unnest(p) AS p, unnest(y) AS y, unnest(generate_series(0, len(p) - 1)) AS label FROM m1),
mr AS (SELECT vec_id, any_value(source) AS source, CAST(bool_and((p >= .5) = (y = 1)) AS DOUBLE) AS exact, avg(-(ln(greatest(p, 1e-12)) * y + ln(greatest(1 - p, 1e-12)) * (1 - y))) AS nll FROM mo GROUP BY vec_id)"""


def logits(spark, d) -> DataFrame:
    """vec_id, a, z. The centroids are one row of labels * dimensions numbers, which does not grow with the rows."""
    emb = table(spark, d, "embeddings")
    parts = emb.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    centroids = parts.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("c"))
    one = centroids.agg(F.transform(F.array_sort(F.collect_list(F.struct("label", "c"))), lambda s: s["c"]).alias("cs"))
    dot = lambda c: 50.0 * A.total(F.zip_with("embedding", c, lambda x, m: x.cast("double") * m))  # noqa: E731
    return emb.crossJoin(F.broadcast(one)).select("vec_id", F.col("label").cast("int").alias("a"), F.transform("cs", dot).alias("z"))


def single_predictions(spark, d) -> DataFrame:
    rows = logits(spark, d)
    return rows.select(F.col("vec_id").alias("id"), F.lit("choice").alias("type"), F.concat(F.lit("src"), (F.col("vec_id") % 4).cast("string")).alias("source"), "a", "z", A.softmax(F.col("z")).alias("p"), F.lit(None).cast("array<int>").alias("y"))


def multi_predictions(spark, d) -> DataFrame:
    label = F.col("label_")
    y = F.transform(F.sequence(F.lit(0), F.size("z") - 1), lambda i: ((i == label) | (i == (label * 3 + 1) % 10)).cast("int"))
    rows = logits(spark, d).withColumnRenamed("a", "label_").withColumns({"z": F.transform("z", lambda x: x / 10 - 1.5), "y": y})
    return rows.select(F.col("vec_id").alias("id"), F.lit("multi").alias("type"), F.concat(F.lit("src"), (F.col("vec_id") % 4).cast("string")).alias("source"), F.lit(None).cast("int").alias("a"), "z", A.sigmoid(F.col("z")).alias("p"), "y")


def r6(name: str):
    return F.round(name, 6).alias(name)


@query("softmax_probs", f"WITH {PRED} SELECT vec_id, round(p[1], 6) AS p0, round(p[10], 6) AS p9, round(list_sum(p), 6) AS total FROM pr")
def softmax_probs(spark, d):
    return single_predictions(spark, d).select(F.col("id").alias("vec_id"), F.round(F.get("p", F.lit(0)), 6).alias("p0"), F.round(F.get("p", F.lit(9)), 6).alias("p9"), F.round(A.total(F.col("p")), 6).alias("total"))


@query("sigmoid_probs", f"WITH {PRED}{MULTI} SELECT vec_id, round(p[1], 6) AS p0, round(list_sum(p), 6) AS total FROM m1")
def sigmoid_probs(spark, d):
    return multi_predictions(spark, d).select(F.col("id").alias("vec_id"), F.round(F.get("p", F.lit(0)), 6).alias("p0"), F.round(A.total(F.col("p")), 6).alias("total"))


@query("concentration", f"WITH {PRED} SELECT vec_id, round(greatest(0, 1 + list_sum(list_transform(p, lambda x: greatest(x, 1e-12) * ln(greatest(x, 1e-12)))) / ln(len(p))), 6) AS c FROM pr")
def concentration(spark, d):
    return single_predictions(spark, d).select(F.col("id").alias("vec_id"), F.round(A.concentration(F.col("p")), 6).alias("c"))


@query("expected_level", f"WITH {PRED} SELECT vec_id, round(list_sum(list_transform(generate_series(1, len(p)), lambda i: p[i] * (i - 1))), 6) AS level, CAST(list_position(p, list_max(p)) - 1 AS BIGINT) AS best FROM pr")
def expected_level(spark, d):
    return single_predictions(spark, d).select(F.col("id").alias("vec_id"), F.round(A.expected(F.col("p")), 6).alias("level"), A.argmax(F.col("p")).cast("long").alias("best"))


@query("soft_targets", f"WITH {PRED} SELECT vec_id, round(.6 + .4 * p[a + 1], 6) AS own FROM pr")
def soft_targets(spark, d):
    t = A.soft_target(F.lit("choice"), F.col("p"), F.array("a"), 0.6)
    return single_predictions(spark, d).select(F.col("id").alias("vec_id"), F.round(F.get(t, F.col("a")), 6).alias("own"))


ECE = "(SELECT sum(n * abs(acc - mean_conf)) / sum(n) FROM (SELECT avg(conf) AS mean_conf, avg(correct) AS acc, count(*) AS n FROM {rows} GROUP BY greatest(CAST(ceil(conf * 15) AS BIGINT), 1)))"


@query("metrics_core_by_type", f"WITH {PRED} SELECT 'choice' AS type, count(*) AS n, round(avg(correct), 6) AS acc, round(avg(nll), 6) AS nll, round(avg(brier), 6) AS brier, round({ECE.format(rows='s1')}, 6) AS ece, round(avg(conf), 6) AS mean_conf FROM s1")
def metrics_core_by_type(spark, d):
    return metrics.core(single_predictions(spark, d), ["type"]).select("type", "n", *map(r6, ("acc", "nll", "brier", "ece", "mean_conf")))


MCONF = "(SELECT CASE WHEN p >= .5 THEN p ELSE 1 - p END AS conf, CAST((p >= .5) = (y = 1) AS DOUBLE) AS correct FROM mo)"


@query(
    "metrics_multi",
    f"""WITH {PRED}{MULTI} SELECT 'multi' AS type, (SELECT count(*) FROM mr) AS n, round((SELECT avg(exact) FROM mr), 6) AS acc, round((SELECT avg(nll) FROM mr), 6) AS nll, round(avg(pow(p - y, 2)), 6) AS brier, round({ECE.format(rows=MCONF)}, 6) AS ece,
round(avg(greatest(p, 1 - p)), 6) AS mean_conf, round(avg(CAST((p >= .5) = (y = 1) AS DOUBLE)), 6) AS option_acc, round(2.0 * count(*) FILTER (p >= .5 AND y = 1) / greatest(1, 2 * count(*) FILTER (p >= .5 AND y = 1) + count(*) FILTER (p >= .5 AND y = 0) + count(*) FILTER (p < .5 AND y = 1)), 6) AS f1 FROM mo""",
)
def metrics_multi(spark, d):
    return metrics.multi_core(multi_predictions(spark, d), ["type"]).select("type", "n", *map(r6, ("acc", "nll", "brier", "ece", "mean_conf", "option_acc", "f1")))


def both(spark, d):
    """All single and all multi predictions. The multi ones have sources of their own, as a source with single answers leaves
    its multi rows out."""
    return single_predictions(spark, d).unionByName(multi_predictions(spark, d).withColumn("source", F.concat(F.lit("multi-"), "source")))


@query(
    "summarize_by_source",
    f"""WITH {PRED}{MULTI}, whole AS (SELECT source, count(*) AS n, avg(exact) AS acc, avg(nll) AS nll FROM mr GROUP BY source),
options AS (SELECT source, avg(pow(p - y, 2)) AS brier, avg(greatest(p, 1 - p)) AS mean_conf FROM mo GROUP BY source),
src AS (SELECT source, count(*) AS n, avg(correct) AS acc, avg(nll) AS nll, avg(brier) AS brier, avg(conf) AS mean_conf FROM s1 GROUP BY source
UNION ALL SELECT 'multi-' || whole.source, n, acc, nll, brier, mean_conf FROM whole JOIN options ON whole.source = options.source)
SELECT source, n, round(acc, 6) AS acc, round(nll, 6) AS nll, round(brier, 6) AS brier, round(mean_conf, 6) AS mean_conf FROM src""",
)
def summarize_by_source(spark, d):
    out = metrics.summarize(both(spark, d)).where("scope = 'source'")
    return out.select(F.col("name").alias("source"), "n", *map(r6, ("acc", "nll", "brier", "mean_conf")))


@query("summarize_overall")
def summarize_overall(spark, d):
    return metrics.summarize(both(spark, d)).where("scope <> 'source'").select("scope", "name", "n", *map(r6, ("acc", "nll", "brier", "ece", "mean_conf")))


@query("reliability_bins", f"WITH {PRED} SELECT greatest(CAST(ceil(conf * 15) AS BIGINT), 1) AS bin, round(avg(conf), 6) AS mean_conf, round(avg(correct), 6) AS acc, count(*) AS n FROM s1 GROUP BY 1")
def reliability_bins(spark, d):
    rel = metrics.reliability(metrics.confidences(single_predictions(spark, d)))
    return rel.select(F.col("bin").cast("long").alias("bin"), r6("mean_conf"), r6("acc"), "n")


GRID = [0.25, 0.5, 1.0, 2.0, 4.0]
LOSS = "avg(-ln(greatest(exp((z[a + 1] - list_max(z)) / t) / list_sum(list_transform(z, lambda y: exp((y - list_max(z)) / t))), 1e-12)))"


@query("temperature_losses", f"WITH {PRED} SELECT t, round({LOSS}, 6) AS loss FROM pr, (SELECT unnest({GRID}) AS t) GROUP BY t")
def temperature_losses(spark, d):
    return calibrate.losses(single_predictions(spark, d), GRID).select("t", r6("loss"))


@query("temperature_grid", f"WITH {PRED}, l AS (SELECT t, {LOSS} AS loss FROM pr, (SELECT unnest({GRID}) AS t) GROUP BY t) SELECT 'choice' AS type, CAST(arg_min(t, loss) AS DOUBLE) AS temperature FROM l")
def temperature_grid(spark, d):
    return calibrate.temperature_grid(single_predictions(spark, d), GRID)


@query("fit_temperature")
def fit_temperature(spark, d):
    return calibrate.fit_temperatures(single_predictions(spark, d).unionByName(multi_predictions(spark, d))).select("type", F.round("temperature", 4).alias("temperature"))


@query("ece_raw_vs_calibrated", f"""WITH {PRED}, t AS (SELECT *, t, list_max(list_transform(z, lambda x: exp((x - list_max(z)) / t) / list_sum(list_transform(z, lambda y: exp((y - list_max(z)) / t))))) AS c FROM s1, (SELECT unnest([1.0, 2.0]) AS t)),
b AS (SELECT t, greatest(CAST(ceil(c * 15) AS BIGINT), 1) AS bin, avg(c) AS mc, avg(correct) AS acc, count(*) AS n FROM t GROUP BY 1, 2) SELECT CAST(t AS DOUBLE) AS t, round(sum(n * abs(acc - mc)) / sum(n), 6) AS ece FROM b GROUP BY t""")
def ece_raw_vs_calibrated(spark, d):
    rows = single_predictions(spark, d).withColumn("t", F.explode(F.array(F.lit(1.0), F.lit(2.0))))
    rows = rows.withColumn("p", A.softmax(F.col("z"), F.col("t")))
    return metrics.ece(metrics.single_rows(rows).select("t", "conf", "correct"), ["t"]).select("t", r6("ece"))


@query("multi_threshold_grid", f"WITH {PRED}{MULTI} SELECT CAST(t AS DOUBLE) AS threshold, round(2.0 * count(*) FILTER (p >= t AND y = 1) / greatest(1, 2 * count(*) FILTER (p >= t AND y = 1) + count(*) FILTER (p >= t AND y = 0) + count(*) FILTER (p < t AND y = 1)), 6) AS f1 FROM mo, (SELECT unnest({calibrate.THRESHOLDS}) AS t) GROUP BY t")
def multi_threshold_grid(spark, d):
    return calibrate.threshold_grid(multi_predictions(spark, d)).select("threshold", r6("f1"))


@query(
    "best_threshold",
    f"""WITH {PRED}{MULTI}, g AS (SELECT CAST(t AS DOUBLE) AS t, 2.0 * count(*) FILTER (p >= t AND y = 1) / greatest(1, 2 * count(*) FILTER (p >= t AND y = 1) + count(*) FILTER (p >= t AND y = 0) + count(*) FILTER (p < t AND y = 1)) AS f1 FROM mo, (SELECT unnest({calibrate.THRESHOLDS}) AS t) GROUP BY t)
SELECT CASE WHEN (SELECT count(*) FROM mr) < {calibrate.LEAST_ROWS} THEN 0.5 ELSE arg_max(t, (f1, -t)) END AS threshold FROM g""",
)
def best_threshold(spark, d):
    return calibrate.best_threshold(multi_predictions(spark, d))


@query(
    "risk_coverage_curve",
    f"""WITH {PRED}, r AS (SELECT row_number() OVER w AS k, sum(1 - correct) OVER w AS wrong FROM s1 WINDOW w AS (ORDER BY conf DESC, vec_id)), n AS (SELECT count(*) AS n FROM s1), cov AS (SELECT unnest(generate_series(5, 100, 5)) AS coverage)
SELECT CAST(coverage AS BIGINT) AS coverage, round(wrong / k, 6) AS error FROM cov, n JOIN r ON r.k = greatest(1, CAST(round_even(n * coverage / 100.0, 0) AS BIGINT))""",
)
def risk_coverage_curve(spark, d):
    return coverage.risk_curve(coverage.answers(single_predictions(spark, d))).select(F.col("coverage").cast("long").alias("coverage"), r6("error"))


@query("selective_thresholds", f"WITH {PRED} SELECT CAST(t AS DOUBLE) AS threshold, round(CAST(count(*) FILTER (conf >= t) AS DOUBLE) / count(*), 6) AS coverage, round(avg(1 - correct) FILTER (conf >= t), 6) AS error FROM s1, (SELECT unnest([.5, .6, .7, .8, .9, .95, .97]) AS t) GROUP BY t")
def selective_thresholds(spark, d):
    return coverage.selective(coverage.answers(single_predictions(spark, d))).select("threshold", r6("coverage"), r6("error"))


@query(
    "benchmark_score_single",
    f"""WITH {PRED}, b AS (SELECT source AS benchmark, a, list_position(p, list_max(p)) - 1 AS pred, correct, nll FROM s1),
sides AS (SELECT benchmark, unnest(list_distinct([CAST(a AS BIGINT), CAST(pred AS BIGINT)])) AS cls, a, pred FROM b),
f AS (SELECT benchmark, cls, 2.0 * count(*) FILTER (a = cls AND pred = cls) / greatest(1, 2 * count(*) FILTER (a = cls AND pred = cls) + count(*) FILTER (a <> cls AND pred = cls) + count(*) FILTER (a = cls AND pred <> cls)) AS f1 FROM sides GROUP BY 1, 2),
maj AS (SELECT benchmark, max(c) * 1.0 / sum(c) AS majority FROM (SELECT benchmark, a, count(*) AS c FROM b GROUP BY 1, 2) GROUP BY 1)
SELECT b.benchmark, count(*) AS n, round(avg(correct), 6) AS acc, round(avg(nll), 6) AS nll, round((SELECT avg(f1) FROM f WHERE f.benchmark = b.benchmark), 6) AS macro_f1, round((SELECT majority FROM maj WHERE maj.benchmark = b.benchmark), 6) AS majority FROM b GROUP BY b.benchmark""",
)
def benchmark_score_single(spark, d):
    rows = single_predictions(spark, d).withColumn("benchmark", F.col("source"))
    return metrics.benchmark_single(rows).select("benchmark", "n", *map(r6, ("acc", "nll", "macro_f1", "majority")))


@query(
    "benchmark_score_multi",
    f"""WITH {PRED}{MULTI}, l AS (SELECT label, 2.0 * count(*) FILTER (p >= .4 AND y = 1) / greatest(1, 2 * count(*) FILTER (p >= .4 AND y = 1) + count(*) FILTER (p >= .4 AND y = 0) + count(*) FILTER (p < .4 AND y = 1)) AS f1 FROM mo GROUP BY label HAVING sum(y) > 0),
x AS (SELECT CAST(bool_and((p >= .4) = (y = 1)) AS DOUBLE) AS exact FROM mo GROUP BY vec_id)
SELECT (SELECT count(*) FROM x) AS n, round((SELECT avg(exact) FROM x), 6) AS acc, round((SELECT avg(f1) FROM l), 6) AS macro_f1, round(avg(CAST((p >= .4) = (y = 1) AS DOUBLE)), 6) AS option_acc FROM mo""",
)
def benchmark_score_multi(spark, d):
    rows = multi_predictions(spark, d).withColumn("benchmark", F.lit("all"))
    return metrics.benchmark_multi(rows, 0.4).select("n", *map(r6, ("acc", "macro_f1", "option_acc")))


@query("score_by_group", f"WITH {PRED} SELECT source, a, count(*) AS n, round(avg(correct), 6) AS acc FROM s1 GROUP BY source, a")
def score_by_group(spark, d):
    return metrics.by_group(single_predictions(spark, d), "source", "a").select("source", "a", "n", r6("acc"))


@query("permutation_agreement", f"WITH {PRED} SELECT k AS perm, round(avg(correct), 6) AS acc, 1.0 AS agree FROM s1, (SELECT unnest([0, 1, 2, 3]) AS k) GROUP BY k")
def permutation_agreement(spark, d):
    rows = single_predictions(spark, d).withColumn("options", F.transform("p", lambda _, i: i.cast("string")))
    shown = sampling.permutations(rows).withColumn("p", A.take(F.col("p"), F.col("back")))
    return metrics.permutation_agreement(shown).select("perm", r6("acc"), r6("agree"))


# --- filters, corpus, graph, time -----------------------------------------------------------------------------------------


@query("audit_table", "SELECT source, count(*) AS n, round(avg(quality), 6) AS agree, round(avg(toxic), 6) AS p, round(avg(1.0 / (1 + d.doc_id % 4)), 6) AS chance FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY source")
def audit_table(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id")
    audited = rows.select("source", F.col("quality").alias("agree"), F.col("toxic").alias("p"), (1.0 / (1 + F.col("doc_id") % 4)).alias("chance"))
    return statistics.audit_table(audited).select("source", "n", r6("agree"), r6("p"), r6("chance"))


@query("audit_dropped", "SELECT lang FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang HAVING count(*) >= 20 AND avg(toxic) < 0.5 - 0.15")
def audit_dropped(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id")
    return filters.dropped_sources(rows.groupBy("lang").agg(F.count("*").alias("n"), F.avg("toxic").alias("agree"), F.lit(0.5).alias("chance"))).select("lang")


@query("structure_checks", f"""SELECT CASE WHEN length({sql_clean(sql_strip('text'), 3000)}) < 40 THEN 'short_state' WHEN regexp_matches({sql_clean(sql_strip('text'), 3000)}, '(?i)' || '\\[(?:[A-Z][A-Za-z ]{{0,20}}|insert[^\\]]*|placeholder[^\\]]*)\\]|\\{{[a-z_]{{2,30}}\\}}|lorem ipsum|<[A-Z_]{{3,}}>|\\bXXX+\\b') THEN 'placeholder'
WHEN regexp_matches({sql_clean(sql_strip('text'), 3000)}, '(?i)\\b(the (correct|right) (answer|option) is|answer\\s*:\\s*\\w)') THEN 'giveaway' ELSE 'ok' END AS reason, count(*) AS n FROM documents WHERE list_contains({sql_list(LANGS)}, lang) AND {sql_strip('text')} <> '' GROUP BY 1""")
def structure_checks(spark, d):
    return document_records(spark, d).select(F.coalesce(filters.structure_problem(), F.lit("ok")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("corpus_browse", f"SELECT 'doc:' || doc_id AS id FROM documents WHERE list_contains({sql_list(LANGS)}, lang) AND {sql_strip('text')} <> '' AND doc_id % 5 <> 0 AND contains(lower({sql_clean(sql_strip('text'), 3000)} || chr(10) || 'Which language is this text in?' || chr(10) || 'de' || chr(10) || 'en' || chr(10) || 'es' || chr(10) || 'fr'), 'license')")
def corpus_browse(spark, d):
    rows = document_records(spark, d)
    return filters.browse(rows, rows.where("row_ord % 5 = 0").select("id"), "doc", "License").select("id")


@query("corpus_exclude", f"SELECT count(*) AS n FROM documents WHERE list_contains({sql_list(LANGS)}, lang) AND {sql_strip('text')} <> '' AND doc_id % 7 <> 0")
def corpus_exclude(spark, d):
    rows = document_records(spark, d)
    return filters.exclude(rows, rows.where("row_ord % 7 = 0").select("id"), ["other", "synth"]).agg(F.count("*").alias("n"))


@query("corpus_overview", f"SELECT source, count(*) AS n, count(*) FILTER (doc_id % 5 = 0) AS deleted FROM documents GROUP BY source")
def corpus_overview(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "source", "doc_id")
    return corpus.overview(rows, corpus.delete(rows.limit(0), rows.where("doc_id % 5 = 0")))


@query("history_upsert", "SELECT CAST(o_orderkey AS VARCHAR) AS model, o_orderpriority AS benchmark, round(CASE WHEN o_orderkey % 3 = 0 THEN 0.9 ELSE 0.5 END, 6) AS acc FROM orders")
def history_upsert(spark, d):
    old = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("model"), F.col("o_orderpriority").alias("benchmark"), F.lit(0.5).alias("acc"))
    return corpus.upsert(old, old.where("cast(model as long) % 3 = 0").withColumn("acc", F.lit(0.9)))


@query("previous_model_delta", "SELECT source AS model, lang AS benchmark, lag(source) OVER w AS previous, round(acc - lag(acc) OVER w, 6) AS delta FROM (SELECT source, lang, avg(n_chars) AS acc FROM documents GROUP BY 1, 2) WINDOW w AS (PARTITION BY lang ORDER BY source)")
def previous_model_delta(spark, d):
    rows = table(spark, d, "documents").groupBy(F.col("source").alias("model"), F.col("lang").alias("benchmark")).agg(F.avg("n_chars").alias("acc"))
    return corpus.previous_delta(rows).select("model", "benchmark", "previous", r6("delta"))


@query("ema_by_user", "SELECT user_id, count(*) AS n, round(list_reduce(list(value ORDER BY event_id), lambda a, x: .97 * a + .03 * x), 6) AS ema FROM events GROUP BY user_id")
def ema_by_user(spark, d):
    return corpus.ema(table(spark, d, "events").where("value is not null"), "user_id", "event_id", "value").select("user_id", "n", r6("ema"))


@query("moving_rate_120s", "SELECT event_id, round(count(*) OVER (PARTITION BY event_type ORDER BY CAST(floor(epoch(ts)) AS BIGINT) RANGE BETWEEN 120 PRECEDING AND CURRENT ROW) / 120.0, 6) AS rate FROM events")
def moving_rate_120s(spark, d):
    return corpus.moving_rate(table(spark, d, "events"), "event_type", "ts").select("event_id", r6("rate"))


@query("top_answers", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type LIMIT 4")
def top_answers(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type").limit(4)


@query("corpus_statistics", "SELECT lang, source, count(*) AS n, round(avg(n_chars), 6) AS mean, round(median(n_chars), 6) AS median, round(quantile_cont(n_chars, .95), 6) AS p95, round(avg(CASE WHEN n_chars >= 512 THEN 1.0 ELSE 0.0 END), 6) AS long_share FROM documents GROUP BY lang, source")
def corpus_statistics(spark, d):
    rows = statistics.length_statistics(table(spark, d, "documents"), ["lang", "source"], F.col("n_chars"), 512)
    return rows.select("lang", "source", "n", *(r6(c) for c in ("mean", "median", "p95", "long_share")))


def outcomes(spark, d) -> DataFrame:
    """Labelled documents as outcomes of a synthesis: good ones are accepted."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    return docs.select(F.col("source").alias("family"), F.col("lang").alias("domain"), F.when(F.col("quality") == 1, "accepted").otherwise("rejected").alias("status"), F.col("text").alias("state"), (F.col("doc_id") % 5 + 1).alias("quality"), (F.col("n_chars") % 100 / 100).alias("p_answer"), F.col("toxic").alias("relabeled"))


@query("synth_tried_accepted", "SELECT source AS family, lang AS domain, count(*) AS tried, count(*) FILTER (quality = 1) AS accepted FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE source IS NOT NULL AND lang IS NOT NULL GROUP BY source, lang")
def synth_tried_accepted(spark, d):
    return statistics.tried_accepted(outcomes(spark, d), "family", "domain")


@query(
    "synth_accepted_statistics",
    r"""WITH r AS (SELECT lang, d.doc_id % 5 + 1 AS q, (n_chars % 100) / 100.0 AS p, toxic, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	

]+')) AS DOUBLE) AS w FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality = 1)
SELECT count(*) AS n, round(avg(q), 6) AS quality_mean, round(median(q), 6) AS quality_median, round(avg(p), 6) AS p_answer_mean, round(avg(w), 6) AS words_mean, round(median(w), 6) AS words_median, count(DISTINCT lang) AS domains, count(*) FILTER (toxic = 1) AS relabeled FROM r""",
)
def synth_accepted_statistics(spark, d):
    means = ("quality_mean", "quality_median", "p_answer_mean", "words_mean", "words_median")
    return statistics.accepted_statistics(outcomes(spark, d)).select("n", *(r6(c) for c in means), "domains", "relabeled")


MODELS = ("m1", "m2", "m3", "teacher_t1")


@query(
    "benchmark_overview",
    f"""WITH h AS (SELECT {sql_list(MODELS)}[d.doc_id % 4 + 1] AS model, source AS benchmark, avg(quality) AS acc, count(*) AS n FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY ALL),
b AS (SELECT benchmark, arg_max(model, model) AS previous, arg_max(acc, model) AS before FROM h WHERE model IN ('m1', 'm2') GROUP BY benchmark)
SELECT h.benchmark, h.n, round(h.acc, 6) AS acc, previous, round(h.acc - before, 6) AS delta, round(t.acc, 6) AS teacher_acc FROM h LEFT JOIN b ON b.benchmark = h.benchmark LEFT JOIN h AS t ON t.benchmark = h.benchmark AND t.model = 'teacher_t1' WHERE h.model = 'm3'""",
)
def benchmark_overview(spark, d):
    model = F.element_at(F.array(*map(F.lit, MODELS)), (F.col("doc_id") % 4 + 1).cast("int"))
    rows = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id")
    history = rows.groupBy(model.alias("model"), F.col("source").alias("benchmark")).agg(F.avg("quality").alias("acc"), F.count("*").alias("n"))
    of = lambda m: history.where(F.col("model") == m).drop("model")  # noqa: E731
    out = statistics.benchmark_overview(of("m3"), history, "m3", of("teacher_t1"))
    return out.select("benchmark", "n", r6("acc"), "previous", r6("delta"), r6("teacher_acc"))


@query("usable_sample", f"SELECT doc_id FROM documents WHERE list_contains({sql_list(LANGS)}, lang) AND n_chars >= 200 ORDER BY {h60("'scan:1234:' || doc_id")}, doc_id LIMIT 300")
def usable_sample(spark, d):
    """A benchmark's fixed sample of 300 usable documents."""
    usable = F.col("lang").isin(LANGS) & (F.col("n_chars") >= 200)
    return sampling.bounded_usable(table(spark, d, "documents").select("doc_id", "lang", "n_chars"), usable, "doc_id", 300).select("doc_id")


def nation_graph(spark, d):
    nodes = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    none = F.lit(None).cast("string")
    nodes = nodes.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("title"), none.alias("label"), none.alias("name"), F.col("r_name").alias("cluster"), none.alias("type"), none.alias("summary"), none.alias("formula"))
    edges = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_nationkey").cast("string").alias("source"), ((F.col("s_nationkey") * 7 + F.col("s_suppkey")) % 25).cast("string").alias("target"), F.lit("supplies").alias("relation"), none.alias("kind"), F.lit(True).alias("directed"))
    return nodes, edges


@query(
    "graph_relation_records",
    """WITH e AS (SELECT CAST(s_nationkey AS VARCHAR) AS s, CAST((s_nationkey * 7 + s_suppkey) % 25 AS VARCHAR) AS t, min(CAST(s_suppkey AS VARCHAR)) AS id FROM supplier GROUP BY 1, 2)
SELECT 'sem:' || id || '-' || substr(md5(s || '|supplies|' || t), 1, 10) AS id, n_name AS shown, 4 AS n_options FROM e JOIN nation ON CAST(n_nationkey AS VARCHAR) = t WHERE s <> t""",
)
def graph_relation_records(spark, d):
    out = graph.graph_records(*nation_graph(spark, d))
    return out.select("id", F.get("options", F.get("answer", F.lit(0))).alias("shown"), F.size("options").alias("n_options"))


LANG_NAMES = {"de": "German prose", "en": "English prose", "es": "Spanish prose", "fr": "French prose"}
CRITERIA = ("It insults or threatens.", "It does neither.")


def lookups(spark) -> plan.Lookups:
    workers_import(spark)
    return plan.Lookups(
        spark.createDataFrame([("doc", LANG_NAMES)], "source string, names map<string,string>"),
        spark.createDataFrame([("priority|How urgent is this order, 1 being most urgent?|1|2|3|4|5", ["urgent", "high", "medium", "low", "none"])], "key string, names array<string>"),
        spark.createDataFrame([(q, *CRITERIA) for q in TOXIC], "question string, yes string, no string"),
    )


def augmented(spark, rows):
    x = lookups(spark)
    return augment.augment(rows, x.labels, x.levels, x.criteria)


@query("augment_desc", f"SELECT 'doc:' || doc_id AS id, CASE WHEN {sql_u01("'aug:desc:doc:' || doc_id")} < .4 THEN 'de: German prose|en: English prose|es: Spanish prose|fr: French prose' ELSE 'de|en|es|fr' END AS options FROM documents WHERE list_contains({sql_list(LANGS)}, lang) AND {sql_strip('text')} <> '' AND {sql_u01("'aug:multi:doc:' || doc_id")} >= .05")
def augment_desc(spark, d):
    out = augmented(spark, document_records(spark, d)).where("type = 'choice'")
    return out.select("id", F.array_join("options", "|").alias("options"))


@query("augment_to_multi", f"SELECT 'doc:' || doc_id AS id, CAST(CASE WHEN {sql_u01("'tomulti:doc:' || doc_id")} < .3 THEN 0 ELSE 1 END AS BIGINT) AS n_true, CAST(CASE WHEN {sql_u01("'tomulti:doc:' || doc_id")} < .3 THEN 3 ELSE 4 END AS BIGINT) AS n_options FROM documents WHERE list_contains({sql_list(LANGS)}, lang) AND {sql_strip('text')} <> '' AND {sql_u01("'aug:multi:doc:' || doc_id")} < .05")
def augment_to_multi(spark, d):
    out = augmented(spark, document_records(spark, d)).where("type = 'multi'")
    return out.select("id", F.size("answer").cast("long").alias("n_true"), F.size("options").cast("long").alias("n_options"))


@query("augment_levels", f"SELECT 'priority:' || o_orderkey AS id, CASE WHEN {sql_u01("'aug:levels:priority:' || o_orderkey")} < .5 THEN 'urgent|high|medium|low|none' ELSE '1|2|3|4|5' END AS options FROM orders WHERE TRY_CAST(left(o_orderpriority, 1) AS INTEGER) BETWEEN 1 AND 5")
def augment_levels(spark, d):
    return augmented(spark, priority_records(spark, d)).select("id", F.array_join("options", "|").alias("options"))


@query("augment_criteria", f"""SELECT 'toxic:' || d.doc_id AS id, {sql_pick(TOXIC, "('toxic:' || d.doc_id)")} || CASE WHEN {sql_u01("'aug:criteria:toxic:' || d.doc_id")} < .3 THEN chr(10) || 'yes = {CRITERIA[0]}' || chr(10) || 'no = {CRITERIA[1]}' ELSE '' END AS question FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE toxic IS NOT NULL AND {sql_strip('text')} <> ''""")
def augment_criteria(spark, d):
    return augmented(spark, toxic_records(spark, d)).select("id", "question")


@query("synth_outcomes", f"SELECT type, status, count(*) AS n FROM (SELECT CASE doc_id % 2 WHEN 0 THEN 'choice' ELSE 'binary' END AS type, CASE WHEN {sql_u01("'outcome:' || doc_id")} < .6 THEN 'accepted' ELSE 'rejected' END AS status FROM documents) GROUP BY 1, 2")
def synth_outcomes(spark, d):
    rows = table(spark, d, "documents").select(F.when(F.col("doc_id") % 2 == 0, "choice").otherwise("binary").alias("type"), F.when(u01("outcome", F.col("doc_id")) < 0.6, "accepted").otherwise("rejected").alias("status"))
    return rows.groupBy("type", "status").agg(F.count("*").alias("n"))


@query("flagship", f"""WITH r AS (SELECT d.doc_id, toxic, row_number() OVER (PARTITION BY {sql_norm(sql_clean(sql_strip('text'), 3000))}, {sql_pick(TOXIC, "('toxic:' || d.doc_id)")} ORDER BY d.doc_id) AS k FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE toxic IS NOT NULL AND {sql_strip('text')} <> '')
SELECT CASE WHEN {sql_u01("'split:toxic:' || doc_id || ':1234'")} < .03 THEN 'test' WHEN {sql_u01("'split:toxic:' || doc_id || ':1234'")} < .06 THEN 'val' ELSE 'train' END AS split, CASE WHEN toxic = 1 THEN '0' ELSE '1' END AS answer, count(*) AS n FROM r WHERE k = 1 GROUP BY 1, 2""")
def flagship(spark, d):
    rows = toxic_records(spark, d).withColumns({"source_rank": F.lit(0), "row_ord": F.split_part("id", F.lit(":"), F.lit(2)).cast("long")})
    built = plan.build(rows, plan.Config())
    return built.groupBy("split", F.array_join("answer", ",").alias("answer")).agg(F.count("*").alias("n"))


# --- tokens, batches, serving, synthesis, streams -----------------------------------------------------------------------


@query("byte_tokens", "SELECT c_custkey, CAST(strlen(c_name) AS BIGINT) AS n, CAST(ascii(c_name) + 4 AS BIGINT) AS first FROM customer")
def byte_tokens(spark, d):
    from .functions.tokens import byte_ids

    ids = byte_ids(F.col("c_name"))
    return table(spark, d, "customer").select("c_custkey", F.size(ids).cast("long").alias("n"), F.get(ids, F.lit(0)).cast("long").alias("first"))


@query("pack_training_rows")
def pack_training_rows(spark, d):
    return plan.pack(plan.build(all_records(spark, d), CONFIG)).select("id", "split", "len", "ans", "typ", F.size("pos").alias("options"))


@query("make_batches")
def make_batches(spark, d):
    from .operators.batching import make_batches as cut

    return cut(table(spark, d, "documents"), "doc_id", "n_chars", 50_000)


def requests(spark, d) -> DataFrame:
    turns = table(spark, d, "conversations").where("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"))
    kind = "struct<type:string,instructions:string,criteria:map<string,string>,threshold:double>"
    q = lambda t, i, c: F.struct(F.lit(t).alias("type"), F.lit(i).alias("instructions"), (F.create_map(*[F.lit(x) for kv in c.items() for x in kv]) if c else F.create_map().cast("map<string,string>")).alias("criteria"), F.lit(None).cast("double").alias("threshold")).cast(kind)  # noqa: E731
    many = {f"topic {i}": "" for i in range(40)}
    questions = F.create_map(F.lit("polite"), q("noul", "Is the request polite?", {}), F.lit("topic"), q("choice", "What is it about?", many), F.lit("broken"), q("choice", "Only one?", {"one": ""}))
    return turns.select(F.col("conv_id").cast("string").alias("request_id"), F.create_map(F.lit("text"), "text").alias("state"), questions.alias("questions"))


@query("ask_many", """SELECT CAST(conv_id AS VARCHAR) AS request_id, 3 AS n, 'needs 2 to 255 options, has 1' AS error FROM conversations WHERE role = 'user' GROUP BY conv_id""")
def ask_many(spark, d):
    from .serve import ask

    out = ask(requests(spark, d))
    return out.select("request_id", F.size("answers").alias("n"), F.element_at("answers", F.lit("broken"))["error"].alias("error"))


#: Logits of forty options by the length of the state: four groups of ten, two finalists of each, eight in the last round.
CUP = """WITH t AS (SELECT conv_id, length('text: ' || arg_min(text, turn)) AS n FROM conversations WHERE role = 'user' AND text IS NOT NULL GROUP BY conv_id),
z AS (SELECT conv_id, i, i // 10 AS g, ((n * (i + 3)) % 37) / 8.0 AS z FROM t, (SELECT unnest(generate_series(0, 39)) AS i)),
l AS (SELECT *, exp(z) / sum(exp(z)) OVER (PARTITION BY conv_id, g) AS local, row_number() OVER (PARTITION BY conv_id, g ORDER BY z DESC, i) AS k FROM z),
f AS (SELECT conv_id, i, exp(z) / sum(exp(z)) OVER (PARTITION BY conv_id) AS pf FROM l WHERE k <= 2),
s AS (SELECT l.conv_id, l.i, coalesce(f.pf, l.local * max(f.pf / l.local) FILTER (k = 1) OVER (PARTITION BY l.conv_id, g)) AS p FROM l LEFT JOIN f ON f.conv_id = l.conv_id AND f.i = l.i),
p AS (SELECT conv_id, i, p / sum(p) OVER (PARTITION BY conv_id) AS p FROM s)
SELECT CAST(conv_id AS VARCHAR) AS request_id, 'topic ' || arg_max(i, (round(p, 12), -i)) AS answer, round(sum(p), 2) AS total, round(max(p), 4) AS top, round(max(p) FILTER (i = 39), 4) AS last FROM p GROUP BY conv_id"""


@query("tournament_choice", CUP)
def tournament_choice(spark, d):
    from .scorer import CallableScorer
    from .serve import ask

    scorer = CallableScorer(lambda s, q, o: [((len(s) * (int(x.split()[-1]) + 3)) % 37) / 8 for x in o])
    rows = requests(spark, d).where("state['text'] is not null").withColumn("questions", F.map_filter("questions", lambda k, _: k == "topic"))
    topic = F.element_at("answers", F.lit("topic"))
    p = topic["probabilities"]
    return ask(rows, scorer).select("request_id", topic["answer"].alias("answer"), F.round(F.aggregate(F.map_values(p), F.lit(0.0), lambda a, x: a + x), 2).alias("total"), F.array_max(F.map_values(p)).alias("top"), F.element_at(p, F.lit("topic 39")).alias("last"))


@query("decide_priority", "SELECT 'priority:' || o_orderkey AS id, 'score' AS type FROM orders WHERE TRY_CAST(left(o_orderpriority, 1) AS INTEGER) BETWEEN 1 AND 5")
def decide_priority(spark, d):
    from .serve import decide

    return decide(priority_records(spark, d).select("id", "state", "question", "options")).select("id", "type")


@query(
    "relevance_filter_topk",
    f"""WITH d AS (SELECT 'doc:' || doc_id AS id, regexp_extract_all(lower({sql_clean(sql_strip('text'), 3000)}), '[\\p{{L}}\\p{{N}}_]+') AS w FROM documents WHERE list_contains({sql_list(LANGS)}, lang) AND {sql_strip('text')} <> ''),
z AS (SELECT id, 4.0 * (list_contains(w, 'the')::INT + list_contains(w, 'and')::INT + list_contains(w, 'of')::INT) / sqrt(3) AS a, 4.0 * (list_contains(w, 'der')::INT + list_contains(w, 'die')::INT + list_contains(w, 'das')::INT) / sqrt(3) AS b FROM d),
p AS (SELECT id, 1 / (1 + exp(b - a)) AS p FROM z)
SELECT id, round(p, 6) AS p FROM p WHERE p >= 0.6 ORDER BY p DESC, id LIMIT 100""",
)
def relevance_filter_topk(spark, d):
    from .scorer import LexicalScorer, score

    rows = document_records(spark, d).withColumn("options", F.array(F.lit("the and of"), F.lit("der die das")))
    scored = score(rows.select("id", "type", "state", "question", "options"), LexicalScorer())
    found = filters.relevant(scored.select("id", F.get("p", F.lit(0)).alias("p")), 0.6)
    return found.select("id", r6("p")).orderBy(F.desc("p"), "id").limit(100)


@query("synth_chain")
def synth_chain(spark, d):
    """A job for every customer, from writing to the near-duplicate filter."""
    from . import synth

    workers_import(spark)
    jobs = synth.jobs_on(table(spark, d, "customer"), "c_custkey", 50)
    made = dedup.shared_table(synth.make_examples(jobs, synth.FakeTeacher()), "outcomes")
    return synth.without_near(made).groupBy("type", "status", "reason").agg(F.count("*").alias("n"))


def _drawn(name: str, what: str, n: int) -> str:
    return f"""({h60(f"'{name}:1234:' || o_orderkey || ':{what}'")} % {n})"""


@query(
    "toy_sources",
    f"""SELECT 'toy:stock:' || o_orderkey AS id, CASE WHEN {_drawn("stock", "a", 60)} + {_drawn("stock", "b", 60)} >= {_drawn("stock", "c", 120)} THEN '0' ELSE '1' END AS answer, 'ok' AS reason FROM orders
UNION ALL SELECT 'toy:delay:' || o_orderkey, CAST([0, 1, 2, 2, 3, 4][abs({_drawn("delay", "hour", 11)} - 5) + 1] AS VARCHAR), 'ok' FROM orders
UNION ALL SELECT 'toy:cheapest:' || o_orderkey, CAST(list_position(p, list_min(p)) - 1 AS VARCHAR), 'ok' FROM (SELECT o_orderkey, list_transform(generate_series(0, {_drawn("cheapest", "k", 4)} + 1), lambda j: (j * ({_drawn("cheapest", "step", 4)} + 1) + {_drawn("cheapest", "base", 20)} + 5) % 5) AS p FROM orders)
UNION ALL SELECT 'toy:tags:' || o_orderkey, array_to_string(list_filter(generate_series(0, {_drawn("tags", "k", 3)} + 2), lambda j: {h60("'tags:1234:' || o_orderkey || ':there:' || j")} % 2 <> 0), ','), 'ok' FROM orders""",
)
def toy_sources(spark, d):
    """A toy record of each kind for every order."""
    from .sources.readers import toy_on

    out = None
    for name in ("stock", "cheapest", "tags", "delay"):
        rows = toy_on(dealt(spark, d, "orders", "o_orderkey"), name, "o_orderkey")
        out = rows if out is None else out.unionByName(rows)
    return out.select("id", F.array_join("answer", ",").alias("answer"), invalid_reason().alias("reason"))


@query("describe_plan", f"SELECT 'labels' AS kind, 'doc' AS key, 4 AS n FROM documents WHERE list_contains({sql_list(LANGS)}, lang) AND {sql_strip('text')} <> '' HAVING count(*) >= 50")
def describe_plan(spark, d):
    return augment.describe_plan(document_records(spark, d)).select("kind", "key", F.size("items").alias("n"))


@query("windowed_events", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def windowed_events(spark, d):
    from .streaming.ingest import windowed

    rows = windowed(table(spark, d, "events"), "ts", "1 hour", "event_type")
    return rows.select("start", "event_type", "n", F.round("total", 4).alias("total"))


@query("stream_jid_dedup_counts", "SELECT event_type AS type, count(DISTINCT user_id) AS n FROM events GROUP BY event_type")
def stream_jid_dedup_counts(spark, d):
    """The events as JSON files, read as a stream, each user and type once, counted."""
    from .streaming.ingest import ingest

    rows = table(spark, d, "events").select(F.concat_ws(":", "event_type", F.col("user_id").cast("string")).alias("jid"), F.col("event_type").alias("type"), F.lit("accepted").alias("status"))
    base = dedup.shared_folder(spark, "stream")
    rows.write.json(f"{base}/in")
    ingest(spark, f"{base}/in", "jid string, type string, status string", f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("type").agg(F.count("*").alias("n"))


@query("stream_near_kept", KEPT)
def stream_near_kept(spark, d):
    """The documents' signatures in four batches of ids, filtered as a stream."""
    from .streaming.near import NearStream

    sig = dedup.shared_table(document_signatures(spark, d).select("doc_id", "hi", "lo"), "signatures")
    low, high = sig.agg(F.min("doc_id"), F.max("doc_id")).first()
    stream = NearStream(spark, dedup.shared_folder(spark, "near"), "doc_id")
    for k in range(4 if low is not None else 0):
        part = F.least(F.lit(3), F.floor((F.col("doc_id") - low) * 4 / F.lit(high - low + 1)))
        stream.feed(sig.where(part == k))
    return stream.kept()


SHARDED = f"""j AS (SELECT o_custkey % 16 AS shard, {h60("'try1:' || o_orderkey")} % 100 < CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE 10 END AS e1, {h60("'try2:' || o_orderkey")} % 100 < CASE WHEN o_custkey % 4 = 3 THEN 60 ELSE 5 END AS e2 FROM orders),
t AS (SELECT shard, count(*) AS n, count(*) FILTER (e1) AS m1, count(*) FILTER (e1 AND e2) AS m2 FROM j GROUP BY shard)"""


@query(
    "shard_states",
    f"""WITH {SHARDED} SELECT shard, CASE WHEN m1 <= n * 0.03 OR m2 <= n * 0.03 THEN 'closed' ELSE 'open' END AS state, n AS jobs, CASE WHEN m1 <= n * 0.03 THEN m1 ELSE m2 END AS missing,
CASE WHEN m1 <= n * 0.03 THEN 1 ELSE 2 END AS rounds, CASE WHEN m1 <= n * 0.03 THEN n - m1 WHEN m2 <= n * 0.03 THEN n - m2 ELSE 0 END AS outcomes FROM t""",
)
def shard_states(spark, d):
    """Orders as jobs whose outcomes come in three files, some as errors; what misses is tried once more."""
    from .streaming.shards import ShardLog

    jobs = dedup.shared_table(table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("jid"), (F.col("o_custkey") % 16).alias("shard"), (F.col("o_custkey") % 4).alias("_kind")), "jobs")
    base = dedup.shared_folder(spark, "shards")
    log, schema = ShardLog(jobs, f"{base}/log"), "jid string, shard long, status string"

    def tried(rows: DataFrame, no: int, share) -> DataFrame:
        fails = keyed(f"try{no}", F.col("jid")) % 100 < share
        return rows.select("jid", "shard", F.when(fails, "error").otherwise("accepted").alias("status"))

    def run() -> None:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{base}/in")
        stream.writeStream.foreachBatch(log.commit).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()

    tried(jobs, 1, F.when(F.col("_kind") % 2 == 0, 1).otherwise(10)).repartition(3).write.json(f"{base}/in")
    run()
    again = log.retries(spark).join(jobs.select("jid", "_kind"), "jid")
    tried(again, 2, F.when(F.col("_kind") == 3, 60).otherwise(5)).repartition(1).write.mode("append").json(f"{base}/in")
    run()
    counts = log.closed(spark, "jid string, batch long, status string").groupBy("shard").agg(F.count("*").alias("outcomes"))
    return log.marks(spark).join(counts, "shard", "left").select("shard", "state", "jobs", "missing", "rounds", F.coalesce("outcomes", F.lit(0)).alias("outcomes"))


@query(
    "stream_feeder",
    f"""WITH RECURSIVE s AS (SELECT o_orderkey % 20 AS shard, count(*) AS n, count(*) FILTER ({h60("'ok:' || o_orderkey")} % 10 < 6) AS ok FROM orders GROUP BY ALL),
c AS (SELECT row_number() OVER (ORDER BY shard) AS k, sum(n) OVER (ORDER BY shard) AS fed, sum(ok) OVER (ORDER BY shard) AS ok FROM s UNION ALL SELECT 0, 0, 0),
goal AS (SELECT CAST(floor(count(*) * 0.4) AS BIGINT) AS goal FROM orders),
g AS (SELECT CAST(0 AS BIGINT) AS k, CAST(-1 AS BIGINT) AS before UNION ALL
  SELECT coalesce(min(CASE WHEN a.ok + (CASE WHEN a.fed >= 20 THEN a.ok / a.fed ELSE 0.5 END) * (b.fed - a.fed) >= goal THEN b.k END), max(b.k)), any_value(g.k)
  FROM g JOIN c AS a ON a.k = g.k JOIN c AS b ON b.k >= a.k, goal WHERE g.k <> g.before GROUP BY g.k)
SELECT CAST(c.k AS BIGINT) AS shards, CAST(fed AS BIGINT) AS tried, CAST(ok AS BIGINT) AS accepted, CAST(ok AS BIGINT) >= goal AS reached FROM c, goal WHERE c.k = (SELECT max(k) FROM g)""",
)
def stream_feeder(spark, d):
    """Orders as jobs in twenty shards, fed until two fifths of their number are accepted or expected."""
    from .streaming.feeder import Feeder

    jobs = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 20).alias("shard"))
    goal, folder = int(jobs.count() * 0.4), dedup.shared_folder(spark, "feeder")
    work = lambda rows: rows.withColumn("status", F.when(keyed("ok", F.col("o_orderkey")) % 10 < 6, "accepted").otherwise("rejected"))  # noqa: E731
    released = Feeder(jobs, work, goal, folder, lockstep=True).run()
    done = spark.read.parquet(f"{folder}/progress").agg(F.max("tried").alias("tried"), F.max("accepted").alias("accepted"))
    return done.select(F.lit(len(released)).cast("long").alias("shards"), F.coalesce("tried", F.lit(0)).alias("tried"), F.coalesce("accepted", F.lit(0)).alias("accepted"), (F.coalesce("accepted", F.lit(0)) >= goal).alias("reached"))


@query("stream_bounded_scan", SQL["bounded_scan"])
def stream_bounded_scan(spark, d):
    from .streaming.scan import ScanSketch, scan_stream

    path = f"{d}/lineitem.parque[t]"  # a pattern, as a stream's path may be a file only so
    rows = spark.readStream.schema(table(spark, d, "lineitem").schema).option("maxFilesPerTrigger", 1).parquet(path)
    folder = dedup.shared_folder(spark, "scan")
    keyed_rows = rows.select("l_orderkey", "l_linenumber", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"))
    scan_stream(keyed_rows, folder, "k", 1000).awaitTermination()
    return ScanSketch(f"{folder}/sketch", "k", 1000).rows(spark).drop("k")


@query(
    "source_markers",
    f"""WITH n AS (SELECT 'segment' AS source, count(*) AS n FROM customer WHERE list_contains({sql_list(SEGMENTS)}, c_mktsegment) AND trim(c_name) <> '' UNION ALL
SELECT 'brand', count(*) FROM part WHERE list_contains({sql_list([f"Brand#{i}{j}" for i in range(1, 6) for j in range(1, 6)])}, p_brand) AND trim(p_name) <> '')
SELECT source, n, 'built' AS first, 'kept' AS second, CASE WHEN source = 'brand' THEN 'built' ELSE 'kept' END AS third FROM n""",
)
def source_markers(spark, d):
    """Two sources built, looked at again, and built again after one of them has other settings."""
    from .plans import sources as P

    def both(ask: str) -> list[P.Source]:
        customers = P.Source("segment", lambda s: dealt(s, d, "customer", "c_custkey"), lambda df: M.classes(df, "segment", "c_custkey", ["c_name"], "c_mktsegment", ["Which market segment is this customer in?"], SEGMENTS))
        parts = P.Source("brand", lambda s: dealt(s, d, "part", "p_partkey"), lambda df: M.classes(df, "brand", "p_partkey", ["p_name"], "p_brand", [ask], [f"Brand#{i}{j}" for i in range(1, 6) for j in range(1, 6)]), {"ask": ask})
        return [customers, parts]

    path = dedup.shared_folder(spark, "sources")
    said = [P.build(spark, both(ask), path) for ask in ("Which brand is this part of?", "Which brand is this part of?", "What brand is this?")]
    told = spark.createDataFrame([(name, *(x[name] for x in said)) for name in said[0]], "source string, first string, second string, third string")
    return P.read(spark, path).groupBy("source").agg(F.count("*").alias("n")).join(told, "source")


TONES = ("calm", "eager", "formal", "rude")


@query(
    "request_jobs",
    f"""WITH t AS (SELECT conv_id, length('text: ' || arg_min(text, turn)) AS n FROM conversations WHERE role = 'user' AND text IS NOT NULL GROUP BY conv_id),
z AS (SELECT conv_id, list_transform([0, 1, 2, 3], lambda i: exp(((n * (i + 3)) % 11) / 2.0)) AS z FROM t)
SELECT CAST(conv_id AS VARCHAR) AS request_id, {sql_list(TONES)}[list_position(z, list_max(z))] AS answer, round(z[1] / list_sum(z), 4) AS calm, round(z[4] / list_sum(z), 4) AS rude, TRUE AS same FROM z""",
)
def request_jobs(spark, d):
    """The conversations' first requests as JSON lines, answered as one job and as a stream; same tells whether both say the same."""
    from .scorer import CallableScorer
    from .serve import read_answers, request_file, request_stream

    turns = table(spark, d, "conversations").where("role = 'user' and text is not null").groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"))
    tones = F.create_map(*[F.lit(x) for t in TONES for x in (t, "")])
    question = F.struct(F.lit("choice").alias("type"), F.lit("What tone is this in?").alias("instructions"), tones.alias("criteria"))
    rows = turns.select(F.col("conv_id").cast("string").alias("request_id"), F.create_map(F.lit("text"), "text").alias("state"), F.create_map(F.lit("tone"), question).alias("questions"))
    base, scorer = dedup.shared_folder(spark, "requests"), CallableScorer(lambda s, q, o: [((len(s) * (i + 3)) % 11) / 2 for i in range(len(o))])
    rows.write.json(f"{base}/in")
    request_file(spark, f"{base}/in", f"{base}/job", scorer)
    request_stream(spark, f"{base}/in", f"{base}/stream", f"{base}/state", scorer, files=1).awaitTermination()
    one, two = (read_answers(spark, f"{base}/{x}").select("request_id", F.element_at("answers", F.lit("tone")).alias(x)) for x in ("job", "stream"))
    p = F.col("stream.probabilities")
    both = one.join(two, "request_id", "full")
    return both.select("request_id", F.col("stream.answer").alias("answer"), *(F.element_at(p, F.lit(t)).alias(t) for t in ("calm", "rude")), F.to_json("job").eqNullSafe(F.to_json("stream")).alias("same"))


# --- reports ----------------------------------------------------------------------------------------------------------


@query("report_audit", "SELECT source, count(*) AS n, round(avg(CAST(quality AS DOUBLE)), 6) AS agree FROM labels l JOIN documents d ON d.doc_id = l.doc_id WHERE lang = 'en' GROUP BY source")
def report_audit(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "lang")
    done = table(spark, d, "labels").join(docs, "doc_id").select(F.col("doc_id").alias("id"), "source", F.col("quality").alias("agree"))
    return reports.audit_of(done, docs.where("lang = 'en'").select(F.col("doc_id").alias("id"))).select("source", "n", r6("agree"))


@query("report_categories", "SELECT r_name AS category, count(*) AS sources, sum(n)::BIGINT AS n FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY ALL) JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY r_name")
def report_categories(spark, d):
    stats = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("n"))
    categories = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("nation"), F.col("r_name").alias("category"))
    return reports.with_category(stats, categories, "nation").groupBy("category").agg(F.count("*").alias("sources"), F.sum("n").alias("n"))


@query(
    "report_family_acceptance",
    """WITH f AS (SELECT lang AS type, source AS family, avg(coalesce(CAST(quality AS DOUBLE), 0)) AS share FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY ALL)
SELECT type, round(min(share), 6) AS least, round(median(share), 6) AS median, round(max(share), 6) AS greatest, list(family ORDER BY share, family)[1] AS lowest, list(family ORDER BY share DESC, family DESC)[1] AS highest FROM f GROUP BY type""",
)
def report_family_acceptance(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.col("lang").alias("type"), F.col("source").alias("family")).join(table(spark, d, "labels").select("doc_id", F.col("quality").alias("accepted")), "doc_id", "left")
    return reports.family_acceptance(rows).select("type", r6("least"), r6("median"), r6("greatest"), "lowest", "highest")


@query("report_funnel", "SELECT reason, n, row_number() OVER (ORDER BY n DESC, reason) AS place, round(n / sum(n) OVER (), 6) AS share FROM (SELECT coalesce(event_type, 'accepted') AS reason, count(*) AS n FROM events GROUP BY ALL)")
def report_funnel(spark, d):
    return reports.funnel(table(spark, d, "events").select(F.col("event_type").alias("reason"))).select("reason", "n", "place", r6("share"))


@query("report_source_bars", f"WITH {PRED}, b AS (SELECT source, count(*) AS n, avg(correct) AS acc, avg(1 / len(p)) AS chance FROM s1 GROUP BY source) SELECT source, n, round(acc, 6) AS acc, round(chance, 6) AS chance, row_number() OVER (ORDER BY acc DESC, source) AS place FROM b")
def report_source_bars(spark, d):
    rows = single_predictions(spark, d).select("source", (A.argmax(F.col("p")) == F.col("a")).alias("correct"), F.size("p").alias("n_options"))
    return reports.source_bars(rows).select("source", "n", r6("acc"), r6("chance"), "place")


@query(
    "report_early_stopping",
    """WITH b AS (SELECT user_id, event_id, value, min(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM events),
g AS (SELECT *, value IS NOT NULL AND (before IS NULL OR value < before) AS better, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM b),
r AS (SELECT *, k - coalesce(max(CASE WHEN better THEN k END) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS bad FROM g),
s AS (SELECT *, min(CASE WHEN bad >= 8 THEN event_id END) OVER (PARTITION BY user_id) AS stopped FROM r)
SELECT user_id AS run, any_value(stopped) AS stopped, round(min(value), 6) AS best, max(CASE WHEN better THEN event_id END) AS best_step FROM s WHERE stopped IS NULL OR event_id <= stopped GROUP BY user_id""",
)
def report_early_stopping(spark, d):
    evals = table(spark, d, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("nll"))
    return reports.early_stopping(evals).select("run", "stopped", r6("best"), "best_step")


@query(
    "report_benchmark_ratios",
    """WITH r AS (SELECT event_type AS benchmark, avg(CASE WHEN value >= 50 THEN 1.0 ELSE 0 END) AS acc, avg(value) AS ms, max(value) AS teacher_ms FROM events GROUP BY event_type)
SELECT benchmark, round(acc, 6) AS acc, round(teacher_ms / nullif(ms, 0), 6) AS speedup FROM r UNION ALL SELECT 'Mean', round(avg(acc), 6), NULL FROM r""",
)
def report_benchmark_ratios(spark, d):
    rows = table(spark, d, "events").groupBy(F.col("event_type").alias("benchmark")).agg(F.avg(F.when(F.col("value") >= 50, 1.0).otherwise(0.0)).alias("acc"), F.avg("value").alias("ms"), F.max("value").alias("teacher_ms"))
    return reports.benchmark_ratios(rows).select("benchmark", r6("acc"), r6("speedup"))


@query(
    "report_display_rows",
    """SELECT CASE WHEN quality = 1 THEN 'doc:' || d.doc_id ELSE 'syn:' || d.doc_id END AS id, CASE WHEN quality = 1 THEN source ELSE 'synth' END AS source, 'choice' AS type, md5(CASE WHEN quality = 1 THEN coalesce(text, '') ELSE '' END) AS state_md5,
CASE WHEN quality = 1 THEN 2 ELSE 0 END AS options, CASE WHEN quality = 1 THEN lang END AS family, CAST(NULL AS VARCHAR) AS why FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def report_display_rows(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    made = F.struct(F.concat(F.lit("doc:"), F.col("doc_id")).alias("id"), "source", F.lit("").alias("type"), F.col("text").alias("state"), F.lit("Is it good?").alias("question"), M.words(M.YES_NO).alias("options"), F.array(F.lit(0)).alias("answer"), F.struct(F.col("lang").alias("family"), F.lit(1).alias("other")).alias("meta"))
    outcomes = rows.select(F.col("doc_id").alias("jid"), F.lit("ok").alias("status"), F.lit(None).cast("string").alias("reason"), F.lit("choice").alias("type"), F.lit(0.5).alias("p_answer"), "quality", F.when(F.col("quality") == 1, made).alias("record"))
    return reports.display_rows(outcomes).select("id", "source", "type", F.md5("state").alias("state_md5"), F.size("options").alias("options"), F.col("meta")["family"].alias("family"), F.col("meta")["why"].alias("why"))


@query("record_costs", "SELECT doc_id, coalesce(length(text), 0) + 11 + 5 AS cost FROM documents")
def record_costs(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.col("text").alias("state"), F.lit("Is it good?").alias("question"), M.words(M.YES_NO).alias("options"))
    return rows.select("doc_id", reports.cost().alias("cost"))


@query("render_states", """SELECT n_nationkey, 'name: ' || n_name || chr(10) || 'key: ' || n_nationkey || chr(10) || 'first: ' || CASE WHEN n_nationkey = 0 THEN 'True' ELSE 'False' END || chr(10) || 'none: None' || chr(10) || 'tags: ["' || n_name || '", "x y"]' || chr(10) || 'in: {"region": ' || n_regionkey || ', "say": "\\"hi\\""}' || chr(10) || 'end' AS shown FROM nation""")
def render_states(spark, d):
    from .serve import render

    inner = F.struct(F.col("n_regionkey").alias("region"), F.lit('"hi"').alias("say"))
    shown = F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").alias("key"), (F.col("n_nationkey") == 0).alias("first"), F.lit(None).cast("string").alias("none"), F.array("n_name", F.lit("x y")).alias("tags"), inner.alias("in"))
    rows = table(spark, d, "nation").select("n_nationkey", shown.alias("state"))
    # a list is its elements, each rendered in turn
    return rows.select("n_nationkey", F.array_join(F.array(render(F.col("state"), rows.schema["state"].dataType), F.lit("end")), "\n").alias("shown"))


# --- mappers of single sets -------------------------------------------------------------------------------------------


@query("map_faithful", f"SELECT 'faith:' || doc_id AS id, CAST({h60("'coin:faith:' || doc_id")} % 2 AS VARCHAR) AS answer FROM documents WHERE lang IN ('de', 'en', 'es')")
def map_faithful(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", *(F.concat(F.lit(c + " "), "doc_id").alias(c) for before, _, good, bad, _ in M.FAITHFUL.values() for c in (good, bad)), *(F.col("source").alias(c) for c in ("knowledge", "question", "dialogue_history", "document")))
    made = [M.faithful(docs.where(F.col("lang") == lang), "faith", "doc_id", config) for lang, config in (("de", "qa"), ("en", "dialogue"), ("es", "summarization"), ("fr", "other"))]
    rows = made[0]
    for more in made[1:]:
        rows = rows.unionByName(more)
    return rows.select("id", F.array_join("answer", ",").alias("answer"))


@query("map_graded_yes_no", "SELECT 'legal:' || o_orderkey AS id, CASE lower(trim(o_orderstatus)) WHEN 'f' THEN '0' ELSE '1' END AS answer FROM orders WHERE lower(trim(o_orderstatus)) IN ('f', 'o')")
def map_graded_yes_no(spark, d):
    orders = table(spark, d, "orders")
    return M.graded_yes_no(orders, "legal", "o_orderkey", F.concat(F.lit("Order of "), "o_orderpriority"), F.lit("Is the order closed?"), "o_orderstatus", ("f", "yes"), ("o", "no")).select("id", F.array_join("answer", ",").alias("answer"))


@query("map_graded_choice", "SELECT 'legal:' || o_orderkey AS id, 'F|O' AS options, CASE o_orderstatus WHEN 'F' THEN '0' ELSE '1' END AS answer FROM orders WHERE o_orderstatus IN ('F', 'O')")
def map_graded_choice(spark, d):
    orders = table(spark, d, "orders")
    return M.graded_choice(orders, "legal", "o_orderkey", F.concat(F.lit("Order of "), "o_orderpriority"), F.lit("Which state is the order in?"), "o_orderstatus", ("F", "O")).select("id", F.array_join("options", "|").alias("options"), F.array_join("answer", ",").alias("answer"))
