"""From raw documents to packed sequences: language ID, exact dedup, near dedup, decontamination, packing.

Each stage is written as Parquet and read again as the next one's documents. All but the last return
the columns of documents; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from decisionframe.llm.common import documents, prepare, staged
from decisionframe.llm.decontaminate import remove_documents
from decisionframe.llm.exact_dedup import exact_dedup
from decisionframe.llm.jaccard_join import near_dedup
from decisionframe.llm.langid import identified
from decisionframe.llm.packing import pack
from decisionframe.llm.queries import tokenizer_path

#: Documents whose best language has a lower score are rejected, as are those without letters.
LEAST_SCORE = 0.3
#: Near duplicates share this many hundredths of their shingles of so many words at least; op10's contract has its own figures.
NEAR_PERCENT, NEAR_WORDS = 80, 5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return identified(docs, LEAST_SCORE)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_dedup(docs, NEAR_PERCENT, NEAR_WORDS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_documents(docs, documents(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup_stage),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Language ID and packing can't be expressed in SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
