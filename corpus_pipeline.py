"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir); what it returns is written and read again as the next one's
documents. The last stage returns the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.functions.storage import cut
from shelfwise.llm import decontaminate, jaccard, packing, pii, toxicity
from shelfwise.llm.queries import PSEUDONYM_KEY, crc_of_id
from shelfwise.sources.tables import table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier of operator 1 rejects."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=crc_of_id(3) != 1)
    return toxicity.without_toxic(docs, model)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near copies of operator 10 (five words, similarity 0.8).

    Rows that share an id are one document, of which the row with the smallest text (null first) stays.
    Documents without an id are in no group and stay.
    """
    groups = cut(jaccard.similar_groups(docs, words=5, percent=80).where("doc_id is not null"))
    rest = groups.where("component_id <> doc_id").select(F.col("doc_id").alias("copy")).distinct()
    kept = docs.join(rest, docs["doc_id"] == rest["copy"], "left_anti")
    repeated = groups.where("component_id = doc_id").groupBy(F.col("doc_id").alias("again")).agg(F.count("*").alias("n")).where("n > 1").select("again")
    several = kept.join(repeated, kept["doc_id"] == repeated["again"], "left_semi")
    first = several.groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.struct("text", F.xxhash64(*docs.columns))).alias("row"))
    return kept.join(repeated, kept["doc_id"] == repeated["again"], "left_anti").unionByName(first.select("row.*"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item by operator 6."""
    return decontaminate.without_contaminated(docs, decontaminate.build(table(spark, sf_dir, "benchmark")))


def with_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by operator 2; ``n_chars`` follows the new text."""
    return pii.with_pseudonyms(docs, PSEUDONYM_KEY).withColumn("n_chars", F.char_length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of 2048 tokens by operator 4."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("pseudonyms", with_pseudonyms),
    ("best-fit packing", packed),
]
# Classifier, count-vector search, tokenizer and Feistel rounds are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
