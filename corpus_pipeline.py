"""Corpus pipeline: language ID, exact dedup, near-duplicate join, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``; the last returns the packed pieces.

1. language ID drops texts that the nearest-centroid model, learnt from the labelled rows of docs, rejects;
2. exact dedup drops copies (equal but for white space), keeping the longest original, then the smallest doc_id;
3. the Jaccard join keeps the smallest doc_id of each component of texts that share 0.8 of their five-word shingles;
4. personal data found by the semi-Markov model is replaced by its kind in angle brackets, and n_chars follows;
5. packing places the ids of every text in sequences of 4096 tokens.

Nulls, empty texts, repeated rows and extra columns are treated as the operators' docstrings say. The stages can't be
written in SQL as a whole, so ``ORACLE_SQL`` is None and tests compare with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import exact_dedup, jaccard_join, language_id, packing, pii
from railyard.llm.common import documents, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.learn(docs)
    return language_id.predict(docs, model).where(~F.col("rejected")).select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one_of_each(docs, jaccard_join.Join(width=5, num=8, den=10))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redacted(docs, pii.learn(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in clean.columns else clean


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.word_tokens())


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("PII", personal_data),
    ("packing", sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
