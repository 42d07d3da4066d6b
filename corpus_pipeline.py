"""A corpus through five stages: language, repeated lines, near copies, personal data, sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a DataFrame; run() writes
each as Parquet in the shared folder and reads it back as the next one's docs. All but the last return the columns
of docs. Nulls, empty texts and repeated rows are treated as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, language, lines, packing, pii
from tidemark.llm.common import Scratch, table

ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars follows a changed text, where the column exists."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those far from every known one, or without letters, go."""
    names = ("__tm_lang", "__tm_score", "__tm_rejected")
    return language.predict(docs, language.fit(docs), names).where(~F.col("__tm_rejected")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated runs of lines; one that loses every line goes."""
    done = lines.dedup(spark, docs)
    return _counted(done.where((F.col("__tm_removed") == 0) | (F.col("__tm_removed") < F.col("__tm_lines"))).select(*docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return jaccard.keep_one(spark, docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return _counted(pii.redact(spark, docs))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids, in sequences of 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("jaccard_join", near_copies),
    ("personal_data", personal_data),
    ("packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark), table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs, before = scratch.keep(stage(spark, docs, sf_dir)), docs
        scratch.drop(before)
    return docs
