"""The registered queries of this subpackage: opN_<name> over whole tables, and the SQL that states them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import audio, bpe, chat, jaccard, language, lines, packing, pii, quality, secret_scan
from tidemark.llm.common import Scratch, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _register(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@_register
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_register
def op6_telephony_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = Scratch(spark).keep(audio.store_payloads(table(spark, sf_dir, "documents")))
    return audio.read_media(stored, keep_pcm=False).select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )


@_register
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).selectExpr("-7L conv_id", "id turn", "if(id = 0, 'user', 'assistant') role", r"r'\### Assistant: </turn> ok' text")
    return chat.read_back(chat.format_records(chat.rows_to_records(turns.unionByName(planted))))


ORACLE_SQL["op10_chat_format"] = chat.oracle_sql()


@_register
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), language.held_out().alias("held_out"), "text")
    return language.predict(texts, model).select("doc_id", "held_out", "lang_pred", "score", "rejected")


@_register
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@_register
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality.measure(table(spark, sf_dir, "documents"))
    return measured.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars")


ORACLE_SQL["op3_quality_rules"] = quality.oracle_sql()


@_register
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(spark, table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda c: c["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *(count(kind) for kind in pii.BASE_KINDS),
        F.sha2(pii.joined(F.filter("spans", lambda c: c["base"])), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


@_register
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return lines.dedup(spark, docs).select("doc_id", F.col("__tm_lines").alias("n_lines"), F.col("__tm_removed").alias("n_removed"), "text")


ORACLE_SQL["op4_line_dedup"] = lines.oracle_sql()


@_register
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(spark, table(spark, sf_dir, "documents"))
    return found.where("is_secret").select("doc_id", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), F.sha2("value", 256).alias("value_sha256"), "score")


@_register
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(spark, table(spark, sf_dir, "documents"))


ORACLE_SQL["op7_jaccard_join"] = jaccard.oracle_sql()
