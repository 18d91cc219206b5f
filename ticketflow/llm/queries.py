"""The operators bound to the driver's tables: one query each, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketflow.llm import (
    ann,
    chat_format,
    collocations,
    decontamination,
    filter_audit,
    language_id,
    lm_scoring,
    mixing,
    quality_classifier,
    secret_scan,
    sharding,
    simhash_near_dedup,
    warc,
)
from ticketflow.llm.common import table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dedup.near_duplicates(
        table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix_documents(docs).selectExpr(
        "doc_id", "domain", "coalesce(lang, 'und') as lang", "coalesce(source, 'unknown') as source", "epoch")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ann.usable(table(spark, sf_dir, "embeddings"))
    return ann.search(rows, rows.where("vec_id % 20 = 0"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.format_conversations(rows.unionByName(chat_format.planted(spark)))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_simhash_near_dedup, op2_lm_scoring, op3_quality_classifier, op4_benchmark_decontamination,
    op5_secret_scan, op6_mixing, op7_sharding, op8_language_id, op9_warc, op10_nearest_neighbours,
    op11_collocations, op12_chat_format, op13_filter_audit)}

#: SQL for those that SQL can express; the others are tested against brute force.
ORACLE = {
    "op4_benchmark_decontamination": decontamination.oracle_sql(),
    "op5_secret_scan": secret_scan.oracle_sql(),
    "op6_mixing": mixing.oracle_sql(),
    "op7_sharding": sharding.oracle_sql(),
    "op9_warc": warc.ORACLE_SQL,
    "op11_collocations": collocations.oracle_sql(),
    "op12_chat_format": chat_format.oracle_sql(),
    "op13_filter_audit": filter_audit.oracle_sql(),
}
