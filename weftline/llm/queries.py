"""The registered queries of this subpackage, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import bpe_codec, chat_format, decontamination, merkle, ngram_join, packing, quality_model, quality_rules, spelling, token_counts, toxicity, url_filter, warc
from weftline.llm.common import table


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counts(table(spark, sf_dir, "documents"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(chat_format.ADDED, rows.schema))
    return chat_format.digests(chat_format.segments(chat_format.of_rows(rows)))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(k,) for k in url_filter.LISTED], "key string")
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.RULES, listed)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_model.score(docs, *quality_model.train(docs))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, tampered=merkle.tampering(docs)).drop("path")


def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.coded(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_warc": op4_warc,
    "op5_token_counts": op5_token_counts,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_url_filters": op7_url_filters,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_quality_rules": op9_quality_rules,
    "op10_packing": op10_packing,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_bpe_codec": op13_bpe_codec,
}

ORACLE_SQL = {
    "op1_ngram_join": ngram_join.ORACLE_SQL,
    "op4_warc": warc.ORACLE_SQL,
    "op6_chat_formatting": chat_format.ORACLE_SQL,
    "op7_url_filters": url_filter.ORACLE_SQL,
    "op9_quality_rules": quality_rules.ORACLE_SQL,
    "op11_spelling_variants": spelling.ORACLE_SQL,
    "op12_merkle_manifest": merkle.ORACLE_SQL,
}
