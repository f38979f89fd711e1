"""The catalogue of this subpackage: one query per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from offerlake.llm import ann, filter_audit, line_dedup, mixing, phrases, pieces, quality_crf, secret_scan, sharding, surrogates, toxicity, url_filter
from offerlake.llm.minhash_dedup import near_duplicates
from offerlake.llm.spark import read
from offerlake.llm.sql import ORACLES  # noqa: F401

# A deployment passes its own secret; the catalogue's runs have to agree with each other.
SURROGATE_KEY = b"catalogue"


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), shingle=2)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "text", "n_lines", "n_removed")


def op3_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_crf.judge(docs, quality_crf.train(docs, read(spark, sf_dir, "labels")))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(read(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    return url_filter.judge(read(spark, sf_dir, "pages"), rules)


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace(read(spark, sf_dir, "documents"), SURROGATE_KEY)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(read(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(read(spark, sf_dir, "documents"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_minhash_dedup, op2_line_dedup, op3_quality_crf, op4_secret_scan, op5_url_filter, op6_pii_surrogates, op7_sentencepiece, op8_mixing, op9_ann, op10_toxicity, op11_filter_audit, op12_sharding, op13_phrases, pipeline)}
