"""Registered corpus queries: each operator over its whole table, and SQL checks."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import read
from .bytepair import encode_documents
from .chat import conversation_digests, format_conversations
from .covertree import mine_hard_negatives, scaled_floor
from .langid import learn_languages, predict_language
from .lexical import rank_documents
from .licences import recognise_licences
from .multiindex import sign_code, top_k
from .oracles import ALL
from .packing import pack_documents
from .ranking import rank_quality
from .repetition import repetition_quality
from .simhash import near_duplicates
from .substrings import remove_repeated_passages
from .urls import SiteRule, judge_urls

#: The site rules of the URL query.
SITE_RULES = (
    SiteRule("allow", "com", "/"),
    SiteRule("block", "example.com", "/en/"),
    SiteRule("allow", "www.example.com", "/en/"),
    SiteRule("block", "net", "/es/"),
    SiteRule("block", "net", "/fr/"),
)
#: The added conversation and what both its turns say.
ADDED_CONVERSATION = -1
ADDED_TEXT = "</s>[INST] ok [/INST]"


def op1_multiindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors, by the signs of their elements, of every twentieth vector."""
    codes = read(spark, sf_dir, "embeddings").select("vec_id", sign_code("embedding").alias("code"))
    return top_k(codes, codes.where("vec_id % 20 = 0"), 10)


def op2_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_quality(read(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), 3, 3)


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(ADDED_CONVERSATION).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ADDED_TEXT).alias("text"),
    )
    return conversation_digests(format_conversations(turns.unionAll(added)))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return predict_language(docs, learn_languages(docs))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"), SITE_RULES)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(
        read(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        with_ids=False,
    )


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recognise_licences(read(spark, sf_dir, "documents"))


def op9_bytepair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(
        read(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        with_ids=False,
    )


def op10_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return rank_quality(docs, read(spark, sf_dir, "labels"))


def op11_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(read(spark, sf_dir, "documents"), 50, with_text=False)


def op12_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, after moving every seventh label on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").select(
        "vec_id", label.alias("label"), scaled_floor("embedding", 256).alias("vector")
    )
    return mine_hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_multiindex": op1_multiindex,
    "op2_repetition": op2_repetition,
    "op3_simhash": op3_simhash,
    "op4_chat": op4_chat,
    "op5_langid": op5_langid,
    "op6_urls": op6_urls,
    "op7_packing": op7_packing,
    "op8_licences": op8_licences,
    "op9_bytepair": op9_bytepair,
    "op10_ranking": op10_ranking,
    "op11_substrings": op11_substrings,
    "op12_covertree": op12_covertree,
    "op13_lexical": op13_lexical,
}

ORACLES: dict[str, str] = dict(ALL)
