"""Corpus preparation: the stages from raw documents to packed training sequences.

Every stage works on all that its predecessor kept and returns whole rows of
``documents``; only the last returns packed pieces. Between stages the rows are written as
Parquet to the shared checkpoint folder and read again, so a lost executor never reaches back
further than one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortine.llm.base import read
from cohortine.llm.langid import filter_language, learn_languages
from cohortine.llm.packing import pack_documents
from cohortine.llm.ranking import keep_good
from cohortine.llm.simhash import drop_near_duplicates
from cohortine.session import materialise, release, scratch

#: A text less close than this to every language profile is no language.
MIN_CLOSENESS = 0.2


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the pairwise ranking, learned from ``labels``, accepts."""
    return keep_good(docs, read(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in a recognised language."""
    return filter_language(docs, learn_languages(docs), min_score=MIN_CLOSENESS)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest ``doc_id`` of every group of near duplicates."""
    return drop_near_duplicates(docs, max_distance=3, words_per_shingle=3)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 4096 tokens."""
    import public_tokenizers  # only here, so that the module loads without it

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_dedup),
    ("packing", packing),
]

#: Trained models, hashes and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with scratch(spark) as kept:
            following = materialise(stage(spark, docs, sf_dir))
            kept.append(following)
        release(docs)
        docs = following
    return docs
