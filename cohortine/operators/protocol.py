"""Placement of protocol endpoints and criteria in datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.protocol_rules import RULES
from ..session import materialise, release
from ..sources.protocols import ITEM_FIELDS


def protocol_items(protocols: DataFrame) -> DataFrame:
    """One row per endpoint or criterion, with its list and position (from 1)."""
    kinds = F.array(
        *[F.struct(F.lit(n).alias("kind"), F.col(n).alias("texts")) for n in ITEM_FIELDS]
    )
    return (
        protocols.select("protocol_number", F.inline(kinds))
        .select("protocol_number", "kind", F.posexplode("texts").alias("position", "endpoint"))
        .withColumn("position", (F.col("position") + 1).cast("bigint"))
    )


#: Words and comparison signs of a text; everything else separates.
_TERM = r"[\p{L}\p{N}]+|[<>]=?|="


def terms(text: Column) -> Column:
    """Lower-case words of a text without a plural s; so "Doses" is "dose", "overdose" is not."""
    words = F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0))
    plural = lambda w: (F.length(w) > 3) & w.endswith("s") & ~w.endswith("ss")
    return F.transform(words, lambda w: F.when(plural(w), F.rtrim(w, F.lit("s"))).otherwise(w))


def default_rules(spark: SparkSession) -> DataFrame:
    """The rules of :mod:`.protocol_rules` as a table."""
    return spark.createDataFrame(
        [tuple(rule) for rule in RULES], "keyword string, domain string, dataset string, confidence string"
    )


#: A text is frequent if more than one item in so many has it; so there are fewer than that.
FREQUENT = 1000
#: Rows from which the looked-up side of a join is hashed by part, so that the other is not sorted.
_LARGE = 100_000


def _phrases(text: Column, lengths: Sequence[int]) -> Column:
    """All different runs of so many words of a text, joined by blanks."""

    def of_length(words: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
        found = F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))
        return F.when(F.size(words) >= n, found).otherwise(F.array().cast("array<string>"))

    # The words are found once.
    return F.transform(
        F.array(terms(text)),
        lambda words: F.array_distinct(F.concat(*[of_length(words, n) for n in lengths])),
    )[0]


def _hashed(df: DataFrame, rows: int) -> DataFrame:
    return df.hint("shuffle_hash") if rows > _LARGE else df


def _best_rules(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """``__text`` and ``rule`` of every text that a rule fits."""
    # Of rules with the same words one is the best wherever they fit.
    best = F.min(
        F.struct(
            (-F.size("phrase")).alias("words"),
            (-F.length("keyword")).alias("length"),
            "keyword",
            "domain",
            "dataset",
            "confidence",
        )
    ).alias("rule")
    index = materialise(
        rules.select(terms(F.col("keyword")).alias("phrase"), "keyword", "domain", "dataset", "confidence")
        .where(F.size("phrase") > 0)
        .groupBy(F.array_join("phrase", " ").alias("phrase"), F.size("phrase").alias("words"))
        .agg(best)
    )
    sizes = {row["words"]: row["count"] for row in index.groupBy("words").count().collect()}
    return (
        texts.select("__text", F.explode(_phrases(F.col("endpoint"), sorted(sizes) or [1])).alias("phrase"))
        .join(_hashed(index.select("phrase", "rule"), sum(sizes.values())), "phrase")
        .groupBy("__text")
        .agg(F.min("rule").alias("rule"))
    )


def map_items(items: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """Suggest tabulation domain and analysis dataset for every item.

    ``rules`` has ``keyword``, ``domain``, ``dataset`` and ``confidence``. A rule fits where
    the words of its keyword stand in the item one after another; the longest wins, by words and
    then by characters, and on a tie the first in order of its columns. Items without
    one, null items too, get low confidence and need a supplemental qualifier.

    Each different text is looked up once, by equi-joins of its runs of words with the whole
    phrases of the rules, one run per place and length that a rule has. The work grows with
    the words of the texts, not with the rules that begin alike. Items meet their texts by a join in which
    items of frequent texts, and null items, are spread over all parts.
    """
    rules = default_rules(items.sparkSession) if rules is None else rules
    texts = materialise(
        items.where(F.col("endpoint").isNotNull())
        .groupBy("endpoint")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__text", F.monotonically_increasing_id())
    )
    n_texts, n_items = texts.agg(F.count(F.lit(1)), F.sum("__n")).first()
    found = materialise(
        texts.join(_best_rules(texts, rules), "__text", "left").select(
            "endpoint", "__n", "rule", F.lit(0).alias("__zero")
        )
    )
    release(texts)
    frequent = F.col("__n") * FREQUENT > (n_items or 0)
    hot = found.where(frequent).select("endpoint", F.col("rule").alias("__hot"), F.lit(True).alias("__is_hot"))
    rare = found.where(~frequent).select(F.col("endpoint").alias("__rare"), "__zero", "rule")
    others = [c for c in items.columns if c != "endpoint"]
    is_rare = F.col("__is_hot").isNull() & F.col("endpoint").isNotNull()
    spread_out = F.pmod(F.xxhash64(*others), F.lit(1 << 16)).cast("int") if others else F.lit(1)
    rule = F.coalesce("__hot", "rule")
    confidence = F.coalesce(rule["confidence"], F.lit("low"))
    return (
        items.join(F.broadcast(hot), "endpoint", "left")
        # A null key meets nothing, and the place beside it deals its rows over the parts. The
        # zero is read from the table: a literal would not be a key of the join.
        .withColumns(
            {
                "__key": F.when(is_rare, F.col("endpoint")),
                "__place": F.when(is_rare, 0).otherwise(spread_out),
            }
        )
        .join(
            _hashed(rare, n_texts),
            (F.col("__key") == F.col("__rare")) & (F.col("__place") == F.col("__zero")),
            "left",
        )
        .select(
            "endpoint",
            *others,
            rule["domain"].alias("suggested_sdtm_domain"),
            rule["dataset"].alias("suggested_adam_dataset"),
            confidence.alias("confidence"),
            (confidence == "low").alias("requires_suppqual"),
        )
    )


def mapping_summary(mapping: DataFrame) -> DataFrame:
    """One row: items, distinct domains, supplemental and low-confidence counts."""
    return mapping.agg(
        F.count(F.lit(1)).alias("total_endpoints"),
        F.count_distinct("suggested_sdtm_domain").alias("unique_sdtm_domains"),
        F.count_if("requires_suppqual").alias("suppqual_required"),
        F.count_if(F.col("confidence") == "low").alias("low_confidence_count"),
    )
