"""Per-arm summary statistics for report sections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import arm_column, percent
from ..session import materialise
from .quantiles import grouped_medians
from .tables import emergent, subject_event_flags


def demographics_summary(adsl: DataFrame) -> DataFrame:
    """Subjects, age statistics and sex shares per arm.

    A subject without recorded sex still counts in the denominators. Without an AGE
    column its statistics are NULL.
    """
    arm = arm_column(adsl)
    rows = F.count(F.lit(1))
    adsl = _optional(adsl, "AGE")
    medians = _medians(adsl, arm, "AGE", "age_median")

    def sex(code: str):
        return F.count_if(F.col("SEX") == code)

    age = F.col("AGE").cast("double")
    summary = (
        adsl.where(F.col(arm).isNotNull())
        .groupBy(F.col(arm).alias("arm"))
        .agg(
            rows.alias("n"),
            F.round(F.avg(age), 1).alias("age_mean"),
            F.round(F.stddev_samp(age), 2).alias("age_sd"),
            F.min(age).cast("bigint").alias("age_min"),
            F.max(age).cast("bigint").alias("age_max"),
            sex("M").alias("sex_m_n"),
            sex("F").alias("sex_f_n"),
            F.round(percent(sex("M"), rows), 1).alias("sex_m_pct"),
            F.round(percent(sex("F"), rows), 1).alias("sex_f_pct"),
        )
    )
    return _with_medians(summary, medians, "age_median", after="age_sd")


def _optional(df: DataFrame, column: str) -> DataFrame:
    """``df`` with the column, NULL if it is absent."""
    return df if column in df.columns else df.withColumn(column, F.lit(None).cast("double"))


def _medians(df: DataFrame, arm: str, column: str, name: str) -> DataFrame:
    medians = grouped_medians(df.select(F.col(arm).alias("arm"), column), "arm", column, name)
    return medians.withColumn(name, F.round(name, 1))


def _with_medians(summary: DataFrame, medians: DataFrame, name: str, after: str) -> DataFrame:
    """The summary with the medians of its arms as the column behind ``after``."""
    place = summary.columns.index(after) + 1
    order = [*summary.columns[:place], name, *summary.columns[place:]]
    return summary.join(medians, "arm", "left").select(*order)


def safety_summary(adae: DataFrame, adsl: DataFrame) -> DataFrame:
    """Subjects with emergent events, by kind, against all subjects of the arm."""
    adsl_arm = arm_column(adsl)
    sizes = (
        adsl.where(F.col(adsl_arm).isNotNull())
        .groupBy(F.col(adsl_arm).alias("arm"))
        .agg(F.count(F.lit(1)).alias("n_safety"))
    )
    arm = arm_column(adae)
    counts = (
        subject_event_flags(adae, arm)
        .groupBy(F.col(arm).alias("arm"))
        .agg(
            F.count(F.lit(1)).alias("n_any_teae"),
            F.count_if("serious").alias("n_serious"),
            F.count_if("related").alias("n_related"),
            F.count_if("grade3").alias("n_grade3plus"),
        )
    )
    joined = sizes.join(counts, "arm", "left").na.fill(0)
    share = F.round(percent(F.col("n_any_teae"), F.col("n_safety")), 1)
    return joined.select(
        "arm",
        "n_safety",
        "n_any_teae",
        share.alias("pct_any_teae"),
        "n_serious",
        "n_related",
        "n_grade3plus",
    )


def top_terms(adae: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` preferred terms per arm with most subjects; ties by term."""
    arm = arm_column(adae)
    counts = (
        emergent(adae)
        .where(F.col(arm).isNotNull() & F.col("AEDECOD").isNotNull())
        .where(F.col("USUBJID").isNotNull())
        .select(F.col(arm).alias("arm"), F.col("AEDECOD").alias("term"), "USUBJID")
        .distinct()
        .groupBy("arm", "term")
        .agg(F.count(F.lit(1)).alias("n_subjects"))
    )
    ranking = Window.partitionBy("arm").orderBy(F.desc("n_subjects"), F.asc("term"))
    return counts.withColumn("rank", F.row_number().over(ranking).cast("bigint")).where(
        F.col("rank") <= k
    )


def time_to_event_summary(adtte: DataFrame, endpoint: str | None = None) -> DataFrame:
    """Subjects, events and raw time statistics per arm.

    ``endpoint`` may be a parameter code or a parameter label. Without an AVAL column
    its statistics are NULL.
    """
    if endpoint is not None:
        named = [F.col(c) == endpoint for c in ("PARAMCD", "PARAM") if c in adtte.columns]
        if not named:
            raise ValueError("the dataset has no PARAMCD or PARAM to select an endpoint by")
        condition = named[0]
        for other in named[1:]:
            condition = condition | other
        adtte = adtte.where(condition)
    arm = arm_column(adtte)
    rows = F.count(F.lit(1))
    adtte = _optional(adtte, "AVAL")
    medians = _medians(adtte, arm, "AVAL", "median_aval")
    events = F.count_if(F.col("CNSR") == 0)
    value = F.col("AVAL").cast("double")
    summary = (
        adtte.where(F.col(arm).isNotNull())
        .groupBy(F.col(arm).alias("arm"))
        .agg(
            rows.alias("n"),
            events.alias("n_events"),
            F.count_if(F.col("CNSR") == 1).alias("n_censored"),
            F.round(percent(events, rows), 1).alias("event_rate"),
            F.round(F.min(value), 1).alias("min_aval"),
            F.round(F.max(value), 1).alias("max_aval"),
        )
    )
    return _with_medians(summary, medians, "median_aval", after="event_rate")


def _only(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[c for c in dict.fromkeys(names) if c in df.columns])


def _subject_terms(adae: DataFrame) -> DataFrame:
    """Emergent events with one row per arm, subject and term that carries the worst of each kind."""
    worst = {
        "ASER": F.max(F.when(F.col("ASER") == "Y", "Y")),
        "AEREL": F.max(F.when(F.col("AEREL") == "Y", "Y")),
        "AEOUT": F.max(F.when(F.col("AEOUT") == "FATAL", "FATAL")),
        "ATOXGR": F.max("ATOXGR"),
    }
    kinds = [worst[c].alias(c) for c in worst if c in adae.columns]
    grouped = emergent(adae).groupBy(arm_column(adae), "USUBJID", "AEDECOD")
    return grouped.agg(*kinds) if kinds else grouped.count().drop("count")


def section_payload(
    adsl: DataFrame, adae: DataFrame, adtte: DataFrame, endpoint: str | None = None
) -> DataFrame:
    """The statistics of sections 11.2, 11.4 and 11.5 as JSON, one row per arm.

    Each dataset is read once, into a table of what the sections need of it: the subjects, the
    worst event per subject and term, and the times. The sections read these.
    """
    subjects = materialise(_only(adsl, arm_column(adsl), "AGE", "SEX"))
    adae = materialise(_subject_terms(adae))
    adtte = materialise(
        _only(adtte, arm_column(adtte), "PARAMCD", "PARAM", "AVAL", "CNSR")
    )
    adsl = subjects

    def as_rows(summary: DataFrame, section: str, title: str) -> DataFrame:
        stats = [c for c in summary.columns if c != "arm"]
        return summary.select(
            F.lit(section).alias("section"),
            F.lit(title).alias("section_title"),
            "arm",
            F.to_json(F.struct(*stats), {"ignoreNullFields": "false"}).alias("stats"),
        )

    # At most five terms per arm.
    terms = (
        top_terms(adae)
        .groupBy("arm")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "term", "n_subjects"))).alias("ranked"))
        .select("arm", F.col("ranked").alias("top5_preferred_terms"))
    )
    safety = safety_summary(adae, adsl).join(terms, "arm", "left")
    demographics = demographics_summary(adsl)
    efficacy = time_to_event_summary(adtte, endpoint)
    return (
        as_rows(demographics, "11.2", "Demographic and Baseline Characteristics")
        .unionByName(as_rows(efficacy, "11.4", "Analysis of Efficacy"))
        .unionByName(as_rows(safety, "11.5", "Safety and Tolerability"))
    )
