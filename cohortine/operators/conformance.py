"""Conformance checks on tabulation datasets, reported as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sdtm import Domain


def validate(df: DataFrame, domain: Domain) -> DataFrame:
    """Findings as (domain, rule, severity, n_records, message); none if clean.

    Missing variables are known from the schema; every other rule is a
    conditional count, all taken in one pass.
    """
    counts = [F.count(F.lit(1)).alias("n_all")]
    findings = []

    def finding(rule: str, severity: str, n, message):
        return F.struct(
            F.lit(domain.code).alias("domain"),
            F.lit(rule).alias("rule"),
            F.lit(severity).alias("severity"),
            n.cast("bigint").alias("n_records"),
            message.alias("message"),
        )

    for name in domain.required:
        if name not in df.columns:
            message = F.lit(f"Required variable missing: {name}")
            findings.append(finding("required_variable", "ERROR", F.col("n_all"), message))
    if "STUDYID" in df.columns:
        counts.append(F.count_if(F.col("STUDYID").isNull()).alias("n_study"))
        findings.append(
            finding("study_present", "ERROR", F.col("n_study"), F.lit("STUDYID contains null values"))
        )
    if "DOMAIN" in df.columns:
        counts.append(F.count_if(~F.col("DOMAIN").eqNullSafe(domain.code)).alias("n_domain"))
        message = F.lit(f"DOMAIN value mismatch, expected {domain.code}")
        findings.append(finding("domain_code", "ERROR", F.col("n_domain"), message))
    if "USUBJID" in df.columns:
        well_formed = F.coalesce(F.contains(F.col("USUBJID"), F.lit("-")), F.lit(False))
        counts.append(F.count_if(~well_formed).alias("n_subject"))
        message = F.concat(
            F.col("n_subject").cast("string"),
            F.lit(" USUBJID values may not follow STUDYID-SITEID-SUBJID convention"),
        )
        findings.append(finding("subject_format", "WARNING", F.col("n_subject"), message))

    if not findings:
        findings.append(finding("none", "NONE", F.lit(0), F.lit("")))
    always = F.col("rule") == "required_variable"
    return (
        df.agg(*counts)
        .select(F.inline(F.array(*findings)))
        .where((always | (F.col("n_records") > 0)) & (F.col("rule") != "none"))
    )


def validation_summary(df: DataFrame, domain: Domain) -> DataFrame:
    """One row: validity, finding counts and a readable text."""
    findings = validate(df, domain)
    is_error = F.col("severity") == "ERROR"

    def messages(severity: str, tag: str):
        # At most one line per rule and required variable.
        lines = F.array_sort(
            F.collect_list(F.when(F.col("severity") == severity, F.col("message")))
        )
        return F.transform(lines, lambda m: F.concat(F.lit(f"  [{tag}] "), m))

    heading = F.lit(f"Domain: {domain.code}")
    return findings.agg(
        F.count_if(is_error).alias("n_errors"),
        F.count_if(~is_error).alias("n_warnings"),
        messages("ERROR", "ERROR").alias("errors"),
        messages("WARNING", "WARN").alias("warnings"),
    ).select(
        F.lit(domain.code).alias("domain"),
        (F.col("n_errors") == 0).alias("is_valid"),
        "n_errors",
        "n_warnings",
        F.concat_ws(
            "\n",
            heading,
            F.concat(F.lit("Valid: "), F.when(F.col("n_errors") == 0, "True").otherwise("False")),
            F.when(F.col("n_errors") > 0, F.format_string("Errors (%d):", "n_errors")),
            F.when(F.col("n_errors") > 0, F.array_join("errors", "\n")),
            F.when(F.col("n_warnings") > 0, F.format_string("Warnings (%d):", "n_warnings")),
            F.when(F.col("n_warnings") > 0, F.array_join("warnings", "\n")),
        ).alias("summary"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur on more than one record, with their counts."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )
