"""Tabulation domains: demographics, adverse events, labs, vital signs, exposure.

Each domain is one projection over its raw table. A new domain is added by
writing another :class:`Domain`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codelists as codes
from ..functions.columns import (
    iso_date,
    lookup,
    number_or_null,
    require_columns,
    subject_key,
    upper,
)
from ..functions.dates import ORDERS, settle_orders
from ..session import materialise
from ..sinks.files import write_numbered
from .numbering import in_order, numbered

Orders = Mapping[str, str]
Builder = Callable[[DataFrame, str, Orders], Mapping[str, Column]]


@dataclass(frozen=True)
class Domain:
    """A tabulation domain: raw inputs, required variables and column builder."""

    code: str
    raw_columns: tuple[str, ...]
    required: tuple[str, ...]
    build: Builder
    sequence: str | None = None
    dates: tuple[str, ...] = ()


def map_domain(
    domain: Domain,
    raw: DataFrame,
    study_id: str,
    order_by: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    date_orders: Orders | None = None,
) -> DataFrame:
    """Map a raw table to ``domain``, with STUDYID and DOMAIN in front.

    ``order_by`` names raw columns that order the records uniquely; with it, the
    dataset-wide sequence variable is added. Without it the sequence is left out
    and the result is a plain lazy projection. ``keep`` carries raw columns along.

    Text dates are read in the order of day, month and year that their column settles,
    found by a pass over the date columns. ``date_orders`` states the orders instead
    (raw column to ``MDY``, ``DMY`` or ``YMD``; ``MDY`` for columns it leaves out) and
    starts no job.
    """
    require_columns(raw, domain.raw_columns, domain.code)
    if date_orders is None:
        date_orders = {name: found.order for name, found in settle_orders(raw, domain.dates).items()}
    mapped = domain.build(raw, study_id, date_orders)
    order = list(order_by or []) if domain.sequence else []
    # Ranges are found by a pass of its own: the raw rows are put in order, then mapped once.
    out = (in_order(raw, order) if order else raw).select(
        F.lit(study_id).alias("STUDYID"),
        F.lit(domain.code).alias("DOMAIN"),
        *[column.alias(name) for name, column in mapped.items()],
        *[F.col(c) for c in keep],
    )
    return numbered(materialise(out), domain.sequence) if order else out


def write_domain(
    domain: Domain,
    raw: DataFrame,
    study_id: str,
    order_by: Sequence[str],
    folder: str,
    date_orders: Orders | None = None,
) -> str:
    """Map a raw table and write it, in order, as the only copy; returns the path.

    :func:`..sinks.files.read_numbered` reads it with its sequence variable.
    """
    keys = {f"__key{i}": c for i, c in enumerate(order_by)}
    # The key stands beside the domain until the rows are sorted, and is not written.
    named = raw.withColumns({alias: F.col(c) for alias, c in keys.items()})
    out = map_domain(domain, named, study_id, keep=list(keys), date_orders=date_orders)
    return write_numbered(out, domain.code, folder, list(keys), drop=list(keys))


def range_indicator(value: Column, low: Column, high: Column) -> Column:
    """LOW / HIGH / NORMAL against a reference range, else UNKNOWN.

    A one-sided range still gives LOW or HIGH.
    """
    return (
        F.when(value < low, "LOW")
        .when(value > high, "HIGH")
        .when(value.between(low, high), "NORMAL")
        .otherwise("UNKNOWN")
    )


def _date(raw: DataFrame, name: str, orders: Orders) -> Column:
    return iso_date(raw, name, orders.get(name, ORDERS[0]))


def _demographics(raw: DataFrame, study_id: str, orders: Orders) -> dict[str, Column]:
    return {
        "SUBJID": F.col("subject_id").cast("string"),
        "SITEID": F.col("site_id").cast("string"),
        "USUBJID": subject_key(study_id),
        "AGE": number_or_null(raw, "age"),
        "AGEU": F.lit("YEARS"),
        "SEX": lookup(upper(raw, "sex"), codes.SEX_CODES, "U"),
        "RACE": upper(raw, "race"),
        "ETHNIC": upper(raw, "ethnicity", default="UNKNOWN"),
        "ARMCD": F.replace(upper(raw, "arm"), F.lit(" "), F.lit("_")),
        "ARM": F.col("arm"),
        "RFICDTC": _date(raw, "informed_consent_date", orders),
        "RFSTDTC": _date(raw, "randomization_date", orders),
    }


def _adverse_events(raw: DataFrame, study_id: str, orders: Orders) -> dict[str, Column]:
    decoded = "ae_decoded_term" if "ae_decoded_term" in raw.columns else "ae_term"
    return {
        "USUBJID": subject_key(study_id),
        "AETERM": upper(raw, "ae_term"),
        "AEDECOD": upper(raw, decoded),
        "AEBODSYS": upper(raw, "ae_body_system", default=""),
        "AESTDTC": _date(raw, "ae_start_date", orders),
        "AEENDTC": _date(raw, "ae_end_date", orders),
        "AESEV": lookup(upper(raw, "ae_severity"), codes.SEVERITY_CODES, "UNKNOWN"),
        "AESER": lookup(upper(raw, "ae_serious"), codes.SERIOUS_CODES, "N"),
        "AEREL": lookup(upper(raw, "ae_related"), codes.RELATED_CODES, "N"),
        "AEOUT": lookup(upper(raw, "ae_outcome"), codes.OUTCOME_CODES, "UNKNOWN"),
    }


def _laboratory(raw: DataFrame, study_id: str, orders: Orders) -> dict[str, Column]:
    test = upper(raw, "lab_test")
    value = number_or_null(raw, "lab_result")
    low = number_or_null(raw, "lab_ref_low")
    high = number_or_null(raw, "lab_ref_high")
    return {
        "USUBJID": subject_key(study_id),
        "LBTESTCD": F.substring(F.replace(test, F.lit(" "), F.lit("")), 1, 8),
        "LBTEST": test,
        "LBCAT": upper(raw, "lab_category", default="CHEMISTRY"),
        "LBORRES": F.col("lab_result").cast("string"),
        "LBORRESU": upper(raw, "lab_unit"),
        "LBSTRESN": value,
        "LBSTRESU": upper(raw, "lab_unit"),
        "LBSTNRLO": low,
        "LBSTNRHI": high,
        "LBNRIND": range_indicator(value, low, high),
        "LBDTC": _date(raw, "lab_date", orders),
        "VISIT": upper(raw, "visit_name"),
    }


def _vital_signs(raw: DataFrame, study_id: str, orders: Orders) -> dict[str, Column]:
    test = upper(raw, "vs_test")
    return {
        "USUBJID": subject_key(study_id),
        "VSTESTCD": lookup(test, codes.VITAL_TEST_CODES, F.substring(test, 1, 8)),
        "VSTEST": test,
        "VSPOS": upper(raw, "vs_position", default="SITTING"),
        "VSORRES": F.col("vs_result").cast("string"),
        "VSORRESU": upper(raw, "vs_unit"),
        "VSSTRESN": number_or_null(raw, "vs_result"),
        "VSSTRESU": upper(raw, "vs_unit"),
        "VSDTC": _date(raw, "vs_date", orders),
        "VISIT": upper(raw, "visit_name"),
    }


def _exposure(raw: DataFrame, study_id: str, orders: Orders) -> dict[str, Column]:
    return {
        "USUBJID": subject_key(study_id),
        "EXTRT": upper(raw, "drug_name"),
        "EXDOSE": number_or_null(raw, "dose_amount"),
        "EXDOSU": upper(raw, "dose_unit"),
        "EXROUTE": upper(raw, "dose_route"),
        "EXDOSFRQ": upper(raw, "dose_frequency"),
        "EXSTDTC": _date(raw, "start_date", orders),
        "EXENDTC": _date(raw, "end_date", orders),
        "VISIT": upper(raw, "visit_name"),
    }


# Names of the raw columns and of the required variables.
DEMOGRAPHICS = Domain(
    "DM",
    ("subject_id", "site_id", "age", "sex", "race", "arm",
     "informed_consent_date", "randomization_date"),
    ("STUDYID", "DOMAIN", "USUBJID", "SUBJID", "SITEID", "AGE", "AGEU", "SEX", "RACE",
     "ETHNIC", "ARMCD", "ARM", "RFSTDTC", "RFICDTC"),
    _demographics,
    dates=("informed_consent_date", "randomization_date"),
)
ADVERSE_EVENTS = Domain(
    "AE",
    ("subject_id", "site_id", "ae_term", "ae_start_date", "ae_end_date", "ae_severity",
     "ae_serious", "ae_related", "ae_outcome"),
    ("STUDYID", "DOMAIN", "USUBJID", "AESEQ", "AETERM", "AEDECOD", "AESTDTC", "AEENDTC",
     "AESEV", "AESER", "AEREL", "AEOUT"),
    _adverse_events,
    "AESEQ",
    ("ae_start_date", "ae_end_date"),
)
LABORATORY = Domain(
    "LB",
    ("subject_id", "site_id", "lab_test", "lab_result", "lab_unit", "lab_ref_low",
     "lab_ref_high", "lab_date", "visit_name"),
    ("STUDYID", "DOMAIN", "USUBJID", "LBSEQ", "LBTESTCD", "LBTEST", "LBCAT", "LBORRES",
     "LBORRESU", "LBSTRESN", "LBSTNRLO", "LBSTNRHI", "LBNRIND", "LBDTC", "VISIT"),
    _laboratory,
    "LBSEQ",
    ("lab_date",),
)
VITAL_SIGNS = Domain(
    "VS",
    ("subject_id", "site_id", "vs_test", "vs_result", "vs_unit", "vs_date", "visit_name"),
    ("STUDYID", "DOMAIN", "USUBJID", "VSSEQ", "VSTESTCD", "VSTEST", "VSORRES", "VSORRESU",
     "VSSTRESN", "VSSTRESU", "VSDTC", "VISIT"),
    _vital_signs,
    "VSSEQ",
    ("vs_date",),
)
EXPOSURE = Domain(
    "EX",
    ("subject_id", "site_id", "drug_name", "dose_amount", "dose_unit", "dose_route",
     "dose_frequency", "start_date", "end_date", "visit_name"),
    ("STUDYID", "DOMAIN", "USUBJID", "EXSEQ", "EXTRT", "EXDOSE", "EXDOSU", "EXROUTE",
     "EXDOSFRQ", "EXSTDTC", "EXENDTC", "VISIT"),
    _exposure,
    "EXSEQ",
    ("start_date", "end_date"),
)
DOMAINS = {d.code: d for d in (DEMOGRAPHICS, ADVERSE_EVENTS, LABORATORY, VITAL_SIGNS, EXPOSURE)}


def apply_terms(
    df: DataFrame, column: str, terms: Mapping[str, str] | DataFrame
) -> DataFrame:
    """Override the values of one column; unlisted values stay as they are.

    ``terms`` is a small dictionary, or for large code lists a DataFrame with the
    columns ``term`` and ``standard``. Of a term listed twice the smallest standard
    counts, so that no row is multiplied.
    """
    if isinstance(terms, DataFrame):
        listed = terms.groupBy(F.col("term").alias("__term")).agg(
            F.min("standard").alias("__standard")
        )
        joined = df.join(listed, df[column] == listed["__term"], "left")
        return joined.withColumn(column, F.coalesce("__standard", column)).select(df.columns)
    if not terms:
        return df
    return df.withColumn(column, lookup(F.col(column), terms, F.col(column)))
