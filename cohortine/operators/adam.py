"""Analysis datasets: subject level, adverse events, time to event, laboratory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codelists import BASELINE_VISITS, SEVERITY_GRADES
from ..functions.columns import date_or_null, elapsed_days, moment_or_null, require_columns
from ..session import materialise
from .numbering import in_order, number_rows, numbered

_SUBJECT_KEYS = ("USUBJID", "TRTSDT", "TRT01A", "TRT01AN")


def subject_level(dm: DataFrame) -> DataFrame:
    """Subject-level dataset: treatment, age group, start date, population flags.

    An age outside (0, 999] or missing has no age group (NULL).
    """
    require_columns(dm, ("USUBJID", "AGE", "SEX", "ARM", "RFSTDTC"), "ADSL")
    active = F.coalesce(F.contains(F.upper("ARM"), F.lit("DRUG")), F.lit(False))
    arm_number = F.when(active, 1).otherwise(2)
    age = F.col("AGE")

    def by_age(young, middle, old) -> Column:
        return (
            F.when((age > 0) & (age <= 64), young)
            .when((age > 64) & (age <= 74), middle)
            .when((age > 74) & (age <= 999), old)
        )

    start = moment_or_null(dm, "RFSTDTC")
    return dm.withColumns(
        {
            "TRT01P": F.col("ARM"),
            "TRT01PN": arm_number,
            "TRT01A": F.col("ARM"),
            "TRT01AN": arm_number,
            "AGEGR1": by_age("<65", "65-74", ">=75"),
            "AGEGR1N": by_age(1, 2, 3),
            "TRTSDT": start.cast("date"),
            "TRTSDTM": start,
            "ITTFL": F.lit("Y"),
            "SAFFL": F.lit("Y"),
            "PPROTFL": F.lit("Y"),
            "EVALFL": F.lit("Y"),
        }
    )


def _start_moment(adsl: DataFrame) -> Column:
    """Treatment start with its time of day, where the dataset has one."""
    return moment_or_null(adsl, "TRTSDTM" if "TRTSDTM" in adsl.columns else "TRTSDT")


def adverse_event_analysis(
    ae: DataFrame,
    adsl: DataFrame,
    order_by: Sequence[str] | None = None,
    reuse_sequence: bool = False,
) -> DataFrame:
    """Adverse events with treatment, study day, emergence flag and grade.

    Every event stays, also one whose subject is unknown. ``order_by`` names the
    columns that order the records uniquely (normally AESEQ); with it the
    dataset-wide ASEQ is added. For a whole numbered domain and one ADSL row per
    subject, ASEQ equals AESEQ: ``reuse_sequence`` copies it and saves a shuffle; a
    subject with two ADSL rows is then an error.

    An event is emergent from the moment of the first dose on, with times of day where
    the dates have them; the study day counts whole elapsed days.
    """
    require_columns(ae, ("USUBJID", "AESTDTC", "AEENDTC", "AESEV", "AESER", "AEREL"), "ADAE")
    require_columns(adsl, (*_SUBJECT_KEYS, "SAFFL"), "ADAE")
    grade = F.lit(0)
    for severity, number in SEVERITY_GRADES.items():
        grade = F.when(F.col("AESEV") == severity, number).otherwise(grade)

    if reuse_sequence:
        twice = adsl.groupBy("USUBJID").count().where(F.col("count") > 1)
        if not twice.isEmpty():
            raise ValueError("reuse_sequence needs one ADSL row per subject")
    subjects = adsl.select(*_SUBJECT_KEYS, "SAFFL", _start_moment(adsl).alias("__start"))
    joined = ae.join(subjects, "USUBJID", "left")
    # Ranges are found by a pass of its own: events are put in order first, then derived once.
    ordered = bool(order_by) and not reuse_sequence and set(order_by) <= set(ae.columns)
    if ordered:
        joined = in_order(joined, list(order_by))
    start = moment_or_null(ae, "AESTDTC")
    derived = joined.select(
        *ae.columns,
        *[c for c in (*_SUBJECT_KEYS, "SAFFL") if c != "USUBJID"],
        F.col("TRT01A").alias("TRTA"),
        F.col("TRT01AN").alias("TRTAN"),
        start.cast("date").alias("ASTDT"),
        date_or_null(ae, "AEENDTC").alias("AENDT"),
        (elapsed_days(start, F.col("__start")) + 1).alias("AESTDY"),
        F.when(start >= F.col("__start"), "Y").otherwise("").alias("TRTEMFL"),
        grade.alias("ATOXGR"),
        F.when(F.col("AEREL") == "Y", "RELATED").otherwise("NOT RELATED").alias("AREL"),
        F.when(F.col("AESER") == "Y", "Y").otherwise("N").alias("ASER"),
    )
    if reuse_sequence:
        return derived.withColumn("ASEQ", F.col("AESEQ"))
    if ordered:
        return numbered(materialise(derived), "ASEQ")
    return number_rows(derived, list(order_by), "ASEQ") if order_by else derived


def _time_to_event(
    joined: DataFrame,
    carried: Sequence[str],
    param: str,
    code: str,
    event_date: Column,
    censor_date: Column,
    description: Column,
) -> DataFrame:
    moment = F.coalesce(event_date, censor_date)
    return joined.select(
        *_SUBJECT_KEYS,
        *carried,
        F.lit(param).alias("PARAM"),
        F.lit(code).alias("PARAMCD"),
        F.when(event_date.isNotNull(), 0).otherwise(1).alias("CNSR"),
        moment.cast("date").alias("ADT"),
        elapsed_days(moment, F.col("__start")).alias("AVAL"),
        F.lit("DAYS").alias("AVALU"),
        description.alias("EVNTDESC"),
        F.col("TRT01A").alias("TRTA"),
        F.col("TRT01AN").alias("TRTAN"),
    )


def overall_survival(adsl: DataFrame, events: DataFrame) -> DataFrame:
    """Days from treatment start to death, else censored at the last contact."""
    carried = ("death_date", "last_contact_date")
    require_columns(adsl, _SUBJECT_KEYS, "ADTTE")
    require_columns(events, ("USUBJID", *carried), "ADTTE")
    subjects = adsl.select(*_SUBJECT_KEYS, _start_moment(adsl).alias("__start"))
    joined = subjects.join(events.select("USUBJID", *carried), "USUBJID", "left")
    death = moment_or_null(events, "death_date")
    return _time_to_event(
        joined,
        carried,
        "Overall Survival",
        "OS",
        death,
        moment_or_null(events, "last_contact_date"),
        F.when(death.isNotNull(), "DEATH").otherwise("CENSORED"),
    )


def progression_free_survival(
    adsl: DataFrame, response: DataFrame, earliest: bool = False
) -> DataFrame:
    """Days from treatment start to progression or death, else last assessment.

    Progression wins even over an earlier death; ``earliest=True`` takes whichever
    came first instead.
    """
    dates = ("progression_date", "death_date", "last_assessment_date")
    require_columns(adsl, _SUBJECT_KEYS, "ADTTE")
    require_columns(response, ("USUBJID", *dates), "ADTTE")
    subjects = adsl.select(*_SUBJECT_KEYS, _start_moment(adsl).alias("__start"))
    joined = subjects.join(response, "USUBJID", "left")
    progression = moment_or_null(response, "progression_date")
    death = moment_or_null(response, "death_date")
    if earliest:
        event = F.least(progression, death)
        progressed = progression == event
    else:
        event = F.coalesce(progression, death)
        progressed = progression.isNotNull()
    return _time_to_event(
        joined,
        [c for c in response.columns if c != "USUBJID"],
        "Progression-Free Survival",
        "PFS",
        event,
        moment_or_null(response, "last_assessment_date"),
        F.when(progressed, "PROGRESSION").when(death.isNotNull(), "DEATH").otherwise("CENSORED"),
    )


def laboratory_analysis(
    lb: DataFrame, adsl: DataFrame, order_by: Sequence[str] = ("LBSEQ",)
) -> DataFrame:
    """Lab results with baseline value, change and percent change.

    The baseline is the first non-null value, in ``order_by`` order, of a subject's
    baseline visits for a test. It is aggregated once (with map-side combining) and
    joined back, so a subject with very many results is never gathered in one task.
    """
    require_columns(lb, ("USUBJID", "LBTESTCD", "LBTEST", "LBSTRESN", "LBNRIND", "VISIT"), "ADLB")
    require_columns(lb, order_by, "ADLB")
    require_columns(adsl, _SUBJECT_KEYS, "ADLB")
    is_baseline = F.upper("VISIT").isin(*BASELINE_VISITS)
    base = (
        lb.where(is_baseline & F.col("LBSTRESN").isNotNull())
        .groupBy("USUBJID", "LBTESTCD")
        .agg(F.min_by("LBSTRESN", F.struct(*order_by)).alias("BASE"))
    )
    change = F.col("LBSTRESN") - F.col("BASE")
    unit = F.col("LBSTRESU") if "LBSTRESU" in lb.columns else F.lit("")
    return (
        lb.join(adsl.select(*_SUBJECT_KEYS), "USUBJID", "left")
        .join(base, ["USUBJID", "LBTESTCD"], "left")
        .select(
            *lb.columns,
            "TRT01A",
            "TRT01AN",
            "TRTSDT",
            F.col("TRT01A").alias("TRTA"),
            F.col("TRT01AN").alias("TRTAN"),
            F.col("LBTEST").alias("PARAM"),
            F.col("LBTESTCD").alias("PARAMCD"),
            F.col("LBSTRESN").alias("AVAL"),
            unit.alias("AVALU"),
            F.when(is_baseline, "Y").otherwise("").alias("ABLFL"),
            "BASE",
            change.alias("CHG"),
            F.when(F.col("BASE") != 0, 100 * change / F.col("BASE")).alias("PCHG"),
            F.col("LBNRIND").alias("ANRIND"),
        )
    )
