"""Report tables and listings as DataFrames.

A :class:`Report` holds the numbered body plus title and footnotes. The body of a
table has one text column per treatment arm; its leading ``block`` / ``row``
columns give the print order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codelists import (
    EVENT_ROW_LABELS,
    REPORT_FOOTNOTES,
    REPORT_TITLES,
    SEX_LABELS,
)
from ..functions.columns import (
    arm_column,
    arm_values,
    count_percent_text,
    fixed_text,
    lookup,
    optional_flag,
)


@dataclass(frozen=True)
class Report:
    """A numbered table or listing."""

    number: str
    title: str
    body: DataFrame
    order_by: tuple[str, ...]
    footnotes: tuple[str, ...] = ()


#: In the arms of a table: a column over all arms.
TOTAL = "Total"


def _and_total(counts: DataFrame, arm: str, arms: Sequence[str]) -> DataFrame:
    """Aggregated rows, and with a total column asked for a copy of each under its name.

    Taken from rows that are already aggregated per arm, so nothing else is read twice.
    """
    if TOTAL not in arms:
        return counts
    both = F.explode(F.array(F.col(arm), F.lit(TOTAL)))
    return counts.where(F.col(arm) != TOTAL).withColumn(arm, both)


def _report(number: str, body: DataFrame, order_by: tuple[str, ...], **values: str) -> Report:
    footnotes = tuple(note.format(**values) for note in REPORT_FOOTNOTES[number])
    return Report(number, REPORT_TITLES[number].format(**values), body, order_by, footnotes)


def _safety(df: DataFrame) -> DataFrame:
    return df.where(F.col("SAFFL") == "Y") if "SAFFL" in df.columns else df


def _cells(df: DataFrame, block: int, row: Column, label: Column, arm: str, text: Column):
    return df.select(
        F.lit(block).alias("block"),
        row.alias("row"),
        label.alias("characteristic"),
        F.col(arm).alias("arm"),
        text.alias("text"),
    )


def _layout(cells: list[DataFrame], arms: Sequence[str]) -> DataFrame:
    """Turn long cells into one row per characteristic and one column per arm."""
    return (
        reduce(DataFrame.unionByName, cells)
        .groupBy("block", "row", "characteristic")
        .pivot("arm", list(arms))
        .agg(F.first("text"))
    )


def demographics(
    adsl: DataFrame, arm_col: str | None = None, arms: Sequence[str] | None = None
) -> Report:
    """Table 14.1.1: age statistics and sex, race and age-group counts per arm.

    The safety population is counted once by (arm, age, sex, race, age group);
    every block is computed from those counts. ``"Total"`` among ``arms`` is a column over
    all arms, those without a column of their own included.
    """
    arm = arm_column(adsl, arm_col)
    safety = _safety(adsl)
    arms = list(arms) if arms else arm_values(safety, arm)
    categories = [("SEX", "Sex, n (%)"), ("RACE", "Race, n (%)")]
    if "AGEGR1" in adsl.columns:
        categories.append(("AGEGR1", "Age group, n (%)"))
    profile = (
        safety.where(F.col(arm).isNotNull())
        .groupBy(arm, "AGE", *[name for name, _ in categories])
        .agg(F.count(F.lit(1)).alias("n"))
    )
    profile = _and_total(profile, arm, arms)
    totals = profile.groupBy(arm).agg(F.sum("n").alias("arm_n"))

    # Every arm gets a header cell and every block a heading with empty cells.
    headings = ["Characteristic", "Age (years)", *[title for _, title in categories]]
    cells = [
        _cells(
            totals,
            block,
            F.lit(""),
            F.lit(title),
            arm,
            F.format_string("(N=%d)", "arm_n") if block == 0 else F.lit(""),
        )
        for block, title in enumerate(headings)
    ]

    age, n = F.col("AGE").cast("double"), F.col("n")
    counted = F.when(age.isNotNull(), n)
    known = F.sum(counted)
    mean = F.sum(age * n) / known
    variance = (F.sum(age * age * n) - F.sum(age * n) * mean) / (known - 1)
    stats = profile.groupBy(arm).agg(
        F.coalesce(known, F.lit(0)).alias("known"),
        mean.alias("mean"),
        F.when(known > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("sd"),
        F.percentile(age, 0.5, n).alias("median"),
        F.min(age).alias("low"),
        F.max(age).alias("high"),
    )
    # One value leaves the SD undefined; it prints as "nan".
    sd_text = F.coalesce(fixed_text(F.col("sd"), 2), F.lit("nan"))
    texts = [
        ("  n", F.col("known").cast("string")),
        ("  Mean (SD)", F.concat(fixed_text(F.col("mean"), 1), F.lit(" ("), sd_text, F.lit(")"))),
        ("  Median", fixed_text(F.col("median"), 1)),
        ("  Min, Max", F.concat_ws(", ", fixed_text(F.col("low"), 1), fixed_text(F.col("high"), 1))),
    ]
    statistic = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(str(i)).alias("row"),
                    F.lit(label).alias("label"),
                    F.when(F.col("known") > 0, text).otherwise("-").alias("text"),
                )
                for i, (label, text) in enumerate(texts, start=1)
            ]
        )
    )
    age_rows = stats.select(arm, statistic)
    cells.append(_cells(age_rows, 1, F.col("row"), F.col("label"), arm, F.col("text")))
    table = _layout(cells, arms)

    category = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(block).alias("block"),
                    F.col(name).cast("string").alias("row"),
                    (
                        lookup(F.col(name), SEX_LABELS, F.col(name))
                        if name == "SEX"
                        else F.col(name).cast("string")
                    ).alias("label"),
                )
                for block, (name, _) in enumerate(categories, start=2)
            ]
        )
    )
    counts = (
        profile.select(arm, "n", category)
        .where(F.col("row").isNotNull())
        .groupBy(arm, "block", "row", "label")
        .agg(F.sum("n").alias("n"))
        .join(totals, arm)
        .select(
            "block",
            "row",
            F.concat(F.lit("  "), "label").alias("characteristic"),
            F.col(arm).alias("arm"),
            count_percent_text(F.col("n"), F.col("arm_n")).alias("text"),
        )
    )
    # An arm without subjects in a category shows a zero.
    category_rows = _layout([counts], arms).na.fill("0 (0.0%)", list(arms))
    return _report("14.1.1", table.unionByName(category_rows), ("block", "row"))


def emergent(adae: DataFrame) -> DataFrame:
    """Treatment-emergent events (all events when there is no flag)."""
    return adae.where(F.col("TRTEMFL") == "Y") if "TRTEMFL" in adae.columns else adae


def subject_event_flags(adae: DataFrame, arm: str, arms: Sequence[str] = ()) -> DataFrame:
    """One row per (arm, subject) with emergent events and what kinds they had.

    Counting these rows counts distinct subjects, without one distinct
    aggregation (and one copy of the events) per kind. With ``"Total"`` among ``arms`` a
    subject has one more row under it, however many arms its events have.
    """
    grade = F.coalesce(F.col("ATOXGR") >= 3, F.lit(False)) if "ATOXGR" in adae.columns else F.lit(False)
    kinds = {
        "serious": optional_flag(adae, "ASER", "Y", False),
        "related": optional_flag(adae, "AEREL", "Y", False),
        "grade3": grade,
        "fatal": optional_flag(adae, "AEOUT", "FATAL", False),
    }
    flags = (
        emergent(adae)
        .where(F.col("USUBJID").isNotNull())
        .groupBy(arm, "USUBJID")
        .agg(*[F.max(flag).alias(name) for name, flag in kinds.items()])
    )
    if TOTAL not in arms:
        return flags
    return (
        _and_total(flags, arm, arms)
        .groupBy(arm, "USUBJID")
        .agg(*[F.max(name).alias(name) for name in kinds])
    )


def adverse_events(
    adae: DataFrame,
    adsl: DataFrame,
    arm_col: str | None = None,
    arms: Sequence[str] | None = None,
) -> Report:
    """Table 14.3.1: subjects with emergent events by kind and arm.

    ``"Total"`` among ``arms`` is a column over all arms; a subject counts in it once.
    """
    arm = arm_column(adae, arm_col)
    subject_arm = arm_column(adsl, arm_col)
    safety = _safety(adsl).where(F.col(subject_arm).isNotNull())
    arms = list(arms) if arms else arm_values(safety, subject_arm)
    sizes = safety.groupBy(F.col(subject_arm).alias("arm")).agg(F.count(F.lit(1)).alias("size"))
    # Copied per arm before the sums, so that the total adds up all arms.
    sizes = _and_total(sizes, "arm", arms).groupBy("arm").agg(F.sum("size").alias("size"))
    counts = (
        subject_event_flags(adae, arm, arms)
        .groupBy(F.col(arm).alias("arm"))
        .agg(
            F.count(F.lit(1)).alias("any"),
            *[F.count_if(c).alias(c) for c in ("serious", "related", "grade3", "fatal")],
        )
    )
    cell = F.inline(
        F.array(
            F.struct(
                F.lit("0").alias("row"),
                F.lit("Adverse Event Category").alias("label"),
                F.format_string("(N=%d)", "size").alias("text"),
            ),
            *[
                F.struct(
                    F.lit(str(i)).alias("row"),
                    F.lit(label).alias("label"),
                    count_percent_text(F.col(name), F.col("size")).alias("text"),
                )
                for i, (name, label) in enumerate(EVENT_ROW_LABELS.items(), start=1)
            ],
        )
    )
    cells = sizes.join(counts, "arm", "left").select("arm", cell)
    body = _layout([_cells(cells, 0, F.col("row"), F.col("label"), "arm", F.col("text"))], arms)
    return _report("14.3.1", body, ("block", "row"))


def lab_shift(
    adlb: DataFrame,
    parameter: str,
    arm_col: str | None = None,
    arms: Sequence[str] | None = None,
    order_by: Sequence[str] = ("LBSEQ",),
    direction: str = "high",
) -> Report:
    """Table 14.3.4: baseline category by worst post-baseline category and arm.

    "Worst" is the highest value, or the lowest with ``direction="low"``; ties go
    to the record that comes first in ``order_by``. Category and arm each take
    their first non-null value in that order. A subject with several baseline
    records counts once per record. ``"Total"`` among ``arms`` is a column over all arms.
    """
    if direction not in ("high", "low"):
        raise ValueError("direction must be 'high' or 'low'")
    arm = arm_column(adlb, arm_col)
    rows = adlb.where(F.col("PARAMCD") == parameter)
    is_baseline = optional_flag(adlb, "ABLFL", "Y", False)
    baseline = (
        rows.where(is_baseline & F.col("ANRIND").isNotNull())
        .groupBy("USUBJID", F.col("ANRIND").alias("BASELINE"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Smallest key first: rows without a value come last, then by value, then order.
    value = -F.col("AVAL") if direction == "high" else F.col("AVAL")
    key = F.struct(F.col("AVAL").isNull(), value, *order_by)
    worst = (
        rows.where(~is_baseline)
        .groupBy("USUBJID")
        .agg(
            F.min_by("ANRIND", F.when(F.col("ANRIND").isNotNull(), key)).alias("WORST_POST"),
            F.min_by(arm, F.when(F.col(arm).isNotNull(), key)).alias("arm"),
        )
    )
    shifts = (
        baseline.join(worst, "USUBJID")
        .where(F.col("WORST_POST").isNotNull() & F.col("arm").isNotNull())
        .groupBy("BASELINE", "WORST_POST", "arm")
        .agg(F.sum("n").alias("n"))
    )
    columns = list(arms) if arms else arm_values(adlb, arm)
    body = (
        _and_total(shifts, "arm", columns)
        .groupBy("BASELINE", "WORST_POST")
        .pivot("arm", columns)
        .agg(F.sum("n"))
        .na.fill(0)
    )
    return _report("14.3.4", body, ("BASELINE", "WORST_POST"), parameter=parameter)


def subject_listing(
    adsl: DataFrame, cols: Sequence[str] | None = None, arm_col: str | None = None
) -> Report:
    """Listing 16.2.1: the requested columns that exist, sorted by subject."""
    default = (
        "USUBJID", "SITEID", "AGE", "AGEGR1", "SEX", "RACE",
        arm_column(adsl, arm_col), "ITTFL", "SAFFL",
    )
    present = [c for c in (cols or default) if c in adsl.columns]
    body = (
        adsl.select("USUBJID", *[c for c in present if c != "USUBJID"])
        .orderBy("USUBJID")
        .select(*present)
    )
    return _report("16.2.1", body, ("USUBJID",) if "USUBJID" in present else ())
