"""Kaplan-Meier curves and the log-rank test.

Records are first collapsed to one row per (arm, time); running sums over times
are taken block by block (see ``scans``), never over all times in one task.
Records without a time or censoring flag are left out.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import arm_column, nan_to_null
from ..session import materialise
from .scans import running_totals, with_blocks


def _event_counts(adtte: DataFrame, arm: str, duration: str, censor: str) -> DataFrame:
    """Events and leavers per (arm, time), from one pass over the records.

    A time or flag that is NULL or NaN counts as missing.
    """
    time, flag = nan_to_null(adtte, duration), nan_to_null(adtte, censor)
    return (
        adtte.where(F.col(arm).isNotNull() & time.isNotNull() & flag.isNotNull())
        .groupBy(F.col(arm).alias("arm"), time.alias("time"))
        .agg(
            F.count_if(F.col(censor) == 0).alias("n_event"),
            F.count(F.lit(1)).alias("n_left"),
        )
    )


def km_curve(
    adtte: DataFrame,
    duration: str = "AVAL",
    censor: str = "CNSR",
    arm_col: str | None = None,
    confidence: float = 0.95,
) -> DataFrame:
    """Survival curve per arm: one row per (arm, time).

    The curve starts at time 0 (or at the earliest time, if negative). Limits are
    log-log transformed Greenwood limits; they are NULL where the survival
    probability is 0, and equal 1 before the first event.
    """
    arm = arm_column(adtte, arm_col)
    counts = _event_counts(adtte, arm, duration, censor)
    sizes = counts.groupBy("arm").agg(F.sum("n_left").alias("n_arm"), F.min("time").alias("first"))
    zero = F.lit(0)
    origin = sizes.where(F.col("first") > 0).select(
        "arm",
        zero.cast(counts.schema["time"].dataType).alias("time"),
        zero.cast("bigint").alias("n_event"),
        zero.cast("bigint").alias("n_left"),
    )
    # Small, read several times below, and the end of the heavy input plan.
    rows = materialise(counts.unionByName(origin))
    blocks = with_blocks(rows, "time")
    totals = rows.groupBy("arm").agg(F.sum("n_left").alias("n_arm"))
    left_before = running_totals(blocks, ["arm"], "time", {"left": "n_left"}, inclusive=False)
    at_risk = left_before.join(totals, "arm").withColumn("n_risk", F.col("n_arm") - F.col("left"))

    d, n = F.col("n_event").cast("double"), F.col("n_risk").cast("double")
    wiped_out = d == n
    steps = (
        at_risk.withColumn("log_step", F.when(~wiped_out, F.log(1 - d / n)).otherwise(0.0))
        .withColumn("var_step", F.when(~wiped_out, d / (n * (n - d))).otherwise(0.0))
        .withColumn("end_step", F.when(wiped_out, 1).otherwise(0))
        .drop("left", "n_arm")
    )
    summed = running_totals(
        steps,
        ["arm"],
        "time",
        {"log_sum": "log_step", "var_sum": "var_step", "ended": "end_step"},
    )
    z = NormalDist().inv_cdf(0.5 + confidence / 2)
    survival = F.when(F.col("ended") > 0, 0.0).otherwise(F.exp("log_sum"))
    # log(-log S) +- z * sqrt(V) / log S, with log S < 0 once an event happened.
    spread = z * F.sqrt("var_sum") / F.col("log_sum")
    centre = F.log(-F.col("log_sum"))

    def limit(offset):
        return (
            F.when(F.col("ended") > 0, F.lit(None).cast("double"))
            .when(F.col("log_sum") == 0, 1.0)
            .otherwise(F.exp(-F.exp(centre + offset)))
        )

    return summed.select(
        "arm",
        "time",
        "n_risk",
        "n_event",
        (F.col("n_left") - F.col("n_event")).alias("n_censored"),
        survival.alias("survival"),
        limit(-spread).alias("ci_lower"),
        limit(spread).alias("ci_upper"),
    )


def km_summary(curve: DataFrame) -> DataFrame:
    """Subjects, events and median survival with limits, per arm.

    A median (or limit) that the curve never reaches is NULL. The limits invert
    the curve's confidence band.
    """

    def first_time(column: str):
        return F.min(F.when(F.coalesce(column, F.lit(0.0)) <= 0.5, F.col("time")))

    return curve.groupBy("arm").agg(
        F.max("n_risk").alias("n_subjects"),
        F.sum("n_event").alias("n_events"),
        first_time("survival").alias("median_survival"),
        first_time("ci_lower").alias("median_ci_lower"),
        first_time("ci_upper").alias("median_ci_upper"),
    )


def survival_table(curve: DataFrame, arm: str) -> DataFrame:
    """The curve of one arm; ``KeyError`` when the arm has none."""
    rows = curve.where(F.col("arm") == arm).select("time", "survival")
    if rows.isEmpty():
        raise KeyError(f"Arm '{arm}' not found.")
    return rows


def logrank_components(
    adtte: DataFrame,
    arm1: str,
    arm2: str,
    duration: str = "AVAL",
    censor: str = "CNSR",
    arm_col: str | None = None,
) -> DataFrame:
    """One row: observed and expected events of ``arm1``, variance, chi-square."""
    arm = arm_column(adtte, arm_col)
    pooled = (
        _event_counts(adtte.where(F.col(arm).isin(arm1, arm2)), arm, duration, censor)
        .groupBy("time")
        .agg(
            F.sum("n_event").alias("d"),
            F.sum("n_left").alias("left"),
            F.sum(F.when(F.col("arm") == arm1, F.col("n_event")).otherwise(0)).alias("d1"),
            F.sum(F.when(F.col("arm") == arm1, F.col("n_left")).otherwise(0)).alias("left1"),
        )
    )
    blocks = with_blocks(materialise(pooled), "time")
    # At risk at t: everyone who leaves at t or later.
    at_risk = running_totals(
        blocks, [], "time", {"n": "left", "n1": "left1"}, descending=True
    ).where(F.col("d") > 0)
    d, n, n1 = (F.col(c).cast("double") for c in ("d", "n", "n1"))
    share = n1 / n
    variance = F.when(n > 1, d * share * (1 - share) * (n - d) / (n - 1)).otherwise(0.0)
    return at_risk.agg(
        F.sum("d1").alias("observed"),
        F.sum(d * share).alias("expected"),
        F.sum(variance).alias("variance"),
    ).select(
        "observed",
        "expected",
        "variance",
        F.when(
            F.col("variance") > 0,
            F.pow(F.col("observed") - F.col("expected"), 2) / F.col("variance"),
        ).alias("chi_square"),
    )


def with_p_value(components: DataFrame) -> DataFrame:
    """Add ``p_value``, the upper chi-square tail (one degree of freedom) of ``chi_square``.

    For one degree of freedom this is erfc(sqrt(x / 2)). One row comes in, so the
    value is computed on the driver.
    """
    row = components.first()
    statistic = row["chi_square"]
    p = None if statistic is None else chi_square_p(statistic)
    return components.sparkSession.createDataFrame(
        [(*row, p)], T.StructType([*components.schema.fields, T.StructField("p_value", T.DoubleType())])
    )


def chi_square_p(statistic: float) -> float:
    """Upper tail of the chi-square distribution with one degree of freedom."""
    return math.erfc(math.sqrt(statistic / 2))


def logrank_test(
    adtte: DataFrame,
    arm1: str,
    arm2: str,
    duration: str = "AVAL",
    censor: str = "CNSR",
    arm_col: str | None = None,
    alpha: float = 0.05,
) -> dict:
    """Two-arm log-rank test: statistic, p-value, verdict and a text."""
    row = logrank_components(adtte, arm1, arm2, duration, censor, arm_col).first()
    statistic = row["chi_square"]
    if statistic is None:
        raise ValueError("the log-rank test needs events with both arms at risk")
    p = chi_square_p(statistic)
    verdict = "significant" if p < alpha else "not significant"
    return {
        "test_statistic": statistic,
        "p_value": p,
        "significant": p < alpha,
        "summary": f"Log-rank test: chi2={statistic:.4f}, p={p:.4f} ({verdict} at alpha={alpha})",
    }
