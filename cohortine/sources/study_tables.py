"""Raw clinical tables, built from the star-schema test tables.

Orders play the exposure records and follow-up contacts, returned line items the
adverse events, other line items the lab results, events the vital signs.
Raw dates are handed over as text, as a data-capture system would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread

STUDY_ID = "STUDY-01"
LINE_KEYS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    "l_quantity", "l_extendedprice", "l_shipdate",
)


# Declared, so that opening a table starts no job to read file footers.
SCHEMAS = {
    "customer": "c_custkey long, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey long, p_name string, p_brand string, p_type string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
}


#: Order of day, month and year in the raw text dates; month first where not named.
DATE_ORDERS = {"informed_consent_date": "DMY"}


def _collected(date: str, key: str, numbers: str = "M/d/yyyy") -> str:
    """SQL text of a date as collection systems write it: mostly ISO, now and then not.

    ``numbers`` is the form of dates in three numbers. One row in 110 gets text that is no date.
    """
    short = numbers.replace("yyyy", "yy")
    forms = (
        f"date_format({date}, '{numbers}')",
        f"upper(date_format({date}, 'ddMMMyyyy'))",
        f"date_format({date}, 'd-MMM-yyyy')",
        f"date_format({date}, 'MMMM d, yyyy')",
        f"date_format({date}, '{numbers}') || ' 10:30'",
        f"date_format({date}, '{short}')",
        f"date_format({date}, '{numbers}') || ' 12:30 AM'",
        f"string({date}) || 'T10:30:00Z'",
        f"string({date}) || 'T23:30:00.000+02:00'",
        f"date_format({date}, 'dd-MMM-yy')",
        f"date_format({date}, 'd MMMM yyyy')",
        f"date_format({date}, 'EEE, MMM d yyyy')",
        f"date_format({date}, 'yyyy.MM.dd')",
    )
    cases = " ".join(f"WHEN {i} THEN {form}" for i, form in enumerate(forms, 1))
    return (
        f"CASE WHEN {key} % 110 = 6 THEN string({date}) || ' or later' ELSE "
        f"CASE {key} % 23 {cases} ELSE string({date}) END END"
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("first_order"))
    )


def raw_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    first = _first_orders(spark, sf_dir)
    return customer.join(first, customer.c_custkey == first.o_custkey, "left").selectExpr(
        "c_custkey AS subject_id",
        "c_nationkey AS site_id",
        "18 + c_custkey % 73 AS age",
        "CASE c_custkey % 5 WHEN 0 THEN 'Male' WHEN 1 THEN 'F' WHEN 2 THEN 'female'"
        " WHEN 3 THEN 'M' WHEN 4 THEN 'unknown' END AS sex",
        "c_mktsegment AS race",
        "CASE WHEN c_custkey % 2 = 0 THEN 'Drug X' ELSE 'Placebo' END AS arm",
        f"{_collected('(date(first_order) + 173)', 'c_custkey', 'd/M/yyyy')}"
        " AS informed_consent_date",
        f"{_collected('(date(first_order) + 180)', 'c_custkey')} AS randomization_date",
    )


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")


def _line_events(spark: SparkSession, sf_dir: str, returned: bool) -> DataFrame:
    """Line items of one kind with their order, part and site."""
    lines = table(spark, sf_dir, "lineitem")
    is_returned = F.col("l_returnflag") == "R"
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    sites = _sites(spark, sf_dir)
    return (
        spread(lines.where(is_returned if returned else ~is_returned), *LINE_KEYS)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(sites, F.col("o_custkey") == F.col("c_custkey"), "left")
    )


def raw_adverse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_events(spark, sf_dir, returned=True).selectExpr(
        "o_custkey AS subject_id",
        "c_nationkey AS site_id",
        "p_name AS ae_term",
        "p_brand AS ae_decoded_term",
        "p_type AS ae_body_system",
        f"{_collected('date(l_shipdate)', 'l_partkey')} AS ae_start_date",
        "string(date_add(date(l_shipdate), int(l_quantity))) AS ae_end_date",
        "CASE l_linenumber WHEN 1 THEN '1' WHEN 2 THEN 'Grade 2' WHEN 3 THEN 'Severe'"
        " WHEN 4 THEN '4' WHEN 5 THEN 'fatal' WHEN 6 THEN 'Grade 4' END AS ae_severity",
        "CASE WHEN l_linestatus = 'F' THEN 'Yes' ELSE 'No' END AS ae_serious",
        "CASE o_orderstatus WHEN 'P' THEN 'Related' WHEN 'F' THEN 'Not Related'"
        " WHEN 'O' THEN 'Y' END AS ae_related",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Recovered' WHEN '2-HIGH' THEN 'Resolved'"
        " WHEN '3-MEDIUM' THEN 'Not Recovered' WHEN '4-NOT SPECIFIED' THEN 'Fatal'"
        " WHEN '5-LOW' THEN 'lost' END AS ae_outcome",
        *LINE_KEYS,
    )


def raw_laboratory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_events(spark, sf_dir, returned=False).selectExpr(
        "o_custkey AS subject_id",
        "c_nationkey AS site_id",
        "p_type AS lab_test",
        "l_quantity AS lab_result",
        "'mg/dL' AS lab_unit",
        "10 AS lab_ref_low",
        "40 AS lab_ref_high",
        "string(date(l_shipdate)) AS lab_date",
        "CASE WHEN l_linenumber = 1 THEN 'Baseline' ELSE 'Week ' || l_linenumber END"
        " AS visit_name",
        *LINE_KEYS,
    )


def raw_vital_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    sites = _sites(spark, sf_dir)
    return events.join(sites, events.user_id == sites.c_custkey, "left").selectExpr(
        "user_id AS subject_id",
        "c_nationkey AS site_id",
        "CASE event_type WHEN 'click' THEN 'Heart Rate'"
        " WHEN 'error' THEN 'Systolic Blood Pressure' WHEN 'purchase' THEN 'Weight'"
        " WHEN 'signup' THEN 'Grip Strength Left' WHEN 'view' THEN 'BMI' END AS vs_test",
        "value AS vs_result",
        "'unit' AS vs_unit",
        "string(date(ts)) AS vs_date",
        "'Day 1' AS visit_name",
        "event_id",
    )


def raw_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    sites = _sites(spark, sf_dir)
    return orders.join(sites, orders.o_custkey == sites.c_custkey, "left").selectExpr(
        "o_custkey AS subject_id",
        "c_nationkey AS site_id",
        "CASE WHEN o_custkey % 2 = 0 THEN 'Drug X' ELSE 'Placebo' END AS drug_name",
        "o_totalprice AS dose_amount",
        "'mg' AS dose_unit",
        "o_orderstatus AS dose_route",
        "o_orderpriority AS dose_frequency",
        "string(date(o_orderdate)) AS start_date",
        "string(date(o_orderdate) + 21) AS end_date",
        "'Cycle 1 Day 1' AS visit_name",
        "o_orderkey",
    )


def follow_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Death, progression and last-contact dates per subject with orders.

    One aggregation by subject: a death is the subject's first urgent finished
    order, kept only from randomization on; a progression is the first pending
    high-priority order from randomization on. The candidate days are a set of
    calendar days, small even for a subject with very many orders.
    """
    orders = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    high = F.when((status == "P") & (priority == "2-HIGH"), F.col("day"))
    urgent = F.when((status == "F") & (priority == "1-URGENT"), F.col("day"))
    start = F.date_add("first", 180)
    per_subject = (
        orders.groupBy("o_custkey")
        .agg(
            F.min("day").alias("first"),
            F.max("day").alias("last"),
            F.min(urgent).alias("urgent"),
            F.collect_set(high).alias("high"),
        )
        .withColumn("start", start)
        .withColumn(
            "progression", F.array_min(F.filter("high", lambda day: day >= F.col("start")))
        )
    )
    sites = _sites(spark, sf_dir)
    death = F.when(F.col("urgent") >= F.col("start"), F.col("urgent"))
    usubjid = F.concat(
        F.lit(f"{STUDY_ID}-"), F.col("c_nationkey").cast("string"), F.lit("-"),
        F.col("o_custkey").cast("string"),
    )
    return per_subject.join(sites, per_subject.o_custkey == sites.c_custkey).select(
        usubjid.alias("USUBJID"),
        F.col("progression").cast("string").alias("progression_date"),
        death.cast("string").alias("death_date"),
        F.col("last").cast("string").alias("last_date"),
    )


def os_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return follow_up(spark, sf_dir).select(
        "USUBJID", "death_date", F.col("last_date").alias("last_contact_date")
    )


def pfs_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    return follow_up(spark, sf_dir).select(
        "USUBJID",
        "progression_date",
        "death_date",
        F.col("last_date").alias("last_assessment_date"),
    )


PANEL = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
PANEL_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def lab_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-item measurements with about a seventh of each column missing."""
    lines = table(spark, sf_dir, "lineitem")
    shift = F.col("l_orderkey") * 7 + F.col("l_partkey") * 3 + F.col("l_linenumber")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        *[F.when((shift + k) % 7 != 0, F.col(c)).alias(c) for k, c in enumerate(PANEL)],
    )


def protocol_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One protocol JSON document per order, with item lists that vary by order."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")

    def texts(*values) -> Column:
        return F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values])

    primary = (
        F.when(priority == "1-URGENT", texts("Overall survival (OS) until death from any cause"))
        .when(
            priority == "2-HIGH",
            texts("Progression-free survival (PFS) by review", "Objective response rate (ORR)"),
        )
        .when(priority == "3-MEDIUM", texts("Change in laboratory values at week 12"))
        .when(priority == "4-NOT SPECIFIED", texts("xyzzy frobnicate entanglement score"))
    )
    secondary = (
        F.when(status == "F", texts("Safety and tolerability per CTCAE", "Duration of response"))
        .when(status == "O", texts("Systolic blood pressure at week 12"))
        .otherwise(F.array().cast("array<string>"))
    )
    customer = F.col("o_custkey").cast("string")
    arm = F.struct(
        F.lit("Drug X").alias("arm_name"),
        F.concat((F.col("o_custkey") % 5 * 100).cast("string"), F.lit("mg")).alias("dose"),
        F.lit("IV").alias("route"),
        F.lit("Q3W").alias("frequency"),
    )
    visit = F.struct(
        F.lit("Screening").alias("visit_name"),
        F.lit("Day -28 to Day -1").alias("visit_day"),
        texts("Demographics", "Laboratory tests", "ECG").alias("assessments"),
    )
    document = F.struct(
        F.concat(F.lit("Study of compound "), customer).alias("study_title"),
        F.concat(F.lit("P-"), F.col("o_orderkey").cast("string")).alias("protocol_number"),
        F.concat(F.lit("Phase "), (F.col("o_orderkey") % 3 + 1).cast("string")).alias("phase"),
        F.lit("NSCLC").alias("indication"),
        F.lit("Synthetic sponsor").alias("sponsor"),
        primary.alias("primary_endpoints"),
        secondary.alias("secondary_endpoints"),
        texts(
            F.concat(F.lit("Age >= "), (18 + F.col("o_custkey") % 50).cast("string")),
            "Adequate hematology values",
        ).alias("inclusion_criteria"),
        texts(F.concat(F.lit("Prior treatment with compound "), customer)).alias(
            "exclusion_criteria"
        ),
        F.array(arm).alias("treatment_arms"),
        F.array(visit).alias("visit_schedule"),
        F.floor("o_totalprice").cast("bigint").alias("raw_text_length"),
    )
    return spread(table(spark, sf_dir, "orders"), "o_orderkey").select(F.to_json(document).alias("document"))


def keyword_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placement rules from the parts: one, two or three words, one rule per part and more."""
    parts = table(spark, sf_dir, "part")
    rules = (
        ("p_name || ' ' || p_partkey", "p_type", "p_brand", "'high'"),
        ("p_name", "min(p_type)", "min(p_brand)", "'medium'"),
        ("split(p_name, ' ')[1]", "'NOUN'", "'ADNOUN'", "'low'"),
    )
    names = ("keyword", "domain", "dataset", "confidence")
    single, double, noun = (
        [f"{e} AS {n}" for e, n in zip(expressions, names)] for expressions in rules
    )
    by_name = parts.groupBy("p_name").agg(*[F.expr(e) for e in double[1:]])
    return (
        parts.selectExpr(*single)
        .unionByName(by_name.withColumnRenamed("p_name", "keyword"))
        .unionByName(parts.selectExpr(*noun).distinct())
    )


def measured_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per line: a part named fully, in the plural, without its number, or run together."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    text = (
        "CASE l_linenumber % 4 WHEN 0 THEN 'Change in ' || p_name || ' ' || p_partkey || ' at week 12'"
        " WHEN 1 THEN upper(p_name) || 's, by review' WHEN 2 THEN 'Rate of over' || p_name"
        " ELSE 'Time to un' || replace(p_name, ' ', '') END"
    )
    return lines.join(parts, lines.l_partkey == parts.p_partkey).selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", f"{text} AS endpoint"
    )
