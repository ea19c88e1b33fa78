import csv
import glob
import json

import pytest
from pyspark.sql import functions as F

from cohortine.operators import metadata, protocol, summaries, tables
from cohortine.sinks import files
from cohortine.sources import protocols

ARMS = ["Drug X", "Placebo"]


@pytest.fixture(scope="module")
def adsl(spark):
    rows = [
        ("u1", "S1", 40, "<65", "M", "WHITE", "Drug X", "Y"),
        ("u2", "S1", 50, "<65", "F", "ASIAN", "Drug X", "Y"),
        ("u3", "S1", 70, "65-74", None, "WHITE", "Drug X", "Y"),
        ("u4", "S2", 80, ">=75", "F", None, "Placebo", "Y"),
        ("u5", "S2", 60, "<65", "F", "WHITE", "Placebo", "N"),
        ("u6", "S2", 60, "<65", "F", "WHITE", None, "Y"),
    ]
    return spark.createDataFrame(
        rows,
        "USUBJID string, SITEID string, AGE int, AGEGR1 string, SEX string, RACE string, "
        "TRTA string, SAFFL string",
    )


@pytest.fixture(scope="module")
def adae(spark):
    rows = [
        ("u1", "Drug X", "NAUSEA", "Y", "Y", "Y", 3, "FATAL"),
        ("u1", "Drug X", "NAUSEA", "Y", "N", "N", 1, "UNKNOWN"),
        ("u2", "Drug X", "RASH", "Y", "N", "Y", 2, "UNKNOWN"),
        ("u2", "Drug X", "COUGH", "Y", "N", "Y", None, None),
        ("u3", "Drug X", "RASH", "", "Y", "Y", 5, "FATAL"),
        (None, "Drug X", "RASH", "Y", "Y", "Y", 5, "FATAL"),
    ]
    return spark.createDataFrame(
        rows,
        "USUBJID string, TRTA string, AEDECOD string, TRTEMFL string, ASER string, AEREL string, "
        "ATOXGR int, AEOUT string",
    )


def body(report):
    return report.body.orderBy(*report.order_by).collect()


def test_demographics(adsl):
    report = tables.demographics(adsl)
    assert report.number == "14.1.1" and report.footnotes
    rows = {r.characteristic.strip(): (r["Drug X"], r["Placebo"]) for r in body(report)}
    assert rows["Characteristic"] == ("(N=3)", "(N=1)")
    assert rows["n"] == ("3", "1")
    # One subject leaves the standard deviation undefined.
    assert rows["Mean (SD)"] == ("53.3 (15.28)", "80.0 (nan)")
    assert rows["Median"] == ("50.0", "80.0") and rows["Min, Max"] == ("40.0, 70.0", "80.0, 80.0")
    assert rows["Male"] == ("1 (33.3%)", "0 (0.0%)")
    assert rows["WHITE"] == ("2 (66.7%)", "0 (0.0%)") and rows["ASIAN"] == ("1 (33.3%)", "0 (0.0%)")
    assert rows[">=75"] == ("0 (0.0%)", "1 (100.0%)")
    order = [r.characteristic for r in body(report)]
    assert order.index("Sex, n (%)") < order.index("  Female") < order.index("Race, n (%)")


def test_demographics_without_ages(adsl):
    unknown = adsl.withColumn("AGE", F.lit(None).cast("int")).drop("AGEGR1")
    rows = {r.characteristic.strip(): r["Drug X"] for r in body(tables.demographics(unknown))}
    assert rows["Median"] == "-" and "Age group, n (%)" not in rows


def test_adverse_events(adsl, adae):
    rows = [(r["Drug X"], r["Placebo"]) for r in body(tables.adverse_events(adae, adsl))]
    assert rows == [
        ("(N=3)", "(N=1)"),
        ("2 (66.7%)", "0 (0.0%)"),
        ("1 (33.3%)", "0 (0.0%)"),
        ("2 (66.7%)", "0 (0.0%)"),
        ("1 (33.3%)", "0 (0.0%)"),
        ("1 (33.3%)", "0 (0.0%)"),
    ]


def test_total_column(spark, adsl, adae):
    """Over all arms, also those without a column; a subject with events in two arms counts once."""
    arms = ["Drug X", tables.TOTAL]
    rows = {r.characteristic.strip(): r for r in body(tables.demographics(adsl, arms=arms))}
    assert rows["Characteristic"].Total == "(N=4)" and rows["Characteristic"]["Drug X"] == "(N=3)"
    assert rows["Mean (SD)"].Total == "60.0 (18.26)" and rows["Median"].Total == "60.0"
    assert rows["Male"].Total == "1 (25.0%)" and rows[">=75"].Total == "1 (25.0%)"
    crossed = adae.unionByName(adae.withColumn("TRTA", F.lit("Placebo")))
    events = [(r["Drug X"], r.Total) for r in body(tables.adverse_events(crossed, adsl, arms=arms))]
    assert events[:2] == [("(N=3)", "(N=4)"), ("2 (66.7%)", "2 (50.0%)")]
    shift = spark.createDataFrame(
        [(u, i, a, 10.0 + i, "Y" if i == 1 else "", "LOW" if i == 1 else "HIGH")
         for u, a in (("u1", "Drug X"), ("u2", "Placebo"), ("u3", "Other")) for i in (1, 2)],
        "USUBJID string, LBSEQ int, TRTA string, AVAL double, ABLFL string, ANRIND string",
    ).withColumn("PARAMCD", F.lit("HGB"))
    assert [tuple(r) for r in body(tables.lab_shift(shift, "HGB", arms=arms))] == [("LOW", "HIGH", 1, 3)]


def test_lab_shift(spark):
    rows = [
        ("u1", 1, "Drug X", 10.0, "Y", "NORMAL"),
        ("u1", 2, "Drug X", 11.0, "Y", "LOW"),  # two baseline records fan out
        ("u1", 3, "Drug X", 15.0, "", "NORMAL"),
        ("u1", 4, "Drug X", 15.0, "", "HIGH"),  # tied: the earlier record wins
        ("u1", 5, "Drug X", 1.0, "", "LOW"),
        ("u2", 6, "Placebo", 10.0, "Y", "NORMAL"),
        ("u2", 7, "Placebo", None, "", "UNKNOWN"),
        ("u2", 8, "Placebo", 20.0, "", None),  # no category: the next one counts
        ("u2", 9, "Placebo", 12.0, "", "HIGH"),
        ("u3", 10, "Placebo", 12.0, "", "HIGH"),  # no baseline
        ("u4", 11, "Placebo", 12.0, "Y", None),
        ("u4", 12, "Placebo", 12.0, "", "HIGH"),
    ]
    adlb = spark.createDataFrame(
        rows,
        "USUBJID string, LBSEQ int, TRTA string, AVAL double, ABLFL string, ANRIND string",
    ).withColumn("PARAMCD", F.lit("HGB"))
    assert [tuple(r) for r in body(tables.lab_shift(adlb, "HGB"))] == [
        ("LOW", "NORMAL", 1, 0), ("NORMAL", "HIGH", 0, 1), ("NORMAL", "NORMAL", 1, 0),
    ]
    assert tables.lab_shift(adlb, "HGB").title.startswith("Shift Table: HGB (")
    low = tables.lab_shift(adlb, "HGB", direction="low")
    assert [tuple(r) for r in body(low)][0] == ("LOW", "LOW", 1, 0)
    assert tables.lab_shift(adlb, "none", arms=ARMS).body.count() == 0
    with pytest.raises(ValueError):
        tables.lab_shift(adlb, "HGB", direction="sideways")


def test_listing(adsl):
    report = tables.subject_listing(adsl, cols=["AGE", "USUBJID", "NOPE"])
    assert report.body.columns == ["AGE", "USUBJID"]
    assert [r.USUBJID for r in report.body.collect()] == [f"u{i}" for i in range(1, 7)]
    assert "SEX" in tables.subject_listing(adsl).body.columns


def test_summaries(spark, adsl, adae):
    rows = {r.arm: r for r in summaries.demographics_summary(adsl).collect()}
    assert (rows["Drug X"].n, rows["Drug X"].age_mean, rows["Drug X"].age_min) == (3, 53.3, 40)
    # The subject without recorded sex stays in the denominator.
    assert (rows["Drug X"].sex_m_n, rows["Drug X"].sex_m_pct) == (1, 33.3)
    assert rows["Placebo"].n == 2
    safety = {r.arm: r for r in summaries.safety_summary(adae, adsl).collect()}
    assert (safety["Drug X"].n_safety, safety["Drug X"].n_any_teae) == (3, 2)
    assert (safety["Placebo"].n_safety, safety["Placebo"].n_any_teae, safety["Placebo"].pct_any_teae) == (
        2, 0, 0.0,
    )
    terms = summaries.top_terms(adae, k=2).orderBy("rank").collect()
    assert [(r.term, r.n_subjects) for r in terms] == [("COUGH", 1), ("NAUSEA", 1)]
    adtte = spark.createDataFrame(
        [("Drug X", "OS", "Overall Survival", 10, 0), ("Drug X", "OS", "Overall Survival", 20, 1),
         ("Drug X", "PFS", "Other", 99, 1)],
        "TRTA string, PARAMCD string, PARAM string, AVAL int, CNSR int",
    )
    for endpoint in ("OS", "Overall Survival"):
        row = summaries.time_to_event_summary(adtte, endpoint).first()
        assert (row.n, row.n_events, row.event_rate, row.median_aval) == (2, 1, 50.0, 15.0)
    assert summaries.time_to_event_summary(adtte).first().n == 3
    payload = summaries.section_payload(adsl, adae, adtte, "OS").collect()
    stats = {(r.section, r.arm): json.loads(r.stats) for r in payload}
    assert stats["11.4", "Drug X"]["n_events"] == 1
    assert stats["11.5", "Drug X"]["top5_preferred_terms"][0]["term"] == "COUGH"
    assert stats["11.5", "Placebo"]["top5_preferred_terms"] is None


def test_sinks(spark, adsl, tmp_path):
    path = files.write_dataset(adsl, "ADSL", str(tmp_path), ["SITEID"])
    assert path.endswith("/adsl") and spark.read.parquet(path).count() == 6
    path = files.write_report(tables.demographics(adsl), str(tmp_path))
    assert path.endswith("table_14_1_1")
    lines = [r for f in sorted(glob.glob(f"{path}/*.csv")) for r in csv.reader(open(f))]
    assert lines[0] == ["characteristic", *ARMS] and lines[1] == ["Characteristic", "(N=3)", "(N=1)"]
    variables = metadata.variable_metadata({"DM": adsl})
    items, groups = files.write_define(variables, metadata.dataset_metadata({"DM": adsl}), str(tmp_path))
    back = spark.read.format("xml").option("rowTag", "ItemDef").load(items)
    assert back.where("_OID = 'IT.DM.AGE' and _DataType = 'integer'").count() == 1
    group = spark.read.format("xml").option("rowTag", "ItemGroupDef").load(groups).first()
    assert group._Records == 6 and len(group.ItemRef) == 8 and group._Repeating == "No"


PROTOCOL = {
    "study_title": "Trial",
    "protocol_number": "P-1",
    "primary_endpoints": ["Overall survival (OS)", "Progression-free survival (PFS)"],
    "secondary_endpoints": ["xyzzy frobnicate entanglement score"],
    "inclusion_criteria": ["Adequate laboratory values"],
    "treatment_arms": [{"arm_name": "Drug X", "dose": "200mg", "route": "IV", "frequency": "Q3W"}],
    "visit_schedule": [{"visit_name": "V1", "visit_day": "Day 1", "assessments": ["ECG", "PK"]}],
}


def test_protocol(spark, tmp_path):
    text = json.dumps(PROTOCOL)
    parsed = protocols.parse_protocols(spark.createDataFrame([(text,)], "doc string"), "doc")
    row = parsed.first()
    assert set(parsed.columns) == set(protocols.PROTOCOL_SCHEMA.names)
    assert row.raw_text_length == len(text) and row.exclusion_criteria == []
    assert row.treatment_arms[0].route == "IV" and row.visit_schedule[0].assessments == ["ECG", "PK"]
    (tmp_path / "p.json").write_text(json.dumps(PROTOCOL, indent=1))
    assert protocols.read_protocols(spark, str(tmp_path)).first().protocol_number == "P-1"
    mapping = protocol.map_items(protocol.protocol_items(parsed))
    rows = {r.endpoint: r for r in mapping.collect()}
    assert len(rows) == 4
    assert rows["Overall survival (OS)"].suggested_adam_dataset == "ADTTE"
    assert rows["Adequate laboratory values"].suggested_sdtm_domain == "LB"
    unknown = rows["xyzzy frobnicate entanglement score"]
    assert unknown.confidence == "low" and unknown.requires_suppqual
    summary = protocol.mapping_summary(mapping).first()
    assert (summary.total_endpoints, summary.low_confidence_count, summary.suppqual_required) == (4, 1, 1)
    out = str(tmp_path / "mapping")
    files.write_mapping(mapping, out)
    assert open(glob.glob(f"{out}/*.csv")[0]).readline().startswith("endpoint,")


def test_mapping_by_a_rule_table(spark):
    rules = spark.createDataFrame(
        [
            ("dose", "EX", "ADEX", "medium"),
            ("survival", "DM", "ADTTE", "medium"),
            ("progression-free survival", "RS", "ADTTE", "high"),
            ("free text", "CO", "ADCO", "high"),
            ("age >=", "DM", "ADSL", "high"),
            ("vital sign", "VS", "ADVS", "high"),
            ("vital sign", "XX", "ADXX", "high"),  # listed twice: the first in order counts
            ("--", "ZZ", "ADZZ", "high"),  # no word: never fits
            (None, "ZZ", "ADZZ", "high"),
        ],
        "keyword string, domain string, dataset string, confidence string",
    )
    want = {
        "Overdose of anything": None,
        "Doses given": "EX",
        "PROGRESSION-FREE SURVIVAL (PFS)": "RS",
        "Progression free of survival": "DM",
        "Free-text": "CO",
        "Age>=18": "DM",
        "Age > 18": None,
        "Vital signs, dose by dose": "VS",
        "Ends with a vital": None,
        "": None,
        None: None,
        "x " * 20_000 + "dose": "EX",
    }
    items = spark.createDataFrame([(i, t) for i, t in enumerate([*want, "Doses given"])], "id int, endpoint string")
    rows = protocol.map_items(items, rules).collect()
    assert len(rows) == len(want) + 1
    for r in rows:
        assert r.suggested_sdtm_domain == want[r.endpoint], r.endpoint
        assert r.requires_suppqual == (want[r.endpoint] is None)
    assert protocol.map_items(items, rules.limit(0)).where("confidence = 'low'").count() == len(rows)


def test_mapping_meets_only_rules_whose_whole_phrase_stands_in_the_text(spark):
    # All rules begin with the same word, so pairs by the first word would be n * n.
    n = 3000
    rules = spark.range(n).selectExpr(
        "'lesion count ' || id AS keyword", "'D' || id AS domain", "'A' AS dataset", "'high' AS confidence"
    )
    texts = spark.range(n).selectExpr("id AS __text", "'Rise in lesion count ' || id || ' at week 2' AS endpoint")
    assert protocol._best_rules(texts, rules).where("rule.domain = 'D' || __text").count() == n
    phrases = texts.select(F.explode(protocol._phrases(F.col("endpoint"), [3])).alias("phrase"))
    assert phrases.where("phrase LIKE 'lesion count %'").count() == n
    assert phrases.count() == 6 * n
    short = texts.select(protocol._phrases(F.lit("Two words"), [1, 2, 3]).alias("all")).first()
    assert short["all"] == ["two", "word", "two word"]


def test_items_of_a_frequent_text_are_spread(spark, monkeypatch):
    monkeypatch.setattr(protocol, "_LARGE", 0)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        text = "CASE WHEN id % 4 < 2 THEN 'Overall survival' WHEN id % 4 = 2 THEN null ELSE 'Dose ' || id END"
        items = spark.range(8000).selectExpr("id", f"{text} AS endpoint")
        mapped = protocol.map_items(items)
        sizes = [r["count"] for r in mapped.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 8000 and len(sizes) == 16 and max(sizes) < 1000
        counts = dict(mapped.groupBy("suggested_sdtm_domain").agg(F.count("*")).collect())
        assert counts == {"DM": 4000, "EX": 2000, None: 2000}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
