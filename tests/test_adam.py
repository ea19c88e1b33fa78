import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortine.functions import columns
from cohortine.operators import adam


@pytest.fixture(scope="module")
def adsl(spark):
    ages = [0.0, 64.0, 64.5, 65.0, 74.0, 75.0, 1000.0, None]
    arms = ["Drug X", "drug y", "Placebo", None, "Placebo", "Placebo", "Placebo", "Placebo"]
    dm = spark.createDataFrame(
        [
            (f"U-{i}", age, "M", arm, "2024-01-10" if i != 5 else "bad")
            for i, (age, arm) in enumerate(zip(ages, arms))
        ],
        "USUBJID string, AGE double, SEX string, ARM string, RFSTDTC string",
    )
    return adam.subject_level(dm)


def test_subject_level(adsl):
    rows = adsl.orderBy("USUBJID").collect()
    assert [r.AGEGR1 for r in rows] == [
        None, "<65", "65-74", "65-74", "65-74", ">=75", None, None,
    ]
    assert [r.AGEGR1N for r in rows] == [None, 1, 2, 2, 2, 3, None, None]
    assert [r.TRT01AN for r in rows[:4]] == [1, 1, 2, 2]
    assert rows[0].TRTSDT == dt.date(2024, 1, 10) and rows[5].TRTSDT is None
    assert {(r.ITTFL, r.SAFFL, r.PPROTFL, r.EVALFL) for r in rows} == {("Y", "Y", "Y", "Y")}


def test_missing_columns_are_named(adsl):
    with pytest.raises(ValueError, match=r"ADSL: missing required columns: \['SEX'\]"):
        adam.subject_level(adsl.drop("SEX"))
    with pytest.raises(ValueError, match="ADAE: missing required columns"):
        adam.adverse_event_analysis(adsl, adsl)


def test_adverse_event_analysis(spark, adsl):
    ae = spark.createDataFrame(
        [
            ("U-0", 1, "2024-01-10", "2024-01-12", "FATAL", "Y", "Y"),
            ("U-0", 2, "2024-01-09", None, "MILD", "N", "N"),
            ("U-5", 3, "2024-01-10", None, "UNKNOWN", None, None),
            ("U-99", 4, "2024-01-10", None, None, "Y", "N"),
        ],
        "USUBJID string, AESEQ int, AESTDTC string, AEENDTC string, AESEV string, AESER string, "
        "AEREL string",
    )
    adae = adam.adverse_event_analysis(ae, adsl, order_by=["AESEQ"])
    rows = adae.orderBy("ASEQ").collect()
    assert [r.ASEQ for r in rows] == [1, 2, 3, 4]
    # The day before treatment start is day 0: one is always added.
    assert [r.AESTDY for r in rows] == [1, 0, None, None]
    assert [r.TRTEMFL for r in rows] == ["Y", "", "", ""]
    assert [r.ATOXGR for r in rows] == [5, 1, 0, 0]
    assert [r.AREL for r in rows] == ["RELATED"] + ["NOT RELATED"] * 3
    assert [r.ASER for r in rows] == ["Y", "N", "N", "Y"]
    assert rows[3].TRTA is None
    reused = adam.adverse_event_analysis(ae, adsl, reuse_sequence=True)
    assert [r.ASEQ for r in reused.orderBy("AESEQ").collect()] == [1, 2, 3, 4]


def test_overall_survival(spark, adsl):
    events = spark.createDataFrame(
        [("U-0", "2024-02-09", "2024-03-01"), ("U-1", None, "2024-01-20")],
        "USUBJID string, death_date string, last_contact_date string",
    )
    rows = adam.overall_survival(adsl, events).orderBy("USUBJID").collect()
    assert len(rows) == 8
    assert [(r.CNSR, r.AVAL, r.EVNTDESC) for r in rows[:3]] == [
        (0, 30, "DEATH"), (1, 10, "CENSORED"), (1, None, "CENSORED"),
    ]


def test_progression_free_survival(spark, adsl):
    response = spark.createDataFrame(
        [
            ("U-0", "2024-02-01", "2024-01-20", "2024-03-01", "kept"),
            ("U-1", None, "2024-01-20", "2024-03-01", "kept"),
            ("U-2", None, None, "2024-01-15", "kept"),
        ],
        "USUBJID string, progression_date string, death_date string, "
        "last_assessment_date string, extra string",
    )
    rows = adam.progression_free_survival(adsl, response).orderBy("USUBJID").collect()
    assert [(r.AVAL, r.EVNTDESC, r.CNSR, r.extra) for r in rows[:3]] == [
        (22, "PROGRESSION", 0, "kept"), (10, "DEATH", 0, "kept"), (5, "CENSORED", 1, "kept"),
    ]
    early = adam.progression_free_survival(adsl, response, earliest=True).orderBy("USUBJID").first()
    assert (early.AVAL, early.EVNTDESC) == (10, "DEATH")


def test_laboratory_analysis(spark, adsl):
    rows = [
        ("U-0", 1, "HGB", None, "SCREENING"),
        ("U-0", 2, "HGB", 10.0, "Day 1"),
        ("U-0", 3, "HGB", 8.0, "Baseline"),
        ("U-0", 4, "HGB", 15.0, "WEEK 2"),
        ("U-0", 5, "ALT", 0.0, "BASELINE"),
        ("U-0", 6, "ALT", 3.0, "WEEK 2"),
        ("U-1", 7, "ALT", 3.0, "WEEK 2"),
        ("U-1", 8, "ALT", None, "WEEK 3"),
    ]
    lb = spark.createDataFrame(
        rows, "USUBJID string, LBSEQ int, LBTESTCD string, LBSTRESN double, VISIT string"
    ).withColumns({"LBTEST": F.col("LBTESTCD"), "LBNRIND": F.lit("NORMAL")})
    found = adam.laboratory_analysis(lb, adsl).orderBy("LBSEQ").collect()
    assert [r.BASE for r in found] == [10.0, 10.0, 10.0, 10.0, 0.0, 0.0, None, None]
    assert [r.ABLFL for r in found] == ["Y", "Y", "Y", "", "Y", "", "", ""]
    assert [r.CHG for r in found] == [None, 0.0, -2.0, 5.0, 0.0, 3.0, None, None]
    assert [r.PCHG for r in found] == [None, 0.0, -20.0, 50.0, None, None, None, None]
    assert found[0].AVALU == ""


def test_spellings_of_dates(spark):
    good = (
        "1/5/2024", "01/05/2024", "05JAN2024", "5-Jan-2024", "January 5, 2024", "Jan 5, 2024",
        "01/05/2024 10:30", "2024-01-05", "2024-01-05T08:00", "2024-01-05 08:00:01.5", "20240105",
        "2024/01/05", "05 Jan 2024", " 2024-01-05 ",
    )
    bad = ("2024-01-05 garbage", "2024-13-01", "", "13/13/2024", "5 of May", None)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "i int, t string")
    got = df.select("i", columns.date_or_null(df, "t").alias("d")).orderBy("i").collect()
    assert [str(r.d) for r in got] == ["2024-01-05"] * len(good) + ["None"] * len(bad)
    moments = df.select("i", columns.moment_or_null(df, "t").cast("string").alias("m"))
    assert {r.m for r in moments.collect() if r.i in (6, 9)} == {
        "2024-01-05 10:30:00", "2024-01-05 08:00:01.5",
    }


def test_times_of_day_decide_emergence(spark):
    adsl = adam.subject_level(
        spark.createDataFrame(
            [("s", 50, "F", "Drug", "2024-01-05T10:30")],
            "USUBJID string, AGE int, SEX string, ARM string, RFSTDTC string",
        )
    )
    row = adsl.first()
    assert str(row.TRTSDT) == "2024-01-05" and str(row.TRTSDTM) == "2024-01-05 10:30:00"
    starts = ("2024-01-05T09:00", "2024-01-05T11:00", "2024-01-06T10:00", "2024-01-06T10:30")
    ae = spark.createDataFrame(
        [("s", t, None, "MILD", "N", "N") for t in starts],
        "USUBJID string, AESTDTC string, AEENDTC string, AESEV string, AESER string, AEREL string",
    )
    got = adam.adverse_event_analysis(ae, adsl).orderBy("AESTDTC").collect()
    assert [(r.TRTEMFL, r.AESTDY) for r in got] == [("", 0), ("Y", 1), ("Y", 1), ("Y", 2)]
    events = spark.createDataFrame(
        [("s", "2024-01-08T10:00", None)],
        "USUBJID string, death_date string, last_contact_date string",
    )
    assert adam.overall_survival(adsl, events).first().AVAL == 2


def test_reused_sequence_needs_unique_subjects(spark):
    adsl = spark.createDataFrame(
        [("s", "Drug", 1, "Y")] * 2, "USUBJID string, TRT01A string, TRT01AN int, SAFFL string"
    ).withColumn("TRTSDT", F.lit("2024-01-01").cast("date"))
    ae = spark.createDataFrame(
        [("s", "2024-01-02", None, "MILD", "N", "N", 1)],
        "USUBJID string, AESTDTC string, AEENDTC string, AESEV string, AESER string, "
        "AEREL string, AESEQ long",
    )
    with pytest.raises(ValueError, match="one ADSL row"):
        adam.adverse_event_analysis(ae, adsl, reuse_sequence=True)


def test_numbered_events_are_derived_once(spark, monkeypatch):
    derived = spark.sparkContext.accumulator(0)

    @F.udf("date")
    def counted(value):
        derived.add(1)
        return value

    monkeypatch.setattr(adam, "date_or_null", lambda df, name: counted(F.col(name)))
    ae = spark.range(500).selectExpr(
        "'S' || id % 7 AS USUBJID", "500 - id AS AESEQ", "'2024-01-0' || (1 + id % 9) AS AESTDTC",
        "date'2024-02-01' AS AEENDTC", "'MILD' AS AESEV", "'N' AS AESER", "'Y' AS AEREL",
    )
    adsl = spark.range(6).selectExpr(
        "'S' || id AS USUBJID", "date'2024-01-03' AS TRTSDT", "'Drug X' AS TRT01A",
        "1 AS TRT01AN", "'Y' AS SAFFL",
    )
    rows = adam.adverse_event_analysis(ae, adsl, order_by=["AESEQ"]).collect()
    assert {(r.AESEQ, r.ASEQ) for r in rows} == {(i, i) for i in range(1, 501)}
    assert {r.AENDT.isoformat() for r in rows} == {"2024-02-01"} and derived.value == 500
