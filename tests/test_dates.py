"""Everyday spellings of dates, orders settled by the column, day counts in any zone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortine.functions import dates
from cohortine.functions.columns import elapsed_days, iso_date, moment_or_null
from cohortine.functions.dates import DateOrder, settle_orders
from cohortine.operators import adam, sdtm

MORNING = dt.datetime(2024, 1, 5, 10, 30)
MIDNIGHT = dt.datetime(2024, 1, 5)
SPELLINGS = {
    "2024-01-05": MIDNIGHT,
    "2024-1-5": MIDNIGHT,
    "20240105": MIDNIGHT,
    "2024/1/5": MIDNIGHT,
    "2024.01.05": MIDNIGHT,
    "2024-JAN-05": MIDNIGHT,
    "2024-01-05T10:30:00Z": MORNING,
    "2024-01-05T10:30:00+02:00": MORNING,
    "2024-01-05T10:30:00.000Z": MORNING,
    "2024-01-05 10:30:00 -0500": MORNING,
    "2024-01-05T10:30": MORNING,
    "05-Jan-24": MIDNIGHT,
    "05JAN2024": MIDNIGHT,
    "05JAN2024:10:30:00": MORNING,
    "5 January 2024": MIDNIGHT,
    "Jan 5 2024": MIDNIGHT,
    "January 5th, 2024": MIDNIGHT,
    "Fri, 5 Jan 2024 10:30": MORNING,
    "1/5/24": MIDNIGHT,
    "01/05/2024 10:30 AM": MORNING,
    "01/05/2024 10:30:00.000 am": MORNING,
    "01-05-2024": MIDNIGHT,
    "01/05/2024 12:00 AM": MIDNIGHT,
    "01/05/2024 12:30 PM": dt.datetime(2024, 1, 5, 12, 30),
    "13/01/2024": dt.datetime(2024, 1, 13),
    "31/12/99": dt.datetime(1999, 12, 31),
    "Sept 5, 2068": dt.datetime(2068, 9, 5),
    "29-Feb-2023": None,
    "2024-01-05 or later": None,
    "5 of January": None,
    "13:30 PM": None,
    "01/05/2024 13:30 PM": None,
    "99/99/2024": None,
    "hello": None,
    "": None,
}


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_spellings(spark):
    df = texts(spark, *SPELLINGS, None)
    got = {r.v: r.m for r in df.select("v", moment_or_null(df, "v").alias("m")).collect()}
    assert got == {**SPELLINGS, None: None}


@pytest.mark.parametrize(
    "values,want,first",
    [
        (["01/02/2024", "13/02/2024"], DateOrder("DMY", True, 1, 0, 0), "2024-02-01"),
        (["01/02/2024", "02/13/2024", None], DateOrder("MDY", True, 1, 0, 0), "2024-01-02"),
        (["01/02/2024", "05/06/2024"], DateOrder("MDY", False, 2, 0, 0), "2024-01-02"),
        (["01/02/2024", "13/02/2024", "14/02/2024", "02/13/2024"], DateOrder("DMY", False, 1, 1, 0), "2024-02-01"),
        (["24/01/02", "99/12/31", "24-13-13"], DateOrder("YMD", True, 1, 0, 1), "2024-01-02"),
        (["2024-01-02", "?", " ", "5 Jan 2024"], DateOrder("MDY", True, 0, 0, 1), "2024-01-02"),
    ],
)
def test_order_is_settled_by_the_column(spark, values, want, first):
    df = texts(spark, *values).repartition(2)
    found = settle_orders(df, ["v", "absent"])
    assert found == {"v": want}
    got = {r.v: r.d for r in df.select("v", iso_date(df, "v", want.order).alias("d")).collect()}
    assert got[values[0]] == first


def test_typed_and_empty_columns_settle_nothing(spark):
    assert settle_orders(spark.sql("SELECT DATE'2024-01-02' AS v"), ["v"]) == {}
    assert settle_orders(texts(spark).where("v = 'x'"), ["v"]) == {"v": DateOrder()}


def test_domain_reads_each_column_in_its_order(spark):
    rows = [
        (i, 1, 40, "F", "ASIAN", "Drug X", f"{d:02d}/03/2024", f"03/{d:02d}/2024")
        for i, d in enumerate((4, 25))
    ]
    names = "subject_id site_id age sex race arm informed_consent_date randomization_date".split()
    raw = spark.createDataFrame(rows, names)
    dm = sdtm.map_domain(sdtm.DEMOGRAPHICS, raw, "S").orderBy("SUBJID")
    assert [(r.RFICDTC, r.RFSTDTC) for r in dm.collect()] == [("2024-03-04",) * 2, ("2024-03-25",) * 2]
    stated = sdtm.map_domain(sdtm.DEMOGRAPHICS, raw, "S", date_orders={"randomization_date": "DMY"})
    assert stated.orderBy("SUBJID").first().RFSTDTC == "2024-04-03"


ZONES = ("UTC", "America/New_York", "Asia/Kolkata", "Australia/Lord_Howe")


@pytest.fixture(params=ZONES)
def zone(request, spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


PAIRS = [
    ("2024-03-01", "2024-03-31", 30),
    ("2024-10-27", "2024-11-10", 14),
    ("2024-03-10T01:30", "2024-03-11T01:30", 1),
    ("2024-03-10T02:30", "2024-03-11T02:29", 0),
    ("2024-11-03T01:30", "2024-11-02T23:00", -1),
    ("2024-11-03T12:00", "2024-11-01T12:00", -2),
    ("2024-11-03T12:00", "2024-11-01T12:01", -2),
    ("2024-11-03T12:00", "2024-11-01T11:59", -3),
    ("2024-04-06", "2024-04-08T23:59:59.5", 2),
]


def test_day_counts_do_not_depend_on_the_zone(spark, zone):
    df = spark.createDataFrame(PAIRS, "a string, b string, want long")
    days = elapsed_days(moment_or_null(df, "b"), moment_or_null(df, "a"))
    rows = df.select("a", "b", "want", days.alias("got")).collect()
    assert [(r.a, r.b, r.got) for r in rows] == PAIRS


def test_analysis_datasets_do_not_depend_on_the_zone(spark, zone):
    dm = spark.createDataFrame(
        [("S-1-1", 60, "F", "Drug X", "2024-03-01"), ("S-1-2", 60, "M", "Placebo", "2024-10-20")],
        "USUBJID string, AGE int, SEX string, ARM string, RFSTDTC string",
    )
    adsl = adam.subject_level(dm)
    events = spark.createDataFrame(
        [("S-1-1", None, "2024-03-31"), ("S-1-2", "2024-11-19T08:00:00-05:00", None)],
        "USUBJID string, death_date string, last_contact_date string",
    )
    got = adam.overall_survival(adsl, events).orderBy("USUBJID").select("AVAL", "CNSR").collect()
    assert [tuple(r) for r in got] == [(30, 1), (30, 0)]
    ae = spark.createDataFrame(
        [("S-1-1", "2024-03-31", None), ("S-1-2", "2024-11-03 23:30", "2024-11-04"), ("S-1-2", "2024-10-19", None)],
        "USUBJID string, AESTDTC string, AEENDTC string",
    ).withColumns({c: F.lit("Y") for c in ("AESEV", "AESER", "AEREL")})
    rows = adam.adverse_event_analysis(ae, adsl).orderBy("AESTDTC").select("AESTDY", "TRTEMFL").collect()
    assert [tuple(r) for r in rows] == [(31, "Y"), (0, ""), (15, "Y")]


def test_plain_iso_dates_are_read_without_their_parts(spark, monkeypatch):
    texts = ["2024-02-29", "2024-02-30", " 2024-02-28", "2024-2-28", "2024-02-28\n", "0000-01-01", "9999-12-31", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, day string")
    fast = dict(df.select("id", dates.read_moment("day").cast("string")).collect())
    with monkeypatch.context() as slow:
        slow.setattr(dates, "_iso_date", lambda name: F.lit(None).cast("date"))
        assert fast == dict(df.select("id", dates.read_moment("day").cast("string")).collect())
    assert fast[0] == "2024-02-29 00:00:00" and fast[1] is None and fast[2] == "2024-02-28 00:00:00"
    parts = F.split(F.raise_error(F.lit("cut into parts")).cast("string"), r"\|")
    monkeypatch.setattr(dates, "_parts", lambda name: parts)
    plain = df.where("id IN (0, 6)")
    assert plain.where(dates.read_moment("day").isNotNull()).count() == 2


def test_equal_texts_of_a_column_are_counted_before_they_are_read(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    parts = dates._parts
    monkeypatch.setattr(dates, "_parts", lambda name: F.when(counted(name).isNotNull(), parts(name)))
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN '13/01/2024' ELSE '01/02/2024' END AS day")
    found = dates.settle_orders(df, ["day"])["day"]
    assert (found.order, found.open_values, found.against) == ("DMY", 2000, 0)
    assert read.value < 100
