import pytest
from pyspark.sql import functions as F

from cohortine.functions.columns import (
    elapsed_days, fixed_text, number_or_null, word_count,
)
from cohortine.operators import conformance, metadata, numbering, sdtm
from cohortine.operators.numbering import number_rows
from cohortine.sinks import files

STUDY = "TRIAL-7"


@pytest.fixture(scope="module")
def raw_dm(spark):
    return spark.createDataFrame(
        [
            ("001", "S1", "64", "male", "White", "Hispanic", "Drug X", "2024-01-10", "2024-01-17"),
            ("002", "S1", "5d", None, "Asian", None, None, "01/17/2024", "2024-13-01"),
            (None, "S2", " 1e1 ", "x", "Black", "No", "Placebo", "2024-02-01 09:30", "20240208"),
        ],
        "subject_id string, site_id string, age string, sex string, race string, "
        "ethnicity string, arm string, informed_consent_date string, randomization_date string",
    )


@pytest.fixture(scope="module")
def raw_ae(spark):
    codes = [
        ("Mild", "Yes", "Related", "Recovered"),
        ("GRADE 3", "n", "Y", "Recovered/Resolved"),
        ("Grade 4", None, "yes", "recovering"),
        ("5", "y", "no", None),
        (None, "maybe", None, "Not Recovered"),
    ]
    rows = [("S1", str(i), "headache", "2024-01-02", "bad", *c) for i, c in enumerate(codes)]
    return spark.createDataFrame(
        rows,
        "site_id string, subject_id string, ae_term string, ae_start_date string, "
        "ae_end_date string, ae_severity string, ae_serious string, ae_related string, "
        "ae_outcome string",
    )


def test_demographics(raw_dm):
    dm = sdtm.map_domain(sdtm.DEMOGRAPHICS, raw_dm, STUDY)
    assert dm.columns == [
        "STUDYID", "DOMAIN", "SUBJID", "SITEID", "USUBJID", "AGE", "AGEU", "SEX", "RACE",
        "ETHNIC", "ARMCD", "ARM", "RFICDTC", "RFSTDTC",
    ]
    first, second, third = dm.collect()
    assert (first.USUBJID, first.AGE, first.SEX) == ("TRIAL-7-S1-001", 64.0, "M")
    assert (first.ARMCD, first.RFSTDTC, first.ETHNIC) == ("DRUG_X", "2024-01-17", "HISPANIC")
    # Text that is no number or date becomes NULL; a NULL cell keeps its NULL.
    assert (second.AGE, second.SEX, second.ARMCD, second.ETHNIC) == (None, "U", None, None)
    assert (second.RFICDTC, second.RFSTDTC) == ("2024-01-17", None)
    assert (third.USUBJID, third.AGE, third.SEX) == (None, 10.0, "U")
    assert (third.RFICDTC, third.RFSTDTC) == ("2024-02-01", "2024-02-08")


def test_absent_ethnicity_takes_default(raw_dm):
    dm = sdtm.map_domain(sdtm.DEMOGRAPHICS, raw_dm.drop("ethnicity"), STUDY)
    assert {r.ETHNIC for r in dm.collect()} == {"UNKNOWN"}


def test_missing_raw_column_is_reported(raw_dm):
    with pytest.raises(ValueError, match="missing required columns"):
        sdtm.map_domain(sdtm.DEMOGRAPHICS, raw_dm.drop("arm"), STUDY)


def test_adverse_events(raw_ae):
    ae = sdtm.map_domain(sdtm.ADVERSE_EVENTS, raw_ae, STUDY, order_by=["subject_id"])
    rows = ae.orderBy("AESEQ").collect()
    assert [r.AESEQ for r in rows] == [1, 2, 3, 4, 5]
    assert [r.AESEV for r in rows] == ["MILD", "SEVERE", "UNKNOWN", "FATAL", "UNKNOWN"]
    assert [r.AESER for r in rows] == ["Y", "N", "N", "Y", "N"]
    # A bare "Y" is not a listed relation code.
    assert [r.AEREL for r in rows] == ["Y", "N", "Y", "N", "N"]
    assert [r.AEOUT for r in rows] == [
        "RECOVERED/RESOLVED", "UNKNOWN", "RECOVERING/RESOLVING", "UNKNOWN",
        "NOT RECOVERED/NOT RESOLVED",
    ]
    assert rows[0].AEDECOD == "HEADACHE" and rows[0].AEBODSYS == ""
    assert rows[0].AEENDTC is None
    assert "AESEQ" not in sdtm.map_domain(sdtm.ADVERSE_EVENTS, raw_ae, STUDY).columns


def test_laboratory_range_indicator(spark):
    rows = [
        ("Hemoglobin", 9.0, 10.0, 12.0),
        ("White Blood", 13.0, None, 12.0),
        ("ALT", 9.0, 10.0, None),
        ("ALT", float("nan"), 10.0, 12.0),
        ("ALT", 10.0, 10.0, 12.0),
        ("ALT", 11.0, None, None),
    ]
    raw = spark.createDataFrame(
        [(str(i), *r) for i, r in enumerate(rows)],
        "subject_id string, lab_test string, lab_result double, lab_ref_low double, "
        "lab_ref_high double",
    ).withColumns(
        {c: F.lit(v) for c, v in {
            "site_id": "S", "lab_unit": "g/dl", "lab_date": "2024-01-01", "visit_name": "Day 1",
        }.items()}
    )
    out = sdtm.map_domain(sdtm.LABORATORY, raw, STUDY, keep=["subject_id"])
    found = out.orderBy("subject_id").collect()
    assert [r.LBNRIND for r in found] == ["LOW", "HIGH", "LOW", "UNKNOWN", "NORMAL", "UNKNOWN"]
    assert [r.LBTESTCD for r in found[:2]] == ["HEMOGLOB", "WHITEBLO"]
    assert found[3].LBSTRESN is None and found[0].LBCAT == "CHEMISTRY"


def test_vital_signs_and_exposure(spark):
    raw = spark.createDataFrame(
        [("1", "S", "Heart Rate", 72, "bpm", "2024-01-01", "Day 1"),
         ("2", "S", "Grip Strength", 30, "kg", "x", "Day 1")],
        "subject_id string, site_id string, vs_test string, vs_result int, vs_unit string, "
        "vs_date string, visit_name string",
    )
    rows = sdtm.map_domain(sdtm.VITAL_SIGNS, raw, STUDY, ["subject_id"]).orderBy("VSSEQ").collect()
    assert [r.VSTESTCD for r in rows] == ["HR", "GRIP STR"]
    assert rows[0].VSPOS == "SITTING" and rows[0].VSORRES == "72" and rows[1].VSDTC is None
    raw = spark.createDataFrame(
        [("1", "S", "drug x", 200, "mg", "iv", "q3w", "2024-01-01", "2024-01-21", "Cycle 1")],
        "subject_id string, site_id string, drug_name string, dose_amount int, dose_unit string, "
        "dose_route string, dose_frequency string, start_date string, end_date string, "
        "visit_name string",
    )
    row = sdtm.map_domain(sdtm.EXPOSURE, raw, STUDY, ["subject_id"]).first()
    assert (row.EXTRT, row.EXDOSE, row.EXROUTE, row.EXSEQ) == ("DRUG X", 200, "IV", 1)


def test_numbering_with_a_hot_leading_key(spark):
    # A third of the rows share the leading key.
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("a"), "id"
    )
    rows = number_rows(df, ["a", "id"], "n").collect()
    assert [r.n for r in sorted(rows, key=lambda r: (r.a, r.id))] == list(range(1, 3001))


def test_controlled_terms(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "code string")
    terms = {"A": "Alpha"}
    assert [r.code for r in sdtm.apply_terms(df, "code", terms).collect()] == ["Alpha", "B", None]
    listed = spark.createDataFrame([("A", "Alpha")], "term string, standard string")
    found = {r.code for r in sdtm.apply_terms(df, "code", listed).collect()}
    assert found == {"Alpha", "B", None}


def test_validate(spark, raw_ae):
    ae = sdtm.map_domain(sdtm.ADVERSE_EVENTS, raw_ae, STUDY, order_by=["subject_id"])
    assert conformance.validate(ae, sdtm.ADVERSE_EVENTS).count() == 0
    summary = conformance.validation_summary(ae, sdtm.ADVERSE_EVENTS).first()
    assert summary.is_valid and summary.summary == "Domain: AE\nValid: True"
    bad = ae.drop("AETERM").withColumns(
        {
            "DOMAIN": F.when(F.col("AESEQ") > 1, F.col("DOMAIN")),
            "USUBJID": F.when(F.col("AESEQ") == 1, "nodash").when(F.col("AESEQ") > 2, F.col("USUBJID")),
        }
    )
    found = {
        (r.rule, r.severity): r.n_records
        for r in conformance.validate(bad, sdtm.ADVERSE_EVENTS).collect()
    }
    assert found == {
        ("required_variable", "ERROR"): 5,
        ("domain_code", "ERROR"): 1,
        ("subject_format", "WARNING"): 2,
    }
    summary = conformance.validation_summary(bad, sdtm.ADVERSE_EVENTS).first()
    assert not summary.is_valid
    assert summary.summary.startswith("Domain: AE\nValid: False\nErrors (2):\n  [ERROR] ")
    # An empty dataset that lacks a variable is still reported.
    empty = ae.drop("AETERM").limit(0)
    assert conformance.validate(empty, sdtm.ADVERSE_EVENTS).count() == 1


def test_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, v int")
    assert [tuple(r) for r in conformance.duplicate_keys(df, ["k"]).collect()] == [("a", 2)]


def test_metadata(spark, raw_dm):
    dm = sdtm.map_domain(sdtm.DEMOGRAPHICS, raw_dm, STUDY).withColumn("EXTRA_VARIABLE", F.lit(1))
    rows = {r.name: r for r in metadata.variable_metadata({"DM": dm}).collect()}
    # The data's type wins over the listed one, and unknown names get defaults.
    assert (rows["AGE"].data_type, rows["AGE"].label) == ("float", "Age")
    extra = rows["EXTRA_VARIABLE"]
    assert (extra.label, extra.data_type, extra.length) == ("EXTRA_VARIABLE", "integer", 200)
    assert (extra.field_name, extra.mandatory, extra.order_number) == ("EXTRA_VA", "No", 15)
    assert rows["STUDYID"].mandatory == "Yes" and rows["AGE"].dataset_records == 3
    datasets = metadata.dataset_metadata({"DM": dm, "ZZ": dm}, {"ZZ": "Custom"}).collect()
    assert [(r.domain, r.label, r.repeating, r.records) for r in datasets] == [
        ("DM", "Demographics", "No", 3),
        ("ZZ", "Custom", "Yes", 3),
    ]
    assert metadata.study_summary({"DM": dm}, STUDY).first().total_datasets == 1


def test_number_text(spark):
    texts = ["5d", "nan", "", " 1e3 ", "-.5", "7.", None, "1,5", "0x1A"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    found = [r[0] for r in df.select(number_or_null(df, "x")).collect()]
    assert found == [None, None, None, 1000.0, -0.5, 7.0, None, None, None]


def test_small_helpers(spark):
    df = spark.createDataFrame([("  a  b\tc ",), ("   ",), ("",)], "t string")
    assert [r[0] for r in df.select(word_count(F.col("t"))).collect()] == [3, 0, 0]
    row = spark.sql(
        "SELECT timestamp'2024-01-02 01:00:00' a, timestamp'2024-01-01 23:00:00' b, 2.675D x"
    ).select(elapsed_days(F.col("a"), F.col("b")), fixed_text(F.col("x"), 2)).first()
    assert tuple(row) == (0, "2.68")


def test_numbers_come_from_the_files(spark, tmp_path):
    """One copy of the rows, without keys or numbers; a hot subject over many files."""
    rows = [(7 if i % 3 else i, 1, f"t{i}", "2024-01-01", None, "1", "Y", "Y", "FATAL", i * 7919 % 1000)
            for i in range(1000)]
    names = [*sdtm.ADVERSE_EVENTS.raw_columns, "key"]
    schema = "subject_id int, site_id int, ae_term string, ae_start_date string, ae_end_date string, " + (
        "ae_severity string, ae_serious string, ae_related string, ae_outcome string, key int"
    )
    raw = spark.createDataFrame(rows, schema)
    assert raw.columns == names
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = sdtm.write_domain(sdtm.ADVERSE_EVENTS, raw, STUDY, ["key"], str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    written = spark.read.parquet(path)
    assert written.count() == 1000 and "AESEQ" not in written.columns and "__key0" not in written.columns
    assert written.select("_metadata.file_name").distinct().count() > 1
    got = files.read_numbered(spark, path, "AESEQ")
    assert sorted(tuple(r) for r in got.select("AESEQ", "AETERM").collect()) == [
        (n, f"T{i}") for n, i in enumerate(sorted(range(1000), key=lambda i: i * 7919 % 1000), 1)
    ]
    same = sdtm.map_domain(sdtm.ADVERSE_EVENTS, raw, STUDY, order_by=["key"])
    assert same.columns == got.columns
    assert sorted(map(str, same.collect())) == sorted(map(str, got.collect()))


def test_numbers_of_an_empty_table_and_of_many_files(spark, tmp_path):
    empty = spark.range(0)
    assert numbering.number_rows(empty, ["id"], "n").count() == 0
    # File names whose numbers differ in width are put in order as numbers.
    for part in (2, 99_999, 100_000):
        spark.range(part, part + 3).coalesce(1).write.parquet(str(tmp_path / f"w{part}"))
    import glob
    import shutil

    place = tmp_path / "all"
    place.mkdir()
    for part in (2, 99_999, 100_000):
        for i, path in enumerate(glob.glob(str(tmp_path / f"w{part}" / "part-*.parquet"))):
            shutil.copy(path, place / f"part-{part:05d}-x-c{i:03d}.snappy.parquet")
    table = spark.read.parquet(str(place))
    rows = numbering.numbered(table, "n").orderBy("n").collect()
    assert [(r.n, r.id) for r in rows] == list(
        enumerate([2, 3, 4, 99_999, 100_000, 100_001, 100_000, 100_001, 100_002], 1)
    )


def test_numbered_rows_are_mapped_once(spark):
    mapped = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(value):
        mapped.add(1)
        return value

    domain = sdtm.Domain("ZZ", ("id",), ("ZZSEQ",), lambda raw, study, orders: {"VALUE": counted("id")}, "ZZSEQ")
    raw = spark.range(500).selectExpr("id", "500 - id AS place")
    rows = sdtm.map_domain(domain, raw, "S", ["place"], date_orders={}).collect()
    assert {(r.VALUE, r.ZZSEQ) for r in rows} == {(i, 500 - i) for i in range(500)}
    assert mapped.value == 500
