"""Raw CSV: declared schema, header order, short, long and broken lines."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry
from cohortine.operators import sdtm
from cohortine.sources import study_tables as study
from cohortine.sources.raw_files import read_raw_csv

SCHEMA = "subject_id int, note string, value double"
SF = "/root/testdata/sf0.001"


def write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_bytes(text.encode())
    return str(folder)


def test_good_and_broken_lines(spark, tmp_path):
    path = write(
        tmp_path,
        a='subject_id,note,value\n1,"said ""no"", twice",2.5\n2,,\n3,short\n4,long,1,2\nx,no number,1\n',
        b='﻿subject_id, "note" ,value\r\n5,é,1e3\r\n6,"open,1\r\n',
        c="subject_id,note,value\n",
    )
    found = read_raw_csv(spark, path, SCHEMA)
    rows = sorted(map(tuple, found.rows.collect()))
    assert rows == [(1, 'said "no", twice', 2.5), (2, None, None), (5, "é", 1000.0)]
    lines = {(r.file[-5:], r.line.strip()) for r in found.quarantine.collect()}
    assert lines == {("a.csv", "3,short"), ("a.csv", "4,long,1,2"), ("a.csv", "x,no number,1"), ("b.csv", '6,"open,1')}


def test_line_breaks_inside_fields(spark, tmp_path):
    path = write(tmp_path, a='subject_id,note,value\n1,"two\nlines",2\n')
    assert read_raw_csv(spark, path, SCHEMA, multi_line=True).rows.first().note == "two\nlines"


@pytest.mark.parametrize("header", ["note,subject_id,value", "subject_id,note", "1,x,2"])
def test_every_header_is_checked(spark, tmp_path, header):
    path = write(tmp_path, a="subject_id,note,value\n1,x,2\n", b=f"{header}\n1,x,2\n")
    with pytest.raises(ValueError, match="b.csv"):
        read_raw_csv(spark, path, SCHEMA)


def test_domains_from_csv_equal_their_oracle(spark, tmp_path):
    """The raw tables, written as CSV and read back, give the domains' rows."""
    for name, raw, domain, order in (
        ("sdtm_dm", study.raw_demographics(spark, SF), sdtm.DEMOGRAPHICS, None),
        ("sdtm_ae", study.raw_adverse_events(spark, SF), sdtm.ADVERSE_EVENTS, study.LINE_KEYS),
    ):
        path = str(tmp_path / name)
        raw.repartition(3).write.option("header", True).csv(path)
        found = read_raw_csv(spark, path, raw.schema)
        assert found.quarantine.count() == 0
        actual = sdtm.map_domain(domain, found.rows, study.STUDY_ID, order).toArrow()
        expected = duck(SF).sql(entry.oracle_sql()[name]).to_arrow_table()
        assert difference(actual, expected) is None
