"""Ingest, contract and quarantine tests (S-01 ... S-08, R19 ... R24, T2-01)."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from starmart.sources.contract import ContractError, csv_contract, enforce
from starmart.sources.csv import coerce, read_csv_raw, split_quarantine
from starmart.sources.ingest import ingest_table
from starmart.specs import HEALTH_SPECS, TableSpec
from tests.conftest import rows


def write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text, encoding="utf-8")
    return str(p)


def test_bom_header_and_na_tokens(spark, fixture_dir):
    raw = read_csv_raw(spark, f"{fixture_dir}/DIM_STUDENT.csv", HEALTH_SPECS["dim_student"])
    assert raw.columns[0] == "student_key"
    got = {r.student_key: r for r in raw.collect()}
    assert got["2"].Date_of_birth is None and got["2"].End_date is None
    assert got["3"].Date_of_birth is None
    assert got["4"].National_ID is None
    assert got["5"].First_Name == "Eve, Jr"


def test_number_coercion_and_failure_counts(spark, tmp_path):
    path = write(tmp_path, "n.csv", "k,v\n1, 7 \n2,1e3\n3,0x1A\n4,abc\n5,5d\n6,1.5\n7,\n")
    spec = TableSpec("n", (("k", T.LongType()), ("v", T.LongType())))
    typed = coerce(read_csv_raw(spark, path, spec), spec)
    assert rows(typed, "k", "v") == [(1, 7), (2, 1000), (3, None), (4, None), (5, None),
                                     (6, None), (7, None)]
    res = ingest_table(spark, path, spec, str(tmp_path / "out"))
    assert res.rows == 7
    assert res.cast_failures == {"k": 0, "v": 4}


def test_double_coercion_matches_lenient_parser(spark, tmp_path):
    path = write(tmp_path, "d.csv", "k,v\n1, 7 \n2,1e3\n3,5d\n4,1f\n5,NaN\n6,2.25\n")
    spec = TableSpec("d", (("k", T.LongType()), ("v", T.DoubleType())))
    typed = coerce(read_csv_raw(spark, path, spec), spec)
    assert rows(typed, "k", "v") == [(1, 7.0), (2, 1000.0), (3, None), (4, None), (5, None),
                                     (6, 2.25)]


def test_quoted_newline_needs_multiline(spark, tmp_path):
    path = write(tmp_path, "q.csv", 'k,t\n1,"two\nlines"\n2,plain\n')
    spec = TableSpec("q", (("k", T.StringType()), ("t", T.StringType())))
    assert read_csv_raw(spark, path, spec, multiline=True).count() == 2
    assert rows(read_csv_raw(spark, path, spec, multiline=True), "k", "t") == \
        [("1", "two\nlines"), ("2", "plain")]


def test_quarantine_ragged_rows(spark, tmp_path):
    path = write(tmp_path, "r.csv", "a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,11,12\n")
    spec = TableSpec("r", tuple((c, T.StringType()) for c in "abc"))
    raw = read_csv_raw(spark, path, spec, quarantine=True)
    good, bad = split_quarantine(raw, str(tmp_path / "bronze"))
    assert rows(good, "a") == [("1",), ("10",)]
    assert sorted(r.raw_line for r in bad.collect()) == ["4,5", "6,7,8,9"]
    res = ingest_table(spark, path, spec, str(tmp_path / "out"),
                       quarantine_path=str(tmp_path / "quarantine"))
    assert res.rows == 2 and res.quarantined == 2


def test_duplicate_count_counts_nulls(spark, fixture_dir, tmp_path):
    res = ingest_table(spark, f"{fixture_dir}/DIM_STUDENT.csv", HEALTH_SPECS["dim_student"],
                       str(tmp_path / "dim_student"))
    # 5 rows, 3 distinct non-NULL ids (00456 twice, one NULL) -> 2
    assert res.duplicates == 2
    assert res.null_counts == {"student_key": 0, "National_ID": 1}
    assert res.parity_ok is False


def test_contract_reports_missing_columns_and_files(spark, tmp_path):
    spec = HEALTH_SPECS["dim_sleep"]
    ok = write(tmp_path, "ok.csv", "sleep_key,Sleep_Quality\n1,good\n")
    bad = write(tmp_path, "bad.csv", "sleep_key,Quality\n1,good\n")
    empty = write(tmp_path, "empty.csv", "")
    rep = {(r.check_name): r.passed for r in csv_contract(spark, ok, spec).collect()}
    assert rep["required_columns"] and rep["min_rows"] and not rep["row_count_parity"]
    enforce(csv_contract(spark, ok, spec))
    with pytest.raises(ContractError):
        enforce(csv_contract(spark, bad, spec))
    with pytest.raises(ContractError):
        enforce(csv_contract(spark, empty, spec))
    with pytest.raises(ContractError):
        enforce(csv_contract(spark, str(tmp_path / "missing.csv"), spec))


def test_concurrent_ingest_finishes_other_tables_then_raises(spark, tmp_path):
    from starmart.sources.ingest import ingest_all
    write(tmp_path, "a.csv", "k,v\n1,x\n2,y\n")
    write(tmp_path, "b.csv", "k,v\n3,z\n")
    spec = lambda n: TableSpec(n, (("k", T.LongType()), ("v", T.StringType())))
    specs = {"a": spec("a"), "missing": spec("missing"), "b": spec("b")}
    files = {"a": "a.csv", "missing": "nope.csv", "b": "b.csv"}
    out = str(tmp_path / "raw")
    with pytest.raises(Exception):
        ingest_all(spark, str(tmp_path), specs, files, out, max_parallel=3)
    # The independent tables were still ingested completely.
    from starmart.sources.layers import read_table
    assert rows(read_table(spark, f"{out}/a"), "k", "v") == [(1, "x"), (2, "y")]
    assert rows(read_table(spark, f"{out}/b"), "k", "v") == [(3, "z")]
