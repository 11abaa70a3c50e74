"""Inputs that once lost or shifted rows without an error."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows
from opsflow.operators import categorize as cat
from opsflow.operators import clusters as cl
from opsflow.operators import runs, status, transfer
from opsflow.plans import jobs
from opsflow.sources import files


def test_missing_day_folder_raises(spark, tmp_path):
    base = str(tmp_path / "t")
    spark.createDataFrame([(1, 2024, 1, 5)], "id int, year int, month int, day int").write.partitionBy("year", "month", "day").parquet(base)
    assert rows(files.read_dated(spark, "parquet", base, "d", dt.date(2024, 1, 5))) == [(1,)]
    with pytest.raises(AnalysisException) as e:
        files.read_dated(spark, "parquet", base, "d", dt.date(2024, 1, 6))
    assert e.value.getCondition() == "PATH_NOT_FOUND"


def test_manifest_by_header_name(spark, tmp_path):
    (tmp_path / "m.csv").write_text("DEST_TABLE_NAME|TEMP_STORAGE_LOCATION|PROCESS_NAME|COLUMN_LIST\nt1|/tmp/x|p|a,b\n")
    got = files.read_manifest(spark, str(tmp_path / "m.csv")).first()
    assert (got.DEST_TABLE_NAME, got.PROCESS_NAME, got.COLUMN_LIST, got.TEMP_STORAGE_LOCATION) == ("t1", "p", "a,b", "/tmp/x")
    assert got.WHERE_CLAUSE is None


def test_positional_rows_after_a_short_one(spark, tmp_path):
    (tmp_path / "r.csv").write_text("a,b,c\nd,1,2,3,4,5,6,OK,9\n")
    got = files.read_positional_csv(spark, str(tmp_path / "r.csv"), {"usecase": 1, "category": 8})
    assert rows(got) == [("a", None), ("d", "OK")]


def test_braces_in_manifest_text(spark):
    df = spark.createDataFrame([("1",), ("12",)], "id string")
    assert rows(transfer.project(spark, df, None, "id rlike '^[0-9]{1}$'")) == [("1",)]


def test_null_frequency_is_daily(spark):
    df = spark.createDataFrame([("a", None, 90.0), ("b", "DAILY", 10.0)], "usecase string, FREQ string, mtd double")
    assert rows(status.dashboard_order(df), "position", "usecase") == [(1, "b"), (2, "a")]


def test_latest_attempt_breaks_ties(spark):
    df = spark.createDataFrame([("j", 1, "a"), ("j", 1, "b")], "job string, start int, app string")
    assert rows(runs.latest_attempt(df, "job", "start", ["app"])) == [("j", 1, "b")]


def test_other_errors_are_not_a_first_run(spark, tmp_path):
    (tmp_path / "m.csv").write_text("u,09:00,DAILY\n")
    (tmp_path / "raw.csv").write_text("u,1,2,3,4,5,6,OK\n")
    spark.createDataFrame([("u", dt.date(2024, 1, 1), "OK")], "other string, report_date date, category string").write.parquet(str(tmp_path / "h"))
    with pytest.raises(AnalysisException):
        jobs.dashboard_run(spark, str(tmp_path / "m.csv"), str(tmp_path / "raw.csv"), str(tmp_path / "h"), str(tmp_path / "s"),
                           dt.date(2024, 1, 2), "20240102")


def test_one_row_per_transaction_when_the_map_varies(spark):
    m = spark.createDataFrame(
        [("a", "7", '{"catIdEdit":"11","accOfDec":"9"}', ["x", "x"]),
         ("a", "8", '{"catIdEdit":"12","accOfDec":"95"}', ["y"]),
         ("a", "7", '{"catIdEdit":"11","accOfDec":"10"}', ["x", "x"]),
         ("a", None, None, None), ("b", "9-10", None, None), (None, "5", None, None)],
        "accIdent string, cat_id string, udCat string, decCatId array<string>")
    dm = cat.prepare_decision_map(m)
    got = {r["accIdent"]: (r["cat_id"], r["usDecCatId"], r["decCatId"])
           for r in cat.decisions_per_key(dm, "accIdent").collect()}
    assert got == {"a": ("7-8", ["12", "11"], ["x", "y"]), "b": ("9-10", [], None), None: ("5", [], None)}
    txn = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "accIdent string, tranI int").selectExpr(
        "accIdent", "cast(tranI as string) tranI", "'x' tranDt", "'1' cost", "'U/x' tranT", "'p' payType")
    tree = spark.createDataFrame([("7", "seven")], "catId string, catN string")
    for keys in (None, txn):
        out = cat.categorize(txn, m, tree, join_key="accIdent", batch_keys=keys)
        assert sorted((r["accIdent"], r["catId"]) for r in out.select("accIdent", "catId").collect()) == [
            ("a", "7-8"), ("b", "9-10"), ("c", None)]


def test_status_code_is_a_whole_word(spark):
    df = spark.createDataFrame([("ok (late)",), ("TOKEN",), ("x DLT",), ("OK_1",), ("",), (None,)], "category string")
    tally = {r["code"]: r["n"] for r in status.code_tally(df, []).collect()}
    assert tally == {"OK": 1, "DLT": 1, "UNCLASSIFIED": 4}


def test_raw_order_is_path_order_and_master_rows_do_not_multiply(spark, tmp_path):
    raw, master = tmp_path / "raw", tmp_path / "master"
    raw.mkdir(), master.mkdir()
    line = "uc1,10:00,DLY,d,t,1,-,{}\n"
    (raw / "a.txt").write_text(line.format("OK"))
    (raw / "b.txt").write_text(line.format("SRC") * 50)
    (master / "m.csv").write_text("uc1,10:00,DLY\nuc1,11:00,DLY\n")
    out = jobs.dashboard_run(spark, str(master), str(raw), str(tmp_path / "hist"), str(tmp_path / "snap"),
                             dt.date(2024, 1, 30), "r1")
    got = out.dashboard.select("usecase", "SLA", "d20240130").collect()
    assert sorted(tuple(r) for r in got) == [("uc1", "10:00", "OK"), ("uc1", "11:00", "OK")]


def test_only_recent_launch_events_name_a_creator(spark):
    rows = [("u1", "RunJobFlow", dt.datetime(2024, 1, 30)), ("u2", "TerminateJobFlows", dt.datetime(2024, 1, 30)),
            ("u3", "RunJobFlow", dt.datetime(2023, 1, 1)), ("u4", None, None)]
    ev = spark.createDataFrame(rows, "Username string, EventName string, EventTime timestamp_ntz")
    kept = cl.launch_events(ev, F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
    assert [r["Username"] for r in kept.collect()] == ["u1"]
