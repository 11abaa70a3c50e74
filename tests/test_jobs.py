import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from opsflow.operators import transfer
from opsflow.plans import jobs
from opsflow.session import scratch_path
from opsflow.sources import jdbc


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_dashboard_run_two_days(spark):
    root = tempfile.mkdtemp(prefix="opsflow-dash-")
    _write(f"{root}/master", "m.txt", ["UC1,10:00,DLY", "UC2,11:00,MLY_01", "UC3,12:00,DLY"])
    hist, snap = scratch_path(spark, "t_dash_hist"), scratch_path(spark, "t_dash_snap")
    _write(f"{root}/raw1", "r.txt", ["uc1,a,b,c,d,e,SUCCESS,OK", "UC2,a,b,c,d,e,FAILED,DLT", "UC1,a,b,c,d,e,x,SRC"])
    jobs.dashboard_run(spark, f"{root}/master", f"{root}/raw1", hist, snap, dt.date(2024, 1, 29), "r1")
    _write(f"{root}/raw2", "r.txt", ["UC1,a,b,c,d,e,FAILED,SRC", "UC3,a,b,c,d,e,SUCCESS,OK"])
    rep = scratch_path(spark, "t_dash_rep")
    out = jobs.dashboard_run(spark, f"{root}/master", f"{root}/raw2", hist, snap, dt.date(2024, 1, 30), "r2",
                             report_folder=rep)
    written = spark.read.option("header", "true").csv(f"{rep}/dashboard/run_ts=r2")
    assert written.columns[:6] == ["USECASE", "SLA", "FREQ", "MTD", "MTD-DL", "20240130"]
    rows = {r["usecase"]: r for r in out.dashboard.collect()}
    assert (rows["UC1"]["d20240130"], rows["UC1"]["d20240129"]) == ("SRC", "OK")
    assert rows["UC1"]["MTD"] == 50 and rows["UC3"]["MTD"] == 100 and rows["UC2"]["MTD_DL"] == 0
    order = [r["usecase"] for r in out.dashboard.orderBy("position").collect()]
    assert order == ["UC1", "UC3", "UC2"]                 # daily by MTD, monthly last
    assert [r["line"] for r in out.failures.collect()] == ["UC1,a,b,c,d,e,FAILED,SRC"]
    assert out.report.count() == 3
    # rerun of the same day keeps one copy in the history
    jobs.dashboard_run(spark, f"{root}/master", f"{root}/raw2", hist, snap, dt.date(2024, 1, 30), "r3")
    assert spark.read.parquet(hist).filter(F.col("report_date") == dt.date(2024, 1, 30)).count() == 3
    # lines that arrive later are seen by the next run on the same path
    _write(f"{root}/raw2", "s.txt", ["UC2,a,b,c,d,e,SUCCESS,OK"])
    out = jobs.dashboard_run(spark, f"{root}/master", f"{root}/raw2", hist, snap, dt.date(2024, 1, 30), "r4")
    assert {r["usecase"]: r["d20240130"] for r in out.dashboard.collect()}["UC2"] == "OK"


def test_cluster_report_run(spark):
    root = tempfile.mkdtemp(prefix="opsflow-clu-")
    _write(f"{root}/c", "c.json", [
        '{"Id": "j-1", "NormalizedInstanceHours": 8, "Status": {"State": "WAITING", "Timeline": '
        '{"CreationDateTime": "2024-01-29T00:00:00", "ReadyDateTime": "2024-01-29T01:00:00"}}}',
        '{"Id": "j-2", "NormalizedInstanceHours": 16, "Status": {"State": "WAITING", "Timeline": '
        '{"CreationDateTime": "2024-01-20T00:00:00"}}}',
        '{"Id": "j-3", "NormalizedInstanceHours": 99, "Status": {"State": "TERMINATED", "Timeline": '
        '{"CreationDateTime": "2024-01-20T00:00:00"}}}'])
    _write(f"{root}/e", "e.json", [
        '{"Username": "%s", "EventName": "%s", "EventTime": "%s", "CloudTrailEvent": '
        '"{\\"responseElements\\": {\\"jobFlowId\\": \\"j-1\\"}}"}' % e
        for e in (("alice", "RunJobFlow", "2024-01-29T00:00:00"), ("eve", "AddTags", "2024-01-29T00:00:00"),
                  ("old", "RunJobFlow", "2020-01-01T00:00:00"))])
    _write(f"{root}/m", "m.json", ['{"ClusterId": "j-1", "Timestamp": "2024-01-29T23:00:00", "IsIdle": 1.0}'])
    out_folder = scratch_path(spark, "t_clu_out")
    rep = jobs.cluster_report_run(spark, f"{root}/c", f"{root}/e", f"{root}/m", dt.datetime(2024, 1, 30),
                                  out_folder, "01-30-2024_00-00-00", rate=2.0)
    got = [(r["ClusterId"], r["Username"], r["idle_pct_3h"], r["ApproxCost"]) for r in rep.orderBy("position").collect()]
    assert got == [("j-2", None, None, 32.0), ("j-1", "alice", 1.0, 16.0)]
    csv = spark.read.option("header", "true").csv(f"{out_folder}/run_ts=01-30-2024_00-00-00")
    assert csv.count() == 2 and csv.columns[0] == "Username" and "idle% in last 3hours" in csv.columns


def test_transfer_round_and_ready_loads(spark):
    root = tempfile.mkdtemp(prefix="opsflow-tr-")
    _write(f"{root}/logs", "p~cc~t1~M.log", ["1~#~BB~#~~#~~#~t1~#~x", "Data Transfer Successful :t1"])
    _write(f"{root}/logs", "p~cc~t2~t.log", ["started only"])
    _write(f"{root}/markers", "success-p-cc-t20-1", ["x"])
    wanted = spark.createDataFrame([("p~cc~t1~M",), ("p~cc~t2~t",), ("p~cc~t3~t",), ("p~cc~t4~M",)], "process_key string")
    state, summary = jobs.transfer_round(spark, wanted, f"{root}/logs", f"{root}/markers", past_deadline=False)
    st = {r["process_key"]: (r["pending"], r["ready"]) for r in state.collect()}
    assert st == {"p~cc~t1~M": (False, True), "p~cc~t2~t": (True, True), "p~cc~t3~t": (True, False),
                  "p~cc~t4~M": (True, True)}
    s = summary.first()
    assert (s["transfer_pending"], s["ingestion_pending"], s["ingestion_completed"], s["status"]) == (3, 1, 2, "RUNNING")

    db = os.path.join(tempfile.mkdtemp(prefix="opsflow-derby-"), "db")
    url, opts = f"jdbc:derby:{db};create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    jdbc.write_table(spark.createDataFrame([], "TableName string, LoadDate date, Status string, ProcessDateTime timestamp"),
                     url, "AUDIT", "overwrite",
                     options={**opts, "createTableColumnTypes": "TableName VARCHAR(128), Status VARCHAR(32)"})
    src = scratch_path(spark, "t_tr_src")
    spark.range(5).withColumn("v", F.col("id") * 2.0).write.parquet(src)
    mpath = scratch_path(spark, "t_tr_manifest")
    cols = transfer.C.MANIFEST_COLUMNS
    spark.createDataFrame([("P~CC~T2~T", "d", "parquet", "OUT2", "append", "AUDIT", "M", src, "id", "v > 4"),
                           ("p~cc~t4~m", "d", "parquet", "OUT4", "append", "AUDIT", "M", src, "id", None),
                           ("p~cc~t4~m", "d", "parquet", "OUT5", "append", "AUDIT", "M", "/nonexistent/x", None, None),
                           ("p~cc~t3~t", "d", "parquet", "OUT3", "append", "AUDIT", "M", src, None, None)],
                          ", ".join(f"{c} string" for c in cols)).write.option("header", "true").option("delimiter", "|").csv(mpath)
    dest = transfer.Destination(url, opts, scratch_path(spark, "t_tr_audit"))
    logs2, errs = scratch_path(spark, "t_tr_logs"), scratch_path(spark, "t_tr_err")
    loaded, failed = jobs.transfer_ready(spark, state, mpath, dest, dt.date(2024, 1, 30), dt.datetime(2024, 1, 30, 23, 30),
                                         log_folder=logs2, error_folder=errs)
    assert loaded == ["OUT2", "OUT4"] and failed == ["OUT5"]      # t3 is not ready
    assert sorted(r[0] for r in jdbc.read_table(spark, url, "OUT2", opts).collect()) == [3, 4]
    # next round: the completion line marks t2 as done
    state2, summary2 = jobs.transfer_round(spark, wanted.filter("process_key = 'p~cc~t2~t'"), logs2, None, False)
    assert summary2.first()["status"] == "SUCCESS"
    # a process with a failed table stays pending
    state4, _ = jobs.transfer_round(spark, wanted.filter("process_key = 'p~cc~t4~M'"), logs2, None, False)
    assert state4.first()["pending"]
    stages = {tuple(r["value"].split(transfer.C.LOG_SEPARATOR)[5:7]) for r in spark.read.text(logs2).collect()
              if transfer.C.LOG_SEPARATOR in r["value"]}
    assert stages == {("SPARK_CONNECT", "SUCCESS"), ("Data Transfer", "STARTED"), ("Data Transfer", "SUCCESS"),
                      ("Data Transfer", "FAILED")}


@pytest.mark.parametrize("concurrent", [1, 4])
def test_transfer_ready_gates_once_and_repeats_in_order(spark, concurrent):
    """Tables finished today are skipped; of two rows for one table the second sees the first as finished."""
    db = os.path.join(tempfile.mkdtemp(prefix="opsflow-derby-"), "db")
    url, opts = f"jdbc:derby:{db};create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    day = dt.date(2024, 1, 30)
    audit = spark.createDataFrame([("DONE", day, "Finished", dt.datetime(2024, 1, 30)),
                                   ("N0", day, "Started", dt.datetime(2024, 1, 30))],
                                  "TableName string, LoadDate date, Status string, ProcessDateTime timestamp")
    jdbc.write_table(audit, url, "AUDIT", "overwrite",
                     options={**opts, "createTableColumnTypes": "TableName VARCHAR(128), Status VARCHAR(32)"})
    src, mpath = scratch_path(spark, "t_gate_src"), scratch_path(spark, "t_gate_manifest")
    spark.range(3).write.parquet(src)
    tables = ["N0", "N1", "N2", "N3", "DONE", "TWICE", "TWICE"]
    spark.createDataFrame([("p", "d", "parquet", t, "append", "AUDIT", "M", src, None, None) for t in tables]
                          + [("p", "d", "parquet", "LOST", "append", "NO_AUDIT", "M", src, None, None)],
                          ", ".join(f"{c} string" for c in transfer.C.MANIFEST_COLUMNS)
                          ).write.option("header", "true").option("delimiter", "|").csv(mpath)
    state = spark.createDataFrame([("p", True, True)], "process_key string, pending boolean, ready boolean")
    dest = transfer.Destination(url, opts, scratch_path(spark, "t_gate_audit"))
    loaded, failed = jobs.transfer_ready(spark, state, mpath, dest, day, dt.datetime(2024, 1, 30, 23, 30), concurrent=concurrent)
    assert loaded == ["N0", "N1", "N2", "N3", "TWICE"] and failed == ["LOST"]
    assert jdbc.read_table(spark, url, "TWICE", opts).count() == 3
    copies = spark.read.parquet(f"{dest.audit_folder}/20240130")
    assert copies.count() == 10 and copies.filter("Status = 'Finished'").count() == 5


def test_transfer_ready_records_errors(spark):
    state = spark.createDataFrame([("p~cc~bad~M", True, True)], "process_key string, pending boolean, ready boolean")
    mpath = scratch_path(spark, "t_err_manifest")
    cols = transfer.C.MANIFEST_COLUMNS
    spark.createDataFrame([("p~cc~bad~M", "d", "parquet", "OUTX", "append", "AUDIT", "M", "/nonexistent/x", None, None)],
                          ", ".join(f"{c} string" for c in cols)).write.option("header", "true").option("delimiter", "|").csv(mpath)
    db = os.path.join(tempfile.mkdtemp(prefix="opsflow-derby-"), "db")
    url, opts = f"jdbc:derby:{db};create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    jdbc.write_table(spark.createDataFrame([], "TableName string, LoadDate date, Status string, ProcessDateTime timestamp"),
                     url, "AUDIT", "overwrite",
                     options={**opts, "createTableColumnTypes": "TableName VARCHAR(128), Status VARCHAR(32)"})
    errs, logs = scratch_path(spark, "t_err_out"), scratch_path(spark, "t_err_logs")
    loaded, failed = jobs.transfer_ready(spark, state, mpath, transfer.Destination(url, opts, scratch_path(spark, "t_err_a")),
                                         dt.date(2024, 1, 30), dt.datetime(2024, 1, 30, 23, 30), log_folder=logs,
                                         error_folder=errs)
    assert loaded == [] and failed == ["OUTX"]
    err = spark.read.parquet(f"{errs}/20240130").first()
    assert err["TableName"] == "OUTX" and err["error"]
    _, summary = jobs.transfer_round(spark, state.select("process_key"), logs, None, False)
    assert summary.first()["status"] == "RUNNING"     # a failed table is still pending
