from opsflow.functions import wall_clock
import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from opsflow.operators import transfer
from opsflow.sources import files, jdbc
from opsflow.session import scratch_path
from conftest import rows


def _manifest(spark):
    path = scratch_path(spark, "t_manifest")
    data = [("P~CC~T1", "df1", "parquet", "t1", "append", "AUDIT", "M", "/base/a", "id, v", "v > 1"),
            ("p~cc~t1", "df2", "csv", "t2", "overwrite", "AUDIT", None, "/base/b", None, None),
            ("p~cc~t1", "df3", "csv", "t3", "append", "AUDIT", "d", "/base/c", None, None),
            ("other", "df4", "csv", "t4", "append", "AUDIT", "M", "/base/d", None, None)]
    spark.createDataFrame(data, ", ".join(f"{c} string" for c in transfer.C.MANIFEST_COLUMNS)) \
        .write.option("header", "true").option("delimiter", "|").csv(path)
    return files.read_manifest(spark, path)


def test_manifest_lookup_and_location(spark):
    m = transfer.select_process(_manifest(spark), "p~CC~t1")
    out = rows(m.select("DEST_TABLE_NAME", "M_INDICATOR", "COLUMN_LIST",
                        transfer.resolved_location(F.lit(dt.date(2024, 3, 5))).alias("loc")))
    assert out == [("t1", "M", "id, v", "/base/a"), ("t2", None, None, "/base/b"),
                   ("t3", "d", None, "/base/c/year=2024/month=03/day=05/")]


def test_run_date_for():
    assert transfer.run_date_for("on~cc~30", dt.date(2024, 3, 1), ("ON~CC~30",)) == dt.date(2024, 2, 29)
    assert transfer.run_date_for("x", dt.date(2024, 3, 1), ("ON~CC~30",)) == dt.date(2024, 3, 1)
    assert transfer.run_date_for("On~cc~30", dt.date(2024, 1, 1)) == dt.date(2023, 12, 31)     # default list


def test_project_null_columns_and_filter(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 5.0)], "id int, v double")
    assert rows(transfer.project(spark, df, "id", "v > 2")) == [(2,)]
    assert rows(transfer.project(spark, df, None, None)) == [(1, 1.0), (2, 5.0)]
    assert rows(transfer.project(spark, df, "id, v * 2 AS w", None)) == [(1, 2.0), (2, 10.0)]


def test_load_gate(spark):
    man = spark.createDataFrame([("a",), ("b",), ("c",)], "DEST_TABLE_NAME string")
    today, yday = dt.date(2024, 1, 2), dt.date(2024, 1, 1)
    audit = spark.createDataFrame([("a", today, "Finished"), ("b", yday, "Finished"), ("c", today, "Started")],
                                  "TableName string, LoadDate date, Status string")
    assert rows(transfer.load_gate(man, audit, F.lit(today))) == [("b",), ("c",)]
    assert transfer.finished_count(audit, "a", F.lit(today)).first()["count"] == 1


def test_dated_scan_prunes_to_one_day(spark):
    path = scratch_path(spark, "t_dated")
    df = spark.createDataFrame([(1, "2024", "01", "15"), (2, "2024", "01", "16"), (3, "2023", "01", "15")],
                               "id int, year string, month string, day string")
    df.write.partitionBy("year", "month", "day").parquet(path)
    got = files.read_dated(spark, "parquet", path, "d", dt.date(2024, 1, 15))
    assert got.columns == ["id"] and rows(got) == [(1,)]
    assert files.read_dated(spark, "parquet", path, "M", dt.date(2024, 1, 15)).count() == 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_transfer_table_with_derby(spark):
    db = os.path.join(tempfile.mkdtemp(prefix="opsflow-derby-"), "db")
    url = f"jdbc:derby:{db};create=true"
    opts = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    empty = spark.createDataFrame([], "TableName string, LoadDate date, Status string, ProcessDateTime timestamp")
    jdbc.write_table(empty, url, "AUDIT", "overwrite",
                     options={**opts, "createTableColumnTypes": "TableName VARCHAR(128), Status VARCHAR(32)"})
    src = scratch_path(spark, "t_src")
    spark.createDataFrame([(1, 1.0), (2, 5.0), (3, 9.0)], "id int, v double").write.parquet(src)
    r = type("ManifestRow", (), {})()
    r.DEST_AUDIT_TABLENAME, r.DEST_TABLE_NAME, r.SOURCE_TYPE = "AUDIT", "T_OUT", "parquet"
    r.STORAGE_LOCATION, r.M_INDICATOR, r.COLUMN_LIST, r.WHERE_CLAUSE, r.DEST_WRITE_MODE = src, "M", "id, v", "v > 2", "overwrite"
    dest = transfer.Destination(url, opts, scratch_path(spark, "t_audit"), batchsize=100)
    today = dt.date(2024, 1, 2)
    assert transfer.transfer_table(spark, r, dest, "p~cc~t_out~M", today, dt.datetime(2024, 1, 2, 23, 30))
    assert rows(jdbc.read_table(spark, url, "T_OUT", opts)) == [(2, 5.0), (3, 9.0)]
    audit = jdbc.read_table(spark, url, "AUDIT", opts)
    assert sorted(r2["STATUS"] if "STATUS" in r2.asDict() else r2["Status"] for r2 in audit.collect()) == ["Finished", "Started"]
    # second run on the same day is gated
    assert not transfer.transfer_table(spark, r, dest, "p~cc~t_out~M", today, dt.datetime(2024, 1, 2, 23, 31))
    assert spark.read.parquet(f"{dest.audit_folder}/20240102").count() == 2


def test_audit_and_error_rows(spark):
    t = spark.createDataFrame([("tbl", "p")], "TableName string, p string")
    a = transfer.audit_rows(t, "Started", F.lit(dt.date(2024, 1, 1)), wall_clock(dt.datetime(2024, 1, 1, 1)),
                            process_col="p")
    assert a.columns == ["TableName", "process_name", "LoadDate", "Status", "ProcessDateTime"]
    e = spark.createDataFrame([("t", "it's \"bad\"")], "t string, m string").withColumn("ts", F.current_timestamp())
    assert transfer.error_rows(e, "t", "ts", "m").first()["error"] == "it's \"bad\""
