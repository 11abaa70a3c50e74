from pyspark.sql import Window
from pyspark.sql import functions as F

from opsflow.functions.ranking import number_rows
from opsflow.operators import runs
from opsflow.session import scratch_path
from opsflow.sources import files
from conftest import rows


def test_parse_process_key(spark):
    df = spark.createDataFrame([("p~cc~table1~M",), ("p~cc~table2",), (None,)], "k string")
    assert rows(df.select(*runs.parse_process_key("k"))) == [
        ("p", "cc", "table1", "M"), ("p", "cc", "table2", None), (None, None, None, None)]


def test_readiness_prefix_semantics(spark):
    wanted = spark.createDataFrame([("p", "cc", "table1", "t"), ("p", "cc", "table2", "t"), ("p", "cc", "table3", "M"),
                                    ("p", "cc", "table4", None), ("q", "cc", "table1", "T"),
                                    ("q", "cc", "table5", "T")],
                                   "src string, db string, tbl string, indicator string")
    markers = spark.createDataFrame([("success-p-cc-table10-20240101",), ("success-q-cc-table1",), ("other",)],
                                    "marker string")
    out = rows(runs.readiness(wanted, markers), "src", "tbl", "ready")
    assert out == [("p", "table1", True), ("p", "table2", False), ("p", "table3", True), ("p", "table4", True),
                   ("q", "table1", True), ("q", "table5", True)]      # only lower-case t waits for a marker


def test_readiness_combines_names_before_cutting_them(spark):
    wanted = spark.createDataFrame([("p", "cc", f"table{i}", "t") for i in (1, 2, 33, 444)], "src string, db string, tbl string, indicator string")
    markers = spark.range(20_000).selectExpr("concat('success-p-cc-table1', id % 3, '-', 20240000 + id) as marker").unionAll(
        spark.sql("select cast(null as string) union all select 'success-p-cc-table33'"))
    out = runs.readiness(wanted, markers)
    assert rows(out, "tbl", "ready") == [("table1", True), ("table2", False), ("table33", True), ("table444", False)]
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in plan]
    cut = next(i for i, x in enumerate(plan) if "Generate explode" in x)
    end = next((i for i in range(cut + 1, len(plan)) if depth[i] <= depth[cut]), len(plan))
    below = plan[cut + 1:end]
    assert any("Aggregate" in x for x in below), "names are distinct before they are cut to every length"


def test_list_markers_reads_names_only(spark):
    folder = scratch_path(spark, "t_markers")
    spark.createDataFrame([("x",)], "v string").write.text(folder)
    names = [r[0] for r in files.list_markers(spark, folder, "part-*").collect()]
    assert names and all(n.startswith("part-") for n in names)


def test_pending_and_pending_all(spark):
    wanted = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "k string")
    done = spark.createDataFrame([("a",), ("c",), ("z",)], "k string")
    assert rows(runs.pending(wanted, done, "k")) == [("b",)]
    assert rows(runs.pending_all(wanted, done, "k")) == [("a",), ("b",)]   # one repeat survives


def test_numbered_matches_row_number(spark):
    df = spark.range(0, 5000).select(F.col("id"), ((F.col("id") * 7919) % 5003).alias("o"))
    got = number_rows(df.repartition(7), [F.col("o"), F.col("id")], "pos")
    want = df.withColumn("pos", F.row_number().over(Window.orderBy("o", "id")))
    assert sorted(got.collect()) == sorted(want.collect())
    lines = runs.numbered(spark.createDataFrame([("b",), ("a",)], "n string"), [F.col("n")], "n")
    assert rows(lines, "line") == [("1. a",), ("2. b",)]


def test_run_status_rules(spark):
    st = spark.createDataFrame([("g1", False, True), ("g2", True, False), ("g3", True, True), ("g3", True, False)],
                               "g string, pending boolean, ready boolean")
    out = {r["g"]: r for r in runs.run_status(st, ["g"], F.lit(False)).collect()}
    assert out["g1"]["status"] == "SUCCESS" and out["g1"]["transfer_pending"] == 0
    assert out["g2"]["status"] == "PENDING" and out["g2"]["ingestion_pending"] == 1
    assert out["g3"]["status"] == "RUNNING" and out["g3"]["ingestion_completed"] == 1
    late = {r["g"]: r["status"] for r in runs.run_status(st, ["g"], F.lit(True)).collect()}
    assert late == {"g1": "SUCCESS", "g2": "FAILED", "g3": "FAILED"}


def test_latest_attempt(spark):
    df = spark.createDataFrame([("j", 1, "a"), ("j", 3, "b"), ("k", 2, "c")], "job string, start int, app string")
    assert rows(runs.latest_attempt(df, "job", "start", ["app"])) == [("j", 3, "b"), ("k", 2, "c")]


def test_logs_parse_and_completed(spark):
    folder = scratch_path(spark, "t_logs")
    lines = spark.createDataFrame([
        ("p1", "7~#~BB~#~~#~~#~t1~#~Data Transfer~#~STARTED~#~~#~Transfer Started~#~2024-01-01 10:00:00~#~2024-01-01"),
        ("p1", "DATA TRANSFER SUCCESSFUL :t1"),
        ("p2", "noise"),
    ], "process string, value string")
    lines.write.partitionBy("process").text(folder)
    logs = files.read_logs(spark, folder)
    parsed = runs.parse_log_lines(logs)
    r = parsed.first()
    assert (r["log_id"], r["table_name"], r["status"], r["log_date"]) == ("7", "t1", "STARTED", "2024-01-01")
    assert r["export_line"].startswith("7~BB~~~t1~")
    proc = F.regexp_extract("file_path", "process=([^/]+)", 1)
    assert rows(runs.completed_processes(logs, proc)) == [("p1",)]


def test_pending_all_chunked_hot_key_equals_except_all(spark):
    wanted = spark.range(0, 3000).select((F.when(F.col("id") < 1000, F.lit(0)).otherwise(F.col("id") % 50)).alias("k"))
    done = spark.range(0, 700).select((F.col("id") % 60).alias("k"))
    want = sorted(wanted.exceptAll(done).collect())
    got = sorted(runs.pending_all(wanted, done, "k", chunk=7).collect())
    assert got == want


def test_number_within_groups_null_keys_and_empty(spark):
    from opsflow.functions.ranking import number_within_groups
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2), ("a", 5), ("b", 1)], "g string, v int")
    got = sorted((r["g"] or "", r["v"], r["p"]) for r in number_within_groups(df.repartition(3), ["g"], [F.col("v")], "p").collect())
    assert got == [("", 1, 1), ("", 3, 2), ("a", 2, 1), ("a", 5, 2), ("b", 1, 1)]
    empty = spark.createDataFrame([], "g string, v int")
    assert number_within_groups(empty, ["g"], [F.col("v")]).count() == 0
    assert number_rows(empty, [F.col("v")]).count() == 0


def test_running_sum_within_groups_hot_group(spark):
    from pyspark.sql import Window as W

    from opsflow.functions.ranking import running_sum_within_groups
    df = spark.range(0, 4000).select(
        F.when(F.col("id") % 4 == 0, F.lit(None)).when(F.col("id") < 3000, F.lit("hot"))
        .otherwise((F.col("id") % 5).cast("string")).alias("g"),
        F.col("id").alias("o"), (F.col("id") % 7).alias("v"))
    got = running_sum_within_groups(df.repartition(6), ["g"], [F.col("o").desc()], "v", "run")
    w = W.partitionBy("g").orderBy(F.desc("o")).rowsBetween(W.unboundedPreceding, W.currentRow)
    want = df.withColumn("run", F.sum("v").over(w))
    def key(t):
        return (t[0] is None, t[0] or "", t[1])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
