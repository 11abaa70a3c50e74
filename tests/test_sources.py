from opsflow.operators import runs, status
from opsflow.session import scratch_path
from opsflow.sources import files, messages, sinks
from conftest import rows


def test_positional_csv_short_rows(spark):
    path = scratch_path(spark, "t_pos")
    spark.createDataFrame([("a,1,DLY,x,y,z,w,OK",), ("b,2",)], "value string").write.text(path)
    out = files.read_positional_csv(spark, path, {"usecase": 1, "SLA": 2, "category": 8, "missing": 12})
    assert rows(out) == [("a", "1", "OK", None), ("b", "2", None, None)]


def test_wide_history_round_trip(spark):
    path = scratch_path(spark, "t_wide")
    spark.createDataFrame([("UC1", "10", "DLY", "50", "75", "OK", None), ("UC2", "11", "DLY", None, None, None, "DLT")],
                          "usecase string, SLA string, FREQ string, MTD string, `MTD-DL` string, "
                          "`20240130` string, `20240129` string").write.option("header", "true").csv(path)
    wide = files.read_wide_history(spark, path)
    long = status.history_unpivot(wide, ["usecase"], wide.columns[5:])
    assert rows(long, "usecase", "report_date", "category") == [
        ("UC1", __import__("datetime").date(2024, 1, 30), "OK"), ("UC2", __import__("datetime").date(2024, 1, 29), "DLT")]


def test_log_export(spark):
    parsed = runs.parse_log_lines(spark.createDataFrame([("1~#~BB~#~x",), ("plain",)], "line string"))
    folder = scratch_path(spark, "t_export")
    sinks.export_log_lines(parsed, folder, "20240130")
    sinks.export_log_lines(parsed, folder, "20240130")
    assert [r[0] for r in spark.read.text(f"{folder}/run_date=20240130").collect()] == ["1~BB~x", "1~BB~x"]


def test_report_csv_and_snapshot(spark):
    df = spark.createDataFrame([("j-1", 3)], "ClusterId string, hours int")
    folder = scratch_path(spark, "t_report")
    path = sinks.write_report_csv(df, folder, "01-30-2024_23-59-59")
    assert spark.read.option("header", "true").csv(path).first()["ClusterId"] == "j-1"
    snap = scratch_path(spark, "t_snap")
    sinks.snapshot(df, snap, "20240130_235959")
    sinks.snapshot(df, snap, "20240131_000001")
    assert spark.read.parquet(snap).select("snapshot_ts").distinct().count() == 2


def test_kafka_options():
    o = messages.kafka_source_options("h:9092", "topicA", "g1")
    assert o == {"kafka.bootstrap.servers": "h:9092", "subscribe": "topicA", "startingOffsets": "latest",
                 "kafka.group.id": "g1", "failOnDataLoss": "false"}


def test_cluster_settings_sizes_partitions():
    from opsflow.session import cluster_settings
    s = cluster_settings(100 * (1 << 40), total_cores=3000)           # 100 TB on 3000 cores
    assert int(s["spark.sql.shuffle.partitions"]) == 409600           # 256 MB each
    small = cluster_settings(1 << 30, total_cores=3000)
    assert int(small["spark.sql.shuffle.partitions"]) == 9000         # three waves of cores
