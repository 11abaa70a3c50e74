"""Plan-shape checks: the physical plans keep the properties the design relies on."""

import datetime as dt

from pyspark.sql import functions as F

from opsflow.functions.ranking import number_rows
from opsflow.operators import latest, transfer
from opsflow.sources import files
from opsflow.session import scratch_path

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_message_uses_no_window(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    p = plan(latest.latest_messages(ev, ["user_id", "event_type"], F.to_date("ts")))
    assert "Window" not in p and "LeftSemi" in p
    assert "partial_max" in p                     # combined map-side


def test_projection_and_filter_reach_the_scan(spark):
    orders = files.read_by_format(spark, "parquet", f"{SF}/orders.parquet")
    p = plan(transfer.project(spark, orders, "o_orderkey", "o_orderstatus = 'F'"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in p


def test_dated_read_prunes_partitions(spark):
    path = scratch_path(spark, "t_plan_dated")
    spark.createDataFrame([(1, 2024, 1, 15)], "id int, year int, month int, day int") \
        .write.partitionBy("year", "month", "day").parquet(path)
    p = plan(files.read_dated(spark, "parquet", path, "d", dt.date(2024, 1, 15)))
    assert "year=2024/mont" in p and "PartitionFilters: []" in p      # the day's folder alone is listed


def test_numbering_keeps_data_out_of_a_single_partition(spark):
    df = spark.range(0, 1000).repartition(4)
    out = number_rows(df, [F.col("id")], "pos")
    p = plan(out)
    # the only single-partition step is the window over the per-partition counts,
    # which sits below the broadcast of the offsets
    head, _, offsets = p.partition("BroadcastExchange")
    assert "SinglePartition" not in head and "Window" in offsets
    assert out.count() == 1000 and out.agg(F.max("pos")).first()[0] == 1000
