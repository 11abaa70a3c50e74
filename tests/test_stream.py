from opsflow.functions import wall_clock
import datetime as dt

from pyspark.sql import functions as F

from opsflow.plans import feed_runs
from opsflow.streaming import categorize_stream as cs


def test_two_batches_do_not_deduplicate_across_batches(spark):
    T = dt.datetime
    ev = spark.createDataFrame([
        (1, T(2024, 1, 1, 10), 7, "click", 1.0, "{}"), (2, T(2024, 1, 2, 10), 7, "click", 1.0, "{}"),
        (3, T(2024, 1, 20, 10), 7, "click", 1.0, "{}"), (4, T(2024, 1, 20, 11), 7, "click", 1.0, "{}"),
    ], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    out = feed_runs.run_file_stream_latest(spark, ev, wall_clock(T(2024, 1, 16)))
    got = sorted((r["event_id"], r["batch_id"]) for r in out.collect())
    assert got == [(2, 0), (3, 1), (4, 1)]      # same key kept again in the later batch; ties by day kept


def test_batch_processor_feed_b(spark):
    from opsflow.operators.feeds import FeedConfig
    seen = {}
    proc = cs.batch_processor(FeedConfig("B", "i", "o", "g"), lambda df, eid: seen.setdefault(eid, df.collect()))
    batch = spark.createDataFrame([("t1", "-5.0", "x", 1, "acc1"), ("t1", "-5.0", "x", 2, "acc1")],
                                  "tranId string, amount string, tranText string, msg_time int, accId string")
    proc(batch, 0)
    assert len(seen[0]) == 1 and '"catId":"956"' in seen[0][0]["value"] and seen[0][0]["key"] == "acc1"
    assert '"catStruct":{"catId":"956"' in seen[0][0]["value"]


def test_feed_a_stream_end_to_end(spark):
    import json

    from opsflow.operators.feeds import FeedConfig
    from opsflow.session import scratch_path
    from opsflow.sources import messages

    T = dt.datetime
    schema = ("tranId string, amount string, tranText string, msg_time timestamp_ntz, accId string, "
              "accIdent string, tranDt string, cost string, tranT string, tranI string, payType string")
    rows = [
        ("t1", "10", "CX/shop", T(2024, 1, 1, 9), "acc1", "acc1", "d", "10", "CX/shop/x", "T1", "others"),
        ("t1", "10", "CX/shop", T(2024, 1, 1, 10), "acc1", "acc1", "d", "10", "CX/shop/y", "T1", "others"),  # later copy
        ("t2", "-5", "MX", T(2024, 1, 1, 9), "acc2", None, "d", "-5", "MX/a/b/c", "T2", "bill"),          # incomplete
    ]
    root = scratch_path(spark, "t_feedA")
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/in")

    def masters(s):
        dm = s.createDataFrame([("T1", '{"catIdEdit": "3", "accOfDec": "9"}', "3")], "tranI string, udCat string, cat_id string")
        tree = s.createDataFrame([("3", "Food")], "catId string, catN string")
        return dm, tree

    sink = cs.partition_sink(f"{root}/out")
    proc = cs.batch_processor(FeedConfig("A", "i", "o", "g"), sink, masters, keys=["tranId", "amount", "tranText"],
                              join_key="tranI")
    q = (messages.read_file_stream(spark, f"{root}/in", schema, glob="part-*.parquet").writeStream
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).foreachBatch(proc).start())
    q.awaitTermination()
    out = {r["key"]: json.loads(r["value"]) for r in spark.read.parquet(f"{root}/out").collect()}
    assert set(out) == {"acc1", "acc2"}
    a = out["acc1"]
    assert a["tranT1"] == "CX/shop/y" and a["catN"] == "Food" and a["counP_Name_TT"] == "SHOP"
    assert a["isCat"] == 1 and a["catId"] == "3" and a["merchN"] == "" and a["usDecCatId"] == ["3"]
    assert out["acc2"]["isCat"] == 0 and out["acc2"]["catN"] is None


def test_failed_batch_replays_without_duplicates(spark):
    """A batch that fails after writing part of its output is replayed from the
    checkpoint on restart; the batch-partition sink replaces its own output."""
    from opsflow.session import scratch_path
    from opsflow.sources import messages

    root = scratch_path(spark, "t_replay")
    spark.range(0, 100).select(F.col("id"), (F.col("id") % 7).alias("k")).write.parquet(f"{root}/in")
    sink = cs.partition_sink(f"{root}/out")
    state = {"fail": True}

    def flaky(df, epoch_id):
        sink(df, epoch_id)                           # output written ...
        if state["fail"]:
            state["fail"] = False
            raise RuntimeError("executor lost")      # ... then the batch fails

    def start():
        return (messages.read_file_stream(spark, f"{root}/in", "id long, k long", glob="part-*.parquet").writeStream
                .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).foreachBatch(flaky).start())

    q = start()
    try:
        q.awaitTermination()
    except Exception:  # noqa: BLE001 - the injected failure
        pass
    q2 = start()
    q2.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    assert out.count() == 100 and out.select("batch_id").distinct().count() == 1


def test_start_feed_c_from_raw_payloads(spark):
    import json

    from opsflow.operators.feeds import FeedConfig
    from opsflow.session import scratch_path
    from opsflow.sources import messages

    T = dt.datetime
    msgs = [
        {"tranId": "t1", "tranText": "x", "accId": "a1", "amount": 12.5, "accIdent": "a1", "tranDt": "d", "cost": "1",
         "tranT": "SX/shop", "tranI": "T1", "payType": "others"},
        {"tranId": "t2", "tranText": "y", "accId": "a2", "amount": -3, "accIdent": None, "tranDt": "d", "cost": "1",
         "tranT": "AX/b", "tranI": "T2", "payType": "bill"},
    ]
    root = scratch_path(spark, "t_feedC")
    spark.createDataFrame([(T(2024, 1, 1, 10), json.dumps(m)) for m in msgs] + [(T(2024, 1, 1, 11), "{broken")],
                          "timestamp timestamp_ntz, value string").write.parquet(f"{root}/in")

    def masters(s):
        return (s.createDataFrame([], "tranI string, udCat string, cat_id string"),
                s.createDataFrame([("X", "none")], "catId string, catN string"))

    src = messages.read_file_stream(spark, f"{root}/in", "timestamp timestamp_ntz, value string", glob="part-*.parquet")
    q = cs.start_feed(spark, FeedConfig("C", "C_in", "C_out", "C_g"), "unused:9092", masters,
                      sink=cs.partition_sink(f"{root}/out"), checkpoint=f"{root}/ckpt", source=src,
                      trigger={"availableNow": True}, join_key="tranI")
    q.awaitTermination()
    out = [json.loads(r["value"]) for r in spark.read.parquet(f"{root}/out").collect()]
    by_id = {o["tranId"]: o for o in out}
    assert by_id["t1"]["counP_Name_TT"] == "SX" and by_id["t1"]["paperNum"] == "" and by_id["t1"]["amtId"] == 0
    assert by_id["t2"]["isCat"] == 0 and by_id["t2"]["amtId"] == 1     # incomplete: set aside, still sent
    assert len(out) == 3                                               # the malformed payload is kept as all-null


def test_feeds_survive_a_failed_batch(spark):
    """A batch that is written but not committed is replayed after a restart, and its output is there once."""
    from datetime import datetime as T

    from pyspark.sql import functions as F

    from opsflow.operators import feeds

    def message(i, at, account="a1"):
        return (T(2024, 1, at), f'{{"tranId": "t{i}", "tranText": "x", "accId": "{account}", "amount": {i}, "accIdent": "{account}", '
                                '"tranDt": "d", "cost": "1", "tranT": "AX/shop", "tranI": "i", "payType": "p"}')

    landed = {n: spark.createDataFrame([message(1, 1), message(1, 2), message(2, 3), message(1, 20), message(-3, 21)],
                                       feed_runs.MESSAGE_SCHEMA) for n in "AB"}
    configs = {n: feeds.FeedConfig(n, "in", "out", "g") for n in "AB"}

    def masters(s):
        return (s.createDataFrame([("a1", '{"catIdEdit": "9", "accOfDec": "1"}', "7")], "acc string, udCat string, cat_id string"),
                s.createDataFrame([("7", "Food")], "catId string, catN string"))

    out = feed_runs.run_feeds_with_restart(spark, landed, wall_clock(T(2024, 1, 16)), configs, masters, join_key="accIdent", decision_key="acc")
    got = sorted((r.feed, r.batch_id, r.key, r.t, r.c) for r in out.select(
        "feed", "batch_id", "key", F.get_json_object("value", "$.tranId").alias("t"), F.get_json_object("value", "$.catN").alias("c")).collect())
    assert got == [("A", 0, "a1", "t1", "Food"), ("A", 0, "a1", "t2", "Food"), ("A", 1, "a1", "t-3", "Food"), ("A", 1, "a1", "t1", "Food"),
                   ("B", 0, "a1", "t1", "OI"), ("B", 0, "a1", "t2", "OI"), ("B", 1, "a1", "t-3", "OP (T)"), ("B", 1, "a1", "t1", "OI")]
