from pyspark.sql import functions as F

from opsflow.operators import feeds
from opsflow import config as C
from conftest import rows


def test_parse_malformed_and_partial_json(spark):
    df = spark.createDataFrame([("t1", '{"a": 1, "b": "x"}'), ("t2", "{not json"), ("t3", '{"a": 2, "zz": 9}')],
                               "msg_time string, val_str string")
    out = feeds.parse_messages(df, "a int, b string")
    assert out.columns == ["msg_time", "a", "b"]
    assert rows(out) == [("t1", 1, "x"), ("t2", None, None), ("t3", 2, None)]


def test_raw_messages_casts_payload(spark):
    df = spark.createDataFrame([(bytearray(b'{"a":1}'), "2024-01-01")], "value binary, timestamp string")
    assert feeds.raw_messages(df).first()["val_str"] == '{"a":1}'


def test_pad_columns_feed_c_and_a(spark):
    df = spark.createDataFrame([(-5.0,), (3.0,), (None,)], "amount double")
    c = feeds.pad_columns(df, "C")
    a = feeds.pad_columns(df, "A")
    assert set(C.FEED_C_MISSING) <= set(c.columns)
    assert not set(C.FEED_C_MISSING) & set(a.columns)
    assert rows(c, "amount", "amtId") == [(-5.0, 1), (3.0, 0), (None, 0)]
    assert all(v == "" for v in c.select(*C.BATCH_PAD).first())


def test_rename_output(spark):
    df = spark.createDataFrame([("1", "n", 1)], "cat_id string, cat_N string, Var int")
    out = feeds.rename_output(df)
    assert out.columns == ["catId", "catN", "isCat", "merchN"]


def test_default_category(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (None,)], "amount double")
    out = feeds.default_category(df, keep_struct=False)
    assert "catStruct" in feeds.default_category(df).columns
    assert rows(out, "amount", "catId", "catN", "catType", "isCat") == [
        (-1.0, "956", "OP (T)", "Exp", " "), (0.0, "953", "OI", "Exp", " "), (None, "953", "OI", "Exp", " ")]
    assert "catStruct" not in out.columns


def test_route(spark):
    cfg = {n: feeds.FeedConfig(n, f"{n}_in", f"{n}_out", f"{n}_g") for n in "ABC"}
    df = spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "f string")
    out = feeds.route(df, F.col("f"), cfg)
    assert rows(out, "f", "output_topic", "branch") == [
        ("A", "A_out", "categorize"), ("B", "B_out", "default"), ("C", "C_out", "categorize"), (None, None, None)]


def test_feed_schemas_parse_and_pad(spark):
    from opsflow.operators.feeds import FeedConfig
    msg = ('{"tranId": "t1", "tranText": "x", "accId": "a1", "amount": -12.5, "accIdent": "a1", "tranDt": "d", '
           '"cost": "1", "tranT": "CX/y", "tranI": "i1", "payType": "others"}')
    raw = spark.createDataFrame([("2024-01-01 10:00:00", msg)], "msg_time string, val_str string")
    for name in "ABC":
        fc = FeedConfig(name, "i", "o", "g")
        out = feeds.pad_columns(feeds.parse_messages(raw, fc.message_schema), name)
        r = out.first()
        assert r["amtId"] == 1 and r["tranT"] == "CX/y" and str(r["amount"]) == "-12.50"
        assert set(C.FEED_C_MISSING) <= set(out.columns)
