from pyspark.sql import Window
from pyspark.sql import functions as F

from opsflow.operators.latest import latest_messages

SCHEMA = "id int, tranId string, amount string, tranText string, t int"


def test_ties_nulls_and_blanks(spark):
    data = [
        (1, "a", "10", "x", 1), (2, "a", "10", "x", 2), (3, "a", "10", "x", 2),   # tie at the max: both kept
        (4, None, "5", "y", 1), (5, None, "5", "y", 3),                             # null key = one group
        (6, " b ", "1", "z", 7), (7, "b", "1", "z", 5),                             # outer blanks trimmed
        (8, "c", "1", "z", None), (9, "c", "1", "z", None),                         # all-null order: all kept
        (10, "d", "1", "z", None), (11, "d", "1", "z", 4),                          # null order loses
    ]
    df = spark.createDataFrame(data, SCHEMA)
    out = latest_messages(df, ["tranId", "amount", "tranText"], "t")
    assert {r[0] for r in out.select("id").collect()} == {2, 3, 5, 6, 8, 9, 11}
    assert set(r[0] for r in out.select("msg_number").collect()) == {1}


def test_equals_rank_window(spark):
    df = spark.range(0, 2000).select(
        (F.col("id") % 37).cast("string").alias("tranId"), (F.col("id") % 3).cast("string").alias("amount"),
        F.lit("t").alias("tranText"), (F.col("id") % 11).alias("t"), F.col("id"))
    w = Window.partitionBy(F.trim("tranId"), F.trim("amount"), F.trim("tranText")).orderBy(F.desc("t"))
    brute = df.withColumn("r", F.rank().over(w)).filter("r = 1").select("id")
    got = latest_messages(df, ["tranId", "amount", "tranText"], "t").select("id")
    assert sorted(brute.collect()) == sorted(got.collect())
