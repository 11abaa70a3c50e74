"""A key holding a third of the rows: results stay exact and AQE splits the hot
partition of the shuffled joins (broadcast disabled to force the large-input plan)."""

import contextlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from opsflow.operators import latest, runs


@contextlib.contextmanager
def large_input_plan(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def skewed(spark, n=30000):
    # a third of the rows share tranId "hot"; the hot key has many distinct times and a tie at the max
    return spark.range(0, n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("tranId"),
        F.lit("1").alias("amount"), F.lit("t").alias("tranText"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 5000).otherwise(F.col("id") % 13).alias("t"),
    )


def test_latest_message_hot_key(spark):
    with large_input_plan(spark):
        df = skewed(spark)
        out = latest.latest_messages(df, ["tranId", "amount", "tranText"], "t")
        got = sorted(r[0] for r in out.select("id").collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    w = Window.partitionBy("tranId", "amount", "tranText").orderBy(F.desc("t"))
    want = sorted(r[0] for r in df.withColumn("r", F.rank().over(w)).filter("r = 1").select("id").collect())
    assert got == want
    assert "SortMergeJoin" in plan and "LeftSemi" in plan and "Window" not in plan


def test_pending_all_hot_key(spark):
    with large_input_plan(spark):
        df = skewed(spark).select(F.col("tranId").alias("k"))
        done = skewed(spark, 9000).select(F.col("tranId").alias("k"))
        got = sorted(runs.pending_all(df, done, "k", chunk=500).collect())
    assert got == sorted(df.exceptAll(done).collect())


def test_semi_join_skew_split(spark):
    """With ties spread over few values, the hot key still lands in one join
    partition; AQE marks the sort-merge join as skewed and splits it."""
    with large_input_plan(spark):
        df = spark.range(0, 40000).select(
            F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 7).alias("t"))
        out = latest.latest_messages(df, ["k"], "t")
        n = out.count()
        out.collect()
        final = out._jdf.queryExecution().executedPlan().toString()
    assert n == df.filter("t = 7 OR (k <> 'hot' AND t = 6)").count()
    assert "skew=true" in final


def test_categorize_hot_account(spark):
    from opsflow.operators import categorize as cat
    n = 30000
    batch = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("accIdent"),
        F.lit("d").alias("tranDt"), F.lit("1").alias("cost"),
        F.concat(F.lit("CX/"), (F.col("id") % 11).cast("string")).alias("tranT"),
        F.col("id").cast("string").alias("tranI"), F.lit("others").alias("payType"))
    dm = spark.range(0, 3000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("accIdent"),
        F.concat(F.lit('{"catIdEdit": "'), (F.col("id") % 9).cast("string"), F.lit('", "accOfDec": "'),
                 (F.col("id") % 97).cast("string"), F.lit('"}')).alias("udCat"),
        F.lit("2").alias("cat_id"), F.col("id").alias("t"))
    tree = spark.createDataFrame([("2", "Food")], "catId string, catN string")

    def run():
        out = cat.categorize(batch, dm, tree, join_key="accIdent", tie_col="t")
        return out, sorted((r["tranI"], tuple(r["usDecCatId"] or []), r["catN"]) for r in out.collect())

    _, want = run()
    with large_input_plan(spark):
        out, got = run()
        final = out._jdf.queryExecution().executedPlan().toString()
    assert got == want and len(got) == n
    assert "skew=true" in final
