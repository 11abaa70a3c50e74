"""Property tests on random inputs (few examples: each one runs Spark jobs)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from opsflow.operators import categorize as cat
from opsflow.operators import latest, runs, status
from opsflow.session import scratch_path

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.one_of(st.none(), st.sampled_from(["a", " a", "b", "c "]))
orders = st.one_of(st.none(), st.integers(0, 4))


@SETTINGS
@given(st.lists(st.tuples(keys, keys, orders), min_size=0, max_size=40))
def test_latest_equals_rank_window(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, k1 string, k2 string, t int")
    got = sorted(r[0] for r in latest.latest_messages(df, ["k1", "k2"], "t").select("id").collect())
    w = Window.partitionBy(F.trim("k1"), F.trim("k2")).orderBy(F.desc("t"))
    want = sorted(r[0] for r in df.withColumn("r", F.rank().over(w)).filter("r = 1").select("id").collect())
    assert got == want


@SETTINGS
@given(st.lists(st.sampled_from("abcde"), max_size=30), st.lists(st.sampled_from("abcdxy"), max_size=30))
def test_pending_properties(spark, wanted, completed):
    w = spark.createDataFrame([(x,) for x in wanted], "k string")
    c = spark.createDataFrame([(x,) for x in completed], "k string")
    pend = {r[0] for r in runs.pending(w, c, "k").collect()}
    assert pend | set(completed) >= set(wanted)            # pending and completed cover wanted
    assert not pend & set(completed)
    got = sorted(r[0] for r in runs.pending_all(w, c, "k", chunk=2).collect())
    assert got == sorted(r[0] for r in w.exceptAll(c).collect())


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("gh"), st.one_of(st.none(), st.sampled_from(["1", "2", "9", "10", "95"]))),
                min_size=1, max_size=25))
def test_decision_list_is_longest_running_list(spark, rows):
    df = spark.createDataFrame([(g, str(i), a, i) for i, (g, a) in enumerate(rows)],
                               "g string, udId string, udAcc string, t int")
    w = Window.partitionBy("g").orderBy(F.desc("udAcc"))
    brute = {r["g"]: sorted(r["l"]) for r in
             df.withColumn("l", F.collect_list("udId").over(w)).groupBy("g").agg(F.max("l").alias("l")).collect()}
    got = {r["g"]: sorted(r["usDecCatId"]) for r in cat.decision_list(df, ["g"], tie_col="t").collect()}
    assert got == brute


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3"]), st.sampled_from(["OK", "DLT", "SRC"])), min_size=1,
                max_size=10, unique_by=lambda r: r[0]))
def test_rollover_twice_equals_once(spark, rows):
    import datetime as dt
    day = spark.createDataFrame([(u, dt.date(2024, 1, 30), c) for u, c in rows],
                                "usecase string, report_date date, category string")
    once, twice = scratch_path(spark, "p_once"), scratch_path(spark, "p_twice")
    status.rollover(day, once)
    status.rollover(day, twice)
    status.rollover(day, twice)
    assert sorted(spark.read.parquet(once).collect()) == sorted(spark.read.parquet(twice).collect())
