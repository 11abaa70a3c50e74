from pyspark.sql import Window
from pyspark.sql import functions as F

from opsflow.operators import categorize as cat
from conftest import rows


def test_completeness_and_split(spark):
    df = spark.createDataFrame([(1, "a", "d", "c", "t", "i"), (2, None, "d", "c", "t", "i"), (3, "a", "d", "c", "t", None)],
                               "k int, accIdent string, tranDt string, cost string, tranT string, tranI string")
    flagged = cat.completeness(df)
    assert rows(flagged, "k", "Var") == [(1, 1), (2, 0), (3, 0)]
    valid, invalid = cat.split_valid(flagged)
    assert valid.count() == 1 and invalid.count() == 2


def test_normalize_and_tokens(spark):
    df = spark.createDataFrame([("one",), ("a/b~c/d~e/f",), ("x \t y//z",), ("p~Q  \t r",)], "tranT string")
    out = cat.tokens(cat.normalize(df))
    got = rows(out, "tranT1", "tranT", "TT_0", "TT_1", "TT_2", "TT_3", "TT_4")
    assert ("one", "ONE", "ONE", None, None, None, None) in got
    assert ("a/b~c/d~e/f", "A/B~C/D~E/F", "A", "B", "C", "D", "E") in got   # six tokens: the sixth is dropped
    assert ("x \t y//z", "X Y//Z", "X Y", "", "Z", None, None) in got
    assert ("p~Q  \t r", "P~Q R", "P", "Q R", None, None, None) in got


def test_counterparty_rules(spark):
    data = [  # (text, payType, expected)
        ("UX/a/b/c", None, ""), ("AX/a1/b/c", None, "A1"), ("MX/a/b/c3", None, "C3"), ("EX/a/b2/c", None, "B2"),
        ("CX/c1/b/c", None, "C1"), ("BX/b1/b/c", None, "B1"), ("NX/a/n2/c", None, "N2"), ("IX/a/b/i3", None, "I3"),
        ("ZX/a/b/c", "Remit-out", ""), ("ZX/AP/b/z3", "Bill", "Z3"), ("ZX/AQ/b/z3", "Bill", ""),
        ("SX/a/b/c", "others", "SX"), ("ZX/a/b/c", "others", ""), ("ZX/a/b/c", None, ""),
        ("AX/a1/b/c", "others", "A1"),   # matches two rules: the first wins
    ]
    df = spark.createDataFrame(data, "tranT string, payType string, want string")
    out = cat.add_counterparty(cat.tokens(cat.normalize(df)))
    for r in out.collect():
        assert r["counP_Name_TT"] == r["want"], (r["tranT"], r["payType"])


def test_decision_guard(spark):
    data = [("1", "2"), ("2", "3"), ("2", "9"), ("9", "2"), ("9", "9"), ("119", "9"), ("2", None), (None, "2"),
            ("119", None)]
    df = spark.createDataFrame(data, "udId string, cat_id string")
    out = df.withColumn("g", cat.guard_decision())
    got = {(r["udId"], r["cat_id"]): r["g"] for r in out.collect()}
    assert got[("1", "2")] is None          # in others
    assert got[("2", "3")] == "2"           # both in the list
    assert got[("2", "9")] is None          # membership differs
    assert got[("9", "2")] is None
    assert got[("9", "9")] == "9"
    assert got[("119", "9")] is None
    assert got[("2", None)] == "2"          # null side keeps the id
    assert got[(None, "2")] is None
    assert got[("119", None)] is None       # unless in others


def test_prepare_decision_map(spark):
    df = spark.createDataFrame([("12", '{"catIdEdit": "5", "accOfDec": "95"}'), ("x1", "{bad")], "m_c string, udCat string")
    out = cat.prepare_decision_map(df)
    assert rows(out, "m_c", "udId", "udAcc", "Dec_Wt") == [(12, "5", "95", 1.5), (None, None, None, 1.5)]


def test_decision_list_text_order_ties_and_nulls(spark):
    data = [("g1", "a", "9", 2), ("g1", "b", "10", 1), ("g1", "c", "95", 3), ("g1", "d", "9", 1), ("g1", None, "99", 0),
            ("g1", "e", None, 0), ("g2", None, "1", 0), ("g3", "x", "5", 0)]
    df = spark.createDataFrame(data, "g string, udId string, udAcc string, t int")
    out = {r["g"]: r["usDecCatId"] for r in cat.decision_list(df, ["g"], tie_col="t").collect()}
    assert out["g1"] == ["c", "d", "a", "b", "e"]   # "95" > "9" (ties by t) > "10", null accuracy last
    assert out["g2"] == []
    assert out["g3"] == ["x"]
    num = {r["g"]: r["usDecCatId"] for r in cat.decision_list(df, ["g"], tie_col="t", numeric=True).collect()}
    assert num["g1"] == ["c", "b", "d", "a", "e"]   # 95 > 10 > 9


def test_decision_list_equals_running_window(spark):
    df = spark.range(0, 600).select((F.col("id") % 7).alias("g"), F.col("id").cast("string").alias("udId"),
                                    (F.col("id") % 13).cast("string").alias("udAcc"), F.col("id").alias("t"))
    w = Window.partitionBy("g").orderBy(F.desc("udAcc"))
    brute = df.withColumn("l", F.collect_list("udId").over(w)).groupBy("g").agg(F.max(F.size("l")).alias("n"))
    got = cat.decision_list(df, ["g"], tie_col="t").select("g", F.size("usDecCatId").alias("n"))
    assert sorted(brute.collect()) == sorted(got.collect())
    run = cat.running_decision_count(df, ["g"])
    brute_run = df.withColumn("running_len", F.count("udId").over(w))
    assert sorted(run.collect()) == sorted(brute_run.collect())


def test_candidate_set_null_and_empty_arrays(spark):
    df = spark.createDataFrame(
        [("1-2-2", ["2", "3"], None, None, ["7"]), (None, None, [], ["4"], None)],
        "cat_id string, usDecCatId array<string>, decCatId array<string>, nextBestCat array<string>, "
        "nextBest_catId array<string>")
    out = cat.candidate_set(df).collect()
    assert sorted(out[0]["usDecCatId"]) == ["1", "2", "3"]
    assert sorted(out[0]["setNext"]) == ["1", "2", "3", "7"]
    assert out[1]["usDecCatId"] == []
    assert out[1]["setNext"] == ["4"]


def test_explode_scores(spark):
    df = spark.createDataFrame([(1, ['{"catId": "5", "score": "0.9"}', '{"catId": "6"}']), (2, []), (3, None),
                                (4, ["oops"])], "id int, dec_cat array<string>")
    out = rows(cat.explode_scores(df), "id", "cat_id", "cat_wt")
    assert out == [(1, "5", "0.9"), (1, "6", None), (2, None, None), (3, None, None), (4, None, None)]


def test_score_json(spark):
    df = spark.createDataFrame([("5", "0.9")], "a string, b string")
    assert df.select(cat.score_json("a", "b")).first()[0] == '{"catId":"5","score":"0.9"}'


def test_tree_enrich_and_union(spark):
    txn = spark.createDataFrame([(1, "10"), (2, "99")], "k int, catId string")
    tree = spark.createDataFrame([("10", "Food")], "catId string, catN string")
    bad = spark.createDataFrame([(3, 0)], "k int, Var int")
    out = cat.union_invalid(cat.enrich_with_tree(txn, tree), bad)
    assert rows(out, "k", "catId", "catN", "Var") == [(1, "10", "Food", None), (2, "99", None, None),
                                                      (3, None, None, 0)]


def test_join_valid_gives_the_rows_of_the_union(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "a", 0), (4, None, 0), (5, None, 1), (3, "a", 0)],
                               "k int, acc string, Var int")
    side = spark.createDataFrame([("a", "10"), ("a", "11"), (None, "12")], "acc string, catId string")
    valid, invalid = cat.split_valid(df)
    want = cat.union_invalid(valid.join(side, "acc", "left").select("k", "Var", "catId"), invalid.select("k", "Var"))
    got = cat.join_valid(df, side, "acc")
    assert got.columns == ["k", "acc", "Var", "catId"]
    assert rows(got, "k", "Var", "catId") == rows(want, "k", "Var", "catId")


def test_categorize_end_to_end(spark):
    batch = spark.createDataFrame([
        ("acc1", "2024-01-01", "10.0", "AX/shop/b/c", "T1", "others"),
        ("acc2", "2024-01-01", "5.0", "MX/a/b/c3", "T2", "bill"),
        ("acc3", None, "1.0", "zz", "T3", "bill"),
    ], "accIdent string, tranDt string, cost string, tranT string, tranI string, payType string")
    dm = spark.createDataFrame([
        ("T1", '{"catIdEdit": "2", "accOfDec": "9"}', "3", ['{"catId": "3", "score": "1"}']),
        ("T1", '{"catIdEdit": "3", "accOfDec": "95"}', "3", ['{"catId": "3", "score": "1"}']),
    ], "tranI string, udCat string, cat_id string, dec_cat array<string>")
    tree = spark.createDataFrame([("3", "Food")], "catId string, catN string")
    out = cat.categorize(batch, dm, tree, join_key="tranI")
    got = {r["tranI"]: r for r in out.collect()}
    assert got["T1"]["counP_Name_TT"] == "SHOP" and got["T1"]["catN"] == "Food"
    assert got["T1"]["usDecCatId"] == ["3", "2"]     # split category ids first, then decisions by accuracy
    assert got["T2"]["counP_Name_TT"] == "C3" and got["T2"]["usDecCatId"] == []
    assert got["T3"]["Var"] == 0 and got["T3"]["catN"] is None
    assert (got["T3"]["tranT1"], got["T3"]["tranT"], got["T3"]["TT_0"]) == ("zz", "ZZ", None)   # normalized, not split


def test_decision_positions_match_list_with_hot_group(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") < 2000, F.lit(0)).otherwise(F.col("id") % 9).alias("g"),
        F.when(F.col("id") % 17 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("udId"),
        (F.col("id") % 23).cast("string").alias("udAcc"), F.col("id").alias("t"))
    pos = cat.decision_positions(df.repartition(5), ["g"], tie_col="t")
    lists = {r["g"]: r["usDecCatId"] for r in cat.decision_list(df, ["g"], tie_col="t").collect()}
    rebuilt = {}
    for r in pos.collect():
        rebuilt.setdefault(r["g"], []).append((r["position"], r["udId"]))
    assert {g: [i for _, i in sorted(v)] for g, v in rebuilt.items()} == {g: v for g, v in lists.items() if v}
    assert all(sorted(p for p, _ in v) == list(range(1, len(v) + 1)) for v in rebuilt.values())
