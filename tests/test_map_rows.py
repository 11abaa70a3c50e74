"""Map rows per transaction, lists in blocks and running lists, against plain Python."""

import hashlib

from pyspark.sql import functions as F

from opsflow.operators import categorize as cat
from test_skew import large_input_plan

SCHEMA = ("tranI string, udCat string, cat_id string, dec_cat string, decCatId array<string>, nextBestCat array<string>, "
          "nextBest_catId array<string>, nextBest0 string, catWt0 string, subT_create string, subT string, t int")


def decision(i, acc):
    return f'{{"catIdEdit": "{i}", "accOfDec": "{acc}"}}'


def batch_of(spark, ids):
    return spark.createDataFrame([("a", "d", "c", "AX/shop", i, "others") for i in ids],
                                 "accIdent string, tranDt string, cost string, tranT string, tranI string, payType string")


def test_every_map_value_reaches_the_transaction(spark):
    scored = '[{"catId": "3", "score": "0.9"}, {"catId": "4", "score": "0.1"}]'
    dm = spark.createDataFrame([
        ("T1", decision(20, "9"), "30", scored, ["5"], ["6"], None, "8", "0.5", "c", "P", 1),
        ("T1", decision(21, "95"), "30", scored, ["5"], ["6"], None, "8", "0.5", "c", "P", 2),      # same values, another decision
        ("T1", decision(22, "50"), "31", None, None, None, ["7"], "9", None, "c", "P", 3),            # another category, same group
        ("T1", decision(23, "50"), "31", "[]", None, None, None, None, None, "x", "O", 4),            # another group
        ("T2", None, "40", "not json", None, None, None, None, "0.1", None, None, 5),
    ], SCHEMA)
    tree = spark.createDataFrame([("3", "Food"), ("30", "no")], "catId string, catN string")
    out = cat.categorize(batch_of(spark, ["T1", "T2", "T3", None]), dm, tree, join_key="tranI", tie_col="t")
    got = sorted(((r["tranI"], r["subT"], tuple(r["usDecCatId"] or ["-"]), tuple(sorted(r["setNext"] or ["-"])), r["nextBest0"], r["catId"],
                   r["cat_wt"], r["catN"]) for r in out.collect()), key=str)
    group_p = ("21", "20", "22")                # as text "95" > "9" > "50"
    best = '{"catId":"8","score":"0.5"}'
    assert got == sorted([
        ("T1", "P", ("30", *group_p), tuple(sorted(["30", *group_p, "5", "6"])), best, "3", "0.9", "Food"),
        ("T1", "P", ("30", *group_p), tuple(sorted(["30", *group_p, "5", "6"])), best, "4", "0.1", None),
        ("T1", "P", ("31", *group_p), tuple(sorted(["31", *group_p, "7"])), '{"catId":"9"}', None, None, None),
        ("T1", "O", ("31", "23"), ("23", "31"), "{}", None, None, None),
        ("T2", None, ("40",), ("40",), '{"score":"0.1"}', None, None, None),
        ("T3", None, ("-",), ("-",), "{}", None, None, None),
        (None, None, ("-",), ("-",), None, None, None, None),
    ], key=str)


def test_one_row_per_key_stays_available(spark):
    dm = spark.createDataFrame([("T1", decision(20, "9"), "30", None, None, None, None, None, None, "c", "P", 1),
                                ("T1", decision(21, "95"), "31", None, None, None, None, None, None, "x", "O", 2)], SCHEMA)
    tree = spark.createDataFrame([], "catId string, catN string")
    merged = cat.categorize(batch_of(spark, ["T1"]), dm, tree, join_key="tranI", tie_col="t", map_rows=False)
    assert [tuple(r["usDecCatId"]) for r in merged.collect()] == [("30", "31", "21", "20")]
    plain = cat.categorize(batch_of(spark, ["T1"]), dm.select("tranI", "udCat", "cat_id", "t"), tree, join_key="tranI", tie_col="t")
    assert plain.count() == 1
    assert cat.categorize(batch_of(spark, ["T1"]), dm.select("tranI", "udCat", "cat_id", "t"), tree, join_key="tranI", tie_col="t",
                          map_rows=True).count() == 2


def grouped(spark, n=9000):
    """A third of the rows in one group, some without a decision, equal accuracies, a null group."""
    return spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 101 == 0, F.lit(None)).otherwise((F.col("id") % 50).cast("string")).alias("g"),
        F.when(F.col("id") % 17 != 0, (F.col("id") % 7919).cast("string")).alias("udId"),
        F.when(F.col("id") % 23 != 0, (F.col("id") % 97).cast("string")).alias("udAcc"), F.col("id").alias("t"))


def plain_lists(rows):
    """(group -> sorted rows with a decision); accuracy descending as text, nulls last, then t."""
    out = {}
    for r in rows:
        out.setdefault(r.g, []).append(r)
    order = lambda r: (r.udAcc is None, [-ord(c) for c in r.udAcc or ""] + [1], r.t)
    return {g: sorted(v, key=order) for g, v in out.items()}


def test_lists_in_blocks_with_a_hot_group(spark):
    df = grouped(spark)
    want = {g: [r.udId for r in v if r.udId is not None] for g, v in plain_lists(df.collect()).items()}
    with large_input_plan(spark):
        blocks = cat.decision_blocks(df.repartition(5), ["g"], tie_col="t", size=64)
        rows = blocks.collect()
        whole = {r.g: r.usDecCatId for r in cat.list_from_blocks(blocks, ["g"]).collect()}
    assert max(len(r.ids) for r in rows) == 64 and len([r for r in rows if r.g == "hot"]) > 40
    assert all(len(r.ids) == 64 for r in rows if r.block < len(want[r.g]) // 64)
    assert whole == {g: v for g, v in want.items() if v}


def test_running_lists_with_a_hot_group(spark):
    df = grouped(spark, 6000)
    with large_input_plan(spark):
        rows, blocks = cat.running_lists(df.repartition(5), ["g"], tie_col="t", size=32)
        got, parts = rows.collect(), blocks.collect()
    assert max(len(r.ids) for r in parts) <= 32           # no value holds a group
    lists = plain_lists(df.collect())
    held = {(r.g, r.block): r.ids for r in parts}

    def digest(ids):
        return sum(int(hashlib.md5(f"{i}:{x}".encode()).hexdigest()[:8], 16) for i, x in enumerate(ids, 1))

    ends = {}
    for g, v in lists.items():
        ids, seen = [], {}
        for r in v:
            if r.udId is not None:
                ids.append(r.udId)
            seen[r.udAcc] = len(ids)
        ends[g] = (ids, seen)
    assert len(got) == 6000
    known = {}
    for r in got:
        ids, seen = ends[r.g]
        n = seen[r.udAcc]
        assert r.running_len == n
        if (r.g, n) not in known:
            known[r.g, n] = digest(ids[:n])
        assert r.list_digest == known[r.g, n]
        if n:
            whole = [x for b in range(r.block) for x in held[r.g, b]] + held[r.g, r.block][:n - r.block * 32]
            assert whole == ids[:n]
