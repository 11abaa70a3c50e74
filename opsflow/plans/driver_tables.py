"""Bindings of the operators to the driver's tables (one function per query key).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables; every query reads the given tables (or data Spark derives from them),
``events`` is the message feed and metric stream, ``customer`` the accounts,
``orders`` / ``lineitem`` / ``part`` / ``nation`` the masters and run data.
Queries that need landed files (CSV masters, dated folders, logs, JSON
documents, streams) write them under the shared checkpoint folder first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import arrays, wall_clock
from ..operators import categorize as cat
from ..operators import clusters as cl
from ..operators import envelope as env
from ..operators import feeds, latest, runs, status, transfer
from ..session import scratch_path
from ..sources import files, sinks
from . import feed_runs

# --- fixed binding parameters ---------------------------------------------
NOW_EVENTS = dt.datetime(2024, 1, 30, 0, 0, 0)       # "now" for event-time windows
RUN_DATE = dt.date(2024, 1, 30)                        # dashboard report date
RAW_DAY = dt.date(2024, 1, 29)                         # day of raw status rows
DATED_DAY = dt.date(2024, 1, 15)                       # day read from the dated folder
STREAM_SPLIT = dt.datetime(2024, 1, 16)                # first / second stream batch
NOW_CLUSTERS = dt.datetime(2001, 8, 1, 0, 0, 0)        # "now" for cluster documents
AUDIT_TS = dt.datetime(2024, 1, 30, 23, 30, 0)
TXN_SPLIT = dt.datetime(1998, 6, 1)                    # first / second transaction batch
MATRIX_DAYS = [RUN_DATE - dt.timedelta(days=i) for i in range(30)]  # every day of the events, newest first
WANTED_PROCESS = "P~CC~BRAND2"
COST_RATE = 0.25
FEEDS = {
    "A": feeds.FeedConfig("A", "A_in", "A_out", "A_group"),
    "B": feeds.FeedConfig("B", "B_in", "B_out", "B_group"),
    "C": feeds.FeedConfig("C", "C_in", "C_out", "C_group"),
}
EVENT_FEED = {"purchase": "A", "click": "A", "view": "B", "signup": "C", "error": "C"}
EVENT_CODE = {"click": "OK", "purchase": "OK", "view": "DLT", "error": "SRC", "signup": "TGT"}
REGION_FREQ = {1: "MLY_01", 3: "MLT_15"}               # other regions: DLY


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _map(c: Column, mapping: dict, default: Column | None = None) -> Column:
    out = default if default is not None else F.lit(None).cast("string")
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def _ts(v: dt.datetime) -> Column:
    return wall_clock(v)


# ============================================================ feeds
def messages(spark, sf_dir) -> DataFrame:
    """events as raw messages: message time and payload text."""
    ev = _t(spark, sf_dir, "events")
    return feeds.raw_messages(ev, time_col="ts", value_col="props")


def q_json_flatten(spark, sf_dir):
    return feeds.parse_messages(messages(spark, sf_dir), "k int")


def q_pad_columns(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", F.col("ts").alias("msg_time"), "value",
                                             F.col("props").alias("val_str"))
    parsed = feeds.parse_messages(ev, "k int", keep=["event_id", "msg_time", "value"])
    return feeds.pad_columns(parsed, "C", amount_col="value")


def q_rename_map(spark, sf_dir):
    part = _t(spark, sf_dir, "part").select(
        F.col("p_partkey"), F.col("p_name").alias("cat_N"), F.col("p_type").alias("cat_type"),
        F.col("p_size").alias("Var"), F.col("p_brand").alias("sub_text"),
        F.col("p_retailprice").alias("Final_Output"), F.col("p_partkey").cast("string").alias("cat_id"))
    return feeds.rename_output(part)


def q_sign_flag(spark, sf_dir):
    cu = _t(spark, sf_dir, "customer")
    return cu.select("c_custkey", "c_acctbal", feeds.sign_flag("c_acctbal").alias("amtId"))


def q_default_category(spark, sf_dir):
    cu = _t(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("amount"))
    return feeds.default_category(cu, "amount", keep_struct=False)


def q_feed_route(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "event_type")
    routed = feeds.route(ev, _map(F.col("event_type"), EVENT_FEED), FEEDS)
    return routed.select("event_id", "feed", "output_topic", "consumer_group", "branch")


# ============================================================ latest message
def q_latest_message(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return latest.latest_messages(ev, ["user_id", "event_type"], F.to_date("ts"))


# ============================================================ categorization
def transactions(spark, sf_dir) -> DataFrame:
    """orders left-joined to events: the five required columns, some null."""
    o = _t(spark, sf_dir, "orders")
    e = _t(spark, sf_dir, "events")
    j = o.join(e, o["o_orderkey"] == e["event_id"], "left")
    return j.select(
        F.col("o_orderkey"), F.col("o_custkey").alias("accIdent"), F.col("o_orderdate").alias("tranDt"),
        F.col("o_totalprice").alias("cost"), F.col("props").alias("tranT"), F.col("event_id").alias("tranI"))


def q_completeness(spark, sf_dir):
    return cat.completeness(transactions(spark, sf_dir)).select("o_orderkey", "Var")


def q_invalid_union(spark, sf_dir):
    flagged = cat.completeness(transactions(spark, sf_dir))
    cu = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("accIdent"),
                                               F.col("c_nationkey").cast("string").alias("catId"))
    tree = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("catId"),
                                               F.col("n_name").alias("catN"))
    enriched = cat.enrich_with_tree(cat.join_valid(flagged, cu, "accIdent"), tree, "catId")
    return enriched.select("o_orderkey", "Var", "catId", "catN")


def part_text(spark, sf_dir) -> DataFrame:
    """A transaction text per part: '/', '~', double blanks and a tab."""
    p = _t(spark, sf_dir, "part")
    second = F.when(F.col("p_size") % 4 == 0, F.lit("ap")).otherwise(F.col("p_brand"))
    base = F.concat(F.lower("p_type"), F.lit("/"), second, F.lit("~"), F.col("p_name"), F.lit("  \t"),
                    F.col("p_type"), F.lit("/"), F.col("p_size").cast("string"))
    text = F.when(F.col("p_size") > 25, F.concat(base, F.lit("~x/y"))).otherwise(base)
    return p.select("p_partkey", "p_type", "p_size", text.alias("tranT"))


def q_text_normalize(spark, sf_dir):
    return cat.normalize(part_text(spark, sf_dir)).select("p_partkey", "tranT1", "tranT")


def q_token_split(spark, sf_dir):
    t = cat.tokens(cat.normalize(part_text(spark, sf_dir)))
    return t.select("p_partkey", *[f"TT_{i}" for i in range(5)])


def q_counterparty(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    pay = (F.when(F.col("o_orderpriority").startswith("1"), F.lit("Remittance"))
           .when(F.col("o_orderpriority").startswith("2"), F.lit("BILL"))
           .when(F.col("o_orderpriority").startswith("3"), F.lit("Others"))
           .otherwise(F.col("o_orderpriority")))
    txt = cat.tokens(cat.normalize(part_text(spark, sf_dir))).select("p_partkey", "tranT", *[f"TT_{i}" for i in range(5)])
    j = (li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(txt, li["l_partkey"] == txt["p_partkey"])
         .withColumn("payType", pay))
    return cat.add_counterparty(j).select("l_orderkey", "l_linenumber", "payType", "counP_Name_TT")


def decision_map(spark, sf_dir) -> DataFrame:
    """The user-decision map from events: decision JSON text, category ids, m_c text."""
    ev = _t(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    acc = F.round("value").cast("int").cast("string")
    m_c = F.concat(F.col("user_id").cast("string"), F.when(F.col("event_type") == "error", F.lit("x")).otherwise(F.lit("")))
    day = F.dayofmonth("ts").cast("string")
    cat_id = F.when(F.hour("ts") < 12, day).otherwise(F.concat(day, F.lit("-"), F.hour("ts").cast("string")))
    ud = F.to_json(F.struct(k.alias("catIdEdit"), acc.alias("accOfDec")))
    return ev.select("event_id", "user_id", "event_type", "ts", k.alias("k"), m_c.alias("m_c"), ud.alias("udCat"),
                     cat_id.alias("cat_id"))


def guarded_decisions(spark, sf_dir) -> DataFrame:
    dm = cat.prepare_decision_map(decision_map(spark, sf_dir))
    return dm.withColumn("udId", cat.guard_decision("udId", "cat_id"))


def q_decision_guard(spark, sf_dir):
    return guarded_decisions(spark, sf_dir).select("event_id", "user_id", "m_c", "cat_id", "udId", "udAcc", "Dec_Wt")


def q_decision_list(spark, sf_dir):
    """Lists built once per user, then every customer joined to its list (many-to-one)."""
    cu = _t(spark, sf_dir, "customer").select("c_custkey")
    lists = cat.decision_list(guarded_decisions(spark, sf_dir), ["user_id"], tie_col="event_id")
    j = cu.join(lists, cu["c_custkey"] == lists["user_id"], "left")
    return j.select("c_custkey", F.coalesce(F.array_join("usDecCatId", ","), F.lit("")).alias("usDecCatId"))


def q_decision_positions(spark, sf_dir):
    g = guarded_decisions(spark, sf_dir).select("event_id", "user_id", "udId", "udAcc")
    return cat.decision_positions(g, ["user_id"], tie_col="event_id")


LIST_BLOCK = 4                                          # small, so that lists have several blocks


def q_running_list(spark, sf_dir):
    """The running list of every row as its length and digest, from blocks and a slice."""
    g = guarded_decisions(spark, sf_dir).select("event_id", "user_id", "udId", "udAcc")
    rows, _ = cat.running_lists(g, ["user_id"], tie_col="event_id", size=LIST_BLOCK)
    return rows.select("event_id", "user_id", "udAcc", "running_len", "list_digest")


def q_decision_blocks(spark, sf_dir):
    """Every user's decision list in blocks (D2 for groups of any size)."""
    g = guarded_decisions(spark, sf_dir).select("event_id", "user_id", "udId", "udAcc")
    blocks = cat.decision_blocks(g, ["user_id"], tie_col="event_id", size=LIST_BLOCK)
    return blocks.select("user_id", "block", F.array_join("ids", ",").alias("ids"))


def q_candidate_set(spark, sf_dir):
    g = guarded_decisions(spark, sf_dir)
    et = F.col("event_type")
    per_user = cat.decision_list(g, ["user_id"], tie_col="event_id", extra_aggs=[
        F.concat_ws("-", F.array_sort(F.collect_set(et))).alias("cat_id"),
        F.collect_set(F.when(et == "click", F.col("k"))).alias("decCatId"),
        F.when(F.count_if(et == "view") > 0, F.collect_set(F.when(et == "view", F.col("k")))).alias("nextBestCat"),
        F.collect_set(F.when(et == "signup", F.col("k"))).alias("nextBest_catId"),
    ])
    c = cat.candidate_set(per_user)
    return c.select("user_id", arrays.sorted_text(F.col("usDecCatId")).alias("usDecCatId"),
                    arrays.sorted_text(F.col("setNext")).alias("setNext"))


def scored_events(spark, sf_dir) -> DataFrame:
    dm = cat.prepare_decision_map(decision_map(spark, sf_dir))
    j1 = cat.score_json(F.col("k"), F.col("udAcc"))
    j2 = cat.score_json((F.col("k").cast("int") + 100).cast("string"), F.col("udAcc"))
    arr = (F.when(F.col("event_type") == "error", F.lit(None).cast("array<string>"))
           .when(F.col("event_type") == "signup", F.array().cast("array<string>"))
           .otherwise(F.array(j1, j2)))
    return dm.select("event_id", "k", "udAcc", arr.alias("dec_cat"))


def q_explode_scores(spark, sf_dir):
    return cat.explode_scores(scored_events(spark, sf_dir)).select("event_id", "cat_id", "cat_wt")


def q_score_json(spark, sf_dir):
    dm = cat.prepare_decision_map(decision_map(spark, sf_dir))
    return dm.select("event_id", cat.score_json("k", "udAcc").alias("nextBest0"))


def land_tree_csv(spark, sf_dir) -> str:
    """All nations landed as a headered CSV master (the category tree)."""
    path = scratch_path(spark, "tree_csv")
    tree = _t(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("catId"), F.col("n_name").alias("catN"), F.col("n_regionkey").alias("catRegion"))
    tree.write.option("header", "true").csv(path)
    return path


def customer_category(spark, sf_dir) -> DataFrame:
    """Category of every customer: the nation, one that the tree lacks, or null."""
    key = F.when(F.col("c_custkey") % 5 == 0, F.col("c_nationkey") + 100) \
        .when(F.col("c_custkey") % 7 != 0, F.col("c_nationkey"))
    return _t(spark, sf_dir, "customer").select("c_custkey", key.cast("string").alias("catId"))


def q_tree_enrich(spark, sf_dir):
    tree = files.read_master_csv(spark, land_tree_csv(spark, sf_dir))
    cu = customer_category(spark, sf_dir)
    return cat.enrich_with_tree(cu, tree, "catId").select("c_custkey", "catId", "catN", "catRegion")


def categorize_inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Transactions (orders left-joined to events, some incomplete), the decision
    map from events keyed by user (category = the user's nation; every fourth
    user has a second one), and the nation tree."""
    o = _t(spark, sf_dir, "orders")
    e = _t(spark, sf_dir, "events")
    txn = o.join(e, o["o_orderkey"] == e["event_id"], "left").select(
        F.col("o_orderkey"), F.col("o_custkey").alias("accIdent"), F.col("o_orderdate").alias("tranDt"),
        F.col("o_totalprice").alias("cost"), F.col("event_id").alias("tranI"),
        F.concat(F.col("event_type"), F.lit("/"), F.col("o_orderpriority"), F.lit("~"), F.col("props")).alias("tranT"),
        F.when(F.col("o_orderpriority").startswith("2"), F.lit("Bill")).otherwise(F.lit("Others")).alias("payType"))
    cu = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    dm = decision_map(spark, sf_dir).drop("cat_id")
    dm = dm.join(cu, dm["user_id"] == cu["c_custkey"]).select(
        "event_id", "user_id", "udCat", "m_c",
        F.when((F.col("user_id") % 4 == 0) & (F.col("event_id") % 2 == 0), F.col("c_nationkey") + 1)
        .otherwise(F.col("c_nationkey")).cast("string").alias("cat_id"))
    tree = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("catId"),
                                               F.col("n_name").alias("catN"))
    return txn, dm, tree


def categorized_view(out: DataFrame) -> DataFrame:
    return out.select("o_orderkey", "Var", "tranT", "TT_0", "counP_Name_TT",
                      F.array_join("usDecCatId", ",").alias("usDecCatId"),
                      arrays.sorted_text(F.col("setNext")).alias("setNext"), "catId", "catN")


def q_categorize_batch(spark, sf_dir):
    txn, dm, tree = categorize_inputs(spark, sf_dir)
    out = cat.categorize(txn, dm, tree, join_key="accIdent", decision_key="user_id", tie_col="event_id")
    return categorized_view(out)


def scored_map(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``categorize_inputs`` with the whole decision map: several scored rows per user, lists as JSON text as a CSV map
    has them, decisions parted by ``subT``."""
    txn, dm, tree = categorize_inputs(spark, sf_dir)
    et = _t(spark, sf_dir, "events").select(F.col("event_id").alias("_e"), F.col("event_type").alias("et"))
    j = dm.join(et, dm["event_id"] == et["_e"])
    own = F.col("cat_id")
    scores = (F.when(F.col("et") == "click", F.array(cat.score_json(own, F.lit("0.9")), cat.score_json(F.lit("3"), F.lit("0.5"))))
              .when(F.col("et") == "purchase", F.array(cat.score_json(own, F.lit("0.4"))))
              .when(F.col("et") == "error", F.array().cast("array<string>")))
    # a JSON array of objects, as text
    as_text = F.concat(F.lit("["), F.array_join(scores, ","), F.lit("]"))
    return txn, j.select(
        "event_id", "user_id", "udCat", "m_c", "cat_id", as_text.alias("dec_cat"),
        F.when(F.col("et") == "click", F.array(own, F.lit("42"))).alias("decCatId"),
        F.when(F.col("et") == "view", F.array(F.lit("11"), F.lit("12"))).alias("nextBestCat"),
        F.when(F.col("et") == "signup", F.array(F.lit("77"), own)).alias("nextBest_catId"),
        F.when(F.col("et") != "view", own).alias("nextBest0"),
        F.when(F.col("et") == "purchase", F.lit("0.75")).when(F.col("et") == "click", F.lit("0.25")).alias("catWt0"),
        F.substring("et", 1, 1).alias("subT_create"),
        F.when(F.col("et").isin("purchase", "click"), F.lit("P")).otherwise(F.lit("O")).alias("subT")), tree


def q_categorize_map_rows(spark, sf_dir):
    """The whole J1 batch: every transaction with each of its account's map rows, scores exploded, next best."""
    txn, dm, tree = scored_map(spark, sf_dir)
    out = cat.categorize(txn, dm, tree, join_key="accIdent", decision_key="user_id", tie_col="event_id")
    return out.select("o_orderkey", "Var", "subT_create", "subT", F.array_join("usDecCatId", ",").alias("usDecCatId"),
                      arrays.sorted_text(F.col("setNext")).alias("setNext"), F.array_join("nextBestCat1", ",").alias("nextBestCat1"),
                      "nextBest0", "cat", "catId", "cat_wt", "catN")


def q_stream_categorize(spark, sf_dir):
    """Transactions arrive in two micro-batches (orders before / from mid-1998)."""
    txn, _, _ = categorize_inputs(spark, sf_dir)

    def masters(s):
        _, dm, tree = categorize_inputs(s, sf_dir)
        return dm, tree

    return feed_runs.run_file_stream_categorize(
        spark, txn, _ts(TXN_SPLIT), masters, keys=["tranI", "cost", "tranT"], order="tranDt",
        join_key="accIdent", decision_key="user_id", tie_col="event_id",
        project=lambda out: categorized_view(out))


# ============================================================ envelope
def q_envelope(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return env.envelope(ev, "user_id")


def q_envelope_structured(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return env.envelope_structured(ev, {"props": "k int"}, "user_id")


# ============================================================ streams
def q_stream_latest(spark, sf_dir):
    return feed_runs.run_file_stream_latest(spark, _t(spark, sf_dir, "events"), _ts(STREAM_SPLIT))


def q_stream_enrich(spark, sf_dir):
    tree_path = land_tree_csv(spark, sf_dir)
    cu = customer_category(spark, sf_dir)
    return feed_runs.run_file_stream_enrich(spark, _t(spark, sf_dir, "events"), _ts(STREAM_SPLIT),
                                                    cu, tree_path)


def feed_messages(spark, sf_dir) -> dict[str, DataFrame]:
    """The events as raw messages of their feed: time and JSON payload.  A user's messages of one kind and amount are one
    transaction; every fifth lacks its text and is set aside."""
    ev = _t(spark, sf_dir, "events")
    user = F.col("user_id").cast("string")
    payload = F.to_json(F.struct(
        F.concat(F.lit("t"), user).alias("tranId"), F.col("event_type").alias("tranText"), user.alias("accId"),
        (F.floor(F.col("value") / 50) - 1).cast("int").alias("amount"), user.alias("accIdent"), F.to_date("ts").cast("string").alias("tranDt"),
        F.lit("1").alias("cost"), F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("AX/"), F.col("event_type"))).alias("tranT"),
        F.lit("i").alias("tranI"), F.lit("others").alias("payType")))
    rows = ev.select(_map(F.col("event_type"), EVENT_FEED).alias("feed"), F.col("ts").cast("timestamp_ntz").alias("timestamp"),
                     payload.alias("value"))
    return {name: rows.filter(F.col("feed") == name).drop("feed") for name in FEEDS}


def q_feed_stream(spark, sf_dir):
    """Feeds A, B and C from raw message to envelope, through a failed batch and a restart from the checkpoint (H1)."""
    def masters(s):
        _, dm, tree = categorize_inputs(s, sf_dir)
        return dm.withColumn("user_id", F.col("user_id").cast("string")), tree

    out = feed_runs.run_feeds_with_restart(spark, feed_messages(spark, sf_dir), _ts(STREAM_SPLIT), FEEDS, masters,
                                           join_key="accIdent", decision_key="user_id", tie_col="event_id")
    row = F.from_json("value", "tranId string, amount string, tranText string, msg_time string, isCat string, catId string, "
                               "catN string, Output string, usDecCatId array<string>, counP_Name_TT string")
    return out.select("feed", "batch_id", "key", row.alias("r")).select(
        "feed", "batch_id", "key", "r.tranId", F.col("r.amount").cast("double").cast("int").alias("amount"), "r.tranText", F.substring("r.msg_time", 1, 19).alias("msg_time"),
        "r.isCat", "r.catId", "r.catN", F.array_join("r.usDecCatId", ",").alias("usDecCatId"), "r.counP_Name_TT")


# ============================================================ transfer
def manifest_from_parts(spark, sf_dir) -> DataFrame:
    p = _t(spark, sf_dir, "part")
    even = F.col("p_size") % 2 == 0
    return p.select(
        F.concat(F.when(even, F.lit("P")).otherwise(F.lit("p")), F.lit("~cc~"),
                 F.replace(F.lower("p_brand"), F.lit("#"), F.lit(""))).alias("PROCESS_NAME"),
        F.col("p_name").alias("DATAFRAME_NAME"),
        F.lit("parquet").alias("SOURCE_TYPE"),
        F.concat(F.lit("table"), F.col("p_partkey").cast("string")).alias("DEST_TABLE_NAME"),
        F.when(even, F.lit("append")).otherwise(F.lit("overwrite")).alias("DEST_WRITE_MODE"),
        F.lit("AUDIT").alias("DEST_AUDIT_TABLENAME"),
        F.when(F.col("p_size") % 3 == 1, F.lit("M")).when(F.col("p_size") % 3 == 2, F.lit("d")).alias("M_INDICATOR"),
        F.concat(F.lit("/data/"), F.lower("p_type")).alias("STORAGE_LOCATION"),
        F.when(F.col("p_size") % 5 != 0, F.lit("o_orderkey, o_totalprice")).alias("COLUMN_LIST"),
        F.when(F.col("p_size") % 7 != 0, F.concat(F.lit("o_totalprice > "),
                                                  F.col("p_retailprice").cast("int").cast("string"))).alias("WHERE_CLAUSE"),
    )


def q_manifest_lookup(spark, sf_dir):
    path = scratch_path(spark, "manifest")
    manifest_from_parts(spark, sf_dir).write.option("header", "true").option("delimiter", "|").csv(path)
    chosen = transfer.select_process(files.read_manifest(spark, path), WANTED_PROCESS)
    return chosen.select("PROCESS_NAME", "DEST_TABLE_NAME", "M_INDICATOR", "COLUMN_LIST", "WHERE_CLAUSE",
                         transfer.resolved_location(F.lit(RUN_DATE)).alias("location"))


def q_transfer_project(spark, sf_dir):
    row = {"SOURCE_TYPE": "parquet", "STORAGE_LOCATION": f"{sf_dir}/orders.parquet", "M_INDICATOR": "M",
           "COLUMN_LIST": "o_orderkey, o_custkey, o_totalprice, o_orderdate",
           "WHERE_CLAUSE": "o_orderstatus = 'F' AND o_totalprice > 100000"}
    src = files.read_dated(spark, row["SOURCE_TYPE"], row["STORAGE_LOCATION"], row["M_INDICATOR"], RUN_DATE)
    return transfer.project(spark, src, row["COLUMN_LIST"], row["WHERE_CLAUSE"])


def land_dated_events(spark, sf_dir) -> str:
    """The events as year= / month= / day= folders."""
    path = scratch_path(spark, "dated")
    ev = _t(spark, sf_dir, "events")
    (ev.withColumns({"year": F.date_format("ts", "yyyy"), "month": F.date_format("ts", "MM"),
                     "day": F.date_format("ts", "dd")})
     .hint("rebalance", "year", "month", "day").write.partitionBy("year", "month", "day").parquet(path))
    return path


def q_dated_scan(spark, sf_dir):
    return files.read_dated(spark, "parquet", land_dated_events(spark, sf_dir), "d", DATED_DAY)


def q_previous_day(spark, sf_dir):
    """The folder read by a process that loads the previous day (A5)."""
    day = transfer.run_date_for(C.PREVIOUS_DAY_PROCESSES[0].lower(), DATED_DAY)
    return files.read_dated(spark, "parquet", land_dated_events(spark, sf_dir), "d", day)


def audit_from_lineitem(spark, sf_dir) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    return li.select(F.concat(F.lit("table"), F.col("l_partkey").cast("string")).alias("TableName"),
                     F.when(F.col("l_linestatus") == "F", F.lit(C.AUDIT_FINISHED)).otherwise(F.lit(C.AUDIT_STARTED)).alias("Status"),
                     F.trunc(F.to_date("l_shipdate"), "year").alias("LoadDate"))


def q_load_gate(spark, sf_dir):
    """The audit table (derived from lineitem) is landed first, as a real audit
    table would be stored, so the gate's Status / LoadDate filter reaches the scan."""
    path = scratch_path(spark, "audit_table")
    audit_from_lineitem(spark, sf_dir).write.parquet(path)
    p = _t(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("table"), F.col("p_partkey").cast("string")).alias("DEST_TABLE_NAME"))
    return transfer.load_gate(p, spark.read.parquet(path), F.lit(dt.date(1997, 1, 1)))


def q_audit_rows(spark, sf_dir):
    types = _t(spark, sf_dir, "events").select("event_type").distinct()
    types = types.select("event_type", F.concat(F.lit("p~cc~"), F.col("event_type"), F.lit("~M")).alias("process_name"),
                         F.explode(F.array(F.lit(C.AUDIT_STARTED), F.lit(C.AUDIT_FINISHED))).alias("s"))
    return transfer.audit_rows(types, F.col("s"), F.lit(RUN_DATE), _ts(AUDIT_TS), "event_type", "process_name")


def q_audit_sink(spark, sf_dir):
    """Audit rows appended to the run's folder and read back (A14)."""
    folder = f"{scratch_path(spark, 'audit_rows')}/{RUN_DATE:%Y%m%d}"
    sinks.append_parquet(q_audit_rows(spark, sf_dir), folder)
    return spark.read.parquet(folder)


def q_finished_count(spark, sf_dir):
    """Finished audit rows of one table on one day (D1)."""
    return transfer.finished_count(audit_from_lineitem(spark, sf_dir), "table7", F.lit(dt.date(1997, 1, 1)))


def q_error_rows(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    ev = ev.withColumns({"tbl": F.concat(F.lit("table"), F.col("user_id").cast("string")),
                         "msg": F.concat(F.lit("failed: "), F.col("props"))})
    return transfer.error_rows(ev, "tbl", "ts", "msg")


# ============================================================ run bookkeeping
def _log_fields(ev: DataFrame) -> list[Column]:
    msg = F.when(F.col("event_type") == "purchase", F.lit("Data Transfer Completed")).otherwise(F.lit("Transfer Started"))
    return [F.col("event_id").cast("string"), F.lit("BB"), F.lit(""), F.lit(""),
            F.concat(F.lit("table"), F.col("user_id").cast("string")), F.lit("Data Transfer"),
            F.upper("event_type"), F.lit(""), msg, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
            F.date_format("ts", "yyyy-MM-dd")]


def land_logs(spark, sf_dir) -> str:
    """One log folder per process (one per event type): a ``~#~`` line per event,
    plus a completion line for large purchase and click events."""
    path = scratch_path(spark, "logs")
    ev = _t(spark, sf_dir, "events")
    process = F.concat(F.lit("p~cc~"), F.col("event_type"), F.lit("~M"))
    lines = ev.select(process.alias("process"), F.concat_ws(C.LOG_SEPARATOR, *_log_fields(ev)).alias("value"))
    done = ev.filter(F.col("event_type").isin("purchase", "click") & (F.col("value") >= 150)).select(
        process.alias("process"),
        F.concat(F.lit(C.COMPLETION_MARKER), F.lit("table"), F.col("user_id").cast("string")).alias("value"))
    # rebalance: about one file per process, while AQE still splits a hot process
    lines.unionByName(done).hint("rebalance", "process").write.partitionBy("process").text(path)
    return path


def q_log_parse(spark, sf_dir):
    parsed = runs.parse_log_lines(files.read_logs(spark, land_logs(spark, sf_dir)))
    return parsed.select("log_id", "source", "table_name", "stage", "status", "message", "log_ts", "log_date",
                         "export_line")


def q_completed_processes(spark, sf_dir):
    logs = files.read_logs(spark, land_logs(spark, sf_dir))
    process = F.url_decode(F.regexp_extract("file_path", "process=([^/]+)", 1))
    return runs.completed_processes(logs, process)


def process_keys(spark, sf_dir) -> DataFrame:
    p = _t(spark, sf_dir, "part")
    ind = F.when(F.col("p_size") % 7 == 0, F.lit("")).otherwise(
        F.concat(F.lit("~"), F.when(F.col("p_size") % 2 == 0, F.lit("t")).otherwise(F.lit("M"))))
    key = F.concat(F.lower(F.substring("p_type", 1, 2)), F.lit("~cc~table"), F.col("p_partkey").cast("string"), ind)
    return p.select("p_partkey", key.alias("process_key"))


def q_process_key(spark, sf_dir):
    k = process_keys(spark, sf_dir)
    return k.select("p_partkey", "process_key", *runs.parse_process_key("process_key"))


def q_readiness(spark, sf_dir):
    k = process_keys(spark, sf_dir)
    wanted = k.select("p_partkey", "process_key", *runs.parse_process_key("process_key"))
    li = _t(spark, sf_dir, "lineitem")
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_type")
    markers = li.join(p, li["l_partkey"] == p["p_partkey"]).select(
        F.concat(F.lit("success-"), F.lower(F.substring("p_type", 1, 2)), F.lit("-cc-table"),
                 F.col("l_partkey").cast("string"), F.lit("-"), F.date_format("l_shipdate", "yyyyMMdd")).alias("marker"))
    return runs.readiness(wanted, markers).select("p_partkey", "process_key", "indicator", "ready")


def finished_customers(spark, sf_dir) -> DataFrame:
    o = _t(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return o.select(F.col("o_custkey").alias("c_custkey"))


def q_pending(spark, sf_dir):
    return runs.pending(_t(spark, sf_dir, "customer"), finished_customers(spark, sf_dir), "c_custkey")


def q_numbered_pending(spark, sf_dir):
    cu = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    pend = cu.join(finished_customers(spark, sf_dir), "c_custkey", "left_anti")
    return runs.numbered(pend, [F.col("c_name")], "c_name").select("c_custkey", "position", "line")


def q_pending_all(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return runs.pending_all(o.select("o_custkey"), o.filter(F.col("o_orderstatus") == "F"), "o_custkey")


def q_run_status(spark, sf_dir):
    cu = _t(spark, sf_dir, "customer")
    done = finished_customers(spark, sf_dir).distinct().withColumn("_done", F.lit(True))
    st = cu.join(done, "c_custkey", "left").select(
        "c_mktsegment", F.col("_done").isNull().alias("pending"), (F.col("c_acctbal") >= 0).alias("ready"))
    return runs.run_status(st, ["c_mktsegment"], F.lit(False))


def q_run_status_failed(spark, sf_dir):
    """The run status per nation once the deadline has passed (FAILED branch, D8)."""
    cu = _t(spark, sf_dir, "customer")
    done = finished_customers(spark, sf_dir).distinct().withColumn("_done", F.lit(True))
    st = cu.join(done, "c_custkey", "left").select(
        "c_nationkey", F.col("_done").isNull().alias("pending"), (F.col("c_acctbal") >= 0).alias("ready"))
    return runs.run_status(st, ["c_nationkey"], F.lit(True))


def q_log_export(spark, sf_dir):
    """Exported log lines appended to the run date's folder and read back (A19)."""
    folder = scratch_path(spark, "log_export")
    sinks.export_log_lines(q_log_parse(spark, sf_dir), folder, RUN_DATE.isoformat())
    return spark.read.text(f"{folder}/run_date={RUN_DATE.isoformat()}").select(F.col("value").alias("export_line"))


def q_error_sink(spark, sf_dir):
    """Error rows appended to the run's folder and read back (A15)."""
    folder = f"{scratch_path(spark, 'error_rows')}/{RUN_DATE:%Y%m%d}"
    sinks.append_parquet(q_error_rows(spark, sf_dir), folder)
    return spark.read.parquet(folder)


def q_latest_attempt(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return runs.latest_attempt(ev, "user_id", "ts", ["event_id", "event_type"])


# ============================================================ dashboard
def event_code(c: str = "event_type") -> Column:
    return _map(F.col(c), EVENT_CODE)


def status_long(spark, sf_dir) -> DataFrame:
    """(usecase, report_date, category): per user and day, the code of the day's first event."""
    ev = _t(spark, sf_dir, "events")
    return ev.groupBy(F.concat(F.lit("UC_"), F.col("user_id").cast("string")).alias("usecase"),
                      F.to_date("ts").alias("report_date")).agg(
        F.min_by(event_code(), F.struct("ts", "event_id")).alias("category"))


def nation_master(spark, sf_dir) -> DataFrame:
    n = _t(spark, sf_dir, "nation")
    return n.select(F.col("n_name").alias("usecase"),
                    F.concat((F.col("n_regionkey") + 10).cast("string"), F.lit(":00")).alias("SLA"),
                    _map(F.col("n_regionkey"), REGION_FREQ, F.lit("DLY")).alias("FREQ"))


def q_daily_status(spark, sf_dir):
    """Master and raw rows landed as header-less CSV and read by field position."""
    ev = _t(spark, sf_dir, "events").filter(F.to_date("ts") == F.lit(RAW_DAY))
    cu = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    raw = (ev.join(cu, ev["user_id"] == cu["c_custkey"]).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
           .select(F.when(F.col("event_id") % 2 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("uc"),
                   F.lit("10:00"), F.lit("DLY"), F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss"),
                   F.col("event_id").cast("string"), F.lit("-"), event_code().alias("category")))
    master_path, raw_path = scratch_path(spark, "uc_master"), scratch_path(spark, "uc_raw")
    nation_master(spark, sf_dir).write.option("header", "false").csv(master_path)
    raw.write.option("header", "false").csv(raw_path)
    master = files.read_positional_csv(spark, master_path, {"usecase": 1, "SLA": 2, "FREQ": 3})
    raw_rows = files.read_positional_csv(spark, raw_path, {"usecase": 1, "line_no": 6, "category": 8}) \
        .withColumn("line_no", F.col("line_no").cast("bigint"))
    return status.daily_status(master, raw_rows, "usecase", "category", "line_no")


def raw_words(spark, sf_dir) -> DataFrame:
    """Raw status lines of one day as landed text: the use case stands in the first field, or in a remark with another
    one, in any case, also glued to other characters."""
    ev = _t(spark, sf_dir, "events").filter(F.to_date("ts") == F.lit(RAW_DAY))
    cu = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = ev.join(cu, ev["user_id"] == cu["c_custkey"]).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    name = F.col("n_name")
    first = (F.when(F.col("event_id") % 4 == 0, F.lower(name)).when(F.col("event_id") % 4 == 1, F.lit("job"))
             .when(F.col("event_id") % 4 == 2, F.concat(name, F.lit("_x"))).otherwise(name))
    remark = (F.when(F.col("event_id") % 4 == 1, F.concat(F.lit("late for "), F.initcap(name), F.lit("!")))
              .when(F.col("event_id") % 4 == 2, F.concat(F.lit("x"), name)).otherwise(F.lit("-")))
    path = scratch_path(spark, "raw_words")
    line = F.concat_ws(",", F.format_string("%010d", "event_id"), first, F.lit("DLY"), F.date_format("ts", "yyyy-MM-dd"),
                       F.date_format("ts", "HH:mm:ss"), F.col("event_id").cast("string"), remark, event_code())
    j.select(line.alias("value")).write.text(path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def q_daily_status_words(spark, sf_dir):
    """Today's category by whole words anywhere in the raw line (C2, C3)."""
    lines = raw_words(spark, sf_dir).withColumn("line_no", status.line_field("line", 1))
    return status.daily_status_words(nation_master(spark, sf_dir), lines, "line_no")


def q_code_tally(spark, sf_dir):
    return status.code_tally(status_long(spark, sf_dir), [], "category")


def q_mtd_success(spark, sf_dir):
    return status.mtd_success(status_long(spark, sf_dir), ["usecase"], RUN_DATE)


def matrix(spark, sf_dir) -> DataFrame:
    master = _t(spark, sf_dir, "customer").select(F.concat(F.lit("UC_"), F.col("c_custkey").cast("string")).alias("usecase"))
    return status.status_matrix(status_long(spark, sf_dir), MATRIX_DAYS, master=master)


def q_status_matrix(spark, sf_dir):
    return matrix(spark, sf_dir)


def q_history_unpivot(spark, sf_dir):
    """The wide history file (usecase, SLA, FREQ, MTD, MTD-DL, one column per day,
    newest first) landed as headered CSV, read back and turned long."""
    mtd = status.mtd_success(status_long(spark, sf_dir), ["usecase"], RUN_DATE)
    wide = matrix(spark, sf_dir).join(mtd, "usecase", "left").select(
        "usecase", F.lit("10:00").alias("SLA"), F.lit("DLY").alias("FREQ"), F.col("mtd").alias("MTD"),
        F.col("mtd_dl").alias("MTD-DL"), *[F.col(status.day_column(d)).alias(d.strftime("%Y%m%d")) for d in MATRIX_DAYS])
    path = scratch_path(spark, "history_wide")
    wide.write.option("header", "true").csv(path)
    landed = files.read_wide_history(spark, path)
    return status.history_unpivot(landed, ["usecase"], landed.columns[5:])


def user_master(spark, sf_dir) -> DataFrame:
    cu = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return cu.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("UC_"), F.col("c_custkey").cast("string")).alias("usecase"),
        _map(F.col("n_regionkey"), REGION_FREQ, F.lit("DLY")).alias("FREQ"))


def q_dashboard_order(spark, sf_dir):
    mtd = status.mtd_success(status_long(spark, sf_dir), ["usecase"], RUN_DATE)
    rows = mtd.join(user_master(spark, sf_dir), "usecase", "left")
    return status.dashboard_order(rows).select("usecase", "FREQ", "mtd", "mtd_dl", "position")


def q_dashboard_lines(spark, sf_dir):
    """The matrix order with repeated use cases: equal names are told apart by the whole line (F1)."""
    mtd = status.mtd_success(status_long(spark, sf_dir), ["usecase"], RUN_DATE)
    cu = _t(spark, sf_dir, "customer").select(F.concat(F.lit("UC_"), F.col("c_custkey").cast("string")).alias("usecase"),
                                              "c_nationkey", "c_mktsegment")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    rows = (mtd.join(cu, "usecase").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("n_name").alias("usecase"), F.concat((F.col("n_regionkey") + 10).cast("string"), F.lit(":00")).alias("SLA"),
                    _map(F.col("n_regionkey"), REGION_FREQ, F.lit("DLY")).alias("FREQ"), "mtd", "mtd_dl",
                    F.col("c_mktsegment").alias("owner")))
    return status.dashboard_order(rows, line_cols=["usecase", "SLA", "FREQ", "mtd", "mtd_dl", "owner"])


def raw_lines(spark, sf_dir) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    code = event_code()
    result = (F.when(F.col("event_type") == "click", F.lit("SUCCESS"))
              .when(F.col("event_type") == "purchase", F.lit("Success")).otherwise(F.lit("FAILED")))
    line = F.concat_ws(",", F.concat(F.lit("UC_"), F.col("user_id").cast("string")), F.lit("10:00"), F.lit("DLY"),
                       F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss"),
                       F.col("event_id").cast("string"), result, code)
    return ev.select("event_id", line.alias("line"))


def q_failure_list(spark, sf_dir):
    return status.failure_list(raw_lines(spark, sf_dir))


def q_status_colour(spark, sf_dir):
    return status.with_colour(status_long(spark, sf_dir))


def q_report_rows(spark, sf_dir):
    cols = ["usecase", *[status.day_column(d) for d in MATRIX_DAYS]]
    return status.report_rows(matrix(spark, sf_dir), cols).select("usecase", "html")


def q_history_rollover(spark, sf_dir):
    folder = scratch_path(spark, "history")
    day = status_long(spark, sf_dir).filter(F.col("report_date") == F.lit(RUN_DATE))
    status.rollover(day, folder)
    status.rollover(day, folder)           # same-day rerun: still one copy
    return spark.read.parquet(folder).select("usecase", "category", "report_date")


def q_rollover_days(spark, sf_dir):
    """Two days rolled over one after the other, the first again: both stay, once each (A18)."""
    folder = scratch_path(spark, "history_days")
    long = status_long(spark, sf_dir)
    first = long.filter(F.col("report_date") == F.lit(RAW_DAY))
    status.rollover(first, folder)
    status.rollover(long.filter(F.col("report_date") == F.lit(RUN_DATE)), folder)
    status.rollover(first, folder)
    return spark.read.parquet(folder).select("usecase", "category", "report_date")


def q_snapshot(spark, sf_dir):
    """The status rows kept under a time-stamped partition and read back (A17)."""
    folder = scratch_path(spark, "snapshot")
    sinks.snapshot(status_long(spark, sf_dir), folder, "ts-20240130-2330")
    return spark.read.parquet(folder).select("usecase", "category", "report_date", "snapshot_ts")


SNAPSHOT_DAYS = {"20240110_2330": dt.date(2024, 1, 10), "20240120_2330": dt.date(2024, 1, 20),
                 "20240130_2330": dt.date(2024, 1, 30)}
SNAPSHOT_AS_OF = "20240125_0000"


def q_snapshot_as_of(spark, sf_dir):
    """Raw lines, master and result kept by three runs; what the dashboard knew at a time between two of them (A17)."""
    root = scratch_path(spark, "snapshots")
    long = status_long(spark, sf_dir)
    for ts, day in SNAPSHOT_DAYS.items():
        known = long.filter(F.col("report_date") <= F.lit(day))
        sinks.snapshot(raw_lines(spark, sf_dir).filter(status.line_field("line", 4) == F.lit(day.isoformat())).select("line"), f"{root}/raw", ts)
        sinks.snapshot(nation_master(spark, sf_dir), f"{root}/master", ts)
        sinks.snapshot(status.mtd_success(known, ["usecase"], day), f"{root}/matrix", ts)
    parts = {"raw": F.col("line"), "master": F.concat_ws(",", "usecase", "SLA", "FREQ"),
             "matrix": F.concat_ws(",", "usecase", F.coalesce(F.col("mtd").cast("string"), F.lit("")), F.coalesce(F.col("mtd_dl").cast("string"), F.lit("")))}
    out = None
    for kind, line in parts.items():
        one = files.read_snapshot_as_of(spark, f"{root}/{kind}", SNAPSHOT_AS_OF).select(
            F.lit(kind).alias("kind"), line.alias("line"), "snapshot_ts")
        out = one if out is None else out.unionAll(one)
    return out


def q_marker_listing(spark, sf_dir):
    """Zero-length marker files of one load date, listed and matched with the processes that wait for them (A10)."""
    su = _t(spark, sf_dir, "supplier")
    key = F.concat(F.lit("s"), F.col("s_nationkey").cast("string"), F.lit("~cc~supplier"), F.col("s_suppkey").cast("string"),
                   F.when(F.col("s_suppkey") % 3 != 0, F.lit("~t")).otherwise(F.lit("~M")))
    root = scratch_path(spark, "status_dir")
    for day in (RAW_DAY, RUN_DATE):
        done = su.filter((F.col("s_suppkey") + day.day) % 2 == 0).select(F.concat(
            F.lit("success-s"), F.col("s_nationkey").cast("string"), F.lit("-cc-supplier"), F.col("s_suppkey").cast("string"),
            F.lit(f"-{day:%Y%m%d}")).alias("marker"))
        files.touch_markers(spark, f"{root}/year={day:%Y}/month={day:%m}/day={day:%d}", done)
    markers = files.list_markers(spark, f"{root}/year={RUN_DATE:%Y}/month={RUN_DATE:%m}/day={RUN_DATE:%d}")
    wanted = su.select("s_suppkey", key.alias("process_key")).select("s_suppkey", "process_key", *runs.parse_process_key("process_key"))
    return runs.readiness(wanted, markers).select("s_suppkey", "process_key", "indicator", "ready")


# ============================================================ cluster report
def cluster_docs(spark, sf_dir, *keep: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    state = _map(F.col("o_orderstatus"), {"F": "TERMINATED", "O": "WAITING", "P": "RUNNING"})
    ready = F.when((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 100000), F.lit(None)) \
        .otherwise(F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR"))
    end = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL 3 DAYS"))
    cid = F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("j-"), F.col("o_orderkey").cast("string")))
    return o.select(*keep, cid.alias("Id"), F.floor(F.col("o_totalprice") / 1000).cast("int").alias("NormalizedInstanceHours"),
                    F.struct(state.alias("State"), F.struct(F.col("o_orderdate").alias("CreationDateTime"),
                                                            ready.alias("ReadyDateTime"),
                                                            end.alias("EndDateTime")).alias("Timeline")).alias("Status"))


def landed_clusters(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "clusters_json")
    cluster_docs(spark, sf_dir).write.json(path)
    return cl.flatten_clusters(files.read_cluster_docs(spark, path, cl.CLUSTER_SCHEMA))


def q_cluster_flatten(spark, sf_dir):
    flat = landed_clusters(spark, sf_dir)
    after = _ts(NOW_CLUSTERS) - F.make_dt_interval(days=F.lit(C.INFO_DAYS))
    return cl.filter_clusters(flat, ["WAITING", "RUNNING"], after)


PAGE_ROWS = 1000                                        # keys per landed result page


def land_pages(docs: DataFrame, key: Column, items: str, token: str, name: str) -> str:
    """Rows as result pages: pretty JSON documents of at most ``PAGE_ROWS`` consecutive keys under ``request=<token>``."""
    spark = docs.sparkSession
    page = F.floor(key / PAGE_ROWS)
    pages = docs.select(page.alias("_page"), F.struct("*").alias("_item")).groupBy("_page").agg(F.collect_list("_item").alias(items))
    low, high = docs.agg(F.min(page), F.max(page)).first()

    def name_of(p: Column) -> Column:
        return F.when(p == low, F.lit("first")).otherwise(F.concat(F.lit("t"), p.cast("string")))

    request, follow = name_of(F.col("_page")), F.when(F.col("_page") < high, name_of(F.col("_page") + 1))
    path = scratch_path(spark, name)
    doc = F.to_json(F.struct(F.col(items), follow.alias(token)), {"pretty": "true"})
    pages.select(doc.alias("value"), request.alias("request")).write.partitionBy("request").text(path)
    return path


def q_cluster_pages(spark, sf_dir):
    """Cluster result pages with markers, landed as documents, to flat rows (A11, G2)."""
    path = land_pages(cluster_docs(spark, sf_dir, "o_orderkey"), F.col("o_orderkey"), "Clusters", "Marker", "cluster_pages")
    return cl.flatten_clusters(files.read_pages(spark, path, cl.CLUSTER_PAGE, "Clusters", "Marker"))


def q_event_pages(spark, sf_dir):
    """Audit-event result pages with tokens to the creators of clusters (A11, G2)."""
    ev = trail_events(spark, sf_dir, "event_id")
    path = land_pages(ev, F.col("event_id"), "Events", "NextToken", "event_pages")
    found = files.read_pages(spark, path, cl.EVENT_PAGE, "Events", "NextToken")
    return cl.creator_extract(cl.launch_events(found, _ts(NOW_EVENTS - dt.timedelta(days=20))))


def trail_events(spark, sf_dir, *keep: str) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    doc = (F.when(F.col("event_type") == "error", F.lit("{}"))
           .when(F.col("event_type") == "view", F.lit('{"responseElements": {}}'))
           .when(F.col("event_type") == "signup", F.lit('{"responseElements": {"other": "x"}}'))
           .otherwise(F.concat(F.lit('{"eventName": "RunJobFlow", "responseElements": {"jobFlowId": "j-'),
                               F.col("event_id").cast("string"), F.lit('"}}'))))
    name = F.when(F.col("event_type") == "view", F.lit("TerminateJobFlows")).otherwise(F.lit(C.LAUNCH_EVENT))
    return ev.select(*keep, F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("Username"),
                     doc.alias("CloudTrailEvent"), name.alias("EventName"), F.col("ts").alias("EventTime"))


def q_creator_extract(spark, sf_dir):
    """Launch events of the last 20 days; others stay out."""
    since = _ts(NOW_EVENTS - dt.timedelta(days=20))
    return cl.creator_extract(cl.launch_events(trail_events(spark, sf_dir), since))


def q_cluster_runtime(spark, sf_dir):
    rt = cl.with_runtime(landed_clusters(spark, sf_dir), _ts(NOW_CLUSTERS)).select("ClusterId", "runtime")
    return cl.runtime_order(rt)


def q_idle_windows(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select(F.col("user_id").alias("ClusterId"), F.col("ts").alias("Timestamp"),
                                             F.col("value").alias("IsIdle"))
    idle = cl.idle_windows(ev, _ts(NOW_EVENTS))
    return idle.select("ClusterId", *[F.round(c, 6).alias(c) for c in ("idle_pct", "idle_pct_12h", "idle_pct_3h")])


def q_cluster_report(spark, sf_dir):
    """Every customer a cluster with its own lifetime (some without an end), idle figures within it."""
    ready = F.when(F.col("c_custkey") % 11 != 0, F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
                   + F.make_dt_interval(days=(F.col("c_custkey") % 28).cast("int")))
    cu = _t(spark, sf_dir, "customer")
    clusters = cu.select(
        F.concat(F.lit("j-"), F.col("c_custkey").cast("string")).alias("ClusterId"),
        F.floor(F.abs(F.col("c_acctbal")) / 10).cast("int").alias("NormalizedInstanceHours"),
        F.col("c_mktsegment").alias("State"),
        ready.alias("ReadyDateTime"),
        (ready - F.make_dt_interval(hours=F.lit(1))).alias("CreationDateTime"),
        F.when(F.col("c_custkey") % 3 == 0, ready + F.make_dt_interval(days=F.lit(5))).alias("EndDateTime"))
    clusters = cl.with_runtime(clusters, _ts(NOW_EVENTS))
    o = _t(spark, sf_dir, "orders")
    creators = o.select(F.concat(F.lit("user-"), F.col("o_orderpriority")).alias("Username"),
                        F.concat(F.lit("j-"), F.col("o_custkey").cast("string")).alias("ClusterId"))
    ev = _t(spark, sf_dir, "events").select(F.concat(F.lit("j-"), F.col("user_id").cast("string")).alias("ClusterId"),
                                             F.col("ts").alias("Timestamp"), F.col("value").alias("IsIdle"))
    idle = cl.idle_windows(ev, _ts(NOW_EVENTS), clusters=clusters)
    idle = idle.select("ClusterId", *[F.round(c, 6).alias(c) for c in ("idle_pct", "idle_pct_12h", "idle_pct_3h")])
    return cl.cluster_report(clusters, creators, idle, COST_RATE)


def q_report_csv(spark, sf_dir):
    """The whole report under its display names, written as headered CSV and read back as text (A16)."""
    rep = q_cluster_report(spark, sf_dir)
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("ReadyDateTime", "CreationDateTime", "EndDateTime")}
    rep = rep.withColumns(times).withColumnsRenamed(C.REPORT_DISPLAY_NAMES)
    path = sinks.write_report_csv(rep, scratch_path(spark, "report_csv"), "20240130")
    back = spark.read.option("header", "true").csv(path)
    return back.withColumnsRenamed({v: k for k, v in C.REPORT_DISPLAY_NAMES.items()})


QUERIES = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
