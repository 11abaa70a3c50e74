"""Transaction categorization: completeness, text rules, user decisions,
candidate sets, category-tree enrichment.

Every step is a DataFrame transformation; ``categorize`` composes them for one
micro-batch.  Master tables (decision map, category tree) are ordinary
DataFrames supplied by the caller (re-read per batch by the stream runner).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import config as C
from ..functions import arrays, text
from ..functions.ranking import number_within_groups, running_sum_within_groups

DECISION_SCHEMA = StructType([StructField("catIdEdit", StringType()), StructField("accOfDec", StringType())])
# Columns of the decision map that stay per row, and those that part a key's decisions.
MAP_LISTS = ["dec_cat", "decCatId", "nextBestCat", "nextBest_catId"]
MAP_GROUPS = ["subT_create", "subT"]
MAP_VALUES = ["cat_id", *MAP_LISTS, "nextBest0", "catWt0", *MAP_GROUPS]
# Those of which one row per key could keep one value only.
MAP_SINGLES = {"dec_cat", "nextBest0", "catWt0", *MAP_GROUPS}
SCORE_SCHEMA = StructType([StructField("catId", StringType()), StructField("score", StringType())])


# ---------------------------------------------------------------- validity
def completeness(df: DataFrame, required: list[str] | None = None, flag: str = "Var") -> DataFrame:
    """``Var`` = 0 when any required column is null, else 1."""
    required = C.REQUIRED_COLUMNS if required is None else required
    any_null = F.lit(False)
    for c in required:
        any_null = any_null | F.col(c).isNull()
    return df.withColumn(flag, F.when(any_null, F.lit(0)).otherwise(F.lit(1)))


def split_valid(df: DataFrame, flag: str = "Var") -> tuple[DataFrame, DataFrame]:
    """(rows that continue, rows set aside).  Both are filters of one input."""
    return df.filter(F.col(flag) > 0), df.filter(F.col(flag) == 0)


def union_invalid(enriched: DataFrame, invalid: DataFrame) -> DataFrame:
    """Enriched rows plus the set-aside rows; columns missing on a side are null."""
    return enriched.unionByName(invalid, allowMissingColumns=True)


def join_valid(df: DataFrame, other: DataFrame, key: str, flag: str = "Var") -> DataFrame:
    """Left join of the rows that continue; set-aside rows keep their place with nulls.

    The rows of ``union_invalid`` over both branches of ``split_valid``, with the
    input computed once.  The flag is part of the join condition, so set-aside
    rows are spread by their key."""
    side = other.withColumnRenamed(key, "_key")
    return df.join(side, (df[key] == side["_key"]) & (F.col(flag) > 0), "left").drop("_key")


# ---------------------------------------------------------------- text rules
def normalize(df: DataFrame, text_col: str = "tranT", original_col: str = "tranT1") -> DataFrame:
    """Keep the original text, then upper-case it and collapse whitespace runs."""
    return df.withColumns({original_col: F.col(text_col), text_col: text.normalize_text(text_col)})


def tokens(df: DataFrame, text_col: str = "tranT", n: int = 5) -> DataFrame:
    """Positional tokens ``TT_0..TT_{n-1}`` split on '/' or '~'."""
    return df.select("*", *text.split_tokens(text_col, n))


def add_counterparty(df: DataFrame, pay_type_col: str = "payType", text_col: str = "tranT",
                     out: str = "counP_Name_TT") -> DataFrame:
    return df.withColumn(out, text.counterparty([f"TT_{i}" for i in range(5)], pay_type_col, text_col))


# ---------------------------------------------------------------- decisions
def prepare_decision_map(m_map: DataFrame, decision_col: str = "udCat") -> DataFrame:
    """Typed decision map: integer ``m_c`` (bad text gives null), constant weight,
    decision id and accuracy read from the JSON text column."""
    parsed = F.from_json(F.col(decision_col), DECISION_SCHEMA)
    out = m_map.withColumn("Dec_Wt", F.lit(C.DECISION_WEIGHT))
    if "m_c" in m_map.columns:
        out = out.withColumn("m_c", F.col("m_c").cast("string").try_cast("int"))
    return out.withColumns({"udId": parsed["catIdEdit"], "udAcc": parsed["accOfDec"]})


def guard_decision(id_col: str = "udId", cat_col: str = "cat_id") -> Column:
    """Null when the decision id is in the "others" list, or when the id and the
    category differ in membership of the category list; else the id.  A null on
    either side of the membership comparison keeps the id (unless in "others")."""
    i = F.col(id_col)
    differs = i.isin(C.IN_CAT_IDS) != F.col(cat_col).isin(C.IN_CAT_IDS)
    return F.when(i.isin(C.OTHERS_IDS) | differs, F.lit(None).cast("string")).otherwise(i)


def _by_accuracy(numeric: bool):
    """Comparator: accuracy descending (nulls last), then tie key ascending."""
    def cmp(left: Column, right: Column) -> Column:
        la, ra = left["a"], right["a"]
        tie = F.when(left["t"] < right["t"], -1).when(left["t"] > right["t"], 1).otherwise(0)
        return (F.when(la.isNull() & ra.isNull(), tie)
                .when(la.isNull(), 1).when(ra.isNull(), -1)
                .when(la > ra, -1).when(la < ra, 1).otherwise(tie))
    return cmp


def decision_list(df: DataFrame, group_cols: list[str], id_col: str = "udId", acc_col: str = "udAcc",
                  tie_col: str | None = None, numeric: bool = False, out: str = "usDecCatId",
                  extra_aggs: list[Column] | None = None) -> DataFrame:
    """Per group, the non-null decision ids ordered by accuracy descending.

    Accuracy compares as text by default ("95" > "9" > "10"), or as a number with
    ``numeric=True``; ties by ``tie_col``.  An all-null group gives ``[]``.
    One aggregate replaces the running list + max of the source job (same result).
    ``collect_list`` is partially aggregated map-side; the final list of one group
    is one value, so groups are expected to be per-transaction sized.
    """
    acc = F.col(acc_col).cast("double") if numeric else F.col(acc_col)
    tie = F.col(tie_col) if tie_col else F.lit(0)
    item = F.when(F.col(id_col).isNotNull(), F.struct(acc.alias("a"), tie.alias("t"), F.col(id_col).alias("id")))
    grouped = df.groupBy(*group_cols).agg(F.collect_list(item).alias("_items"), *(extra_aggs or []))
    ordered = F.transform(F.array_sort("_items", _by_accuracy(numeric)), lambda x: x["id"])
    return grouped.withColumn(out, ordered).drop("_items")


def decisions_per_key(df: DataFrame, key: str, id_col: str = "udId", acc_col: str = "udAcc",
                      tie_col: str | None = None, out: str = "usDecCatId") -> DataFrame:
    """One row per ``key`` of a prepared decision map, whatever its other columns hold.

    ``out``: the distinct non-null decision ids in ``decision_list`` order (text
    accuracy descending, then ``tie_col``, then the id).  ``cat_id``: the key's
    distinct category ids in text order, ``-``-separated like one composite id
    (a single id stays as it is; none gives null).  Array columns of the map are
    united (no repeats if there are several), ``nextBest0`` and ``catWt0`` come
    from the row with the largest weight, ``subT_create`` and ``subT`` are the
    largest values.  Equal (key, id, accuracy) rows meet in a first aggregate, so
    a hot key's value holds its distinct ids and accuracies, not its rows.
    """
    types = dict(df.dtypes)
    texts = [c for c in ("cat_id",) if c in types]
    lists = [c for c in ("dec_cat", "decCatId", "nextBestCat", "nextBest_catId") if c in types]
    sets = texts + [c for c in lists if types[c].startswith("array")]
    scalars = [c for c in ("subT_create", "subT", *lists) if c in types and c not in sets]
    pair = {"nextBest0", "catWt0"} <= set(types)
    single = {c: F.col(c) for c in (() if pair else ("nextBest0", "catWt0")) if c in types}
    single |= {c: F.col(c) for c in scalars}
    if pair:
        single["_pair"] = F.struct(F.col("catWt0"), F.col("nextBest0"))

    tie = F.col(tie_col) if tie_col else F.lit(0)
    first = df.groupBy(key, F.col(id_col).alias("_id"), F.col(acc_col).alias("_a")).agg(
        F.min(tie).alias("_t"), *[F.sort_array(F.collect_set(c)).alias(c) for c in sets],
        *[F.max(v).alias(c) for c, v in single.items()])
    item = F.when(F.col("_id").isNotNull(), F.struct(F.col("_a").alias("a"), F.struct("_t", "_id").alias("t"),
                                                     F.col("_id").alias("id")))
    per = first.groupBy(key).agg(
        F.collect_list(item).alias("_items"),
        *[F.sort_array(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in sets],
        *[F.max(c).alias(c) for c in single])
    ids = F.array_distinct(F.transform(F.array_sort("_items", _by_accuracy(False)), lambda x: x["id"]))
    cols = {out: ids}
    for c in sets:
        several = (F.array_join(c, C.CATEGORY_ID_SEPARATOR) if c in texts else F.array_distinct(F.flatten(c)))
        cols[c] = F.when(F.size(c) <= 1, F.get(F.col(c), 0)).otherwise(several)
    if pair:
        cols |= {"nextBest0": F.col("_pair.nextBest0"), "catWt0": F.col("_pair.catWt0")}
    return per.withColumns(cols).drop("_items", "_pair")


def list_column(df: DataFrame, column: str) -> Column:
    """A list column of the map as an array of texts; a map read from CSV holds it as JSON text (bad text is null)."""
    if dict(df.dtypes)[column] == "string":
        return F.from_json(F.col(column), "array<string>")
    return F.col(column)


def map_rows_per_key(df: DataFrame, key: str, id_col: str = "udId", acc_col: str = "udAcc",
                     tie_col: str | None = None, out: str = "usDecCatId") -> DataFrame:
    """Every distinct row of values of a prepared decision map per ``key``, with its decision list.

    Values are those of ``MAP_VALUES`` that the map has.  ``out`` holds the
    distinct non-null decision ids, in ``decision_list`` order, of the key's rows
    with the same ``subT_create`` and ``subT`` (the grouping of the source job).
    Lists are built from distinct (id, accuracy) pairs and are joined back to the
    distinct value rows, so nothing here holds the rows of a hot key together.
    """
    values = [c for c in MAP_VALUES if c in df.columns]
    by = [key, *[c for c in MAP_GROUPS if c in df.columns]]
    tie = F.col(tie_col) if tie_col else F.lit(0)
    pairs = df.filter(F.col(id_col).isNotNull()).groupBy(*by, F.col(id_col).alias("_id"), F.col(acc_col).alias("_a")).agg(
        F.min(tie).alias("_t"))
    item = F.struct(F.col("_a").alias("a"), F.struct("_t", "_id").alias("t"), F.col("_id").alias("id"))
    lists = pairs.groupBy(*by).agg(F.collect_list(item).alias("_items"))
    ids = F.array_distinct(F.transform(F.array_sort("_items", _by_accuracy(False)), lambda x: x["id"]))
    lists = lists.select(*[F.col(c).alias(f"_by_{c}") for c in by], ids.alias(out))
    rows = df.select(key, *values).distinct()
    same = [rows[c].eqNullSafe(lists[f"_by_{c}"]) for c in by]
    return rows.join(lists, same, "left").select(key, *values, arrays.empty_if_null(F.col(out)).alias(out))


def decision_blocks(df: DataFrame, group_cols: list[str], id_col: str = "udId", acc_col: str = "udAcc",
                    tie_col: str | None = None, numeric: bool = False, size: int = 1024, out: str = "ids") -> DataFrame:
    """``decision_list`` in blocks: per group and ``block`` (0, 1, ...) the next ``size`` ids of its list.

    Positions come from one range-sorted pass over all groups, so a group of any
    size is cut into blocks by many tasks and no value holds more than ``size``
    ids.  A group without a decision has no block."""
    placed = decision_positions(df, group_cols, id_col, acc_col, tie_col, numeric, "_at")
    block = ((F.col("_at") - 1) / F.lit(size)).cast("bigint")
    item = F.struct(F.col("_at"), F.col(id_col).alias("id"))
    grouped = placed.groupBy(*group_cols, block.alias("block")).agg(F.collect_list(item).alias("_items"))
    return grouped.withColumn(out, F.transform(F.array_sort("_items"), lambda x: x["id"])).drop("_items")


def list_from_blocks(blocks: DataFrame, group_cols: list[str], ids_col: str = "ids", out: str = "usDecCatId") -> DataFrame:
    """The whole list of each group from its blocks: only sorted blocks meet, no single rows."""
    grouped = blocks.groupBy(*group_cols).agg(F.array_sort(F.collect_list(F.struct("block", ids_col))).alias("_blocks"))
    return grouped.withColumn(out, F.flatten(F.transform("_blocks", lambda b: b[ids_col]))).drop("_blocks")


def element_digest(position: Column, value: Column) -> Column:
    """A number for a value at a 1-based position: the first 32 bits of the MD5 of ``position:value``.
    Digests of the elements of a list add up to the list's digest."""
    text = F.concat(position.cast("string"), F.lit(":"), value)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def running_blocks(df: DataFrame, group_cols: list[str], id_col: str = "udId", acc_col: str = "udAcc",
                   tie_col: str | None = None, size: int = 1024) -> DataFrame:
    """``decision_blocks`` with ``before``: the digest of all blocks before (a distributed prefix sum), and the
    elements' own digests, so any prefix of a group's list is some blocks and a slice of one."""
    blocks = decision_blocks(df, group_cols, id_col, acc_col, tie_col, size=size)
    marks = F.transform("ids", lambda v, i: element_digest(F.col("block") * size + i + 1, v))
    blocks = blocks.withColumn("digests", marks)
    blocks = blocks.withColumn("_total", F.aggregate("digests", F.lit(0).cast("bigint"), lambda a, b: a + b))
    summed = running_sum_within_groups(blocks, group_cols, [F.col("block")], "_total", "_through")
    return summed.withColumn("before", F.col("_through") - F.col("_total")).drop("_through", "_total")


def running_lists(df: DataFrame, group_cols: list[str], id_col: str = "udId", acc_col: str = "udAcc",
                  tie_col: str | None = None, size: int = 1024) -> tuple[DataFrame, DataFrame]:
    """The running list of every row in linear space: (rows, blocks).

    Rows get ``running_len`` and ``block`` (that of the list's last element; null
    for an empty list) and ``list_digest``; the list is the group's blocks before
    ``block`` and the first ``running_len - block * size`` ids of that block.
    Writing the lists out would be quadratic in a group's size."""
    blocks = running_blocks(df, group_cols, id_col, acc_col, tie_col, size)
    rows = running_decision_count(df, group_cols, id_col, acc_col)
    block = F.when(F.col("running_len") > 0, ((F.col("running_len") - 1) / F.lit(size)).cast("bigint"))
    rows = rows.withColumn("block", block)
    side = blocks.select(*[F.col(g).alias(f"_g_{g}") for g in group_cols], F.col("block").alias("_b"), "digests", "before")
    same = [rows[g].eqNullSafe(side[f"_g_{g}"]) for g in group_cols] + [rows["block"] == side["_b"]]
    used = F.slice("digests", 1, (F.col("running_len") - F.col("block") * size).cast("int"))
    digest = F.when(F.col("running_len") > 0, F.col("before") + F.aggregate(used, F.lit(0).cast("bigint"), lambda a, b: a + b))
    joined = rows.join(side, same, "left").withColumn("list_digest", F.coalesce(digest, F.lit(0).cast("bigint")))
    return joined.drop(*[f"_g_{g}" for g in group_cols], "_b", "digests", "before"), blocks


def decision_positions(df: DataFrame, group_cols: list[str], id_col: str = "udId", acc_col: str = "udAcc",
                       tie_col: str | None = None, numeric: bool = False, out: str = "position") -> DataFrame:
    """Long form of ``decision_list``: one row per non-null decision with its
    1-based position in the group's list (same order).  Skew-safe: no group is
    gathered into one task or one value, so it suits groups of any size."""
    acc = F.col(acc_col).cast("double") if numeric else F.col(acc_col)
    order = [acc.desc_nulls_last()] + ([F.col(tie_col).asc_nulls_first()] if tie_col else [])
    kept = df.filter(F.col(id_col).isNotNull())
    return number_within_groups(kept, group_cols, order, out)


def running_decision_count(df: DataFrame, group_cols: list[str], id_col: str = "udId", acc_col: str = "udAcc",
                           out: str = "running_len") -> DataFrame:
    """Length of the running decision list at each row.

    The running list over (accuracy descending, default RANGE frame) at a row is the
    prefix of ``decision_list`` of that length, so the length is the whole answer
    in linear size (the list itself would be quadratic per group).  Counts are
    first aggregated per (group, accuracy), then summed as a distributed prefix
    sum (no group in one task), then joined back on (group, accuracy).
    """
    gnames = [f"_g{i}" for i in range(len(group_cols))]
    per = df.groupBy(*[F.col(g).alias(n) for g, n in zip(group_cols, gnames)], F.col(acc_col).alias("_acc")) \
        .agg(F.count(id_col).alias("_c"))
    # running total over distinct accuracies, descending with nulls last (peers share a value)
    per = running_sum_within_groups(per, gnames, [F.col("_acc").desc_nulls_last()], "_c", out)
    cond = [F.col(g).eqNullSafe(F.col(n)) for g, n in zip(group_cols, gnames)] + [F.col(acc_col).eqNullSafe(F.col("_acc"))]
    return df.join(per.drop("_c"), cond, "left").drop(*gnames, "_acc")


# ---------------------------------------------------------------- candidates
def candidate_set(df: DataFrame, cat_col: str = "cat_id", decisions_col: str = "usDecCatId") -> DataFrame:
    """Decision ids extended with the ``-``-separated category ids (no repeats), and
    ``setNext``: union of decisions, decided, next-best and next-best-id arrays.
    Missing array columns count as empty; null arrays are read as empty."""
    cols = set(df.columns)

    def arr(c: str) -> Column:
        return F.col(c) if c in cols else F.array().cast("array<string>")

    decisions = F.array_distinct(arrays.union_all(F.split(F.col(cat_col), C.CATEGORY_ID_SEPARATOR), arr(decisions_col)))
    out = df.withColumn(decisions_col, decisions)
    if "nextBestCat" in cols:
        out = out.withColumn("nextBestCat1", arrays.empty_if_null(F.col("nextBestCat")))
    return out.withColumn("setNext", arrays.union_all(F.col(decisions_col), arr("decCatId"), arr("nextBestCat"),
                                                      arr("nextBest_catId")))


def explode_scores(df: DataFrame, arr_col: str = "dec_cat") -> DataFrame:
    """One row per scored category (rows with null or empty arrays kept once),
    with the category id and score read from each JSON element."""
    out = df.withColumn("cat", F.explode_outer(arr_col))
    parsed = F.from_json(F.col("cat"), SCORE_SCHEMA)
    return out.withColumns({"cat_id": parsed["catId"], "cat_wt": parsed["score"]})


def score_json(id_col: str | Column, score_col: str | Column) -> Column:
    """``{"catId": ..., "score": ...}`` as JSON text."""
    i = F.col(id_col) if isinstance(id_col, str) else id_col
    s = F.col(score_col) if isinstance(score_col, str) else score_col
    return F.to_json(F.struct(i.alias("catId"), s.alias("score")))


# ---------------------------------------------------------------- enrichment
def enrich_with_tree(df: DataFrame, tree: DataFrame, key: str = "catId") -> DataFrame:
    """Left join to the category tree.  No hint: the planner broadcasts the tree
    when its size statistics are under the broadcast threshold (and AQE re-checks
    at run time); a large tree falls back to a shuffled join."""
    return df.join(tree, [key], "left")


def categorize(batch: DataFrame, decisions: DataFrame, tree: DataFrame, join_key: str,
               decision_key: str | None = None, tie_col: str | None = None,
               batch_keys: DataFrame | None = None, map_rows: bool | None = None) -> DataFrame:
    """Full categorization of one batch of transactions.

    ``decisions`` is the raw decision map (``udCat`` JSON, ``cat_id``, optional
    ``dec_cat`` / ``decCatId`` / ``nextBestCat`` / ``nextBest_catId`` /
    ``nextBest0`` + ``catWt0`` / ``subT_create`` / ``subT``); it is joined to the
    valid transactions on ``join_key`` (left); scores are exploded and the tree
    is joined.  A map with any of ``MAP_SINGLES`` gives a transaction one row for
    every distinct row of values of its key (``map_rows_per_key``); a map whose
    columns can be united is brought to one row per key (``decisions_per_key``).
    ``map_rows`` chooses one of the two for any map.

    Every row gets ``Var``, ``tranT1`` (original text) and the normalized
    ``tranT``; rows that fail the completeness check get nulls in every other
    derived column, exactly as the split + ``unionByName`` of
    the source job gives, but in one pass: the rules and joins apply only where
    ``Var = 1`` (conditional columns and a conditional join predicate), so the
    input is computed once instead of once per branch.

    ``batch_keys``: a persisted frame with at least the batch's ``join_key``
    values (the raw micro-batch); only map rows whose key occurs there are kept
    (a semi join), before anything is aggregated.  Further keys in it do no harm.
    """
    flagged = completeness(batch)
    ok = F.col("Var") == 1
    dkey = decision_key or join_key
    if dkey not in decisions.columns or join_key not in flagged.columns:
        raise ValueError(f"join keys not found: transactions need {join_key!r}, the decision map {dkey!r}")

    # every row keeps its original text and is normalized (before the split, as in
    # the source job); tokens and rules apply to valid rows only
    flagged = normalize(flagged)
    parts = F.split(F.col("tranT"), C.TOKEN_SPLIT_PATTERN)
    flagged = flagged.withColumns({f"TT_{i}": F.when(ok, F.get(parts, i)) for i in range(5)})
    flagged = flagged.withColumn("counP_Name_TT", F.when(ok, text.counterparty(
        [f"TT_{i}" for i in range(5)], "payType", "tranT")))

    # decisions: cut to the batch's keys, one row per key, many-to-one join
    dm = prepare_decision_map(decisions)
    dm = dm.withColumn("udId", guard_decision("udId", "cat_id")).withColumnRenamed(dkey, "_dkey")
    if batch_keys is not None:
        keys = batch_keys.select(F.col(join_key).alias("_bkey")).distinct()
        dm = dm.join(keys, dm["_dkey"].eqNullSafe(keys["_bkey"]), "left_semi")
    if map_rows is None:
        map_rows = bool(MAP_SINGLES & set(dm.columns))
    dm = dm.withColumns({c: list_column(dm, c) for c in MAP_LISTS if c in dm.columns})
    if map_rows:
        per_key = map_rows_per_key(dm, "_dkey", tie_col=tie_col)
    else:
        per_key = decisions_per_key(dm, "_dkey", tie_col=tie_col)
    per_txn = flagged.join(per_key, flagged[join_key].eqNullSafe(per_key["_dkey"]) & ok, "left").drop("_dkey")
    per_txn = per_txn.withColumn("usDecCatId", F.when(ok, arrays.empty_if_null(F.col("usDecCatId"))))
    if "cat_id" not in per_txn.columns:
        per_txn = per_txn.withColumn("cat_id", F.lit(None).cast("string"))

    cands = candidate_set(per_txn)
    cands = cands.withColumns({c: F.when(ok, F.col(c)) for c in ("usDecCatId", "setNext", "nextBestCat1")
                               if c in cands.columns})
    if {"nextBest0", "catWt0"} <= set(cands.columns):
        cands = cands.withColumn("nextBest0", F.when(ok, score_json("nextBest0", "catWt0")))
    if "dec_cat" in cands.columns:
        cands = explode_scores(cands)
    # the category id is the tree key (the output rename of cat_id -> catId is then a no-op)
    return enrich_with_tree(cands.withColumnRenamed("cat_id", "catId"), tree, "catId")
