"""Global row numbering without moving all rows into one task.

``Window.orderBy(...)`` without a partition pulls every row into a single task.
Here the rows are range-partitioned by the sort (Spark samples the bounds, so a
hot value range is split), each row gets a partition-local index, and the
per-partition row counts (one row per partition, a proven size bound) give the
offsets.  The sorted, tagged rows are checkpointed to the shared checkpoint
folder first, so the counting job and the final job see the same partitions
even when an executor is lost and a stage is recomputed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

_LOCAL_BITS = 33  # monotonically_increasing_id: partition index in the upper bits


def number_rows(df: DataFrame, order: list[str | Column], name: str = "position") -> DataFrame:
    """Add a 1-based position following ``order`` (ties in any fixed order)."""
    checkpoint_root(df.sparkSession)
    tagged = df.orderBy(*order).withColumn("_rid", F.monotonically_increasing_id())
    tagged = tagged.checkpoint(eager=True)
    tagged = tagged.select(
        "*",
        F.shiftright("_rid", _LOCAL_BITS).alias("_pid"),
        F.col("_rid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("_loc"),
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_pid")
    return out.select(
        *[c for c in df.columns],
        (F.col("_off") + F.col("_loc") + 1).alias(name),
    )


def number_within_groups(df: DataFrame, group_cols: list[str], order: list[str | Column],
                         name: str = "position") -> DataFrame:
    """Add a 1-based position within each group following ``order``.

    Same idea as ``number_rows``: one global range-partitioned sort by
    (group, order), so a hot group is spread over many partitions; per
    (partition, group) counts give each group's offset in each partition.  The
    offset table has at most one row per (group, partition) pair, and the join
    back is keyed by partition and group, so no task holds a whole group.
    """
    checkpoint_root(df.sparkSession)
    tagged = (df.orderBy(*[F.col(g) for g in group_cols], *order)
              .withColumn("_rid", F.monotonically_increasing_id()).checkpoint(eager=True))
    tagged = tagged.select(
        "*",
        F.shiftright("_rid", _LOCAL_BITS).alias("_pid"),
        F.col("_rid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("_loc"),
    )
    gk = [f"_g{i}" for i in range(len(group_cols))]
    per = tagged.groupBy("_pid", *[F.col(g).alias(k) for g, k in zip(group_cols, gk)]).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_loc").alias("_first"))
    before = Window.partitionBy(*gk).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("_pid").alias("_ppid"), *gk, "_first",
                     F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    cond = [tagged["_pid"] == per["_ppid"]] + [tagged[g].eqNullSafe(per[k]) for g, k in zip(group_cols, gk)]
    out = tagged.join(per, cond)
    return out.select(*[tagged[c] for c in df.columns],
                      (F.col("_off") + F.col("_loc") - F.col("_first") + 1).alias(name))


def running_sum_within_groups(df: DataFrame, group_cols: list[str], order: list[str | Column], value_col: str,
                              name: str = "running") -> DataFrame:
    """Running sum of ``value_col`` within each group following ``order`` (each
    row includes itself and every row before it).

    A distributed prefix sum: rows are range-partitioned by (group, order) and
    checkpointed; within a partition the sum runs over that partition's slice
    of the group only, and each (group, partition) slice is offset by the totals
    of the group's earlier slices (at most one row per group and partition).
    """
    checkpoint_root(df.sparkSession)
    tagged = (df.orderBy(*[F.col(g) for g in group_cols], *order)
              .withColumn("_rid", F.monotonically_increasing_id()).checkpoint(eager=True))
    tagged = tagged.select("*", F.shiftright("_rid", _LOCAL_BITS).alias("_pid"))
    local = Window.partitionBy("_pid", *group_cols).orderBy("_rid").rowsBetween(Window.unboundedPreceding,
                                                                                 Window.currentRow)
    tagged = tagged.withColumn("_local", F.sum(value_col).over(local))
    gk = [f"_g{i}" for i in range(len(group_cols))]
    per = tagged.groupBy("_pid", *[F.col(g).alias(k) for g, k in zip(group_cols, gk)]).agg(
        F.sum(value_col).alias("_tot"))
    before = Window.partitionBy(*gk).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("_pid").alias("_ppid"), *gk, F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_off"))
    cond = [tagged["_pid"] == per["_ppid"]] + [tagged[g].eqNullSafe(per[k]) for g, k in zip(group_cols, gk)]
    out = tagged.join(per, cond)
    return out.select(*[tagged[c] for c in df.columns], (F.col("_off") + F.col("_local")).alias(name))
