"""Latest-message filter.

Semantics: within each group of trimmed key columns, keep every row whose order
value equals the group's greatest value (``rank() == 1`` over a descending order):
ties are all kept, null keys form one group, and a group whose order values are
all null keeps all its rows.

Plan: a partial+final ``max`` per key (map-side combine, so a hot key costs one
row per map task) and a left-semi join back on the keys *and* the order value
with null-safe equality.  Joining on the order value too spreads a hot key over
the shuffle by its time values; AQE splits what is left (ties at the maximum).
No group is ever sorted or buffered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_messages(df: DataFrame, keys: list[str | Column], order: str | Column,
                    rank_col: str | None = "msg_number") -> DataFrame:
    key_cols = [F.trim((F.col(k) if isinstance(k, str) else k).cast("string")) for k in keys]
    order_col = F.col(order) if isinstance(order, str) else order
    names = [f"_lk{i}" for i in range(len(key_cols))]
    tagged = df.select("*", *[k.alias(n) for k, n in zip(key_cols, names)], order_col.alias("_lo"))
    best = tagged.groupBy(*names).agg(F.max("_lo").alias("_best"))
    cond = [tagged[n].eqNullSafe(best[n]) for n in names] + [tagged["_lo"].eqNullSafe(best["_best"])]
    kept = tagged.join(best, cond, "left_semi").select(*df.columns)
    if rank_col:
        kept = kept.withColumn(rank_col, F.lit(1))
    return kept
