"""Cluster usage report from landed cluster, audit-event and metric documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import wall_clock
from ..functions.ranking import number_rows

SECONDS_A_DAY = 86400

CLUSTER_SCHEMA = (
    "Id string, NormalizedInstanceHours int, Status struct<State: string, "
    "Timeline: struct<CreationDateTime: timestamp_ntz, ReadyDateTime: timestamp_ntz, EndDateTime: timestamp_ntz>>"
)
EVENT_SCHEMA = "Username string, CloudTrailEvent string, EventName string, EventTime timestamp_ntz"
TRAIL_SCHEMA = "responseElements map<string, string>"
CLUSTER_PAGE = f"Clusters array<struct<{CLUSTER_SCHEMA}>>"
EVENT_PAGE = f"Events array<struct<{EVENT_SCHEMA}>>"


def flatten_clusters(docs: DataFrame) -> DataFrame:
    """Nested cluster documents to flat rows; absent id and state become ''."""
    tl = F.col("Status.Timeline")
    return docs.select(
        F.coalesce(F.col("Id"), F.lit("")).alias("ClusterId"),
        F.col("NormalizedInstanceHours"),
        tl["ReadyDateTime"].alias("ReadyDateTime"),
        tl["CreationDateTime"].alias("CreationDateTime"),
        tl["EndDateTime"].alias("EndDateTime"),
        F.coalesce(F.col("Status.State"), F.lit("")).alias("State"),
    )


def filter_clusters(clusters: DataFrame, states: list[str], created_after: Column) -> DataFrame:
    """Clusters in one of ``states`` created at or after ``created_after``."""
    return clusters.filter(F.col("State").isin(states) & (F.col("CreationDateTime") >= created_after))


def launch_events(events: DataFrame, since: Column, time_col: str = "EventTime",
                  name_col: str = "EventName") -> DataFrame:
    """Audit events that start a cluster (by event name), at or after ``since``."""
    return events.filter((F.col(name_col) == C.LAUNCH_EVENT) & (F.col(time_col) >= since))


def creator_extract(events: DataFrame) -> DataFrame:
    """Creator user and cluster id from the audit event's embedded JSON text.
    An empty or absent ``responseElements`` gives the text "No responseElements"."""
    re_ = F.from_json(F.col("CloudTrailEvent"), TRAIL_SCHEMA)["responseElements"]
    cid = F.when(re_.isNull() | (F.size(re_) == 0), F.lit(C.NO_RESPONSE_ELEMENTS)) \
        .otherwise(F.coalesce(re_["jobFlowId"], F.lit("")))
    return events.select(F.coalesce(F.col("Username"), F.lit("")).alias("Username"), cid.alias("ClusterId"))


def with_runtime(clusters: DataFrame, now: Column) -> DataFrame:
    """``runtime`` in seconds: (end, or now while running) - ready; null if never ready."""
    end = F.coalesce(F.col("EndDateTime"), now)
    rt = F.when(F.col("ReadyDateTime").isNotNull(), F.timestamp_diff("SECOND", F.col("ReadyDateTime"), end))
    return clusters.withColumn("runtime", rt)


def runtime_order(clusters: DataFrame, tie_cols: list[str] | None = None) -> DataFrame:
    """``position`` by run time descending, nulls last (ties by ``tie_cols``)."""
    order = [F.col("runtime").desc_nulls_last()] + [F.col(c) for c in (tie_cols or ["ClusterId"])]
    return number_rows(clusters, order, "position")


def metric_period(start: Column, end: Column) -> Column:
    """Seconds of one data point of the metric service for a window: its whole days and four more, at least one day."""
    days = F.floor(F.timestamp_diff("SECOND", start, end) / F.lit(SECONDS_A_DAY))
    return F.greatest(days + F.lit(4), F.lit(1)) * F.lit(SECONDS_A_DAY)


def single_point(average: Column, first: Column, last: Column, period: Column) -> Column:
    """``average`` if the points from ``first`` to ``last`` lie in one period, else null.  Periods are tumbling and
    start at the epoch, so points lie in one if their first and last do."""
    epoch = wall_clock(dt.datetime(1970, 1, 1))

    def slot(ts: Column) -> Column:
        return F.floor(F.timestamp_diff("SECOND", epoch, ts) / period)

    return F.when(slot(first) == slot(last), average)


def idle_windows(points: DataFrame, now: Column, clusters: DataFrame | None = None, id_col: str = "ClusterId",
                 ts_col: str = "Timestamp", value_col: str = "IsIdle") -> DataFrame:
    """Average idle value per cluster over its lifetime, the last 12 h and the last 3 h
    (windows ``[start, now]``), as the metric service gives it: it answers with one
    average for each period (``metric_period``, aligned to the epoch) that holds
    points, and only a single answer counts.  Points in two periods, or none,
    give null.

    One pass: conditional averages, first and last times in a single aggregate.
    With ``clusters`` the lifetime is ``[ready, end or now]`` (one equi-join on
    the id, no range join); without, it is ``[first point, now]``.
    """
    ts, v = F.col(ts_col), F.col(value_col)
    if clusters is not None:
        bounds = clusters.select(F.col("ClusterId").alias("_cid"), F.col("ReadyDateTime").alias("_ready"),
                                 F.coalesce(F.col("EndDateTime"), now).alias("_end"))
        points = points.join(bounds, points[id_col] == bounds["_cid"])
    else:
        points = points.withColumns({"_ready": F.lit(None).cast("timestamp_ntz"), "_end": now})
    within = F.col("_ready").isNotNull() & (ts >= F.col("_ready")) & (ts <= F.col("_end"))
    windows = {"idle_pct": within if clusters is not None else F.lit(True)}
    for name, hours in (("idle_pct_12h", 12), ("idle_pct_3h", 3)):
        windows[name] = (ts >= now - F.make_dt_interval(hours=F.lit(hours))) & (ts <= now)
    aggs = [F.max("_ready").alias("_from"), F.max("_end").alias("_to")]
    for name, inside in windows.items():
        aggs += [F.avg(F.when(inside, v)).alias(name), F.min(F.when(inside & v.isNotNull(), ts)).alias(f"{name}_first"),
                 F.max(F.when(inside & v.isNotNull(), ts)).alias(f"{name}_last")]
    got = points.groupBy(id_col).agg(*aggs)
    start = F.col("_from") if clusters is not None else F.col("idle_pct_first")
    period = {"idle_pct": metric_period(start, F.col("_to"))}
    for name, hours in (("idle_pct_12h", 12), ("idle_pct_3h", 3)):
        period[name] = metric_period(now - F.make_dt_interval(hours=F.lit(hours)), now)
    return got.select(id_col, *[single_point(F.col(name), F.col(f"{name}_first"), F.col(f"{name}_last"), period[name]).alias(name)
                                for name in windows])


def cluster_report(clusters: DataFrame, creators: DataFrame, idle: DataFrame | None = None,
                   rate: float | None = None) -> DataFrame:
    """Clusters left-joined to creator events (repeated events repeat the cluster),
    idle figures added, fixed column order, ``position`` by hours descending
    (nulls last).  ``ApproxCost`` = hours x rate, null without a rate."""
    rep = clusters.join(creators, "ClusterId", "left")
    if idle is not None:
        rep = rep.join(idle, "ClusterId", "left")
    for c in ("runtime", "idle_pct", "idle_pct_12h", "idle_pct_3h"):
        if c not in rep.columns:
            rep = rep.withColumn(c, F.lit(None).cast("double" if c.startswith("idle") else "bigint"))
    cost = F.col("NormalizedInstanceHours") * F.lit(rate) if rate is not None else F.lit(None).cast("double")
    rep = rep.withColumn("ApproxCost", cost).select(*C.REPORT_COLUMNS)
    order = [F.col("NormalizedInstanceHours").desc_nulls_last(), F.col("ClusterId"), F.col("Username")]
    return number_rows(rep, order, "position")
