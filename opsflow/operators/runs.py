"""Run bookkeeping for the transfer: process keys, logs, completed / pending /
ready lists, run status, latest attempt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.ranking import number_rows


def parse_process_key(key: str | Column) -> list[Column]:
    """``source~db~table~indicator`` into four columns; missing parts are null."""
    parts = F.split(F.col(key) if isinstance(key, str) else key, C.PROCESS_KEY_SEPARATOR)
    return [F.get(parts, i).alias(n) for i, n in enumerate(["src", "db", "tbl", "indicator"])]


def parse_log_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Lines carrying the ``~#~`` separator: export form (``~``-separated) and fields."""
    kept = lines.filter(F.col(line_col).contains(C.LOG_SEPARATOR))
    parts = F.split(F.col(line_col), C.LOG_SEPARATOR)
    fields = [F.get(parts, i).alias(n) for i, n in enumerate(C.LOG_FIELDS) if not n.startswith("empty")]
    export = F.replace(F.col(line_col), F.lit(C.LOG_SEPARATOR), F.lit(C.LOG_EXPORT_SEPARATOR))
    return kept.select("*", export.alias("export_line"), *fields)


def completed_processes(logs: DataFrame, process: Column, line_col: str = "line") -> DataFrame:
    """Distinct processes with a completion line (marker matched ignoring case), in order."""
    done = logs.filter(F.lower(F.col(line_col)).contains(C.COMPLETION_MARKER.lower()))
    return done.select(process.alias("process")).distinct().orderBy("process")


def pending(wanted: DataFrame, completed: DataFrame, key: str) -> DataFrame:
    """Distinct wanted keys without a completed entry, in order."""
    return wanted.select(key).distinct().join(completed.select(key).distinct(), key, "left_anti").orderBy(key)


def pending_all(wanted: DataFrame, completed: DataFrame, key: str, chunk: int = 10_000) -> DataFrame:
    """List difference keeping repeats: each completed entry cancels one wanted entry
    (the multiset difference of ``EXCEPT ALL``).

    Counts per key are combined map-side, so a hot key costs one row per task
    up to the final count.  The surviving copies are then produced in chunks of
    at most ``chunk`` rows that are spread over the cluster before expansion,
    so no task emits all copies of a hot key.
    """
    counts = (wanted.select(key, F.lit(1).alias("_d"))
              .unionByName(completed.select(key, F.lit(-1).alias("_d")))
              .groupBy(key).agg(F.sum("_d").alias("_n"))
              .filter(F.col("_n") > 0))
    chunks = counts.select(key, "_n", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / chunk))).alias("_c"))
    size = F.least(F.lit(chunk), F.col("_n") - F.col("_c") * chunk)
    spread = chunks.repartition(key, "_c")
    return spread.select(key, F.explode(F.array_repeat(F.lit(True), size.cast("int"))).alias("_x")).drop("_x")


def numbered(df: DataFrame, order: list[str | Column], name_col: str, out: str = "line") -> DataFrame:
    """``"<n>. <name>"`` in list order, numbered without a single-task window."""
    pos = number_rows(df, order, "position")
    return pos.withColumn(out, F.concat(F.col("position").cast("string"), F.lit(". "), F.col(name_col).cast("string")))


def marker_prefix(src: Column, db: Column, tbl: Column) -> Column:
    return F.concat_ws("-", F.lit(C.MARKER_PREFIX), src, db, tbl)


def readiness(wanted: DataFrame, markers: DataFrame, marker_col: str = "marker") -> DataFrame:
    """Adds ``ready``: indicator ``t`` needs a marker whose name starts with
    ``success-src-db-table`` (so ``table1`` also matches ``table10``); other
    indicators are ready at once.

    The prefix test is an equi-join: each marker name is cut to the prefix
    lengths that occur among the keys that need one (a set bounded by the longest
    key), so no marker x key pairs are formed.  Names are first cut to the longest
    of these lengths, which drops their dates, and only the distinct ones are cut
    on; repeated names and cuts are combined before they are shuffled, so neither
    the number of loads of a table nor a short prefix of many names grows a task.
    """
    w = wanted.withColumn("_prefix", marker_prefix(F.col("src"), F.col("db"), F.col("tbl")))
    needs = F.coalesce(F.col("indicator"), F.lit("")) == C.READY_ON_MARKER_INDICATOR     # exact case
    asked = w.filter(needs).select("_prefix").distinct()
    lengths = sorted(r[0] for r in asked.select(F.length("_prefix")).distinct().collect() if r[0] is not None)
    m = markers.select(F.left(F.col(marker_col), F.lit(lengths[-1] if lengths else 0)).alias("_m")).distinct()
    cuts = F.filter(F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>"),
                    lambda n: n <= F.length("_m"))
    found = (m.select(F.explode(F.transform(cuts, lambda n: F.left(F.col("_m"), n))).alias("_prefix"))
             .distinct().join(asked, "_prefix", "left_semi").withColumn("_hit", F.lit(True)))
    joined = w.join(found, "_prefix", "left")
    ready = F.when(needs, F.coalesce(F.col("_hit"), F.lit(False))).otherwise(F.lit(True))
    return joined.withColumn("ready", ready).drop("_prefix", "_hit")


def run_status(states: DataFrame, group_cols: list[str], past_deadline: Column) -> DataFrame:
    """Per group, from rows with booleans ``pending`` (transfer not done) and
    ``ready`` (ingestion done): counts and the run status.

    No pending -> SUCCESS; past deadline -> FAILED; nothing ready -> PENDING;
    else RUNNING.
    """
    agg = states.groupBy(*group_cols).agg(
        F.count_if(F.col("pending")).alias("transfer_pending"),
        F.count_if(F.col("pending") & ~F.col("ready")).alias("ingestion_pending"),
        F.count_if(F.col("pending") & F.col("ready")).alias("ingestion_completed"),
    )
    status = (F.when(F.col("transfer_pending") == 0, F.lit("SUCCESS"))
              .when(past_deadline, F.lit("FAILED"))
              .when(F.col("ingestion_completed") == 0, F.lit("PENDING"))
              .otherwise(F.lit("RUNNING")))
    return agg.withColumn("status", status)


def latest_attempt(df: DataFrame, job_col: str, start_col: str, cols: list[str]) -> DataFrame:
    """Per job, the attempt with the latest start time, of equal times the one with
    the largest ``cols`` (one partial aggregate)."""
    best = F.max(F.struct(F.col(start_col), *[F.col(c) for c in cols])).alias("_b")
    return df.groupBy(job_col).agg(best).select(job_col, "_b.*")
