"""Whole jobs composed from the operators: what a user of the source jobs runs.

* ``dashboard_run``: today's status per use case, the history, month-to-date
  percentages, the ordered matrix, failure list and report rows, then the
  roll-over of today into the history and a snapshot of the inputs.
* ``cluster_report_run``: landed cluster, audit-event and metric documents to
  the ordered report, written as CSV under a time-stamped folder.
* ``transfer_round``: one pass of the transfer wrapper: completed, pending and
  ready processes from logs and markers, the run status, then the transfer of
  every ready process's manifest rows.
* The categorization stream is started with ``streaming.categorize_stream.start_feed``.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import wall_clock
from ..operators import clusters as cl
from ..operators import runs, status, transfer
from ..sources import files, sinks

RAW_FIELDS = {"usecase": 1, "category": 8}
MASTER_FIELDS = {"usecase": 1, "SLA": 2, "FREQ": 3}


@dataclass
class DashboardOutput:
    dashboard: DataFrame      # ordered matrix with MTD, MTD-DL and position
    failures: DataFrame       # raw lines without SUCCESS
    report: DataFrame         # dashboard rows rendered as table rows
    tally: DataFrame          # status codes per use case over the matrix days


def _raw_rows(spark: SparkSession, raw_path: str) -> DataFrame:
    """Raw status lines with their fields and input order: file path, start of the
    block, then the row within it (file splits are not scheduled in path order)."""
    lines = spark.read.text(raw_path).select(F.col("value").alias("line"), F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("row")).alias("line_no"))
    parts = F.split("line", ",")
    return lines.select("line", "line_no", *[F.get(parts, pos - 1).alias(name) for name, pos in RAW_FIELDS.items()])


def dashboard_run(spark: SparkSession, master_path: str, raw_path: str, history_folder: str,
                  snapshot_folder: str, report_date: dt.date, run_ts: str, days: int | None = None,
                  scope: str = "month", report_folder: str | None = None, whole_line: bool = False,
                  collation: str | None = None) -> DashboardOutput:
    """One dashboard run, over all days of the history or the last ``days``.  With ``report_folder``, the ordered matrix is written
    as CSV with the header ``USECASE,SLA,FREQ,MTD,MTD-DL,<yyyyMMdd per day>`` and
    the failure lines as text, both under ``run_ts=<run_ts>``.  ``whole_line``
    finds a use case as whole words anywhere in a raw line instead of in its
    first field; ``collation`` orders the lines (see ``dashboard_order``).  Raw
    lines, master and the ordered matrix are kept as snapshots of the run.  The
    raw lines and today's status are used several times and are persisted for
    the run."""
    master = files.read_positional_csv(spark, master_path, MASTER_FIELDS)
    raw = _raw_rows(spark, raw_path).persist()
    found = (status.daily_status_words(master, raw, "line_no") if whole_line
             else status.daily_status(master, raw, "usecase", "category", "line_no"))
    today = found.select("usecase", F.lit(report_date).alias("report_date"), "category").persist()
    try:
        return _dashboard(spark, master, raw, today, history_folder, snapshot_folder, report_date, run_ts, days, scope,
                          report_folder, collation)
    finally:      # a later run on the same paths must read them again
        today.unpersist()
        raw.unpersist()


def _dashboard(spark: SparkSession, master: DataFrame, raw: DataFrame, today: DataFrame, history_folder: str,
               snapshot_folder: str, report_date: dt.date, run_ts: str, days: int | None, scope: str,
               report_folder: str | None, collation: str | None) -> DashboardOutput:
    try:
        history = spark.read.parquet(history_folder).filter(F.col("report_date") != F.lit(report_date))
        long = history.select("usecase", "report_date", "category").unionByName(today)
    except AnalysisException as e:       # first run: no history folder yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        long = today
    if days is None:                     # every day that the history has, one column each
        kept = long.select("report_date").distinct().collect()
        dates = sorted((r.report_date for r in kept if r.report_date is not None), reverse=True)
    else:
        dates = [report_date - dt.timedelta(days=i) for i in range(days)]
    mtd = status.mtd_success(long, ["usecase"], report_date, scope)
    matrix = status.status_matrix(long, dates, master=master)
    wide = (matrix.join(mtd, "usecase", "left")
            .select("usecase", "SLA", "FREQ", F.col("mtd").alias("MTD"), F.col("mtd_dl").alias("MTD_DL"),
                    *[status.day_column(d) for d in dates]))
    cols = ["usecase", "SLA", "FREQ", "MTD", "MTD_DL", *[status.day_column(d) for d in dates]]
    ordered = status.dashboard_order(wide, "FREQ", "MTD", "usecase", line_cols=cols, collation=collation)
    report = status.report_rows(ordered, cols)
    failures = status.failure_list(raw.select("line"))
    tally = status.code_tally(long.filter(F.col("report_date").isin(dates)), ["usecase"])
    if report_folder:
        header = {"usecase": "USECASE", "MTD_DL": "MTD-DL",
                  **{status.day_column(d): d.strftime("%Y%m%d") for d in dates}}
        table = ordered.orderBy("position").select(*cols).withColumnsRenamed(header)
        sinks.write_report_csv(table, f"{report_folder}/dashboard", run_ts)
        failures.write.mode("overwrite").text(f"{report_folder}/failures/run_ts={run_ts}")
    # inputs and result are kept under the run's time stamp; today becomes history (idempotent per day)
    result = ordered.select(F.lit(report_date).alias("report_date"), "position", "usecase", "SLA", "FREQ", "MTD", "MTD_DL",
                            F.map_from_arrays(F.array(*[F.lit(d) for d in dates]),
                                              F.array(*[F.col(status.day_column(d)) for d in dates])).alias("days"))
    sinks.snapshot(result, f"{snapshot_folder}/matrix", run_ts)
    status.rollover(today, history_folder)
    sinks.snapshot(raw.select("line"), f"{snapshot_folder}/raw", run_ts)
    sinks.snapshot(master, f"{snapshot_folder}/master", run_ts)
    return DashboardOutput(ordered, failures, report, tally)


def cluster_report_run(spark: SparkSession, clusters_path: str, events_path: str, metrics_path: str,
                       now: dt.datetime, out_folder: str, run_ts: str, states: list[str] | None = None,
                       info_days: int = C.INFO_DAYS, rate: float | None = None, paged: bool = False) -> DataFrame:
    """The report over landed documents.  ``paged``: cluster and event documents are result pages
    (``files.read_pages``); else there is one cluster or event per line."""
    now_c = wall_clock(now)
    clusters = (files.read_pages(spark, clusters_path, cl.CLUSTER_PAGE, "Clusters", "Marker") if paged
                else files.read_cluster_docs(spark, clusters_path, cl.CLUSTER_SCHEMA))
    flat = cl.flatten_clusters(clusters)
    since = now_c - F.make_dt_interval(days=F.lit(info_days))
    recent = cl.filter_clusters(flat, states or C.DEFAULT_CLUSTER_STATES, since)
    recent = cl.with_runtime(recent, now_c)
    events = (files.read_pages(spark, events_path, cl.EVENT_PAGE, "Events", "NextToken") if paged
              else files.read_cluster_docs(spark, events_path, cl.EVENT_SCHEMA))
    creators = cl.creator_extract(cl.launch_events(events, since))
    points = files.read_cluster_docs(spark, metrics_path, "ClusterId string, Timestamp timestamp_ntz, IsIdle double")
    idle = cl.idle_windows(points, now_c, clusters=recent)
    report = cl.cluster_report(recent, creators, idle, rate)
    written = report.orderBy("position").drop("position").withColumnsRenamed(C.REPORT_DISPLAY_NAMES)
    sinks.write_report_csv(written, out_folder, run_ts)
    return report


def _process_of(file_path: str = "file_path", file_name: str = "file_name"):
    """Process key of a log file: a ``process=<key>`` folder, else the file name
    without extension."""
    from_dir = F.url_decode(F.regexp_extract(F.col(file_path), "process=([^/]+)", 1))
    return F.when(from_dir != "", from_dir).otherwise(F.regexp_extract(F.col(file_name), "^([^.]+)", 1))


def transfer_round(spark: SparkSession, wanted: DataFrame, log_folder: str, marker_folder: str | None,
                   past_deadline: bool) -> tuple[DataFrame, DataFrame]:
    """(per-process state, run status).  ``wanted`` holds ``process_key`` rows;
    completed processes come from the logs, readiness from the marker files."""
    try:
        logs = files.read_logs(spark, log_folder)
        done = runs.completed_processes(logs, _process_of()).withColumnRenamed("process", "process_key")
    except AnalysisException as e:       # no log folder yet: nothing completed
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        done = spark.createDataFrame([], "process_key string")
    pend = runs.pending(wanted, done, "process_key").withColumn("pending", F.lit(True))
    state = wanted.select("process_key").distinct().join(pend, "process_key", "left").select(
        "process_key", F.coalesce("pending", F.lit(False)).alias("pending"), *runs.parse_process_key("process_key"))
    markers = (files.list_markers(spark, marker_folder) if marker_folder
               else spark.createDataFrame([], "marker string"))
    state = runs.readiness(state, markers)
    summary = runs.run_status(state.withColumn("_all", F.lit("all")), ["_all"], F.lit(past_deadline)).drop("_all")
    return state, summary


def _log_line(log_id: str, source: str, table: str, stage: str, status_: str, message: str,
              at: dt.datetime) -> str:
    fields = [log_id, source, "", "", table, stage, status_, "", message,
              at.strftime("%Y-%m-%d %H:%M:%S"), at.strftime("%Y-%m-%d")]
    return C.LOG_SEPARATOR.join(fields)


def transfer_ready(spark: SparkSession, state: DataFrame, manifest_path: str, dest: transfer.Destination,
                   today: dt.date, processed_at: dt.datetime,
                   previous_day_processes: tuple[str, ...] = C.PREVIOUS_DAY_PROCESSES,
                   log_folder: str | None = None, error_folder: str | None = None,
                   log_id: str = "0", source: str = "BB", concurrent: int = 4) -> tuple[list[str], list[str]]:
    """Transfer the manifest rows of every pending, ready process.

    Returns (tables loaded, tables failed).  The chosen manifest rows are
    configuration and are read to the driver once.  The gate is one query per
    audit table; then each table is its own Spark job, at most ``concurrent`` at
    a time (the results do not depend on it).  Rows that write to one table run
    one after the other and ask the audit table again.  A failure is recorded as
    an error row (``error_folder/<run date>``) and the other tables go on.  With
    ``log_folder``, ``~#~`` log lines (session, started, success or failed) and
    the completion markers are appended per process; a process with a failed
    table gets no marker, so the next round sees it as pending and the gate skips
    its finished tables.
    """
    ready = state.filter(F.col("pending") & F.col("ready")).select(F.lower("process_key").alias("_p"), "process_key")
    manifest = files.read_manifest(spark, manifest_path)
    chosen = manifest.join(ready, F.lower(F.col("PROCESS_NAME")) == F.col("_p")).drop("_p")
    rows = chosen.orderBy("process_key", "DEST_TABLE_NAME").collect()         # configuration rows, one collect
    gates: dict[str, set[str] | Exception] = {}
    for name in dict.fromkeys(r.DEST_AUDIT_TABLENAME for r in rows):
        try:
            gates[name] = transfer.open_tables(spark, chosen, name, dest, today)
        except Exception as e:  # noqa: BLE001 - recorded for each table that uses this audit table
            gates[name] = e

    def run(row, again: bool) -> bool | Exception:
        """Whether the table was loaded, or what kept it from being loaded."""
        known = gates[row.DEST_AUDIT_TABLENAME]
        if isinstance(known, Exception):
            return known
        if row.DEST_TABLE_NAME not in known:
            return False
        try:
            return transfer.transfer_table(spark, row, dest, row.process_key, today, processed_at,
                                           previous_day_processes, gate=again)
        except Exception as e:  # noqa: BLE001 - recorded, the other tables go on
            return e

    by_table: dict[tuple, list[int]] = {}
    for i, r in enumerate(rows):
        by_table.setdefault((r.DEST_AUDIT_TABLENAME, r.DEST_TABLE_NAME), []).append(i)

    @inheritable_thread_target(spark)
    def run_table(indexes: list[int]) -> list[tuple[int, bool | Exception]]:
        return [(i, run(rows[i], again=n > 0)) for n, i in enumerate(indexes)]

    with ThreadPoolExecutor(max(1, concurrent)) as pool:
        results = dict(x for part in pool.map(run_table, by_table.values()) for x in part)

    loaded, failed, lines, errors, markers, broken = [], [], [], [], [], set()
    for i, row in enumerate(rows):
        table, done = row.DEST_TABLE_NAME, results[i]

        def log(stage: str, state_: str, message: str, row=row, table=table) -> None:
            lines.append((row.process_key, _log_line(log_id, source, table, stage, state_, message, processed_at)))

        log("SPARK_CONNECT", "SUCCESS", "Spark Session Created")
        log("Data Transfer", "STARTED", "Transfer Started")
        if isinstance(done, Exception):
            failed.append(table)
            broken.add(row.process_key)
            errors.append((table, processed_at, str(done)))
            log("Data Transfer", "FAILED", " ".join(str(done).replace(C.LOG_SEPARATOR, " ").split()) or "error")
            continue
        if done:
            loaded.append(table)
            log("Data Transfer", "SUCCESS", "Data Transfer Completed")
        markers.append((row.process_key, f"{C.COMPLETION_MARKER}{table}"))
    lines += [m for m in markers if m[0] not in broken]
    if log_folder and lines:
        (spark.createDataFrame(lines, "process string, value string")
         .write.mode("append").partitionBy("process").text(log_folder))
    if error_folder and errors:
        err = spark.createDataFrame(errors, "TableName string, start_time timestamp_ntz, error string")
        sinks.append_parquet(err, f"{error_folder}/{today.strftime('%Y%m%d')}")
    return loaded, failed
