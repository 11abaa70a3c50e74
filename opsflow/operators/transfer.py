"""Manifest-driven table transfer: lookup, dated location, load gate,
dynamic projection, audit and error rows, and the per-table job."""

from __future__ import annotations

import datetime as dt
import threading
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import wall_clock
from ..sources import files, jdbc

#: appends to one folder share its temporary folder, so those of concurrent tables go one at a time
_AUDIT_COPY = threading.Lock()


def select_process(manifest: DataFrame, process_name: str) -> DataFrame:
    """Manifest rows of one process, name compared ignoring case."""
    return manifest.filter(F.lower(F.col("PROCESS_NAME")) == process_name.lower())


def resolved_location(run_date: Column, base: str = "STORAGE_LOCATION", indicator: str = "M_INDICATOR") -> Column:
    """Base path for indicator null or ``m``; else the ``year=/month=/day=`` folder of ``run_date``."""
    ind = F.col(indicator)
    dated = F.concat(F.col(base), F.lit("/year="), F.date_format(run_date, "yyyy"), F.lit("/month="),
                     F.date_format(run_date, "MM"), F.lit("/day="), F.date_format(run_date, "dd"), F.lit("/"))
    return F.when(ind.isNull() | (F.lower(ind) == C.BASE_PATH_INDICATOR), F.col(base)).otherwise(dated)


def run_date_for(process_name: str, today: dt.date,
                 previous_day_processes: tuple[str, ...] = C.PREVIOUS_DAY_PROCESSES) -> dt.date:
    """Named processes read yesterday's folder, all others today's."""
    upper = {p.upper() for p in previous_day_processes}
    return today - dt.timedelta(days=1) if process_name.upper() in upper else today


def project(spark: SparkSession, df: DataFrame, column_list: str | None, where_clause: str | None) -> DataFrame:
    """Dynamic projection and predicate from manifest text (trusted input).

    Null column list = all columns; null filter = no filter.  The text goes
    through the SQL parser, so column pruning and filter pushdown still apply.
    """
    def plain(text: str) -> str:      # braces of the manifest text are not frame names
        return text.replace("{", "{{").replace("}", "}}")

    cols = plain(column_list) if column_list and column_list.strip() else "*"
    sql = f"SELECT {cols} FROM {{src}}"
    if where_clause and where_clause.strip():
        sql += f" WHERE {plain(where_clause)}"
    return spark.sql(sql, src=df)


def finished_today(audit: DataFrame, load_date: Column, table_col: str = "TableName") -> DataFrame:
    """Audit rows marking a finished load on ``load_date``."""
    return audit.filter((F.col("Status") == C.AUDIT_FINISHED) & (F.col("LoadDate") == load_date)).select(table_col)


def load_gate(manifest: DataFrame, audit: DataFrame, load_date: Column, table_col: str = "DEST_TABLE_NAME",
              audit_table_col: str = "TableName") -> DataFrame:
    """Manifest rows whose table has no finished audit row for the day (left anti join).
    The audit side is reduced to distinct table names first (partial aggregate),
    so a table with many audit rows is not a hot join key."""
    done = finished_today(audit, load_date, audit_table_col).distinct()
    return manifest.join(done, manifest[table_col] == done[audit_table_col], "left_anti")


def finished_count(audit: DataFrame, table: str, load_date: Column) -> DataFrame:
    """One-row frame: number of finished audit rows of one table on the day."""
    done = finished_today(audit, load_date).filter(F.col("TableName") == table)
    return done.agg(F.count(F.lit(1)).alias("count"))


def audit_rows(tables: DataFrame, status: str, load_date: Column, processed_at: Column,
               table_col: str = "TableName", process_col: str | None = None) -> DataFrame:
    """Audit rows (TableName, LoadDate, Status, ProcessDateTime[, process_name]).
    Values are columns, never text spliced into SQL."""
    cols = [F.col(table_col).cast("string").alias("TableName"), load_date.alias("LoadDate"),
            F.lit(status).alias("Status"), processed_at.alias("ProcessDateTime")]
    if process_col:
        cols.insert(1, F.col(process_col).alias("process_name"))
    return tables.select(*cols)


def error_rows(errors: DataFrame, table_col: str, time_col: str, message_col: str) -> DataFrame:
    """Error rows (TableName, start_time, error)."""
    return errors.select(F.col(table_col).cast("string").alias("TableName"),
                         F.col(time_col).alias("start_time"), F.col(message_col).cast("string").alias("error"))


@dataclass
class Destination:
    """JDBC destination with the audit table; ``audit_folder/<yyyyMMdd of the run>``
    receives the file copy of the audit rows."""

    url: str
    options: dict[str, str]
    audit_folder: str
    batchsize: int | None = None


def _audit(spark: SparkSession, row, dest: Destination, process_name: str, status: str, today: dt.date,
           processed_at: dt.datetime) -> None:
    """One audit row in the destination's audit table, and its copy in the run's folder."""
    one = spark.range(1).select(F.lit(row.DEST_TABLE_NAME).alias("TableName"), F.lit(process_name).alias("p"))
    load_date, ts = F.lit(today), wall_clock(processed_at)
    jdbc.write_table(audit_rows(one, status, load_date, ts), dest.url, row.DEST_AUDIT_TABLENAME, "append",
                     options=dest.options)
    copy = audit_rows(one, status, load_date, ts, process_col="p")
    with _AUDIT_COPY:
        copy.write.mode("append").parquet(f"{dest.audit_folder}/{processed_at.strftime('%Y%m%d')}")


def transfer_table(spark: SparkSession, row, dest: Destination, process_name: str, today: dt.date,
                   processed_at: dt.datetime,
                   previous_day_processes: tuple[str, ...] = C.PREVIOUS_DAY_PROCESSES, gate: bool = True) -> bool:
    """Run one manifest row: gate, read, project, audit Started, write, audit Finished.

    Returns False when the table was already finished today (``gate=False``: the
    caller has asked the audit table).  The gate is a check-then-act: two
    concurrent runs may both load (at-least-once).  Audit rows always append,
    whatever the table's write mode.
    """
    if gate:
        audit = jdbc.read_table(spark, dest.url, row.DEST_AUDIT_TABLENAME, dest.options)
        if finished_count(audit, row.DEST_TABLE_NAME, F.lit(today)).first()["count"] > 0:
            return False
    run_date = run_date_for(process_name, today, previous_day_processes)
    src = files.read_dated(spark, row.SOURCE_TYPE, row.STORAGE_LOCATION, row.M_INDICATOR, run_date)
    out = project(spark, src, row.COLUMN_LIST, row.WHERE_CLAUSE)
    _audit(spark, row, dest, process_name, C.AUDIT_STARTED, today, processed_at)
    jdbc.write_table(out, dest.url, row.DEST_TABLE_NAME, row.DEST_WRITE_MODE or "append", dest.batchsize,
                     dest.options)
    _audit(spark, row, dest, process_name, C.AUDIT_FINISHED, today, processed_at)
    return True


def open_tables(spark: SparkSession, chosen: DataFrame, audit_table: str, dest: Destination, today: dt.date) -> set[str]:
    """Destination tables of the chosen manifest rows that ``audit_table`` does not show as finished today, in one query."""
    audit = jdbc.read_table(spark, dest.url, audit_table, dest.options)
    mine = chosen.filter(F.col("DEST_AUDIT_TABLENAME") == audit_table).select("DEST_TABLE_NAME").distinct()
    return {r.DEST_TABLE_NAME for r in load_gate(mine, audit, F.lit(today)).collect()}
