"""File sinks: audit and error folders, reports, snapshots, history roll-over."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_report_csv(df: DataFrame, folder: str, run_ts: str) -> str:
    """Report as headered CSV under ``folder/run_ts=<run_ts>``; returns the path."""
    path = f"{folder}/run_ts={run_ts}"
    df.write.mode("overwrite").option("header", "true").csv(path)
    return path


def snapshot(df: DataFrame, folder: str, snapshot_ts: str) -> None:
    """Append the frame under a time-stamped partition (inputs and results kept)."""
    df.withColumn("snapshot_ts", F.lit(snapshot_ts)).write.mode("append").partitionBy("snapshot_ts").parquet(folder)


def overwrite_partitions(df: DataFrame, folder: str, partition_col: str) -> None:
    """Replace only the partitions present in ``df``: re-running a day is idempotent."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(folder))


def export_log_lines(parsed: DataFrame, folder: str, run_date: str, line_col: str = "export_line") -> None:
    """Append the ``~``-separated export form of the log lines to the run date's folder."""
    parsed.select(F.col(line_col).alias("value")).write.mode("append").text(f"{folder}/run_date={run_date}")
