"""Frame helpers shared by the operators: column checks, tables in shared scratch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import scratch_path

#: Paths of the scratch tables written inside each open ``settled`` call, innermost last.
_OPEN: list[list[str]] = []


def need(df: DataFrame, *columns: str) -> None:
    """Raise for missing columns, with their names."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")


def write_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a table under the shared checkpoint folder; the table read back, and its path."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if _OPEN:
        _OPEN[-1].append(path)
    return spark.read.schema(df.schema).parquet(path), path


def write_and_read(df: DataFrame, name: str) -> DataFrame:
    """Write a table under the shared checkpoint folder and read it back: a
    lineage cut that outlives lost executors."""
    return write_table(df, name)[0]


#: Bounds of an Arrow batch of whole texts: a task holds a batch in the JVM and in its Python worker.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2000


def bound_batches(spark: SparkSession) -> None:
    """Lower this session's bounds on Arrow batches to ``BATCH_BYTES`` and ``BATCH_ROWS``; smaller ones stay.

    Spark's own bounds (64 MB, 10,000 rows) suit narrow rows; with several text
    stages in one application the batches of long texts fill the memory that
    executors have beside their heap.  Results do not depend on it."""
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)):
        now = spark.conf.get(key, None)
        digits = "".join(c for c in now or "" if c.isdigit() or c == "-")
        plain = int(digits) if now and digits and now.rstrip("b") == digits else 0
        if plain <= 0 or plain > most:
            spark.conf.set(key, str(most))


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The result of ``make`` written and read back; the scratch tables that were
    written for it are deleted, so a job's disk holds what is still read."""
    _OPEN.append([])
    try:
        df = make()
        spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
        df.write.parquet(path)
    finally:
        made = _OPEN.pop()
    for p in made:
        drop_table(spark, p)
    if _OPEN:
        _OPEN[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def type_of(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
