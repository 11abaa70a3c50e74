"""JDBC tables (the transfer destination and its audit table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, options: dict[str, str] | None = None) -> DataFrame:
    """Whole table; filters applied later are pushed to the database by Spark."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {})).load()


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int | str | None = None,
                options: dict[str, str] | None = None) -> None:
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
    if batchsize is not None:
        w = w.option("batchsize", str(batchsize))
    w.options(**(options or {})).save()
