"""Message topics (Kafka) and the file stream used in place of a topic in tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def kafka_source_options(servers: str, topic: str, group_id: str) -> dict[str, str]:
    """Subscribe to one topic from the latest offset; lost data is tolerated."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "kafka.group.id": group_id,
        "failOnDataLoss": "false",
    }


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, group_id: str) -> DataFrame:
    """Streaming frame with ``timestamp`` and binary ``value`` (needs the Kafka connector)."""
    return spark.readStream.format("kafka").options(**kafka_source_options(servers, topic, group_id)).load()


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """One batch write of ``key``/``value`` to a topic (inside ``foreachBatch``)."""
    (df.select("key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def read_file_stream(spark: SparkSession, folder: str, schema: StructType | str, glob: str = "*.parquet",
                     fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream over ``folder`` (a glob selects the files; a single file path is not allowed)."""
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder)
