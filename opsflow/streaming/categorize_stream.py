"""Micro-batch categorization with ``foreachBatch``.

Each batch is persisted for its several uses, reduced to the latest message per
transaction (scope: that batch only, so a repeat in a later batch is sent
again), categorized or given the default category by feed, wrapped in the
output envelope and handed to a sink.  Master tables are re-read for every
batch, so their edits show in the next batch.  Failures raise (the batch is not
committed and is replayed); sinks must tolerate replays (at-least-once).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import categorize as cat
from ..operators import envelope as env
from ..operators import feeds, latest
from ..sources import messages

TXN_KEYS = ["tranId", "amount", "tranText"]


def batch_processor(feed: feeds.FeedConfig, sink: Callable[[DataFrame, int], None],
                    load_masters: Callable[[SparkSession], tuple[DataFrame, DataFrame]] | None = None,
                    keys: list[str] = TXN_KEYS, order: str = "msg_time", account_col: str = "accId",
                    join_key: str = "tranId", decision_key: str | None = None,
                    tie_col: str | None = None) -> Callable[[DataFrame, int], None]:
    """The function given to ``foreachBatch`` for one feed."""

    def process(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            kept = latest.latest_messages(batch, keys, order)
            if feed.categorized:
                decisions, tree = load_masters(batch.sparkSession)
                out = cat.categorize(kept, decisions, tree, join_key=join_key, decision_key=decision_key,
                                     tie_col=tie_col, batch_keys=batch)
                out = feeds.rename_output(out)
            else:
                out = feeds.default_category(kept, "amount")
            sink(env.envelope(out, account_col), epoch_id)
        finally:
            batch.unpersist()

    return process


def kafka_sink(servers: str, topic: str) -> Callable[[DataFrame, int], None]:
    """Sink writing each batch's ``key``/``value`` rows to the output topic."""

    def sink(df: DataFrame, epoch_id: int) -> None:
        messages.write_kafka(df, servers, topic)

    return sink


def start_feed(spark: SparkSession, feed: feeds.FeedConfig, servers: str, load_masters,
               sink: Callable[[DataFrame, int], None] | None = None, *, checkpoint: str,
               source: DataFrame | None = None, trigger: dict | None = None, **processor_opts) -> StreamingQuery:
    """A feed end to end: raw messages (``timestamp``, ``value``) from the feed's
    Kafka topic, or from ``source`` (any streaming frame with those columns),
    parsed with the feed schema and padded, then the batch processor; the output
    goes to the feed's output topic unless another sink is given.  The
    checkpoint folder is required, so that a restarted feed goes on where it
    stopped; ``trigger`` is passed to ``DataStreamWriter.trigger`` and
    ``processor_opts`` (keys, order, join keys) to ``batch_processor``."""
    src = source if source is not None else messages.read_kafka_stream(spark, servers, feed.input_topic, feed.group_id)
    parsed = feeds.pad_columns(feeds.parse_messages(feeds.raw_messages(src), feed.message_schema), feed.name)
    writer = (parsed.writeStream.outputMode("append")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(batch_processor(feed, sink or kafka_sink(servers, feed.output_topic), load_masters,
                                            **processor_opts)))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def partition_sink(folder: str) -> Callable[[DataFrame, int], None]:
    """Writes each batch to ``folder/batch_id=<n>``; a replayed batch replaces its own output."""

    def sink(df: DataFrame, epoch_id: int) -> None:
        (df.withColumn("batch_id", F.lit(epoch_id).cast("bigint")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(folder))

    return sink
