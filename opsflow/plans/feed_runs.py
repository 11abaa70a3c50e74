"""Streams over landed rows: two micro-batches of one query, and the three feeds through a failed batch and a restart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import categorize as cat
from ..operators import feeds, latest
from ..session import scratch_path
from ..sources import files, messages
from ..streaming import categorize_stream as cs

MESSAGE_SCHEMA = "timestamp timestamp_ntz, value string"


def failing_after(sink: Callable[[DataFrame, int], None], epoch: int) -> Callable[[DataFrame, int], None]:
    """A sink that writes its batch and fails before the batch is committed, for one batch number."""

    def run(df: DataFrame, epoch_id: int) -> None:
        sink(df, epoch_id)
        if epoch_id == epoch:
            raise RuntimeError(f"batch {epoch_id} was written and not committed")

    return run


def run_feeds_with_restart(spark: SparkSession, landed: dict[str, DataFrame], split: Column,
                           configs: dict[str, feeds.FeedConfig], load_masters, **options) -> DataFrame:
    """Each feed's messages (``timestamp``, ``value``) arrive in two steps, before and from ``split``.

    ``start_feed`` runs after the first; after the second it fails once the output of the batch is written and before
    it is committed; a new start on the same checkpoint replays that batch, whose output replaces what was written.
    Returns ``feed``, ``batch_id``, ``key`` and ``value`` of all output."""
    root = scratch_path(spark, "feeds")

    def start(name: str, sink) -> StreamingQuery:
        stream = messages.read_file_stream(spark, f"{root}/{name}/in", spark.createDataFrame([], MESSAGE_SCHEMA).schema,
                                           glob="part-*.parquet")
        return cs.start_feed(spark, configs[name], "", load_masters, sink, checkpoint=f"{root}/{name}/ckpt", source=stream,
                             trigger={"availableNow": True}, **options)

    def run_all(wrap) -> list[str]:
        """Names of the feeds whose run failed; feeds run at the same time."""
        running = {name: start(name, wrap(cs.partition_sink(f"{root}/{name}/out"))) for name in landed}
        failed = []
        for name, query in running.items():
            try:
                query.awaitTermination()
            except StreamingQueryException:
                failed.append(name)
        return failed

    def land(keep: Column) -> None:
        for name, df in landed.items():
            df.filter(keep).write.mode("append").parquet(f"{root}/{name}/in")

    land(F.col("timestamp") < split)
    steps = [run_all(lambda sink: sink)]
    land(F.col("timestamp") >= split)
    steps.append(run_all(lambda sink: failing_after(sink, 1)))
    steps.append(run_all(lambda sink: sink))
    if steps != [[], list(landed), []]:
        raise RuntimeError(f"feeds that failed, by run: {steps}; only the second run may fail")
    out = None
    for name in landed:
        one = spark.read.parquet(f"{root}/{name}/out").select(F.lit(name).alias("feed"), F.col("batch_id").cast("bigint").alias("batch_id"),
                                                              "key", "value")
        out = one if out is None else out.unionAll(one)
    return out


def run_two_batches(spark: SparkSession, events: DataFrame, split: Column,
                     per_batch: Callable[[DataFrame], DataFrame], time_col: str = "ts") -> DataFrame:
    """Land rows in two steps (before / from ``split`` on ``time_col``) and run an
    ``availableNow`` file stream after each, so the two halves arrive as two
    micro-batches of one query."""
    root = scratch_path(spark, "stream")
    src, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    sink = cs.partition_sink(out)

    def run_batch(df: DataFrame, epoch_id: int) -> None:
        df.persist()                     # the batch is read several times (H2)
        try:
            sink(per_batch(df), epoch_id)
        finally:
            df.unpersist()

    for part in (events.filter(F.col(time_col) < split), events.filter(F.col(time_col) >= split)):
        part.write.mode("append").parquet(src)
        stream = messages.read_file_stream(spark, src, events.schema, glob="part-*.parquet")
        q = (stream.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
             .foreachBatch(run_batch).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return spark.read.parquet(out).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def run_file_stream_latest(spark: SparkSession, events: DataFrame, split: Column) -> DataFrame:
    """Latest message per (user, event type) and day, per micro-batch."""
    def per_batch(df: DataFrame) -> DataFrame:
        return latest.latest_messages(df, ["user_id", "event_type"], F.to_date("ts"))
    return run_two_batches(spark, events, split, per_batch)


def run_file_stream_enrich(spark: SparkSession, events: DataFrame, split: Column, accounts: DataFrame,
                           tree_path: str) -> DataFrame:
    """Per micro-batch: latest message, account lookup, then the category tree
    (a CSV master re-read for every batch: a stream-static join)."""
    def per_batch(df: DataFrame) -> DataFrame:
        tree = files.read_master_csv(df.sparkSession, tree_path)
        kept = latest.latest_messages(df, ["user_id", "event_type"], F.to_date("ts"))
        j = kept.join(accounts, kept["user_id"] == accounts["c_custkey"], "left").drop("c_custkey")
        return cat.enrich_with_tree(j, tree, "catId").select("event_id", "user_id", "event_type", "catId", "catN")
    return run_two_batches(spark, events, split, per_batch)


def run_file_stream_categorize(spark: SparkSession, transactions: DataFrame, split: Column,
                               load_masters: Callable[[SparkSession], tuple[DataFrame, DataFrame]],
                               keys: list[str], order: str, join_key: str, decision_key: str,
                               tie_col: str | None, project: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Per micro-batch: latest message per transaction key, then the full
    categorization with masters re-read for the batch; ``project`` shapes the output."""
    def per_batch(df: DataFrame) -> DataFrame:
        decisions, tree = load_masters(df.sparkSession)
        kept = latest.latest_messages(df, keys, order)
        out = cat.categorize(kept, decisions, tree, join_key=join_key, decision_key=decision_key, tie_col=tie_col,
                             batch_keys=df)
        return project(out)
    return run_two_batches(spark, transactions, split, per_batch, time_col=order)
