"""Message parsing and per-feed column work (feeds A, B, C).

All functions are plain transformations, valid on batch and streaming frames.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .. import config as C


# Message schemas per feed (our own: the source's schema module is absent).
# Feed C lacks the six columns of ``config.FEED_C_MISSING``; they are padded.
_COMMON = ("tranId string, tranText string, accId string, amount decimal(18,2), accIdent string, tranDt string, "
           "cost string, tranT string, tranI string, payType string")
_PAPER = "paperNum string, due string, jour string, merch string, location string, bCode string"
FEED_SCHEMAS = {
    "A": f"{_COMMON}, {_PAPER}",
    "B": f"{_COMMON}, {_PAPER}",
    "C": _COMMON,
}


@dataclass(frozen=True)
class FeedConfig:
    """One feed: its input topic, output topic, consumer group and schema."""

    name: str
    input_topic: str
    output_topic: str
    group_id: str
    schema: StructType | str | None = None

    @property
    def message_schema(self) -> StructType | str:
        return self.schema if self.schema is not None else FEED_SCHEMAS[self.name]

    @property
    def categorized(self) -> bool:
        """Feeds A and C go through categorization; B gets the default category."""
        return self.name in ("A", "C")


def raw_messages(df: DataFrame, time_col: str = "timestamp", value_col: str = "value") -> DataFrame:
    """Rename the message time and read the payload bytes as text."""
    return df.select(F.col(time_col).alias("msg_time"), F.col(value_col).cast("string").alias("val_str"))


def parse_messages(df: DataFrame, schema: StructType | str, keep: list[str] | None = None,
                   value_col: str = "val_str") -> DataFrame:
    """Parse JSON payloads by ``schema`` and flatten the struct.

    Malformed payloads give all-null fields (``from_json`` permissive mode).
    ``keep`` lists columns carried next to the parsed fields (default ``msg_time``).
    """
    keep = ["msg_time"] if keep is None else keep
    parsed = df.select(*keep, F.from_json(F.col(value_col), schema).alias("jsonData"))
    return parsed.select(*keep, "jsonData.*")


def sign_flag(amount: str | Column) -> Column:
    """1 when the amount is below zero, else 0 (null gives 0)."""
    a = F.col(amount) if isinstance(amount, str) else amount
    return F.when(a < 0, F.lit(1)).otherwise(F.lit(0))


def _amount(df: DataFrame, amount_col: str) -> Column:
    """The amount as a number; text amounts are read leniently (bad text is null)."""
    c = F.col(amount_col)
    return c.try_cast("decimal(38,10)") if isinstance(df.schema[amount_col].dataType, StringType) else c


def pad_columns(df: DataFrame, feed: str, amount_col: str = "amount") -> DataFrame:
    """Add the empty columns a feed lacks, and the sign flag ``amtId``."""
    pads: dict[str, Column] = {}
    if feed == "C":
        pads.update({c: F.lit("") for c in C.FEED_C_MISSING})
    pads.update({c: F.lit("") for c in C.BATCH_PAD})
    pads["amtId"] = sign_flag(_amount(df, amount_col))
    return df.withColumns(pads)


def rename_output(df: DataFrame) -> DataFrame:
    """Feed A/C output: add ``merchN`` and apply the fixed rename map in one projection."""
    return df.withColumn("merchN", F.lit("")).withColumnsRenamed(C.OUTPUT_RENAMES)


def default_category(df: DataFrame, amount_col: str = "amount", keep_struct: bool = True) -> DataFrame:
    """Feed B output: category by sign of the amount, plus the fixed padding
    columns; the struct is kept next to its expanded fields unless ``keep_struct``
    is false."""
    def cat(values: tuple[str, str, str]) -> Column:
        return F.struct(F.lit(values[0]).alias("catId"), F.lit(values[1]).alias("catN"),
                        F.lit(values[2]).alias("catType"))

    out = df.withColumn(
        "catStruct",
        F.when(_amount(df, amount_col) < 0, cat(C.DEFAULT_CAT_NEGATIVE)).otherwise(cat(C.DEFAULT_CAT_OTHER)),
    ).withColumns({k: F.lit(v) for k, v in C.FEED_B_PAD.items()})
    out = out.select("*", "catStruct.*")
    return out if keep_struct else out.drop("catStruct")


def route(df: DataFrame, feed_of: Column, feeds: dict[str, FeedConfig]) -> DataFrame:
    """Tag each row with its feed, output topic and branch (categorize / default)."""
    topic = F.lit(None).cast("string")
    group = F.lit(None).cast("string")
    for name, fc in feeds.items():
        topic = F.when(feed_of == name, F.lit(fc.output_topic)).otherwise(topic)
        group = F.when(feed_of == name, F.lit(fc.group_id)).otherwise(group)
    branch = F.when(feed_of.isin([n for n, fc in feeds.items() if fc.categorized]), F.lit("categorize")) \
        .when(feed_of.isNotNull(), F.lit("default"))
    return df.withColumns({"feed": feed_of, "output_topic": topic, "consumer_group": group, "branch": branch})
