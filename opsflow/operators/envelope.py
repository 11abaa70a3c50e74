"""Output envelope: ``key`` = account id, ``value`` = the row as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import jsonfmt


def envelope(df: DataFrame, key_col: str = "accId", literal_unescape: bool = True) -> DataFrame:
    """Literal form: the row as JSON (nulls kept), then embedded JSON text
    un-escaped by text replacement (drops every backslash)."""
    value = jsonfmt.json_value(df.columns)
    if literal_unescape:
        value = jsonfmt.unescape_embedded(value)
    return df.select(F.col(key_col).cast("string").alias("key"), value.alias("value"))


def envelope_structured(df: DataFrame, json_cols: dict[str, str], key_col: str = "accId") -> DataFrame:
    """Structured form: JSON text columns are parsed (``json_cols`` maps column to
    schema DDL) before the row is written, so real backslashes survive."""
    parsed = df.withColumns({c: F.from_json(F.col(c), schema) for c, schema in json_cols.items()})
    return parsed.select(F.col(key_col).cast("string").alias("key"),
                         jsonfmt.json_value(parsed.columns).alias("value"))
