"""JSON envelope columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Timestamps in the envelope are written with microseconds.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def json_value(cols: list[str]) -> Column:
    """All columns as one JSON object; null fields are kept as ``null``."""
    return F.to_json(
        F.struct(*[F.col(c) for c in cols]),
        {"ignoreNullFields": "false", "timestampFormat": TIMESTAMP_FORMAT,
         "timestampNTZFormat": TIMESTAMP_FORMAT},
    )


def unescape_embedded(c: Column) -> Column:
    """Literal un-escape of JSON text embedded in JSON: drop every backslash,
    then ``"{`` -> ``{`` and ``}"`` -> ``}``.  Lossy for text with real backslashes."""
    v = F.translate(c, "\\", "")
    v = F.regexp_replace(v, '"\\{', "{")
    return F.regexp_replace(v, '\\}"', "}")
