"""Time literals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(v: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal from its text, independent of any time zone."""
    return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
