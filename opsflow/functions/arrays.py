"""Array columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def empty_if_null(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def union_all(*cols: Column) -> Column:
    """``array_union`` over several arrays, nested right to left, null read as empty.

    The plain ``array_union`` gives null when any argument is null.
    """
    cs = [empty_if_null(c) for c in cols]
    return reduce(lambda acc, c: F.array_union(c, acc), reversed(cs[:-1]), cs[-1])


def sorted_text(c: Column, sep: str = ",") -> Column:
    """Order-free text form of an array (sorted, joined), for comparisons."""
    return F.array_join(F.array_sort(c), sep)
