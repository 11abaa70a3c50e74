"""Status-code columns for the dashboard."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def normalized_code(c: str | Column) -> Column:
    """The first of the ten status codes that stands in the text as a whole word
    (``OK (late)`` is OK, ``TOKEN`` is none), upper-cased; null without one."""
    u = F.upper(F.col(c) if isinstance(c, str) else c)
    return F.nullif(F.regexp_extract(u, r"\b(" + "|".join(C.STATUS_CODES) + r")\b", 1), F.lit(""))


def all_codes(c: str | Column) -> Column:
    """Every status code that stands in the text as a whole word, upper-cased, in order (empty for null)."""
    u = F.upper(F.col(c) if isinstance(c, str) else c)
    found = F.regexp_extract_all(u, F.lit(r"\b(" + "|".join(C.STATUS_CODES) + r")\b"), F.lit(1))
    return F.coalesce(found, F.array().cast("array<string>"))


def colour(c: str | Column) -> Column:
    """Cell colour; exact case, unknown codes get none."""
    v = F.col(c) if isinstance(c, str) else c
    return (F.when(v == C.SUCCESS_CODE, F.lit(C.COLOUR_OK))
            .when(v == C.DELAY_CODE, F.lit(C.COLOUR_DELAY))
            .when(v.isin(C.OTHER_COLOURED_CODES), F.lit(C.COLOUR_OTHER_CODE)))


def html_row(line: str | Column) -> Column:
    """A comma-separated line rendered as one table row."""
    v = F.col(line) if isinstance(line, str) else line
    inner = F.replace(F.coalesce(v, F.lit("")), F.lit(","), F.lit(C.CELL_CLOSE + C.CELL_OPEN))
    return F.concat(F.lit("<tr>" + C.CELL_OPEN), inner, F.lit(C.CELL_CLOSE + "</tr>"))
