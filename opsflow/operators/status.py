"""Use-case status dashboard on a long table ``(usecase, report_date, category)``.

The source job keeps a wide text file (one column per day); here the history is
long and partitioned by day, and the wide matrix is only produced for output,
with an explicit, bounded list of dates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import status as S
from ..functions import text
from ..functions.ranking import number_rows
from ..sources.sinks import overwrite_partitions


def daily_status(master: DataFrame, raw: DataFrame, raw_key: str, category: str, raw_order: str,
                 master_key: str = "usecase") -> DataFrame:
    """Each master row with today's category: raw rows matched on the use case
    ignoring case, the first raw row (by ``raw_order``) kept; no raw row -> null.
    The first match is a ``min_by`` aggregate (combined map-side, skew-safe)."""
    first = raw.groupBy(F.lower(F.col(raw_key)).alias("_k")).agg(
        F.min_by(F.col(category), F.col(raw_order)).alias("category"))
    m = master.withColumn("_k", F.lower(F.col(master_key)))
    return m.join(first, "_k", "left").drop("_k")


def first_lines_by_words(master: DataFrame, lines: DataFrame, order: str, master_key: str = "usecase", line_col: str = "line",
                         out: str = "line") -> DataFrame:
    """Each master row with the first line (by ``order``) that has its key as whole words anywhere, ignoring case.

    The key is literal text; no word character may stand right before or after
    it.  Lines are cut into runs of as many words as some key has (the distinct
    numbers of words among the keys), which meet the keys' words in an equi-join:
    a pair arises only where a line has all words of a key in a row.  The pair is
    then confirmed on the line itself (what stands between the words counts), and
    the first line is a ``min_by`` aggregate, so neither a key that is in a third
    of all lines nor a common word makes a large group.  Keys without a word, and
    null keys, match nothing.
    """
    keys = master.select(F.col(master_key).alias("_key")).filter("_key is not null").distinct()
    keys = keys.withColumn("_words", text.words("_key")).filter(F.size("_words") > 0)
    sizes = sorted(r[0] for r in keys.select(F.size("_words")).distinct().collect())
    keys = keys.withColumn("_phrase", F.array_join("_words", " "))
    src = lines.select(F.col(line_col).alias("_line"), F.col(order).alias("_order")).withColumn("_words", text.words("_line"))
    have = F.size("_words")

    def runs_of(n: int) -> Column:
        return F.when(have >= n, F.transform(F.sequence(F.lit(1), have - n + 1), lambda i: F.array_join(F.slice("_words", i, n), " ")))

    runs = [runs_of(n) for n in sizes]
    phrases = F.array_distinct(F.flatten(F.array_compact(F.array(*runs)))) if runs else F.array().cast("array<string>")
    src = src.select("_line", "_order", F.explode(phrases).alias("_phrase"))
    pairs = src.join(keys.select("_key", "_phrase"), "_phrase").filter(text.has_whole(F.col("_line"), F.col("_key")))
    first = pairs.groupBy("_key").agg(F.min_by("_line", "_order").alias(out))
    return master.join(first, master[master_key] == first["_key"], "left").drop("_key")


def line_field(line: str, position: int, sep: str = ",") -> Column:
    """A field of a delimited line by its 1-based position; null where the line has fewer."""
    return F.get(F.split(F.col(line), sep), position - 1)


def daily_status_words(master: DataFrame, lines: DataFrame, order: str, master_key: str = "usecase", line_col: str = "line",
                       position: int = 8) -> DataFrame:
    """Each master row with today's category: field ``position`` of the first raw line that has the use case as whole
    words anywhere.  ``daily_status`` compares the key column instead."""
    found = first_lines_by_words(master, lines, order, master_key, line_col, "_first")
    return found.withColumn("category", line_field("_first", position)).drop("_first")


def code_tally(long: DataFrame, group_cols: list[str], code_col: str = "category") -> DataFrame:
    """Number of status codes (ten codes, whole words, ignoring case): each code in a cell counts, also one that repeats;
    a cell without any counts as UNCLASSIFIED."""
    codes = S.all_codes(code_col)
    code = F.explode(F.when(F.size(codes) > 0, codes).otherwise(F.array(F.lit("UNCLASSIFIED"))))
    return long.select(*group_cols, code.alias("code")).groupBy(*group_cols, "code").agg(F.count(F.lit(1)).alias("n"))


def mtd_success(long: DataFrame, key_cols: list[str], report_date: dt.date, scope: str = "month",
                date_col: str = "report_date", code_col: str = "category") -> DataFrame:
    """Success percentages per use case, truncated to integers:
    ``mtd`` = OK x 100 / classified; ``mtd_dl`` = (classified - DLT) x 100 / classified,
    counted in codes (a cell may hold several).
    ``scope="month"``: days of ``report_date``'s month up to it; ``"all"``: every day.
    No classified day gives null."""
    rows = long
    if scope == "month":
        start = report_date.replace(day=1)
        rows = rows.filter((F.col(date_col) >= F.lit(start)) & (F.col(date_col) <= F.lit(report_date)))
    codes = S.all_codes(code_col)
    counted = lambda code: F.sum(F.size(F.filter(codes, lambda x: x == code)))
    agg = rows.groupBy(*key_cols).agg(
        counted(C.SUCCESS_CODE).alias("_ok"),
        counted(C.DELAY_CODE).alias("_dlt"),
        F.sum(F.size(codes)).alias("_all"),
    )
    pct = lambda num: F.when(F.col("_all") > 0, F.try_divide(num * 100, F.col("_all")).cast("bigint"))
    return agg.select(*key_cols, pct(F.col("_ok")).alias("mtd"), pct(F.col("_all") - F.col("_dlt")).alias("mtd_dl"))


def day_column(d: dt.date) -> str:
    return "d" + d.strftime("%Y%m%d")


def status_matrix(long: DataFrame, dates: list[dt.date], key_col: str = "usecase", date_col: str = "report_date",
                  code_col: str = "category", master: DataFrame | None = None) -> DataFrame:
    """One row per use case, one column per given date (in the given order,
    newest first).  Pivot values are given, so no job runs to discover them.
    With ``master``, every master use case appears (absent -> blanks)."""
    dates = list(dates)
    wide = (long.filter(F.col(date_col).isin(dates))
            .groupBy(key_col).pivot(date_col, dates).agg(F.max(code_col)))
    wide = wide.select(key_col, *[F.col(f"`{d.isoformat()}`").alias(day_column(d)) for d in dates])
    if master is not None:
        wide = master.join(wide, key_col, "left")
    return wide


def history_unpivot(wide: DataFrame, key_cols: list[str], date_cols: list[str]) -> DataFrame:
    """Wide history back to long rows; blank cells are dropped."""
    long = wide.unpivot(key_cols, date_cols, "day_col", "category")
    return (long.filter(F.col("category").isNotNull())
            .withColumn("report_date", F.to_date(F.regexp_extract("day_col", "(\\d{8})", 1), "yyyyMMdd"))
            .drop("day_col"))


def dashboard_order(rows: DataFrame, freq_col: str = "FREQ", mtd_col: str = "mtd",
                    name_col: str = "usecase", line_cols: list[str] | None = None, collation: str | None = None) -> DataFrame:
    """Daily use cases (also those without a frequency) first, monthly ones last;
    within each, success percentage ascending (blank = 0), then the whole line.
    Adds ``position`` (1-based).

    The line is ``line_cols`` comma-joined, blank for null; without them the name
    alone.  ``collation`` (a Spark collation such as ``UNICODE``) orders lines as
    a locale does; bytes count if it is not given."""
    monthly = F.coalesce(F.col(freq_col).isin(C.MONTHLY_FREQUENCIES), F.lit(False)).cast("int")
    line = F.col(name_col) if line_cols is None else F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in line_cols])
    # a collation may hold different lines equal; bytes decide then
    keys = [F.collate(line, collation), line] if collation else [line]
    return number_rows(rows, [monthly, F.coalesce(F.col(mtd_col), F.lit(0)), *keys], "position")


def failure_list(raw: DataFrame, line_col: str = "line") -> DataFrame:
    """Raw rows whose line does not contain SUCCESS (case matters)."""
    return raw.filter(~F.col(line_col).contains(C.FAILURE_MARKER))


def with_colour(df: DataFrame, code_col: str = "category", out: str = "colour") -> DataFrame:
    return df.withColumn(out, S.colour(code_col))


def report_rows(df: DataFrame, cols: list[str], out: str = "html") -> DataFrame:
    """Each row as a comma-joined line rendered into table cells."""
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return df.withColumn(out, S.html_row(line))


def rollover(day_rows: DataFrame, history_folder: str, date_col: str = "report_date") -> None:
    """Today's rows become history: the day's partition is replaced, so a
    same-day rerun leaves one copy."""
    overwrite_partitions(day_rows, history_folder, date_col)
