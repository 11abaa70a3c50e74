"""Text columns: normalization, token split, counterparty rule chain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: str | Column) -> Column:
    """Upper-case and collapse every whitespace run to one blank."""
    return F.regexp_replace(F.upper(_col(c)), C.WHITESPACE_PATTERN, " ")


def split_tokens(c: str | Column, n: int = 5, prefix: str = "TT_") -> list[Column]:
    """Split on '/' or '~' into ``n`` positional columns; missing positions are null.

    ``get`` (not ``getItem``) so an out-of-range position is null under ANSI mode.
    """
    parts = F.split(_col(c), C.TOKEN_SPLIT_PATTERN)
    return [F.get(parts, i).alias(f"{prefix}{i}") for i in range(n)]


def counterparty(tokens: list[str | Column], pay_type: str | Column, text: str | Column) -> Column:
    """First matching rule wins; see ``config.COUNTERPARTY_TOKEN_RULES``.

    Rules on the first token pick a token (or ''), then pay-type rules, else ''.
    """
    t = [_col(x) for x in tokens]
    pay = F.lower(_col(pay_type))
    rules: list[tuple[Column, Column]] = []
    for pattern, idx in C.COUNTERPARTY_TOKEN_RULES:
        rules.append((t[0].rlike(pattern), F.lit("") if idx is None else t[idx]))
    rules.append((pay.rlike(C.PAYTYPE_REMIT_PATTERN), F.lit("")))
    rules.append(((pay == C.PAYTYPE_BILL) & (t[1] == C.BILL_TOKEN), t[3]))
    rules.append(((pay == C.PAYTYPE_OTHERS) & _col(text).rlike(C.OTHERS_TEXT_PATTERN), t[0]))
    first_cond, first_val = rules[0]
    chain = reduce(lambda acc, r: acc.when(r[0], r[1]), rules[1:], F.when(first_cond, first_val))
    return chain.otherwise(F.lit(""))



# A word is a run of letters, digits and underscores of any script.
WORD = r"[\p{L}\p{N}_]+"


def words(c: str | Column) -> Column:
    """The words of a text, lower-cased, in order."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(WORD), F.lit(0))


def has_whole(line: Column, phrase: Column) -> Column:
    """Whether ``phrase`` (literal, any case) stands in ``line`` with no word character right before or after it."""
    quoted = F.concat(F.lit(r"\Q"), F.replace(F.lower(phrase), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    edge = r"[\p{L}\p{N}_]"
    return F.rlike(F.lower(line), F.concat(F.lit(f"(?<!{edge})"), quoted, F.lit(f"(?!{edge})")))
