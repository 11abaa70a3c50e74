"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every text version is addressed by the SHA-256 of its content, every rule by a
hash of its own definition.  The ledger holds, for each blob, which rule
versions it was scanned with and their findings; a run scans only the (blob,
rule version) pairs that the ledger lacks, appends them, and joins findings back
to every path that has the blob.  A new rule is the only one that old blobs are
scanned with; a blob's copies are scanned once; a rerun after a lost job scans
what is not yet in the ledger.

Texts that no rule matches are entered without being moved: one pass finds the
addresses and whether any rule matches, and only texts that one matches are
brought together (one for each blob and task).

A rule is a kind, a pattern, the group whose length counts, and the least
length.  Matches are leftmost and do not overlap within a kind; those whose
group is too short are dropped (after they have used up their characters).
Positions count code points, ends are exclusive.

Defined results: a null text counts as an empty one; a text without findings
has an empty list; repeated rows and ids are reported row by row; null ids stay
null; very long texts are scanned whole; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .frames import need, write_and_read


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int
    least: int


# fixed values: the base rules of the contract, in the order in which kinds are listed.  A run of hex digits (or of
# AKIA characters) is taken whole from its first place, so the least length can stand in the pattern; in assign it
# cannot, as a match with a short value uses up its characters.
BASE_RULES = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
# further kinds: private key blocks and signed web tokens
MORE_RULES = (
    # up to the closing line; without one, the lines that look like a key's body
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----|(?:(?:\s|\\n)+[A-Za-z0-9+/=]{16,})*)", 0, 27),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 24),
)
RULES = BASE_RULES + MORE_RULES
FINDINGS = "array<struct<start:int,rank:int,kind:string,end:int>>"
LEDGER = "blob string, rules array<string>, findings array<struct<start:int,rule:string,end:int>>"


def rule_version(rule: Rule) -> str:
    """Content address of one rule."""
    return hashlib.sha256(repr(tuple(rule)).encode()).hexdigest()[:16]


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """Findings of one rule: the pieces between the matches and the matches give the positions."""
    empty = F.array().cast(FINDINGS)
    pieces = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    lengths = F.transform(whole, F.length)
    if rule.group:
        counted = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.length)
    else:
        counted = lengths
    steps = F.arrays_zip(F.slice(pieces, 1, F.size(whole)).alias("gap"), lengths.alias("size"), counted.alias("counted"))
    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def add(state: Column, m: Column) -> Column:
        begin = state["at"] + m["gap"]
        end = begin + m["size"]
        one = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        found = F.when(m["counted"] >= rule.least, F.concat(state["found"], F.array(one))).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    found = F.aggregate(steps, start, add, lambda s: s["found"])
    return F.when(text.rlike(rule.pattern), found).otherwise(empty)


def findings(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All findings of a text, by start and then by the rules' order."""
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*[rule_spans(text, r, i) for i, r in enumerate(rules)]))


def read_ledger(spark, path: str) -> DataFrame:
    """The ledger's rows; none where it does not exist yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def _suspect(text: Column, rules: tuple[Rule, ...]) -> Column:
    """Whether any rule matches somewhere (null texts: no)."""
    found = F.lit(False)
    for r in rules:
        found = found | text.rlike(r.pattern)
    return F.coalesce(found, F.lit(False))


def _missing_findings(text: Column, rules: tuple[Rule, ...]) -> Column:
    """Findings, by rule version, of the rules in the column ``missing``."""
    parts = []
    for i, r in enumerate(rules):
        own = _versioned(rule_spans(text, r, i), rule_version(r))
        parts.append(F.when(F.array_contains("missing", rule_version(r)), own).otherwise(F.array().cast("array<struct<start:int,rule:string,end:int>>")))
    return F.concat(*parts)


def _versioned(spans: Column, version: str) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(version).alias("rule"), x["end"].alias("end")))


def _known(ledger: DataFrame) -> DataFrame:
    """``blob``, the rule versions it was scanned with, and all findings (a blob has a row for each run that scanned it)."""
    return ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("known"),
                                      F.array_distinct(F.flatten(F.collect_list("findings"))).alias("found"))


def scan_unseen(docs: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text",
                rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan the (blob, rule version) pairs that the ledger lacks and append them; ``blob`` and ``findings`` (start, rank
    of the kind, kind, end) of every blob of the ledger that was scanned with all of ``rules``."""
    need(docs, id_col, text_col)
    spark, versions = docs.sparkSession, [rule_version(r) for r in rules]
    wanted = F.array(*[F.lit(v) for v in versions])
    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("text", F.sha2("text", 256).alias("blob"), _suspect(F.col("text"), rules).alias("suspect"))
    # addresses only; a blob's copies meet before the shuffle
    blobs = rows.groupBy("blob").agg(F.max("suspect").alias("suspect"))
    known = _known(read_ledger(spark, ledger)).select("blob", "known")
    missing = F.array_except(wanted, F.coalesce("known", F.array().cast("array<string>")))
    unseen = blobs.join(known, "blob", "left").select("blob", "suspect", missing.alias("missing")).filter(F.size("missing") > 0)
    unseen = write_and_read(unseen, "unseen")
    clean = unseen.filter(~F.col("suspect")).select("blob", F.col("missing").alias("rules"),
                                                    F.array().cast("array<struct<start:int,rule:string,end:int>>").alias("findings"))
    texts = rows.filter("suspect").groupBy("blob").agg(F.first("text").alias("text"))
    found = texts.join(unseen.filter("suspect").select("blob", "missing"), "blob").select(
        "blob", F.col("missing").alias("rules"), _missing_findings(F.col("text"), rules).alias("findings"))
    clean.unionAll(found).write.mode("append").parquet(ledger)
    return _for_rules(read_ledger(spark, ledger), rules)


def _for_rules(ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob`` and its findings under ``rules``, by start and then by the rules' order."""
    versions = [rule_version(r) for r in rules]
    wanted = F.array(*[F.lit(v) for v in versions])
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    mine = F.transform(F.filter("found", lambda x: F.array_contains(wanted, x["rule"])), lambda x: F.struct(
        x["start"].alias("start"), (F.array_position(wanted, x["rule"]) - 1).cast("int").alias("rank"),
        F.element_at(kinds, F.array_position(wanted, x["rule"]).cast("int")).alias("kind"), x["end"].alias("end")))
    return (_known(ledger).filter(F.size(F.array_except(wanted, F.col("known"))) == 0)
            .select("blob", F.array_sort(mine).alias("findings")))


def _with_findings(docs: DataFrame, ledger: str | None, id_col: str, text_col: str, rules: tuple[Rule, ...]) -> DataFrame:
    """The blobs of ``docs`` that have findings, in shared scratch (so that a join with them can be split)."""
    ledger = ledger or scratch_path(docs.sparkSession, "ledger")
    return write_and_read(scan_unseen(docs, ledger, id_col, text_col, rules).filter(F.size("findings") > 0), "findings")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES,
         ledger: str | None = None) -> DataFrame:
    """Per row: ``id``, ``blob`` and ``findings`` (start, rank of the kind, kind, end).

    ``ledger`` is a folder that later runs use again; a fresh one in shared scratch if it is not given."""
    seen = _with_findings(docs, ledger, id_col, text_col, rules)
    paths = docs.select(F.col(id_col).alias("id"), F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256).alias("blob"))
    return paths.join(seen, "blob", "left").select("id", "blob", F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings"))


def redact(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping findings replaced by ``mark``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def cut(s: Column, x: Column) -> Column:
        ahead = F.substring(text, s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0)))
        out = F.when(x["start"] >= s["at"], F.concat(s["out"], ahead, F.lit(mark))).otherwise(s["out"])
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), out.alias("out"))

    rest = F.aggregate(found, start, cut, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(found) > 0, rest).otherwise(text)


def redact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES,
                  ledger: str | None = None) -> DataFrame:
    """All rows and columns of ``docs``, secrets in the text replaced; a null text stays null."""
    seen = _with_findings(docs, ledger, id_col, text_col, rules)
    # only texts that some rule matches go through the join; the others keep their place
    text = F.col(text_col).cast("string")
    suspect = _suspect(text, rules)
    # the row goes as one struct, so its columns may have any name
    rows = docs.filter(suspect).select(F.struct("*").alias("row"), F.sha2(text, 256).alias("blob"))
    joined = rows.join(seen, "blob", "left")
    own = F.col("row")[text_col]
    clean = F.when(F.col("findings").isNull(), own).otherwise(redact(own, F.col("findings")))
    return docs.filter(~suspect).unionAll(
        joined.select(*[clean.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]))


def span_text(found: Column) -> Column:
    """kind:start:end of findings in order, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
