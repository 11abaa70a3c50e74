"""URL filters by hashed host-suffix and path-prefix expressions, in DataFrame functions only.

A rule (host, path, verdict) fits its host and all subdomains if the url's path
starts with the rule's.  Each distinct url is expanded into the expressions
host suffix + path prefix of the shapes (labels, path length) that the rules
have; expressions and rules are equi-joined on the first 4 bytes of their
SHA-256, and the full digest confirms a hit.  The longest rule wins (host and
path together, then the longer host, then block over allow).

The number of shapes is bounded by the longest rule; the rule table itself is
joined as any table, so Spark broadcasts it only under its size threshold.

Defined results: a null url, or one without ``://``, has an empty host and path;
an url that no rule fits gets a null rule and the default verdict; repeated
urls are judged once and reported row by row; null ids stay null; rules with a
null part are ignored, repeated rules count once; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import need

RULE_SCHEMA = "host string, path string, verdict string"
DEFAULT_VERDICT = "allow"
PREFIX_DIGITS = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def expressions(host: Column, path: Column, shapes: Column) -> Column:
    """Structs of ``expr`` and ``digest``: each host suffix of so many labels with each path prefix of so many characters,
    for the shapes (array of structs ``labels``, ``size``) that the host and path are long enough for."""
    labels, length = _labels(host), F.length(path)

    def one(shape: Column) -> Column:
        suffix = F.call_function("substring_index", host, F.lit("."), -shape["labels"])
        expr = F.concat(suffix, F.substring(path, F.lit(1), shape["size"]))
        return F.struct(F.length(suffix).alias("host_size"), expr.alias("expr"), F.sha2(expr, 256).alias("digest"))

    return F.transform(F.filter(shapes, lambda s: (s["labels"] <= labels) & (s["size"] <= length)), one)


def compile_rules(rules: DataFrame) -> DataFrame:
    """Distinct rules with their digest and its short prefix; of two verdicts for one rule, block holds."""
    need(rules, "host", "path", "verdict")
    return (rules.dropna(subset=["host", "path", "verdict"]).filter("host <> ''")
            .withColumn("host", F.translate("host", _UPPER, _LOWER))
            .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
            .withColumn("rule", F.concat("host", "path")).withColumn("digest", F.sha2("rule", 256))
            .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS)))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = DEFAULT_VERDICT) -> DataFrame:
    """Per row: ``id``, ``host``, ``path``, ``rule`` (host and path of the rule that holds, or null) and ``verdict``."""
    need(pages, id_col, url_col)
    compiled = compile_rules(rules)
    # one row, bounded by the longest rule; a subquery of the job, so nothing is collected
    shapes = compiled.select(F.struct(_labels(F.col("host")).alias("labels"), F.length("path").alias("size")).alias("shape"))
    shapes = shapes.agg(F.collect_set("shape")).scalar()
    host, path = url_parts(F.col("url"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("id", host.alias("host"), path.alias("path"))
    # rows without a host fit no rule: each gets a key of its own, so they do not meet in one task
    rows = rows.withColumn("alone", F.when(F.col("host") == "", F.monotonically_increasing_id()).otherwise(F.lit(-1)))
    distinct = rows.filter("host <> ''").select("host", "path").distinct()
    asked = distinct.select("host", "path", shapes.alias("shapes"))
    asked = asked.select("host", "path", F.explode(expressions(F.col("host"), F.col("path"), F.col("shapes"))).alias("e"))
    asked = asked.select("host", "path", "e.*", F.substring("e.digest", 1, PREFIX_DIGITS).alias("prefix"))
    known = compiled.select("prefix", F.col("digest").alias("full"), F.length("host").alias("rule_host"), "rule", "verdict")
    hits = (asked.join(known, "prefix").filter((F.col("digest") == F.col("full")) & (F.col("host_size") == F.col("rule_host")))
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("size"), "rule_host", "verdict", "rule")).alias("best"))
            .withColumn("alone", F.lit(-1).cast("bigint")))
    return (rows.join(hits, ["alone", "host", "path"], "left")
            .select("id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
