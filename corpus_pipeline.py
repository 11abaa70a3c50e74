"""A training-corpus pipeline of five stages over ``documents``, in this order:
language ID, near-duplicate removal, benchmark decontamination, secret
redaction, BPE encoding.

Each stage works on all rows that its predecessor kept; ``run`` writes each
result as Parquet and reads it again.  Every stage but the last returns the
columns of ``documents``.

Ids: language ID drops rows whose text is null or has no letters.  Near-duplicate
removal links rows by their texts alone, so rows that repeat an id are linked
only if their texts are alike.  Of each component one row is kept, that with
the smallest id (null ids last; of equal ids any).  Texts without words are
linked with nothing.  Decontamination judges every row by its own text, whatever
its id.  Very long texts are handled whole in every stage; repeated rows without
words stay.

Disk: a stage deletes the scratch tables behind its small results (groups, hits)
before it returns, so that only what its result still reads is left.  Memory:
every stage bounds the session's Arrow batches (``frames.bound_batches``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsflow.llm import bpe, decontaminate, langid, minhash, secrets
from opsflow.llm.frames import bound_batches, settled, table, write_and_read
from opsflow.llm.queries import vocabulary_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; ``lang`` becomes the predicted one.

    Learns from the labelled rows that are not held out; rejects ``und``."""
    bound_batches(spark)
    docs = docs.select(*COLUMNS)
    model = langid.train(docs.filter(~langid.held_out("doc_id")))
    found = langid.predict(docs, model, lang_name="_lang", score_name="_score").filter(F.col("_lang") != langid.UND)
    return found.withColumn("lang", F.col("_lang")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component at a similarity of 0.8 or more over five-word shingles, the one with the smallest id.
    Rows are linked by row number, written once so that it stays."""
    bound_batches(spark)
    rows = write_and_read(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "rows")

    def repeated() -> DataFrame:
        groups = minhash.near_duplicates(rows, id_col="_row", k=5, percent=80).select(F.col("id").alias("_row"), "component")
        groups = write_and_read(rows.select("_row", "doc_id").join(groups, "_row"), "groups")
        first = groups.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))).alias("first"))
        return groups.join(first, "component").filter(F.col("_row") != F.col("first._row")).select("_row")

    return rows.join(settled(repeated, "repeated"), "_row", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of ``benchmark``; a row goes for its own text, named by its digest.
    The digests of the texts that are hit are written first, so Spark knows their size and need not shuffle the texts."""
    bound_batches(spark)
    docs = docs.select(*COLUMNS)
    docs = docs.withColumn("_digest", F.unhex(F.sha2(F.col("text"), 256)))

    def hit() -> DataFrame:
        found = decontaminate.matches(decontaminate.build_index(docs, "_digest"), table(spark, sf_dir, "benchmark"))
        return found.filter(F.size("spans") > 0).select(F.col("id").alias("_digest")).distinct()

    return docs.join(settled(hit, "hits"), "_digest", "left_anti").select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in the text become a mark, and ``n_chars`` follows."""
    bound_batches(spark)
    clean = secrets.redact_copies(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, ``n_tokens`` and ``ids`` of every document."""
    bound_batches(spark)
    vocabulary = bpe.Vocabulary(vocabulary_path())
    lexicon = bpe.build_lexicon(docs, vocabulary)
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary, lexicon)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [("language ID", language_id), ("MinHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("secret scans", secret_scan), ("BPE encoding", encoding)]

#: Language ID and BPE have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_and_read(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
