"""The operators of this subpackage bound to the driver tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, decontaminate, htmltext, langid, licences, minhash, secrets, simhash, toxicity, urlfilter, warc, whitening
from ..session import scratch_path
from .frames import table, write_and_read

# fixed values: the url rules of the contract
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every whole text, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = bpe.Vocabulary(vocabulary_path())
    lexicon = bpe.build_lexicon(docs, vocabulary)
    return bpe.round_trip_digests(docs, vocabulary, lexicon, "doc_id").withColumnRenamed("id", "doc_id")


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and licences of every whole text."""
    found = licences.scan(table(spark, sf_dir, "documents"))
    names = F.transform("sentences", lambda x: F.concat_ws(":", x["id"], F.nullif(x["version"], F.lit(""))))
    return found.select(F.col("id").alias("doc_id"), F.array_join(names, ",").alias("sentence_ids"),
                        F.array_join("licences", ",").alias("licences"), F.col("n_unknown").cast("bigint").alias("n_unknown"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over two-word shingles."""
    return (minhash.near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)
            .select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of every whole text, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.filter(~langid.held_out("doc_id")))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of every page, written and read back."""
    rows = warc.with_revisits(table(spark, sf_dir, "pages"))
    archives = write_and_read(warc.write_archives(rows), "archives")
    found = warc.read_archives(archives)  # a gap, if any, is seen as a row without a page
    return found.select(F.col("id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast("bigint").alias("refers_to"))


def warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of every page, each overwritten with 16 bytes at a third and cut by its last 20: what the salvage reader
    recovers, and the gaps that it logs."""
    rows = warc.with_revisits(table(spark, sf_dir, "pages"))
    archives = write_and_read(warc.write_archives(rows, archive_bytes=1 << 18), "archives")
    size = F.octet_length("content")
    hurt = F.expr("overlay(content PLACING X'00112233445566778899AABBCCDDEEFF' FROM octet_length(content) div 3 FOR 16)")
    hurt = F.when(size > 60, F.substring(hurt, F.lit(1), size - 20)).otherwise(F.col("content"))
    found = warc.read_archives(archives.select("archive", hurt.alias("content")))
    return found.select("archive", "start", "end", "kind", F.col("id").cast("bigint").alias("page_id"), "record_type",
                        "payload_bytes", "payload_digest", "reason")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    found = htmltext.with_text(table(spark, sf_dir, "pages").select("page_id", "html"))
    return found.select("page_id", "text", F.length("text").cast("bigint").alias("n_chars"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of its edited text."""
    found = simhash.edited_prints(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                        "edited_fingerprint", "near_edited", "near_next")


def simhash_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids divisible by 50 against all rows: a row for each class of equal fingerprints within 24 of 256 bits that has
    another document, with the class's least id and its number of documents (op6_simhash has the fingerprint of each)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = write_and_read(simhash.with_fingerprint(docs).select("doc_id", "fingerprint"), "prints")
    queries = prints.filter("doc_id % 50 = 0")
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_docs"))
    near = simhash.neighbours(queries, prints, radius=24, spare=2).join(classes, "fingerprint")
    near = near.filter("distance > 0 or n_docs > 1").withColumn("distance", F.col("distance").cast("bigint"))
    return (queries.withColumnRenamed("fingerprint", "query").join(near, "query")
            .select("doc_id", "class_id", "fingerprint", "distance", "n_docs"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text, through a fresh ledger."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("findings", lambda x: x["rank"] < len(secrets.BASE_RULES))

    def count(kind: str):
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(r.kind) for r in secrets.BASE_RULES]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
                        secrets.span_text(F.col("findings")).alias("spans"))


def secret_ledger_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one ledger: half of the documents with the base rules, then all of them with every rule.  Per document
    the runs that scanned its text, the (text, rule) pairs scanned in all, and its findings."""
    docs, ledger = table(spark, sf_dir, "documents").select("doc_id", "text"), scratch_path(spark, "ledger")
    secrets.scan_unseen(docs.filter("doc_id % 2 = 0"), ledger, rules=secrets.BASE_RULES)
    found = secrets.scan(docs, ledger=ledger)
    runs = secrets.read_ledger(spark, ledger).groupBy("blob").agg(
        F.count(F.lit(1)).alias("n_runs"), F.sum(F.size("rules")).cast("bigint").alias("n_pairs"))
    return found.join(write_and_read(runs, "runs"), "blob").select(
        F.col("id").alias("doc_id"), "n_runs", "n_pairs", F.size("findings").cast("bigint").alias("n_findings"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of the benchmark in every whole text."""
    index = decontaminate.build_index(table(spark, sf_dir, "documents"))
    found = decontaminate.matches(index, table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", decontaminate.hit_words().alias("n_hit"),
                        F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


def op10_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every url."""
    rules = spark.createDataFrame(URL_RULES, urlfilter.RULE_SCHEMA)
    return (urlfilter.judge(table(spark, sf_dir, "pages"), rules)
            .select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of every vector."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    each = found.select("id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select(F.col("id").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
                       F.col("c")["whitened"].alias("whitened"), F.col("c")["explained"].alias("explained"), "identity_error")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learned from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    learned = ~toxicity.held_out("doc_id")
    model = toxicity.train(docs.filter(learned), labels.filter(learned), corpus=docs)
    found = toxicity.predict(docs, model)
    return found.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


def op13_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact clusters of every vector after ten rounds."""
    assigned, final = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return (centroids.with_inertia(assigned, final)
            .select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def kmeans_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds of op13 written out, with exact integers."""
    steps = [f"""
        v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT) FOR e IN embedding] AS x
            FROM embeddings WHERE len(embedding) = 64 AND len([e FOR e IN embedding IF e IS NOT NULL AND isfinite(e)]) = 64),
        c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS j, x AS c
            FROM (SELECT sha256('3:' || vec_id) AS h, x FROM v ORDER BY h, x LIMIT {k}))"""]
    for i in range(rounds + 1):
        steps.append(f"""
        a{i} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS x, min({{'d': d, 'j': j}}) AS m
            FROM (SELECT r, vec_id, x, j, list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(x, c)]) AS d FROM v, c{i}) GROUP BY r)""")
        if i < rounds:
            steps.append(f"""
        c{i + 1} AS MATERIALIZED (SELECT c{i}.j, coalesce(n.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
            SELECT j, list(q ORDER BY dim) AS c FROM (
                SELECT j, dim, (s - ((s % n) + n) % n) // n AS q FROM (
                    SELECT j, dim, sum(e) AS s, count(*) AS n
                    FROM (SELECT m.j AS j, unnest(x) AS e, generate_subscripts(x, 1) AS dim FROM a{i}) GROUP BY j, dim)) GROUP BY j) n USING (j))""")
    return f"""
        WITH {",".join(steps)}
        SELECT vec_id, CAST(m.j AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance,
               CAST(sum(m.d) OVER (PARTITION BY m.j) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string([CAST(e AS VARCHAR) FOR e IN c], ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON c{rounds}.j = m.j"""


QUERIES = {f.__name__: f for f in (op1_bpe, op2_licences, op3_minhash, op4_langid, op5_warc, op6_simhash, op7_html, op8_secrets,
                                   op9_decontaminate, op10_urlfilter, op11_whitening, op12_toxicity, op13_kmeans, simhash_neighbours,
                                   secret_ledger_runs, warc_salvage)}
SQL: dict[str, str] = {
    "op13_kmeans": kmeans_sql(),
    "op5_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
        k AS (SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN keeper <> page_id THEN keeper END AS refers_to
        FROM p LEFT JOIN k USING (payload_digest)""",
    "op10_urlfilter": """
        WITH r(rule_host, rule_path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
             ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        q AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
        h AS (SELECT page_id, rule_host || rule_path AS rule, verdict,
                     row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS n
              FROM q JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
        SELECT q.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM q LEFT JOIN h ON h.page_id = q.page_id AND n = 1""",
}
