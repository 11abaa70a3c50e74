"""Each stage on edge rows, and the stages over the smallest tables."""

import math
import os
import re
import sys
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(os.path.dirname(HERE)), HERE]

import corpus_pipeline as P
from test_llm import brute_components, brute_hits, tokenizer  # noqa: F401

DIR = "/root/testdata/sf0.001"
CLASHING = ("_id", "_lang", "_score", "_blob", "items", "spans", "component", "kept", "ids", "n_tokens")
SECRETS = [(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
           (r"AKIA[A-Z0-9]+", 0, 18), (r"[0-9a-f]+", 0, 16), (r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:.|\n)*?-----END [A-Z ]*PRIVATE KEY-----", 0, 0),
           (r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 0)]


def letters(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def grams(word, n):
    edged = f" {word} " if n > 1 else word
    return [edged[i:i + n] for i in range(len(edged) - n + 1)]


def brute_languages(rows):
    """Predicted language of each text, learned from all labelled rows that are not held out."""
    learned = [r for r in rows if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    langs = sorted({r.lang for r in learned})
    counts = {(lang, n): Counter() for lang in langs for n in range(6)}         # 0: words, n: n-grams
    for r in learned:
        counts[r.lang, 0].update(letters(r.text))
        for n in range(1, 6):
            counts[r.lang, n].update(g for w in letters(r.text) for g in grams(w, n))
    known = {n: set().union(*(counts[x, n] for x in langs)) for n in range(6)}
    size = {k: (sum(c.values()), len(c)) for k, c in counts.items()}
    share = Counter(r.lang for r in learned)

    def log(lang, n, feature):
        total, kinds = size[lang, n]
        return math.log((counts[lang, n][feature] + 0.5) / (total + 0.5 * kinds + 1))

    def score(lang, word):
        if word in known[0]:
            return log(lang, 0, word)
        for n in range(5, 0, -1):
            found = [log(lang, n, g) for g in grams(word, n) if g in known[n]]
            if found:
                return sum(found) / len(found)
        return 0.0

    out = []
    for r in rows:
        words = Counter(letters(r.text))
        sums = {x: math.log(share[x] / len(learned)) + sum(c * score(x, w) for w, c in words.items()) for x in langs}
        out.append(max(langs, key=lambda x: sums[x]) if words else "und")
    return out


def brute_redacted(text):
    spans = sorted((m.start(), m.end()) for p, g, n in SECRETS for m in re.finditer(p, text, re.ASCII) if len(m[g]) >= n)
    out, at = "", 0
    for a, b in spans:
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def test_run_matches_brute_force(spark, tokenizer):  # noqa: F811
    rows = spark.read.parquet(f"{DIR}/documents.parquet").collect()
    kept = [(r, lang) for r, lang in zip(rows, brute_languages(rows), strict=True) if lang != "und"]
    found = brute_components([(r.doc_id, r.text) for r, _ in kept], 5)
    kept = [(r, lang) for r, lang in kept if found[r.doc_id][1] == r.doc_id]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    hit = {i for i, _, n, _ in brute_hits([(r.doc_id, r.text) for r, _ in kept], items) if n}
    assert 0 < len(hit) < len(kept) < len(rows)
    want = {r.doc_id: (lang, r.source, tokenizer[0].encode(brute_redacted(r.text), add_special_tokens=False).ids)
            for r, lang in kept if r.doc_id not in hit}
    got = P.run(spark, DIR)
    assert got.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]
    got = got.collect()
    assert len(got) == len(want) and all(r.n_tokens == len(r.ids) for r in got)
    assert {r.doc_id: (r.lang, r.source, r.ids) for r in got} == want


def test_stages_on_edge_rows(spark):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "12 34", None, "s", 5), (None, "the word of it", "en", "s", 14),
            (5, "the word of it", None, None, None), (5, "the word of it", None, None, None), (6, "token = 'abcdefghijklmnop' the", "en", "s", 9)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, id int")
    docs = docs.select("*", *[F.lit(1).alias(c) for c in CLASHING])
    for name, stage in P.STAGES:
        docs = stage(spark, docs if stage is P.language_id else docs.select("*", *[F.lit(1).alias(c) for c in CLASHING]), DIR)
        if stage is not P.encoding:
            assert docs.columns == P.COLUMNS
        if stage is P.language_id:
            assert docs.count() == 4
        if stage is P.secret_scan:
            assert sorted(r.text for r in docs.collect()) == ["[SECRET]' the", "the word of it"]
    assert sorted(map(str, (r.doc_id for r in docs.collect()))) == ["5", "6"]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_decontamination_judges_rows_not_ids(spark):
    leaked = spark.read.parquet(f"{DIR}/benchmark.parquet").filter("size(split(trim(text), ' +')) >= 10").first().text
    clean = [(None, "a clean text without an id"), (None, None), (7, "a clean text under a repeated id"), (8, "a clean text")]
    docs = documents(spark, [(None, leaked), (7, f"see {leaked} there"), (9, leaked), *clean])
    got = P.decontamination(spark, docs, DIR).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(clean, key=str)


def test_near_dedup_links_texts_not_ids(spark):
    words = [f"w{i}" for i in range(90)]
    one, two, three, four = (" ".join(f"{x}{w}" for w in words) for x in "abcd")
    near = one + " tail"
    rows = [(5, one), (5, two), (5, three), (6, near), (4, two), (4, two), (None, four), (None, four + " tail"), (None, four), (None, "x y"),
            (9, " "), (None, one), (None, near)]
    got = P.near_dedup(spark, documents(spark, rows), DIR).collect()
    named = sorted((r.doc_id, r.text) for r in got if r.doc_id is not None)
    assert named == sorted([(5, one), (5, three), (4, two), (9, " ")])
    unnamed = [r.text for r in got if r.doc_id is None]
    assert len(unnamed) == 2 and "x y" in unnamed and any(t.startswith(four) for t in unnamed)


@pytest.mark.parametrize("stage", [f for _, f in P.STAGES])
def test_empty_documents(spark, stage):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert stage(spark, empty, DIR).count() == 0
