"""Deobfuscation against an enumeration of all paths, the language model against counts, and toxicity on held-out rows."""

import itertools
import math
import os
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opsflow.llm import queries, toxicity
from opsflow.llm.langid import letter_table

LETTERS = letter_table()
SCHEMA = "doc_id bigint, text string, score string, predicted string, _text string, toxic double"
CORPUS = ["the idiot was a stupid clown and the loser was an idiot", "such trash such scum the idiot", "stop the moron at the pathetic shop",
          "Straße der Idioten, été", "worthless worthless hello world", None, ""]


def corpus_model(spark, texts=CORPUS):
    return toxicity.language_model(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string"))


def brute_words(text):
    out, word = [], ""
    for c in (text or "").lower() + " ":
        if LETTERS[ord(c)]:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def test_language_model_counts_every_word(spark):
    got = corpus_model(spark, CORPUS * 3)
    want = np.zeros(toxicity.LM_CELLS, np.int64)
    for text in CORPUS * 3:
        for w in brute_words(text):
            a = b = " "
            for c in w + " ":
                pair = (ord(a) << 21) | ord(b)
                for order, key in ((1, ord(c)), (2, pair), (3, (pair << 21) | ord(c))):
                    want[toxicity.lm_cells(order, np.array([key]))[0]] += 1
                a, b = b, c
    assert (got == want).all()


@pytest.mark.parametrize("span", ["1d10t", "$cum", "i d i o t", "stuuuupid", "l0$er", "m.o-r", "w0rthle55", "aaa1bbb", "7rash", "1 d 1 0 7"])
def test_decoding_takes_the_best_of_all_paths(spark, span):
    d = toxicity.Decoder(corpus_model(spark), LETTERS)

    def cost(path):
        a = b = " "
        total = 0.0
        for text, c in path:
            total += c
            for x in text:
                if x == " " and b == " ":
                    continue
                total += d.log_share(a, b, x)
                a, b = (" ", " ") if x == " " else (b, x)
        return total + (0.0 if b == " " else d.log_share(a, b, " "))

    paths = list(itertools.product(*d.lattice(span)))
    best = max(cost(p) for p in paths)
    got = d.decode(span)
    assert any("".join(t for t, _ in p) == got and math.isclose(cost(p), best, rel_tol=1e-12) for p in paths)


def test_restored_words(spark):
    d = toxicity.Decoder(corpus_model(spark, CORPUS * 50), LETTERS)
    assert d.restore(["you 1d10t", "An i d i o t here", "stuuuupid!!!", "the l0$er", "p@thet1c $cum", "cl0wn"]) == \
        ["you idiot", "an idiot here", "stupid!!!", "the loser", "pathetic scum", "clown"]
    plain = ["nothing odd here, on 555-1234", "a b", "HELLO!! world$$$", "", "x" * 2, "1 2 3 4"]
    assert d.restore(plain) == [t.lower() for t in plain]
    # a span never joins two texts
    assert d.restore(["id", "1", "ot", None, "a", "b", "c"]) == ["id", "1", "ot", "", "a", "b", "c"]
    long = "ab1" * 100_000 + "z"
    assert len(d.restore([long])[0]) >= 200_000


def test_cells_of_words_match_a_plain_version():
    words = ["idiot", "a", "worthless", "été"]
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(w) for w in words])
    hashes = np.arange(4, dtype=np.uint64)
    word, cell = toxicity.word_cells(points, ends - [len(w) for w in words], ends, hashes)
    counts = Counter(word.tolist())
    for i, w in enumerate(words):
        assert counts[i] == 1 + sum(max(0, len(w) + 2 - n + 1) for n in toxicity.SIZES)
    # the same n-gram (here: idiot) has the same cell wherever it stands
    more = np.frombuffer("xxidiotyy".encode("utf-32-le"), np.uint32)
    _, other = toxicity.word_cells(more, np.array([0]), np.array([9]), np.full(1, 99, np.uint64))
    assert len(set(cell[word == 0].tolist()) & set(other.tolist())) == 1


def planted(n):
    """Texts of invented words; every fourth is toxic, and half of those are disguised."""
    rng = np.random.default_rng(9)
    bad, disguised = ["blorgface", "snarfhead", "wumpling"], {"blorgface": "bl0rgf@ce", "snarfhead": "s n a r f h e a d", "wumpling": "wuuuump1ing"}
    plain = ["".join(rng.choice(list("abdeilmnorstu"), 6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = rng.choice(plain, 30).tolist()
        toxic = i % 4 == 0
        if toxic:
            w = bad[(i // 4) % 3]
            words[7] = disguised[w] if i % 8 == 0 and i > n // 2 else w
        rows.append((i, " ".join(words), "x", "y", "z", 0.5))
        labels.append((i, int(toxic)))
    return rows, labels


def test_disguised_words_are_caught_and_clean_texts_are_not(spark):
    rows, labels = planted(600)
    docs = spark.createDataFrame(rows, SCHEMA)
    # labels of the first half only; the disguised ones are in the other
    known = spark.createDataFrame([x for x in labels if x[0] <= 300], "doc_id bigint, toxic int")
    model = toxicity.train(docs, known)
    got = {r.doc_id: r for r in toxicity.predict(docs, model, restored_name="restored").collect()}
    want = dict(labels)
    assert all(r.predicted == want[i] == int(r.score >= 0.5) for i, r in got.items())
    assert "snarfhead" in got[352].restored + got[376].restored + got[400].restored
    assert toxicity.predict(docs, model).columns == ["doc_id", "text", "_text", "toxic", "score", "predicted"]


def test_sampling_keeps_the_prior(spark):
    rows, labels = planted(600)
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.train(docs, known, per_label=100)
    clean = toxicity.predict(spark.createDataFrame([(1, "")], "doc_id bigint, text string"), model).first()
    assert clean.score < 0.25 and clean.predicted == 0


def test_edges(spark):
    rows, labels = planted(80)
    docs = spark.createDataFrame(rows, SCHEMA)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    edge = spark.createDataFrame([(1, None, "", "", "", 0.0), (None, "", "", "", "", 0.0), (1, "x" * 400_000, "", "", "", 0.0),
                                  (1, "x" * 400_000, "", "", "", 0.0), (2, " \t\n", "", "", "", 0.0), (3, "\U0001F600 1 @ !", "", "", "", 0.0)], SCHEMA)
    unlearned = toxicity.predict(edge, toxicity.train(docs, none)).collect()
    assert [(r.score, r.predicted) for r in unlearned] == [(0.0, 0)] * 6
    one = spark.createDataFrame([(i, 1) for i, _ in labels] + [(None, 0), (2, None)], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.predict(edge, toxicity.train(docs, one)).collect()} == {1.0}
    # a document labelled twice, repeated ids and rows, null texts among the learned
    twice = spark.createDataFrame(labels + [(1, 1), (0, 0)], "doc_id bigint, toxic int")
    model = toxicity.train(docs.unionAll(docs).unionAll(edge), twice)
    got = toxicity.predict(edge, model).collect()
    assert len(got) == 6 and len({r.score for r in got if not (r.text or "").strip("x \t\n")}) == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert toxicity.predict(empty, toxicity.train(empty, none)).count() == 0


def test_held_out_accuracy_of_the_query(spark):
    """On rows whose labels were not learned: nearly no clean text is called toxic, most toxic ones are caught."""
    d = "/root/testdata/sf0.1"
    got = queries.op12_toxicity(spark, d)
    rows = got.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("held_out").select("toxic", "score", "predicted").collect()
    assert got.count() == 10_000
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    better = np.array([[r.score] for r in toxic]) > np.array([[r.score for r in clean]])
    assert better.mean() > 0.93
