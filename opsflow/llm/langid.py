"""Language identification by words first, then shorter and shorter n-grams.

Words are runs of letters, lower-cased.  A word known from the training texts
adds its log frequency in each language; an unseen word backs off to its known
character n-grams of 5 letters, of 4 if it has none, and so on down to 1 (word
edges count as a character), and adds their mean.  The language with the
largest sum plus the log share of the language among all labelled texts with
letters wins; the score is its posterior probability.

Word counts come from about ``per_language`` different texts of each language,
the ones whose hash lies under a threshold set by the language's number of
different texts (by a sketch; all texts if there are not more rows than that).
Copies of a chosen text weigh as often as they occur, but are cut into words
once a batch.  Counts come from a Spark aggregate.
The model keeps every word and n-gram of the sample, as sorted 64-bit hashes
with one number for each language; the bound on the sample is the only one.

Defined results: a null text or one without letters is ``und`` with score 0; so
is every text when no text was learned from; a text with letters but no known
word or letter gets the most frequent language; ties go to the language first
in text order; labels that are null, and texts without letters, are not learned; other columns are kept or
ignored, whatever their names.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import need
from .textkernel import SpanHasher, gather, mix, runs, span_bounds, text_slices

PER_LANGUAGE = 4000
ORDER = 5
UND = "und"


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)], bool)


def letter_words(texts: list, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code points, starts, ends, first word of each text and the total) of lower-cased texts."""
    low = ["" if t is None else t.lower() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in low], dtype=np.int64)])
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts, ends = runs(letters[points], offsets)
    return points, starts, ends, span_bounds(starts, offsets)


def gram_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, hash) of every n-gram of the words; a space at both ends of a word counts if ``n`` is over 1."""
    sizes = ends - starts
    if not len(sizes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    edge = 1 if n > 1 else 0
    places = np.cumsum(sizes + 2 * edge) - (sizes + 2 * edge)
    text = np.full(int(sizes.sum()) + 2 * edge * len(sizes), 0x20, np.uint64)
    letters = np.ones(len(text), bool)
    if edge:
        letters[places] = letters[places + sizes + 1] = False
    text[letters] = gather(starts, sizes, points).astype(np.uint64)
    first = np.maximum(sizes + 2 * edge - n + 1, 0)
    word = np.repeat(np.arange(len(sizes)), first)
    at = gather(places, first, np.arange(len(text)))
    h = np.zeros(len(at), np.uint64)
    for k in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + mix(text[at + k] + np.uint64(1))
    return word, mix(h + np.uint64(n))


def train_counts(docs: DataFrame, text_col: str, lang_col: str, per_language: int = PER_LANGUAGE) -> tuple[DataFrame, dict]:
    """``lang``, ``kind`` (0: text, -1: word, n: n-gram), ``feature`` (hash), ``n`` over the training sample, and the
    number of labelled rows with letters of each language."""
    # letters newer than the JVM's tables are unassigned there
    labelled = (docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).cast("string").rlike(r"[\p{L}\p{Cn}]"))
                .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")))
    # one row per language; a hash threshold of the wanted share of each: no sort, texts are not shuffled
    found = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64("text"), 0.01).alias("texts"))
    sizes, below = {}, {}
    for r in found.collect():
        sizes[r.lang], below[r.lang] = r.n, float(per_language) * (1 << 30) / max(1, min(r.n, r.texts))
    limits = F.create_map(*[F.lit(x) for pair in below.items() for x in pair]) if sizes else F.create_map()
    pick = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.try_element_at(limits, "lang")
    chosen = labelled.filter(pick) if sizes else labelled.limit(0)

    letters = letter_table()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher(1 << 16)
        for batch in batches:
            for part in text_slices(batch, "text"):
                copies = Counter(zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True))
                langs = sorted({lang for lang, _ in copies})
                own = np.array([langs.index(lang) for lang, _ in copies])
                times = np.array(list(copies.values()), np.int64)
                points, starts, ends, bounds = letter_words([t for _, t in copies], letters)
                words, first, each = np.unique(hasher.hashes(points, starts, ends), return_index=True, return_inverse=True)
                row = np.repeat(np.arange(len(copies)), np.diff(bounds))
                starts, ends = starts[first], ends[first]
                weights = [np.bincount(each[own[row] == k], weights=times[row[own[row] == k]], minlength=len(words)) for k in range(len(langs))]
                for k, lang in enumerate(langs):
                    yield rows_for(lang, 0, np.zeros(1, np.uint64), np.array([times[own == k].sum()]))
                # one kind at a time, so that only its n-grams are held
                for kind in (-1, *range(1, ORDER + 1)):
                    word, h = (np.arange(len(words)), words) if kind < 0 else gram_hashes(points, starts, ends, kind)
                    for lang, weight in zip(langs, weights, strict=True):
                        used = weight[word] > 0
                        keys, where = np.unique(h[used], return_inverse=True)
                        yield rows_for(lang, kind, keys, np.bincount(where, weights=weight[word[used]], minlength=len(keys)))

    def rows_for(lang: str, kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(keys), np.int32))), pa.array(np.full(len(keys), kind, np.int32)),
                                           pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "kind", "feature", "n"])

    counted = chosen.mapInArrow(count, "lang string, kind int, feature bigint, n bigint")
    return counted.groupBy("lang", "kind", "feature").agg(F.sum("n").alias("n")), sizes


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> dict:
    """Language names, log shares, and log frequencies of every word and n-gram of the sample by hash."""
    need(docs, text_col, lang_col)
    counts, sizes = train_counts(docs, text_col, lang_col, per_language)
    langs = sorted(sizes)
    if not langs:
        return {"langs": []}
    number = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")) - 1
    seen = counts.filter("kind <> 0").select(number.cast("int").alias("lang"), "kind", "feature", "n").toArrow()
    lang, kind, feature, n = (seen.column(c).to_numpy() for c in ("lang", "kind", "feature", "n"))
    # a language without a word in the sample can't be compared
    have = np.unique(lang[kind == -1])
    if not len(have):
        return {"langs": []}
    langs, lang = [langs[i] for i in have], np.searchsorted(have, lang)
    model: dict = {"langs": langs, "prior": np.log(np.array([sizes[x] for x in langs]) / sum(sizes[x] for x in langs))}
    for k in (-1, *range(1, ORDER + 1)):
        mine = kind == k
        keys, at = np.unique(feature[mine].view(np.uint64), return_inverse=True)
        wide = np.zeros((len(keys), len(langs)))
        wide[at, lang[mine]] = n[mine]
        total, kinds = wide.sum(axis=0), (wide > 0).sum(axis=0)
        model[k] = (keys, np.log((wide + 0.5) / (total + 0.5 * kinds + 1)).astype(np.float32))
    return model


def _known(table: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each hash is in the table, its place)."""
    keys = table[0]
    if not len(keys):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return keys[at] == hashes, at


def _backoff(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, model: dict) -> np.ndarray:
    """Of each word the mean of its known n-grams of the largest size that has any (0 without)."""
    value = np.zeros((len(starts), len(model["langs"])))
    left = np.arange(len(starts))
    for n in range(ORDER, 0, -1):
        if not len(left):
            break
        word, h = gram_hashes(points, starts[left], ends[left], n)
        known, at = _known(model[n], h)
        word, logs = word[known], model[n][1][at[known]]
        count = np.bincount(word, minlength=len(left))
        for k in range(value.shape[1]):
            value[left, k] = np.bincount(word, weights=logs[:, k], minlength=len(left)) / np.maximum(count, 1)
        left = left[count == 0]
    return value


def _score(texts: list, model: dict, letters: np.ndarray, hasher: SpanHasher) -> tuple[list, np.ndarray]:
    langs = model["langs"]
    points, starts, ends, bounds = letter_words(texts, letters)
    words, first, each = np.unique(hasher.hashes(points, starts, ends), return_index=True, return_inverse=True)
    value = np.zeros((len(words), len(langs)), np.float64)
    known, at = _known(model[-1], words)
    value[known] = model[-1][1][at[known]]
    unseen = first[~known]
    value[~known] = _backoff(points, starts[unseen], ends[unseen], model)
    total = np.zeros((len(starts) + 1, len(langs)))
    np.cumsum(value[each], axis=0, out=total[1:])
    sums = total[bounds[1:]] - total[bounds[:-1]] + model["prior"]
    best = sums.argmax(axis=1)
    share = np.exp(sums - sums.max(axis=1, keepdims=True))
    none = bounds[1:] == bounds[:-1]
    score = np.where(none, 0.0, share.max(axis=1) / share.sum(axis=1))
    return [UND if n else langs[i] for i, n in zip(best, none, strict=True)], score


def predict(df: DataFrame, model: dict, text_col: str = "text", lang_name: str = "lang_pred",
            score_name: str = "score") -> DataFrame:
    """All columns of ``df``, the predicted language and its score (columns of these names are replaced)."""
    need(df, text_col)
    src = df.drop(*[c for c in (lang_name, score_name) if c != text_col])
    schema = src.select("*", F.lit("").alias(lang_name), F.lit(0.0).alias(score_name)).schema
    shared = df.sparkSession.sparkContext.broadcast((model, letter_table()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (model, letters), hasher = shared.value, SpanHasher(1 << 18)
        for batch in batches:
            for part in text_slices(batch, text_col, 1 << 21):
                if model["langs"]:
                    langs, scores = _score(part.column(text_col).to_pylist(), model, letters, hasher)
                else:
                    langs, scores = [UND] * part.num_rows, np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores)],
                                                 names=[*part.schema.names, lang_name, score_name])

    return src.mapInArrow(score, schema)


def held_out(id_col: str = "doc_id"):
    """Whether a row is held out of training: crc32 of the id as text, modulo 4, is 2 (null ids are not)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
