"""Toxicity of texts after noisy-channel deobfuscation.

Restoring.  Spans that look disguised are found in the lower-cased text: tokens
with symbols or digits before or between letters (``1d!ot``, ``$cum``), single
characters with one separator between them (``i d-i o t``), and words with a
letter three times in a row (``idiiiot``).  A span becomes a lattice: a letter
stays; a symbol is one of the letters it stands for, or a word break; a
separator vanishes or is a word break; a repeated letter is written once, twice
or as it stands.  Viterbi decoding takes the path with the best sum of channel
costs and a character language model (the letter given the two before it),
which is counted over the words of *all* documents by a Spark aggregate, so it
grows with them.  Its counts live in ``LM_CELLS`` hashed cells, a fixed size.
A span of more than ``PIECE`` characters is decoded in pieces of that length.

Scoring.  Features of the restored text are its distinct words and their
character n-grams of ``SIZES`` (word edges count as a character), in
``CELLS`` hashed cells.  From at most ``per_label`` labelled documents of each
class (those with the smallest hash of their id) a Spark aggregate counts the
documents of each class with each cell.  A cell is a feature if it leans to
toxic documents and its likelihood-ratio statistic is over
``2 ln(number of cells seen)``; an MLlib logistic regression over the presence
of these cells, fitted on the same documents, gives the score.  Where a class
was sampled, its intercept is corrected to the classes' true numbers.

Defined results: null and empty texts score like a text without any weighing
word; without labelled documents every score is 0, with one class only it is
that class; null ids and labels are not learned; a document labelled twice is
toxic if any label says so; of several documents with one id the one whose text
has the smallest hash is learned; repeated rows are scored alike; an empty
table gives an empty result; other columns are kept or ignored, whatever their
names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import need, write_and_read
from .langid import letter_table, letter_words
from .textkernel import SpanHasher, gather, mix, rows_of, runs, text_slices

PER_LABEL = 10_000
LM_CELLS, CELLS = 1 << 18, 1 << 20
SIZES = (5, 7)
LEAST_DOCUMENTS = 3
REGULARISATION = 1e-6
PIECE = 256
SPACE = 0x20

# fixed values: the letters that a symbol may stand for
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou", "2": "", "6": "g"}
SEPARATORS = " .-_"
# fixed values: log costs of the channel
SUBSTITUTE, BREAK, JOIN, PART, ONCE, TWICE = -1.0, -6.0, -0.5, -2.0, -1.0, -1.2


def _table(chars: str) -> np.ndarray:
    t = np.zeros(0x110000, bool)
    t[[ord(c) for c in chars]] = True
    return t


# ---------------------------------------------------------------- language model
def lm_cells(order: int, key: np.ndarray) -> np.ndarray:
    salt = np.uint64(order * 0x9E3779B97F4A7C15 % (1 << 64))
    return (mix(key.astype(np.uint64) + salt) & np.uint64(LM_CELLS - 1)).astype(np.int64)


def padded(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words one after the other with a space before, between and after them, and each place's word (-1: space)."""
    sizes = ends - starts
    out = np.full(int(sizes.sum()) + len(sizes) + 1, SPACE, np.uint64)
    owner = np.full(len(out), -1, np.int64)
    if len(sizes):
        inner = np.ones(len(out), bool)
        inner[np.concatenate([[0], np.cumsum(sizes + 1)])] = False
        out[inner] = gather(starts, sizes, points).astype(np.uint64)
        owner[inner] = np.repeat(np.arange(len(sizes)), sizes)
    return out, owner


def ngram_counts(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Counts by cell of letters, pairs and triples (two spaces before a word, one after it)."""
    text, owner = padded(points, starts, ends)
    if len(starts) == 0:
        return np.zeros(LM_CELLS, np.int64)
    # a place's letter given the two before; spaces count as the end of the word before them
    c = text[1:]
    b = text[:-1]
    a = np.concatenate([[SPACE], text[:-2]]).astype(np.uint64)
    a = np.where(b == SPACE, np.uint64(SPACE), a)
    weight = times[np.where(owner[1:] >= 0, owner[1:], owner[:-1])]
    pair = (a << np.uint64(21)) | b
    out = np.zeros(LM_CELLS, np.int64)
    for order, key in ((1, c), (2, pair), (3, (pair << np.uint64(21)) | c)):
        out += np.bincount(lm_cells(order, key), weights=weight, minlength=LM_CELLS).astype(np.int64)
    return out


def language_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Cell counts over the words of all documents (``LM_CELLS`` numbers, whatever the corpus)."""
    need(docs, text_col)
    letters = letter_table()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = SpanHasher(1 << 18), np.zeros(LM_CELLS, np.int64)
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 22):
                points, starts, ends, _ = letter_words(part.column("text").to_pylist(), letters)
                _, first, times = np.unique(hasher.hashes(points, starts, ends), return_index=True, return_counts=True)
                total += ngram_counts(points, starts[first], ends[first], times)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(total[cells])], names=["cell", "n"])

    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "cell int, n bigint")
    got = counted.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(LM_CELLS, np.int64)
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return out


class Decoder:
    """Viterbi decoding of suspicious spans; found results are remembered up to a number of entries."""

    MEMO = 100_000

    def __init__(self, counts: np.ndarray, letters: np.ndarray):
        self.counts, self.letters = counts, letters
        self.symbols, self.written, self.between = _table("".join(LEET)), _table("0123456789@$"), _table(SEPARATORS)
        self.total = float(max(1, counts[lm_cells(2, np.array([(SPACE << 21) | SPACE]))[0]]))
        self.logs: dict[tuple[str, str, str], float] = {}
        self.memo: dict[str, str] = {}

    def log_share(self, a: str, b: str, c: str) -> float:
        """Log probability of ``c`` after ``a``, ``b``, smoothed by that of the letter alone."""
        key = (a, b, c)
        got = self.logs.get(key)
        if got is None:
            pair = (ord(a) << 21) | ord(b)
            one, two, three = (float(self.counts[lm_cells(n, np.array([k]))[0]]) for n, k in
                               ((1, ord(c)), (2, pair), (3, (pair << 21) | ord(c))))
            alone = (one + 0.5) / (8.0 * self.total + 0.5 * 4096)
            got = math.log((min(three, two) + 2.0 * alone) / (two + 2.0))
            if len(self.logs) < 4 * self.MEMO:
                self.logs[key] = got
        return got

    def lattice(self, span: str) -> list[list[tuple[str, float]]]:
        """Choices (output, cost) of each place of a lower-cased span."""
        out, i = [], 0
        while i < len(span):
            c, j = span[i], i + 1
            while j < len(span) and span[j] == c:
                j += 1
            n = j - i
            if self.letters[ord(c)]:
                out.append([(c * n, 0.0)] if n < 3 else [(c * n, 0.0), (c, ONCE), (c * 2, TWICE)])
            elif c in LEET:
                for _ in range(n if n < 3 else 1):
                    out.append([(x, SUBSTITUTE) for x in LEET[c]] + [(" ", BREAK)])
            else:
                out.append([("", JOIN), (" ", PART)])
            i = j
        return out

    def _best(self, span: str) -> str:
        states: dict[tuple[str, str], tuple[float, tuple | None]] = {(" ", " "): (0.0, None)}
        for choices in self.lattice(span):
            new: dict[tuple[str, str], tuple[float, tuple | None]] = {}
            for (a, b), (score, back) in states.items():
                for text, cost in choices:
                    x, y, s = a, b, score + cost
                    for c in text:
                        if c == " " and y == " ":
                            continue
                        s += self.log_share(x, y, c)
                        x, y = (" ", " ") if c == " " else (y, c)
                    old = new.get((x, y))
                    if old is None or s > old[0]:
                        new[(x, y)] = (s, (back, text))
            states = new
        ended = [(s + (0.0 if b == " " else self.log_share(a, b, " ")), back) for (a, b), (s, back) in states.items()]
        back, parts = max(ended, key=lambda e: e[0])[1], []
        while back is not None:
            back, text = back
            parts.append(text)
        return "".join(reversed(parts))

    def decode(self, span: str) -> str:
        """The most likely words behind a span, in pieces of at most ``PIECE`` characters."""
        got = self.memo.get(span)
        if got is None:
            got = "".join(self._best(span[i:i + PIECE]) for i in range(0, len(span), PIECE))
            if len(self.memo) < self.MEMO and len(span) <= PIECE:
                self.memo[span] = got
        return got

    # ------------------------------------------------------------ spans
    def spans(self, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the suspicious spans of lower-cased texts, in order."""
        letter, symbol = self.letters[points], self.symbols[points]
        starts, ends = runs(letter | symbol, offsets)
        n = len(starts)
        if n == 0:
            return starts, ends
        owner = np.zeros(len(points), np.int64)
        owner[starts] = 1
        owner = np.cumsum(owner) - 1
        inside = np.zeros(len(points), bool)
        inside[1:] = (owner[1:] == owner[:-1]) & (letter | symbol)[1:] & (letter | symbol)[:-1]
        rise = np.flatnonzero(inside[1:] & symbol[:-1] & ~letter[:-1] & letter[1:]) + 1   # a symbol, then this letter
        fall = np.flatnonzero(inside[1:] & letter[:-1] & symbol[1:] & ~letter[1:]) + 1     # a letter, then this symbol
        last_rise, first_fall = np.full(n, -1, np.int64), np.full(n, len(points), np.int64)
        np.maximum.at(last_rise, owner[rise], rise)
        np.minimum.at(first_fall, owner[fall], fall)
        first_rise = np.full(n, len(points), np.int64)
        np.minimum.at(first_rise, owner[rise], rise)
        odd = last_rise > first_fall
        odd |= ~letter[starts] & (first_rise - starts <= 2)
        # three equal letters in a row
        same = np.flatnonzero(letter[2:] & (points[2:] == points[1:-1]) & (points[1:-1] == points[:-2]) & inside[2:] & inside[1:-1])
        odd[owner[same]] = True
        # symbols after the last letter belong to the token if they are one or two digits, @ or $
        kept = np.flatnonzero(letter)
        at = np.searchsorted(kept, ends) - 1
        tail = np.where(at >= 0, kept[np.maximum(at, 0)] + 1, starts) if len(kept) else starts
        voiced = tail > starts
        last = np.minimum(tail, len(points) - 1)
        close = voiced & (ends > tail) & (ends - tail <= 2) & self.written[points[last]] & self.written[points[ends - 1]]
        odd |= close
        tail = np.where(close, ends, tail)
        odd &= voiced
        a, b = starts[odd], tail[odd]
        # chains of single characters with one separator between them
        if n >= 3:
            single = ends - starts == 1
            row = rows_of(starts, offsets)
            linked = (single[:-1] & single[1:] & (starts[1:] - ends[:-1] == 1) & (row[1:] == row[:-1])
                      & self.between[points[np.minimum(ends[:-1], len(points) - 1)]])
            first, last = runs(linked, np.array([0, len(linked)]))
            voiced = np.concatenate([[0], np.cumsum(letter[starts])])
            long = (last - first >= 2) & (voiced[last + 1] - voiced[first] >= 2) if len(first) else np.zeros(0, bool)
            a, b = np.concatenate([a, starts[first[long]]]), np.concatenate([b, ends[last[long]]])
        order = np.argsort(a, kind="stable")
        return a[order], b[order]

    def restore(self, texts: list) -> list[str]:
        """Lower-cased texts with their suspicious spans decoded; null is empty."""
        low = ["" if t is None else t.lower() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in low], dtype=np.int64)])
        points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts, ends = self.spans(points, offsets)
        cuts: dict[int, list[tuple[int, int]]] = {}
        for r, a, b in zip(rows_of(starts, offsets).tolist(), starts.tolist(), ends.tolist(), strict=True):
            cuts.setdefault(r, []).append((a - int(offsets[r]), b - int(offsets[r])))
        for r, where in cuts.items():
            text, at, out = low[r], 0, []
            for a, b in where:
                out += [text[at:a], self.decode(text[a:b])]
                at = b
            low[r] = "".join([*out, text[at:]])
        return low


# ---------------------------------------------------------------- features
def word_cells(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, cell) of the words and their n-grams; a pair may repeat."""
    text, owner = padded(points, starts, ends)
    space = np.concatenate([[0], np.cumsum(text == SPACE)])
    word, cell = [np.arange(len(starts))], [mix(hashes ^ np.uint64(0xA5A5A5A5)) & np.uint64(CELLS - 1)]
    h, base = np.zeros(len(text), np.uint64), np.uint64(0x9E3779B97F4A7C15)
    for n in range(1, max(SIZES) + 1):
        m = len(text) - n + 1
        if m <= 0:
            break
        h = h[:m] * base + mix(text[n - 1:n - 1 + m] + np.uint64(1))
        if n in SIZES:
            # no space strictly inside the window
            ok = np.flatnonzero(space[n - 1:n - 1 + m] - space[1:1 + m] == 0)
            word.append(owner[ok + 1])
            cell.append(mix(h[ok] + np.uint64(n)) & np.uint64(CELLS - 1))
    return np.concatenate(word), np.concatenate(cell).astype(np.int64)


def _words(texts: list[str], letters: np.ndarray, hasher: SpanHasher):
    """Distinct words of a slice: (points, starts, ends, hashes), and the distinct (text, word) pairs."""
    points, starts, ends, bounds = letter_words(texts, letters)
    hashes, first, each = np.unique(hasher.hashes(points, starts, ends), return_index=True, return_inverse=True)
    row = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(bounds))
    pairs = np.unique(row * max(1, len(hashes)) + each)
    return (points, starts[first], ends[first], hashes), pairs // max(1, len(hashes)), pairs % max(1, len(hashes))


def cell_pairs(texts: list[str], letters: np.ndarray, hasher: SpanHasher, index: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, cell) pairs in order; with ``index``, of the cells that it numbers (-1: none), by their numbers."""
    words, row, each = _words(texts, letters, hasher)
    if not len(row):
        return row, row
    word, cell = word_cells(*words)
    if index is not None:
        cell = index[cell]
        word, cell = word[cell >= 0], cell[cell >= 0]
    order = np.argsort(word, kind="stable")
    word, cell = word[order], cell[order]
    first = np.searchsorted(word, np.arange(len(words[3])))
    size = np.searchsorted(word, np.arange(len(words[3])), "right") - first
    pairs = np.unique(np.repeat(row, size[each]) * CELLS + gather(first[each], size[each], cell))
    return pairs // CELLS, pairs % CELLS


def cell_index(cells: np.ndarray) -> np.ndarray:
    """Number of each cell among the features, -1 for others."""
    out = np.full(CELLS, -1, np.int64)
    out[cells] = np.arange(len(cells))
    return out


# ---------------------------------------------------------------- training
def training_rows(docs: DataFrame, labels: DataFrame, counts: np.ndarray, id_col: str, text_col: str, label_col: str,
                  per_label: int) -> tuple[DataFrame, dict[int, int]]:
    """(``toxic`` (0 or 1) and the restored ``text`` of the documents learned from, in shared scratch; number of labelled ids by class)."""
    known = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic")))
    totals = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for c in (0, 1):
        one = known.filter(F.col("toxic") == c).orderBy(F.xxhash64("_id"), "_id").limit(per_label)
        picked = one if picked is None else picked.unionAll(one)
    # 2 * per_label rows at most
    picked = F.broadcast(picked)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = (rows.join(picked, F.col("id") == F.col("_id")).groupBy("id", "toxic")
            .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")))
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    letters = letter_table()

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value, letters)
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 21):
                yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(decoder.restore(part.column("text").to_pylist()), pa.string())],
                                                 names=["toxic", "text"])

    return write_and_read(rows.select("toxic", "text").mapInArrow(restore, "toxic int, text string"), "labelled"), totals


def cell_counts(rows: DataFrame) -> DataFrame:
    """``cell`` and the numbers of other and of toxic documents with it, ``n0`` and ``n1``, in shared scratch."""
    letters = letter_table()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = SpanHasher(1 << 18), np.zeros((2, CELLS), np.int64)
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                row, cell = cell_pairs(part.column("text").to_pylist(), letters, hasher)
                np.add.at(total, (part.column("toxic").to_numpy()[row], cell), 1)
        cells = np.flatnonzero(total.any(axis=0))
        for i in range(0, len(cells), 1 << 16):
            some = cells[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *[pa.array(t[some]) for t in total]], names=["cell", "n0", "n1"])

    found = rows.mapInArrow(count, "cell int, n0 bigint, n1 bigint")
    return write_and_read(found.groupBy("cell").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "cells")


def telling(n1: np.ndarray, n0: np.ndarray, toxic: int, other: int, cells: int) -> np.ndarray:
    """Whether cells seen in ``n1`` of the ``toxic`` and ``n0`` of the ``other`` documents lean to toxic ones beyond chance."""
    a, b, q = n1.astype(float), n0.astype(float), toxic / (toxic + other)
    n = np.maximum(a + b, 1.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(a > 0, a * np.log(a / (n * q)), 0.0) + np.where(b > 0, b * np.log(b / (n * (1 - q))), 0.0))
    return (a >= LEAST_DOCUMENTS) & (a * other > b * toxic) & (g > 2 * math.log(max(2, cells)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          per_label: int = PER_LABEL, corpus: DataFrame | None = None) -> dict:
    """Model of bounded size: language model cells, feature cells with their weights, intercept.

    ``docs`` are those that may be learned from; ``corpus`` (``docs`` if not
    given) is all documents, for the language model, which uses no labels."""
    need(docs, id_col, text_col)
    need(labels, id_col, label_col)
    counts = language_model(docs if corpus is None else corpus, text_col)
    rows, totals = training_rows(docs, labels, counts, id_col, text_col, label_col, per_label)
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    other, toxic = sizes.get(0, 0), sizes.get(1, 0)
    model: dict = {"lm": counts, "cells": np.zeros(0, np.int64), "weights": np.zeros(0)}
    if not other or not toxic:
        return model | {"intercept": math.inf if toxic else -math.inf}
    table = cell_counts(rows)
    # CELLS rows at most, and fewer as they must lean to toxic documents
    leaning = table.filter((F.col("n1") >= LEAST_DOCUMENTS) & (F.col("n1") * other > F.col("n0") * toxic)).toArrow()
    n1, n0 = leaning.column("n1").to_numpy(), leaning.column("n0").to_numpy()
    use = np.flatnonzero(telling(n1, n0, toxic, other, table.count()))
    use = use[np.argsort(leaning.column("cell").to_numpy()[use])]
    cells = leaning.column("cell").to_numpy().astype(np.int64)[use]
    # how much thinner the other class was sampled than the toxic one
    thinner = (totals[0] / other) / (totals[1] / toxic)
    if not len(cells):
        return model | {"intercept": math.log(toxic / other) - math.log(thinner)}
    shared = docs.sparkSession.sparkContext.broadcast(cells)
    letters = letter_table()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, index = SpanHasher(1 << 18), cell_index(shared.value)
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                row, cell = cell_pairs(part.column("text").to_pylist(), letters, hasher, index)
                bounds = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.ListArray.from_arrays(pa.array(bounds), pa.array(cell.astype(np.int32)))],
                                                 names=["toxic", "present"])

    # at most 2 * per_label rows: a row-wise function turns them into sparse vectors
    width = len(cells)
    vector = F.udf(lambda at: Vectors.sparse(width, at, [1.0] * len(at)), VectorUDT())
    points = write_and_read(rows.mapInArrow(measure, "toxic int, present array<int>"), "present")
    points = points.select(F.col("toxic").cast("double").alias("label"), vector("present").alias("features"))
    fitted = LogisticRegression(regParam=REGULARISATION, maxIter=100, standardization=False).fit(points)
    return model | {"cells": cells, "weights": fitted.coefficients.toArray(), "intercept": float(fitted.intercept) - math.log(thinner)}


# ---------------------------------------------------------------- scoring
def predict(df: DataFrame, model: dict, text_col: str = "text", score_name: str = "score", predicted_name: str = "predicted",
            restored_name: str | None = None) -> DataFrame:
    """All columns of ``df``, the score, whether it is 0.5 or more, and the restored
    text if it has a name (columns of these names are replaced)."""
    need(df, text_col)
    names = [score_name, predicted_name, *([restored_name] if restored_name else [])]
    own = "_text"
    while own in df.columns:
        own += "_"
    src = df.withColumn(own, F.col(text_col).cast("string")).drop(*names)
    schema = src.drop(own).select("*", F.lit(0.0).alias(score_name), F.lit(0).alias(predicted_name),
                                               *([F.lit("").alias(restored_name)] if restored_name else [])).schema
    shared = df.sparkSession.sparkContext.broadcast(model)
    letters = letter_table()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hasher = shared.value, SpanHasher(1 << 18)
        decoder, index = Decoder(model["lm"], letters), cell_index(model["cells"])
        for batch in batches:
            for part in text_slices(batch, own, 1 << 21):
                texts = decoder.restore(part.column(own).to_pylist())
                row, cell = cell_pairs(texts, letters, hasher, index)
                z = np.bincount(row, weights=model["weights"][cell], minlength=len(texts)) + model["intercept"]
                p = np.where(np.isinf(z), (z > 0).astype(float), 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700))))
                more = [pa.array(texts, pa.string())] if restored_name else []
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(p), pa.array((p >= 0.5).astype(np.int32)), *more],
                                                 names=[*part.schema.names[:-1], *names])

    return src.mapInArrow(score, schema)


def held_out(id_col: str = "doc_id"):
    """Whether a row is held out of training: crc32 of the id as text is divisible by 5 (null ids are not)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
