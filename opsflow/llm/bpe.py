"""Byte-level BPE encoding with a minimal acyclic transducer, and decoding.

``build_lexicon`` counts the words of the whole corpus (words as the vocabulary's
splitting rule cuts them), takes the most frequent ones, merges each exactly
once, and compiles them into a minimal acyclic automaton with shared suffixes.
Its arcs carry additive outputs whose sum along a word is the word's rank, and
the rank points to the word's ids.  The automaton is one file of flat arrays in
the shared checkpoint folder, given to the executors with ``addFile`` and
memory-mapped by the tasks.

``encode`` cuts whole texts into words with array operations, walks all distinct
words of a slice through the automaton at once, and merges the words that it
does not hold exactly (a heap for long words), so the ids are the vocabulary's
own whatever the lexicon holds.  ``decode`` joins the tokens' bytes.

The lexicon's size is bounded (``LEXICON_WORDS`` words of at most
``LEXICON_BYTES`` bytes), so the driver holds a bounded file; the vocabulary is
a parameter and is broadcast (its size is fixed).

Defined results: a null or empty text has no ids and decodes to an empty text;
added tokens in a text (``<|endoftext|>``) get their own id; bytes that are no
UTF-8 decode to U+FFFD; a null list of ids decodes to an empty text; an empty
table gives an empty result; other columns are kept, and a column named like
the result is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
import uuid
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .frames import need, write_and_read
from .textkernel import gather, text_slices

LEXICON_WORDS, LEXICON_BYTES, MIN_COUNT = 131_072, 64, 2
SLICE = 1 << 20
MEMO_WORDS = 250_000
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
# fixed values: white space of the splitting rule (Unicode White_Space)
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# fixed values: contractions of the splitting rule
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


class Vocabulary:
    """A byte-level BPE file of the tokenizers library: ids by byte, merges, token bytes, added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        back = {chr(b): b for b in shown}
        back.update({chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)})
        ids = spec["model"]["vocab"]
        as_bytes = {token: bytes(back[c] for c in token) for token in ids}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = [b""] * (1 + max([*ids.values(), *self.added.values()]))
        for token, i in ids.items():
            self.tokens[i] = as_bytes[token]
        for token, i in self.added.items():
            self.tokens[i] = token.encode()
        self.byte_ids = [0] * 256
        for c, b in back.items():
            self.byte_ids[b] = ids[c]
        self.merges = {}                       # pair of ids as one number -> rank and merged id as one number
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault(ids[a] << 32 | ids[b], rank << 32 | ids[a + b])

    def merge(self, word: bytes) -> list[int]:
        """Exact ids of one word: always the pair of lowest rank, leftmost first."""
        byte_ids, rank_of, none = self.byte_ids, self.merges.get, 1 << 62
        parts = [byte_ids[b] for b in word]
        if len(parts) > 100:
            return self._merge_long(parts)
        ranks = [rank_of(a << 32 | b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i] = best & 0xFFFFFFFF
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] << 32 | parts[i], none)
            if i < len(ranks):
                ranks[i] = rank_of(parts[i] << 32 | parts[i + 1], none)
        return parts

    def _merge_long(self, parts: list) -> list[int]:
        merges, n = self.merges, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        keys = (a << 32 | b for a, b in zip(parts, parts[1:]))
        heap = [(merges[p], i, p) for i, p in enumerate(keys) if p in merges]
        heapq.heapify(heap)
        while heap:
            best, i, pair = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else n
            if j >= n or parts[i] << 32 | parts[j] != pair:
                continue
            parts[i], parts[j] = best & 0xFFFFFFFF, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (pair := parts[left] << 32 | parts[right]) in merges:
                    heapq.heappush(heap, (merges[pair], left, pair))
        return [p for p in parts if p is not None]


def class_table() -> np.ndarray:
    """Letter, number, space or other for each code point, as the installed tokenizers library has them.

    Code points that this Python's Unicode version does not know but ``regex`` does are asked of the library."""
    import regex
    from tokenizers import pre_tokenizers

    every = "".join(map(chr, [c if not 0xD800 <= c < 0xE000 else 0 for c in range(0x110000)]))
    kinds = np.array(list(map(unicodedata.category, every)))
    table = np.zeros(0x110000, np.uint8)
    table[np.char.startswith(kinds, "L")] = LETTER
    table[np.char.startswith(kinds, "N")] = NUMBER
    pieces = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    for c in regex.findall(r"[\p{L}\p{N}]", "".join(c for c, k in zip(every, kinds, strict=True) if k == "Cn")):
        table[ord(c)] = LETTER if len(pieces("a" + c)) == 1 else NUMBER if len(pieces("1" + c)) == 1 else OTHER
    table[WHITE_SPACE] = SPACE
    return table


def token_starts(points: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether a word of the splitting rule starts at each code point; ``offsets`` bound the texts."""
    n = len(points)
    kind = table[points]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    last, first = first[1:], first[:n]                       # of its text
    before = np.concatenate([[OTHER], kind[:-1]]).astype(np.uint8)
    change = first | (kind != before)
    start = change.copy()
    # of white space before something else, the last one goes apart, and a blank joins what follows
    follows = np.concatenate([kind[1:], [OTHER]]) != SPACE
    start |= (kind == SPACE) & follows & ~last
    blank = np.concatenate([[False], points[:-1] == 0x20]) & ~first
    start &= ~(blank & (kind != SPACE))
    at = np.flatnonzero((points == 0x27) & start)
    if len(at):
        room = offsets[np.searchsorted(offsets, at, "right")] - at
        letter = [points[np.minimum(at + k, n - 1)] for k in (1, 2)]
        for tail in CONTRACTIONS:
            hit = room > len(tail)
            for k, c in enumerate(tail):
                hit &= letter[k] == ord(c)
            end = at[hit] + 1 + len(tail)
            start[at[hit] + 1] = False
            end = end[end < n]
            start[end] = True
    return start


def cut_words(column: pa.Array, table: np.ndarray, added: list[str]) -> tuple[pa.Array, np.ndarray]:
    """(all words of the texts as bytes, first word of each text and the total); an added token is one word."""
    texts, rows, marks = column.to_pylist(), [], []
    split = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
    pieces: list[str] = []
    for t in texts:
        rows.append(len(pieces))
        t = t or ""
        if split is not None and any(a in t for a in added):
            parts = split.split(t)
            marks.extend(range(len(pieces) + 1, len(pieces) + len(parts), 2))
            pieces.extend(parts)
        else:
            pieces.append(t)
    rows.append(len(pieces))
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces], dtype=np.int64)])
    joined = "".join(pieces)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    if len(points) == 0:
        return pa.array([], pa.binary()), np.zeros(len(rows), np.int64)
    start = token_starts(points, offsets, table)
    for m in marks:
        start[offsets[m]:offsets[m + 1]] = False
        start[offsets[m]] = True
    data = joined.encode()
    width = 1 + (points >= 0x80).astype(np.uint8) + (points >= 0x800) + (points >= 0x10000)
    at = np.flatnonzero(start)
    ends = np.cumsum(width, dtype=np.int64)
    begin = ends[at] - width[at]
    buffer = np.append(begin, len(data)).astype(np.int32 if len(data) < 1 << 31 else np.int64)
    kind = pa.binary() if buffer.dtype == np.int32 else pa.large_binary()
    words = pa.Array.from_buffers(kind, len(at), [None, pa.py_buffer(buffer), pa.py_buffer(data)])
    return words, np.searchsorted(at, offsets[rows], "left")


class Transducer:
    """Minimal acyclic automaton over words, with additive outputs (ranks) and an id list for each rank."""

    NAMES = ("arcs", "targets", "outputs", "final", "first", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arcs, self.targets, self.outputs, self.final, self.first, self.ids = (arrays[n] for n in self.NAMES)

    @classmethod
    def build(cls, words: list[bytes], ids: Iterable[list[int]]) -> Transducer:
        """From distinct words in byte order and their ids."""
        nodes: list[tuple] = []                # (final, ((byte, child), ...)): registered states
        register: dict[tuple, int] = {}
        path: list[list] = [[False, []]]       # the states of the last word, not yet registered
        last = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs = path.pop()
                key = (final, tuple(arcs))
                at = register.setdefault(key, len(nodes))
                if at == len(nodes):
                    nodes.append(key)
                byte = last[len(path) - 1]
                path[-1][1].append((byte, at))

        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            close(same)
            path.extend([False, []] for _ in word[same:])
            path[-1][0], last = True, word
        close(0)
        root = len(nodes)
        nodes.append((path[0][0], tuple(path[0][1])))
        below = [0] * len(nodes)               # words below each state; children come first
        arcs, targets, outputs = [], [], []
        for state, (final, out) in enumerate(nodes):
            count = int(final)
            for byte, child in out:
                arcs.append(state << 8 | byte)
                targets.append(child)
                outputs.append(count)
                count += below[child]
            below[state] = count
        flat, sizes = array("i"), array("q")
        for x in ids:
            flat.extend(x)
            sizes.append(len(x))
        return cls({"arcs": np.array(arcs, np.int64), "targets": np.array(targets, np.int32),
                    "outputs": np.array(outputs, np.int32), "final": np.array([n[0] for n in nodes], np.uint8),
                    "first": np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32),
                    "ids": np.array(flat, np.int32)}) if root else cls.empty()

    @classmethod
    def empty(cls) -> Transducer:
        return cls({"arcs": np.zeros(0, np.int64), "targets": np.zeros(0, np.int32), "outputs": np.zeros(0, np.int32),
                    "final": np.zeros(1, np.uint8), "first": np.zeros(1, np.int32), "ids": np.zeros(0, np.int32)})

    def to_bytes(self) -> bytes:
        parts, head, at = [], [], 4096
        for name in self.NAMES:
            raw = getattr(self, name)
            at += -at % 16
            head.append([name, raw.dtype.str, len(raw), at])
            parts.append((at, raw.tobytes()))
            at += raw.nbytes
        out = bytearray(at)
        top = json.dumps(head).encode()
        out[:len(top)] = top
        for place, raw in parts:
            out[place:place + len(raw)] = raw
        return bytes(out)

    @classmethod
    def open(cls, path: str) -> Transducer:
        """Memory-mapped from a file."""
        raw = np.memmap(path, np.uint8, mode="r")
        head = json.loads(bytes(raw[:4096]).split(b"\0")[0])
        return cls({name: raw[at:at + n * np.dtype(kind).itemsize].view(kind) for name, kind, n, at in head})

    def ranks(self, words: pa.Array) -> np.ndarray:
        """Rank of each word, -1 for words that it does not hold; all words walk in step."""
        n, (_, off, data) = len(words), words.buffers()
        wide = np.int64 if pa.types.is_large_binary(words.type) else np.int32
        bounds = np.frombuffer(off, wide)[words.offset:words.offset + n + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        rank = np.full(n, -1, np.int64)
        if not len(self.arcs) or not n:
            return rank
        live, state, total = np.arange(n), np.full(n, len(self.final) - 1, np.int64), np.zeros(n, np.int64)
        length = np.diff(bounds)
        step = 0
        while len(live):
            done = length[live] == step
            hit = done & (self.final[state] > 0)
            rank[live[hit]] = total[hit]
            live, state, total = live[~done], state[~done], total[~done]
            want = (state << 8) | raw[bounds[live] + step]
            at = np.minimum(np.searchsorted(self.arcs, want), len(self.arcs) - 1)
            ok = self.arcs[at] == want
            live, at = live[ok], at[ok]
            state, total = self.targets[at].astype(np.int64), total[ok] + self.outputs[at]
            step += 1
        return rank


def word_counts(df: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """``word`` (bytes) and ``n`` over the whole texts; combined per task before the shuffle."""
    need(df, text_col)
    table, added = class_table(), list(vocabulary.added)

    def flush(held: list) -> pa.RecordBatch:
        both = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
        return pa.table({"word": both.column("word"), "n": both.column("n_sum")})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                words, _ = cut_words(part.column("text"), table, added)
                if len(words):
                    coded = words.dictionary_encode()
                    n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
                    held.append(pa.table({"word": coded.dictionary.cast(pa.binary()), "n": pa.array(n.astype(np.int64))}))
                if sum(t.num_rows for t in held) > 500_000:
                    held = [flush(held)]
                    if held[0].num_rows > 250_000:
                        yield from held.pop().combine_chunks().to_batches()
        if held:
            yield from flush(held).combine_chunks().to_batches()

    src = df.select(F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, limit: int = LEXICON_WORDS, longest: int = LEXICON_BYTES,
                   least: int = MIN_COUNT) -> list[bytes]:
    """At most ``limit`` words: those over a count that a histogram of the counts gives."""
    counts = write_and_read(counts.filter((F.col("n") >= least) & (F.octet_length("word") <= longest)), "words")
    # one row per power-of-1.1 step of the count: a bounded histogram
    step = F.floor(F.log(F.col("n")) / F.log(F.lit(1.1))).cast("int")
    seen, floor = 0, None
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        seen += r["count"]
        if seen > limit:
            break
        floor = r.step
    if floor is None:
        return []
    return sorted(counts.filter(step >= floor).select("word").toArrow().column("word").to_pylist())


def build_lexicon(df: DataFrame, vocabulary: Vocabulary, text_col: str = "text", limit: int = LEXICON_WORDS) -> str:
    """Compile the frequent words and give the file to the executors; returns its name for ``encode``."""
    words = frequent_words(word_counts(df, vocabulary, text_col), limit)
    words = [w for w in words if w.decode("utf-8", "replace") not in vocabulary.added]
    return share(df.sparkSession, Transducer.build(words, map(vocabulary.merge, words)).to_bytes())


def share(spark: SparkSession, content: bytes) -> str:
    """Write a file to the shared checkpoint folder and add it to the session's files."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    at = f"{scratch_path(spark, 'lexicon')}/{name}"
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(path)
    out.write(content)
    out.close()
    spark.sparkContext.addFile(files.makeQualified(path).toString())
    return name


def _encoder(shared, lexicon: str, text_col: str, name: str):
    """Batch function that adds ids to a batch stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, table = shared.value
        added = {a.encode(): i for a, i in vocabulary.added.items()}
        transducer, memo = Transducer.open(SparkFiles.get(lexicon)), {}
        for batch in batches:
            for part in text_slices(batch, text_col, SLICE):
                words, rows = cut_words(part.column(text_col), table, list(vocabulary.added))
                coded = words.dictionary_encode()
                rank = transducer.ranks(coded.dictionary)
                known = rank >= 0
                size = np.zeros(len(rank), np.int64)
                first = np.zeros(len(rank), np.int64)
                first[known] = transducer.first[rank[known]]
                size[known] = transducer.first[rank[known] + 1] - first[known]
                new: list[int] = []
                base, unseen = len(transducer.ids), np.flatnonzero(~known)
                for i, word in zip(unseen.tolist(), coded.dictionary.take(pa.array(unseen)).to_pylist(), strict=True):
                    ids = memo.get(word)
                    if ids is None:
                        ids = [added[word]] if word in added else vocabulary.merge(word)
                        if len(memo) < MEMO_WORDS and len(word) <= LEXICON_BYTES:
                            memo[word] = tuple(ids)
                    first[i], size[i] = base + len(new), len(ids)
                    new.extend(ids)
                values = np.concatenate([transducer.ids, np.array(new, np.int32)])
                at = coded.indices.to_numpy()
                flat = gather(first[at], size[at], values)
                ends = np.concatenate([[0], np.cumsum(size[at])])[rows].astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*part.schema.names, name])

    return run


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    """Ids of each row; a null list is empty."""
    values, bounds = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        yield values[a:b] if column.null_count == 0 or column[i].is_valid else values[:0]


def _decoder(shared, ids_col: str, name: str):
    """Batch function that adds the decoded text to a batch stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value if isinstance(shared.value, list) else shared.value[0].tokens
        token = tokens.__getitem__
        for batch in batches:
            texts = [b"".join(map(token, ids.tolist())).decode("utf-8", "replace") for ids in _lists(batch.column(ids_col))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, name])

    return run


def _broadcast(df: DataFrame, vocabulary: Vocabulary):
    """Vocabulary and code point classes, of fixed size."""
    return df.sparkSession.sparkContext.broadcast((vocabulary, class_table()))


def encode(df: DataFrame, vocabulary: Vocabulary, lexicon: str, text_col: str = "text", name: str = "ids") -> DataFrame:
    """All columns of ``df`` and the text's ids (array of int) as the last column ``name``."""
    need(df, text_col)
    src = df.drop(name) if name != text_col else df
    schema = T.StructType([*src.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType(), False), False)])
    return src.mapInArrow(_encoder(_broadcast(df, vocabulary), lexicon, text_col, name), schema)


def decode(df: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """All columns of ``df`` and the text of the ids as the last column ``name``; added tokens are written out."""
    need(df, ids_col)
    src = df.drop(name) if name != ids_col else df
    schema = src.select("*", F.lit("").alias(name)).schema
    return src.mapInArrow(_decoder(df.sparkSession.sparkContext.broadcast(vocabulary.tokens), ids_col, name), schema)


def round_trip_digests(df: DataFrame, vocabulary: Vocabulary, lexicon: str, id_col: str, text_col: str = "text") -> DataFrame:
    """``id``, ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned 32-bit integers) and ``decoded_sha256`` (decoded
    text in UTF-8).  Encodes and decodes in one pass, so that ids and texts stay in the task."""
    from hashlib import sha256

    need(df, id_col, text_col)
    shared = _broadcast(df, vocabulary)
    encode_, decode_ = _encoder(shared, lexicon, "text", "ids"), _decoder(shared, "ids", "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in decode_(encode_(batches)):
            ids = [x.astype("<u4").tobytes() for x in _lists(batch.column("ids"))]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array([sha256(x.encode()).hexdigest() for x in batch.column("decoded").to_pylist()], pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    src = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, "
                               "decoded_sha256 string")
