"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores, for every segment (a few megabytes of consecutive
training texts), one row per distinct word with the sorted positions of its
occurrences, and one row (term 0) with the segment's document ids and their
first word positions.  Segments are balanced by bytes, so a frequent word or a
hot source never makes a large group: its postings are split over all segments.

``matches`` keeps only the postings of words that occur in the benchmark
(an equi-join), gathers them by segment, and intersects the offset-adjusted
position lists of every window, starting from its rarest word in the segment.
Windows come in blocks of at most ``block`` rows, so what is broadcast has a
fixed bound whatever the benchmark's size; spans and items of all blocks are
merged.

Words: text with A-Z lower-cased, runs of digits, a-z and non-ASCII characters.
A window is ``width`` consecutive words of an item; an item of fewer words, but
not none, is one window.  Words are compared by 64-bit hashes.

Defined results: a null or empty text has no words and no match, and still gets
its row; every row of a table with repeated rows or ids is reported on its own;
a null id stays null; a null item id is reported as an empty string; an empty
benchmark matches nothing; an empty document table gives an empty result; other
columns of either table are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import need, write_and_read
from .textkernel import SpanHasher, byte_table, lower_table, runs, span_bounds, text_buffer, text_slices

WIDTH = 10
WINDOW_BLOCK = 100_000
SEGMENT_BYTES = 4 << 20


def _is_word_byte(b: int) -> bool:
    return 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80


def word_hashes(column: pa.Array, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, first word of each row and the total); hash 0 is not used."""
    data, offsets = text_buffer(column)
    data = lower_table()[data]
    starts, ends = runs(byte_table(_is_word_byte)[data], offsets)
    h = hasher.hashes(data, starts, ends)
    h[h == 0] = 1
    return h, span_bounds(starts, offsets)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Positional index of whole texts, written to shared scratch: ``segment``,
    ``term``, ``positions`` and, in the rows with term 0, ``doc_ids``."""
    need(docs, id_col, text_col)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["id"].dataType.simpleString()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, part, k = SpanHasher(), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in text_slices(batch, "text", segment_bytes):
                h, first = word_hashes(rows.column("text"), hasher)
                order = np.argsort(h, kind="stable")
                h = h[order]
                cuts = np.concatenate([[0], np.flatnonzero(h[1:] != h[:-1]) + 1, [len(h)]]) if len(h) else np.zeros(1)
                terms = h[cuts[:-1].astype(np.int64)] if len(h) else h
                lists = np.concatenate([[0, len(first)], cuts[1:] + len(first)]).astype(np.int32)
                positions = np.concatenate([first, order]).astype(np.int32)
                n = len(terms) + 1
                ids = rows.column("id")
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{part}-{k}"]).take(pa.array(np.zeros(n, np.int32))),
                    pa.array(np.concatenate([np.zeros(1, np.uint64), terms]).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(lists), pa.array(positions)),
                    pa.concat_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                                      pa.nulls(n - 1, pa.list_(ids.type))]),
                ], names=["segment", "term", "positions", "doc_ids"])
                k += 1

    index = src.mapInArrow(segments, f"segment string, term bigint, positions array<int>, doc_ids array<{id_type}>")
    return write_and_read(index, "postings")


def windows_of(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
               width: int = WIDTH) -> DataFrame:
    """One row per window: ``item`` (as text) and ``terms`` (word hashes in order)."""
    need(benchmark, item_col, text_col)
    src = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                           F.col(text_col).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            for rows in text_slices(batch, "text"):
                h, first = word_hashes(rows.column("text"), hasher)
                h = h.view(np.int64)
                for item, a, b in zip(rows.column("item").to_pylist(), first[:-1], first[1:], strict=True):
                    if b > a:
                        n = max(1, b - a - width + 1)
                        terms = (np.lib.stride_tricks.sliding_window_view(h[a:b], width) if b - a >= width
                                 else h[None, a:b])
                        lists = np.arange(n + 1, dtype=np.int32) * terms.shape[1]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([item] * n), pa.ListArray.from_arrays(pa.array(lists), pa.array(terms.ravel()))],
                            names=["item", "terms"])

    return src.mapInArrow(cut, "item string, terms array<bigint>")


def compile_windows(rows: list, width: int) -> dict:
    """Distinct windows as a matrix (0 pads), their lengths and item lists."""
    items: dict[tuple, set] = {}
    for r in rows:
        items.setdefault(tuple(r.terms), set()).add(r.item)
    keys = list(items)
    terms = np.zeros((len(keys), width), np.int64)
    for i, key in enumerate(keys):
        terms[i, :len(key)] = key
    return {"terms": terms, "lengths": np.array([len(k) for k in keys], np.int64),
            "items": [sorted(items[k]) for k in keys]}


def _has(sorted_positions: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether a position lies in each [low, high]."""
    j = np.searchsorted(sorted_positions, low)
    return (j < len(sorted_positions)) & (sorted_positions[np.minimum(j, len(sorted_positions) - 1)] <= high)


def intersect(lists: list[np.ndarray], first: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, start) of the alignments at which word k of a window has an
    occurrence within ``slop`` of start + k, all in one document.  Starts from
    the shortest list."""
    order = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    anchor = lists[order[0]].astype(np.int64)
    doc = np.searchsorted(first, anchor, "right") - 1
    start = (anchor - order[0])[:, None] + np.arange(-slop, slop + 1)
    start, doc = start.ravel(), np.repeat(doc, 2 * slop + 1)
    if slop:
        pairs = np.unique(np.stack([doc, start]), axis=1)
        doc, start = pairs[0], pairs[1]
    for k in order if slop else order[1:]:
        low = np.maximum(start + k - slop, first[doc])
        high = np.minimum(start + k + slop, first[doc + 1] - 1)
        ok = _has(lists[k], low, high) & (low <= high)
        doc, start = doc[ok], start[ok]
        if len(start) == 0:
            break
    return doc, start


def match_segment(terms: np.ndarray, lists: list[np.ndarray], first: np.ndarray, windows: dict,
                  slop: int) -> tuple[np.ndarray, np.ndarray, list[set]]:
    """Starts and ends of merged hit runs (segment positions), and the items of each document."""
    n_words, found = int(first[-1]), [set() for _ in range(len(first) - 1)]
    cover = np.zeros(n_words + 1, np.int32)
    want, lengths = windows["terms"], windows["lengths"]
    if len(terms) and len(want):
        at = np.minimum(np.searchsorted(terms, want), len(terms) - 1)
        here = (terms[at] == want) | (np.arange(want.shape[1]) >= lengths[:, None])
        for w in np.flatnonzero(here.all(axis=1)):
            n = int(lengths[w])
            doc, start = intersect([lists[t] for t in at[w, :n]], first, slop)
            if len(start):
                np.add.at(cover, np.maximum(start, first[doc]), 1)
                np.add.at(cover, np.minimum(start + n, first[doc + 1]), -1)
                for d in np.unique(doc):
                    found[d].update(windows["items"][w])
    starts, ends = runs(np.cumsum(cover[:-1]) > 0, first)
    return starts, ends, found


def _merged(spans):
    """Union of word spans given as an array of (start, end), in order."""
    ordered = F.array_sort(spans)
    zero = F.slice(ordered, 1, 0)

    def add(done, x):
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return (F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= x["start"]),
                       F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined)))
                .otherwise(F.concat(done, F.array(x))))

    return F.aggregate(ordered, zero, add)


def _segment_matcher(shared, slop: int):
    """Function of one segment's postings for ``applyInArrow``."""

    def of_segment(key, rows):
        rows = rows.sort_by("term").combine_chunks()
        terms = rows.column("term").to_numpy()
        at = int(np.searchsorted(terms, 0))
        positions = [x.values.to_numpy(zero_copy_only=False) for x in rows.column("positions")]
        first, ids = positions[at].astype(np.int64), rows.column("doc_ids")[at].values
        keep = np.arange(len(terms)) != at
        starts, ends, items = match_segment(terms[keep], [p for p, y in zip(positions, keep) if y], first,
                                            shared.value, slop)
        bounds, n = span_bounds(starts, first), len(first) - 1
        base = np.repeat(first[:-1], np.diff(bounds))
        spans = pa.StructArray.from_arrays([pa.array((starts - base).astype(np.int32)),
                                            pa.array((ends - base).astype(np.int32))], names=["start", "end"])
        return pa.table({
            "segment": pa.array([key[0].as_py()] * n, pa.string()), "ord": pa.array(np.arange(n, dtype=np.int32)),
            "id": ids, "n_words": pa.array(np.diff(first)),
            "spans": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), spans),
            "items": pa.array([sorted(x) for x in items], pa.list_(pa.string()))})

    return of_segment


def matches(index: DataFrame, benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
            width: int = WIDTH, slop: int = 0, block: int = WINDOW_BLOCK) -> DataFrame:
    """Per document: ``id``, ``n_words``, ``spans`` (merged word spans in matches,
    end exclusive) and ``items`` (distinct matching item ids as text, sorted).

    ``slop`` 0 gives exact phrases; over 0, proximity matches: an alignment at
    which every word of the window occurs within ``slop`` words of its place.
    """
    spark = index.sparkSession
    id_type = index.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"segment string, ord int, id {id_type}, n_words bigint, " \
             "spans array<struct<start:int,end:int>>, items array<string>"
    windows = windows_of(benchmark, item_col, text_col, width)
    blocks = max(1, -(-windows.count() // block))
    parts = []
    for k in range(blocks):
        mine = windows if blocks == 1 else windows.filter(F.pmod(F.xxhash64("terms", "item"), F.lit(blocks)) == k)
        compiled = compile_windows(mine.collect(), width)
        terms = np.unique(np.append(compiled["terms"], 0))
        wanted = spark.createDataFrame(pa.table({"term": terms}))
        shared = spark.sparkContext.broadcast(compiled)

        posts = index.join(F.broadcast(wanted), "term", "left_semi")
        parts.append(posts.groupBy("segment").applyInArrow(_segment_matcher(shared, slop), schema))
    if blocks == 1:
        return parts[0].drop("segment", "ord")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionAll(p)
    return (every.groupBy("segment", "ord")
            .agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"),
                 _merged(F.flatten(F.collect_list("spans"))).alias("spans"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
            .drop("segment", "ord"))


def hit_words(spans="spans"):
    """Number of words in the merged spans."""
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
