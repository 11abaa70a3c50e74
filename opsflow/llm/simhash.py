"""SimHash fingerprints and their search within a Hamming radius.

Every distinct word of a text votes with its weight (square root of its count)
on each bit of its hash; the sign of the sum is the fingerprint's bit.  With
``bits`` bits the expected share of equal bits of two texts is 1 - angle / pi
of their weighted word vectors.

``neighbours`` finds every fingerprint within ``radius`` bits of the queries:
the bits are cut into ``radius + spare`` blocks, and each choice of ``spare``
blocks is one permuted table.  Two fingerprints within the radius agree on all
blocks of at least one table, so a lookup of the block bits in every table finds
them and a bit count confirms them.  Equal fingerprints are searched once.
Fingerprints are dealt over a grid of blocks; a task builds the tables of one
block of queries, one at a time, and looks up one block of the others, so no row
is written for each table and no pair but those within the radius.

Words: A-Z lower-cased, runs of characters other than space and U+0009-U+000D.
Defined results: a null or empty text, or one without words, has the all-zero
fingerprint; equal texts have equal fingerprints; null ids stay null; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import need, write_and_read
from .textkernel import SpanHasher, byte_table, gather, lower_table, mix, runs, span_bounds, text_buffer, text_slices

BITS = 256
QUERY_BLOCK, PRINT_BLOCK = 16_384, 32_768
PAIRS = 1 << 20       # candidates checked at a time


def fingerprints(column: pa.Array, bits: int, hasher: SpanHasher) -> np.ndarray:
    """Packed fingerprints (rows x bits / 8 bytes) of the texts of a column."""
    data, offsets = text_buffer(column)
    data = lower_table()[data]
    starts, ends = runs(byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)[data], offsets)
    words, bounds = hasher.hashes(data, starts, ends), span_bounds(starts, offsets)
    salts = mix(np.arange(1, bits // 64 + 1, dtype=np.uint64))
    out = np.zeros((len(column), bits // 8), np.uint8)
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if a == b:
            continue
        terms, count = np.unique(words[a:b], return_counts=True)
        weight, votes = np.sqrt(count).astype(np.float32), np.zeros(bits, np.float32)
        for j in range(0, len(terms), 4096):
            wide = mix(terms[j:j + 4096, None] ^ salts[None, :])
            sign = np.unpackbits(wide.view(np.uint8).reshape(len(wide), -1), axis=1).astype(np.float32)
            w = weight[j:j + 4096]
            votes += 2 * (w @ sign) - w.sum()
        out[i] = np.packbits(votes > 0)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits of packed fingerprints, row by row."""
    return 1.0 - np.bitwise_count(a ^ b).sum(axis=1) / (8.0 * a.shape[1])


def to_hex(packed: np.ndarray) -> pa.Array:
    return pa.array([bytes(x).hex() for x in packed], pa.string())


def with_fingerprint(df: DataFrame, text_col: str = "text", name: str = "fingerprint", bits: int = BITS) -> DataFrame:
    """All columns of ``df`` and the text's fingerprint in hexadecimal, as the last column ``name``
    (a column of that name is replaced)."""
    need(df, text_col)
    src = df.drop(name) if name != text_col else df
    schema = src.select("*", F.lit("").alias(name)).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            for part in text_slices(batch, text_col):
                prints = to_hex(fingerprints(part.column(text_col), bits, hasher))
                yield pa.RecordBatch.from_arrays([*part.columns, prints], names=[*part.schema.names, name])

    return src.mapInArrow(add, schema)


def block_tables(bits: int, radius: int, spare: int) -> list[list[tuple[int, int]]]:
    """Hex digit ranges of each table's blocks: every choice of ``spare`` of the
    ``radius + spare`` blocks of nearly equal numbers of digits."""
    digits, n = bits // 4, radius + spare
    cuts = [digits * i // n for i in range(n + 1)]
    return [[(cuts[i], cuts[i + 1]) for i in chosen] for chosen in combinations(range(n), spare)]


def _within(radius: int, bits: int, tables: list[list[tuple[int, int]]]):
    """Pairs of a block of queries and a block of fingerprints within the radius, each from the first table they share."""
    cuts = sorted({block for table in tables for block in table})

    def compare(rows: pa.Table) -> pa.Table:
        names, asks = rows.column("fingerprint").combine_chunks(), rows.column("asks").to_numpy(zero_copy_only=False)
        packed = np.frombuffer(bytes.fromhex("".join(names.to_pylist())), np.uint8).reshape(len(names), bits // 8)
        digits = np.stack([packed >> 4, packed & 15], axis=2).reshape(len(names), -1)
        values = np.zeros((len(cuts), len(names)), np.uint64)
        for value, (start, end) in zip(values, cuts, strict=True):
            for i in range(start, end):
                value *= np.uint64(16)
                value += digits[:, i]
        words = packed.view(np.uint64)
        queries, others = np.flatnonzero(asks), np.flatnonzero(~asks)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))]
        for table in tables if len(queries) and len(others) else []:
            chosen = [cuts.index(block) for block in table]
            key = np.zeros(len(names), np.uint64)
            for c in chosen:
                key = key * np.uint64(0x9E3779B97F4A7C15) + values[c]
            order = queries[np.argsort(key[queries], kind="stable")]
            known, wanted = key[order], key[others]
            low = np.searchsorted(known, wanted)
            hit = np.flatnonzero(known[np.minimum(low, len(known) - 1)] == wanted)
            low, hit = low[hit], others[hit]
            count = np.searchsorted(known, key[hit], "right") - low
            ends = np.cumsum(count)
            for part in np.split(np.arange(len(hit)), np.searchsorted(ends, np.arange(PAIRS, ends[-1] if len(ends) else 0, PAIRS))):
                a, b = gather(low[part], count[part], order), np.repeat(hit[part], count[part])
                distance = np.bitwise_count(words[a] ^ words[b]).sum(axis=1)
                near = np.flatnonzero(distance <= radius)
                a, b, distance = a[near], b[near], distance[near]
                # the blocks up to the table's last one that agree are the table's own
                agree = values[:chosen[-1] + 1, a] == values[:chosen[-1] + 1, b]
                first = (agree.sum(axis=0) == len(chosen)) & agree[chosen].all(axis=0)
                found.append((a[first], b[first], distance[first].astype(np.int32)))
        a, b, distance = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table({"query": names.take(pa.array(a)), "fingerprint": names.take(pa.array(b)), "distance": pa.array(distance, pa.int32())})

    return compare


def neighbours(queries: DataFrame, prints: DataFrame, radius: int, bits: int = BITS, spare: int = 2) -> DataFrame:
    """Distinct (``query``, ``fingerprint``, ``distance``) of fingerprints within ``radius`` bits.

    Both tables have a column ``fingerprint`` (hexadecimal); equal fingerprints count once, distance 0 included.
    """
    def distinct(df: DataFrame, name: str) -> DataFrame:
        return write_and_read(df.select("fingerprint").filter("fingerprint is not null").distinct(), name)

    asked, known = distinct(queries, "asked"), distinct(prints, "known")
    rows, cols = (max(1, -(-df.count() // n)) for df, n in ((known, PRINT_BLOCK), (asked, QUERY_BLOCK)))

    def dealt(df: DataFrame, asks: bool) -> DataFrame:
        own, every = (("j", cols), ("i", rows)) if asks else (("i", rows), ("j", cols))
        return df.select("fingerprint", F.lit(asks).alias("asks"), F.pmod(F.xxhash64("fingerprint"), F.lit(own[1])).cast("int").alias(own[0]),
                         F.explode(F.sequence(F.lit(0), F.lit(every[1] - 1))).alias(every[0]))

    grid = dealt(known, False).unionByName(dealt(asked, True)).repartition(min(4096, 2 * rows * cols), "i", "j")
    return grid.groupBy("i", "j").applyInArrow(_within(radius, bits, block_tables(bits, radius, spare)),
                                               "query string, fingerprint string, distance int")


def _cuts(df: DataFrame, column: str, n: int) -> list:
    """At most n - 1 cut values of a numeric column (quantile sketches, merged on the driver)."""
    found = df.approxQuantile(column, [i / n for i in range(1, n)], 0.25 / n) if n > 1 else []
    return sorted({int(x) for x in found})


def edited_prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """Fingerprints of each text, of its edited text and their likeness.

    The edited text replaces the last floor(n / 2) code points by the first as
    many (or all) of the next document, in descending id order (null ids last,
    equal ids by text); the next of the last is the first.  Integer ids.

    Texts are shuffled once, by ranges of ids; a copy of each range's first
    document goes to the range before, so neighbours meet without a global sort.
    A table of one document has itself as the next.
    """
    need(docs, id_col, text_col)
    src = docs.select(F.col(id_col).cast("bigint").alias("id"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = _cuts(src.filter("id is not null"), "id", parts)
    # bucket 0 has the largest ids; null ids come last
    bucket = F.when(F.col("id").isNull(), F.lit(len(cuts) + 1)).otherwise(
        F.lit(len(cuts)) - F.size(F.filter(F.array(*[F.lit(c).cast("bigint") for c in cuts]).cast("array<bigint>"),
                                           lambda c: c < F.col("id"))))
    src = src.withColumn("bucket", bucket)
    # one row per bucket: its first document, which is the successor of the bucket before (bounded by the buckets)
    first = {r.bucket: r.id for r in src.groupBy("bucket").agg(F.max("id").alias("id")).collect()}
    order = sorted(first)
    heads = [(b, first[b], order[i - 1]) for i, b in enumerate(order)]
    heads = docs.sparkSession.createDataFrame(heads, "head_bucket int, head_id bigint, before int")
    tails = (src.join(F.broadcast(heads), (F.col("bucket") == F.col("head_bucket")) & F.col("id").eqNullSafe(F.col("head_id")))
             .groupBy("bucket", "before", "id").agg(F.min("text").alias("text"))
             .select("id", "text", F.col("before").alias("bucket"), F.lit(True).alias("tail")))
    rows = (src.withColumn("tail", F.lit(False)).unionByName(tails)
            .repartition(parts, "bucket")
            .sortWithinPartitions("bucket", "tail", F.col("id").desc_nulls_last(), "text"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held = SpanHasher(), None
        for batch in batches:
            for part in text_slices(batch.select(["id", "text", "tail"]), "text"):
                part = pa.Table.from_batches([part])
                both = part if held is None else pa.concat_tables([held, part])
                held = both.slice(both.num_rows - 1)
                texts, tail = both.column("text").to_pylist(), both.column("tail").to_pylist()
                prints = fingerprints(both.column("text").combine_chunks(), bits, hasher)
                kept = [i for i in range(len(texts) - 1) if not tail[i]]
                if not kept:
                    continue
                new = [t[:len(t) - len(t) // 2] + u[:len(t) // 2] for t, u in ((texts[i], texts[i + 1]) for i in kept)]
                edited = fingerprints(pa.array(new, pa.large_string()), bits, hasher)
                own = prints[kept]
                yield pa.RecordBatch.from_arrays([
                    both.column("id").combine_chunks().take(pa.array(kept)),
                    pa.array([len(texts[i]) for i in kept], pa.int64()), pa.array(new, pa.string()),
                    to_hex(own), to_hex(edited), pa.array(likeness(own, edited)),
                    pa.array(likeness(own, prints[np.array(kept) + 1]))],
                    names=["id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return rows.mapInArrow(compare, "id bigint, n_chars bigint, edited string, fingerprint string, "
                                    "edited_fingerprint string, near_edited double, near_next double")
