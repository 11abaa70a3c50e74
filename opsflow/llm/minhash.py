"""MinHash near-duplicates: universal hash minima, banding, signature
verification, confirmation on full shingle sets, connected components.

1. One pass over whole texts gives each document its number of distinct
   shingles, a 128-bit key of its shingle set, band keys and a signature of one
   byte per minimum.
2. Documents with equal sets form one class, whose smallest id stands for it;
   copies are never paired.
3. In each band bucket every member is compared with the bucket's leader, the
   member with the most bucket partners (in a group of edited copies that is the
   text they were made from).  Pairs pass a size bound and signature
   verification, then the exact test on the full sets of both texts.  Confirmed
   links give components.
4. Buckets whose other members are still in different components are joined to
   families.  In each family the texts outside its largest component are
   compared with all texts of the family on full sets, block by block: a task
   holds one block of either side and gives out only links that join two
   components, so no pair list is formed and no link is lost.

With 48 bands of 6 minima a pair at similarity 0.8 shares no bucket with a
probability of 5e-7; signature verification drops it with one below 1e-7.

Words are runs of characters other than space and U+0009-U+000D, with A-Z
lower-cased; sets are of 64-bit shingle hashes.  Defined results: documents
without words have no shingles and are linked with nothing; a text of fewer
words than a shingle is one shingle; rows with a null id are not deduplicated
(null component, kept); the texts of one repeated id count as linked; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .frames import need, type_of, write_and_read
from .textkernel import SpanHasher, byte_table, gather, lower_table, mix, runs, span_bounds, text_buffer, text_slices

BANDS, ROWS = 48, 6
SEED = 20240607
SLACK = 0.13          # about 5.5 standard deviations of an estimate from 288 minima at 0.8
CHUNK_SHINGLES = 200_000
BLOCK_SHINGLES = 400_000


def _word_table() -> np.ndarray:
    return byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)


def shingle_sets(column: pa.Array, k: int, hasher: SpanHasher) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each row."""
    data, offsets = text_buffer(column)
    data = lower_table()[data]
    starts, ends = runs(_word_table()[data], offsets)
    words = hasher.hashes(data, starts, ends)
    bounds = span_bounds(starts, offsets)
    odd = np.uint64(0x9FB21C651E98DF25)
    rolled = words.copy()
    for j in range(1, k):
        rolled = rolled[:-1] * odd + words[j:] if len(rolled) > 1 else rolled[:0]
    rolled = mix(rolled)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= k:
            yield np.unique(rolled[a:b - k + 1])
        elif b > a:
            whole = words[a:a + 1]
            for i in range(a + 1, b):
                whole = whole * odd + words[i:i + 1]
            yield mix(whole ^ np.uint64(b - a))
        else:
            yield words[:0]


class MinHasher:
    """Minima of the universal family (a x + b) mod 2**32, a odd, over the upper half of shingle hashes."""

    def __init__(self, n: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1))[:, None]
        self.b = rng.integers(0, 1 << 32, n, dtype=np.uint32)[:, None]

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        best = None
        for i in range(0, len(x), 512):
            block = self.a * x[None, i:i + 512]
            block += self.b
            least = block.min(axis=1)
            best = least if best is None else np.minimum(best, least)
        return best


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``id``, ``n_shingles``, set key (``k1``, ``k2``), band keys and signature bytes per document."""
    need(docs, id_col, text_col)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, minhash = SpanHasher(), MinHasher(bands * rows)
        salt = mix(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            for part in text_slices(batch, "text"):
                count, k1, k2, keys, sig = [], [], [], [], []
                for s in shingle_sets(part.column("text"), k, hasher):
                    count.append(len(s))
                    k1.append(np.add.reduce(mix(s)))
                    k2.append(np.add.reduce(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))))
                    if len(s) == 0:
                        keys.append(None)
                        sig.append(None)
                        continue
                    m = minhash.minima(s)
                    band = salt.copy()
                    for col in m.reshape(bands, rows).T:
                        band = mix(band ^ col.astype(np.uint64)) + band
                    keys.append(band.view(np.int64))
                    sig.append(m.astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array(count, pa.int64()),
                    pa.array(np.array(k1, np.uint64).view(np.int64)), pa.array(np.array(k2, np.uint64).view(np.int64)),
                    pa.array(keys, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                    names=["id", "n_shingles", "k1", "k2", "bands", "sig"])

    kind = type_of(src, "id").simpleString()
    return src.mapInArrow(sign, f"id {kind}, n_shingles bigint, k1 bigint, k2 bigint, bands array<bigint>, sig binary")


def _agreeing(least: float):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, _ = text_buffer(batch.column("sig_a"))
                b, _ = text_buffer(batch.column("sig_b"))
                same = (a == b).reshape(batch.num_rows, -1).mean(axis=1)
                yield batch.select(["a", "b", "n_b"]).filter(pa.array(same >= least))

    return check


def _confirmed(k: int, percent: int):
    """Streams sorted rows (leader first in each group) and keeps one leader's set at a time."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, group, leaders = SpanHasher(), None, []
        for batch in batches:
            for part in text_slices(batch, "text"):
                a, b = [], []
                keys = zip(part.column("a").to_pylist(), part.column("salt").to_pylist(), part.column("b").to_pylist(),
                           strict=True)
                for (x, salt, y), s in zip(keys, shingle_sets(part.column("text"), k, hasher), strict=True):
                    if group != (x, salt):
                        group, leaders = (x, salt), []
                    if y is None:
                        leaders.append(s)
                        continue
                    for own in leaders:
                        both = len(np.intersect1d(own, s, assume_unique=True))
                        if 100 * both >= percent * (len(own) + len(s) - both) > 0:
                            a.append(x)
                            b.append(y)
                            break
                yield pa.RecordBatch.from_arrays([pa.array(a, part.schema.field("a").type),
                                                  pa.array(b, part.schema.field("b").type)], names=["a", "b"])

    return check


def _verify(pairs: DataFrame, reps: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links among the pairs ``a``, ``b``: size bound, signatures, then the full sets of both texts."""
    kind = type_of(pairs, "a").simpleString()
    side = reps.select("id", F.col("n_shingles").alias("n"), "sig")
    near = (pairs.join(side.withColumnsRenamed({"id": "a", "n": "n_a", "sig": "sig_a"}), "a")
            .join(side.withColumnsRenamed({"id": "b", "n": "n_b", "sig": "sig_b"}), "b")
            .filter(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
            .select("a", "b", "n_b", "sig_a", "sig_b")
            .mapInArrow(_agreeing(percent / 100 - SLACK), f"a {kind}, b {kind}, n_b bigint"))
    near = write_and_read(near.groupBy("a", "b").agg(F.max("n_b").alias("n_b")), "near")
    # a leader's members are dealt over chunks of about CHUNK_SHINGLES shingles; each chunk gets the leader's text
    chunks = near.groupBy("a").agg(F.ceil(F.sum("n_b") / CHUNK_SHINGLES).cast("int").alias("chunks"))
    members = near.join(chunks, "a").select("a", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("salt"), "b",
                                            F.col("b").alias("id"))
    heads = chunks.select("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("salt"),
                          F.lit(None).cast(kind).alias("b"), F.col("a").alias("id"))
    return (members.unionAll(heads).join(texts, "id").select("a", "salt", "b", "text")
            .repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
            .mapInArrow(_confirmed(k, percent), f"a {kind}, b {kind}").distinct())


def _joining(k: int, percent: int):
    """Links between a block of queries and a block of a family's texts that join two components."""
    def compare(key, rows):
        rows = rows.combine_chunks()
        sets = list(shingle_sets(rows.column("text").combine_chunks(), k, SpanHasher()))
        ids, component = rows.column("id").to_pylist(), rows.column("component").to_pylist()
        asks = rows.column("asks").to_numpy(zero_copy_only=False)
        others, queries = np.flatnonzero(~asks), np.flatnonzero(asks)
        sizes = np.array([len(sets[i]) for i in others], np.int64)
        shingles = np.concatenate([sets[i] for i in others]) if len(others) else np.zeros(0, np.uint64)
        order = np.argsort(shingles, kind="stable")
        shingles, owner = shingles[order], np.repeat(np.arange(len(others)), sizes)[order]
        up: dict = {}

        def root(x):
            while up.get(x, x) != x:
                x = up[x]
            return x

        a, b = [], []
        for q in queries:
            s = sets[q]
            low = np.searchsorted(shingles, s, "left")
            both = np.bincount(gather(low, np.searchsorted(shingles, s, "right") - low, owner), minlength=len(others))
            for i in np.flatnonzero(100 * both >= percent * np.maximum(len(s) + sizes - both, 1)):
                x, y = root(component[q]), root(component[others[i]])
                if x != y:
                    up[x] = y
                    a.append(ids[q])
                    b.append(ids[others[i]])
        kind = rows.schema.field("id").type
        return pa.table({"a": pa.array(a, kind), "b": pa.array(b, kind)})

    return compare


def _join_families(open_: DataFrame, sizes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links that join components within the families of the open buckets (``key``, ``rep``, ``component``)."""
    kind = type_of(open_, "rep").simpleString()
    heads = open_.groupBy("key").agg(F.min("rep").alias("b"))
    families = connected_components(open_.join(heads, "key").select(F.col("rep").alias("a"), "b").distinct())
    members = (open_.select(F.col("rep").alias("id"), "component").distinct()
               .join(families.withColumnsRenamed({"node": "id", "component": "family"}), "id").join(sizes, "id"))
    members = write_and_read(members, "families")
    largest = (members.groupBy("family", "component").agg(F.count(F.lit(1)).alias("n"))
               .groupBy("family").agg(F.max_by("component", F.struct("n", "component")).alias("largest")))
    members = members.join(largest, "family").withColumn("asks", F.col("component") != F.col("largest"))
    # every row is compared with the queries; a query also stands among the rows
    blocks = members.groupBy("family").agg(
        F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("rows"),
        F.ceil(F.sum(F.when(F.col("asks"), F.col("n")).otherwise(0)) / BLOCK_SHINGLES).cast("int").alias("queries"))
    members = write_and_read(members.join(blocks, "family"), "families")
    own = F.xxhash64("id")
    rows = members.select("family", "id", "component", F.lit(False).alias("asks"), F.pmod(own, "rows").alias("i"),
                          F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("queries").cast("bigint") - 1)).alias("j"))
    asked = members.filter("asks").select(
        "family", "id", "component", "asks",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows").cast("bigint") - 1)).alias("i"), F.pmod(own, "queries").alias("j"))
    return (rows.unionByName(asked).join(texts, "id").groupBy("family", "i", "j")
            .applyInArrow(_joining(k, percent), f"a {kind}, b {kind}"))


def _components(docs: DataFrame, id_col: str, text_col: str, members: DataFrame, reps: DataFrame, k: int,
                percent: int) -> DataFrame:
    """Components of the class representatives that have links."""
    entries = reps.select(F.explode("bands").alias("key"), F.col("id").alias("rep"))
    shared = entries.groupBy("key").agg(F.min("rep").alias("x"), F.max("rep").alias("y"), F.count(F.lit(1)).alias("n")).filter("x < y")
    entries = write_and_read(entries.join(shared.select("key", "n"), "key"), "entries")
    partners = entries.groupBy("rep").agg(F.sum("n").alias("partners"))
    leaders = entries.join(partners, "rep").groupBy("key").agg(F.max(F.struct("partners", "rep")).alias("top"))
    entries = write_and_read(entries.join(leaders.select("key", F.col("top.rep").alias("leader")), "key").select("key", "rep", "leader"),
                             "entries")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = write_and_read(texts.join(partners.select(F.col("rep").alias("id")), "id", "left_semi"), "texts")
    sizes = reps.select("id", F.col("n_shingles").alias("n"))

    same_id = members.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a < z").select("id", "a")
    links = members.join(same_id, "id").select("a", F.col("rep").alias("b")).distinct().filter("a < b")
    pairs = entries.filter("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    links = links.unionAll(_verify(pairs, reps.select("id", "n_shingles", "sig"), texts, k, percent))
    components = write_and_read(connected_components(links), "components")
    # the leaders have met all members of their buckets; what is left is open where it lies in two components
    left = (entries.filter("rep <> leader").join(components.select(F.col("node").alias("rep"), "component"), "rep", "left")
            .select("key", "rep", F.coalesce("component", "rep").alias("component")))
    mixed = left.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
    open_ = write_and_read(left.join(mixed.select("key"), "key", "left_semi"), "open")
    if open_.count() == 0:
        return components
    more = write_and_read(_join_families(open_, sizes, texts, k, percent), "links")
    if more.count() == 0:
        return components
    return connected_components(components.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document: ``id``, ``n_shingles``, ``component`` (smallest id reachable over links with
    100 * intersection >= percent * union, itself included) and ``kept`` (the component's smallest id)."""
    signed = write_and_read(signatures(docs, id_col, text_col, k, bands, rows), "signatures")
    known = signed.filter("id is not null and n_shingles > 0")
    sets = ["n_shingles", "k1", "k2"]
    classes = known.groupBy(*sets).agg(F.min("id").alias("rep"))
    members = write_and_read(known.select("id", *sets).join(classes, sets).select("id", "n_shingles", "rep"), "members")
    reps = known.join(classes.select(F.col("rep").alias("id"), *sets), ["id", *sets], "left_semi")
    reps = write_and_read(reps.select("id", "n_shingles", "sig", "bands"), "reps")
    components = _components(docs, id_col, text_col, members, reps, k, percent)
    placed = (members.join(components.withColumnsRenamed({"node": "rep"}), "rep", "left")
              .select("id", "n_shingles", F.coalesce("component", "rep").alias("component")))
    alone = signed.filter("id is null or n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component"))
    return placed.unionAll(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component")))
