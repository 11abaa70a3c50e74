"""Exact k-means over integer vectors with ns-bounds.

Each vector keeps, for every centroid, its distance when it was last computed
and the round of that time.  The centroids of all rounds are kept (k vectors a
round, on the driver), so a stored distance is loosened by the norm of the
centroid's *total* displacement since that round, which is never more than the
sum of its drifts round by round.  A vector whose own (upper) bound stays under
every other (lower) bound keeps its centroid without computing a distance;
otherwise its own distance is computed, and then those of the centroids whose
bounds still fail.  Decisions between computed distances compare integers, so
ties go to the smaller number and the result equals the full scan.

A round is one pass of ``mapInArrow`` over a state table in shared scratch (the
round before is deleted once the next is written) and one aggregate of partial
sums; only k centroids meet on the driver.  Rounds end early when no centroid
moved, as nothing changes after that.

Arithmetic: components are ``floor(scale * x)`` with ``x`` as double.  Squared
distances are exact 64-bit integers while components stay within 2**27 and
``dims`` within 64 (in general dims * 2**56 < 2**63); a larger component raises
an error instead of a wrong distance.  Sums are decimals.  Bounds are doubles
with a margin of 1e-9 of their size, far over their rounding.

Defined results: vectors that are null, have another length than ``dims``, or
hold null or non-finite entries are left out; null ids are assigned but seed
nothing; repeated rows are vectors of their own (two seeds may be equal; the
second then stays empty); with fewer vectors than ``k`` there are as many
centroids as there are vectors to seed them, and without any the result is
empty; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import drop_table, need, write_table

LIMIT = 1 << 27
MARGIN = 1e-9
BATCH_ROWS = 8192


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``id`` and ``x`` (integers) of the usable vectors."""
    need(df, id_col, vector_col)
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = df.select(F.col(id_col).alias("id"), v.alias("v")).filter((F.size("v") == dims) & finite)

    def whole(e: Column) -> Column:
        scaled = F.floor(e * F.lit(float(scale)))
        return F.when(F.abs(e * F.lit(float(scale))) < LIMIT, scaled.cast("int")).otherwise(
            F.raise_error(F.lit(f"a component is not within {LIMIT} after scaling by {scale}")))

    return rows.select("id", F.transform("v", whole).alias("x"))


def seed_order(seed: int, id_col: str = "id") -> Column:
    """Lowercase hexadecimal SHA-256 of ``<seed>:<id>``."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)


def _matrix(column: pa.Array, dims: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), dims)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.ravel(), kind))


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def displacements(history: np.ndarray) -> np.ndarray:
    """Norm of each centroid's way from every round to the last: (rounds, k)."""
    d = (history - history[-1]).astype(np.float64)
    return np.sqrt((d * d).sum(axis=2))


def assign_first(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(label, distances, rounds) with every distance computed."""
    exact = np.stack([_squared(x, c) for c in centroids], axis=1) if len(centroids) else np.zeros((len(x), 0), np.int64)
    return exact.argmin(axis=1).astype(np.int32), np.sqrt(exact.astype(np.float64)), np.zeros(exact.shape, np.int32)


def assign_bounded(x: np.ndarray, label: np.ndarray, dist: np.ndarray, at: np.ndarray, history: np.ndarray,
                   moved: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(label, distances, rounds, number of distances computed) for the last centroids of ``history``.

    ``dist`` and ``at``: distances last computed and the rounds of that time."""
    now, centroids = len(history) - 1, history[-1]
    k, dist, at, label = len(centroids), dist.copy(), at.copy(), label.copy()
    rows, cols = np.arange(len(x)), np.arange(k)
    drift = moved[at, cols]
    low = dist - drift
    low[rows, label] = np.inf
    high = dist[rows, label] + drift[rows, label]
    slack = MARGIN * (high + 1.0)
    fails = np.flatnonzero((low <= (high + slack)[:, None] + MARGIN * np.abs(dist)).any(axis=1))
    if not len(fails):
        return label, dist, at, 0
    # the own distance first; then the centroids whose bounds still fail
    own = label[fails]
    best = _squared(x[fails], centroids[own])
    exact_own = np.sqrt(best.astype(np.float64))
    dist[fails, own], at[fails, own] = exact_own, now
    todo = low[fails] <= (exact_own + MARGIN * (exact_own + 1.0))[:, None] + MARGIN * np.abs(dist[fails])
    computed, winner = len(fails), own.copy()
    for j in range(k):
        which = np.flatnonzero(todo[:, j])
        if not len(which):
            continue
        computed += len(which)
        at_rows = fails[which]
        d = _squared(x[at_rows], centroids[j])
        dist[at_rows, j], at[at_rows, j] = np.sqrt(d.astype(np.float64)), now
        better = (d < best[which]) | ((d == best[which]) & (j < winner[which]))
        best[which[better]], winner[which[better]] = d[better], j
    label[fails] = winner
    return label, dist, at, computed


def _first_pass(state: DataFrame, centroids: np.ndarray, dims: int, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(i, BATCH_ROWS)
                label, dist, at = assign_first(_matrix(part.column("x"), dims, np.int64), centroids)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("x"), pa.array(label),
                                                  _lists(dist, pa.float64()), _lists(at, pa.int32())],
                                                 names=["id", "x", "label", "dist", "at"])

    return state.mapInArrow(run, schema)


def _next_pass(state: DataFrame, history: np.ndarray, dims: int, schema: str) -> DataFrame:
    moved, k = displacements(history), history.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(i, BATCH_ROWS)
                label, dist, at, _ = assign_bounded(
                    _matrix(part.column("x"), dims, np.int64), part.column("label").to_numpy(),
                    _matrix(part.column("dist"), k, np.float64), _matrix(part.column("at"), k, np.int32), history, moved)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("x"), pa.array(label),
                                                  _lists(dist, pa.float64()), _lists(at, pa.int32())],
                                                 names=["id", "x", "label", "dist", "at"])

    return state.mapInArrow(run, schema)


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of each centroid's vectors; empty centroids stay."""
    k, dims = centroids.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(i, BATCH_ROWS)
                x, label = _matrix(part.column("x"), dims, np.int64), part.column("label").to_numpy()
                for j in range(k):
                    mine = x[label == j]
                    total[j] += mine.sum(axis=0)
                    count[j] += len(mine)
        have = np.flatnonzero(count)
        if len(have):
            yield pa.RecordBatch.from_arrays([pa.array(have.astype(np.int32)), pa.array(count[have]), _lists(total[have], pa.int64())],
                                             names=["label", "n", "sums"])

    parts = state.select("label", "x").mapInArrow(partial, "label int, n bigint, sums array<bigint>")
    # k * dims rows at most
    sums = (parts.select("label", "n", F.posexplode("sums").alias("dim", "s")).groupBy("label", "dim")
            .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    out = centroids.copy()
    for r in sums:
        out[r.label, r.dim] = int(r.s) // int(r.n)
    return out


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 8, rounds: int = 10,
            seed: int = 3, dims: int = 64, scale: int = 1024) -> tuple[DataFrame, np.ndarray]:
    """(``id``, ``x``, ``cluster``, ``distance`` (squared) of every usable vector, final centroids).

    Centroids start as the ``k`` vectors with the smallest ``seed_order`` (ties
    by vector); ``rounds`` times all vectors are assigned and the centroids
    replaced; then vectors are assigned once more."""
    spark = df.sparkSession
    rows, path = write_table(integer_vectors(df, id_col, vector_col, dims, scale), "vectors")
    seeds = rows.filter("id is not null").orderBy(seed_order(seed), "x").limit(k).collect()
    history = np.array([[list(r.x) for r in seeds]], np.int64).reshape(1, len(seeds), dims)
    id_type = rows.schema["id"].dataType.simpleString()
    if not seeds:
        none = rows.limit(0).select("id", "x", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return none, history[0]
    schema = f"id {id_type}, x array<int>, label int, dist array<double>, at array<int>"
    state, now = write_table(_first_pass(rows, history[0], dims, schema), "bounds")
    drop_table(spark, path)
    for _ in range(rounds):
        centroids = _means(state, history[-1])
        if (centroids == history[-1]).all():
            break
        history = np.concatenate([history, centroids[None]])
        state, path = write_table(_next_pass(state, history, dims, schema), "bounds")
        drop_table(spark, now)
        now = path
    final = history[-1]

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(i, BATCH_ROWS)
                own = final[part.column("label").to_numpy()]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("x"), part.column("label"),
                                                  pa.array(_squared(_matrix(part.column("x"), dims, np.int64), own))],
                                                 names=["id", "x", "cluster", "distance"])

    out = state.select("id", "x", "label").mapInArrow(distances, f"id {id_type}, x array<int>, cluster int, distance bigint")
    return out, final


def centroid_digests(centroids: np.ndarray) -> list[str]:
    """Lowercase hexadecimal SHA-256 of each centroid's components in decimal, comma-joined."""
    return [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in centroids]


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    rows, _ = write_table(assigned.drop("x"), "assigned")
    sums = {r.cluster: int(r.s) for r in
            rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total, digests = sum(sums.values()), centroid_digests(centroids)
    if not sums:
        return rows.select("*", F.lit(0).cast("bigint").alias("cluster_inertia"), F.lit(0).cast("bigint").alias("inertia"),
                           F.lit("").alias("centroid_sha256"))
    own = F.create_map(*[F.lit(x) for c, s in sums.items() for x in (c, s)])[F.col("cluster")]
    digest = F.create_map(*[F.lit(x) for c in sums for x in (c, digests[c])])[F.col("cluster")]
    return rows.select("*", own.cast("bigint").alias("cluster_inertia"), F.lit(total).cast("bigint").alias("inertia"),
                       digest.alias("centroid_sha256"))
