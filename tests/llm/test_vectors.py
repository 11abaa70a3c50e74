"""Whitening and exact clusters against brute force, and their edge rows."""

import hashlib
import math
import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opsflow.llm import centroids, queries, whitening

DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, x int, cluster int, distance string, n int"


def rows_of(vectors):
    return [(i, v, 0, "a", 1, 2, "d", 3) for i, v in vectors]


def usable(vectors, dims):
    return [(i, v) for i, v in vectors if v is not None and len(v) == dims and all(e is not None and math.isfinite(e) for e in v)]


def as_float32(v):
    return [float(np.float32(e)) for e in v]


def brute_clusters(vectors, k, rounds, seed, scale):
    """Full scans with Python integers; (id, cluster, distance) in input order and the centroids."""
    x = [(i, [math.floor(scale * e) for e in as_float32(v)]) for i, v in vectors]
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in x if i is not None)
    cs = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))

    for _ in range(rounds):
        who = [near(v)[1] for _, v in x]
        for j in range(len(cs)):
            mine = [v for (_, v), w in zip(x, who) if w == j]
            if mine:
                cs[j] = [sum(col) // len(mine) for col in zip(*mine)]
    return [(i, near(v)[1], near(v)[0]) for i, v in x], cs


def edge_vectors():
    rng = np.random.default_rng(11)
    base = [(i, (rng.normal(0, 1, 4) + (i % 3) * 2).tolist()) for i in range(60)]
    copies = [(100 + i, base[7][1]) for i in range(15)]
    odd = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0]), (203, [1.0, float("nan"), 2.0, 3.0]),
           (204, [1.0, float("inf"), 2.0, 3.0]), (205, [1.0, 2.0, 3.0]), (None, [0.5, 0.5, 0.5, 0.5]), (3, base[3][1]), (3, base[3][1])]
    return base + copies + odd


@pytest.mark.parametrize(("k", "rounds"), [(8, 10), (3, 1), (5, 0)])
def test_clusters_match_full_scans(spark, k, rounds):
    vectors = edge_vectors()
    df = spark.createDataFrame(rows_of(vectors), SCHEMA).repartition(3)
    got, final = centroids.cluster(df, k=k, rounds=rounds, dims=4)
    want, cs = brute_clusters(usable(vectors, 4), k, rounds, 3, 1024)
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(((r.id, r.cluster, r.distance) for r in got.collect()), key=key) == sorted(want, key=key)
    assert [[int(v) for v in c] for c in final] == cs


def test_cluster_query_matches_full_scans(spark):
    """The registered query over a whole given table, its sums and its digests."""
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DIR}/embeddings.parquet").collect()]
    got = {r.vec_id: r for r in queries.op13_kmeans(spark, DIR).collect()}
    want, cs = brute_clusters(usable(rows, 64), 8, 10, 3, 1024)
    assert {i: (r.cluster, r.distance) for i, r in got.items()} == {i: (c, d) for i, c, d in want}
    per = {j: sum(d for _, c, d in want if c == j) for j in range(8)}
    for r in got.values():
        assert (r.cluster_inertia, r.inertia) == (per[r.cluster], sum(per.values()))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cs[r.cluster])).encode()).hexdigest()


def test_bounds_skip_work_and_stay_exact():
    """Bounds loosened by the total displacement: same labels as a scan at every round, fewer distances."""
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(m, 40, (400, 8)) for m in (-900, 0, 900)]).astype(np.int64)
    history = x[rng.choice(len(x), 6, replace=False)][None]
    label, dist, at = centroids.assign_first(x, history[0])
    spent = scans = 0
    for _ in range(12):
        new = history[-1].copy()
        for j in range(6):
            if (label == j).any():
                new[j] = x[label == j].sum(axis=0) // (label == j).sum()
        history = np.concatenate([history, new[None]])
        label, dist, at, n = centroids.assign_bounded(x, label, dist, at, history, centroids.displacements(history))
        exact = ((x[:, None, :] - history[-1][None]) ** 2).sum(axis=2)
        assert (label == exact.argmin(axis=1)).all()
        spent, scans = spent + n, scans + exact.size
    assert spent < scans / 2


def test_displacement_is_that_of_the_way_as_a_whole():
    history = np.array([[[0, 0]], [[3, 4]], [[0, 1]]], np.int64)
    assert centroids.displacements(history)[:, 0].tolist() == [1.0, math.sqrt(18), 0.0]


def test_ties_go_to_the_smaller_number(spark):
    vectors = [(i, [0.0, float(i % 2)]) for i in range(40)] + [(50, [0.0, 0.5])]
    df = spark.createDataFrame(rows_of(vectors), SCHEMA)
    got, _ = centroids.cluster(df, k=6, rounds=4, dims=2)
    want, _ = brute_clusters(vectors, 6, 4, 3, 1024)
    assert sorted((r.id, r.cluster, r.distance) for r in got.collect()) == sorted(want)


def test_cluster_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    got, final = centroids.cluster(none)
    assert got.count() == 0 and len(final) == 0
    assert centroids.with_inertia(got, final).columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    two = spark.createDataFrame(rows_of([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (None, [9.0, 9.0])]), SCHEMA)
    got, final = centroids.cluster(two, dims=2)
    assert len(final) == 2 and got.count() == 3
    unnamed = spark.createDataFrame(rows_of([(None, [9.0, 9.0])]), SCHEMA)
    assert centroids.cluster(unnamed, dims=2)[0].count() == 0
    far = spark.createDataFrame(rows_of([(1, [1e9, 0.0])]), SCHEMA)
    with pytest.raises(Exception, match="not within"):
        centroids.cluster(far, dims=2)[0].collect()


def brute_whitening(vectors, components):
    x = np.array([[math.floor(64 * e) + 1_000_000 for e in as_float32(v)] for _, v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    w = x * n - sums
    centred = (w / n).astype(float)
    cov = centred.T @ centred / n
    values, vecs = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    return n, [int(sum(int(e) ** 2 for e in row)) for row in w], centred @ vecs[:, order] / np.sqrt(values[order]), values[order] / np.trace(cov), cov


@pytest.mark.parametrize("block", [4096, 7])
def test_whitening_matches_brute_force(spark, block):
    rng = np.random.default_rng(4)
    mix = rng.normal(0, 1, (6, 6))
    vectors = [(i, (rng.normal(0, 1, 6) @ mix).tolist()) for i in range(120)] + [(5, [0.25] * 6), (None, [0.5] * 6)]
    odd = [(300, None), (301, []), (302, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (303, [float("nan")] * 6), (304, [float("-inf")] * 6), (305, [1.0])]
    df = spark.createDataFrame(rows_of(vectors + odd), SCHEMA).repartition(3)
    got = whitening.whiten(df, rows_per_block=block).collect()
    n, deviation, whitened, explained, cov = brute_whitening(vectors, 32)
    assert len(got) == n and {r.n for r in got} == {n} and all(0 <= r.identity_error < 1e-9 for r in got)
    assert sorted(r.deviation for r in got) == sorted(deviation)
    np.testing.assert_allclose(got[0].explained, explained, rtol=1e-9)
    want = {i: (d, w) for (i, _), d, w in zip(vectors, deviation, whitened) if i not in (5, None)}
    sign = None
    for r in got:
        if r.id in want:
            d, w = want[r.id]
            assert r.deviation == d
            if sign is None:
                sign = np.sign(np.array(r.whitened) * w)
            np.testing.assert_allclose(np.array(r.whitened) * sign, w, atol=1e-8)


def test_whitening_query_over_a_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DIR}/embeddings.parquet").collect()]
    n, deviation, whitened, explained, _ = brute_whitening(usable(rows, 64), 32)
    got = queries.op11_whitening(spark, DIR).toPandas().sort_values(["component", "vec_id"])
    assert len(got) == 32 * n and (got.identity_error <= 1e-4).all() and got.identity_error.nunique() == 1
    ids = [i for i, _ in usable(rows, 64)]
    for c in range(1, 33):
        mine = got[got.component == c].set_index("vec_id")
        np.testing.assert_allclose(mine.explained.iloc[0], explained[c - 1], rtol=1e-9)
        w = mine.whitened.loc[ids].to_numpy()
        assert min(np.abs(w - whitened[:, c - 1]).max(), np.abs(w + whitened[:, c - 1]).max()) < 1e-6
        assert mine.deviation.loc[ids].tolist() == deviation


def test_whitening_without_variance(spark):
    """Copies only, one vector, no vectors, fewer dimensions of variance than components."""
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    one = whitening.whiten(spark.createDataFrame(rows_of([(1, [1.0, 2.0])] * 5), SCHEMA)).collect()
    assert [tuple(r) for r in one] == [(1, 5, 0, [0.0, 0.0], [0.0, 0.0], 0.0)] * 5
    line = whitening.whiten(spark.createDataFrame(rows_of([(i, [float(i), 2.0 * i, 7.0]) for i in range(9)]), SCHEMA)).collect()
    assert all(r.whitened[1:] == [0.0, 0.0] and abs(r.whitened[0]) > 0 or r.id == 4 for r in line) and line[0].identity_error < 1e-9
    assert abs(line[0].explained[0] - 1) < 1e-12
