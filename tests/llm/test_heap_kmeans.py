import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import heap_kmeans as H

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, size int, ids string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, "x") for i, v in rows], SCHEMA)


def brute(rows, k, rounds, size):
    """Lloyd's rounds by Python integers, every vector against every centroid."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    hashed = sorted(((i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in kept))
    centroids = [list(v) for _, _, v in hashed[:k]]

    def assign():
        out = []
        for _, v in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)))
        return out

    for _ in range(rounds):
        found = assign()
        for j in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, found, strict=True) if c == j]
            if own:
                centroids[j] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    found = assign()
    return sorted(((i, c, d, sum(e for e, b in found if b == c), sum(e for e, _ in found),
                    hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(kept, found, strict=True)), key=str)


def rows_of(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=str)


def blobs(n, size, seed=1, spread=0.05):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(5)]
    return [(i, [rng.gauss(x, spread) for x in centres[i % 5]]) for i in range(n)]


@pytest.mark.parametrize("seed,spread,k", [(1, 0.05, 5), (2, 1.0, 7), (3, 0.0, 6)])
def test_equals_lloyd(spark, seed, spread, k):
    rows = blobs(600, 6, seed, spread)
    got = H.heap_kmeans(frame(spark, rows).repartition(3), k=k, rounds=6, size=6)
    assert rows_of(got) == brute(rows, k, 6, 6)


def test_odd_rows(spark):
    v = [0.5, -0.25, 0.001]
    rows = [(1, v), (2, v), (2, v), (2, [1.0, 2.0, 3.0]), (None, [9.0, 9.0, 9.0]), (3, None), (4, []), (5, [1.0, 2.0]), (6, [1.0, None, 2.0]),
            (7, [float("nan"), 0.0, 0.0]), (8, [float("inf"), 0.0, 0.0]), (9, [1000.5, -40000.0, 3.0]), (10, [1.0] * 4)]
    for k in (1, 2, 3, 40):
        assert rows_of(H.heap_kmeans(frame(spark, rows), k=k, rounds=3, size=3)) == brute(rows, k, 3, 3)
    assert H.heap_kmeans(frame(spark, []), size=3).count() == 0
    assert H.heap_kmeans(frame(spark, rows[5:9]), size=3).count() == 0
    with pytest.raises(Exception, match="would not fit a long"):
        H.heap_kmeans(frame(spark, [(1, [1e30, 0.0, 0.0])]), size=3).count()


def test_only_expired_vectors_are_scanned(spark):
    """Well separated clusters settle: later rounds pop few vectors, and no fewer than have to move."""
    rows = blobs(3000, 8, 4, 0.02)
    got = H.heap_kmeans(frame(spark, rows), k=5, rounds=8, size=8)
    assert rows_of(got) == brute(rows, 5, 8, 8)
    scanned = got.first().rescanned
    assert 3000 <= scanned < 3000 * 9 / 2


def test_heaps():
    heaps = H.Heaps([[] for _ in range(3)])
    zero = np.zeros(3)
    heaps.enter([0, 1, 2, 3], np.array([0, 1, 1, 2]), np.array([5.0, 1.0, -1.0, np.inf]), zero)
    assert heaps.expired(zero) == [2]
    heaps = H.Heaps.unpack(*heaps.pack())
    assert heaps.expired(np.array([4.9, 1.0, 1e9])) == [1]
    heaps.enter([1], np.array([0]), np.array([2.0]), np.array([4.9, 1.0, 1e9]))  # enters with what its new cluster has drifted so far
    assert heaps.expired(np.array([5.0, 1.0, 1e9])) == [0]
    assert heaps.expired(np.array([6.8, 0, 0])) == [] and heaps.expired(np.array([6.95, 0, 0])) == [1]


def test_distances_are_exact():
    rng = np.random.default_rng(1)
    for top in (100, 1 << 20, 1 << 26):
        x = rng.integers(-top, top, (50, 16)).astype(np.int32)
        c = rng.integers(-top, top, (4, 16))
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, w, strict=True)) for w in c] for v in x]
        assert H.distances(x, c).tolist() == want


def test_drifts():
    old = np.array([[0, 0], [10, 0], [0, 10]])
    new = np.array([[3, 4], [10, 1], [0, 10]])
    assert np.allclose(H.drifts(old, new), [5 + 1, 1 + 5, 0 + 5])
