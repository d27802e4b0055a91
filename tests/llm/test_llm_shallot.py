"""Shallot search against the plain method in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from packetloom.llm import shallot

COLUMNS = "vec_id long, embedding array<double>, cluster int, moves string"


def plain(rows, clusters, dims, rounds, scale=1024, seed=3):
    """(id, cluster, distance, cluster_inertia, inertia, sha) per vector, sorted."""
    most = shallot.limit(dims) / scale
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and -most <= x < most for x in v)
    ]
    name = lambda r: hashlib.sha256(f"{seed}:{'null' if r[0] is None else r[0]}".encode()).hexdigest()
    packed = lambda r: np.asarray(r[1], "<i4").tobytes().hex().upper()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r), packed(r)))[:clusters]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min((square(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            mine = [v for (_, v), a in zip(kept, at) if a == j]
            if mine:
                centroids[j] = [sum(column) // len(mine) for column in zip(*mine)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    sums = {j: sum(d for _, c, d in found if c == j) for j in range(len(centroids))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, sums[c], sum(sums.values()), sha[c]) for i, c, d in found), key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def rows_of(seed, n, dims, spread=0.3, groups=5):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(groups)]
    return [(i, [m + rng.gauss(0, spread) for m in rng.choice(middles)]) for i in range(n)]


@pytest.mark.parametrize("seed,dims,clusters,spread", [(1, 4, 8, 0.3), (2, 64, 8, 0.05), (3, 2, 12, 0.8), (4, 1, 3, 0.1), (5, 3, 1, 0.2)])
def test_equals_the_plain_method(spark, seed, dims, clusters, spread):
    rows = rows_of(seed, 300, dims, spread)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], COLUMNS).repartition(3)
    got = found(shallot.shallot_kmeans(frame, clusters=clusters, dims=dims, rounds=6))
    assert got == plain(rows, clusters, dims, 6)


def test_ties_repeated_rows_and_bad_vectors(spark):
    rows = [(i, [float(i % 4), float(i % 2)]) for i in range(40)] + [(3, [3.0, 1.0])] * 20 + [(None, [0.5, 0.5])]
    rows += [(90, None), (91, [1.0]), (92, [1.0, None]), (93, [1.0, math.nan]), (94, [1.0, math.inf]), (95, [1e30, 0.0]), (96, []), (97, [-0.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], COLUMNS)
    assert found(shallot.shallot_kmeans(frame, dims=2, clusters=6, rounds=5)) == plain(rows, 6, 2, 5)


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(1, [0.25, 0.5]), (2, [0.75, 0.5])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], COLUMNS)
    assert found(shallot.shallot_kmeans(frame, dims=2)) == plain(rows, 8, 2, 10)
    empty = shallot.shallot_kmeans(frame.limit(0), dims=2)
    assert empty.count() == 0 and empty.columns[0] == "vec_id"


def test_largest_components_stay_exact(spark):
    edge = (shallot.limit(2) - 1) / 1024
    rows = [(0, [edge, edge]), (1, [-edge, -edge]), (2, [edge, -edge]), (3, [edge - 1, edge])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], COLUMNS)
    assert found(shallot.shallot_kmeans(frame, dims=2, clusters=2, rounds=2)) == plain(rows, 2, 2, 2)


def test_most_vectors_are_not_looked_at(monkeypatch):
    """After some rounds the bounds leave out most vectors of well parted groups."""
    rng = np.random.default_rng(3)
    middles = rng.integers(-4000, 4000, (6, 16))
    vectors = (middles[rng.integers(0, 6, 3000)] + rng.integers(-60, 60, (3000, 16))).astype(np.int64)
    now = shallot.Centroids.of(middles.astype(np.int64))
    state = shallot.advance(vectors, np.zeros(3000, int), np.ones(3000, int), np.full(3000, np.inf), np.zeros(3000), now)
    seen = []
    search = shallot.search
    monkeypatch.setattr(shallot, "search", lambda v, *rest: seen.append(len(v)) or search(v, *rest))
    moved = shallot.Centroids.of(now.points + 1, now.points)
    again = shallot.advance(vectors, *state, moved)
    assert sum(seen) < 30
    full = ((vectors[:, None, :] - moved.points[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (again[0] == full).all()
