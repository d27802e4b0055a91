import itertools

import numpy as np
import pytest

from packetloom.llm import lattice

SCHEMA = "vec_id long, embedding array<float>, label int, node string"


def brute(rows):
    """Links and components by comparing all pairs."""

    def ready(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = {i: set() for i in range(len(rows))}
    for i, j in itertools.combinations(range(len(rows)), 2):
        (_, a, la, *_), (_, b, lb, *_) = rows[i], rows[j]
        if la is not None and la == lb and ready(a) and ready(b) and len(a) == len(b):
            a, b = np.float32(a).astype(float), np.float32(b).astype(float)
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.98:
                links[i].add(j)
                links[j].add(i)
    out = []
    for i in links:
        reached, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - reached:
                reached.add(j)
                todo.append(j)
        ids = [rows[k][0] for k in reached if rows[k][0] is not None]
        low = min(ids, default=None)
        out.append((rows[i][0], len(links[i]), low, rows[i][0] == low))
    return sorted(out, key=str)


def result(spark, rows):
    found = lattice.lattice_near_copies(spark.createDataFrame(rows, SCHEMA))
    return sorted(map(tuple, found.collect()), key=str)


def test_nearest_point_is_the_nearest_of_all_neighbours():
    x = np.random.default_rng(1).normal(size=(500, 8)) * 2
    found = lattice.nearest_point(x)
    doubled = np.rint(found * 2)
    assert np.allclose(doubled, found * 2) and ((doubled % 2).sum(axis=1) % 8 == 0).all() and (found.sum(axis=1) % 2 == 0).all()
    own = ((x - found) ** 2).sum(axis=1)
    for step in lattice.minimal_vectors():
        assert (own <= ((x - found - step) ** 2).sum(axis=1) + 1e-9).all()


def test_recall_at_the_threshold():
    rng, shape = np.random.default_rng(2), lattice.Lattice()
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    met = np.zeros(len(a), bool)
    for t in range(shape.tables):
        met |= (lattice.cells(b, t, shape) == lattice.cells(a, t, shape)[:, :1]).any(axis=1)
    assert met.all()


def test_same_as_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows, centres = [], rng.normal(size=(6, 64))
    for i in range(150):
        v = centres[i % 6] + rng.normal(size=64) * [0.02, 0.1, 0.13, 0.15][i % 4]
        rows.append((i, [float(x) for x in v], i % 2 if i % 11 else None, "x"))
    base = [float(x) for x in rng.normal(size=64)]
    rows += [(200 + i, base, 1, "copy") for i in range(90)]
    rows += [(200, base, 1, "again"), (None, base, 1, None), (None, base, None, None)]
    rows += [(300, None, 1, ""), (301, [0.0] * 64, 1, ""), (302, [float("nan")] * 64, 1, ""), (303, [None, *base[1:]], 1, "")]
    rows += [(304, [float("inf"), *base[1:]], 1, ""), (305, [], 1, ""), (306, [3.0], 1, ""), (307, [4.0], 1, ""), (308, [-4.0], 1, "")]
    assert result(spark, rows) == brute(rows)


def test_crowded_cell_is_compared_in_blocks(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=64)
    rows = [(i, [float(x) for x in centre + rng.normal(size=64) * 0.09], 0, "") for i in range(3 * lattice.BLOCK)]
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)]])
def test_nothing_to_compare(spark, rows):
    assert result(spark, rows) == [(1, 0, 1, True)] * len(rows)


def facing(dim, n, cosine, seed=3):
    """Pairs of unit vectors at the cosine."""
    rng = np.random.default_rng([seed, dim])
    a = rng.normal(size=(n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    c = rng.normal(size=(n, dim))
    c -= (a * c).sum(axis=1, keepdims=True) * a
    return a, cosine * a + np.sqrt(1 - cosine**2) * c / np.linalg.norm(c, axis=1, keepdims=True)


@pytest.mark.parametrize("dim", [8, 12, 16, 24, 64, 384, 768])
@pytest.mark.parametrize("cosine", [0.98, 0.95])
def test_recall_and_selectivity_in_any_dimension(dim, cosine):
    a, b = facing(dim, 1200, cosine)
    shape = lattice.shape_for(dim, cosine)
    met, unrelated = np.zeros(len(a), bool), 0
    for t in range(shape.tables):
        own, looks = lattice.cells(a, t, shape)[:, :1], lattice.cells(b, t, shape)
        met |= (looks == own).any(axis=1)
        unrelated += (np.roll(looks, 1, axis=0) == own).any(axis=1).sum()
    assert met.mean() >= 0.999
    # at a lower cosine steps are longer and unrelated vectors meet more often
    if cosine == 0.98:
        assert unrelated / (len(a) * shape.tables) < 0.01


def test_mixed_dimensions_are_compared_among_themselves(spark):
    rows, wanted = [], {}
    for k, dim in enumerate((8, 64, 384)):
        a, b = facing(dim, 40, 0.985)
        for i in range(40):
            rows += [(1000 * k + 2 * i, a[i].tolist(), 1), (1000 * k + 2 * i + 1, b[i].tolist(), 1)]
            wanted[1000 * k + 2 * i] = wanted[1000 * k + 2 * i + 1] = 1000 * k + 2 * i
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: r["component_id"] for r in lattice.lattice_near_copies(frame).collect()}
    wrong = {i for i in found if found[i] != wanted[i] and i >= 1000}
    assert not wrong and set(found) == set(wanted)
