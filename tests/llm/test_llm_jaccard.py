import itertools
import random
import re

import pytest

from packetloom.llm import graph, jaccard

SCHEMA = "doc_id long, text string, id string, text_key string"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    links = {i: set() for i in range(len(rows))}
    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and common >= 0.8 * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
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
        out.append((rows[i][0], len(links[i]), min(ids, default=None)))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def near(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    bases = [[f"w{rng.randrange(300)}" for _ in range(rng.choice([6, 40, 120, 400]))] for _ in range(25)]
    rows = [(i, near(rng, bases[i % 25], i % 5)) for i in range(100)]
    rows += [(200 + i, "One two  three\tFOUR") for i in range(4)] + [(210, "one two three four"), (211, "one two three")]
    rows += [(300, None), (301, ""), (302, " \n\t "), (None, "one two three four"), (None, None), (200, "One two  three\tFOUR")]
    rows += [(400, " ".join(f"v{i}" for i in range(30_000))), (401, " ".join(f"v{i}" for i in range(29_000)))]
    rows += [(500 + i, "né ça \xa0x " + " ".join(bases[3])) for i in range(3)]
    return rows


def test_bands_reach_the_recall():
    bands, length = jaccard.choose_bands(0.8, 0.9999)
    assert bands * length <= jaccard.MOST_HASHES and (1 - 0.8**length) ** bands <= 1e-4
    with pytest.raises(ValueError):
        jaccard.choose_bands(0.1, 0.9999, 20)


def test_same_as_all_pairs(spark, rows):
    found = jaccard.jaccard_join(frame(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_links"], r["component_id"]) for r in found), key=str) == brute(rows)
    classes = {r["doc_id"]: r["class_id"] for r in found}
    assert classes[203] == classes[210] == 200 and classes[211] == 211


def test_large_group_is_compared_in_blocks(spark):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, near(rng, base, 1 + i % 6)) for i in range(2 * jaccard.BLOCK + 30)]
    found = jaccard.jaccard_join(frame(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_links"], r["component_id"]) for r in found), key=str) == brute(rows)


def test_one_of_each_group_stays(spark, rows):
    kept = jaccard.drop_near_copies(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "id", "text_key"]
    got = [r["doc_id"] for r in kept.collect() if shingles(r["text"])]
    wanted = {low for _, _, low in brute([r for r in rows if shingles(r[1])])}
    assert sorted(got) == sorted(wanted)
    assert sum(not shingles(r["text"]) for r in kept.collect()) == 4


def test_empty_table(spark):
    empty = frame(spark, [(1, "a")]).limit(0)
    assert jaccard.jaccard_join(empty).count() == 0 and jaccard.drop_near_copies(empty).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(8, 60)] + [(1, 1), (3, 2)]
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(101, 161)} | {k: 7 for k in range(8, 60)} | {3: 2}
