"""Token counts, decontamination, toxicity and the language model."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest import TESTDATA
from packetloom.llm import decontaminate, lm, tokens, toxicity

DOCS = "doc_id long, text string, half string, key int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)


# token counts

ODD = [
    None, "", " ", "a", "it's we're I'd", "  two  spaces\n\n\ttab ", "x<|endoftext|>y", "日本語 text", "naïve café 12³ ½",
    "\x0b\x0c\x1c\x85 \xa0 z", "!!??...---", "é" * 50_000, "supercalifragilistic " * 4000, "'''s 's'S", "a\r\n b",
    "“curly” quotes’ — dash … € 5", "Привет, мир! 한국어 텍스트 ١٢٣", "👩‍👩‍👧 emoji\u2028line\u3000wide", "ﬁ ½ Å n\u0303 \ud7ff",
]


def test_token_counts_equal_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a b"), (3, "a")]
    found = tokens.token_counts(frame(spark, rows), path, limit=3).collect()
    assert len(found) == len(rows)
    for r in found:
        if r["doc_id"] is not None:
            text = ODD[r["doc_id"]] or ""
            n = len(library.encode(text, add_special_tokens=False).ids)
            assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(text.encode()), n > 3)
    assert tokens.token_counts(frame(spark, rows).limit(0), path).count() == 0


def test_cache_starts_anew_when_full():
    import public_tokenizers

    tokenizer = tokens.load(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = tokens.Lengths({"a": 1}, tokenizer, 2)
    assert [lengths[p] for p in ("a", "bb", "cc", "dd")] == [1, 1, 1, 1]
    assert set(lengths) == {"a", "dd"}


# decontamination

ITEM = "Anna bought 12 kg of sweet apples for 30 dollars on the old market while it rained in Paris all day"
OTHER = "Please explain how seven quiet rivers carve their deep valleys through layers of very old grey stone"


def leaked(spark, texts, items, **options):
    docs = frame(spark, list(enumerate(texts)))
    found = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string"), **options)
    return {(r["doc_id"], r["item_id"]): r for r in found.collect()}


def test_exact_edited_and_changed_items(spark):
    changed = ITEM.replace("12", "7").replace("30", "45.50").replace("kg", "lb").replace("Anna", "Boris").replace("Paris", "Rome")
    texts = [
        f"some words {ITEM} some more",
        f"x {changed}, y",
        "nothing of that kind is here " * 30,
        ITEM.replace("old", "new") + " " + OTHER,
        None,
        "",
        "lorem ipsum " * 20_000 + ITEM.upper().replace("ANNA", "Anna").replace("PARIS", "Paris"),
        " ".join(ITEM.split()[:9]),
    ]
    items = [(1, ITEM), (2, OTHER), (3, None), (None, ITEM), (4, ""), (5, "too short"), (6, "12 kg 7 m 9 s 10 h 4 cm")]
    found = leaked(spark, texts, items)
    assert set(found) == {(0, 1), (1, 1), (3, 1), (3, 2), (6, 1)}
    assert not found[0, 1]["changed"] and found[1, 1]["changed"] and found[1, 1]["conflicts"] == 0


def test_slots_must_map_one_to_one(spark):
    words = "the Xa met Xb and Xa gave 1 to Xb then Xb gave 2 to Xa and 3 to Xb while Xa kept 4 of them for the Xb".split()
    item = " ".join({"Xa": "Anna", "Xb": "Boris"}.get(w, w) for w in words)
    same = " ".join({"Xa": "Clara", "Xb": "Dora"}.get(w, w) for w in words)
    mixed, names = [], iter("Aa Bb Cc Dd Ee Ff Gg Hh Ii Jj".split())
    for w in words:
        mixed.append(next(names) if w in ("Xa", "Xb") else "5" if w.isdigit() else w)
    assert set(leaked(spark, [same, " ".join(mixed)], [(1, item)])) == {(0, 1)}


def test_drop_leaks_keeps_the_rest(spark):
    docs = frame(spark, [(1, ITEM), (1, "clean"), (None, ITEM), (None, None), (2, "clean"), (2, "clean")])
    bench = spark.createDataFrame([(1, ITEM), (1, ITEM)], "item_id long, text string")
    kept = decontaminate.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(
        map(str, [(1, "clean"), (None, None), (2, "clean"), (2, "clean")])
    )
    assert decontaminate.drop_leaks(docs, bench.limit(0)).count() == 6
    assert decontaminate.drop_leaks(docs.limit(0), bench).count() == 0


def test_short_dense_and_lower_case_copies_are_dropped(spark):
    dense = "Anna 12 Boris 7 Clara 9 Dora 11 Emil 30 Frida 2 Gustav 5 Hanna 8 how many"
    mostly = "The red fox sold seven old hats Anna 12 Boris 7 Clara 9 Dora 11 Emil 30 Frida 2 Gustav 5 Hanna 8 Ida 4 Jan 6"
    items = [(1, "What is 17 * 23?"), (2, dense), (3, ITEM), (4, "Why 42?"), (5, mostly), (6, None), (7, "...")]
    bad = [
        "well, What is 17 * 23? I ask", f"a {dense} b", f"a {dense.lower()} b", f"a {ITEM.lower()} b", "why 42",
        mostly.replace("12", "13").replace("Clara", "Carl"), "Now think. What is 18 * 24?\nSay it.",
    ]
    good = ["and What is 18 * 23", "why 43", "and why 42 then", "Anna 12", "", None, "the old market while", "nothing here " * 40]
    docs = frame(spark, list(enumerate(bad + good)))
    kept = decontaminate.drop_leaks(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(len(bad), len(bad) + len(good)))


def test_kinds_of_leaks(spark):
    dense = "Anna 12 Boris 7 Clara 9 Dora 11 Emil 30 Frida 2 Gustav 5 Hanna 8 how many"
    items = [(1, "What is 17 * 23?"), (2, dense), (3, ITEM), (4, "Paris"), (5, "Name it. Is 5 prime?")]
    texts = [
        "So. What is 5 * 6? Right.",
        f"x {dense} y",
        ITEM.replace("12", "13"),
        ITEM.lower(),
        "Paris.",
        "paris",
        "I saw Paris. Paris! It was nice",
        "Well. Name it. Is 9 prime? Yes",
        "Name it. Then. Is 9 prime?",
        dense.replace("12", "13").replace("7", "8"),
        "What is 5 * 6 and more?",
    ]
    found = leaked(spark, texts, items)
    kinds = {k: r["kind"] for k, r in found.items()}
    assert kinds == {
        (0, 1): "sentence", (1, 2): "words", (2, 3): "template", (3, 3): "template", (4, 4): "whole", (5, 4): "whole", (7, 5): "sentence",
        (9, 2): "words",
    }
    assert found[7, 5]["slots"] == 3 and found[7, 5]["changed"] and not found[1, 2]["changed"]


def test_one_ordinary_word_does_not_empty_the_corpus(spark):
    docs = frame(spark, [(1, "the cat sat on the mat"), (2, "The."), (3, "the the"), (4, "dog")])
    kept = decontaminate.drop_leaks(docs, spark.createDataFrame([(1, "the"), (2, "on the")], "item_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]


def test_long_words_take_linear_time(spark):
    import time

    items = [(1, ITEM), (2, "What is 17 * 23?")]
    leaked(spark, [ITEM], items)
    for text in ("a" * 1_000_000, "a." * 500_000, "1" * 1_000_000, "A" * 1_000_000, "!?" * 500_000, "\x01" * 1_000_000):
        started = time.time()
        assert set(leaked(spark, [f"1 {text} 2 {ITEM}"], items)) == {(0, 1)}
        assert time.time() - started < 5, text[:2]


# toxicity

@pytest.fixture(scope="module")
def scored(spark):
    at = str(TESTDATA / "sf0.1")
    docs = spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{at}/labels.parquet").select("doc_id", "toxic")
    found = toxicity.toxicity_scores(docs, labels).toPandas()
    return found, found.merge(labels.toPandas(), on="doc_id")


def test_held_out_accuracy(scored):
    found, judged = scored
    assert found["score"].between(0, 1).all() and (found["predicted"] == (found["score"] >= 0.5)).all()
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found["doc_id"]]).all()
    held = judged[judged["held_out"]]
    toxic, clean = held[held["toxic"] == 1], held[held["toxic"] == 0]
    assert toxic["predicted"].mean() > 0.85 and clean["predicted"].mean() < 0.02


def test_labels_of_one_kind_and_none(spark):
    docs = frame(spark, [(1, "you idiot"), (2, None), (None, "x"), (3, ""), (3, "")])
    one = spark.createDataFrame([(1, 1), (2, None), (3, 1), (None, 0)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.toxicity_scores(docs, one).collect()} <= {0.0, 1.0}
    assert [r["score"] for r in toxicity.toxicity_scores(docs, one.limit(0)).collect()] == [0.0] * 5
    assert toxicity.toxicity_scores(docs.limit(0), one).count() == 0
    kept = toxicity.drop_toxic(docs, one.limit(0))
    assert kept.columns == docs.columns and kept.count() == 5


def test_features_of_disguised_words():
    codes = toxicity.Codes({"idiot": 5.0, "scum*": 3.0})
    hits = {w: (codes[w] & toxicity.WEIGHT) / 100 for w in ("idiot", "IDIOT!!", "1d10t", "id-iot", "scummy", "river")}
    assert hits == {"idiot": 5.0, "IDIOT!!": 5.0, "1d10t": 5.0, "id-iot": 5.0, "scummy": 3.0, "river": 0.0}
    rows = toxicity.feature_matrix(["you absolute idiot", "idiot " + "w " * 9 + "you", ""], codes)
    near = toxicity.FEATURES.index("near_second_person")
    assert rows[:, near].tolist() == [1.0, 0.0, 0.0] and not rows[2].any()


# language model

def base_scores(texts):
    def words(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]

    listed = {i: words(t) for i, t in texts}
    seen = Counter(w for i, x in listed.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in x)
    n, v = sum(seen.values()), len(seen)
    base = {i: sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x) for i, x in listed.items()}
    return base, {i: (len(x), sum(seen[w] > 0 for w in x), n) for i, x in listed.items()}


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 1


def test_base_score_and_counts(spark):
    texts = [(i, f"Der the ÄB x{i % 7} \x0b the\nend {'long ' * (i % 4)}") for i in range(120)]
    texts += [(200, None), (201, ""), (202, "A\xa0b"), (203, "word " * 30_000)]
    base, counts = base_scores(texts)
    for r in lm.context_mixing_scores(frame(spark, texts)).collect():
        i = r["doc_id"]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == counts[i] and r["held_out"] == held(i)
        assert r["base_score"] == pytest.approx(base[i]) and r["score"] < 0
        assert r["bits_per_byte"] == pytest.approx(-r["score"] / math.log10(2) / (len((dict(texts)[i] or "").encode()) + 1))


def test_probabilities_of_different_texts_add_up_to_one_at_most(spark):
    ids = [i for i in range(3000) if held(i)]
    words = ["", *(f"w{k}" for k in range(40)), "new", "other", "zzz", "w1 w1", "w1 w2", "w2 w1", "w0 w0 w0"]
    train = [(i, " ".join(f"w{(i * k) % 40}" for k in range(i % 5))) for i in range(3000) if not held(i)]
    found = lm.context_mixing_scores(frame(spark, [*train, *zip(ids, words)])).filter("held_out").collect()
    total = sum(10 ** r["score"] for r in found)
    assert len(found) == len(words) and 0.1 < total <= 1


def test_spelling_is_a_distribution():
    words = [b"then", b"this", b"that", b"hat"] * 20
    cells, gates, bits, _ = lm.spelling_bits(words)
    mixer = lm.BitMixer(lm.ORDERS, 64, np.zeros((lm.ORDERS, lm.SPELLING_CELLS, 2), np.float32))
    for k in range(lm.ORDERS):
        np.add.at(mixer.tables[k], (cells[:, k], bits), 1)
    mixer.learn(cells, gates, bits)
    mixer.freeze()
    one_byte = [bytes([b]) for b in range(256) if b not in (9, 10, 11, 12, 13, 32)]
    assert (10 ** lm.spelled([b"", *one_byte], mixer)).sum() < 1
    assert lm.spelled([b"then"], mixer)[0] > lm.spelled([b"tnhe"], mixer)[0]


def test_the_texts_are_read_and_split_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    docs = frame(spark, [(i, f"some words {i % 9} and w{i}") for i in range(90)])
    assert lm.context_mixing_scores(docs.mapInArrow(watched, docs.schema)).count() == 90
    assert seen.value == 90


def test_words_of_a_block():
    texts = [b"The end of the END", b"", b"a b a", b"xx yy xx of", b"of it the of", b"new of new"]
    train = np.array([True, True, False, True, True, False])
    tally = lm.WordTally(0)
    for part in (slice(0, 2), slice(2, 6)):
        rows = pa.record_batch({"id": pa.array(range(6)[part])})
        tally.add(rows, texts[part], train[part])
    *rows, words = tally.told()
    places = words.column("place").to_pylist()
    names = dict(zip(places, words.column("word").to_pylist()))
    listed = [[*t.lower().split(), lm.END] for t in texts]
    assert [i for r in rows for i in r.column("id").to_pylist()] == [*range(6)]
    assert [[names[k] for k in np.frombuffer(x, np.int32)] for r in rows for x in r.column("tokens").to_pylist()] == listed
    assert [names[k] for k in range(len(names))] == sorted({w for x in listed for w in x})
    assert [k for r in rows for k in r.column("place").to_pylist()] == [*range(6)]

    leads = {0: b"the", 1: lm.END, 3: lm.END, 4: b"the"}  # the first of the most frequent words of three bytes or more
    group = {i: zlib.crc32(w) % (lm.GROUPS - 1) + 1 for i, w in leads.items()}
    for place, c, df, best in zip(places, *(words.column(k).to_pylist() for k in ("c", "df", "best"))):
        word = names[place]
        having = [i for i in leads if word in listed[i]]
        by_group = Counter(group[i] for i in having)
        most = max(by_group.values(), default=0)
        lead = min((g for g, n in by_group.items() if n == most), default=0) if word != lm.END else 0
        assert (c, df, best) == (sum(listed[i].count(word) for i in leads), len(having), most * lm.GROUPS + lead)


def test_cells_of_a_branch_are_those_of_its_contexts_with_the_node():
    words = {"df": np.array([5, 3, 2, 0]), "group": np.array([0, 7, 30, 0])}
    part = lm.Slice([np.array([1, 2, 1, 3, 2, 0]), np.array([2, 1, 0])], np.array([True, False]), words, 9)
    rows = np.arange(len(part.chosen))
    plain = [np.resize([17, 4000, 3, 0, 99], len(rows)) * lm.GROUPS] * len(part.group_keys)
    part.group_keys = lm.cell_keys(*plain)
    for cells, node, _ in part.branches(rows):
        assert (cells == lm.hashed_cells(*(x + node for x in plain))).all()


def test_every_rare_word_teaches_the_spelling(spark):
    words = [f"w{i * 7919 % 1000003}".encode() for i in range(21_000)]
    rare = spark.createDataFrame([(w,) for w in words], "word binary")
    mixer = lm.spelling_mixer(rare)
    assert mixer.refined.sum() == 8 * sum(len(w) + 1 for w in words)  # eight bits of every byte and of the ends
    hashes = {bytes(w): h for w, h in rare.selectExpr("word", "xxhash64(word)").collect()}
    alone = lm.spelling_run(sorted(words, key=hashes.__getitem__), mixer.tables)
    assert np.allclose(mixer.weights, alone.weights) and np.allclose(mixer.refined, alone.refined)


def test_runs_of_the_spelling_are_averaged(spark, monkeypatch):
    monkeypatch.setattr(lm, "SPELLING_WORDS", 900)
    words = [f"w{i * 7919 % 1000003}".encode() for i in range(2000)]
    rare = spark.createDataFrame([(w,) for w in words], "word binary")
    mixer = lm.spelling_mixer(rare)
    hashes = {bytes(w): h for w, h in rare.selectExpr("word", "xxhash64(word)").collect()}
    ordered = sorted(words, key=hashes.__getitem__)
    each = [lm.spelling_run([w for w in ordered if hashes[w] % 3 == k], mixer.tables) for k in range(3)]
    bits = [one.refined.sum(axis=(1, 2))[:, None] for one in each]
    assert np.allclose(mixer.refined, sum(one.refined for one in each))
    seen = mixer.refined.sum(axis=(1, 2)) > 0
    mean = sum(n * one.weights for n, one in zip(bits, each))[seen] / sum(bits)[seen]
    assert seen.sum() > 40 and np.allclose(mixer.weights[seen], mean)


def test_better_than_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet(str(TESTDATA / "sf0.1" / "documents.parquet")).select("doc_id", "text")
    found = lm.context_mixing_scores(docs).filter("held_out").toPandas()
    assert found["score"].sum() > found["base_score"].sum()
    assert (found["score"] > found["base_score"]).mean() > 0.8


def test_every_slice_of_a_block_teaches(monkeypatch):
    monkeypatch.setattr(lm, "SLICE_BYTES", 200_000)
    plain = [" ".join(f"w{(i * 7 + k) % 300}" for k in range(100)) for i in range(1500)]
    echo = [" ".join(f"w{(i * 7 + k // 2) % 300}" for k in range(100)) for i in range(1500)]
    held = [" ".join(f"w{(i * 11 + k // 2) % 300}" for k in range(100)) for i in range(50)]
    names = [lm.END, *(f"w{k}".encode() for k in range(300))]
    words = {"word": np.array(names, object), "group": np.array([0] + [1] * 300), "c": np.full(301, 1000), "df": np.full(301, 999)}
    words["part"] = np.log10(words["df"] / words["df"].sum())
    group_df = np.bincount(words["group"], words["df"], minlength=lm.GROUPS).astype(float)

    def score(train):
        texts = [*train, *held]
        taught = np.array([True] * len(train) + [False] * len(held))
        return lm.score_block(texts, taught, words, group_df, 301_000, 301)["score"][len(train) :].sum()

    alone = score(plain)
    assert score(plain + echo) > alone + 0.02 * abs(alone)  # what comes late in the block teaches as well


def test_new_words_are_counted_after_the_two_words_before_in_all_texts(spark):
    draw = np.random.default_rng(5)
    texts = {i: " ".join(f"w{k}" for k in draw.integers(0, 9, draw.integers(0, 15))) for i in range(300)}
    listed = {i: ["", "", *t.split(), "END"] for i, t in texts.items()}
    events = {i: [tuple(x[k - 2 : k + 1]) for k in range(2, len(x)) if x[k] not in x[2:k]] for i, x in listed.items()}
    docs = spark.createDataFrame([(i, not held(i), t) for i, t in texts.items()], "id long, train boolean, text string").repartition(3)
    blocks = lm.settle(lm.numbered_blocks(docs), "lm-test")
    told = lm.pair_counts(blocks.filter("keys is not null").select("block", "place", "c", "keys", "n"), 1).toPandas()
    rows, seen = blocks.toPandas(), []
    assert told["piece"].max() > 0 and rows["block"].nunique() == 3
    for block, part in rows.groupby("block"):
        words = part[part["word"].notnull()].sort_values("place")
        name = lm.mixed(np.array([zlib.crc32(w) for w in words["word"]], np.uint64))
        own = part[part["tokens"].notnull()].sort_values("place")
        tokens = [lm.unpacked(x, int(c), np.int32) for x, c in zip(own["tokens"], own["c"])]
        pairs = told[told["block"] == block].sort_values(["place", "piece"])
        counts, totals = (np.concatenate([lm.unpacked(x, c, np.int64) for x, c in zip(pairs[k], pairs["c"])]) for k in ("counts", "totals"))
        parts = [slice(0, 7), slice(7, len(tokens))]
        found = lm.followers(tokens, parts, own["train"].to_numpy(bool), name, counts, totals)
        for i, x, after in zip(own["id"].astype(int), listed, found):
            others = [e for j in texts if j != i and not held(j) for e in events[j]]
            expected = {e[2]: (others.count(e), sum(o[:2] == e[:2] for o in others)) for e in events[i]}
            first = [k for k in range(len(listed[i]) - 2) if listed[i][k + 2] not in listed[i][2 : k + 2]]
            assert {listed[i][k + 2]: tuple(after[:, k].astype(int)) for k in first} == expected
            assert (np.delete(after, first, axis=1) == 0).all()
            seen.append(i)
    assert sorted(seen) == sorted(texts)


def test_texts_of_the_corpus_are_known_by_the_order_of_their_words(spark):
    draw = np.random.default_rng(7)
    train = {i: [f"w{k}" for k in draw.permutation(900)[:60]] for i in range(600) if not held(i)}
    texts = {i: " ".join(x) for i, x in train.items()}
    copies, mixed_up = [i for i in range(600) if held(i)][:40], [i for i in range(600) if held(i)][40:80]
    for i, x in zip(copies + mixed_up, train.values()):
        texts[i] = " ".join(x if i in copies else draw.permutation(x))
    found = lm.context_mixing_scores(frame(spark, texts.items()).repartition(4)).toPandas().set_index("doc_id")["bits_per_byte"]
    assert found[copies].max() < 0.6 * found[mixed_up].min()  # their training texts are mostly in other blocks


def test_no_training_rows_and_no_rows(spark):
    ids = [i for i in range(40) if held(i)]
    found = lm.context_mixing_scores(frame(spark, [(i, "some words") for i in ids])).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in found} == {(0, 0, 0.0)}
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    assert lm.context_mixing_scores(frame(spark, [(1, "a")]).limit(0)).count() == 0
