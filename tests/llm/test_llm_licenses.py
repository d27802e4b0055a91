"""License scans against a plain scan of words."""

import random
import re

from packetloom.llm import licenses

COLUMNS = "doc_id long, text string, row long, label string, hits int"
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}


def words_of(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def base_of(text):
    words = words_of(text)
    places = []
    for label, phrase in BASE.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in places}))


def notices_of(text):
    """Labels and the best share, from all grams of all templates."""
    words, labels, best = words_of(text), set(), 0.0
    for t in licenses.TEMPLATES:
        m, k = len(t.words), t.gram
        diagonals = {}
        for p in range(m - k + 1):
            for i in range(len(words) - k + 1):
                if tuple(words[i : i + k]) == t.words[p : p + k]:
                    diagonals.setdefault(i - p, set()).update(range(p, p + k))
        last, held = None, set()
        for d in [*sorted(diagonals), None]:
            if d is None or (last is not None and d - last > t.slack):
                if len(held) >= t.needed:
                    labels.add(t.label)
                    best = max(best, len(held) / m)
                held = set()
            if d is not None:
                held |= diagonals[d]
                last = d
    return ",".join(sorted(labels)), best


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def expected(rows):
    out = []
    for doc_id, text in rows:
        n, count, first, last, base = base_of(text)
        labels, score = notices_of(text)
        out.append((doc_id, n, count, first, last, base, labels, score))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], COLUMNS)


def damaged(rng, t, changes):
    words = list(t.words)
    for _ in range(changes):
        k = rng.randrange(len(words))
        words[k : k + 1] = rng.choice([[], ["other"], [words[k], "more"]])
    return " ".join(words)


def test_scan_equals_plain_scan(spark):
    rng = random.Random(5)
    vocabulary = ["mit", "MIT", "License", "license", "Apache", "general", "public", "cc", "by", "é", "naïve", "4.0", "the", "copy", "of"]
    rows = [(i, " ".join(rng.choice(vocabulary) + rng.choice(["", ",", ".\n", "-"]) for _ in range(rng.randrange(60)))) for i in range(150)]
    for i, t in enumerate(licenses.TEMPLATES * 2):
        text = damaged(rng, t, i % 5 if len(t.words) >= licenses.LONG else 0)
        rows.append((1000 + i, "some words " * (i % 7) + text.upper() + " and more " + (text if i % 2 else "")))
    rows += [(1, "MIT  license"), (1, "MIT  license"), (None, "the Apache\nLicense"), (2, None), (3, ""), (4, "..."), (5, "MİT license mıt license")]
    got = found(licenses.license_scan(frame(spark, rows).repartition(4)))
    assert got == expected(rows)


def test_notice_with_changed_words_is_found_and_half_of_one_is_not(spark):
    mit = next(t for t in licenses.NOTICES if len(t.words) > 40)
    whole, half = " ".join(mit.words), " ".join(mit.words[: len(mit.words) // 2])
    changed = whole.replace("free of charge", "gratis and free of charge").replace("sublicense", "license")
    rows = {r["doc_id"]: r for r in licenses.license_scan(frame(spark, [(1, whole), (2, changed), (3, half), (4, half + " x" * 50 + half)])).collect()}
    assert rows[1]["labels"] == "mit" and rows[1]["score"] == 1.0 and rows[1]["n_base"] == 0
    assert rows[2]["labels"] == "mit" and 0.8 <= rows[2]["score"] < 1
    assert rows[3]["labels"] == rows[4]["labels"] == "" and rows[3]["score"] == 0.0


def test_spans_name_the_place(spark):
    scanned = licenses._scan(frame(spark, [(1, "a b the Apache License, Version 2.0")]), "doc_id", "text", licenses.TEMPLATES)
    spans = licenses.license_spans(scanned.selectExpr("*", "7L AS row")).collect()
    assert [(r["row"], r["first"], r["last"], r["covered"]) for r in spans] == [(7, 3, 5, 2)]


def test_very_long_texts_and_empty_table(spark):
    long = "word " * 300_000 + "mit license " * 2_000 + "x" * 1_000_000
    got = licenses.license_scan(frame(spark, [(1, long), (2, "é" * 400_000 + " mit license")])).collect()
    rows = {r["doc_id"]: r for r in got}
    assert (rows[1]["n_words"], rows[1]["n_base"], rows[1]["first_word"], rows[1]["last_word"]) == (304_001, 2_000, 300_000, 303_998)
    assert (rows[2]["n_words"], rows[2]["n_base"], rows[2]["first_word"]) == (3, 1, 1)
    assert licenses.license_scan(frame(spark, [])).count() == 0


def test_the_words_decide_not_the_votes():
    t = licenses.template("gpl", "general public license")
    words = {4: "general", 5: "public", 6: "licence", 9: "public", 10: "license"}
    assert licenses.covered(words, [4], t) == (2, 4, 6) and licenses.covered(words, [8], t) == (2, 9, 11)
    assert licenses.covered(words, [4, 8], t) == (3, 4, 11) and licenses.covered(words, [0], t) == (0, -1, -1)


def test_hashes_of_words_do_not_depend_on_chunks(monkeypatch):
    text = ("alpha beta gamma " * 500 + "y" * 5_000 + " alpha").encode()
    whole = licenses.split_words([text])[3]
    monkeypatch.setattr(licenses, "CHUNK", 64)
    assert (licenses.split_words([b"alpha", text])[3][1:] == whole).all() and whole[0] == whole[-1]
