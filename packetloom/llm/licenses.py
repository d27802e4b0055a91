"""License scans by diagonal voting.

Hashes of all rolling word k-grams of a text are joined to the places where license templates have them. Each hit votes
for a diagonal, the place in the text less that in the template: words that follow a template without a break share
one. Diagonals that lie close to each other are merged, since an added or a missing word only moves what follows. The
words themselves then decide which merged spans hold a template.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packetloom.llm.common import rows_of, text_of
from packetloom.llm.jaccard import constants, mixed
from packetloom.session import settle

#: Words of a gram; templates of fewer than LONG words are matched as a whole by the shorter one.
SHORT_GRAM, LONG_GRAM, LONG = 2, 4, 10
#: Diagonals of long templates this close together are one span.
SLACK = 4
#: Share of a long template's words that a span must have.
COVERAGE = 0.8
#: ASCII characters that part words: all but digits and letters.
PARTS_WORDS = np.ones(256, bool)
PARTS_WORDS[48:58] = PARTS_WORDS[65:91] = PARTS_WORDS[97:123] = PARTS_WORDS[128:] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    #: Phrases are what the base result counts.
    phrase: bool = False

    @property
    def gram(self) -> int:
        return LONG_GRAM if len(self.words) >= LONG else SHORT_GRAM

    @property
    def slack(self) -> int:
        return SLACK if len(self.words) >= LONG else 0

    @property
    def needed(self) -> int:
        """Words of the template that a span must cover."""
        return int(np.ceil(COVERAGE * len(self.words))) if len(self.words) >= LONG else len(self.words)


def template(label: str, text: str, phrase: bool = False) -> Template:
    """At least two words, in lower case, parted like those of texts."""
    words = tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)})))
    if len(words) < SHORT_GRAM:
        raise ValueError(f"a template needs {SHORT_GRAM} words: {text!r}")
    return Template(label, words, phrase)


# Phrases to count, and notices as the licenses ask to have them put into files.
PHRASES = (
    template("mit", "mit license", phrase=True),
    template("apache", "apache license", phrase=True),
    template("gpl", "general public license", phrase=True),
)
NOTICES = (
    template("mit", "SPDX-License-Identifier: MIT"),
    template("apache", "SPDX-License-Identifier: Apache-2.0"),
    template("gpl", "SPDX-License-Identifier: GPL"),
    template("bsd", "SPDX-License-Identifier: BSD"),
    template("mpl", "SPDX-License-Identifier: MPL"),
    template("isc", "SPDX-License-Identifier: ISC"),
    template("bsd", "BSD license"),
    template("isc", "ISC license"),
    template("mpl", "Mozilla Public License"),
    template("cc-by", "licensed under CC BY 4.0"),
    template("cc-by-nc", "licensed under CC BY-NC 4.0"),
    template("cc-by-sa", "licensed under CC BY-SA 4.0"),
    template("cc-by", "Creative Commons Attribution 4.0 International"),
    template("cc-by-nc", "Creative Commons Attribution-NonCommercial"),
    template("cc-by-sa", "Creative Commons Attribution-ShareAlike"),
    template("cc0", "CC0 1.0 Universal"),
    template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    template(
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
    ),
    template(
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on"
        " an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation",
    ),
    template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met",
    ),
    template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at",
    ),
    template("unlicense", "This is free and unencumbered software released into the public domain."),
)
TEMPLATES = PHRASES + NOTICES


#: Longer words are hashed one by one.
LONG_WORD = 256
#: Bytes whose letters are hashed at a time.
CHUNK = 1 << 20


def hash_words(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of words ``data[begin:end]``."""
    out = np.empty(len(begin), np.uint64)
    lengths = end - begin
    power = np.cumprod(np.full(LONG_WORD, constants(11, 1)[0], np.uint64))
    usual = np.flatnonzero(lengths <= LONG_WORD)
    total = np.cumsum(lengths[usual])
    for part in np.split(usual, np.searchsorted(total, np.arange(CHUNK, int(total[-1]), CHUNK)) if len(usual) else []):
        if len(part):
            size = lengths[part]
            before = np.concatenate([[0], np.cumsum(size)[:-1]])
            place = np.arange(int(size.sum())) - np.repeat(before, size)
            value = constants(53, 256)[data[np.repeat(begin[part], size) + place]] * power[place]
            out[part] = mixed(np.add.reduceat(value, before) + size.astype(np.uint64))
    for k in np.flatnonzero(lengths > LONG_WORD):
        out[k] = int.from_bytes(hashlib.blake2b(data[begin[k] : end[k]], digest_size=8).digest(), "little")
    return out


def split_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes of all texts, begin and end of every word, its 64-bit hash, and the first word of every text."""
    data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    edge = np.diff((~PARTS_WORDS)[data].astype(np.int8), prepend=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return data, begin, end, hash_words(data, begin, end), np.searchsorted(begin, starts)


def grams(hashed: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all rolling grams of ``size`` words."""
    count = max(0, len(hashed) - size + 1)
    total = np.full(count, size, np.uint64)
    for k, factor in enumerate(constants(59, size)):
        total += hashed[k : k + count] * factor
    return mixed(total).view(np.int64)


def template_places(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """gram, hash, template, place: where each template has which gram."""
    rows = []
    for number, t in enumerate(templates):
        hashed = split_words([" ".join(t.words).encode()])[3]
        rows += [(t.gram, int(h), number, place) for place, h in enumerate(grams(hashed, t.gram))]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["gram", "hash", "template", "place"]), "gram int, hash long, template int, place int")


def _scan(docs: DataFrame, id_col: str, text_col: str, templates: tuple[Template, ...]) -> DataFrame:
    """id, n_words, hits (gram, at, hash) and pieces (at, words): the grams that any template has, and the words in them."""
    sizes = sorted({t.gram for t in templates})
    known = {}
    for size in sizes:
        mine = [grams(split_words([" ".join(t.words).encode()])[3], size) for t in templates if t.gram == size]
        known[size] = np.unique(np.concatenate(mine))
    hit_type = pa.list_(pa.struct([("gram", pa.int32()), ("at", pa.int32()), ("hash", pa.int64())]))
    piece_type = pa.list_(pa.struct([("at", pa.int32()), ("words", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            data, begin, end, hashed, first = split_words([t.encode() for t in batch.column("text").to_pylist()])
            rows = np.repeat(np.arange(batch.num_rows), np.diff(first))
            hits: list[list] = [[] for _ in range(batch.num_rows)]
            near = np.zeros(len(hashed) + 1, np.int64)
            for size in sizes:
                made = grams(hashed, size)
                found = np.flatnonzero(np.isin(made, known[size]))
                found = found[rows[found] == rows[found + size - 1]]
                for at, row, value in zip(found.tolist(), rows[found].tolist(), made[found].tolist()):
                    hits[row].append((size, at - int(first[row]), value))
                np.add.at(near, found, 1)
                np.add.at(near, found + size, -1)
            wanted = np.cumsum(near[:-1]) > 0
            # runs of words in grams, parted where a text begins
            begins_text = np.zeros(len(hashed) + 1, bool)
            begins_text[first] = True
            opens = wanted & (begins_text[:-1] | ~np.concatenate([[False], wanted[:-1]]))
            closes = wanted & (begins_text[1:] | ~np.concatenate([wanted[1:], [False]]))
            pieces: list[list] = [[] for _ in range(batch.num_rows)]
            for low, last in zip(np.flatnonzero(opens).tolist(), np.flatnonzero(closes).tolist()):
                words = (data[b:e].tobytes() for b, e in zip(begin[low : last + 1].tolist(), end[low : last + 1].tolist()))
                pieces[int(rows[low])].append((low - int(first[rows[low]]), b" ".join(words).decode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(first)), pa.array(hits, hit_type), pa.array(pieces, piece_type)],
                names=["id", "n_words", "hits", "pieces"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(
        run, f"id {kind}, n_words long, hits array<struct<gram: int, at: int, hash: long>>, pieces array<struct<at: int, words: string>>"
    )


def covered(words: dict[int, str], diagonals: list[int], t: Template) -> tuple[int, int, int]:
    """Words of the template that the text has in grams on these diagonals, and the first and last place of those."""
    has = np.zeros(len(t.words), bool)
    low, high = None, None
    for diagonal in diagonals:
        same = np.asarray([words.get(diagonal + p) == w for p, w in enumerate(t.words)], np.int64)
        run = np.convolve(same, np.ones(t.gram, np.int64), "valid") == t.gram
        for p in np.flatnonzero(run):
            has[p : p + t.gram] = True
            low = diagonal + p if low is None else min(low, diagonal + p)
            high = diagonal + p + t.gram if high is None else max(high, diagonal + p + t.gram)
    return int(has.sum()), int(-1 if low is None else low), int(-1 if high is None else high)


def license_spans(scanned: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """row, template, first, last, covered: the spans of scanned rows (row, hits, pieces) that hold a template."""
    spark = scanned.sparkSession
    places = template_places(spark, templates)
    hits = scanned.select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    # the table has a row per gram of the given templates, whatever the corpus
    hits = hits.join(F.broadcast(places), ["gram", "hash"])
    votes = hits.groupBy("row", "template", (F.col("at") - F.col("place")).alias("diagonal")).agg(F.count(F.lit(1)).alias("votes"))
    rules = spark.createDataFrame([(i, t.slack, t.needed, t.gram) for i, t in enumerate(templates)], "template int, slack int, needed int, size int")
    votes = votes.join(F.broadcast(rules), "template")
    # one group is one template in one text
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    opens = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.col("slack"), F.lit(True))
    merged = votes.withColumn("opens", opens.cast("int")).withColumn("span", F.sum("opens").over(along))
    spans = merged.groupBy("row", "template", "span").agg(
        F.sort_array(F.collect_list("diagonal")).alias("diagonals"), F.sum("votes").alias("votes"), F.first("size").alias("size"), F.first("needed").alias("needed")
    )
    # n votes cover at most n times the words of a gram
    spans = spans.filter("votes * size >= needed").groupBy("row").agg(F.collect_list(F.struct("template", "diagonals")).alias("spans"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, found, pieces in zip(*(batch.column(c).to_pylist() for c in ("row", "spans", "pieces"))):
                words = {p["at"] + k: w for p in pieces for k, w in enumerate(p["words"].split(" "))}
                for span in found:
                    t = templates[span["template"]]
                    count, low, high = covered(words, span["diagonals"], t)
                    if count >= t.needed:
                        out.append((row, span["template"], low, high, count))
            columns = list(zip(*out)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["row", "template", "first", "last", "covered"])

    judged = spans.join(scanned.select("row", "pieces"), "row")
    return judged.mapInArrow(verify, "row long, template int, first int, last int, covered int")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    Words are runs of digits, letters A-Z in lower case, and characters beyond ASCII. n_base counts the places of the
    phrases, first_word and last_word are the smallest and the largest of them (null without any). labels adds those
    of the notices, of which long ones may have changed words: COVERAGE of their words must stand in grams on
    neighbouring diagonals. score is the largest share of a template's words that a span has, 0 without a span.
    Null and empty texts have no words; null ids, repeated rows and very long texts are rows like others, and every
    row gives one. Extra columns are left out. An empty table gives no rows.

    Texts never move: a row goes on as its hits and the words around them, stored once. A notice in every text is one hit
    list per row; no group is larger than a text's own hits.
    """
    scanned = _scan(docs, id_col, text_col, templates).withColumn("row", F.monotonically_increasing_id())
    scanned = settle(scanned, "scanned")
    spans = license_spans(scanned.filter("size(hits) > 0"), templates)
    facts = [(i, t.label, t.phrase, len(t.words)) for i, t in enumerate(templates)]
    named = spans.join(F.broadcast(docs.sparkSession.createDataFrame(facts, "template int, label string, phrase boolean, length int")), "template")
    base = F.col("phrase")
    labels = lambda condition: F.concat_ws(",", F.array_sort(F.collect_set(condition)))
    per_row = named.groupBy("row").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        labels(F.when(base, F.col("label"))).alias("base_labels"),
        labels(F.col("label")).alias("labels"),
        F.max(F.col("covered") / F.col("length")).alias("score"),
    )
    out = scanned.select("row", "id", "n_words").join(per_row, "row", "left").select(
        "id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
    return out.withColumnRenamed("id", id_col)
