"""Jaccard join of documents on word shingles by MinHash banding.

Band and row counts follow from the similarity and the recall asked for. Documents are shuffled by band hashes; whoever
shares a band becomes a candidate, and the full shingle sets of candidates decide. Equal texts form a class and are
compared once. Candidates are grouped into units by the stars of their bands; a unit of any size is compared in square
blocks of bounded size, which give numbers of links and spanning edges, never a row per pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import extend, rows_of, spare, text_of
from packetloom.llm.graph import components
from packetloom.session import settle

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9999
MOST_HASHES = 128
#: Classes on one side of a comparison block.
BLOCK = 128
#: Columns of the shingle matrix that are multiplied at a time.
COLUMNS = 4096
#: ASCII white space: blank and the control characters 9 to 13.
BLANKS = np.zeros(256, bool)
BLANKS[[9, 10, 11, 12, 13, 32]] = True


def choose_bands(similarity: float = SIMILARITY, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows: the longest rows whose bands reach the recall at the similarity within ``most`` hashes."""
    best = None
    for rows in range(1, most + 1):
        bands = int(np.ceil(np.log1p(-recall) / np.log1p(-(similarity**rows))))
        if bands * rows > most:
            break
        best = bands, rows
    if best is None:
        raise ValueError(f"{most} hashes cannot reach recall {recall} at similarity {similarity}")
    return best


@lru_cache(maxsize=8)
def constants(seed: int, count: int) -> np.ndarray:
    """Odd 64-bit multipliers."""
    return np.random.default_rng(seed).integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one after the other, and the first word of every text."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    solid = ~BLANKS[data]
    edge = np.diff(solid.astype(np.int8), prepend=0)
    begin = np.flatnonzero(edge == 1)
    if not len(begin):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    letters = np.flatnonzero(solid)
    lengths = np.flatnonzero(edge == -1) - begin
    # position of each letter in its word; powers of an odd constant make the hash depend on the order
    place = letters - np.repeat(begin, lengths)
    power = np.cumprod(np.full(int(lengths.max()), constants(11, 1)[0], np.uint64))
    value = constants(13, 256)[data[letters]] * power[place]
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return mixed(np.add.reduceat(value, first) + lengths.astype(np.uint64)), np.searchsorted(begin, starts)


def shingles(texts: list[bytes], words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, one text after the other, and the number of shingles of every text.

    A text of fewer than ``words`` words has one shingle, the whole of it; a text without a word has none.
    """
    hashed, first = word_hashes(texts)
    count = np.diff(first)
    factor = constants(17, words)
    window = max(0, len(hashed) - words + 1)
    joined = np.zeros(window, np.uint64)
    for k in range(words):
        joined += hashed[k : k + window] * factor[k]
    amount = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    start = np.repeat(first[:-1], amount) + np.arange(amount.sum()) - np.repeat(np.cumsum(amount) - amount, amount)
    short = np.repeat(count < words, amount)
    out = np.empty(len(start), np.uint64)
    out[~short] = mixed(joined[start[~short]])
    for at in np.flatnonzero(short):
        n = int(count[np.searchsorted(first, start[at], "right") - 1])
        part = hashed[start[at] : start[at] + n]
        out[at] = mixed(np.asarray([(part * factor[:n]).sum() + np.uint64(n)], np.uint64))[0]
    return out, amount


def band_hashes(hashed: np.ndarray, amount: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One row of band hashes per text that has shingles."""
    first = (np.cumsum(amount) - amount)[amount > 0]
    if not len(first):
        return np.empty((0, bands), np.int64)
    out = np.empty((len(first), bands), np.uint64)
    multiplier, within = constants(19, bands * rows), constants(23, rows)
    for band in range(bands):
        key = np.full(len(first), band + 1, np.uint64)
        for row in range(rows):
            key += mixed(np.minimum.reduceat(hashed * multiplier[band * rows + row], first)) * within[row]
        out[:, band] = mixed(key)
    return out.view(np.int64)


def lowered(texts: list[str]) -> list[bytes]:
    return [t.lower().encode() for t in texts]


def signatures(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, words: int) -> DataFrame:
    """id, text_key, class_a, class_b (a 128-bit hash of the words) and bands (null without words) of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            texts = lowered(batch.column("text").to_pylist())
            keys = [hashlib.blake2b(b" ".join(t.split()), digest_size=16).digest() for t in texts]
            classes = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            hashed, amount = shingles(texts, words)
            found = iter(band_hashes(hashed, amount, bands, rows))
            listed = [next(found) if n else None for n in amount]
            yield extend(
                batch.select(["id", "text_key"]),
                class_a=classes[:, 0],
                class_b=classes[:, 1],
                bands=pa.array(listed, pa.list_(pa.int64())),
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows_in = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("text_key", F.xxhash64("text"))
    return rows_in.mapInArrow(sign, f"id {kind}, text_key long, class_a long, class_b long, bands array<long>")


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the common parts of all pairs of ``sets`` of unique values."""
    n = len(sets)
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = np.bincount(column, minlength=len(values)) > 1
    column, row = (np.cumsum(shared) - 1)[column][(keep := shared[column])], row[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    total = np.zeros((n, n), np.float32)
    for low in range(0, int(shared.sum()), COLUMNS):
        part = slice(*np.searchsorted(column, [low, low + COLUMNS]))
        dense = np.zeros((n, COLUMNS), np.float32)
        dense[row[part], column[part] - low] = 1
        total += dense @ dense.T
    return total


def roots(links: np.ndarray) -> np.ndarray:
    """Smallest index that each index reaches over ``links``."""
    label = np.arange(len(links))
    while True:
        lower = np.minimum(label, np.where(links, label[None, :], len(links)).min(axis=1))
        lower = np.minimum(lower, lower[lower])
        if (lower == label).all():
            return label
        label = lower


LINKS = "class_a long, class_b long, links long, root long"


def compare_block(group: pd.DataFrame, similarity: float, words: int) -> pd.DataFrame:
    """Links and spanning edges between the classes of a block, or of two blocks of one unit."""
    hashed, amount = shingles(lowered(group["text"].tolist()), words)
    sets = [np.unique(part) for part in np.split(hashed, np.cumsum(amount)[:-1])]
    size = np.asarray([len(s) for s in sets], np.float32)
    common = intersections(sets)
    linked = common >= similarity * (size[:, None] + size[None, :] - common) - 1e-3
    block = group["block"].to_numpy()
    if len(group) and group["low"].iloc[0] != group["high"].iloc[0]:
        linked &= block[:, None] != block[None, :]
    np.fill_diagonal(linked, False)
    has = linked.any(axis=1)
    node = group["class_a"].to_numpy()
    result = pd.DataFrame(
        {
            "class_a": node,
            "class_b": group["class_b"].to_numpy(),
            "links": linked @ group["copies"].to_numpy(),
            "root": node[roots(linked)],
        }
    )
    return result[has]


def jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    words: int = SHINGLE_WORDS,
) -> DataFrame:
    """Near copies of every document: id, text_key, class_id, n_links, component_id, kept.

    Documents are linked whose sets of ``words``-word shingles (lower case, cut at ASCII white space) have a Jaccard
    similarity of at least ``similarity``. class_id is the smallest id with the same words, n_links the number of other
    rows linked directly, copies included, component_id the smallest id reachable over links; kept marks one id of each
    component. text_key is a hash of the text, which tells rows of one id apart. A document without a word (null, empty,
    blanks only) is linked with nothing and kept. A null id is never the smallest unless all are null; rows of equal id
    and text share every value. An empty table gives no rows.
    """
    bands, rows = choose_bands(similarity, recall)
    signed = settle(signatures(docs, id_col, text_col, bands, rows, words), "signatures")
    with_words = signed.filter("bands IS NOT NULL")
    person = F.struct(F.col("id").isNull().alias("none"), "id", "text_key")
    classes = with_words.groupBy("class_a", "class_b").agg(
        F.count(F.lit(1)).alias("copies"), F.min(person).alias("first"), F.first("bands").alias("bands")
    )
    classes = settle(classes, "classes")

    spread = classes.select("class_a", F.posexplode("bands").alias("band", "hash"))
    stars = spread.groupBy("band", "hash").agg(F.min("class_a").alias("star"), F.max("class_a").alias("far"))
    stars = stars.filter("star < far").drop("far")
    units = components(spread.join(stars, ["band", "hash"]).select("class_a", "star"), "class_a", "star")
    units = units.unionByName(units.select(F.col("component").alias("node"), "component").distinct())

    members = classes.drop("bands").join(units, F.col("class_a") == F.col("node"))
    sizes = units.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = members.join(sizes, "component").select(
        "component", "class_a", "class_b", "copies", "blocks", F.col("first.id").alias("id"), F.col("first.text_key").alias("text_key")
    )
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("text_key", F.xxhash64("text"))
    same = members["id"].eqNullSafe(texts["id"]) & (members["text_key"] == texts["text_key"])
    members = members.join(texts, same).drop(texts["id"], texts["text_key"]).dropDuplicates(["class_a", "class_b"])
    members = members.withColumn("block", F.pmod(F.xxhash64("class_b"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    members = members.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        return compare_block(group, similarity, words)

    found = settle(
        members.select("component", "low", "high", "block", "class_a", "class_b", "copies", "text")
        .groupBy("component", "low", "high")
        .applyInPandas(compare, LINKS),
        "links",
    )
    links = found.groupBy("class_a", "class_b").agg(F.sum("links").alias("links"))
    joined = components(found.select("class_a", "root"), "class_a", "root")

    smallest = classes.join(joined, F.col("class_a") == F.col("node"), "left").select(
        "class_a", "class_b", "copies", "first", F.coalesce("component", "class_a").alias("component")
    )
    heads = smallest.groupBy("component").agg(F.min("first").alias("head"))
    summary = smallest.join(heads, "component").join(links, ["class_a", "class_b"], "left").select(
        "class_a", "class_b", "copies", "first", "head", F.coalesce("links", F.lit(0)).alias("links")
    )
    lone = F.col("copies").isNull()
    return signed.drop("bands").join(summary, ["class_a", "class_b"], "left").select(
        F.col("id").alias(id_col),
        "text_key",
        F.when(lone, F.col("id")).otherwise(F.col("first.id")).alias("class_id"),
        F.when(lone, F.lit(0)).otherwise(F.col("copies") - 1 + F.col("links")).cast("long").alias("n_links"),
        F.when(lone, F.col("id")).otherwise(F.col("head.id")).alias("component_id"),
        (lone | (F.col("id").eqNullSafe(F.col("head.id")) & (F.col("text_key") == F.col("head.text_key")))).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of every group of near copies, with all columns of ``docs``.

    Rows of equal id and text count as one document, unless they hold no word.
    """
    key = spare(docs, "key")
    kept = jaccard_join(docs.select(id_col, text_col), id_col, text_col, **options).filter("kept")
    kept = kept.select(F.col(id_col).alias("kept_id"), F.col("text_key").alias("kept_key")).distinct()
    keyed = docs.withColumn(key, F.xxhash64(text_of(text_col)))
    found = keyed.alias("d").join(kept.alias("k"), F.expr(f"d.`{id_col}` <=> k.kept_id AND d.`{key}` = k.kept_key"), "left_semi")
    blank = F.regexp_replace(text_of(text_col), r"[\x20\x09-\x0D]+", "") == ""
    once = found.filter(~blank).dropDuplicates([id_col, key])
    return once.unionByName(found.filter(blank)).drop(key)
