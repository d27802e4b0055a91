"""Token counts by a two-tier lookup on the map side: no pre-token is ever shuffled.

First tier: a table of the pre-tokens that are frequent in a bounded sample, with their numbers of tokens, broadcast to
every worker. Second tier: pre-tokens outside it are encoded once by the tokenizer library and kept in a bounded cache of
the worker. Counts of a text are sums over its pre-tokens.

The split into pre-tokens is exact for texts of ASCII and Latin letters. A text with any other character is split by the
tokenizer itself and uses the same tiers in its spelling. Only one with a special token's string goes to the library as a
whole, so counts always equal the library's.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import extend, rows_of, text_of

#: Bounds of the frequent tier: it is fitted on so many texts and holds so many entries; neither changes a count.
SAMPLE_TEXTS = 2_000
TABLE_ENTRIES = 30_000
#: Pre-tokens a worker keeps; beyond that the cache starts anew.
CACHE_ENTRIES = 300_000

#: The split rule of the byte-level vocabulary, with letter and number classes spelled out for SAFE texts.
LETTERS = r"A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = r"0-9²³¹¼-¾"
SPLIT = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"
)
UNSAFE = re.compile(r"[^\t\n\r\x20-\x7e¡-ɏ]")


@lru_cache(maxsize=2)
def load(path: str):
    """The tokenizer, once per worker, with neither truncation nor padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Lengths(dict):
    """Pre-token to number of tokens; a miss is encoded and kept until the cache is full."""

    def __init__(self, frequent: dict[str, int], tokenizer, most: int) -> None:
        super().__init__(frequent)
        self.frequent, self.tokenizer, self.most = frequent, tokenizer, most
        self._split: SplitLengths | None = None

    def encoded(self, piece: str) -> int:
        return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def __missing__(self, piece: str) -> int:
        count = self.encoded(piece)
        if len(self) >= self.most + len(self.frequent):
            self.clear()
            self.update(self.frequent)
        self[piece] = count
        return count

    @property
    def split(self) -> SplitLengths:
        """The same tiers for texts that the tokenizer itself has to split."""
        if self._split is None:
            self._split = SplitLengths(self)
        return self._split


class SplitLengths(Lengths):
    """Lengths by the pre-tokens of the tokenizer, in its own spelling."""

    def __init__(self, plain: Lengths) -> None:
        cut = plain.tokenizer.pre_tokenizer.pre_tokenize_str
        spelled = ((cut(piece), count) for piece, count in plain.frequent.items())
        super().__init__({pieces[0][0]: count for pieces, count in spelled if len(pieces) == 1}, plain.tokenizer, plain.most)
        self.cut = cut

    def encoded(self, piece: str) -> int:
        return len(self.tokenizer.model.tokenize(piece))

    def count(self, text: str) -> int:
        normalizer = self.tokenizer.normalizer
        return sum(self[piece] for piece, _ in self.cut(normalizer.normalize_str(text) if normalizer else text))


def special_strings(tokenizer) -> re.Pattern | None:
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return re.compile("|".join(map(re.escape, added))) if added else None


def count_text(text: str, lengths: Lengths, special: re.Pattern | None) -> int:
    if special and special.search(text) or lengths.tokenizer.pre_tokenizer is None:
        return len(lengths.tokenizer.encode(text, add_special_tokens=False).ids)
    if UNSAFE.search(text):
        return lengths.split.count(text)
    return sum(map(lengths.__getitem__, SPLIT.findall(text)))


def frequent_lengths(
    docs: DataFrame, tokenizer_path: str, text_col: str = "text", sample: int = SAMPLE_TEXTS, entries: int = TABLE_ENTRIES
) -> dict[str, int]:
    """Frequent pre-tokens of the first texts; at most ``entries`` of them come to the driver.

    A partition tells those of its first ``sample`` texts, most frequent first. The limit reads one partition, and more
    only while there are too few entries, so nothing is shuffled and the work does not grow with the table.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        left = sample
        for batch in rows_of(batches):
            for text in batch.column(0).to_pylist():
                if not UNSAFE.search(text):
                    seen.update(SPLIT.findall(text))
            left -= batch.num_rows
            if left <= 0:
                break
        pieces = [p for p, _ in seen.most_common(entries)]
        sizes = [len(e.ids) for e in load(tokenizer_path).encode_batch(pieces, add_special_tokens=False)]
        yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.string()), pa.array(sizes, pa.int32())], names=["piece", "n"])

    texts = docs.select(text_of(text_col).alias("text"))
    return {r["piece"]: r["n"] for r in texts.mapInArrow(tally, "piece string, n int").limit(entries).collect()}


def token_counts(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512
) -> DataFrame:
    """Tokens of every text: id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    A null text counts as empty: no bytes, no tokens. Ids may be null or repeat; each row is counted by itself, so an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(frequent_lengths(docs, tokenizer_path, text_col))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(tokenizer_path)
        lengths, special = Lengths(shared.value, tokenizer, CACHE_ENTRIES), special_strings(tokenizer)
        for batch in rows_of(batches):
            found = [count_text(text, lengths, special) for text in batch.column("text").to_pylist()]
            yield extend(batch.select(["id", "n_bytes"]), n_tokens=pa.array(found, pa.int64()))

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
