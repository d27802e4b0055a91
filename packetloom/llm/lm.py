"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is coded as binary decisions. For each word: does it repeat a word of the text, and if not, is it known from
the corpus? A repeated word is drawn by its count in the text so far. Of a known one: does it follow the two words before
it, else the one before it, in another training text? Then it is drawn by its count after them in all training texts, else
by its number of training texts (without the words that the text already had) in its group, which is told bit by bit. Any
other word is spelled byte by byte, eight bits each. Every decision is
predicted by several hashed contexts; their log odds are added with weights that a gate selects, weights are learned
online from the error of each prediction, and the result is refined by an adaptive table. Every text so has a proper
probability, whose bits per byte are reported.

Counts grow with the corpus and stay in Spark tables: words of a block of texts are numbered and counted in place, added up
by word, scored once, and sent back to the blocks that use them. So are the hashes of every new word with the words before it. A
text is split once; after that it is a row of numbers.
"""

from __future__ import annotations

import ctypes
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import extend, fold, rows_of, runs, text_of
from packetloom.llm.jaccard import constants, mixed
from packetloom.session import settle

#: Text bytes of a block; its words and their scores fit a worker many times over.
BLOCK_BYTES = 40 << 20
#: Cells of a predictor's table, decisions that are learned from at a time, steps of the refining table.
CELLS = 1 << 16
SPELLING_CELLS = 1 << 18
#: Parts of the spelling's tables that are added up apart, a multiple of ORDERS.
SPELLING_SLOTS = 192
CHUNK = 4096
STEPS = 24
#: Words that one run of the spelling's learner takes; every run learns from all of its words, and the runs are averaged.
SPELLING_WORDS = 1 << 17
#: Bytes of words that it reads at a time.
SPELLING_BYTES = 10_000
#: Spelling contexts: the bits of the byte so far with the last 0 to 4 bytes, and with the whole word so far.
ORDERS = 6
#: Groups of words, a power of two.
GROUPS = 32
#: Words before a new word after which it is looked up in all texts.
AFTER = 2
#: Bits of the hash of the words before and of that of the word after them.
BEFORE_BITS, WORD_BITS = 32, 24
#: Ranges of these hashes, a power of two, and hashes of a range that are counted at a time; larger ranges are cut.
RANGES, RANGE_KEYS = 512, 1 << 22
#: Text bytes that are scored at a time.
SLICE_BYTES = 1 << 19
END = b""


class BitMixer:
    """Predicts bits from hashed contexts (one column each) by gated weights and a refining table."""

    def __init__(self, contexts: int, gates: int, tables: np.ndarray | None = None) -> None:
        """``tables``: counts that are known before; else they are learned with the weights."""
        self.tables = np.zeros((contexts, CELLS, 2), np.float32) if tables is None else tables
        self.fixed = tables is not None
        self.weights = np.full((gates, contexts + 1), 1 / contexts, np.float64)
        self.weights[:, -1] = 0
        self.refined = np.zeros((gates, STEPS, 2), np.float64)
        self.others: np.ndarray | None = None

    def without_own(self) -> np.ndarray:
        """Log odds of every context and cell when a zero or a one of its own is taken out of the known counts."""
        if self.others is None:
            zero, one = self.tables[:, :, 0], self.tables[:, :, 1]
            self.others = np.empty(self.tables.shape, np.float32)
            for own in (0, 1):
                left = np.maximum(zero - np.float32(own == 0), 0), np.maximum(one - np.float64(own), 0)
                self.others[:, :, own] = np.log((left[1] + np.float32(0.4)) / (left[0] + np.float32(0.4)))
            self.others = self.others.reshape(len(self.tables), -1)
        return self.others

    def inputs(self, cells: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """A row of log odds for each context, and a constant; ``own`` bits are taken out of the counts first.

        ``cells`` holds a row for each context here, counted from the first cell of the first context.
        """
        out = np.ones((len(cells) + 1, cells.shape[1]), np.float32)
        if own is not None:
            out[:-1] = self.without_own().reshape(-1).take(cells * 2 + own)
            return out
        both = self.tables.reshape(-1).view(np.complex64).take(cells)  # zeros and ones of a cell by one look-up
        np.log((both.imag + np.float32(0.4)) / (both.real + np.float32(0.4)), out=out[:-1])
        return out

    def mix(self, inputs: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mixed probability of a one, and the step of the refining table it falls into."""
        x = (np.ascontiguousarray(self.weights.T, np.float32).take(gate, axis=1) * inputs).sum(axis=0)
        np.clip(x, -12, 12, out=x)
        return 1 / (1 + np.exp(-x)), np.minimum(((x + 12) * (STEPS / 24)).astype(np.int64), STEPS - 1)

    def learn(self, cells: np.ndarray, gate: np.ndarray, bit: np.ndarray, rate: float = 0.5) -> None:
        """Predict the bits in order, a chunk at a time, and learn from the errors of each chunk.

        Steps are scaled by the energy of each input, which keeps them stable whatever its size.
        """
        first = np.arange(cells.shape[1])[:, None] * self.tables.shape[1]
        for low in range(0, len(bit), CHUNK):
            part = slice(low, low + CHUNK)
            order = np.argsort(gate[part].astype(np.uint16), kind="stable")  # rows of a gate side by side
            g, b = gate[part][order], bit[part].astype(np.int64)[order]
            c = cells[part].T.take(order, axis=1) + first
            edge = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            x = self.inputs(c, b if self.fixed else None)
            p, step = self.mix(x, g)
            slope = np.add.reduceat((b.astype(np.float32) - p) * x, edge, axis=1)
            energy = np.add.reduceat(np.square(x), edge, axis=1)
            self.weights[g[edge]] += (rate * slope / (energy + 30)).T
            self.refined += np.bincount((g * STEPS + step) * 2 + b, minlength=self.refined.size).reshape(self.refined.shape)
            if not self.fixed:
                np.add.at(self.tables.reshape(-1), (c * 2 + b).ravel(), np.float32(1))

    def freeze(self) -> "BitMixer":
        """Turn counts into log odds once; what is learned afterwards has no effect on predictions."""
        one, both = self.tables[:, :, 1], self.tables.sum(axis=2)
        self.odds = np.log((one + 0.4) / (both - one + 0.4)).astype(np.float32)
        self.slopes = np.ascontiguousarray(self.weights.T, np.float32)
        total = self.refined.sum(axis=2)
        self.pull = (32 / (total + 32)).astype(np.float32).ravel()
        self.offset = (self.refined[:, :, 1] / (total + 32)).astype(np.float32).ravel()
        return self

    def predict(self, cells: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Probability of a one for each row, by the frozen state."""
        out = np.empty(len(gate))
        for low in range(0, len(gate), 16 * CHUNK):
            part = slice(low, low + 16 * CHUNK)
            g = gate[part]
            x = self.slopes[-1].take(g)
            for k in range(cells.shape[1]):
                x += self.slopes[k].take(g) * self.odds[k].take(cells[part, k])
            np.clip(x, -12, 12, out=x)
            p = 1 / (1 + np.exp(-x))
            step = g * STEPS + np.minimum((x + 12) * np.float32(STEPS / 24), STEPS - 1).astype(np.int64)
            out[part] = np.clip((p + self.offset.take(step) + self.pull.take(step) * p) / 2, 1e-6, 1 - 1e-6)
        return out


def spelling_bits(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells, gates, bits and word numbers of the decisions that spell ``words``, each ended by a blank."""
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.int64)
    sizes = np.asarray([len(w) + 1 for w in words])
    start = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(data)) - start[word]
    history = [np.zeros(len(data), np.uint64)]
    for back in range(1, 5):
        before = np.zeros(len(data), np.int64)
        before[back:] = data[:-back]
        byte = np.where(place >= back, before, 0).astype(np.uint64)
        history.append(history[-1] * np.uint64(257) + byte + np.uint64(1))
    power = np.cumprod(np.full(int(sizes.max()), constants(53, 1)[0], np.uint64))
    value = constants(59, 256)[data] * power[place]
    total = np.cumsum(value, dtype=np.uint64) - value
    history.append(total - total[start][word] + np.uint64(7))
    cells = np.empty((ORDERS, 8, len(data)), np.int64)
    # the upper bits of a product are the cell; the bits of the byte so far come in as a sum, so they are multiplied once
    spread, shift = constants(71, 1)[0], np.uint64(65 - SPELLING_CELLS.bit_length())
    keys = [mixed(h * np.uint64(ORDERS) + np.uint64(k)) for k, h in enumerate(history)]
    gates, bits = [], []
    for bit in range(8):
        part = ((data >> (8 - bit)) | (1 << bit)).astype(np.uint64) * spread
        for k, key in enumerate(keys):
            cells[k, bit] = (key + part) >> shift
        gates.append(np.minimum(place, 7) * 8 + bit)
        bits.append((data >> (7 - bit)) & 1)
    return cells.reshape(ORDERS, -1).T, np.concatenate(gates), np.concatenate(bits), np.tile(word, 8)


def in_batches(words: list[bytes], most: int = SPELLING_BYTES) -> Iterator[list[bytes]]:
    """Runs of words of about ``most`` bytes."""
    run, size = [], 0
    for w in words:
        run.append(w)
        size += len(w) + 1
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def spelled(words: list[bytes], mixer: BitMixer) -> np.ndarray:
    """log10 of the probability that the spelling gives each word."""
    out = []
    for run in in_batches(words):
        cells, gates, bits, word = spelling_bits(run)
        p = mixer.predict(cells, gates)
        out.append(np.bincount(word, np.log10(np.where(bits == 1, p, 1 - p)), minlength=len(run)))
    return np.concatenate(out) if out else np.empty(0)


def words_of(text: bytes) -> list[bytes]:
    """Words of a text, A to Z in lower case."""
    return text.lower().split()


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of the batches with the block they belong to: runs of about BLOCK_BYTES within a partition of the input."""
    from pyspark import TaskContext

    block, size = TaskContext.get().partitionId() << 24, 0
    for batch in rows_of(batches):
        yield block, batch
        size += batch.nbytes
        if size >= BLOCK_BYTES:
            block, size = block + 1, 0


def numbers(listed: list[list[bytes]], index: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """The size of every list, and the numbers of all words in one row."""
    size = np.fromiter(map(len, listed), np.int64, len(listed))
    return size, np.fromiter(map(index.__getitem__, chain.from_iterable(listed)), np.int64, int(size.sum()))


def by_text(doc: np.ndarray, token: np.ndarray, words: int) -> np.ndarray:
    """The order of the tokens by text, then by word, then by place; ``doc`` ascends."""
    if not len(token):
        return np.empty(0, np.int64)
    bits = len(token).bit_length()
    if (int(doc[-1]) + 1) * words < 1 << (63 - bits):
        return np.sort((doc * words + token) << bits | np.arange(len(token))) & ((1 << bits) - 1)
    return np.argsort(doc * words + token, kind="stable")


def newcomers(doc: np.ndarray, token: np.ndarray, words: int) -> np.ndarray:
    """The tokens that no token of the same text is equal to before them."""
    order = by_text(doc, token, words)
    same = np.zeros(len(token), bool)
    same[order[1:]] = (token[order[1:]] == token[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    return np.flatnonzero(~same)


def pair_keys(name: np.ndarray, place: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A hash of the AFTER words before each of ``rows`` with a hash of the word; ``name``: hashes of all tokens."""
    key = np.zeros(len(rows), np.uint64)
    for k, factor in zip(range(1, AFTER + 1), constants(67, AFTER)):
        key = mixed(key * factor + np.where(place[rows] >= k, name[np.maximum(rows - k, 0)], np.uint64(0)))
    return key >> np.uint64(64 - BEFORE_BITS) << np.uint64(WORD_BITS) | name[rows] >> np.uint64(64 - WORD_BITS)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in few bytes: the first bytes of all, then the second ones and so on, compressed."""
    return pa.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, count: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, decompressed_size=count * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, count).T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending hashes by their differences."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes, count: int) -> np.ndarray:
    return np.cumsum(unpacked(data, count, np.uint64), dtype=np.uint64)


def trim() -> None:
    """Give freed memory back to the system; a worker is kept for later tasks, beside what its executor needs then."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if give_back is not None:
        give_back(0)


class WordTally:
    """Words of a block by numbers: occurrences, and texts by the group of the text."""

    def __init__(self, block: int) -> None:
        self.block = block
        self.ids: defaultdict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.lengths = np.empty(0, np.int64)
        self.parts: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]] = []
        self.seen = np.empty(0, np.int64)
        self.grouped: list[np.ndarray] = [np.empty(0, np.int64)]

    def add(self, rows: pa.RecordBatch, texts: list[bytes], train: np.ndarray) -> None:
        """Take in ``texts``; ``rows`` holds what goes with them."""
        listed = [[*words_of(t), END] for t in texts]
        size, token = numbers(listed, self.ids)
        self.parts.append((rows, size, token.astype(np.int32), train))
        fresh = islice(reversed(self.ids), len(self.ids) - len(self.lengths))
        self.lengths = np.concatenate([self.lengths, np.fromiter(map(len, fresh), np.int64)[::-1]])
        mine = token[np.repeat(train, size)]
        seen = np.bincount(mine, minlength=len(self.ids))
        seen[: len(self.seen)] += self.seen
        self.seen = seen
        if train.any():
            self.group([x for x, yes in zip(listed, train.tolist()) if yes], size[train], mine)

    def group(self, listed: list[list[bytes]], size: np.ndarray, token: np.ndarray) -> None:
        """Keep every word of a text with the text's group: 1 to GROUPS - 1 by its most frequent word.

        That word has three bytes or more, if any has: texts of one language mostly share theirs.
        """
        doc = np.repeat(np.arange(len(size)), size)
        order = by_text(doc, token, len(self.ids))
        own, word = doc[order], token[order]
        edge = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (own[1:] != own[:-1])]))
        own, word = own[edge], word[edge]
        # of the most frequent words the first in the text
        count = len(token) + 1
        rank = np.diff(edge, append=len(token)) * count + len(token) - order[edge]
        lead = np.searchsorted(own, np.arange(len(size)))
        best = np.maximum.reduceat(rank, lead)
        longer = np.maximum.reduceat(np.where(self.lengths[word] > 2, rank, -1), lead)
        group = np.empty(len(size), np.int64)
        for i, (words, low, a, b) in enumerate(zip(listed, (np.cumsum(size) - size).tolist(), best.tolist(), longer.tolist())):
            name = words[len(token) - a % count - low]
            if len(name) < 3:
                name = words[len(token) - b % count - low] if b >= 0 else END
            group[i] = zlib.crc32(name) % (GROUPS - 1) + 1
        self.grouped.append(word * GROUPS + group[own])

    def told(self) -> Iterator[pa.RecordBatch]:
        """The rows that were taken in, numbered, with the places of their texts' words; then place, word, c, df, best.

        best: the number of texts of the group with most, times GROUPS, plus that group. The end is in group 0, in which
        there is no other word. Places go by the bytes of the words, so that no shuffle decides about hashed contexts.
        """
        size, names = len(self.ids), pa.array(list(self.ids), pa.binary())
        order = pc.sort_indices(names).to_numpy()
        place, done = np.empty(size, np.int32), 0
        place[order] = np.arange(size, dtype=np.int32)
        for rows, sizes, token, _ in self.parts:
            spot = np.arange(done, done + len(sizes), dtype=np.int32)
            done += len(sizes)
            ends = np.concatenate([[0], np.cumsum(sizes) * 4]).astype(np.int32)
            tokens = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(place[token])])
            yield extend(rows, tokens=tokens, place=pa.array(spot))

        keys, n = np.unique(np.concatenate(self.grouped), return_counts=True)
        word, group = keys // GROUPS, keys % GROUPS
        df, best = np.bincount(word, n, minlength=size).astype(np.int64), np.zeros(size, np.int64)
        if len(word):
            lead = np.flatnonzero(np.diff(word, prepend=-1))
            most = np.maximum.reduceat(n * GROUPS + GROUPS - 1 - group, lead)  # the smallest group of those with most
            best[word[lead]] = most // GROUPS * GROUPS + GROUPS - 1 - most % GROUPS
        if END in self.ids:
            best[self.ids[END]] = best[self.ids[END]] // GROUPS * GROUPS
        columns = [np.arange(size, dtype=np.int32), names.take(pa.array(order)), self.seen[order], df[order], best[order]]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["place", "word", "c", "df", "best"])


    def pairs(self) -> Iterator[pa.RecordBatch]:
        """place, c, keys, n: the different pair keys of the block, ascending, and the training texts that have each.

        A text has a word first in one place, so it counts once for a pair. place: the range of the c keys of a row.
        """
        names = mixed(np.fromiter(map(zlib.crc32, self.ids), np.uint64, len(self.ids)))
        found = []
        for _, size, token, train in self.parts:
            doc = np.repeat(np.arange(len(size)), size)
            rows = newcomers(doc, token.astype(np.int64), len(self.ids))
            key = pair_keys(names[token], np.arange(len(token)) - (np.cumsum(size) - size)[doc], rows)
            found.append(key << np.uint64(1) | train[doc[rows]])
        both = np.concatenate(found)
        del found
        both.sort()
        key = both >> np.uint64(1)
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        n = np.add.reduceat((both & np.uint64(1)).astype(np.int32), edge, dtype=np.int32)
        key = key[edge]
        del both, edge
        edges = np.searchsorted(key, np.arange(RANGES + 1, dtype=np.uint64) * np.uint64((1 << BEFORE_BITS + WORD_BITS) // RANGES))
        spans = [(k, slice(a, b)) for k, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist())) if a < b]
        columns = {"place": pa.array([k for k, _ in spans], pa.int32()), "c": pa.array([x.stop - x.start for _, x in spans])}
        columns |= {"keys": pa.array([packed_keys(key[x]) for _, x in spans]), "n": pa.array([packed(n[x]) for _, x in spans])}
        yield pa.RecordBatch.from_pydict(columns)


def numbered_blocks(rows: DataFrame) -> DataFrame:
    """Of every block of ``rows`` (id, train, text): each text by the numbers of its words, and what is told of each word.

    A row is a text (id, train, size, chars, place, c words, tokens), a word (its number in place, word, c, df, best) or
    pairs of words (place, c, keys, n), other columns are null. Numbers go by the words' counts in the block, then bytes.
    """
    kind = rows.schema["id"].dataType.simpleString()
    out = f"block long, id {kind}, train boolean, size long, chars long, tokens binary, place int, word binary, c long, df long, best long"
    out += ", keys binary, n binary"
    schema = pa.schema(
        [("block", pa.int64()), ("id", pa.string() if kind == "string" else pa.int64()), ("train", pa.bool_()), ("size", pa.int64()),
         ("chars", pa.int64()), ("tokens", pa.binary()), ("place", pa.int32()), ("word", pa.binary()), ("c", pa.int64()),
         ("df", pa.int64()), ("best", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())]
    )

    def whole(tally: WordTally) -> Iterator[pa.RecordBatch]:
        *texts, words = tally.told()
        # frequent words first, which makes small numbers
        number = np.empty(words.num_rows, np.int32)
        number[np.argsort(-words.column("c").to_numpy(), kind="stable")] = np.arange(words.num_rows, dtype=np.int32)
        for batch in chain(texts, [words], tally.pairs()):
            columns = dict(zip(batch.schema.names, batch.columns)) | {"block": pa.array(np.full(batch.num_rows, tally.block))}
            if "tokens" in columns:
                listed = [number[np.frombuffer(x, np.int32)] for x in columns["tokens"].to_pylist()]
                columns["tokens"] = pa.array(map(packed, listed), pa.binary())
                columns["c"] = pa.array(map(len, listed), pa.int64())
            elif "word" in columns:
                columns["place"] = pa.array(number)
            yield pa.RecordBatch.from_arrays(
                [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(batch.num_rows, f.type) for f in schema], schema=schema
            )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = None
        for block, batch in numbered(batches):
            if tally is None or block != tally.block:
                if tally is not None:
                    yield from whole(tally)
                    tally = None
                    trim()
                tally = WordTally(block)
            train, text = batch.column("train"), batch.column("text")
            told = [batch.column("id").take(pa.array(range(batch.num_rows))), train.take(pa.array(range(batch.num_rows)))]
            told += [pc.binary_length(text).cast(pa.int64()), pc.utf8_length(text).cast(pa.int64())]
            about = pa.RecordBatch.from_arrays(told, names=["id", "train", "size", "chars"])
            tally.add(about, text.cast(pa.binary()).to_pylist(), train.to_numpy(zero_copy_only=False))
        if tally is not None:
            yield from whole(tally)
            tally = None
            trim()

    return rows.mapInArrow(number, out)


def pair_counts(pairs: DataFrame, range_keys: int = RANGE_KEYS) -> DataFrame:
    """block, place, piece, c, counts, totals: for the keys of each row of ``pairs`` (block, place, c, keys, n), which is cut
    into pieces if there are many, how many training texts have the pair, and how many pairs they have with the words before.
    """
    total = pairs.agg(F.sum("c")).first()[0] or 0
    pieces = -(-total // (RANGES * range_keys)) or 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 1):
            block, place, count, data, n = (x[0].as_py() for x in batch.columns)
            keys, n = unpacked_keys(data, count), unpacked(n, count, np.int32)
            border = [((place * pieces + k << BEFORE_BITS) // (RANGES * pieces)) << WORD_BITS for k in range(1, pieces)]
            edges = [0, *np.searchsorted(keys, np.asarray(border, np.uint64)).tolist(), count]
            for k, part in enumerate(slice(a, b) for a, b in zip(edges, edges[1:]) if a < b):
                columns = {"block": [block], "place": pa.array([place], pa.int32()), "piece": pa.array([k], pa.int32())}
                columns |= {"c": [len(keys[part])], "keys": [packed_keys(keys[part])], "n": [packed(n[part])]}
                yield pa.RecordBatch.from_pydict(columns)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ["place", "piece"]):
            sizes = rows.column("c").to_pylist()
            listed = [unpacked_keys(x, c) for x, c in zip(rows.column("keys").to_pylist(), sizes)]
            every = np.sort(np.concatenate(listed))
            every = every[np.concatenate([[True], every[1:] != every[:-1]])]
            spots = [np.searchsorted(every, x) for x in listed]
            texts = np.zeros(len(every), np.int64)
            for spot, n, c in zip(spots, rows.column("n").to_pylist(), sizes):
                texts[spot] += unpacked(n, c, np.int32)
            earlier = every >> np.uint64(WORD_BITS)
            edge = np.flatnonzero(np.concatenate([[True], earlier[1:] != earlier[:-1]]))
            same = np.repeat(np.add.reduceat(texts, edge), np.diff(edge, append=len(every)))
            columns = {k: rows.column(k).combine_chunks() for k in ("block", "place", "piece", "c")}
            columns |= {"counts": pa.array([packed(texts[x]) for x in spots]), "totals": pa.array([packed(same[x]) for x in spots])}
            yield from pa.table(columns).to_batches()

    if pieces > 1:
        pairs = pairs.mapInArrow(cut, "block long, place int, piece int, c long, keys binary, n binary")
    else:
        pairs = pairs.select("block", "place", F.lit(0).alias("piece"), "c", "keys", "n")
    near = pairs.repartition("place", "piece").sortWithinPartitions("place", "piece")
    return near.mapInArrow(count, "block long, place int, piece int, c long, counts binary, totals binary")


def spelling_counts(words: DataFrame) -> np.ndarray:
    """Counts of zeros and ones in every cell of every context, from all ``words`` (word)."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((ORDERS, SPELLING_CELLS * 2), np.int64)
        for batch in batches:
            for run in in_batches(batch.column(0).to_pylist(), 5 * SPELLING_BYTES):
                cells, _, bits, _ = spelling_bits(run)
                for k in range(ORDERS):
                    total[k] += np.bincount(cells[:, k] * 2 + bits, minlength=SPELLING_CELLS * 2)
        slots = total.reshape(SPELLING_SLOTS, -1)
        columns = [pa.array(np.arange(SPELLING_SLOTS)), pa.array(map(packed, slots), pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["slot", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, counts in zip(*(x.to_pylist() for x in batch.columns)):
                total[slot] = total.get(slot, 0) + unpacked(counts, tables.size // SPELLING_SLOTS, np.int64)
        if total:
            columns = [pa.array(total, pa.int64()), pa.array(map(packed, total.values()), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["slot", "counts"])

    tables = np.zeros((ORDERS, SPELLING_CELLS, 2), np.float32)
    counted = words.select("word").mapInArrow(tally, "slot long, counts binary").repartition("slot")
    found = counted.mapInArrow(add, "slot long, counts binary").toArrow()  # SPELLING_SLOTS rows
    for slot, counts in zip(found.column("slot").to_pylist(), found.column("counts").to_pylist()):
        tables.reshape(SPELLING_SLOTS, -1)[slot] = unpacked(counts, tables.size // SPELLING_SLOTS, np.int64)
    return tables


def spelling_run(words: list[bytes], tables: np.ndarray, others: np.ndarray | None = None) -> BitMixer:
    """A mixer of the known counts that has learned from all ``words``, in order."""
    mixer = BitMixer(ORDERS, 64, tables)
    mixer.others = others
    for run in in_batches(words):
        cells, gates, bits, _ = spelling_bits(run)
        mixer.learn(cells, gates, bits)
    return mixer


def spelling_mixer(rare: DataFrame) -> BitMixer:
    """A mixer for spelling, from all words that one training text has: to the other texts these are unknown words.

    Every run of about SPELLING_WORDS words, by hash, learns weights from all of its words in the order of their hashes.
    A gate's weights are the mean over the runs by the bits that each had of that gate, its refining table their sum.
    """
    mixer = BitMixer(ORDERS, 64, spelling_counts(rare))
    runs = -(-rare.count() // SPELLING_WORDS)
    if not runs:
        return mixer
    shared = rare.sparkSession.sparkContext.broadcast(mixer.tables)
    kept: dict[str, np.ndarray] = {}

    def learn(words: pa.Table) -> pa.Table:
        if not kept:  # once for the runs of a task
            kept["others"] = BitMixer(ORDERS, 64, shared.value).without_own()
        ordered = words.sort_by([("h", "ascending"), ("word", "ascending")]).column("word").to_pylist()
        one = spelling_run(ordered, shared.value, kept["others"])
        bits = one.refined.sum(axis=(1, 2))
        values = np.concatenate([bits, (one.weights * bits[:, None]).ravel(), one.refined.ravel()])
        return pa.table({"slot": pa.array(np.arange(len(values))), "value": pa.array(values)})

    hashed = rare.select("word", F.xxhash64("word").alias("h")).withColumn("run", F.pmod("h", F.lit(runs)))
    learned = hashed.repartition(runs, "run").groupBy("run").applyInArrow(learn, "slot long, value double")
    found = learned.groupBy("slot").agg(F.sum("value").alias("value")).orderBy("slot").toArrow()  # 64 gates, 56 numbers each
    bits, weights, refined = np.split(found.column("value").to_numpy(), np.cumsum([64, mixer.weights.size]))
    seen = bits > 0
    mixer.weights[seen] = weights.reshape(mixer.weights.shape)[seen] / bits[seen, None]
    mixer.refined = refined.reshape(mixer.refined.shape)
    return mixer


def score_words(vocabulary: DataFrame, mixer: BitMixer) -> DataFrame:
    """block, c, at, told, part: what ``vocabulary`` tells of the words of a block, some of them in a row, packed.

    at: steps of the numbers of the words, c of them, and their crc; told: training count, training texts and group of the word;
    part: log10 of the spelling of those that no training text has.
    """
    shared = vocabulary.sparkSession.sparkContext.broadcast((mixer.tables, mixer.weights, mixer.refined))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, weights, refined = shared.value
        speller = BitMixer(ORDERS, 64, tables)
        speller.weights, speller.refined = weights, refined
        speller.freeze()
        held, size = [], 0
        for batch in chain(batches, [None]):
            if batch is not None:
                df = batch.column("df").to_numpy(zero_copy_only=False)
                part, new = np.zeros(len(df)), np.flatnonzero(df == 0)
                part[new] = spelled(batch.column("word").take(pa.array(new)).to_pylist(), speller)
                held.append(np.stack([*(batch.column(k).to_numpy(zero_copy_only=False) for k in names), part.view(np.int64)]))
                size += len(df)
            if held and (batch is None or size >= 1 << 18):
                rows = np.concatenate(held, axis=1)
                rows = rows[:, np.lexsort((rows[1], rows[0]))]
                edge = np.flatnonzero(np.diff(rows[0], prepend=-1))
                at = rows[1:3].astype(np.uint32)
                at[0] = np.diff(at[0], prepend=np.uint32(0))
                at[0, edge] = rows[1, edge]
                spans = [slice(a, b) for a, b in zip(edge, [*edge[1:], rows.shape[1]])]
                columns = {"block": rows[0][edge], "c": np.asarray([x.stop - x.start for x in spans])}
                columns |= {"at": [packed(at[:, x].ravel()) for x in spans], "told": [packed(rows[3:6, x].ravel()) for x in spans]}
                columns["part"] = [packed(rows[6, x][rows[4, x] == 0]) for x in spans]
                yield pa.RecordBatch.from_pydict(columns)
                held, size = [], 0

    names = ["block", "place", "crc", "c", "df", "group"]
    rows = vocabulary.select("block", F.col("place").cast("long").alias("place"), F.crc32("word").alias("crc"), "c", "df", "group", "word")
    return rows.mapInArrow(score, "block long, c long, at binary, told binary, part binary")


def words_told(rows: pa.Table, all_df: int) -> dict[str, np.ndarray]:
    """group, c, df, part, crc of the words of a block by their numbers, from its rows of ``score_words``.

    part: log10 of a known word's share of all text counts, or of an unknown word's spelling.
    """
    found = []
    for count, at, told, part in zip(*(rows.column(k).to_pylist() for k in ("c", "at", "told", "part"))):
        told = unpacked(told, 3 * count, np.int64).reshape(3, count)
        log = np.log10(np.maximum(told[1], 1) / max(1, all_df))
        log[told[1] == 0] = unpacked(part, int((told[1] == 0).sum()), np.float64)
        step, crc = unpacked(at, 2 * count, np.uint32).reshape(2, count)
        found.append((np.cumsum(step, dtype=np.int64), crc, *told, log))
    number, crc, c, df, group, log = map(np.concatenate, zip(*found))
    order = np.argsort(number)
    return {k: x[order] for k, x in {"group": group, "c": c, "df": df, "part": log, "crc": crc}.items()}


def cell_keys(*columns: np.ndarray) -> np.ndarray:
    """A row of hashes for each column of contexts, whose upper half is the cell."""
    factor = constants(61, len(columns)).astype(np.uint32) | np.uint32(1)
    out = np.empty((len(columns), len(columns[0])), np.uint32)
    for row, c, f in zip(out, columns, factor):
        np.multiply(c.astype(np.uint32) + np.uint32(1), f, out=row)
    return out


def hashed_cells(*columns: np.ndarray) -> np.ndarray:
    """One cell per row for each column of contexts."""
    return (cell_keys(*columns) >> np.uint32(16)).T


def before(values: np.ndarray, place: np.ndarray, back: int, none: int = 0) -> np.ndarray:
    """The value ``back`` tokens before within the text."""
    out = np.full(len(values), none, np.int64)
    out[back:] = values[:-back]
    return np.where(place >= back, out, none)


def running(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sum of the values before each token of its text; ``start`` is the first token of the token's text."""
    total = np.cumsum(values) - values
    return total - total[start]


def in_32(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Which 32nd of ``whole`` ``part`` is; division of floats is exact enough and far faster."""
    return (part * 32 / np.maximum(whole, 1)).astype(np.int64)


class Blend:
    """Shares of the first of two distributions per gate that suit the tokens seen so far best."""

    def __init__(self, gates: int) -> None:
        self.share, self.owed, self.count = np.full(gates, 0.5), np.full(gates, 2.0), np.full(gates, 4.0)

    def learn(self, gate: np.ndarray, one: np.ndarray, other: np.ndarray) -> None:
        count = self.count + np.bincount(gate, minlength=len(self.share))
        for _ in range(4):
            mine = self.share[gate] * one
            owed = self.owed + np.bincount(gate, mine / (mine + (1 - self.share[gate]) * other), minlength=len(self.share))
            self.share = owed / count
        self.owed, self.count = owed, count


class Slice:
    """Tokens of some texts of a block with the contexts of every decision about them."""

    def __init__(
        self, tokens: list[np.ndarray], train: np.ndarray, words: dict[str, np.ndarray], n: int, after: list[np.ndarray] | None = None
    ) -> None:
        """``after``: counts and totals of the tokens of each text, as ``followers`` gives them."""
        self.size = size = np.asarray([len(x) for x in tokens])
        self.token = token = np.concatenate(tokens).astype(np.int64)
        self.doc = doc = np.repeat(np.arange(len(tokens)), size)
        self.start = start = np.repeat(np.cumsum(size) - size, size)
        spot = np.arange(len(token))
        self.place = place = spot - start
        self.learner = learner = train[doc]
        df = words["df"][token]
        self.known = df > 0

        order = by_text(doc, token, len(words["df"]))
        same = np.zeros(len(token), bool)
        same[1:] = (token[order][1:] == token[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        self.earlier = earlier = np.empty(len(token), np.int64)
        earlier[order] = spot - np.maximum.accumulate(np.where(same, 0, spot))
        self.repeat = repeat = earlier > 0
        self.span = span = np.minimum(np.log2(place + 1).astype(np.int64), 15)
        flags = sum(before(repeat, place, k + 1) << k for k in range(4))
        rate = in_32(running(repeat.astype(np.int64), start), place)
        previous = before(token, place, 1, -1) + 1
        # the word that the text has most often so far, and the last one that it repeated
        level = earlier + doc * (int(earlier.max(initial=0)) + 2)
        peak = np.maximum.accumulate(level)
        rise = np.ones(len(token), bool)
        rise[1:] = level[1:] > peak[:-1]
        favourite = before(token[np.maximum.accumulate(np.where(rise, spot, 0))], place, 1, -1) + 1
        last = np.maximum.accumulate(np.where(repeat, spot, -1))
        echoed = before(np.where(last >= start, token[last], -1), place, 1, -1) + 1
        self.again_cells = hashed_cells(span * 32 + rate, flags * 16 + span, previous, favourite * 32 + rate, echoed * 256 + (previous & 255))

        # a training text does not know the words that only it has
        self.first = first = np.flatnonzero(~repeat)
        self.fresh = fresh = self.known if n == 0 else df > learner
        stranger, firsts = running((~fresh & ~repeat).astype(np.int64), start), running((~repeat).astype(np.int64), start)
        odd = in_32(stranger, firsts)
        self.kind_cells = hashed_cells(*(x[first] for x in (odd * 16 + span, flags * 32 + odd, previous, rate * 32 + odd, favourite * 32 + odd)))

        self.group = group = words["group"][token]
        recent = [before(group, place, k, 0) for k in (1, 2, 3)]
        self.chosen = chosen = np.flatnonzero(~repeat & self.known)
        contexts = (favourite, echoed, recent[0] * GROUPS + recent[1], recent[2] * GROUPS + recent[0], span, previous)
        self.group_keys = cell_keys(*(x[chosen] * GROUPS for x in contexts))
        self.group_steps = cell_keys(*[np.zeros(1, np.int64)] * len(contexts))
        self.follow(np.concatenate(after, axis=1)[:, chosen] if after else np.zeros((2, len(chosen)), np.float32), previous[chosen])

    def follow(self, after: np.ndarray, previous: np.ndarray) -> None:
        """``asked``: the chosen tokens whose words before are known, with contexts, gates and truth of their following, and
        their shares then. ``left``: the chosen tokens that do not follow."""
        count, total = after
        doc, spot = self.doc[self.chosen], np.arange(len(self.chosen))
        place = spot - np.searchsorted(doc, doc)
        told = count > 0
        outcome = np.where(told, 2, total > 0).astype(np.int64)
        history = sum(before(outcome, place, k + 1) * 3**k for k in range(4))
        rate = in_32(running(told.astype(np.int64), spot - place), place)
        last = np.maximum.accumulate(np.where(told, -1, spot))  # the last token that did not follow
        streak = np.minimum(before(np.minimum(spot - last, place + 1), place, 1), 31)
        self.asked = asked = np.flatnonzero(total > 0)
        self.after_gate = level = np.minimum(np.log2(total[asked]).astype(np.int64), 15)
        history, rate, streak = history[asked], rate[asked], streak[asked]
        contexts = (history * 16 + level, rate * 16 + level, previous[asked], history * 32 + rate, streak * 16 + level)
        self.after_cells, self.follows = hashed_cells(*contexts), told[asked]
        self.after_share = (count / np.maximum(total, 1))[asked]
        self.left = np.flatnonzero(~told)

    def branches(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Cells, nodes and branches of each level of the tree over the groups, for some of the chosen tokens."""
        levels = GROUPS.bit_length() - 1
        group, keys = self.group[self.chosen][rows], self.group_keys.take(rows, axis=1)
        for k in range(levels):
            node = (group >> (levels - k)) | (1 << k)
            # the cells of the contexts with the node added to them
            cells = (keys + self.group_steps * node.astype(np.uint32)) >> np.uint32(16)
            yield cells.T, node, (group >> (levels - 1 - k)) & 1


class WordChoice:
    """What is learned of the choice of words: repeats, known words, groups, and how repeats are drawn."""

    def __init__(self, words: dict[str, np.ndarray], group_df: np.ndarray, n: int, v: int) -> None:
        self.words, self.n = words, n
        self.share = np.where(words["df"] > 0, 10.0 ** words["part"], 0.0)
        self.whole = group_df / max(1, group_df.sum())
        self.unit = (words["c"] + 0.5) / (n + 1)
        self.base = np.log10((words["c"] + 0.5) / (n + 0.5 * (v + 1)))
        self.again, self.kind, self.pick = BitMixer(5, 16), BitMixer(5, 16), BitMixer(6, GROUPS)
        self.after = BitMixer(5, 16)
        # words with the hash of the word: this part of what followed is expected to be the word itself
        self.itself = words["df"] / np.maximum(words["df"] + group_df.sum() / 2.0**WORD_BITS, 1e-300)
        self.mine = Blend(16)

    def drawn(self, s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The repeated tokens and their shares by counts in the text and by counts in the corpus."""
        unit = self.unit[s.token]
        seen = running(np.where(s.repeat, 0.0, unit), s.start)
        hit = np.flatnonzero(s.repeat)
        return hit, (s.earlier / np.maximum(s.place, 1))[hit], (unit / np.maximum(seen, unit))[hit]

    def learn(self, s: Slice) -> None:
        rows = np.flatnonzero(s.learner & (s.place > 0))
        self.again.learn(s.again_cells.T.take(rows, axis=1).T, s.span[rows], s.repeat[rows])
        rows = np.flatnonzero(s.learner[s.first])
        self.kind.learn(s.kind_cells.T.take(rows, axis=1).T, s.span[s.first][rows], s.fresh[s.first][rows])
        mine = s.learner[s.chosen] & s.fresh[s.chosen]
        rows = np.flatnonzero(mine[s.asked])
        self.after.learn(s.after_cells.T.take(rows, axis=1).T, s.after_gate[rows], s.follows[rows])
        for cells, node, branch in s.branches(s.left[mine[s.left]]):
            self.pick.learn(cells, node, branch)
        hit, by_text, by_corpus = self.drawn(s)
        rows = np.flatnonzero(s.learner[hit])
        self.mine.learn(s.span[hit][rows], by_text[rows], by_corpus[rows])

    def freeze(self) -> None:
        for mixer in (self.again, self.kind, self.after, self.pick):
            mixer.freeze()

    def score(self, s: Slice) -> dict[str, np.ndarray]:
        p_again = np.where(s.place > 0, self.again.predict(s.again_cells, s.span), 0.0)
        log = np.log10(1 - p_again)
        hit, in_text, by_corpus = self.drawn(s)
        mine = self.mine.share[s.span[hit]]
        log[hit] = np.log10(p_again[hit] * (mine * in_text + (1 - mine) * by_corpus))

        p_known = self.kind.predict(s.kind_cells, s.span[s.first]) if self.n else np.zeros(len(s.first))
        known = s.known[s.first]
        with np.errstate(divide="ignore"):
            log[s.first] += np.where(known, np.log10(p_known), np.log10(1 - p_known) + self.words["part"][s.token[s.first]])
        # a known word that follows the words before as in other texts: its share of what follows them
        p_after, rows = self.after.predict(s.after_cells, s.after_gate), s.chosen[s.asked]
        share = s.after_share * self.itself[s.token[rows]]
        log[rows] += np.log10(np.where(s.follows, p_after * np.where(s.follows, share, 1), 1 - p_after))
        # any other: its group bit by bit, then its share of the group without the words that the text had
        share, group = self.share[s.token[s.chosen]], s.group[s.chosen]
        key = s.doc[s.chosen] * GROUPS + group
        by_group = by_text(s.doc[s.chosen], group, GROUPS)
        first_of = np.maximum.accumulate(np.where(np.diff(key[by_group], prepend=-1) != 0, np.arange(len(key)), 0))
        gone = np.empty(len(share))
        gone[by_group] = running(share[by_group], first_of)
        rest = s.chosen[s.left]
        p_known = (share / np.maximum(self.whole[group] - gone, share))[s.left]
        for cells, node, branch in s.branches(s.left):
            p = self.pick.predict(cells, node)
            p_known *= np.where(branch == 1, p, 1 - p)
        log[rest] += np.log10(p_known)

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.bincount(s.doc, values, minlength=len(s.size))

        return {
            "n_tokens": s.size.astype(np.int64),
            "n_known": per_text(self.words["c"][s.token] > 0).astype(np.int64),
            "base_score": per_text(self.base[s.token]),
            "score": per_text(log),
        }


def score_block(texts: list[str], train: np.ndarray, words: dict[str, np.ndarray], group_df: np.ndarray, n: int, v: int) -> dict[str, np.ndarray]:
    """Counts and scores of the texts of a block; what decides about whole words is learned from all its training texts.

    words: word, group, c, df, part as of ``score_words``; group_df: text counts of every group. Texts are taken in slices,
    so that the arrays of a slice, not of the block, are in memory.
    """
    index = dict(zip(words["word"], range(len(words["word"]))))
    tokens = [numbers([[*words_of(t.encode()), END]], index)[1] for t in texts]
    return score_tokens(tokens, [len(t) for t in texts], train, words, group_df, n, v)


def followers(
    tokens: list[np.ndarray], parts: list[slice], train: np.ndarray, name: np.ndarray, counts: np.ndarray, totals: np.ndarray
) -> list[np.ndarray]:
    """Of each text the counts and the totals of its new words, without those of the text itself; zero for other words.

    parts: slices of the texts; name: hashes of the words; counts, totals: of the block's pair keys, ascending.
    """
    size = np.asarray([len(x) for x in tokens])
    keys, spots, docs, low = [], [], [], 0
    for part in parts:
        token = np.concatenate(tokens[part]).astype(np.int64)
        doc = np.repeat(np.arange(part.stop - part.start), size[part])
        rows = newcomers(doc, token, len(name))
        keys.append(pair_keys(name[token], np.arange(len(token)) - (np.cumsum(size[part]) - size[part])[doc], rows))
        spots.append((rows + low).astype(np.int32))
        docs.append((doc[rows] + part.start).astype(np.int32))
        low += len(token)
    key, spot, doc = np.concatenate(keys), np.concatenate(spots), np.concatenate(docs)
    del keys, spots, docs
    out, done = np.zeros((2, low), np.float32), 0
    side = (key >> np.uint64(BEFORE_BITS + WORD_BITS - 3)).astype(np.int8)
    for eighth in range(8):  # of the keys, in order
        rows = np.flatnonzero(side == eighth)
        if not len(rows):
            continue
        rows = rows[np.argsort(key[rows])]
        own_key, own_doc = key[rows], doc[rows]
        rank = np.cumsum(np.concatenate([[done], own_key[1:] != own_key[:-1]]))
        done = int(rank[-1]) + 1
        out[0, spot[rows]] = counts[rank] - train[own_doc]
        # without the pairs that the text itself has with the same words before; one pair is its own
        total, many = totals[rank], np.flatnonzero(totals[rank] > 1)
        out[1, spot[rows]] = total - train[own_doc]
        own_key, own_doc, rows = own_key[many] >> np.uint64(WORD_BITS), own_doc[many], rows[many]
        if len(many):
            group = np.cumsum(np.concatenate([[0], own_key[1:] != own_key[:-1]])) * len(tokens) + own_doc
            order = np.argsort(group)
            edge = np.flatnonzero(np.diff(group[order], prepend=-1))
            own, times = np.empty(len(group), np.int64), np.diff(edge, append=len(group))
            own[order] = np.repeat(times, times)
            out[1, spot[rows]] = total[many] - own * train[own_doc]
    del key, spot, doc, side
    trim()
    return np.split(out, np.cumsum(size)[:-1], axis=1)


def score_tokens(
    tokens: list[np.ndarray],
    chars: list[int],
    train: np.ndarray,
    words: dict[str, np.ndarray],
    group_df: np.ndarray,
    n: int,
    v: int,
    pairs: tuple[np.ndarray, np.ndarray] | None = None,
) -> dict[str, np.ndarray]:
    """``score_block`` of texts that are given by the places of their words, the end included, and their lengths.

    pairs: counts and totals of the block's pair keys; then words has the crc of each word as well.
    """
    slices, low, size = [], 0, 0
    for k, length in enumerate(chars):
        size += length + 1
        if size >= SLICE_BYTES or k == len(tokens) - 1:
            slices.append(slice(low, k + 1))
            low, size = k + 1, 0
    choice = WordChoice(words, group_df, n, v)
    after = followers(tokens, slices, train, mixed(words["crc"].astype(np.uint64)), *pairs) if pairs else None
    for part in slices:
        if train[part].any():
            own = np.flatnonzero(train[part]) + part.start
            choice.learn(Slice([tokens[i] for i in own], train[own], words, n, after and [after[i] for i in own]))
    choice.freeze()
    found = [choice.score(Slice(tokens[part], train[part], words, n, after and after[part])) for part in slices]
    return {k: np.concatenate([f[k] for f in found]) for k in found[0]}


def context_mixing_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: int = 1) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every text.

    Rows of the fold ``held_out`` teach nothing. A null text counts as empty: its only token is the end. Repeated rows
    are scored by themselves, null ids belong to the training fold. Without training rows nothing is known and every
    word is spelled by an untrained model. bits_per_byte counts the end as a byte. An empty table gives no rows.

    ``docs`` is read once; its texts are split into words and stored as numbers then.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), (~fold(id_col, held_out)).alias("train"), text_of(text_col).alias("text"))
    blocks = settle(numbered_blocks(rows), "lm-blocks")
    # two numbers in a column for the shuffle: what is told of a word by one block fits half a long
    two = [F.shiftleft(F.col(a).cast("long"), 32).bitwiseOR(F.col(b)).alias(a) for a, b in (("place", "c"), ("df", "best"))]
    used = blocks.filter("word is not null").select("block", "word", *two).repartition("word")
    low = F.lit((1 << 32) - 1)
    used = used.select(
        "block", "word", F.shiftright("place", 32).alias("place"), F.col("place").bitwiseAND(low).alias("c"),
        F.shiftright("df", 32).alias("df"), F.col("df").bitwiseAND(low).alias("best"),
    )
    same = Window.partitionBy("word").orderBy("block")
    every = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    vocabulary = used.select(
        "block",
        "word",
        F.col("place").cast("int").alias("place"),
        F.sum("c").over(every).alias("c"),
        F.sum("df").over(every).alias("df"),
        (F.max("best").over(every) % GROUPS).alias("group"),
        (F.row_number().over(same) == 1).alias("once"),
    )
    vocabulary = settle(vocabulary, "lm-vocabulary")
    once = vocabulary.filter("once")
    group_df = np.zeros(GROUPS)
    for r in once.groupBy("group").agg(F.sum("df").alias("df")).collect():  # at most GROUPS rows
        group_df[r["group"]] = r["df"]
    totals = once.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1)), F.sum("df")).first()
    n, v, all_df = (int(x or 0) for x in totals)
    scored = score_words(vocabulary, spelling_mixer(once.filter("df = 1")))
    counted = pair_counts(blocks.filter("keys is not null").select("block", "place", "c", "keys", "n"))
    blocked = blocks.filter("tokens is not null").select("block", "place", "c", "id", "train", "size", "chars", "tokens")
    blocked = blocked.unionByName(counted, allowMissingColumns=True).unionByName(scored, allowMissingColumns=True)

    def score(rows: pa.Table) -> pa.Table:
        trim()
        pairs = rows.filter(pc.is_valid(rows.column("counts"))).sort_by([("place", "ascending"), ("piece", "ascending")])
        lengths = pairs.column("c").to_pylist()
        told = [
            np.concatenate([unpacked(x, c, np.int64).astype(np.float32) for x, c in zip(pairs.column(k).to_pylist(), lengths)])
            for k in ("counts", "totals")
        ]
        texts = rows.filter(pc.is_valid(rows.column("tokens"))).sort_by("place")  # learning goes by the order of the input
        tokens = [unpacked(x, c, np.int32) for x, c in zip(texts.column("tokens").to_pylist(), texts.column("c").to_pylist())]
        words = words_told(rows.filter(pc.is_valid(rows.column("at"))), all_df)
        texts, chars = texts.select(["id", "train", "size"]), texts.column("chars").to_pylist()
        trim()
        found = score_tokens(tokens, chars, texts.column("train").to_numpy(), words, group_df, n, v, (told[0], told[1]))
        trim()
        columns = {"id": texts.column("id"), "train": texts.column("train"), "size": texts.column("size")}
        return pa.table(columns | {k: pa.array(x) for k, x in found.items()})

    out = f"id {kind}, train boolean, size long, n_tokens long, n_known long, base_score double, score double"
    result = blocked.groupBy("block").applyInArrow(score, out)
    return result.select(
        F.col("id").alias(id_col),
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        (-F.col("score") / F.lit(float(np.log10(2))) / (F.col("size") + 1)).alias("bits_per_byte"),
    )
