"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from packetloom.llm import repair

ROLES = re.compile("(s?(ua)+)?")
COLUMNS = "conv_id long, turn long, role string, text string, key string, pos int, segment string"


def cheapest(turns):
    """(cost, audit, lines) of turns (role, text, fault): the first finished one of a search by cost, then audit."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, lines = heapq.heappop(heap)
        if at == len(turns) and ROLES.fullmatch(roles):
            return cost, audit, list(lines)
        if (at, roles[-1:], len(roles) == 1, audit[-2:]) in done:
            continue
        done.add((at, roles[-1:], len(roles) == 1, audit[-2:]))
        ways = [(3, "I", at, name[0], (f"{name}:",)) for name in ("user", "assistant")] if audit[-2:] != "II" else []
        if at < len(turns):
            role, text, fault = turns[at]
            ways.append((4, "D", at + 1, "", ()))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                ways.append((extra, "K", at + 1, role[:1] or "?", (f"{role}:{text}",)))
                ways += [(3 + extra, "R", at + 1, name[0], (f"{name}:{text}",)) for name in ("user", "assistant")]
        for extra, edit, place, initial, more in ways:
            found = roles + initial
            if re.fullmatch("s?(ua)*u?", found):
                heapq.heappush(heap, (cost + extra, audit + edit, place, found, lines + more))


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        solid = re.sub("[\x20\x09-\x0d]", "", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def expected(rows, damaged=False):
    """The result per conversation, from lists of (conv, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            turns += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.sha256(t[2].encode()).digest()))
        judged = faults([t[1:] for t in turns])
        cost, audit, lines = cheapest(judged)
        known = {t[0] for t in turns if t[0] is not None}
        count = [sum(f == name for _, _, f in judged) for name in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        out[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(frame):
    return {r["conv_id"]: tuple(r)[1:] for r in frame.collect()}


def drawn(rng, n):
    roles = ["user", "assistant", "system", "tool", "", None, "uncle"]
    texts = ["Yes.", "No", "  ", "", None, "Fine!\n", "a. b", "é?"] + [f"T{i}." for i in range(20)]
    return [(rng.choices(roles, [9, 9, 2, 1, 0.5, 0.5, 0.5])[0], rng.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_alignment_is_the_least_of_all(seed):
    rng = random.Random(seed)
    for _ in range(60):
        codes = [rng.randrange(8) for _ in range(rng.randrange(9))]
        turns = [(["system", "user", "assistant", "tool"][c % 4], f"T{i}", "truncated" if c >= 4 else "") for i, c in enumerate(codes)]
        edits = "".join(repair.repair(codes))
        assert edits == cheapest(turns)[1]


def test_long_alignment_needs_little_space():
    codes = [1, 2] * 20_000 + [3] + [2, 1] * 20_000
    edits = repair.repair(codes)
    assert len(edits) == len(codes) and "".join(edits).count("D") + "".join(edits).count("I") + "".join(edits).count("R") <= 6


@pytest.mark.parametrize("bits,damaged", [(16, False), (16, True), (2, False), (1, True)])
def test_query_equals_search(spark, bits, damaged):
    rng = random.Random(bits)
    rows = []
    for conv in [None, *range(25)]:
        for i, (role, text) in enumerate(drawn(rng, rng.randrange(1, 12))):
            rows.append((conv, rng.choice([i, i, i + 1, None, 3 * i]), role, text))
    rows += [(100, t % 9, role, text) for t, (role, text) in enumerate(drawn(rng, 60))]  # spread over many segments
    rows += [(101, 5, "user", "Same.")] * 40
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], COLUMNS)
    got = found(repair.repair_conversations(frame, damaged=damaged, segment_bits=bits).drop("key"))
    assert got == expected(rows, damaged)


def test_all_rows_dropped(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(7, turn, "user", "Hi.", "x", 1, "y")], COLUMNS)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(repair.repair_conversations(frame, damaged=True)) == {7: (0, 0, 0, 0, 0, 0, "", empty)}


def test_empty_table_long_text_and_text_ids(spark):
    frame = spark.createDataFrame([], COLUMNS)
    assert repair.repair_conversations(frame).count() == 0
    long = "word " * 400_000
    rows = [("a", 1, "user", long), ("a", 2, "assistant", "Yes."), ("", 1, "user", "Hi."), (None, 1, "user", "Hi.")]
    frame = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    got = found(repair.repair_conversations(frame))
    assert got == expected(rows) and set(got) == {"a", "", None}
    assert got["a"][-2] == "KK" and got["a"][3] == 1 and got["a"][5] == 3
