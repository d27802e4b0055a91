"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

A conversation is right if its roles are an optional system turn and then pairs of a user and an assistant turn. Turns
are kept, given another role, deleted, or empty ones are inserted; the state of an alignment is one of four (nothing yet,
after system, after user, after assistant). Hirschberg's divide and conquer finds the edits in linear space: costs from
the left and from the right meet in the middle, the best crossing is fixed, both halves follow.

Any two ways of reaching a turn differ before the shorter one ends, since each of them uses up the same turns. So of
equally cheap crossings the one whose edits so far are least in ASCII is right whatever follows, and the left costs need
only the order of the four states, not their edits.

Work is cut into segments of the ordered turns, whatever conversation they belong to. Costs of a segment from each state to
each state add up like matrices, so a conversation of any size is spread over many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.session import settle

#: Costs of an edit; a truncated turn that stays costs as much as a new role.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows of a segment are at most two to this power.
SEGMENT_BITS = 16
NEVER = 1 << 60
SOLID = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*$"

START, SYSTEM, USER, ASSISTANT = range(4)
#: State after an inserted or renamed turn: whichever of user and assistant may come next.
NEXT = (USER, USER, ASSISTANT, USER)
#: Inserts that complete a conversation that ends in a state.
TAIL = ("", "II", "I", "")
INITIALS = "sua"
NO_FAULT, BLANK, DUPLICATE, CUT = range(4)


def _steps(initial: int, cut: bool) -> list[list[tuple[int, int, str]]]:
    """Per state the cheapest edits (ties: least in ASCII) that use up a turn and lead to each state: (state, cost, edits)."""
    out = []
    for begin in range(4):
        best: dict[int, tuple[int, str]] = {}
        state = begin
        for inserts in range(3):
            stays = TRUNCATED if cut else 0
            ways = [(state, DELETE, "D"), (NEXT[state], REROLE + stays, "R")]
            fits = (initial == 0 and state == START) or (initial < 3 and initial + 1 == NEXT[state])
            if fits:
                ways.append((initial + 1, stays, "K"))
            for target, cost, edit in ways:
                way = cost + INSERT * inserts, "I" * inserts + edit
                best[target] = min(best.get(target, way), way)
            state = NEXT[state]
        out.append([(target, *way) for target, way in sorted(best.items())])
    return out


#: By code of a turn: its initial (s, u, a, other), plus four if it is truncated.
STEPS = [_steps(code % 4, code >= 4) for code in range(8)]


def forward(codes: Sequence[int], entry: int) -> tuple[list[int], list[int]]:
    """Costs from ``entry`` to each state over the turns, and the ASCII order of the edits that lead there."""
    cost, rank = [NEVER] * 4, [0] * 4
    cost[entry] = 0
    for code in codes:
        new, how = [NEVER] * 4, [(0, "")] * 4
        for state, ways in enumerate(STEPS[code]):
            so_far = cost[state]
            if so_far < NEVER:
                for target, extra, edits in ways:
                    total = so_far + extra
                    if total < new[target] or (total == new[target] and (rank[state], edits) < how[target]):
                        new[target], how[target] = total, (rank[state], edits)
        cost = new
        for place, state in enumerate(sorted(range(4), key=how.__getitem__)):
            rank[state] = place
    return cost, rank


def backward(codes: Sequence[int], cost: list[int]) -> list[int]:
    """Costs from each state over the turns to the end, where ``cost`` is what each state costs."""
    for code in reversed(codes):
        cost = [min(extra + cost[target] for target, extra, _ in ways) for ways in STEPS[code]]
    return cost


def align(codes: Sequence[int], entry: int, last: int) -> list[str]:
    """Edits of every turn from state ``entry`` to state ``last``: the cheapest, of those the least in ASCII."""
    out = [""] * len(codes)
    todo = [(0, len(codes), entry, last)] if len(codes) else []
    while todo:
        low, high, begin, end = todo.pop()
        if high - low == 1:
            out[low] = next(edits for target, _, edits in STEPS[codes[low]][begin] if target == end)
            continue
        middle = (low + high) // 2
        left, rank = forward(codes[low:middle], begin)
        right = backward(codes[middle:high], [0 if s == end else NEVER for s in range(4)])
        crossing = min(range(4), key=lambda s: (left[s] + right[s], rank[s]))
        todo += [(low, middle, begin, crossing), (middle, high, crossing, end)]
    return out


def ending(codes: Sequence[int], entry: int = START) -> int:
    """State that the best alignment of a whole conversation ends in."""
    cost, rank = forward(codes, entry)
    return min(range(4), key=lambda s: (cost[s] + INSERT * len(TAIL[s]), rank[s]))


def repair(codes: Sequence[int]) -> list[str]:
    """Edits of every turn of a whole conversation; inserts at its end follow those of the last turn."""
    last = ending(codes)
    out = align(codes, START, last)
    if out:
        out[-1] += TAIL[last]
    return out


def damage(turns: DataFrame) -> DataFrame:
    """Test damage of rows conv, turn, role, text by a hash of conversation and turn; adds copies, 0 for a dropped row."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")))
    kind = F.pmod(F.crc32(key), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    return turns.withColumns({"text": text, "role": role, "copies": F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)})


def _rows(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in names))


def _groups(rows: Iterator[tuple], width: int) -> Iterator[list[tuple]]:
    """Consecutive rows that agree in their first ``width`` values."""
    held: list[tuple] = []
    for row in rows:
        if held and row[:width] != held[0][:width]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


ORDERED = ["key", "segment", "pos", "turn", "role", "digest", "copies", "blank", "cut"]
EDITED = "key string, segment long, pos long, turn long, role string, digest binary, copies long, fault int, code int, edits string"


def _emit(rows: list[tuple], names: Sequence[str], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, schema.field(n).type) for c, n in zip(columns, names)], schema=schema)


PLANNED = pa.schema(
    [("key", pa.string()), ("segment", pa.int64()), ("pos", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
     ("digest", pa.binary()), ("copies", pa.int64()), ("fault", pa.int32()), ("code", pa.int32()), ("edits", pa.string()),
     ("matrix", pa.list_(pa.int64()))]
)


def _matrix(codes: Sequence[int]) -> list[int]:
    """Costs from each state to each state, then the ASCII orders."""
    ways = [forward(codes, entry) for entry in range(4)]
    return [x for cost, _ in ways for x in cost] + [x for _, rank in ways for x in rank]


def _spread(faults: Sequence[int], copies: Sequence[int], edits: Sequence[str]) -> Iterator[str | None]:
    """Edits of the turns that may stay, put between the deletions of blank and repeated ones."""
    left = iter(edits)
    for fault, count in zip(faults, copies):
        yield "D" * count if fault in (BLANK, DUPLICATE) else next(left) + "D" * (count - 1)


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Faults of every turn of a segment; its edits, or its cost matrix where the conversation goes on in other segments."""
    out: list[tuple] = []
    for group in _groups(_rows(batches, ORDERED), 2):
        seen, goes_on, turns, codes = set(), False, [], []
        for key, segment, pos, turn, role, digest, copies, blank, cut in group:
            if pos == -2:
                goes_on = True
            elif pos == -1:
                seen.add((role, digest))
            else:
                repeated = (role, digest) in seen
                seen.add((role, digest))
                fault = BLANK if blank else DUPLICATE if repeated else CUT if cut else NO_FAULT
                initial = INITIALS.find(role[0]) if role else -1
                code = (3 if initial < 0 else initial) + (4 if fault == CUT else 0)
                if fault in (NO_FAULT, CUT):
                    codes.append(code)
                turns.append((key, segment, pos, turn, role, digest, copies, fault, code))
        if not turns:
            continue
        if goes_on:
            out += [(*t, None, None) for t in turns[:-1]] + [(*turns[-1], None, _matrix(codes))]
        else:
            edits = list(_spread([t[7] for t in turns], [t[6] for t in turns], align(codes, START, ending(codes))))
            edits[-1] += TAIL[ending(codes)]
            out += [(*t, e, None) for t, e in zip(turns, edits)]
        if len(out) > 4096:
            yield _emit(out, PLANNED.names, PLANNED)
            out = []
    yield _emit(out, PLANNED.names, PLANNED)


def _cross(parts: pd.DataFrame) -> pd.DataFrame:
    """Entry and exit state of every segment of one conversation; tail for the last one."""
    parts = parts.sort_values("segment")
    tables = [np.asarray(m, dtype=object).reshape(2, 4, 4) for m in parts["matrix"]]
    cost = [INSERT * len(t) for t in TAIL]
    after = [cost]
    for table in reversed(tables):
        cost = [min(min(table[0][s][t] + cost[t], NEVER) for t in range(4)) for s in range(4)]
        after.append(cost)
    after.reverse()
    entry, states = START, []
    for place, table in enumerate(tables):
        last = min(range(4), key=lambda t: (table[0][entry][t] + after[place + 1][t], table[1][entry][t]))
        states.append((entry, last))
        entry = last
    found = parts[["key", "segment"]].assign(entry=[s[0] for s in states], last=[s[1] for s in states])
    found["closes"] = [False] * (len(parts) - 1) + [True]
    return found


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of the turns of a segment between its entry and its exit state."""
    names = PLANNED.names[:9]
    schema = pa.schema([PLANNED.field(n) for n in PLANNED.names[:10]])
    out: list[tuple] = []
    for group in _groups(_rows(batches, [*names, "entry", "last", "closes"]), 2):
        *_, entry, last, closes = group[0]
        codes = [row[8] for row in group if row[7] in (NO_FAULT, CUT)]
        edits = list(_spread([r[7] for r in group], [r[6] for r in group], align(codes, entry, last)))
        edits[-1] += TAIL[last] if closes else ""
        out += [(*row[:9], e) for row, e in zip(group, edits)]
        if len(out) > 4096:
            yield _emit(out, schema.names, schema)
            out = []
    yield _emit(out, schema.names, schema)


def edits_of(turns: DataFrame, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """key, turn, role, digest, copies, fault, edits of the different turns (see EDITED) of rows key, turn, role, text, copies."""
    facts = turns.filter("copies > 0").select(
        "key", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "copies",
        (~F.col("text").rlike(SOLID)).alias("blank"), (~F.col("text").rlike(ENDED)).alias("cut"),
    )
    # equal turns are counted before anything is sorted; a range of the order holds part of a conversation or many
    place = ["key", F.col("turn").asc_nulls_first(), "role", "digest"]
    counted = facts.groupBy("key", "turn", "role", "digest", "blank", "cut").agg(F.sum("copies").alias("copies"))
    ordered = counted.repartitionByRange(*place).sortWithinPartitions(*place).withColumn("pos", F.monotonically_increasing_id())
    ordered = settle(ordered.withColumn("segment", F.shiftright("pos", segment_bits)).select(ORDERED), "turns")

    ends = ordered.groupBy("segment").agg(F.min_by("key", "pos").alias("a"), F.max_by("key", "pos").alias("b"))
    ends = ends.select("segment", F.explode(F.array_distinct(F.array("a", "b"))).alias("key"))
    places = ends.groupBy("key").agg(F.collect_set("segment").alias("segments")).filter(F.size("segments") > 1)
    shared = settle(places.select("key", F.explode("segments").alias("segment")), "shared")
    # turns that an earlier segment of the conversation has already
    known = ordered.join(shared, ["key", "segment"], "left_semi").groupBy("key", "role", "digest").agg(F.collect_set("segment").alias("s"))
    known = known.filter(F.size("s") > 1).withColumn("segment", F.explode(F.array_remove("s", F.array_min("s"))))
    nothing = {c: F.lit(None).cast(ordered.schema[c].dataType) for c in ORDERED}
    marks = known.withColumn("pos", F.lit(-1).cast("long")).unionByName(
        shared.withColumn("pos", F.lit(-2).cast("long")), allowMissingColumns=True
    )
    marks = marks.select(*(F.col(c) if c in marks.columns else nothing[c].alias(c) for c in ORDERED))
    group = ["key", "segment"]
    planned = ordered.unionByName(marks).repartition(*group).sortWithinPartitions(*group, "pos")
    planned = settle(planned.mapInArrow(_plan, EDITED + ", matrix array<long>"), "planned")

    parts = planned.filter("matrix IS NOT NULL").select("key", "segment", "matrix")
    states = parts.groupBy("key").applyInPandas(_cross, "key string, segment long, entry int, last int, closes boolean")
    open_ones = planned.filter("edits IS NULL").drop("matrix", "edits").join(states, group)
    filled = open_ones.repartition(*group).sortWithinPartitions(*group, "pos").mapInArrow(_fill, EDITED)
    return planned.filter("edits IS NOT NULL").drop("matrix").unionByName(filled)


class _Conversation:
    """Running digest of one conversation."""

    def __init__(self) -> None:
        self.conv, self.faults, self.illegal, self.cost = None, [0, 0, 0, 0], 0, 0
        self.low = self.high = self.turn = self.initial = None
        self.turns, self.audit, self.state = 0, [], START
        self.waiting: tuple | None = None
        self.text, self.lines = hashlib.sha256(), 0

    def edit(self, turn, role, digest, copies, fault, edits) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        kept = fault in (NO_FAULT, CUT)
        if kept:
            self.faults[DUPLICATE] += copies - 1
            self.faults[fault] += 1
        else:
            self.faults[fault] += copies
        initial = role[:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.illegal += copies - 1
        self.initial = initial
        self.audit.append(edits)
        stays = "K" in edits or "R" in edits
        self.cost += DELETE * edits.count("D") + REROLE * edits.count("R") + INSERT * edits.count("I")
        self.cost += TRUNCATED if stays and fault == CUT else 0
        self.waiting = (turn, role, digest, edits)
        if not stays:
            self.say(None)

    def say(self, text: str | None) -> None:
        """Apply the waiting edits; ``text`` is that of the turn."""
        _, role, _, edits = self.waiting
        self.waiting = None
        for edit in edits:
            if edit == "D":
                continue
            if edit == "K":
                self.state = 1 + INITIALS.index(role[0])
                line = f"{role}:{text}"
            else:
                self.state = NEXT[self.state]
                line = ("user:" if self.state == USER else "assistant:") + (text if edit == "R" else "")
            self.text.update(("\n" + line if self.lines else line).encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (
            self.conv, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT], self.illegal, self.cost,
            "".join(self.audit), self.text.hexdigest(),
        )


DIGEST = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _digest(conv_col: str) -> Callable:
    columns = ["key", "conv", "turn", "role", "digest", "kind", "copies", "fault", "edits", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key_now, out, kind_of = None, None, [], None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [kind_of, *[pa.int64()] * 6, pa.string(), pa.string()]
            names = [conv_col, *(c.split()[0] for c in DIGEST.split(", "))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            kind_of = batch.schema.field("conv").type
            for key, conv, turn, role, digest, kind, copies, fault, edits, text in _rows([batch], columns):
                if now is None or key != key_now:
                    if now is not None:
                        out.append(now.row())
                    now, key_now = _Conversation(), key
                if kind == 1:
                    now.conv = conv
                if kind == 0:
                    now.edit(turn, role, digest, copies, fault, edits)
                elif now.waiting is not None and now.waiting[:3] == (turn, role, digest):
                    now.say(text)
            if len(out) > 1000:
                yield batch_of(out)
                out = []
        if now is not None:
            out.append(now.row())
            yield batch_of(out)

    return run


def repair_conversations(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    damaged: bool = False,
    segment_bits: int = SEGMENT_BITS,
) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Turns are ordered by ``turn_col`` (whole numbers, nulls first), ties by role and the SHA-256 of the text. audit holds
    the initials of the edits Keep, Rerole, Delete and Insert in order, repaired_sha256 that of the repaired lines
    ``role:text``. A null role or text counts as one blank; a turn without a role is never kept as it is. Null
    conversation ids are one conversation. Equal rows are counted as repetitions. A conversation without turns left has
    zeros, no edits and the hash of no text; an empty table gives no rows. Extra columns are left out.

    ``damaged`` first damages the turns (see ``damage``), which tests use.

    Costs and edits of one large conversation are spread over segments. Only its digest, a hash of one text from its first
    byte to its last, is taken by one task, which reads sorted rows one after the other and holds no more than the edits.
    """
    turns = conversations.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        *(F.coalesce(F.col(c), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))),
    )
    turns = damage(turns) if damaged else turns.withColumn("copies", F.lit(1))
    name = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
    turns = turns.withColumn("key", name)
    edited = edits_of(turns, segment_bits).select("key", "turn", "role", "digest", "copies", "fault", "edits", F.lit(0).alias("kind"))
    here = F.col("copies") > 0
    texts = turns.select(
        "key", "conv", F.when(here, F.col("turn")).alias("turn"), F.when(here, F.col("role")).alias("role"),
        F.when(here, F.unhex(F.sha2("text", 256))).alias("digest"), F.when(here, F.col("text")).alias("text"), F.lit(1).alias("kind"),
    )
    sent = texts.unionByName(edited, allowMissingColumns=True)
    # the id itself comes with the texts only; every conversation has one
    order = ["key", F.col("turn").asc_nulls_first(), "role", "digest", "kind"]
    sent = sent.repartition("key").sortWithinPartitions(*order)
    kind = conversations.schema[conv_col].dataType.simpleString()
    return sent.mapInArrow(_digest(conv_col), f"`{conv_col}` {kind}, {DIGEST}")
