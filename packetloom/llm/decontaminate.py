"""Benchmark decontamination by template canonicalisation.

Numbers, names and units of documents and benchmark items become typed placeholders, so a question with other
parameters keeps its template. Pieces of items are joined to those of documents by their hashes; pieces of one alignment
of a document with an item are put together, and what fills the placeholders must map one to one between the two.

Pieces are windows of template words; where an item has none with enough ordinary words, its sentences as templates; and
windows of the words themselves in lower case, which find copies of any item whatever its case.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import spare, text_of
from packetloom.session import settle

WINDOW = 8
#: Words of a window that are no placeholders; windows with fewer say nothing.
LITERALS = 4
#: Items of fewer words are found where they are all of a text, not inside one.
FEWEST_WORDS = 4
#: Share of an item's windows that make a leak.
COVERAGE = 0.3
#: Share of the slot pairs that may contradict others, as edited copies have some.
CONFLICTS = 0.25
#: A benchmark of up to so many pieces is broadcast; a larger one is joined by a shuffle.
BROADCAST_PIECES = 500_000
#: Kinds of pieces, by which a leak is found; of several the first one is given.
TEMPLATE, WORDS, SENTENCE, WHOLE = "template", "words", "sentence", "whole"
KINDS = (TEMPLATE, WORDS, SENTENCE, WHOLE)
#: Hashes of the pieces that are no windows; a text with more words than a whole item has one that meets none.
OTHER_PIECES = {
    SENTENCE: f"transform(sentences, s -> xxhash64('{SENTENCE}', s))",
    WHOLE: f"array(CASE WHEN size(words) < {FEWEST_WORDS} THEN xxhash64('{WHOLE}', transform(words, w -> lower(w))) END)",
}

#: Units of measure and money, as written after a number.
UNITS = (
    "mm|cm|dm|m|km|in|ft|yd|mi|inch|inches|foot|feet|yard|yards|mile|miles|meter|meters|metre|metres|kilometers|kilometres"
    "|mg|g|kg|lb|lbs|oz|ton|tons|gram|grams|kilograms|pounds|ounces"
    "|ml|cl|l|liter|liters|litre|litres|gallon|gallons|cup|cups"
    "|ms|s|sec|min|h|hr|hrs|second|seconds|minute|minutes|hour|hours|day|days|week|weeks|month|months|year|years"
    "|percent|degrees|dollar|dollars|euro|euros|cent|cents|usd|eur|mph|kph|kmh|hz|khz|mhz|ghz|kb|mb|gb|tb|w|kw|v"
)
BLANK = r"[\x09-\x0D\x20]"
NOT_BLANK = r"[^\x09-\x0D\x20]"
SLOTS = ("#n", "#p", "#u")
#: Ends of sentences are marked by a character that is a word of its own until the sentences are cut.
SENTENCE_END = rf"[.!?]+({BLANK}|\z)|[\x0A\x0D]+"
MARK = "\x01"


def plain_words(text: Column, marked: bool = False) -> Column:
    """The text without punctuation, its words (and marks after sentences) separated by one blank."""
    kept = r"\p{L}\p{M}\p{N}\x09-\x0D\x20"
    if marked:
        text = F.regexp_replace(F.replace(text, F.lit(MARK), F.lit("")), SENTENCE_END, f" {MARK} ")
        kept += r"\x01"
    bare = F.regexp_replace(text, f"[^{kept}]+", "")
    return F.trim(F.regexp_replace(bare, rf"{BLANK}{{2,}}|[\x09-\x0D]", " "))


def template(plain: Column) -> Column:
    """``plain`` in lower case with #n, #u, #p for numbers, units after numbers and capitalised words."""
    digits = plain.rlike(r"\p{N}")
    # matches begin where words begin: a long word without digits is read once
    numbers = F.when(digits, F.regexp_replace(plain, rf"(?<!{NOT_BLANK}){NOT_BLANK}*\p{{N}}{NOT_BLANK}*", "#n")).otherwise(plain)
    names = F.lower(F.regexp_replace(numbers, r"(^| )\p{Lu}\p{Ll}+", "$1#p"))
    return F.when(digits, F.regexp_replace(names, f"#n ({UNITS})( |$)", "#n #u$2")).otherwise(names)


def canonical(rows: DataFrame, text: Column, marked: bool = True) -> DataFrame:
    """``rows`` with arrays words and shape: the words of the text and their template, of equal length.

    A text without words has one empty word. ``marked`` adds sentences, the templates of the sentences that have words.
    """
    rows = rows.withColumn("_plain", plain_words(text, marked))
    rows = rows.withColumn("_shape", template(F.col("_plain")))
    flat = (lambda c: F.trim(F.regexp_replace(c, f" ?{MARK}", ""))) if marked else F.col
    rows = rows.withColumns({"words": F.split(flat("_plain"), " "), "shape": F.split(flat("_shape"), " ")})
    if marked:
        rows = rows.withColumn("sentences", F.expr(f"filter(transform(split(_shape, '{MARK}'), s -> trim(s)), s -> s != '')"))
    return rows.drop("_plain", "_shape")


def bind(value: str, name: str, body: str) -> str:
    """``body`` with ``value`` computed once a row under ``name``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def windows(words: str, size: int, kind: str) -> str:
    """Hashes of all windows of ``size`` words of an array, from hashes of words, of pairs, of fours and so on."""
    word = "lower(w)" if kind == WORDS else "w"
    steps, width = [], 1
    while width < size:
        step = min(width, size - width)
        steps.append((f"zip_with(h, slice(h, {step + 1}, size(h)), (a, b) -> xxhash64(a, b))", "h"))
        width += step
    body = f"slice(h, 1, greatest(0, size({words}) - {size - 1}))"
    for value, name in reversed(steps):
        body = bind(value, name, body)
    return bind(f"transform({words}, w -> xxhash64('{kind}', {word}))", "h", body)


def literals(shape: str, start: str, size: str) -> str:
    """Number of words of a window that are no placeholders."""
    slots = ", ".join(f"'{s}'" for s in SLOTS)
    return f"size(filter(slice({shape}, {start} + 1, {size}), w -> w NOT IN ({slots})))"


def item_pieces(benchmark: DataFrame, window: int, coverage: float) -> DataFrame:
    """item_id, kind, width, at, hash, item_windows, needed: the pieces of every item, and how many a leak must share."""
    items = benchmark.select("item_id", text_of("text").alias("_t")).filter("item_id IS NOT NULL")
    items = canonical(items, F.col("_t")).drop("_t").filter("shape[0] != ''")
    items = items.withColumn("n", F.size("shape")).withColumn("width", F.least(F.lit(window), "n"))
    places = "sequence(0, n - width)"
    items = items.withColumn(f"at_{TEMPLATE}", F.expr(f"filter({places}, i -> {literals('shape', 'i', 'width')} >= {LITERALS})"))
    items = items.withColumn(f"at_{WORDS}", F.expr(f"CASE WHEN n >= {FEWEST_WORDS} THEN {places} ELSE array() END"))
    weak = f"size(at_{TEMPLATE}) = 0 AND n >= {FEWEST_WORDS} AND {literals('shape', '0', 'n')} > 0"
    items = items.withColumn(f"at_{SENTENCE}", F.expr(f"CASE WHEN {weak} THEN sequence(0, size(sentences) - 1) ELSE array() END"))
    items = settle(items.withColumn(f"at_{WHOLE}", F.expr(f"CASE WHEN n < {FEWEST_WORDS} THEN array(0) ELSE array() END")), "items")
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # at most ``window`` values
    parts = [
        items.filter(f"width = {width}").select("*", F.lit(kind).alias("kind"), F.expr(windows(source, width, kind)).alias("hashes"))
        for kind, source in ((TEMPLATE, "shape"), (WORDS, "words"))
        for width in widths
    ]
    parts += [items.select("*", F.lit(kind).alias("kind"), F.expr(value).alias("hashes")) for kind, value in OTHER_PIECES.items()]
    found = []
    for part, kind in zip(parts, [TEMPLATE] * len(widths) + [WORDS] * len(widths) + list(OTHER_PIECES)):
        needed = {SENTENCE: f"size(at_{SENTENCE})", WHOLE: "1"}.get(kind, f"{coverage} * size(at_{kind})")
        wide = "width" if kind in (TEMPLATE, WORDS) else "0 AS width"
        found.append(
            part.withColumn("at", F.explode(f"at_{kind}")).selectExpr(
                "item_id", "kind", wide, "at", "hashes[at] AS hash", f"size(at_{kind}) AS item_windows", f"cast({needed} AS double) AS needed"
            )
        )
    return reduce(DataFrame.unionByName, found)


def alignments(docs: DataFrame, benchmark: DataFrame, window: int, coverage: float) -> DataFrame:
    """id, text_key, item_id, kind, shift, hits, item_windows: alignments of rows with items that share enough pieces."""
    pieces = settle(item_pieces(benchmark, window, coverage), "pieces")
    used = {(r["kind"], r["width"]) for r in pieces.select("kind", "width").distinct().collect()}  # at most two a width, and two
    rows = canonical(docs, F.col("text"), (SENTENCE, 0) in used).drop("text").withColumn("n", F.size("words"))
    # all pieces of a row come from one pass over its text, one kind after the other
    hashes, begins = [], []
    for kind, width in sorted(used):
        source = {TEMPLATE: "shape", WORDS: "words"}.get(kind)
        hashes.append(windows(source, width, kind) if source else OTHER_PIECES[kind])
        begins.append((kind, width, f"greatest(0, n - {width - 1})" if source else "m" if kind == SENTENCE else "1"))
    rows = rows.withColumn("m", F.size("sentences") if (SENTENCE, 0) in used else F.lit(0))
    every = f"concat({', '.join(hashes)})" if hashes else "cast(array() AS array<bigint>)"
    seen = rows.select("id", "text_key", "n", "m", F.posexplode(F.expr(every)).alias("at", "hash"))
    if pieces.count() <= BROADCAST_PIECES:
        pieces = F.broadcast(pieces)
    met = seen.join(pieces.withColumnRenamed("at", "item_at"), "hash")
    before = [
        f"WHEN kind = '{kind}' AND width = {width} THEN {' + '.join(['0', *(size for *_, size in begins[:k])])}"
        for k, (kind, width, _) in enumerate(begins)
    ]
    met = met.withColumn("at", F.expr(f"at - CASE {' '.join(before)} END") if before else F.col("at"))
    # pieces of one alignment: at most as many as the item has
    found = met.groupBy("id", "text_key", "item_id", "kind", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.size(F.collect_set("item_at")).alias("hits"), F.max("item_windows").alias("item_windows"), F.max("needed").alias("needed")
    )
    return found.filter("hits >= needed").drop("needed")


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, coverage: float = COVERAGE
) -> DataFrame:
    """Rows that hold a benchmark item: id, text_key, item_id, kind, hits, item_windows, slots, conflicts, changed.

    A row leaks an item (item_id, text) by one of four kinds of pieces, of which the first that fits is given:

    * template: one alignment shares ``coverage`` of the item's template windows that have LITERALS ordinary words;
    * words: the same for windows of the words themselves, whatever their case, for items of FEWEST_WORDS words or more;
    * sentence: the row has all sentences of the item one after the other, as templates with an ordinary word; asked only
      of items without a window of the first kind, so a short question with other numbers is found where it is a
      sentence, not inside one;
    * whole: an item of fewer than FEWEST_WORDS words is all the row has.

    At most CONFLICTS of the slot pairs may contradict another. Of several alignments the one with most pieces is given
    (ties: the first). changed tells items whose slots hold other values. Items of fewer words than ``window`` are one
    window. Rows that are null, empty or without words leak nothing; rows of equal id and text appear once; null ids stay.
    Empty tables give no rows. Words of any length are read in linear time.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("text_key", F.xxhash64("text"))
    found = settle(alignments(rows, benchmark, window, coverage), "alignments")

    item_text = benchmark.select("item_id", text_of("text").alias("_t")).filter("item_id IS NOT NULL")
    item_words = canonical(item_text, F.col("_t")).select("item_id", F.col("words").alias("item_words"), F.col("shape").alias("item_shape"))
    wanted = found.select("id", "text_key").distinct()
    same = rows["id"].eqNullSafe(wanted["id"]) & (rows["text_key"] == wanted["text_key"])
    texts = rows.join(wanted, same, "left_semi").dropDuplicates(["id", "text_key"])
    texts = canonical(texts, F.col("text")).drop("text")
    same = found["id"].eqNullSafe(texts["id"]) & (found["text_key"] == texts["text_key"])
    aligned = found.join(texts, same).drop(texts["id"], texts["text_key"]).join(item_words, "item_id")
    # an alignment of sentences begins after the words of the sentences before
    before = "aggregate(slice(sentences, 1, greatest(shift, 0)), 0, (t, s) -> t + size(split(s, ' ')))"
    aligned = aligned.withColumn("begin", F.expr(f"CASE WHEN kind = '{SENTENCE}' THEN {before} ELSE shift END"))
    # words of the item at position k + 1 face words of the row at begin + k + 1; only equal placeholders are compared
    slots = ", ".join(f"'{s}'" for s in SLOTS)
    pairs = F.expr(
        f"CASE WHEN kind IN ('{TEMPLATE}', '{SENTENCE}') THEN"
        " transform(filter(sequence(0, size(item_words) - 1), k -> begin + k >= 0 AND begin + k < size(words)"
        f" AND item_shape[k] IN ({slots}) AND item_shape[k] = shape[begin + k]),"
        " k -> struct(item_words[k] AS a, words[begin + k] AS b)) ELSE array() END"
    )
    aligned = aligned.withColumn("pairs", F.array_distinct(pairs)).select(
        "id", "text_key", "item_id", "kind", "shift", "hits", "item_windows",
        F.size("pairs").alias("slots"),
        F.expr("2 * size(pairs) - size(array_distinct(pairs.a)) - size(array_distinct(pairs.b))").alias("conflicts"),
        F.expr("exists(pairs, p -> p.a != p.b)").alias("changed"),
    )
    kept = aligned.filter(F.col("conflicts") <= CONFLICTS * F.col("slots"))
    names = ", ".join(f"'{k}'" for k in KINDS)
    first = F.expr(f"-array_position(array({names}), kind)").alias("first")
    best = F.max(F.struct(first, "hits", (-F.col("shift")).alias("early"), "kind", "item_windows", "slots", "conflicts", "changed")).alias("best")
    kept = kept.groupBy("id", "text_key", "item_id").agg(best)
    return kept.select(
        F.col("id").alias(id_col), "text_key", "item_id",
        *(F.col(f"best.{c}").alias(c) for c in ("kind", "hits", "item_windows", "slots", "conflicts", "changed")),
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    key = spare(docs, "key")
    bad = leaks(docs.select(id_col, text_col), benchmark, id_col, text_col, **options)
    bad = bad.select(F.col(id_col).alias("bad_id"), F.col("text_key").alias("bad_key")).distinct()
    keyed = docs.withColumn(key, F.xxhash64(text_of(text_col)))
    return keyed.alias("d").join(bad.alias("b"), F.expr(f"d.`{id_col}` <=> b.bad_id AND d.`{key}` = b.bad_key"), "left_anti").drop(key)
