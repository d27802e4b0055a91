"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Every source's documents, shuffled by a hash, are laid end to end. The mix is a sequence of slots. Slot ``k`` looks up the
golden-ratio point ``frac(k * phi)`` in the cumulative weights, which names its source. The words that the target asks of a
source are cut into as many equal blocks as it has slots, around again after its last word; the slot's rank within its
source names its block. So every source meets its target to the word, small ones by small blocks, and any prefix of
the schedule is near the target shares.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packetloom.llm.common import spare, word_count
from packetloom.session import settle

#: The fractional part of the golden ratio.
GOLDEN = 0.6180339887498949
#: Slots of a schedule, shared by targets, and about so many more for every source, however small its target.
SLOTS = 1 << 17
SLOTS_PER_SOURCE = 64
#: Rows of a source that meet in one window, about.
CELL_ROWS = 1_000_000
#: A target is at most so many times the size of its source.
MOST_REPEATS = 3
WEIGHTS = (1, 2, 3)


@dataclass(frozen=True)
class Mix:
    """sources: one row each with size and target; schedule: source, rank and words of every slot; documents: place and use."""

    sources: DataFrame
    schedule: DataFrame
    documents: DataFrame


def source_targets(sizes: DataFrame, most: int = MOST_REPEATS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_rank, source_size, target of every source, from (source, source_size).

    Weights repeat over the sources by code point, null last. A target stops at ``most`` times the source's size and the
    excess is shared again by weight until none is above: the stopped sources are those with the smallest caps per
    weight, so one pass in that order finds the level. The windows run over one row per source.
    """
    ranked = sizes.withColumn("source_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumns({"weight": weight.cast("long"), "cap": F.col("source_size") * most})
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "source_rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = ranked.withColumns(
        {
            "total": F.sum("source_size").over(everything),
            "capped_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weight_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    left = F.col("total") - F.col("capped_before")
    stopped = (F.col("cap") * F.col("weight_left") <= F.col("weight") * left).cast("int")
    # stopped sources are a prefix of the order: all rows up to the first that is not
    prefix = by_level.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = ranked.withColumns({"left": left, "stopped": F.min(stopped).over(prefix)})
    open_row = F.col("stopped") == 0
    ranked = ranked.withColumns(
        {
            "level_left": F.max(F.when(open_row, F.col("left"))).over(everything),
            "level_weight": F.max(F.when(open_row, F.col("weight_left"))).over(everything),
        }
    )
    shared = F.col("weight") * F.col("level_left") / F.col("level_weight")
    target = F.when(F.col("stopped") == 1, F.col("cap").cast("double")).otherwise(shared)
    return ranked.select("source", F.col("source_rank").cast("int"), "source_size", target.alias("target"))


def golden_schedule(spark: SparkSession, sources: DataFrame, slots: int) -> DataFrame:
    """slot, source_rank, rank, slots, wanted, begins, ends: the source of every slot and the words it takes of it.

    ``begins`` and ``ends`` count the words of the shuffled source, around again after its last one, up to ``wanted`` words.
    The weight of a source is its target and a small part for being one. The table of sources is joined to slots by cells
    of the unit interval, each of which lists the sources whose ranges meet it, so there is no pairing of slots and sources.
    """
    wanted = F.round("target").cast("long")
    steps = sources.filter("source_size > 0").select("source_rank", wanted.alias("wanted")).filter("wanted > 0")
    every = Window.partitionBy()
    total = F.sum("wanted").over(every)
    weight = F.least(F.lit(slots), total) * (F.col("wanted") / total) + SLOTS_PER_SOURCE
    steps = steps.withColumn("weight", F.greatest(F.lit(1), F.round(weight)).cast("long"))
    edge = F.sum("weight").over(Window.orderBy("source_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    steps = settle(steps.withColumns({"edge": edge, "last": F.sum("weight").over(every)}), "mix-edges")
    first = steps.select("last").first()
    # as many cells as slots, so that a cell meets few sources however many there are
    cells = first["last"] if first else 1
    low = (F.col("edge") - F.col("weight")).alias("low")
    # weights are whole numbers that add up to the cells: a cell belongs to one source
    owned = steps.select("source_rank", "wanted", low, (F.col("edge") - 1).alias("high"))
    owned = owned.withColumn("cell", F.explode(F.sequence("low", "high"))).select("source_rank", "wanted", "cell")
    point = F.pmod(F.col("slot") * F.lit(GOLDEN), F.lit(1.0))
    named = spark.range(cells if first else 0).withColumnRenamed("id", "slot")
    named = named.withColumn("cell", F.least(F.lit(cells - 1), F.floor(point * cells)).cast("long")).join(owned, "cell")
    of_source = Window.partitionBy("source_rank")
    named = named.withColumns({"rank": F.row_number().over(of_source.orderBy("slot")).cast("long") - 1, "slots": F.count(F.lit(1)).over(of_source)})
    border = "CAST(({0}) * CAST(wanted AS DECIMAL(20, 0)) div slots AS BIGINT)"
    return named.selectExpr(
        "slot", "source_rank", "rank", "slots", "wanted", f"{border.format('rank')} AS begins", f"{border.format('rank + 1')} AS ends"
    )


#: Rank of the slot that takes the word with this number, the inverse of the borders of ``golden_schedule``.
RANK_OF_WORD = "CAST(((word + 1) * CAST(slots AS DECIMAL(20, 0)) - 1) div wanted AS BIGINT)"


def row_key(key: str | Column, source: str | Column) -> Column:
    """Tells apart rows of equal id and text in different sources."""
    named = F.concat(F.lit("="), F.col(source) if isinstance(source, str) else source)
    return F.concat_ws("|", key, F.coalesce(named, F.lit("")))


def shuffled_places(docs: DataFrame, key: Column, rows: int) -> DataFrame:
    """``docs`` with begins: words of the source before the document, in the order of the hash ``key``.

    A source may hold most rows, so its order is cut into cells by the leading digits of the hash, more of them the more
    ``rows`` there are; totals of the cells are summed up first and only rows of one cell meet in a window.
    """
    digits = 3
    while 16**digits * CELL_ROWS < rows:
        digits += 1
    keyed = docs.withColumn("_key", key).withColumn("_cell", F.substring("_key", 1, digits))
    totals = keyed.groupBy("source_rank", "_cell").agg(F.sum("size").alias("_sum"))
    ahead = Window.partitionBy("source_rank").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("source_rank", "_cell", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"))
    within = Window.partitionBy("source_rank", "_cell").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    inside = keyed.withColumn("_inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = inside.join(totals, ["source_rank", "_cell"])
    return placed.withColumn("begins", F.col("_ahead") + F.col("_inside")).drop("_ahead", "_inside", "_cell", "_key")


def shuffle_key(id_col: str, text_col: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.col(text_col)))


def placed_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """Sources with their targets, and the rows (without text) with their place in their source."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        shuffle_key(id_col, text_col, seed).alias("key"),
        word_count(text_col).alias("size"),
    )
    rows = settle(rows, "mix-rows")  # narrow: the texts are read once
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = settle(source_targets(sizes), "mix-sources")
    named = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    return sources, shuffled_places(named, F.col("key"), rows.count())


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 7,
    slots: int = SLOTS,
) -> Mix:
    """Plan the mix of all ``docs``.

    documents: doc_id, key, size, source_rank, source_size, target, begins and taken (words the mix takes of the document).
    Each source has its rounded target taken; a document has at most MOST_REPEATS times its size taken. A null text has
    size 0 and nothing taken; a null source is a source of its own, ordered last. Repeated ids are separate rows; equal
    rows may swap places. An empty table gives an empty mix.
    """
    sources, placed = placed_rows(docs, id_col, text_col, source_col, seed)
    schedule = settle(golden_schedule(docs.sparkSession, sources, slots), "mix-schedule")
    # the slots of a source take its words one after the other, so what they take of a document follows from their sum
    used = schedule.groupBy("source_rank").agg(F.sum(F.col("ends") - F.col("begins")).alias("used"))
    # one row per source
    placed = placed.join(used, "source_rank", "left").withColumn("used", F.coalesce("used", F.lit(0)))
    taken = F.expr(
        "CASE WHEN size > 0 THEN (used div source_size) * size + greatest(0, least(begins + size, used % source_size) - begins) ELSE 0 END"
    )
    documents = placed.select("doc_id", "key", "size", "source", "source_rank", "source_size", "target", "begins", taken.cast("long").alias("taken"))
    return Mix(sources, schedule, documents)


def document_slots(mix: Mix) -> DataFrame:
    """key, slot, word: every use of a whole document in the mix, by the slot that takes its first word.

    ``word`` is the number of that word in the scheduled words of the source, which orders the documents of a slot. A
    document is used whole as often as its first word is taken, so a source meets its target but for a part of one document.
    """
    per_source = mix.schedule.select("source_rank", "slots", "wanted").distinct()
    uses = mix.documents.filter("size > 0").join(per_source, "source_rank")
    rounds = F.sequence(F.lit(0), F.lit(MOST_REPEATS - 1))
    uses = uses.withColumn("word", F.explode(F.transform(rounds, lambda k: F.col("begins") + k * F.col("source_size"))))
    uses = uses.filter("word < wanted").withColumn("rank", F.expr(RANK_OF_WORD))
    uses = uses.join(mix.schedule.select("source_rank", "rank", "slot"), ["source_rank", "rank"])
    return uses.select(row_key("key", "source").alias("key"), "slot", "word")


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7, slots: int = SLOTS
) -> DataFrame:
    """``docs`` as a mix of whole documents uses them, in the order of the schedule.

    Rows of equal id, text and source are interchangeable: one of them stands for all, as often as all are used.
    """
    key, first, slot, word = (spare(docs, name) for name in ("key", "first", "slot", "word"))
    plan = document_slots(mix_sources(docs.select(id_col, text_col, source_col), id_col, text_col, source_col, seed, slots))
    plan = plan.select(F.col("key").alias(key), F.col("slot").alias(slot), F.col("word").alias(word))
    keyed = docs.withColumn(key, row_key(shuffle_key(id_col, text_col, seed), source_col))
    # a task sends one row of a key on, however often it has it
    one = keyed.withColumn(first, F.row_number().over(Window.partitionBy(key).orderBy(id_col))).filter(F.col(first) == 1)
    taken = one.join(plan, key)
    return taken.repartitionByRange(slot, word).sortWithinPartitions(slot, word).select(*(F.col(f"`{c}`") for c in docs.columns))
