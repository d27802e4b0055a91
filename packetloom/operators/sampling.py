"""Training-set building: weights, samples, splits and the mixed retraining set.

Randomness is a hash of the row key, so the same rows are drawn on every run and after every task retry. Keys must
identify rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetloom.functions.hashing import hash_uniform
from packetloom.operators.ordering import few, smallest
from packetloom.schemas import NORMAL_NAMES, column_or
from packetloom.session import settle

# Sampling policy.
MAX_SAMPLES = 100_000
RATIOS = {"benchmark": 0.5, "local_normal": 0.3, "local_attack": 0.2}
MIN_PER_ATTACK = 100
DECAY_PER_DAY = 0.1
PRIORITY = {"VERIFIED": 2.0, "HUMAN_REVIEW_NEEDED": 3.0}
WEIGHT_FLOOR = 0.001
MIN_PSEUDO_CONFIDENCE = 0.9
OUTLIER_Z = 4.0
OUTLIER_COLUMNS = ("duration", "pkts_total", "bytes_total")
OUTLIER_MIN_ROWS = 100
LOCAL_SOURCES = ("local_normal", "local_attack")
HOLDOUT_MIN_ROWS = 50

RANK_CELLS = 1024
CELL_ROWS = 5_000_000


def sample_weight(
    df: DataFrame,
    now: float | Column,
    decay: float = DECAY_PER_DAY,
    priority: Mapping[str, float] = PRIORITY,
    time_col: str = "__timestamp",
) -> Column:
    """exp(-decay * age in days) times the review priority, never below the floor. ``now`` is epoch seconds."""
    now = F.lit(now) if isinstance(now, (int, float)) else now
    weight = F.lit(1.0)
    if time_col in df.columns:
        age = (now - F.col(time_col)) / F.lit(86400.0)
        weight = F.when(age > 0, F.exp(F.lit(-decay) * age)).otherwise(F.lit(1.0))
    status = column_or(df, "label_status", "UNLABELED", "string")
    factor = F.lit(1.0)
    for name, value in priority.items():
        factor = F.when(status == name, F.lit(value)).otherwise(factor)
    return F.greatest(weight * factor, F.lit(WEIGHT_FLOOR))


def drop_weak_pseudo_labels(df: DataFrame, min_confidence: float = MIN_PSEUDO_CONFIDENCE) -> DataFrame:
    """Drop machine labels whose score is too low; without the two columns nothing is dropped."""
    if not {"label_status", "model_score"} <= set(df.columns):
        return df
    weak = (F.col("label_status") == "PSEUDO_LABELED") & (F.col("model_score") < F.lit(min_confidence))
    return df.where(~F.coalesce(weak, F.lit(False)))


def drop_outliers(
    df: DataFrame,
    columns: Sequence[str] = OUTLIER_COLUMNS,
    z_limit: float = OUTLIER_Z,
    min_rows: int = OUTLIER_MIN_ROWS,
) -> DataFrame:
    """Remove local rows beyond ``z_limit`` sample deviations, column after column.

    Each column is judged by the rows that survived the ones before, so there is one aggregate per column; it reads
    only the checked columns and returns three numbers. NULL and NaN have no deviation: they stay and do not count.
    """
    kept = df
    local = F.col("source_type").isin(*LOCAL_SOURCES)
    for c in [c for c in columns if c in df.columns]:
        value = F.col(c).cast("double")
        x = F.when(local & ~F.isnan(value), value)
        stats = kept.agg(F.count_if(local).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std")).first()
        if stats["n"] > min_rows and stats["std"] is not None and stats["std"] > 0:
            z = F.abs((x - F.lit(stats["mean"])) / F.lit(stats["std"]))
            kept = kept.where(~F.coalesce(local & (z > F.lit(z_limit)), F.lit(False)))
    return kept


def sanitize(df: DataFrame) -> DataFrame:
    tagged = df if "source_type" in df.columns else df.withColumn("source_type", F.lit("unknown"))
    return drop_outliers(drop_weak_pseudo_labels(tagged))


def uniform_sample(df: DataFrame, key: Sequence[str], n: int, salt: str = "uniform", **how) -> DataFrame:
    """``n`` rows without replacement (``how``: limits of ``smallest``)."""
    return smallest(df, hash_uniform([F.col(k) for k in key], salt), key, n, **how)


def weighted_sample(
    df: DataFrame, key: Sequence[str], weight: Column, n: int, salt: str = "weighted", **how
) -> DataFrame:
    """``n`` rows without replacement, heavier rows more likely (exponential keys, Efraimidis and Spirakis 2006)."""
    u = hash_uniform([F.col(k) for k in key], salt)
    return smallest(df, -F.ln(u) / weight, key, n, **how)


def weighted_sample_with_replacement(
    df: DataFrame, key: Sequence[str], weight: Column, n: int, salt: str = "replace", cells: int = RANK_CELLS
) -> DataFrame:
    """``n`` draws with replacement, numbered by ``__draw``.

    Rows in hash order own consecutive intervals of the total weight, and draw j falls into one of them. The running sum
    is taken per hash cell, with the totals of the cells before added. Intervals and draws meet in equal pieces of the
    weight axis, so the lookup is an equi-join; a heavy row covers many pieces instead of collecting all draws.
    """
    weighted = df.withColumns({"__w": weight, "__u": hash_uniform([F.col(k) for k in key], f"{salt}-order")})
    placed = weighted.withColumn("__cell", F.floor(F.col("__u") * cells).cast("int"))
    total = placed.agg(F.sum("__w").alias("t")).first()["t"]
    if not total:
        return df.limit(0).withColumn("__draw", F.lit(0).cast("bigint"))
    earlier = Window.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    # one row per cell
    offsets = placed.groupBy("__cell").agg(F.sum("__w").alias("__sum")).select(
        "__cell", F.coalesce(F.sum("__sum").over(earlier), F.lit(0.0)).alias("__offset")
    )
    upto = Window.partitionBy("__cell").orderBy("__u", *key).rowsBetween(Window.unboundedPreceding, 0)
    ends = placed.withColumn("__inner", F.sum("__w").over(upto)).join(F.broadcast(offsets), "__cell")
    owned = ends.withColumn("__end", F.col("__inner") + F.col("__offset")).withColumn("__start", F.col("__end") - F.col("__w"))

    pieces = max(1, min(n, 1 << 20))

    def piece(position: Column) -> Column:
        return F.least(F.floor(position / F.lit(total) * F.lit(float(pieces))), F.lit(pieces)).cast("int")

    covered = owned.withColumn("__piece", F.explode(F.sequence(piece(F.col("__start")), piece(F.col("__end")))))
    draws = df.sparkSession.range(1, n + 1).select(
        F.col("id").alias("__draw"), (hash_uniform(F.col("id"), salt) * F.lit(total)).alias("__at")
    )
    inside = (F.col("__at") >= F.col("__start")) & (F.col("__at") < F.col("__end"))
    return (
        covered.join(draws.withColumn("__piece", piece(F.col("__at"))), "__piece").where(inside).select(*df.columns, "__draw")
    )


def oversample_small_classes(
    df: DataFrame, class_col: str, key: Sequence[str], least: int = MIN_PER_ATTACK, salt: str = "oversample"
) -> DataFrame:
    """Classes below ``least`` rows are replaced by ``least`` draws with replacement; larger ones are kept whole.

    Adds ``__draw`` (0: an original row). Rows of the class NULL are dropped. Only rows of small classes are ranked, and a
    small class has fewer than ``least`` rows, so no task holds a large class. The list of small classes is broadcast, so
    the large ones do not move.
    """
    counts = df.where(F.col(class_col).isNotNull()).groupBy(class_col).agg(F.count(F.lit(1)).alias("__n"))
    small = settle(counts.where(F.col("__n") < least), "small-classes")
    names = few(small.select(class_col))
    whole = (
        df.where(F.col(class_col).isNotNull())
        .join(names, class_col, "left_anti")
        .withColumn("__draw", F.lit(0).cast("bigint"))
    )
    order = Window.partitionBy(class_col).orderBy(*key)
    ranked = df.join(names, class_col, "left_semi").withColumn("__rank", F.row_number().over(order))
    draws = small.withColumn("__draw", F.explode(F.sequence(F.lit(1), F.lit(least)))).select(
        class_col,
        F.col("__draw").cast("bigint").alias("__draw"),
        (
            F.floor(hash_uniform([F.col(class_col), F.col("__draw")], salt) * F.col("__n")).cast("int") + F.lit(1)
        ).alias("__rank"),
    )
    drawn = draws.join(ranked, [class_col, "__rank"]).select(*df.columns, "__draw")
    return whole.select(*df.columns, "__draw").unionByName(drawn)


def stratified_split(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    test_share: float = 0.2,
    salt: str = "split",
    cells: int = RANK_CELLS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Add ``is_test``: in every class the ``round(share * n)`` rows with the smallest hash are test rows.

    The border row of each class is found by counting per class and hash cell (a hash spreads a hot class evenly),
    picking the cell that holds the border, and ranking only the rows of that cell; a very large table gets a second,
    finer round of cells first. All rows are then compared with the border of their class, so no class is sorted as a whole.
    """
    u = hash_uniform([F.col(k) for k in key], salt)
    marked = df.where(F.col(label).isNotNull()).withColumn("__u", u)
    keyed = marked.select(label, *key, "__u")
    sizes = keyed.groupBy(label, F.floor(F.col("__u") * cells).cast("int").alias("__cell")).agg(
        F.count(F.lit(1)).alias("n")
    )
    total = F.sum("n").over(Window.partitionBy(label))
    wanted = sizes.withColumn("__nth", F.floor(total * test_share + 0.5))
    # one row per class, read by the size check and by the join
    border = settle(_border_cells(wanted, [label]), "border-cells")
    held = keyed.withColumn("__cell", F.floor(F.col("__u") * cells).cast("int")).join(few(border), [label, "__cell"])
    groups = [label, "__cell"]
    if marked.count() > cells * cell_rows:
        finer = held.withColumnRenamed("__cell", "__coarse").withColumn(
            "__cell", F.floor(F.col("__u") * (cells * cells)).cast("int")
        )
        sizes = finer.groupBy(label, "__cell").agg(F.count(F.lit(1)).alias("n"), F.first("__nth").alias("__nth"))
        held = finer.drop("__nth").join(few(_border_cells(sizes, [label])), groups)
    in_cell = Window.partitionBy(*groups).orderBy("__u", *key)
    rank = F.row_number().over(in_cell)
    last_test = settle(
        held.withColumn("__rank", rank)
        .where(F.col("__rank") == F.col("__nth"))
        .select(F.col(label).alias("__class"), F.struct("__u", *key).alias("__border")),
        "borders",
    )
    at_or_before = F.coalesce(F.struct("__u", *key) <= F.col("__border"), F.lit(False))
    return (
        marked.join(few(last_test), F.col(label) == F.col("__class"), "left")
        .withColumn("is_test", at_or_before)
        .drop("__u", "__class", "__border")
    )


def _border_cells(sizes: DataFrame, group: list[str]) -> DataFrame:
    """Per group the cell that holds the ``__nth`` row, with the position inside that cell as the new ``__nth``.

    ``sizes`` has one row per group and cell, so a window over a group is short.
    """
    upto = Window.partitionBy(*group).orderBy("__cell").rowsBetween(Window.unboundedPreceding, 0)
    reached = sizes.withColumn("__reached", F.sum("n").over(upto))
    holds = (F.col("__reached") >= F.col("__nth")) & (F.col("__reached") - F.col("n") < F.col("__nth"))
    inside = F.col("__nth") - F.col("__reached") + F.col("n")
    return reached.where(holds).select(*group, "__cell", inside.alias("__nth"))


def fraction_split(df: DataFrame, key: Sequence[str], share: float = 0.2, salt: str = "fraction") -> tuple[DataFrame, DataFrame]:
    """(sample, complement) by the hash of the key: no shuffle, no count."""
    u = hash_uniform([F.col(k) for k in key], salt)
    return df.where(u < share), df.where(u >= share)


@dataclass
class ZeroDaySplit:
    """``held_out_class`` is NULL (None) when fewer than two attack classes qualify."""

    train: DataFrame
    held_out: DataFrame
    held_out_class: str | None
    report: DataFrame = field(repr=False)


def holdout_candidates(df: DataFrame, class_col: str, min_rows: int = HOLDOUT_MIN_ROWS) -> DataFrame:
    """Attack classes with more than ``min_rows`` rows."""
    named = F.lower(F.col(class_col).cast("string"))
    return (
        df.where(~named.isin(*NORMAL_NAMES, "0"))
        .groupBy(F.col(class_col).cast("string").alias("class"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > min_rows)
    )


def rarest_class(candidates: DataFrame) -> DataFrame:
    return candidates.agg(
        F.count(F.lit(1)).alias("candidates"), F.min_by("class", F.struct("n", "class")).alias("rarest")
    )


def zero_day_split(df: DataFrame, min_rows: int = HOLDOUT_MIN_ROWS) -> ZeroDaySplit:
    """Hold out the rarest qualifying attack class, if at least two classes qualify.

    Uses ``attack_type``, else a text ``label``; a numeric label cannot name attack classes.
    """
    class_col = "attack_type" if "attack_type" in df.columns else "label"
    held = None
    if dict(df.dtypes)[class_col] == "string":
        found = rarest_class(holdout_candidates(df, class_col, min_rows)).first()
        held = found["rarest"] if found["candidates"] >= 2 else None
    is_held = F.coalesce(F.col(class_col).cast("string") == F.lit(held), F.lit(False)) if held else F.lit(False)
    report = df.agg(
        F.count_if(~is_held).alias("train_size"),
        F.lit(held).cast("string").alias("zero_day_holdout"),
        F.count_if(is_held).alias("zero_day_size"),
    )
    return ZeroDaySplit(df.where(~is_held), df.where(is_held), held, report)


def composition(df: DataFrame, label: str = "label", source: str = "source_type") -> DataFrame:
    return df.groupBy(source, label).agg(F.count(F.lit(1)).alias("count"))


def build_retrain_set(
    benchmark: DataFrame,
    normal: DataFrame,
    attack: DataFrame,
    key: Sequence[str],
    now: float,
    max_samples: int = MAX_SAMPLES,
    ratios: Mapping[str, float] = RATIOS,
    min_per_attack: int = MIN_PER_ATTACK,
    max_new_ratio: float | None = None,
) -> DataFrame:
    """Sanitised, weighted and mixed training set; keeps ``source_type`` and ``__draw`` for reports.

    The pools are tagged here. ``max_new_ratio`` optionally bounds the share of non-benchmark rows by shrinking their
    targets.
    """
    targets = {source: int(max_samples * ratios[source]) for source in RATIOS}
    if max_new_ratio is not None:
        new = targets["local_normal"] + targets["local_attack"]
        allowed = int(max_new_ratio * sum(targets.values()))
        if new > allowed:
            targets["local_normal"] = targets["local_normal"] * allowed // new
            targets["local_attack"] = targets["local_attack"] * allowed // new
    # a pool is read once: what cleans and samples it reads stored rows
    pools = {"benchmark": benchmark, "local_normal": normal, "local_attack": attack}
    tagged = {source: settle(rows.withColumn("source_type", F.lit(source)), f"pool-{source}") for source, rows in pools.items()}
    tagged = {source: rows if source == "benchmark" else sanitize(rows) for source, rows in tagged.items()}
    no_draw = F.lit(0).cast("bigint")
    bench = uniform_sample(tagged["benchmark"], key, targets["benchmark"]).withColumn("__draw", no_draw)
    pool = tagged["local_normal"]
    normals = weighted_sample(pool, key, sample_weight(pool, now), targets["local_normal"]).withColumn("__draw", no_draw)
    pool = tagged["local_attack"]
    class_col = next((c for c in ("label", "attack_type") if c in pool.columns), None)
    if class_col:
        filled = oversample_small_classes(pool, class_col, key, min_per_attack)
        attacks = weighted_sample(filled, [*key, "__draw"], sample_weight(filled, now), targets["local_attack"])
    elif pool.limit(targets["local_attack"]).count() < targets["local_attack"]:
        attacks = weighted_sample_with_replacement(pool, key, sample_weight(pool, now), targets["local_attack"])
    else:
        attacks = weighted_sample(pool, key, sample_weight(pool, now), targets["local_attack"]).withColumn("__draw", no_draw)
    return bench.unionByName(normals, allowMissingColumns=True).unionByName(attacks, allowMissingColumns=True)


def finish_retrain_set(mixed: DataFrame) -> DataFrame:
    """The training rows without the helper columns."""
    return mixed.drop("__timestamp", "source_type", "__draw")
