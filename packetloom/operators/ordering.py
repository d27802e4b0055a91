"""Global-order computations that never put one group, or the whole table, into one task.

Three building blocks:

* ``slice_bounds`` / ``with_slice`` cut an ordered column into slices of about equal row counts, so that
  a window partitioned by ``(key, slice)`` stays small even when one key holds most of the table;
* ``running_totals`` gives exact prefix sums over a global order;
* ``exact_quantiles`` finds order statistics by narrowing a bracket, without sorting or shuffling rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from packetloom.session import settle

SLICE = "__slice"
SLICE_ROWS = 8_000_000
TOTAL_ROWS = 1_000_000
MAX_SLICES = 8192
SKETCH_ACCURACY = 20_000
EXACT_VALUES = 1_000_000
TOP_K_ROWS = 1_000
MERGE_ROWS = 1_000_000


def slice_bounds(df: DataFrame, order: Column, slice_rows: int = SLICE_ROWS) -> list[float]:
    """Inner borders that cut ``order`` into slices of about ``slice_rows`` rows (empty list: one slice)."""
    return slice_scan(df, order, {}, slice_rows)[0]


def slice_scan(
    df: DataFrame, order: Column, extra: Mapping[str, Column], slice_rows: int = SLICE_ROWS
) -> tuple[list[float], Row]:
    """Slice borders together with other aggregates of the same pass.

    At most ``MAX_SLICES`` numbers reach the driver.
    """
    # the grid is one foldable text literal: thousands of separate literals would be slow to plan
    grid = F.expr(f"cast(split('{','.join(repr(i / MAX_SLICES) for i in range(1, MAX_SLICES))}', ',') as array<double>)")
    value = order.cast("double")
    row = df.agg(
        F.count(value).alias("n"),
        F.percentile_approx(value, grid, F.lit(SKETCH_ACCURACY)).alias("grid"),
        *[total.alias(name) for name, total in extra.items()],
    ).first()
    slices = min(MAX_SLICES, math.ceil(row["n"] / slice_rows))
    if slices <= 1:
        return [], row
    step = MAX_SLICES / slices
    picked = {row["grid"][min(MAX_SLICES - 2, round(step * i) - 1)] for i in range(1, slices)}
    return sorted(picked), row


def repeats_heavily(scan: Row) -> bool:
    """Whether one value may fill more than a slice of its own.

    A value with at least two grid steps of the rows shows up twice in the quantile grid of ``slice_scan``.
    """
    return any(a == b for a, b in zip(scan["grid"], scan["grid"][1:]))


def with_slice(df: DataFrame, order: Column, bounds: Sequence[float], name: str = SLICE) -> DataFrame:
    """Add the slice number of ``order``; borders belong to the upper slice."""
    if not bounds:
        return df.withColumn(name, F.lit(0))
    raw, binned = f"{name}_order", f"{name}_bin"
    splits = [-math.inf, *bounds, math.inf]
    bucketizer = Bucketizer(splits=splits, inputCol=raw, outputCol=binned, handleInvalid="keep")
    return (
        bucketizer.transform(df.withColumn(raw, order.cast("double")))
        .withColumn(name, F.col(binned).cast("int"))
        .drop(raw, binned)
    )


def running_totals(
    df: DataFrame,
    value: str,
    sums: Mapping[str, Column],
    slice_rows: int = TOTAL_ROWS,
    bounds: Sequence[float] | None = None,
) -> DataFrame:
    """Per distinct ``value`` (NULL and NaN left out): each sum of ``sums`` and ``<name>_before``, its total over all smaller values.

    Equal values are added up before the shuffle, slices are summed in parallel, and only the totals of the slices
    (at most ``MAX_SLICES`` rows) are accumulated in one place. ``bounds`` are slice borders found before.
    """
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    if bounds is None:
        bounds = slice_bounds(known, F.col(value), slice_rows)
    grouped = known.groupBy(value).agg(*[total.alias(name) for name, total in sums.items()])
    sliced = with_slice(grouped, F.col(value), bounds)
    before = Window.partitionBy(SLICE).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    inner = sliced.withColumns({f"{n}_before": F.coalesce(F.sum(n).over(before), F.lit(0)) for n in sums})
    if not bounds:
        return inner.drop(SLICE)
    lower = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(SLICE)
        .agg(*[F.sum(n).alias(n) for n in sums])
        .select(SLICE, *[F.coalesce(F.sum(n).over(lower), F.lit(0)).alias(f"{n}_offset") for n in sums])
    )
    # offsets has one row per slice: at most MAX_SLICES rows
    joined = inner.join(F.broadcast(offsets), SLICE)
    return joined.select(
        value, *sums, *[(F.col(f"{n}_before") + F.col(f"{n}_offset")).alias(f"{n}_before") for n in sums]
    )


@dataclass
class _Target:
    """One wanted 0-based rank and the open interval of values known to hold it."""

    column: str
    rank: int
    inside: int
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    found: float | None = None

    def held(self, x: Column) -> Column:
        return F.when((x > F.lit(self.low)) & (x < F.lit(self.high)), x)

    def narrow(self, low: float, high: float, under: int, at_low: int, between: int, at_high: int) -> None:
        """Move to the part of the interval that holds the rank, given counts relative to ``low`` and ``high``."""
        position = self.rank - self.below
        if position < under:
            self.high, self.inside = low, under
        elif position < under + at_low:
            self.found = low
        elif position < under + at_low + between:
            self.low, self.high, self.inside = low, high, between
            self.below += under + at_low
        elif position < under + at_low + between + at_high:
            self.found = high
        else:
            passed = under + at_low + between + at_high
            self.low, self.inside = high, self.inside - passed
            self.below += passed


def exact_quantiles(
    df: DataFrame, probabilities: Mapping[str, Sequence[float]], exact_values: int = EXACT_VALUES
) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation; NULL and NaN are skipped, an empty column gives ``None``."""
    return quantile_scan(df, probabilities, {}, exact_values)[0]


def quantile_scan(
    df: DataFrame,
    probabilities: Mapping[str, Sequence[float]],
    extra: Mapping[str, Column],
    exact_values: int = EXACT_VALUES,
) -> tuple[dict[str, list[float | None]], Row]:
    """Exact quantiles, and other aggregates taken in the pass that counts the values.

    Up to ``exact_values`` rows the built-in exact aggregate answers in one pass. Beyond that its value map would
    outgrow a task, so each wanted rank is located by ``order_statistics``.
    """
    names = list(probabilities)
    value = {n: _number(df, n) for n in names}
    counted = df.agg(
        *[F.count(value[n]).alias(f"n{i}") for i, n in enumerate(names)],
        *[total.alias(name) for name, total in extra.items()],
    ).first()
    sizes = {n: counted[f"n{i}"] for i, n in enumerate(names)}
    result: dict[str, list[float | None]] = {n: [None] * len(probabilities[n]) for n in names}

    small = [n for n in names if 0 < sizes[n] <= exact_values]
    for batch in _batches(small, sizes, exact_values):
        row = df.agg(
            *[
                F.percentile(value[n], F.array(*[F.lit(float(p)) for p in probabilities[n]])).alias(f"q{i}")
                for i, n in enumerate(batch)
            ]
        ).first()
        for i, n in enumerate(batch):
            result[n] = list(row[f"q{i}"])

    large = {n: [p * (sizes[n] - 1) for p in probabilities[n]] for n in names if sizes[n] > exact_values}
    if large:
        wanted = {n: sorted({r for x in ranks for r in (math.floor(x), math.ceil(x))}) for n, ranks in large.items()}
        found = order_statistics(df, wanted, sizes, exact_values)
        for n, ranks in large.items():
            lower_upper = [(found[n, math.floor(x)], found[n, math.ceil(x)], x - math.floor(x)) for x in ranks]
            result[n] = [low + (high - low) * part for low, high, part in lower_upper]
    return result, counted


def order_statistics(
    df: DataFrame,
    ranks: Mapping[str, Sequence[int]],
    sizes: Mapping[str, int],
    exact_values: int = EXACT_VALUES,
) -> dict[tuple[str, int], float]:
    """The values at 0-based ``ranks`` of each column (``sizes``: counts without NULL and NaN).

    A quantile sketch proposes an interval for each rank, counting verifies it, and the interval is narrowed until at
    most ``exact_values`` rows lie strictly inside. Every pass is one aggregate over the table: no row is
    shuffled or sampled, and repeated values only add to a count.
    """
    targets = [_Target(n, r, sizes[n]) for n, wanted in ranks.items() for r in wanted]
    value = {n: _number(df, n) for n in ranks}
    budget = max(1, exact_values // max(1, len(targets)))
    margin = 2.0 / SKETCH_ACCURACY
    while wide := [t for t in targets if t.found is None and t.inside > budget]:
        proposed = df.agg(
            *[
                F.percentile_approx(
                    t.held(value[t.column]),
                    [
                        max(0.0, (t.rank - t.below) / t.inside - margin),
                        min(1.0, (t.rank - t.below + 1) / t.inside + margin),
                    ],
                    F.lit(SKETCH_ACCURACY),
                ).alias(f"e{i}")
                for i, t in enumerate(wide)
            ]
        ).first()
        counts = []
        for i, t in enumerate(wide):
            x, (low, high) = t.held(value[t.column]), proposed[f"e{i}"]
            counts += [
                F.count_if(x < low).alias(f"u{i}"),
                F.count_if(x == low).alias(f"l{i}"),
                F.count_if((x > low) & (x < high)).alias(f"m{i}"),
                F.count_if((x == high) & F.lit(high > low)).alias(f"h{i}"),
            ]
        counted = df.agg(*counts).first()
        for i, t in enumerate(wide):
            t.narrow(*proposed[f"e{i}"], *[counted[f"{part}{i}"] for part in "ulmh"])

    rest = [t for t in targets if t.found is None]
    if rest:
        held = df.select(*[t.held(value[t.column]).alias(f"x{i}") for i, t in enumerate(rest)])
        row = held.agg(
            *[
                F.expr(f"percentile_disc({(t.rank - t.below + 0.5) / t.inside!r}D) WITHIN GROUP (ORDER BY x{i})").alias(f"v{i}")
                for i, t in enumerate(rest)
            ]
        ).first()
        for i, t in enumerate(rest):
            t.found = row[f"v{i}"]
    return {(t.column, t.rank): t.found for t in targets}


def few(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """``df`` marked for broadcast where it is counted to have at most ``rows`` rows, else as it is.

    For tables with one row per class or cell that are joined to large tables: without the mark the large table would
    be shuffled by a key that may be hot.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def number_sorted(df: DataFrame, column: str, name: str) -> DataFrame:
    """Every distinct value of ``column`` with its 0-based place in their order; no task sees more than a range of them."""
    values = df.select(column).distinct().repartitionByRange(column).sortWithinPartitions(column)
    placed = settle(values.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftrightunsigned("__at", 33)
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())  # one row per partition
    before, starts = 0, []
    for row in sizes:
        starts.append((row["part"], before - (row["part"] << 33)))
        before += row["count"]
    offsets = F.broadcast(df.sparkSession.createDataFrame(starts, "__part long, __start long"))
    return placed.withColumn("__part", part).join(offsets, "__part").select(column, (F.col("__at") + F.col("__start")).alias(name))


def join_classes(df: DataFrame, table: DataFrame, key: str, table_key: str, hot_share: float = 0.001) -> DataFrame:
    """``df`` left-joined with a table of one row per class, whatever the shares of the classes.

    A short table is broadcast. From a longer one the classes that hold at least ``hot_share`` of the rows, which are at
    most its inverse in number, are broadcast; rows of the others are shuffled by their class.
    """
    short = table.limit(10_001).count() <= 10_000
    if short:
        return df.join(F.broadcast(table), F.col(key) == F.col(table_key), "left")
    counted = df.groupBy(key).count().where(F.col(key).isNotNull())
    least = max(1, math.ceil(df.count() * hot_share))
    hot = counted.where(F.col("count") >= least).select(F.col(key).alias("__hot"))
    frequent = F.broadcast(table.join(F.broadcast(hot), F.col(table_key) == F.col("__hot"), "left_semi"))
    rare = table.join(F.broadcast(hot), F.col(table_key) == F.col("__hot"), "left_anti")
    is_hot = df.join(F.broadcast(hot.withColumn("__is", F.lit(True))), F.col(key) == F.col("__hot"), "left")
    marked = F.coalesce("__is", F.col(key).isNull())
    first = is_hot.where(marked).drop("__is", "__hot").join(frequent, F.col(key) == F.col(table_key), "left")
    rest = is_hot.where(~marked).drop("__is", "__hot").join(rare, F.col(key) == F.col(table_key), "left")
    return first.unionByName(rest)


def smallest(
    df: DataFrame,
    order: Column,
    tie: Sequence[str],
    n: int,
    top_k_rows: int = TOP_K_ROWS,
    merge_rows: int = MERGE_ROWS,
) -> DataFrame:
    """The ``n`` rows with the smallest ``order`` (never NULL), ties by ``tie``; all rows when there are not more.

    A top-k sends up to ``n`` rows of *every* partition to one task. That is fine for a short list only. For a larger
    ``n`` a cut value is found first that about ``n`` rows reach in the whole table, so little more than the result is
    merged; beyond ``merge_rows`` the exact border is located and becomes a filter, and no task merges anything.
    """
    keyed = df.withColumn("__order", order.cast("double"))
    if n <= top_k_rows:
        return keyed.orderBy("__order", *tie).limit(n).drop("__order")
    size = df.count()
    if size <= n:
        return df
    if n > merge_rows:
        border = order_statistics(keyed, {"__order": [n - 1]}, {"__order": size})["__order", n - 1]
        below = keyed.where(F.col("__order") < F.lit(border))
        room = n - below.count()
        at_border = keyed.where(F.col("__order") == F.lit(border)).orderBy(*tie).limit(room)
        return below.unionByName(at_border).drop("__order")
    cut = _cut_above(keyed, n, size, merge_rows)
    near = keyed if cut is None else keyed.where(F.col("__order") <= F.lit(cut))
    return near.orderBy("__order", *tie).limit(n).drop("__order")


def _cut_above(keyed: DataFrame, n: int, size: int, slack: int) -> float | None:
    """A value that at least ``n`` and, unless values repeat heavily, at most ``n + slack`` rows do not exceed."""
    x = F.col("__order")
    cut, reached = None, size
    while reached - n > slack:
        held = x if cut is None else F.when(x <= F.lit(cut), x)
        share = min(1.0, n / reached + 2.0 / SKETCH_ACCURACY)
        proposed = keyed.agg(F.percentile_approx(held, share, F.lit(SKETCH_ACCURACY)).alias("c")).first()["c"]
        count = keyed.agg(F.count_if(x <= F.lit(proposed)).alias("n")).first()["n"]
        if not n <= count < reached:
            break
        cut, reached = proposed, count
    return cut


def _number(df: DataFrame, name: str) -> Column:
    as_double = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(as_double), as_double)


def _batches(names: Sequence[str], sizes: Mapping[str, int], budget: int) -> list[list[str]]:
    """Group columns so that the values one task has to hold stay within the budget."""
    batches: list[list[str]] = []
    room = 0
    for n in names:
        if not batches or sizes[n] > room:
            batches.append([])
            room = budget
        batches[-1].append(n)
        room -= sizes[n]
    return batches
