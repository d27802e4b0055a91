"""Drift of many segments from quantile sketches that are stored per hour and merged on demand.

A sketch counts values by buckets of a fixed relative width, whose borders are the same everywhere: sketches of any hours,
segments and features are merged by adding up counts, in any order, and nothing is lost beyond the width of a bucket. A
quantile is off by that width at most. The index of a segment is exact for buckets of its values that end at borders of the
sketch, so all segments are compared in one pass over small tables, without the traffic itself.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetloom.operators.drift import BUCKETS, EMPTY_SHARE, PSI_DRIFT

#: Relative width of a bucket, and the magnitude below which a value counts as zero.
WIDTH, SMALLEST = 0.02, 1e-9
#: Makes the bucket numbers of all magnitudes positive.
_SHIFT = 100_000


def bucket_of(value: Column, width: float = WIDTH) -> Column:
    """Number of the bucket, which grows with the value; NULL for NULL, NaN and infinities.

    There are some 6,500 buckets between 1e-9 and 1e18 on both sides of zero, however many values there are.
    """
    x = value.cast("double")
    size = F.floor(F.ln(F.abs(x)) / F.lit(math.log1p(width))).cast("int") + _SHIFT
    number = F.when(F.abs(x) < SMALLEST, F.lit(0)).when(x > 0, size).otherwise(-size)
    return F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), number)


def border(bucket: Column, width: float = WIDTH) -> Column:
    """The value of a bucket that is farthest from zero, or nearly."""
    return F.signum(bucket.cast("double")) * F.when(bucket == 0, 0.0).otherwise(F.pow(F.lit(1 + width), F.abs(bucket) - _SHIFT + 1))


def hourly_sketches(rows: DataFrame, features: Sequence[str], segment: str, time_col: str = "ts", width: float = WIDTH) -> DataFrame:
    """hour, segment, feature, bucket, n: one pass over ``rows``, all features at once.

    Missing values, NaN, infinities and rows without a time are left out; a missing segment is one.
    """
    cells = F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), bucket_of(F.col(f"`{f}`"), width).alias("bucket")) for f in features]))
    hour = F.date_trunc("hour", F.col(time_col)).alias("hour")
    spread = rows.where(F.col(time_col).isNotNull()).select(hour, F.col(segment).cast("string").alias("segment"), cells)
    return spread.where("bucket IS NOT NULL").groupBy("hour", "segment", "feature", "bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(sketches: DataFrame, by: Sequence[str] = ("segment", "feature")) -> DataFrame:
    """One sketch per group of ``by``."""
    return sketches.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))


def sketch_quantiles(sketches: DataFrame, shares: Sequence[float], width: float = WIDTH) -> DataFrame:
    """segment, feature, share, value: the nearest-rank quantiles, off by the width of a bucket at most."""
    of = Window.partitionBy("segment", "feature")
    whole = merged(sketches).withColumns({"reached": F.sum("n").over(of.orderBy("bucket")), "total": F.sum("n").over(of)})
    asked = F.explode(F.array(*map(F.lit, shares)))
    rows = whole.withColumn("share", asked).where(F.col("reached") >= F.greatest(F.lit(1), F.ceil(F.round(F.col("share") * F.col("total"), 6))))
    return rows.groupBy("segment", "feature", "share").agg(F.min("bucket").alias("bucket")).select(
        "segment", "feature", "share", border(F.col("bucket"), width).alias("value")
    )


def segment_psi(reference: DataFrame, current: DataFrame, bins: int = BUCKETS) -> DataFrame:
    """segment, feature, n_reference, n_current, psi, drift from two tables of sketches, of any hours.

    Bins end at the quantiles of the reference, the first and the last are open. An empty share counts as EMPTY_SHARE.
    Segments and features that one side lacks are left out. A window holds the buckets of one segment and feature.
    """
    by = ["segment", "feature"]
    zero = F.lit(0).cast("bigint")
    sides = reference.select(*by, "bucket", F.col("n").alias("r"), zero.alias("c")).unionByName(
        current.select(*by, "bucket", zero.alias("r"), F.col("n").alias("c"))
    )
    counts = sides.groupBy(*by, "bucket").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    of = Window.partitionBy(*by)
    before = of.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns(
        {"n_reference": F.sum("r").over(of), "n_current": F.sum("c").over(of), "passed": F.coalesce(F.sum("r").over(before), zero)}
    ).where("n_reference > 0 AND n_current > 0")
    # the quantile i is in an earlier bucket if its rank has been passed
    ranks = [F.ceil(F.round(F.lit(i / bins) * F.col("n_reference"), 6)) for i in range(1, bins)]
    number = sum(((F.col("passed") >= rank).cast("int") for rank in ranks), F.lit(0))
    binned = counts.groupBy(*by, "n_reference", "n_current", number.alias("bin")).agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    share = lambda part, whole: F.when(F.col(part) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(EMPTY_SHARE))
    e, a = share("r", "n_reference"), share("c", "n_current")
    # a bin without any value on either side adds nothing
    found = binned.groupBy(*by, "n_reference", "n_current").agg(F.sum((e - a) * F.ln(e / a)).alias("psi"))
    return found.withColumn("drift", F.col("psi") > PSI_DRIFT)
