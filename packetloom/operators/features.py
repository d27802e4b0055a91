"""Feature columns and fitted feature steps with the same code in batch and in streams.

The steps are ``pyspark.ml`` estimators: ``fit`` reduces the table to a bounded set of numbers, ``transform`` is a list of
column expressions, so nothing is joined and a stream can use the fitted step as well.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.functions.columns import binary_label, finite_or_zero, log1p_length
from packetloom.operators.ordering import join_classes, number_sorted, quantile_scan
from packetloom.schemas import NORMAL_NAMES, is_numeric

# Columns that are never model input.
LEAKAGE = ("ts", "timestamp", "attack_type", "src_ip", "dst_ip", "risk_hint")
METADATA = (
    "ts",
    "src_ip",
    "dst_ip",
    "src_port",
    "dst_port",
    "proto",
    "service",
    "conn_state",
    "attack_type",
    "label",
    "risk_hint",
)
ANOMALY_METADATA = ("label", "attack_type", "ts", "src_port", "dst_port")
MISSING = "missing"
MAX_CATEGORIES = 1000
#: Width of the vector, and counts kept, for a text column of more values than that.
HASHED_CATEGORIES, FREQUENCY_BUCKETS = 1 << 11, 1 << 14


def drop_leakage(df: DataFrame, columns: Sequence[str] = LEAKAGE) -> DataFrame:
    return df.drop(*columns)


def numeric_feature_names(df: DataFrame, exclude: Sequence[str] = METADATA, skip_prefix: str | None = None) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if is_numeric(f) and f.name not in exclude and not (skip_prefix and f.name.startswith(skip_prefix))
    ]


def anomaly_feature_names(df: DataFrame) -> list[str]:
    return numeric_feature_names(df, ANOMALY_METADATA, "_")


def clean_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing and infinite values become 0."""
    return df.withColumns({c: finite_or_zero(F.col(f"`{c}`")) for c in columns})


def align_columns(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the expected columns in order: absent ones become 0, others are dropped (except ``keep``)."""
    return df.select(
        *keep, *[F.col(f"`{c}`") if c in df.columns else F.lit(0.0).alias(c) for c in expected]
    )


def strict_select(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The features in order; a missing one is an error."""
    absent = [c for c in features if c not in df.columns]
    if absent:
        raise ValueError(f"missing features: {absent}")
    return df.select(*keep, *[F.col(f"`{c}`") for c in features])


def with_binary_label(df: DataFrame, name: str = "y") -> DataFrame:
    """Binary target from ``label`` when present, else from ``attack_type``."""
    source = "label" if "label" in df.columns else "attack_type"
    if source not in df.columns:
        raise ValueError("neither label nor attack_type present")
    return df.withColumn(name, binary_label(F.col(source), NORMAL_NAMES))


def class_names(df: DataFrame, column: str, limit: int = MAX_CATEGORIES) -> list[str] | None:
    """Sorted distinct values, None where there are more than ``limit``: they are too many for a list of literals."""
    rows = df.select(F.col(f"`{column}`").cast("string").alias("v")).where("v IS NOT NULL").distinct().limit(limit + 1).collect()
    return sorted(r["v"] for r in rows) if len(rows) <= limit else None


def with_label_index(df: DataFrame, column: str, name: str = "y", limit: int = MAX_CATEGORIES) -> DataFrame:
    """Position of the class in the sorted list of classes: a literal list, or a join where there are many classes."""
    classes = class_names(df, column, limit)
    if classes is not None:
        return df.withColumn(name, index_of(F.col(column), classes))
    named = df.select(F.col(column).cast("string").alias("__class")).where("__class IS NOT NULL")
    joined = join_classes(df.withColumn("__key", F.col(column).cast("string")), number_sorted(named, "__class", "__index"), "__key", "__class")
    return joined.withColumn(name, F.col("__index").cast("int")).drop("__key", "__class", "__index")


def index_of(value: Column, ordered: Sequence[str]) -> Column:
    """0-based position in a fixed list, NULL when absent."""
    listed = F.array(*[F.lit(c) for c in ordered]).cast("array<string>")
    return F.nullif(F.array_position(listed, value.cast("string")), F.lit(0)).cast("int") - F.lit(1)


def require_classes(df: DataFrame, label: str, least: int = 2) -> None:
    """Training needs at least two classes."""
    found = len(df.where(F.col(label).isNotNull()).select(label).distinct().limit(least).collect())
    if found < least:
        raise ValueError(f"{label} has {found} classes, at least {least} are needed")


class LengthFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``length`` to ``length_log`` = ln(1 + length), the original dropped; tables without ``length`` pass through."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if "length" not in dataset.columns:
            return dataset
        return dataset.withColumn("length_log", log1p_length(F.col("length"))).drop("length")


def mean_lengths(packets: DataFrame) -> DataFrame:
    """Mean packet length of every protocol that has one, however many there are."""
    return packets.groupBy("protocol").agg(F.avg("length").alias("mean_length")).where("protocol IS NOT NULL AND mean_length IS NOT NULL")


class PacketFeatures(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the mean length per protocol and adds the length features."""

    def _fit(self, dataset: DataFrame) -> PacketFeaturesModel:
        means: dict[str, float] = {}
        if {"protocol", "length"} <= set(dataset.columns):
            rows = mean_lengths(dataset).limit(MAX_CATEGORIES + 1).collect()
            means = {r["protocol"]: r["mean_length"] for r in rows}
        complete = len(means) <= MAX_CATEGORIES
        model = PacketFeaturesModel()
        model._set(protocols=list(means) if complete else [], meanLengths=list(means.values()) if complete else [], complete=complete)
        return model


class PacketFeaturesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    protocols = Param(Params._dummy(), "protocols", "protocols seen in fit", TypeConverters.toListString)
    meanLengths = Param(Params._dummy(), "meanLengths", "mean length per protocol", TypeConverters.toListFloat)
    complete = Param(Params._dummy(), "complete", "whether the list has all protocols", TypeConverters.toBoolean)

    @property
    def mean_length(self) -> dict[str, float]:
        """Means by protocol. More protocols than fit a list stay in a table, see ``mean_lengths``."""
        if self.isSet("complete") and not self.getOrDefault("complete"):
            raise ValueError(f"more than {MAX_CATEGORIES} protocols: use mean_lengths")
        return dict(zip(self.getOrDefault(self.protocols), self.getOrDefault(self.meanLengths)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return LengthFeatures().transform(dataset)


class NumericScaler(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Median imputation, then standardisation with the population standard deviation of the imputed column.

    ``ml.Imputer`` takes an approximate median and ``ml.StandardScaler`` the sample deviation, hence this step. The
    moments of the imputed column follow from the moments of the present values and the median, so the table is
    read once for the moments and, while it is small, once for the median.
    """

    inputCols = Param(Params._dummy(), "inputCols", "numeric columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _fit(self, dataset: DataFrame) -> NumericScalerModel:
        columns = self.getOrDefault(self.inputCols)
        moments = {"rows": F.count(F.lit(1))}
        for i, c in enumerate(columns):
            moments |= {
                f"known{i}": F.count(_number(c)),
                f"mean{i}": F.avg(_number(c)),
                f"var{i}": F.var_pop(_number(c)),
            }
        quantiles, row = quantile_scan(dataset, {c: [0.5] for c in columns}, moments)
        medians, means, deviations = [], [], []
        for i, c in enumerate(columns):
            rows, known = row["rows"], row[f"known{i}"]
            median = quantiles[c][0] if known else 0.0
            mean = ((row[f"mean{i}"] or 0.0) * known + median * (rows - known)) / max(1, rows)
            spread = known * ((row[f"var{i}"] or 0.0) + ((row[f"mean{i}"] or 0.0) - mean) ** 2)
            spread += (rows - known) * (median - mean) ** 2
            medians.append(float(median))
            means.append(float(mean))
            deviations.append(math.sqrt(spread / max(1, rows)))
        model = NumericScalerModel()
        model._set(inputCols=columns, medians=medians, means=means, deviations=deviations)
        return model


class NumericScalerModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    inputCols = Param(Params._dummy(), "inputCols", "numeric columns", TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "imputed values", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "means after imputation", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "population deviations", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scaled = {}
        for name, median, mean, deviation in zip(
            *[self.getOrDefault(p) for p in (self.inputCols, self.medians, self.means, self.deviations)]
        ):
            centred = F.coalesce(_number(name), F.lit(median)) - F.lit(mean)
            scaled[name] = centred / F.lit(deviation if deviation > 0 else 1.0)
        return dataset.withColumns(scaled)


def _number(name: str) -> Column:
    as_double = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(as_double), as_double)


class CategoryEncoder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """One 0/1 column ``<column>_<value>`` per category; NULL is the category ``missing``, unknown values give zeros.

    The width of the result is the number of categories, so ``fit`` refuses a column with more than
    ``maxCategories`` of them; ``sparse_categories`` encodes such columns without a wide table.
    """

    inputCols = Param(Params._dummy(), "inputCols", "text columns", TypeConverters.toListString)
    maxCategories = Param(Params._dummy(), "maxCategories", "widest allowed column", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, maxCategories: int = MAX_CATEGORIES):
        super().__init__()
        self._set(maxCategories=maxCategories)
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _fit(self, dataset: DataFrame) -> CategoryEncoderModel:
        columns = self.getOrDefault(self.inputCols)
        filled = dataset.select(*[_category(c).alias(c) for c in columns])
        limit = self.getOrDefault(self.maxCategories)
        names, values = [], []
        for c in columns:
            found = class_names(filled, c, limit)
            if found is None:
                raise ValueError(f"{c} has more than {limit} categories, encode it in sparse form")
            names += [c] * len(found)
            values += found
        model = CategoryEncoderModel()
        model._set(inputCols=columns, encodedCols=names, encodedValues=values)
        return model


class CategoryEncoderModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    inputCols = Param(Params._dummy(), "inputCols", "text columns", TypeConverters.toListString)
    encodedCols = Param(Params._dummy(), "encodedCols", "source column per output", TypeConverters.toListString)
    encodedValues = Param(Params._dummy(), "encodedValues", "category per output", TypeConverters.toListString)

    @property
    def output_names(self) -> list[str]:
        return [f"{c}_{v}" for c, v in self._pairs()]

    def _pairs(self) -> list[tuple[str, str]]:
        return list(zip(self.getOrDefault(self.encodedCols), self.getOrDefault(self.encodedValues)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        pairs = self._pairs()
        sources = self.getOrDefault(self.inputCols)
        rest = [F.col(f"`{c}`") for c in dataset.columns if c not in sources]
        return dataset.select(
            *rest, *[(_category(c) == F.lit(v)).cast("double").alias(f"{c}_{v}") for c, v in pairs]
        )


def _category(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(MISSING))


def sparse_categories(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Long form of the one-hot table: one row ``(key, feature, 1.0)`` per filled cell, any number of categories."""
    cells = F.explode(F.array(*[F.concat(F.lit(f"{c}_"), _category(c)) for c in columns]))
    return df.select(key, cells.alias("feature"), F.lit(1.0).alias("value"))


def split_types(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric columns of any width and text columns, as the preprocessing step takes them; other types are ignored."""
    fields = [f for f in df.schema.fields if f.name not in exclude]
    numeric = [f.name for f in fields if is_numeric(f)]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    return numeric, text


class DropColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    inputCols = Param(Params._dummy(), "inputCols", "columns to leave out", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.getOrDefault(self.inputCols))


class FillCategories(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """NULL becomes the category ``missing``."""

    inputCols = Param(Params._dummy(), "inputCols", "text columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({c: _category(c) for c in self.getOrDefault(self.inputCols)})


def _bucket(name: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(_category(name)), F.lit(buckets)).cast("int")


class FrequencyEncoder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """One number ``<column>_frequency`` per text column: the logarithm of the share of rows with that value.

    Values are counted by hash buckets, so a column may have any number of them and the model keeps a fixed number of
    counts; values of one bucket count as one. A value that the fit has not seen is as rare as an empty bucket.
    """

    inputCols = Param(Params._dummy(), "inputCols", "text columns", TypeConverters.toListString)
    buckets = Param(Params._dummy(), "buckets", "counts per column", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, buckets: int = FREQUENCY_BUCKETS):
        super().__init__()
        self._set(buckets=buckets)
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _fit(self, dataset: DataFrame) -> FrequencyEncoderModel:
        columns, buckets = self.getOrDefault(self.inputCols), self.getOrDefault(self.buckets)
        cells = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _bucket(c, buckets).alias("b")) for i, c in enumerate(columns)]))
        counts = [0] * (buckets * len(columns))
        for row in dataset.select(cells.alias("cell")).groupBy("cell").count().collect():  # at most one row a bucket
            counts[row["cell"]["i"] * buckets + row["cell"]["b"]] = row["count"]
        model = FrequencyEncoderModel()
        model._set(inputCols=columns, buckets=buckets, counts=counts)
        return model


class FrequencyEncoderModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    inputCols = Param(Params._dummy(), "inputCols", "text columns", TypeConverters.toListString)
    buckets = Param(Params._dummy(), "buckets", "counts per column", TypeConverters.toInt)
    counts = Param(Params._dummy(), "counts", "rows per bucket, column after column", TypeConverters.toListInt)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns, buckets, counts = (self.getOrDefault(p) for p in (self.inputCols, self.buckets, self.counts))
        total = sum(counts[:buckets])
        added = {}
        for i, c in enumerate(columns):
            shares = [math.log((n + 1) / (total + buckets)) for n in counts[i * buckets : (i + 1) * buckets]]
            listed = F.from_json(F.lit(json.dumps(shares)), "array<double>")
            added[f"{c}_frequency"] = F.get(listed, _bucket(c, buckets))
        return dataset.withColumns(added).drop(*columns)


def model_inputs(prepared: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns of a prepared table that go into the feature vector: scaled numbers, 0/1 columns and sparse vectors."""
    return [f.name for f in prepared.schema.fields if f.name not in exclude and f.dataType.simpleString() in ("double", "vector")]


def fit_preprocessing(df: DataFrame, exclude: Sequence[str] = (), max_categories: int = MAX_CATEGORIES, wide: str = "sparse"):
    """Extractor, scaler and encoder as one fitted ``PipelineModel``; ``exclude`` names key and target columns.

    A text column of more than ``max_categories`` values becomes one sparse vector ``<column>_sparse`` of hashed values,
    or with ``wide="frequency"`` one number ``<column>_frequency``, for models that take numbers only. Neither gathers the
    values.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import FeatureHasher

    if wide not in ("sparse", "frequency"):
        raise ValueError(f"wide columns become sparse or frequency, not {wide}")
    extractor = PacketFeatures().fit(df)
    featured = extractor.transform(df)
    numeric, text = split_types(featured, exclude)
    stages: list[Model] = [extractor]
    if numeric:
        stages.append(NumericScaler(inputCols=numeric).fit(featured))
    many = [c for c in text if class_names(featured, c, max_categories) is None]
    if many and wide == "frequency":
        stages.append(FrequencyEncoder(inputCols=many).fit(featured))
    elif many:
        stages.append(FillCategories(inputCols=many))
        for c in many:
            stages.append(FeatureHasher(inputCols=[c], outputCol=f"{c}_sparse", categoricalCols=[c], numFeatures=HASHED_CATEGORIES))
        stages.append(DropColumns(inputCols=many))
    narrow = [c for c in text if c not in many]
    if narrow:
        stages.append(CategoryEncoder(inputCols=narrow, maxCategories=max_categories).fit(featured))
    return PipelineModel(stages)
