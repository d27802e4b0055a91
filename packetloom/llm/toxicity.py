"""Toxicity by gradient-boosted trees over dense features of whole texts, calibrated by isotonic regression.

Features: densities of a fixed and of a learned lexicon, closeness of their hits to second-person words, rates of
capitals, punctuation and obfuscated words. The learned lexicon holds words and word beginnings that labelled toxic rows
use more than others; it is fitted crosswise, so that no training row meets weights that its own label has made.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.llm.common import extend, fold, rows_of, text_of
from packetloom.session import settle

#: Bound of the labelled rows that a classifier is fitted on.
SAMPLE_ROWS = 20_000
#: Bound of the learned lexicon, and the toxic rows a unit needs.
LEXICON_UNITS = 20_000
LEAST_ROWS = 3
#: Log odds from which a unit counts as a hit.
HIT = 2.5
#: Distance in words within which a second-person word counts as close.
NEAR = 5
#: Words whose codes a worker keeps; beyond that the cache starts anew.
CACHE_ENTRIES = 300_000

#: Common insults of four languages.
INSULTS = frozenset(
    """asshole bastard bitch clown coward creep crap degenerate disgusting dumb dumbass failure filth fool garbage
    idiot imbecile jerk liar loser lowlife maggot moron parasite pathetic pig rat retard scum shit stupid suck trash
    ugly useless vermin worthless
    abschaum arschloch blöd depp dumm dummkopf feigling hure idiotisch miststück schwachkopf trottel versager widerlich
    abruti bouffon connard connasse crétin débile idiote imbécile lâche minable ordure pourriture salaud salope stupide
    asco basura cabrón cobarde estúpida estúpido idiota imbécil inútil mierda patético payaso perdedor tonto""".split()
)
#: Second-person words of four languages.
SECOND_PERSON = frozenset(
    """you your yours yourself youre u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos
    tú ti tus usted ustedes vosotros""".split()
)
#: Characters that stand for letters in disguised words.
DISGUISE = str.maketrans("013457@$!|", "oieastasii")

RUNS = re.compile(r"[^\W\d_]+")
LONG_DRAWN = re.compile(r"(.)\1\1")
#: Bytes by kind: 0 other, 1 capital, 2 small letter, 3 digit, 4 exclamation or question mark, 5 other punctuation.
KINDS = np.zeros(256, np.int64)
KINDS[65:91], KINDS[97:123], KINDS[48:58] = 1, 2, 3
for _c in range(33, 127):
    if KINDS[_c] == 0:
        KINDS[_c] = 4 if chr(_c) in "!?" else 5

FEATURES = [
    "hit_density", "hit_count", "insult_density", "insult_count", "weight_density", "top_weight", "near_second_person",
    "second_person_density", "capital_rate", "shouted_rate", "mark_rate", "punctuation_rate", "digit_rate",
    "obfuscated_rate", "drawn_rate", "log_words",
]
#: Bits of a word's code above the weight, which is in hundredths.
INSULT, SECOND, OBFUSCATED, DRAWN, SHOUTED = (1 << k for k in range(12, 17))
WEIGHT = (1 << 12) - 1


def units(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word, *(word[:k] + "*" for k in (4, 5, 6) if len(word) >= k)]


def word_forms(token: str) -> list[str]:
    """Letter runs of a token; for a token that mixes letters with other signs also the words it may disguise."""
    low = token.lower()
    forms = RUNS.findall(low)
    core = low.strip(".,;:!?\"'()[]{}*&%#$-_|")
    if forms and core and not core.isalpha():
        forms += [core.translate(DISGUISE), "".join(forms)]
    return forms


class Codes(dict):
    """Token to code; misses are computed and kept until the cache is full."""

    def __init__(self, weights: dict[str, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        forms = word_forms(token)
        weight = max((self.weights.get(u, 0.0) for f in forms for u in units(f)), default=0.0)
        code = min(WEIGHT, round(100 * max(0.0, weight)))
        core = token.strip(".,;:!?\"'()[]{}*&%#$-_|")
        code |= INSULT * any(f in INSULTS for f in forms) | SECOND * any(f in SECOND_PERSON for f in forms)
        code |= OBFUSCATED * bool(forms and core and not core.isalpha()) | DRAWN * bool(LONG_DRAWN.search(token))
        code |= SHOUTED * (len(core) > 2 and core.isupper())
        self[token] = code
        return code


def feature_matrix(texts: list[str], codes: Codes) -> np.ndarray:
    """One row of FEATURES per text; a text without a word has zeros."""
    listed = [t.split() for t in texts]
    count = np.asarray([len(x) for x in listed], np.int64)
    code = np.fromiter((codes[w] for words in listed for w in words), np.int64, int(count.sum()))
    doc = np.repeat(np.arange(len(texts)), count)
    kinds = np.zeros((len(texts), 6))
    for i, t in enumerate(texts):
        kinds[i] = np.bincount(KINDS[np.frombuffer(t.encode(), np.uint8)], minlength=6)

    def per_text(values) -> np.ndarray:
        return np.bincount(doc, values, minlength=len(texts))

    weight = (code & WEIGHT) / 100
    insult, second = code & INSULT > 0, code & SECOND > 0
    hit = weight >= HIT
    index = np.arange(len(code))
    far = len(code) + NEAR + 1
    last = np.maximum.accumulate(np.where(second, index, -far)) if len(code) else index
    after = np.minimum.accumulate(np.where(second, index, 2 * far)[::-1])[::-1] if len(code) else index
    first = np.repeat(np.cumsum(count) - count, count)
    end = np.repeat(np.cumsum(count), count)
    close = ((index - last <= NEAR) & (last >= first)) | ((after - index <= NEAR) & (after < end))
    top = np.zeros(len(texts))
    np.maximum.at(top, doc, weight)
    n = np.maximum(count, 1)
    letters, signs = np.maximum(kinds[:, 1] + kinds[:, 2], 1), np.maximum(kinds.sum(axis=1), 1)
    hits, insults = per_text(hit), per_text(insult)
    return np.column_stack(
        [
            hits / n, np.log1p(hits), insults / n, np.log1p(insults), per_text(weight) / n, top, per_text((hit | insult) & close),
            per_text(second) / n, kinds[:, 1] / letters, per_text(code & SHOUTED > 0) / n, kinds[:, 4] / signs,
            kinds[:, 5] / signs, kinds[:, 3] / signs, per_text(code & OBFUSCATED > 0) / n, per_text(code & DRAWN > 0) / n, np.log1p(count),
        ]
    )


def with_features(rows: DataFrame, lexicons: dict[int, dict[str, float]]) -> DataFrame:
    """``rows`` (text, half, ...) without the text, with an array of features by the lexicon of the row's half."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicons)
    kept = [f for f in rows.schema if f.name != "text"]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = {half: Codes(weights) for half, weights in shared.value.items()}
        for batch in rows_of(batches):
            half = batch.column("half").to_numpy(zero_copy_only=False)
            texts = batch.column("text").to_pylist()
            found = np.zeros((len(texts), len(FEATURES)))
            for h in np.unique(half):
                mine = np.flatnonzero(half == h)
                found[mine] = feature_matrix([texts[i] for i in mine], codes[int(h)])
            yield extend(batch.select([f.name for f in kept]), features=pa.array(list(found), pa.list_(pa.float64())))

    return rows.mapInArrow(compute, T.StructType([*kept, T.StructField("features", T.ArrayType(T.DoubleType()))]))


def unit_counts(sample: DataFrame) -> DataFrame:
    """unit and the numbers of toxic and other rows of each half (toxic_0, toxic_1, other_0, other_1) that have it."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, ...] = (Counter(), Counter(), Counter(), Counter())

        def told() -> pa.RecordBatch:
            names = list(set().union(*seen))
            columns = [pa.array(names, pa.string()), *(pa.array([c[u] for u in names], pa.int64()) for c in seen)]
            return pa.RecordBatch.from_arrays(columns, names=["unit", "toxic_0", "toxic_1", "other_0", "other_1"])

        for batch in rows_of(batches):
            for row in batch.to_pylist():
                found = {u for token in set(row["text"].split()) for f in word_forms(token) for u in units(f)}
                seen[(0 if row["label"] else 2) + row["half"]].update(found)
            if sum(map(len, seen)) > 1_000_000:
                yield told()
                for c in seen:
                    c.clear()
        yield told()

    counted = sample.select("text", "label", "half").mapInArrow(
        tally, "unit string, toxic_0 long, toxic_1 long, other_0 long, other_1 long"
    )
    return counted.groupBy("unit").agg(*(F.sum(c).alias(c) for c in counted.columns[1:]))


def learn_lexicons(sample: DataFrame) -> dict[int, dict[str, float]]:
    """Log odds of units: under 2 from all rows, under 0 and 1 for rows of that half, from the rows of the other."""
    sizes = {(r["half"], r["label"]): r["n"] for r in sample.groupBy("half", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = unit_counts(sample).filter(F.col("toxic_0") + F.col("toxic_1") >= LEAST_ROWS)
    odds = (F.col("toxic_0") + F.col("toxic_1")) / (F.col("other_0") + F.col("other_1") + 1)
    best = found.orderBy(odds.desc(), "unit").limit(LEXICON_UNITS).collect()

    def weights(halves: tuple[int, ...]) -> dict[str, float]:
        toxic = sum(sizes.get((h, 1), 0) for h in halves)
        other = sum(sizes.get((h, 0), 0) for h in halves)
        out = {}
        for r in best:
            a, b = sum(r[f"toxic_{h}"] for h in halves), sum(r[f"other_{h}"] for h in halves)
            out[r["unit"]] = math.log((a + 0.1) / (toxic + 1)) - math.log((b + 0.5) / (other + 1)) if a > 1 else 0.0
        return {u: w for u, w in out.items() if w > 0.5}

    return {0: weights((1,)), 1: weights((0,)), 2: weights((0, 1))}


@dataclass(frozen=True)
class ToxicityModel:
    """Lexicon, trees and calibration; without trees (labels of one kind or none) every score is ``prior``."""

    lexicon: dict[str, float]
    prior: float
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """row (all columns of ``docs``) and score (0 to 1) of every row; a null text counts as empty."""
        rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), text_of(text_col).alias("text"))
        if self.trees is None:
            return rows.drop("text").withColumn("score", F.lit(self.prior))
        rows = with_features(rows.withColumn("half", F.lit(2)), {2: self.lexicon})
        scored = self.trees.transform(rows.withColumn("features", array_to_vector("features")))
        scored = scored.select("row", vector_to_array("probability")[1].alias("raw"))
        scored = self.calibration.transform(scored)
        # the calibration is a staircase; a thousandth of the raw score keeps the order within a step
        return scored.select("row", (F.col("prediction") * 0.999 + F.col("raw") * 0.001).alias("score"))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = SAMPLE_ROWS
) -> ToxicityModel:
    """Fit on at most about ``most`` labelled rows, drawn by a hash of the id.

    Labels that are null are left out; of several labels of one id the largest counts. Three quarters of the sample fit
    the trees, the rest the calibration. The ids of the sample are broadcast, which their bound allows.
    """
    marks = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    marks = marks.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    share = min(1.0, most / max(1, marks.count()))
    draw = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30)) < int(share * (1 << 30))
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    sample = texts.join(F.broadcast(marks.filter(draw)), "id")
    part = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(8))
    sample = settle(sample.select("text", "label", (part % 2).cast("int").alias("half"), part.cast("int").alias("part")), "toxic-sample")

    counted = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = counted.get(1, 0) / max(1, sum(counted.values()))
    if len(counted) < 2:
        return ToxicityModel({}, prior)
    lexicons = learn_lexicons(sample)
    rows = settle(with_features(sample, lexicons), "toxic-features").coalesce(4)
    rows = rows.withColumn("features", array_to_vector("features")).withColumn("label", F.col("label").cast("double"))
    trees = GBTClassifier(maxIter=25, maxDepth=4, stepSize=0.2, minInstancesPerNode=3, seed=3)
    trees = trees.fit(rows.filter("part < 6"))
    held = trees.transform(rows.filter("part >= 6")).select("label", vector_to_array("probability")[1].alias("raw"))
    if held.select("label").distinct().count() < 2:
        held = trees.transform(rows).select("label", vector_to_array("probability")[1].alias("raw"))
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(held)
    return ToxicityModel(lexicons[2], prior, trees, calibration)


def toxicity_scores(docs: DataFrame, labels: DataFrame, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; rows of the held-out fold never teach the model.

    A null or empty text has a score as any other. Null ids are scored and teach nothing; repeated rows are scored by
    themselves; an empty table gives no rows.
    """
    model = fit_toxicity(docs, labels.filter(~fold("doc_id", held_out)))
    scored = model.score(docs.select("doc_id", "text"))
    score, doc_id = F.col("score"), F.col("row.doc_id")
    return scored.select(doc_id, fold(doc_id, held_out).alias("held_out"), "score", (score >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not predict toxic, with all their columns."""
    model = fit_toxicity(docs, labels, id_col, text_col)
    return model.score(docs, text_col).filter("score < 0.5").select("row.*")
