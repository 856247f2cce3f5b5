"""Toxicity by cumulative-link ordinal regression on sparse text features.

Severity grades 0 < 1 < ... < K are ordered, so one weight per feature and K ordered
thresholds describe them all: P(grade > k) = sigmoid(x.w - threshold_k). The expected
severity is the sum of these over k.

Features of a text are its different words, in lower case, and their beginnings of four to
six letters, which catch inflected forms; each counts as log(1 + times). Those that toxic
labelled texts have clearly more often than others, by a likelihood ratio, are chosen on
counts made by Spark, and the weights are fitted on a bounded sample of labelled texts.
Scoring is one pass over all texts.

Edge cases: NULL and empty texts have no features and get the severity of the thresholds
alone; without labels of both kinds nothing can be learned, and all texts score 0; rows
that repeat are scored alike; a text is scored whole, however long. An input column
`severity` is replaced, all others are kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadspark.llm.shared import Workspace, one_text_each

#: Labelled texts used for fitting: those with the smallest hashes, this many of each class.
SAMPLE = 6_000
#: Features with weights, at most, and the labelled texts one must be in, at least.
FEATURES = 8_192
LEAST_TEXTS = 4
#: Likelihood ratio (twice its logarithm) that a feature must have at least.
LEAST_RATIO = 18.0
PENALTY = 0.3
STEPS = 200
#: Cells of the sample that one step of the fit handles at once, for little memory.
CELLS = 1 << 17
#: A text with an expected severity from here on is toxic.
REJECT = 0.5
WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6)


def features(text: str | None) -> Counter:
    """Times of each word and beginning of a word (marked by a dot)."""
    words = Counter(WORD.findall(text.lower())) if text else Counter()
    found = Counter(words)
    for word, times in words.items():
        for size in BEGINNINGS:
            if len(word) > size:
                found[word[:size] + "."] += times
    return found


@dataclass
class Model:
    weights: dict[str, float]
    thresholds: list[float]

    def score(self, text: str | None) -> float:
        known = self.weights
        total = sum(known[x] * math.log1p(n) for x, n in features(text).items() if x in known)
        return sum((1 / (1 + math.exp(min(60, max(-60, cut - total)))) for cut in self.thresholds), 0.0)


# Plain Python functions: a worker holds a hundred rows at once and loads no data library,
# so that it takes little of an executor's memory beside the JVM's.
@F.udf(T.MapType(T.StringType(), T.IntegerType()), useArrow=False)
def listed_features(text):
    return dict(features(text))


def sample(docs: DataFrame, labels: DataFrame, number: int = SAMPLE) -> DataFrame:
    """(key, grade, text): labelled texts, at most `number` with grade 0 and with others.

    `labels` has doc_id and grade. A document with several labels takes the highest, and one
    with several rows counts once.
    """
    graded = labels.where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id")
    graded = graded.agg(F.max("grade").cast("int").alias("grade"))
    mark = F.xxhash64("doc_id")
    chosen = [graded.where(x).orderBy(mark, "doc_id").limit(number) for x in ("grade = 0", "grade > 0")]
    chosen = chosen[0].unionByName(chosen[1])  # at most twice `number` rows of two numbers
    found = one_text_each(docs, chosen).join(F.broadcast(chosen), "doc_id")
    return found.select(F.col("doc_id").cast("long").alias("key"), "grade", "text")


def listed_sample(docs: DataFrame, labels: DataFrame, work: Workspace, number: int = SAMPLE) -> DataFrame:
    """(key, grade, name, times): the features of the labelled sample, written once."""
    each = F.explode(listed_features("text")).alias("name", "times")
    return work.store(sample(docs, labels, number).select("key", "grade", each), "features")


def chosen_features(listed: DataFrame, number: int = FEATURES) -> list[str]:
    """Names that graded texts have more often than others, the clearest first."""
    sizes = dict(listed.groupBy((F.col("grade") > 0).alias("t")).agg(F.countDistinct("key")).collect())
    if len(sizes) < 2:
        return []
    counts = listed.groupBy("name").agg(
        F.sum(F.when(F.col("grade") > 0, 1.0).otherwise(0.0)).alias("a"), F.count("*").cast("double").alias("n")
    )
    share = sizes[True] / (sizes[True] + sizes[False])
    a, n = F.col("a"), F.col("n")

    def part(found, expected):
        return F.when(found > 0, found * F.log(found / expected)).otherwise(0.0)

    ratio = 2 * (part(a, n * share) + part(n - a, n * (1 - share)))
    counts = counts.where((n >= LEAST_TEXTS) & (a > n * share) & (ratio >= LEAST_RATIO))
    return [row["name"] for row in counts.orderBy(ratio.desc(), "name").limit(number).select("name").collect()]


def fit_cumulative(rows, cols, values, grades: np.ndarray, width: int, penalty=PENALTY, steps=STEPS):
    """Weights and ordered thresholds of the cumulative-link model, by Adam on all rows.

    Row i has `values` at `cols` where `rows` is i. Thresholds are a first one and positive
    gaps, so they stay ordered.
    """
    top = int(grades.max())
    state = np.zeros(width + top)
    state[width] = 1.0
    first, second = np.zeros_like(state), np.zeros_like(state)
    blocks = [slice(at, at + CELLS) for at in range(0, len(rows), CELLS)]
    beyond = grades[:, None] > np.arange(top)[None, :]
    # Rows of grade g are told from g - 1 by threshold g - 1 and from g + 1 by threshold g.
    near = (np.arange(top)[None, :] == grades[:, None] - 1) | (np.arange(top)[None, :] == grades[:, None])
    for turn in range(1, steps + 1):
        weights, gaps = state[:width], np.exp(np.clip(state[width + 1 :], -6, 6))
        cuts = state[width] + np.concatenate([[0.0], np.cumsum(gaps)])
        lines = np.zeros(len(grades))
        for x in blocks:
            lines += np.bincount(rows[x], weights[cols[x]] * values[x], len(grades))
        chance = 1 / (1 + np.exp(np.clip(cuts[None, :] - lines[:, None], -60, 60)))
        slope = np.where(near, chance - beyond, 0.0)
        by_row = slope.sum(axis=1)
        grad = np.empty_like(state)
        grad[:width] = penalty * weights
        for x in blocks:
            grad[:width] += np.bincount(cols[x], by_row[rows[x]] * values[x], width)
        grad[width] = -slope.sum()
        tail = -slope.sum(axis=0)[::-1].cumsum()[::-1]
        grad[width + 1 :] = tail[1:] * gaps
        grad /= len(grades)
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        rate = 0.1 * (1 - (turn - 1) / steps) + 0.002
        state -= rate * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
    gaps = np.exp(np.clip(state[width + 1 :], -6, 6))
    return state[:width], (state[width] + np.concatenate([[0.0], np.cumsum(gaps)])).tolist()


def fit(listed: DataFrame) -> Model:
    """Model of a listed sample, which is bounded."""
    names = sorted(chosen_features(listed))
    if not names:
        return Model({}, [])
    kept = listed.sparkSession.createDataFrame([(x, i) for i, x in enumerate(names)], "name string, col int")
    every = listed.groupBy("key").agg(F.max("grade").alias("grade")).orderBy("key").toArrow()
    keys, grades = every["key"].to_numpy(), every["grade"].to_numpy().astype(np.int64)
    # Arrow columns, not rows of Python objects, come to the driver, and only narrow arrays
    # of them stay; all are bounded by the sample.
    cells = listed.join(F.broadcast(kept), "name").select("key", "col", "times").toArrow()
    row, col = np.searchsorted(keys, cells["key"].to_numpy()).astype(np.int32), cells["col"].to_numpy()
    values = np.log1p(cells["times"].to_numpy().astype(np.float32))
    del cells
    order = np.lexsort((col, row)).astype(np.int32)
    row, col, values = row[order], col[order], values[order]
    del order
    weights, cuts = fit_cumulative(row, col, values, grades, len(names))
    return Model({x: float(w) for x, w in zip(names, weights, strict=True) if abs(w) > 1e-6}, cuts)


def graded(listed: DataFrame) -> DataFrame:
    """A listed sample of texts labelled toxic (1) or not (0), with grades 0, 1 and 2, for
    labels that do not say how toxic a text is.

    Toxic texts are parted at the median of their number of toxic words, which are the words
    found in toxic labelled texts only: up to it the grade is 1, above it 2.
    """
    whole = listed.where(~F.col("name").endswith("."))
    only = whole.groupBy("name").agg(F.min("grade").alias("least"), F.count("*").alias("n"))
    only = only.where((F.col("least") > 0) & (F.col("n") >= LEAST_TEXTS)).select("name", F.lit(1).alias("bad"))
    number_of = whole.where("grade > 0").join(only, "name", "left").groupBy("key")
    number_of = number_of.agg(F.sum(F.when(F.col("bad") == 1, F.col("times")).otherwise(0)).alias("x"))
    middle = number_of.agg(F.percentile_approx("x", 0.5)).first()[0]
    if middle is None:
        return listed
    parted = number_of.select("key", F.when(F.col("x") > middle, 2).otherwise(1).alias("_grade"))
    told = listed.join(F.broadcast(parted), "key", "left")  # no more rows than the sample
    return told.withColumn("grade", F.coalesce("_grade", "grade")).drop("_grade")


def fit_labels(docs: DataFrame, labels: DataFrame, number: int = SAMPLE) -> Model:
    """Model of labels (doc_id, toxic 0 or 1) with derived grades."""
    work = Workspace(docs.sparkSession, "toxicity")
    flags = labels.select("doc_id", F.col("toxic").alias("grade"))
    model = fit(graded(listed_sample(docs, flags, work, number)))
    work.keep()
    return model


def with_severity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Documents with `severity`, the expected grade."""

    @F.udf("double", useArrow=False)
    def severity(text):
        return model.score(text)

    return docs.withColumn("severity", severity(F.col(text)))
