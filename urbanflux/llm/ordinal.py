"""Quality classes by ordinal regression with cumulative links over hashed text.

A document has one score, the sum of the weights of its hashed words and shape marks. Ordered
thresholds cut the score into grades: the probability of a grade above ``j`` is the logistic
function of the score minus threshold ``j``. Expected grade and tail probabilities follow.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanflux.llm.common import TwoGenerationCache, ship_package, slices, texts_of

BITS = 18
#: Labelled documents that a fit may use: those whose key has the smallest hash.
MAX_LABELLED = 20_000
EPOCHS, RATE, PENALTY = 20, 0.2, 1e-3
#: A feature takes part if so many labelled documents hold it and their grades stand out so far
#: (in standard deviations); the value of a feature that is there.
MIN_DOCUMENTS, MIN_DEVIATION, VALUE = 5, 4.0, 0.3
CACHED_WORDS = 300_000
#: Hash buckets at the end of the range for shape marks: ten steps for each of them.
SHAPES = ("symbols", "upper", "digits", "lines", "repeats", "length")
STEPS = 10


#: What is no letter or digit at the ends of a word.
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def core_of(word: str) -> str:
    """A word in lower case without signs at its ends; one of signs alone stays as it is."""
    return EDGES.sub("", word.lower()) or word


class Features:
    """Distinct hashed features of a text: its words in lower case and steps of its shape."""

    def __init__(self, bits: int = BITS):
        self.size = 1 << bits
        self.words = TwoGenerationCache(self._word, CACHED_WORDS)
        self.first_shape = self.size - len(SHAPES) * STEPS

    def _word(self, word: bytes) -> int:
        return xxhash.xxh3_64_intdigest(core_of(word.decode(errors="replace"))) % self.first_shape

    def of(self, text: str) -> np.ndarray:
        words = text.encode().split()
        if not words:
            return np.zeros(0, np.int32)
        n = max(1, len(text))
        lines = [x for x in text.split("\n") if x.strip()]
        shares = (
            sum(map(text.count, "#*$%&|<>!")) / n * 4,
            sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) / n * 2,
            sum(map(text.count, "0123456789")) / n * 3,
            1 - len(set(lines)) / max(1, len(lines)),
            1 - len(set(words)) / len(words),
            np.log10(len(words)) / 5,
        )
        marks = [self.first_shape + i * STEPS + min(STEPS - 1, int(s * STEPS)) for i, s in enumerate(shares)]
        found = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        return np.unique(np.concatenate([found, marks])).astype(np.int32)


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    cuts: np.ndarray
    bits: int

    def tails(self, features: np.ndarray) -> np.ndarray:
        """Probability of a grade above each of the cuts; a text without words has the lowest grade."""
        if not len(features):
            return np.zeros(len(self.cuts))
        score = self.weights[features].sum() * VALUE
        return _logistic(score - self.cuts)


def telling_features(rows: list[tuple[np.ndarray, int]], grades: int, size: int) -> np.ndarray:
    """Which features are frequent enough and change the share of some grade or better clearly."""
    each = np.concatenate([np.zeros(0, np.int32), *(x for x, _ in rows)])
    held = np.bincount(each, minlength=size)
    out = np.zeros(size, bool)
    grade = np.repeat([g for _, g in rows], [len(x) for x, _ in rows])
    for cut in range(1, grades):
        share = np.mean([g >= cut for _, g in rows]) if rows else 0.0
        above = np.bincount(each, grade >= cut, minlength=size) if len(each) else held
        spread = np.sqrt(np.maximum(held * share * (1 - share), 1e-9))
        out |= np.abs(above - held * share) >= MIN_DEVIATION * spread
    return out & (held >= MIN_DOCUMENTS)


def fit_features(rows: list[tuple[np.ndarray, int]], grades: int, bits: int = BITS, epochs: int = EPOCHS) -> OrdinalModel:
    """Adaptive gradient steps on the likelihood of the grades; the cuts stay in order."""
    size = 1 << bits
    telling = telling_features(rows, grades, size)
    rows = [(x[telling[x]], g) for x, g in rows if len(x)]
    weights, squares = np.zeros(size), np.full(size, 1e-3)
    counts = np.bincount(np.array([g for _, g in rows], np.int64), minlength=grades) + 1.0
    above = counts[::-1].cumsum()[::-1][1:] / counts.sum()
    cuts = np.maximum.accumulate(np.log((1 - above) / above) + np.arange(grades - 1) * 1e-3)
    cut_squares = np.full(grades - 1, 1.0)
    random = np.random.default_rng(7)
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            x, grade = rows[i]
            tail = np.concatenate([[1.0], _logistic(weights[x].sum() * VALUE - cuts), [0.0]])
            share = max(tail[grade] - tail[grade + 1], 1e-6)
            slope = tail * (1 - tail)
            step = (slope[grade] - slope[grade + 1]) / share * VALUE - PENALTY * weights[x]
            squares[x] += step * step
            weights[x] += RATE * step / np.sqrt(squares[x])
            moved = np.zeros(grades + 1)
            moved[grade] -= slope[grade] / share
            moved[grade + 1] += slope[grade + 1] / share
            moved = moved[1:-1]
            cut_squares += moved * moved
            cuts = np.maximum.accumulate(cuts + RATE * moved / np.sqrt(cut_squares))
    return OrdinalModel(weights, cuts, bits)


def fit(
    documents: DataFrame,
    labels: DataFrame,
    grades: int,
    key: str = "doc_id",
    text: str = "text",
    grade: str = "grade",
    limit: int = MAX_LABELLED,
) -> OrdinalModel:
    """Fits ``grades`` grades (0, 1, ...) to at most ``limit`` documents: those whose key hashes lowest.

    Labels without a grade or with one out of range are left out; of repeated labels or documents
    of a key the smallest counts. Only hashed features of the chosen documents reach the driver.
    """
    ship_package(documents.sparkSession)
    usable = labels.where(F.col(key).isNotNull() & F.col(grade).between(0, grades - 1))
    usable = usable.groupBy(F.col(key).alias("key")).agg(F.min(F.col(grade).cast("int")).alias("grade"))
    chosen = usable.withColumn("order", F.xxhash64("key")).orderBy("order", "key").limit(limit)
    texts = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    chosen = texts.join(F.broadcast(chosen), "key").groupBy("key", "order", "grade").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in slices(batches):
            hashed = pa.array([features.of(x) for x in texts_of(batch, "text")], pa.list_(pa.int32()))
            rest = [batch.column(batch.schema.get_field_index(c)) for c in ("grade", "order")]
            yield pa.RecordBatch.from_arrays([hashed, *rest], names=["x", "grade", "order"])

    found = chosen.mapInArrow(run, "x array<int>, grade int, order bigint").toArrow()
    found = found.sort_by("order")
    pairs = [(np.asarray(x.as_py(), np.int32), g.as_py()) for x, g in zip(found["x"], found["grade"], strict=True)]
    return fit_features(pairs, grades)


def grade_documents(df: DataFrame, model: OrdinalModel, text: str = "text", least: float = 0.5) -> DataFrame:
    """Adds ``expected_grade, tails, selected``; columns of these names are replaced.

    ``tails`` holds the probabilities of grade 1 or more, 2 or more, and so on; ``selected`` says
    whether the last of them is ``least`` or more. Texts without words, null included, have the
    lowest grade for sure. Repeated rows get equal grades, an empty table stays empty.
    """
    ship_package(df.sparkSession)
    names = ["expected_grade", "tails", "selected"]
    keep = [c for c in df.columns if c not in names]
    schema = df.select(*keep).schema.add("expected_grade", "double").add("tails", T.ArrayType(T.DoubleType())).add("selected", "boolean")
    shared = df.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.cuts, model.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = OrdinalModel(*shared.value)
        features = Features(own.bits)
        for batch in slices(batches):
            tails = np.array([own.tails(features.of(x)) for x in texts_of(batch, text)]).round(9)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            added = [
                pa.array(tails.sum(axis=1)),
                pa.array(list(tails), pa.list_(pa.float64())),
                pa.array(tails[:, -1] >= least),
            ]
            yield pa.RecordBatch.from_arrays([*kept, *added], names=[*keep, *names])

    return df.mapInArrow(run, schema)


def grades_of(quality: Column, toxic: Column) -> Column:
    """0: toxic; 1: neither toxic nor good; 2: good."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when((quality == 1) & (toxic == 0), 2)
