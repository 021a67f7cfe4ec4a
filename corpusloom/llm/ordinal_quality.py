"""Ordinal quality regression: hashed words, one weight vector, ordered thresholds.

Ratings are grades in order (here 0 toxic, 1 poor, 2 good). A cumulative-link model gives
the probability of a grade above k as the logistic of the score minus the k-th threshold;
all grades share the weights, and the thresholds are kept in order. A document's features
are its distinct lower-cased words and beginnings of words, hashed, each weighted by a
damped count, and a few shares of character kinds. Fitting takes a bounded sample of rated rows
(`SAMPLE`, a parameter); scoring runs over every row.

Defined results: a null or empty text has no features and is scored by the thresholds
alone; rows with null ratings are not used to fit; without rated rows of two grades at
least, every row gets a null grade and is kept. Rated rows whose id repeats count once
for each rated row. Repeated rows are scored one by one. Only ids, texts and ratings are
read, so other columns cannot clash.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bytesets import PLAIN, slices, text_bytes, word_bounds, word_hashes

# Rated rows used to fit, at most; taken by a hash of the id, so alike on every run.
SAMPLE = 12_000
# Hash slots of words, and the features beside them.
SLOTS = 1 << 18
EXTRA = 4
# Bytes of a word's beginning that count as a feature beside the whole word.
STEM = 6
EPOCHS, RATE = 150, 0.3
# A word needs so many rated rows for a weight; small weights are cut off by SPARSE.
MIN_ROWS, SPARSE = 10, 1e-3
# A document is kept if its grade is above this one with this probability at least.
KEEP_ABOVE, KEEP_CHANCE = 0, 0.5

_KINDS = [[0x41, 0x5B], [0x23, 0x2B], [0x21, 0x22], [0x7C, 0x7D]]


def features(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot, value and row of every feature, and the bounds of the rows."""
    data, offsets = text_bytes(texts)
    starts, ends, counts = word_bounds(data, offsets, PLAIN)
    stems = np.minimum(ends, starts + STEM)
    hashes = [word_hashes(data, starts, ends), ~word_hashes(data, starts, stems)]
    slot = (np.concatenate(hashes) % np.uint64(SLOTS)).astype(np.int64)
    row = np.tile(np.repeat(np.arange(len(counts)), counts), 2)
    pair, times = np.unique(row * SLOTS + slot, return_counts=True)
    row, slot = pair // SLOTS, pair % SLOTS
    value = 1 + np.log(times)
    size = np.diff(offsets).astype(float)
    extra = np.zeros((len(size), EXTRA))
    for k, (low, high) in enumerate(_KINDS):
        found = np.flatnonzero((data >= low) & (data < high))
        extra[:, k] = 10 * np.diff(np.searchsorted(found, offsets)) / np.maximum(size, 1)
    rows = np.arange(len(size))
    row = np.concatenate([row, np.repeat(rows, EXTRA)])
    slot = np.concatenate([slot, np.tile(SLOTS + np.arange(EXTRA), len(size))])
    value = np.concatenate([value, extra.ravel()])
    order = np.argsort(row, kind="stable")
    return slot[order], value[order].astype(np.float32), row[order]


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Weights of all slots and the ordered thresholds between the grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, texts) -> np.ndarray:
        slot, value, row = features(texts)
        return np.bincount(row, self.weights[slot] * value, len(texts))

    def tails(self, texts) -> np.ndarray:
        """Per text, the probability of a grade above 0, above 1 and so on."""
        return logistic(self.scores(texts)[:, None] - self.thresholds[None, :])


def fit(slot, value, row, grade: np.ndarray, grades: int) -> Model:
    """Adaptive proximal descent on the cumulative-link likelihood; grades weigh alike."""
    n = len(grade)
    weight = 1 / np.maximum(1, np.bincount(grade, minlength=grades))[grade]
    weight *= n / weight.sum()
    common = np.bincount(slot, minlength=SLOTS + EXTRA) >= MIN_ROWS
    value = np.where(common[slot], value, 0)
    w = np.zeros(SLOTS + EXTRA)
    cut = np.linspace(-1, 1, grades - 1) if grades > 2 else np.zeros(1)
    seen_w, seen_c = np.full(len(w), 1e-6), np.full(len(cut), 1e-6)
    for _ in range(EPOCHS):
        score = np.bincount(row, w[slot] * value, n)
        # P(grade = k) = tail(k - 1) - tail(k), with tail(-1) = 1 and tail(last) = 0.
        tail = logistic(score[:, None] - cut[None, :])
        bounds = np.hstack([np.ones((n, 1)), tail, np.zeros((n, 1))])
        p = np.maximum(bounds[np.arange(n), grade] - bounds[np.arange(n), grade + 1], 1e-9)
        slope = np.hstack([np.zeros((n, 1)), tail * (1 - tail), np.zeros((n, 1))])
        upper, lower = slope[np.arange(n), grade], slope[np.arange(n), grade + 1]
        pull = weight * (upper - lower) / p
        gradient = np.bincount(slot, pull[row] * value, len(w)) / n
        cut_gradient = np.zeros(len(cut))
        for k in range(len(cut)):
            up, low = grade == k + 1, grade == k
            cut_gradient[k] = (-(weight * upper / p)[up].sum() + (weight * lower / p)[low].sum()) / n
        seen_w += gradient**2
        seen_c += cut_gradient**2
        pace = RATE / np.sqrt(seen_w)
        w += pace * gradient
        w = np.sign(w) * np.maximum(np.abs(w) - pace * SPARSE, 0)
        cut = np.sort(cut + RATE * cut_gradient / np.sqrt(seen_c))
    return Model(w.astype(np.float32), cut)


def graded(labels: DataFrame) -> DataFrame:
    """`doc_id` and `grade`: 0 toxic, 1 poor, 2 good; rows without both ratings go."""
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    grade = F.when(F.col("toxic") > 0, 0).when(F.col("quality") <= 0, 1).otherwise(2)
    return known.select(F.col("doc_id").cast("long"), grade.cast("int").alias("grade"))


def fitted(documents: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from rated documents (`doc_id`, `grade`), at most `sample` of them."""
    some = ratings.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample)
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def measured(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                slot, value, row = features(part.column("text"))
                bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("grade"),
                        pa.array([slot[a:b] for a, b in zip(bounds, bounds[1:])], pa.list_(pa.int32())),
                        pa.array([value[a:b] for a, b in zip(bounds, bounds[1:])], pa.list_(pa.float32())),
                    ],
                    ["grade", "slot", "value"],
                )

    # At most `sample` narrow rows are broadcast.
    joined = texts.join(F.broadcast(some), "doc_id").select("grade", "text")
    rows = joined.mapInArrow(measured, "grade int, slot array<int>, value array<float>").toArrow()
    grade = np.asarray(rows.column("grade"))
    if len(set(grade.tolist())) < 2:
        return None
    sizes = [len(x) for x in rows.column("slot")]
    slot = np.concatenate([np.asarray(c.flatten()) for c in rows.column("slot").chunks])
    value = np.concatenate([np.asarray(c.flatten()) for c in rows.column("value").chunks])
    # One grade order and one row order, whatever order the rows came in.
    return fit(slot, value, np.repeat(np.arange(len(grade)), sizes), grade, int(grade.max()) + 1)


def assessed(documents: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Every row's doc_id with expected grade, tail probability and verdict."""
    model = fitted(documents, ratings, sample)
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if model is None:
        empty = F.lit(None).cast("double")
        return rows.select("doc_id", empty.alias("expected_grade"), empty.alias("tail_chance"), F.lit(True).alias("kept"))
    shared = rows.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def scored(batches):
        own = Model(*shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                tails = own.tails(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(tails.sum(axis=1)), pa.array(tails[:, KEEP_ABOVE])],
                    ["doc_id", "expected_grade", "tail_chance"],
                )

    found = rows.mapInArrow(scored, "doc_id long, expected_grade double, tail_chance double")
    return found.withColumn("kept", F.col("tail_chance") >= KEEP_CHANCE)
