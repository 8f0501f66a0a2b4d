"""Quality of texts by naive Bayes support vectors.

Features are the distinct n-grams of a text, hashed: those of 3 bytes, and those of 4 words of which only
counts how far back each word stands before, which is what repetitive texts have in common. Each
is scaled by the log of how much more often it occurs in the texts of one class than of the
other; a linear model with hinge loss is fitted to the scaled indicators (of length 1 for every text) by dual coordinate
descent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sums import vector_sum
from .tables import written
from .texts import blocks, folded, raw_bytes, words


@dataclass(frozen=True)
class Settings:
    """bits: log2 of the features. labels: most labelled ids that are learnt from, sample: most rows of
    those that the hinge loss is fitted to; either takes the smallest hashes of the ids.

    cost: bound of the dual variables. rounds: passes over the sample.
    """

    bits: int = 18
    labels: int = 40_000
    sample: int = 12_000
    cost: float = 1.0
    rounds: int = 12
    smoothing: float = 1.0


def recurrences(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(codes, rows) of the 4-grams of words by their recurrence: 0 for a word that is new to its text, else
    1 + log2 of the number of words since it stood there, 8 at most."""
    hashes, _, offsets = words(*folded(block))
    if len(hashes) < 4:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(offsets))
    keys = rows << np.uint64(44) | hashes >> np.uint64(20)
    order = np.argsort(keys, kind="stable")
    again = keys[order][1:] == keys[order][:-1]
    steps = np.zeros(len(keys))
    steps[order[1:][again]] = np.diff(order)[again]
    marks = np.where(steps > 0, np.minimum(np.log2(np.maximum(steps, 1)).astype(np.int64) + 1, 8), 0).astype(np.uint64)
    codes = ((marks[:-3] * np.uint64(9) + marks[1:-2]) * np.uint64(9) + marks[2:-1]) * np.uint64(9) + marks[3:]
    inside = rows[:-3] == rows[3:]
    return codes[inside] + np.uint64(1 << 32), rows[:-3][inside]


def features(block: pa.RecordBatch, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, begins): the distinct features of each text, in ascending order."""
    raw, begins = raw_bytes(block)
    n = len(begins) - 1
    if len(raw) < 3:
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    wide = raw.astype(np.uint64)
    codes = wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]
    rows = np.repeat(np.arange(n, dtype=np.uint64), np.diff(begins))
    inside = rows[:-2] == rows[2:]
    more, owners = recurrences(block)
    codes, rows = np.concatenate((codes[inside], more)), np.concatenate((rows[:-2][inside], owners))
    keys = np.sort(((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)) | rows << np.uint64(bits))
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    keys = keys[first]
    found = np.searchsorted(keys, np.arange(n + 1, dtype=np.uint64) << np.uint64(bits))
    return (keys & np.uint64((1 << bits) - 1)).astype(np.int64), found


@dataclass
class Model:
    """weights and squares: for each feature its part in the margin, and in the length of a text."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    bits: int

    def scores(self, block: pa.RecordBatch) -> np.ndarray:
        found, begins = features(block, self.bits)
        # Added up text by text, so that equal texts have equal scores to the last bit.
        owner = np.repeat(np.arange(block.num_rows), np.diff(begins))
        margins, lengths = (np.bincount(owner, weights=w[found], minlength=block.num_rows) for w in (self.weights, self.squares))
        margins = np.divide(margins, np.sqrt(np.maximum(lengths, 1e-12)), out=np.zeros(len(margins)), where=lengths > 1e-9)
        return 1 / (1 + np.exp(-np.clip(4 * (margins + self.bias), -500, 500)))


def dual_descent(rows: list[np.ndarray], signs: np.ndarray, ratios: np.ndarray, settings: Settings) -> np.ndarray:
    """Weights of the scaled features, and the bias last."""
    weights, bias = np.zeros(len(ratios)), 0.0
    # Four bytes a feature, twice, are all that a text takes here.
    scaled = [(x / max(np.sqrt((x * x).sum()), 1e-9)).astype(np.float32) for x in (ratios[r] for r in rows)]
    curvature = np.array([(x * x).sum(dtype=np.float64) + 1 for x in scaled])
    alphas = np.zeros(len(rows))
    random = np.random.Generator(np.random.PCG64(5))
    for _ in range(settings.rounds):
        for i in random.permutation(len(rows)):
            slope = signs[i] * (weights[rows[i]] @ scaled[i] + bias) - 1
            changed = min(max(alphas[i] - slope / curvature[i], 0.0), settings.cost)
            if changed != alphas[i]:
                step = (changed - alphas[i]) * signs[i]
                weights[rows[i]] += step * scaled[i]
                bias += step
                alphas[i] = changed
    return np.append(weights, bias)


def learnt(rows: DataFrame, settings: Settings = Settings()) -> Model:
    """A model of rows (id, text, label); label 0 or 1, others and null ones teach nothing.

    The log-count ratios come from all these rows, the fit from those settings.sample rows
    with the smallest hashes, where rows that repeat count once. With one class only, or none, every score is that
    class or 0.5.
    """
    rows = rows.filter("label in (0, 1)").withColumn("order", F.xxhash64("id", "text"))
    size, bits = 1 << settings.bits, settings.bits

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(2 * size + 16, np.int64)
        for block in blocks(batches):
            found, begins = features(block, bits)
            labels = block.column("label").to_numpy().astype(np.int64)
            owner = np.repeat(labels, np.diff(begins))
            total += np.bincount(found + owner * size, minlength=len(total))
            total[2 * size : 2 * size + 2] += np.bincount(labels, minlength=2)
        return total

    counts = vector_sum(rows.select("text", "label"), 2 * size + 16, count)
    texts = counts[2 * size : 2 * size + 2]
    if not texts.all():
        bias = 0.0 if not texts.any() else (10.0 if texts[1] else -10.0)
        return Model(np.zeros(size), np.zeros(size), bias, bits)
    worse, better = (counts[k * size : (k + 1) * size] + settings.smoothing for k in (0, 1))
    ratios = np.log((better / better.sum()) / (worse / worse.sum()))
    ratios[(counts[:size] + counts[size : 2 * size]) == 0] = 0
    last = rows.select("order").distinct().orderBy("order").limit(settings.sample).agg(F.max("order")).first()[0]
    sample = rows.filter(F.col("order") <= last).select("order", "text", F.col("label").cast("int"))
    shared = rows.sparkSession.sparkContext.broadcast(ratios)  # 2**bits numbers

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found, begins = features(block, bits)
            packed = [found[i:j].astype(np.int32).tobytes() for i, j in zip(begins[:-1], begins[1:])]
            yield pa.RecordBatch.from_arrays([block.column("order"), pa.array(packed, pa.binary()), block.column("label")], ["order", "features", "label"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, rows, signs = [], [], []
        for batch in batches:
            orders += batch.column("order").to_pylist()
            signs += [1.0 if label else -1.0 for label in batch.column("label").to_pylist()]
            # Views of the batches, which stay.
            rows += [np.frombuffer(x.as_buffer(), np.int32) for x in batch.column("features")]
        first = sorted(range(len(orders)), key=orders.__getitem__)
        weights = dual_descent([rows[k] for k in first], np.array(signs)[first], shared.value, settings)
        yield pa.record_batch({"weights": pa.array([weights.tobytes()], pa.binary())})

    extracted = sample.mapInArrow(extract, "order long, features binary, label int")
    # Rows that repeat have equal hashes, and count once here: the sample stays bounded.
    once = extracted.groupBy("order").agg(F.min(F.struct("features", "label")).alias("row")).select("order", "row.*")
    # The bounded sample goes to one task, and its weights to the driver.
    found = once.repartition(1).mapInArrow(fit, "weights binary").first()
    weights = np.frombuffer(found["weights"])
    return Model(weights[:-1] * ratios, ratios * ratios, float(weights[-1]), bits)


def training_rows(documents: DataFrame, labels: DataFrame, learn: Column, id: str, text: str, label: str, settings: Settings) -> DataFrame:
    """(id, text, label) of settings.labels ids for which `learn` holds; ids with both labels, and null ids, teach nothing."""
    marks = labels.select(F.col(id).alias("id"), F.col(label).alias("label")).filter("label in (0, 1)")
    marks = marks.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other").drop("other")
    rows = documents.filter(learn).select(F.col(id).alias("id"), F.col(text).alias("text")).filter("text is not null")
    known = rows.select("id").distinct().join(marks, "id")
    chosen = written(known.orderBy(F.xxhash64("id"), "id").limit(settings.labels), "labels")
    # Bounded by settings.labels, so texts need not be shuffled.
    return rows.join(F.broadcast(chosen), "id")


def scored(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """documents with score and predicted set; a null text is an empty one. Other columns stay as they are."""
    rows = documents.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            scores = shared.value.scores(pa.record_batch({"text": block.column(text)}))
            new = {"score": pa.array(scores), "predicted": pa.array((scores >= 0.5).astype(np.int32))}
            yield pa.RecordBatch.from_arrays([new.get(n, block.column(n)) for n in block.schema.names], block.schema.names)

    return rows.mapInArrow(judge, rows.schema)


def classify(documents: DataFrame, labels: DataFrame, learn: Column, id: str = "doc_id", text: str = "text", label: str = "quality", settings: Settings = Settings()) -> DataFrame:
    """documents with score (0 to 1) and predicted (1 if score >= 0.5), learnt from labelled rows for which `learn` holds.

    Rows that repeat are scored alike, and an empty table gives no rows. A text's label, language,
    source and id have no part in its score.
    """
    return scored(documents, learnt(training_rows(documents, labels, learn, id, text, label, settings), settings), text)
