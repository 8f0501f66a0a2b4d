"""Toxicity of texts by a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

Texts are lower-cased and what is no letter or digit becomes one space, so n-grams see where words
begin and end. Of the hashed n-grams of 3 to 6 characters those stay whose share of texts differs
most surely between the classes. A text's value for an n-gram is (1 + log of its occurrences) times
the log of how much more often toxic texts hold it; a logistic model is fitted to these values.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import training_rows
from .sums import vector_sum
from .texts import blocks, mixed, strings

#: Code points below this are told apart as letters and digits or not; those above count as letters.
_KNOWN = 0x30000
_alphanumeric: list[np.ndarray] = []


@dataclass(frozen=True)
class Settings:
    """sizes: lengths of n-grams. bits: log2 of the hashed n-grams. kept: n-grams of the model. least: texts that
    must hold an n-gram. labels: most labelled ids that are learnt from, those with the smallest hashes.

    smoothing: added to the counts. shrink: weight of the squared weights. rounds: most steps of the fit.
    """

    sizes: tuple[int, ...] = (3, 4, 5, 6)
    bits: int = 19
    kept: int = 1000
    least: int = 3
    labels: int = 40_000
    smoothing: float = 1.0
    shrink: float = 1.0
    rounds: int = 100


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points, begins) of the texts for comparison, each between two spaces."""
    if not _alphanumeric:
        _alphanumeric.append(np.array([chr(c).isalnum() for c in range(_KNOWN)] + [True]))
    padded = [f" {t.lower()} " for t in texts]
    begins = np.concatenate(([0], np.cumsum([len(t) for t in padded]))).astype(np.int64)
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _alphanumeric[0][np.minimum(points, _KNOWN)]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    keep[begins[:-1]] = True
    return np.where(inside, points, 32)[keep], np.concatenate(([0], np.cumsum(keep)))[begins]


def ngrams(texts: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, text numbers, lengths of the texts): every occurrence of every hashed n-gram."""
    points, begins = characters(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))
    wide, sums = points.astype(np.uint64), np.zeros(len(points), np.uint64)
    features, rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size in range(1, min(max(settings.sizes), len(points)) + 1):
        sums = sums[: len(points) - size + 1] * np.uint64(0x9E3779B97F4A7C15) + wide[size - 1 :]
        if size in settings.sizes:
            whole = owner[: len(sums)] == owner[size - 1 :]
            hashed = mixed(sums[whole] + np.uint64(size)) >> np.uint64(64 - settings.bits)
            features.append(hashed.astype(np.int64))
            rows.append(owner[: len(sums)][whole])
    return np.concatenate(features), np.concatenate(rows), np.diff(begins)


def occurrences(features: np.ndarray, rows: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text numbers, features, counts) of the distinct n-grams of each text, in that order."""
    keys, counts = np.unique(rows << bits | features, return_counts=True)
    return keys >> bits, keys & ((1 << bits) - 1), counts


@dataclass
class Model:
    """places: for each hashed n-gram its number among those kept, or -1. weights: of those kept, by log-count ratio
    and fit, then of the log of the length. fixed: the score of every text where one class or none was learnt."""

    settings: Settings
    places: np.ndarray
    weights: np.ndarray
    bias: float
    fixed: float | None = None

    def values(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text numbers, kept n-grams, 1 + log of their counts, log of the lengths)."""
        features, rows, lengths = ngrams(texts, self.settings)
        found = self.places[features]
        held = found >= 0
        rows, found, counts = occurrences(found[held].astype(np.int64), rows[held], self.settings.bits)
        return rows, found, 1 + np.log(counts), np.log(lengths)

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.fixed is not None:
            return np.full(len(texts), self.fixed)
        rows, found, values, lengths = self.values(texts)
        margins = np.bincount(rows, weights=self.weights[found] * values, minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(margins + self.weights[-1] * lengths + self.bias, -500, 500)))


def chosen_ngrams(counts: np.ndarray, texts: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(places, log-count ratios of those kept) from the texts of each class that hold an n-gram."""
    size = 1 << settings.bits
    clean, toxic = counts[:size].astype(float), counts[size : 2 * size].astype(float)
    shares = [(n + settings.smoothing) / (total + 2 * settings.smoothing) for n, total in zip((clean, toxic), texts)]
    ratios = np.log(shares[1] / shares[0])
    pooled = (clean + toxic) / texts.sum()
    deviation = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / texts[0] + 1 / texts[1]))
    sureness = np.abs(toxic / texts[1] - clean / texts[0]) / deviation
    sureness[clean + toxic < settings.least] = 0
    kept = np.lexsort((np.arange(size), -sureness))[: settings.kept]
    kept = kept[sureness[kept] > 0]
    places = np.full(size, -1, np.int16 if settings.kept < 1 << 15 else np.int32)
    places[kept] = np.arange(len(kept))
    return places, ratios[kept]


def fitted(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, signs: np.ndarray, width: int, settings: Settings) -> np.ndarray:
    """Weights of a logistic model by limited-memory quasi-Newton steps; the last column, a constant, is not shrunk."""

    def loss(weights: np.ndarray) -> tuple[float, np.ndarray]:
        margins = signs * np.bincount(rows, weights=weights[columns] * values, minlength=len(signs))
        pull = -signs / (1 + np.exp(np.clip(margins, -500, 500)))
        slope = np.bincount(columns, weights=pull[rows] * values, minlength=width)
        shrunk = np.append(weights[:-1], 0.0) * settings.shrink
        return float(np.logaddexp(0, -margins).sum() + shrunk @ weights / 2), slope + shrunk

    weights = np.zeros(width)
    now, slope = loss(weights)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(settings.rounds):
        towards, parts = slope.copy(), []
        for moved, bent in reversed(steps):
            parts.append(moved @ towards / (moved @ bent))
            towards -= parts[-1] * bent
        towards *= steps[-1][0] @ steps[-1][1] / (steps[-1][1] @ steps[-1][1]) if steps else 1 / max(np.linalg.norm(slope), 1e-12)
        for (moved, bent), part in zip(steps, reversed(parts)):
            towards += moved * (part - bent @ towards / (moved @ bent))
        size = 1.0
        while True:
            tried = weights - size * towards
            then, new = loss(tried)
            if then <= now - 1e-4 * size * (slope @ towards) or size < 1e-6:
                break
            size /= 2
        if size < 1e-6:
            break
        if (tried - weights) @ (new - slope) > 1e-12:
            steps = [*steps[-7:], (tried - weights, new - slope)]
        done = now - then < 1e-6 * abs(now)
        weights, now, slope = tried, then, new
        if done:
            break
    return weights


def learnt(rows: DataFrame, settings: Settings = Settings()) -> Model:
    """A model of rows (id, text, label); label 0 or 1, others and null ones teach nothing.

    All rows count towards the log-count ratios; the fit takes one row of each id, of at most settings.labels
    ids with the smallest hashes. Without toxic rows every score is 0, with toxic rows alone 1.
    """
    rows = rows.filter("label in (0, 1)")
    size, bits = 1 << settings.bits, settings.bits

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(2 * size + 16, np.int64)
        for block in blocks(batches):
            labels = block.column("label").to_numpy().astype(np.int64)
            owner, features, _ = occurrences(*ngrams(strings(block), settings)[:2], bits)
            total[: 2 * size] += np.bincount(features + labels[owner] * size, minlength=2 * size)
            total[2 * size : 2 * size + 2] += np.bincount(labels, minlength=2)
        return total

    counts = vector_sum(rows.select("text", "label"), 2 * size + 16, count)
    texts = counts[2 * size : 2 * size + 2]
    if not texts.all():
        return Model(settings, np.zeros(0), np.zeros(0), 0.0, float(texts[1] > 0))
    places, ratios = chosen_ngrams(counts, texts, settings)
    model = Model(settings, places, np.zeros(len(ratios) + 1), 0.0)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # 2**bits small integers

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            owner, found, values, lengths = shared.value.values(strings(block))
            begins = np.searchsorted(owner, np.arange(block.num_rows + 1))
            packed = [
                found[i:j].astype("<i4").tobytes() + values[i:j].astype("<f4").tobytes() for i, j in zip(begins[:-1], begins[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), block.column("label"), pa.array(lengths), pa.array(packed, pa.binary())],
                ["id", "label", "length", "features"],
            )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taught = sorted(
            row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("label", "length", "features")))
        )
        owner, columns, values = [], [], []
        for number, (_, length, packed) in enumerate(taught):
            n = len(packed) // 8
            owner.append(np.full(n + 2, number))
            columns.append(np.append(np.frombuffer(packed, "<i4", n), [len(ratios), len(ratios) + 1]))
            own = np.frombuffer(packed, "<f4", n, 4 * n) * ratios[columns[-1][:n]]
            values.append(np.append(own, [length, 1.0]))
        signs = np.array([1.0 if label else -1.0 for label, _, _ in taught])
        weights = fitted(np.concatenate(owner), np.concatenate(columns), np.concatenate(values), signs, len(ratios) + 2, settings)
        yield pa.record_batch({"weights": pa.array([weights.tobytes()], pa.binary())})

    kind = rows.schema["id"].dataType.simpleString()
    extracted = rows.select("id", "text", F.col("label").cast("int").alias("label")).mapInArrow(extract, f"id {kind}, label int, length double, features binary")
    one = extracted.groupBy("id").agg(F.min(F.struct("label", "length", "features")).alias("row")).select("row.*")
    # Some dozens of numbers a text, of a bounded number of texts, go to one task, and its weights to the driver.
    weights = np.frombuffer(one.repartition(1).mapInArrow(fit, "weights binary").first()["weights"])
    return Model(settings, places, np.append(weights[:-2] * ratios, weights[-2]), float(weights[-1]))


def scored(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """documents with score and predicted set; a null text is an empty one. Other columns stay as they are."""
    rows = documents.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            scores = shared.value.scores(strings(block, text))
            new = {"score": pa.array(scores), "predicted": pa.array((scores >= 0.5).astype(np.int32))}
            yield pa.RecordBatch.from_arrays([new.get(n, block.column(n)) for n in block.schema.names], block.schema.names)

    return rows.mapInArrow(judge, rows.schema)


def classify(documents: DataFrame, labels: DataFrame, learn: Column, id: str = "doc_id", text: str = "text", label: str = "toxic", settings: Settings = Settings()) -> DataFrame:
    """documents with score (0 to 1) and predicted (1 if score >= 0.5), learnt from labelled rows for which `learn` holds.

    Ids with both labels, and null ids, teach nothing. Rows that repeat are scored alike, columns of the
    names `score` and `predicted` are replaced, and an empty table gives no rows. A text's label,
    language, source and id have no part in its score.
    """
    return scored(documents, learnt(training_rows(documents, labels, learn, id, text, label, settings), settings), text)
