"""Language of texts by a bit-sliced Bloom filter of n-grams.

For each language the n-grams (4 bytes of folded text) that are usual in it are put into a
Bloom filter. The filters of all languages share their probes: a cell holds one bit per language, in as many
words of 63 bits as needed, so the AND of a few cells is a mask of all languages that hold an n-gram. A text's masks are
counted by language, the expected false positives are taken off, and the largest share
decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written
from .texts import blocks, collapsed, folded, mixed

PROBES = 3
#: Languages in a word of a cell.
WORD = 63
#: Languages up to which the ids to learn from are sent to all tasks.
FEW = 256


@dataclass(frozen=True)
class Settings:
    """sample: most texts to learn from, for each language. bits: log2 of the cells.

    An n-gram belongs to a language if it makes up `least` of its n-grams or more, and
    `share` or more of what it makes up in the language where it is most usual.
    """

    sample: int = 4000
    bits: int = 20
    least: float = 2e-6
    share: float = 0.1


@dataclass
class Model:
    """languages: in order of their bits, WORD of them a word. cells: masks by word and cell."""

    languages: list[str]
    cells: np.ndarray
    bits: int

    def masks(self, codes: np.ndarray) -> np.ndarray:
        """For each word and n-gram the mask of the languages that seem to hold it."""
        found = np.full((len(self.cells), len(codes)), -1, np.int64)
        for cell in probes(codes, self.bits):
            found &= self.cells[:, cell]
        return found

    def false_positives(self) -> np.ndarray:
        """For each language the chance that an n-gram it does not hold seems to be held."""
        return np.array([np.mean(self.cells[k // WORD] >> k % WORD & 1) ** PROBES for k in range(len(self.languages))])


def probes(codes: np.ndarray, bits: int) -> list[np.ndarray]:
    spread = mixed(codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return [((spread >> np.uint64(21 * k)) & np.uint64((1 << bits) - 1)).astype(np.int64) for k in range(PROBES)]


def ngrams(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(codes, begins) of the n-grams of each text; digits count as spaces, and every text ends with two."""
    data, begins = folded(block)
    data[(data >= 48) & (data <= 57)] = 32
    data, begins = collapsed(data, begins)
    n = len(begins) - 1
    rows = np.repeat(np.arange(n), np.diff(begins))
    padded = np.full(len(data) + 3 * n, 32, np.uint64)
    padded[np.arange(len(data)) + 3 * rows + 1] = data
    if len(padded) < 4:
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    codes = padded[:-3] << np.uint64(24) | padded[1:-2] << np.uint64(16) | padded[2:-1] << np.uint64(8) | padded[3:]
    ends = begins + 3 * np.arange(n + 1)
    inside = np.ones(len(codes), bool)
    for back in range(1, 4):
        cut = ends[1:] - back
        inside[cut[(cut >= 0) & (cut < len(codes))]] = False
    return codes[inside], np.concatenate(([0], np.cumsum(inside)))[np.minimum(ends, len(codes))]


def learnt(rows: DataFrame, settings: Settings = Settings()) -> Model:
    """A model of the languages of rows (id, text, lang); null languages and texts teach nothing.

    At most settings.sample texts of a language are read, those with the smallest hashes
    of their id. Any number of languages is told apart.
    """
    usable = rows.filter("lang is not null and text is not null")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = usable.select("id", "lang").withColumn("n", F.row_number().over(order)).filter(F.col("n") <= settings.sample)
    chosen = chosen.select("id", "lang")
    if usable.select("lang").distinct().limit(FEW + 1).count() <= FEW:
        chosen = F.broadcast(chosen)  # bounded by settings.sample for each of them
    sample = usable.join(chosen, ["id", "lang"], "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            codes, begins = ngrams(block)
            languages, which = np.unique(np.array(block.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            owner = np.repeat(which, np.diff(begins))
            for k, language in enumerate(languages):
                found, counts = np.unique(codes[owner == k], return_counts=True)
                if len(found):
                    yield pa.record_batch(
                        {"lang": pa.array([str(language)] * len(found)), "code": pa.array(found.astype(np.int64)), "n": pa.array(counts.astype(np.int64))}
                    )

    counts = sample.select("text", "lang").mapInArrow(count, "lang string, code long, n long")
    counts = written(counts.groupBy("lang", "code").agg(F.sum("n").alias("n")), "ngrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    languages = sorted(row["lang"] for row in totals.select("lang").collect())
    rates = counts.join(totals, "lang").withColumn("rate", F.col("n") / F.col("total"))
    most = rates.groupBy("code").agg(F.max("rate").alias("most"))
    bits = [(language, k // WORD, 1 << k % WORD) for k, language in enumerate(languages)]
    bits = rows.sparkSession.createDataFrame(bits, "lang string, word int, bit long")
    usual = rates.join(most, "code").filter((F.col("rate") >= settings.least) & (F.col("rate") >= settings.share * F.col("most")))
    grams = usual.join(F.broadcast(bits), "lang").groupBy("code", "word").agg(F.bit_or("bit").alias("mask"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in probes(batch.column("code").to_numpy(), settings.bits):
                yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(cell), batch.column("mask")], ["word", "cell", "mask"])

    filled = grams.mapInArrow(deal, "word int, cell long, mask long").groupBy("word", "cell").agg(F.bit_or("mask").alias("mask"))
    cells = np.zeros((max(1, -(-len(languages) // WORD)), 1 << settings.bits), np.int64)
    found = filled.toPandas()  # one row per word and cell at most
    cells[found["word"].to_numpy(np.int64), found["cell"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64)
    return Model(languages, cells, settings.bits)


def predicted(rows: DataFrame, model: Model) -> DataFrame:
    """rows (id, text, held_out) as (id, held_out, lang_pred, score).

    lang_pred is `und` for a null text, a text without a letter, and where nothing was learnt. score is the
    share of the language among the corrected counts of all languages. Ties go to the first language.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)  # 2**bits masks for each word
    chance = model.false_positives()

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = np.array([*shared.value.languages, "und"], object)
        for block in blocks(batches):
            codes, begins = ngrams(block)
            masks = shared.value.masks(codes)
            totals = np.diff(begins)
            shares = np.zeros((block.num_rows, len(chance)))
            for k in range(len(chance)):
                hits = np.concatenate(([0], np.cumsum(masks[k // WORD] >> k % WORD & 1)))[begins]
                shares[:, k] = np.maximum(0, np.diff(hits) - totals * chance[k]) / (1 - min(chance[k], 0.999))
            known = block.column("letters").to_numpy(zero_copy_only=False).astype(bool) & (len(chance) > 0)
            best = shares.argmax(1) if len(chance) else np.zeros(block.num_rows, int)
            sums = shares.sum(1)
            score = np.divide(shares[np.arange(len(best)), best] if len(chance) else sums, sums, out=np.zeros(len(sums)), where=sums > 0)
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), block.column("held_out"), pa.array(languages[np.where(known, best, len(chance))], pa.string()), pa.array(np.where(known, score, 0.0))],
                ["id", "held_out", "lang_pred", "score"],
            )

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "held_out", "text", letters).mapInArrow(decide, f"id {kind}, held_out boolean, lang_pred string, score double")


def identify(documents: DataFrame, learn: Column, held_out: Column, id: str = "doc_id", text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """(id, held_out, lang_pred, score) of all documents, learnt from the rows for which `learn` holds.

    Rows that repeat teach and are predicted as often as they occur; other columns are not read. An
    empty table gives no rows.
    """
    training = documents.filter(learn).select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    model = learnt(training, settings)
    rows = documents.select(F.col(id).alias("id"), held_out.alias("held_out"), F.col(text).alias("text"))
    return predicted(rows, model).withColumnRenamed("id", id)
