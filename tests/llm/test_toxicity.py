"""The toxicity classifier on planted words, and its pieces against plain Python."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import queries, toxicity
from ledgerloom.llm.toxicity import Settings
from tests.llm.samples import documents, messy, prose, words


def test_ngrams_are_those_of_plain_python():
    texts = ["Ab, c!", "", "!!", "ÜBER-all 日本", "a  b\n\tc", "x"]
    settings = Settings(sizes=(2, 3), bits=40)
    features, rows, lengths = toxicity.ngrams(texts, settings)
    plain = [re.sub(r"[\W_]+", " ", f" {t.lower()} ") for t in texts]
    assert lengths.tolist() == [len(t) for t in plain]
    expected = [Counter(t[k : k + n] for n in (2, 3) for k in range(len(t) - n + 1)) for t in plain]
    for k, grams in enumerate(expected):
        found = Counter(features[rows == k].tolist())
        assert sorted(found.values()) == sorted(grams.values())
        alone, own, _ = toxicity.ngrams([texts[k]], settings)
        assert Counter(alone.tolist()) == found and not own.any()


def test_the_fit_has_no_slope_left():
    made = np.random.Generator(np.random.PCG64(3))
    x = made.normal(size=(80, 5))
    x[:, -1] = 1
    signs = np.where(x[:, 0] + 0.3 * made.normal(size=80) > 0.2, 1.0, -1.0)
    rows, columns = (a.ravel() for a in np.indices(x.shape))
    weights = toxicity.fitted(rows, columns, x.ravel(), signs, 5, Settings())
    slope = -(x * (signs / (1 + np.exp(signs * (x @ weights))))[:, None]).sum(0) + np.append(weights[:-1], 0)
    assert np.abs(slope).max() < 0.05


def test_log_count_ratios_and_choice():
    settings = Settings(bits=2, kept=2, least=2)
    counts = np.array([5, 0, 3, 1, 5, 6, 3, 0] + [0] * 16)
    places, ratios = toxicity.chosen_ngrams(counts, np.array([10, 10]), settings)
    assert places.tolist() == [-1, 0, -1, -1] and np.allclose(ratios, [np.log(7)])


def test_planted_words_in_long_and_short_texts(spark):
    made = random.Random(1)
    insults = ["vorgut", "blask", "snirkel"]
    texts, toxic = [], []
    for k in range(400):
        parts = words(k, made.choice([4, 60, 900]))
        toxic.append(k % 5 == 0)
        if toxic[-1]:
            for _ in range(1 + len(parts) // 60):
                parts.insert(made.randrange(len(parts)), made.choice(insults))
        texts.append(" ".join(parts))
    labels = spark.createDataFrame([(k, int(t)) for k, t in enumerate(toxic)], "doc_id long, toxic int")
    found = toxicity.classify(documents(spark, texts), labels, learn=F.col("doc_id") % 2 == 0).collect()
    held = [r for r in found if r.doc_id % 2]
    assert sum(r.predicted == toxic[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and (r.score >= 0.5) == (r.predicted == 1) for r in found)


def test_held_out_documents(spark, sample_folder):
    found = queries.op13_toxicity(spark, sample_folder).join(queries.table(spark, sample_folder, "labels"), "doc_id")
    rows = found.filter("held_out and toxic is not null").collect()
    assert len(rows) > 60 and sum(r.toxic == r.predicted for r in rows) >= 0.93 * len(rows)


def test_messy_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (6, 0), (7, 0), (8, 1), (8, 0), (None, 1), (2, None), (9, 7)], "doc_id long, toxic int")
    docs = messy(spark)
    rows = toxicity.classify(docs, labels, F.lit(True))
    assert rows.columns == docs.columns and rows.count() == docs.count()
    assert len({(r.text, r.score) for r in rows.collect()}) == len({r.text for r in rows.collect()})
    assert toxicity.classify(docs.limit(0), labels, F.lit(True)).collect() == []
    for some, expected in ((labels.limit(0), 0), (labels.filter("toxic = 0"), 0), (labels.filter("doc_id = 1"), 1)):
        assert {r.predicted for r in toxicity.classify(docs, some, F.lit(True)).collect()} == {expected}
    # A third of all rows with one id: one of them is fitted to.
    many = documents(spark, [prose(k) for k in range(20)]).union(documents(spark, [prose(0)] * 10).withColumn("doc_id", F.lit(0).cast("long")))
    few = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, toxic int")
    assert toxicity.classify(many, few, F.lit(True)).count() == 30
