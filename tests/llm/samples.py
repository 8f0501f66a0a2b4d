"""Small tables for the operators of ledgerloom.llm."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "ka lo mi ter an sul pre von da ri eth gan bro ple ust om".split()


def words(seed, n):
    made = random.Random(seed)
    return ["".join(made.choice(SYLLABLES) for _ in range(made.randint(1, 4))) for _ in range(n)]


def prose(seed, n=60):
    return " ".join(words(seed, n)).capitalize() + "."


def changed(text, seed, n):
    """text with n of its words replaced."""
    made, parts = random.Random(seed), text.split()
    for at in made.sample(range(len(parts)), n):
        parts[at] = f"new{made.randint(0, 10**6)}"
    return " ".join(parts)


def documents(spark, texts):
    rows = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def messy(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, and columns with the operators' own names."""
    long = " ".join(words(1, 4000))
    rows = [
        (1, prose(1), "en", "s", 1),
        (1, prose(1), "en", "s", 1),
        (1, prose(2), "en", "s", 1),
        (None, prose(1), "en", "s", None),
        (None, None, None, None, None),
        (2, None, "en", "s", 0),
        (3, "", "en", "s", 0),
        (4, " \n\n ", None, "s", 4),
        (5, "!!! ??", "en", None, 6),
        (6, long, "en", "s", len(long)),
        (7, "x" * 100_000, "en", "s", 100_000),
        (8, "Ünïcode “quotes” 日本語 — ok\tand a tab\r\nline", "fr", "s", 9),
        (9, prose(3) + "\n" + prose(1), "en", "s", 9),
    ]
    out = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "node", "label", "quality", "number", "line", "row", "item_id", "group", "score", "predicted", "n", "key", "held_out"):
        out = out.withColumn(name, F.lit("clash"))
    return out


ROWS = 13
