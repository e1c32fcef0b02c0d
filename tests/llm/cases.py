"""Odd document tables that every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHES = "key at n fp score predicted component_id items runs y print owner part rank length h1 piece".split()


def passage(seed: int, words: int) -> str:
    rng = random.Random(seed)
    stems = "lo mar ten vi qua shi or ble dun ka ser pol nit".split()
    return " ".join("".join(rng.choices(stems, k=rng.randint(1, 4))) for _ in range(words))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows, shared passages."""
    shared, common = passage(1, 60), passage(2, 25)
    rows = [
        (1, passage(3, 50) + " " + shared, "en", "a", 1),
        (2, shared + " " + passage(4, 50), "de", "a", 2),
        (3, passage(5, 30) + "\n" + common + "\t" + passage(6, 30), None, None, None),
        (4, common, "fr", "b", 4),
        (5, "", "en", "b", 0),
        (6, None, "en", None, None),
        (7, " \n\t ", None, "b", 4),
        (8, "one", "en", "b", 3),
        (9, passage(7, 6000) + " " + shared, "en", "a", 9),
        (9, passage(7, 6000) + " " + shared, "en", "a", 9),  # the same row once more
        (9, passage(8, 40), "es", "c", 9),  # another text under the same id
        (None, passage(3, 50) + " " + shared, "en", "a", 1),
        (None, None, None, None, None),
        (None, None, None, None, None),
        (12, "Été ÉTÉ été “ß” 日本語 \u0000 x", "fr", "c", 9),
        (13, "spam " * 300, "en", "c", 9),
        (14, "a" * 5000, "en", "c", 9),
        (15, passage(3, 50) + " " + shared, "en", "a", 1),
    ]
    return rows


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(df):
    from pyspark.sql import functions as F

    for name in CLASHES:
        df = df.withColumn(name, F.lit(name))
    return df
