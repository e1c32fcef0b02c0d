"""A bounded sample of labelled documents, for operators that fit a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import common
from reviewmill.session import materialise


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, folds: int, held: int) -> DataFrame:
    """(doc_id, text, y): at most ``rows`` labelled documents whose fold is not ``held``, stored.

    Chosen by a hash of the id, so that the choice does not depend on the order
    of the tables. Null ids and labels take no part; of repeated ids one row counts,
    of repeated labels the largest.
    """
    wanted = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .filter(common.fold(F.col("doc_id"), folds) != held)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col(label).cast("int")).alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # At most ``rows`` pairs of two numbers: small enough for every executor.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "y").agg(F.max("text").alias("text"))
    return materialise(found)
