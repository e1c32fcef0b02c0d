"""Toxic documents out, near copies out, repeated passages out, benchmark leaks out, then packed sequences.

Every stage takes the whole result of the one before it. The first four return the
columns of ``documents``:

* ``toxicity``: rows that the classifier rejects go;
* ``near_copies``: of each component of texts with five-word Jaccard similarity of at least 0.8 the row with
  the smallest doc_id stays;
* ``repeated_windows``: words inside a window of 20 words that also starts earlier go;
* ``benchmark``: rows that share a window of ten words with a benchmark item go;
* ``pack``: one row per piece of a document with its place in a sequence of at most 4096 tokens.

A stage's intermediate tables are deleted when the next one begins, unless that one still reads them.

Odd rows are treated as the modules define (nulls, empty texts, repeated ids).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewmill.llm import packing, simhash, toxicity, windows, winnowing
from reviewmill.llm.common import table
from reviewmill.session import materialise, step_tables


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with step_tables(docs, first=True):
        return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with step_tables(docs):
        return simhash.one_of_each(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with step_tables(docs):
        return windows.remove_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with step_tables(docs):
        return winnowing.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with step_tables(docs):
        return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeated_windows", remove_repeats),
    ("benchmark", drop_leaks),
    ("pack", pack),
]

#: The stages tokenise, hash and learn, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's rows are stored before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialise(docs)
    return docs
