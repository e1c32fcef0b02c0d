"""A unique, ordered key for every row of a document table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.session import materialise

KEY = "_llm_row_key"


def with_key(docs: DataFrame) -> DataFrame:
    """Adds the column ``KEY``: the doc_id itself, if ids are unique and not null.

    Otherwise rows are ordered by (doc_id, text), null ids first, and numbered: rows
    that share an id, or have none, are documents of their own that follow each
    other. The numbered table is stored, so a lost executor cannot renumber it.
    """
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if not ids.filter("n > 1 or doc_id is null").limit(1).count():
        return docs.withColumn(KEY, F.col("doc_id").cast("long"))
    order = ("doc_id", F.xxhash64("text"))
    dealt = docs.repartitionByRange(*order).sortWithinPartitions("doc_id", "text")
    # Range partitions are in order, so this rising number is the place in the whole table.
    return materialise(dealt.withColumn(KEY, F.monotonically_increasing_id()))
