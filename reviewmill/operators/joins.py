"""Join shapes used across the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.session import materialise


def attach_totals(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Adds the columns of a grand total (an aggregate without keys) to every row.

    A scalar subquery: Spark evaluates the total once, checks that it is one
    row, and every task sees it as a constant; no join takes place.
    """
    total = totals.select(F.struct(*totals.columns)).scalar().alias("__totals")
    kept = [F.col(c) for c in df.columns]
    return df.select(*kept, total).select(*kept, "__totals.*")


def same_keys(df: DataFrame, keys: list[str], prefix: str) -> Column:
    """Equality of the key columns with their prefixed twins; nulls are equal to each other."""
    match = F.lit(True)
    for k in keys:
        match = match & df[k].eqNullSafe(F.col(prefix + k))
    return match


def attach_stats(
    df: DataFrame, stats: DataFrame, key: str | list[str], null_safe: bool = False, broadcast_rows: int | None = None
) -> DataFrame:
    """Left join of per-key statistics.

    No hint by default: user and product tables grow with the data, so the
    size check that picks broadcast or sort-merge is left to the planner, and
    adaptive execution splits skewed partitions of the review side. With
    ``broadcast_rows`` the statistics are stored and counted, and sent to every executor only if there
    are at most so many of them. ``null_safe`` lets null keys meet.
    """
    if broadcast_rows is not None:
        stats = materialise(stats)
        if stats.limit(broadcast_rows + 1).count() <= broadcast_rows:
            stats = F.broadcast(stats)
    if not null_safe:
        return df.join(stats, key, "left")
    keys = [key] if isinstance(key, str) else list(key)
    renamed = stats.select(*[F.col(c).alias(f"__at_{c}" if c in keys else c) for c in stats.columns])
    return df.join(renamed, same_keys(df, keys, "__at_"), "left").drop(*[f"__at_{k}" for k in keys])
