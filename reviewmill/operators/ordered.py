"""Ordered computations that survive hot keys.

A plain ``Window.partitionBy(key)`` sends one key to one task. Here a key
that holds more than ``HOT_ROWS`` rows is range-partitioned along the window
order instead, so its rows spread over many tasks, and only small per-slice
totals are carried from slice to slice. The remaining keys keep the ordinary
single-shuffle window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewmill.operators.joins import attach_totals, same_keys
from reviewmill.session import materialise

HOT_ROWS = 5_000_000  # one sorted task of this many narrow rows is still comfortable
BLOCK_ROWS = 1_000_000  # rows of a hot key that share one frame computation
SLICE_ROWS = 2_000_000  # rows of a slice of running totals, where the table's size is known
SMALL_TABLE = 200_000  # (key, value) groups below which one task may hold a key's values


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    amounts: dict[str, Column],
    rows: int | None = None,
) -> DataFrame:
    """Adds inclusive running sums along ``order`` within ``keys``.

    Works for any key size: range partitions on (keys, order), sums inside a
    slice with a local window, and adds the totals of earlier slices, of which
    there are at most (#keys + #partitions). ``rows``, if known, sets the number of
    slices, so that none holds many more than ``SLICE_ROWS``.
    """
    keys = list(keys)
    staged = df
    for name, amount in amounts.items():
        staged = staged.withColumn(f"__amt_{name}", amount)
    slices = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(rows or 0) // SLICE_ROWS))
    placed = materialise(
        staged.repartitionByRange(slices, *_columns(keys), *order).withColumn("__slice", F.spark_partition_id())
    )
    totals = placed.groupBy(*keys, "__slice").agg(
        *[F.sum(f"__amt_{n}").alias(f"__tot_{n}") for n in amounts]
    )
    earlier = W.partitionBy(*keys).orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    # Stored, so that its true size decides between broadcast and shuffle.
    carried = materialise(totals.select(
        *[F.col(k).alias(f"__key_{k}") for k in keys],
        F.col("__slice").alias("__slice_at"),
        *[
            F.coalesce(F.sum(f"__tot_{n}").over(earlier), F.lit(0)).alias(f"__off_{n}")
            for n in amounts
        ],
    ))
    inside = (
        W.partitionBy(*keys, "__slice").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    match = F.col("__slice") == F.col("__slice_at")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    local = placed
    for n in amounts:
        local = local.withColumn(f"__run_{n}", F.sum(f"__amt_{n}").over(inside))
    joined = local.join(carried, match, "inner")
    return joined.select(
        *df.columns, *[(F.col(f"__run_{n}") + F.col(f"__off_{n}")).alias(n) for n in amounts]
    )


def group_totals(
    counts: DataFrame, keys: Sequence[str], value: str, amounts: dict[str, Column], small: int | None = None
) -> DataFrame:
    """Running sums over an already aggregated (keys, value) table.

    The table is written once; when it is provably small a plain window is
    enough, otherwise it takes the range-partitioned way.
    """
    small = SMALL_TABLE if small is None else small
    fixed = materialise(counts)
    if fixed.limit(small + 1).count() > small:
        return materialise(running_totals(fixed, keys, [F.col(value)], amounts, fixed.count()))
    span = W.partitionBy(*keys).orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    return fixed.select("*", *[F.sum(a).over(span).alias(n) for n, a in amounts.items()])


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Keys with more than ``hot_rows`` rows; there are at most N / hot_rows of them."""
    limit = HOT_ROWS if hot_rows is None else hot_rows
    return df.groupBy(*keys).count().filter(F.col("count") > limit).drop("count")


def split_hot(
    df: DataFrame, keys: Sequence[str], hot_rows: int | None = None, base: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """(cold rows, hot rows or None). A null key is a key like any other.

    ``base`` may name a cheaper frame with the same rows per key to count on.
    """
    hot = materialise(hot_keys(df if base is None else base, keys, hot_rows))
    if hot.isEmpty():
        return df, None
    named = hot.select(*[F.col(k).alias(f"__hot_{k}") for k in keys])
    match = same_keys(df, list(keys), "__hot_")
    return df.join(named, match, "left_anti"), df.join(named, match, "left_semi")


def _number_hot(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    # Copies of one row compare equal in any order; a row id taken from the
    # written file separates them so that a group of copies can be split too.
    stored = materialise(rows)
    fixed = stored.withColumn("__tie", F.monotonically_increasing_id())
    ones = {name: F.lit(1).cast("long")}
    return running_totals(fixed, keys, [*order, F.col("__tie")], ones, stored.count()).drop("__tie")


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """``row_number`` per key, with hot keys spread over many tasks."""
    cold, hot = split_hot(df, keys, hot_rows)
    plain = cold.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long"))
    if hot is None:
        return plain
    return plain.unionByName(_number_hot(hot, keys, order, name))


def sliding(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    width: int,
    exprs: Callable[[W], dict[str, Column]],
    hot_rows: int | None = None,
    block_rows: int | None = None,
    base: DataFrame | None = None,
) -> DataFrame:
    """Adds columns computed over the last ``width`` rows of each key.

    ``exprs`` receives an ordered window spec without frame and returns the
    columns; a frame may look back at most ``width - 1`` rows. Hot keys are cut
    into blocks of consecutive rows, and each block is given the ``width - 1``
    rows before it.
    """
    block_rows = BLOCK_ROWS if block_rows is None else block_rows
    cold, hot = split_hot(df, keys, hot_rows, base)
    plain = cold.select("*", *[c.alias(n) for n, c in exprs(W.partitionBy(*keys).orderBy(*order)).items()])
    if hot is None:
        return plain
    numbered = _number_hot(hot, keys, order, "__rn")
    at = F.col("__rn") - 1
    home = F.floor(at / block_rows)
    spills = (at % block_rows) >= block_rows - (width - 1)
    cut = numbered.withColumn("__home", home).withColumn(
        "__block", F.explode(F.when(spills, F.array(home, home + 1)).otherwise(F.array(home)))
    )
    spec = W.partitionBy(*keys, "__block").orderBy("__rn")
    names = exprs(spec)
    done = (
        cut.select("*", *[c.alias(n) for n, c in names.items()])
        .filter(F.col("__home") == F.col("__block"))
        .select(*df.columns, *names)
    )
    return plain.unionByName(done)


def unpivot(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Long form (keys, column, value as double); nulls and NaN are dropped."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    )
    return (
        df.select(*keys, pairs.alias("__p"))
        .select(*keys, "__p.column", "__p.value")
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    )


def distribution(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, value, copies, cum, rows): counts per distinct value with running and grand totals.

    The one pass over the data behind ranks, quantiles, moments and outlier
    counts. Copies of a value collapse before the shuffle; the result is stored,
    so everything derived from it reads the small table.
    """
    keys = list(keys)
    counts = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("copies"))
    cum = group_totals(counts, keys, "value", {"cum": F.col("copies")})
    totals = cum.groupBy(*keys).agg(F.max("cum").alias("rows"))
    # One row per key. Stored, so that its size is known and the value table need not move for the join.
    joined = cum.join(materialise(totals), keys) if keys else attach_totals(cum, totals)
    return joined.select(*keys, "value", "copies", "cum", "rows")


def rank_percent() -> Column:
    """Average-rank percentile over a ``distribution``: (rows below + (copies + 1) / 2) / rows."""
    return (F.col("cum") - F.col("copies") + (F.col("copies") + 1) / F.lit(2.0)) / F.col("rows")


def quantiles(dist: DataFrame, keys: Sequence[str], qs: dict[str, float]) -> DataFrame:
    """Exact linear-interpolation quantiles per key, from the two order statistics around each."""
    aggs = []
    for name, q in qs.items():
        position = F.lit(float(q)) * (F.col("rows") - 1)
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            held = (F.col("cum") - F.col("copies") <= rank) & (rank < F.col("cum"))
            aggs.append(F.max(F.when(held, F.col("value"))).alias(f"__{name}_{side}"))
    picked = dist.groupBy(*keys).agg(F.max("rows").alias("rows"), *aggs)
    out = []
    for name, q in qs.items():
        position = F.lit(float(q)) * (F.col("rows") - 1)
        low, high = F.col(f"__{name}_lo"), F.col(f"__{name}_hi")
        out.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return picked.select(*keys, *out)


def moments(dist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n, mean, std, min, max) of a distribution; sample standard deviation, null for n = 1."""
    value, copies = F.col("value"), F.col("copies")
    mean = F.sum(value * copies) / F.sum(copies)
    first = dist.groupBy(*keys).agg(
        F.sum("copies").alias("n"), mean.alias("mean"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    first = materialise(first) if keys else first
    centred = dist.join(first.select(*keys, "mean"), list(keys)) if keys else attach_totals(dist, first.select("mean"))
    spread = centred.groupBy(*keys).agg(
        F.sum(copies * (value - F.col("mean")) * (value - F.col("mean"))).alias("__ss"), F.sum("copies").alias("__n")
    )
    std = F.sqrt(F.try_divide("__ss", F.col("__n") - 1))
    joined = first.join(spread, list(keys)) if keys else attach_totals(first, spread)
    return joined.select(*keys, "n", "mean", std.alias("std"), "min", "max")
