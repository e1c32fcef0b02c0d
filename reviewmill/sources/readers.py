"""Sources: JSON lines, gzip JSON, CSV, and the three ways to take fewer rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.schemas import CLEANED_REVIEW

BAD_LINE = "_bad_line"


def spread_small(df: DataFrame) -> DataFrame:
    """Repartitions a scan that yields fewer tasks than cores (one small or unsplittable file)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < min(cores, 64) else df


def read_reviews(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = CLEANED_REVIEW,
    partitions: int | None = None,
) -> DataFrame:
    """JSON lines; ``schema=None`` infers it (an extra pass over the data).

    ``.json.gz`` files are read too; gzip cannot be split, so give
    ``partitions`` to spread such a file over the cluster after the scan.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.json(path)
    return df.repartition(partitions) if partitions else df


def read_reviews_checked(
    spark: SparkSession, path: str | list[str], schema: T.StructType = CLEANED_REVIEW
) -> tuple[DataFrame, DataFrame]:
    """(good records, malformed lines).

    Lines are read as text and parsed by an expression, so both results prune
    and filter as usual; the second has one column with the raw line.
    """
    with_bad = T.StructType(schema.fields + [T.StructField(BAD_LINE, T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select(
        F.from_json("value", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}).alias("r")
    )
    good = parsed.filter(F.col(f"r.{BAD_LINE}").isNull()).select("r.*").drop(BAD_LINE)
    bad = parsed.filter(F.col(f"r.{BAD_LINE}").isNotNull()).select(F.col(f"r.{BAD_LINE}").alias("line"))
    return good, bad


def read_features(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header; ``review_timestamp`` becomes a timestamp."""
    reader = spark.read.option("header", True).option("multiLine", False)
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    if "review_timestamp" in df.columns:
        df = df.withColumn("review_timestamp", F.col("review_timestamp").cast("timestamp_ntz"))
    return df


def limit_rows(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """The first n rows in a total order (a top-n, never a full sort)."""
    return df.orderBy(*order).limit(n)


def sample_fraction(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Bernoulli sample of about n rows; the table is counted once."""
    total = df.count()
    return df if total <= n else df.sample(False, n / total, seed)


def sample_exact(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly n rows (or all), chosen by a seeded hash of ``keys``, whatever the partitioning."""
    return df.orderBy(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), *keys).limit(n)
