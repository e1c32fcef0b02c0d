"""Event-time streams: running experiment metrics and value percentiles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.operators import experiments, ordered
from reviewmill.sources import writers

#: Size of a quantile sketch, and the rank error of a mark read from it (99 % sure, also after merging).
SKETCH_K = 2048
SKETCH_RANK_ERROR = 0.002

#: An end-of-input marker lies this long after the newest event; more than a window and the allowed lateness.
GAP = "3 days"

EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def event_stream(
    spark: SparkSession, folder: str, pattern: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Events arriving as Parquet files; event times are UTC."""
    reader = spark.readStream.schema(EVENT)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # Event-time operators want an instant; the wall clock is read as UTC.
    return reader.parquet(folder).withColumn("ts", F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()))


def metric_windows(events: DataFrame, window: str, lateness: str, split: float = 0.5) -> DataFrame:
    """Per (window, metric, group): n, sum and sum of squares, all that the t test needs."""
    user = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    return (
        events.withWatermark("ts", lateness)
        .groupBy(
            F.window("ts", window),
            F.col("event_type").alias("metric"),
            experiments.group_of(user, split).alias("group"),
        )
        .agg(
            F.count("value").alias("n"),
            F.sum("value").alias("total"),
            F.sum(F.col("value") * F.col("value")).alias("total_squares"),
        )
        .select(
            F.unix_seconds("window.start").alias("window_start"), "metric", "group", "n", "total", "total_squares"
        )
    )


def percentile_windows(events: DataFrame, window: str, lateness: str, accuracy: int = 100_000) -> DataFrame:
    """Per window: count, mean and approximate 95th / 99th percentile of the value."""
    return (
        events.withWatermark("ts", lateness)
        .groupBy(F.window("ts", window))
        .agg(
            F.count("value").alias("n"),
            F.avg("value").alias("mean"),
            F.percentile_approx("value", [0.95, 0.99], accuracy).alias("__p"),
        )
        .select(
            F.unix_seconds("window.start").alias("window_start"),
            "n",
            "mean",
            F.col("__p")[0].alias("p95"),
            F.col("__p")[1].alias("p99"),
        )
    )


def sketch_windows(events: DataFrame, window: str, lateness: str, k: int = SKETCH_K) -> DataFrame:
    """Per window: count, total and a quantile sketch of the value, all of which add up over windows."""
    return (
        events.withWatermark("ts", lateness)
        .groupBy(F.window("ts", window))
        .agg(
            F.count("value").alias("n"),
            F.sum("value").alias("total"),
            F.kll_sketch_agg_double("value", k).alias("sketch"),
        )
        .select(F.unix_seconds("window.start").alias("window_start"), "n", "total", "sketch")
    )


def merged_percentiles(table: DataFrame, keys: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """(keys, n, mean, p95, p99) over any grouping of stored windows, without their rows.

    Sketches merge like sums, on the map side first. A group without values has null marks.
    """
    merged = table.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("__total"),
        F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("sketch")), k).alias("__s"),
    )

    def mark(share: float) -> Column:
        return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("__s", F.lit(share)))

    return merged.select(
        *keys, "n", F.try_divide("__total", "n").alias("mean"), mark(0.95).alias("p95"), mark(0.99).alias("p99")
    )


def run_to_end(
    spark: SparkSession,
    folder: str,
    transform: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    gap: str,
    **source,
) -> DataFrame:
    """Runs a windowed stream over a finished input and closes its last window too.

    The watermark follows the events, so a stream that has read everything still waits
    with its newest windows open. An end-of-input marker, a row without values
    later than ``gap`` after the newest event, comes in over a second folder and moves the
    watermark past them. The marker's own window stays open and is never written.
    """
    marks = f"{checkpoint}-end"
    spark.createDataFrame([], EVENT).write.mode("append").parquet(marks)

    def go() -> None:
        events = event_stream(spark, folder, **source).unionByName(event_stream(spark, marks))
        run_available(transform(events), out, checkpoint)

    go()
    batch = spark.read.schema(EVENT)
    if source.get("pattern"):
        batch = batch.option("pathGlobFilter", source["pattern"])
    end = batch.parquet(folder).agg((F.max("ts") + F.expr(f"interval {gap}")).alias("ts")).filter("ts is not null")
    marker = end.select(*[F.col(f.name) if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in EVENT])
    marker.write.mode("append").parquet(marks)
    go()
    return spark.read.parquet(out)


def run_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Processes everything there is and stops; windows are appended once the watermark passes them."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_ab_metrics(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    window: str = "1 day",
    lateness: str = "1 hour",
    split: float = 0.5,
    **source,
) -> DataFrame:
    """Appends closed metric windows to ``out`` and returns the table; a rerun resumes from the checkpoint."""
    run_available(metric_windows(event_stream(spark, folder, **source), window, lateness, split), out, checkpoint)
    return spark.read.parquet(out)


def metric_events(events: DataFrame, test_id: str, lateness: str, split: float = 0.5) -> DataFrame:
    """The metric log rows of an event stream; an event that is delivered again within ``lateness`` counts once."""
    once = events.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["event_id"])
    user = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    return once.filter(F.col("event_id").isNotNull()).select(
        "event_id", F.lit(test_id).alias("test_id"), user.alias("user_id"), experiments.group_of(user, split).alias("group"),
        F.col("event_type").alias("metric"), "value", "ts",
    )


def stream_metric_log(
    spark: SparkSession, folder: str, path: str, checkpoint: str, test_id: str, lateness: str = "1 hour",
    split: float = 0.5, **source,
) -> DataFrame:
    """Appends the metric rows of new events to the versioned table at ``path`` and returns the table.

    Every micro-batch is one commit that carries the batch's number. If a run dies after the commit and before the
    checkpoint, the batch is run again under the same number and adds nothing. One checkpoint is one writer.
    """

    def append(rows: DataFrame, number: int) -> None:
        if writers.append_table(rows, path, f"metrics:{test_id}", number) is None:
            # The state of the stream has to go on although the table has these rows.
            rows.write.format("noop").mode("append").save()

    events = event_stream(spark, folder, **source)
    query = (
        metric_events(events, test_id, lateness, split).writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return writers.read_table(spark, path)


def ab_metrics_to_end(
    spark: SparkSession, folder: str, out: str, checkpoint: str, window: str = "1 day", lateness: str = "1 hour",
    split: float = 0.5, **source,
) -> DataFrame:
    """``stream_ab_metrics`` over a finished input: every window is written."""
    return run_to_end(
        spark, folder, lambda e: metric_windows(e, window, lateness, split), out, checkpoint, GAP, **source
    )


def value_percentiles_to_end(
    spark: SparkSession, folder: str, out: str, checkpoint: str, window: str = "1 day", lateness: str = "1 hour", **source
) -> DataFrame:
    return run_to_end(spark, folder, lambda e: percentile_windows(e, window, lateness), out, checkpoint, GAP, **source)


def value_sketches_to_end(
    spark: SparkSession, folder: str, out: str, checkpoint: str, window: str = "1 day", lateness: str = "1 hour", **source
) -> DataFrame:
    """The stored sketches of a finished input, one row per window."""
    return run_to_end(spark, folder, lambda e: sketch_windows(e, window, lateness), out, checkpoint, GAP, **source)


def stream_value_percentiles(
    spark: SparkSession, folder: str, out: str, checkpoint: str, window: str = "1 day", lateness: str = "1 hour", **source
) -> DataFrame:
    run_available(percentile_windows(event_stream(spark, folder, **source), window, lateness), out, checkpoint)
    return spark.read.parquet(out)


def value_percentiles(events: DataFrame, unit: str = "day") -> DataFrame:
    """The batch form with exact interpolated percentiles, safe for a window that holds most rows."""
    keyed = events.select(F.date_trunc(unit, F.col("ts")).cast("timestamp_ntz").alias("window_start"), "value")
    dist = ordered.distribution(keyed.filter(F.col("value").isNotNull()), ["window_start"])
    marks = ordered.quantiles(dist, ["window_start"], {"p95": 0.95, "p99": 0.99})
    return ordered.moments(dist, ["window_start"]).select("window_start", "n", "mean").join(marks, "window_start")
