from pyspark.sql import functions as F

from reviewmill.streaming import experiments as streams


def put(spark, rows, folder):
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(folder)


def event(i, ts, value=1.0, user=1):
    return (i, ts, user, "view", value, "{}")


def test_stream_equals_batch_and_drops_late_rows(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    put(spark, [event(1, "2024-01-01 01:00:00", 2.0), event(2, "2024-01-01 23:00:00", 4.0)], src)
    streams.stream_ab_metrics(spark, src, out, state)
    put(spark, [event(3, "2024-01-03 12:00:00")], src)
    streams.stream_ab_metrics(spark, src, out, state)
    # Two days behind the watermark: too late for its window.
    put(spark, [event(4, "2024-01-01 02:00:00", 100.0), event(5, "2024-01-05 12:00:00")], src)
    table = streams.stream_ab_metrics(spark, src, out, state)
    rows = sorted((r.window_start, r.n, r.total, r.total_squares) for r in table.collect())
    assert rows == [(1704067200, 2, 6.0, 20.0), (1704240000, 1, 1.0, 1.0)]


def test_percentile_stream(spark, tmp_path):
    src = str(tmp_path / "src")
    put(spark, [event(i, "2024-01-01 10:00:00", float(i)) for i in range(1, 101)], src)
    put(spark, [event(200, "2024-01-03 00:00:00")], src)
    table = streams.stream_value_percentiles(spark, src, str(tmp_path / "out"), str(tmp_path / "state"))
    row = table.first()
    assert (row.n, row.mean, row.p95, row.p99) == (100, 50.5, 95.0, 99.0)


def test_metric_log_counts_events_once(spark, tmp_path):
    """Repeated and late events, and a batch whose checkpoint was lost after its commit."""
    src, table, state = (str(tmp_path / n) for n in ("src", "table", "state"))
    put(spark, [event(1, "2024-01-01 01:00:00", 2.0), event(1, "2024-01-01 01:00:00", 2.0), event(2, "2024-01-01 01:10:00", 3.0)], src)
    assert streams.stream_metric_log(spark, src, table, state, "t").count() == 2
    put(spark, [event(2, "2024-01-01 01:10:00", 3.0), event(3, "2024-01-01 03:30:00", 4.0, user=7)], src)
    log = streams.stream_metric_log(spark, src, table, state, "t")
    assert sorted((r.event_id, r.user_id, r.value) for r in log.collect()) == [
        (1, "user_1", 2.0), (2, "user_1", 3.0), (3, "user_7", 4.0)
    ]
    # Older than the watermark: dropped.
    put(spark, [event(4, "2024-01-01 00:10:00", 100.0), event(5, "2024-01-01 03:40:00", 5.0)], src)
    assert sorted(r.event_id for r in streams.stream_metric_log(spark, src, table, state, "t").collect()) == [1, 2, 3, 5]
    # Another checkpoint, as if the first were lost: its numbers start again, the table has seen them.
    again = streams.stream_metric_log(spark, src, table, str(tmp_path / "other"), "t")
    assert sorted(r.event_id for r in again.collect()) == [1, 2, 3, 5]
    # A commit without its checkpoint entry: the batch is run again.
    put(spark, [event(6, "2024-01-01 03:50:00")], src)
    streams.stream_metric_log(spark, src, table, state, "t")
    last = max((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for path in (last, last.with_name(f".{last.name}.crc")):
        path.unlink(missing_ok=True)
    assert sorted(r.event_id for r in streams.stream_metric_log(spark, src, table, state, "t").collect()) == [1, 2, 3, 5, 6]


def test_sketches_merge_over_any_range(spark, tmp_path):
    """Two days of skewed sizes and one without values: merged marks keep their bound on all rows."""
    src = str(tmp_path / "src")
    low = [event(i, "2024-01-01 10:00:00", float(i)) for i in range(20_000)]
    high = [event(i, "2024-01-02 10:00:00", 20_000.0 + i) for i in range(1_000)]
    put(spark, low + high + [event(-1, "2024-01-03 10:00:00", None)], src)
    table = streams.value_sketches_to_end(spark, src, str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(r.n for r in table.collect()) == [0, 1_000, 20_000]
    row = streams.merged_percentiles(table, []).first()
    assert row.n == 21_000 and row.mean == sum(range(21_000)) / 21_000
    for mark, share in ((row.p95, 0.95), (row.p99, 0.99)):
        assert abs(mark / 21_000 - share) <= streams.SKETCH_RANK_ERROR
    days = {r.window_start: r for r in streams.merged_percentiles(table, ["window_start"]).collect()}
    empty = days[max(days)]
    assert empty.n == 0 and empty.mean is None and empty.p95 is None
    assert days[min(days)].p99 < 20_000
