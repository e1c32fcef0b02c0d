import gzip
import json

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import quality, validate
from reviewmill.schemas import RAW_REVIEW, require
from reviewmill.sources import commits, readers, writers

LINE = {"reviewerID": "A1", "asin": "B1", "helpful": [1, 2], "overall": 5.0, "unixReviewTime": 1}


def test_json_lines_good_and_bad(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text(json.dumps(LINE) + "\n{broken\n\n" + json.dumps({**LINE, "asin": "B2"}) + "\n")
    good, bad = readers.read_reviews_checked(spark, str(path), RAW_REVIEW)
    assert sorted(r.asin for r in good.collect()) == ["B1", "B2"]
    assert [r.line for r in bad.collect()] == ["{broken"]


def test_gzip_and_inferred_schema(spark, tmp_path):
    path = tmp_path / "r.json.gz"
    with gzip.open(path, "wt") as f:
        f.write("\n".join(json.dumps({**LINE, "asin": f"B{i}"}) for i in range(50)))
    df = readers.read_reviews(spark, str(path), RAW_REVIEW, partitions=4)
    assert df.count() == 50 and df.rdd.getNumPartitions() == 4
    assert "helpful" in readers.read_reviews(spark, str(path), None).columns


def test_limits_and_samples(spark):
    df = spark.range(1000).repartition(7)
    assert [r.id for r in readers.limit_rows(df, 3, ["id"]).collect()] == [0, 1, 2]
    a = {r.id for r in readers.sample_exact(df, 100, ["id"]).collect()}
    assert len(a) == 100 and a == {r.id for r in readers.sample_exact(df.repartition(2), 100, ["id"]).collect()}
    assert 50 < readers.sample_fraction(df, 100).count() < 160
    assert readers.sample_fraction(df, 5000).count() == 1000


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_sinks(spark, tmp_path, fmt):
    df = spark.createDataFrame([("a", 1.5)], "k string, v double")
    writers.write(df, str(tmp_path / fmt), fmt)
    back = readers.read_features(spark, str(tmp_path / fmt)) if fmt == "csv" else spark.read.format(fmt).load(str(tmp_path / fmt))
    assert [(r.k, r.v) for r in back.collect()] == [("a", 1.5)]


def test_partitioned_overwrite_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    writers.write(spark.createDataFrame([(2020, 1), (2021, 2)], "review_year int, v int"), path, partition_by=["review_year"])
    writers.write(spark.createDataFrame([(2021, 9)], "review_year int, v int"), path, partition_by=["review_year"])
    assert sorted((r.review_year, r.v) for r in spark.read.parquet(path).collect()) == [(2020, 1), (2021, 9)]


def test_versions_compaction_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_table(spark.createDataFrame([(1, "x")], "a int, b string"), path)
    writers.write_table(spark.createDataFrame([(2,)], "a int"), path)
    newest = writers.read_table(spark, path).first()
    assert newest.a == 2 and newest.b is None
    assert writers.read_table(spark, path, 1).first().a == 1
    writers.compact_table(spark, path)
    assert writers.versions(spark, path) == [1, 2, 3]
    assert writers.vacuum_table(spark, path) == [1, 2]
    assert writers.versions(spark, path) == [3] and writers.read_table(spark, path).first().a == 2
    with pytest.raises(ValueError):
        writers.read_table(spark, path, 1)


def test_feature_store(spark, tmp_path):
    df = spark.sql("select 'U' reviewerID, 'P' asin, timestamp_ntz'2020-01-01 00:00:00' review_timestamp, 4D overall, 1D f, 2D f_scaled, 3D g")
    writers.publish_features(df, ["f"], str(tmp_path / "fs"), "1.0", "2020-01-02")
    row = spark.read.parquet(str(tmp_path / "fs")).first()
    assert (row.f, row.f_scaled, row.feature_count) == (1.0, 2.0, 1) and "g" not in row.asDict()


def test_report_sink(spark, tmp_path):
    writers.write_report(spark.createDataFrame([("s", "k", 1.0)], "section string, key string, value double"), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).first().value == 1.0


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="asin"):
        require(spark.range(1), ["id", "asin"])


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, 4.0, 7.0)], "a double, b double, c double")
    got = {(r.x, r.y): r.correlation for r in validate.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == pytest.approx(1.0) and got[("a", "c")] is None and got[("c", "c")] is None


def test_histogram_of_constant_and_box(spark):
    df = spark.createDataFrame([("g", float(v)) for v in [1, 2, 3, 4, 100]], "g string, v double")
    assert quality.histogram(df.withColumn("v", F.lit(3.0)), "v", 5).collect()[0]["count"] == 5
    box = quality.box_stats(df, "g", "v").first()
    assert (box.q1, box.median, box.q3, box.high_whisker) == (2.0, 3.0, 4.0, 4.0)


def test_simple_monitor_alerts(spark):
    rows = [(f"U{i}", f"P{i}", 5.0, 2.0, None) for i in range(20)]
    df = spark.createDataFrame(rows, "reviewerID string, asin string, overall double, ratio_x double, note string")
    row = quality.simple_monitor(df, "d").first()
    kinds = [a.split()[1] for a in row.alerts]
    assert kinds == ["HIGH_NULLS", "INVALID_VALUES", "BIASED_DISTRIBUTION", "COLD_START"]
    assert row.overall_score == pytest.approx((1 + 0.7 + 0.5 + 0.7) / 4)


def test_dead_attempts_are_not_read(spark, tmp_path):
    """What a run that died before its pointer row has left stays out of the next version."""
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "x long, p string")
    writers.write_table(rows, path, ["p"])
    for name in ("v=2", "v2-dead"):
        rows.withColumn("p", F.lit("z")).write.partitionBy("p").parquet(f"{path}/{name}")
    assert writers.write_table(rows.filter("x = 2"), path, ["p"]) == 2
    assert [tuple(r) for r in writers.read_table(spark, path).select("x", "p").collect()] == [(2, "b")]
    assert writers.vacuum_table(spark, path) == [1]
    assert writers.write_table(rows, path, ["p"]) == 3


def test_lost_race_takes_the_next_number(spark, tmp_path, monkeypatch):
    """Another writer publishes the same number between this one's look at the log and its commit."""
    path = str(tmp_path / "t")
    frame = lambda x: spark.createDataFrame([(x,)], "x long")
    writers.write_table(frame(1), path)
    publish, waiting = commits.CommitLog.publish, [frame(20), spark.createDataFrame([(30, "new")], "x long, y string")]

    def raced(log, commit):
        if waiting:
            other = waiting.pop(0)
            writers.write_table(other, path)
        publish(log, commit)

    monkeypatch.setattr(commits.CommitLog, "publish", raced)
    # Each of the two rivals is itself raced, so three writers want number 2.
    assert writers.write_table(frame(2), path) == 4
    assert writers.versions(spark, path) == [1, 2, 3, 4]
    seen = [sorted(tuple(r) for r in writers.read_table(spark, path, v).collect()) for v in (1, 2, 3, 4)]
    assert seen == [[(1,)], [(30, "new")], [(20, None)], [(2, None)]]
    waiting.append(frame(5))
    with pytest.raises(writers.Conflict):
        writers.write_table(frame(6), path, based_on=4)
    assert writers.versions(spark, path)[-1] == 5
    waiting.append(spark.createDataFrame([(7, "z")], "x long, y string"))
    assert writers.compact_table(spark, path) == 7
    assert writers.read_table(spark, path).first().x == 7  # what the rival wrote, not what it replaced


def test_writers_at_once(spark, tmp_path):
    """Threads that publish and append at the same time: every number once, nothing lost."""
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "t")
    with ThreadPoolExecutor(6) as pool:
        made = list(pool.map(lambda k: writers.append_table(spark.createDataFrame([(k,)], "x long"), path, f"w{k % 5}"), range(8)))
    rows = [r.x for r in writers.read_table(spark, path).collect()]
    made = [v for v in made if v]
    assert writers.versions(spark, path) == sorted(made) == [1, 2, 3, 4, 5]
    assert sorted(x % 5 for x in rows) == [0, 1, 2, 3, 4]
    log = commits.CommitLog(spark, path)
    with ThreadPoolExecutor(8) as pool:
        wins = list(pool.map(lambda k: _wins(log, commits.Commit(max(made) + 1, [str(k)])), range(16)))
    assert sum(wins) == 1


def _wins(log, commit):
    try:
        log.publish(commit)
        return True
    except commits.Conflict:
        return False


def test_replayed_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1,), (2,)], "x long")
    assert [writers.append_table(rows, path, "q", b) for b in (0, 1, 0, 1)] == [1, 2, None, None]
    assert writers.read_table(spark, path).count() == 4
    assert writers.compact_table(spark, path) == 3 and writers.append_table(rows, path, "q", 0) is None
    assert writers.vacuum_table(spark, path) == [1, 2] and writers.read_table(spark, path).count() == 4
    assert writers.append_table(rows, path, "q", 1) is None and writers.versions(spark, path) == [3]
    assert writers.append_table(rows, path) == 4 and writers.read_table(spark, path).count() == 6


def test_republished_features_replace_all_partitions(spark, tmp_path):
    path = str(tmp_path / "f")
    rows = spark.createDataFrame([("u", "i", "2020-01-01", 1.0, 0.5, 1), ("v", "i", "2020-01-01", 2.0, 0.5, 2)],
                                 "reviewerID string, asin string, review_timestamp string, overall double, f double, part int")
    keys = ("reviewerID", "asin", "review_timestamp", "part")
    writers.publish_features(rows, ["f"], path, "1", "2020-01-01", ["part"], keys=keys)
    writers.publish_features(rows.filter("part = 1"), ["f"], path, "1", "2020-01-01", ["part"], keys=keys)
    assert spark.read.parquet(f"{path}/feature_version=1").count() == 1


def test_shared_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    from reviewmill import session

    folders = []
    context = SimpleNamespace(
        master="spark://host:7077", getCheckpointDir=lambda: folders[-1] if folders else None, setCheckpointDir=folders.append
    )
    fake = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(fake)
    named = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: "hdfs://shared"))
    assert session.shared_folder(named) == "hdfs://shared"
