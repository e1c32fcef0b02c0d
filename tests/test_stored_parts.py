"""Work on the reviews is done once, and vectors travel once per recommended item."""

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import enrich, recommend
from reviewmill.plans import catalog
from reviewmill.sources import testviews

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["novelty", "coverage", "diversity", "batch_recommend", "train_only_stats"])
def test_lists_read_the_reviews_from_one_stored_table(spark, name):
    files = catalog.queries()[name](spark, SF_DIR).inputFiles()
    assert files and not [f for f in files if "lineitem" in f]


def test_routed_users_are_hashed_once_each(spark):
    lines = spark.range(400).select(F.format_string("u%02d", F.col("id") % 7).alias("reviewerID"), F.col("id").alias("line"))
    users = lines.select("reviewerID").distinct().withColumn("group", F.when(F.md5("reviewerID") < "8", "A").otherwise("B"))
    items = spark.range(9).select(F.concat(F.lit("i"), "id").alias("asin"))
    recs = users.select("reviewerID", F.lit("i1").alias("asin"), F.lit(1).alias("rank"))
    out = recommend.route_recommendations(users, recs, items, 3)
    first = users.select("group", "reviewerID").collect()
    want = {(u, "random" if g == "A" else "model", 3 if g == "A" else 1) for g, u in first}
    got = out.groupBy("reviewerID", "source").count().collect()
    assert {tuple(r) for r in got} == want
    assert "md5" not in out.filter("source = 'model'")._jdf.queryExecution().optimizedPlan().toString()


def test_vector_diversity_sends_no_row_per_component(spark):
    vecs = {1: [3.0, 0.0], 2: [0.0, 2.0], 3: [0.0, 0.0], 4: [1.0, None], 5: None}
    vectors = spark.createDataFrame(list(vecs.items()), "item long, vec array<float>")
    recs = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 1), ("b", 1), ("c", 1), ("c", 3), ("c", 4), ("d", 1), ("d", 5), ("e", 3), ("e", 3)],
        "reviewerID string, item long",
    )
    out = recommend.diversity(recs, vectors, item="item")
    assert {r[0]: round(r[1], 9) for r in out.collect()} == {"a": 1.0, "b": 0.0, "c": round(1 - 1 / 3, 9), "e": 1.0}
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_profile_makes_the_frame_once(spark):
    files = testviews.profile(spark, SF_DIR).inputFiles()
    assert files and not [f for f in files if "lineitem" in f or "documents" in f]


@pytest.mark.parametrize("name", ["quality_report", "running_reviews"])
def test_passes_over_the_reviews_read_a_stored_table(spark, name):
    files = catalog.queries()[name](spark, SF_DIR).inputFiles()
    assert files and not [f for f in files if "lineitem" in f]


def test_running_count_takes_its_total_from_the_stored_counts(spark, tmp_path):
    rows = [("a", 1), ("a", 1), ("a", 3), (None, 2), (None, None), ("b", None)]
    df = spark.createDataFrame(rows, "reviewerID string, review_timestamp long")
    df.write.parquet(f"{tmp_path}/rows")
    out = enrich.running_reviews(spark.read.parquet(f"{tmp_path}/rows"))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [("a", 1, 3), ("a", 1, 3), ("a", 3, 1), (None, 2, 1), (None, None, 2), ("b", None, 1)], key=repr
    )
    scans = [x for x in out._jdf.queryExecution().optimizedPlan().collectLeaves().mkString("\n").split("\n") if x.startswith("Relation")]
    assert len(scans) == 3  # the rows, the counts twice
