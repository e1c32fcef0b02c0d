"""Hot-key paths must equal the plain window, copies and ties included."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewmill.operators import enrich, features, ordered


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame(
        {
            "reviewerID": np.where(rng.random(n) < 0.4, "HOT", np.char.add("U", rng.integers(0, 60, n).astype(str))),
            "asin": np.char.add("P", rng.integers(0, 5, n).astype(str)),
            "overall": rng.integers(1, 6, n).astype(float),
            "day": rng.integers(0, 40, n),
            "word_count": rng.integers(0, 30, n),
            "user_review_count": 3,
        }
    )
    # A third of the hot user's rows are copies of one row.
    hot = pdf.index[pdf.reviewerID == "HOT"][:500]
    pdf.loc[hot, ["asin", "overall", "day", "word_count"]] = ["P1", 5.0, 7, 9]
    df = spark.createDataFrame(pdf)
    stamp = F.expr("timestamp_ntz'2020-01-01 00:00:00'") + F.make_dt_interval(days=F.col("day").cast("int"))
    return df.withColumn("review_timestamp", stamp).withColumn("sentiment_score", F.signum(F.col("overall") - 3)).drop("day").cache()


TIES = ("asin", "overall", "word_count")


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    key = lambda df: sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
    assert key(a) == key(b)


def test_number_rows_hot_equals_plain(rows):
    order = [F.col("review_timestamp").desc(), *[F.col(t).desc() for t in TIES]]
    plain = rows.withColumn("n", F.row_number().over(W.partitionBy("reviewerID").orderBy(*order)).cast("long"))
    same(ordered.number_rows(rows, ["reviewerID"], order, "n", hot_rows=100), plain)


def test_sliding_hot_equals_plain(rows, monkeypatch):
    plain = features.user_rolling(rows, TIES, hot_rows=10**9)
    monkeypatch.setattr(ordered, "BLOCK_ROWS", 37)
    rounded = lambda df: df.withColumn("user_rolling_std_rating", F.round("user_rolling_std_rating", 9))
    same(rounded(features.user_rolling(rows, TIES, hot_rows=100)), rounded(plain))


def test_product_rolling_hot_equals_plain(rows, monkeypatch):
    ties = ("reviewerID", "overall", "word_count")
    plain = features.product_rolling(rows, ties, hot_rows=10**9)
    monkeypatch.setattr(ordered, "BLOCK_ROWS", 11)
    same(features.product_rolling(rows, ties, hot_rows=50), plain)


def test_timeline_hot_equals_plain(rows):
    same(enrich.timeline(rows, TIES, hot_rows=100), enrich.timeline(rows, TIES, hot_rows=10**9))


def test_running_totals_range_path(spark, monkeypatch):
    values = np.random.default_rng(1).integers(0, 500, 4000)
    df = spark.createDataFrame(pd.DataFrame({"k": values % 3, "value": values.astype(float)}))
    small = ordered.distribution(df, ["k"])
    monkeypatch.setattr(ordered, "SMALL_TABLE", 0)
    same(ordered.distribution(df, ["k"]), small)


def test_quantiles_and_moments_match_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 500), "value": np.round(rng.normal(size=500), 1)})
    dist = ordered.distribution(spark.createDataFrame(pdf), ["g"])
    q = {r.g: (r.a, r.b) for r in ordered.quantiles(dist, ["g"], {"a": 0.25, "b": 0.9}).collect()}
    m = {r.g: (r.n, r.mean, r.std) for r in ordered.moments(dist, ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        assert q[g] == pytest.approx((part.value.quantile(0.25), part.value.quantile(0.9)))
        assert m[g] == pytest.approx((len(part), part.value.mean(), part.value.std()))


def test_percentile_rank_equals_pandas(spark):
    pdf = pd.DataFrame({"overall": [1.0, 1.0, 2.0, 5.0, 5.0, 5.0, None]})
    out = features.percentile_ranks(spark.createDataFrame(pdf), {"overall": "p"}).toPandas()
    want = pdf.assign(p=pdf.overall.rank(pct=True))
    pd.testing.assert_frame_equal(
        out.sort_values(["overall", "p"]).reset_index(drop=True), want.sort_values(["overall", "p"]).reset_index(drop=True)
    )


def test_single_row_user_has_null_gap_and_std(spark):
    df = spark.sql("select 'U' reviewerID, 'P' asin, 4D overall, timestamp_ntz'2020-01-01 00:00:00' review_timestamp, 3 word_count, 1D sentiment_score")
    assert enrich.days_between_reviews(df, ("asin",)).first().days_since_last_review is None
    row = features.user_rolling(df, ("asin",)).first()
    assert row.user_rolling_std_rating is None and row.user_rolling_sentiment_trend == 0


def test_null_users_and_times_do_not_depend_on_hot_rows(spark):
    """A null user is a user, a null time is older than all others, whatever path a key takes."""
    from reviewmill.operators import enrich

    rows = [
        (user, f"B{i:03d}", float(i % 5 + 1), i % 3, i % 4, None if i % 7 == 0 else f"2020-01-{i % 9 + 1:02d}")
        for i, user in enumerate([None, "A1", "A2", None, "A1"] * 8)
    ]
    schema = "reviewerID string, asin string, overall double, helpful_votes int, total_votes int, day string"
    df = spark.createDataFrame(rows, schema).withColumn("review_timestamp", F.col("day").cast("timestamp_ntz")).drop("day")
    ties = ("asin", "overall", "helpful_votes", "total_votes")

    def of(frame):
        return sorted(map(repr, (tuple(r) for r in frame.select(sorted(frame.columns)).collect())))

    assert of(enrich.timeline(df, ties, hot_rows=0)) == of(enrich.timeline(df, ties))
    running = {(r["reviewerID"], r["asin"]): r["user_total_reviews"] for r in enrich.running_reviews(df).collect()}
    plain = {(r["reviewerID"], r["asin"]): r["user_total_reviews"] for r in enrich.timeline(df, ties).collect()}
    assert running == plain
    for hot_rows in (0, 5, None):
        got = enrich.recency_rank(df, ties, hot_rows)
        assert of(got) == of(enrich.recency_rank(df, ties))
