import pytest
from pyspark.sql import functions as F

from reviewmill.functions import text
from reviewmill.operators import cleaning
from reviewmill.schemas import RAW_REVIEW

GOOD = dict(
    reviewerID="A1", asin="B000000001", reviewerName="Ann", helpful=[1, 2], reviewText="a perfectly fine product",
    overall=5.0, summary="ok", unixReviewTime=1_400_000_000, reviewTime="05 13, 2014",
)


def frame(spark, *changes):
    rows = [{**GOOD, "reviewerID": f"A{i}", **c} for i, c in enumerate(changes)]
    return spark.createDataFrame([tuple(r[f.name] for f in RAW_REVIEW.fields) for r in rows], RAW_REVIEW)


@pytest.mark.parametrize(
    "change,step",
    [
        ({"reviewerName": "!"}, "reviewer"),
        ({"reviewerName": " x "}, "reviewer"),
        ({"reviewerID": "a1"}, "reviewer"),
        ({"reviewerID": None}, "reviewer"),
        ({"asin": "B00000001"}, "product"),
        ({"overall": 0.0}, "rating"),
        ({"overall": 6.0}, "rating"),
        ({"overall": None}, "rating"),
        ({"reviewText": "   "}, "text"),
        ({"reviewText": None}, "text"),
        ({"reviewText": "123456789"}, "text"),
        ({"reviewText": "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"}, "spam"),
        ({"reviewText": "THISISLOUDANDLONG"}, "spam"),
        ({"reviewText": "see http://x.y for more"}, "spam"),
        ({"reviewText": "Click HERE for a prize"}, "spam"),
        ({"reviewText": "you should buy   now please"}, "spam"),
        ({"reviewText": "ab " * 400}, "spam"),
        ({"unixReviewTime": 100_000_000}, "time"),
        ({"unixReviewTime": None}, "time"),
        ({"reviewTime": "13 45, 2014"}, "time"),
    ],
)
def test_each_step_removes(spark, change, step):
    df = frame(spark, {}, change)
    assert cleaning.clean_reviews(df).count() == 1
    stats = cleaning.cleaning_stats(df).first()
    assert stats[f"removed_{step}"] == 1 and stats.cleaned_records == 1 and stats.retention_rate == 0.5


def test_kept_values(spark):
    df = frame(
        spark,
        {"reviewerName": None, "reviewText": " one\ttwo\n three   four é five ", "helpful": [3, 4], "summary": None},
        {"helpful": [7], "overall": 2.5, "summary": "x" * 120},
        {"helpful": None, "overall": 2.0},
    )
    rows = {r.reviewerID: r for r in cleaning.clean_reviews(df).collect()}
    first = rows["A0"]
    assert first.reviewerName == "Anonymous" and first.summary == ""
    assert first.reviewText == "onetwo three four five"
    assert (first.helpful_votes, first.total_votes, first.helpful_ratio) == (3, 4, 0.75)
    assert first.review_word_count == 4 and first.review_length == 22
    assert (first.review_year, first.review_month, first.review_dayofweek) == (2014, 5, 1)
    assert rows["A1"].rating_category == "positive" and len(rows["A1"].summary) == 100
    assert rows["A1"].helpful == [0, 0] and rows["A2"].rating_category == "negative"


def test_duplicates_keep_one(spark):
    df = frame(spark, {"reviewerID": "A1"}, {"reviewerID": "A1", "overall": 1.0}, {"reviewerID": "A1"})
    out = cleaning.clean_reviews(df).collect()
    assert len(out) == 1 and out[0].overall == 1.0
    assert cleaning.cleaning_stats(df).first().removed_duplicates == 2


def test_empty_input(spark):
    df = frame(spark, {}).limit(0)
    assert cleaning.clean_reviews(df).count() == 0
    assert cleaning.cleaning_stats(df).first().retention_rate is None


def test_text_scores(spark):
    df = spark.createDataFrame([("great bad great",), ("",), (None,), ("plain words here",)], "t string")
    rows = df.select(
        text.sentiment_intensity(F.col("t")), text.text_complexity(F.col("t")), text.word_count(F.col("t")),
        text.word_count(F.col("t"), "space"),
    ).collect()
    assert rows[0][0] == pytest.approx(1 / 3)
    assert rows[0][1] == pytest.approx(2 / 3 * 0.5 + 13 / 3 / 10 * 0.3 + 0.03 * 0.2)
    assert rows[1][:2] == (0.0, 0.0) and rows[2][:3] == (0.0, 0.0, 0)
    assert rows[1][3] == 1 and rows[3][0] == 0.0
