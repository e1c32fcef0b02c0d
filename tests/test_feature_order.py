"""The columns of time are added after the rows have moved, and stand where they stood."""

from reviewmill.operators import features
from reviewmill.sources import testviews as tv

SF_DIR = "/root/testdata/sf0.001"


def test_time_columns_are_not_shuffled(spark):
    out = features.build_features(tv.frame(spark, SF_DIR, intensity=True), tv.TIES)
    assert out.columns.index("review_timestamp") < out.columns.index("month_sin") < out.columns.index("user_popularity")
    spark.conf.set("spark.sql.debug.maxToStringFields", "500")
    plan = out.select("month_sin", "product_rolling_avg_rating", "user_rolling_avg_rating")._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    # Nothing below the upper window makes or carries it.
    assert " AS month_sin" in text and text.index(" AS month_sin") < text.index("Window [")
    assert "month_sin" not in text[text.index("Window ["):]
