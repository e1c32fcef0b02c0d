import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewmill.operators import factors, recommend


@pytest.fixture(scope="module")
def ratings(spark):
    rng = np.random.default_rng(7)
    taste, kind = rng.normal(size=(40, 2)), rng.normal(size=(30, 2))
    rows = []
    for u in range(40):
        for i in rng.choice(30, 15, replace=False):
            value = float(np.clip(np.round(3 + taste[u] @ kind[i]), 1, 5))
            rows.append((f"U{u:02d}", f"I{i:02d}", value, int(u * 100 + i), "2020-01-01 00:00:00"))
    df = spark.createDataFrame(rows, "reviewerID string, asin string, overall double, doc_id long, ts string")
    return df.withColumn("review_timestamp", F.col("ts").cast("timestamp_ntz")).drop("ts").cache()


@pytest.fixture(scope="module")
def als(ratings):
    return factors.train_als(factors.index_ratings(ratings), rank=5, iters=8)


def test_als_beats_global_mean(ratings, als):
    from reviewmill.operators.metrics import regression_metrics

    error = regression_metrics(factors.predict(als, ratings), "overall").first()
    spread = ratings.agg(F.stddev_pop("overall")).first()[0]
    assert error.rmse < spread and error.r2 > 0 and error.n == 600


def test_als_topk_equals_all_pairs(als):
    got = {}
    for r in factors.recommend_all(als, 4).collect():
        got.setdefault(r.reviewerID, {})[r["rank"]] = r.asin
    users, items = als.users.orderBy("user").collect(), als.items.orderBy("item").collect()
    scores = np.round(np.array([r.vec for r in users]) @ np.array([r.vec for r in items]).T, 6)
    for u, row in zip(users, scores):
        want = [items[j].asin for _, j in sorted((-s, j) for j, s in enumerate(row))[:4]]
        assert [got[u.reviewerID][k] for k in (1, 2, 3, 4)] == want


def test_recommend_for_some_users(spark, als):
    asked = spark.createDataFrame([("U01",), ("nobody",)], "reviewerID string")
    out = factors.recommend_for(als, asked, 3).collect()
    assert {r.reviewerID for r in out} == {"U01"} and len(out) == 3


def test_unknown_pair_gets_default(spark, als):
    pairs = spark.createDataFrame([("nobody", "I01")], "reviewerID string, asin string")
    assert factors.predict(als, pairs).first().prediction == 3.0
    zero = factors.embeddings(als.users, pairs, "reviewerID", 5).first().vec
    assert zero == [0.0] * 5


def test_svd_matches_numpy(ratings):
    indexed = factors.index_ratings(ratings.select("reviewerID", "asin", "overall"))
    model, singular = factors.train_svd(indexed, k=4, rounds=8)
    dense = np.zeros((40, 30))
    for r in indexed.ratings.collect():
        dense[r["user"], r["item"]] = r.overall
    u, s, vt = np.linalg.svd(dense)
    assert singular == pytest.approx(s[:4], rel=1e-4)
    low = (u[:, :4] * s[:4]) @ vt[:4]
    left = np.array([r.vec for r in model.users.orderBy("user").collect()])
    right = np.array([r.vec for r in model.items.orderBy("item").collect()])
    assert np.abs(left @ right.T - low).max() < 1e-2
    pred = factors.predict_svd(model, ratings).agg(F.min("prediction"), F.max("prediction")).first()
    assert pred[0] >= 1 and pred[1] <= 5


def test_vectors_are_not_broadcast(spark, ratings):
    """A product joins vectors by a shuffle: the planner's size of them leaves out how long they are."""
    indexed = factors.index_ratings(ratings.select("reviewerID", "asin", "overall"))
    start = F.transform(F.sequence(F.lit(0), F.lit(59)), lambda j: (j + 0.5) * F.col("item"))
    product = factors._multiply(indexed.ratings, indexed.items.select("item", start.alias("vec")), "item", "user")
    assert product.count() == 40
    plan = product._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_neural_scores_and_seen_items(spark, ratings, tmp_path):
    model = factors.train_ncf(ratings, rank=4, layers=(8, 4), most=2)
    users = spark.createDataFrame([("U00",), ("U01",), ("nobody",)], "reviewerID string")
    every = ratings.select("reviewerID").distinct().crossJoin(ratings.select("asin").distinct())
    recs = factors.ncf_recommend(model, every, users, 30).cache()
    seen = {tuple(r) for r in ratings.select("reviewerID", "asin").collect()}
    assert not seen & {(r.reviewerID, r.asin) for r in recs.filter("method = 'model'").collect()}
    # Half of the catalogue is unseen, so k = 30 returns exactly the other half.
    assert recs.filter("reviewerID = 'U00'").count() == 15
    assert recs.filter("reviewerID = 'nobody' and method = 'popular'").count() == 30
    ranks = [r["rank"] for r in recs.filter("reviewerID = 'U00'").orderBy(F.desc("score"), "asin").collect()]
    assert ranks == list(range(1, 16))
    factors.save_neural(model, str(tmp_path / "ncf"))
    again = factors.load_neural(spark, str(tmp_path / "ncf"))
    unknown = spark.createDataFrame([("nobody", "I01")], "reviewerID string, asin string")
    assert factors.ncf_predict(again, unknown).first().probability == 0.5


def test_route_sends_groups_apart(spark, ratings):
    users = spark.createDataFrame([("U00", "A"), ("U01", "B"), ("U02", None)], "reviewerID string, `group` string")
    model = ratings.groupBy("reviewerID").agg(F.min("asin").alias("asin")).withColumn("rank", F.lit(1))
    out = recommend.route_recommendations(users, model, ratings.select("asin").distinct(), 5).collect()
    random = [r for r in out if r.source == "random"]
    assert {r.reviewerID for r in random} == {"U00"} and len({r.asin for r in random}) == 5
    assert {r.reviewerID for r in out if r.source == "model"} == {"U01", "U02"}


def test_machine_has_biases(spark, ratings, als):
    from reviewmill.operators.metrics import regression_metrics

    model = factors.train_fm(factors.index_ratings(ratings.select("reviewerID", "asin", "overall")), rank=4)
    fitted = regression_metrics(factors.predict_fm(model, ratings), "overall").first().rmse
    spread = ratings.agg(F.stddev_pop("overall")).first()[0]
    assert fitted < spread
    user, item = model.users.filter("reviewerID = 'U03'").first(), model.items.filter("asin = 'I07'").first()
    pairs = spark.createDataFrame([("U03", "I07"), ("nobody", "I07"), (None, None)], "reviewerID string, asin string")
    got = {r.reviewerID: r.prediction for r in factors.predict_fm(model, pairs).collect()}
    want = model.mean + user.bias + item.bias + float(np.dot(user.vec, item.vec))
    assert got["U03"] == pytest.approx(want) and got["nobody"] == got[None] == 3.0


def test_machine_without_arrow(spark, ratings):
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    try:
        model = factors.train_fm(
            factors.index_ratings(ratings.select("reviewerID", "asin", "overall")), rank=2, iters=2
        )
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    assert model.users.count() == 40 and {len(r.vec) for r in model.items.collect()} == {2}


def test_machine_refuses_what_does_not_fit(ratings, monkeypatch):
    monkeypatch.setattr(factors, "FM_NUMBERS", 100)
    with pytest.raises(ValueError, match="too many"):
        factors.train_fm(factors.index_ratings(ratings.select("reviewerID", "asin", "overall")), rank=4)


def _points(spark, rows):
    from pyspark.ml.linalg import Vectors

    return spark.createDataFrame([(Vectors.dense(x), float(y)) for x, y in rows], ["features", "label"])


def test_net_stops_and_goes_on(spark, tmp_path):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(300, 2))
    clear = [(list(p), p[0] * p[1] > 0) for p in points]
    noise = [(list(p), rng.integers(2)) for p in points]
    net, steps = factors.fit_net(
        _points(spark, clear[:200]), _points(spark, clear[200:]), [2, 6, 2], most=4, path=str(tmp_path / "net")
    )
    assert [s.step for s in steps] == list(range(1, len(steps) + 1)) and steps[0].kept
    kept = [s.valid_loss for s in steps if s.kept]
    assert kept == sorted(kept, reverse=True)
    assert factors.log_loss(net, _points(spark, clear[200:])) == pytest.approx(min(kept))
    # A saved step gives the same loss, and training goes on from it without losing what it had.
    from pyspark.ml.classification import MultilayerPerceptronClassificationModel as Net

    last = Net.load(str(tmp_path / "net" / f"step={len(steps)}"))
    assert factors.log_loss(last, _points(spark, clear[200:])) == pytest.approx(steps[-1].valid_loss)
    more, _ = factors.fit_net(_points(spark, clear[:200]), _points(spark, clear[200:]), [2, 6, 2], most=1, start=last)
    assert factors.log_loss(more, _points(spark, clear[200:])) <= steps[-1].valid_loss
    # Labels without meaning are learnt by heart only: the validation loss rises and training stops.
    _, idle = factors.fit_net(_points(spark, noise[:200]), _points(spark, noise[200:]), [2, 16, 2], most=12, patience=2)
    assert len(idle) < 12 and not any(s.kept for s in idle[-2:])


def test_machine_is_fitted_by_every_core(spark, monkeypatch):
    from pyspark.ml.regression import FMRegressor

    class Seen(Exception):
        pass

    def fit(self, rows):
        raise Seen(rows.count(), rows.rdd.getNumPartitions())

    monkeypatch.setattr(FMRegressor, "fit", fit)
    pairs = [(f"U{u}", f"I{i}", float(1 + (u + i) % 5)) for u in range(20) for i in range(10)]
    ratings = spark.createDataFrame(pairs, "reviewerID string, asin string, overall double").coalesce(1)
    with pytest.raises(Seen) as told:
        factors.train_fm(factors.index_ratings(ratings))
    assert told.value.args == (200, spark.sparkContext.defaultParallelism)
