"""The perceptron's training: the weights of MLlib's trainer, from rows that every core has a part of."""

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors

from reviewmill.operators import factors, perceptron

LAYERS = [4, 7, 5, 2]


def _rows(spark, n):
    points = np.random.default_rng(0).normal(size=(n, 4))
    rows = [(Vectors.dense(x), float(x[0] * x[1] > 0.1)) for x in points.tolist()]
    return spark.createDataFrame(rows, ["features", "label"]).coalesce(1)


def test_steps_give_the_weights_of_mllib(spark):
    rows = _rows(spark, 512).cache()  # whole blocks, since MLlib weighs the rows of a smaller one higher
    net, steps = factors.fit_net(rows, rows, LAYERS, rounds=5, most=2, patience=2)
    one = MultilayerPerceptronClassifier(layers=LAYERS, maxIter=5, seed=42)
    two = one.copy().setInitialWeights(one.fit(rows).weights).fit(rows)
    assert net.weights.toArray() == pytest.approx(two.weights.toArray(), abs=1e-9)
    assert steps[-1].train_loss == pytest.approx(factors.log_loss(two, rows)) == steps[-1].valid_loss


def test_rows_of_one_file_are_dealt_to_every_core(spark, monkeypatch):
    monkeypatch.setattr(perceptron, "BLOCK", 50)
    rows = _rows(spark, 400)
    assert perceptron.dealt(rows).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    part, flat = perceptron.dealt(rows), perceptron.net_of(None, LAYERS, 42, spark).weights.toArray()
    whole = perceptron.summed(part, flat, LAYERS)
    monkeypatch.setattr(perceptron, "DIRECT", 1)  # the sums of many tasks are added up in groups
    grouped = perceptron.summed(part, flat, LAYERS)
    assert grouped[:2] == pytest.approx(whole[:2]) and grouped[2] == pytest.approx(whole[2])


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(1)
    x, label, flat = rng.normal(size=(9, 4)), rng.integers(0, 2, 9), rng.normal(size=4 * 7 + 7 + 7 * 5 + 5 + 5 * 2 + 2)
    _, slope = perceptron.block_sums(flat, LAYERS, x, label)
    for n in range(0, len(flat), 5):
        step = np.zeros(len(flat))
        step[n] = 1e-6
        up, down = (perceptron.block_sums(flat + s, LAYERS, x, label, slopes=False)[0] for s in (step, -step))
        assert (up - down) / 2e-6 == pytest.approx(slope[n], abs=1e-5)
