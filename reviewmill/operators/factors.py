"""Matrix factorisation recommenders: ALS, truncated SVD and the two-stage neural model."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import MultilayerPerceptronClassificationModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import FMRegressor
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.operators import neighbours, perceptron
from reviewmill.operators.joins import attach_totals
from reviewmill.operators.ordered import running_totals
from reviewmill.operators.recommend import LIKED, index_ids, interactions, split_point
from reviewmill.session import materialise, shared_folder

UNKNOWN_RATING = 3.0
INT_LIMIT = 2**31 - 1
#: A factorisation machine is one vector on the driver: (users + items) x (rank + 1) numbers, refused above this (320 MB).
FM_NUMBERS = 40_000_000
#: Blocks of ALS unless one would hold more ratings than that: building it takes some 50 bytes of each at a time.
LEAST_BLOCKS, BLOCK_RATINGS = 10, 4_000_000
#: Users and items that meet in one group of ``count_beaten``, on average, and those that are multiplied at a time.
USER_BLOCK, ITEM_BLOCK = 1 << 17, 1 << 18
PIECE_USERS, PIECE_ITEMS = 256, 4096


@dataclass
class Indexed:
    """Ratings with integer ids and the two id maps, all as tables."""

    ratings: DataFrame  # user, item, overall
    users: DataFrame  # reviewerID, user
    items: DataFrame  # asin, item


def index_ratings(ratings: DataFrame) -> Indexed:
    ratings = materialise(ratings)
    users, items = index_ids(ratings, "reviewerID", "user"), index_ids(ratings, "asin", "item")
    joined = ratings.join(users, "reviewerID").join(items, "asin").select("user", "item", "overall")
    return Indexed(materialise(joined), users, items)


@dataclass
class Factors:
    """Vectors per user and item; a rating is estimated by their inner product."""

    users: DataFrame  # reviewerID, user, vec
    items: DataFrame  # asin, item, vec
    rank: int
    als: ALSModel | None = None  # the MLlib model that the vectors come from, if there is one


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _als(
    rank: int, iters: int, reg: float, seed: int, implicit: bool = False, blocks: int = LEAST_BLOCKS, checkpoint: int = 1
) -> ALS:
    """MLlib's ALS with ``blocks`` blocks of either side.

    Every iteration is checkpointed, after which MLlib deletes the shuffle files that led to it. Else those of
    all iterations lie on disk until the end: each vector once per block that needs it, in every half of an iteration.
    """
    return ALS(
        userCol="user", itemCol="item", ratingCol="overall", rank=rank, maxIter=iters, regParam=reg, seed=seed,
        nonnegative=True, coldStartStrategy="drop", implicitPrefs=implicit, checkpointInterval=checkpoint,
        numUserBlocks=blocks, numItemBlocks=blocks,
    )


def als_blocks(ratings: int) -> int:
    """Blocks of either side: MLlib's number, and more where a block would hold more than ``BLOCK_RATINGS`` ratings."""
    return max(LEAST_BLOCKS, math.ceil(ratings / BLOCK_RATINGS))


def _als_input(indexed: Indexed) -> DataFrame:
    shared_folder(indexed.ratings.sparkSession)  # where checkpoints go
    top = indexed.ratings.agg(F.max("user"), F.max("item")).first()
    if max(top[0] or 0, top[1] or 0) > INT_LIMIT:
        raise ValueError("ALS needs ids that fit a 32-bit integer")
    return indexed.ratings.select(F.col("user").cast("int"), F.col("item").cast("int"), F.col("overall").cast("float"))


def als_factors(model: ALSModel, indexed: Indexed) -> Factors:
    def side(factors: DataFrame, ids: DataFrame, index: str) -> DataFrame:
        vectors = factors.select(F.col("id").cast("long").alias(index), F.col("features").cast("array<double>").alias("vec"))
        return ids.join(vectors, index)

    users, items = side(model.userFactors, indexed.users, "user"), side(model.itemFactors, indexed.items, "item")
    return Factors(users, items, model.rank, model)


def train_als(
    indexed: Indexed, rank: int = 10, iters: int = 10, reg: float = 0.1, seed: int = 42, implicit: bool = False
) -> Factors:
    """Non-negative ALS (explicit by default)."""
    als = _als(rank, iters, reg, seed, implicit, als_blocks(indexed.ratings.count()))
    return als_factors(als.fit(_als_input(indexed)), indexed)


def tune_als(
    indexed: Indexed,
    ranks: Sequence[int] = (5, 10, 20),
    iters: Sequence[int] = (5, 10, 15),
    regs: Sequence[float] = (0.01, 0.1, 1.0),
    folds: int = 3,
    seed: int = 42,
    parallelism: int = 2,
) -> tuple[Factors, DataFrame]:
    """Grid search by cross-validated RMSE: (best model, one row per combination)."""
    # Many short fits: MLlib's own interval, since each checkpoint is a job.
    als = _als(ranks[0], iters[0], regs[0], seed, blocks=als_blocks(indexed.ratings.count()), checkpoint=10)
    grid = (
        ParamGridBuilder().addGrid(als.rank, list(ranks)).addGrid(als.maxIter, list(iters))
        .addGrid(als.regParam, list(regs)).build()
    )
    judge = RegressionEvaluator(metricName="rmse", labelCol="overall", predictionCol="prediction")
    search = CrossValidator(
        estimator=als, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, seed=seed, parallelism=parallelism
    )
    fitted = search.fit(_als_input(indexed))
    rows = [
        (int(p[als.rank]), int(p[als.maxIter]), float(p[als.regParam]), float(m))
        for p, m in zip(grid, fitted.avgMetrics)
    ]
    table = indexed.ratings.sparkSession.createDataFrame(rows, "rank int, iterations int, reg double, rmse double")
    return als_factors(fitted.bestModel, indexed), table


def predict(model: Factors, pairs: DataFrame, unknown: float | None = UNKNOWN_RATING) -> DataFrame:
    """Adds ``prediction`` to (reviewerID, asin) pairs; a pair with an unknown side gets ``unknown``."""
    joined = pairs.join(model.users.select("reviewerID", F.col("vec").alias("__u")), "reviewerID", "left").join(
        model.items.select("asin", F.col("vec").alias("__v")), "asin", "left"
    )
    return joined.withColumn("prediction", F.coalesce(dot(F.col("__u"), F.col("__v")), F.lit(unknown))).drop("__u", "__v")


def _named(ranked: DataFrame, model: Factors) -> DataFrame:
    users = model.users.select("reviewerID", F.col("user").alias("id"))
    items = model.items.select("asin", F.col("item").alias("partner"))
    return ranked.join(users, "id").join(items, "partner").select("reviewerID", "asin", "score", "rank")


def recommend_all(model: Factors, k: int) -> DataFrame:
    """(reviewerID, asin, score, rank): the k best items of every user, by a block search that leaves out what bounds exclude.

    Scores are given to six decimals, by which they are ranked (equal ones by item number).
    """
    users = model.users.select(F.col("user").alias("id"), "vec")
    items = model.items.select(F.col("item").alias("id"), "vec")
    ranked = neighbours.top_inner(users, items, k).withColumn("score", F.round("score", 6))
    return _named(ranked, model)


def recommend_for(model: Factors, users: DataFrame, k: int) -> DataFrame:
    """The same for the given users (column reviewerID) only."""
    asked = model.users.join(users.select("reviewerID").distinct(), "reviewerID", "left_semi")
    return recommend_all(Factors(asked, model.items, model.rank), k)


def count_beaten(
    model: Factors, ranked: DataFrame, slack: float = 1e-4, user_block: int = USER_BLOCK, item_block: int = ITEM_BLOCK
) -> DataFrame:
    """One row: ``beaten``, how many products outside a user's list score more than its last one by ``slack``.

    ``ranked`` (reviewerID, asin, score) has the lists; every one is held against the whole catalogue. Blocks of users
    and of items meet in one group, which keeps a number; a piece of items that is too short to beat a user's
    last score (an inner product is at most the product of both lengths) is not multiplied. Null without lists.
    """
    places = model.items.select("asin", "item")
    last = ranked.join(places, "asin").groupBy("reviewerID").agg(
        F.min("score").alias("floor"), F.collect_set("item").alias("listed")
    )
    asked = materialise(last.join(model.users.select("reviewerID", "user", "vec"), "reviewerID").drop("reviewerID"))
    items = materialise(model.items.select("item", "vec"))
    user_blocks, item_blocks = (max(1, math.ceil(df.count() / n)) for df, n in ((asked, user_block), (items, item_block)))

    def block(name: str, blocks: int) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(blocks))

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))

    keys, tasks = ["ub", "ib"], user_blocks * item_blocks
    left = asked.select(block("user", user_blocks).alias("ub"), every(item_blocks).alias("ib"), "vec", "floor", "listed")
    right = items.select(every(user_blocks).alias("ub"), block("item", item_blocks).alias("ib"), "item", "vec")

    def count(own: pa.Table, offered: pa.Table) -> pa.Table:
        found = 0
        if own.num_rows and offered.num_rows:
            listed = own.column("listed").combine_chunks()
            found = _beaten(
                neighbours.vectors(own), own.column("floor").to_numpy() + slack, listed.flatten().to_numpy(),
                listed.value_lengths().to_numpy(), neighbours.vectors(offered), offered.column("item").to_numpy(),
            )
        return pa.table({"beaten": pa.array([found], pa.int64())})

    dealt = (side.repartition(tasks, *keys).groupBy(*keys) for side in (left, right))
    return next(dealt).cogroup(next(dealt)).applyInArrow(count, "beaten long").agg(F.sum("beaten").alias("beaten"))


def _beaten(
    q: np.ndarray, floor: np.ndarray, listed: np.ndarray, n_listed: np.ndarray, x: np.ndarray, items: np.ndarray
) -> int:
    """How many (row of ``q``, row of ``x``) have a product above the row's ``floor`` though the item is not in the row's list."""
    size, lengths = (np.sqrt(np.einsum("ij,ij->i", v, v)) for v in (q, x))
    by_length = np.argsort(-lengths, kind="stable")
    x, items, lengths = x[by_length], items[by_length], lengths[by_length]
    # Places of the listed items among the rows of x; one that lies in another block has none.
    by_item = np.argsort(items, kind="stable")
    at = by_item[np.minimum(np.searchsorted(items, listed, sorter=by_item), len(items) - 1)]
    here = items[at] == listed
    own = np.unique(np.repeat(np.arange(len(q)), n_listed)[here] * len(items) + at[here])
    # How long an item must be to beat the row's floor; rows in that order, so that a piece needs about the same items.
    with np.errstate(divide="ignore", invalid="ignore"):
        least = np.where(floor < 0, 0.0, np.where(size > 0, floor / size, np.inf))
    order, found = np.argsort(least, kind="stable"), 0
    for a in range(0, len(q), PIECE_USERS):
        rows = order[a : a + PIECE_USERS]
        # Lengths fall; a hair is left for rounding.
        stop = int(np.searchsorted(-lengths, -least[rows[0]] * (1 - 1e-9), "right"))
        for b in range(0, stop, PIECE_ITEMS):
            r, c = np.nonzero(q[rows] @ x[b : min(stop, b + PIECE_ITEMS)].T > floor[rows, None])
            pairs = rows[r] * len(items) + b + c
            found += len(pairs) - int(np.isin(pairs, own).sum())
    return found


def embeddings(vectors: DataFrame, ids: DataFrame, key: str, rank: int) -> DataFrame:
    """(key, vec) for the asked ids; an unknown id gets the zero vector."""
    zero = F.array_repeat(F.lit(0.0), rank)
    return ids.select(key).join(vectors.select(key, "vec"), key, "left").withColumn("vec", F.coalesce("vec", zero))


# --- factorisation machine ------------------------------------------------------------------


@dataclass
class Machine:
    """A rating is the mean, plus a bias of either side, plus the inner product of their embeddings."""

    users: DataFrame  # reviewerID, user, bias, vec
    items: DataFrame  # asin, item, bias, vec
    mean: float
    rank: int


def train_fm(
    indexed: Indexed, rank: int = 16, iters: int = 100, step: float = 0.05, reg: float = 0.2, seed: int = 42
) -> Machine:
    """Biases and embeddings by squared error: a factorisation machine over sparse user and item indicators.

    MLlib holds the coefficients as one vector on the driver and sends it to the tasks every round, so the fit
    is refused above ``FM_NUMBERS`` of them; ALS has no such bound.
    """
    spark = indexed.ratings.sparkSession
    sizes = indexed.users.count(), indexed.items.count()
    if not all(sizes):
        raise ValueError("no ratings to fit")
    if sum(sizes) * (rank + 1) > FM_NUMBERS:
        raise ValueError(f"{sum(sizes)} ids at rank {rank} are too many for one vector; use ALS")
    # Ratings less their mean, so that the penalty does not pull the mean to zero.
    centre = float(indexed.ratings.agg(F.avg("overall")).first()[0])
    # The encoder learns the number of slots from the largest ids, which are in the ratings.
    rating = (F.col("overall") - centre).alias("overall")
    coded = indexed.ratings.select(F.col("user").cast("double"), F.col("item").cast("double"), rating)
    hot = OneHotEncoder(inputCols=["user", "item"], outputCols=["__u", "__i"], dropLast=False).fit(coded).transform(coded)
    rows = VectorAssembler(inputCols=["__u", "__i"], outputCol="features").transform(hot).select("features", "overall")
    # Sparse rows are few bytes, which one task would read in every round; each task sends a whole gradient, so not more than cores.
    ready = materialise(rows.repartition(spark.sparkContext.defaultParallelism))
    fitted = FMRegressor(
        featuresCol="features", labelCol="overall", factorSize=rank, maxIter=iters, stepSize=step, regParam=reg, seed=seed,
        tol=1e-5,
    ).fit(ready)
    bias, vectors = fitted.linear.toArray(), fitted.factors.toArray()

    def side(ids: DataFrame, index: str, start: int, count: int) -> DataFrame:
        part = slice(start, start + count)
        table = pd.DataFrame({index: np.arange(count), "bias": bias[part], "vec": vectors[part].tolist()})
        return ids.join(spark.createDataFrame(table, f"{index} long, bias double, vec array<double>"), index)

    users, items = side(indexed.users, "user", 0, sizes[0]), side(indexed.items, "item", sizes[0], sizes[1])
    return Machine(materialise(users), materialise(items), centre + float(fitted.intercept), rank)


def predict_fm(model: Machine, pairs: DataFrame, unknown: float = UNKNOWN_RATING) -> DataFrame:
    """Adds ``prediction`` to (reviewerID, asin) pairs; a pair with an unknown side gets ``unknown``."""
    users = model.users.select("reviewerID", F.col("bias").alias("__bu"), F.col("vec").alias("__u"))
    items = model.items.select("asin", F.col("bias").alias("__bi"), F.col("vec").alias("__v"))
    joined = pairs.join(users, "reviewerID", "left").join(items, "asin", "left")
    rating = F.lit(model.mean) + F.col("__bu") + F.col("__bi") + dot(F.col("__u"), F.col("__v"))
    return joined.withColumn("prediction", F.coalesce(rating, F.lit(unknown))).drop("__bu", "__u", "__bi", "__v")


# --- truncated SVD --------------------------------------------------------------------------


def _gram(vectors: DataFrame, width: int) -> np.ndarray:
    """Sum of outer products: width x width numbers, whatever the number of rows."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for batch in batches:
            if len(batch):
                x = np.stack(batch["vec"].to_numpy())
                total += x.T @ x
        yield pd.DataFrame({"cell": np.arange(width * width, dtype=np.int64), "value": total.ravel()})

    cells = vectors.select("vec").mapInPandas(partial, "cell long, value double")
    out = np.zeros(width * width)
    for row in cells.groupBy("cell").agg(F.sum("value").alias("value")).collect():
        out[row["cell"]] = row["value"]
    return out.reshape(width, width)


def _times(vectors: DataFrame, matrix: np.ndarray) -> DataFrame:
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def apply(vec: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(vec.to_numpy()) @ matrix)) if len(vec) else pd.Series([], dtype=object)

    return vectors.withColumn("vec", apply("vec"))


def _orthonormal(vectors: DataFrame, width: int) -> tuple[DataFrame, int]:
    """The same column space with orthonormal columns, from the eigenvectors of the Gram matrix."""
    values, basis = np.linalg.eigh(_gram(vectors, width))
    keep = values > max(values.max(), 0.0) * 1e-12
    return _times(vectors, basis[:, keep] / np.sqrt(values[keep])), int(keep.sum())


def _multiply(ratings: DataFrame, vectors: DataFrame, inner: str, outer: str) -> DataFrame:
    """Sparse matrix times dense rows: one join on the inner index, one weighted vector sum per outer index.

    MLlib's vector sum has partial sums on the map side, so a popular row is reduced before the shuffle; its
    weights, the ratings, must not be negative. The planner takes an array for one number long, so without the
    hint it would broadcast a table of vectors through the driver.
    """
    joined = ratings.join(vectors.hint("merge"), inner).select(outer, "overall", array_to_vector("vec").alias("vec"))
    sums = joined.groupBy(outer).agg(Summarizer.sum(F.col("vec"), F.col("overall")).alias("vec"))
    return sums.select(outer, vector_to_array("vec").alias("vec"))


def train_svd(indexed: Indexed, k: int = 50, oversample: int = 10, rounds: int = 4, seed: int = 42) -> tuple[Factors, list[float]]:
    """(factors, singular values) of the rating matrix with missing entries as 0; ratings are not negative.

    Randomised subspace iteration: the big matrices stay tables, only a
    (k + oversample)-sized square reaches the driver.
    """
    width = k + oversample
    entries = indexed.ratings
    start = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda j: F.when(F.xxhash64(F.lit(seed), "item", j) % 2 == 0, 1.0).otherwise(-1.0),
    )
    right, width = _orthonormal(indexed.items.select("item", start.alias("vec")), width)
    for _ in range(rounds):
        left, width = _orthonormal(materialise(_multiply(entries, right, "item", "user")), width)
        right, width = _orthonormal(materialise(_multiply(entries, left, "user", "item")), width)
    right = materialise(right)
    left = materialise(_multiply(entries, right, "item", "user"))
    values, basis = np.linalg.eigh(_gram(left, width))
    top = np.argsort(-values)[:k]
    singular = [float(v) for v in np.sqrt(np.maximum(values[top], 0.0))]
    users = indexed.users.join(materialise(_times(left, basis[:, top])), "user")
    items = indexed.items.join(materialise(_times(right, basis[:, top])), "item")
    return Factors(users, items, len(top)), singular


def clip_rating(col: Column) -> Column:
    return F.least(F.greatest(col, F.lit(1.0)), F.lit(5.0))


def predict_svd(model: Factors, pairs: DataFrame) -> DataFrame:
    out = predict(model, pairs, unknown=None)
    return out.withColumn("prediction", F.coalesce(clip_rating(F.col("prediction")), F.lit(UNKNOWN_RATING)))


def tune_svd(indexed: Indexed, test: DataFrame, sizes: Sequence[int] = (10, 25, 50, 100)) -> DataFrame:
    """(components, rmse) on (reviewerID, asin, overall) test rows."""
    rows = []
    for size in sizes:
        scored = predict_svd(train_svd(indexed, size)[0], test)
        error = scored.agg(F.sqrt(F.avg(F.pow(F.col("overall") - F.col("prediction"), 2)))).first()[0]
        rows.append((size, float(error)))
    return test.sparkSession.createDataFrame(rows, "components int, rmse double")


# --- two-stage neural model -----------------------------------------------------------------


@dataclass
class Step:
    """One training step of the perceptron; ``kept`` marks a new least validation loss."""

    step: int
    train_loss: float
    valid_loss: float
    kept: bool


@dataclass
class Neural:
    """ALS embeddings and a perceptron over [user vector, item vector]."""

    factors: Factors
    net: MultilayerPerceptronClassificationModel
    seen: DataFrame  # reviewerID, asin
    popular: DataFrame  # asin, rank: all products by popularity
    history: list[Step]  # one per training step


def log_loss(net: MultilayerPerceptronClassificationModel, part: DataFrame) -> float:
    """Mean cross-entropy of the 0/1 ``label``; infinite if there is no row."""
    sure = F.element_at(vector_to_array("probability"), F.col("label").cast("int") + 1)
    loss = net.transform(part).agg(F.avg(-F.log(F.greatest(sure, F.lit(1e-15))))).first()[0]
    return math.inf if loss is None else float(loss)


def fit_net(
    train: DataFrame,
    valid: DataFrame,
    layers: Sequence[int],
    rounds: int = 5,
    most: int = 20,
    patience: int = 3,
    least_gain: float = 1e-4,
    seed: int = 42,
    start: MultilayerPerceptronClassificationModel | None = None,
    path: str | None = None,
) -> tuple[MultilayerPerceptronClassificationModel, list[Step]]:
    """(net of the step with the least validation loss, all steps), stopped early.

    A step is ``rounds`` L-BFGS rounds from the weights of the step before. Training ends after ``most`` steps, or
    once ``patience`` steps in a row have not lowered the validation loss by ``least_gain``. With ``path`` the
    net of every step is saved under ``step=n``; ``start`` goes on from a saved one.
    Without validation rows nothing is ever lower, so the first step stays.
    """
    spark = train.sparkSession
    part, judge = (materialise(perceptron.dealt(rows)) for rows in (train, valid))
    sizes = list(layers)
    net, best, steps = start if start is not None else perceptron.net_of(None, sizes, seed, spark), None, []
    least, idle = math.inf, 0
    weights = net.weights.toArray()

    def valid_loss(at: np.ndarray) -> float:
        count, total, _ = perceptron.summed(judge, at, sizes, slopes=False)
        return total / count if count else math.inf

    def objective(at: np.ndarray) -> tuple[float, np.ndarray]:
        count, total, slope = perceptron.summed(part, at, sizes)
        if not count:
            raise ValueError("no rows to train on")
        return total / count, slope / count

    if start is not None:
        best, least = start, valid_loss(weights)
    for number in range(1, most + 1):
        weights, train_loss = perceptron.minimise(objective, weights, rounds)
        net = perceptron.net_of(weights, sizes, seed, spark)
        loss = valid_loss(weights)
        better = best is None or loss < least - least_gain
        steps.append(Step(number, train_loss, loss, better))
        if path:
            net.write().overwrite().save(f"{path}/step={number}")
        if better:
            best, least, idle = net, loss, 0
        else:
            idle += 1
        if idle >= patience:
            break
    return best, steps


def train_ncf(
    df: DataFrame,
    rank: int = 64,
    layers: Sequence[int] = (128, 64, 32),
    most: int = 20,
    patience: int = 3,
    seed: int = 42,
    order: Sequence[str] = ("review_timestamp",),
    path: str | None = None,
) -> Neural:
    """Embeddings by ALS on the 0/1 target, then the perceptron on the same pairs, a tenth of which says when to stop."""
    df = materialise(df.select(*dict.fromkeys(["reviewerID", "asin", "overall", *order])))
    ratings = materialise(
        interactions(df, order).withColumn("label", F.when(F.col("overall") >= LIKED, 1.0).otherwise(0.0))
    )
    indexed = index_ratings(ratings.select("reviewerID", "asin", F.col("label").alias("overall")))
    factors = train_als(indexed, rank=rank, iters=5, seed=seed)
    factors = Factors(materialise(factors.users), materialise(factors.items), rank)
    held = (split_point(["reviewerID", "asin"], seed) >= 900).alias("held")
    pairs = materialise(
        _pairs(ratings.select("reviewerID", "asin", "label"), factors).select("features", "label", held)
    )
    net, history = fit_net(
        pairs.filter("not held"), pairs.filter("held"), [2 * rank, *layers, 2], most=most, patience=patience, seed=seed,
        path=path,
    )
    counts = df.groupBy("asin").agg(F.count(F.lit(1)).alias("n"), F.avg("overall").alias("mean"))
    order = [F.col("n").desc(), F.col("mean").desc(), F.col("asin").asc()]
    popular = materialise(running_totals(counts, [], order, {"rank": F.lit(1)}).select("asin", F.col("rank").cast("int")))
    return Neural(factors, net, ratings.select("reviewerID", "asin"), popular, history)


def _pairs(pairs: DataFrame, factors: Factors) -> DataFrame:
    joined = pairs.join(factors.users.select("reviewerID", F.col("vec").alias("__u")), "reviewerID").join(
        factors.items.select("asin", F.col("vec").alias("__v")), "asin"
    )
    return joined.withColumn("features", array_to_vector(F.concat("__u", "__v"))).drop("__u", "__v")


def ncf_predict(model: Neural, pairs: DataFrame) -> DataFrame:
    """Adds ``probability`` of a positive rating; a pair with an unknown side gets 0.5."""
    known = model.net.transform(_pairs(pairs.select("reviewerID", "asin").distinct(), model.factors))
    scored = known.select("reviewerID", "asin", vector_to_array("probability")[1].alias("__p"))
    return pairs.join(scored, ["reviewerID", "asin"], "left").withColumn(
        "probability", F.coalesce("__p", F.lit(0.5))
    ).drop("__p")


def ncf_recommend(model: Neural, candidates: DataFrame, users: DataFrame, k: int) -> DataFrame:
    """(reviewerID, asin, score, rank, method): the k most probable unseen ``candidates`` of each user.

    ``candidates`` (reviewerID, asin) says which pairs are scored, so the work is that table and not users x
    items; the result is complete over it. Users that the model does not know get the k most
    popular items.
    """
    asked = users.select("reviewerID").distinct()
    pairs = candidates.select("reviewerID", "asin").distinct().join(asked, "reviewerID", "left_semi")
    unseen = pairs.join(model.seen.select("reviewerID", "asin").distinct(), ["reviewerID", "asin"], "left_anti")
    known = unseen.join(model.factors.users.select("reviewerID"), "reviewerID", "left_semi")
    best = W.partitionBy("reviewerID").orderBy(F.desc("probability"), "asin")
    own = ncf_predict(model, known).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "reviewerID", "asin", F.col("probability").alias("score"), "rank", F.lit("model").alias("method")
    )
    return own.unionByName(popular_lists(model, users, k))


def popular_lists(model: Neural, users: DataFrame, k: int) -> DataFrame:
    """The k most popular items for each of ``users`` that the model does not know."""
    asked = users.select("reviewerID").distinct()
    strangers = asked.join(model.factors.users.select("reviewerID"), "reviewerID", "left_anti")
    listed = model.popular.filter(F.col("rank") <= k).agg(F.collect_list(F.struct("asin", "rank")).alias("__l"))
    return attach_totals(strangers, listed).select("reviewerID", F.explode("__l").alias("__i")).select(
        "reviewerID", "__i.asin", F.lit(0.5).alias("score"), "__i.rank", F.lit("popular").alias("method")
    )


# --- saving ---------------------------------------------------------------------------------


def save_factors(model: Factors, path: str) -> None:
    """Vectors with their id maps as two Parquet tables."""
    model.users.withColumn("rank", F.lit(model.rank)).write.mode("overwrite").parquet(f"{path}/users")
    model.items.withColumn("rank", F.lit(model.rank)).write.mode("overwrite").parquet(f"{path}/items")


def load_factors(spark, path: str) -> Factors:
    users, items = spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/items")
    return Factors(users.drop("rank"), items.drop("rank"), int(items.select("rank").first()[0]))


def save_neural(model: Neural, path: str) -> None:
    save_factors(model.factors, f"{path}/factors")
    model.net.write().overwrite().save(f"{path}/net")
    model.seen.write.mode("overwrite").parquet(f"{path}/seen")
    model.popular.write.mode("overwrite").parquet(f"{path}/popular")


def load_neural(spark, path: str) -> Neural:
    return Neural(
        load_factors(spark, f"{path}/factors"),
        MultilayerPerceptronClassificationModel.load(f"{path}/net"),
        spark.read.parquet(f"{path}/seen"),
        spark.read.parquet(f"{path}/popular"),
        [],
    )
