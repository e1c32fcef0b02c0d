"""Interactions, ids, popularity, baselines, list metrics and routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewmill.operators import neighbours, ordered
from reviewmill.operators.joins import attach_totals
from reviewmill.session import materialise

LIKED = 4  # a rating from here on counts as a positive interaction


def index_ids(df: DataFrame, col: str, name: str) -> DataFrame:
    """(col, name): dense index 0..n-1 in sorted order, built without collecting the ids."""
    ids = df.select(col).filter(F.col(col).isNotNull()).distinct()
    numbered = ordered.group_totals(ids, [], col, {"__at": F.lit(1).cast("long")})
    return numbered.select(col, (F.col("__at") - 1).alias(name))


def interactions(df: DataFrame, order: Sequence[str] = ("review_timestamp",)) -> DataFrame:
    """One rating per (user, item): the latest one, by the total order given."""
    latest = F.max_by("overall", F.struct(*order))
    return df.groupBy("reviewerID", "asin").agg(latest.alias("overall"))


def split_point(keys: Sequence[str], seed: int = 42) -> Column:
    """0..999 from a seeded digest of the keys: the same row always lands on the same side."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 1000).cast("int")


def hash_split(
    df: DataFrame, keys: Sequence[str], train: float = 0.8, seed: int = 42, store: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(train part, rest). With ``store`` these columns are written once, so whoever reads the parts often does not make ``df`` again."""
    first = split_point(keys, seed) < int(train * 1000)
    if store is None:
        return df.filter(first), df.filter(~first)
    stored = materialise(df.select(*store, first.alias("__first")))
    return stored.filter("__first").drop("__first"), stored.filter("not __first").drop("__first")


def temporal_split(df: DataFrame, ties: Sequence[str], holdout: int = 1) -> tuple[DataFrame, DataFrame]:
    """The last ``holdout`` reviews of every user are the test part."""
    order = [F.col("review_timestamp").desc(), *[F.col(t).desc() for t in ties]]
    ranked = ordered.number_rows(df, ["reviewerID"], order, "__rank")
    test = F.col("__rank") <= holdout
    return ranked.filter(~test).drop("__rank"), ranked.filter(test).drop("__rank")


def binary_target(df: DataFrame, col: str = "overall", name: str = "label") -> DataFrame:
    return df.withColumn(name, F.when(F.col(col) >= LIKED, 1).otherwise(0))


def top_products(df: DataFrame, n: int, by: str | None = "category") -> DataFrame:
    """Products by review count, then mean rating, then id; top n per ``by``."""
    keys = [by] if by else []
    per = df.groupBy(*keys, "asin").agg(F.count(F.lit(1)).alias("score"), F.avg("overall").alias("avg_rating"))
    order = [F.col("score").desc(), F.col("avg_rating").desc(), F.col("asin").asc()]
    if not by:
        # The n best come first by a top-n, so the numbering sees n rows.
        return per.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(W.orderBy(*order)))
    ranked = per.withColumn("rank", F.row_number().over(W.partitionBy(by).orderBy(*order)))
    return ranked.filter(F.col("rank") <= n)


def category_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.count_distinct("reviewerID").alias("unique_users"),
        F.count_distinct("asin").alias("unique_products"),
        F.avg("overall").alias("avg_rating"),
    )


def list_products(df: DataFrame, category: str, n: int) -> DataFrame:
    return df.filter(F.col("category") == category).select("asin").distinct().orderBy("asin").limit(n)


def baseline_predict(pairs: DataFrame, df: DataFrame) -> DataFrame:
    """Product mean (confidence .7), else global mean (.5), with the method used."""
    means = df.groupBy("asin").agg(F.avg("overall").alias("__product"))
    overall = df.agg(F.avg("overall").alias("__global"))
    known = F.col("__product").isNotNull()
    return (
        attach_totals(pairs.join(means, "asin", "left"), overall)
        .withColumn("predicted_rating", F.coalesce("__product", "__global"))
        .withColumn("confidence", F.when(known, 0.7).otherwise(0.5))
        .withColumn("method", F.when(known, "product_average").otherwise("global_average"))
        .drop("__product", "__global")
    )


def batch_recommend(users: DataFrame, recs: DataFrame, popular: DataFrame, k: int) -> DataFrame:
    """(reviewerID, status, method, recommendations) for each requested user.

    ``recs``: (reviewerID, asin, rank) rows; users without any get the popular
    list, a single row of at most k products.
    """
    fallback = popular.filter(F.col("rank") <= k).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "asin"))), lambda s: s["asin"]).alias("__popular")
    )
    own = (
        recs.filter(F.col("rank") <= k)
        .groupBy("reviewerID")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "asin"))), lambda s: s["asin"]).alias("__own"))
    )
    has = F.col("__own").isNotNull()
    return attach_totals(users.join(own, "reviewerID", "left"), fallback).select(
        "reviewerID",
        F.when(has | (F.size("__popular") > 0), "success").otherwise("error").alias("status"),
        F.when(has, "model").otherwise("popular").alias("method"),
        F.coalesce("__own", "__popular").alias("recommendations"),
    )


def _digest(seed: int, col: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(col)))


def route_recommendations(
    users: DataFrame, model: DataFrame, catalogue: DataFrame, k: int, seed: int = 42
) -> DataFrame:
    """Group B (or no test) gets the model's list, group A a hash-shuffled one.

    ``users``: (reviewerID, group or null); ``model``: (reviewerID, asin, rank).
    The shuffled list of a user is a run of k products that starts at a hashed
    position on a hashed ring of the catalogue, so no user meets the whole catalogue.
    """
    # Both are read twice. Left as plans, a filter by group would go below the distinct that names the users, so that
    # every row of theirs is hashed.
    users, catalogue = materialise(users), materialise(catalogue.select("asin").distinct())
    size = catalogue.agg(F.count(F.lit(1)).alias("__size"))
    ring = catalogue.select("asin", _digest(seed, "asin").alias("__h"))
    placed = ordered.group_totals(
        ring.withColumn("__key", F.struct("__h", "asin")), [], "__key", {"__pos": F.lit(1).cast("long")}
    ).select("asin", (F.col("__pos") - 1).alias("__pos"))
    control = attach_totals(users.filter(F.col("group") == "A"), size)
    steps = F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(k).cast("long"), F.col("__size")) - 1))
    start = F.pmod(F.conv(F.substring(_digest(seed, "reviewerID"), 1, 8), 16, 10).cast("long"), F.col("__size"))
    shuffled = (
        control.filter(F.col("__size") > 0)
        .withColumn("__step", steps)
        .withColumn("__pos", F.pmod(start + F.col("__step"), F.col("__size")))
        .join(placed, "__pos")
        .select("reviewerID", "asin", (F.col("__step") + 1).cast("int").alias("rank"), F.lit("random").alias("source"))
    )
    treated = users.filter(F.coalesce(F.col("group") != "A", F.lit(True))).select("reviewerID")
    ranked = model.filter(F.col("rank") <= k).join(treated, "reviewerID", "left_semi")
    return shuffled.unionByName(ranked.select("reviewerID", "asin", "rank", F.lit("model").alias("source")))


def user_knn(ratings: DataFrame, k: int = 20) -> DataFrame:
    """(reviewerID, neighbour, similarity, rank): nearest users by cosine of their rating rows."""
    ratings = materialise(ratings.select("reviewerID", "asin", "overall"))
    users = index_ids(ratings, "reviewerID", "id")
    items = index_ids(ratings, "asin", "item")
    entries = (
        ratings.join(users, "reviewerID").join(items, "asin").select("id", "item", F.col("overall").alias("weight"))
    )
    near = neighbours.sparse_cosine(entries, k)
    other = users.select(F.col("reviewerID").alias("neighbour"), F.col("id").alias("partner"))
    return near.join(users, "id").join(other, "partner").select(
        "reviewerID", "neighbour", F.col("score").alias("similarity"), "rank"
    )


def similar(vectors: DataFrame, k: int, **options) -> DataFrame:
    """(id, partner, score, rank): the k most similar other rows by cosine of ``vec``."""
    units = vectors.select("id", neighbours.unit(F.col("vec")).alias("vec"))
    return neighbours.top_inner(units, units, k, exclude_self=True, **options)


# --- list metrics ---------------------------------------------------------------------------


def ranking_metrics(scored: DataFrame, k: int, user: str = "reviewerID") -> DataFrame:
    """Per user NDCG@k, precision@k and recall@k from (user, item, score, rating)."""
    relevant = (F.col("rating") >= LIKED).cast("int")
    order = W.partitionBy(user).orderBy(F.col("score").desc(), F.col("item").asc())
    top = scored.withColumn("__pos", F.row_number().over(order)).filter(F.col("__pos") <= k)
    gained = top.groupBy(user).agg(
        F.sum(relevant).alias("hits"), F.sum(relevant / F.log2(F.col("__pos") + 1)).alias("dcg")
    )
    wanted = scored.groupBy(user).agg(F.sum(relevant).alias("relevant"))
    reachable = F.least(F.col("relevant"), F.lit(k)).cast("int")
    ideal = F.aggregate(
        F.when(reachable > 0, F.sequence(F.lit(1), reachable)).otherwise(F.array().cast("array<int>")),
        F.lit(0.0),
        lambda a, i: a + F.lit(1.0) / F.log2(i + 1),
    )
    return gained.join(wanted, user).select(
        user,
        F.when(F.col("relevant") > 0, F.col("dcg") / ideal).alias("ndcg"),
        (F.col("hits") / F.lit(k)).alias("precision"),
        F.when(F.col("relevant") > 0, F.col("hits") / F.col("relevant")).alias("recall"),
    )


def mean_ranking_metrics(per_user: DataFrame) -> DataFrame:
    return per_user.agg(
        F.count(F.lit(1)).alias("users"), F.avg("ndcg").alias("ndcg"), F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
    )


def coverage(recs: DataFrame, test: DataFrame, item: str = "asin") -> DataFrame:
    """Share of the test items that are recommended to anybody."""
    items = test.select(item).distinct()
    hit = recs.select(item).distinct().withColumn("__hit", F.lit(1))
    return items.join(hit, item, "left").agg(
        F.count(F.lit(1)).alias("test_items"), F.count("__hit").alias("covered_items")
    ).withColumn("coverage", F.coalesce(F.try_divide("covered_items", "test_items"), F.lit(0.0)))


def diversity(recs: DataFrame, vectors: DataFrame | None = None, user: str = "reviewerID", item: str = "asin") -> DataFrame:
    """Per user 1 - mean pairwise similarity of the recommended items.

    Identity similarity by default, cosine with ``vectors`` (item, vec), which have one length; a missing
    component counts as zero. The sum over pairs comes from sums over items: sum of u_i.u_j = (|sum u|^2 - sum |u_i|^2) / 2.
    A vector travels once, as it is, to the user that was recommended its item, and is scaled by its weight there.
    """
    if vectors is None:
        copies = recs.groupBy(user, item).agg(F.count(F.lit(1)).alias("__c"))
        parts = copies.groupBy(user).agg(
            F.sum("__c").alias("n"), (F.sum(F.col("__c") * (F.col("__c") - 1)) / 2).alias("__same")
        )
    else:
        kind = vectors.schema["vec"].dataType.elementType
        norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0)).cast("double") ** 2))
        scaled = (norm > 0) & (norm < float("inf"))
        weighted = vectors.filter(F.col("vec").isNotNull()).select(
            item, F.transform("vec", lambda x: F.ifnull(x, F.lit(0).cast(kind))).alias("vec"),
            F.when(scaled, 1 / norm).otherwise(1.0).alias("__w"), F.when(scaled, 1.0).otherwise(norm * norm).alias("__q"),
        )
        placed = recs.select(user, item).join(weighted, item).select(user, "vec", "__w", "__q").repartition(user)
        sums = placed.groupBy(user).agg(
            F.count(F.lit(1)).alias("n"), F.sum("__q").alias("__q"),
            vector_to_array(Summarizer.sum(array_to_vector("vec"), F.col("__w"))).alias("__s"),
        )
        square = F.aggregate("__s", F.lit(0.0), lambda a, x: a + x * x)
        parts = sums.select(user, "n", ((square - F.col("__q")) / 2).alias("__same"))
    pairs = F.col("n") * (F.col("n") - 1) / 2
    return parts.filter(F.col("n") > 1).select(user, (1 - F.col("__same") / pairs).alias("diversity"))


def novelty(recs: DataFrame, train: DataFrame, user: str = "reviewerID", item: str = "asin") -> DataFrame:
    """Per user mean of -log2((popularity + 1) / total) over the recommended items."""
    counts = train.groupBy(item).agg(F.count(F.lit(1)).alias("__pop"))
    total = train.agg(F.count(F.lit(1)).alias("__total"))
    surprise = -F.log2((F.coalesce(F.col("__pop"), F.lit(0)) + 1) / F.col("__total"))
    joined = attach_totals(recs.join(counts, item, "left"), total)
    return joined.groupBy(user).agg(F.avg(surprise).alias("novelty"))
