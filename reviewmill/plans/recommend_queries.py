"""Recommendation, similarity and list-metric queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.operators import factors, layout, neural_topk, recommend
from reviewmill.operators.joins import attach_totals
from reviewmill.operators.metrics import regression_metrics
from reviewmill.plans.etl_queries import TIES_DESC
from reviewmill.plans.registry import Catalog, r6, rounded
from reviewmill.plans.views import BUCKET, sql
from reviewmill.session import materialise, shared_folder
from reviewmill.sources import testviews as tv

catalog = Catalog()
KEYS = ("reviewerID", "asin", "review_timestamp", "doc_id")
ORDER = ("review_timestamp", "overall", "helpful_votes", "total_votes", "doc_id")
RATED = ("reviewerID", "asin", *ORDER)
_POINT = (
    "('0x' || substr(md5(concat_ws('|', '42', \"reviewerID\", asin, "
    "strftime(review_timestamp, '%Y-%m-%d %H:%M:%S'), doc_id::varchar)), 1, 8))::bigint % 1000"
)


@catalog.add("top_products_by_category", sql("""
, per as (select category, asin, count(*) as score, avg(overall) as avg_rating from reviews group by 1, 2)
select category, asin, score, round(avg_rating, 6) as avg_rating, rank from (
  select *, cast(row_number() over (partition by category order by score desc, avg_rating desc, asin) as int) as rank
  from per) where rank <= 10""", "reviews"))
def top_products_by_category(spark, sf_dir):
    return rounded(recommend.top_products(tv.reviews(spark, sf_dir), 10), "avg_rating")


@catalog.add("top_products_overall", sql("""
, per as (select asin, count(*) as score, avg(overall) as avg_rating from reviews group by 1)
select asin, score, round(avg_rating, 6) as avg_rating, rank from (
  select *, cast(row_number() over (order by score desc, avg_rating desc, asin) as int) as rank from per)
where rank <= 20""", "reviews"))
def top_products_overall(spark, sf_dir):
    return rounded(recommend.top_products(tv.reviews(spark, sf_dir), 20, by=None), "avg_rating")


@catalog.add("category_stats", sql("""
select category, count(*) as total_reviews, count(distinct "reviewerID") as unique_users,
  count(distinct asin) as unique_products, round(avg(overall), 6) as avg_rating from reviews group by 1""", "reviews"))
def category_stats(spark, sf_dir):
    return rounded(recommend.category_stats(tv.reviews(spark, sf_dir)), "avg_rating")


@catalog.add("list_products", sql("""
select distinct asin from reviews where category = 'electronics' order by 1 limit 100""", "reviews"))
def list_products(spark, sf_dir):
    return recommend.list_products(tv.reviews(spark, sf_dir), "electronics", 100)


_SPLIT = f", cut as (select *, {_POINT} < 800 as is_train from reviews)"


@catalog.add("hash_split", sql(_SPLIT + """
select "reviewerID", asin, review_timestamp, doc_id, is_train from cut""", "reviews"))
def hash_split(spark, sf_dir):
    train, test = recommend.hash_split(tv.reviews(spark, sf_dir), KEYS)
    cols = ("reviewerID", "asin", "review_timestamp", "doc_id")
    return train.select(*cols, F.lit(True).alias("is_train")).unionByName(
        test.select(*cols, F.lit(False).alias("is_train"))
    )


@catalog.add("temporal_split", sql(f"""
select * exclude (rn), rn <= 1 as is_test from (
  select *, row_number() over (partition by "reviewerID" order by {TIES_DESC}) as rn from reviews)""", "reviews"))
def temporal_split(spark, sf_dir):
    train, test = recommend.temporal_split(tv.reviews(spark, sf_dir), tv.TIES)
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


@catalog.add("index_ids", sql("""
select 'user' as kind, "reviewerID" as id, row_number() over (order by "reviewerID") - 1 as index
from (select distinct "reviewerID" from reviews)
union all select 'item', asin, row_number() over (order by asin) - 1 from (select distinct asin from reviews)""",
    "reviews"))
def index_ids(spark, sf_dir):
    df = tv.reviews(spark, sf_dir)
    users = recommend.index_ids(df, "reviewerID", "index")
    items = recommend.index_ids(df, "asin", "index")
    return users.select(F.lit("user").alias("kind"), F.col("reviewerID").alias("id"), "index").unionByName(
        items.select(F.lit("item").alias("kind"), F.col("asin").alias("id"), "index")
    )


_INTER = """
, inter as (select "reviewerID", asin, overall from (
  select *, row_number() over (partition by "reviewerID", asin
    order by review_timestamp desc, overall desc, helpful_votes desc, total_votes desc, doc_id desc) as rn
  from reviews) where rn = 1)"""


@catalog.add("interactions", sql(_INTER + """ select * from inter""", "reviews"))
def interactions(spark, sf_dir):
    return recommend.interactions(tv.reviews(spark, sf_dir), ORDER)


@catalog.add("binary_target", sql("""
select "reviewerID", asin, review_timestamp, doc_id, case when overall >= 4 then 1 else 0 end as label from reviews""",
    "reviews"))
def binary_target(spark, sf_dir):
    return recommend.binary_target(tv.reviews(spark, sf_dir)).select(*KEYS, "label")


_BASE = _SPLIT + """
, means as (select asin, avg(overall) as m from cut where is_train group by 1),
g as (select avg(overall) as m from cut where is_train)"""


@catalog.add("baseline_predict", sql(_BASE + """
select "reviewerID", t.asin, round(coalesce(means.m, g.m), 6) as predicted_rating,
  case when means.m is not null then 0.7e0 else 0.5e0 end as confidence,
  case when means.m is not null then 'product_average' else 'global_average' end as method
from (select "reviewerID", case when doc_id % 10 = 0 then asin || '?' else asin end as asin from cut where not is_train) t
left join means on t.asin = means.asin, g""", "reviews"))
def baseline_predict(spark, sf_dir):
    train, test = recommend.hash_split(tv.reviews(spark, sf_dir), KEYS)
    # Every tenth pair asks for a product nobody has reviewed.
    unknown = F.concat("asin", F.lit("?"))
    pairs = test.select("reviewerID", F.when(F.col("doc_id") % 10 == 0, unknown).otherwise(F.col("asin")).alias("asin"))
    return rounded(recommend.baseline_predict(pairs, train), "predicted_rating")


_SCORED = _BASE + """
, scored as (select c."reviewerID", c.asin, overall, coalesce(means.m, g.m) as score
  from cut c left join means on c.asin = means.asin, g where not is_train),
top as (select *, row_number() over (partition by "reviewerID" order by round(score, 6) desc, asin) as rn from scored)"""


def _scored(spark, sf_dir):
    # Written once: the means, the totals, the lists and what is made of them each read a part.
    train, test = recommend.hash_split(tv.reviews(spark, sf_dir), KEYS, store=("reviewerID", "asin", "overall"))
    scored = recommend.baseline_predict(test, train).select(
        "reviewerID", F.col("asin").alias("item"), F.col("overall").alias("rating"),
        r6("predicted_rating").alias("score"),
    )
    return train, scored


@catalog.add("regression_metrics", sql(_SCORED + """
select count(*) as n, round(sqrt(avg(power(overall - score, 2))), 6) as rmse,
  round(avg(abs(overall - score)), 6) as mae,
  round(1 - sum(power(overall - score, 2)) / (var_pop(overall) * count(*)), 6) as r2
from (select overall, round(score, 6) as score from scored)""", "reviews"))
def regression_metrics_query(spark, sf_dir):
    _, scored = _scored(spark, sf_dir)
    return rounded(regression_metrics(scored, "rating", "score"), "rmse", "mae", "r2")


_RANKING = _SCORED + """
, dedup as (select "reviewerID", asin, max(overall) as overall, max(score) as score from scored group by 1, 2),
pos as (select *, row_number() over (partition by "reviewerID" order by round(score, 6) desc, asin) as p from dedup),
per as (select "reviewerID", sum((overall >= 4)::int) filter (p <= 5) as hits,
    sum((overall >= 4)::int / log2(p + 1)) filter (p <= 5) as dcg, sum((overall >= 4)::int) as rel from pos group by 1),
done as (select *, list_sum(list_transform(range(1, least(rel, 5)::bigint + 1), lambda i: 1 / log2(i + 1))) as ideal from per)
"""


def _dedup_scored(spark, sf_dir):
    _, scored = _scored(spark, sf_dir)
    return scored.groupBy("reviewerID", "item").agg(F.max("rating").alias("rating"), F.max("score").alias("score"))


@catalog.add("ranking_metrics", sql(_RANKING + """
select "reviewerID", round(case when rel > 0 then dcg / ideal end, 6) as ndcg, round(hits / 5, 6) as precision,
  round(case when rel > 0 then hits / rel end, 6) as recall from done""", "reviews"))
def ranking_metrics(spark, sf_dir):
    return rounded(recommend.ranking_metrics(_dedup_scored(spark, sf_dir), 5), "ndcg", "precision", "recall")


@catalog.add("ranking_metrics_mean", sql(_RANKING + """
select count(*) as users, round(avg(case when rel > 0 then dcg / ideal end), 6) as ndcg,
  round(avg(hits / 5), 6) as precision, round(avg(case when rel > 0 then hits / rel end), 6) as recall from done""",
    "reviews"))
def ranking_metrics_mean(spark, sf_dir):
    per_user = recommend.ranking_metrics(_dedup_scored(spark, sf_dir), 5)
    return rounded(recommend.mean_ranking_metrics(per_user), "ndcg", "precision", "recall")


def _top_lists(spark, sf_dir, k: int = 5):
    from pyspark.sql import Window as W

    train, scored = _scored(spark, sf_dir)
    order = W.partitionBy("reviewerID").orderBy(F.col("score").desc(), "item")
    lists = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return train, scored.withColumnRenamed("item", "asin"), lists.withColumnRenamed("item", "asin")


@catalog.add("coverage", sql(_SCORED + """
select count(distinct asin) as test_items, count(distinct asin) filter (rn <= 5) as covered_items,
  round(count(distinct asin) filter (rn <= 5) / count(distinct asin), 6) as coverage from top""", "reviews"))
def coverage(spark, sf_dir):
    _, test, lists = _top_lists(spark, sf_dir)
    return rounded(recommend.coverage(lists, test), "coverage")


@catalog.add("diversity", sql(_SCORED + """
, c as (select "reviewerID", asin, count(*) as n from top where rn <= 5 group by 1, 2)
select "reviewerID", round(1 - (sum(n * (n - 1)) / 2) / (sum(n) * (sum(n) - 1) / 2), 6) as diversity
from c group by 1 having sum(n) > 1""", "reviews"))
def diversity(spark, sf_dir):
    _, _, lists = _top_lists(spark, sf_dir)
    return rounded(recommend.diversity(lists), "diversity")


@catalog.add("diversity_by_vectors", sql("""
, v as (select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings),
u as (select vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) as e from v),
l as (select distinct "reviewerID", doc_id % (select count(*) from embeddings) as vec_id from reviews)
select a."reviewerID", round(1 - avg(list_dot_product(ua.e, ub.e)), 6) as diversity
from l a join l b on a."reviewerID" = b."reviewerID" and a.vec_id < b.vec_id
join u ua on ua.vec_id = a.vec_id join u ub on ub.vec_id = b.vec_id group by 1""", "reviews"))
def diversity_by_vectors(spark, sf_dir):
    vectors = tv.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    size = vectors.agg(F.count(F.lit(1)).alias("__n"))
    lists = tv.attach_totals(tv.reviews(spark, sf_dir), size).select(
        "reviewerID", (F.col("doc_id") % F.col("__n")).alias("vec_id")
    ).distinct()
    return rounded(recommend.diversity(lists, vectors, item="vec_id"), "diversity")


@catalog.add("novelty", sql(_SCORED + """
, pop as (select asin, count(*) as n from cut where is_train group by 1)
select "reviewerID", round(avg(-log2((coalesce(n, 0) + 1) / (select count(*) from cut where is_train))), 6) as novelty
from top left join pop using (asin) where rn <= 5 group by 1""", "reviews"))
def novelty(spark, sf_dir):
    train, _, lists = _top_lists(spark, sf_dir)
    return rounded(recommend.novelty(lists, train), "novelty")


@catalog.add("batch_recommend", sql(_SCORED + """
, own as (select "reviewerID", string_agg(asin, ',' order by rn) as items from top where rn <= 5 group by 1),
pop as (select asin, row_number() over (order by count(*) desc, avg(overall) desc, asin) as rn
  from cut where is_train group by 1)
select concat('A', lpad(cast(c_custkey as varchar), 9, '0')) as "reviewerID", 'success' as status,
  case when items is not null then 'model' else 'popular' end as method,
  coalesce(items, (select string_agg(asin, ',' order by rn) from pop where rn <= 5)) as recommendations
from customer left join own on own."reviewerID" = concat('A', lpad(cast(c_custkey as varchar), 9, '0'))""", "reviews"))
def batch_recommend(spark, sf_dir):
    train, _, lists = _top_lists(spark, sf_dir)
    users = customers(spark, sf_dir)
    out = recommend.batch_recommend(users, lists, recommend.top_products(train, 5, by=None), 5)
    return out.withColumn("recommendations", F.concat_ws(",", "recommendations"))


@catalog.add("route_recommendations", sql(_SCORED + f"""
, people as (select "reviewerID", case when {BUCKET} < 50 then 'A' else 'B' end as grp
  from (select distinct "reviewerID", md5("reviewerID") as h from cut where is_train)),
ring as (select asin, row_number() over (order by md5(concat('42|', asin)), asin) - 1 as pos
  from (select distinct asin from cut where is_train)),
steps as (select "reviewerID", step, (('0x' || substr(md5(concat('42|', "reviewerID")), 1, 8))::bigint + step)
    % (select count(*) from ring) as pos
  from people, (select unnest(range(5)) as step) where grp = 'A' and step < (select count(*) from ring))
select "reviewerID", asin, (step + 1)::int as rank, 'random' as source from steps join ring using (pos)
union all select t."reviewerID", t.asin, t.rn::int, 'model' from top t join people p on t."reviewerID" = p."reviewerID"
where p.grp = 'B' and t.rn <= 5""", "reviews"))
def route_recommendations(spark, sf_dir):
    from reviewmill.operators import experiments

    train, _, lists = _top_lists(spark, sf_dir)
    users = experiments.assign(train.select("reviewerID").distinct(), 0.5, user="reviewerID")
    return recommend.route_recommendations(users, lists, train.select("asin").distinct(), 5)


@catalog.add("user_knn", sql(_INTER + """
, n as (select "reviewerID", sqrt(sum(overall * overall)) as norm from inter group by 1),
w as (select i."reviewerID" as u, asin, overall / norm as w from inter i join n on i."reviewerID" = n."reviewerID"),
s as (select a.u as u, b.u as v, sum(a.w * b.w) as sim from w a join w b on a.asin = b.asin and a.u <> b.u group by 1, 2)
select u as "reviewerID", v as neighbour, round(sim, 6) as similarity, rank from (
  select *, cast(row_number() over (partition by u order by round(sim, 6) desc, v) as int) as rank from s)
where rank <= 20""", "reviews"))
def user_knn(spark, sf_dir):
    out = recommend.user_knn(recommend.interactions(tv.reviews(spark, sf_dir), ORDER), 20)
    return rounded(out, "similarity")


@catalog.add("similar_items", """
with v as (select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings),
u as (select vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) as e from v),
s as (select a.vec_id as id, b.vec_id as partner, list_dot_product(a.e, b.e) as score
      from u a join u b on a.vec_id <> b.vec_id)
select id, partner, round(score, 6) as score, rank from (
  select *, cast(row_number() over (partition by id order by round(score, 6) desc, partner) as int) as rank from s)
where rank <= 10""")
def similar_items(spark, sf_dir):
    vectors = tv.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return rounded(recommend.similar(vectors, 10, block_rows=256), "score")


_HIST = ", ".join(f"count(*) filter (overall = {r})::double" for r in range(1, 6))


@catalog.add("similar_users", sql(f"""
, h as (select o_custkey as id, [{_HIST}] as e from reviews r
  join (select distinct o_custkey from orders) c on r."reviewerID" = concat('A', lpad(cast(o_custkey as varchar), 9, '0'))
  group by 1),
u as (select id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) as e from h),
s as (select a.id as id, b.id as partner, list_dot_product(a.e, b.e) as score from u a join u b on a.id <> b.id)
select id, partner, round(score, 6) as score, rank from (
  select *, cast(row_number() over (partition by id order by round(score, 6) desc, partner) as int) as rank from s)
where rank <= 5""", "reviews"))
def similar_users(spark, sf_dir):
    df = tv.reviews(spark, sf_dir)
    counts = [F.count_if(F.col("overall") == r).cast("double") for r in range(1, 6)]
    vectors = df.groupBy(F.substring("reviewerID", 2, 9).cast("long").alias("id")).agg(F.array(*counts).alias("vec"))
    return rounded(recommend.similar(vectors, 5), "score")


# --- factor models: no SQL twin, checked by invariants and small brute-force fixtures ---------


def customers(spark, sf_dir):
    """All customers under their reviewer names, with and without reviews."""
    return tv.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("A"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("reviewerID")
    )


def train_als(spark, sf_dir):
    train, test = recommend.hash_split(tv.reviews(spark, sf_dir), KEYS)
    indexed = factors.index_ratings(recommend.interactions(train, ORDER))
    return factors.train_als(indexed, rank=10, iters=10, reg=0.1), train, test, indexed


@catalog.add("als_metrics")
def als_metrics(spark, sf_dir):
    model, _, test, _ = train_als(spark, sf_dir)
    return regression_metrics(factors.predict(model, test), "overall")


@catalog.add("als_reloaded", sql("""
select 'users' as part, count(distinct "reviewerID") as rows, 0::bigint as changed from reviews where "reviewerID" is not null
union all select 'items', count(distinct asin), 0 from reviews where asin is not null
union all select 'predictions', count(*), 0 from (select distinct "reviewerID", asin from reviews
  where "reviewerID" is not null and asin is not null)""", "reviews"))
def als_reloaded(spark, sf_dir):
    """A factor model is saved with its id maps and read back: rows of each part, and how many differ from the model in memory."""
    ratings = materialise(recommend.interactions(tv.reviews(spark, sf_dir), ORDER))
    model = factors.train_als(factors.index_ratings(ratings), rank=10, iters=3, reg=0.1)
    # Trained once: what is compared comes from stored tables.
    model = factors.Factors(materialise(model.users), materialise(model.items), model.rank)
    path = f"{shared_folder(spark)}/models/{uuid.uuid4().hex}"
    factors.save_factors(model, path)
    loaded = factors.load_factors(spark, path)

    def part(name: str, before: DataFrame, after: DataFrame) -> DataFrame:
        gone = before.select(*sorted(before.columns)).exceptAll(after.select(*sorted(before.columns)))
        rows, changed = after.agg(F.count("*").alias("rows")), gone.agg(F.count("*").alias("changed"))
        return attach_totals(rows, changed).select(F.lit(name).alias("part"), "rows", "changed")

    return part("users", model.users, loaded.users).unionByName(part("items", model.items, loaded.items)).unionByName(
        part("predictions", factors.predict(model, ratings), factors.predict(loaded, ratings))
    )


@catalog.add("als_topk")
def als_topk(spark, sf_dir):
    return factors.recommend_all(train_als(spark, sf_dir)[0], 10)


@catalog.add("als_checks", sql("""
select count(distinct "reviewerID") as users, count(distinct "reviewerID") * 10 as rows, true as ranks_dense,
  true as scores_fall, true as better_than_mean from reviews""", "reviews"))
def als_checks(spark, sf_dir):
    """What must hold for the k best items of every user, as facts that SQL can foretell."""
    df = tv.reviews(spark, sf_dir)
    ratings = materialise(recommend.interactions(df, ORDER))
    model = factors.train_als(factors.index_ratings(ratings), rank=10, iters=10, reg=0.1)
    per_user = factors.recommend_all(model, 10).groupBy("reviewerID").agg(
        F.count(F.lit(1)).alias("n"), F.min("rank").alias("low"), F.max("rank").alias("high"),
        F.count_distinct("asin").alias("items"), F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("listed"),
    )
    scores_of = F.transform("listed", lambda x: x["score"])
    falls = scores_of == F.reverse(F.array_sort(scores_of))
    fit = regression_metrics(factors.predict(model, ratings), "overall").select("rmse")
    mean = ratings.agg(F.stddev_pop("overall").alias("spread"))
    facts = per_user.agg(
        F.count(F.lit(1)).alias("users"), F.sum("n").alias("rows"),
        F.bool_and((F.col("low") == 1) & (F.col("high") == 10) & (F.col("n") == 10) & (F.col("items") == 10)).alias("ranks_dense"),
        F.bool_and(falls).alias("scores_fall"),
    )
    return attach_totals(attach_totals(facts, fit), mean).select(
        "users", "rows", "ranks_dense", "scores_fall", (F.col("rmse") < F.col("spread")).alias("better_than_mean")
    )


@catalog.add("als_for_users")
def als_for_users(spark, sf_dir):
    model, _, test, _ = train_als(spark, sf_dir)
    return factors.recommend_for(model, test.select("reviewerID"), 10)


@catalog.add("als_grid")
def als_grid(spark, sf_dir):
    train, _ = recommend.hash_split(tv.reviews(spark, sf_dir), KEYS)
    indexed = factors.index_ratings(recommend.interactions(train, ORDER))
    return factors.tune_als(indexed)[1]


@catalog.add("embedding_lookup")
def embedding_lookup(spark, sf_dir):
    model, _, _, _ = train_als(spark, sf_dir)
    users = customers(spark, sf_dir)
    return factors.embeddings(model.users, users, "reviewerID", model.rank)


@catalog.add("svd_topk")
def svd_topk(spark, sf_dir):
    indexed = factors.index_ratings(recommend.interactions(tv.reviews(spark, sf_dir), ORDER))
    model, _ = factors.train_svd(indexed)
    return factors.recommend_all(model, 10).withColumn("predicted_rating", factors.clip_rating(F.col("score")))


@catalog.add("svd_grid")
def svd_grid(spark, sf_dir):
    train, test = recommend.hash_split(tv.reviews(spark, sf_dir), KEYS, store=RATED)
    indexed = factors.index_ratings(recommend.interactions(train, ORDER))
    return factors.tune_svd(indexed, test)


@catalog.add("ncf_predict")
def ncf_predict(spark, sf_dir):
    train, test = recommend.hash_split(tv.reviews(spark, sf_dir), KEYS)
    model = factors.train_ncf(train, order=ORDER)
    return factors.ncf_predict(model, test.select("reviewerID", "asin", "overall"))


@catalog.add("ncf_topk")
def ncf_topk(spark, sf_dir):
    df = tv.reviews(spark, sf_dir)
    model = factors.train_ncf(df, rank=8, most=6, order=ORDER)
    return neural_topk.ncf_recommend_all(model, customers(spark, sf_dir), 10)


@catalog.add("ncf_topk_checks", sql("""
select case when r.id is null then 'popular' else 'model' end as method, count(*) as users, count(*) * 10 as rows,
  true as ranks_dense, true as scores_fall, 0::bigint as seen
from (select concat('A', lpad(c_custkey::varchar, 9, '0')) as id from customer) c
left join (select distinct "reviewerID" as id from reviews) r on r.id = c.id group by 1""", "reviews"))
def ncf_topk_checks(spark, sf_dir):
    """What must hold for the neural lists: ten unseen products for every customer, the most popular ones for unknown customers."""
    df = tv.reviews(spark, sf_dir)
    model = factors.train_ncf(df, rank=8, most=1, order=ORDER)
    lists = materialise(neural_topk.ncf_recommend_all(model, customers(spark, sf_dir), 10))
    scores_of = F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"])
    per_user = lists.groupBy("method", "reviewerID").agg(
        F.count(F.lit(1)).alias("n"), F.min("rank").alias("low"), F.max("rank").alias("high"),
        F.count_distinct("asin").alias("items"), scores_of.alias("scores"),
    )
    again = lists.join(df.select("reviewerID", "asin").distinct(), ["reviewerID", "asin"], "left_semi")
    seen = again.groupBy("method").agg(F.count(F.lit(1)).alias("seen"))
    dense = (F.col("low") == 1) & (F.col("high") == 10) & (F.col("n") == 10) & (F.col("items") == 10)
    facts = per_user.groupBy("method").agg(
        F.count(F.lit(1)).alias("users"), F.sum("n").alias("rows"), F.bool_and(dense).alias("ranks_dense"),
        F.bool_and(F.col("scores") == F.reverse(F.array_sort("scores"))).alias("scores_fall"),
    )
    return facts.join(seen, "method", "left").select(
        "method", "users", "rows", "ranks_dense", "scores_fall", F.coalesce("seen", F.lit(0)).cast("long").alias("seen")
    )


# --- layout and join shapes -----------------------------------------------------------------


@catalog.add("partition_skew")
def partition_skew(spark, sf_dir):
    df = layout.repartition_by(tv.reviews(spark, sf_dir), "hash", 8, "reviewerID")
    return layout.partition_skew(df)


@catalog.add("partition_by_category", sql("""
select category, 1::bigint as partitions, count(*) as rows from reviews group by 1""", "reviews"))
def partition_by_category(spark, sf_dir):
    # After a hash repartition every category sits in exactly one partition.
    df = layout.repartition_by(tv.reviews(spark, sf_dir), "hash", 8, "category")
    per = df.groupBy("category", F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("category").agg(F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("rows"))


_MONTHS = """
, sizes as (select year(review_timestamp) as y, month(review_timestamp) as m, count(*) as rows from reviews group by 1, 2),
facts as (select quantile_cont(rows, 0.5) as middle from sizes),
tests as (
  select 'above_median' as rule, 2.0 * middle as bound, rows, rows > 2.0 * middle as hit from sizes, facts
  union all select 'below_rows', 200.0, rows, rows < 200.0 from sizes
  union all select 'above_rows', 1500.0, rows, rows > 1500.0 from sizes)
select rule, round(bound, 6) as bound, count(*) filter (hit) as partitions,
  coalesce(sum(rows) filter (hit), 0)::bigint as affected_rows,
  round(coalesce(sum(rows) filter (hit), 0) / sum(rows), 6) as affected_share
from tests group by 1, 2"""


@catalog.add("layout_advice", sql(_MONTHS, "reviews"))
def layout_advice(spark, sf_dir):
    # How a table partitioned by year and month would come out.
    months = tv.reviews(spark, sf_dir).groupBy(
        F.year("review_timestamp").alias("y"), F.month("review_timestamp").alias("m")
    ).agg(F.count(F.lit(1)).alias("rows"))
    return rounded(layout.layout_findings(months, 2.0, 200, 1500), "bound", "affected_share")


_POPULAR = """
, pop as (select asin, count(*) as review_count from reviews group by 1 order by 2 desc, 1 limit 100)
select r.*, review_count from reviews r join pop on r.asin = pop.asin"""


@catalog.add("join_popular", sql(_POPULAR, "reviews"))
def join_popular(spark, sf_dir):
    return layout.join_popular(tv.reviews(spark, sf_dir))


@catalog.add("join_popular_broadcast", sql(_POPULAR, "reviews"))
def join_popular_broadcast(spark, sf_dir):
    return layout.join_popular(tv.reviews(spark, sf_dir), hint="broadcast")


@catalog.add("join_popular_shuffle_hash", sql(_POPULAR, "reviews"))
def join_popular_shuffle_hash(spark, sf_dir):
    return layout.join_popular(tv.reviews(spark, sf_dir), hint="shuffle_hash")


@catalog.add("latest_per_user", sql(f"""
select * from (select *, cast(row_number() over (partition by "reviewerID" order by {TIES_DESC}) as int) as row_num
  from reviews) where row_num <= 5""", "reviews"))
def latest_per_user(spark, sf_dir):
    return layout.latest_per_user(tv.reviews(spark, sf_dir), 5, tv.TIES)


@catalog.add("user_rollup", sql("""
select "reviewerID", count(*) as total_reviews, round(avg(overall), 6) as avg_rating,
  round(stddev_samp(overall), 6) as rating_std, min(overall) as min_rating, max(overall) as max_rating,
  count(*) filter (overall >= 4) as positive_reviews, quantile_disc(overall, 0.5) as median_rating
from reviews group by 1""", "reviews"))
def user_rollup(spark, sf_dir):
    return rounded(layout.user_rollup(tv.reviews(spark, sf_dir)), "avg_rating", "rating_std")


@catalog.add("active_users", sql("""
select "reviewerID", count(*) as num_reviews, round(avg(overall), 6) as avg_rating from reviews group by 1
having count(*) > 5""", "reviews"))
def active_users(spark, sf_dir):
    return rounded(layout.active_users(tv.reviews(spark, sf_dir), 5), "avg_rating")
