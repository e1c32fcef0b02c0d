"""Sources, sinks and the end-to-end job: the given tables go out in every format and come back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.operators import cleaning, enrich
from reviewmill.plans.registry import Catalog, r6
from reviewmill.plans.views import sql
from reviewmill.schemas import RAW_REVIEW
from reviewmill.session import shared_folder
from reviewmill.sources import readers, writers
from reviewmill.sources import testviews as tv

catalog = Catalog()


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"


def _narrow(df: DataFrame) -> DataFrame:
    """Raw reviews with long texts as digests, so that results stay small."""
    return df.select(
        "reviewerID", "asin", "reviewerName", F.md5("reviewText").alias("text_md5"), F.md5("summary").alias("summary_md5"),
        "overall", "unixReviewTime", "reviewTime",
    )


_RAW = """
select "reviewerID", asin, "reviewerName", md5("reviewText") as text_md5, md5(summary) as summary_md5, overall,
  "unixReviewTime", "reviewTime" from raw_reviews"""


@catalog.add("json_lines", sql(_RAW, "raw_reviews"))
def json_lines(spark, sf_dir):
    path = _folder(spark)
    writers.write(tv.raw_reviews(spark, sf_dir), path, "json")
    return _narrow(readers.read_reviews(spark, path, RAW_REVIEW))


@catalog.add("json_lines_inferred", sql(_RAW, "raw_reviews"))
def json_lines_inferred(spark, sf_dir):
    path = _folder(spark)
    writers.write(tv.raw_reviews(spark, sf_dir), path, "json")
    return _narrow(readers.read_reviews(spark, path, schema=None))


@catalog.add("json_lines_gzip", sql(_RAW, "raw_reviews"))
def json_lines_gzip(spark, sf_dir):
    path = _folder(spark)
    tv.raw_reviews(spark, sf_dir).write.option("compression", "gzip").json(path)
    return _narrow(readers.read_reviews(spark, path, RAW_REVIEW))


@catalog.add("malformed_lines", """
select 'good' as kind, count(*) as lines, sum(doc_id)::bigint as ids from documents where doc_id % 7 <> 3
union all select 'bad', count(*), null from documents where doc_id % 7 = 3""")
def malformed_lines(spark, sf_dir):
    path = _folder(spark)
    docs = tv.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("unixReviewTime"), F.col("text").alias("reviewText"))
    line = F.to_json(F.struct("unixReviewTime", "reviewText"))
    broken = F.when(F.col("unixReviewTime") % 7 == 3, F.expr("substr(line, 1, length(line) - 3)")).otherwise(F.col("line"))
    docs.withColumn("line", line).select(broken.alias("value")).write.text(path)
    good, bad = readers.read_reviews_checked(spark, path, RAW_REVIEW)
    return good.agg(
        F.lit("good").alias("kind"), F.count(F.lit(1)).alias("lines"), F.sum("unixReviewTime").alias("ids")
    ).unionByName(bad.agg(F.lit("bad").alias("kind"), F.count(F.lit(1)).alias("lines"), F.lit(None).cast("long").alias("ids")))


@catalog.add("csv_tables", sql("""
select "reviewerID", asin, overall, helpful_votes, total_votes, cast(review_timestamp as timestamp) as review_timestamp,
  category, doc_id from reviews""", "reviews"))
def csv_tables(spark, sf_dir):
    path, df = _folder(spark), tv.reviews(spark, sf_dir)
    df = df.withColumn("review_timestamp", F.col("review_timestamp").cast("timestamp_ntz"))
    writers.write(df, path, "csv")
    return readers.read_features(spark, path, df.schema)


@catalog.add("partitioned_overwrite", sql("""
select category, year(review_timestamp) as review_year, count(*) as rows,
  sum(case when category = 'clothing' then overall + 10 else overall end) as total from reviews group by 1, 2""", "reviews"))
def partitioned_overwrite(spark, sf_dir):
    path = _folder(spark)
    df = tv.reviews(spark, sf_dir).withColumn("review_year", F.year("review_timestamp"))
    writers.write(df, path, partition_by=["category", "review_year"])
    # The second write holds one category only; the other one must stay.
    again = df.filter("category = 'clothing'").withColumn("overall", F.col("overall") + 10)
    writers.write(again, path, partition_by=["category", "review_year"])
    back = spark.read.parquet(path)
    return back.groupBy("category", "review_year").agg(F.count(F.lit(1)).alias("rows"), F.sum("overall").alias("total"))


@catalog.add("versioned_table", sql("""
select 'first' as state, 1::bigint as version, count(*) as rows, null::double as bonus from reviews where overall >= 4
union all select 'merged', 2, count(*), sum(overall * 2) from reviews
union all select 'compacted', 3, count(*), sum(overall * 2) from reviews""", "reviews"))
def versioned_table(spark, sf_dir):
    path, df = _folder(spark), tv.reviews(spark, sf_dir)
    writers.write_table(df.filter("overall >= 4"), path, ["category"])
    writers.write_table(df.withColumn("bonus", F.col("overall") * 2), path, ["category"])

    def state(name: str, version: int) -> DataFrame:
        rows = writers.read_table(spark, path, version)
        bonus = F.sum("bonus") if "bonus" in rows.columns else F.lit(None).cast("double")
        return rows.agg(
            F.lit(name).alias("state"), F.lit(version).cast("long").alias("version"), F.count(F.lit(1)).alias("rows"),
            bonus.alias("bonus"),
        )

    seen = spark.createDataFrame(
        state("first", 1).unionByName(state("merged", 2)).collect(), "state string, version long, rows long, bonus double"
    )
    newest = writers.compact_table(spark, path, ["category"])
    writers.vacuum_table(spark, path)
    return seen.unionByName(state("compacted", newest))


@catalog.add("first_rows", sql("""
select * from reviews order by review_timestamp, "reviewerID", asin, doc_id, overall, helpful_votes, total_votes limit 1000""", "reviews"))
def first_rows(spark, sf_dir):
    order = ("review_timestamp", "reviewerID", "asin", "doc_id", "overall", "helpful_votes", "total_votes")
    return readers.limit_rows(tv.reviews(spark, sf_dir), 1000, order)


@catalog.add("sampled_rows", sql("""
select 'exact' as kind, least(count(*), 1000) as rows, true as inside from reviews
union all select 'bernoulli', null, true""", "reviews"))
def sampled_rows(spark, sf_dir):
    df = tv.reviews(spark, sf_dir)
    exact = readers.sample_exact(df, 1000, ["doc_id", "reviewerID", "asin", "review_timestamp"])
    about = readers.sample_fraction(df, 3000)
    n = F.count(F.lit(1))
    # Three thousand expected rows deviate by less than six standard deviations.
    return exact.agg(F.lit("exact").alias("kind"), n.alias("rows"), (n <= 1000).alias("inside")).unionByName(
        about.agg(F.lit("bernoulli").alias("kind"), F.lit(None).cast("long").alias("rows"), n.between(2670, 3330).alias("inside"))
    )


@catalog.add("report_sink", sql("""
select category as dataset, count(*) as records, round(avg(overall), 6) as avg_rating from reviews group by 1""", "reviews"))
def report_sink(spark, sf_dir):
    path = _folder(spark)
    report = tv.reviews(spark, sf_dir).groupBy(F.col("category").alias("dataset")).agg(
        F.count(F.lit(1)).alias("records"), r6(F.avg("overall")).alias("avg_rating")
    )
    writers.write_report(report, path)
    return spark.read.schema(report.schema).json(path)


_JOB = """
, clean as (
  select *, year(timestamp '1970-01-01' + to_seconds("unixReviewTime")) as review_year, helpful[1] as hv, helpful[2] as tv from (
    select *, row_number() over (partition by "reviewerID", asin, "unixReviewTime"
      order by overall, "reviewerName", helpful, "reviewText", summary, "reviewTime") as rn
    from checked where failed is null) where rn = 1)
select review_year, count(*) as records, count(distinct "reviewerID") as unique_users, count(distinct asin) as unique_products,
  round(avg(overall), 6) as avg_rating, round(avg(case when tv > 0 then hv / tv else 0e0 end), 6) as avg_helpful,
  sum(len(list_filter(string_split("reviewText", ' '), lambda x: x <> '')))::bigint as words,
  bool_and("reviewerID" is not null and asin is not null and overall between 1 and 5) as keys_complete
from clean group by 1"""


@catalog.add("etl_job", sql(_JOB, "checked"))
def etl_job(spark, sf_dir):
    """JSON lines in; cleaned, enriched, written by year; the report is taken from what was written."""
    source, target = _folder(spark), _folder(spark)
    writers.write(tv.raw_reviews(spark, sf_dir), source, "json")
    good, _ = readers.read_reviews_checked(spark, source, RAW_REVIEW)
    clean = cleaning.clean_reviews(good)
    ready = enrich.add_text(clean).withColumn("review_timestamp", F.col("review_date"))
    rich = enrich.enrich(ready, as_of="2002-01-01", ties=("asin", "overall", "helpful_votes", "total_votes"))
    writers.write(rich, target, partition_by=["review_year"])
    stored = spark.read.parquet(target)
    return stored.groupBy("review_year").agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("reviewerID").alias("unique_users"),
        F.countDistinct("asin").alias("unique_products"),
        r6(F.avg("overall")).alias("avg_rating"),
        r6(F.avg("helpfulness_ratio")).alias("avg_helpful"),
        F.sum("review_word_count").alias("words"),
        F.bool_and(
            F.col("reviewerID").isNotNull() & F.col("asin").isNotNull() & F.col("overall").between(1, 5)
        ).alias("keys_complete"),
    )
