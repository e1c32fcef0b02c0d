"""A/B experiment and stream queries."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from reviewmill.operators import experiments
from reviewmill.plans.registry import Catalog, rounded
from reviewmill.plans.views import BUCKET, sql
from reviewmill.session import shared_folder
from reviewmill.sources import testviews as tv
from reviewmill.sources import writers
from reviewmill.streaming import experiments as streams

catalog = Catalog()


@catalog.add("ab_assign", sql(f"""
select user_id, {BUCKET}::int as bucket, case when {BUCKET} < 30 then 'A' else 'B' end as "group"
from (select distinct user_id, md5(concat('user_', cast(user_id as varchar))) as h from events)"""))
def ab_assign(spark, sf_dir):
    users = tv.table(spark, sf_dir, "events").select("user_id").distinct()
    name = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    return users.select(
        "user_id", experiments.bucket(name).alias("bucket"), experiments.group_of(name, 0.3).alias("group")
    )


@catalog.add("ab_metric_log", sql("""
select 'ranker' as test_id, user_id, "group", metric, round(value, 6) as value from ab_metrics""", "ab_metrics"))
def ab_metric_log(spark, sf_dir):
    log = tv.ab_metrics(spark, sf_dir).drop("group").withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    return rounded(experiments.track(log, "ranker").drop("ts"), "value")


def _simpson(body: str, low: str, high: str, steps: int = 4000) -> str:
    """The integral of ``body``, an expression of x, as SQL."""
    step = f"(({high}) - ({low})) / {steps}e0"
    inner = re.sub(r"\bx\b", lambda _: f"(({low}) + i * {step})", body)
    return f"""({step} / 3 * list_sum(list_transform(range(0, {steps + 1}),
  lambda i: (case when i = 0 or i = {steps} then 1 when i % 2 = 1 then 4 else 2 end) * {inner})))"""


def _t_tail(t: str, nu: str) -> str:
    """Two-sided tail of Student's t: with t = sqrt(nu) tan x the density is a power of the cosine."""
    start = f"atan(abs({t}) / sqrt({nu}))"
    end = f"least(pi() / 2, {start} + 16 / sqrt({nu}))"
    return f"""(2 * {_simpson(f"pow(greatest(cos(x), 0), ({nu}) - 1)", start, end)}
  / (sqrt(pi()) * exp(lgamma(({nu}) / 2e0) - lgamma(({nu}) / 2e0 + 0.5e0))))"""


def _t_margin(nu: str) -> str:
    """The t beyond which both tails hold 0.05, by halving [0, 50]."""
    middle = "((b[1] + b[2]) / 2)"
    return f"""(list_reduce(list_prepend([0e0, 50e0], list_transform(range(45), lambda j: [0e0, 0e0])),
  lambda b, z: case when {_t_tail(middle, nu)} > 0.05 then [{middle}, b[2]] else [b[1], {middle}] end)[1])"""


_NORMAL = _simpson("exp(-(x) * (x) / 2) / sqrt(2 * pi())", "zz", "zz + 14")

_ARMS = """
, arms as (select metric, count(*) filter ("group" = 'A') as na, count(*) filter ("group" = 'B') as nb,
    avg(value) filter ("group" = 'A') as ma, avg(value) filter ("group" = 'B') as mb,
    stddev_pop(value) filter ("group" = 'A') as sa, stddev_pop(value) filter ("group" = 'B') as sb
  from ab_metrics group by 1)
"""


@catalog.add("stream_metric_log", sql(f"""
select event_id, 'ranker' as test_id, concat('user_', cast(user_id as varchar)) as user_id,
  case when {BUCKET} < 50 then 'A' else 'B' end as "group", event_type as metric, value, ts
from (select distinct *, md5(concat('user_', cast(user_id as varchar))) as h from events)"""))
def stream_metric_log(spark, sf_dir):
    """The events as a stream into a versioned table, which is then read."""
    table, state = _stream_folders(spark)
    log = streams.stream_metric_log(spark, sf_dir, table, state, "ranker", pattern="events.parquet")
    return log.withColumn("ts", F.to_utc_timestamp("ts", F.current_timezone()).cast("timestamp_ntz"))


@catalog.add("ab_t_test", sql(_ARMS + """
select metric, na as sample_size_a, round(ma, 6) as mean_a, round(sa, 6) as std_a, nb as sample_size_b,
  round(mb, 6) as mean_b, round(sb, 6) as std_b, na + nb - 2 as dof,
  round((ma - mb) / sqrt((na * sa * sa + nb * sb * sb) / (na + nb - 2) * (1 / na + 1 / nb)), 6) as t_statistic,
  round((mb - ma) / sqrt(((na - 1) * sa * sa + (nb - 1) * sb * sb) / (na + nb - 2)), 6) as cohens_d,
  round(case when ma > 0 then (mb - ma) / ma * 100 else 0 end, 6) as improvement_percent from arms""", "ab_metrics"))
def ab_t_test(spark, sf_dir):
    out = experiments.t_statistics(experiments.arms(tv.ab_metrics(spark, sf_dir)))
    return rounded(out, "mean_a", "mean_b", "std_a", "std_b", "t_statistic", "cohens_d", "improvement_percent")


_TESTED = _ARMS + f"""
, tests as (select *, na + nb - 2 as dof,
    (ma - mb) / sqrt((na * sa * sa + nb * sb * sb) / (na + nb - 2) * (1 / na + 1 / nb)) as t,
    (mb - ma) / sqrt(((na - 1) * sa * sa + (nb - 1) * sb * sb) / (na + nb - 2)) as cd,
    case when ma > 0 then (mb - ma) / ma * 100 else 0 end as up from arms)
, tp as (select *, {_t_tail("t", "dof")} as p from tests)
"""


@catalog.add("ab_t_test_full", sql(_TESTED + f"""
select metric, na as sample_size_a, round(ma, 6) as mean_a, round(sa, 6) as std_a, nb as sample_size_b,
  round(mb, 6) as mean_b, round(sb, 6) as std_b, dof, round(t, 6) as t_statistic, round(cd, 6) as cohens_d,
  round(up, 6) as improvement_percent, round(p, 6) as p_value, p < 0.05 as is_significant,
  round(ma - {_t_margin("na - 1")} * sa / sqrt(na), 6) as low_a, round(ma + {_t_margin("na - 1")} * sa / sqrt(na), 6) as high_a,
  round(mb - {_t_margin("nb - 1")} * sb / sqrt(nb), 6) as low_b, round(mb + {_t_margin("nb - 1")} * sb / sqrt(nb), 6) as high_b
from tp""", "ab_metrics"))
def ab_t_test_full(spark, sf_dir):
    out = experiments.t_test(tv.ab_metrics(spark, sf_dir))
    for tag in ("a", "b"):
        out = out.withColumns({f"low_{tag}": F.col(f"ci_{tag}")[0], f"high_{tag}": F.col(f"ci_{tag}")[1]})
    return rounded(
        out.drop("ci_a", "ci_b"), "mean_a", "mean_b", "std_a", "std_b", "t_statistic", "cohens_d", "improvement_percent",
        "p_value", "low_a", "high_a", "low_b", "high_b",
    )


@catalog.add("ab_mann_whitney", sql("""
, r as (select *, rank() over (partition by metric order by value)
    + (count(*) over (partition by metric, value) - 1) / 2e0 as rk, count(*) over (partition by metric, value) as t
  from ab_metrics)
select metric, count(*) filter ("group" = 'A') as n_a, count(*) filter ("group" = 'B') as n_b,
  round(sum(rk) filter ("group" = 'A') - (count(*) filter ("group" = 'A')) * (count(*) filter ("group" = 'A') + 1) / 2, 6)
    as u_statistic, round(sum(t * t - 1)::double, 6) as ties from r group by 1""", "ab_metrics"))
def ab_mann_whitney(spark, sf_dir):
    return rounded(experiments.rank_statistics(tv.ab_metrics(spark, sf_dir)), "u_statistic", "ties")


_RANKED = f"""
, r as (select *, rank() over (partition by metric order by value)
    + (count(*) over (partition by metric, value) - 1) / 2e0 as rk, count(*) over (partition by metric, value) as t
  from ab_metrics)
, us as (select metric, count(*) filter ("group" = 'A') as n_a, count(*) filter ("group" = 'B') as n_b,
    sum(rk) filter ("group" = 'A') - (count(*) filter ("group" = 'A')) * (count(*) filter ("group" = 'A') + 1) / 2 as u,
    sum(t * t - 1)::double as ties, avg(value) filter ("group" = 'A') as mean_a, avg(value) filter ("group" = 'B') as mean_b
  from r group by 1)
, zs as (select *, (greatest(u, n_a * n_b - u) - n_a * n_b / 2e0 - 0.5e0)
    / sqrt(n_a * n_b / 12e0 * (n_a + n_b + 1 - ties / ((n_a + n_b) * (n_a + n_b - 1e0)))) as zz from us)
, ex as (
  select metric, n_a + n_b as big, least(n_a, n_b) as n, 0::bigint as j, 0::bigint as c, 0::bigint as s, 1e0 as ways
  from us where least(n_a, n_b) between 1 and 8 and ties = 0
  union all
  select metric, big, n, j + 1, c + take, s + take * (j + 1), sum(ways) from ex, (values (0), (1)) as v(take)
  where j < big and c + take <= n group by all)
, ends as (select ex.metric, 2 * sum(ways) filter (s - n * (n + 1) / 2 >= greatest(u, n_a * n_b - u)) / sum(ways) as exact
  from ex join us on ex.metric = us.metric where j = big and c = n group by 1)
, up as (select zs.*, least(1e0, coalesce(exact, 2 * {_NORMAL})) as p from zs left join ends on zs.metric = ends.metric)
"""


@catalog.add("ab_mann_whitney_full", sql(_RANKED + """
select metric, n_a as sample_size_a, n_b as sample_size_b, round(u, 6) as u_statistic, round(ties, 6) as ties,
  round(mean_a, 6) as mean_a, round(mean_b, 6) as mean_b, round(p, 6) as p_value, p < 0.05 as is_significant,
  round(case when mean_a > 0 then (mean_b - mean_a) / mean_a * 100 else 0 end, 6) as improvement_percent
from up""", "ab_metrics"))
def ab_mann_whitney_full(spark, sf_dir):
    out = experiments.mann_whitney(tv.ab_metrics(spark, sf_dir))
    return rounded(out, "u_statistic", "ties", "mean_a", "mean_b", "p_value", "improvement_percent")


def _grouped_events(spark, sf_dir):
    events = tv.table(spark, sf_dir, "events")
    name = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    return events.withColumn("group", experiments.group_of(name))


_CONTINGENCY = f"""
, e as (select event_type, case when {BUCKET} < 50 then 'A' else 'B' end as g
  from (select *, md5(concat('user_', cast(user_id as varchar))) as h from events)),
t as (select event_type, count(*) filter (g = 'A') as a, count(*) filter (g = 'B') as b from e group by 1),
x as (select *, (a + b) * (sum(a) over ()) / (sum(a + b) over ()) as ea,
  (a + b) * (sum(b) over ()) / (sum(a + b) over ()) as eb from t)
"""


@catalog.add("ab_chi_square", sql(_CONTINGENCY + """
select round(sum(power(a - ea, 2) / ea + power(b - eb, 2) / eb), 6) as chi2_statistic,
  count(*) - 1 as degrees_of_freedom from x"""))
def ab_chi_square(spark, sf_dir):
    out = experiments.chi_square_statistic(_grouped_events(spark, sf_dir), "event_type")
    return rounded(out, "chi2_statistic")


@catalog.add("ab_contingency", sql(_CONTINGENCY + """
select event_type, a as observed_a, b as observed_b, round(ea, 6) as expected_a, round(eb, 6) as expected_b from x"""))
def ab_contingency(spark, sf_dir):
    out = experiments.contingency(_grouped_events(spark, sf_dir), "event_type")
    return rounded(out, "expected_a", "expected_b")


# For one degree of freedom the density has a pole at zero; with x = y^2 it has none.
_CHI2 = _simpson("exp(-(x) * (x) / 2) * pow((x), dof - 1)", "sqrt(s)", "sqrt(s) + sqrt(dof) + 14")


@catalog.add("ab_chi_square_full", sql(_CONTINGENCY + f"""
, st as (select sum(power(a - ea, 2) / ea + power(b - eb, 2) / eb) as s, count(*) - 1 as dof from x)
, cp as (select *, {_CHI2} * pow(2, 1 - dof / 2e0) / exp(lgamma(dof / 2e0)) as p from st)
select round(s, 6) as chi2_statistic, dof as degrees_of_freedom, round(p, 6) as p_value, p < 0.05 as is_significant from cp"""))
def ab_chi_square_full(spark, sf_dir):
    out = experiments.chi_square(_grouped_events(spark, sf_dir), "event_type")
    return rounded(out, "chi2_statistic", "p_value")


@catalog.add("ab_analyze", sql(_TESTED + _RANKED + """
, rows_ as (select tp.metric, least(na, nb) >= 5 as enough, least(na, nb) < 30 as small, na, nb, ma, mb, t, cd, tp.up, u,
    case when least(na, nb) < 30 then up.p else tp.p end as p from tp join up on tp.metric = up.metric)
, judged as (select *, enough and p < 0.05 as sig from rows_)
select 'ranker' as test_id, metric, enough as sample_size_sufficient, na as sample_size_a, nb as sample_size_b,
  5 as required_sample_size, case when enough then case when small then 'mann_whitney_u' else 't_test' end end as test_type,
  case when enough then round(case when small then u else t end, 6) end as statistic,
  case when enough then round(p, 6) end as p_value, sig as is_significant, case when enough then round(ma, 6) end as mean_a,
  case when enough then round(mb, 6) end as mean_b, case when enough and not small then round(cd, 6) end as cohens_d,
  case when enough then round(up, 6) end as improvement_percent, count(*) filter (sig) over () as significant_metrics_count,
  case when count(*) filter (sig) over () > 0 then 'significant_results'
    when count(*) filter (enough) over () > 0 then 'no_significant_results' else 'insufficient_data' end as overall_status
from judged""", "ab_metrics"))
def ab_analyze(spark, sf_dir):
    out = experiments.analyze(tv.ab_metrics(spark, sf_dir), "ranker", min_sample=5)
    return rounded(out, "statistic", "p_value", "mean_a", "mean_b", "cohens_d", "improvement_percent")


@catalog.add("ab_summary", sql("""
select 'ranker' as test_id, 0.5e0 as traffic_split, count(distinct user_id) as total_assignments,
  count(distinct user_id) filter ("group" = 'A') as group_a_count,
  count(distinct user_id) filter ("group" = 'B') as group_b_count,
  (select string_agg(metric, ',' order by metric) from (select distinct metric from ab_metrics)) as metrics_tracked
from ab_metrics""", "ab_metrics"))
def ab_summary(spark, sf_dir):
    return experiments.test_summary(tv.ab_metrics(spark, sf_dir), "ranker")


@catalog.add("ab_sample_size", sql("""
, b as (select metric, avg(value) as p from ab_metrics where "group" = 'A' and metric <> 'value' group by 1)
select metric, round(p, 6) as baseline, n as n_per_group, 2 * n as n_total from (
  select metric, p, ceil(power(1.959963984540054e0 + 0.8416212335729143e0, 2)
    * (p * (1 - p) + (p + 0.05e0) * (1 - p - 0.05e0)) / 0.0025e0)::bigint as n from b)""", "ab_metrics"))
def ab_sample_size(spark, sf_dir):
    rates = tv.ab_metrics(spark, sf_dir).filter(F.col("metric") != "value")
    return rounded(experiments.required_sample(rates, 0.05), "baseline")


@catalog.add("ab_close_test", sql("""
select 'ranker_' || "group" as test_id, case when "group" = 'A' then 'stopped' else 'active' end as status,
  case when "group" = 'A' then '2024-02-01' end as stopped_at,
  case when "group" = 'A' then 'insufficient_data' end as overall_status from ab_metrics group by "group" """, "ab_metrics"))
def ab_close_test(spark, sf_dir):
    metrics = tv.ab_metrics(spark, sf_dir)
    tests = metrics.groupBy("group").agg(F.count(F.lit(1))).select(
        F.concat(F.lit("ranker_"), F.col("group")).alias("test_id"), F.lit("active").alias("status"),
        F.lit(None).cast("string").alias("stopped_at"), F.lit(None).cast("string").alias("overall_status"),
    )
    results = experiments.analyze(metrics, "ranker_A", min_sample=1_000_000)
    return experiments.close_test(tests, results, "ranker_A", "2024-02-01")


@catalog.add("ab_close_saved_test", sql(_TESTED + _RANKED + """
select tp.metric as test_id, case when tp.metric = 'value' then 'stopped' else 'active' end as status,
  case when tp.metric = 'value' then '2024-02-01' end as stopped_at,
  case when tp.metric <> 'value' then null when least(na, nb) < 5 then 'insufficient_data'
    when case when least(na, nb) < 30 then up.p else tp.p end < 0.05 then 'significant_results'
    else 'no_significant_results' end as overall_status
from tp join up on tp.metric = up.metric""", "ab_metrics"))
def ab_close_saved_test(spark, sf_dir):
    """One test per metric in a versioned table; the test of ``value`` is closed with the verdict of its own rows."""
    metrics = tv.ab_metrics(spark, sf_dir)
    none = F.lit(None).cast("string")
    opened = metrics.select(F.col("metric").alias("test_id")).distinct().select(
        "test_id", F.lit("active").alias("status"), none.alias("stopped_at"), none.alias("overall_status")
    )
    path = f"{shared_folder(spark)}/tests/{uuid.uuid4().hex}"
    writers.write_table(opened, path)
    experiments.close_saved_test(metrics.filter("metric = 'value'"), path, "value", "2024-02-01", min_sample=5)
    return writers.read_table(spark, path)


def _stream_folders(spark) -> tuple[str, str]:
    base = f"{shared_folder(spark)}/streams/{uuid.uuid4().hex}"
    return f"{base}/out", f"{base}/state"


@catalog.add("stream_ab_metrics", sql(f"""
select epoch(date_trunc('day', ts))::bigint as window_start, event_type as metric,
  case when {BUCKET} < 50 then 'A' else 'B' end as "group", count(value) as n, round(sum(value), 4) as total,
  round(sum(value * value), 4) as total_squares
from (select *, md5(concat('user_', cast(user_id as varchar))) as h from events) group by 1, 2, 3"""))
def stream_ab_metrics(spark, sf_dir):
    out = streams.ab_metrics_to_end(spark, sf_dir, *_stream_folders(spark), pattern="events.parquet")
    return out.withColumns({c: F.round(c, 4) for c in ("total", "total_squares")})


@catalog.add("stream_value_percentiles", sql(f"""
select epoch(date_trunc('day', ts))::bigint as window_start, count(value) as n, round(avg(value), 6) as mean,
  quantile_disc(value, 0.95) as p95, quantile_disc(value, 0.99) as p99 from events group by 1"""))
def stream_value_percentiles(spark, sf_dir):
    out = streams.value_percentiles_to_end(spark, sf_dir, *_stream_folders(spark), pattern="events.parquet")
    return rounded(out, "mean")


@catalog.add("value_percentiles", sql("""
select date_trunc('day', ts)::timestamp as window_start, count(value) as n, round(avg(value), 6) as mean,
  round(quantile_cont(value, 0.95), 6) as p95, round(quantile_cont(value, 0.99), 6) as p99 from events group by 1"""))
def value_percentiles(spark, sf_dir):
    return rounded(streams.value_percentiles(tv.table(spark, sf_dir, "events")), "mean", "p95", "p99")


@catalog.add("stream_value_sketches", sql("""
select epoch(date_trunc('month', ts))::bigint as month_start, count(value) as n, round(avg(value), 6) as mean,
  true as p95_within, true as p99_within from events group by 1"""))
def stream_value_sketches(spark, sf_dir):
    """Daily sketches of the stream merged into months; the marks must keep their rank bound on all rows of the month."""
    table = streams.value_sketches_to_end(spark, sf_dir, *_stream_folders(spark), pattern="events.parquet")
    month = F.unix_seconds(F.date_trunc("month", F.timestamp_seconds("window_start")))
    merged = streams.merged_percentiles(table.withColumn("month_start", month), ["month_start"])
    rows = tv.table(spark, sf_dir, "events").select(
        F.unix_seconds(F.date_trunc("month", F.col("ts").cast("timestamp"))).alias("month_start"), "value")
    told = rows.join(merged.select("month_start", "p95", "p99"), "month_start")
    bound = streams.SKETCH_RANK_ERROR

    def within(mark: str, share: float):
        below, upto = F.avg((F.col("value") < F.col(mark)).cast("int")), F.avg((F.col("value") <= F.col(mark)).cast("int"))
        return ((below <= share + bound) & (upto >= share - bound)).alias(f"{mark}_within")

    ranks = told.filter("value is not null").groupBy("month_start").agg(within("p95", 0.95), within("p99", 0.99))
    return rounded(merged.drop("p95", "p99").join(ranks, "month_start"), "mean")
