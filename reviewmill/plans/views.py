"""DuckDB twins of the adapters, as named CTEs that queries pick from."""

from __future__ import annotations

SPACE = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def clean_text(col: str) -> str:
    stripped = f"regexp_replace({col}, '^{SPACE}+|{SPACE}+$', '', 'g')"
    ascii_only = rf"regexp_replace({stripped}, '[^\x20-\x7E]', '', 'g')"
    return f"coalesce(regexp_replace({ascii_only}, ' +', ' ', 'g'), '')"


def tokens(col: str) -> str:
    return f"list_filter(regexp_split_to_array({col}, '{SPACE}+'), lambda t: t <> '')"


GOOD = "['excellent','amazing','perfect','love','great','awesome','fantastic','wonderful']"
BAD = "['terrible','awful','hate','worst','disappointed','bad','poor','horrible']"

BUCKET = """
(((('0x'||substr(h,1,8))::BIGINT%100)*36 + (('0x'||substr(h,9,8))::BIGINT%100)*16
 + (('0x'||substr(h,17,8))::BIGINT%100)*96 + (('0x'||substr(h,25,8))::BIGINT%100))%100)
"""

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "reviews": ((), """
select concat('A', lpad(cast(o.o_custkey as varchar), 9, '0')) as "reviewerID",
       concat('B', lpad(cast(l.l_partkey as varchar), 9, '0')) as asin,
       cast(case when cast(l.l_quantity as int) % 20 = 0 then 1
                 when cast(l.l_quantity as int) % 20 = 1 then 2
                 when cast(l.l_quantity as int) % 20 in (2, 3) then 3
                 when cast(l.l_quantity as int) % 20 between 4 and 7 then 4
                 else 5 end as double) as overall,
       least(cast(round(l.l_discount * 100) as int), l.l_linenumber - 1) as helpful_votes,
       l.l_linenumber - 1 as total_votes,
       l.l_shipdate as review_timestamp,
       case when l.l_partkey % 2 = 0 then 'electronics' else 'clothing' end as category,
       cast(l.l_orderkey % (select count(*) from documents) as bigint) as doc_id
from lineitem l join orders o on l.l_orderkey = o.o_orderkey"""),
    "cleaned_docs": ((), f"select doc_id, {clean_text('text')} as t from documents"),
    "doc_words": (("cleaned_docs",), f"""
select doc_id, t, {tokens('t')} as w, {tokens('lower(t)')} as lw from cleaned_docs"""),
    "docs": (("doc_words",), f"""
select doc_id, cast(len(w) as int) as word_count, cast(length(t) as int) as char_count,
  case when len(w) > 0 then length(t) / len(w) else 0.0 end as avg_word_length,
  case when len(w) > 0 then least(1.0,
     len(list_distinct(w)) / len(w) * 0.5
     + least(list_sum(list_transform(w, lambda x: length(x))) / len(w) / 10, 1.0) * 0.3
     + least(len(w) / 100, 1.0) * 0.2) else 0.0 end as text_complexity,
  case when len(list_filter(lw, lambda x: list_contains({GOOD}, x) or list_contains({BAD}, x))) > 0
     then (len(list_filter(lw, lambda x: list_contains({GOOD}, x)))::double
           - len(list_filter(lw, lambda x: list_contains({BAD}, x))))
          / len(list_filter(lw, lambda x: list_contains({GOOD}, x) or list_contains({BAD}, x)))
     else 0.0 end as sentiment_intensity
from doc_words"""),
    "frame": (("reviews", "docs"), """
select r.*, d.word_count, d.char_count, d.avg_word_length, d.text_complexity, d.sentiment_intensity,
  case when total_votes > 0 then helpful_votes / total_votes else 0e0 end as helpfulness_ratio,
  case when overall <= 2 then -1e0 when overall = 3 then 0e0 else 1e0 end as sentiment_score,
  case when overall <= 2 then 'negative' when overall = 3 then 'neutral' else 'positive' end as rating_category
from reviews r left join docs d using (doc_id)"""),
    "user_stats": (("reviews",), """
select "reviewerID", count(*) as user_review_count, avg(overall) as user_avg_rating,
  stddev_samp(overall) as user_rating_std, min(review_timestamp) as user_first_review,
  max(review_timestamp) as user_last_review
from reviews group by 1"""),
    "product_stats": (("reviews",), """
select asin, count(*) as product_review_count, avg(overall) as product_avg_rating,
  stddev_samp(overall) as product_rating_std
from reviews group by 1"""),
    "profile": (("frame", "user_stats", "product_stats"), """
select f.*, user_review_count, product_review_count,
  case when user_review_count >= 50 then 'expert' when user_review_count >= 10 then 'intermediate'
    else 'beginner' end as user_experience,
  case when product_review_count >= 35 then 'high' when product_review_count >= 25 then 'medium'
    else 'low' end as product_popularity
from frame f join user_stats u on f."reviewerID" = u."reviewerID" join product_stats p on f.asin = p.asin"""),
    "raw_reviews": ((), """
select case when doc_id % 37 = 5 then lower(concat('a', pad)) when doc_id % 41 = 7 then null
            else concat('A', pad) end as "reviewerID",
  case when doc_id % 43 = 3 then concat('B', substr(pad, 2, 8)) else concat('B', pad) end as asin,
  case when doc_id % 29 = 2 then null when doc_id % 31 = 4 then '!'
       else concat('  Jo. ', lang, '-', source, ' é ') end as "reviewerName",
  case when doc_id % 19 = 6 then null when doc_id % 19 = 8 then [cast(doc_id % 7 as int)]
       else [cast(doc_id % 5 as int), cast(doc_id % 5 + doc_id % 3 as int)] end as helpful,
  case when doc_id % 47 = 9 then null else text end as "reviewText",
  case when doc_id % 53 = 10 then null else cast(k % 7 as double) end as overall,
  text as summary,
  case when doc_id % 59 = 11 then 100000000 else 900000000 + k * 86400 end as "unixReviewTime",
  case when doc_id % 61 = 12 then 'not a date'
       else strftime(timestamp '1970-01-01' + to_seconds(900000000 + k * 86400), '%m %d, %Y') end as "reviewTime"
from (select *, case when doc_id % 23 = 1 then doc_id - 1 else doc_id end as k,
        lpad(cast(case when doc_id % 23 = 1 then doc_id - 1 else doc_id end as varchar), 9, '0') as pad
      from documents)"""),
    "normalised": (("raw_reviews",), rf"""
select "reviewerID", asin, overall, "unixReviewTime",
  regexp_replace(regexp_replace(coalesce("reviewerName", 'Anonymous'), '[^\w\sé]', '', 'g'),
    '^{SPACE}+|{SPACE}+$', '', 'g') as "reviewerName",
  case when len(helpful) >= 2 then helpful[1:2] else [0, 0] end as helpful,
  "reviewText" is not null as had_text,
  {clean_text('"reviewText"')} as "reviewText",
  substr({clean_text('summary')}, 1, 100) as summary,
  cast(try_strptime("reviewTime", '%m %d, %Y') as date) as "reviewTime"
from raw_reviews"""),
    "checked": (("normalised",), rf"""
select *, case
  when not (length("reviewerName") > 1 and coalesce(regexp_full_match("reviewerID", '[A-Z0-9]+'), false)) then 'reviewer'
  when not coalesce(regexp_full_match(asin, '[A-Z0-9]{{10}}'), false) then 'product'
  when not coalesce(overall between 1 and 5, false) then 'rating'
  when not (had_text and length("reviewText") >= 10) then 'text'
  when len(list_distinct(string_split("reviewText", ''))) < least(length("reviewText"), 95) * 0.1e0
    or length(regexp_replace("reviewText", '[^A-Z]', '', 'g')) > length("reviewText") * 0.9e0
    or regexp_matches("reviewText", '(?i)http[s]?://\S+|www\.\S+|click here|buy\s+now|free\s+trial|money\s+back|\.com')
    then 'spam'
  when not (coalesce("unixReviewTime" between 788918400 and 1767139200, false) and "reviewTime" is not null) then 'time'
  end as failed
from normalised"""),
    "ab_users": ((), f"""
select *, case when {BUCKET} < 50 then 'A' else 'B' end as "group" from (
  select concat('user_', cast(user_id as varchar)) as user_id, md5(concat('user_', cast(user_id as varchar))) as h,
    count(*) filter (event_type = 'click') as clicks, count(*) filter (event_type = 'view') as views,
    count(*) filter (event_type = 'purchase') as buys, avg(value) as v
  from events group by 1, 2)"""),
    "ab_metrics": (("ab_users",), """
select user_id, "group", 'ctr' as metric, clicks / (views + clicks) as value from ab_users where views + clicks > 0
union all
select user_id, "group", 'conversion', buys / (views + buys) from ab_users where views + buys > 0
union all
select user_id, "group", 'value', v from ab_users where v is not null"""),
}


def sql(body: str, *needs: str) -> str:
    """``with <needed CTEs in dependency order> body``; body may open with more CTEs (", x as (...) select")."""
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in CTES[name][0]:
            visit(dep)
        if name not in order:
            order.append(name)

    for need in needs:
        visit(need)
    parts = ",\n".join(f"{n} as ({CTES[n][1]}\n)" for n in order)
    body = body.strip()
    if not parts:
        return "with recursive " + body[1:].strip() if body.startswith(",") else body
    return f"with recursive {parts}\n{body}" if not body.startswith(",") else f"with recursive {parts}{body}"
