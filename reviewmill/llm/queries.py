"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import (
    chat, langid, maxscore, packing, periods, quality, simhash, strata, suffixes, tiles, toxicity, windows, winnowing,
)
from reviewmill.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", (fold(scored["doc_id"], toxicity.FOLDS) == toxicity.HELD).alias("held_out"), "score", "predicted"
    )


def op2_marginal_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs))
    held = fold(found["doc_id"], langid.FOLDS) == langid.HELD
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op3_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal(table(spark, sf_dir, "documents"))


def op4_chat_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    said = "</s>[INST] ok [/INST]"
    control = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select(*columns).unionByName(control)
    return chat.digest(chat.format_conversations(turns))


def op5_count_min_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.removal(table(spark, sf_dir, "documents"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


def op7_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    held = fold(found["doc_id"], quality.FOLDS) == quality.HELD
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")


def op8_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"))


def op9_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_simhash_popcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(found["fp"]).alias("fingerprint"), "component_id")


def looped(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth text, by the hash of its id, is made periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"))
    cut = docs.select("doc_id", "text", words.alias("words"), (h / 10).cast("long").alias("g"))
    cut = cut.withColumn("n", F.size("words").cast("long"))
    cut = cut.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    cut = cut.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    loop = F.expr("transform(words, (w, i) -> if(i < a, w, words[cast(a + (i - a) % p as int)]))")
    return cut.select("doc_id", F.when(F.col("n") > 0, F.array_join(loop, " ")).otherwise(F.col("text")).alias("text"))


def op11_difference_cover_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.find_runs(looped(table(spark, sf_dir, "documents")))
    longest = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    lines = F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    found = found.withColumn("longest", longest)
    length, period = F.col("longest.length"), -F.col("longest.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
        length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_length_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strata.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_banded_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def queries() -> dict[str, Query]:
    return {
        "op1_weak_toxicity": op1_weak_toxicity,
        "op2_marginal_unigrams": op2_marginal_unigrams,
        "op3_sparse_suffixes": op3_sparse_suffixes,
        "op4_chat_offsets": op4_chat_offsets,
        "op5_count_min_windows": op5_count_min_windows,
        "op6_winnowing": op6_winnowing,
        "op7_additive_quality": op7_additive_quality,
        "op8_maxscore": op8_maxscore,
        "op9_vector_best_fit": op9_vector_best_fit,
        "op10_simhash_popcount": op10_simhash_popcount,
        "op11_difference_cover_runs": op11_difference_cover_runs,
        "op12_length_strata": op12_length_strata,
        "op13_banded_tiles": op13_banded_tiles,
    }


ORACLES = {
    "op4_chat_offsets": r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized as (
  select *, 20 + length(both_) + (length(both_) - length(replace(both_, '\', '')))
    + (length(both_) - length(replace(both_, '<s>', ''))) / 3 + (length(both_) - length(replace(both_, '</s>', ''))) / 4
    + (length(both_) - length(replace(both_, '[INST]', ''))) / 6
    + (length(both_) - length(replace(both_, '[/INST]', ''))) / 7 as size
  from (select *, role || chr(10) || text as both_ from turns)
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(size) - count(*) as bigint) as formatted_chars
from sized group by conv_id
""",
    "op8_maxscore": r"""
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
  from vectors q join vectors c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 20
""",
    "op12_length_strata": r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), docs as (
  select doc_id, w, len(w) as n from words where len(w) > 0
), total as (
  select count(*) as big_n, cast(sum(n) as bigint) as big_l from docs
), asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as term from benchmark
), counts as (
  select doc_id, n, term, count(*) as tf from (select doc_id, n, unnest(w) as term from docs)
  where term in (select term from asked) group by doc_id, n, term
), weights as (
  select term, cast(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) as bigint) as w
  from (select term, count(*) as df from counts group by term), total
), parts as (
  select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))) as part
  from counts join weights using (term), total
), scores as (
  select item_id, doc_id, cast(sum(part) as bigint) as score from parts join asked using (term)
  group by item_id, doc_id having sum(part) > 0
), ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores
)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 10
""",
    "op13_banded_tiles": r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), shingles as (
  select distinct doc_id, array_to_string(w[pos:pos + 4], ' ') as body
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as pos from words where len(w) > 0)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select body from shingles group by body having count(*) > 1
), repeated as (
  select doc_id, body from shingles semi join shared using (body)
), pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as both_
  from repeated a join repeated b on a.body = b.body and a.doc_id < b.doc_id group by a.doc_id, b.doc_id
), links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * both_ >= 80 * (x.n + y.n - both_)
), ways as (
  select a, b from links union all select b, a from links
), reach as (
  select a, b from ways union select r.a, w.b from reach r join ways w on r.b = w.a
), least as (
  select a, min(b) as b from reach group by a
)
select w.doc_id, coalesce(s.n, 0) as n_shingles, least(w.doc_id, coalesce(l.b, w.doc_id)) as component_id
from words w left join sizes s on w.doc_id = s.doc_id left join least l on w.doc_id = l.a
""",
    "op5_count_min_windows": r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), places as (
  select doc_id, w, unnest(range(1, len(w) - 18)) as pos from words where len(w) >= 20
), windows as (
  select doc_id, pos, array_to_string(w[pos:pos + 19], ' ') as body from places
), ranked as (
  select doc_id, pos, row_number() over (partition by body order by doc_id, pos) as nth from windows
), gone as (
  select distinct doc_id, unnest(range(pos, pos + 20)) as pos from ranked where nth > 1
), each_word as (
  select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos from words
), kept as (
  select e.doc_id, string_agg(e.word, ' ' order by e.pos) as body, count(*) as n
  from each_word e anti join gone g on e.doc_id = g.doc_id and e.pos = g.pos group by e.doc_id
)
select w.doc_id, cast(len(w.w) as bigint) as n_words, cast(len(w.w) - coalesce(k.n, 0) as bigint) as n_removed,
  sha256(coalesce(k.body, '')) as kept_sha256
from words w left join kept k on w.doc_id = k.doc_id
""",
    "op6_winnowing": r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), item_windows as (
  select distinct item_id, size, array_to_string(w[pos:pos + size - 1], ' ') as body from (
    select item_id, w, least(10, len(w)) as size, unnest(range(1, len(w) - least(10, len(w)) + 2)) as pos
    from items where len(w) > 0)
), sizes as (
  select distinct size from item_windows
), places as (
  select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as pos from words, sizes where len(w) >= size
), hits as (
  select p.doc_id, p.pos, p.size, i.item_id
  from places p join item_windows i on i.size = p.size and i.body = array_to_string(p.w[p.pos:p.pos + p.size - 1], ' ')
), hit_words as (
  select doc_id, count(distinct pos) as n from (select doc_id, unnest(range(pos, pos + size)) as pos from hits)
  group by doc_id
), hit_items as (
  select doc_id, count(*) as n, string_agg(item, ',' order by item) as body
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id
)
select w.doc_id, cast(len(w.w) as bigint) as n_words, coalesce(h.n, 0) as n_hit, coalesce(i.n, 0) as n_items,
  sha256(coalesce(i.body, '')) as items_sha256, coalesce(h.n, 0) > 0 as contaminated
from words w left join hit_words h on w.doc_id = h.doc_id left join hit_items i on w.doc_id = i.doc_id
""",
}


def oracles() -> dict[str, str]:
    return dict(ORACLES)
