"""Registered queries of the operators, and the SQL for those that DuckDB can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramlag.llm import (
    bm25_wand,
    filter_lattice,
    fim_sparse,
    html_layout,
    improbable_digest,
    licence_lr,
    mixing_wfq,
    nn_descent,
    packing_online,
    quality_ordinal,
    simhash_vp,
    substring_cm,
    toxicity_ac,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return html_layout.extract(pages).select("page_id", "url", F.col("_text").alias("text"))


def op2_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_vp.simhash_groups(_table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return groups.select("doc_id", simhash_vp.hex_digits("fp").alias("fingerprint"), "component_id")


def op3_embedding_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(_table(spark, sf_dir, "embeddings"))


#: The tokenizer's files, on every node: the vocabulary, and the same as ranks.
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def packed(docs: DataFrame) -> DataFrame:
    import public_tokenizers as public

    return packing_online.pack(docs, public.path(TOKENIZER), public.path(RANKS), public.PATTERN)


def op4_pack_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    crc = F.crc32("ids").alias("ids_crc32")
    return packed(_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset"
    )


def op6_licence_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_lr.classify(_table(spark, sf_dir, "documents"))


def op7_substring_count_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_cm.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_removed").alias("n_removed"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


OP7_SQL = r"""
with split as (
  select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as ws from documents
),
windows as (
  select doc_id, pos, array_to_string(ws[pos:pos + 12], ' ') as run
  from (select doc_id, ws, unnest(range(1, len(ws) - 11)) as pos from split)
),
firsts as (select run, min(doc_id) as first_doc from windows group by run),
gone as (
  select distinct doc_id, unnest(range(pos, pos + 13)) as pos
  from windows join firsts using (run) where doc_id > first_doc
),
words as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as pos from split),
kept as (
  select w.doc_id, count(*) as n, string_agg(word, ' ' order by w.pos) as text
  from words w anti join gone g on g.doc_id = w.doc_id and g.pos = w.pos group by w.doc_id
)
select s.doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(k.n, 0) as bigint) as n_removed,
       sha256(coalesce(k.text, '')) as kept_sha256
from split s left join kept k on k.doc_id = s.doc_id
"""


def op8_mix_fair_queueing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing_wfq.queues(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        F.col("_taken").alias("taken"),
    )


def op5_bm25_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = _table(spark, sf_dir, "benchmark").where("item_id % 20 = 0")
    found = bm25_wand.search(_table(spark, sf_dir, "documents"), queries, k=10)
    return found.select("item_id", "rank", "doc_id", F.round("score", 6).alias("score"))


OP5_SQL = r"""
with words as (
  select doc_id, unnest(regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents
),
lengths as (select doc_id, count(*) as dl from words group by doc_id),
totals as (select (select count(*) from documents) as n, (select sum(dl) from lengths) as total),
asked as (
  select item_id, term, count(*) as qtf from (
    select item_id, unnest(regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark where item_id % 20 = 0
  ) group by item_id, term
),
postings as (
  select term, doc_id, count(*)::double as tf from words
  where term in (select term from asked) group by term, doc_id
),
df as (select term, count(*) as df from postings group by term),
scored as (
  select a.item_id, p.doc_id,
         sum(a.qtf * ln(1 + (t.n - d.df + 0.5) / (d.df + 0.5)) * p.tf * 2.2
             / (p.tf + 1.2 * (0.25 + 0.75 * l.dl / (t.total / t.n::double)))) as score
  from asked a join postings p using (term) join df d using (term) join lengths l using (doc_id) cross join totals t
  group by a.item_id, p.doc_id
),
ranked as (
  select item_id, cast(row_number() over (partition by item_id order by round(score, 9) desc, doc_id) as int) as rank, doc_id, score
  from scored
)
select item_id, rank, doc_id, round(score, 6) as score from ranked where rank <= 10
"""

HELD_OUT = "crc32(cast(doc_id as string)) % 4 = 2"


def op9_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(f"not ({HELD_OUT})")
    scored = toxicity_ac.score(docs, toxicity_ac.train(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"),
        F.when(F.col("_score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


#: Tail probability of the highest grade from which a document is selected.
SELECTED = 0.5


def op10_quality_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    graded = quality_ordinal.grade(docs, quality_ordinal.train(docs, _table(spark, sf_dir, "labels")))
    return graded.select(
        "doc_id",
        F.col("_expected").alias("expected_grade"),
        F.col("_tail").alias("tail_probability"),
        (F.col("_tail") >= SELECTED).alias("selected"),
    )


OP8_SQL = r"""
with docs as (
  select doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
         md5('mix' || coalesce(cast(doc_id as varchar), '')) as place
  from documents
),
queue as (
  select *, coalesce(sum(size) over (partition by source order by place, size
                                     rows between unbounded preceding and 1 preceding), 0) as ahead
  from docs
),
sums as (select source, cast(sum(size) as bigint) as source_size from docs group by source),
weighted as (
  select *, [1.0, 2.0, 3.0][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)]::double as w,
         source_size * 3.0::double as most
  from sums
),
filled as (
  select *, sum(most) over upto as filled, sum(w) over upto as weighed,
         sum(source_size) over () as total, sum(w) over () as all_w
  from weighted
  window upto as (order by most / w, w, source rows between unbounded preceding and current row)
),
levels as (select *, (total - filled + most) / (all_w - weighed + w) as level from filled),
ends as (select *, max(case when most > level * w then level end) over () as ends from levels),
goals as (
  select source, source_size, case when ends is null then most else least(most, ends * w) end as target from ends
)
select q.doc_id, cast(q.size as bigint) as size, g.source_size, g.target,
       cast(case when g.source_size = 0 then 0
            else cast(floor(g.target) as bigint) // g.source_size * q.size
               + greatest(0, least(q.size, cast(floor(g.target) as bigint) % g.source_size - q.ahead)) end as bigint) as taken
from queue q join goals g on q.source is not distinct from g.source
"""


def op11_fim_sparse_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = F.col("fim")
    return fim_sparse.transform(docs).select(
        "doc_id",
        cut["n"].alias("n"),
        cut["form"].alias("form"),
        cut["prefix_chars"].alias("prefix_chars"),
        cut["middle_chars"].alias("middle_chars"),
        F.sha2(cut["output"], 256).alias("output_sha256"),
        F.sha2(fim_sparse.restored(cut["output"], cut["form"]), 256).alias("restored_sha256"),
    )


OP11_SQL = """
with docs as (
  select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n,
         sha256('1:' || coalesce(cast(doc_id as varchar), '')) as s
  from documents
),
drawn as (
  select *, cast('0x' || substr(s, 1, 8) as ubigint) % (n + 1) as a, cast('0x' || substr(s, 9, 8) as ubigint) % (n + 1) as b,
         case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
                or cast('0x' || substr(s, 17, 8) as ubigint) % 100 >= 90 then 'plain'
              when cast('0x' || substr(s, 25, 8) as ubigint) % 100 < 20 then 'spm' else 'psm' end as form
  from docs
),
cut as (
  select doc_id, t, n, form, cast(least(a, b) as bigint) as p, cast(greatest(a, b) as bigint) as e from drawn
)
select doc_id, cast(n as bigint) as n, form,
       case when form <> 'plain' then p end as prefix_chars,
       case when form <> 'plain' then e - p end as middle_chars,
       sha256(case form when 'plain' then t
         when 'psm' then '<P>' || substr(t, 1, p) || '<S>' || substr(t, e + 1) || '<M>' || substr(t, p + 1, e - p)
         else '<S>' || substr(t, e + 1) || '<P>' || substr(t, 1, p) || '<M>' || substr(t, p + 1, e - p) end) as output_sha256,
       sha256(t) as restored_sha256
from cut
"""


def op12_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_lattice.interactions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


OP12_SQL = r"""
with docs as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as ws
  from documents
),
judged as (
  select part, doc_id,
         case when len(ws) < 200 then 1 else 0 end
         + case when 100 * len(list_distinct(ws)) < 50 * len(ws) then 2 else 0 end
         + case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) then 4 else 0 end
         + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
         + case when doc_id > min(doc_id) over (partition by t) then 16 else 0 end as fails
  from docs
),
marks as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
          from labels group by doc_id),
counts as (
  select part, fails, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
  from judged left join marks using (doc_id) group by part, fails
),
letters(l, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders as (
  select a.l || b.l || c.l || d.l || e.l as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from letters a, letters b, letters c, letters d, letters e
  where a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
steps as (
  select filter_order, cast(s as int) as step, bits[s] as f, cast(coalesce(list_sum(bits[1:s - 1]), 0) as int) as before
  from orders, range(1, 6) r(s)
),
found as (
  select part, filter_order, step, f,
         sum(case when fails & (before | f) = 0 then n else 0 end) as kept,
         sum(case when fails & before = 0 and fails & f > 0 then n else 0 end) as removed,
         sum(case when fails & before > 0 and fails & f > 0 then n else 0 end) as redundant,
         sum(case when fails = f then n else 0 end) as unique_fails,
         sum(case when fails & before = 0 and fails & f > 0 then good else 0 end) as good_lost,
         sum(case when fails & before = 0 and fails & f > 0 then toxic else 0 end) as toxic_lost
  from counts, steps group by part, filter_order, step, f
)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
       cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, f) as bigint) as shapley
from found
"""


def op13_improbable_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = improbable_digest.edit_audit(docs, improbable_digest.rarity(docs))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.base64("fingerprint").alias("fingerprint"),
        F.base64("edited_fingerprint").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_layout": op1_html_layout,
        "op2_simhash_vptree": op2_simhash_vptree,
        "op3_embedding_nn_descent": op3_embedding_nn_descent,
        "op4_pack_online": op4_pack_online,
        "op5_bm25_wand": op5_bm25_wand,
        "op6_licence_classifier": op6_licence_classifier,
        "op7_substring_count_min": op7_substring_count_min,
        "op8_mix_fair_queueing": op8_mix_fair_queueing,
        "op9_toxicity_lexicon": op9_toxicity_lexicon,
        "op10_quality_ordinal": op10_quality_ordinal,
        "op11_fim_sparse_index": op11_fim_sparse_index,
        "op12_filter_interactions": op12_filter_interactions,
        "op13_improbable_digest": op13_improbable_digest,
    }


ORACLE = {
    "op5_bm25_wand": OP5_SQL,
    "op7_substring_count_min": OP7_SQL,
    "op8_mix_fair_queueing": OP8_SQL,
    "op11_fim_sparse_index": OP11_SQL,
    "op12_filter_interactions": OP12_SQL,
}
