"""One query per operator over its whole table."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.llm import bpe, exact, html, mixture, neardup, pitman_yor, shards, sketch, toxicity, urls, variants, vectors, whitening
from tablewarden.llm.registry import query, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

MIX_SQL = r"""with d as (
  select doc_id, source, case when source is null then '1' else '0' || source end s,
   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint size,
   md5('mix:' || coalesce(doc_id::varchar, 'null')) h from documents),
src as (select s, sum(size)::bigint source_size, [3,1,2][((row_number() over (order by s)) - 1) % 3 + 1]::bigint w from d group by s),
tot as (select sum(source_size)::hugeint total from src),
ord as (select *, 2*source_size cap, row_number() over (order by 2*source_size*6//w, s) k from src),
run as (select *, coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0)::hugeint c,
   (sum(w) over (order by k rows between current row and unbounded following))::hugeint wl from ord),
lvl as (select c, wl, total from run, tot where (150*total - 100*c)*w < 100*cap::hugeint*wl order by k limit 1),
tgt as (select src.*, case when exists(select 1 from lvl) and
   (select (150*total - 100*c)*src.w < 200*source_size::hugeint*wl from lvl)
   then (select (150*total - 100*c)::double / 100.0::double / wl::double from lvl) * src.w else (2*source_size)::double end target from src),
plan as (select *, case when source_size > 0 then floor(target/source_size) else 0 end whole from tgt),
j as (select d.*, source_size, target, whole, target - whole*source_size need,
   coalesce(sum(size) over (partition by d.s order by h, size rows between unbounded preceding and 1 preceding), 0) before
  from d join plan on plan.s = d.s)
select doc_id, source, size, source_size, target, (whole + (2*(need - before) >= size and size > 0)::int)::bigint repeats,
 (size*(whole + (2*(need - before) >= size and size > 0)::int))::bigint taken from j"""


@query("op1_mix_sources", MIX_SQL)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents"))


@query("op2_main_text")
def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query("op3_near_documents")
def op3_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "documents")).drop("node", "class_node")


@query("op4_fingerprints")
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.edit_likeness(table(spark, sf_dir, "documents"))


@query("op5_url_filter")
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("blocked", 6).alias("blocked"))


@query("op6_near_vectors")
def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op7_pitman_yor")
def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"))


@functools.cache
def vocabulary() -> bpe.Vocabulary:
    return bpe.Vocabulary(bpe.read_ranks(RANKS))


@query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents, model).drop("passages")


@query("op10_shards")
def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.interleave(table(spark, sf_dir, "documents"))


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


EXACT_SQL = """select doc_id, max(doc_id) over w keep_id, count(*) over w group_size,
 row_number() over (partition by coalesce(text, '') order by doc_id desc nulls last) = 1 kept,
 strlen(coalesce(text, ''))::bigint n_bytes, sha256(coalesce(text, '')) text_sha256
 from documents window w as (partition by coalesce(text, ''))"""


@query("op12_exact_duplicates", EXACT_SQL)
def op12_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"), every_digest=True)


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
