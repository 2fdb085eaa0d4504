"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mktpanel.llm import (
    kmeans,
    kmeans_sql,
    language_id,
    licenses,
    line_dedup,
    merkle,
    mixing,
    packing,
    quality_rules,
    simhash_dedup,
    token_files,
    topk,
    url_rules,
    warc_derive,
)
from mktpanel.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return deco


@register("op1_quality_rules")
def op1(spark: SparkSession, d: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"])
    return judged.select("doc_id", *quality_rules.BASE, "base_failed", "rule", "kept")


@register("op2_exact_top_k", """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e
  from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
s as (
  select q.vec_id as query_id, q.e as e, v.vec_id as vec_id, list_dot_product(q.e, v.e)::bigint as score
  from (select distinct vec_id, e from v where vec_id % 20 = 0) q join v on v.vec_id <> q.vec_id),
r as (
  select query_id, row_number() over (partition by query_id, e order by score desc, vec_id)::int as rank, vec_id, score
  from s)
select query_id, rank, vec_id, score from r where rank <= 20
""")
def op2(spark: SparkSession, d: str) -> DataFrame:
    return topk.top_k(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


@register("op3_language_id")
def op3(spark: SparkSession, d: str) -> DataFrame:
    return language_id.identify(table(spark, d, "documents"))


@register("op4_fuzzy_line_dedup")
def op4(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", F.size(F.split("text", "\n")).alias("n_lines"))
    return line_dedup.dedup_lines(docs).select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("__dropped").cast("long").alias("n_dropped"),
        F.length("text").cast("long").alias("n_chars"), F.crc32(F.col("text")).alias("text_crc32"))


@register("op5_license_scan")
def op5(spark: SparkSession, d: str) -> DataFrame:
    # The table has no paths: source, language and number give a tree of unequal depth; every fifth file has a licence file's name.
    doc = F.col("doc_id")
    path = F.concat_ws("/", "source", F.when(doc % 3 > 0, F.col("lang")),
                       F.when(doc % 3 > 1, F.floor(doc / 50).cast("string")), F.concat(F.when(doc % 5 == 0, "LICENSE.").otherwise(""), doc.cast("string"), F.lit(".txt")))
    files = table(spark, d, "documents").select(doc.alias("id"), path.alias("path"), "text")
    return licenses.scan_licences(files).withColumnRenamed("id", "doc_id")


@register("op6_mix_sources", r"""
with t as (
  select doc_id, source, coalesce(text, '') as text,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
w as (
  select *, case when signs = 0 and size >= 50 then 2.0::double when signs * 20 > length(text) then 0.5::double
                 else 1.0::double end as weight
  from (select *, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as signs from t)),
drawn as (
  select doc_id, source, size,
         -ln((('0x' || substr(md5('mix-1-' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint::double + 1.0)
             / 4503599627370496.0) / weight as key
  from w),
src as (select source, sum(size)::bigint as source_size from drawn group by source),
named as (
  select *, [3, 1, 2][((row_number() over (order by source is null, source) - 1) % 3 + 1)::int]::bigint as w,
         2 * source_size as cap
  from src),
ordered as (
  select *, row_number() over o as k, (sum(cap) over (o rows unbounded preceding) - cap)::bigint as capped_before,
         (sum(w) over (o rows between current row and unbounded following))::bigint as w_left,
         (3 * sum(source_size) over ())::bigint as total3
  from named window o as (order by cap * (6 // w), source is null, source)),
opened as (
  select *, total3 - 2 * capped_before as left2,
         min(case when cap * 2 * w_left > (total3 - 2 * capped_before) * w then k end) over () as first_open
  from ordered),
target as (
  select source, source_size,
         case when first_open is null or k < first_open then cap::double
              else max(case when k = first_open then left2 / 2.0::double / w_left end) over () * w end as target
  from opened),
budget as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs from target),
placed as (
  select d.doc_id, d.size, b.source_size, b.target, b.epochs, b.target - b.epochs * b.source_size as rest,
         sum(d.size) over (partition by d.source order by d.key, d.doc_id, d.size rows unbounded preceding) as upto
  from drawn d join budget b on d.source is not distinct from b.source)
select doc_id, size, source_size, target,
       (size * (epochs + case when rest > 0 and upto - size / 2.0::double <= rest then 1 else 0 end))::bigint as taken
from placed
""")
def op6(spark: SparkSession, d: str) -> DataFrame:
    return mixing.taken(table(spark, d, "documents"))


@register("op7_pack_sequences")
def op7(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"))


@register("op8_token_files")
def op8(spark: SparkSession, d: str) -> DataFrame:
    return token_files.write_and_read(table(spark, d, "documents"))


@register("op9_warc_derivatives")
def op9(spark: SparkSession, d: str) -> DataFrame:
    records = warc_derive.derive(warc_derive.responses(table(spark, d, "pages")))
    return records.select("page_id", "record_type", "record_id", "refers_to", "target_uri", "block_digest",
                          "content_length", F.crc32("record").alias("record_crc32"))


@register("op10_simhash_near_dedup")
def op10(spark: SparkSession, d: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, d, "documents"))


@register("op13_shallot_kmeans", kmeans_sql.sql())
def op13(spark: SparkSession, d: str) -> DataFrame:
    return kmeans.cluster(table(spark, d, "embeddings"))


@register("op11_url_rules", r"""
with recursive rests as (
  select page_id, url, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low,
         case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end as rest
  from pages),
parsed as (
  select *, translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low_path
  from (select *, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz'), '') as host,
               coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from rests)),
judged as (
  select *,
         case when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
              when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
              when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
              when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
              when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/' end as rule,
         case when url is null then [] else list_distinct(list_filter(
           ['scheme:' || regexp_extract(low, '(?s)^(.*?)://', 1), 'host:' || host,
            'ending:' || regexp_extract(low_path, '(\.[^./]*)\z', 1),
            case when contains(low, '#') then 'fragment' else 'no fragment' end]
           || list_transform(list_reverse(string_split(host, '.')), lambda x, i: case when x <> '' then 'label' || (i - 1) || ':' || x end)
           || list_transform(string_split(regexp_extract(low_path, '(?s)^(.*)/[^/]*\z', 1), '/'),
                             lambda x: case when x <> '' then 'folder:' || x end)
           || list_transform(string_split(regexp_extract(low, '^[^?#]*\?([^#]*)', 1), '&'),
                             lambda x: case when regexp_extract(x, '^[^=]*') <> '' then 'key:' || regexp_extract(x, '^[^=]*') end),
           lambda x: x is not null)) end as tokens
  from parsed),
bad as (
  select doc_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad
  from labels where quality is not null or toxic is not null group by doc_id),
learn as (
  select row_number() over () as pid, * from (
    select distinct page_id, url, tokens, bad from judged join bad on doc_id = page_id where url is not null)),
least as (select greatest(10, ceil(count(*) * 0.001::double)) as least from learn),
common as (
  select token from (select bad, unnest(tokens) as token from learn)
  group by token having sum(bad) >= (select least from least)),
held as (
  select pid, bad, list(token order by token) as held
  from (select pid, bad, unnest(tokens) as token from learn) join common using (token) group by pid, bad),
sets as (
  select pid, bad, []::varchar[] as s, 0::bigint as upto, held from held
  union all
  select pid, bad, list_append(s, held[j]), j, held
  from (select *, unnest(range(upto + 1, len(held) + 1)) as j from sets)),
rules as (
  select s from sets where len(s) > 0 group by s
  having sum(bad) >= (select least from least) and sum(bad)::double / count(*) >= 0.6)
select page_id, host, path, rule,
       case when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block'
            when exists (select 1 from rules where list_has_all(tokens, s)) then 'block' else 'allow' end as verdict
from judged
""")
def op11(spark: SparkSession, d: str) -> DataFrame:
    return url_rules.judge(table(spark, d, "pages"), table(spark, d, "labels"))


@register("op12_merkle_manifest", r"""
with recursive fields as (
  select row_number() over () as rid, doc_id, source, lang, n_chars, text,
         -- CRC-32 bit by bit: each byte is one step of its value and eight of -1.
         xor(4294967295, list_reduce(list_concat([4294967295::bigint], flatten(list_transform(
           string_split(doc_id::varchar, ''), lambda c: [ord(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, s: case when s >= 0 then xor(a, s) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) as crc
  from documents),
texts as (
  select *, case when crc % 2 = 0 then replace(text, chr(10), '') else text end as now_text from fields),
hashed as (
  select rid, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
         sha256(head || coalesce(strlen(now_text) || ':' || now_text, '-')) as now
  from (select *, coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                  || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head
        from texts)),
leaves as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf, rid) - 1 as rank,
         count(*) over (partition by source) as n, coalesce('1' || source, '0') as tree
  from hashed),
nodes as (
  select tree, 0 as level, rank as idx, leaf as h, n as m from leaves
  union all
  select tree, level + 1, idx // 3, sha256(string_agg(h, '' order by idx)), max((m + 2) // 3)
  from nodes where m > 1 group by tree, level, idx // 3),
subroots as (
  select tree, h, row_number() over (order by encode(tree)) - 1 as rank, count(*) over () as n from nodes where m = 1),
tops as (
  select 0 as level, rank as idx, h, n as m from subroots
  union all
  select level + 1, idx // 3, sha256(string_agg(h, '' order by idx)), max((m + 2) // 3)
  from tops where m > 1 group by level, idx // 3),
-- The path of each leaf: the other nodes of its run, level by level, by source first and then over the subroots.
inner_steps as (
  select l.rid, n.level, coalesce(string_agg(k.h, '' order by k.idx) filter (k.idx < l.rank // (3 ** n.level)::bigint), '') as lft,
         coalesce(string_agg(k.h, '' order by k.idx) filter (k.idx > l.rank // (3 ** n.level)::bigint), '') as rgt
  from leaves l join nodes n on n.tree = l.tree and n.idx = l.rank // (3 ** n.level)::bigint and n.m > 1
  join nodes k on k.tree = n.tree and k.level = n.level and k.idx // 3 = n.idx // 3
  group by l.rid, n.level),
upper_steps as (
  select s.tree, n.level, coalesce(string_agg(k.h, '' order by k.idx) filter (k.idx < s.rank // (3 ** n.level)::bigint), '') as lft,
         coalesce(string_agg(k.h, '' order by k.idx) filter (k.idx > s.rank // (3 ** n.level)::bigint), '') as rgt
  from subroots s join tops n on n.idx = s.rank // (3 ** n.level)::bigint and n.m > 1
  join tops k on k.level = n.level and k.idx // 3 = n.idx // 3
  group by s.tree, n.level),
paths as (
  select rid, list({'l': lft, 'r': rgt} order by part, level) as path from (
    select rid, 0 as part, level, lft, rgt from inner_steps
    union all select l.rid, 1, u.level, u.lft, u.rgt from leaves l join upper_steps u using (tree))
  group by rid),
folded as (
  select rid, 0 as step, now as h from leaves
  union all
  select f.rid, f.step + 1, sha256(p.path[f.step + 1].l || f.h || p.path[f.step + 1].r)
  from folded f join paths p using (rid) where f.step < len(p.path))
select l.doc_id, l.leaf, s.h as subroot, r.h as root,
       sha256(coalesce(array_to_string(list_transform(p.path, lambda x: x.l || x.r), ''), '')) as proof_sha256,
       f.h as folded_root, f.h = r.h as verified
from leaves l join subroots s using (tree) join (select h from tops where m = 1) r on true left join paths p using (rid)
join folded f on f.rid = l.rid and f.step = coalesce(len(p.path), 0)
""")
def op12(spark: SparkSession, d: str) -> DataFrame:
    return merkle.manifest(table(spark, d, "documents"), merkle.without_line_breaks())
