"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, language, lm, near_dedup, packing, prefix_trie, quality, secrets, topk, toxicity, url_rules, vector_codes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_rules.site_rules(spark).unionByName(url_rules.pattern_rules(spark))
    return url_rules.url_filter(table(spark, sf_dir, "pages"), rules)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(topk.quantised(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))[0].drop("turn_id")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_near_dedup, op2_exact_dedup, op3_toxicity, op4_lm_score, op5_best_fit_packing, op6_quality, op7_url_filter, op8_secret_scan, op9_topk_search, op10_byte_bpe, op11_prefix_trie, op12_vector_codes, op13_language)}

ORACLE_SQL = {
    "op2_exact_dedup": r"""
        with d as (
            select doc_id, length(coalesce(text, '')) as n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as h
            from documents)
        select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by h) as group_size,
               doc_id = first_value(doc_id) over w as kept, h as text_sha256
        from d window w as (partition by h order by n desc, doc_id)""",
    "op7_url_filter": r"""
        with u as (
            select page_id, case when contains(coalesce(url, ''), '://') then regexp_extract(url, '://([^?#]*)', 1) else '' end as rest from pages),
        p as (
            select page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                   regexp_replace(rest, '^[^/]*', '') as path from u),
        rules as (
            select * from (values ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
                ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/'))
            as r(verdict, rule, h, q)),
        best as (
            select p.page_id, p.host, p.path, arg_max(r.rule, length(r.rule)) as rule, arg_max(r.verdict, length(r.rule)) as verdict
            from p left join rules r on (p.host = r.h or ends_with(p.host, '.' || r.h)) and starts_with(p.path, r.q) group by all)
        select page_id, host, path, rule, coalesce(verdict, case
            when regexp_matches(host || path, '(^|[./-])ads?[./-].*/banner([^A-Za-z0-9]|$)') or regexp_matches(host || path, '/(click|track|pixel)/redirect([^A-Za-z0-9]|$)')
              or regexp_matches(host || path, '^([^/]*[.-])?casino[.-][^/]*/') or regexp_matches(host || path, '/wp-login\.php$') then 'block' else 'allow' end) as verdict
        from best""",
    "op9_topk_search": r"""
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
            where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
        s as (
            select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
            from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0 and len(q.v) = len(c.v)),
        r as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s)
        select query_id, rank, vec_id, score from r where rank <= 5""",
    "op11_prefix_trie": r"""
        with own as (
            select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as s
            from conversations where conv_id is not null group by conv_id),
        bits as (
            select conv_id, s, flatten(list_transform(range(1, len(conv_id::varchar) + 1), lambda i: list_transform(range(0, 8), lambda j: (ord((conv_id::varchar)[i]) >> j) & 1))) as b from own),
        heads as (  -- crc32, a bit at a time
            select conv_id, s, xor(list_reduce(list_prepend(4294967295::bigint, b::bigint[]), lambda a, x: xor(a >> 1, (xor(a, x) & 1) * 3988292384)), 4294967295) % 4 as h from bits),
        made as (
            select c.conv_id, list_concat(list_slice(coalesce(f.s, []), 1, c.h), list_slice(c.s, c.h + 1, len(c.s))) as s
            from heads c left join own f on f.conv_id = c.conv_id - c.conv_id % 20),
        prefix as (select conv_id, len(s) as n, d, list_slice(s, 1, d) as k from (select *, unnest(range(0, len(s) + 1)) as d from made)),
        node as materialized (
            select k, d, min(conv_id) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where n = d), '')) as ends_sha256,
                   list_slice(k, 1, d - 1) as up, (count(*) - 1) * coalesce(len(regexp_extract_all(k[d].text, '[^ 	-
]+')), 0) as own
            from prefix group by k, d),
        kids as (select up as k, count(*) as n from node where d > 0 group by up),
        below as (
            select list_slice(n.k, 1, a) as k, sum(n.own) as saved, count(*) filter (where kids.n is null) as leaves
            from (select *, unnest(range(0, d + 1)) as a from node) n left join kids on kids.k = n.k group by 1)
        select n.conv_id, n.d as depth, case when n.d > 0 then p.conv_id end as parent_conv_id, n.n_convs, coalesce(c.n, 0) as n_children, b.leaves as n_leaves, b.saved::bigint as saved_tokens, n.ends_sha256
        from node n join below b on b.k = n.k left join kids c on c.k = n.k left join node p on p.k = n.up""",
    "op12_vector_codes": r"""
        with v as materialized (
            select row_number() over () as rid, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
            where len(embedding) > 0 and len(embedding) % 16 = 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
        cut as materialized (select rid, p, list_slice(v, p * len(v) // 16 + 1, (p + 1) * len(v) // 16) as x from v, range(16) r(p)),
        c0 as (select p, e, x as c from cut join (select rid, row_number() over (order by vec_id nulls last, v) - 1 as e from v qualify e < 64) using (rid)),
        a0 as (select rid, p, any_value(x) as x, arg_min(e, (d, e)) as e from (select rid, p, x, e, list_sum(list_transform(list_zip(x, c), lambda t: (t[1] - t[2]) * (t[1] - t[2])))::bigint as d from cut join c0 using (p)) group by rid, p),
        m0 as (select p, e, list(m order by j) as c from (select p, e, j, floor(sum(x[j]) / count(*))::bigint as m from (select *, unnest(range(1, len(x) + 1)) as j from a0) group by p, e, j) group by p, e),
        c1 as materialized (select p, e, coalesce(m0.c, c0.c) as c from c0 left join m0 using (p, e)),
        a1 as (select rid, p, any_value(x) as x, arg_min(e, (d, e)) as e from (select rid, p, x, e, list_sum(list_transform(list_zip(x, c), lambda t: (t[1] - t[2]) * (t[1] - t[2])))::bigint as d from cut join c1 using (p)) group by rid, p),
        m1 as (select p, e, list(m order by j) as c from (select p, e, j, floor(sum(x[j]) / count(*))::bigint as m from (select *, unnest(range(1, len(x) + 1)) as j from a1) group by p, e, j) group by p, e),
        c2 as materialized (select p, e, coalesce(m1.c, c1.c) as c from c1 left join m1 using (p, e)),
        a2 as (select rid, p, arg_min(e, (d, e)) as e, min(d) as d from (select rid, p, e, list_sum(list_transform(list_zip(x, c), lambda t: (t[1] - t[2]) * (t[1] - t[2])))::bigint as d from cut join c2 using (p)) group by rid, p),
        coded as (select rid, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error from a2 group by rid)
        select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
               (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) from c2) as codebooks_sha256
        from coded join v using (rid)""",
}
