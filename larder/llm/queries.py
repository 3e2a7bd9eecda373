"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import byte_cnn, forced_bpe
from larder.llm.ball_tree import top_k
from larder.llm.bloom_cascade import judge_urls, rules_frame
from larder.llm.content_sort import content_sort
from larder.llm.line_winnow import winnow_lines
from larder.llm.packing import retrieval_pack
from larder.llm.prob_minhash import near_duplicates
from larder.llm.range_coder import written_and_read
from larder.llm.separator_scan import count_tokens
from larder.llm.sim_hash import sim_hash_classes
from larder.llm.source_divergence import source_divergence
from larder.llm.spelling_trie import spelling_variants

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with its SQL if it has one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql.strip()
        return function

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query(r"""
with l as (
    select doc_id, i, line, trim(line) <> '' as counted from (
        select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as i
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents)
    )
), c as (
    select doc_id, i, trim(line) as t, row_number() over (partition by doc_id order by i) as k
    from l where counted
), m as (
    select doc_id, k, t, lead(t, 1) over d as t1, lead(t, 2) over d as t2,
        len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) as n,
        len(regexp_extract_all(lead(t, 1) over d, '[^\x20\x09-\x0D]+')) as n1
    from c window d as (partition by doc_id order by k)
), w as (
    select doc_id, k, 1 as run, [t] as content from m where n > 50
    union all select doc_id, k, 2, [t, t1] from m where t1 is not null and n + n1 > 50
    union all select doc_id, k, 3, [t, t1, t2] from m where t2 is not null
), r as (
    select doc_id, k, run from (
        select doc_id, k, run, row_number() over (partition by content order by doc_id, k) as n
        from w
    ) where n > 1
), gone as (
    select distinct c.doc_id, c.i
    from c join r on c.doc_id = r.doc_id and c.k >= r.k and c.k < r.k + r.run
), kept as (
    select l.doc_id,
        string_agg(case when gone.i is null then line end, chr(10) order by l.i) as text,
        count(*) filter (counted) as n_lines, count(gone.i) as n_deleted
    from l left join gone on l.doc_id = gone.doc_id and l.i = gone.i group by l.doc_id
)
select doc_id, n_lines, n_deleted, sha256(coalesce(text, '')) as text_sha256 from kept
""")
def op1_winnowing_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = winnow_lines(documents(spark, sf_dir))
    return cut.select("doc_id", "n_lines", "n_deleted", F.sha2("text", 256).alias("text_sha256"))


@query()
def op2_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir))


#: The rules that judge the pages.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query()
def op3_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = (~byte_cnn.in_training("doc_id")).alias("held_out")
    predicted = byte_cnn.predict(docs, byte_cnn.train(docs))
    return predicted.select("doc_id", held_out, "lang_pred", "score")


@query()
def op4_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forced_bpe.round_trip(documents(spark, sf_dir))


@query()
def op5_probminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


@query()
def op6_context_mixing_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_and_read(documents(spark, sf_dir))


@query("""
with v as (
    select vec_id, [floor(1024 * x::double) for x in embedding] as e
    from embeddings
    where embedding is not null and len(embedding) > 0
        and len([x for x in embedding if x is not null and isfinite(x)]) = len(embedding)
), s as (
    select q.vec_id as query_id, c.vec_id as vec_id,
        cast(list_dot_product(q.e, c.e) as bigint) as score
    from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id
), r as (
    select query_id, vec_id, score,
        cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank
    from s
)
select query_id, rank, vec_id, score from r where rank <= 10
""")
def op7_ball_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % 100 == 0)


@query(r"""
with u as (
    select page_id, case when contains(url, '://')
        then substring(url, strpos(url, '://') + 3) else '' end as rest
    from pages
), h as (
    select page_id, rest, regexp_extract(rest, '^[^/?#]*', 0) as raw_host from u
), p as (
    select page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
        as host, regexp_extract(substring(rest, length(raw_host) + 1), '^[^?#]*', 0) as path
    from h
), r(verdict, rhost, rpath) as (
    values ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
        ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), m as (
    select page_id, host, path, verdict, rhost || rpath as rule,
        row_number() over (partition by page_id order by length(rhost || rpath) desc nulls last)
            as n
    from p left join r
        on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from m where n = 1
""")
def op8_bloom_cascade_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge_urls(pages, rules_frame(spark, URL_RULES))


@query()
def op9_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval_pack(documents(spark, sf_dir))


@query(r"""
with n as (
    select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t
    from documents
), g as (select t, min(doc_id) as keep_id, count(*) as group_size from n group by t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256
from n join g using (t)
""")
def op10_content_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort(documents(spark, sf_dir))


@query(r"""
with d as (
    select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
        coalesce(text, '') as text
    from documents
), w as (
    select id, lang, source, translate(unnest(regexp_extract_all(text,
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') as term
    from d
), kept as (
    select lang, term, count(*) as n from w group by all having count(distinct id) >= 10
), counts as (
    select lang, source, term, count(*) as n from w semi join kept using (lang, term) group by all
), langs as (
    select lang, count(*) as v, sum(n)::hugeint as total from kept group by lang
), groups as (
    select g.lang, g.source, coalesce(sum(n), 0)::hugeint as total
    from (select distinct lang, source from d) g left join counts using (lang, source) group by all
), p as (
    select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
        (1 + 1000000000::hugeint * (coalesce(c.n, 0) + 2) // (g.total + 2 * l.v))::bigint as p,
        (1 + 1000000000::hugeint * (k.n + 2) // (l.total + 2 * l.v))::bigint as q
    from groups g join langs l using (lang) join kept k using (lang)
        left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
), pairs as (
    select a.lang, a.source, b.source as item, 0::bigint as value
    from groups a join groups b using (lang)
    where a.source <> b.source and a.lang not in (select lang from langs)
    union all
    select a.lang, a.source, b.source,
        sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::bigint
    from p a join p b using (lang, term) where a.source <> b.source group by all
), terms as (
    select lang, source, term as item, (p - q) * (p - q) // (p + q) as value
    from p where n > 0 and p > q
), ranked as (
    select lang, source, 'pair' as part, item, value, row_number() over (
        partition by lang, source order by value desc, item)::int as rank from pairs
    union all
    select lang, source, 'term' as part, item, value, row_number() over (
        partition by lang, source order by value desc, item)::int as rank from terms
)
select * from ranked where part = 'pair' or rank <= 10
""")
def op12_gustavson_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(documents(spark, sf_dir))


@query()
def op13_pigeonring_sim_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sim_hash_classes(documents(spark, sf_dir))


@query()
def op11_trie_pair_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))
