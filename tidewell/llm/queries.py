"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, chosen_path, divergence, exact_dedup, html_text, jaccard, mixing, pii, quality, substring, topk, trie

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
with d as (select doc_id, coalesce(text, '') as text from documents),
     g as (select text, max(doc_id) as keep_id, count(*) as group_size from d group by text)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.text) as text_sha256
from d join g on d.text = g.text""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query(r"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         sha256('mix-1|' || coalesce(cast(doc_id as varchar), '') || '|' || sha256(coalesce(text, ''))) as coin
  from documents),
s0 as (select source, cast(sum(size) as bigint) as source_size from d group by source),
s1 as (select *, row_number() over (order by source nulls last) - 1 as i from s0),
s2 as (select *, case i % 3 when 0 then 5 when 1 then 2 else 1 end as w from s1),
s3 as (select *, row_number() over (order by source_size::double / w, i) as k from s2),
s4 as (select *, coalesce(sum(2 * source_size) over (order by k rows between unbounded preceding and 1 preceding), 0) as c,
       sum(w) over (order by k rows between current row and unbounded following) as ws, sum(source_size) over () as total from s3),
cut as (select min(k) as k from s4 where (3 * total - 2 * c) * w <= 2 * source_size * 2 * ws),
lam as (select cast(3 * total - 2 * c as bigint) as num, cast(2 * ws as bigint) as den from s4 join cut using (k)),
r as (select s2.source, s2.source_size,
             least(cast(2 * s2.source_size as double), cast(lam.num * s2.w as double) / cast(lam.den as double)) as target
      from s2 cross join lam),
j as (select d.*, r.source_size, r.target, case when r.source_size > 0 then r.target / r.source_size else 0.0 end as rate
      from d join r on d.source is not distinct from r.source)
select doc_id, size, source_size, target,
       cast(size * (floor(rate) + case when cast(cast('0x' || substr(coin, 1, 13) as bigint) as double) / 4503599627370496.0
                                            < rate - floor(rate) then 1 else 0 end) as bigint) as taken
from j""")
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query()
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query(r"""
with t as (select conv_id // 2 as pair_id, conv_id % 2 = 0 as chosen, coalesce(turn, 9223372036854775807) as tn, turn, role, text from conversations where conv_id is not null),
s as (select pair_id, tn, role, text, sum(case when chosen then 1 else -1 end) as more from t group by all),
c as (select pair_id, min(case when more <> 0 then tn end) as cut from s group by pair_id),
j as (select t.*, (c.cut is null or t.tn < c.cut) as common, coalesce(role, 'unknown') as r,
             '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) as rendered
      from t join c using (pair_id))
select pair_id, case when common then 'prompt' when chosen then 'chosen' else 'rejected' end as part, turn, r as role, rendered,
       cast(length(rendered) as bigint) as n_chars, case when not common and r = 'assistant' then 1 else 0 end as loss
from j where not common or chosen""")
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.preference_rows(table(spark, sf_dir, "conversations"))


@query("""
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v, len(embedding) as dim from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(cast(x as double)))) = 0),
s as (select q.vec_id as query_id, v.vec_id, cast(list_inner_product(q.v, v.v) as bigint) as score
      from v q join v on q.dim = v.dim and q.vec_id <> v.vec_id where q.vec_id % 50 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5""")
def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


@query()
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
     s as (select doc_id, ws, unnest(range(1, len(ws) - 48)) as i from w where len(ws) >= 50),
     h as (select doc_id, i, md5(array_to_string(ws[i : i + 49], ' ')) as h from s),
     f as (select h, min(doc_id) as first_doc from h group by h),
     r as (select distinct doc_id, unnest(range(i, i + 50)) as pos from h join f using (h) where f.first_doc < h.doc_id),
     k as (select w.doc_id, w.i, w.word, r.pos is not null as gone
           from (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as i from w) as w left join r on r.doc_id = w.doc_id and r.pos = w.i),
     a as (select doc_id, cast(sum(gone::int) as bigint) as n_removed, string_agg(word, ' ' order by i) filter (not gone) as kept from k group by doc_id)
select w.doc_id, cast(len(w.ws) as bigint) as n_words, coalesce(a.n_removed, 0) as n_removed, sha256(coalesce(a.kept, '')) as kept_sha256
from w left join a using (doc_id)""")
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query(r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select doc_id, case when len(ws) = 0 then []::varchar[] when len(ws) < 3 then [array_to_string(ws, ' ')]
             else list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) end as sh from w),
t as (select doc_id, unnest(sh) as token from s),
c as (select x.doc_id as a, y.doc_id as b, count(*) as common from t x join t y on x.token = y.token and x.doc_id < y.doc_id group by all),
l as (select a, b from c join s x on x.doc_id = a join s y on y.doc_id = b where 100 * common >= 90 * (len(x.sh) + len(y.sh) - common)),
e as (select a, b from l union all select b, a from l),
r(doc_id, other) as (select doc_id, doc_id from s union select r.doc_id, e.b from r join e on r.other = e.a)
select s.doc_id, cast(len(sh) as bigint) as n_shingles, m.component_id
from s join (select doc_id, min(other) as component_id from r group by doc_id) m using (doc_id)""")
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.component_ids(table(spark, sf_dir, "documents"), 3, 90, 100)


@query()
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(r"""
with d as (select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as ws from documents),
t as (select rid, lang, source, unnest(ws) as term from d),
lt as (select lang, term, count(*) as tf from t group by all having count(distinct rid) >= 10),
l as (select lang, count(*) as v, sum(tf) as n from lt group by lang),
c as (select lang, source, term, count(*) as tf from t join lt using (lang, term) group by all),
g as (select s.lang, s.source, coalesce(l.v, 0) as v, coalesce(sum(c.tf), 0) as n
      from (select distinct lang, source from d) s left join l using (lang) left join c on c.lang = s.lang and c.source = s.source group by all),
p as (select g.lang, g.source, lt.term, coalesce(c.tf, 0) as tf,
             cast(1 + 1000000000::hugeint * (coalesce(c.tf, 0) + 2) // (g.n + 2 * g.v) as bigint) as p,
             cast(1 + 1000000000::hugeint * (lt.tf + 2) // (l.n + 2 * l.v) as bigint) as q
      from g join l using (lang) join lt using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = lt.term),
pairs as (select a.lang, a.source, b.source as item, coalesce(x.value, 0) as value
          from g a join g b on a.lang = b.lang and a.source <> b.source
          left join (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
                     from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all) x
            on x.lang = a.lang and x.source = a.source and x.item = b.source),
words as (select lang, source, term as item, (p - q) * (p - q) // (p + q) as value from p where tf > 0 and p > q)
select lang, source, 'pair' as part, item, cast(value as bigint) as value,
       cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank from pairs
union all
select lang, source, 'term', item, cast(value as bigint), cast(row_number() over (partition by lang, source order by value desc, item) as integer)
from words qualify row_number() over (partition by lang, source order by value desc, item) <= 10""")
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


@query(r"""
with crc as (select list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)) as t),
t as (select conv_id, sha256(cast(length(coalesce(role, '')) as varchar) || ':' || coalesce(role, '') || coalesce(text, '')) as s, strlen(coalesce(text, '')) as n, turn
      from conversations where conv_id is not null),
c as (select conv_id, list({'s': s, 'n': n} order by turn nulls first, s) as own from t group by conv_id),
h as (select conv_id, own, xor(list_reduce(list_concat([4294967295], list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as bigint))),
             lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1])), 4294967295) % 9 as h from c, crc),
r as (select h.conv_id, list_concat(coalesce(b.own, [])[1 : h.h], h.own[h.h + 1 :]) as seq from h left join c b on b.conv_id = h.conv_id - h.conv_id % 5),
k as (select conv_id, d, len(seq) as len, coalesce(seq[d].n, 0) as n, md5(array_to_string(list_transform(seq[1:d], lambda x: x.s), ',')) as key from (select conv_id, seq, unnest(range(0, len(seq) + 1)) as d from r)),
node as (select d, key, min(conv_id) as conv_id, count(*) as n_convs, max(n) as n, coalesce(string_agg(conv_id, ',' order by conv_id) filter (d = len), '') as ends from k group by d, key),
up as (select node.d, node.key, p.d as pd, p.key as pkey, (node.n_convs - 1) * node.n as saved from node join k p on p.conv_id = node.conv_id and p.d <= node.d),
kids as (select pd as d, pkey as key, count(*) as n_children from up where d = pd + 1 group by all),
under as (select up.pd as d, up.pkey as key, sum(saved) as saved, count(*) filter (kids.d is null) as leaves from up left join kids on kids.d = up.d and kids.key = up.key group by all)
select node.conv_id, cast(node.d as bigint) as depth, p.conv_id as parent_conv_id, node.n_convs, coalesce(n_children, 0) as n_children, under.leaves as n_leaves, cast(under.saved as bigint) as saved_tokens, sha256(node.ends) as ends_sha256
from node join under using (d, key) left join kids using (d, key) left join up on up.d = node.d and up.key = node.key and up.pd = node.d - 1 left join node p on p.d = up.pd and p.key = up.pkey""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query(r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select doc_id, case when len(ws) = 0 then []::varchar[] when len(ws) < 5 then [array_to_string(ws, ' ')]
             else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] || ' ' || ws[i + 4])) end as sh from w),
t as (select doc_id, unnest(sh) as token from s),
c as (select x.doc_id as a, y.doc_id as b, count(*) as common from t x join t y on x.token = y.token and x.doc_id < y.doc_id group by all),
l as (select a, b from c join s x on x.doc_id = a join s y on y.doc_id = b where 100 * common >= 85 * (len(x.sh) + len(y.sh) - common)),
e as (select a, b from l union all select b, a from l),
r(doc_id, other) as (select doc_id, doc_id from s union select r.doc_id, e.b from r join e on r.other = e.a)
select s.doc_id, cast(len(sh) as bigint) as n_shingles, m.component_id, s.doc_id = m.component_id as kept
from s join (select doc_id, min(other) as component_id from r group by doc_id) m using (doc_id)""")
def op13_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
