"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    binpack,
    capfilter,
    htmltext,
    invindex,
    labelled,
    maglev,
    quality,
    simhash,
    spelling,
    substring,
    tokenpack,
    toxicity,
    trie,
    warc,
)
from tidemark.llm.common import table
from tidemark.session import scratch_path


def op1_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def _judged(scored: DataFrame, least: float) -> DataFrame:
    return scored.select(
        "doc_id",
        labelled.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
        *[c for c in scored.columns if c not in ("doc_id", "score")],
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _judged(toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))), 0.5)


SHARDS = [f"shard-{i:03d}" for i in range(256)]


def op3_maglev(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return maglev.place(docs, "doc_id", SHARDS)


def op4_capfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capfilter.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _judged(quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels"))), 0.3)


def damaged(pages: DataFrame) -> DataFrame:
    """A replica with faults: some pages with one character replaced, some lost."""
    broken = F.concat(F.substring("html", 1, 10), F.lit("#"), F.expr("substring(html, 12)"))
    html = F.when(F.col("page_id") % 101 == 7, broken).otherwise(F.col("html"))
    return pages.filter(~F.coalesce(F.col("page_id") % 499 == 11, F.lit(False))).withColumn("html", html)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    root = scratch_path(spark, "archives")
    warc.write_archives(pages, f"{root}/one", compressed=True)
    warc.write_archives(damaged(pages), f"{root}/two", compressed=True)
    return warc.audit_archives(spark, f"{root}/one", f"{root}/two", pages)


def op7_tokenpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    path = tokenpack.write_ids(table(spark, sf_dir, "documents"), vocabulary, end_id=2)
    return tokenpack.read_ids(spark, path, with_ids=False)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op9_binpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binpack.pack(binpack.measured(table(spark, sf_dir, "documents")))


def op10_invindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return invindex.contamination(invindex.matches(docs, benchmark))


def op11_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(*trie.rebuilt_turns(table(spark, sf_dir, "conversations")))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_htmltext": op1_htmltext,
    "op2_toxicity": op2_toxicity,
    "op3_maglev": op3_maglev,
    "op4_capfilter": op4_capfilter,
    "op5_quality": op5_quality,
    "op6_warc": op6_warc,
    "op7_tokenpack": op7_tokenpack,
    "op8_simhash": op8_simhash,
    "op9_binpack": op9_binpack,
    "op10_invindex": op10_invindex,
    "op11_substring": op11_substring,
    "op12_trie": op12_trie,
    "op13_spelling": op13_spelling,
}

ORACLES: dict[str, str] = {
    "op4_capfilter": """
with recursive unit as (
  select vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) as norm
  from (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings)
  where v is not null and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
),
links as (
  select a.vec_id as src, b.vec_id as dst
  from unit a join unit b on a.vec_id <> b.vec_id and a.norm > 0 and b.norm > 0
   and list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.9
),
reach as (
  select vec_id as node, vec_id as seen from embeddings
  union
  select r.node, l.dst from reach r join links l on l.src = r.seen
),
counts as (select src, count(*) as n from links group by src)
select e.vec_id, coalesce(c.n, 0) as n_links, r.component_id, e.vec_id = r.component_id as kept
from embeddings e
join (select node, min(seen) as component_id from reach group by node) r on r.node = e.vec_id
left join counts c on c.src = e.vec_id
""",
    "op6_warc": """
with b as (
  select page_id, url, case when page_id % 101 = 7
    then substring(html, 1, 10) || '#' || substring(html, 12) else html end as html
  from pages where page_id % 499 <> 11
),
both_sides as (
  select 'a' as side, page_id, url, html from pages union all select 'b', page_id, url, html from b
),
records as (
  select side, page_id, url,
    'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:md5:' || md5(page_id::varchar || chr(10) || url) || '>' || chr(13) || chr(10)
    || 'Content-Type: text/html' || chr(13) || chr(10)
    || 'Content-Length: ' || octet_length(encode(html))::varchar || chr(13) || chr(10) || chr(13) || chr(10)
    || html || chr(13) || chr(10) || chr(13) || chr(10) as whole
  from both_sides
),
summed as (select side, page_id, url, octet_length(encode(whole)) as n, sha256(whole) as digest from records),
ranked as (
  select a.page_id, a.url, a.n as length, a.digest as digest_a, b.digest as digest_b,
         row_number() over (order by a.page_id, a.url) - 1 as r
  from summed a left join summed b on b.side = 'b' and b.page_id = a.page_id and b.url = a.url
  where a.side = 'a'
),
placed as (
  select *, r // 4096 as archive, r % 4096 as record_no,
         coalesce(sum(length) over (partition by r // 4096 order by r rows between unbounded preceding and 1 preceding), 0)
           as start
  from ranked
)
select page_id, url, archive::bigint as archive, record_no::bigint as record_no, start::bigint as "offset",
       length::bigint as length, case when digest_b is null then 'missing' else 'changed' end as status,
       digest_a, digest_b
from placed where digest_b is null or digest_a <> digest_b
""",
    "op10_invindex": r"""
with d as (
  select doc_id, row_number() over () as r, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from documents
),
i as (
  select item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from benchmark
),
phrases as (
  select distinct item_id, len(w[p : p + 9]) as n, array_to_string(w[p : p + 9], ' ') as phrase
  from (select item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as p from i where len(w) > 0)
),
sizes as (select distinct n from phrases),
spots as (select r, unnest(range(1, len(w) + 1)) as p, w from d),
runs as (
  select r, p, n, array_to_string(w[p : p + n - 1], ' ') as phrase from spots, sizes where p + n - 1 <= len(w)
),
found as (select r, p, n, item_id from runs join phrases using (n, phrase)),
hit as (select r, count(distinct q) as n_hit from (select r, unnest(range(p, p + n)) as q from found) group by r),
items as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as list
  from (select distinct r, cast(item_id as varchar) as item from found) group by r
)
select d.doc_id, len(d.w) as n_words, coalesce(hit.n_hit, 0) as n_hit, coalesce(items.n_items, 0) as n_items,
       sha256(coalesce(items.list, '')) as items_sha256, hit.n_hit is not null as contaminated
from d left join hit using (r) left join items using (r)
""",
    "op11_substring": r"""
with d as (
  select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents
),
windows as (
  select doc_id, p, sha256(array_to_string(w[p : p + 19], ' ')) as h
  from (select doc_id, w, unnest(range(1, len(w) - 18)) as p from d)
),
later as (
  select doc_id, p from (select *, row_number() over (partition by h order by doc_id, p) as r from windows) where r > 1
),
gone as (select doc_id, list_sort(list(distinct q)) as g from (select doc_id, unnest(range(p, p + 20)) as q from later) group by doc_id),
kept as (
  select d.doc_id, string_agg(x, ' ' order by i) as text, count(*) as n
  from (select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as i from d) d
  where not exists (select 1 from (select doc_id, unnest(g) as q from gone) k where k.doc_id = d.doc_id and k.q = d.i)
  group by d.doc_id
)
select d.doc_id, len(d.w) as n_words, coalesce(len(g.g), 0) as n_removed, sha256(coalesce(k.text, '')) as kept_sha256
from d left join gone g using (doc_id) left join kept k using (doc_id)
""",
    "op12_trie": r"""
with steps as (
  select list(v order by b) as t from (
    select b, list_reduce(range(8), lambda c, i: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b) as v
    from (select unnest(range(256))::bigint as b)
  )
),
own as (
  select conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} order by turn nulls first, role, text) as s
  from conversations where conv_id is not null group by conv_id
),
heads as (
  select conv_id, s, xor(list_reduce(
    list_transform(range(1, 2 * length(conv_id::varchar), 2), lambda i: ('0x' || substring(hex(encode(conv_id::varchar)), i, 2))::bigint),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::bigint), 4294967295) % 4 as h
  from own, steps
),
whole as (
  select a.conv_id, list_concat(coalesce(b.s[1 : a.h], []), a.s[a.h + 1 :]) as s
  from heads a left join heads b on b.conv_id = a.conv_id - a.conv_id % 20
),
entries as (select conv_id, s, unnest(range(0, len(s) + 1)) as d from whole),
marked as (
  select conv_id, d, len(s) as size, sha256(s[1 : d]::varchar) as k, case when d > 0 then sha256(s[1 : d - 1]::varchar) end as up,
         case when d > 0 then len(regexp_extract_all(s[d].t, '[^\x20\x09-\x0D]+')) else 0 end as words
  from entries
),
nodes as (
  select k, d, any_value(up) as up, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where size = d), '')) as ends_sha256
  from marked group by k, d
),
children as (select up as k, count(*) as n from nodes where up is not null group by up),
full_nodes as (select n.*, coalesce(c.n, 0) as n_children from nodes n left join children c using (k)),
under as (
  select distinct a.k as top, b.k as low from marked a join marked b on a.conv_id = b.conv_id and b.d >= a.d
),
totals as (
  select top as k, count(*) filter (where n.n_children = 0) as n_leaves, sum((n.n_convs - 1) * n.words)::bigint as saved_tokens
  from under join full_nodes n on n.k = under.low group by top
)
select n.conv_id, n.d as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, t.n_leaves, t.saved_tokens, n.ends_sha256
from full_nodes n join totals t using (k) left join full_nodes p on p.k = n.up
""",
    "op13_spelling": r"""
with recursive steps as (
  select list(v order by b) as t from (
    select b, list_reduce(range(8), lambda c, i: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b) as v
    from (select unnest(range(256))::bigint as b)
  )
),
runs as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) as run
  from documents
),
bytes as (
  select doc_id, run, count(*) as m, hex(encode(doc_id::varchar || ':' || run)) as x from runs where length(run) >= 7 group by all
),
summed as (
  select run, m, xor(list_reduce(
    list_transform(range(1, length(x), 2), lambda i: ('0x' || substring(x, i, 2))::bigint),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::bigint), 4294967295) as h
  from bytes, steps
),
words as (
  select word, sum(m)::bigint as n from (
    select case when h % 31 = 0 then left(run, (h % length(run))::int) || substring(run, (h % length(run))::int + 2) else run end as word, m
    from summed
  ) where length(word) >= 7 group by word having sum(m) >= 2
),
lacking as (
  select word, p, left(word, p - 1) || substring(word, p + 1) as rest
  from (select word, unnest(range(1, length(word) + 1))::int as p from words)
),
near as (
  select a.word, b.word as other from lacking a join lacking b using (p, rest) where a.word <> b.word and length(a.word) = length(b.word)
  union select a.word, a.rest from lacking a join words w on w.word = a.rest
  union select a.rest, a.word from lacking a join words w on w.word = a.rest
),
best as (
  select w.word, w.n, count(o.word) as n_near, arg_min(o.word, (-o.n, encode(o.word))) as top, max(o.n) as most
  from words w left join near x on x.word = w.word left join words o on o.word = x.other group by w.word, w.n
),
forms as (
  select word, n, n_near, case when most >= 10 * n then top end as form, case when most >= 10 * n then most end as form_n from best
),
chains as (
  select word, word as root, form as next from forms
  union all
  select c.word, c.next, f.form from chains c join forms f on f.word = c.next
)
select f.word, f.form, c.root, f.n, f.n_near, f.form_n from forms f join chains c on c.word = f.word and c.next is null
""",
}
