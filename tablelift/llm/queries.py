"""One query per operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.llm import crf_quality
from tablelift.llm.anchor_dedup import removal_digests, remove_repeats
from tablelift.llm.byte_bpe import encode_digests
from tablelift.llm.centroids import cluster_report
from tablelift.llm.chat_format import canonical_turns, conversation_digests
from tablelift.llm.embed_dedup import near_vectors
from tablelift.llm.jaccard_join import jaccard_components
from tablelift.llm.packing import pack
from tablelift.llm.quality_rules import quality_rules
from tablelift.llm.sharding import lookup_table, place
from tablelift.llm.suffix_dedup import repeated_spans
from tablelift.llm.token_files import token_files_roundtrip
from tablelift.llm.whitening import whiten_vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

WORDS_RE = r"'[^\x20\x09-\x0D]+'"


def query(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle.strip()
        return fn
    return deco


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


@query("op10_jaccard_join", f"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), {WORDS_RE}) as ws from documents),
s as (select doc_id, case when len(ws) >= 5
        then list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
        when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end as sh from w),
g as (select doc_id, len(sh) as n, unnest(sh) as x from s),
links as (select a.doc_id as u, b.doc_id as v from g a join g b on a.x = b.x and a.doc_id < b.doc_id
          group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges as (select u, v from links union all select v, u from links),
reach(a, b) as (select doc_id, doc_id from s union select r.a, e.v from reach r join edges e on r.b = e.u)
select doc_id, cast(len(sh) as bigint) as n_shingles, m.c as component_id
from s join (select a, min(b) as c from reach group by a) m on s.doc_id = m.a
""")
def op10_jaccard_join(spark, sf):
    return jaccard_components(load(spark, sf, "documents"))


@query("op4_token_files")
def op4_token_files(spark, sf):
    return token_files_roundtrip(load(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark, sf):
    return pack(load(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), 0, 2048)


@query("op1_suffix_dedup", f"""
with w as (select doc_id, regexp_extract_all(text, {WORDS_RE}) as ws from documents where text is not null),
p as (select doc_id, unnest(range(0, len(ws) - 49)) as s, ws from w where len(ws) >= 50),
k as (select doc_id, s, md5(array_to_string(ws[s + 1:s + 50], ' ')) as h from p),
d as (select doc_id, s, row_number() over (partition by h order by doc_id, s) as r,
             first_value(doc_id) over (partition by h order by doc_id, s) as f from k),
e as (select *, case when s <= lag(s) over (partition by doc_id order by s) + 50 then 0 else 1 end as fresh
      from d where r > 1),
i as (select *, sum(fresh) over (partition by doc_id order by s) as part from e)
select doc_id, cast(min(s) as integer) as start_word, cast(max(s) + 50 as integer) as end_word,
       min(f) as first_doc_id
from i group by doc_id, part
""")
def op1_suffix_dedup(spark, sf):
    return repeated_spans(load(spark, sf, "documents")).drop("text_key")


# SQL for the references, the distances and the verdict, over the same counts.
_CLASSES = {"symbol": r"[#*$%&|<>]", "lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]",
            "punct": r"[!\x22'()+,\-./:;=?@\[\x5C\]^_`{}~]", "space": r"[\x20\x09-\x0D]",
            "control": r"[\x00-\x08\x0E-\x1F\x7F]"}


def _cells(pattern: str) -> str:
    return f"len(regexp_replace(t, '{pattern.replace(chr(39), chr(39) * 2)}', '', 'g'))"


def _kl(a: str) -> str:
    return f"sum(case when {a} > 0 then {a} * log2({a} / (({'p'} + q) / 2)) else 0 end)"


_QUALITY_SQL = f"""
with d as (select doc_id, coalesce(text, '') as t, coalesce(lang, '') as lang from documents),
w as (select *, regexp_extract_all(t, {WORDS_RE}) as ws,
             regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORDS_RE}) as ls
      from d),
rep as (select doc_id, count(distinct i + o) as n from (
          select doc_id, i, count(*) over (partition by doc_id, g) as c from (
            select doc_id, i, array_to_string(ws[i:i + 4], ' ') as g
            from (select doc_id, ws, unnest(range(1, len(ws) - 3)) as i from w where len(ws) >= 5)))
        cross join (select unnest(range(0, 5)) as o) where c > 1 group by doc_id),
dup as (select doc_id, count(*) - count(distinct l) as n from (select doc_id, unnest(string_split(t, chr(10))) as l from d)
        where regexp_matches(l, {WORDS_RE}) group by doc_id),
base as (select w.doc_id, cast(len(ws) as bigint) as n_words,
           cast(len(t) - (len(t) - {_cells(_CLASSES['space'])}) as bigint) as word_chars,
           cast(len(t) - {_cells(_CLASSES['symbol'])} as bigint) as n_symbols,
           cast(coalesce(dup.n, 0) as bigint) as n_dup_lines, cast(coalesce(rep.n, 0) as bigint) as n_repeat_words,
           len(t) as n_chars
         from w left join rep using (doc_id) left join dup using (doc_id)),
cells as (select doc_id, lang, unnest([{", ".join(f"{{'c': '{k}', 'n': len(t) - {_cells(v)}}}" for k, v in _CLASSES.items())},
            {{'c': 'other', 'n': len(t) - {" - ".join(f"(len(t) - {_cells(v)})" for v in _CLASSES.values())}}}],
            recursive := true) from d),
refs as (select lang from w group by lang having sum(len(ws)) >= 5000),
rc as (select lang, c, sum(n) / sum(sum(n)) over (partition by lang) as q from cells join refs using (lang) group by lang, c),
alone as (select count(*) = 0 as yes from (select lang from rc group by lang having 2 * sum(q) filter (c = 'other')
          > sum(q) filter (c in ('lower', 'upper', 'other')))),
script as (select doc_id, 2 * sum(n) filter (c = 'other') > sum(n) filter (c in ('lower', 'upper', 'other')) as other
           from cells group by doc_id),
jc as (select doc_id, min(sqrt(greatest((a + b) / 2, 0))) as dist from (
         select doc_id, lang, {_kl('p')} as a, {_kl('q')} as b from (
           select x.doc_id, rc.lang, x.n / greatest(sum(x.n) over (partition by x.doc_id, rc.lang), 1) as p, rc.q
           from cells x join rc using (c)) group by doc_id, lang) group by doc_id),
lw as (select doc_id, lang, unnest(ls) as x from w),
wc as (select lang, x, count(*) as n from lw join refs using (lang) group by lang, x),
top as (select *, row_number() over (partition by lang order by n desc, x) as r,
               sum(n) over (partition by lang) as total from wc),
rw as (select lang, x, n / total as q from top where r <= 100
       union all select lang, null, 1 - sum(n) / max(total) from top where r <= 100 group by lang),
dw as (select doc_id, x, count(*) as n from lw group by doc_id, x),
hits as (select dw.doc_id, rw.lang, rw.x, dw.n from dw join rw on dw.x = rw.x),
pw as (select w.doc_id, rw.lang, rw.q, case when rw.x is null
          then len(w.ws) - coalesce((s.n), 0) else coalesce(h.n, 0) end / greatest(len(w.ws), 1) as p
       from w cross join rw left join hits h on h.doc_id = w.doc_id and h.lang = rw.lang and h.x = rw.x
       left join (select doc_id, lang, sum(n) as n from hits group by doc_id, lang) s
         on s.doc_id = w.doc_id and s.lang = rw.lang),
jw as (select doc_id, min(sqrt(greatest((a + b) / 2, 0))) as dist from (
         select doc_id, lang, {_kl('p')} as a, {_kl('q')} as b from pw group by doc_id, lang) group by doc_id),
v as (select base.*, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
             ((coalesce(jc.dist, 0) > 0.3 and n_chars >= 200) or (coalesce(jw.dist, 0) > 0.5 and n_words >= 50))
               and not (script.other and alone.yes) as far
      from base left join jc using (doc_id) left join jw using (doc_id) left join script using (doc_id), alone)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not far as kept from v
"""


@query("op2_quality_rules", _QUALITY_SQL)
def op2_quality_rules(spark, sf):
    return quality_rules(load(spark, sf, "documents")).drop("char_distance", "word_distance")


@query("op7_crf_quality")
def op7_crf_quality(spark, sf):
    docs = load(spark, sf, "documents")
    return crf_quality.score(docs, crf_quality.fit(docs, load(spark, sf, "labels")))


@query("op6_byte_bpe")
def op6_byte_bpe(spark, sf):
    return encode_digests(load(spark, sf, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)


SHARDS, SLOTS = [f"shard-{i:03d}" for i in range(64)], 10_007


@query("op5_sharding", f"""
with t as (select unnest(range(0, {SLOTS})) as slot, unnest({lookup_table(SHARDS, SLOTS)}) as shard),
d as (select doc_id, cast(('0x' || md5(coalesce(cast(doc_id as varchar), ''))[1:15]) as bigint) % {SLOTS} as slot from documents)
select doc_id, slot, cast(shard as integer) as shard from d join t using (slot)
""")
def op5_sharding(spark, sf):
    return place(load(spark, sf, "documents").select("doc_id"), "doc_id", SHARDS, SLOTS)


_ESC = r"regexp_replace(coalesce(text, ''), '(\\|###|</turn>)', '\\\1', 'g')"


@query("op8_chat_format", f"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -7, 0, 'user', '\\### Assistant: </turn> ok'
           union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok')
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(sum(case when role = 'assistant' then len(text) else 0 end) as bigint) as loss_chars,
       sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '')) as loss_sha256,
       cast(sum(len(role) + len({_ESC}) + 14) as bigint) as formatted_chars
from c group by conv_id
""")
def op8_chat_format(spark, sf):
    rows = load(spark, sf, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    own = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], rows.schema)
    records = rows.unionByName(extra).select(F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("record"))
    return conversation_digests(canonical_turns(records, "record"))


@query("op3_embed_dedup", """
with recursive e as (select vec_id, cast(embedding as double[]) as v from embeddings),
ok as (select vec_id, v from e where v is not null and len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
       and len(list_filter(v, lambda x: x <> 0)) > 0),
links as (select a.vec_id as u, b.vec_id as w from ok a join ok b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
          where list_cosine_similarity(a.v, b.v) >= 0.95),
reach(a, b) as (select vec_id, vec_id from e union select r.a, l.w from reach r join links l on r.b = l.u),
c as (select a as vec_id, min(b) as component_id from reach group by a),
n as (select u as vec_id, count(*) as n from links group by u)
select vec_id, coalesce(n.n, 0) as n_links, component_id, vec_id = component_id as kept
from c left join n using (vec_id)
""")
def op3_embed_dedup(spark, sf):
    return near_vectors(load(spark, sf, "embeddings"))


def _assign_sql(step: int) -> str:
    """Nearest centroid of every vector, ties to the smaller number."""
    return f"""d{step} as (select rid, min({{'d': list_sum(list_transform(list_zip(e.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))),
                                            'c': c.c}}) as m from e cross join c{step} c group by rid)"""


def _update_sql(step: int) -> str:
    """Floor of the mean of every cluster; an empty one stays."""
    return f"""s{step} as (select c, i, sum(x) as s, count(*) as n from (
             select m.c as c, unnest(e.v) as x, unnest(range(1, 65)) as i from e join d{step} using (rid)) group by c, i),
u{step} as (select c, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as v from s{step} group by c),
c{step + 1} as (select c.c, coalesce(u.v, c.v) as v from c{step} c left join u{step} u on c.c = u.c)"""


@query("op11_centroids", f"""
with e as (select row_number() over () as rid, vec_id,
             list_transform(cast(embedding as double[]), lambda x: cast(floor(64 * x) as bigint)) as v
           from embeddings where len(embedding) = 64
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as (select c, v from (select row_number() over (order by sha256('1:' || cast(vec_id as varchar)), v) - 1 as c, v
                         from e where vec_id is not null) where c < 16),
{", ".join(f"{_assign_sql(k)}, {_update_sql(k)}" for k in range(3))},
{_assign_sql(3)},
r as (select vec_id, cast(m.c as integer) as cluster, cast(m.d as bigint) as distance from e join d3 using (rid))
select vec_id, cluster, distance, cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
       cast(sum(distance) over () as bigint) as inertia, sha256(array_to_string(c3.v, ',')) as centroid_sha256
from r join c3 on r.cluster = c3.c
""")
def op11_centroids(spark, sf):
    return cluster_report(load(spark, sf, "embeddings"))


@query("op12_whitening")
def op12_whitening(spark, sf):
    return whiten_vectors(load(spark, sf, "embeddings"))


@query("op13_anchor_dedup", f"""
with w as (select row_number() over () as rid, doc_id, coalesce(regexp_extract_all(text, {WORDS_RE}), []) as ws from documents),
k as (select rid, doc_id, s, md5(array_to_string(ws[s + 1:s + 13], ' ')) as h
      from (select rid, doc_id, ws, unnest(range(0, len(ws) - 12)) as s from w where len(ws) >= 13 and doc_id is not null)),
later as (select rid, s from (select rid, s, doc_id, min(doc_id) over (partition by h) as f from k) where doc_id > f),
gone as (select distinct rid, s + unnest(range(1, 14)) as i from later),
kept as (select rid, string_agg(x, ' ' order by i) as t from (
           select rid, unnest(ws) as x, unnest(range(1, len(ws) + 1)) as i from w) anti join gone using (rid, i) group by rid),
n as (select rid, count(*) as n from gone group by rid)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n.n, 0) as n_removed, sha256(coalesce(kept.t, '')) as kept_sha256
from w left join kept using (rid) left join n using (rid)
""")
def op13_anchor_dedup(spark, sf):
    return removal_digests(remove_repeats(load(spark, sf, "documents")))
