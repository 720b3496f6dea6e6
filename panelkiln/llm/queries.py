"""One query for each operator over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, filter_audit, fuzzy_hash, line_dedup, merkle, ngram_join, packing, pseudo_likelihood, sharding, substring_dedup, token_counts, toxicity, vector_dedup
from .common import table


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), k=20, with_text=False)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"), least=0.98)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.corpus_rollup(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(table(spark, sf_dir, "documents"), least=10, with_text=False)


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pseudo_likelihood.score(docs, pseudo_likelihood.fit(docs))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=40)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), capacity=1024, end_id=2)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_texts(table(spark, sf_dir, "documents"), least=0.8, w=5).select("doc_id", "class_id", "n_links", "n_shingles", "kept")


def op11_merkle_dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    return merkle.audit(table(spark, sf_dir, "documents"), tampered)


def op12_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_hash.following_texts(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_benchmark_decontamination, op2_substring_dedup, op3_toxicity, op4_embedding_near_dedup, op5_token_counts, op6_line_dedup, op7_lm_scoring, op8_sharding, op9_best_fit_packing, op10_ngram_jaccard_join, op11_merkle_dataset_manifest, op12_filter_interaction_audit, op13_document_fingerprints)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_RAW = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# bit by bit, from the definition of the checksum
_CRC32 = "xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda s: ascii(s)::bigint), lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(c, b)), 4294967295::bigint), 4294967295)"
_RUNS = "list_transform(range(0, (len(d) + 2) // 3), lambda i: sha256(array_to_string(d[3 * i + 1:3 * i + 3], '')))"
_SIDES = "array_to_string(d[i // 3 * 3 + 1:i], '') || '|' || array_to_string(d[i + 2:i // 3 * 3 + 3], '') as sides"

SQL = {
    "op1_benchmark_decontamination": f"""
with b as (select item_id, {_WORDS} as t from benchmark),
bk as (select item_id, t, least(len(t), 10) as k from b where len(t) > 0),
bw as (select distinct item_id, k, unnest(list_transform(range(1, len(t) - k + 2), lambda i: array_to_string(t[i:i + k - 1], ' '))) as p from bk),
d as (select doc_id, {_WORDS} as t from documents),
dk as (select doc_id, t, k from d, (select distinct k from bw) where len(t) >= k),
dw as (select doc_id, k, unnest(range(1, len(t) - k + 2)) as s, unnest(list_transform(range(1, len(t) - k + 2), lambda i: array_to_string(t[i:i + k - 1], ' '))) as p from dk),
hits as (select doc_id, dw.k, s, item_id from dw join bw on dw.k = bw.k and dw.p = bw.p),
covered as (select doc_id, count(distinct w) as n from (select doc_id, unnest(range(s, s + k)) as w from hits) group by doc_id),
items as (select doc_id, count(*) as n, string_agg(i, ',' order by i) as l from (select distinct doc_id, item_id::varchar as i from hits) group by doc_id)
select d.doc_id, len(t)::bigint as n_words, coalesce(c.n, 0)::bigint as n_hit, coalesce(i.n, 0)::bigint as n_items, sha256(coalesce(i.l, '')) as items_sha256, coalesce(c.n, 0) > 0 as contaminated
from d left join covered c using (doc_id) left join items i using (doc_id)""",
    "op2_substring_dedup": f"""
with d as (select doc_id, {_RAW} as t from documents),
w as (select doc_id, unnest(range(1, len(t) - 18)) as s, unnest(list_transform(range(1, len(t) - 18), lambda i: array_to_string(t[i:i + 19], ' '))) as p from d where len(t) >= 20),
r as (select doc_id, s, row_number() over (partition by p order by doc_id, s) as n from w),
gone as (select distinct doc_id, unnest(range(s, s + 20)) as pos from r where n > 1),
words as (select doc_id, unnest(t) as word, unnest(range(1, len(t) + 1)) as pos from d),
kept as (select doc_id, string_agg(word, ' ' order by pos) as k from words anti join gone using (doc_id, pos) group by doc_id),
lost as (select doc_id, count(*) as n from gone group by doc_id)
select d.doc_id, len(t)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(k, '')) as kept_sha256 from d left join kept using (doc_id) left join lost using (doc_id)""",
    "op4_embedding_near_dedup": """
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings where label is not null and embedding is not null and len(embedding) > 0 and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))) and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
n as (select *, sqrt(list_dot_product(e, e)) as z from v),
l as (select a.vec_id as a, b.vec_id as b from n a join n b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_dot_product(a.e, b.e) / (a.z * b.z) >= 0.98),
reach as (select distinct a, a as b from l union select r.a, l.b from reach r join l on r.b = l.a),
c as (select a, min(b) as component_id from reach group by a),
k as (select a, count(*) as n from l group by a)
select vec_id, coalesce(k.n, 0)::bigint as n_links, coalesce(component_id, vec_id) as component_id, coalesce(component_id, vec_id) = vec_id as kept from embeddings left join c on c.a = vec_id left join k on k.a = vec_id""",
    "op6_line_dedup": """
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
u as (select doc_id, unnest(l) as line, unnest(range(1, len(l) + 1)) as pos from d),
x as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from u),
f as (select *, length(k) >= 10 and doc_id > min(doc_id) over (partition by k) as gone from x),
s as (select doc_id, count(*) as n, count(*) filter (gone) as g, string_agg(line, chr(10) order by pos) filter (not gone) as kept from f group by doc_id)
select doc_id, n::bigint as n_lines, g::bigint as n_dropped, sha256(coalesce(kept, '')) as kept_sha256 from s""",
    "op10_ngram_jaccard_join": f"""
with recursive d as (select doc_id, {_RAW} as t from documents),
s as (select distinct doc_id, unnest(case when len(t) >= 5 then list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i + 4], ' ')) when len(t) > 0 then [array_to_string(t, ' ')] else [] end) as p, case when len(t) < 5 then len(t) else 5 end as w from d),
n as (select doc_id, count(*) as n from s group by doc_id),
i as (select a.doc_id as a, b.doc_id as b, count(*) as m from s a join s b on a.p = b.p and a.w = b.w and a.doc_id <> b.doc_id group by 1, 2),
l as (select a, b from i join n x on x.doc_id = a join n y on y.doc_id = b where 5 * m >= 4 * (x.n + y.n - m)),
reach as (select distinct a, a as b from l union select r.a, l.b from reach r join l on r.b = l.a),
c as (select a, min(b) as class_id from reach group by a),
k as (select a, count(*) as n from l group by a)
select d.doc_id, coalesce(class_id, d.doc_id) as class_id, coalesce(k.n, 0)::bigint as n_links, coalesce(n.n, 0)::bigint as n_shingles, coalesce(class_id, d.doc_id) = d.doc_id as kept from d left join c on c.a = d.doc_id left join k on k.a = d.doc_id left join n on n.doc_id = d.doc_id""",
    "op11_merkle_dataset_manifest": f"""
with recursive r as (select doc_id, source, {_leaf('text')} as leaf, case when {_CRC32} % 2 = 0 then {_leaf("replace(text, chr(10), '')")} else {_leaf('text')} end as changed, row_number() over (partition by source order by doc_id nulls first, {_leaf('text')}) - 1 as pos from documents),
lv as (select source, 0 as l, list(leaf order by pos) as d from r group by source union all select source, l + 1, {_RUNS} from lv where len(d) > 1),
sub as (select source, d[1] as subroot, row_number() over (order by source nulls first) - 1 as pos from lv where len(d) = 1),
tv as (select 0 as l, list(subroot order by pos) as d from sub union all select l + 1, {_RUNS} from tv where len(d) > 1),
low as (select source, pos, l, {_SIDES} from (select r.source, r.pos, l, d, r.pos // (3 ** l)::bigint as i from r join lv on r.source is not distinct from lv.source where len(d) > 1)),
top as (select source, l + 1000 as l, {_SIDES} from (select source, l, d, pos // (3 ** l)::bigint as i from sub, tv where len(d) > 1)),
steps as (select * from low union all select r.source, r.pos, l, sides from r join top on r.source is not distinct from top.source),
paths as (select source, pos, list(sides order by l) as path from steps group by source, pos),
whole as (select r.*, coalesce(path, []) as path, subroot, (select d[1] from tv where len(d) = 1) as root from r left join paths p on r.source is not distinct from p.source and r.pos = p.pos join sub on r.source is not distinct from sub.source),
folds as (select *, list_reduce(path, lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2)), changed) as folded_root from whole)
select doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) as proof_sha256, folded_root, folded_root = root as verified from folds""",
    "op12_filter_interaction_audit": f"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, {_RAW} as w from documents),
f as (select doc_id, part, (len(w) < 100)::int + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::int + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t))::int + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * coalesce(doc_id > min(doc_id) over (partition by t), false)::int as m from d),
lab as (select doc_id, max((quality = 1)::int) as g, max((toxic = 1)::int) as x from labels group by doc_id),
s as (select part, m, count(*) as n, count(*) filter (g = 1) as g, count(*) filter (x = 1) as x from f left join lab using (doc_id) group by part, m),
one as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(c, bit)),
o as (select a.c || b.c || c.c || e.c || h.c as o from one a, one b, one c, one e, one h where len(list_distinct([a.c, b.c, c.c, e.c, h.c])) = 5),
st as (select o, k::int as step, bit as own, coalesce((select sum(bit) from one where instr(substr(o, 1, k - 1), c) > 0), 0)::int as was from o, range(1, 6) r(k), one where c = substr(o, k, 1)),
e as (select part, o as filter_order, step, own, sum(n) filter (m & (was | own) = 0) as kept, sum(n) filter (m & own <> 0 and m & was = 0) as removed, sum(n) filter (m & own <> 0 and m & was <> 0) as redundant, sum(n) filter (m = own) as unique_fails, sum(g) filter (m & own <> 0 and m & was = 0) as good_lost, sum(x) filter (m & own <> 0 and m & was = 0) as toxic_lost from s, st group by part, o, step, own)
select part, filter_order, step, {", ".join(f"coalesce({c}, 0)::bigint as {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))}, coalesce(sum(removed) over (partition by part, own), 0)::bigint as shapley from e""",
}
