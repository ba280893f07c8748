"""The operators of this package as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.llm import forest, html, mixing, negatives, neighbours, passages, quality, rules, runs, sharding, suffixes, threshold, tokenize
from talkloom.sources.scratch import keep

RANKS = "byte_bpe_multi_50k.tiktoken"
SHARDS = 8


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_learned_partitions(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), store=keep)


def op2_suffix_array(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.digests(suffixes.repeated_bytes(_table(spark, sf, "documents"), keep))


def op3_html_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages")
    return html.extract_text(pages, html.fit_weights(pages))


def op4_mixing(spark: SparkSession, sf: str) -> DataFrame:
    drawn = mixing.sampled(_table(spark, sf, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return drawn.select("doc_id", "size", "source_size", "target", taken)


def op5_passages(spark: SparkSession, sf: str) -> DataFrame:
    return passages.digests(passages.repeated_words(_table(spark, sf, "documents"), keep))


def op6_lsh_forest(spark: SparkSession, sf: str) -> DataFrame:
    return forest.near_duplicates(_table(spark, sf, "documents"), keep).drop("version", "first")


def op7_site_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    fitted = quality.fit_sites(docs, _table(spark, sf, "labels"), lambda df: keep(df, "sites"))
    scored = quality.classify(docs.select("doc_id", "source", "lang", "text"), fitted)
    return scored.select("row.doc_id", "evidence", "score", "kept")


def op8_isolation_forest(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return rules.quality_rules(docs, rules.fit_on_sample(docs, _table(spark, sf, "labels")))


def op9_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    return tokenize.token_digests(_table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)


def op10_virtual_slots(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    placed = sharding.shard(docs, lambda df: keep(df, "slot-map"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("place").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return runs.digests(runs.periodic_runs(docs, order=runs.planted_order))


def op12_threshold_search(spark: SparkSession, sf: str) -> DataFrame:
    return threshold.top_k(_table(spark, sf, "embeddings"), F.col("id") % 50 == 0, keep)


def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, sf, "embeddings"), F.col("id") % 50 == 0, keep, label=label)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_learned_partitions, op2_suffix_array, op3_html_text, op4_mixing, op5_passages,
        op6_lsh_forest, op7_site_quality, op8_isolation_forest, op9_byte_bpe, op10_virtual_slots,
        op11_periodic_runs, op12_threshold_search, op13_hard_negatives,
    ]
    return {query.__name__: query for query in found}


_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

_MIXING = rf"""
with d as (
    select doc_id, source, len({_WORDS.format("text")})::bigint as size,
           ('0x' || substr(md5(concat_ws('|', doc_id::varchar, md5(text))), 1, 8))::bigint as salt
    from documents),
b as (select greatest(16, ceil(sqrt(count(*)) / 20))::bigint as spread from documents),
s as (
    select source, sum(size)::bigint as source_size,
           (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
    from d group by source),
r as (
    select *, 3 * source_size as cap, sum(source_size) over () as total,
           sum(weight) over () as all_weight, sum(3 * source_size) over w as cap_here,
           sum(weight) over w as weight_here
    from s window w as (
        order by (3 * source_size)::double / weight, source nulls last rows unbounded preceding)),
c as (
    select *, (total - (cap_here - cap)) * weight
              >= cap * (all_weight - (weight_here - weight)) as capped
    from r),
t as (
    select source, source_size,
           case when capped then cap::double
                else (total - coalesce(sum(case when capped then cap end) over (), 0))::double
                     * weight / sum(case when not capped then weight end) over () end as target
    from c),
p as (
    select *, row_number() over (
        partition by source
        order by (length(bin(size + 1)) * 16 + ((size + 1) * 16 >> (length(bin(size + 1)) - 1)))
                 * spread + salt % spread,
                 size, doc_id) as place
    from d, b),
q as (
    select doc_id, size, source_size, target, place,
           case when source_size > 0 then target / source_size else 0 end as rate,
           ('0x' || substr(md5('mix|' || coalesce(p.source, chr(0))), 1, 8))::bigint
               / 4294967296.0::double as off
    from p join t on p.source is not distinct from t.source)
select doc_id, size, source_size, target,
       ((floor(rate * place + off) - floor(rate * (place - 1) + off)) * size)::bigint as taken
from q"""

_PASSAGES = rf"""
with d as (select doc_id, {_WORDS.format("text")} as w from documents),
n as (
    select doc_id, i, md5(array_to_string(w[i : i + 12], ' ')) as h
    from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d)),
f as (select h, min(doc_id) as least from n group by h),
g as (
    select distinct doc_id, unnest(range(i, i + 13)) as i
    from n join f using (h) where least < doc_id),
k as (
    select doc_id, i, w[i] as word from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from d)),
j as (
    select k.doc_id, string_agg(word, ' ' order by k.i) as kept, count(*) as n_kept
    from k left join g on k.doc_id = g.doc_id and k.i = g.i where g.i is null group by 1)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n_kept, 0))::bigint as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from d left join j using (doc_id)"""

_BYTES = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
n as (
    select doc_id, i, md5(substr(x, 2 * i + 1, 200)) as h
    from (select doc_id, x, unnest(range(0, length(x) // 2 - 99)) as i from d)),
f as (select *, row_number() over (partition by h order by doc_id, i) as place from n),
s as (
    select *, case when i <= lag(i) over (partition by doc_id order by i) + 100
                   then 0 else 1 end as fresh
    from f where place > 1),
u as (select doc_id, i, sum(fresh) over (partition by doc_id order by i) as run from s),
v as (select doc_id, run, min(i) as a, max(i) + 100 as b from u group by all),
z as (
    select doc_id, run, a, b, lead(a) over (partition by doc_id order by a) as following from v),
j as (
    select doc_id, sum(b - a)::bigint as n_removed, count(*)::bigint as n_spans, min(a) as head,
           string_agg(substr(x, 2 * b + 1, 2 * (coalesce(following, length(x) // 2) - b)), ''
                      order by a) as tail
    from z join d using (doc_id) group by doc_id)
select doc_id, (length(x) // 2)::bigint as n_bytes, coalesce(n_removed, 0) as n_removed,
       coalesce(n_spans, 0) as n_spans,
       sha256(unhex(case when head is null then x else substr(x, 1, 2 * head) || tail end))
           as kept_sha256
from d left join j using (doc_id)"""

_NEAR = rf"""
with recursive d as (
    select doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w
    from documents),
g as (
    select distinct doc_id, md5(array_to_string(w[i : i + 4], ' ')) as h
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i
          from d where len(w) > 0)),
n as (select doc_id, count(*) as n from g group by doc_id),
p as (
    select x.doc_id as a, y.doc_id as b, count(*) as common
    from g x join g y on x.h = y.h and x.doc_id < y.doc_id group by all),
e as (
    select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b
    where 100 * common >= 75 * (x.n + y.n - common)),
l as (select a, b from e union select b, a from e),
r(node, reached) as (
    select doc_id, doc_id from d
    union
    select r.node, l.b from r join l on l.a = r.reached),
c as (select node, min(reached) as component_id from r group by node)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, component_id,
       d.doc_id = component_id as kept
from d join c on c.node = d.doc_id left join n using (doc_id)"""


_WHOLE = "list_transform(embedding, lambda x: floor(256 * x::double))"
_FINE = "embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))"

_TOP = f"""
with v as (select vec_id, {_WHOLE} as x from embeddings where {_FINE}),
s as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.x, c.x)::bigint as score
    from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank,
       vec_id, score
from s qualify rank <= 5"""

_NEGATIVES = f"""
with v as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, {_WHOLE} as x
    from embeddings where label is not null and {_FINE}),
s as (
    select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
           list_inner_product(a.x, c.x)::bigint as score
    from v a join v c on a.vec_id % 50 = 0 and a.vec_id <> c.vec_id),
p as (
    select anchor_id, vec_id as positive_id, score as positive_score from s where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id,
       row_number() over (
           partition by p.anchor_id, positive_id order by score desc, vec_id)::int as rank,
       vec_id as negative_id, positive_score, score as negative_score
from p join s on s.anchor_id = p.anchor_id and not same
     and 100 * score between 50 * positive_score and 95 * positive_score
qualify rank <= 3"""

# A run is a stretch in which words q apart are equal, an island of equal pairs at distance q; it counts if no
# run of a smaller period holds it. The checksum of an id is folded byte by byte, bit by bit.
_CRC = """list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii(substr(doc_id::varchar, i, 1))::bigint)),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), range(8)),
        lambda c, step: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end))"""
_RUNS = rf"""
with d as (
    select doc_id, w, len(w) as n, xor({_CRC}, 4294967295) as h
    from (select doc_id, {_WORDS.format("text")} as w from documents)),
e as (
    select doc_id, w, n, h % 10 = 0 and n > 0 as planted,
           case when n > 0 then (h // 10) % n end as a, 3 + (h // 10) % 8 as parts from d),
f as (
    select doc_id, n,
           case when planted then list_transform(range(0, n), lambda i: w[1 + case when i < a then i
                    else a + (i - a) % (1 + (n - a) // parts) end]) else w end as w from e),
g as (select doc_id, n, i, w[i + 1] as word from (select *, unnest(range(0, n)) as i from f)),
m as (
    select x.doc_id, y.i - x.i as q, x.i from g x join g y
        on x.doc_id = y.doc_id and x.word = y.word and y.i > x.i and 4 * (y.i - x.i) <= x.n),
o as (select *, i - row_number() over (partition by doc_id, q order by i) as island from m),
s as (
    select doc_id, q as period, min(i) as start, count(*) + q as length from o group by doc_id, q, island
    having count(*) + q >= greatest(6, 4 * q)),
r as (
    select * from s where not exists (
        select 1 from s t where t.doc_id = s.doc_id and t.period < s.period
            and t.start <= s.start and t.start + t.length >= s.start + s.length)),
t as (
    select doc_id, count(*) as n_runs,
           string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines,
           arg_min(struct_pack(start, length, period), [-length, start, period]) as best
    from r group by doc_id),
u as (select distinct doc_id, unnest(range(start + period, start + length)) as i from r),
k as (
    select g.doc_id, string_agg(word, ' ' order by g.i) as kept
    from g left join u on g.doc_id = u.doc_id and g.i = u.i where u.i is null group by 1)
select d.doc_id, coalesce(n_runs, 0)::bigint as n_runs, best.start::bigint as start,
       best.length::bigint as length, best.period::bigint as period,
       (1000 * best.length // best.period)::bigint as exponent_milli,
       sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(kept, '')) as collapsed_sha256
from d left join t using (doc_id) left join k using (doc_id)"""


def oracle_sql() -> dict[str, str]:
    """Where SQL can express an operator: classifiers, checksums and token ids it cannot."""
    return {
        "op2_suffix_array": _BYTES,
        "op4_mixing": _MIXING,
        "op5_passages": _PASSAGES,
        "op6_lsh_forest": _NEAR,
        "op11_periodic_runs": _RUNS,
        "op12_threshold_search": _TOP,
        "op13_hard_negatives": _NEGATIVES,
    }
