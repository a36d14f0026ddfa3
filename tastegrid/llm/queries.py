"""One query per operator, with production parameters, over the whole tables; and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.llm import (
    chat, clusters, decontaminate, fingerprints, lines, lm, minhash, mixing, partenum, relative, resampling, suffix, toxicity,
)
from tastegrid.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build):
    def run(spark, folder):
        return build(lambda table: configure(spark).read.parquet(f"{folder}/{table}.parquet"))

    QUERIES[build.__name__] = run
    return build


def crc_mod(column: str | Column, n: int) -> Column:
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string")) % n


@query
def op1_fingerprints(table):
    return fingerprints.fingerprint_documents(table("documents"))


@query
def op2_decontaminate(table):
    found = decontaminate.find_matches(table("documents").select("doc_id", "text"), table("benchmark"), drop_text=True)
    return found.select("doc_id", F.explode("matches").alias("m")).select(
        "doc_id", F.col("m.item").alias("item_id"), F.round("m.similarity", 6).alias("similarity"), "m.start_word", "m.n_words")


@query
def op3_suffix_dedup(table):
    return suffix.remove_repeats(table("documents"))


@query
def op4_toxicity(table):
    docs = table("documents").select("doc_id", "text")
    model = toxicity.fit(docs, table("labels"), crc_mod("doc_id", 5) != 0)
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), F.col("tox_score").alias("score"),
        (F.col("tox_score") >= 0.5).cast("int").alias("predicted"), "tox_tokens")


@query
def op5_line_dedup(table):
    out = lines.dedup_lines(table("documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "lines_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op6_relative_lz(table):
    return relative.remove_copied(table("documents"))


@query
def op7_chat_format(table):
    talk = table("conversations").select("conv_id", "turn", "role", "text")
    extra = talk.sparkSession.createDataFrame(
        [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], talk.schema)
    return chat.conversation_digests(chat.format_turns(talk.unionByName(extra)))


@query
def op8_interpolated_lm(table):
    part = crc_mod("doc_id", 7)
    out = lm.score_documents(table("documents"), part != 2, part == 5)
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score")


@query
def op9_probminhash(table):
    return minhash.near_classes(table("documents"))


# Target mixture of op10 and the pipeline. Domains are made of the sources' numbers.
LEVELS = {"domain": "case when length(source) <= 4 then 'web' else 'books' end", "lang": "lang", "source": "source"}
WEIGHTS = ["case when domain = 'web' then 0.6 else 0.4 end", "case when lang = 'en' then 4.0 else 2.0 end", "1.0"]
SHARE, EPOCHS, SEED = 0.6, 2, 17


def mixed(docs: DataFrame) -> DataFrame:
    return mixing.mix(docs, {n: F.expr(e) for n, e in LEVELS.items()}, [F.expr(w) for w in WEIGHTS], F.floor(F.sum("supply") * SHARE), EPOCHS, SEED)


@query
def op10_mix_sources(table):
    return mixed(table("documents").select("doc_id", "text", "lang", "source")).select(
        "doc_id", "domain", "lang", "source", "n_tokens", "copies")


@query
def op11_ngram_join(table):
    return partenum.jaccard_components(table("documents"))


# op12: percent drawn of the documents with enough words.
DRAWN, LEAST_WORDS, DRAW_SEED = 10, 20, 2024


@query
def op12_resample(table):
    return resampling.resample(table("documents"), table("benchmark"), DRAWN, DRAW_SEED, least_words=LEAST_WORDS).select(
        "doc_id", "n_features", "weight", "score", "rank")


CLUSTERS, ROUNDS, CLUSTER_SEED, DIMS, SCALE = 40, 5, 2, 64, 256


@query
def op13_centroids(table):
    return clusters.cluster_vectors(table("embeddings"), dims=DIMS, k=CLUSTERS, rounds=ROUNDS, seed=CLUSTER_SEED, scale=SCALE)


LINE_SQL = r"""
with raw as (
  select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents
), lines as (
  select doc_id, i, line, trim(line, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) as norm from raw
), ranked as (
  select *, row_number() over (partition by norm order by doc_id, i) as nth from lines where norm <> ''
), firsts as (
  select norm, doc_id, i, row_number() over (order by doc_id, i) as pos, string_split(norm, ' ') as w from ranked where nth = 1
), long as (select * from firsts where len(w) >= 8),
variants as (
  select norm, pos, k, array_to_string(list_concat(w[1:k - 1], w[k + 1:]), ' ') as v
  from (select norm, pos, w, unnest(range(1, len(w) + 1)) as k from long)
), near as (
  select norm from (select norm, pos, min(pos) over (partition by v, k) as best from variants) where best < pos
  union select x.norm from variants x join long y on x.v = y.norm where y.pos < x.pos
  union select y.norm from variants x join long y on x.v = y.norm where x.pos < y.pos
), kept as (
  select l.doc_id, l.i, l.line from lines l left join ranked r on l.doc_id = r.doc_id and l.i = r.i
  where l.norm = '' or (r.nth = 1 and l.norm not in (select norm from near))
), texts as (select doc_id, count(*) as n, string_agg(line, chr(10) order by i) as text from kept group by doc_id)
select d.doc_id, cast(len(string_split(d.text, chr(10))) as bigint) as n_lines,
  cast(len(string_split(d.text, chr(10))) - coalesce(t.n, 0) as bigint) as lines_removed,
  sha256(coalesce(t.text, '')) as kept_sha256
from documents d left join texts t on d.doc_id = t.doc_id
"""


def _deal_sql(name: str, parent: str, keys: str, last: str, weight: str) -> str:
    """SQL of one level of ``mixing.deal``: budgets of the children in table ``name`` from table ``parent``."""
    on = f"using ({parent[1]})" if parent[1] else "on true"
    group = parent[1] or "1"
    return f"""
{name}_w as (select c.*, p.allotted, cast({weight} as double) as w from (
  select {keys}, sum(capacity) as capacity from leaves group by {keys}) c join {parent[0]} p {on}),
{name}_l as (select *,
  allotted - coalesce(sum(capacity) over (partition by {group} order by capacity / w, {last} rows between unbounded preceding and 1 preceding), 0) as r,
  sum(w) over (partition by {group} order by capacity / w, {last} rows between current row and unbounded following) as ws from {name}_w),
{name}_v as (select *, max(case when capacity * ws > r * w then r / ws end) over (partition by {group}) as level from {name}_l),
{name} as (select {keys}, case when level is null then cast(capacity as double) else least(cast(capacity as double), w * level) end as allotted from {name}_v)"""


MIX_SQL = rf"""
with docs as (
  select doc_id, case when length(source) <= 4 then 'web' else 'books' end as domain, lang, source,
    cast(len(regexp_extract_all(text, '[^ \t-\r]+')) as bigint) as n_tokens from documents
), leaves as (
  select domain, lang, source, sum(n_tokens) as supply, cast(sum(n_tokens) * {EPOCHS} as double) as capacity
  from docs group by domain, lang, source
), root as (select least(sum(capacity), floor(sum(supply) * {SHARE})) as allotted from leaves),
{_deal_sql("domains", ("root", ""), "domain", "domain", "case when domain = 'web' then 0.6 else 0.4 end")},
{_deal_sql("langs", ("domains", "domain"), "domain, lang", "lang", "case when lang = 'en' then 4.0 else 2.0 end")},
{_deal_sql("sources", ("langs", "domain, lang"), "domain, lang, source", "source", "1.0")},
plan as (
  select domain, lang, source, supply, cast(floor(allotted + 1e-6) as bigint) as budget,
    cast(floor(cast(floor(allotted + 1e-6) as bigint) / supply) as bigint) as epochs
  from sources join leaves using (domain, lang, source)
), placed as (
  select d.*, p.epochs, p.budget - p.epochs * p.supply as rest,
    sum(n_tokens) over (partition by d.domain, d.lang, d.source
      order by md5('{SEED}|' || p.epochs || '|' || d.doc_id), n_tokens rows between unbounded preceding and current row) as running
  from docs d join plan p using (domain, lang, source)
)
select doc_id, domain, lang, source, n_tokens, cast(epochs + case when running <= rest then 1 else 0 end as bigint) as copies
from placed where epochs + case when running <= rest then 1 else 0 end > 0
"""

JOIN_SQL = rf"""
with recursive docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents
), sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < {partenum.SHINGLE} then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - {partenum.SHINGLE} + 2), lambda i: array_to_string(w[i:i + {partenum.SHINGLE - 1}], ' ')) end) as s from docs
), sizes as (select doc_id, len(s) as n from sets),
shingles as (select doc_id, unnest(s) as g from sets),
links as materialized (
  select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as k from shingles x join shingles y on x.g = y.g and x.doc_id <> y.doc_id
    group by x.doc_id, y.doc_id) p join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * k >= {partenum.PERCENT} * (x.n + y.n - k)
), reached(doc_id, other) as (
  select doc_id, doc_id from docs union select r.doc_id, l.b from reached r join links l on l.a = r.other
)
select doc_id, cast(n as bigint) as n_shingles, least_id as component_id, size as component_size
from sizes join (select doc_id, min(other) as least_id, count(*) as size from reached group by doc_id) using (doc_id)
"""

RESAMPLE_SQL = rf"""
with crc as (  -- CRC-32 of every byte, from the polynomial
  select list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
), docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as words from documents
), wanted as (
  select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) as w from benchmark
), found as (select doc_id, unnest(words) as w from docs),
bytes as (
  select w, list_transform(range(0, len(hex(w)) // 2), lambda i: cast('0x' || substr(hex(w), 2 * i + 1, 2) as bigint)) as b
  from (select w from found union select w from wanted)
), hashed as (
  select w, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(t[xor(c & 255, x) + 1], c >> 8)), 4294967295) % 10000 as bucket
  from bytes, crc
), s as (select bucket, count(*) as s from found join hashed using (w) group by bucket),
t as (select bucket, count(*) as t from wanted join hashed using (w) group by bucket),
gains as (
  select bucket, cast(floor(1000 * ln((coalesce(t, 0) + 1) * ((select coalesce(sum(s), 0) from s) + 10000)::double
    / ((coalesce(s, 0) + 1) * ((select coalesce(sum(t), 0) from t) + 10000)::double))) as bigint) as gain from s full join t using (bucket)
), weights as (select doc_id, cast(sum(gain) as bigint) as weight from found join hashed using (w) join gains using (bucket) group by doc_id),
scored as (
  select doc_id, cast(len(words) as bigint) as n_features, coalesce(weight, 0) as weight, coalesce(weight, 0) + cast(floor(-1000 * ln(-ln(
    (cast('0x' || substr(sha256('{DRAW_SEED}:' || doc_id), 1, 8) as bigint) + 0.5::double) / 4294967296))) as bigint) as score
  from docs left join weights using (doc_id)
), placed as (
  select *, row_number() over (partition by n_features >= {LEAST_WORDS} order by score desc, doc_id) as place from scored
)
select doc_id, n_features, weight, score, case when n_features >= {LEAST_WORDS}
  and place <= (select count(*) * {DRAWN} // 100 from scored where n_features >= {LEAST_WORDS}) then place end as rank from placed
"""


def _cluster_sql() -> str:
    """SQL of op13: one pair of CTEs a round, nearest centroids and their floored means."""
    def near(turn: int) -> str:
        return f"""
a{turn} as materialized (select r, c, d from (
  select n.r, m.c, d, row_number() over (partition by n.r order by d, m.c) as k from (
    select n.r, m.c, list_sum(list_transform(list_zip(n.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d
    from vecs n, c{turn} m) n join c{turn} m using (c)) where k = 1)"""

    parts = [f"""
with vecs as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * x::double) as bigint)) as v
  from embeddings where len(embedding) = {DIMS} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {DIMS}
), c0 as materialized (
  select c, v from (select v, row_number() over (order by sha256('{CLUSTER_SEED}:' || vec_id), v) - 1 as c from vecs) where c < {CLUSTERS}
)"""]
    for turn in range(ROUNDS):
        parts.append(near(turn))
        parts.append(f"""
c{turn + 1} as materialized (select c.c, coalesce(m.v, c.v) as v from c{turn} c left join (
  select c, list(cast((s - ((s % n) + n) % n) // n as bigint) order by place) as v from (
    select c, place, sum(x) as s, count(*) as n from (
      select a.c, unnest(n.v) as x, generate_subscripts(n.v, 1) as place from a{turn} a join vecs n using (r)) group by c, place) group by c
  ) m on c.c = m.c)""")
    parts.append(near(ROUNDS))
    return ",".join(parts) + f"""
select vec_id, cast(a.c as integer) as cluster, cast(d as bigint) as distance, cast(sum(d) over (partition by a.c) as bigint) as cluster_inertia,
  cast(sum(d) over () as bigint) as inertia, sha256(array_to_string(m.v, ',')) as centroid_sha256
from a{ROUNDS} a join vecs using (r) join c{ROUNDS} m on a.c = m.c"""


SQL = {"op5_line_dedup": LINE_SQL, "op10_mix_sources": MIX_SQL, "op11_ngram_join": JOIN_SQL, "op12_resample": RESAMPLE_SQL, "op13_centroids": _cluster_sql()}
