"""Registered queries of this package, one an operator, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (budget_mix, cover_anchors, four_russians, fuzzy_lines, merkle_manifest, mil_quality, multi_index_hash, odd_sketch,
               order_minhash, piece_viterbi, preference_chat, secret_scan, toxicity)
from .common import hex_digest, table


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mil_quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")) \
        .withColumnRenamed("id", "doc_id")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_spans(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.RULES if r.base]
    counts = [F.expr(f"cast(size(filter(spans, x -> x.kind = {i})) as bigint)").alias(f"n_{k}")
              for i, k in enumerate(base)]
    return found.withColumn("_base", F.expr(f"filter(spans, x -> x.kind < {len(base)})")).select(
        F.col("id").alias("doc_id"), *counts, hex_digest(secret_scan.joined("_base")).alias("base_sha256"),
        secret_scan.joined("spans").alias("spans"))


def op4_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op5_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen, rejected = preference_chat.swapped_replies(table(spark, sf_dir, "conversations"))
    return preference_chat.preference_pairs(chosen, rejected).select(
        "pair_id", "n_prompt_turns", *[hex_digest(F.col(c)).alias(f"{c}_sha256") for c in ("prompt", "chosen", "rejected")],
        "chosen_spans", "rejected_spans")


def op6_budget_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget_mix.mix(budget_mix.with_tree(table(spark, sf_dir, "documents")), budget_mix.LEVELS) \
        .withColumnRenamed("id", "doc_id")


def op7_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_viterbi.digests(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")) \
        .withColumnRenamed("id", "doc_id")


def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lines = fuzzy_lines.dropped_lines(docs).groupBy("id").agg(
        F.count("*").alias("n"), F.sum(F.col("drop").cast("bigint")).alias("gone"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("drop"), F.col("at")))), ",").alias("dropped"))
    ids = docs.select("doc_id")
    return ids.join(lines, ids["doc_id"].eqNullSafe(lines["id"]), "left").select(
        "doc_id", F.coalesce("n", F.lit(0)).alias("n_lines"), F.coalesce("gone", F.lit(0)).alias("n_dropped"),
        F.coalesce("dropped", F.lit("")).alias("dropped"))


def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return multi_index_hash.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op11_merkle_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in merkle_manifest.FIELDS]
    altered = [F.expr("replace(text, '\n', '')") if c == "text" else F.col(c) for c in merkle_manifest.FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    leaf = merkle_manifest.leaf_digest(fields)
    rows = docs.select("doc_id", "source", leaf.alias("leaf"),
                       F.when(tampered & F.contains("text", F.lit("\n")), merkle_manifest.leaf_digest(altered))
                       .otherwise(leaf).alias("held"))
    found = merkle_manifest.proofs(merkle_manifest.manifest(rows))
    others = F.flatten(F.transform("proof", lambda s: s["others"]))
    return found.select(
        "doc_id", "leaf", "subroot", "root", hex_digest(F.array_join(others, "")).alias("proof_sha256"),
        merkle_manifest.folded(F.col("held"), F.col("proof")).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_cover_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_anchors.without_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", hex_digest(F.col("text")).alias("kept_sha256"))


def op13_four_russians(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return four_russians.hard_negatives(vectors.select("vec_id", "embedding", moved.alias("label")), F.col("id") % 100 == 0)


QUERIES = {f.__name__: f for f in (
    op1_order_minhash, op2_quality_attention, op3_secret_scan, op4_odd_sketch, op5_preference_chat, op6_budget_mix,
    op7_piece_viterbi, op8_toxicity, op9_fuzzy_lines, op10_multi_index, op11_merkle_descent,
    op12_cover_anchors, op13_four_russians)}


def _secret_sql() -> str:
    parts = []
    for i, r in enumerate(secret_scan.RULES):
        p = r.pattern.replace("'", "''")
        parts.append(f"""
    select doc_id, {i} ord, '{r.kind}' kind, i, m, p, g from (
      select doc_id, m, p, g, unnest(range(1, len(m) + 1)) i from (
        select doc_id, regexp_extract_all(coalesce(text, ''), '{p}') m,
               regexp_extract_all(coalesce(text, ''), '{p}', {r.group}) g,
               string_split_regex(coalesce(text, ''), '{p}') p from documents))
    where length(g[i]) >= {r.least}""")
    return f"""
with found as ({' union all '.join(parts)}),
placed as (
  select doc_id, ord, kind,
    cast(list_sum(list_transform(p[1:i], lambda x: length(x))) as bigint)
      + cast(coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as bigint) s,
    length(m[i]) n from found),
named as (select doc_id, ord, s, kind || ':' || s || ':' || (s + n) as span from placed),
per as (
  select doc_id, string_agg(span, ',' order by s, ord) as spans,
    string_agg(span, ',' order by s, ord) filter (where ord < 3) as base,
    count(*) filter (where ord = 0) a, count(*) filter (where ord = 1) k, count(*) filter (where ord = 2) h
  from named group by doc_id)
select d.doc_id, coalesce(a, 0) as n_assign, coalesce(k, 0) as n_access, coalesce(h, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join per using (doc_id)"""


_NEAR_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
grams as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) g from words),
sizes as (select doc_id, count(*) n from grams group by doc_id),
common as (select a.doc_id a, b.doc_id b, count(*) k from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id
  group by 1, 2),
links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * k >= 75 * (x.n + y.n - k)),
reach as (select doc_id, doc_id c from sizes union select l.b, r.c from reach r join links l on l.a = r.doc_id),
comp as (select doc_id, min(c) c from reach group by doc_id)
select d.doc_id, coalesce(n, 0) as n_shingles, coalesce(c, d.doc_id) as component_id,
  coalesce(c, d.doc_id) = d.doc_id as kept
from documents d left join sizes using (doc_id) left join comp using (doc_id)"""

_LINES_SQL = f"""
with recursive lines as (
  select doc_id, i - 1 as pos, l[i] line from (
    select doc_id, l, unnest(range(1, len(l) + 1)) i from (
      select doc_id, string_split(text, chr(10)) l from documents))
  where trim(l[i], ' ' || chr(9) || chr(13)) <> ''),
firsts as (select line, min({{'d': doc_id, 'a': pos}}) f, row_number() over (order by line) k from lines group by line),
grams as (select distinct k, unnest(list_transform(range(1, greatest(length(line) - {fuzzy_lines.CHARS - 2}, 2)),
  lambda i: substring(line, i, {fuzzy_lines.CHARS}))) g from firsts),
sizes as (select k, count(*) n from grams group by k),
ranked as (select k, g, row_number() over (partition by k order by df, g) r
  from grams join (select g, count(*) df from grams group by g) using (g)),
-- near lines share one of the rarest shingles: any c of n >= c leave at most n - c outside
rare as (select k, g from ranked join sizes using (k) where r <= n - ceil({fuzzy_lines.SIMILARITY} * n) + 1),
pairs as (select distinct a.k a, b.k b from rare a join rare b on a.g = b.g and a.k < b.k),
close as (select a, b, x.n + y.n s from pairs join sizes x on x.k = a join sizes y on y.k = b
  where least(x.n, y.n) >= {fuzzy_lines.SIMILARITY} * greatest(x.n, y.n)),
common as (select a, b, s, count(*) c from close join grams x on x.k = a join grams y on y.k = b and x.g = y.g group by a, b, s),
ties as (select a, b from common where c >= {fuzzy_lines.SIMILARITY} * (s - c)),
links as (select a, b from ties union all select b, a from ties),
reach as (select k, k c from firsts union select l.b, r.c from reach r join links l on l.a = r.k),
comp as (select k, min(c) c from reach group by k),
stays as (select c, min(f) s from comp join firsts using (k) group by c),
flagged as (select l.doc_id, l.pos, {{'d': l.doc_id, 'a': l.pos}} <> s as gone
  from lines l join firsts using (line) join comp using (k) join stays using (c)),
per as (select doc_id, count(*) n, count(*) filter (where gone) g,
  string_agg(pos::varchar, ',' order by pos) filter (where gone) d from flagged group by doc_id)
select d.doc_id, coalesce(n, 0) as n_lines, coalesce(g, 0) as n_dropped, coalesce(d.d, '') as dropped
from (select x.doc_id, n, g, p.d from documents x left join per p on x.doc_id = p.doc_id) d"""

_PREFERENCE_SQL = f"""
with turns as (
  select conv_id, turn, coalesce(role, 'user') as role, replace(coalesce(text, ''), '<|', '< |') as text
  from conversations where conv_id is not null),
last as (select conv_id, max(turn) as place, arg_max(text, turn) as text from turns where role = 'assistant' group by conv_id),
swap as (select l.conv_id, l.place, coalesce(o.text, '') as other from last l left join last o on o.conv_id = xor(l.conv_id, 1)),
sides as (select t.conv_id, t.turn, t.role, t.text as c, case when turn = place and role = 'assistant' then other else text end as r
  from turns t join swap using (conv_id)),
marked as (select *, min(case when c <> r then turn end) over (partition by conv_id) as cut from sides),
parts as (select *, cut is null or turn < cut as shared,
  '{preference_chat.OPEN}' || role || chr(10) || c || '{preference_chat.CLOSE}' || chr(10) as tc,
  '{preference_chat.OPEN}' || role || chr(10) || r || '{preference_chat.CLOSE}' || chr(10) as tr from marked),
placed as (select *,
  sum(case when shared then 0 else length(tc) end) over (partition by conv_id order by turn) - length(tc)
    + {len(preference_chat.OPEN) + 1} + length(role) as sc,
  sum(case when shared then 0 else length(tr) end) over (partition by conv_id order by turn) - length(tr)
    + {len(preference_chat.OPEN) + 1} + length(role) as sr from parts)
select conv_id as pair_id, cast(count(*) filter (where shared) as int) as n_prompt_turns,
  sha256(coalesce(string_agg(tc, '' order by turn) filter (where shared), '')) as prompt_sha256,
  sha256(coalesce(string_agg(tc, '' order by turn) filter (where not shared), '')) as chosen_sha256,
  sha256(coalesce(string_agg(tr, '' order by turn) filter (where not shared), '')) as rejected_sha256,
  coalesce(string_agg(cast(sc as bigint) || ':' || cast(sc + length(c) + {len(preference_chat.CLOSE)} as bigint), ','
    order by turn) filter (where not shared and role = 'assistant'), '') as chosen_spans,
  coalesce(string_agg(cast(sr as bigint) || ':' || cast(sr + length(r) + {len(preference_chat.CLOSE)} as bigint), ','
    order by turn) filter (where not shared and role = 'assistant'), '') as rejected_spans
from placed group by conv_id"""


def _mix_sql() -> str:
    levels = budget_mix.LEVELS
    domains = ", ".join(f"'{d}'" for d in budget_mix.DOMAINS)
    steps = []
    for depth, level in enumerate(levels):
        path = levels[: depth + 1]
        up = ", ".join(path[:-1])
        by = f"partition by {up}" if up else ""
        pairs = " ".join(f"when '{k}' then {w}" for k, w in budget_mix.WEIGHTS[depth].items())
        weight = f"case {level} {pairs} else {budget_mix.DEFAULT_WEIGHT} end" if pairs else str(budget_mix.DEFAULT_WEIGHT)
        given = f"(select cast(floor(sum(supply) * {budget_mix.SHARE}) as bigint) from leaves)" if not depth else "max(u.budget)"
        joined = f"join l{depth - 1} u using ({up})" if depth else ""
        order = f"order by room / weight, {', '.join(f'{c} nulls first' for c in path)}"
        steps.append(f"""
n{depth} as (select {', '.join(path)}, cast(sum(x.supply) as bigint) supply, cast(sum(x.supply) * {budget_mix.EPOCHS} as bigint) room,
  {weight} weight, {given} given from leaves x {joined} group by {', '.join(path)}),
w{depth} as (select *, coalesce(sum(room) over ({by} {order} rows between unbounded preceding and 1 preceding), 0) taken,
  sum(weight) over ({by}) - coalesce(sum(weight) over ({by} {order} rows between unbounded preceding and 1 preceding), 0) rest
  from n{depth}),
u{depth} as (select *, max(cast(given - taken as double) / rest) over ({by}) unit from w{depth}),
l{depth} as (select {', '.join(path)}, supply, greatest(0, least(room, cast(floor(unit * weight) as bigint))) budget
  from u{depth})""")
    keys = ", ".join(levels)
    return f"""
with base as (select doc_id, [{domains}][cast(nullif(regexp_extract(source, '([0-9]{{1,18}})$', 1), '') as bigint)
    % {len(budget_mix.DOMAINS)} + 1] as domain, lang, source,
    cast(ceil(strlen(text) / 4.0) as bigint) as tokens from documents),
leaves as (select {keys}, cast(sum(tokens) as bigint) supply from base where tokens > 0 group by {keys}),
{','.join(steps)},
ranked as (select b.*, budget // supply as whole, budget % supply as rest,
  md5(concat_ws(':', '{budget_mix.SEED}', cast(budget // supply as varchar), coalesce(cast(doc_id as varchar), ''))) place
  from base b join l{len(levels) - 1} using ({keys}) where tokens > 0),
summed as (select *, sum(tokens) over (partition by {keys} order by place, doc_id, tokens rows unbounded preceding) s from ranked)
select doc_id, {keys}, tokens, cast(whole + (s <= rest)::int as int) as copies from summed where whole + (s <= rest)::int > 0"""


def _merkle_sql(levels: int = 13) -> str:
    """``levels`` levels of each tree are written out: enough for 3**13 rows a source."""
    def field(c: str) -> str:
        return f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(text if c == "text" else c) for c in merkle_manifest.FIELDS) + ")"

    # CRC-32 bit by bit over the decimal digits
    byte = "list_reduce([xor(c, b)] || range(8), lambda r, k: xor(r >> 1, 3988292384 * (r & 1)))"
    crc = ("xor(4294967295, list_reduce([4294967295] || list_transform(string_split(cast(doc_id as varchar), ''),"
           f" lambda x: cast(ord(x) as bigint)), lambda c, b: {byte}))")
    steps, joins, others, folds = [], [], [], []
    for t, first in (("s", "select source, pos, leaf h from leaves"),
                     ("t", "select '0' source, row_number() over (order by source nulls first) - 1 pos, h, source own"
                           " from subroots")):
        steps.append(f"{t}0 as ({first})")
        for k in range(1, levels + 1):
            sized = (f"{t}{k - 1} p join (select source, count(*) c from {t}{k - 1} group by source) m"
                     " on p.source is not distinct from m.source")
            steps.append(f"""
{t}{k} as (select p.source, pos // 3 pos, sha256(string_agg(h, '' order by pos)) h, list(h order by pos) run
  from {sized} where c > 1 group by p.source, pos // 3
  union all select p.source, pos, h, null from {sized} where c = 1)""")
            row, tree = ("l", "l.source") if t == "s" else ("g", "'0'")
            joins.append(f"left join {t}{k} on {t}{k}.source is not distinct from {tree}"
                         f" and {t}{k}.pos = {row}.pos // {3 ** k} and {t}{k}.run is not null")
            mine = f"({row}.pos // {3 ** (k - 1)}) % 3"
            others.append(f"coalesce(array_to_string({t}{k}.run[1:{mine}] || {t}{k}.run[{mine} + 2:], ''), '')")
            mine = f"({'pos' if t == 's' else 'gpos'} // {3 ** (k - 1)}) % 3"
            folds.append(f"""
f{len(folds) + 1} as (select * exclude (f), case when r{t}{k} is null then f else sha256(
  array_to_string(r{t}{k}[1:{mine}], '') || f || array_to_string(r{t}{k}[{mine} + 2:], '')) end f from f{len(folds)})""")
        if t == "s":
            steps.append(f"subroots as (select source, h from s{levels})")
    runs = ", ".join(f"{t}{k}.run as r{t}{k}" for t in "st" for k in range(1, levels + 1))
    return f"""
with leaves as (select doc_id, source, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 pos,
    leaf, case when {crc} % 2 = 0 then {leaf("replace(text, chr(10), '')")} else leaf end held
  from (select *, {leaf('text')} leaf from documents)),
{','.join(steps)},
f0 as (select doc_id, leaf, l.pos, g.pos gpos, g.h subroot, (select h from t{levels}) root,
    {' || '.join(others)} siblings, held f, {runs}
  from leaves l join t0 g on g.own is not distinct from l.source {' '.join(joins)}),
{','.join(folds)}
select doc_id, leaf, subroot, root, sha256(siblings) as proof_sha256, f as folded_root, f = root as verified
from f{len(folds)}"""


_REPEATS_SQL = rf"""
with words as (select row_number() over () r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
starts as (select r, doc_id, i, md5(array_to_string(w[i:i + {cover_anchors.WINDOW - 1}], ' ')) k from (
  select r, doc_id, w, unnest(range(1, len(w) - {cover_anchors.WINDOW - 2})) i from words
  where len(w) >= {cover_anchors.WINDOW})),
least as (select k, min(doc_id) m from starts group by k),
found as (select r, i from starts join least using (k) where m < coalesce(doc_id, {2 ** 63 - 1})),
each as (select r, unnest(range(1, len(w) + 1)) p, unnest(w) word from words),
cut as (select e.r, p, word, max(f.i) over (partition by e.r order by p rows between {cover_anchors.WINDOW - 1} preceding
  and current row) is not null as gone from each e left join found f on f.r = e.r and f.i = e.p),
per as (select r, count(*) n, count(*) filter (where gone) g, string_agg(word, ' ' order by p) filter (where not gone) t
  from cut group by r)
select doc_id, coalesce(n, 0) as n_words, coalesce(g, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from words left join per using (r)"""


_NEGATIVES_SQL = f"""
with whole as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor({four_russians.SCALE} * cast(x as double)) as double)) as q
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
scored as (select a.vec_id a, b.vec_id b, a.label = b.label as same, cast(list_inner_product(a.q, b.q) as bigint) s
  from whole a join whole b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
near as (select a, b, s from scored where same
  qualify row_number() over (partition by a order by s desc, b) <= {four_russians.POSITIVES})
select p.a as anchor_id, p.b as positive_id,
  cast(row_number() over (partition by p.a, p.b order by n.s desc, n.b) as int) as rank,
  n.b as negative_id, p.s as positive_score, n.s as negative_score
from near p join scored n on n.a = p.a and not n.same
  and 100 * n.s between {four_russians.LOW} * p.s and {four_russians.HIGH} * p.s
qualify row_number() over (partition by p.a, p.b order by n.s desc, n.b) <= {four_russians.NEGATIVES}"""


ORACLE = {
    "op3_secret_scan": _secret_sql(),
    "op4_odd_sketch": _NEAR_SQL,
    "op5_preference_chat": _PREFERENCE_SQL,
    "op6_budget_mix": _mix_sql(),
    "op9_fuzzy_lines": _LINES_SQL,
    "op11_merkle_descent": _merkle_sql(),
    "op12_cover_anchors": _REPEATS_SQL,
    "op13_four_russians": _NEGATIVES_SQL,
}
