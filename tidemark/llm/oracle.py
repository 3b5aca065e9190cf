"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm import quality

_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6 = f"""
with normal as (select doc_id, {_ASCII_LOWER} as body from documents)
select doc_id,
       max(doc_id) over (partition by body) as keep_id,
       count(*) over (partition by body) as group_size,
       doc_id = max(doc_id) over (partition by body) as kept,
       sha256(body) as text_sha256
from normal
"""


OP5 = """
with texts as (
    select doc_id, text, string_split(text, chr(10)) as lines from documents
), places as (
    select doc_id, lines, unnest(range(1, len(lines) - 1)) as i from texts where len(lines) >= 3
), windows as (
    select doc_id, i, lines[i] || chr(10) || lines[i + 1] || chr(10) || lines[i + 2] as body from places
), later as (
    select doc_id, i from windows
    where regexp_matches(body, '[^\\x20\\x09-\\x0D]')
    qualify row_number() over (partition by body order by doc_id, i) > 1
), gone as (
    select doc_id, list(distinct i + k) as removed
    from later, (select unnest(range(0, 3)) as k) group by doc_id
), cut as (
    select doc_id, text, lines, coalesce(removed, []) as removed from texts left join gone using (doc_id)
)
select doc_id,
       coalesce(len(lines), 0) as n_lines,
       len(removed) as n_removed,
       sha256(case when len(removed) = 0 then text else array_to_string(
           list_filter(lines, lambda l, i: not list_contains(removed, i)), chr(10)) end) as kept_sha256
from cut
"""


def _verdict() -> str:
    ends = []
    for rule in quality.RULES:
        if rule.low is not None:
            ends.append(f"{rule.metric} >= {rule.low}")
        if rule.high is not None:
            ends.append(f"{rule.metric} <= {rule.high}")
    return " and ".join(ends)


_STOPS = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)

OP9 = f"""
with tokens as (
    select doc_id, text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as lines
    from documents
), windows as (
    select doc_id, i, array_to_string(words[i : i + 7], ' ') as body
    from (select doc_id, words, unnest(range(1, len(words) - 6)) as i from tokens)
), repeated as (
    select doc_id, i from windows
    qualify count(*) over (partition by doc_id, body) > 1
), covered as (
    select doc_id, count(distinct i + k) as n_repeat_words
    from repeated, (select unnest(range(0, 8)) as k) group by doc_id
), counted as (
    select doc_id,
           len(words) as n_words,
           length(array_to_string(words, '')) as word_chars,
           length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) as n_symbols,
           len(lines) - len(list_distinct(lines)) as n_dup_lines,
           len(lines) as n_lines,
           length(regexp_replace(coalesce(text, ''), '[^!]', '', 'g')) as bangs,
           len(list_filter(words, lambda w: lower(w) in ({_STOPS}))) as stops,
           coalesce(list_max(list_transform(words, lambda w: length(w))), 0) as longest_word
    from tokens
), ratios as (
    select counted.*, coalesce(n_repeat_words, 0) as n_repeat_words,
           case when n_words > 0 then word_chars / n_words else 0 end as mean_word_chars,
           case when n_words > 0 then n_symbols / n_words else 0 end as symbol_ratio,
           case when n_words > 0 then bangs / n_words else 0 end as bang_ratio,
           case when n_words > 0 then stops / n_words else 0 end as stop_ratio,
           case when n_lines > 0 then n_dup_lines / n_lines else 0 end as dup_line_ratio
    from counted left join covered using (doc_id)
), judged as (
    select *, n_words < {quality.MIN_WORDS}
              or 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words as base_failed
    from ratios
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and {_verdict()} as kept
from judged
"""

def _vectors(scale: int, where: str = "true", also: str = "") -> str:
    """Rows of embeddings that take part, with floor(scale * x) of their components."""
    return f"""
    select vec_id, {also} [floor({scale} * x::double) for x in embedding] as v
    from embeddings
    where embedding is not null and list_bool_and([x is not null and isfinite(x) for x in embedding] || [true]) and {where}
"""


OP11 = f"""
with vectors as ({_vectors(256, "label is not null", "case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,")}
), scores as (
    select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_dot_product(a.v, c.v)::bigint as score
    from vectors a join vectors c on a.vec_id % 50 = 0 and a.vec_id <> c.vec_id
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scores where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, positive_id,
       row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id)::integer as rank,
       vec_id as negative_id, positive_score, score as negative_score
from positives p join scores n on p.anchor_id = n.anchor_id and not same
     and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3
"""

OP12 = f"""
with vectors as ({_vectors(64)}
), scores as (
    select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
    from vectors q join vectors c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
from scores qualify rank <= 20
"""


def _nearest(centroids: str) -> str:
    return f"""
    select vec_id, v, c, list_dot_product(v, v) - 2 * list_dot_product(v, x) + list_dot_product(x, x) as d
    from vectors, {centroids} qualify row_number() over (partition by vec_id order by d, c) = 1
"""


def _rounds(rounds: int) -> str:
    steps = []
    for r in range(rounds):
        steps.append(f"""
near{r} as materialized ({_nearest(f"centroids{r}")}),
sums{r} as (
    select c, i, sum(v[i])::bigint as s, count(*) as n from near{r}, (select unnest(range(1, 65)) as i) group by c, i
), moved{r} as (
    select c, list(((s - ((s % n) + n) % n) // n)::double order by i) as m from sums{r} group by c
), centroids{r + 1} as materialized (
    select o.c, coalesce(m, o.x) as x from centroids{r} o left join moved{r} using (c)
)""")
    return ",".join(steps)


OP13 = f"""
with vectors as materialized ({_vectors(1024, "len(embedding) = 64")}
), centroids0 as materialized (
    select row_number() over (order by sha256('3:' || vec_id), vec_id) - 1 as c, v as x from vectors
    order by sha256('3:' || vec_id), vec_id limit 8
),{_rounds(10)}, last as materialized ({_nearest("centroids10")})
select vec_id, c::integer as cluster, d::bigint as distance,
       (sum(d) over (partition by c))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia,
       (select sha256(array_to_string([e::bigint for e in x], ',')) from centroids10 o where o.c = l.c) as centroid_sha256
from last l
"""

ORACLE: dict[str, str] = {
    "op5_line_dedup": OP5,
    "op6_exact_dedup": OP6,
    "op9_quality_rules": OP9,
    "op11_hard_negatives": OP11,
    "op12_topk": OP12,
    "op13_centroids": OP13,
}
