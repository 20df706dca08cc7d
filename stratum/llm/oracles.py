"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from stratum.llm.pii import IBAN_LENGTHS

_SPACE = r"[\x20\x09-\x0D]+"

OP5 = rf"""
with d as (
    select doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g')) as text_sha256
    from documents
)
select doc_id,
       min(doc_id) over (partition by text_sha256) as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       row_number() over (partition by text_sha256 order by doc_id) = 1 as kept,
       text_sha256
from d
"""

OP6 = r"""
with d as (
    select doc_id, source, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
    from documents
), grams as (
    select doc_id, i, w[i] as a, w[i + 1] as b, w[i + 2] as c
    from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3)
), doubled as (
    select doc_id, i from grams
    qualify count(*) over (partition by doc_id, a, b, c) > 1
), covered as (
    select doc_id, count(distinct i + k) as n
    from doubled, (values (0), (1), (2)) as t(k) group by doc_id
), counts as (
    select d.doc_id, source, len(w) as n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
           len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
             - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))))
             as n_dup_lines,
           len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) as n_lines,
           coalesce(n, 0) as n_repeat_words
    from d left join covered c on d.doc_id = c.doc_id
), judged as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts
), failures as (
    select source, rule, count(*) as docs, count(*) filter (failed) as failed from (
        select source, unnest(['short', 'repeated_words', 'repeated_lines', 'symbols', 'word_length']) as rule,
               unnest([n_words < 50, 100 * n_repeat_words > 50 * n_words, 10 * n_dup_lines > 3 * n_lines,
                       10 * n_symbols > n_words, word_chars < 3 * n_words or word_chars > 10 * n_words]) as failed
        from judged)
    group by source, rule
), others as (
    select h.source, h.rule, any_value(h.docs) as docs, any_value(h.failed) as failed,
           avg(o.failed / o.docs) as m, coalesce(var_samp(o.failed / o.docs), 0) as v,
           avg(1 / o.docs) as inv, avg(o.docs) as size
    from failures h left join failures o on h.rule = o.rule and h.source is distinct from o.source
    group by h.source, h.rule
), priors as (
    select *, case when m * (1 - m) > 0 and v / (m * (1 - m)) - inv > 0
                   then greatest(2, (1 - inv) / (v / (m * (1 - m)) - inv) - 1)
                   else greatest(2, size) end as s
    from others
), verdicts as (
    select source, coalesce(bool_or((failed + m * s) / (docs + s) - m
                                    > 4 * greatest(sqrt(m * (1 - m) / (s + 1)), 0.05)), false) as host_rejected
    from priors group by source
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rejected,
       not base_failed and not host_rejected as kept
from judged j join verdicts h on j.source is not distinct from h.source
"""

OP7 = r"""
with recursive d as (
    select doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x20\x09-\x0D]+') as w
    from documents
), sets as (
    select doc_id, list_distinct(
        case when len(w) = 0 then []
             when len(w) < 5 then [array_to_string(w, ' ')]
             else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
    from d
), classes as (
    select list_sort(s) as s, min(doc_id) as id from sets where len(s) > 0 group by 1
), grams as (
    select id, len(s) as n, unnest(s) as g from classes
), pairs as (
    select a.id as a, b.id as b
    from grams a join grams b on a.g = b.g and a.id < b.id
    group by a.id, b.id, a.n, b.n
    having 100 * count(*) >= 75 * (a.n + b.n - count(*))
), edges as (
    select a, b from pairs union all select b, a from pairs
), reach as (
    select a as id, a as other from edges
    union
    select r.id, e.b from reach r join edges e on r.other = e.a
), lowest as (
    select id, min(other) as component from reach group by id
)
select t.doc_id, cast(len(t.s) as bigint) as n_shingles,
       coalesce(l.component, c.id, t.doc_id) as component_id,
       t.doc_id = coalesce(l.component, c.id, t.doc_id) as kept
from sets t
left join classes c on len(t.s) > 0 and list_sort(t.s) = c.s
left join lowest l on c.id = l.id
"""


def _spans(kind: str, pattern: str) -> str:
    """Matches of a kind with their places, from the pieces between them."""
    return f"""
    select doc_id, '{kind}' as kind, v[i] as value, text, right(g[i], 40) || ' ' || left(g[i + 1], 40) as around,
           cast(list_sum(list_transform(g[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(v[1:i - 1], lambda x: length(x))), 0) as bigint) as start
    from (select *, unnest(range(1, len(v) + 1)) as i from (
        select doc_id, text, regexp_extract_all(text, '{pattern}') as v,
               string_split_regex(text, '{pattern}') as g from docs))
    """


_EVERY = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}",  # where a number can begin; the rest is looked at from there
    "national_id": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}

#: An account number of its country's length with nothing glued to it; a window of 160 characters
#: holds the longest number and one that begins inside it.
_KNOWN = "|".join(rf"{e[:2]}[0-9]{{2}}(?: ?[A-Z0-9]){{{int(e[2:]) - 4}}}" for e in IBAN_LENGTHS.split())
_END = r"(?:[^A-Za-z0-9]|\z)"

OP4 = rf"""
with docs as (select doc_id, coalesce(text, '') as text from documents),
simple as ({" union all ".join(_spans(k, p) for k, p in _EVERY.items() if k not in ("iban", "national_id"))}),
ids as (
    select * from ({_spans("national_id", _EVERY["national_id"])})
    where not regexp_matches(coalesce(text[start:start], ''), '[A-Za-z0-9-]')
      and not regexp_matches(text[start + length(value) + 1:start + length(value) + 1], '[A-Za-z0-9-]')
), begins as (
    select doc_id, text, start, text[start + 1:start + 160] as w
    from ({_spans("iban", _EVERY["iban"])})
    where start = 0 or not regexp_matches(text[start:start], '[A-Za-z0-9]')
), cut as (
    -- a number of a country that isn't listed ends before the next one that is
    select doc_id, text, start, regexp_extract(w, '^({_KNOWN}){_END}', 1) as known,
           case when regexp_matches(w, ' (?:{_KNOWN}){_END}')
                then regexp_extract(w, '(?s)^(.*?) (?:{_KNOWN}){_END}', 1) else w end as rest
    from begins
), proposed as (
    select *, case when known <> '' then known else regexp_extract(rest, '^[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}}') end as value
    from cut
), placed as (
    select doc_id, any_value(text) as text, list([start, start + length(value)] order by start) as areas
    from proposed
    where value <> '' and (known <> '' or not regexp_matches(rest[length(value) + 1:length(value) + 1], '[A-Za-z0-9]'))
    group by doc_id
), taken as (
    -- leftmost first, none inside another: the end of the last one taken, then starts and ends
    select doc_id, text, list_reduce(list_prepend([0::bigint], areas),
        lambda a, x: case when x[1] >= a[1] then [x[2]] || a[2:] || x else a end) as flat
    from placed
), numbers as (
    select doc_id, text, flat[2 * i] as start, flat[2 * i + 1] as stop
    from (select *, unnest(range(1, len(flat) // 2 + 1)) as i from taken)
), found as (
    select doc_id, kind, value, text, around, start from simple
    union all
    select doc_id, kind, value, text,
           right(text[coalesce(lag(start + length(value)) over w, 0) + 1:start], 40) || ' '
             || left(text[start + length(value) + 1:coalesce(lead(start) over w, length(text))], 40), start
    from ids window w as (partition by doc_id order by start)
    union all
    select doc_id, 'iban', text[start + 1:stop], text, '', start from numbers
), shaped as (
    select *, start + length(value) as stop, regexp_replace(value, '[^0-9]', '', 'g') as digits,
           regexp_replace(value, ' ', '', 'g') as compact
    from found
), checked as (
    select * from shaped where case kind
        when 'email' then true
        when 'ip' then list_max(list_transform(string_split(value, '.'), lambda x: try_cast(x as hugeint))) <= 255
        when 'card' then length(digits) between 13 and 19 and list_sum(list_transform(
            range(1, length(digits) + 1),
            lambda i: case when (length(digits) - i) % 2 = 0 then cast(digits[i] as int)
                      else cast(digits[i] as int) * 2 - case when cast(digits[i] as int) > 4 then 9 else 0 end end)) % 10 = 0
        when 'phone' then length(digits) between 9 and 15
        when 'iban' then length(compact) between 15 and 34 and list_reduce(
            list_prepend(0, list_transform(string_split(compact[5:] || compact[:4], ''),
                lambda c: cast(case when c between '0' and '9' then ascii(c) - 48 else ascii(c) - 55 end as bigint))),
            lambda a, c: (case when c < 10 then a * 10 + c else a * 100 + c end) % 97) = 1
        else 0.4 + case when regexp_matches(around, '(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:ssn|social security|national id|tax id|passport)') then 0.25 else 0 end
                 - case when regexp_matches(around, '(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:example|version|isbn|order no|serial|sku|build)') then 0.3 else 0 end >= 0.5
    end
), listed as (
    select doc_id, kind, start, kind || ':' || start || ':' || stop as item,
           list_position(['email', 'ip', 'card', 'phone', 'iban', 'national_id'], kind) as no
    from checked
), joined as (
    select doc_id, count(*) filter (kind = 'email') as n_email, count(*) filter (kind = 'ip') as n_ip,
           count(*) filter (kind = 'card') as n_card, count(*) filter (kind = 'phone') as n_phone,
           string_agg(item, ',' order by no, start) filter (no <= 4) as base,
           string_agg(item, ',' order by no, start) as spans
    from listed group by doc_id
)
select d.doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card,
       coalesce(n_phone, 0) as n_phone, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs d left join joined j on d.doc_id = j.doc_id
"""


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP11 = rf"""
with split as (
    select doc_id, string_split(coalesce(text, ''), chr(10)) as x from documents
), lines as (
    select doc_id, unnest(x) as line, unnest(range(1, len(x) + 1)) as no from split
), keyed as (
    select *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines
), repeated as (
    select key, max(doc_id) as last from keyed where length(key) >= 20
    group by key having count(distinct doc_id) >= 3
), marked as (
    select k.*, r.key is not null and k.doc_id <> r.last as dropped
    from keyed k left join repeated r on k.key = r.key
)
select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by no) filter (not dropped), '')) as kept_sha256
from marked group by doc_id
"""

OP12 = r"""
with drawn as (
    select doc_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
           sha256('1:' || cast(doc_id as varchar)) as digest
    from documents
), numbers as (
    select *, len(u) as n, cast('0x' || digest[1:8] as bigint) as h1, cast('0x' || digest[9:16] as bigint) as h2,
           cast('0x' || digest[17:24] as bigint) as h3, cast('0x' || digest[25:32] as bigint) as h4
    from drawn
), cuts as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
           case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                     or h3 % 100 >= 90 then 'plain'
                when h4 % 100 < 20 then 'spm' else 'psm' end as form
    from numbers
), parts as (
    select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m,
           array_to_string(u[b + 1:], '') as s
    from cuts
)
select doc_id, cast(n as bigint) as n, form,
       case when form <> 'plain' then length(p) end as prefix_chars,
       case when form <> 'plain' then length(m) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
              else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(text) as restored_sha256
from parts
"""

OP13 = r"""
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
    from embeddings
    where label is not null and embedding is not null
      and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))), true)
), scored as (
    select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
           cast(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) as bigint) as score
    from rows a join rows b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), positives as (
    select anchor_id, id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select p.anchor_id, positive_id,
       cast(row_number() over (partition by p.anchor_id, positive_id order by score desc, id) as int) as rank,
       id as negative_id, positive_score, score as negative_score
from positives p join scored s
  on p.anchor_id = s.anchor_id and not same
 and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by p.anchor_id, positive_id order by score desc, id) <= 10
"""


def llm_oracles() -> dict[str, str]:
    return {"op4_pii": OP4, "op5_exact_dedup": OP5, "op6_host_rules": OP6, "op7_near_dedup": OP7} | {
        "op11_line_dedup": OP11, "op12_fill_in_middle": OP12, "op13_hard_negatives": OP13,
    }
