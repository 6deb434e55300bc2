"""Reference SQL of the queries that SQL can express."""

from __future__ import annotations

OP4 = r"""
with words as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), places as (
  select r, w, unnest(range(1, len(w) - 3)) as i from words where len(w) >= 5
), windows as (
  select r, i, count(*) over (partition by r, array_to_string(w[i:i + 4], ' ')) as n from places
), covered as (
  select r, sum(least(5, coalesce(nxt - i, 5))) as n_repeat_words
  from (select r, i, lead(i) over (partition by r order by i) as nxt from windows where n > 1) group by r
), lines as (
  select r, line from (select r, unnest(string_split(text, chr(10))) as line from words)
  where regexp_matches(line, '[^\x20\x09-\x0D]')
), line_counts as (
  select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines from lines group by r
), measured as (
  select doc_id, cast(len(w) as bigint) as n_words,
         cast(length(array_to_string(w, '')) as bigint) as word_chars,
         cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
         cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines,
         cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
         coalesce(n_lines, 0) as n_lines,
         len(regexp_extract_all(text, '[A-Z]')) as n_upper
  from words left join covered using (r) left join line_counts using (r)
), judged as (
  select *, cast(
      case when n_words < 10 then 1 else 0 end
    + case when 100 * n_repeat_words > 20 * n_words then 2 else 0 end
    + case when 10 * n_symbols > n_words then 4 else 0 end
    + case when n_dup_lines > 2 and 100 * n_dup_lines > 30 * n_lines then 8 else 0 end
    + case when word_chars > 15 * n_words or 2 * word_chars < 3 * n_words then 16 else 0 end
    + case when 2 * n_upper > word_chars then 32 else 0 end
    + case when n_lines = 0 then 64 else 0 end as bigint) as fail_bits
  from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & 3) <> 0 as base_failed, (fail_bits & 63) = 0 as kept, fail_bits
from judged
"""

OP9 = r"""
with docs as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), items as (
  select item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), windows as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as s
  from (select item_id, w, least(10, len(w)) as n, unnest(range(1, greatest(len(w) - 8, 2))) as i
        from items where len(w) > 0)
), sizes as (select distinct n from windows), places as (
  select r, n, i, array_to_string(w[i:i + n - 1], ' ') as s
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from docs, sizes where len(w) >= n)
), hits as (
  select r, i, n, item_id from places join windows using (n, s)
), hit_words as (
  select r, count(distinct k) as n_hit from (select r, unnest(range(i, i + n)) as k from (select distinct r, i, n from hits))
  group by r
), hit_items as (
  select r, count(distinct item_id) as n_items,
         array_to_string(list_sort(list_distinct(list(cast(item_id as varchar)))), ',') as ids
  from hits group by r
)
select doc_id, cast(coalesce(len(w), 0) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit_words using (r) left join hit_items using (r)
"""

OP11 = r"""
with docs as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), words as (
  select r, lang, source, unnest(w) as term from docs
), kept as (
  select lang, term, count(*) as n from words group by lang, term having count(distinct r) >= 30
), langs as (
  select lang, count(*) as v, sum(n) as total from kept group by lang
), groups as (
  select distinct lang, source from docs
), counts as (
  select lang, source, term, count(*) as n from words join kept using (lang, term) group by lang, source, term
), cells as (
  select lang, source, term, coalesce(c.n, 0) as n, kept.n as n_lang
  from groups join kept using (lang) left join counts c using (lang, source, term)
), totals as (
  select lang, source, sum(n) as total from cells group by lang, source
), shares as (
  select lang, source, term, n,
         1 + 1000000000 * cast(n + 5 as hugeint) // cast(t.total + 5 * v as hugeint) as p,
         1 + 1000000000 * cast(n_lang + 5 as hugeint) // cast(langs.total + 5 * v as hugeint) as q
  from cells join totals t using (lang, source) join langs using (lang)
), apart as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by a.lang, a.source, b.source
), found as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join apart on apart.lang = a.lang and apart.source = a.source and apart.item = b.source
  union all
  select lang, source, 'term', term, p - q from shares where n > 0 and p > q
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank from found
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from ranked where part = 'pair' or rank <= 50
"""

OP12 = r"""
with docs as (
  select row_number() over () as r, doc_id, length(coalesce(text, '')) as n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) as text_sha256
  from documents
), placed as (
  select *, row_number() over (partition by text_sha256 order by n desc, doc_id nulls last, r) as place from docs
)
select doc_id, first_value(doc_id) over g as keep_id, count(*) over (partition by text_sha256) as group_size,
       place = 1 as kept, text_sha256
from placed window g as (partition by text_sha256 order by place)
"""

OP13 = r"""
with rows as (
  select row_number() over () as r, vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.r as anchor, a.vec_id as anchor_id, b.r, b.vec_id, a.label = b.label as alike,
         cast(list_inner_product(a.v, b.v) as bigint) as score
  from rows a join rows b on a.r <> b.r where a.vec_id % 100 = 0
), positives as (
  select * from scored where alike
  qualify row_number() over (partition by anchor order by score desc, vec_id, r) <= 5
)
select p.anchor_id, p.vec_id as positive_id,
       cast(row_number() over (partition by p.anchor, p.r order by n.score desc, n.vec_id, n.r) as integer) as rank,
       n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join scored n on n.anchor = p.anchor and not n.alike
where 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score
qualify rank <= 5
"""

SQL: dict[str, str] = {
    "op4_rule_ledger": OP4,
    "op9_suffix_decontamination": OP9,
    "op11_run_length_audit": OP11,
    "op12_two_pass_bloom": OP12,
    "op13_length_buckets": OP13,
}
