"""DuckDB SQL for the queries that SQL can express."""

# Turns in order, with the template's fixed parts counted: <|im_start|>, a line end, <|im_end|> and a line end.
_CHAT = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') r, coalesce(text, '') t from conversations where conv_id is not null
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sized as (
  select *, length(regexp_replace(t, '<(\\*)\|', '<\1\\|', 'g')) as n_text,
    length(regexp_replace(replace(replace(r, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g')) as n_role
  from turns)
select conv_id, count(*) as n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn nulls first, r, t)) as turns_sha256,
  cast(coalesce(sum(length(t)) filter (r = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(t, '' order by turn nulls first, r, t) filter (r = 'assistant'), '')) as loss_sha256,
  cast(sum(n_text + n_role + 24) as bigint) as formatted_chars
from sized group by conv_id"""

# Every window of 20 words is spelled out and grouped with its first place.
_SUBSTRINGS = r"""
with docs as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) as h
  from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from docs where len(w) >= 20)),
ranked as (
  select doc_id, i, row_number() over (partition by h order by doc_id, i) as n from windows),
gone as (
  select distinct doc_id, unnest(range(i, i + 20)) as p from ranked where n > 1),
lost as (
  select doc_id, list(p) as ps, count(*) as n from gone group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(l.n, 0) as n_removed,
  sha256(array_to_string(
    list_filter(w, lambda x, k: l.ps is null or not list_contains(l.ps, k)), ' ')) as kept_sha256
from docs d left join lost l using (doc_id)"""

# Equal sets are joined once; then pairs are counted over shared shingles and components spread step by step.
_JACCARD = r"""
with recursive docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
shingled as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from docs),
named as (
  select doc_id, len(s) as n, min(doc_id) over (partition by md5(array_to_string(list_sort(s), chr(10)))) as class_id
  from shingled),
sets as (
  select d.doc_id, len(s) as n, unnest(s) as x from shingled d join named using (doc_id) where d.doc_id = class_id),
links as (
  select a.doc_id as a, b.doc_id as b from sets a join sets b on a.x = b.x and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
either as (select a, b from links union select b, a from links),
reach as (
  select distinct class_id as a, class_id as c from named
  union select either.b, reach.c from reach join either on either.a = reach.a)
select n1.doc_id, cast(n1.n as bigint) as n_shingles,
  case when n1.n = 0 then n1.doc_id else r.c end as component_id,
  case when n1.n = 0 then n1.doc_id else n1.class_id end as class_id
from named n1 join (select a, min(c) as c from reach group by a) r on r.a = n1.class_id"""

# Every term of every document is spelled out and counted.
_SEARCH = r"""
with docs as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
sized as (select r, doc_id, w, len(w) as n from docs where len(w) > 0),
totals as (select count(*) as docs, sum(n) as terms from sized),
wanted as (
  select item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select distinct item_id, text from benchmark)),
repeated as (select item_id, text, term, count(*) as reps from wanted group by all),
counted as (
  select r, term, count(*) as tf from (select r, unnest(w) as term from sized)
  where term in (select term from repeated) group by all),
weighed as (
  select term, cast(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) as bigint) as weight
  from counted, totals group by term),
scored as (
  select item_id, text, doc_id, r, sum(reps * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) as score
  from repeated join weighed using (term) join counted using (term) join sized using (r), totals group by all),
ranked as (
  select *, row_number() over (partition by item_id, text order by score desc, doc_id nulls last) as rank
  from scored where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, cast(score as bigint) as score from ranked where rank <= 10"""

# Equal payloads are grouped by their digest.
_WARC = """
with hashed as (
  select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
  from pages),
grouped as (
  select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as least from hashed)
select page_id, payload_bytes, payload_digest,
  case when least is null or least is not distinct from page_id then 'response' else 'revisit' end as record_type,
  case when least is distinct from page_id then least end as refers_to
from grouped"""

ORACLE_SQL: dict[str, str] = {
    "op3_chat_format": _CHAT,
    "op4_substring_dedup": _SUBSTRINGS,
    "op6_jaccard_join": _JACCARD,
    "op12_lexical_search": _SEARCH,
    "op13_warc": _WARC,
}
