"""SQL for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

import string

from facetflow.llm import chat, license_scan, line_dedup, spelling


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_TEMPLATES = ", ".join(
    f"({number}, {_text(label)}, {str(number < len(license_scan.BASE)).lower()}, {_text(text)})"
    for number, (text, label) in enumerate([*license_scan.BASE.items(), *license_scan.NOTICES.items()])
)
_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

OP1 = rf"""
with templates(template, label, base, phrase) as (values {_TEMPLATES}),
cut as (select template, label, base, string_split(phrase, ' ') as w from templates),
places as (
  select template, label, base, len(w) - 2 as runs, i - 1 as spot, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as run
  from cut, unnest(range(1, len(w) - 1)) as r(i)
),
docs as (
  select row_number() over () as rn, doc_id,
    list_filter(string_split_regex({_LOWER}, '{license_scan.NO_WORD}'), lambda x: x <> '') as w
  from documents
),
runs as (
  select rn, i - 1 as word, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as run
  from docs, unnest(range(1, len(w) - 1)) as r(i)
),
votes as (
  select rn, template, label, base, runs, word - spot as diagonal, count(*) as votes, min(word) as first, max(word) as last,
    bit_or(1::bigint << spot) as held
  from runs join places using (run) group by all
),
marked as (
  select *, case when diagonal - lag(diagonal) over line <= {license_scan.DRIFT}
    and abs(first - lag(last) over line) <= runs + {license_scan.GRAM} then 0 else 1 end as new
  from votes window line as (partition by rn, template order by diagonal)
),
numbered as (
  select *, sum(new) over (partition by rn, template order by diagonal rows unbounded preceding) as span from marked
),
spans as (
  select rn, template, label, base, bit_count(bit_or(held)) / runs as score,
    count(*) filter (where votes >= runs) as places,
    min(diagonal) filter (where votes >= runs) as first_place, max(diagonal) filter (where votes >= runs) as last_place
  from numbered group by rn, template, label, base, runs, span
),
found as (
  select rn, sum(places) filter (where base) as n_base,
    min(first_place) filter (where base) as first_word, max(last_place) filter (where base) as last_word,
    list_sort(list_distinct(list(label) filter (where base and places > 0))) as base_labels,
    list_sort(list_distinct(list(label) filter (where score >= {license_scan.LEAST_SCORE} or base and places > 0))) as labels,
    max(score) as score
  from spans group by rn
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_base, 0) as bigint) as n_base,
  cast(first_word as bigint) as first_word, cast(last_word as bigint) as last_word,
  coalesce(array_to_string(base_labels, ','), '') as base_labels, coalesce(array_to_string(labels, ','), '') as labels,
  cast(coalesce(score, 0) as double) as score
from docs left join found using (rn)
"""

OP2 = """
with payloads as (
  select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as bytes from pages
),
rows as (
  select page_id, html, bytes, case when bytes >= 100 then min(page_id) over (partition by html) end as response from payloads
)
select page_id, cast(bytes as bigint) as payload_bytes, sha256(html) as payload_digest,
  case when response is not null and response is distinct from page_id then 'revisit' else 'response' end as record_type,
  case when response is distinct from page_id then response end as refers_to
from rows
"""

_ESCAPED = r"replace(replace({0}, '\', '\\'), '<|', '<\|')"
OP4 = rf"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{chat.END}{chat.START}assistant ok'
  union all select -1, 1, 'assistant', '{chat.END}{chat.START}assistant ok'
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = '{chat.TRAINED}'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = '{chat.TRAINED}'), '')) as loss_sha256,
  cast(sum({len(chat.START) + len(chat.END) + 2} + length(replace({_ESCAPED.format("role")}, chr(10), '\n'))
    + length({_ESCAPED.format("text")})) as bigint) as formatted_chars
from said group by conv_id
"""

OP5 = """
with vectors as (
  select vec_id, cast(embedding as double[]) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
pairs as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v) as score
  from vectors q join vectors c on c.vec_id <> q.vec_id where q.vec_id % 20 = 0
),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 20
"""

OP10 = f"""
with lines as (
  select doc_id, n - 1 as n, string_split(coalesce(text, ''), chr(10))[n] as line
  from documents, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) as r(n)
),
kinds as (
  select line, length(line) as size, min({{'doc_id': doc_id, 'n': n}}) as first, count(*) as copies
  from lines where line <> '' group by line
),
long as (select * from kinds where size >= {line_dedup.LEAST_CHARS}),
met as (
  select a.line as x, b.line as y from long a join long b
    on b.size = a.size and left(a.line, a.size // 2) = left(b.line, a.size // 2) and a.line <> b.line
  union select a.line, b.line from long a join long b
    on b.size = a.size and right(a.line, a.size // 2) = right(b.line, a.size // 2) and a.line <> b.line
  union select a.line, b.line from long a join long b
    on b.size = a.size + 1 and left(a.line, a.size // 2) = left(b.line, a.size // 2)
  union select a.line, b.line from long a join long b
    on b.size = a.size + 1 and right(a.line, a.size // 2) = right(b.line, a.size // 2)
),
close as (select x, y from met where levenshtein(x, y) <= 1),
links as (select x, y from close union select y, x from close),
others as (select x as line, min(first) as other, count(*) as links from links join kinds on kinds.line = y group by x),
kept as (
  select kinds.line, least(first, coalesce(other, first)) as keeper, coalesce(links, 0) as links
  from kinds left join others using (line)
),
placed as (select lines.doc_id, n, links, {{'doc_id': doc_id, 'n': n}} > keeper as later from lines join kept using (line)),
gone as (
  select doc_id, count(*) filter (where later) as n_removed, string_agg(cast(n as varchar), ',' order by n) filter (where later) as removed_lines,
    max(links) as most_links
  from placed group by doc_id
)
select doc_id, cast(len(string_split(coalesce(text, ''), chr(10))) as bigint) as n_lines,
  cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(removed_lines, '') as removed_lines,
  cast(coalesce(most_links, 0) as bigint) as most_links
from documents left join gone using (doc_id)
"""

OP11 = f"""
with recursive table256 as (
  select list(list_reduce(range(8), lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) order by i) as t
  from range(256) as r(i)
),
runs as (
  select coalesce(cast(doc_id as varchar), '') as id,
    unnest(regexp_extract_all(text, '[{spelling.LETTERS}]+')) as run
  from documents
),
lowered as (
  select id, translate(run, '{string.ascii_uppercase}', '{string.ascii_lowercase}') as run, count(*) as copies
  from runs where length(run) >= {spelling.LEAST_CHARS} group by all
),
summed as (
  select run, copies, xor(list_reduce(
    flatten(list_transform(string_split(id || ':' || run, ''),
      lambda x: case when ord(x) < 128 then [ord(x)] else [192 + (ord(x) >> 6), 128 + (ord(x) & 63)] end)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) as h
  from lowered, table256
),
damaged as (
  select case when h % {spelling.DAMAGE} = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, copies from summed
),
words as (select word, cast(sum(copies) as bigint) as n from damaged where length(word) >= {spelling.LEAST_CHARS} group by word having sum(copies) >= {spelling.LEAST_COPIES}),
cut as (
  select word, n, k, left(word, k - 1) || substr(word, k + 1) as rest from words, unnest(range(1, length(word) + 1)) as r(k)
),
pairs as (
  select a.word as word, b.word as other from cut a join words b on a.rest = b.word
  union select b.word, a.word from cut a join words b on a.rest = b.word
  union select a.word, b.word from cut a join cut b on a.k = b.k and a.rest = b.rest and a.word <> b.word
),
met as (
  select p.word, count(*) as n_near, max(w.n) as top, arg_min(w.word, {{'n': -w.n, 'word': w.word}}) as best
  from pairs p join words w on w.word = p.other group by p.word
),
formed as (
  select word, n, coalesce(n_near, 0) as n_near, case when top >= {spelling.RATIO} * n then best end as form, case when top >= {spelling.RATIO} * n then top end as form_n
  from words left join met using (word)
),
chain as (
  select word, word as root, form as next from formed
  union all select chain.word, chain.next, formed.form from chain join formed on formed.word = chain.next
),
roots as (select word, root from chain where next is null)
select word, form, root, n, n_near, form_n from formed join roots using (word)
"""

ORACLES: dict[str, str] = {
    "op1_license_scan": OP1,
    "op2_warc": OP2,
    "op4_chat": OP4,
    "op5_neighbours": OP5,
    "op10_line_dedup": OP10,
    "op11_spelling": OP11,
}
