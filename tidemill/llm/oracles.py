"""SQL for the newer operators, written independently of them over the plain tables."""

from __future__ import annotations

# CRC-32 of a list of bytes, by its table of 256 remainders (``crc.t``).
_CRC_TABLE = """select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t"""


def _crc(text: str) -> str:
    """CRC-32 of a text of ASCII and U+00C0 to U+00FF."""
    bytes_ = f"""flatten(list_transform(string_split({text}, ''),
        lambda c: case when ord(c) < 128 then [ord(c)::bigint] else [195::bigint, ord(c)::bigint - 64] end))"""
    return f"""xor(list_reduce(list_prepend(4294967295::bigint, {bytes_}),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


# The main text of pages that have one article element of paragraphs and headings, as all of the given tables do.
MAIN_TEXT = r"""
with a as (
  select page_id, url, string_split_regex(regexp_replace(regexp_replace(
      coalesce(regexp_extract(html, '(?s)<article>(.*)</article>', 1), ''), '</?b>', '', 'g'), '<br>', ' ', 'g'), '</?(?:p|h1)>') as parts
  from pages),
b as (
  select page_id, url, list_filter(list_transform(parts, lambda p: trim(regexp_replace(
      replace(replace(replace(replace(replace(p, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&'),
      '\s+', ' ', 'g'))), lambda p: p <> '') as blocks from a)
select page_id, url, coalesce(array_to_string(blocks, chr(10) || chr(10)), '') as text,
       coalesce(length(array_to_string(blocks, chr(10) || chr(10))), 0)::bigint as n_chars
from b"""


def _repair() -> str:
    """Cheapest edits row by row: the least (cost, audit, text) for each state of the accepted roles."""
    def then(state: str, cost: str, label: str, line: str | None = None) -> str:
        out = f"{state}.o" if line is None else f"{state}.o || chr(10) || {line}"
        return (f"case when {state} is not null then {{'c': {state}.c + {cost}, 'a': {state}.a || '{label}', 'o': {out}}} end")

    least = lambda *xs: f"list_sort(list_filter([{', '.join(xs)}], lambda x: x is not null))[1]"
    put = lambda s, role: then(s, "2", "I", f"'{role}:'")
    keep = lambda s, initial: f"case when f.fault not in (1, 2) and f.role[1] = '{initial}' then {then(s, 'f.more', 'K', 'f.line')} end"
    again = lambda s, role: f"case when f.fault not in (1, 2) then {then(s, '2 + f.more', 'R', chr(39) + role + ':' + chr(39) + ' || f.text')} end"
    moved = [
        then("b0", "3", "D"),
        least(then("b1", "3", "D"), keep("b0", "s")),
        least(then("b2", "3", "D"), *(x for s in ("b0", "b1", "b3") for x in (keep(s, "u"), again(s, "user")))),
        least(then("b3", "3", "D"), keep("b2", "a"), again("b2", "assistant")),
    ]
    closed2 = least("m2", *(put(s, "user") for s in ("m0", "m1", "m3")))
    both = lambda s: then(s, "4", "II", "'user:' || chr(10) || 'assistant:'")
    closed3 = least("m3", put("m2", "assistant"), both("m0"), both("m1"))
    return rf"""
with recursive crc as ({_CRC_TABLE}),
k as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         {_crc("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as kind
  from conversations, crc),
d as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(range(case when kind = 3 then 2 else 1 end)) as copy
  from k where kind <> 0),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) as r from d),
f as (
  select conv_id, turn, role, text, r, role || ':' || text as line,
         case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 1
              when row_number() over (partition by conv_id, role, text order by r) > 1 then 2
              when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 3 else 0 end as fault,
         case when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 1 else 0 end as more,
         lag(role) over (partition by conv_id order by r) as role_before
  from o),
n as (
  select conv_id, count(*) as rows_, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
         sum((fault = 1)::int)::bigint as blank, sum((fault = 2)::int)::bigint as duplicate,
         sum((fault = 3)::int)::bigint as truncated,
         sum((r > 1 and role_before[1] || role[1] not in ('su', 'ua', 'au'))::int)::bigint as illegal
  from f group by conv_id),
s as (
  select conv_id, 0::bigint as r, {{'c': 0, 'a': '', 'o': ''}} as b0, null::struct(c integer, a varchar, o varchar) as b1,
         {{'c': 2, 'a': 'I', 'o': chr(10) || 'user:'}} as b2,
         {{'c': 4, 'a': 'II', 'o': chr(10) || 'user:' || chr(10) || 'assistant:'}} as b3
  from n
  union all
  select conv_id, r, m0, m1, {closed2}, {closed3} from (
    select s.conv_id, f.r, {moved[0]} as m0, {moved[1]} as m1, {moved[2]} as m2, {moved[3]} as m3
    from s join f on s.conv_id is not distinct from f.conv_id and f.r = s.r + 1)),
e as (
  select s.conv_id, {least('b0', 'b3')} as b from s join n on s.conv_id is not distinct from n.conv_id and s.r = n.rows_)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(b.c, 0)::bigint as cost,
       coalesce(b.a, '') as audit, sha256(coalesce(substr(b.o, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join n on c.conv_id is not distinct from n.conv_id
left join e on c.conv_id is not distinct from e.conv_id"""


REPAIR = _repair()

SPELLING = f"""
with recursive crc as ({_CRC_TABLE}),
runs as (
  select coalesce(doc_id::varchar, '') as id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as run
  from documents),
each_run as (select id, run, count(*) as m from runs where length(run) > 5 group by id, run),
hashed as (select run, m, {_crc("id || ':' || run")} as h from each_run, crc),
made as (
  select case when h % 199 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, m
  from hashed),
v as (select word, sum(m)::bigint as n from made where length(word) >= 6 group by word having sum(m) >= 5),
cut as (
  select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from (select word, unnest(range(1, length(word) + 1))::int as i from v)),
pairs as (
  select a.word, b.word as near from cut a join cut b using (i, rest) where a.word <> b.word
  union select cut.word, v.word from cut join v on cut.rest = v.word
  union select v.word, cut.word from cut join v on cut.rest = v.word),
best as (
  select p.word, count(*) as n_near, max(n) as most
  from pairs p join v on v.word = near group by p.word),
first_of as (
  select p.word, min(near) as near from pairs p join v on v.word = near join best on best.word = p.word and v.n = best.most
  group by p.word),
form as (
  select v.word, n, coalesce(n_near, 0)::bigint as n_near, case when most >= 5 * n then near end as form,
         case when most >= 5 * n then most end as form_n
  from v left join best using (word) left join first_of using (word)),
walk as (
  select word, word as at, form as next from form
  union all select w.word, w.next, f.form from walk w join form f on f.word = w.next)
select form.word, form.form, walk.at as root, n, n_near, form_n
from form join walk on walk.word = form.word and walk.next is null"""
