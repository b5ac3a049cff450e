"""DuckDB SQL for the queries of this package that SQL can state."""

from __future__ import annotations

from gridseries.llm import urls

QUALITY = r"""
with w as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
l as (
  select *, len(w) as n, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l,
    row_number() over () as r
  from w),
grams as (
  select r, unnest(list_transform(range(1, n - 6), lambda i: struct_pack(i := i, g := list_slice(w, i, i + 7)))) as x
  from l where n > 8),
repeated as (
  select r, x.i as i from grams qualify count(*) over (partition by r, x.g) > 1),
covered as (
  select r, sum(least(8, coalesce(following - i, 8))) as n_repeat_words
  from (select r, i, lead(i) over (partition by r order by i) as following from repeated) group by r),
m as (
  select doc_id, n as n_words, length(array_to_string(w, '')) as word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, len(l) - len(list_distinct(l)) as n_dup_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words, len(l) as n_lines,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) as n_letter_words,
    len(list_filter(w, lambda x: upper(x) = x and lower(x) <> x)) as n_upper_words,
    length(t) - length(replace(t, '!', '')) as n_exclamations, len(list_distinct(w)) as n_distinct_words,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) as n_ellipsis_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^\s*[-*•‣●]'))) as n_bullet_lines,
    case when n <= 4096 then len(list_distinct(w)) else list_sum(list_transform(range((n - 1) // 4096 + 1), lambda k:
      len(list_distinct(list_slice(w, least(k * 4096, n - 4096) + 1, least(k * 4096, n - 4096) + 4096))))) end as near_distinct,
    case when n <= 4096 then n else ((n - 1) // 4096 + 1) * 4096 end as near_words
  from l left join covered using (r)),
f as (
  select *, n_words < 20 as f0, 100 * n_repeat_words > 30 * n_words as f1, 100 * n_symbols > 10 * n_words as f2,
    100 * n_letter_words < 60 * n_words as f3, 100 * n_upper_words > 50 * n_words as f4,
    100 * n_exclamations > 30 * n_words as f5, 100 * n_distinct_words < 15 * n_words as f6,
    100 * n_dup_lines > 50 * n_lines as f7, word_chars < 2 * n_words or word_chars > 20 * n_words as f8,
    100 * n_ellipsis_lines > 30 * n_lines as f9, 100 * n_bullet_lines > 90 * n_lines as f10,
    100 * near_distinct < 15 * near_words as f11
  from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f0 or f1 as base_failed,
  not (f0 or f1 or f2 or f3 or f4 or f5 or f11)
    and cast(f7 as int) + cast(f8 as int) + cast(f9 as int) + cast(f10 as int) < 2 as kept,
  cast(cast(f0 as int) + 2 * cast(f1 as int) + 4 * cast(f2 as int) + 8 * cast(f3 as int) + 16 * cast(f4 as int)
    + 32 * cast(f5 as int) + 64 * cast(f6 as int) + 128 * cast(f7 as int) + 256 * cast(f8 as int)
    + 512 * cast(f9 as int) + 1024 * cast(f10 as int) + 2048 * cast(f11 as int) as bigint) as failures
from f
"""


_TERM = "len(list_filter([{terms}], lambda t: regexp_matches(u, '(^|[^a-z0-9])' || t || '([^a-z0-9]|$)')))"


def _url_sql() -> str:
    def count(terms):
        return _TERM.format(terms=", ".join(f"'{t}'" for t in terms))

    rules = ""
    for verdict, rule in sorted(urls.RULES, key=lambda x: -len(x[1])):
        host, _, path = rule.partition("/")
        rules += (f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '/{path}') "
                  f"then '{verdict} {rule}'\n    ")
    return f"""
with u as (
  select page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as u,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path
  from pages),
r as (
  select *, case {rules}end as r, {count(urls.STRICT)} as strict, {count(urls.SOFT)} as soft from u)
select page_id, host, path, split_part(r, ' ', 2) as rule,
  coalesce(split_part(r, ' ', 1), case when strict > 0 or soft >= {urls.SOFT_LIMIT} then 'block' else 'allow' end) as verdict
from r
"""


WARC = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
    cast(cast(unhex(sha1(coalesce(html, ''))) as bit) as varchar) as bits
  from pages),
d as (
  select page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(
        16 * cast(substr(bits, 5 * i + 1, 1) as int) + 8 * cast(substr(bits, 5 * i + 2, 1) as int)
        + 4 * cast(substr(bits, 5 * i + 3, 1) as int) + 2 * cast(substr(bits, 5 * i + 4, 1) as int)
        + cast(substr(bits, 5 * i + 5, 1) as int) as int), 1)), '') as payload_digest
  from p),
m as (select *, max(page_id) over (partition by payload_digest) as first from d)
select page_id, payload_bytes, payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from m
"""


LEAKS = r"""
with dw as (
  select doc_id, row_number() over () as r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
iw as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
i as (
  select item_id, least(len(w), 5) as l, unnest(list_distinct(list_transform(
    range(1, len(w) - least(len(w), 5) + 2), lambda k: array_to_string(list_slice(w, k, k + least(len(w), 5) - 1), ' ')))) as s
  from iw where len(w) > 0),
n as (select item_id, count(*) as n_shingles from i group by item_id),
d as (
  select distinct r, doc_id, l, unnest(list_transform(
    range(1, len(w) - l + 2), lambda k: array_to_string(list_slice(w, k, k + l - 1), ' '))) as s
  from dw, (select distinct l from i) where len(w) >= l),
c as (select doc_id, r, item_id, count(*) as n_shared from d join i using (l, s) group by all)
select doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles as containment
from c join n using (item_id) where 10 * n_shared >= 8 * n_shingles
"""


LINES = r"""
with t as (select doc_id, coalesce(text, '') as t, row_number() over (order by doc_id) as r from documents),
u as (
  select r, doc_id, unnest(string_split(t, chr(10))) as s, generate_subscripts(string_split(t, chr(10)), 1) - 1 as line
  from t),
l as (
  select r, line, s, len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) as n,
    row_number() over (partition by r order by line) - 1 as p
  from u where regexp_matches(s, '[^\x20\x09-\x0D]')),
c as (select *, sum(n) over (partition by r order by p) as upto from l),
w as (
  select a.r, a.p, min(b.p) - a.p + 1 as len
  from c a join c b on a.r = b.r and b.p >= a.p and b.p < a.p + 50 and b.upto >= a.upto - a.n + 50
  group by a.r, a.p),
k as (
  select w.r, w.p, w.len, string_agg(c.s, chr(10) order by c.p) as content
  from w join c on c.r = w.r and c.p >= w.p and c.p < w.p + w.len group by all),
f as (select *, first_value(r) over o as fr, first_value(p) over o as fat from k window o as (
  partition by content, len order by r, p)),
m as (select distinct r, p, len, fr, p - fat as shift from f where r <> fr or p <> fat),
apart as (
  select m.r, m.fr, m.shift, x.p
  from (select distinct r, fr, shift from m) m
  join (select r, p, s from c union all select r, max(p) + 1, null from c group by r union all select r, -1, null
    from c group by r) x on x.r = m.r
  left join c y on y.r = m.fr and y.p = x.p - m.shift
  where x.s is null or y.s is null or x.s <> y.s),
e as (
  select m.r, m.p, m.len, m.fr, m.shift, max(a.p) filter (a.p < m.p) + 1 as lo, min(a.p) filter (a.p >= m.p) as hi
  from m join apart a on a.r = m.r and a.fr = m.fr and a.shift = m.shift group by all),
gone as (select distinct c.r, c.line from e join c on c.r = e.r and c.p >= e.lo and c.p < e.hi),
g as (select r, count(*) as n_removed, string_agg(cast(line as varchar), ',' order by line) as removed_lines from gone group by r),
kept as (
  select u.r, string_agg(u.s, chr(10) order by u.line) as kept
  from u left join gone on gone.r = u.r and gone.line = u.line where gone.r is null group by u.r)
select t.doc_id, coalesce(n_removed, 0) as n_removed, coalesce(removed_lines, '') as removed_lines,
  md5(coalesce(kept, '')) as kept_md5
from t left join g using (r) left join kept using (r)
"""


def _merkle_sql(levels: int = 9) -> str:
    """Trees of up to 8^levels leaves: runs of 8 level by level, first inside each language, then over their subroots."""
    fields = ["doc_id", "source", "lang", "n_chars"]

    def field(value: str) -> str:
        return f"coalesce(cast(octet_length(encode(cast({value} as varchar))) as varchar) || ':' || cast({value} as varchar), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in [*fields, text]) + ")"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = ("xor(4294967295, list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::bigint), "
           "lambda c, b: list_reduce(range(8), lambda s, i: xor(s >> 1, (s & 1) * 3988292384), xor(c, b)), 4294967295::bigint))")
    parts = [f"""
l as (
  select doc_id, coalesce('=' || lang, '') as g, {leaf('text')} as leaf, {crc} % 3 = 0 as hit, {leaf(low)} as lowered
  from documents),
p as (
  select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as place, count(*) over (partition by g) as n
  from l),
n0 as (select g, place, n, leaf as d from p)"""]

    def grown(name: str, upto: int) -> str:
        for k in range(upto):
            parts.append(f"""
{name}{k + 1} as (
  select g, place // 8 as place, (n + 7) // 8 as n, sha256(string_agg(d, '' order by place)) as d
  from {name}{k} where n > 1 group by all),
{name}s{k} as (
  select g, place, coalesce(string_agg(d, '') over (r rows between unbounded preceding and 1 preceding), '') as before,
    coalesce(string_agg(d, '') over (r rows between 1 following and unbounded following), '') as after
  from {name}{k} where n > 1 window r as (partition by g, place // 8 order by place))""")
        return " union all ".join(f"select g, d from {name}{k} where n = 1" for k in range(upto + 1))

    def climbed(state: str, name: str, at: str, key: str, upto: int) -> str:
        for k in range(upto):
            parts.append(f"""
{state}{name}{k} as (
  select x.* replace (proof || coalesce(before, '') || coalesce(after, '') as proof,
    case when s.place is null then folded else sha256(before || folded || after) end as folded)
  from {state} x left join {name}s{k} s on s.g = {key} and s.place = x.{at} // {8**k})""")
            state = f"{state}{name}{k}"
        return state

    tops = grown("n", levels)
    parts.append(f"""
t as ({tops}),
m0 as (
  select '' as g, row_number() over (order by encode(g)) - 1 as place, count(*) over () as n, d, g as lang from t),
x as (
  select doc_id, leaf, p.g, p.place, m0.place as upper, m0.d as subroot, '' as proof,
    case when hit then lowered else leaf end as folded
  from p join m0 on m0.lang = p.g)""")
    root = grown("m", 3)
    end = climbed(climbed("x", "n", "place", "x.g", levels), "m", "upper", "''", 3)
    parts.append(f"""
root as ({root})""")
    return "with " + ",".join(parts) + f"""
select doc_id, leaf, subroot, root.d as root, sha256(proof) as proof_sha256, folded as folded_root, folded = root.d as verified
from {end}, root
"""


def all_sql() -> dict[str, str]:
    return {"op2_quality": QUALITY, "op5_decontamination": LEAKS, "op8_lines": LINES, "op9_urls": _url_sql(),
            "op10_warc": WARC, "op13_merkle": _merkle_sql()}
