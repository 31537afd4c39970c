"""DuckDB SQL for the queries that SQL can express (on the given tables)."""

from __future__ import annotations

from math import ceil

from vellum.llm.licenses import CONTAINMENT, PHRASES, TEMPLATES

LOW = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"coalesce(regexp_extract_all(" + LOW + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

SQL: dict[str, str] = {}

SQL["op5_decontaminate"] = f"""
with d as (select doc_id, {WORDS.format("text")} w from documents),
b as (select item_id, w, least(len(w), 10) n from (select item_id, {WORDS.format("text")} w from benchmark) where len(w) > 0),
bw as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') s from (select *, unnest(range(1, len(w) - n + 2)) i from b)),
lens as (select distinct n from b),
dw as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') s
       from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from d, lens)),
hits as (select doc_id, i, n, item_id from dw join bw using (n, s)),
words as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from hits) group by doc_id),
found as (select doc_id, count(distinct item_id) n_items, sha256(string_agg(distinct item_id::varchar, ',' order by item_id::varchar)) s
          from hits group by doc_id)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
       coalesce(s, sha256('')) items_sha256, n_hit is not null contaminated
from d left join words using (doc_id) left join found using (doc_id)
"""

# windows: 3 lines, or fewer that hold 50 words
SQL["op3_line_dedup"] = """
with d as (select doc_id, text, string_split(text, chr(10)) ls from documents),
l as (select doc_id, i, trim(ls[i + 1], ' ' || chr(9) || chr(13) || chr(11) || chr(12)) x from (select *, unnest(range(len(ls))) i from d)),
p as (select *, len(string_split_regex(x, '[ \\x09\\x0B-\\x0D]+')) c, row_number() over (partition by doc_id order by i) p from l where x <> ''),
t as (select *, lead(i, 1) over q i2, lead(i, 2) over q i3, lead(x, 1) over q x2, lead(x, 2) over q x3, lead(c, 1) over q c2
      from p window q as (partition by doc_id order by p)),
w as (select doc_id, p, 3 n, [i, i2, i3] lines, [x, x2, x3] xs from t where x3 is not null
      union all select doc_id, p, 2, [i, i2], [x, x2] from t where c + c2 >= 50
      union all select doc_id, p, 1, [i], [x] from t where c >= 50),
r as (select * from (select *, row_number() over (partition by xs order by doc_id, p) k from w) where k > 1),
gone as (select distinct doc_id, unnest(lines) i from r),
runs as (select doc_id, count(*) filter (p > coalesce(reach, -1)) n_runs
      from (select *, max(p + n) over (partition by doc_id order by p, n rows between unbounded preceding and 1 preceding) reach from r) group by doc_id),
kept as (select d.doc_id, string_agg(ls[i + 1], chr(10) order by i) t from (select *, unnest(range(len(ls))) i from d) d anti join gone g on g.doc_id = d.doc_id and g.i = d.i group by d.doc_id),
cut as (select doc_id, count(*) n from gone group by doc_id)
select doc_id, coalesce(len(ls), 0)::bigint n_lines, coalesce(n, 0)::bigint n_removed, coalesce(n_runs, 0)::bigint n_runs,
       sha256(coalesce(t, '')) kept_sha256
from d left join kept using (doc_id) left join cut using (doc_id) left join runs using (doc_id)
"""


def _seats(rows: str, parent: str, key: str) -> str:
    """The highest quotients, seat by seat."""
    return f"""select *, (select count(*) from (
        select {parent}, {key}, row_number() over (partition by {parent} order by ideal / (seat - 0.5) desc, {key}) rk, seats
        from (select *, unnest(range(1, (ideal + n + 2)::bigint)) seat from (select *, count(*) over (partition by {parent}) n from {rows}))) s
        where rk <= s.seats and s.{key} = r.{key} and s.{parent} = r.{parent}) won from {rows} r"""


SQL["op8_mix"] = f"""
with sized as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint size, coalesce('0' || source, '1') k,
      ('0x' || substr(md5('mix/' || coalesce(doc_id::varchar, 'null/' || md5(coalesce(text, '')))), 1, 12))::bigint draw from documents),
s0 as (select k, sum(size)::bigint words, (row_number() over (order by k) - 1) % 3 + 1 w from sized group by k),
s1 as (select *, 3 * words cap, sum(words) over () total from s0),
s2 as (select *, cap / w <= (total - coalesce(sum(cap) over q, 0)) / (sum(w) over () - coalesce(sum(w) over q, 0)) is_full
       from s1 window q as (order by cap / w, k rows between unbounded preceding and 1 preceding)),
s3 as (select k, words, total, case when is_full then cap::double else
       w * ((total - sum(case when is_full then cap else 0 end) over ()) / (sum(w) over () - sum(case when is_full then w else 0 end) over ())) end target from s2),
s4 as (select *, 0 root, target / 8 ideal, round(total / 8)::bigint seats, greatest(1, ceil(words / 50000))::bigint shards from s3),
src as materialized ({_seats("s4", "root", "k")}),
placed as (select z.*, shards, words source_size, target, draw % shards shard from sized z join src using (k)),
sh as (select k, shard, sum(size)::bigint t, shard // 1024 g from placed group by k, shard),
g0 as (select k, g, sum(t)::bigint gt from sh group by k, g),
g1 as (select g0.*, won seats, coalesce(won * (gt / nullif(words, 0)), 0.0) ideal from g0 join src using (k)),
gr as materialized ({_seats("g1", "k", "g")}),
p0 as (select sh.*, sh.k || '/' || sh.g kg, won seats, coalesce(won * (t / nullif(gt, 0)), 0.0) ideal from sh join gr on gr.k = sh.k and gr.g = sh.g),
p1 as materialized ({_seats("p0", "kg", "shard")}),
p2 as (select k, shard, t, greatest(1, round(t / 8))::bigint n, won from p1),
p3 as (select k, shard, t, n, coalesce(least(round(won * 8 * n / nullif(t, 0))::bigint, 3 * n), 0) won, ('0x' || substr(md5('mix/run/' || k || '/' || shard), 1, 12))::bigint % n f from p2),
laid as (select z.*, t, n, won, f, sum(size) over (partition by k, shard order by draw, doc_id nulls last, size rows unbounded preceding) - size s0 from placed z join p3 using (k, shard)),
e as (select *, (f * t) // n lo, ((f + won % n) * t) // n hi from laid)
select doc_id, size, source_size, target,
       ((won // n) * size + greatest(0, least(size, hi - t - s0)) + greatest(0, least(size, least(hi, t) - s0)) - greatest(0, least(size, lo - s0)))::bigint taken
from e
"""


def _phrase(label: str, phrase: str) -> str:
    p = phrase.split()
    same = " and ".join(f"w[i + {j + 1}] = '{x}'" for j, x in enumerate(p))
    return f"select doc_id, i, '{label}' label from (select doc_id, w, unnest(range(len(w))) i from d where list_contains(w, '{max(p, key=len)}')) where {same}"


def _template(label: str, text: str) -> str:
    t = text.split()
    s = sorted(set(t))
    block = f"len(list_intersect(w[i + 1:i + {2 * len(t)}], {s}))"
    return f"select doc_id, '{label}' label, max({block}) / {len(s)} share from (select doc_id, w, unnest(range(0, len(w) + 1, {len(t)})) i from d) group by doc_id having max({block}) >= {ceil(CONTAINMENT * len(s) - 1e-9)}"


SQL["op9_licenses"] = f"""
with d as (select doc_id, {WORDS.format("text")} w from documents),
places as ({" union all ".join(_phrase(*p) for p in PHRASES.items())}),
met as ({" union all ".join(_template(*t) for t in TEMPLATES)}),
base as (select doc_id, count(*) n, min(i) a, max(i) b, string_agg(distinct label, ',' order by label) l from places group by doc_id),
every as (select doc_id, string_agg(distinct label, ',' order by label) l from (select doc_id, label from places union all select doc_id, label from met) group by doc_id),
share as (select doc_id, max(share) s from met group by doc_id)
select doc_id, len(w)::bigint n_words, coalesce(n, 0)::bigint n_base, a::bigint first_word, b::bigint last_word,
       coalesce(base.l, '') base_labels, coalesce(every.l, '') labels, case when n > 0 then 1.0 else coalesce(s, 0.0) end::double score
from d left join base using (doc_id) left join every using (doc_id) left join share using (doc_id)
"""


def _crc32(text: str) -> str:
    """crc32 of an ASCII string: eight shifts a character."""
    start = "list_concat([4294967295::bigint], list_transform(string_split(" + text + ", ''), lambda z: ascii(z)::bigint))"
    shifts = "list_reduce(list_concat([xor(c, z)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce({start}, lambda c, z: {shifts}), 4294967295)"


# 16 words that stand again one period on are in every run: 24 - q >= 16 up to a
# period of 8, 2 q >= 16 from there
SQL["op11_periodic_runs"] = f"""
with d as (select doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) w, {_crc32("doc_id::varchar")} h from documents),
e as (select *, len(w) n, case when len(w) > 0 then (h // 10) % len(w) end a from d),
f as (select *, 1 + (n - a) // (3 + (h // 10) % 8) p from e),
t as materialized (select doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(range(n), lambda i: w[1 + case when i < a then i else a + (i - a) % p end]) else w end w from f),
grams as materialized (select doc_id, n, i, md5(array_to_string(w[i + 1:i + 16], ' ')) g from (select *, unnest(range(n - 15)) i from t)),
pairs as (select x.doc_id, x.i, y.i - x.i q from grams x join grams y on x.doc_id = y.doc_id and x.g = y.g and x.i < y.i and 3 * (y.i - x.i) <= x.n),
islands as (select doc_id, q, min(i) s, count(*) + 15 m from (select *, i - row_number() over (partition by doc_id, q order by i) k from pairs) group by doc_id, q, k),
runs as (select doc_id, s, m + q l, min(q) q from islands where m >= greatest(24 - q, 2 * q) group by doc_id, s, m + q),
gone as (select distinct doc_id, unnest(range(s + q, s + l)) i from runs),
kept as (select doc_id, string_agg(w[i + 1], ' ' order by i) c from (select doc_id, w, unnest(range(n)) i from t) anti join gone using (doc_id, i) group by doc_id),
told as (select doc_id, count(*) n_runs, first(s order by l::double / q desc, s, q) s, first(l order by l::double / q desc, s, q) l,
         first(q order by l::double / q desc, s, q) q, string_agg(s || ',' || l || ',' || q || chr(10), '' order by s, q) lines from runs group by doc_id)
select doc_id, coalesce(n_runs, 0)::bigint n_runs, s::bigint start, l::bigint length, q::bigint period, (1000 * l // q)::bigint exponent_milli,
       sha256(coalesce(lines, '')) runs_sha256, sha256(coalesce(c, '')) collapsed_sha256
from t left join told using (doc_id) left join kept using (doc_id)
"""


# states 1 to 4: nothing yet, after s, after u, after a; v: least costs from in front of row i, by state
SQL["op12_conversation_repair"] = f"""
with recursive raw as (select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text,
      {_crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 deal from conversations),
rows0 as (select conv_id, turn, case when deal = 4 then 'user' else role end role,
      case deal when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
      from (select *, unnest(range(case deal when 0 then 0 when 3 then 2 else 1 end)) from raw)),
rows1 as (select *, coalesce(conv_id::varchar, 'null') c, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) cut,
      row_number() over (partition by conv_id order by turn nulls first, md5(length(role) || ':' || role || ':' || text)) i from rows0),
rows2 as (select *, case when cut = '' then 'blank' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
      when right(cut, 1) not in ('.', '!', '?') then 'truncated' end fault, role[1] initial from rows1),
j as materialized (select *, fault is not null and fault <> 'truncated' forced, case when fault = 'truncated' then 3 else 0 end late from rows2),
b as (
  select c, max(i) + 1 i, [0, 6, 3, 0] v from j group by c
  union all
  select c, i, list_transform(r, lambda x, s: case s when 1 then least(x, 3 + r[3], 6 + r[4]) when 2 then least(x, 3 + r[3], 6 + r[4])
      when 3 then least(x, 3 + r[4]) else least(x, 3 + r[3]) end) v
  from (select j.c, j.i, case when forced then [4 + v[1], 4 + v[2], 4 + v[3], 4 + v[4]] else [
      least(4 + v[1], 3 + late + v[3], case initial when 's' then late + v[2] when 'u' then late + v[3] else 1e9::int end),
      least(4 + v[2], 3 + late + v[3], case initial when 'u' then late + v[3] else 1e9::int end),
      least(4 + v[3], 3 + late + v[4], case initial when 'a' then late + v[4] else 1e9::int end),
      least(4 + v[4], 3 + late + v[3], case initial when 'u' then late + v[3] else 1e9::int end)] end r
    from b join j on j.c = b.c and j.i = b.i - 1)),
g as materialized (select b.c, b.i, b.v, n.v w, role, text, initial, late, [3, 3, 4, 3] fill from b left join j on j.c = b.c and j.i = b.i left join b n on n.c = b.c and n.i = b.i + 1),
t as (
  select c, 1 i, 1 s, 0 step, null::varchar letter, null::varchar line from g where i = 1
  union all
  select c, case when letter in ('I') then i else i + 1 end, case letter when 'D' then s when 'K' then case initial when 's' then 2 when 'u' then 3 else 4 end else fill[s] end, step + 1, letter,
      case letter when 'K' then role || ':' || text when 'R' then f || text when 'I' then f end
  from (select t.c, t.i, t.s, t.step, g.fill, role, text, initial, case t.s when 3 then 'assistant:' else 'user:' end f,
      case when w is null then case when t.s in (2, 3) then 'I' end when 4 + w[t.s] = v[t.s] then 'D' when 3 + v[fill[t.s]] = v[t.s] then 'I'
           when late + w[case when initial = 's' and t.s = 1 then 2 when initial = 'u' and t.s <> 3 then 3 when initial = 'a' and t.s = 3 then 4 end] = v[t.s] then 'K' else 'R' end letter
    from t join g on g.c = t.c and g.i = t.i) where letter is not null),
told as (select c, coalesce(string_agg(letter, '' order by step), '') audit, sha256(coalesce(string_agg(line, chr(10) order by step), '')) repaired,
      3 * count(*) filter (letter in ('I', 'R')) + 4 * count(*) filter (letter = 'D') price from t group by c),
late as (select t.c, sum(late) late from (select c, i - 1 i, letter from t where letter in ('K', 'R')) t join j on j.c = t.c and j.i = t.i group by t.c),
facts as (select conv_id, c, max(turn) - min(turn) + 1 - count(distinct turn) gaps, count(*) filter (fault = 'blank') blank,
      count(*) filter (fault = 'duplicate') duplicate, count(*) filter (fault = 'truncated') truncated,
      count(*) filter (pair not in ('su', 'ua', 'au')) illegal
      from (select *, lag(initial) over (partition by c order by i) || initial pair from j) group by conv_id, c)
select k.conv_id, coalesce(gaps, 0)::bigint gaps, coalesce(blank, 0)::bigint blank, coalesce(duplicate, 0)::bigint duplicate, coalesce(truncated, 0)::bigint truncated,
      coalesce(illegal, 0)::bigint illegal, (coalesce(price, 0) + coalesce(late, 0))::bigint as cost, coalesce(audit, '') audit, coalesce(repaired, sha256('')) repaired_sha256
from (select distinct conv_id from conversations) k left join facts on facts.conv_id is not distinct from k.conv_id
left join told using (c) left join late using (c)
"""
