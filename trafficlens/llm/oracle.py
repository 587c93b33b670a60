"""DuckDB SQL of the operators that SQL can express."""

CONTAMINATION = r"""
with recursive d as (
  select row_number() over () rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws
  from documents),
b as (
  select cast(item_id as varchar) item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws
  from benchmark),
bw as (
  select distinct item, least(13, len(ws)) n, array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') k
  from b, unnest(range(1, greatest(len(ws) - 11, 2))) t(i) where len(ws) > 0),
sizes as (select distinct n from bw),
dw as (
  select rid, i, n, array_to_string(ws[i:i + n - 1], ' ') k
  from (select rid, ws, n, unnest(range(1, len(ws) - n + 2)) i from d, sizes where len(ws) >= n)),
hits as (select rid, i, dw.n, item from dw join bw using (n, k)),
pos as (select distinct rid, j from (select rid, unnest(range(i, i + n)) j from hits)),
nh as (select rid, count(*) n_hit from pos group by rid),
its as (select rid, count(*) n_items, string_agg(item, ',' order by item) s
        from (select distinct rid, item from hits) group by rid)
select doc_id, cast(len(ws) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
       sha256(coalesce(s, '')) items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) contaminated
from d left join nh using (rid) left join its using (rid)
"""

REPETITION = r"""
with d as (
  select row_number() over () rid, doc_id, coalesce(text, '') t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws from documents),
win as (
  select rid, n, i, array_to_string(ws[i:i + n - 1], ' ') k
  from (select rid, ws, n, unnest(range(1, len(ws) - n + 2)) i
        from d, (values (8), (101)) s(n) where len(ws) >= n)),
rep as (select rid, n, i from (select *, count(*) over (partition by rid, n, k) c from win) where c > 1),
pos as (select distinct rid, j from (select rid, unnest(range(i, i + 8)) j from rep where n = 8)),
cov as (select rid, count(*) n, sum(length(ws[j])) chars from pos join d using (rid) group by rid),
long as (select distinct rid, true over_long from rep where n = 101),
lines as (select rid, unnest(string_split(t, chr(10))) line from d),
dup as (select rid, sum(c - 1) n from (select rid, line, count(*) c from lines
        where regexp_matches(line, '[^\x20\x09-\x0D]') group by rid, line) group by rid),
r as (
  select doc_id, cast(len(ws) as bigint) n_words,
         cast(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as bigint) word_chars,
         cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) n_symbols,
         cast(coalesce(dup.n, 0) as bigint) n_dup_lines, coalesce(cov.n, 0) n_repeat_words,
         coalesce(cov.chars, 0) chars, coalesce(over_long, false) over_long
  from d left join cov using (rid) left join long using (rid) left join dup using (rid)),
j as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words base_failed from r)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and chars / greatest(word_chars, 1) <= 0.3 and not over_long kept
from j
"""

LINE_DEDUP = r"""
with d as (select row_number() over () rid, doc_id, coalesce(text, '') t from documents),
l as (select rid, doc_id, string_split(regexp_replace(t, '((?:[.!?]+[''")\]]*[ \t]+|\n)[ \t-\r]*)',
                                       '\1' || chr(57344), 'g'), chr(57344)) tiles from d),
x as (select rid, doc_id, unnest(tiles) tile, generate_subscripts(tiles, 1) n from l),
w as (select *, regexp_extract_all(translate(tile, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x20\x09-\x0D]+') ws,
             sum(length(tile)) over (partition by rid order by n) - length(tile) a
      from x where tile <> '' or n = 1),
u as (select rid, n, len(ws) > 0 and row_number() over (
        partition by len(ws) > 0, array_to_string(ws, ' ') order by doc_id nulls last, rid, n) > 1 later from w),
r as (select w.*, later, n - row_number() over (partition by rid, later order by n) run from w join u using (rid, n)),
j as (select *, later and sum(len(ws)) over (partition by rid, later, run) >= 30 gone from r)
select doc_id, coalesce(string_agg(tile, '' order by n) filter (not gone), '') as text,
       count(*) filter (tile <> '') n_units, count(*) filter (gone) n_removed,
       coalesce(string_agg(cast(a as bigint) || ':' || cast(a + length(tile) as bigint), ',' order by n)
                filter (gone), '') removed_spans
from j group by rid, doc_id
"""
