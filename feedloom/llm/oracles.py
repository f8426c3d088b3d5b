"""SQL of those queries of this folder that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
with docs as (select row_number() over () as rid, doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
lines as (select rid, unnest(l) as line, generate_subscripts(l, 1) as i from docs),
keyed as (select *, translate(trim(line, {_BLANKS}), '{UPPER}', '{LOWER}') as key from lines),
common as (select key from keyed where length(key) >= 1 group by key having count(distinct rid) >= 10),
marked as (select rid, i, line, key in (select key from common) as gone from keyed),
texts as (
  select rid, count(*) as n_lines, count(*) filter (gone) as n_dropped,
         coalesce(string_agg(line, chr(10) order by i) filter (not gone), '') as kept
  from marked group by rid)
select doc_id, n_lines, n_dropped, sha256(kept) as kept_sha256 from docs join texts using (rid)
"""

#: Unsigned crc32 of an ASCII text, bit by bit (the reflected polynomial 0xEDB88320).
_CRC32 = """xor(4294967295, list_reduce(
  list_concat([4294967295::bigint], list_transform(string_split({0}, ''), lambda c: ascii(c)::bigint)),
  lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
    lambda x, unused: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)))"""

PREFIX_TRIE = f"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, role, text) as t
  from conversations where conv_id is not null),
heads as (
  select conv_id, own, conv_id - conv_id % 20 as base, {_CRC32.format("conv_id::varchar")} % 4 as h
  from (select conv_id, max(t) as own from turns group by conv_id)),
facts as (
  select a.*, least(a.h, coalesce(b.own, 0)) as m, least(a.h, coalesce(b.own, 0)) + greatest(a.own - a.h, 0) as length
  from heads a left join heads b on a.base = b.conv_id),
built as (
  select conv_id, t - h + m as depth, role, text from turns join facts using (conv_id) where t > h
  union all
  select f.conv_id, t, role, text from turns join facts f on turns.conv_id = f.base and t <= f.m),
keyed as (
  select conv_id, depth, text, md5(string_agg(md5(role) || md5(text), '') over (partition by conv_id order by depth)) as node from built
  union all select conv_id, 0, '', '' from facts),
named as (
  select *, min(conv_id) over (partition by depth, node) as rep, count(*) over (partition by depth, node) as n from keyed),
nodes as (
  select rep, depth, any_value(n) as n,
         (any_value(n) - 1) * any_value(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))) as own_tokens
  from named group by rep, depth),
edges as (
  select c.rep, c.depth, p.rep as parent from nodes c left join named p on p.conv_id = c.rep and p.depth = c.depth - 1),
kids as (select parent as rep, depth - 1 as depth, count(*) as n_children from edges where parent is not null group by all),
below as (
  select a.rep, a.depth, sum(y.own_tokens) as saved, count(*) filter (k.n_children is null) as leaves
  from nodes y join named a on a.conv_id = y.rep and a.depth <= y.depth
  left join kids k on k.rep = y.rep and k.depth = y.depth group by a.rep, a.depth),
ends as (
  select rep, depth, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as digest
  from named join facts using (conv_id) where depth = length group by rep, depth)
select rep as conv_id, depth, parent as parent_conv_id, n as n_convs, coalesce(n_children, 0) as n_children,
       leaves as n_leaves, saved::bigint as saved_tokens, coalesce(digest, sha256('')) as ends_sha256
from nodes join edges using (rep, depth) join below using (rep, depth)
left join kids using (rep, depth) left join ends using (rep, depth)
"""

_BODY = "[^\\x20\\x09-\\x0D]"
#: Cheapest edits by a table per row and place (0 nothing yet, 1 after s, 2 after u, 3 after a).
STRUCTURE_REPAIR = f"""
with recursive dealt as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         {_CRC32.format("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 as fault from conversations),
hurt as (
  select conv_id, turn, case when fault = 4 then 'user' else role end as role,
         case fault when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from dealt, lateral (select unnest(range(case fault when 0 then 0 when 3 then 2 else 1 end))) c),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from hurt),
seen as (
  select *, row_number() over (partition by conv_id, role, text order by i) as nth, left(role, 1) as initial,
         lag(left(role, 1)) over (partition by conv_id order by i) as before,
         regexp_extract(text, '({_BODY})[\\x20\\x09-\\x0D]*$', 1) as last
  from placed),
judged as (
  select *, case when last = '' then 'blank' when nth > 1 then 'duplicate' when last not in ('.', '!', '?') then 'truncated' else 'ok' end as kind
  from seen),
places as (select unnest([0, 1, 2, 3]) as place, unnest([2, 2, 3, 2]) as next, unnest([3, 3, 2, 3]) as after),
inserts as (
  select place, 0 as cost, '' as steps, place as then_at, []::varchar[] as made from places
  union all select place, 5, 'I', next, [if(next = 2, 'user:', 'assistant:')] from places
  union all select place, 10, 'II', after, [if(next = 2, 'user:', 'assistant:'), if(next = 2, 'assistant:', 'user:')] from places),
best as (
  select conv_id, 0::bigint as i, then_at as place, struct_pack(cost := cost::bigint, audit := steps, made := made) as way
  from (select distinct conv_id from conversations), inserts where inserts.place = 0
  union all
  select conv_id, i, place, min(way) from (
    select e.conv_id, e.i, n.then_at as place,
           struct_pack(cost := e.cost + n.cost, audit := e.audit || n.steps, made := list_concat(e.made, n.made)) as way
    from (
      select j.conv_id, j.i, b.place, b.way.cost + 2 as cost, b.way.audit || 'D' as audit, b.way.made as made
      from best b join judged j on j.conv_id is not distinct from b.conv_id and j.i = b.i + 1
      union all
      select j.conv_id, j.i, case j.initial when 's' then 1 when 'u' then 2 else 3 end,
             b.way.cost + if(j.kind = 'truncated', 5, 0), b.way.audit || 'K', list_append(b.way.made, j.role || ':' || j.text)
      from best b join judged j on j.conv_id is not distinct from b.conv_id and j.i = b.i + 1
      where j.kind in ('ok', 'truncated') and
            (j.initial = 's' and b.place = 0 or j.initial = 'u' and b.place <> 2 or j.initial = 'a' and b.place = 2)
      union all
      select j.conv_id, j.i, p.next, b.way.cost + if(j.kind = 'truncated', 6, 1), b.way.audit || 'R',
             list_append(b.way.made, if(p.next = 2, 'user:', 'assistant:') || j.text)
      from best b join judged j on j.conv_id is not distinct from b.conv_id and j.i = b.i + 1 join places p on p.place = b.place
      where j.kind in ('ok', 'truncated')) e
    join inserts n on n.place = e.place) group by conv_id, i, place),
ends as (
  select b.conv_id, min(b.way) as way from best b
  left join (select conv_id, max(i) as rows from judged group by conv_id) r on r.conv_id is not distinct from b.conv_id
  where b.i = coalesce(r.rows, 0) and b.place in (0, 3) group by b.conv_id),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (kind = 'blank') as blank,
         count(*) filter (kind = 'duplicate') as duplicate, count(*) filter (kind = 'truncated') as truncated,
         count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
  from judged group by conv_id)
select e.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, e.way.cost as cost, e.way.audit as audit,
       sha256(array_to_string(e.way.made, chr(10))) as repaired_sha256
from ends e left join counts c on c.conv_id is not distinct from e.conv_id
"""
