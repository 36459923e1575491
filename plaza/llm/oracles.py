"""DuckDB SQL with the results of the queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[0-9a-z\x{80}-\x{10FFFF}]+')"

SQL: dict[str, str] = {
    "op4_jaccard_join": f"""with recursive d as (select doc_id, regexp_extract_all({_LOWER}, {_SPACED}) as w from documents),
sh as (select distinct doc_id, array_to_string(list_slice(w, s, s + k - 1), ' ') as h from (select doc_id, w, least(5, len(w)) as k, unnest(range(1, len(w) - least(5, len(w)) + 2)) as s from d where len(w) > 0)),
n as (select doc_id, count(*) as n from sh group by 1),
links as (select x, y from (select a.doc_id as x, b.doc_id as y, count(*) as c from sh a join sh b using (h) where a.doc_id <> b.doc_id group by 1, 2) join n u on u.doc_id = x join n v on v.doc_id = y where 100 * c >= 75 * (u.n + v.n - c)),
reach as (select doc_id as x, doc_id as y from d union select reach.x, links.y from reach join links on reach.y = links.x)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, coalesce(n_links, 0) as n_links
from d left join n using (doc_id) left join (select x as doc_id, min(y) as component_id from reach group by 1) using (doc_id) left join (select x as doc_id, count(*) as n_links from links group by 1) using (doc_id)""",
    "op5_chat_format": r"""with r as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok')
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(15 + length(role) + 2 * length(text) - length(replace(replace(replace(text, '\', ''), '<', ''), '>', ''))) as bigint) as formatted_chars
from r group by conv_id""",
    "op7_mixing": f"""with recursive t as (select doc_id, source, coalesce(len(regexp_extract_all(text, {_SPACED})), 0) as tokens, md5(coalesce(text, '')) as digest from documents),
s as (select source, cast(sum(tokens) as bigint) as tokens from t group by 1 having sum(tokens) > 0),
l as (select list(tokens) as tk, sum(tokens)::double as budget from s),
b as (select 0 as step, 0::double as low, 1::double as high
  union all select step + 1, case when ok then low else mid end, case when ok then mid else high end
  from (select *, (select list_max(list_transform(tk, lambda x: pow(x / budget, mid) * budget / x)) <= 2 * list_sum(list_transform(tk, lambda x: pow(x / budget, mid))) from l) as ok from (select *, (low + high) / 2 as mid from b where step < 36))),
q as (select source, tokens, cast(round(pow(tokens / budget, e) / sum(pow(tokens / budget, e)) over () * budget) as bigint) as quota from s, l, (select high as e from b where step = 36)),
p as (select *, (quota + tokens - 1) // tokens - 1 as last from q where quota > 0),
drawn as (select *, ('0x' || left(md5(concat_ws(':', '0', block, coalesce(doc_id::varchar, ''), digest)), 12))::bigint / 281474976710656::double as place
  from (select doc_id, t.source, t.tokens as n, digest, p.tokens, quota, last, unnest(range(0, last + 1)) as block from t join p on t.source is not distinct from p.source)),
c as (select source, min(place) as cut from (select *, sum(n) over (partition by source order by place) as reached from drawn where block = last) where reached >= quota - last * tokens group by 1)
select doc_id, drawn.source, block, round(least((block + place) * tokens / greatest(quota, (last + cut) * tokens), 1), 6) as mix_order, n as n_tokens
from drawn join c on drawn.source is not distinct from c.source where block < last or place <= cut""",
    "op10_decontaminate": f"""with d as (select doc_id, {_WORDS} as w from documents),
i as (select cast(item_id as varchar) as item_id, w, least(10, len(w)) as k from (select item_id, {_WORDS} as w from benchmark) where len(w) > 0),
iw as (select distinct item_id, k, array_to_string(list_slice(w, s, s + k - 1), ' ') as win from (select item_id, w, k, unnest(range(1, len(w) - k + 2)) as s from i)),
dw as (select doc_id, s, k, array_to_string(list_slice(w, s, s + k - 1), ' ') as win from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as s from d, (select distinct k from iw) where len(w) >= k)),
h as (select doc_id, s, k, item_id from dw join iw using (k, win)),
n as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + k)) as p from h) group by 1),
t as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items from (select distinct doc_id, item_id from h) group by 1)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (doc_id) left join t using (doc_id)""",
    "op11_fill_in_middle": r"""with t as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u, sha256('42:' || coalesce(doc_id::varchar, '')) as h from documents),
d as (select *, len(u) as n, list_transform([0, 1, 2, 3], lambda k: ('0x' || substr(h, 8 * k + 1, 8))::bigint) as r from t),
f as (select *, least(r[1] % (n + 1), r[2] % (n + 1)) as a, greatest(r[1] % (n + 1), r[2] % (n + 1)) as b,
  case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or r[3] % 100 >= 50 then 'plain' when r[4] % 100 < 80 then 'spm' else 'psm' end as form from d),
p as (select *, array_to_string(u[1:a], '') as pre, array_to_string(u[a + 1:b], '') as mid, array_to_string(u[b + 1:n], '') as suf from f)
select doc_id, n, form, case when form <> 'plain' then length(pre) end as prefix_chars, case when form <> 'plain' then length(mid) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256, sha256(text) as restored_sha256
from p""",
    "op12_view_maintenance": """with tab as (select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
named as (select *, xor(list_reduce([4294967295] || list_transform(string_split(name, ''), lambda x: ascii(x)::bigint), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as h from tab, (
  select 'c' || client_id as name from clients union select 's' || sale_id from sales union select 'l' || sale_id || ':' || line_no from sale_lines)),
life as (select name, case when h % 7 < h // 7 % 7 then h % 7 else 0 end as a, case when h % 7 < h // 7 % 7 then h // 7 % 7 else 7 end as d from named),
joined as (select c.client_id, i.item_id, cn.n_regionkey as region, date_diff('day', date '1970-01-01', s.sold_at::date) as part,
    floor(100 * i.amount + 0.5)::bigint * (100 - floor(100 * i.discount + 0.5)::bigint) as revenue, greatest(coalesce(lc.a, 0), coalesce(ls.a, 0), coalesce(ll.a, 0)) as a, least(coalesce(lc.d, 7), coalesce(ls.d, 7), coalesce(ll.d, 7)) as d
  from sale_lines i join sales s using (sale_id) join clients c on c.client_id = s.client_id join vendors v using (vendor_id)
    join nation cn on cn.n_nationkey = c.nation_id join nation vn on vn.n_nationkey = v.nation_id and vn.n_regionkey = cn.n_regionkey
    left join life lc on lc.name = 'c' || c.client_id left join life ls on ls.name = 's' || s.sale_id left join life ll on ll.name = 'l' || i.sale_id || ':' || i.line_no
  where i.amount is not null and s.sold_at is not null)
select batch::integer as batch, region, part, count(*) as n_lines, sum(revenue)::bigint as revenue, min(revenue) as min_revenue, count(distinct client_id) as n_clients, count(distinct item_id) as n_items
from joined join (select unnest(range(7)) as batch) on a <= batch and batch < d group by 1, 2, 3""",
}
