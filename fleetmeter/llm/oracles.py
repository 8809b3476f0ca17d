"""DuckDB SQL for the queries that SQL can express. The others have brute-force tests."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def low(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


EXACT_DEDUP = f"""
with d as (select doc_id, {low("coalesce(text, '')")} as t from documents)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id is not distinct from max(doc_id) over g as kept, sha256(t) as text_sha256
from d window g as (partition by t)
"""

WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
DECONTAMINATE = f"""
with d as (select doc_id, regexp_extract_all({low("coalesce(text, '')")}, {WORDS}) as w from documents),
i as (select item_id, regexp_extract_all({low("coalesce(text, '')")}, {WORDS}) as w from benchmark),
n as (select item_id, w, least(len(w), 10) as n from i where len(w) > 0),
iw as (select distinct item_id, n, array_to_string(w[p:p + n - 1], ' ') as g
       from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as p from n)),
dw as (select doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') as g
       from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as p
             from d cross join (select distinct n from iw) where len(w) >= n)),
m as (select doc_id, p, n, item_id from dw join iw using (n, g)),
h as (select doc_id, count(distinct q) as n_hit
      from (select distinct doc_id, unnest(range(p, p + n)) as q from (select distinct doc_id, p, n from m)) group by 1),
k as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
      from (select distinct doc_id, cast(item_id as varchar) as item from m) group by 1)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (doc_id) left join k using (doc_id)
"""

LINE_DEDUP = f"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
e as (select doc_id, unnest(ls) as l, generate_subscripts(ls, 1) as i from d),
k as (select *, {low("trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as k from e),
f as (select k from k where length(k) >= 1 group by k having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(f.k) as n_dropped,
       sha256(coalesce(string_agg(l, chr(10) order by i) filter (where f.k is null), '')) as kept_sha256
from k left join f on k.k = f.k group by doc_id
"""

SUBSTRING_DEDUP = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
g as (select doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) as h
      from (select doc_id, w, unnest(range(1, len(w) - 48)) as p from d where len(w) >= 50)),
o as (select h, min(doc_id) as owner from g group by h),
r as (select distinct doc_id, unnest(range(p, p + 50)) as q from g join o using (h) where owner < doc_id),
x as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as q from d),
s as (select x.doc_id, count(r.q) as n_removed,
             string_agg(word, ' ' order by x.q) filter (where r.q is null) as kept
      from x left join r on x.doc_id = r.doc_id and x.q = r.q group by x.doc_id)
select doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join s using (doc_id)
"""

#: Earliest deadline first, one slot at a time, for one period of 1000 slots.
MIXING = """
with recursive d as (
  select doc_id, coalesce(source, '') as source, coalesce(length(text), 0) as chars,
         md5('mix' || coalesce(cast(doc_id as varchar), '')) as o from documents),
tot as (select source, sum(chars) as chars, sqrt(cast(sum(chars) as double)) + 1 as w from d group by source),
ex as (select source, chars, w / sum(w) over () * (1000 - count(*) over ()) as x, 1000 - count(*) over () as free from tot),
sh as (select source, chars, cast(floor(x) + 1 + case when row_number() over (order by x - floor(x) desc, source)
         <= free - sum(floor(x)) over () then 1 else 0 end as bigint) as n from ex),
src as (select *, row_number() over (order by source) as i from sh),
edf as (
  select -1 as t, list_transform(range(0, (select count(*) from src)), lambda x: 0) as done, cast(0 as bigint) as pick
  union all
  select t + 1, list_transform(done, lambda x, j: case when j = b.i then x + 1 else x end), b.i
  from (select t, done, (select min({'due': cast(ceil((done[i] + 1) * 1000 / n) as bigint), 'i': i}) from src
                         where floor(done[i] * 1000 / n) <= t + 1) as b
        from edf where t < 999)),
sched as (select pick as i, t as pos, row_number() over (partition by pick order by t) - 1 as k from edf where t >= 0),
run as (select d.*, coalesce(sum(chars) over (partition by source order by o, doc_id, chars
          rows between unbounded preceding and 1 preceding), 0) // 16384 as block from d),
ends as (select min(b // n * 1000 + pos) as stop
         from (select i, n, cast(greatest(ceil(chars / 16384) - 1, 0) as bigint) as b from src) s
         join sched on sched.i = s.i and sched.k = b % n)
select doc_id, run.source, run.chars, cast(block as bigint) as block, cast(block // n * 1000 + pos as bigint) as slot,
       block // n * 1000 + pos <= (select stop from ends) as in_mix
from run join src on run.source = src.source join sched on sched.i = src.i and sched.k = block % n
"""

#: CRC32 of a text's bytes: each byte, then eight shifts (entries of -1).
CRC32 = """list_reduce(
  list_prepend(4294967295, flatten(list_transform(string_split({text}, ''),
    lambda c: list_concat([cast(ascii(c) as bigint)], list_transform(range(8), lambda b: cast(-1 as bigint)))))),
  lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, case when a & 1 = 1 then 3988292384 else 0 end) end)"""
PREFIX_TRIE = f"""
with t as (select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as x from conversations where conv_id is not null),
o as (select conv_id, list({{'r': r, 'x': x}} order by turn nulls first, r, md5(length(r) || ':' || r || x)) as own from t group by conv_id),
h as (select conv_id, own, xor({CRC32.format(text="cast(conv_id as varchar)")}, 4294967295) % 9 as h from o),
c as (select h.conv_id, list_concat(coalesce(b.own, [])[1:h], h.own[h + 1:]) as s
      from h left join o b on b.conv_id = h.conv_id - h.conv_id % 5),
k as (select conv_id, s, list_transform(range(len(s) + 1), lambda d: md5(cast(s[1:d] as varchar) || d)) as keys from c),
p as (select conv_id, s, keys, unnest(range(len(s) + 1)) as depth from k),
g as (select keys[depth + 1] as key, depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(keys[depth]) as up,
             any_value(case when depth > 0 then strlen(s[depth].x) else 0 end) as size,
             sha256(coalesce(string_agg(conv_id, ',' order by conv_id) filter (where len(s) = depth), '')) as ends_sha256
      from p group by 1, 2),
m as (select distinct keys, len(s) as last from k),
ch as (select up, count(*) as n from g group by up),
w as (select g.*, coalesce(ch.n, 0) as n_children from g left join ch on ch.up = g.key),
anc as (select distinct unnest(keys[1:d + 1]) as top, keys[d + 1] as key from (select keys, unnest(range(last + 1)) as d from m)),
sub as (select top, count(*) filter (where n_children = 0) as n_leaves, sum((n_convs - 1) * size) as saved_tokens
        from anc join w on w.key = anc.key group by top)
select w.conv_id, cast(w.depth as bigint) as depth, u.conv_id as parent_conv_id, cast(w.n_convs as bigint) as n_convs, w.n_children, sub.n_leaves,
       cast(sub.saved_tokens as bigint) as saved_tokens, w.ends_sha256
from w join sub on sub.top = w.key left join g u on u.key = w.up
"""

HARD_NEGATIVES = """
with r as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q from embeddings
           where vec_id is not null and label is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, c.vec_id, c.label = a.label as same, cast(list_inner_product(a.q, c.q) as bigint) as score
      from r a join r c on a.vec_id <> c.vec_id where a.vec_id % 100 = 0),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, cast(row_number() over w as integer) as rank, vec_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, vec_id)
qualify row_number() over w <= 5
"""

NGRAM_JOIN = rf"""
with recursive d as (select doc_id, regexp_extract_all({low("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') as w from documents),
g as (select doc_id, unnest(list_distinct(case
        when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda p: array_to_string(w[p:p + 4], ' '))
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) as s from d),
n as (select doc_id, count(*) as n from g group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as k from g a join g b on a.s = b.s and a.doc_id <> b.doc_id group by all),
l as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
r as (select doc_id, doc_id as reached from d union select r.doc_id, l.b from r join l on l.a = r.reached)
select r.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(reached) as component_id
from r left join n on n.doc_id = r.doc_id group by r.doc_id
"""

ORACLES = {
    "op2_exact_dedup": EXACT_DEDUP,
    "op3_decontaminate": DECONTAMINATE,
    "op5_line_dedup": LINE_DEDUP,
    "op6_substring_dedup": SUBSTRING_DEDUP,
    "op10_mixing": MIXING,
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_ngram_join": NGRAM_JOIN,
}
