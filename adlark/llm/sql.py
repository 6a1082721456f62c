"""SQL that DuckDB runs on the same tables, for the operators that SQL can express."""

from __future__ import annotations

#: Every string of 400 bytes is named by its digest; starts whose name occurs twice are merged into spans. So are passages of 51 words.
OP2 = r"""
with raw as (select doc_id, encode(coalesce(text, '')) as b from documents),
  sized as (select doc_id, b, octet_length(b) as n from raw),
  starts as (select doc_id, unnest(generate_series(1, n - 399)) as p, b from sized where n >= 400),
  named as (select doc_id, p, md5(b[p:p + 399]) as h from starts),
  often as (select h from named group by h having count(*) > 1),
  again as (select doc_id, p, p > lag(p, 1, -1000) over (partition by doc_id order by p) + 400 as fresh from named semi join often using (h)),
  runs as (select doc_id, p, sum(fresh::int) over (partition by doc_id order by p) as k from again),
  spans as (select doc_id, k, min(p) as first, max(p) + 399 as last from runs group by doc_id, k),
  edges as (select doc_id, first, last, lag(last, 1, 0) over (partition by doc_id order by first) + 1 as since from spans),
  parts as (select doc_id, since as a, first - 1 as z from edges
            union all select doc_id, max(last) + 1, 1 << 30 from spans group by doc_id),
  kept as (select doc_id, string_agg(case when z < a then '' else hex(b[a:z]) end, '' order by a) as x from parts join sized using (doc_id) group by doc_id),
  counts as (select doc_id, sum(last - first + 1) as gone, count(*) as spans from spans group by doc_id),
  words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
  places as (select doc_id, unnest(generate_series(1, len(w) - 50)) as p, w from words where len(w) >= 51),
  windows as (select doc_id, p, md5(array_to_string(w[p:p + 50], ' ')) as h from places),
  shared as (select h from windows group by h having count(*) > 1),
  passages as (select doc_id, sum(fresh::int) as n_passages
               from (select doc_id, p > lag(p, 1, -1000) over (partition by doc_id order by p) + 50 as fresh from windows semi join shared using (h)) group by doc_id)
select doc_id, n::bigint as n_bytes, coalesce(gone, 0)::bigint as n_removed, coalesce(spans, 0)::bigint as n_spans,
  sha256(coalesce(unhex(x), b)) as kept_sha256, coalesce(n_passages, 0)::bigint as n_passages
from sized left join counts using (doc_id) left join kept using (doc_id) left join passages using (doc_id)
"""

#: Two sets with a similarity of 0.75 share one of their rarest n - ceil(0.75 n) + 1 shingles; such pairs are counted in full.
OP3 = r"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
  shingled as (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
      else list_sort(list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')))) end as s from words),
  member as (select doc_id, len(s) as n, s, min(doc_id) over (partition by s) as rep from shingled),
  items as (select doc_id, n, unnest(s) as g from member where doc_id = rep),
  seen as (select g, count(*) as c from items group by g),
  ranked as (select doc_id, n, g, row_number() over (partition by doc_id order by c, g) as k from items join seen using (g)),
  rare as (select doc_id, n, g from ranked where k <= n - (3 * n + 3) // 4 + 1),
  pairs as (select distinct x.doc_id as a, y.doc_id as b, x.n as na, y.n as nb from rare x join rare y using (g)
            where x.doc_id < y.doc_id and 100 * least(x.n, y.n) >= 75 * greatest(x.n, y.n)),
  shared as (select a, b, any_value(na) as na, any_value(nb) as nb, count(*) as inter
             from pairs join items x on x.doc_id = a join items y on y.doc_id = b and y.g = x.g group by a, b),
  links as (select a, b from shared where 100 * inter >= 75 * (na + nb - inter)),
  ways as (select a, b from links union all select b, a from links),
  reach as (select a, b from ways union select reach.a, ways.b from reach join ways on ways.a = reach.b),
  least_ as (select a as rep, min(b) as low from reach group by a)
select doc_id, n::bigint as n_shingles, case when n = 0 then doc_id else least(rep, coalesce(low, rep)) end as component_id,
  doc_id = (case when n = 0 then doc_id else least(rep, coalesce(low, rep)) end) as kept
from member left join least_ using (rep)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_prefix_free_repeats": OP2, "op3_hyperminhash": OP3}
