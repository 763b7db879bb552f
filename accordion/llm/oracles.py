"""SQL (DuckDB) that gives the rows of those operators that SQL can express."""

from __future__ import annotations

from . import mixing, quality

_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Shared shingles by pair, links, and the smallest id that links reach.
JACCARD = f"""
with recursive d as (select row_number() over () as r, doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
s as (select distinct r, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as x from d),
n as (select r, count(*) as n from s group by r),
p as (select a.r as u, b.r as v, count(*) as c from s a join s b on a.x = b.x and a.r < b.r group by all),
l as (select u, v from p join n a on a.r = u join n b on b.r = v where 100 * c >= 75 * (a.n + b.n - c)),
e as (select u, v from l union all select v, u from l),
reach as (select r as node, r as root from d union select e.v, reach.root from reach join e on e.u = reach.node),
k as (select node, min(doc_id) as component_id from reach join d on d.r = root group by node)
select doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, component_id from d join k on node = d.r left join n on n.r = d.r"""

#: Every string of 400 bytes (in hexadecimal) that starts in two places, and what the runs leave.
SUFFIX = """
with d as (select row_number() over () as r, doc_id, lower(hex(encode(coalesce(text, '')))) as h from documents),
g as (select r, p, md5(substr(h, 2 * p + 1, 800)) as x from (select r, h, unnest(range(0, length(h) // 2 - 399)) as p from d where length(h) >= 800)),
t as (select r, p from (select r, p, count(*) over (partition by x) as c from g) where c > 1),
b as (select r, p, case when p <= lag(p) over (partition by r order by p) + 400 then 0 else 1 end as new from t),
i as (select r, p, sum(new) over (partition by r order by p) as k from b),
run as (select r, k, min(p) as a, max(p) + 400 as z from i group by all),
gap as (select r, k, a, z, coalesce(lag(z) over (partition by r order by k), 0) as y, lead(a) over (partition by r order by k) is null as final from run),
kept as (select gap.r, string_agg(substr(h, 2 * y + 1, 2 * (a - y)) || case when final then substr(h, 2 * z + 1) else '' end, '' order by k) as h, sum(z - a) as n_removed, count(*) as n_spans from gap join d on d.r = gap.r group by gap.r)
select doc_id, cast(length(d.h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, cast(coalesce(n_spans, 0) as bigint) as n_spans, sha256(unhex(coalesce(kept.h, d.h))) as kept_sha256
from d left join kept on kept.r = d.r"""

#: Every window of 13 words that a smaller doc_id has too, and the words that none covers.
SUBSTRING = f"""
with d as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
g as (select r, doc_id, p, array_to_string(w[p:p + 12], ' ') as x from (select r, doc_id, w, unnest(range(1, len(w) - 11)) as p from d where len(w) >= 13)),
t as (select r, p from (select r, doc_id, p, min(doc_id) over (partition by x) as least from g) where least < doc_id),
gone as (select distinct r, unnest(range(p, p + 13)) as p from t),
word as (select r, p, w[p] as x from (select r, w, unnest(range(1, len(w) + 1)) as p from d where len(w) > 0)),
kept as (select word.r, string_agg(x, ' ' order by word.p) as body, count(*) as n from word left join gone on gone.r = word.r and gone.p = word.p where gone.p is null group by word.r)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(kept.n, 0) as bigint) as n_removed, sha256(coalesce(body, '')) as kept_sha256 from d left join kept on kept.r = d.r"""

ORACLES = {
    "op1_quality_rules": quality.oracle(),
    "op2_mixing_weights": mixing.oracle(),
    "op3_ngram_jaccard_join": JACCARD,
    "op7_suffix_array_dedup": SUFFIX,
    "op9_substring_dedup": SUBSTRING,
}
