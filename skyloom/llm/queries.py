"""Queries of the training-data operators, by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from .op1_ann import op1_ann
from .op2_token_counts import op2_token_counts
from .op3_toxicity import op3_toxicity
from .op4_packing import op4_packing
from .op5_jaccard import op5_jaccard
from .op6_language import op6_language
from .op7_bpe import op7_bpe
from .op8_pii import op8_pii
from .op9_embedding_dedup import op9_embedding_dedup
from .op10_licenses import op10_licenses
from .op11_token_binary import op11_token_binary
from .op12_merkle import op12_merkle

QUERIES = {f.__name__: f for f in (op1_ann, op2_token_counts, op3_toxicity, op4_packing, op5_jaccard, op6_language, op7_bpe, op8_pii, op9_embedding_dedup, op10_licenses, op11_token_binary, op12_merkle)}
#: Classes of linked rows: every row with all it reaches.
_REACHED = """both_ways as (select a, b from links union all select b, a from links),
 reached as (select id, id as root from ids union select r.id, l.b from reached r join both_ways l on l.a = r.root)"""

#: A value as the manifest hashes it.
_SAID = "case when {0} is null then '-' else strlen({0}::varchar)::varchar || ':' || {0}::varchar end"
_LEAF = "sha256(" + " || ".join(_SAID.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"
#: crc32 of an id's decimals, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint), lambda crc, b: list_reduce(range(8), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(crc, b)), 4294967295::bigint))"""
_MERKLE = f"""with recursive given as (select *, n_chars + (case when {_CRC} % 7 = 0 then 1 else 0 end) as claimed_chars from documents),
 d as (select doc_id, lang, {_LEAF.format(n="n_chars")} as leaf, {_LEAF.format(n="claimed_chars")} as claimed, row_number() over (partition by lang order by doc_id) - 1 as pos, count(*) over (partition by lang) as n from given),
 up as (select 0 as lvl, lang, pos, leaf as h, n from d union all select lvl + 1, lang, pos // 2, sha256(string_agg(h, '' order by pos)), (n + 1) // 2 from up where n > 1 group by lvl, lang, pos // 2, n),
 sub as (select lang, h, lvl as depth, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from up where n = 1),
 top as (select 0 as lvl, pos, h, n from sub union all select lvl + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (n + 1) // 2 from top where n > 1 group by lvl, pos // 2, n),
 steps as (select d.doc_id, l.lvl, (d.pos >> l.lvl) & 1 = 1 as is_right, u.h from d join (select distinct lvl, lang, n from up where n > 1) l on l.lang is not distinct from d.lang
   left join up u on u.lang is not distinct from d.lang and u.lvl = l.lvl and u.pos = xor(d.pos >> l.lvl, 1)
  union all select d.doc_id, s.depth + l.lvl, (s.pos >> l.lvl) & 1 = 1, t.h from d join sub s on s.lang is not distinct from d.lang join (select distinct lvl, n from top where n > 1) l on true
   left join top t on t.lvl = l.lvl and t.pos = xor(s.pos >> l.lvl, 1)),
 fold as (select doc_id, 0 as lvl, claimed as h from d union all select f.doc_id, f.lvl + 1, sha256(case when s.is_right then coalesce(s.h, '') || f.h else f.h || coalesce(s.h, '') end) from fold f join steps s on s.doc_id = f.doc_id and s.lvl = f.lvl),
 folded as (select doc_id, arg_max(h, lvl) as folded_root from fold group by doc_id),
 proof as (select doc_id, sha256(coalesce(string_agg(h, '' order by lvl), '')) as proof_sha256 from steps group by doc_id)
 select d.doc_id, d.leaf, s.h as subroot, t.h as root, coalesce(p.proof_sha256, sha256('')) as proof_sha256, f.folded_root, f.folded_root = t.h as verified
 from d join sub s on s.lang is not distinct from d.lang join (select h from top where n = 1) t on true join folded f on f.doc_id = d.doc_id left join proof p on p.doc_id = d.doc_id"""

ORACLE_SQL: dict[str, str] = {
    "op12_merkle": _MERKLE,
    "op5_jaccard": f"""with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
 s as (select doc_id, list_distinct(case when len(w) = 0 then []::varchar[] when len(w) < 5 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as g from w),
 e as (select doc_id, unnest(g) as x from s),
 pairs as (select a.doc_id as a, b.doc_id as b, count(*) as c from e a join e b on a.x = b.x and a.doc_id < b.doc_id group by all),
 links as (select a, b from pairs join s p on p.doc_id = a join s q on q.doc_id = b where 100 * c >= 80 * (len(p.g) + len(q.g) - c)),
 ids as (select doc_id as id from documents), {_REACHED}
 select s.doc_id, len(s.g)::bigint as n_shingles, m.root as component_id from s join (select id, min(root) as root from reached group by id) m on m.id = s.doc_id""",
    "op9_embedding_dedup": f"""with recursive v as (select vec_id as id, embedding::double[] as x from embeddings),
 links as (select p.id as a, q.id as b from v p join v q on p.id < q.id where list_dot_product(p.x, q.x) / sqrt(list_dot_product(p.x, p.x)) / sqrt(list_dot_product(q.x, q.x)) >= 0.9),
 ids as (select id from v), {_REACHED}
 select v.id as vec_id, coalesce(n.n, 0)::bigint as n_links, m.root as component_id, v.id = m.root as kept from v join (select id, min(root) as root from reached group by id) m on m.id = v.id
 left join (select a, count(*) as n from both_ways group by a) n on n.a = v.id""",
}
