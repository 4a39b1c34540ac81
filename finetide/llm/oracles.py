"""DuckDB SQL for the queries of this subpackage that SQL can express over whole tables."""

from __future__ import annotations

from finetide.llm.mixing import MOST, SHARE, SYMBOLS, WEIGHTS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_list(c: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({c}, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


DECONTAMINATION = f"""
    with i as (select item_id, {word_list('text')} as w from benchmark),
    iw as (select distinct item_id, n, array_to_string(w[k:k + n - 1], ' ') as win
           from (select item_id, w, least(13, len(w)) as n, unnest(range(1, len(w) - least(13, len(w)) + 2)) as k
                 from i where len(w) > 0)),
    d as (select doc_id, {word_list('text')} as w from documents),
    dw as (select doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') as win
           from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as k
                 from d, (select distinct n from iw) where len(w) >= n)),
    hit as (select doc_id, item_id, n, k from dw join iw using (n, win)),
    pos as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(k, k + n)) as p from hit) group by doc_id),
    its as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
            from (select distinct doc_id, coalesce(item_id::varchar, 'null') as item from hit) group by doc_id)
    select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
           sha256(coalesce(items, '')) as items_sha256,
           coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
    from d left join pos using (doc_id) left join its using (doc_id)"""

MIXING = rf"""
    with t as (select doc_id, source, coalesce(text, '') as t from documents),
    c as (select doc_id, source, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::bigint as size,
                 1 - (length(t) - length(translate(t, '{SYMBOLS}', ''))) / greatest(length(t), 1)::double as share,
                 (('0x' || substr(md5('17:' || doc_id::varchar), 1, 13))::bigint::double + 0.5::double) / 4503599627370496.0::double as u
          from t),
    k as (select doc_id, source, size,
                 -ln(u) / greatest((share * share) * (share * share) * ((share * share) * (share * share)), 0.05::double) as key from c),
    s as (select source, sum(size)::bigint as source_size,
                 ([{", ".join(f"{w}.0::double" for w in WEIGHTS)}])[(row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1] as weight
          from k group by source),
    o as (select *, {MOST}::double * source_size as cap, {SHARE}::double * sum(source_size) over () as total from s),
    r as (select *, cap / weight as ratio,
                 coalesce(sum(cap) over (order by cap / weight, source rows between unbounded preceding and 1 preceding), 0) as below,
                 sum(weight) over (order by cap / weight, source rows between current row and unbounded following) as open from o),
    l as (select arg_min((total - below) / open, ratio) as level from r where (total - below) / open <= ratio),
    g as (select source, source_size, least(cap, level * weight) as target from o, l),
    e as (select *, case when source_size > 0 then floor(target / source_size + 1e-9::double) else 0 end as epochs from g),
    f as (select k.*, source_size, target, epochs, round(target - epochs * source_size) as rest,
                 coalesce(sum(size) over (partition by k.source order by key rows between unbounded preceding and 1 preceding), 0) as before
          from k join e on k.source is not distinct from e.source)
    select doc_id, size, source_size, target,
           (epochs * size + least(size, greatest(rest - before, 0)))::bigint as taken from f"""

EMBEDDINGS = """
    with recursive v as (
        select vec_id, label, embedding::double[] as v from embeddings
        where label is not null and len(embedding) > 0
          and len(list_filter(embedding::double[], lambda x: x is null or not isfinite(x))) = 0
          and len(list_filter(embedding::double[], lambda x: x <> 0)) > 0),
    n as (select *, sqrt(list_dot_product(v, v)) as norm from v),
    p as (select a.vec_id as a, b.vec_id as b from n a join n b
          on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
          where list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93::double),
    r as (select vec_id as a, vec_id as b from embeddings union select r.a, p.b from r join p on r.b = p.a),
    c as (select a, min(b) as component_id from r group by a),
    l as (select a, count(*) as n_links from p group by a)
    select vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, vec_id = component_id as kept
    from embeddings join c on c.a = vec_id left join l on l.a = vec_id"""

def crc32(c: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit."""
    byte = "list_reduce([xor(c, b)] || range(8), lambda s, i: xor(s >> 1, 3988292384::bigint * (s & 1)))"
    codes = f"list_transform(string_split({c}, ''), lambda x: ascii(x)::bigint)"
    return f"xor(list_reduce([4294967295::bigint] || {codes}, lambda c, b: {byte}), 4294967295::bigint)"


def merkle(levels: int = 5, upper: int = 3) -> str:
    """Trees of up to 16 ** levels leaves a source and 16 ** upper sources, level by level."""
    cell = lambda c: f"case when {c} is null then '-' else strlen({c}::varchar)::varchar || ':' || {c}::varchar end"
    digest = lambda text: "sha256(" + " || ".join(cell(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    out = f"""
    with leaves as (select doc_id, dense_rank() over (order by source nulls first) as tree, {digest('text')} as d,
                           case when coalesce({crc32('doc_id::varchar')} % 5 = 0, false) then {digest(lowered)} else {digest('text')} end as f
                    from documents),
    placed as (select *, row_number() over (partition by tree order by doc_id nulls first, d) - 1 as ix, count(*) over (partition by tree) as n from leaves),
    s0 as (select doc_id, d as leaf, tree, ix, '' as p, f from placed),
    n0 as (select tree, ix, n, d from placed)"""
    for k in range(levels + upper):
        if k == levels:  # each tree has one node now: the subroots are the leaves of the tree of sources
            out += f""",
    s{k}t as (select s.doc_id, s.leaf, n.d as subroot, 0 as tree, s.tree - 1 as ix, s.p, s.f from s{k} s join n{k} n using (tree)),
    n{k}t as (select 0 as tree, tree - 1 as ix, count(*) over () as n, d from n{k})"""
        state, nodes, kept = (f"s{k}t", f"n{k}t", "subroot,") if k == levels else (f"s{k}", f"n{k}", "subroot," if k > levels else "")
        out += f""",
    r{k} as (select tree, ix // 16 as run, list(d order by ix) as ds, any_value(n) as n from {nodes} where n > 1 group by tree, run),
    n{k + 1} as (select tree, run as ix, (n + 15) // 16 as n, sha256(array_to_string(ds, '')) as d from r{k} union all select * from {nodes} where n <= 1),
    s{k + 1} as (select doc_id, leaf, {kept} tree, case when ds is null then ix else ix // 16 end as ix,
                 case when ds is null then p else p || array_to_string(ds[:ix % 16] || ds[ix % 16 + 2:], '') end as p,
                 case when ds is null then f else sha256(array_to_string(ds[:ix % 16] || [f] || ds[ix % 16 + 2:], '')) end as f
                 from {state} left join (select tree as own, run, ds from r{k}) on tree = own and run = ix // 16)"""
    last = levels + upper
    return out + f"""
    select doc_id, leaf, subroot, d as root, sha256(p) as proof_sha256, f as folded_root, f = d as verified from s{last} join n{last} using (tree)"""


LINES = f"""
    with t as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
    l as (select doc_id, ls[k] as line, k, translate(trim(ls[k], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') as key
          from (select doc_id, ls, unnest(range(1, len(ls) + 1)) as k from t)),
    shared as (select key, max(doc_id) as keeper from l where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
    marked as (select l.*, keeper is not null and doc_id <> keeper as gone from l left join shared using (key))
    select doc_id, count(*) as n_lines, count_if(gone)::bigint as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by k) filter (not gone), '')) as kept_sha256
    from marked group by doc_id"""

COLLOCATIONS = f"""
    with t as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as t from documents),
    p as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\\n\\x0B\\x0C\\r]')) as piece from t),
    w as (select lang, regexp_extract_all(piece, '[^ \\t]+') as w from p),
    totals as (select lang, sum(len(w))::bigint as n from w group by lang),
    g as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
          from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from w, (values (1), (2), (3)) as ks(k) where len(w) >= k)),
    f as (select lang, k, phrase, count(*) as f from g group by all having count(*) >= 10),
    cut as (select lang, phrase, k, f as a, string_split(phrase, ' ') as w, unnest(range(1, k)) as at_word from f where k >= 2),
    s as (select c.lang, c.phrase, c.a, at_word, x.f as l, y.f as r,
                 (1000000::hugeint * c.a::hugeint * c.a::hugeint) // (x.f::hugeint * y.f::hugeint) as score
          from cut c join f x on x.lang = c.lang and x.phrase = array_to_string(w[:at_word], ' ')
                     join f y on y.lang = c.lang and y.phrase = array_to_string(w[at_word + 1:], ' ')),
    worst as (select * from s qualify row_number() over (partition by lang, phrase order by score, at_word) = 1),
    longer as (select lang, array_to_string(w[i:i + 1], ' ') as phrase, max(f) as f
               from (select lang, f, string_split(phrase, ' ') as w, unnest([1, 2]) as i from f where k = 3) group by 1, 2),
    kept as (select worst.* from worst left join longer using (lang, phrase)
             where string_split(phrase, ' ')[3] is not null or longer.f is null or 100 * longer.f < 50 * a),
    ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
    select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join totals using (lang) where rank <= 2000"""

ORACLES: dict[str, str] = {
    "op2_decontamination": DECONTAMINATION,
    "op4_mixing": MIXING,
    "op10_embedding_dedup": EMBEDDINGS,
    "op11_merkle": merkle(),
    "op12_line_dedup": LINES,
    "op13_collocations": COLLOCATIONS,
}
