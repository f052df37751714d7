"""DuckDB twins of the queries that SQL can express: all pairs and a recursive search.

The others learn a model, tokenize, parse pages or hash with functions that DuckDB lacks; the tests
compare them with brute force, exact round trips or held-out labels.
"""

from __future__ import annotations

_REACHED = """
    edges as (select u, v from links union all select v, u from links),
    reach as (select {id} as id, {id} as node from {rows}
      union select reach.id, edges.v from reach join edges on edges.u = reach.node)"""

_MINHASH = f"""
    with recursive split as (
      select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as words from documents),
    sets as (
      select doc_id, case when len(words) = 0 then [] when len(words) < 4 then [array_to_string(words, ' ')]
        else list_distinct(list_transform(range(1, len(words) - 2),
          lambda i: array_to_string(words[i:i + 3], ' '))) end as shingles from split),
    sizes as (select doc_id, cast(len(shingles) as bigint) as n from sets),
    members as (select doc_id, unnest(shingles) as shingle from sets),
    common as (
      select a.doc_id as u, b.doc_id as v, count(*) as n from members a join members b
        on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
    links as (
      select u, v from common c join sizes a on a.doc_id = u join sizes b on b.doc_id = v
      where 100 * c.n >= 80 * (a.n + b.n - c.n)),
    {_REACHED.format(id="doc_id", rows="sizes")}
    select doc_id, n as n_shingles, component_id, doc_id = component_id as kept
    from sizes join (select id, min(node) as component_id from reach group by id) on id = doc_id"""

_VECTORS = f"""
    with recursive usable as (
      select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
      where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links as (
      select a.vec_id as u, b.vec_id as v from usable a join usable b on a.vec_id < b.vec_id
      where list_cosine_similarity(a.e, b.e) >= 0.9),
    {_REACHED.format(id="vec_id", rows="embeddings")}
    select vec_id, (select count(*) from edges where u = vec_id) as n_links, component_id,
      vec_id = component_id as kept
    from embeddings join (select id, min(node) as component_id from reach group by id) on id = vec_id"""


_COLLOCATIONS = """
    with pieces as (
      select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
    split as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
    grams as (
      select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as g
      from split, (values (1), (2), (3), (4)) as sizes(k) where len(w) >= k),
    counts as materialized (select lang, k, g, count(*) as a from grams group by all),
    sizes as (select lang, cast(sum(a) as bigint) as n from counts where k = 1 group by lang),
    candidates as materialized (select *, string_split(g, ' ') as w from counts where k >= 2 and a >= 30),
    frequent as materialized (select lang, g, a from counts where a >= 30),
    cuts as materialized (
      select lang, g, a, cut, array_to_string(w[1:cut], ' ') as left_part, array_to_string(w[cut + 1:], ' ') as right_part
      from candidates, (values (1), (2), (3)) as places(cut) where cut < k),
    scored as (
      select c.lang, c.g, c.a, cut, l.a as l, r.a as r, cast(2000000::hugeint * c.a // (l.a + r.a) as bigint) as score
      from cuts c join frequent l on l.lang = c.lang and l.g = left_part join frequent r on r.lang = c.lang and r.g = right_part),
    lowest as (select * from scored qualify row_number() over (partition by lang, g order by score, cut) = 1),
    inside as (
      select lang, array_to_string(w[i:i + size - 1], ' ') as g, max(a) as most
      from candidates, (values (2), (3)) as sizes(size), (values (1), (2), (3)) as starts(i)
      where size < k and i + size - 1 <= k group by all),
    left_over as (
      select c.* from lowest c left join inside i on i.lang = c.lang and i.g = c.g where coalesce(100 * most, 0) < 80 * a),
    ranked as (
      select *, g as phrase, row_number() over (partition by lang order by score desc, a desc, g) as rank from left_over)
    select lang, rank, phrase, a, l, r, n, score from ranked join sizes using (lang) where rank <= 2000"""

_REPEATED = """
    with split as (
      select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
    starts as (
      select doc_id, unnest(range(1, len(w) - 18)) as pos, unnest(list_transform(range(1, len(w) - 18),
        lambda i: array_to_string(w[i:i + 19], ' '))) as content from split where len(w) >= 20),
    later as (
      select doc_id, pos from starts qualify row_number() over (partition by content order by doc_id, pos) > 1),
    gone as (select distinct doc_id, unnest(range(pos, pos + 20)) as pos from later),
    words as (select doc_id, unnest(range(1, len(w) + 1)) as pos, unnest(w) as word from split),
    kept as (
      select doc_id, count(*) as n, string_agg(word, ' ' order by pos) as kept from words anti join gone using (doc_id, pos) group by doc_id)
    select s.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(k.n, 0) as bigint) as n_removed,
      sha256(coalesce(k.kept, '')) as kept_sha256
    from split s left join kept k using (doc_id)"""

_SEARCH = """
    with terms as (
      select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from documents),
    wanted as (
      select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from benchmark),
    sizes as (select doc_id, count(*) as n from terms group by doc_id),
    total as (select count(*) as documents, cast(sum(n) as bigint) as length from sizes),
    norms as (select doc_id, 100 - 50 + (50 * n * documents) // length as m from sizes, total),
    counts as (
      select doc_id, term, count(*) as tf from terms where term in (select term from wanted) group by all),
    weights as (
      select term, cast(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) as bigint) as w
      from counts, total group by term, documents),
    scores as (
      select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score
      from wanted join counts using (term) join weights using (term) join norms using (doc_id) group by all),
    ranked as (
      select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank
      from scores where score > 0)
    select item_id, rank, doc_id, score from ranked where rank <= 50"""


def oracle_sql() -> dict[str, str]:
    return {"op6_minhash": _MINHASH, "op7_itq_vectors": _VECTORS, "op11_collocations": _COLLOCATIONS,
            "op12_dual_tree_search": _SEARCH, "op13_repeated_windows": _REPEATED}
