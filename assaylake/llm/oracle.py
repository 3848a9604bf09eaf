"""SQL that gives the same rows as the queries, where SQL can."""

ORACLE = {}

ORACLE["op2_decontamination"] = r"""
WITH item AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
    FROM benchmark WHERE text IS NOT NULL
), win AS (
    SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, p, p + least(len(w), 10) - 1), ' ') AS phrase
    FROM item, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(p) WHERE len(w) > 0
), doc AS (
    SELECT row_number() OVER () AS r, doc_id,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+'), []) AS w
    FROM documents
), place AS (
    SELECT r, p, s.n, array_to_string(list_slice(w, p, p + s.n - 1), ' ') AS phrase
    FROM doc, (SELECT DISTINCT n FROM win) AS s, unnest(range(1, len(w) - s.n + 2)) AS t(p)
), found AS (SELECT DISTINCT r, p, place.n, item FROM place JOIN win USING (n, phrase)),
hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM found, unnest(range(p, p + n)) AS t(q) GROUP BY r),
items AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
    sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

# A text is split at a rule's pattern; running sums of pieces and matches are the places.
_SECRETS = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
rule(kind, k, least) AS (VALUES ('assign', 0, 6), ('access', 1, 20), ('hex', 2, 24)
), m AS (
    {matches}
), place AS (
    SELECT r, kind, k, least, unnest(range(1, len(whole) + 1)) AS i, whole, piece, grp FROM m
), span AS (
    SELECT r, kind, k, least, grp[i] AS value,
        list_sum(list_transform(piece[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i-1], lambda x: length(x))), 0) AS start,
        length(whole[i]) AS size
    FROM place
), good AS (SELECT r, kind, k, start::BIGINT AS start, (start + size)::BIGINT AS stop FROM span WHERE length(value) >= least),
text AS (
    SELECT r, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans,
        count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS b, count(*) FILTER (k = 2) AS c
    FROM good GROUP BY r
)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
    sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN text USING (r)
"""
_MATCHES = """SELECT r, kind, k, least, regexp_extract_all(text, '{p}') AS whole, regexp_split_to_array(text, '{p}') AS piece,
        regexp_extract_all(text, '{p}', 1) AS grp FROM doc, rule WHERE kind = '{kind}'"""
_PATTERNS = {
    "assign": r"""(?i)(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
    "access": "(AKIA[A-Z0-9]+)",
    "hex": "([0-9a-f]{24,})",
}
ORACLE["op5_secrets"] = _SECRETS.replace("{matches}", " UNION ALL ".join(_MATCHES.format(p=p, kind=k) for k, p in _PATTERNS.items()))

# A NULL id counts as larger than all others.
ORACLE["op3_phrases"] = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS d,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), place AS (SELECT r, d, p, array_to_string(w[p:p + 49], ' ') AS s FROM doc, unnest(range(1, len(w) - 48)) AS t(p)),
least AS (SELECT s, min(d) AS m FROM place GROUP BY s),
hit AS (SELECT DISTINCT r, q FROM place JOIN least USING (s), unnest(range(p, p + 50)) AS t(q) WHERE m < d),
word AS (SELECT r, q, w[q] AS word FROM doc, unnest(range(1, len(w) + 1)) AS t(q)),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY q) AS kept FROM word ANTI JOIN hit USING (r, q) GROUP BY r),
gone AS (SELECT r, count(*) AS n FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM doc LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""

ORACLE["op10_suffix_arrays"] = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS d,
        regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS b
    FROM documents
), one AS (SELECT r, d, unnest(range(1, len(b) + 1)) AS q, unnest(b) AS x FROM doc),
s2 AS (SELECT *, x || lead(x) OVER w AS s2 FROM one WINDOW w AS (PARTITION BY r ORDER BY q)),
s4 AS (SELECT *, s2 || lead(s2, 2) OVER w AS s4 FROM s2 WINDOW w AS (PARTITION BY r ORDER BY q)),
s8 AS (SELECT *, s4 || lead(s4, 4) OVER w AS s8 FROM s4 WINDOW w AS (PARTITION BY r ORDER BY q)),
s16 AS (SELECT r, d, q, s2, s8 || lead(s8, 8) OVER w AS s16 FROM s8 WINDOW w AS (PARTITION BY r ORDER BY q)),
s50 AS (
    SELECT r, d, q AS p, s16 || lead(s16, 16) OVER w || lead(s16, 32) OVER w || lead(s2, 48) OVER w AS s
    FROM s16 WINDOW w AS (PARTITION BY r ORDER BY q)
), place AS (SELECT * FROM s50 WHERE s IS NOT NULL),
least AS (SELECT s, min(d) AS m FROM place GROUP BY s),
start AS (SELECT r, p FROM place JOIN least USING (s) WHERE m < d),
hit AS (SELECT DISTINCT r, q FROM start, unnest(range(p, p + 50)) AS t(q)),
kept AS (SELECT r, unhex(string_agg(x, '' ORDER BY q)) AS kept FROM one ANTI JOIN hit USING (r, q) GROUP BY r),
ordered AS (SELECT r, q, lag(q) OVER (PARTITION BY r ORDER BY q) AS before FROM hit),
gone AS (SELECT r, count(*) AS n, count(*) FILTER (before IS NULL OR before < q - 1) AS n_spans FROM ordered GROUP BY r)
SELECT doc_id, len(b)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
    sha256(coalesce(kept, ''::BLOB)) AS kept_sha256
FROM doc LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""

ORACLE["op11_collocations"] = r"""
WITH doc AS (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), piece AS (
    SELECT lang, regexp_extract_all(u, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS u FROM doc)
), gram AS (
    SELECT lang, list_slice(w, i, i + m - 1) AS g, count(*) AS f
    FROM piece, (VALUES (1), (2), (3), (4)) AS s(m), unnest(range(1, len(w) - m + 2)) AS t(i) GROUP BY ALL
), total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM piece GROUP BY lang),
cand AS (SELECT lang, g, f AS a FROM gram WHERE len(g) > 1 AND f >= 30),
cut AS (
    SELECT c.lang, c.g, c.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a // (x.f + y.f))::BIGINT AS score
    FROM (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM cand) AS c
    JOIN gram AS x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, k)
    JOIN gram AS y ON y.lang = c.lang AND y.g = list_slice(c.g, k + 1, len(c.g))
), low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
held AS (
    SELECT lang, list_slice(g, i, i + m - 1) AS g, max(a) AS held
    FROM cand, (VALUES (2), (3)) AS s(m), unnest(range(1, len(g) - m + 2)) AS t(i) WHERE m < len(g) GROUP BY ALL
), ranked AS (
    SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM low LEFT JOIN held USING (lang, g)
    WHERE held IS NULL OR 100::HUGEINT * held < 80::HUGEINT * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM ranked JOIN total USING (lang) QUALIFY rank <= 2000
"""

ORACLE["op12_hard_negatives"] = r"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), pair AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS s
    FROM v AS a, v AS b WHERE a.vec_id % 100 = 0
), positive AS (
    SELECT anchor_id, other AS positive_id, s AS positive_score FROM pair WHERE same AND other <> anchor_id
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, other) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, other)::INTEGER AS rank,
    other AS negative_id, positive_score, s AS negative_score
FROM positive JOIN pair USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * s AND 100 * s <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLE["op13_embedding_duplicates"] = r"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_dot_product(a.e, b.e) >= 0.98 * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))
), reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach AS r JOIN link AS l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
links AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON least.a = vec_id LEFT JOIN links ON links.a = vec_id
"""
