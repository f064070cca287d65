"""Registered queries of the operators, and the SQL of those that SQL can express."""

from anemoscope.llm import (
    contextmix, countrtree, gapkernel, hyperlang, lineindex, linecrf, mixing, packing, postings,
    sharding, spherical, twostage, wordselect,
)

QUERIES = {
    q.__name__: q
    for q in (
        gapkernel.op1_toxicity,
        linecrf.op2_quality_rules,
        mixing.op3_mixing,
        sharding.op4_sharding,
        contextmix.op5_lm_scoring,
        twostage.op6_suffix_array_dedup,
        spherical.op7_embedding_near_dedup,
        countrtree.op8_ngram_jaccard_join,
        packing.op9_packing,
        hyperlang.op10_language_id,
        lineindex.op11_line_dedup,
        postings.op12_filter_audit,
        wordselect.op13_fill_in_middle,
    )
}

_COMPONENTS = """
reach(a, b) AS (
    SELECT id, id FROM nodes
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
),
component AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)
"""

_OP6 = """
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h,
        octet_length(encode(coalesce(text, ''))) AS n_bytes
    FROM documents
),
windows AS (SELECT doc_id, h, unnest(range(n_bytes - 49)) AS p FROM texts WHERE n_bytes >= 50),
marked AS (
    SELECT doc_id, p FROM (
        SELECT doc_id, p, min(doc_id) OVER (PARTITION BY substr(h, 2 * p + 1, 100)) AS low
        FROM windows
    ) WHERE low < doc_id
),
breaks AS (
    SELECT doc_id, p,
        coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50, true) AS fresh
    FROM marked
),
numbered AS (
    SELECT doc_id, p, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM breaks
),
spans AS (
    SELECT doc_id, span, min(p) AS s, max(p) + 50 AS e FROM numbered GROUP BY doc_id, span
),
pieces AS (
    SELECT doc_id, s, e, e - s AS size,
        coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before
    FROM spans
),
kept AS (
    SELECT t.doc_id, sum(size)::BIGINT AS n_removed, count(*) AS n_spans,
        string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s)
            || substr(any_value(h), 2 * max(e) + 1) AS rest
    FROM pieces p JOIN texts t ON t.doc_id = p.doc_id GROUP BY t.doc_id
)
SELECT t.doc_id, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
    coalesce(n_spans, 0)::BIGINT AS n_spans,
    sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""

_OP7 = f"""
WITH RECURSIVE nodes AS (
    SELECT vec_id AS id, label, embedding::DOUBLE[] AS v,
        label IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
            AND len([x for x in embedding if x <> 0]) > 0 AS good
    FROM embeddings
),
links AS (
    SELECT x.id AS a, y.id AS b FROM nodes x JOIN nodes y ON x.label = y.label AND x.id <> y.id
    WHERE x.good AND y.good AND len(x.v) = len(y.v)
        AND list_dot_product(x.v, y.v)
            / (sqrt(list_dot_product(x.v, x.v)) * sqrt(list_dot_product(y.v, y.v))) >= 0.98
),
{_COMPONENTS},
counted AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT c.id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, c.id = component_id AS kept
FROM component c LEFT JOIN counted n ON n.id = c.id
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP8 = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)
    UNION ALL
    SELECT doc_id, array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND 2
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id
),
links AS (
    SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
    WHERE 100 * s.n >= 90 * (x.n + y.n - s.n)
),
nodes AS (SELECT doc_id AS id FROM words),
{_COMPONENTS}
SELECT c.id AS doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM component c LEFT JOIN sizes s ON s.doc_id = c.id
"""

_OP11 = rf"""
WITH lines AS (
    SELECT doc_id, i, line, translate(
        trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM (
        SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
    )
),
often AS (
    SELECT k, max(doc_id) AS last_id FROM lines WHERE length(k) >= 40
    GROUP BY k HAVING count(DISTINCT doc_id) >= 5
),
judged AS (
    SELECT l.doc_id, i, line, o.k IS NOT NULL AND l.doc_id < o.last_id AS dropped
    FROM lines l LEFT JOIN often o ON l.k = o.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_OP12 = r"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
    FROM documents
),
failing AS (
    SELECT part, doc_id, {
        'A': len(w) < 50,
        'B': 100 * len(list_distinct(w)) < 65 * len(w),
        'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
        'D': regexp_matches(t, '[#$%&*|]'),
        'E': doc_id > first_id
    } AS f
    FROM words
),
marked AS (
    SELECT part, f.A AS a, f.B AS b, f.C AS c, f.D AS d, f.E AS e,
        coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
    FROM failing LEFT JOIN (
        SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
        FROM labels GROUP BY doc_id
    ) USING (doc_id)
    GROUP BY ALL
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
    FROM letters p, letters q, letters r, letters s, letters t
    WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
),
steps AS (
    SELECT filter_order, step::INT AS step, filter_order[step] AS filter,
        filter_order[1:step - 1] AS before, replace(filter_order, filter_order[step], '') AS others
    FROM orders, range(1, 6) r(step)
),
judged AS (
    SELECT part, filter_order, step, filter, n, good, toxic,
        (a AND filter = 'A') OR (b AND filter = 'B') OR (c AND filter = 'C')
            OR (d AND filter = 'D') OR (e AND filter = 'E') AS fails,
        (a AND contains(before, 'A')) OR (b AND contains(before, 'B'))
            OR (c AND contains(before, 'C')) OR (d AND contains(before, 'D'))
            OR (e AND contains(before, 'E')) AS gone,
        (a AND contains(others, 'A')) OR (b AND contains(others, 'B'))
            OR (c AND contains(others, 'C')) OR (d AND contains(others, 'D'))
            OR (e AND contains(others, 'E')) AS elsewhere
    FROM steps, marked
),
counted AS (
    SELECT part, filter_order, step, filter,
        coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (fails AND NOT elsewhere), 0)::BIGINT AS unique_fails,
        coalesce(sum(n) FILTER (fails AND NOT gone AND good), 0)::BIGINT AS good_lost,
        coalesce(sum(n) FILTER (fails AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
    FROM judged GROUP BY ALL
)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM counted
"""

_OP13 = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
        sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
),
drawn AS (
    SELECT doc_id, t, n, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
            WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM texts
),
cut AS (
    SELECT *, substr(t, 1, least(a, b)) AS prefix,
        substr(t, least(a, b) + 1, greatest(a, b) - least(a, b)) AS middle,
        substr(t, greatest(a, b) + 1) AS suffix
    FROM drawn
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN greatest(a, b) - least(a, b) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM cut
"""

#: The others have hashes, models or tokenizers that SQL lacks; tests use brute force.
ORACLE_SQL: dict[str, str] = {
    "op6_suffix_array_dedup": _OP6,
    "op7_embedding_near_dedup": _OP7,
    "op8_ngram_jaccard_join": _OP8,
    "op11_line_dedup": _OP11,
    "op12_filter_audit": _OP12,
    "op13_fill_in_middle": _OP13,
}
