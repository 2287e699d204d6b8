"""The queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from footfall.llm.license_rules import ANCHORS, rules

ORACLES: dict[str, str] = {}

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

ORACLES["op2_line_dedup"] = f"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), numbered AS (
    SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos FROM split
), keyed AS (
    SELECT doc_id, pos, lines[pos] AS line, translate(trim(lines[pos], {_BLANKS}), {_UPPER}, {_LOWER}) AS key
    FROM numbered
), shared AS (
    SELECT key, max(doc_id) AS last_doc_id FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT doc_id, pos, line, coalesce(doc_id < last_doc_id, false) AS dropped FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLES["op7_url_filter"] = f"""
WITH parts AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), {_UPPER}, {_LOWER}) AS host,
        coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
    FROM pages
), rules(verdict, host, path) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
        ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fitting AS (
    SELECT page_id, r.host || r.path AS rule, r.verdict,
        row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC) AS place
    FROM parts p JOIN rules r
        ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fitting f ON f.page_id = p.page_id AND f.place = 1
"""

_WORDS = "regexp_extract_all(translate(text, {u}, {l}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(u=_UPPER, l=_LOWER)

ORACLES["op4_decontamination"] = f"""
WITH doc AS (
    SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents
), item AS (
    SELECT item_id, {_WORDS} AS w FROM benchmark
), pattern AS (
    SELECT DISTINCT item_id, w[i:i + 12] AS p
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)
), sizes AS (
    SELECT DISTINCT len(p) AS n FROM pattern
), place AS (
    SELECT doc_id, i, n, w[i:i + n - 1] AS p
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n)
), found AS (
    SELECT doc_id, i, n, item_id FROM place JOIN pattern USING (p)
), hit AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES["op6_exact_dedup"] = """
WITH normal AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
        sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
    FROM documents
), chosen AS (
    SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
        first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id
    FROM normal
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM chosen
"""

ORACLES["op5_jaccard_join"] = f"""
WITH RECURSIVE doc AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, {_UPPER}, {_LOWER}), '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, w[i:i + 3] AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM doc WHERE len(w) > 0)
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), overlap AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
    SELECT a, b FROM overlap JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), both_ways AS (
    SELECT a, b FROM link UNION SELECT b, a FROM link
), reach(a, b) AS (
    SELECT a, b FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.b
)
SELECT doc.doc_id, coalesce(any_value(n), 0) AS n_shingles, least(doc.doc_id, coalesce(min(reach.b), doc.doc_id)) AS component_id
FROM doc LEFT JOIN size ON size.doc_id = doc.doc_id LEFT JOIN reach ON reach.a = doc.doc_id GROUP BY doc.doc_id
"""

ORACLES["op8_warc"] = """
WITH digest AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), base32 AS (
    SELECT page_id, payload, list_reduce(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((CAST('0x' || substr(hex, CAST(k // 4 AS INTEGER) * 5 + 1, 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS BIGINT)) & 31 AS INTEGER) + 1, 1)),
        lambda a, b: a || b) AS payload_digest
    FROM digest
), marked AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload) AS last_id FROM base32
)
SELECT page_id, strlen(payload) AS payload_bytes, payload_digest,
    CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> last_id THEN last_id END AS refers_to
FROM marked
"""

_TERMS = "regexp_extract_all(translate(text, {u}, {l}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')".format(u=_UPPER, l=_LOWER)

ORACLES["op13_lexical_search"] = f"""
WITH doc AS (
    SELECT doc_id, {_TERMS} AS t FROM documents
), totals AS (
    SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM doc WHERE len(t) > 0
), wanted AS (
    SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)
), found AS (
    SELECT doc_id, term, count(*) AS tf, any_value(n) AS n
    FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM doc)
    WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term
), weighted AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM found GROUP BY term), totals
), impact AS (
    SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)) AS x
    FROM found, totals
), scored AS (
    SELECT item_id, doc_id, sum(w * x)::BIGINT AS score
    FROM wanted JOIN weighted USING (term) JOIN impact USING (term) GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

_RULES = ", ".join(
    f"({k}, '{r.label}', '{r.expression}', {r.priority}, {r.confidence}, {str(r.base).lower()})" for k, r in enumerate(rules())
)

ORACLES["op11_license_scan"] = f"""
WITH rules(rule, label, expression, priority, confidence, base) AS (
    VALUES {_RULES}
), doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), spaced AS (
    SELECT doc_id, ' ' || array_to_string(w, '  ') || ' ' AS t FROM doc
), gated AS (
    SELECT * FROM spaced WHERE {" OR ".join(f"contains(t, '{a}')" for a in ANCHORS)}
), cut AS (
    SELECT doc_id, rule, label, priority, confidence, base,
        regexp_split_to_array(t, expression) AS pieces, regexp_extract_all(t, expression) AS hits
    FROM gated CROSS JOIN rules WHERE regexp_matches(t, expression)
), place AS (
    SELECT doc_id, rule, label, priority, confidence, base, len(string_split(hits[i], ' ')) // 2 AS n,
        (length(array_to_string(pieces[:i], '') || array_to_string(hits[:i - 1], ''))
        - length(replace(array_to_string(pieces[:i], '') || array_to_string(hits[:i - 1], ''), ' ', ''))) // 2 AS first
    FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM cut)
), judged AS (
    SELECT *, NOT EXISTS (
        SELECT 1 FROM place o WHERE o.doc_id = p.doc_id AND o.first <= p.first AND o.first + o.n >= p.first + p.n
            AND (o.priority > p.priority OR (o.priority = p.priority AND (o.n > p.n OR (o.n = p.n AND o.rule < p.rule))))
    ) AS stays
    FROM place p
), summed AS (
    SELECT doc_id, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
        list_sort(coalesce(list(DISTINCT label) FILTER (base), [])) AS base_labels,
        list_sort(coalesce(list(DISTINCT label) FILTER (base OR stays), [])) AS labels,
        max(confidence) FILTER (stays) AS score
    FROM judged GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
    last_word::BIGINT AS last_word, coalesce(array_to_string(base_labels, ','), '') AS base_labels,
    coalesce(array_to_string(labels, ','), '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM doc d LEFT JOIN summed USING (doc_id)
"""
