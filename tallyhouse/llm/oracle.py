"""SQL, as DuckDB runs it, for queries over the given tables. Plain and quadratic or wide: meant for small tables."""

from __future__ import annotations

from tallyhouse.llm.license_scan import license_scan_sql
from tallyhouse.llm.line_templates import line_dedup_sql

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

NGRAM_JOIN = f"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
                 WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                 ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM d),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
    reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a)
    SELECT a AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(b) AS component_id
    FROM reach LEFT JOIN n ON n.doc_id = a GROUP BY a
"""

WARC = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
    r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM d)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to
    FROM r
"""

SUFFIX_DEDUP = """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 49, 0))) AS i FROM d),
    f AS (SELECT doc_id, i, md5(h[2 * i + 1 : 2 * i + 100]) AS g FROM w),
    m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first_doc FROM f),
    c AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS is_new
          FROM m WHERE first_doc < doc_id),
    o AS (SELECT doc_id, i, sum(is_new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM c),
    spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM o GROUP BY doc_id, run),
    cuts AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS s, a AS e FROM spans
             UNION ALL SELECT d.doc_id, coalesce(max(b), 0), any_value(len(h)) // 2 FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id),
    kept AS (SELECT doc_id, string_agg(h[2 * s + 1 : 2 * e], '' ORDER BY s) AS k FROM cuts JOIN d USING (doc_id) GROUP BY doc_id),
    removed AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(k)) AS kept_sha256
    FROM d JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""

FLAT_GRAPH = """
    WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
                         WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                           AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
    reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
    c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
    k AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
    SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept, CAST(1 AS DOUBLE) AS audited_recall
    FROM c LEFT JOIN k USING (vec_id)
"""

SPELLING_GROUPS = f"""
    WITH RECURSIVE d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS r FROM documents),
    o AS (SELECT doc_id, r, count(*) AS c FROM d WHERE length(r) >= 5 GROUP BY ALL),
    t AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
              lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i))),
    b AS (SELECT *, concat(doc_id, ':', r) AS s FROM o),
    y AS (SELECT doc_id, r, c, list_prepend(4294967295, flatten(list_transform(string_split(s, ''),
              lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] END)::BIGINT[][])) AS y FROM b),
    h AS (SELECT doc_id, r, c, xor(list_reduce(y, lambda a, x: xor(t.t[(xor(a, x) & 255) + 1], a >> 8)), 4294967295) AS h FROM y, t),
    w AS (SELECT word, sum(c)::BIGINT AS n FROM (SELECT c, CASE WHEN doc_id IS NOT NULL AND h % 97 = 0
              THEN left(r, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word FROM h)
          WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
    x AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w),
    e AS (SELECT word, left(word, i - 1) || substr(word, i + 1) AS less, left(word, i - 1) || '*' || substr(word, i + 1) AS wild FROM x),
    p AS (SELECT a.word AS a, b.word AS b FROM e a JOIN e b ON a.wild = b.wild AND a.word <> b.word
          UNION SELECT e.word, w.word FROM e JOIN w ON w.word = e.less
          UNION SELECT w.word, e.word FROM e JOIN w ON w.word = e.less),
    q AS (SELECT p.a, w.word AS b, w.n, row_number() OVER (PARTITION BY p.a ORDER BY w.n DESC, encode(w.word)) AS place,
                 count(*) OVER (PARTITION BY p.a) AS n_near FROM p JOIN w ON w.word = p.b),
    f AS (SELECT w.word, w.n, coalesce(q.n_near, 0) AS n_near, CASE WHEN q.n >= 2 * w.n THEN q.b END AS form,
                 CASE WHEN q.n >= 2 * w.n THEN q.n END AS form_n FROM w LEFT JOIN q ON q.a = w.word AND q.place = 1),
    g(word, root) AS (SELECT word, word FROM f WHERE form IS NULL UNION ALL SELECT f.word, g.root FROM g JOIN f ON f.form = g.word)
    SELECT f.word, f.form, g.root, f.n, f.n_near, f.form_n FROM f JOIN g USING (word)
"""

ORACLE: dict[str, str] = {
    "op1_ngram_join": NGRAM_JOIN,
    "op4_line_templates": line_dedup_sql(),
    "op5_warc": WARC,
    "op6_license_scan": license_scan_sql(),
    "op8_suffix_dedup": SUFFIX_DEDUP,
    "op10_flat_graph": FLAT_GRAPH,
    "op13_spelling_trie": SPELLING_GROUPS,
}
