"""DuckDB SQL for the operators that SQL can express on whole tables."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op10_exact_dedup": f"""
        WITH n AS (SELECT doc_id, {_LOWER} AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
        SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
        FROM n JOIN g ON n.t = g.t
    """,
    # windows of 50 bytes as 100 hexadecimal digits
    "op1_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
        w AS (SELECT doc_id, p, substr(h, CAST(2 * p + 1 AS INTEGER), 100) AS k FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 49, 0))) AS p FROM d)),
        m AS (SELECT k, min(doc_id) AS low FROM w GROUP BY k),
        hit AS (SELECT w.doc_id, w.p FROM w JOIN m ON w.k = m.k WHERE m.low < w.doc_id),
        o AS (SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM hit),
        r AS (SELECT doc_id, p, sum(CASE WHEN gap IS NULL OR gap > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM o),
        s AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM r GROUP BY doc_id, run),
        e AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM s),
        k AS (SELECT e.doc_id, string_agg(substr(d.h, CAST(2 * e.before + 1 AS INTEGER), CAST(2 * (e.a - e.before) AS INTEGER)), '' ORDER BY e.a) AS kept,
                     max(e.b) AS last, sum(e.b - e.a) AS removed, count(*) AS spans
              FROM e JOIN d ON d.doc_id = e.doc_id GROUP BY e.doc_id)
        SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(k.removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(k.spans, 0) AS BIGINT) AS n_spans,
               sha256(unhex(CASE WHEN k.doc_id IS NULL THEN d.h ELSE k.kept || substr(d.h, CAST(2 * k.last + 1 AS INTEGER)) END)) AS kept_sha256
        FROM d LEFT JOIN k ON k.doc_id = d.doc_id
    """,
    "op8_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        w AS (SELECT doc_id, p, array_to_string(ws[p : p + 34], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 33, 1))) AS p FROM d)),
        m AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
        hit AS (SELECT w.doc_id, w.p FROM w SEMI JOIN m ON w.k = m.k),
        u AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
        c AS (SELECT u.doc_id, u.i, u.ws[u.i] AS word, max(h.p) OVER (PARTITION BY u.doc_id ORDER BY u.i) AS p FROM u LEFT JOIN hit h ON h.doc_id = u.doc_id AND h.p = u.i),
        k AS (SELECT doc_id, count(*) FILTER (WHERE i - p < 35) AS removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE p IS NULL OR i - p >= 35) AS kept FROM c GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(k.removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
        FROM d LEFT JOIN k ON k.doc_id = d.doc_id
    """,
}
