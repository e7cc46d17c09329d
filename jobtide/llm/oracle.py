"""The same questions in SQL for a second engine, where SQL can ask them."""

from __future__ import annotations

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINES = f"""
    SELECT doc_id, pos, line, {LOWER.format(f"trim(line, {SPACES})")} AS key
    FROM (
        SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
    )
"""

OP1 = f"""
WITH lines AS ({LINES}),
common AS (
    SELECT key, max(doc_id) AS top FROM lines
    WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
marked AS (
    SELECT doc_id, pos, line, top IS NOT NULL AND doc_id <> top AS gone
    FROM lines LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP2 = f"""
WITH texts AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
        translate(coalesce(text, ''), {SPACES}, '') AS key FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY key) AS group_size,
    row_number() OVER best = 1 AS kept, sha256(key) AS text_sha256
FROM texts WINDOW best AS (PARTITION BY key ORDER BY n DESC, doc_id)
"""

OP8 = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS digest FROM pages
),
judged AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS last FROM payloads)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
    CASE WHEN size >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN size >= 1000 AND page_id <> last THEN last END AS refers_to, true AS complete
FROM judged
"""

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": OP1,
    "op2_exact_dedup": OP2,
    "op8_warc": OP8,
}
