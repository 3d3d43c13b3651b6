"""DuckDB SQL for the operators' queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH turns AS (
    SELECT conv_id, turn, role, text, coalesce(text, '') AS t, len({_WORDS}) AS n, length(coalesce(text, '')) % 3 AS kind FROM conversations
), calls AS (
    SELECT conv_id, turn, conv_id::VARCHAR || '-' || turn AS call_id,
        CASE kind WHEN 0 THEN 'search' WHEN 1 THEN 'translate' ELSE 'summarise' END AS tool,
        CASE
            WHEN kind = 0 THEN '{{"query":' || to_json(t) || ',"top_k":' || n || '}}'
            WHEN kind = 1 AND n < 10 THEN '{{"text":' || to_json(t) || '}}'
            WHEN kind = 1 THEN '{{"text":' || to_json(t) || ',"to":"en"}}'
            WHEN n < 10 THEN '{{"max_words":"' || n || '","text":' || to_json(t) || ',"tone":"dry"}}'
            ELSE '{{"max_words":' || n || ',"text":' || to_json(t) || '}}'
        END AS arguments,
        CASE
            WHEN kind = 1 AND n < 10 THEN ['to: missing']
            WHEN kind = 2 AND n < 10 THEN ['max_words: not of type integer', 'tone: not in the schema']
            ELSE []::VARCHAR[]
        END AS errors,
        true AS is_call, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island
    FROM turns WHERE role = 'user'
), placed AS (
    SELECT *, CASE WHEN call_id IS NOT NULL THEN row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) - 1 END AS step FROM calls
), results AS (
    SELECT conv_id::VARCHAR || '-' || (turn - 1) AS call_id, text, true AS is_result FROM turns WHERE role = 'assistant'
), linked AS (
    SELECT coalesce(p.call_id, r.call_id) AS call_id, p.tool, p.arguments, r.text AS result, p.step,
        CASE WHEN r.is_result IS NULL THEN 'pending' WHEN p.is_call IS NULL THEN 'orphan' ELSE 'linked' END AS status,
        (p.is_call IS NOT NULL)::BIGINT AS n_calls, (r.is_result IS NOT NULL)::BIGINT AS n_results, coalesce(p.errors, []) AS errors
    FROM placed p FULL JOIN results r ON p.call_id = r.call_id
    UNION ALL
    SELECT conv_id::VARCHAR || '-' || turn, NULL, NULL, text, 0, 'message', 0, 0, [] FROM turns WHERE role IS NULL OR role NOT IN ('user', 'assistant')
)
SELECT call_id, tool, status, step, n_calls, n_results, array_to_string(errors, '; ') AS errors,
    '{{"arguments":' || coalesce(arguments, 'null') || ',"call_id":' || coalesce(to_json(call_id)::VARCHAR, 'null') || ',"errors":' || to_json(errors) || ',"result":' || coalesce(to_json(result)::VARCHAR, 'null')
    || ',"status":' || to_json(status) || ',"step":' || coalesce(step::VARCHAR, 'null') || ',"tool":' || coalesce(to_json(tool)::VARCHAR, 'null') || '}}' AS json
FROM linked
"""

OP3 = rf"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), keyed AS (
    SELECT *, {_LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines
), firsts AS (
    SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key
), marked AS (
    SELECT k.*, coalesce(f.first_doc < k.doc_id, false) AS dropped FROM keyed k LEFT JOIN firsts f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP4 = rf"""
WITH words AS (
    SELECT doc_id, {_WORDS} AS w FROM documents
), windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 11)) AS p, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS body FROM words WHERE len(w) >= 13
), firsts AS (
    SELECT body, min(doc_id) AS first_doc FROM windows GROUP BY body
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS spot FROM windows JOIN firsts USING (body) WHERE first_doc < doc_id
), placed AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS spot FROM words
), kept AS (
    SELECT p.doc_id, string_agg(word, ' ' ORDER BY spot) AS body, count(*) AS n FROM placed p ANTI JOIN gone g USING (doc_id, spot) GROUP BY p.doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.body, '')) AS kept_sha256
FROM words d LEFT JOIN kept k USING (doc_id)
"""

OP5 = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM payloads
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM firsts
"""

OP9 = f"""
WITH bodies AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS body FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
    doc_id = max(doc_id) OVER (PARTITION BY body) AS kept, sha256(body) AS text_sha256
FROM bodies
"""

# The CRC-32 of a decimal number's digits: each digit is mixed in, then eight shifts (-1 stands for one).
_CRC = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) WHEN acc % 2 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END), 4294967295)"""


def _op13(source_levels: int = 6, top_levels: int = 4) -> str:
    """A CTE per level of both trees: 16^6 documents of a source and 16^4 sources are as far as it goes."""
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
    digest = lambda text: "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    parts = [
        f"docs AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '') AS g, {digest('text')} AS leaf, {digest(_LOWER.format('text'))} AS lowered, {_CRC} % 5 = 0 AS tampered FROM documents)",
        """fold0 AS MATERIALIZED (SELECT doc_id, g, leaf, CASE WHEN tampered THEN lowered ELSE leaf END AS folded, '' AS proof,
            row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY g) AS m FROM docs)""",
        "node0 AS MATERIALIZED (SELECT g, p, m, leaf AS node FROM fold0)",
    ]

    def level(k: int, of: str) -> None:
        # runs of 16 nodes; their parents; leaves one level up
        parts.append(f"run{k} AS MATERIALIZED (SELECT {of} AS g, p // 16 AS p, any_value(m) AS m, string_agg(node, '' ORDER BY p) AS run FROM node{k} GROUP BY ALL)")
        parts.append(f"node{k + 1} AS MATERIALIZED (SELECT g, p, (m + 15) // 16 AS m, CASE WHEN m > 1 THEN sha256(run) ELSE run END AS node FROM run{k})")
        left, right = "left(run, 64 * (f.p % 16))", "substr(run, 64 * (f.p % 16) + 65)"
        parts.append(
            f"""fold{k + 1} AS MATERIALIZED (SELECT f.* REPLACE (CASE WHEN f.m > 1 THEN sha256({left} || folded || {right}) ELSE folded END AS folded,
            CASE WHEN f.m > 1 THEN proof || {left} || {right} ELSE proof END AS proof, f.p // 16 AS p, (f.m + 15) // 16 AS m) FROM fold{k} f JOIN run{k} r ON r.g = {"f.g" if of == "g" else "''"} AND r.p = f.p // 16)"""
        )

    for k in range(source_levels):
        level(k, "g")
    n, last = source_levels + 1, source_levels
    parts.append(f"subroots AS MATERIALIZED (SELECT g, node AS subroot, row_number() OVER (ORDER BY g) - 1 AS p, count(*) OVER () AS m FROM node{last})")
    parts.append(f"node{n} AS MATERIALIZED (SELECT '' AS g, p, m, subroot AS node FROM subroots)")
    parts.append(f"fold{n} AS MATERIALIZED (SELECT f.* REPLACE (s.p AS p, s.m AS m), subroot FROM fold{last} f JOIN subroots s USING (g))")
    for k in range(n, n + top_levels):
        level(k, "''")
    end = n + top_levels
    return f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = node AS verified FROM fold{end} CROSS JOIN (SELECT node FROM node{end})"


OP13 = _op13()


def registry() -> dict[str, str]:
    return {"op1_chat_formatting": OP1, "op3_line_dedup": OP3, "op4_substring_dedup": OP4, "op5_warc": OP5, "op9_exact_dedup": OP9, "op13_merkle_manifest": OP13}
