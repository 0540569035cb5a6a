"""SQL of the operators whose results SQL can express, apart from the shorter ones in ``queries``."""

from __future__ import annotations

# CRC-32 byte by byte; its table follows from the polynomial.
_CRC_TABLE = """crc AS (
            SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b) ORDER BY b) AS t
            FROM range(256) AS r(b))"""


def _crc32(text: str) -> str:
    return f"xor(4294967295, list_reduce(list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT), lambda c, x: xor(t[1 + (xor(c, x) & 255)], c >> 8), 4294967295::BIGINT))"

def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_OP11 = f"""
        WITH RECURSIVE {_CRC_TABLE},
        d AS (
            SELECT *, row_number() OVER () AS k, {_leaf("text")} AS leaf,
                CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS claimed
            FROM documents, crc),
        leaves AS (
            SELECT k, doc_id, source, leaf, {_leaf("claimed")} AS other,
                row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
            FROM d),
        tree AS (
            SELECT source, 0 AS level, i, leaf AS h, n FROM leaves
            UNION ALL
            SELECT source, any_value(level + 1), i // 3, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 2) // 3)
            FROM tree WHERE n > 1 GROUP BY source, i // 3),
        subroots AS (
            SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
        top AS (
            SELECT 0 AS level, i, h, n FROM subroots
            UNION ALL
            SELECT any_value(level + 1), i // 3, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 2) // 3) FROM top WHERE n > 1 GROUP BY i // 3),
        runs AS (SELECT source, level, i // 3 AS r, list(h ORDER BY i) AS hs FROM tree WHERE n > 1 GROUP BY source, level, i // 3),
        top_runs AS (SELECT level, i // 3 AS r, list(h ORDER BY i) AS hs FROM top WHERE n > 1 GROUP BY level, i // 3),
        steps AS (
            SELECT k, 0 AS part, level, hs, (i // CAST(pow(3, level) AS BIGINT)) % 3 AS slot
            FROM leaves l JOIN runs r ON r.source IS NOT DISTINCT FROM l.source AND r.r = i // CAST(pow(3, level + 1) AS BIGINT)
            UNION ALL
            SELECT k, 1, level, hs, (s.i // CAST(pow(3, level) AS BIGINT)) % 3
            FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
            JOIN top_runs r ON r.r = s.i // CAST(pow(3, level + 1) AS BIGINT)),
        path AS (
            SELECT k, hs, slot, row_number() OVER (PARTITION BY k ORDER BY part, level) AS step,
                array_to_string(list_concat(hs[1:slot], hs[slot + 2:]), '') AS others
            FROM steps),
        folds AS (
            SELECT k, 0::BIGINT AS step, other AS h FROM leaves
            UNION ALL
            SELECT f.k, p.step, sha256(array_to_string(list_concat(hs[1:slot], [f.h], hs[slot + 2:]), '')) FROM folds f JOIN path p ON p.k = f.k AND p.step = f.step + 1),
        proofs AS (SELECT k, string_agg(others, '' ORDER BY step) AS proof FROM path GROUP BY k),
        reached AS (SELECT k, max_by(h, step) AS folded_root FROM folds GROUP BY k)
        SELECT l.doc_id, l.leaf, s.h AS subroot, t.h AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = t.h AS verified
        FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source JOIN top t ON t.n = 1
        JOIN reached r ON r.k = l.k LEFT JOIN proofs p ON p.k = l.k"""



_BLANKS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP13 = f"""
        WITH RECURSIVE {_CRC_TABLE},
        raw AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
            FROM conversations, crc),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM raw, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copies(c)),
        numbered AS (
            SELECT *, rtrim(text, {_BLANKS}) AS bare, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
            FROM damaged),
        placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM numbered),
        faults AS (
            SELECT *, CASE WHEN bare = '' THEN 'b' WHEN seen > 1 THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
                left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS adjacent
            FROM placed),
        -- States: 0 nothing yet, 1 after s, 2 after u, 3 after a. Inserts lead from one to the next.
        moves(f, g, roles) AS (VALUES (0, 0, ''), (0, 2, 'u'), (0, 3, 'ua'), (1, 1, ''), (1, 2, 'u'), (1, 3, 'ua'),
            (2, 2, ''), (2, 3, 'a'), (3, 3, ''), (3, 2, 'u')),
        reads(f, g, initial) AS (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (3, 2, 'u'), (2, 3, 'a')),
        edits AS (
            SELECT f, g, roles, initial, edit, base FROM (
                SELECT m.f, r.g, m.roles, r.initial, 'K' AS edit, 0 AS base FROM moves m JOIN reads r ON r.f = m.g
                UNION ALL SELECT m.f, r.g, m.roles, r.initial, 'R', 3 FROM moves m JOIN reads r ON r.f = m.g WHERE r.initial <> 's'
                UNION ALL SELECT f, g, roles, NULL, 'D', 4 FROM moves)),
        steps AS (
            SELECT conv_id, 0::BIGINT AS i, 0 AS state, {{'cost': 0::BIGINT, 'audit': '', 'text': ''}} AS best
            FROM (SELECT DISTINCT conv_id FROM conversations)
            UNION ALL
            SELECT s.conv_id, any_value(s.i + 1), e.g, min({{
                'cost': s.best.cost + e.base + 3 * length(e.roles) + CASE WHEN e.edit <> 'D' AND r.fault = 't' THEN 3 ELSE 0 END,
                'audit': s.best.audit || repeat('I', length(e.roles)) || e.edit,
                'text': s.best.text || replace(replace(e.roles, 'a', chr(10) || 'assistant:'), 'u', chr(10) || 'user:') ||
                    CASE e.edit WHEN 'K' THEN chr(10) || r.role || ':' || r.text
                        WHEN 'R' THEN chr(10) || CASE e.initial WHEN 'u' THEN 'user:' ELSE 'assistant:' END || r.text ELSE '' END}})
            FROM steps s JOIN faults r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1 JOIN edits e ON e.f = s.state
            WHERE e.edit = 'D' OR r.fault NOT IN ('b', 'd') AND (e.edit = 'R' OR e.initial = left(r.role, 1))
            GROUP BY s.conv_id, e.g),
        ended AS (
            SELECT s.conv_id, min({{'cost': s.best.cost + 3 * length(m.roles), 'audit': s.best.audit || repeat('I', length(m.roles)),
                'text': s.best.text || replace(replace(m.roles, 'a', chr(10) || 'assistant:'), 'u', chr(10) || 'user:')}}) AS best
            FROM steps s JOIN moves m ON m.f = s.state
            WHERE m.g IN (0, 3) AND s.i = (SELECT count(*) FROM faults r WHERE r.conv_id IS NOT DISTINCT FROM s.conv_id)
            GROUP BY s.conv_id),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
                count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                count(*) FILTER (adjacent NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faults GROUP BY conv_id)
        SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
            coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
            sha256(substr(best.text, 2)) AS repaired_sha256
        FROM ended e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""


ORACLE_SQL: dict[str, str] = {"op11_merkle_manifest": _OP11, "op13_conversation_repair": _OP13}
