"""The registered queries of this package and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from tapehouse.llm import (
    attribution,
    codebooks,
    decontaminate,
    differencing,
    fingerprints,
    jaccard,
    langid,
    lm,
    packing,
    repeats,
    secrets,
    turns,
    warc,
)

QUERIES = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op2_warc_round_trip": warc.op2_warc_round_trip,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_lm_scoring": lm.op4_lm_scoring,
    "op5_scaled_fingerprints": fingerprints.op5_scaled_fingerprints,
    "op6_language_id": langid.op6_language_id,
    "op7_secret_scans": secrets.op7_secret_scans,
    "op8_ngram_jaccard_join": jaccard.op8_ngram_jaccard_join,
    "op9_suffix_array_dedup": repeats.op9_suffix_array_dedup,
    "op10_token_attribution": attribution.op10_token_attribution,
    "op11_vector_codes": codebooks.op11_vector_codes,
    "op12_conversation_repair": turns.op12_conversation_repair,
    "op13_differencing_packing": differencing.op13_differencing_packing,
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

def _assigned(n: int) -> str:
    """CTE near{n}: each part's nearest entry of book{n}, ties to the lower one."""
    return f"""near{n} AS MATERIALIZED (
            SELECT id, position, x, min(struct_pack(d := d, e := entry)) AS best FROM (
                SELECT p.id, p.position, p.x, b.entry,
                       list_sum(list_transform(list_zip(p.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
                FROM part p JOIN book{n} b USING (position)
            ) GROUP BY ALL
        )"""


def _updated(n: int) -> str:
    """CTE book{n + 1}: floors of the means of book{n}'s members; entries without members stay."""
    return f"""mean{n} AS (
            SELECT position, entry, list(mean ORDER BY j) AS c FROM (
                SELECT position, best.e AS entry, j, floor(sum(x[j]) / count(*))::BIGINT AS mean
                FROM near{n}, range(1, 5) r(j) GROUP BY ALL
            ) GROUP BY ALL
        ), book{n + 1} AS MATERIALIZED (
            SELECT b.position, b.entry, coalesce(m.c, b.c) AS c FROM book{n} b LEFT JOIN mean{n} m USING (position, entry)
        )"""


ORACLE_SQL: dict[str, str] = {
    "op2_warc_round_trip": """
        WITH p AS (
            SELECT page_id, url, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id > first THEN first END AS refers_to, nullif(url, '') AS url
        FROM p LEFT JOIN f USING (payload_digest)
    """,
    "op8_ngram_jaccard_join": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), shingled AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
            FROM w
        ), sized AS (SELECT doc_id, s, len(s) AS n FROM shingled),
        item AS (SELECT doc_id, n, unnest(s) AS g FROM sized),
        link AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM item a JOIN item b ON a.g = b.g AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other
        )
        SELECT s.doc_id, s.n AS n_shingles, min(r.other) AS component_id
        FROM sized s JOIN reach r USING (doc_id) GROUP BY s.doc_id, s.n
    """,
    "op11_vector_codes": f"""
        WITH kept AS (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS id, vec_id, label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), part AS MATERIALIZED (
            SELECT id, p.i AS position, v[4 * p.i + 1:4 * p.i + 4] AS x FROM kept, range(16) p(i)
        ), book0 AS (SELECT position, id - 1 AS entry, x AS c FROM part WHERE id <= 64),
        {_assigned(0)}, {_updated(0)}, {_assigned(1)}, {_updated(1)}, {_assigned(2)},
        code AS (
            SELECT id, string_agg(printf('%02x', best.e), '' ORDER BY position) AS code, sum(best.d)::BIGINT AS error
            FROM near2 GROUP BY id
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY position, entry)) FROM book2) AS codebooks_sha256
        FROM kept JOIN code USING (id)
    """,
    "op12_conversation_repair": r"""
        WITH RECURSIVE keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
            FROM conversations
        ), crc AS (  -- CRC-32, a byte and then a bit at a time
            SELECT *, xor(list_reduce([4294967295] || list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT),
                lambda a, b: list_reduce([xor(a, b), 1, 2, 3, 4, 5, 6, 7, 8],
                    lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS k
            FROM keyed
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
                   CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM crc WHERE k <> 0
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                       sha256(length(role)::VARCHAR || ':' || role || text), copy) AS i,
                   trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown
            FROM damaged
        ), judged AS (
            SELECT *, left(role, 1) AS initial,
                   CASE WHEN shown = '' THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                        WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                   coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au'), FALSE) AS illegal
            FROM placed
        ), counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal, count(*) AS n
            FROM judged GROUP BY conv_id
        ), step(state, initial, nxt) AS (
            VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')
        ), put AS (
            SELECT state, nxt, chr(10) || CASE nxt WHEN 'u' THEN 'user:' ELSE 'assistant:' END AS line FROM step WHERE initial <> 's'
        ), inserted AS (  -- none, one or two turns put in
            SELECT state, state AS nxt, 0 AS cost, '' AS edits, '' AS lines FROM (VALUES (''), ('s'), ('u'), ('a')) v(state)
            UNION ALL SELECT state, nxt, 3, 'I', line FROM put
            UNION ALL SELECT p.state, q.nxt, 6, 'II', p.line || q.line FROM put p JOIN put q ON q.state = p.nxt
        ), search(conv_id, i, state, cost, audit, lines) AS (
            SELECT conv_id, 0, '', 0, '', '' FROM counts
            UNION ALL
            SELECT conv_id, i, state, cost, audit, lines FROM (
                SELECT *, row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) AS best FROM (
                    SELECT s.conv_id, s.i + 1 AS i, e.nxt AS state, s.cost + x.cost + e.cost AS cost,
                           s.audit || x.edits || e.edit AS audit, s.lines || x.lines || e.line AS lines
                    FROM search s JOIN inserted x ON x.state = s.state
                    JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.i = s.i + 1
                    JOIN LATERAL (
                        SELECT x.nxt AS nxt, 4 AS cost, 'D' AS edit, '' AS line
                        UNION ALL SELECT t.nxt, CASE WHEN j.fault = 'truncated' THEN 3 ELSE 0 END, 'K', chr(10) || j.role || ':' || j.text
                        FROM step t WHERE t.state = x.nxt AND t.initial = j.initial AND j.fault IN ('', 'truncated')
                        UNION ALL SELECT p.nxt, CASE WHEN j.fault = 'truncated' THEN 6 ELSE 3 END, 'R', p.line || j.text
                        FROM put p WHERE p.state = x.nxt AND j.fault IN ('', 'truncated')
                    ) e ON TRUE
                )
            ) WHERE best = 1
        ), ended AS (
            SELECT s.conv_id, s.cost + x.cost AS cost, s.audit || x.edits AS audit, s.lines || x.lines AS lines,
                   row_number() OVER (PARTITION BY s.conv_id ORDER BY s.cost + x.cost, s.audit || x.edits) AS best
            FROM search s JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND s.i = c.n
            JOIN inserted x ON x.state = s.state AND x.nxt IN ('', 'a')
        )
        SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
               coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(e.cost, 0)::BIGINT AS cost,
               coalesce(e.audit, '') AS audit, sha256(coalesce(substr(e.lines, 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id AND e.best = 1
    """,
}
