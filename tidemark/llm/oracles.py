"""The same results as DuckDB SQL, where SQL can express them."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS l, list_slice(w, p, p + least(len(w), 10) - 1) AS k
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM b WHERE len(w) > 0)
), lens AS (SELECT DISTINCT l FROM iw
), dw AS (
  SELECT doc_id, p, l, list_slice(w, p, p + l - 1) AS k
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS p FROM d, lens)
), hits AS (SELECT doc_id, p, dw.l AS l, item_id FROM dw JOIN iw ON dw.l = iw.l AND dw.k = iw.k
), words AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + l)) AS q FROM (SELECT DISTINCT doc_id, p, l FROM hits)) GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_LINES = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT doc_id, p, ls[p] AS line,
         trim(translate(ls[p], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS p FROM d)
), s AS (
  SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE s.k IS NOT NULL AND doc_id <> last) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE s.k IS NULL OR doc_id = last), '')) AS kept_sha256
FROM l LEFT JOIN s ON l.k = s.k GROUP BY doc_id
"""

_CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### : </turn>') + 1 + length(regexp_replace(role, '[\\\\#<:]', 'xx', 'g')) + length(regexp_replace(text, '[\\\\#<]', 'xx', 'g'))) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id
"""

_MERKLE = r"""
WITH RECURSIVE base AS (
  SELECT doc_id, lang,
    concat('', coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'), coalesce(strlen(source) || ':' || source, '-'),
           coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-')) AS head,
    coalesce(strlen(text) || ':' || text, '-') AS body,
    -- A-Z keep their length when lower-cased
    coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS lower_body,
    (list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda i: i::UBIGINT)),
        lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)))) AS crc
  FROM documents
), leaves AS (
  SELECT row_number() OVER () AS id, doc_id, lang, sha256(head || body) AS leaf,
    CASE WHEN xor(crc, 4294967295::UBIGINT) % 3 = 0 THEN sha256(head || lower_body) END AS tampered
  FROM base
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), low AS (
  SELECT lang, 0 AS level, i, leaf AS h, n FROM ranked
  UNION ALL
  SELECT lang, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM low WHERE n > 1 GROUP BY lang, level, i // 8, n
), subroots AS (
  SELECT lang, level AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS j, count(*) OVER () AS groups FROM low WHERE n = 1
), high AS (
  SELECT 0 AS level, j AS i, subroot AS h, groups AS n FROM subroots
  UNION ALL
  SELECT level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM high WHERE n > 1 GROUP BY level, i // 8, n
), runs AS (
  -- the flanks of every node that has a parent
  SELECT lang, level, i, string_agg(h, '') OVER before AS l, string_agg(h, '') OVER after AS r FROM low WHERE n > 1
  WINDOW before AS (PARTITION BY lang, level, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (PARTITION BY lang, level, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
), top_runs AS (
  SELECT level, i, string_agg(h, '') OVER before AS l, string_agg(h, '') OVER after AS r FROM high WHERE n > 1
  WINDOW before AS (PARTITION BY level, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (PARTITION BY level, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
), steps AS (
  SELECT d.id, r.level AS step, coalesce(r.l, '') AS l, coalesce(r.r, '') AS r
  FROM ranked d JOIN runs r ON r.lang IS NOT DISTINCT FROM d.lang AND r.i = d.i // pow(8, r.level)::BIGINT
  UNION ALL
  SELECT d.id, s.height + t.level, coalesce(t.l, ''), coalesce(t.r, '')
  FROM ranked d JOIN subroots s ON s.lang IS NOT DISTINCT FROM d.lang JOIN top_runs t ON t.i = s.j // pow(8, t.level)::BIGINT
), proofs AS (
  SELECT id, string_agg(l || r, '' ORDER BY step) AS proof, count(*) AS steps FROM steps GROUP BY id
), folded AS (
  SELECT id, 0 AS step, coalesce(tampered, leaf) AS h FROM ranked
  UNION ALL
  SELECT f.id, f.step + 1, sha256(s.l || f.h || s.r) FROM folded f JOIN steps s ON s.id = f.id AND s.step = f.step
)
SELECT d.doc_id, d.leaf, s.subroot, t.h AS root, sha256(coalesce(p.proof, '')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM ranked d JOIN subroots s ON s.lang IS NOT DISTINCT FROM d.lang CROSS JOIN (SELECT h FROM high WHERE n = 1) t
LEFT JOIN proofs p ON p.id = d.id JOIN folded f ON f.id = d.id AND f.step = coalesce(p.steps, 0)
"""

ORACLES = {
    "op2_decontamination": _DECONTAMINATION,
    "op4_chat_formatting": _CHAT,
    "op8_line_dedup": _LINES,
    "op13_merkle_manifest": _MERKLE,
}
