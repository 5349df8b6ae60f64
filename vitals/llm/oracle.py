"""DuckDB SQL of the training-data queries that SQL can express, over whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH item AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS gram, least(13, len(w)) AS size
  FROM item, unnest(range(1, greatest(2, len(w) - 11))) AS t(i) WHERE len(w) > 0),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
pos AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM doc, (SELECT DISTINCT size FROM win) s, unnest(range(1, len(w) - size + 2)) AS t(i) WHERE len(w) >= size),
hit AS (SELECT pos.doc_id, pos.i, pos.size, win.item FROM pos JOIN win USING (gram, size)),
marked AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hit, unnest(range(i, i + size)) AS t(k) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)
"""


#: Brute force: every anchor against every row.
HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
 FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id AS other, a.label = v.label AS same, list_inner_product(a.e, v.e)::BIGINT AS score FROM v a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, s.other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, s.other) QUALIFY row_number() OVER w <= 5
"""

#: Least (cost, audit) by row and role state, row by row; crc32 by its table.
CONVERSATION_REPAIR = r"""
WITH RECURSIVE
crc AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i)),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kinds AS (
  SELECT conv_id, turn, role, text,
    xor(list_reduce(list_transform(string_split(k, ''), lambda x: ord(x)::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 20 AS kind
  FROM raw, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(2) r(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER o AS i, lag(role) OVER o AS before,
    rtrim(text, E' \t\n\x0b\x0c\r') AS bare
  FROM damaged WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
rows AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'good' END AS fault, left(role, 1) AS r
  FROM placed),
stats AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND left(before, 1) || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id),
-- states: 0 nothing yet, s, u, a: the initial of the last role
search AS (
  SELECT conv_id, 0::BIGINT AS i, '0' AS st, {'cost': 0::BIGINT, 'audit': ''} AS best FROM stats
  UNION ALL
  SELECT conv_id, i, st, min(best) FROM (
    SELECT p.conv_id, p.i + 1 AS i, e.st, {'cost': p.cost + e.cost + CASE WHEN e.edit <> 'D' AND rows.fault = 'truncated' THEN 5 ELSE 0 END, 'audit': p.audit || e.edit} AS best
    FROM (
      SELECT conv_id, i, st, best.cost AS cost, best.audit AS audit FROM search
      UNION ALL
      SELECT conv_id, i, CASE WHEN st = 'u' THEN 'a' ELSE 'u' END, best.cost + 5, best.audit || 'I' FROM search) p
    JOIN rows ON rows.conv_id IS NOT DISTINCT FROM p.conv_id AND rows.i = p.i + 1,
    LATERAL (
      SELECT 'D' AS edit, 2 AS cost, p.st AS st
      UNION ALL SELECT 'K', 0, rows.r WHERE rows.fault IN ('good', 'truncated') AND (rows.r = CASE WHEN p.st = 'u' THEN 'a' ELSE 'u' END OR rows.r = 's' AND p.st = '0')
      UNION ALL SELECT 'R', 1, CASE WHEN p.st = 'u' THEN 'a' ELSE 'u' END WHERE rows.fault IN ('good', 'truncated')) e) q
  GROUP BY conv_id, i, st),
ends AS (
  SELECT conv_id, min(CASE WHEN st = 'u' THEN {'cost': best.cost + 5, 'audit': best.audit || 'I'} ELSE best END) AS best
  FROM search JOIN stats USING (conv_id) WHERE i = n AND st <> 's' GROUP BY conv_id),
edits AS (
  SELECT conv_id, j, best.audit[j] AS edit, length(replace(best.audit[:j], 'I', '')) AS i, length(replace(best.audit[:j], 'D', '')) AS pos
  FROM ends, LATERAL (SELECT unnest(range(1, length(best.audit) + 1)) AS j)),
kept AS (SELECT e.conv_id, j, pos, edit, role, text, r FROM edits e LEFT JOIN rows ON rows.conv_id IS NOT DISTINCT FROM e.conv_id AND rows.i = e.i AND edit <> 'I' WHERE edit <> 'D'),
led AS (SELECT *, (first_value(edit = 'K' AND r = 's') OVER (PARTITION BY conv_id ORDER BY j))::BIGINT AS lead FROM kept),
lines AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (pos - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY j) AS t FROM led GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN lines ON lines.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def all_sql() -> dict[str, str]:
    return {"op3_decontamination": DECONTAMINATION, "op12_hard_negatives": HARD_NEGATIVES, "op13_conversation_repair": CONVERSATION_REPAIR}
