"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from millrace.llm.mixing import DIGITS, MOST, SLICES, WEIGHTS

_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

MIX = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, {_WORDS}::BIGINT AS size, coalesce(doc_id, 0) % {SLICES} AS slice FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [{", ".join(map(str, WEIGHTS))}][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % {len(WEIGHTS)} + 1] AS weight
  FROM sized GROUP BY source
), reshared AS (
  SELECT 0 AS step, source, source_size, weight, false AS capped, 0.0::DOUBLE AS target FROM totals
  UNION ALL
  SELECT step + 1, source, source_size, weight, capped OR weight * level > {MOST} * source_size,
    CASE WHEN capped OR weight * level > {MOST} * source_size THEN {MOST} * source_size ELSE weight * level END
  FROM (
    SELECT *, (sum(source_size) OVER () - coalesce(sum({MOST} * source_size) FILTER (capped) OVER (), 0))
      / sum(weight) FILTER (NOT capped) OVER () AS level
    FROM reshared) WHERE step < 200
), solved AS (
  SELECT source, source_size, target,
    CASE WHEN source_size > 0 AND target > 0 THEN round(target / source_size, {DIGITS}) ELSE 0 END AS rate
  FROM reshared WHERE step = 200
), cells AS (
  SELECT c.*, source_size, target, floor(rate) AS base, rate - floor(rate) AS frac
  FROM (SELECT source, size, count(*) AS n FROM sized GROUP BY ALL) c JOIN solved s ON c.source IS NOT DISTINCT FROM s.source
), first AS (
  SELECT *, CASE WHEN base >= {MOST} THEN 0 ELSE floor(frac * upto + 0.5) - floor(frac * (upto - n) + 0.5) END AS extra
  FROM (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY size DESC) AS upto FROM cells)
), gaps AS (
  SELECT *, CASE WHEN size = 0 THEN 0 WHEN rest < 0 THEN extra WHEN base >= {MOST} THEN 0 ELSE n - extra END AS room
  FROM (SELECT *, target - sum((base * n + extra) * size) OVER (PARTITION BY source) AS rest FROM first)
), settled AS (
  SELECT *, extra + CASE WHEN rest < 0 THEN -1 ELSE 1 END * least(room, floor(greatest(0, abs(rest) - before) / greatest(size, 1))) AS final
  FROM (SELECT *, coalesce(sum(room * size) OVER (
      PARTITION BY source ORDER BY size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM gaps)
)
SELECT d.doc_id, d.size, s.source_size, s.target,
  (d.size * (s.base + CASE WHEN d.place <= s.final THEN 1 ELSE 0 END))::BIGINT AS taken
FROM (SELECT *, row_number() OVER (PARTITION BY source, size ORDER BY slice, doc_id) AS place FROM sized) d
JOIN settled s ON d.source IS NOT DISTINCT FROM s.source AND d.size = s.size
"""


COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, w[i:i + k - 1] AS ws, count(*)::HUGEINT AS f
  FROM starts, (SELECT unnest([1, 2, 3, 4]) AS k)
  WHERE i + k - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
often AS (SELECT * FROM grams WHERE f >= 30),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, h.f AS l, t.f AS r, cut, 2000000 * c.f // (h.f + t.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM often WHERE k > 1) c
  JOIN often h ON h.lang = c.lang AND h.k = c.cut AND h.ws = c.ws[1:c.cut]
  JOIN often t ON t.lang = c.lang AND t.k = c.k - c.cut AND t.ws = c.ws[c.cut + 1:c.k]),
scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, k, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, k - width AS k, ws[s:s + k - width - 1] AS ws, max(f) AS f
  FROM (SELECT *, unnest(range(1, width + 2)) AS s FROM (SELECT *, unnest(range(1, k - 1)) AS width FROM often WHERE k > 2))
  GROUP BY ALL),
kept AS (
  SELECT s.* FROM scored s JOIN often o ON o.lang = s.lang AND o.k = s.k AND o.phrase = s.phrase
  LEFT JOIN inside i ON i.lang = o.lang AND i.k = o.k AND i.ws = o.ws
  WHERE 100 * coalesce(i.f, 0) < 80 * s.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

NEAREST = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, min(list_distance(q.v, c.v)) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0 GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank, vec_id, score
FROM pairs QUALIFY rank <= 10
"""
