"""DuckDB SQL for the queries that SQL can express, by key."""

HOST_RULES = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d
), lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM w
), starts AS (
  SELECT doc_id, unnest(list_transform(range(1, len(ws) - 3), lambda i: {'i': i, 'v': array_to_string(ws[i:i + 4], ' ')})) AS s
  FROM w WHERE len(ws) >= 5
), windows AS (
  SELECT doc_id, s.i AS i, count(*) OVER (PARTITION BY doc_id, s.v) AS n FROM starts
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS p FROM windows WHERE n > 1
  ) GROUP BY doc_id
), counts AS (
  SELECT w.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words
  FROM w JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
), hosts AS (
  SELECT source AS host, count(*)::DOUBLE AS n, count(*) FILTER (base_failed)::DOUBLE AS k FROM judged GROUP BY source
), total AS (
  SELECT sum(n) AS n, sum(k) AS k, count(*) AS hosts, sum(n * n) AS n2, sum(k * k / n) AS k2 FROM hosts
), moments AS (
  SELECT k / n AS mean, (k2 - k * k / n - (hosts - 1) * (k / n) * (1 - k / n)) / (n - n2 / n) AS variance, hosts FROM total
), prior AS (
  SELECT mean, CASE WHEN hosts > 1 AND variance > 0 THEN greatest(mean * (1 - mean) / variance - 1, 0) END AS weight FROM moments
), rates AS (
  SELECT host, CASE WHEN weight IS NULL THEN mean ELSE (k + weight * mean) / (hosts.n + weight) END AS rate FROM hosts, prior
)
SELECT doc_id, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rate <= 0.5 AS kept
FROM judged JOIN rates ON source IS NOT DISTINCT FROM host
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), grams AS (
  SELECT lang, 1 AS k, unnest(ws) AS phrase FROM w
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w
), f AS (
  SELECT lang, k, phrase, count(*)::HUGEINT AS n FROM grams GROUP BY ALL
), found AS (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS p FROM f WHERE k > 1 AND n >= 10
), cuts AS (
  SELECT lang, k, phrase, a, 1 AS cut, p[1] AS head, array_to_string(p[2:], ' ') AS rest FROM found
  UNION ALL
  SELECT lang, k, phrase, a, 2, p[1] || ' ' || p[2], p[3] FROM found WHERE k = 3
), scored AS (
  SELECT c.*, h.n AS l, r.n AS r, 1000000::HUGEINT * a * a // (h.n * r.n) AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f r ON r.lang = c.lang AND r.phrase = c.rest
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), covers AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, p[1] || ' ' || p[2] AS phrase, a FROM found WHERE k = 3
    UNION ALL
    SELECT lang, p[2] || ' ' || p[3], a FROM found WHERE k = 3
  ) GROUP BY ALL
), kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN covers USING (lang, phrase) WHERE k = 3 OR most IS NULL OR 100 * most < 50 * a
), totals AS (
  SELECT lang, sum(n) AS n FROM f WHERE k = 1 GROUP BY lang
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op8_host_rules": HOST_RULES,
    "op11_weighted_automata": COLLOCATIONS,
}
