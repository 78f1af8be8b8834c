"""DuckDB SQL for the queries that SQL can express, written from their definitions."""

from __future__ import annotations

from .line_dedup import MIN_CHARS
from .quality_rules import ALPHA, DELTA, GRID, LEAST_WORDS, MOST_REPEATED

#: Fixed value: the white space between words, as an SQL string.
BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_GRID = ", ".join(f"('{rule}', {i}, {cut}::DOUBLE)" for rule, cuts in GRID.items() for i, cut in enumerate(cuts))
_SHARE = ALPHA / len(GRID)

QUALITY_RULES = f"""
WITH d AS (
  SELECT doc_id, coalesce('=' || lang, 'none') AS stratum, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {BLANKS}) <> '') AS l
  FROM documents),
grams AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM d, unnest(range(1, len(w) - 1)) r(i)),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) r(k) GROUP BY doc_id),
c AS (
  SELECT doc_id, stratum, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(t, '\\P{{Lu}}+', '', 'g'))::BIGINT AS n_upper, len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id)),
r AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
         coalesce(n_symbols / nullif(n_words, 0), 0.0) AS symbol_ratio,
         coalesce(n_upper / nullif(word_chars, 0), 0.0) AS upper_ratio,
         coalesce(n_dup_lines / nullif(n_lines, 0), 0.0) AS dup_line_ratio,
         coalesce(n_repeat_words / nullif(n_words, 0), 0.0) AS repeat_ratio,
         coalesce(word_chars / nullif(n_words, 0), 0.0) AS mean_word_chars
  FROM c),
u AS (UNPIVOT (SELECT doc_id, symbol_ratio::DOUBLE AS symbol_ratio, upper_ratio::DOUBLE AS upper_ratio,
                      dup_line_ratio::DOUBLE AS dup_line_ratio, repeat_ratio::DOUBLE AS repeat_ratio,
                      mean_word_chars::DOUBLE AS mean_word_chars FROM r)
      ON symbol_ratio, upper_ratio, dup_line_ratio, repeat_ratio, mean_word_chars INTO NAME rule VALUE ratio),
truth AS (SELECT doc_id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
grid(rule, step, cutoff) AS (VALUES {_GRID}),
counted AS (
  SELECT stratum, rule, step, cutoff, sum(good) AS n, count(*) FILTER (WHERE ratio > cutoff AND good = 1) AS k,
         count(*) FILTER (WHERE ratio > cutoff AND good = 0) AS bad
  FROM r JOIN truth USING (doc_id) JOIN u USING (doc_id) JOIN grid USING (rule)
  WHERE NOT base_failed GROUP BY ALL),
tested AS (
  SELECT *, k < n * {_SHARE} AND list_sum(list_transform(range(0, k + 1), lambda i: exp(
              lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_SHARE}) + (n - i) * ln(1 - {_SHARE}))))
            <= {DELTA} / {len(GRID)} / (SELECT count(DISTINCT stratum) FROM counted) AS passed
  FROM counted),
allowed AS (
  SELECT * FROM (SELECT *, bool_and(passed) OVER (PARTITION BY stratum, rule ORDER BY step) AS sure FROM tested)
  WHERE sure AND bad > 0),
cuts AS (SELECT stratum, rule, cutoff FROM allowed
         QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY bad DESC, step) = 1),
failed AS (SELECT DISTINCT doc_id FROM r JOIN u USING (doc_id) JOIN cuts USING (stratum, rule) WHERE ratio > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM failed) AS kept
FROM r"""

LINE_DEDUP = f"""
WITH parts AS (
  SELECT doc_id, i - 1 AS pos, trim(string_split(coalesce(text, ''), chr(10))[i], {BLANKS}) AS line
  FROM documents, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) r(i)),
lines AS (SELECT *, row_number() OVER (ORDER BY doc_id, pos) AS place FROM parts WHERE line <> ''),
firsts AS (SELECT line, min(place) AS place FROM lines GROUP BY line),
longer AS (SELECT * FROM firsts WHERE length(line) >= {MIN_CHARS}),
pairs AS (
  SELECT b.line AS line, a.line AS mate FROM longer a JOIN longer b ON left(a.line, {MIN_CHARS // 2}) = left(b.line, {MIN_CHARS // 2})
  WHERE a.place < b.place AND abs(length(a.line) - length(b.line)) <= 1
  UNION
  SELECT b.line, a.line FROM longer a JOIN longer b ON right(a.line, {MIN_CHARS // 2}) = right(b.line, {MIN_CHARS // 2})
  WHERE a.place < b.place AND abs(length(a.line) - length(b.line)) <= 1),
near AS (SELECT DISTINCT line FROM pairs WHERE levenshtein(line, mate) <= 1),
marked AS (
  SELECT doc_id, pos, l.place <> f.place OR l.line IN (SELECT line FROM near) AS gone
  FROM lines l JOIN firsts f USING (line))
SELECT d.doc_id, count(pos)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       coalesce(string_agg(pos::VARCHAR, ',' ORDER BY pos) FILTER (WHERE gone), '') AS dropped
FROM documents d LEFT JOIN marked USING (doc_id) GROUP BY d.doc_id"""

_BASE32 = " || ".join(f"to_base(('0x' || substr(h, {1 + 5 * i}, 5))::BIGINT, 32, 4)" for i in range(8))

WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
best AS (SELECT payload, max(page_id) AS keeper FROM p GROUP BY payload)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
       translate(upper({_BASE32}), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p JOIN best USING (payload)"""

RANKED_SEARCH = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
p AS (SELECT r, doc_id, len(ts) AS n, t, count(*) AS tf FROM (SELECT r, doc_id, ts, unnest(ts) AS t FROM d) GROUP BY r, doc_id, len(ts), t),
s AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS nn, sum(len(ts)) AS ll FROM d),
q AS (SELECT DISTINCT i, item_id, t FROM (
  SELECT row_number() OVER () AS i, item_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark)),
w AS (SELECT t, CAST(floor(1000 * ln((2 * (SELECT nn FROM s) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p GROUP BY t),
x AS (
  SELECT q.i, q.item_id, p.r, p.doc_id,
         CAST(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * p.n * s.nn) // s.ll)))) AS BIGINT) AS score
  FROM q JOIN p USING (t) JOIN w USING (t) CROSS JOIN s GROUP BY q.i, q.item_id, p.r, p.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM x WHERE score > 0)
WHERE rank <= 10"""

ORACLES: dict[str, str] = {"op2_quality_rules": QUALITY_RULES, "op7_line_dedup": LINE_DEDUP, "op10_warc": WARC,
                           "op11_ranked_search": RANKED_SEARCH}
