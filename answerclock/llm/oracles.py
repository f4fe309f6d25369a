"""Reference SQL for the queries of this package, written for DuckDB."""

from __future__ import annotations

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))
                              AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15)
              AS BIGINT) AS place
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank
  FROM sized GROUP BY source),
weighted AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
         CAST([3, 1, 2][CAST(rank % 3 + 1 AS INTEGER)] AS DOUBLE) AS weight
  FROM totals),
ranked AS (
  SELECT *, sum(cap) OVER w - cap AS cut,
         (SELECT sum(weight) FROM weighted) - (sum(weight) OVER w - weight) AS free
  FROM weighted WINDOW w AS (ORDER BY cap / weight, source IS NULL, source ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT max((1.5::DOUBLE * (SELECT sum(source_size) FROM totals) - cut) / free) AS value
  FROM ranked
  WHERE (1.5::DOUBLE * (SELECT sum(source_size) FROM totals) - cut) / free <= cap / weight),
targets AS (
  SELECT source, source_size, round(least(cap, weight * value), 6) AS target
  FROM weighted, level),
budgets AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / source_size) AS BIGINT) END
            AS repeats
  FROM targets),
placed AS (
  SELECT s.*, b.source_size, b.target, b.repeats, b.target - b.repeats * b.source_size AS rest,
         sum(size) OVER (PARTITION BY s.source ORDER BY place RANGE UNBOUNDED PRECEDING) AS upto,
         sum(size) OVER (PARTITION BY s.source, place) AS held
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, source, size, source_size, target,
       CAST(size * (repeats + CASE WHEN rest > 0 AND (upto <= rest
                    OR (upto - held <= rest AND upto - rest < rest - (upto - held)))
                    THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed"""

_LOWERED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

DECONTAMINATION = rf"""
WITH doc_words AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ')
         AS words
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i
        FROM item_words WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
placed AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM doc_words, lengths WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item FROM placed JOIN windows USING (n, words)),
hit_words AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY r),
hit_items AS (
  SELECT r, count(DISTINCT item) AS n_items,
         sha256(array_to_string(list_sort(list(DISTINCT item)), ',')) AS items_sha256
  FROM hits GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc_words LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)"""

QUALITY = r"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i:i + 2]) AS n
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM base)),
repeats AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY r),
counted AS (
  SELECT r, doc_id, t, w, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words
  FROM base LEFT JOIN repeats USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
            OR 10 * n_symbols > n_words
            OR 100 * n_dup_lines > 40 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 12 * n_words
            OR len(list_filter(w, lambda x: length(x) > 200)) > 0
            OR 2 * len(regexp_extract_all(t, '\p{Lu}')) > word_chars) AS kept
FROM counted"""

SUBSTRINGS = r"""
WITH base AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT r, i, row_number() OVER (PARTITION BY words ORDER BY r, i) AS nth
  FROM (SELECT r, i, array_to_string(w[i:i + 19], ' ') AS words
        FROM (SELECT r, w, unnest(generate_series(1, len(w) - 19)) AS i FROM base))),
removed AS (
  SELECT DISTINCT r, p
  FROM (SELECT r, unnest(generate_series(i, i + 19)) AS p FROM windows WHERE nth > 1)),
words AS (
  SELECT r, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM base),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS text
  FROM words ANTI JOIN removed USING (r, p) GROUP BY r),
gone AS (SELECT r, count(*) AS n FROM removed GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM base LEFT JOIN kept USING (r) LEFT JOIN gone USING (r)"""

ORACLES = {
    "op2_quality_rules": QUALITY,
    "op3_mixing": MIXING,
    "op6_substring_dedup": SUBSTRINGS,
    "op10_decontamination": DECONTAMINATION,
}
