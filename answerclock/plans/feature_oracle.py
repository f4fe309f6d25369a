"""Reference SQL for ``feature_queries``, written for DuckDB."""

from __future__ import annotations

from answerclock.plans.oracle import (
    CLEAN,
    DELAYS,
    LABELS,
    POSTS,
    TAGGED,
    TIMES,
    TOKENS,
    _FEATURE_PARTS,
    _ROUNDED,
    _TAG_PARTS,
    _stems,
    _with,
)
from answerclock.schemas import FEATURES


EVENTS = """
happened AS (
  SELECT tag, creation_date AS moment, 1 AS asked, coalesce(view_count, 0) AS views, 0 AS answered,
         0 AS fast, 0 AS delay FROM tagged
  UNION ALL
  SELECT q.tag, a.creation_date, 0, 0, 1,
         CASE WHEN epoch(a.creation_date) - epoch(q.creation_date) < 720 * 3600 THEN 1 ELSE 0 END,
         CAST(floor(epoch(a.creation_date)) AS BIGINT) - CAST(floor(epoch(q.creation_date)) AS BIGINT)
  FROM tagged q JOIN posts a ON a.parent_id = q.id),
events_ AS (
  SELECT tag, moment, sum(asked) AS asked, sum(views) AS views, sum(answered) AS answered,
         sum(fast) AS fast, sum(delay) AS delay FROM happened GROUP BY tag, moment),
before AS (
  SELECT tag, moment, coalesce(sum(asked) OVER w, 0) AS asked, coalesce(sum(views) OVER w, 0) AS views,
         coalesce(sum(answered) OVER w, 0) AS answered, coalesce(sum(fast) OVER w, 0) AS fast,
         coalesce(sum(delay) OVER w, 0) AS delay
  FROM events_
  WINDOW w AS (PARTITION BY tag ORDER BY moment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""

TAGGED_TIMES = """
tagged_times AS (
  SELECT tag, t.creation_date, response_seconds FROM times t JOIN tagged USING (id))"""

_QUANTILES = """count(*) AS n,
  CAST(quantile_disc(response_seconds, 0.25) AS BIGINT) AS q25,
  CAST(quantile_disc(response_seconds, 0.5) AS BIGINT) AS q50,
  CAST(quantile_disc(response_seconds, 0.9) AS BIGINT) AS q90,
  CAST(max(response_seconds) AS BIGINT) AS longest"""

RULED = """
ruled AS (
  SELECT l.id, l.label, q.answer_count, q.comment_count, q.view_count,
         coalesce(q.answer_count, 0) - coalesce(q.comment_count, 0) AS score
  FROM labelled l JOIN posts q ON l.id = q.id),
predicted AS (
  SELECT *, CASE WHEN score >= 3 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS prediction FROM ruled)"""

PERMUTED = """
ordered AS (
  SELECT *, row_number() OVER (ORDER BY md5('100:' || id), id) AS takes,
         row_number() OVER (ORDER BY md5('101:' || id), id) AS gives FROM ruled),
pairs AS (
  SELECT a.label, a.answer_count AS a1, a.comment_count AS a2,
         b.answer_count AS b1, b.comment_count AS b2
  FROM ordered a JOIN ordered b ON a.takes = b.gives),
scored AS (
  SELECT feature, label,
         CASE WHEN coalesce(CASE WHEN feature = 'answer_count' THEN b1 ELSE a1 END, 0)
                 - coalesce(CASE WHEN feature = 'comment_count' THEN b2 ELSE a2 END, 0) >= 3
              THEN 0 ELSE 1 END AS prediction
  FROM pairs CROSS JOIN (SELECT unnest([NULL, 'answer_count', 'comment_count', 'view_count'])
                         AS feature)),
accuracies AS (
  SELECT feature, count(*) AS n, count(*) FILTER (prediction = label) AS good
  FROM scored GROUP BY feature)"""

_VALUES = ", ".join(f"{{'feature': '{c}', 'value': CAST({c} AS DOUBLE)}}" for c in FEATURES)
INFORMATION = f"""
rounded AS (SELECT {_ROUNDED}, * EXCLUDE (PR, ASR, TCF, VCF, ACF, latf_h, RSR) FROM all_features),
long AS (
  SELECT label, c.feature AS feature, c.value AS value
  FROM (SELECT label, unnest([{_VALUES}]) AS c FROM rounded) WHERE c.value IS NOT NULL),
binned AS (
  SELECT feature, label, CAST(floor((rank() OVER (PARTITION BY feature ORDER BY value) - 1) * 10
         / (count(*) OVER (PARTITION BY feature))::DOUBLE) AS INTEGER) AS bin FROM long),
joint AS (SELECT feature, bin, label, count(*)::DOUBLE AS n FROM binned GROUP BY ALL),
margins AS (
  SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS total,
         sum(n) OVER (PARTITION BY feature, bin) AS of_bin,
         sum(n) OVER (PARTITION BY feature, label) AS of_label FROM joint)"""

PERIODS = r"""
raw AS (SELECT unnest(regexp_split_to_array(lower(text), '[ \t\r\n\f]+')) AS raw FROM documents),
bare AS (
  SELECT regexp_replace(regexp_replace(raw, '^["''(\[{]+', ''), '[,;:!?"'')\]}]+$', '') AS t
  FROM raw),
kinds AS (
  SELECT CASE WHEN right(t, 1) = '.' THEN t[:-2] ELSE t END AS token, right(t, 1) = '.' AS ended
  FROM bare),
period_counts AS (
  SELECT token, CAST(count(*) FILTER (ended) AS BIGINT) AS with_period,
         CAST(count(*) FILTER (NOT ended) AS BIGINT) AS without_period
  FROM kinds WHERE regexp_matches(token, '\p{L}') GROUP BY token),
chance AS (
  SELECT least(sum(with_period) / sum(with_period + without_period)::DOUBLE, 1 - 1e-9::DOUBLE) AS p
  FROM period_counts),
sized AS (
  SELECT *, length(token) - length(replace(token, '.', '')) AS inner_periods,
         length(replace(token, '.', ''))::DOUBLE AS size
  FROM period_counts, chance WHERE with_period > 0),
period_scores AS (
  SELECT token, with_period, without_period,
         2 * (with_period * ln(0.99::DOUBLE) + without_period * ln(1 - 0.99::DOUBLE)
              - with_period * ln(p) - without_period * ln(1 - p))
         * exp(-size) * (inner_periods + 1) * pow(size, -without_period) AS score
  FROM sized)"""

LEARNED = r"""
pieces AS (
  SELECT doc_id, string_split(regexp_replace(text, '([.!?])[ \t\r\n\f]+', '\1' || chr(1), 'g'),
                              chr(1)) AS parts
  FROM documents),
placed AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS place, unnest(parts) AS piece FROM pieces),
ended AS (
  SELECT *, regexp_replace(regexp_extract(lower(piece), '([^ \t\r\n\f]+)$', 1), '^["''(\[{]+', '')
         AS last, lead(piece) OVER (PARTITION BY doc_id ORDER BY place) AS following
  FROM placed),
judged AS (
  SELECT doc_id, place, piece, last IN (SELECT token || '.' FROM period_scores WHERE score >= 0.3)
         OR regexp_full_match(last, '\p{L}\.')
         OR (regexp_full_match(last, '[0-9]+\.') AND regexp_matches(following, '^[\p{Ll}0-9]'))
         AS goes_on
  FROM ended),
starts AS (
  SELECT *, coalesce(lag(goes_on) OVER (PARTITION BY doc_id ORDER BY place), false) AS joined
  FROM judged),
numbered AS (
  SELECT *, sum(CASE WHEN joined THEN 0 ELSE 1 END)
         OVER (PARTITION BY doc_id ORDER BY place ROWS UNBOUNDED PRECEDING) - 1 AS pos
  FROM starts)"""

_M = "4294967295::UBIGINT"


def _rotated(x: str, n: int) -> str:
    return f"((({x} << {n}) | ({x} >> {32 - n})) & {_M})"


def _times(x: str, c: int) -> str:
    return f"(({x} * {c}::UBIGINT) & {_M})"


def _key(x: str) -> str:
    """What a block of up to four bytes adds to the hash."""
    return _times(_rotated(_times(x, 3432918353), 15), 461845907)


def _murmur(source: str, places: int) -> str:
    """CTEs from ``source`` (column term) to ``hashed`` (term, place): murmur3 of its UTF-8 bytes."""
    step = f"(({_times(_rotated('xor(h, k)', 13), 5)} + 3864292196::UBIGINT) & {_M})"
    tail = "list_sum(list_transform(range(len % 4), lambda i: b[len - len % 4 + i + 1] << (8 * i)))"
    return f"""
hexed AS (SELECT term, hex(encode(term)) AS hx, octet_length(encode(term)) AS len FROM {source}),
byte_lists AS (
  SELECT term, len, list_transform(range(len), lambda i:
         ('0x' || substr(hx, CAST(2 * i + 1 AS INTEGER), 2))::UBIGINT) AS b FROM hexed),
blocks AS (
  SELECT term, len, CAST(coalesce({tail}, 0) AS UBIGINT) AS rest,
         list_transform(list_transform(range(len // 4), lambda i: b[4 * i + 1] + b[4 * i + 2] * 256
           + b[4 * i + 3] * 65536 + b[4 * i + 4] * 16777216), lambda x: {_key('x')}) AS keys
  FROM byte_lists),
bodies AS (
  SELECT term, len, rest,
         list_reduce(list_prepend(42::UBIGINT, keys), lambda h, k: {step}) AS h FROM blocks),
mixed_0 AS (
  SELECT term, xor(CASE WHEN len % 4 > 0 THEN xor(h, {_key('rest')}) ELSE h END,
                   CAST(len AS UBIGINT)) AS h FROM bodies),
mixed_1 AS (SELECT term, {_times('xor(h, h >> 16)', 2246822507)} AS h FROM mixed_0),
mixed_2 AS (SELECT term, {_times('xor(h, h >> 13)', 3266489909)} AS h FROM mixed_1),
hashed AS (SELECT term, CAST(xor(h, h >> 16) & {places - 1} AS INTEGER) AS place FROM mixed_2)"""


def _weights(terms: str, keys: str) -> str:
    """CTEs from ``terms`` (keys, doc_id, term) to ``weights``."""
    return f"""
distinct_terms AS (SELECT DISTINCT term FROM {terms}),{_murmur('distinct_terms', 1 << 18)},
sums AS (SELECT {keys}, place, count(*) AS n FROM {terms} JOIN hashed USING (term) GROUP BY ALL),
spread AS (SELECT place, count(*) AS df FROM sums GROUP BY place),
weights AS (
  SELECT {keys}, place, round(CASE WHEN df >= 5 THEN
           n * ln((SELECT count(*) + 1 FROM counted) / (df + 1)::DOUBLE) ELSE 0 END, 6) AS weight
  FROM sums JOIN spread USING (place))"""


def oracle_sql() -> dict[str, str]:
    times = """SELECT id, creation_date, response_seconds, response_hours FROM times"""
    return {
        "post_tag_features_before": _with(
            POSTS,
            TAGGED,
            EVENTS,
            select="""SELECT id, round(avg(asked), 6) AS asked_before,
                      round(avg(views), 6) AS views_before, round(avg(answered), 6) AS answered_before,
                      round(avg(fast), 6) AS fast_before,
                      round(avg(delay) / 3600.0::DOUBLE, 6) AS delay_hours_before
                      FROM tagged JOIN before ON tagged.tag = before.tag
                        AND tagged.creation_date = before.moment GROUP BY id""",
        ),
        "response_quantiles": _with(
            POSTS,
            TAGGED,
            TIMES,
            TAGGED_TIMES,
            select=f"""SELECT tag, CAST(date_trunc('quarter', creation_date) AS TIMESTAMP) AS period,
                       {_QUANTILES} FROM tagged_times GROUP BY 1, 2""",
        ),
        "overall_quantiles": _with(
            POSTS,
            TIMES,
            select=f"""SELECT CAST(date_trunc('month', creation_date) AS TIMESTAMP) AS period,
                       {_QUANTILES} FROM times GROUP BY 1""",
        ),
        "permutation_importance": _with(
            POSTS,
            TIMES,
            LABELS,
            RULED,
            PERMUTED,
            select="""SELECT feature, round(good / n::DOUBLE, 6) AS accuracy,
                      round(((SELECT good FROM accuracies WHERE feature IS NULL) - good)
                            / n::DOUBLE, 6) AS importance FROM accuracies""",
        ),
        "feature_information": _with(
            *_FEATURE_PARTS,
            INFORMATION,
            select="""SELECT feature, CAST(any_value(total) AS BIGINT) AS n,
                      round(sum(n / total * ln(n * total / (of_bin * of_label))), 6) AS information
                      FROM margins GROUP BY feature""",
        ),
        "rule_auc": _with(
            POSTS,
            TIMES,
            LABELS,
            RULED,
            """
scores AS (
  SELECT score, count(*) FILTER (label = 0) AS pos, count(*) FILTER (label <> 0) AS neg
  FROM ruled GROUP BY score),
pairs AS (
  SELECT a.pos * b.neg * CASE WHEN a.score > b.score THEN 1 WHEN a.score = b.score THEN 0.5::DOUBLE
         ELSE 0 END AS won, a.pos, b.neg FROM scores a CROSS JOIN scores b)""",
            select="""SELECT (SELECT CAST(sum(pos) AS BIGINT) FROM scores) AS positives,
                      (SELECT CAST(sum(neg) AS BIGINT) FROM scores) AS negatives,
                      round(sum(won) / sum(pos * neg)::DOUBLE, 6) AS auc FROM pairs""",
        ),
        "rule_confusion": _with(
            POSTS,
            TIMES,
            LABELS,
            RULED,
            select="""SELECT CAST(label AS DOUBLE) AS label, prediction, count(*) AS n
                      FROM predicted GROUP BY ALL""",
        ),
        "rule_report": _with(
            POSTS,
            TIMES,
            LABELS,
            RULED,
            """
classes AS (SELECT CAST(label AS DOUBLE) AS class FROM predicted
            UNION SELECT prediction FROM predicted),
report AS (
  SELECT class, count(*) FILTER (label = class) AS n,
         count(*) FILTER (prediction = class) AS said,
         count(*) FILTER (prediction = class AND label = class) AS good
  FROM predicted CROSS JOIN classes GROUP BY class)""",
            select="""SELECT class, n, round(good / nullif(said, 0)::DOUBLE, 6) AS precision,
                      round(good / nullif(n, 0)::DOUBLE, 6) AS recall,
                      round(2 * good / nullif(n + said, 0)::DOUBLE, 6) AS f1 FROM report""",
        ),
        "merged_tag_state": _with(*_TAG_PARTS, select=f"SELECT tag, {_ROUNDED} FROM tag_table"),
        "bucketed_response_times": _with(POSTS, TIMES, select=times),
        "bucketed_answer_delays": _with(
            POSTS, TAGGED, DELAYS, select="SELECT tag, id, delay_hours FROM delays"
        ),
        "answers_per_question": _with(
            POSTS,
            select="""SELECT q.id, count(a.id) AS answers,
                      round((CAST(floor(epoch(min(a.creation_date))) AS BIGINT)
                        - CAST(floor(epoch(any_value(q.creation_date))) AS BIGINT))
                        / 3600.0::DOUBLE, 6) AS first_hours
                      FROM posts q LEFT JOIN posts a ON a.parent_id = q.id
                      WHERE q.parent_id IS NULL GROUP BY q.id""",
        ),
        "rolling_trend": _with(
            POSTS,
            TIMES,
            """
days AS (
  SELECT CAST(unnest(generate_series(min(creation_date), max(creation_date), INTERVAL 1 DAY))
         AS TIMESTAMP) AS period FROM (SELECT date_trunc('day', creation_date) AS creation_date FROM times)),
filled AS (
  SELECT period, count(id) AS posts, sum(response_seconds) AS seconds
  FROM days LEFT JOIN times ON date_trunc('day', creation_date) = period GROUP BY period)""",
            select="""SELECT period, posts, CAST(sum(posts) OVER w AS BIGINT) AS rolling_posts,
                      round(CAST(sum(seconds) OVER w AS BIGINT) / nullif(sum(posts) OVER w, 0)::DOUBLE
                            / 3600, 6) AS mean_hours FROM filled
                      WINDOW w AS (ORDER BY period RANGE BETWEEN INTERVAL 6 DAYS PRECEDING
                                   AND CURRENT ROW)""",
        ),
        "rolling_tag_trend": _with(
            POSTS,
            TAGGED,
            TIMES,
            TAGGED_TIMES,
            """
monthly AS (
  SELECT tag, date_trunc('month', creation_date) AS period, count(*) AS posts,
         sum(response_seconds) AS seconds FROM tagged_times GROUP BY 1, 2),
months AS (
  SELECT tag, unnest(generate_series(min(period)::TIMESTAMP, max(period)::TIMESTAMP, INTERVAL 1 MONTH))
         AS period FROM monthly GROUP BY tag),
filled AS (
  SELECT tag, CAST(period AS TIMESTAMP) AS period, coalesce(posts, 0) AS posts, seconds
  FROM months LEFT JOIN monthly USING (tag, period))""",
            select="""SELECT tag, period, posts, CAST(sum(posts) OVER w AS BIGINT) AS rolling_posts,
                      round(CAST(sum(seconds) OVER w AS BIGINT) / nullif(sum(posts) OVER w, 0)::DOUBLE
                            / 3600, 6) AS mean_hours FROM filled
                      WINDOW w AS (PARTITION BY tag ORDER BY period
                                   ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
        ),
        "tfidf_cells": _with(
            TOKENS,
            CLEAN,
            """
terms AS (SELECT doc_id, token AS term FROM clean),
counted AS (SELECT doc_id FROM documents)""",
            _weights("terms", "doc_id"),
            select="SELECT doc_id, place, weight FROM weights",
        ),
        "doc_cells": _with(
            r"""
labelled AS (
  SELECT doc_id, quality AS label, regexp_replace(text, '<[^>]*>', '', 'g') AS text
  FROM documents JOIN labels USING (doc_id)),
split AS (
  SELECT doc_id, label, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
                                    lambda w: w <> '') AS words FROM labelled),
tokens AS (SELECT doc_id, label, unnest(words) AS token FROM split)""",
            CLEAN,
            "\nvocab AS (SELECT DISTINCT token FROM clean)",
            _stems("vocab"),
            """
terms AS (SELECT doc_id, label, stem AS term FROM clean JOIN stems USING (token)),
counted AS (SELECT doc_id FROM labelled)""",
            _weights("terms", "doc_id, label"),
            select="SELECT doc_id, label, place, weight FROM weights",
        ),
        "abbreviations": _with(
            PERIODS,
            select="""SELECT token, with_period, without_period, round(CASE WHEN score > 0 THEN score ELSE 0 END, 6)
                        AS score FROM period_scores""",
        ),
        "learned_sentences": _with(
            PERIODS,
            LEARNED,
            select="""SELECT doc_id, CAST(pos AS INTEGER) AS pos,
                      string_agg(piece, ' ' ORDER BY place) AS sentence
                      FROM numbered GROUP BY doc_id, pos""",
        ),
    }
