"""Reference SQL for the registered queries, written for DuckDB.

Written apart from the Spark code on purpose: the two must agree on results.
"""

from __future__ import annotations

from answerclock.functions.words import ENGLISH_STOP_WORDS
from answerclock.functions.porter import PLURALS, STEP_2, STEP_3, STEP_4

POSTS = """
lines AS (
  SELECT l_orderkey, l_linenumber, l_shipdate,
         4000000000000000000 + l_orderkey * 4194304
           + (l_partkey * 1009 + l_suppkey * 31 + l_linenumber) % 4194304 AS answer_id
  FROM lineitem),
replies AS (
  SELECT l_orderkey, min(answer_id) AS accepted, max(l_shipdate) AS last_reply, count(*) AS n
  FROM lines GROUP BY l_orderkey),
posts AS NOT MATERIALIZED (
  SELECT o_orderkey AS id, 1 AS post_type_id, CAST(NULL AS BIGINT) AS parent_id,
         accepted AS accepted_answer_id, o_orderdate AS creation_date,
         greatest(o_orderdate, coalesce(last_reply, o_orderdate)) AS last_activity_date,
         CASE WHEN o_orderkey % 50 <> 0 THEN
           '<' || lower(c_mktsegment) || '><' || lower(replace(o_orderpriority, ' ', '-'))
           || '><' || lower(o_orderstatus) || '>' END AS tags,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS view_count,
         n AS answer_count,
         CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 5 END AS comment_count
  FROM orders JOIN customer ON o_custkey = c_custkey
       LEFT JOIN replies ON o_orderkey = l_orderkey
  UNION ALL
  SELECT answer_id, 2, l_orderkey, NULL, l_shipdate, l_shipdate, NULL, NULL, NULL,
         l_linenumber % 3
  FROM lines)"""

TAGGED = """
tagged AS (
  SELECT posts.*, unnest(string_split(substr(tags, 2, length(tags) - 2), '><')) AS tag
  FROM posts WHERE tags IS NOT NULL)"""

DELAYS = """
delays AS (
  SELECT q.tag, q.id,
         (CAST(floor(epoch(a.creation_date)) AS BIGINT)
          - CAST(floor(epoch(q.creation_date)) AS BIGINT)) / 3600.0::DOUBLE AS delay_hours
  FROM tagged q JOIN posts a ON a.parent_id = q.id
  WHERE q.parent_id IS NULL AND year(q.creation_date) >= 1997 AND year(a.creation_date) >= 1997)"""

ASR_PR = """
asr_pr AS (
  SELECT tag, count(*) / 14000000.0::DOUBLE AS PR,
         sum(coalesce(answer_count + comment_count, 0)) / 14000000.0::DOUBLE AS ASR
  FROM tagged WHERE year(creation_date) >= 1996 GROUP BY tag)"""

FOUR = """
four AS (
  SELECT tag, count(*) AS TCF, CAST(sum(coalesce(view_count, 0)) AS BIGINT) AS VCF,
         CAST(sum(coalesce(answer_count, 0)) AS BIGINT) AS ACF,
         CAST(sum(CAST(floor(epoch(last_activity_date)) AS BIGINT)
                  - CAST(floor(epoch(creation_date)) AS BIGINT)) AS BIGINT)
           / 3600.0::DOUBLE AS latf_h
  FROM tagged GROUP BY tag)"""

RSR = """
rsr AS (SELECT tag, count(*) AS RSR FROM delays WHERE delay_hours < 720 GROUP BY tag)"""

TAG_TABLE = """
tag_table AS (
  SELECT tag, PR, ASR, TCF, VCF, ACF, latf_h, RSR
  FROM asr_pr JOIN four USING (tag) JOIN rsr USING (tag))"""

POST_TAGS = """
post_tags AS (
  SELECT id, avg(PR) AS PR, avg(ASR) AS ASR, avg(TCF) AS TCF, avg(VCF) AS VCF, avg(ACF) AS ACF,
         avg(latf_h) AS latf_h, avg(RSR) AS RSR
  FROM tagged JOIN tag_table USING (tag) GROUP BY id)"""

TIMES = """
times AS (
  SELECT id, creation_date, response_seconds, response_seconds / 3600.0::DOUBLE AS response_hours,
         answer_count
  FROM (SELECT q.id, q.creation_date, q.answer_count,
               CAST(floor(epoch(a.creation_date)) AS BIGINT)
               - CAST(floor(epoch(q.creation_date)) AS BIGINT) AS response_seconds
        FROM posts q JOIN posts a ON q.accepted_answer_id = a.id)
  WHERE response_seconds >= 0)"""

LABELS = """
labelled AS (
  SELECT *, CASE WHEN response_hours < 720 THEN 0 ELSE 1 END AS label FROM times)"""

TEXT_TABLE = """
post_texts AS (
  SELECT o_orderkey AS id, o_orderdate AS creation_date,
         regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, html AS body
  FROM orders JOIN pages ON o_orderkey = page_id),
text_table AS (
  SELECT id,
         CAST(len(string_split(body, '<script')) - 1 AS INTEGER) AS num_code_snippet,
         CAST(coalesce(list_sum(list_transform(string_split(body, '<script')[2:],
              lambda part: length(string_split(part, '</script>')[1]))), 0) AS INTEGER) AS code_len,
         CAST(len(string_split(body, '<p')) - 1 AS INTEGER) AS num_image,
         CAST(length(body) AS INTEGER) AS body_len,
         CAST(length(title) AS INTEGER) AS title_len,
         right(title, 1) = '.' AS end_que_mark,
         lower(left(title, 2)) = 'wh' AS begin_que_word,
         isodow(creation_date) IN (6, 7) AS is_weekend
  FROM post_texts)"""

ALL_FEATURES = """
all_features AS (
  SELECT post_tags.*, text_table.* EXCLUDE (id), label
  FROM post_tags JOIN text_table USING (id) JOIN labelled USING (id))"""

TOKENS = r"""
split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
                             lambda w: w <> '') AS words
  FROM documents),
tokens AS (
  SELECT doc_id, CAST(generate_subscripts(words, 1) - 1 AS INTEGER) AS pos, unnest(words) AS token
  FROM split)"""

_STOP = ", ".join("'" + word.replace("'", "''") + "'" for word in sorted(ENGLISH_STOP_WORDS))

CLEAN = f"""
clean AS (SELECT * FROM tokens WHERE token NOT IN ({_STOP}))"""

COUNTS = """
counts AS (
  SELECT doc_id, token AS term, CAST(count(*) AS INTEGER) AS n FROM clean GROUP BY doc_id, token),
frequencies AS (
  SELECT term, count(*) AS doc_freq, CAST(sum(n) AS BIGINT) AS term_freq
  FROM counts GROUP BY term)"""

_RATIOS = "round(PR, 12) AS PR, round(ASR, 12) AS ASR"
_MEANS = ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in ["TCF", "VCF", "ACF", "latf_h"])
_ROUNDED = f"{_RATIOS}, {_MEANS}, round(CAST(RSR AS DOUBLE), 6) AS RSR"


# --- stemming: one common table expression per step of the published rules ---


def _shape(word: str) -> str:
    return (
        f"list_reduce(list_prepend('', string_split({word}, '')), lambda acc, ch: acc || "
        "CASE WHEN ch IN ('a', 'e', 'i', 'o', 'u') OR (ch = 'y' AND right(acc, 1) = 'c') "
        "THEN 'v' ELSE 'c' END)"
    )


def _measure(shape: str) -> str:
    return f"((length({shape}) - length(replace({shape}, 'vc', ''))) // 2)"


def _cut(n: int, column: str = "w") -> str:
    return f"substr({column}, 1, length(w) - {n})"


def _rules(rules: dict[str, str], least: int, extra: dict[str, str] | None = None) -> str:
    cases = []
    for suffix in sorted(rules, key=len, reverse=True):
        n = len(suffix)
        test = f"{_measure(_cut(n, 'sh'))} >= {least}" + (extra or {}).get(suffix, "")
        cases.append(
            f"WHEN ends_with(w, '{suffix}') THEN "
            f"CASE WHEN {test} THEN {_cut(n)} || '{rules[suffix]}' ELSE w END"
        )
    return "CASE " + " ".join(cases) + " ELSE w END"


_DOUBLE = "(length(w) > 1 AND right(w, 1) = substr(w, -2, 1) AND right(sh, 1) = 'c')"
_CVC = "(right(sh, 3) = 'cvc' AND right(w, 1) NOT IN ('w', 'x', 'y'))"


def _stems(source: str) -> str:
    """CTEs from ``source`` (column token) to ``stems`` (token, stem)."""
    steps = [
        _rules(PLURALS, 0),
        f"""CASE WHEN ends_with(w, 'eed')
                 THEN CASE WHEN {_measure(_cut(3, 'sh'))} > 0 THEN {_cut(1)} ELSE w END
                 WHEN ends_with(w, 'ed') AND contains({_cut(2, 'sh')}, 'v') THEN {_cut(2)} || '|'
                 WHEN ends_with(w, 'ing') AND contains({_cut(3, 'sh')}, 'v') THEN {_cut(3)} || '|'
                 ELSE w END""",
    ]
    after_cut = f"""CASE WHEN NOT cut THEN w
             WHEN ends_with(w, 'at') OR ends_with(w, 'bl') OR ends_with(w, 'iz') THEN w || 'e'
             WHEN {_DOUBLE} AND right(w, 1) NOT IN ('l', 's', 'z') THEN {_cut(1)}
             WHEN {_measure('sh')} = 1 AND {_CVC} THEN w || 'e'
             ELSE w END"""
    ending_y = f"""CASE WHEN ends_with(w, 'y') AND contains({_cut(1, 'sh')}, 'v')
             THEN {_cut(1)} || 'i' ELSE w END"""
    ion = " AND substr(w, length(w) - 3, 1) IN ('s', 't')"
    later = [
        after_cut,
        ending_y,
        _rules(STEP_2, 1),
        _rules(STEP_3, 1),
        _rules(dict.fromkeys(STEP_4, ""), 2, {"ion": ion}),
    ]
    kept, kept_shape = _cut(1), _cut(1, "sh")
    kept_cvc = f"(right({kept_shape}, 3) = 'cvc' AND right({kept}, 1) NOT IN ('w', 'x', 'y'))"
    later.append(
        f"""CASE WHEN ends_with(w, 'e') AND ({_measure(kept_shape)} > 1
                  OR ({_measure(kept_shape)} = 1 AND NOT {kept_cvc})) THEN {kept} ELSE w END"""
    )
    later.append(f"CASE WHEN ends_with(w, 'll') AND {_measure('sh')} > 1 THEN {_cut(1)} ELSE w END")

    parts = [
        f"p0 AS (SELECT token, token AS w, {_shape('token')} AS sh FROM {source} "
        "WHERE length(token) > 2)"
    ]
    n = 0
    for step in steps:
        parts.append(
            f"q{n} AS (SELECT token, {step} AS w FROM p{n}), "
            f"p{n + 1} AS (SELECT token, rtrim(w, '|') AS w, ends_with(w, '|') AS cut, "
            f"{_shape("rtrim(w, '|')")} AS sh FROM q{n})"
        )
        n += 1
    for step in later:
        parts.append(
            f"q{n} AS (SELECT token, {step} AS w FROM p{n}), "
            f"p{n + 1} AS (SELECT token, w, {_shape('w')} AS sh FROM q{n})"
        )
        n += 1
    parts.append(
        f"stems AS (SELECT token, w AS stem FROM p{n} UNION ALL "
        f"SELECT token, token FROM {source} WHERE length(token) < 3)"
    )
    return ",\n".join(parts)


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


_TAG_PARTS = (POSTS, TAGGED, DELAYS, ASR_PR, FOUR, RSR, TAG_TABLE)
_FEATURE_PARTS = (*_TAG_PARTS, POST_TAGS, TIMES, LABELS, TEXT_TABLE, ALL_FEATURES)

_TEXT_COLUMNS = (
    "num_code_snippet, code_len, num_image, body_len, title_len, "
    "end_que_mark, begin_que_word, is_weekend"
)
_FEATURE_LIST = ", ".join(
    f"CAST({c} AS DOUBLE)"
    for c in ["PR", "ASR", "TCF", "VCF", "ACF", "latf_h", "RSR", *_TEXT_COLUMNS.split(", ")]
)
_SHARE = "(('0x' || substr(md5('100:' || id), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
_BAYES = f"""
cells AS (
  SELECT id, label, is_train, generate_subscripts(f, 1) AS place, unnest(f) AS value
  FROM (SELECT id, label, {_SHARE} < 0.8 AS is_train, [{_FEATURE_LIST}] AS f FROM all_features)),
prior AS (
  SELECT label AS class, ln(count(DISTINCT id) + 1.0::DOUBLE)
         - ln((SELECT count(DISTINCT id) + count(DISTINCT label) FROM cells WHERE is_train)
              ::DOUBLE) AS pi
  FROM cells WHERE is_train GROUP BY label),
theta AS (
  SELECT label AS class, place, ln(sum(value) + 1) - ln(sum(sum(value)) OVER (PARTITION BY label)
         + 15) AS theta
  FROM cells WHERE is_train GROUP BY label, place),
scores AS (
  SELECT id, label, class, pi + sum(value * theta) AS score
  FROM cells JOIN theta USING (place) JOIN prior USING (class)
  WHERE NOT is_train GROUP BY id, label, class, pi),
predictions AS (
  SELECT id, label, CAST(arg_max(class, score) AS DOUBLE) AS prediction
  FROM scores GROUP BY id, label)"""
_TEXT_SHARE = _SHARE.replace("|| id", "|| doc_id")
_TEXT_BAYES = f"""
rated AS (SELECT doc_id, quality AS label, {_TEXT_SHARE} < 0.8 AS is_train FROM labels
          WHERE doc_id IN (SELECT doc_id FROM documents)),
counts AS (
  SELECT doc_id, token AS term, count(*) AS n FROM clean JOIN rated USING (doc_id) GROUP BY ALL),
vocabulary AS (SELECT term FROM counts GROUP BY term HAVING count(*) >= 2),
cells AS (SELECT * FROM counts JOIN vocabulary USING (term) JOIN rated USING (doc_id)),
prior AS (
  SELECT label AS class, ln(count(*) + 1.0::DOUBLE)
         - ln((SELECT count(*) + count(DISTINCT label) FROM rated WHERE is_train)::DOUBLE) AS pi
  FROM rated WHERE is_train GROUP BY label),
held AS (SELECT label AS class, sum(n) AS held FROM cells WHERE is_train GROUP BY label),
theta AS (
  SELECT class, term, ln(coalesce(sum(n) FILTER (WHERE label = class AND is_train), 0) + 1.0::DOUBLE)
         - ln(any_value(held) + (SELECT count(*) FROM vocabulary)::DOUBLE) AS theta
  FROM cells, held GROUP BY class, term),
scores AS (
  SELECT r.doc_id, r.label, p.class, pi + coalesce(s, 0) AS score
  FROM rated r CROSS JOIN prior p
  LEFT JOIN (SELECT doc_id, class, sum(n * theta) AS s FROM cells JOIN theta USING (term)
             GROUP BY doc_id, class) t ON t.doc_id = r.doc_id AND t.class = p.class
  WHERE NOT is_train),
predictions AS (
  SELECT doc_id, label, CAST(arg_max(class, score) AS DOUBLE) AS prediction
  FROM scores GROUP BY doc_id, label)"""
_HISTOGRAM = """
bounds AS (
  SELECT min(value) - CASE WHEN min(value) = max(value) THEN 0.5::DOUBLE ELSE 0 END AS low,
         max(value) + CASE WHEN min(value) = max(value) THEN 0.5::DOUBLE ELSE 0 END AS high
  FROM kept),
filled AS (
  SELECT least(CAST(floor((value - low) / (high - low) * 100) AS INTEGER), 99) AS bin,
         count(*) AS n
  FROM kept, bounds GROUP BY 1)"""
_HISTOGRAM_SELECT = """
SELECT CAST(i AS INTEGER) AS bin, low + i * ((high - low) / 100) AS bin_start,
       low + (i + 1) * ((high - low) / 100) AS bin_end, coalesce(n, 0) AS n
FROM range(100) AS r(i) CROSS JOIN bounds LEFT JOIN filled ON i = bin"""


def oracle_sql() -> dict[str, str]:
    return {
        "post_projection": _with(
            POSTS,
            select="""SELECT tags, id, CAST(floor(epoch(creation_date)) AS BIGINT) AS time,
                      post_type_id, parent_id FROM posts WHERE year(creation_date) >= 1997""",
        ),
        "posts_since": _with(
            POSTS,
            select="""SELECT id, creation_date FROM posts
                      WHERE creation_date >= TIMESTAMP '1998-01-16 12:00:00'""",
        ),
        "posts_between_years": _with(
            POSTS,
            select="""SELECT id, creation_date FROM posts
                      WHERE year(creation_date) BETWEEN 1996 AND 1998""",
        ),
        "questions": _with(
            POSTS, select="SELECT id, tags, creation_date FROM posts WHERE post_type_id = 1"
        ),
        "answers": _with(
            POSTS,
            select="SELECT id, parent_id, creation_date FROM posts WHERE parent_id IS NOT NULL",
        ),
        "latest_posts": _with(
            POSTS,
            select="""SELECT id, post_type_id, creation_date FROM posts
                      ORDER BY creation_date DESC, id LIMIT 10""",
        ),
        "explode_tags": _with(POSTS, TAGGED, select="SELECT tag, id FROM tagged"),
        "tag_asr_pr": _with(POSTS, TAGGED, ASR_PR, select=f"SELECT tag, {_RATIOS} FROM asr_pr"),
        "tag_four": _with(
            POSTS,
            TAGGED,
            FOUR,
            select="SELECT tag, TCF, VCF, ACF, round(latf_h, 6) AS latf_h FROM four",
        ),
        "answer_delays": _with(
            POSTS, TAGGED, DELAYS, select="SELECT tag, id, delay_hours FROM delays"
        ),
        "tag_rsr": _with(POSTS, TAGGED, DELAYS, RSR, select="SELECT tag, RSR FROM rsr"),
        "merged_tag_tables": _with(*_TAG_PARTS, select=f"SELECT tag, {_ROUNDED} FROM tag_table"),
        "tag_features": _with(*_TAG_PARTS, select=f"SELECT tag, {_ROUNDED} FROM tag_table"),
        "tag_features_scaled": _with(
            *_TAG_PARTS,
            select=f"""SELECT tag, round(PR * 1000 / 14000000.0::DOUBLE, 15) AS PR,
                       round(ASR * 1000 / 14000000.0::DOUBLE, 15) AS ASR, {_MEANS},
                       round(RSR / 14000000.0::DOUBLE, 15) AS rsr_ratio FROM tag_table""",
        ),
        "post_tag_features": _with(
            *_TAG_PARTS, POST_TAGS, select=f"SELECT id, {_ROUNDED} FROM post_tags"
        ),
        "tags_in_use": _with(
            *_TAG_PARTS,
            select=f"""SELECT tag, {_ROUNDED} FROM (
                         SELECT tag, avg(PR) AS PR, avg(ASR) AS ASR, avg(TCF) AS TCF,
                                avg(VCF) AS VCF, avg(ACF) AS ACF, avg(latf_h) AS latf_h,
                                avg(RSR) AS RSR
                         FROM tag_table JOIN (SELECT tag FROM tagged
                              WHERE year(creation_date) BETWEEN 1996 AND 1998) USING (tag)
                         GROUP BY tag)""",
        ),
        "response_times": _with(
            POSTS,
            TIMES,
            select="SELECT id, creation_date, response_seconds, response_hours FROM times",
        ),
        "response_labels": _with(
            POSTS, TIMES, LABELS, select="SELECT id, response_hours, label FROM labelled"
        ),
        "answered_count": _with(POSTS, TIMES, select="SELECT count(*) AS answered FROM times"),
        "response_histogram": _with(
            POSTS,
            TIMES,
            """
kept AS (
  SELECT response_hours AS value FROM times
  WHERE creation_date >= TIMESTAMP '1998-01-16 12:00:00' AND response_hours <= 8760)""",
            _HISTOGRAM,
            select=_HISTOGRAM_SELECT,
        ),
        "value_histogram": _with(
            " kept AS (SELECT value FROM events WHERE value IS NOT NULL AND NOT isnan(value))",
            _HISTOGRAM,
            select=_HISTOGRAM_SELECT,
        ),
        "response_buckets": _with(
            POSTS,
            TIMES,
            """
edges(bucket, from_hours, to_hours) AS (
  VALUES (0, 0.0::DOUBLE, 168.0::DOUBLE), (1, 168, 720), (2, 720, 4380), (3, 4380, NULL))""",
            select="""SELECT bucket, from_hours, to_hours, count(*) AS posts,
                      round(CAST(sum(response_seconds) AS BIGINT) / count(*) / 3600.0::DOUBLE, 6)
                        AS mean_hours
                      FROM times JOIN edges ON response_hours >= from_hours
                        AND (to_hours IS NULL OR response_hours < to_hours)
                      GROUP BY bucket, from_hours, to_hours""",
        ),
        "response_trend": _with(
            POSTS,
            TIMES,
            select="""SELECT CAST(date_trunc('month', creation_date) AS TIMESTAMP) AS period,
                      count(*) AS posts,
                      round(CAST(sum(response_seconds) AS BIGINT) / count(*) / 3600.0::DOUBLE, 6)
                        AS mean_hours
                      FROM times GROUP BY 1""",
        ),
        "text_features": _with(
            TEXT_TABLE, select=f"SELECT id, {_TEXT_COLUMNS} FROM text_table"
        ),
        "page_markers": """
SELECT page_id, CAST(len(string_split(html, '<script')) - 1 AS INTEGER) AS scripts,
       CAST(coalesce(list_sum(list_transform(string_split(html, '<script')[2:],
            lambda part: length(string_split(part, '</script>')[1]))), 0) AS INTEGER) AS script_len,
       CAST(coalesce(list_sum(list_transform(string_split(html, '<p')[2:],
            lambda part: length(string_split(part, '</p>')[1]))), 0) AS INTEGER) AS paragraph_len,
       CAST(len(string_split(html, '<p')) - 1 AS INTEGER) AS paragraphs,
       right(url, 1) = 'x' AS ends, lower(left(url, 4)) = 'http' AS begins
FROM pages""",
        "is_weekend": "SELECT event_id, isodow(ts) IN (6, 7) AS is_weekend FROM events",
        "strip_html": """
SELECT page_id, regexp_replace(html, '<[^>]*>', '', 'g') AS plain FROM pages""",
        "strip_code": r"""
SELECT page_id, replace(regexp_replace(regexp_replace(html, '<(/?)script', '<\1code', 'g'),
                                       '(?s)<code.*?</code>', '', 'g'), chr(10), '') AS plain
FROM pages""",
        "sentences": r"""
WITH split AS (
  SELECT doc_id, string_split(regexp_replace(text, '([.!?])[ \t\r\n\f]+', '\1' || chr(1), 'g'),
                              chr(1)) AS parts
  FROM documents)
SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS pos,
       unnest(parts) AS sentence FROM split""",
        "tokens": _with(TOKENS, select="SELECT doc_id, pos, token FROM tokens"),
        "clean_tokens": _with(TOKENS, CLEAN, select="SELECT doc_id, pos, token FROM clean"),
        "stem_vocab": _with(
            TOKENS,
            CLEAN,
            "\nterms AS (SELECT DISTINCT token FROM clean)",
            _stems("terms"),
            select="SELECT token, stem FROM stems",
        ),
        "token_arrays": _with(
            TOKENS,
            CLEAN,
            select="""SELECT documents.doc_id, CAST(count(token) AS INTEGER) AS n_tokens,
                      coalesce(string_agg(token, ' ' ORDER BY pos), '') AS tokens
                      FROM documents LEFT JOIN clean USING (doc_id) GROUP BY documents.doc_id""",
        ),
        "stem_arrays": _with(
            TOKENS,
            CLEAN,
            "\nterms AS (SELECT DISTINCT token FROM clean)",
            _stems("terms"),
            select="""SELECT documents.doc_id,
                      coalesce(string_agg(stem, ' ' ORDER BY pos), '') AS stems
                      FROM documents LEFT JOIN (clean JOIN stems USING (token)) USING (doc_id)
                      GROUP BY documents.doc_id""",
        ),
        "vocabulary": _with(
            TOKENS,
            CLEAN,
            COUNTS,
            select="SELECT term, doc_freq, term_freq FROM frequencies WHERE doc_freq >= 2",
        ),
        "tfidf": _with(
            TOKENS,
            CLEAN,
            COUNTS,
            select="""SELECT doc_id, term, n, doc_freq, round(CASE WHEN doc_freq >= 5 THEN
                        n * ln(((SELECT count(*) FROM documents) + 1) / (doc_freq + 1)::DOUBLE)
                        ELSE 0 END, 6) AS weight
                      FROM counts JOIN frequencies USING (term)""",
        ),
        "count_vectors": _with(
            TOKENS,
            CLEAN,
            COUNTS,
            select="""SELECT doc_id, term, n FROM counts JOIN frequencies USING (term)
                      WHERE doc_freq >= 2""",
        ),
        "all_features": _with(
            *_FEATURE_PARTS,
            select=f"SELECT {_ROUNDED}, {_TEXT_COLUMNS}, id, label FROM all_features",
        ),
        "random_split": _with(
            POSTS, TIMES, LABELS, select="SELECT id, label, CAST(1 AS BIGINT) AS parts FROM labelled"
        ),
        "predict_text_nb": _with(
            TOKENS,
            CLEAN,
            _TEXT_BAYES,
            select="SELECT doc_id, label, prediction FROM predictions",
        ),
        "hash_split": _with(
            POSTS,
            TIMES,
            LABELS,
            select=f"SELECT id, label, {_SHARE} < 0.8 AS is_train FROM labelled",
        ),
        "assembled": _with(
            *_FEATURE_PARTS,
            f"""
cells AS (
  SELECT id, generate_subscripts(f, 1) - 1 AS place, unnest(f) AS value
  FROM (SELECT id, [{_FEATURE_LIST}] AS f FROM all_features))""",
            select="""SELECT id, CAST(place AS INTEGER) AS place,
                      round(value, CASE WHEN place < 2 THEN 12 ELSE 6 END) AS value FROM cells""",
        ),
        "predict_nb": _with(
            *_FEATURE_PARTS, _BAYES, select="SELECT id, label, prediction FROM predictions"
        ),
        "train_and_score_nb": _with(
            *_FEATURE_PARTS,
            _BAYES,
            select="""SELECT count(*) AS scored,
                      CAST(count(*) FILTER (prediction = label) AS BIGINT) AS right,
                      CASE WHEN count(*) > 0 THEN
                        count(*) FILTER (prediction = label) / count(*)::DOUBLE END AS accuracy,
                      'nb' AS model FROM predictions""",
        ),
        "accuracy": _with(
            POSTS,
            TIMES,
            LABELS,
            select="""SELECT count(*) AS scored, CAST(sum(ok) AS BIGINT) AS right,
                      CAST(sum(ok) AS BIGINT) / count(*)::DOUBLE AS accuracy
                      FROM (SELECT CASE WHEN label = CASE WHEN answer_count >= 4 THEN 0 ELSE 1 END
                            THEN 1 ELSE 0 END AS ok FROM labelled)""",
        ),
    }
