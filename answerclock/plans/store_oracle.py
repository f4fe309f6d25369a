"""Reference SQL for ``store_queries``: the tables themselves, as a round trip changes nothing."""

from __future__ import annotations

from answerclock.plans.oracle import (
    _BAYES,
    _FEATURE_LIST,
    _FEATURE_PARTS,
    _ROUNDED,
    _TAG_PARTS,
    DELAYS,
    LABELS,
    POSTS,
    TAGGED,
    TIMES,
    _with,
)

FULL_POSTS = """
full_posts AS (
  SELECT id, post_type_id, parent_id, accepted_answer_id, creation_date, last_activity_date,
         CASE WHEN post_type_id = 1 THEN 'Why "' || id || '" <b> & é?' END AS title,
         '<p>first ' || id || '</p>' || chr(10) || '''second'', <code>a, b</code>' AS body,
         tags, view_count, answer_count, CAST(comment_count AS BIGINT) AS comment_count
  FROM posts)"""


def oracle_sql() -> dict[str, str]:
    whole = _with(POSTS, FULL_POSTS, select="SELECT * FROM full_posts")
    formats = ("posts_json", "posts_xml", "posts_csv", "posts_parquet", "posts_xml_lines")
    return dict.fromkeys(formats, whole) | {
        "posts_by_format": _with(
            POSTS,
            FULL_POSTS,
            select="""SELECT format, id, parent_id, creation_date, tags, title FROM full_posts
                      CROSS JOIN (SELECT unnest(['json', 'xml', 'csv', 'parquet']) AS format)""",
        ),
        "tag_table_csv": _with(
            *_TAG_PARTS, select=f"SELECT tag, {_ROUNDED}, 1 AS files FROM tag_table"
        ),
        "export_csv": _with(
            POSTS,
            select="""SELECT tags, id, CAST(floor(epoch(creation_date)) AS BIGINT) AS time,
                      post_type_id, parent_id FROM posts WHERE year(creation_date) >= 1997""",
        ),
        "delays_csv_appended": _with(
            POSTS, TAGGED, DELAYS, select="SELECT tag, id, delay_hours FROM delays"
        ),
        "labels_csv_overwritten": _with(POSTS, TIMES, LABELS, select="SELECT id, label FROM labelled"),
        "labels_csv_header": _with(
            POSTS,
            TIMES,
            LABELS,
            select="""SELECT header, count(*) + any_value(names) AS lines, any_value(names) AS names
                      FROM labelled CROSS JOIN (VALUES (false, 0::BIGINT), (true, 1::BIGINT))
                        AS kinds(header, names) GROUP BY header""",
        ),
        "response_times_json": _with(
            POSTS, TIMES, select="SELECT creation_date, response_hours FROM times"
        ),
        "vectors_json": _with(
            *_FEATURE_PARTS,
            f"""
rounded AS (SELECT {_ROUNDED}, * EXCLUDE (PR, ASR, TCF, VCF, ACF, latf_h, RSR) FROM all_features)""",
            select=f"""SELECT id, label, CAST(generate_subscripts(f, 1) - 1 AS INTEGER) AS place,
                       unnest(f) AS value FROM (SELECT id, label, [{_FEATURE_LIST}] AS f FROM rounded)""",
        ),
        "stored_model": _with(
            *_FEATURE_PARTS, _BAYES, select="SELECT id, label, prediction FROM predictions"
        ),
    }
