from __future__ import annotations

import gzip

import pytest
from pyspark.ml.linalg import Vectors

from answerclock import schemas
from answerclock.operators import texts
from answerclock.operators.posts import since
from answerclock.sources import readers, writers
from tests.conftest import plan_of, rows

XML = """<?xml version="1.0" encoding="utf-8"?>
<posts>
  <row Id="1" PostTypeId="1" AcceptedAnswerId="2" CreationDate="2018-01-16T12:00:00.000"
    LastActivityDate="2018-01-17T00:00:00.500" Title="Why?" Body="&lt;p&gt;a &lt;code&gt;x&lt;/code&gt;&lt;/p&gt;"
    Tags="&lt;a&gt;&lt;b&gt;" ViewCount="5" AnswerCount="1" CommentCount="0" Score="9" />
  <row Id="2" PostTypeId="2" ParentId="1" CreationDate="2018-01-16T12:30:00.000" Body="b" />
</posts>
"""


@pytest.fixture
def posts(make_posts):
    return make_posts(
        {
            "id": 1,
            "post_type_id": 1,
            "accepted_answer_id": 2,
            "creation_date": "2018-01-16T12:00:00",
            "last_activity_date": "2018-01-17T00:00:00.500000",
            "title": "Why?",
            "body": "<p>a <code>x</code></p>",
            "tags": "<a><b>",
            "view_count": 5,
            "answer_count": 1,
            "comment_count": 0,
        },
        {
            "id": 2,
            "post_type_id": 2,
            "parent_id": 1,
            "creation_date": "2018-01-16T12:30:00",
            "body": "b",
        },
    )


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet", "xml"])
def test_posts_round_trip(spark, posts, tmp_path, fmt):
    path = str(tmp_path / fmt)
    if fmt == "xml":
        with gzip.open(path + ".xml.gz", "wt") as out:
            out.write(XML)
        path += ".xml.gz"
    else:
        writers.write_posts(posts, path, fmt)
    back = readers.read_posts(spark, path, fmt)
    assert [(f.name, f.dataType) for f in back.schema] == [
        (f.name, f.dataType) for f in schemas.POSTS
    ]
    assert rows(back) == rows(posts)


def test_multi_line_bodies_survive(spark, make_posts, tmp_path):
    post = make_posts({"id": 1, "body": 'a\n"b", c\\', "creation_date": "2018-01-01T00:00:00"})
    for fmt in ("json", "csv"):
        writers.write_posts(post, str(tmp_path / fmt), fmt)
        assert readers.read_posts(spark, str(tmp_path / fmt), fmt).first()["body"] == 'a\n"b", c\\'


def test_one_gzip_file_is_dealt_out(spark, tmp_path):
    path = str(tmp_path / "posts.json.gz")
    with gzip.open(path, "wt") as out:
        out.writelines(f'{{"_Id": {i}, "_PostTypeId": 1}}\n' for i in range(1000))
    back = readers.read_posts(spark, path)
    assert back.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert back.select("id").distinct().count() == 1000
    plenty = spark.range(10, numPartitions=50)
    assert readers.spread(plenty) is plenty


def test_packed_files_are_not_dealt_out(spark, make_posts, tmp_path, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(writers, "FILE_POSTS", 2)
    post = {"post_type_id": 1, "creation_date": "2018-01-16T12:00:00", "body": "x"}
    posts = make_posts(*({"id": i, **post} for i in range(3 * cores))).coalesce(1)
    for fmt in ("xml", "json", "csv"):
        path = str(tmp_path / fmt)
        writers.write_posts(posts, path, fmt)
        back = readers.read_posts(spark, path, fmt)
        assert len(back.inputFiles()) == 3 * cores // 2
        assert "Exchange" not in plan_of(back)
        assert cores // 2 < back.rdd.getNumPartitions() < cores
        assert rows(back) == rows(posts)


def test_several_paths(spark, posts, tmp_path):
    for name in ("x", "y"):
        writers.write_posts(posts, str(tmp_path / name))
    assert readers.read_posts(spark, [str(tmp_path / "x"), str(tmp_path / "y")]).count() == 4


def test_time_bound_and_columns_reach_the_scan(spark, posts, tmp_path):
    path = str(tmp_path / "parquet")
    writers.write_posts(posts, path, "parquet")
    recent = since(readers.read_posts(spark, path, "parquet"), "creation_date", "2018-01-16T12:10:00")
    narrow = recent.select("id")
    assert rows(narrow) == [(2,)]
    plan = plan_of(narrow)
    assert "GreaterThanOrEqual(_CreationDate" in plan
    assert "ReadSchema: struct<_Id:bigint,_CreationDate:timestamp_ntz>" in plan


def test_feature_tables_round_trip(spark, tmp_path):
    four = spark.createDataFrame([("a", 3, 10, 8, 2.5), ("b", 1, 0, 0, -1.0)], schemas.FOUR)
    path = str(tmp_path / "four")
    writers.write_csv(four, path, files=1)
    assert len(list((tmp_path / "four").glob("part-*"))) == 1
    assert rows(readers.read_features(spark, path, schemas.FOUR)) == rows(four)
    typed = readers.read_positional(
        spark, path, ["tags_four", "TCF", "VCF", "ACF", "latf_h"], ["string"] + ["long"] * 3 + ["double"]
    )
    assert rows(typed) == rows(four) and typed.columns[0] == "tags_four"
    flags = spark.createDataFrame([(1, 2, 15, 0, 39, 4, True, True, False)], schemas.TEXT_TABLE)
    writers.write_csv(flags, str(tmp_path / "ntb"))
    assert rows(readers.read_features(spark, str(tmp_path / "ntb"), schemas.TEXT_TABLE)) == rows(flags)


def test_csv_modes_and_header(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "tag string, n long")
    path = str(tmp_path / "out")
    writers.write_csv(df, path)
    writers.write_csv(df, path)
    assert spark.read.csv(path).count() == 1
    writers.write_csv(df, path, mode="append")
    assert spark.read.csv(path).count() == 2
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_csv(df, path, mode="error")
    writers.write_csv(df, path, header=True)
    assert spark.read.csv(path, header=True).columns == ["tag", "n"]


def test_vectors_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 0, Vectors.sparse(9, [2, 5], [1.0, 2.5])), (2, 1, Vectors.dense([0.5, 1.0]))],
        schemas.VECTORS,
    )
    path = str(tmp_path / "vectors")
    writers.write_json(df, path)
    assert list((tmp_path / "vectors").glob("*.json.gz"))
    assert rows(readers.read_vectors(spark, path)) == rows(df)
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"])], "id long, tokens array<string>")
    hashed = texts.tfidf_vectors(docs, min_df=1).selectExpr("id", "0 label", "features")
    writers.write_json(hashed, path)
    assert rows(readers.read_vectors(spark, path)) == rows(hashed)


def test_response_times_as_json(spark, tmp_path):
    df = spark.sql("SELECT timestamp_ntz'2018-01-16 12:00:00' creation_date, 0.5D response_hours")
    path = str(tmp_path / "times")
    writers.write_json(df, path)
    assert rows(readers.read_json(spark, path, schemas.RESPONSE_TIMES)) == rows(df)


@pytest.mark.parametrize("fmt", ["lines", "xml", "csv", "json"])
def test_text_files_are_compressed_and_bounded(spark, make_posts, tmp_path, monkeypatch, fmt):
    monkeypatch.setattr(writers, "FILE_POSTS", 10, raising=False)
    post = {"creation_date": "2018-01-16T12:00:00", "title": "Why?", "body": "x" + " a\nb" * 50}
    posts = make_posts(*({"id": i, **post} for i in range(25))).coalesce(1)
    path = tmp_path / fmt
    if fmt == "lines":
        writers.write_post_lines(posts, str(path))
        back = readers.read_post_lines(spark, str(path))
    else:
        writers.write_posts(posts, str(path), fmt)
        back = readers.read_posts(spark, str(path), fmt)
    files = list(path.glob("part-*.gz"))
    assert len(files) == 3
    assert sum(f.stat().st_size for f in files) < 25 * 200
    assert rows(back) == rows(posts)


def test_plain_files_if_asked_for(spark, posts, tmp_path):
    writers.write_posts(posts, str(tmp_path / "xml"), "xml", compression="none")
    writers.write_post_lines(posts, str(tmp_path / "lines"), compression="none")
    assert all(b"Why?" in b"".join(f.read_bytes() for f in (tmp_path / d).glob("part-*")) for d in ("xml", "lines"))


def test_posts_by_format_makes_the_posts_once(spark, posts, monkeypatch):
    from pyspark.sql import functions as F

    from answerclock.plans import store_queries

    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(key):
        made.add(1)
        return key

    counting = posts.withColumn("id", counted.asNondeterministic()("id"))
    monkeypatch.setattr(store_queries, "full_posts", lambda spark, sf_dir: counting)
    found = store_queries.posts_by_format(spark, "unused")
    assert sorted((r.format, r.id) for r in found.collect()) == [
        (fmt, key) for fmt in ("csv", "json", "parquet", "xml") for key in (1, 2)
    ]
    assert made.value == 2
