from __future__ import annotations

from pyspark.ml.linalg import SparseVector

from answerclock.operators import post_store, response, sentences, tags, texts
from answerclock.sources import readers, writers
from tests.conftest import plan_of, rows


def _some_posts(make_posts):
    q = {"post_type_id": 1, "tags": "<a><b>"}
    a = {"post_type_id": 2}
    return make_posts(
        q | {"id": 1, "accepted_answer_id": 11, "creation_date": "2020-01-01T00:00:00"},
        q | {"id": 2, "accepted_answer_id": 11, "creation_date": "2020-01-01T00:00:00"},
        q | {"id": 3, "tags": None, "creation_date": "2020-01-01T00:00:00"},
        a | {"id": 11, "parent_id": 1, "creation_date": "2020-01-01T02:00:00"},
        a | {"id": 12, "parent_id": 1, "creation_date": "2020-01-01T01:00:00"},
        a | {"id": 13, "parent_id": 99, "creation_date": "2020-01-01T01:00:00"},
    )


def test_store_gives_the_same_without_a_shuffle(make_posts, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    posts = _some_posts(make_posts)
    store = post_store.store_posts(posts, 4)
    times = post_store.stored_response_times(store)
    assert rows(times) == [r for r in rows(response.response_times(posts)) if r[0] != 2]
    delays = post_store.stored_answer_delays(store)
    assert rows(delays) == rows(tags.answer_delays(posts))
    counts = post_store.answers_per_question(store)
    assert rows(counts) == [(1, 2, 1.0), (2, 0, None), (3, 0, None)]
    for df in (times, delays, counts):
        assert "Exchange" not in plan_of(df)


def test_store_of_no_posts(make_posts):
    store = post_store.store_posts(make_posts())
    assert post_store.stored_response_times(store).count() == 0


def test_lines_of_a_dump(spark, make_posts, tmp_path):
    body = "line one\nline two\r\n<p a=\"b\">&amp; 'é'</p>"
    posts = make_posts(
        {"id": 1, "post_type_id": 1, "title": 'say "x" <y>', "body": body, "tags": "<a>", "creation_date": "2020-01-01T00:00:00.123"},
        {"id": 2, "post_type_id": 2, "parent_id": 1, "creation_date": "2020-01-02T00:00:00"},
    )
    path = str(tmp_path / "lines")
    writers.write_post_lines(posts, path)
    assert spark.read.text(path).count() == 2
    assert rows(readers.read_post_lines(spark, path)) == rows(posts)


def test_lines_of_other_kinds_and_broken_ones(spark, tmp_path):
    lines = ['<?xml version="1.0"?>', "<posts>", '  <row Id="5" Body="a&#xA;b" Title="t" />', '<row Id="6" Body="broken', "</posts>", "", '<rowdy Id="7"/>']
    (tmp_path / "dump.xml").write_text("\n".join(lines))
    got = readers.read_post_lines(spark, str(tmp_path / "dump.xml"), corrupt_column="broken").select("id", "body", "broken")
    assert rows(got) == sorted([(5, "a\nb", None), (None, None, '<row Id="6" Body="broken')], key=repr)


def test_a_splittable_dump_is_several_tasks(spark, tmp_path, settings):
    settings(spark__sql__files__maxPartitionBytes="2000")
    (tmp_path / "dump.xml").write_text("\n".join(f'<row Id="{i}" Title="title {i}"/>' for i in range(500)))
    read = readers.read_post_lines(spark, str(tmp_path / "dump.xml"))
    assert read.rdd.getNumPartitions() > 4 and read.count() == 500


def test_posts_as_xml_and_back(spark, make_posts, tmp_path):
    posts = _some_posts(make_posts)
    writers.write_posts(posts, str(tmp_path / "xml"), "xml")
    assert rows(readers.read_posts(spark, str(tmp_path / "xml"), "xml")) == rows(posts)


def test_vectors_are_built_without_python(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, [])], "id long, tokens array<string>")
    vectors, places = texts.count_vectors(docs, "id", min_df=2)
    assert "Python" not in plan_of(vectors) and "ArrowEval" not in plan_of(vectors)
    got = {r.id: r.features for r in vectors.collect()}
    assert got == {1: SparseVector(1, {0: 1.0}), 2: SparseVector(1, {0: 1.0}), 3: SparseVector(1, {})}
    assert [r.term for r in places.collect()] == ["b"]


def test_learned_abbreviations_do_not_end_sentences(spark):
    often = ["We met Dr. Brown today. It was fun.", "See fig. 3 and fig. 4 now. Then dr. Who left."] * 20
    other = ["The end. J. Smith came at 5. 30 people saw it. Was it 7. Yes.", None, "", "   ", "one"]
    plain = ["today now fun who left it came yes end at was seven"] * 20
    df = spark.createDataFrame(list(enumerate(often + other + plain)), "id long, text string")
    found = {r.token: r.score for r in sentences.period_scores(df, "text").collect()}
    assert found["dr"] >= sentences.LEAST_SCORE > found["fun"] and found["fig"] >= sentences.LEAST_SCORE
    got = {}
    for r in sentences.learned_sentences(df, "id", "text").orderBy("id", "pos").collect():
        got.setdefault(r.id, []).append(r.sentence)
    assert got[0] == ["We met Dr. Brown today.", "It was fun."]
    assert got[1] == ["See fig. 3 and fig. 4 now.", "Then dr. Who left."]
    assert got[40] == ["The end.", "J. Smith came at 5. 30 people saw it.", "Was it 7.", "Yes."]
    assert 41 not in got and got[44] == ["one"]
    assert sentences.learned_sentences(df.limit(0), "id", "text").count() == 0
