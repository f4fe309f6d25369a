from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from answerclock.functions import porter, tags, terms, text, times, words
from tests.conftest import plan_of

BODIES = [
    ("<p>a<code>abc</code> z <code class=q>de", (2, 15, 0)),
    ("no", (0, 0, 0)),
    ("", (0, 0, 0)),
    (" <img><img src=1/>", (0, 0, 2)),
    ("<pre><code>a\nb</code></pre><code></code>", (2, 5, 0)),
    (None, (None, None, None)),
]


def _code_features(body: str) -> tuple[int, int, int]:
    """The definition in plain Python."""
    pieces = body.split("<code")
    length = 0
    for piece in pieces[1:]:
        end = piece.find("</code>")
        length += len(piece) if end < 0 else end
    return len(pieces) - 1, length, body.count("<img")


def _expressions():
    return (
        text.count_marker("body", "<code"),
        text.span_length("body"),
        text.count_marker("body", "<img"),
    )


def test_code_and_image_features(spark):
    df = spark.createDataFrame([(b,) for b, _ in BODIES], "body string")
    got = [tuple(r) for r in df.select(*_expressions()).collect()]
    assert got == [want for _, want in BODIES]


def test_code_features_equal_the_definition_on_random_bodies(spark):
    dice = random.Random(7)
    parts = ["<code", ">", "</code>", "x", "é", "\n", "<img", " ", "<", "co", "de>"]
    bodies = ["".join(dice.choices(parts, k=dice.randrange(25))) for _ in range(400)]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = [tuple(r) for r in df.select(*_expressions()).collect()]
    assert got == [_code_features(b) for b in bodies]


def test_title_features(spark):
    df = spark.createDataFrame([("Why?",), ("what",), ("",), (None,), ("w",)], "title string")
    got = [
        tuple(r) for r in df.select(text.ends_with("title"), text.begins_with("title")).collect()
    ]
    assert got == [(True, True), (False, True), (False, False), (None, None), (False, False)]


def test_strip_functions(spark):
    body = "<p>a<code>x\ny</code>b<code>z</code></p>\nc < d"
    df = spark.createDataFrame([(body,)], "body string")
    row = df.select(
        text.strip_html("body"), text.strip_code("body"), text.strip_newlines("body")
    ).first()
    assert row[0] == "ax\nybz\nc < d"
    assert row[1] == "<p>ab</p>\nc < d"
    assert "\n" not in row[2]


def test_weekend(spark):
    days = ["2019-01-04", "2019-01-05", "2019-01-06", "2019-01-07"]
    df = spark.createDataFrame([(d + " 23:59:59",) for d in days], "ts string")
    flags = [r[0] for r in df.select(times.is_weekend(F.col("ts"))).collect()]
    assert flags == [False, True, True, False]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_seconds_do_not_depend_on_the_session_zone(spark, settings, zone):
    settings(spark__sql__session__timeZone=zone)
    df = spark.sql(
        "SELECT timestamp_ntz'2019-03-10 01:30:00.9' a, timestamp_ntz'2019-03-10 03:30:00.1' b"
    )
    row = df.select(
        times.seconds_between("a", "b"), times.hours_between("b", "a"), times.epoch_seconds("a")
    ).first()
    assert tuple(row) == (7200, -2.0, 1552181400)


def test_year_of(spark):
    df = spark.sql("SELECT timestamp_ntz'2018-12-31 23:59:59' a")
    assert df.select(times.year_of("a")).first()[0] == 2018


def test_tag_array(spark):
    texts = ["<a><b-c>", "<a><a>", "<>", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "tags string")
    got = [r[0] for r in df.select(tags.tag_array("tags")).collect()]
    assert got == [["a", "b-c"], ["a", "a"], [""], [""], None]


def test_response_count(spark):
    df = spark.createDataFrame([(2, None), (2, 3), (None, None)], "a long, c long")
    got = [
        tuple(r)
        for r in df.select(
            tags.response_count("a", "c"), tags.response_count("a", "c", each_null_as_zero=True)
        ).collect()
    ]
    assert got == [(0, 2), (5, 5), (0, 0)]


def test_stop_words_are_the_ones_spark_ships(spark):
    from pyspark.ml.feature import StopWordsRemover

    shipped = StopWordsRemover.loadDefaultStopWords("english")
    assert sorted(words.ENGLISH_STOP_WORDS) == sorted(shipped)


def test_tokens_stop_words_and_stems(spark):
    df = spark.createDataFrame(
        [("The Cats' 2 running, ÉTÉ!",), ("",), (None,), ("the",)], "t string"
    )
    tokens = df.select(words.token_array("t").alias("w"))
    assert [r[0] for r in tokens.collect()] == [
        ["the", "cats", "2", "running", "été"],
        [],
        None,
        ["the"],
    ]
    clean = tokens.select(words.without_stop_words("w").alias("w"))
    assert [r[0] for r in clean.collect()] == [["cats", "2", "running", "été"], [], None, []]
    stems = clean.select(words.stem_array("w"), words.stem_word(F.get("w", F.lit(0))))
    assert [tuple(r) for r in stems.collect()] == [
        (["cat", "2", "run", "été"], "cat"),
        ([], None),
        (None, None),
        ([], None),
    ]


def test_stop_words_ignore_case(spark):
    df = spark.createDataFrame([(["The", "IS", "Cat"],)], "w array<string>")
    assert df.select(words.without_stop_words("w", ["THE", "is"])).first()[0] == ["Cat"]


def test_sentences(spark):
    df = spark.createDataFrame([("One. Two!\nThree? v1.2 end",), ("",)], "t string")
    got = [r[0] for r in df.select(words.sentence_array("t")).collect()]
    assert got == [["One.", "Two!", "Three?", "v1.2 end"], [""]]


def test_term_counts_of_one_row(spark):
    df = spark.createDataFrame(
        [(["b", "a", "b", "ab"],), ([],), (["a"],), (None,)], "w array<string>"
    )
    ordered = df.select(terms.sorted_tokens("w").alias("o"))
    started = ordered.withColumn("s", terms.run_starts("o"))
    got = [r[0] for r in started.select(terms.run_lengths("o", "s")).collect()]
    as_pairs = [None if g is None else [(x.term, x.n) for x in g] for g in got]
    assert as_pairs[:3] == [[("a", 1), ("ab", 1), ("b", 2)], [], [("a", 1)]]
    assert not as_pairs[3]


def test_text_expressions_are_built_in(spark):
    from answerclock.operators.textfeat import text_features

    df = spark.createDataFrame(
        [(1, "t", "b", "2019-01-05")], "id long, title string, body string, creation_date string"
    )
    plan = plan_of(text_features(df))
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert text_features(df, ts=None).columns == text_features(df).columns[:-1]


# Words and stems from the published description of the algorithm.
PUBLISHED = """
caresses caress ponies poni ties ti caress caress cats cat feed feed plastered plaster bled bled
motoring motor sing sing sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz
failing fail filing file happy happi sky sky relational relat conditional condit rational ration
valenci valenc digitizer digit conformabli conform radicalli radic vileli vile
vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis
hopefulness hope callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl
triplicate triplic formative form formalize formal electriciti electr electrical electr
hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin
gyroscopic gyroscop adjustable adjust defensible defens irritant irrit replacement replac
adjustment adjust dependent depend adoption adopt homologou homolog communism commun
activate activ angulariti angular homologous homolog effective effect bowdlerize bowdler
probate probat rate rate cease ceas controll control roll roll generalizations gener
oscillators oscil
""".split()


@pytest.mark.parametrize(
    "word, stem", list(zip(PUBLISHED[::2], PUBLISHED[1::2], strict=True))
)
def test_published_stems(word, stem):
    assert porter.stem(word) == stem


def test_short_words_and_y():
    assert [porter.stem(w) for w in ("as", "is", "a", "", "toy", "syzygy", "by")] == [
        "as",
        "is",
        "a",
        "",
        "toi",
        "syzygi",
        "by",
    ]
