from __future__ import annotations

import math
import os
import subprocess
import sys
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.sql import functions as F

from answerclock.operators import texts
from tests.conftest import plan_of, rows

TEXTS = [
    (1, "Cats run. Dogs run fast!"),
    (2, "cats sleep and cats eat"),
    (3, "the the the"),
    (4, ""),
    (5, "dogs eat cats"),
]


@pytest.fixture
def documents(spark):
    return spark.createDataFrame(TEXTS, "id long, body string")


@pytest.fixture
def arrays(documents):
    return texts.token_arrays(documents, "id", "body", stemmed=False)


def test_rows_of_sentences_and_tokens(documents):
    assert rows(texts.sentences(documents, "id", "body").filter("id = 1")) == [
        (1, 0, "Cats run."),
        (1, 1, "Dogs run fast!"),
    ]
    tokens = texts.tokens(documents, "id", "body")
    assert rows(tokens.filter("id = 5")) == [(5, 0, "dogs"), (5, 1, "eat"), (5, 2, "cats")]
    clean = texts.remove_stopwords(tokens)
    assert rows(clean.filter("id = 2").select("token")) == [
        ("cats",),
        ("cats",),
        ("eat",),
        ("sleep",),
    ]
    assert rows(texts.stem_tokens(clean)) == [
        ("cats", "cat"),
        ("dogs", "dog"),
        ("eat", "eat"),
        ("fast", "fast"),
        ("run", "run"),
        ("sleep", "sleep"),
    ]


def test_token_arrays_need_no_shuffle(documents):
    stemmed = texts.token_arrays(documents, "id", "body")
    assert dict(rows(stemmed))[1] == ["cat", "run", "dog", "run", "fast"]
    assert "Exchange" not in plan_of(stemmed)


def _expected(min_df):
    docs = {
        1: ["cats", "run", "dogs", "run", "fast"],
        2: ["cats", "sleep", "cats", "eat"],
        3: [],
        4: [],
        5: ["dogs", "eat", "cats"],
    }
    df = Counter(term for words in docs.values() for term in set(words))
    return sorted(
        (
            key,
            term,
            n,
            df[term],
            round(n * math.log(6 / (df[term] + 1)), 9) if df[term] >= min_df else 0.0,
        )
        for key, words in docs.items()
        for term, n in Counter(words).items()
    )


@pytest.mark.parametrize("limit", [10**9, 60, 0])
@pytest.mark.parametrize("min_df", [1, 2, 5])
def test_tfidf(arrays, limit, min_df):
    got = texts.tfidf(arrays, "id", min_df=min_df, broadcast_limit=limit)
    columns = ["id", "term", "n", "doc_freq", F.round("weight", 9)]
    assert rows(got.select(*columns)) == _expected(min_df)


def test_vocabulary(arrays):
    assert rows(texts.vocabulary(texts.term_counts(arrays, "id"))) == [
        ("cats", 3, 4),
        ("dogs", 2, 2),
        ("eat", 2, 2),
    ]


def test_term_counts_need_no_shuffle(arrays):
    assert "Exchange" not in plan_of(texts.term_counts(arrays, "id"))


def test_tfidf_equals_the_vector_form(arrays):
    """On an un-hashed vocabulary the relational weights equal those of Spark ML."""
    counter = CountVectorizer(inputCol="tokens", outputCol="counts", minDF=1.0).fit(arrays)
    counted = counter.transform(arrays)
    weighed = IDF(inputCol="counts", outputCol="weights", minDocFreq=2).fit(counted)
    vectors = weighed.transform(counted).collect()
    ml = {
        (row.id, counter.vocabulary[int(i)]): float(v)
        for row in vectors
        for i, v in zip(row.weights.indices, row.weights.values, strict=True)
        if v
    }
    ours = {
        (r.id, r.term): r.weight for r in texts.tfidf(arrays, "id", min_df=2).collect() if r.weight
    }
    assert ours.keys() == ml.keys()
    assert all(abs(ours[k] - ml[k]) < 1e-12 for k in ml)


def test_vectors(arrays, documents):
    vectors, places = texts.count_vectors(arrays, "id")
    place = {r.term: r.place for r in places.collect()}
    assert sorted(place) == ["cats", "dogs", "eat"] and sorted(place.values()) == [0, 1, 2]
    by_id = {r.id: r.features for r in vectors.collect()}
    assert by_id[2][place["cats"]] == 2.0 and by_id[3].numNonzeros() == 0
    hashed = {r.id: r.features for r in texts.tfidf_vectors(arrays, min_df=1).collect()}
    assert hashed[1].numNonzeros() == 4 and hashed[4].numNonzeros() == 0
    labels = documents.filter("id > 1").select("id", F.lit(1).alias("label"))
    out = texts.doc_vectors(documents, labels, min_df=1)
    assert out.columns == ["id", "features", "label"]
    sizes = {r.id: r.features.numNonzeros() for r in out.collect()}
    assert sizes == {2: 3, 3: 0, 4: 0, 5: 3}


def test_count_vectors_keep_every_term(spark):
    """More terms than 2**18, each in two documents: no cell is lost."""
    n, each = 270_000, 3_000
    terms = F.transform(F.sequence(F.lit(0), F.lit(each - 1)), lambda i: F.concat(F.lit("t"), F.col("part") * each + i))
    docs = spark.range(2 * n // each).select("id", (F.col("id") % (n // each)).alias("part"))
    vectors, places = texts.count_vectors(docs.select("id", terms.alias("tokens")), "id")
    assert places.count() == n
    assert places.agg(F.max("place")).first()[0] == n - 1
    cells = F.unwrap_udt("features")["indices"]
    assert vectors.agg(F.sum(F.size(cells))).first()[0] == 2 * n


def test_stems_work_where_the_package_is_missing(tmp_path):
    """The stemmer travels by value: a process without the package can run it."""
    from pyspark import cloudpickle

    from answerclock.functions import words

    pickled = tmp_path / "stemmer"
    pickled.write_bytes(cloudpickle.dumps(words._stem_lists))
    script = (
        "import pickle, sys, pyarrow as pa; f = pickle.load(open(sys.argv[1], 'rb'));"
        "print(f(pa.array([['running', 'cats'], None, []])).to_pylist(), 'answerclock' in sys.modules)"
    )
    done = subprocess.run(
        [sys.executable, "-c", script, str(pickled)],
        cwd=tmp_path,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
        capture_output=True,
        text=True,
        check=True,
    )
    assert done.stdout.strip() == "[['run', 'cat'], None, []] False"


@pytest.mark.parametrize("limit", [10**9, 0])
def test_tfidf_cuts_each_text_once(spark, documents, limit):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    seen = documents.withColumn("body", counted.asNondeterministic()("body"))
    arrays = texts.token_arrays(seen, "id", "body", stemmed=False)
    assert rows(texts.tfidf(arrays, "id", broadcast_limit=limit).select("id")).count((2,)) == 3
    assert read.value == len(TEXTS)


def test_doc_vectors_give_python_small_batches(spark, tmp_path, monkeypatch):
    from answerclock.functions import words

    log, stem = str(tmp_path / "sizes"), words._stem_lists

    def noted(lists: pa.Array) -> pa.Array:
        with open(log, "a") as out:
            out.write(f"{len(lists)} {lists.nbytes}\n")
        return stem(lists)

    monkeypatch.setattr(words, "_stem_lists", noted)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    text = F.repeat(F.lit("running dogs "), 500)
    documents = spark.range(0, 3000, numPartitions=1).select("id", text.alias("body"))
    labels = spark.range(3000).select("id", F.lit(1).alias("label"))
    out = texts.doc_vectors(documents, labels, min_df=1)
    assert out.count() == 3000
    assert len(out.first().features.indices) == 2
    batches = [tuple(map(int, line.split())) for line in open(log)]
    assert sum(n for n, _ in batches) == 3000
    assert max(size for _, size in batches) <= 2 * texts.BATCH_BYTES
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
