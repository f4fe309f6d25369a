"""Sentences, tokens, stems and term weights over a table of documents.

One row is one document. Tokens, stop words, stems and term counts are worked
out inside that row, so only terms (never whole texts) are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerclock.functions import terms, words
from answerclock.functions.text import strip_html
from answerclock.operators.lookups import (
    BROADCAST_LIMIT,
    checkpointed,
    join_lookup,
    table_size,
)
from answerclock.operators.storage import numbered, stored

# Least number of documents that hold a term.
COUNT_MIN_DF = 2
IDF_MIN_DF = 5
HASH_PLACES = 1 << 18
# What a Python worker is given at once; it holds a few times as much.
BATCH_BYTES = 4 * 1024 * 1024


def sentences(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, sentence): text cut at white space after ``.``, ``!`` or ``?``."""
    return df.select(key, F.posexplode(words.sentence_array(text)).alias("pos", "sentence"))


def tokens(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, token) in text order."""
    return df.select(key, F.posexplode(words.token_array(text)).alias("pos", "token"))


def remove_stopwords(
    token_rows: DataFrame, stop_words: Sequence[str] = words.ENGLISH_STOP_WORDS
) -> DataFrame:
    """Token rows whose token is no stop word, whatever its case."""
    lowered = sorted({word.lower() for word in stop_words})
    return token_rows.filter(~F.lower("token").isin(lowered))


def stem_tokens(token_rows: DataFrame) -> DataFrame:
    """(token, stem) once per distinct token."""
    distinct = token_rows.select("token").distinct()
    return distinct.select("token", words.stem_word("token").alias("stem"))


def token_arrays(
    df: DataFrame,
    key: str,
    text: str,
    stop_words: Sequence[str] = words.ENGLISH_STOP_WORDS,
    stemmed: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(key, ``keep``..., tokens): cleaned tokens of each document in text order, no shuffle."""
    cleaned = words.without_stop_words(words.token_array(text), stop_words, lower_case=True)
    tokens_col = words.stem_array(cleaned) if stemmed else cleaned
    return df.select(key, *keep, tokens_col.alias("tokens"))


def term_counts(docs: DataFrame, key: str, tokens_col: str = "tokens") -> DataFrame:
    """(key, term, n) per document row, counted by sorting its own tokens."""
    ordered = docs.select(key, terms.sorted_tokens(tokens_col).alias("ordered"))
    started = ordered.withColumn("starts", terms.run_starts("ordered"))
    counted = started.select(key, F.explode(terms.run_lengths("ordered", "starts")).alias("run"))
    return counted.select(key, "run.term", "run.n")


def vocabulary(counts: DataFrame, min_df: int = COUNT_MIN_DF) -> DataFrame:
    """(term, doc_freq, term_freq) of terms in at least ``min_df`` documents."""
    return (
        counts.groupBy("term")
        .agg(F.count(F.lit(1)).alias("doc_freq"), F.sum("n").alias("term_freq"))
        .filter(F.col("doc_freq") >= min_df)
    )


def tfidf(
    docs: DataFrame,
    key: str,
    tokens_col: str = "tokens",
    min_df: int = IDF_MIN_DF,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """(key, term, n, doc_freq, weight) with weight = n * ln((docs + 1) / (doc_freq + 1)).

    Terms in fewer than ``min_df`` documents weigh 0. The counts are stored: texts are cut
    into tokens once, not for the frequencies and again for the weights.
    """
    counts = stored(term_counts(docs, key, tokens_col))
    frequencies = vocabulary(counts, min_df=1).select("term", "doc_freq")
    rows = join_lookup(
        counts, frequencies, "term", "doc_freq", broadcast_limit=broadcast_limit, rows_stored=True
    )
    total = docs.agg(F.count(F.lit(1))).scalar()
    weight = F.col("n") * F.log((total + 1) / (F.col("doc_freq") + 1))
    return rows.select(
        key,
        "term",
        "n",
        "doc_freq",
        F.when(F.col("doc_freq") >= min_df, weight).otherwise(0.0).alias("weight"),
    )


def count_vectors(
    docs: DataFrame,
    key: str,
    tokens_col: str = "tokens",
    min_df: int = COUNT_MIN_DF,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> tuple[DataFrame, DataFrame]:
    """(key, features) with vectors of term counts, and (term, doc_freq, term_freq, place).

    The vocabulary is a table of any size: its terms are numbered by falling frequency
    (then by term) in range order, none is left out and none reaches the driver. A
    document without a term of the vocabulary has an empty vector. ``key`` is unique.
    """
    counts = stored(term_counts(docs, key, tokens_col))
    terms_ = vocabulary(counts, min_df)
    places = stored(numbered(terms_, F.col("term_freq").desc(), F.col("term"), name="place"))
    size = places.count()
    found = join_lookup(
        counts, places.select("term", "doc_freq", "place"), "term", "doc_freq",
        broadcast_limit=broadcast_limit, rows_stored=True,
    )
    cell = F.struct(F.col("place").cast("int").alias("place"), F.col("n").cast("double").alias("n"))
    cells = found.groupBy(key).agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    every = docs.select(key).join(cells, key, "left")
    return as_vectors(every.select(key, "cells"), "cells", "place", "n", size), places


def as_vectors(df: DataFrame, cells: str, place: str, value: str, size: int) -> DataFrame:
    """``df`` with sparse vectors ``features`` in place of the sorted structs ``cells``.

    The vector type is a struct in storage, so it is built as one, stored, and read back as
    vectors. Null cells are an empty vector.
    """
    none = F.lit(0).cast("byte"), F.lit(size)
    parts = F.struct(
        none[0].alias("type"),
        none[1].alias("size"),
        F.coalesce(F.col(f"{cells}.{place}"), F.array().cast("array<int>")).alias("indices"),
        F.coalesce(F.col(f"{cells}.{value}"), F.array().cast("array<double>")).alias("values"),
    )
    rest = [c for c in df.columns if c != cells]
    rows = df.select(*rest, parts.alias("features"))
    fields = [f for f in rows.schema.fields if f.name != "features"]
    return stored(rows, T.StructType([*fields, T.StructField("features", VectorUDT())]))


def hashed_counts(
    docs: DataFrame, tokens_col: str = "tokens", places: int = HASH_PLACES
) -> DataFrame:
    """``docs`` with term counts hashed to ``places`` in place of the tokens, inside each row."""
    hasher = HashingTF(inputCol=tokens_col, outputCol="term_counts", numFeatures=places)
    return hasher.transform(docs).drop(tokens_col)


@contextmanager
def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> Iterator[None]:
    """Actions inside give Python batches of about ``size`` bytes, however long the texts are."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def weigh(hashed: DataFrame, min_df: int = IDF_MIN_DF) -> DataFrame:
    """Hashed counts to a ``features`` vector of TF-IDF weights.

    Fitting and weighing both read the counts, so they are checkpointed: tokens
    and stems are worked out once.
    """
    stored = checkpointed(hashed)
    model = IDF(inputCol="term_counts", outputCol="features", minDocFreq=min_df).fit(stored)
    return model.transform(stored).drop("term_counts")


def tfidf_vectors(
    docs: DataFrame,
    tokens_col: str = "tokens",
    min_df: int = IDF_MIN_DF,
    places: int = HASH_PLACES,
) -> DataFrame:
    """``docs`` with a ``features`` vector of hashed TF-IDF weights."""
    return weigh(hashed_counts(docs, tokens_col, places), min_df)


def doc_vectors(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "id",
    text: str = "body",
    label: str = "label",
    min_df: int = IDF_MIN_DF,
    places: int = HASH_PLACES,
    stop_words: Sequence[str] = words.ENGLISH_STOP_WORDS,
    stemmed: bool = True,
) -> DataFrame:
    """The whole text job: (key, features, label) from HTML texts and a table of labels.

    Texts become hashed counts before they meet their labels, so the join carries
    counts and not texts. Where the labelled keys fit a broadcast, texts without a label
    are left out before any work on them. Weights are fitted on the labelled documents.
    Stems are worked out here, in small batches, and their counts checkpointed.
    """
    named = checkpointed(labels.select(key, label))
    if table_size(named)[1] <= BROADCAST_LIMIT:
        docs = docs.join(F.broadcast(named.select(key)), key, "left_semi")
    plain = docs.select(key, strip_html(text).alias("plain"))
    arrays = token_arrays(plain, key, "plain", stop_words, stemmed)
    hashed = hashed_counts(arrays, places=places)
    with small_batches(docs.sparkSession):
        return weigh(hashed.join(named, key), min_df).select(key, "features", label)
