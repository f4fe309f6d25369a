"""Language of texts by the nearest of several centroids per language.

A text becomes hashed counts of its letter n-grams (one to three letters, lower case,
every other character a word end), weighed by TF-IDF and scaled to length one. Each
language has up to ``CENTROIDS`` centroids from spherical k-means over its sample, and a
text gets the language of the centroid with the largest cosine. A text is rejected if
that cosine lies below the language's floor (``FLOOR_SHARE`` of the ``FLOOR_QUANTILE``
of its sample), or if it has no letter.

The classifier is fitted on about ``SAMPLE`` labelled texts of each language (a bound by
design, chosen by a hash of the key); it has ``DIMENSIONS`` numbers per centroid, which is
all that reaches the driver. Every text is predicted whole, inside its row, without a
shuffle. Null texts and texts without letters are ``und`` with score 0. With no label to
learn from, everything is ``und``. Only the named columns are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerclock.llm.batches import mixed, slices, text_bytes
from answerclock.llm.cluster import map_arrow, ship
from answerclock.operators.storage import stored

DIMENSIONS = 1 << 13
CENTROIDS = 4
ROUNDS = 10
SAMPLE = 400
MAX_LANGUAGES = 500  # more labels than that are refused
FLOOR_QUANTILE = 0.01
FLOOR_SHARE = 0.4
UNKNOWN = "und"
HOLD_OUT = 5  # of so many keys, one is held out

SLICE_BYTES = 1 << 19
SLICE_TEXTS = 256
_MARKS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def ngram_counts(texts: list[str | None]) -> np.ndarray:
    """(texts, DIMENSIONS): how often each hashed n-gram occurs. All zero without a letter."""
    codes = [np.frombuffer((t or "").lower().encode("utf-32-le"), np.uint32) for t in texts]
    of = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    code = np.concatenate(codes).astype(np.uint64) if codes else np.empty(0, np.uint64)
    letter = _letters()[code]
    code[~letter] = 0
    keep = letter.copy()  # letters, and the first other character after one
    keep[1:] |= letter[:-1]
    code, of, letter = code[keep], of[keep], letter[keep]
    bins, rows = [], []
    sums = np.zeros(len(code), np.uint64)
    for n, mark in enumerate(_MARKS, 1):
        tail = code[n - 1 :]
        sums = sums[: len(tail)] * np.uint64(mark) + tail + np.uint64(n)
        own = of[: len(tail)]
        whole = (own == of[n - 1 :]) & (letter[: len(tail)] | letter[n - 1 :])
        bins.append((mixed(sums[whole]) >> np.uint64(13)).astype(np.int64) % DIMENSIONS)
        rows.append(own[whole])
    place = np.concatenate(rows) * DIMENSIONS + np.concatenate(bins)
    counts = np.bincount(place, minlength=len(texts) * DIMENSIONS)
    return counts.reshape(len(texts), DIMENSIONS)


def weighed(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF vectors of length one (zero where there is no n-gram)."""
    out = np.log1p(counts).astype(np.float32) * idf
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(length > 0, length, 1)


def clustered(vectors: np.ndarray, k: int = CENTROIDS) -> np.ndarray:
    """Up to ``k`` centroids by spherical k-means, started from points far from one another."""
    centres = vectors.mean(0, keepdims=True)
    centres /= max(np.linalg.norm(centres), 1e-12)
    while len(centres) < min(k, len(vectors)):
        far = int(np.argmin((vectors @ centres.T).max(1)))
        centres = np.concatenate([centres, vectors[far : far + 1]])
    for _ in range(ROUNDS):
        nearest = np.argmax(vectors @ centres.T, 1)
        sums = np.stack([vectors[nearest == i].sum(0) for i in range(len(centres))])
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
    return centres


@dataclass
class Model:
    """``centroids`` in rows, with the language and the least cosine accepted of each."""

    languages: list[str]
    floors: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, rejected) of every text."""
        counts = ngram_counts(texts)
        known = counts.any(1)
        if not self.languages:
            known[:] = False
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), ~known
        cosines = weighed(counts, self.idf) @ self.centroids.T
        best = np.argmax(cosines, 1)
        score = np.clip(cosines[np.arange(len(texts)), best].astype(float), 0, 1) * known
        names = [self.languages[i] if ok else UNKNOWN for i, ok in zip(best, known, strict=True)]
        return names, score, ~known | (score < self.floors[best])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of texts that hold each n-gram, one row of sums for each task."""
    held = np.zeros(DIMENSIONS, np.int64)
    for texts in _text_slices(batches, 0):
        held += (ngram_counts(texts) > 0).sum(0)
    places = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays(
        [pa.array(places, pa.int32()), pa.array(held[places], pa.int64())], ["place", "texts"]
    )


def _text_slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[list]:
    for batch in batches:
        for a, b in _ranges(batch.column(column)):
            yield batch.column(column)[a:b].to_pylist()


def _ranges(column: pa.Array) -> Iterator[tuple[int, int]]:
    for a, b in slices(text_bytes(column)[1], SLICE_BYTES):
        for start in range(a, b, SLICE_TEXTS):
            yield start, min(start + SLICE_TEXTS, b)


def _fitter(idf: np.ndarray):
    def fit_one(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        texts = table["text"].to_pylist()
        parts = [
            weighed(ngram_counts(texts[a : a + SLICE_TEXTS]), idf)
            for a in range(0, len(texts), SLICE_TEXTS)
        ]
        vectors = np.concatenate(parts)
        vectors = vectors[vectors.any(1)]
        centres = clustered(vectors) if len(vectors) else vectors
        floor = 0.0
        if len(vectors):
            near = (vectors @ centres.T).max(1)
            floor = FLOOR_SHARE * float(np.quantile(near, FLOOR_QUANTILE))
        n = len(centres)
        return pa.table(
            {
                "lang": pa.array([table["lang"][0].as_py()] * n, pa.string()),
                "floor": pa.array([floor] * n, pa.float64()),
                "centroid": pa.array([c.tolist() for c in centres], pa.list_(pa.float32())),
            }
        )

    return fit_one


def held_out(key: str = "doc_id") -> Column:
    """True for the keys (as text) that no model may learn from."""
    remainder = F.crc32(F.col(key).cast("string")) % HOLD_OUT
    return F.coalesce(remainder == 0, F.lit(False))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learn from a sample of the labelled rows of ``docs`` that are not held out."""
    ship(docs.sparkSession)
    place = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), F.lit(1 << 30))
    rows = docs.select(
        F.col(lang).alias("lang"),
        F.col(text).alias("text"),
        place.alias("place"),
        held_out(key).alias("held_out"),
        F.col(key).isNull().alias("no_key"),
    ).filter("lang IS NOT NULL AND NOT held_out AND NOT no_key")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1))).limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    limit = F.lit(0)
    for name, n in counts:  # a condition inside the row, so texts are not shuffled by language
        limit = F.when(F.col("lang") == name, F.lit(SAMPLE * (1 << 30) // n)).otherwise(limit)
    chosen = rows.filter(F.col("place") < limit)
    sample = stored(chosen.select("lang", "text", "place"))
    total = sample.count()
    frequencies = map_arrow(sample.select("text"), _frequencies, "place int, texts long")
    idf = np.full(DIMENSIONS, np.log(total + 1) + 1, np.float32)
    for place_, texts in frequencies.groupBy("place").agg(F.sum("texts")).collect():
        idf[place_] = np.log((total + 1) / (texts + 1)) + 1
    fitted = sample.groupBy("lang").applyInArrow(
        _fitter(idf), "lang string, floor double, centroid array<float>"
    )
    found = sorted(fitted.collect(), key=lambda row: (row["lang"], row["centroid"]))
    return Model(
        [row["lang"] for row in found],
        np.array([row["floor"] for row in found]),
        np.array([row["centroid"] for row in found], np.float32).reshape(-1, DIMENSIONS),
        idf,
    )


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, lang_pred, score, rejected) of every row, in place."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _ranges(batch.column(2)):
                names, score, rejected = model.predict(batch.column(2)[a:b].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[a:b],
                        batch.column(1)[a:b],
                        pa.array(names, pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array(rejected, pa.bool_()),
                    ],
                    [key, "held_out", "lang_pred", "score", "rejected"],
                )

    rows = docs.select(F.col(key), held_out(key).alias("held_out"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return map_arrow(
        rows,
        kernel,
        f"`{key}` {kind}, held_out boolean, lang_pred string, score double, rejected boolean",
    )


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not rejected."""
    at = docs.columns.index(text)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _ranges(batch.column(at)):
                rejected = model.predict(batch.column(at)[a:b].to_pylist())[2]
                yield batch.slice(a, b - a).filter(pa.array(~rejected))

    return map_arrow(docs, kernel, docs.schema)


def identify(docs: DataFrame) -> DataFrame:
    """Fit on ``docs`` and predict all of them."""
    return predict(docs, fit(docs))
