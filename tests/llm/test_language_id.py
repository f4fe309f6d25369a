from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from answerclock.llm import language_id as lang
from tests.llm.helpers import AWKWARD

SYLLABLES = {"aa": ["the", "ing", "er", "on"], "bb": ["que", "ión", "los", "ez"], "cc": ["sch", "ung", "ä", "ein"]}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        name = rng.choice(list(SYLLABLES))
        text = " ".join("".join(rng.choices(SYLLABLES[name], k=2)) for _ in range(rng.randrange(4, 60)))
        rows.append((i, text, name if i % 10 else None, name))
    rows += [(1000 + i, t, "aa", None) for i, t in enumerate(AWKWARD)]
    rows += [(2000 + i, "".join(rng.choices("xqzwkjvy", k=300)), None, None) for i in range(5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string")


@pytest.fixture(scope="module")
def found(labelled):
    return {r.doc_id: r for r in lang.identify(labelled).collect()}


def test_held_out_accuracy(labelled, found):
    right = [
        found[r.doc_id].lang_pred == r.truth
        for r in labelled.collect()
        if r.truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
    ]
    assert len(right) > 60 and np.mean(right) > 0.97


def test_hold_out_scores_and_unknown(labelled, found):
    for r in labelled.collect():
        out = found[r.doc_id]
        assert out.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= out.score <= 1
        none = r.text is None or not any(c.isalpha() for c in r.text)
        assert (out.lang_pred == "und") == none
        assert none <= out.rejected


def test_noise_is_rejected_and_texts_are_kept(labelled, found):
    assert all(found[2000 + i].rejected for i in range(5))
    assert not any(found[r.doc_id].rejected for r in labelled.collect() if r.truth)
    model = lang.fit(labelled)
    kept = lang.accepted(labelled, model)
    assert kept.columns == labelled.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if not r.rejected}


def test_nothing_to_learn_from(labelled):
    from pyspark.sql import functions as F

    bare = labelled.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in lang.identify(bare).collect()} == {"und"}
    assert lang.identify(bare.limit(0)).count() == 0


def test_ngrams_are_counted_inside_texts_only():
    one, other = lang.ngram_counts(["ab!", "c"]), lang.ngram_counts(["ab!"])
    assert (one[0] == other[0]).all()
    assert one[0].sum() == 5  # a, b; ab, b and its end; ab and its end
