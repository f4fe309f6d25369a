from __future__ import annotations

import hashlib

import pytest

from answerclock.llm import substring_dedup as sub
from tests.llm.helpers import words


def expected(rows):
    """Rows in order of key; words covered by a window that starts earlier too."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        own = words(text)
        gone = [False] * len(own)
        for a in range(len(own) - sub.WINDOW + 1):
            window = tuple(own[a : a + sub.WINDOW])
            if window in seen:
                gone[a : a + sub.WINDOW] = [True] * sub.WINDOW
            seen.add(window)
        kept = " ".join(w for w, g in zip(own, gone) if not g)
        out[i] = (len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


@pytest.mark.parametrize("slab", [1 << 24, 4000])
def test_equals_brute_force(docs, texts, monkeypatch, slab):
    monkeypatch.setattr(sub, "SLAB_BYTES", slab)
    monkeypatch.setattr(sub, "SHARD_BYTES", slab)
    got = {r.doc_id: r for r in sub.remove_repeats(docs, with_text=True).collect()}
    want = expected(texts)
    assert {i: (r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for i, r in got.items()} == want
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got.values())
    assert sum(r.n_removed for r in got.values()) > 500


def test_a_text_that_repeats_itself(spark):
    rows = [(1, " ".join(["a"] * 50)), (2, " ".join(["b", "c"] * 30))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in sub.remove_repeats(df).collect()}
    assert got == {i: v[:3] for i, v in expected(rows).items()}


def test_empty_table_null_and_repeated_keys(spark, no_docs):
    assert sub.remove_repeats(no_docs).count() == 0
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(5, text), (5, text), (None, text), (7, None)], "doc_id long, text string")
    gone = sorted((str(r.doc_id), r.n_removed) for r in sub.remove_repeats(df).collect())
    assert gone == [("5", 30), ("5", 30), ("7", 0), ("None", 0)]


def test_packets_round_trip():
    import numpy as np

    hashes = np.sort(np.random.default_rng(2).integers(0, 1 << 63, 100).astype(np.uint64))
    keys, marks = np.arange(100) - 50, (np.arange(100) % 3).astype(np.uint8)
    back = sub.unpack(sub.pack(hashes, keys, marks), 100, np.int64, np.uint8)
    assert all((a == b).all() for a, b in zip(back, (hashes, keys, marks)))


def test_one_key_on_all_rows_is_spread(spark, monkeypatch):
    monkeypatch.setattr(sub, "SLAB_BYTES", 3000)
    texts = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(100)]
    shared = " ".join(f"s{j}" for j in range(30))
    df = spark.createDataFrame([(None, f"{t} {shared}") for t in texts], "doc_id long, text string")
    got = sub.remove_repeats(df).collect()
    assert sum(r.n_removed for r in got) == 99 * 30
