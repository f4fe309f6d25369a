from __future__ import annotations

import random

import numpy as np

from answerclock.llm import dedup_minmax as dedup
from answerclock.llm.batches import WindowHasher
from tests.llm.helpers import Groups, sentences, words


def shingles(text):
    own = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}


def expected(rows):
    sets = {i: shingles(t) for i, t in rows}
    groups = Groups(sets)
    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= 85 * len(a | b):
                groups.link(i, j)
    return {i: (len(s), groups.least(i)) for i, s in sets.items()}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_equals_brute_force(docs, texts):
    out = dedup.near_duplicates(docs)
    assert found(out) == expected(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())


def test_a_dense_group_of_near_copies(spark, monkeypatch):
    """Links only between some members: the centre of a bucket does not reach them all."""
    rng = random.Random(3)
    base = sentences(rng, 5000, 150).split()
    rows = []
    for i in range(120):
        own = list(base)
        for _ in range(rng.choice([0, 1, 2, 2, 3])):
            own[rng.randrange(len(own))] = f"n{rng.randrange(30)}"
        rows.append((1000 - i, " ".join(own)))
    monkeypatch.setattr(dedup, "BLOCK_NODES", 16)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(dedup.near_duplicates(df)) == expected(rows)


def test_empty_table_and_repeated_rows(spark, no_docs):
    assert dedup.near_duplicates(no_docs).count() == 0
    rows = [(None, "a b c"), (None, "a b c"), (4, "a b c"), (4, "a b c"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = [(r.doc_id, r.component_id) for r in dedup.near_duplicates(df).collect()]
    assert sorted(out, key=str) == sorted([(None, 4), (None, 4), (4, 4), (4, 4), (9, 9)], key=str)


def test_kept_rows_have_all_columns(docs, texts):
    kept = dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    want = sorted(i for i, (_, c) in expected(texts).items() if i == c)
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_common_counts_equal_set_intersections(monkeypatch):
    monkeypatch.setattr(dedup, "MATRIX_COLUMNS", 7)
    rng = np.random.default_rng(1)
    sides = [[np.unique(rng.integers(0, 60, 30).astype(np.uint64)) for _ in range(n)] for n in (4, 6)]
    want = [[len(np.intersect1d(a, b)) for b in sides[1]] for a in sides[0]]
    assert dedup.common_counts(*sides).tolist() == want


def test_signatures_estimate_the_similarity():
    """Equal values among minima and maxima are about as many as the sets share."""
    hasher = WindowHasher(5)
    rng = np.random.default_rng(5)
    both, one, two = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (600, 200, 200))
    sets = np.concatenate([both, one, both, two])
    out = dedup.signatures(sets, np.array([0, 800]))
    assert abs((out[:, 0] == out[:, 1]).mean() - 0.6) < 0.12
    assert hasher.width == 5


def test_a_third_without_keys_meets_only_its_own_rows(spark):
    """Texts are fetched by row: as many rows as nodes, whatever the keys."""
    rng = random.Random(5)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, sentences(rng, 3000, 30)) for i in range(90)]
    rows += [(key, text + " more") for key, text in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = dedup.deduplicated(df).collect()
    assert len(kept) == 90 and len({r.text.removesuffix(" more") for r in kept}) == 90


def test_copies_without_any_key_keep_one(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text)] * 5 + [(None, text + " x")] * 2 + [(None, None), (None, None), (3, ""), (3, ""), (4, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, bool(r.text and r.text.strip())) for r in dedup.deduplicated(df).collect())
    assert got == [(False, 3, False), (False, 4, False), (True, 0, False), (True, 0, True)]
