from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from answerclock.llm import run_index as ri
from tests.conftest import plan_of


def expected(rows):
    """Bytes covered by a window of which there is another one anywhere."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[a : a + ri.WINDOW] for _, t in texts for a in range(len(t) - ri.WINDOW + 1))
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for a in range(len(t) - ri.WINDOW + 1):
            if seen[t[a : a + ri.WINDOW]] > 1:
                gone[a : a + ri.WINDOW] = [True] * ri.WINDOW
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and not before for g, before in zip(gone, [False, *gone]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r[:5]) + (bytes(r[5]),) for r in df.collect()), key=repr)


def passages(seed=3):
    """Passages just under, at and over a window in ever different surroundings, and periodic texts."""
    rng = random.Random(seed)
    letters = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared = {n: letters(n) for n in (150, 185, 198, 199, 200, 201, 260, 700)}
    texts = [letters(rng.randrange(0, 300)) + shared[n] + letters(rng.randrange(0, 300)) for n in shared for _ in range(4)]
    texts += ["x" * 199, "x" * 200, "x" * 201, "y" * 1500, "ab" * 400, "z" * 150, letters(600)]
    texts += [shared[700][100:450] * 2, None, "", " "]
    return [(i, t) for i, t in enumerate(texts)]


SCHEMA = "doc_id long, text string"


def test_equals_brute_force(docs, texts):
    assert got(ri.remove_repeats(docs, with_text=True)) == expected(texts)


@pytest.mark.parametrize("limit", [2000, 2])
def test_passages_in_many_surroundings(spark, limit, monkeypatch):
    monkeypatch.setattr(ri, "SHARD_BYTES", 4000)
    rows = passages()
    result = got(ri.remove_repeats(spark.createDataFrame(rows, SCHEMA), with_text=True, region_limit=limit))
    assert result == expected(rows)
    assert sum(r[2] for r in result) > 3000


def test_empty_table_null_and_repeated_keys(spark, no_docs):
    assert ri.remove_repeats(no_docs).count() == 0
    rows = [(None, "q" * 10 + "r" * 250), (None, "r" * 250), (4, "s" * 230), (4, "s" * 230), (5, None)]
    rows = [(i, t) for i, t in rows]
    assert got(ri.remove_repeats(spark.createDataFrame(rows, SCHEMA), with_text=True)) == expected(rows)


@pytest.mark.parametrize("period", [1, 7, 100, 151, 152, 153, 154, 300])
def test_a_short_period_that_no_other_text_has(spark, period):
    """Equal windows may overlap so far that they lie in one region, whose anchor no other has."""
    rng = random.Random(period)
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    rows = []
    for length in (200, 200 + period - 1, 200 + period, 203 + period, 352, 353):
        for around in (0, 90):
            own = chr(ord("A") + len(rows)) + letters(period - 1)
            rows.append((len(rows), letters(around) + (own * 400)[:length] + letters(3 * around)))
    result = got(ri.remove_repeats(spark.createDataFrame(rows, SCHEMA), with_text=True))
    assert result == expected(rows)
    assert sum(r[2] for r in result) > 0


def naive_statistics(parts):
    whole = [(i, a) for i, t in enumerate(parts) for a in range(len(t) + 1)]

    def common(p, q):
        a, b = parts[p[0]][p[1] :], parts[q[0]][q[1] :]
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    return [max((common(p, q) for q in whole if q != p), default=0) for p in whole]


@pytest.mark.parametrize("seed", range(6))
def test_statistics_from_sampled_run_ends(seed):
    rng = random.Random(seed)
    parts = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(1, 60))) for _ in range(6)]
    parts = list(dict.fromkeys([*parts, b"a" * 40, b"ab" * 30]))
    data = np.frombuffer(b"".join(parts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in parts])])
    index = ri.RunIndex(data, offsets, np.ones(len(parts), int))
    assert index.matching_statistics().tolist() == naive_statistics(parts)
    assert len(index.run_lengths) < len(data)
    assert index.run_lengths.sum() == len(data) + len(parts)


def test_copies_lengthen_runs_and_match_to_their_end():
    data = np.frombuffer(b"abcabd", np.uint8)
    index = ri.RunIndex(data, np.array([0, 3, 6]), np.array([5, 1]))
    assert index.matching_statistics().tolist() == [3, 2, 1, 0, 2, 1, 0, 0]
    assert index.run_lengths.sum() == 5 * 4 + 4


def test_texts_are_not_shuffled_again(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    rows = [(i, "t" * 220) for i in range(20)]
    plan = plan_of(ri.remove_repeats(spark.createDataFrame(rows, SCHEMA)))
    texts = plan[plan.index("SortMergeJoin") :].split("Exchange")[0]
    assert "Bucketed: true" in texts and "doc_id" in texts
