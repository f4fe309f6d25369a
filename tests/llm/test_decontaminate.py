from __future__ import annotations

import hashlib
import random
import re

import pytest

from answerclock.llm import decontaminate as decon
from tests.llm.helpers import AWKWARD, sentences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def windows(text):
    own = words(text)
    n = min(len(own), decon.WINDOW_WORDS)
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()


def expected(text, items):
    own, hit, found = words(text), set(), set()
    for key, item in items:
        for window in windows(item):
            n = len(window)
            for i in range(len(own) - n + 1):
                if tuple(own[i : i + n]) == window:
                    hit |= set(range(i, i + n))
                    found.add(str(key))
    joined = ",".join(sorted(found)).encode()
    return len(own), len(hit), len(found), hashlib.sha256(joined).hexdigest(), bool(hit)


@pytest.fixture(scope="module")
def data(spark, texts):
    rng = random.Random(9)
    items = [(i, sentences(rng, 300, rng.choice([10, 11, 25, 40]))) for i in range(25)]
    items += [(50, "Two words"), (51, "solo"), (52, None), (53, "?!"), (7, "É é nine TEN"), (54, items[3][1])]
    rows = [(i, t) for i, t in texts if len(t or "") < 3000]
    for i in range(40):
        text = items[i % 25][1].upper() if i % 3 else " ".join(items[i % 25][1].split()[2:13])
        rows.append((1000 + i, sentences(rng, 300, 20) + ", " + text + " " + sentences(rng, 300, 9)))
    rows += [(2000, "two, WORDS!"), (2001, "a solo b solo"), (2002, "é É nine ten É é nine ten"), (2003, "x " * 400)]
    rows += [(3000 + i, t) for i, t in enumerate(AWKWARD)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, row int")
    return rows, items, docs, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("part", [decon.PART_BYTES, 4000])
def test_equals_brute_force(data, monkeypatch, part):
    """In one pass and in several."""
    monkeypatch.setattr(decon, "PART_BYTES", part)
    rows, items, docs, items_df = data
    got = {r.doc_id: tuple(r)[1:] for r in decon.digest(decon.contamination(docs, items_df)).collect()}
    assert got == {i: expected(t, items) for i, t in rows}


def test_clean_rows_have_all_columns(data):
    rows, items, docs, items_df = data
    kept = decon.clean(docs, items_df)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, t in rows if not expected(t, items)[-1])


def test_empty_tables_and_repeated_rows(spark, data):
    _, _, docs, items = data
    assert decon.digest(decon.contamination(docs.limit(0), items)).count() == 0
    none = decon.digest(decon.contamination(docs, items.limit(0)))
    assert none.filter("contaminated").count() == 0 and none.count() == docs.count()
    twice = spark.createDataFrame([(None, "two words"), (None, "two words")], "doc_id long, text string")
    assert [r.n_hit for r in decon.digest(decon.contamination(twice, items)).collect()] == [2, 2]


def test_no_python_in_the_plan(data):
    from tests.conftest import plan_of

    plan = plan_of(decon.digest(decon.contamination(data[2], data[3])))
    assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan


def test_columns_with_the_names_of_the_operator(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    docs = spark.createDataFrame([(1, passage, 7, 8), (2, "clean words", 7, 8)], "doc_id long, text string, _item_mark int, __item_mark int")
    items = spark.createDataFrame([("i", passage)], "item_id string, text string")
    got = decon.clean(docs, items)
    assert [tuple(r) for r in got.collect()] == [(2, "clean words", 7, 8)]
