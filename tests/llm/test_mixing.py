from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from answerclock.llm import mixing
from tests.llm.helpers import words


def expected(rows, weights=mixing.WEIGHTS, share=mixing.SHARE, most=mixing.MAX_REPEATS):
    """rows (id, source, text): targets by resharing, then documents in order of their hash."""
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, capped = {}, set()
    while True:
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        target = {
            s: most * sizes[s] if s in capped else weight[s] * rest / free for s in order
        }
        above = {s for s in order if target[s] > most * sizes[s]} - capped
        if not above:
            break
        capped |= above
    taken = {}
    for s in order:
        repeats = int(target[s] // sizes[s]) if sizes[s] else 0
        rest = target[s] - repeats * sizes[s]
        place = lambda r: hashlib.md5(f"mix:{'null' if r[0] is None else r[0]}".encode()).hexdigest()[:15]
        held, open_ = 0, rest > 0
        own = sorted((r for r in rows if r[1] == s), key=place)
        for i, _, text in own:
            n = len(words(text))
            more = open_ and (held + n <= rest or held + n - rest < rest - held)
            open_ = open_ and held + n <= rest
            held += n
            taken[i] = (n, sizes[s], n * (repeats + more))
    return target, taken


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()]


def test_equals_brute_force(docs, rows):
    target, taken = expected(rows)
    got = mixing.mix(docs).collect()
    assert {r.doc_id: (r["size"], r.source_size, r.taken) for r in got} == taken
    assert all(r.target == pytest.approx(target[r.source], abs=1e-5) for r in got)
    assert all(r.taken <= 2 * r["size"] for r in got)


def test_the_mix_repeats_rows(docs, rows):
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    copies = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    taken = {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies}
    assert copies == taken


def test_budgets_beyond_all_sizes_take_everything(docs):
    got = mixing.mix(docs, share=10.0).collect()
    assert all(r.copies == (2 if r.source_size else 0) for r in got)


def test_empty_tables_and_empty_texts(spark, no_docs):
    assert mixing.mix(no_docs).count() == 0
    df = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in mixing.mix(df).collect()] == [(0, 0.0, 0)] * 2


def test_one_key_on_all_rows(spark):
    df = spark.createDataFrame([(None, "a b", "s")] * 10, "doc_id long, text string, source string")
    assert mixing.mix(df).agg(F.sum("taken")).first()[0] in (20, 40)


def test_columns_with_the_names_of_the_operator(spark):
    rows = [(i, f"word {i} more", "a" if i % 2 else None, 7, "x", 1.5, 9) for i in range(40)]
    names = "_mix_copy int, _mix_source string, _mix_threshold double, _MIX_REPEATS int"
    df = spark.createDataFrame(rows, f"doc_id long, text string, source string, {names}")
    got = mixing.mixed(df)
    assert got.columns == df.columns and got.count() > 40
    assert {tuple(r)[3:] for r in got.collect()} == {(7, "x", 1.5, 9)}
