from __future__ import annotations

from collections import Counter

from answerclock.llm import quality_cascade as quality
from tests.llm.helpers import words


def expected(text):
    text = text or ""
    own = words(text)
    windows = Counter(tuple(own[i : i + 3]) for i in range(len(own) - 2))
    covered = {
        p for i in range(len(own) - 2) if windows[tuple(own[i : i + 3])] > 1 for p in (i, i + 1, i + 2)
    }
    lines = [line for line in text.split("\n") if words(line)]
    n, repeats = len(own), len(covered)
    chars, dups = sum(map(len, own)), len(lines) - len(set(lines))
    symbols = sum(c in quality.SYMBOLS for c in text)
    base = n < 50 or 100 * repeats > 50 * n
    bad = (
        10 * symbols > n
        or 100 * dups > 40 * len(lines)
        or not 2 * n <= chars <= 12 * n
        or any(len(w) > 200 for w in own)
        or 2 * sum(c.isupper() for c in text) > chars
    )
    return n, chars, symbols, dups, repeats, base, not base and not bad


JUNK = [
    "### " * 60,
    "a b c d e f g h i j\n" * 12,
    " ".join(f"W{i}X" for i in range(60)).upper(),
    " ".join(f"w{i}" for i in range(60)) + " " + "z" * 300,
    " ".join(f"w{i}$" for i in range(60)),
    "&&&\n&&&\n|",
]


def test_equals_brute_force(spark, docs, texts):
    more = [(10_000 + i, t) for i, t in enumerate(JUNK)]
    extra = spark.createDataFrame(more, "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(extra)
    got = {r.doc_id: tuple(r)[1:7] + (r.kept,) for r in quality.judged(both).collect()}
    assert got == {i: expected(t) for i, t in [*texts, *more]}
    assert any(v[-1] for v in got.values())


def test_the_order_of_rules_changes_no_verdict(docs):
    names = list(quality.RULES)
    kept = [
        sorted((r.doc_id, r.kept) for r in quality.judged(docs, order=order).collect())
        for order in (names, names[::-1])
    ]
    assert kept[0] == kept[1]


def test_rules_are_ordered_by_rejections_per_second(spark):
    rows = [(i, "### " * 60) for i in range(50)]
    order = quality.ordered_rules(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(order) == sorted(quality.RULES) and order[-1] != "symbols"


def test_no_python_in_the_plan(docs):
    from tests.conftest import plan_of

    plan = plan_of(quality.judged(docs, order=list(quality.RULES)))
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(no_docs):
    assert quality.judged(no_docs).count() == 0
