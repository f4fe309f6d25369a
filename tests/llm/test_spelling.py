from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from answerclock.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def counts(rows):
    found = Counter()
    for key, text in rows:
        for run in RUN.findall(lowered(text)):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if n >= 3 and len(w) >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(rows):
    words = counts(rows)
    forms, out = {}, {}
    for w, n in words.items():
        close = sorted((v for v in words if near(v, w)), key=lambda v: (-words[v], v))
        forms[w] = close[0] if close and words[close[0]] >= 2 * n else None
        out[w] = len(close)
    result = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        result.append((w, forms[w], root, n, out[w], words.get(forms[w])))
    return sorted(result)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def misspelt(seed):
    """Texts of few words in many spellings, of very different frequency, with runs like "sss"."""
    rng = random.Random(seed)
    base = ["aaaaaa", "assess", "Bàttér", "colour", "passsing", "letters", "ababab", "ÿÀ÷×é"]
    spelt = []
    for word in base:
        for _ in range(25):
            own = list(word)
            for _ in range(rng.randrange(4)):
                i = rng.randrange(len(own))
                kind = rng.randrange(3)
                if kind == 0:
                    own[i] = rng.choice("abesz")
                elif kind == 1:
                    own.insert(i, rng.choice(own))
                elif len(own) > 5:
                    del own[i]
            spelt.append(("".join(own), rng.choice([1, 2, 3, 6, 13, 30, 90])))
    drawn = [w for w, n in spelt for _ in range(n)]
    rng.shuffle(drawn)
    texts = [" ".join(drawn[i : i + 50]) for i in range(0, len(drawn), 50)]
    return list(enumerate([*texts, None, "", "1 2", texts[0]])) + [(None, texts[1])]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed, settings):
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="64")
    rows = misspelt(seed)
    result = got(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert result == expected(rows)
    assert sum(r[1] is not None for r in result) > 20
    assert any(r[1] != r[2] and r[1] is not None for r in result)


def test_awkward_texts_and_clashing_names(docs, no_docs, spark):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(spelling.variants(docs)) == expected(rows)
    assert spelling.variants(no_docs).count() == 0
    named = "prefix string, word string, n int, root string, key int, run int"
    clash = spark.createDataFrame([(1, "hello hello hello", "a", "b", 1, "c", 2, 3)], f"doc_id long, text string, {named}")
    assert got(spelling.variants(clash)) == [("hello", None, "hello", 3, 0, None)]


def test_a_letter_is_taken_from_the_runs_that_the_checksum_names(spark):
    rows = [(i, "damaged") for i in range(3000)]
    found = {r.word: r.n for r in spelling.word_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == counts(rows) and len(found) > 5


def test_long_chains_of_forms(spark):
    """Each form is one letter and a factor of two away; the last one is the root of all."""
    letters = "abcdefgh"
    words = ["".join("z" if j < i else c for j, c in enumerate(letters)) for i in range(9)]
    counted = spark.createDataFrame([(w, 3 * 2**i) for i, w in enumerate(words)], "word string, n long")
    links = spark.createDataFrame(list(zip(words, words[1:])), "word string, form string")
    leads = {r.word: r.root for r in spelling.roots(links, 3 * 2**8).collect()}
    assert leads == dict.fromkeys(words[:-1], words[-1])
    best = {r.word: r.best for r in spelling.neighbours(counted).collect()}
    assert best == dict(zip(words, words[1:])) | {words[-1]: words[-2]}
