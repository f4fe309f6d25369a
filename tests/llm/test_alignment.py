from __future__ import annotations

import hashlib
import os
from collections import Counter

import numpy as np
import pytest

from answerclock.llm import alignment as al
from answerclock.llm.registry import tokenizer_path
from answerclock.operators import lookups

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"

SPACED = [
    " ", "  ", "   a", "a  b", "a \n b", "x\n\n  b", "tail ", "tail  ", "\ta b", "a  b", "a  c d",
    "emoji 😀 and ▁ mark", "▁", "<|endoftext|> plain", "<s> </s> <unk> <0x41>", "null\x00 inside",
    "don't  we'll", "100,000.00 is 1e5", "naïve Ω≈ç√ 漢字 かな", "ﬁ ① Á", "aaaa" * 300, "tab\tand\x0bmore\x1c x",
    "\r\n\r\n lines \r\n", "é combining", "über-cool straße Ångström", "CamelCaseWords_and_snake_case",
]


@pytest.fixture(scope="module")
def plain():
    """Whole texts by the libraries themselves."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = al.byte_letters()

    def ids(text):
        if not text:
            return None
        spelt = (" " + text).encode()
        x = a.encode(" " + text, add_special_tokens=False).ids
        y = b.encode(text)
        bytes_x = [bytes(letters[c] for c in a.id_to_token(i)) for i in x]
        names = [b.id_to_piece(i) for i in y]
        bytes_y = [bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for p, i in zip(names, y)]
        return (x, bytes_x, y, bytes_y) if b"".join(bytes_x) == spelt == b"".join(bytes_y) else None

    return ids


def spans(pieces):
    ends = np.cumsum([len(p) for p in pieces]).tolist()
    return list(zip([0, *ends[:-1]], ends))


def expected(rows, ids):
    per_text, counts = [], Counter()
    for key, text in rows:
        found = ids(text)
        if found is None:
            per_text.append((key, None))
            continue
        x, bytes_x, y, bytes_y = found
        sx, sy = spans(bytes_x), spans(bytes_y)
        links = [(x[i], y[j]) for i, p in enumerate(sx) for j, q in enumerate(sy) if p[0] < q[1] and q[0] < p[1]]
        counts.update(links)
        common = sorted({e for _, e in sx} & {e for _, e in sy})
        groups, start = [], 0
        for end in common:
            own = [",".join(str(t) for t, (s, e) in zip(z, sz) if start <= s and e <= end) for z, sz in ((x, sx), (y, sy))]
            groups.append("|".join(own))
            start = end
        per_text.append((key, (len(x), len(y), groups, links)))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for key, found in per_text:
        if found is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found
        best = sum(counts[p] == highest[p[1]] for p in links)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((key, n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), sha))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def short(docs, texts):
    return docs.filter("length(text) < 4000 or text is null"), [r for r in texts if r[1] is None or len(r[1]) < 4000]


def test_equals_the_libraries_on_whole_texts(docs, texts, plain):
    docs, texts = short(docs, texts)
    assert got(al.alignment(docs, A, B)) == expected(texts, plain)


@pytest.mark.parametrize("limit", [al.MAX_UNITS, 10])
def test_spaces_marks_and_special_strings(spark, plain, limit, monkeypatch):
    monkeypatch.setattr(al, "MAX_UNITS", limit)
    monkeypatch.setattr(al, "SLICE_BYTES", 50)
    rows = [*enumerate(SPACED * 2), (None, None), (None, "null key"), (7, ""), (7, "again and again"), (7, "again and again")]
    held = al.Aligner(A, B)
    for _, text in rows:
        if text:
            assert "".join(" " + u for u in held.units_of(text)) == " " + text
    assert got(al.alignment(spark.createDataFrame(rows, SCHEMA), A, B)) == expected(rows, plain)


def test_cache_is_trimmed_between_slices(plain, monkeypatch):
    monkeypatch.setattr(al, "MAX_UNITS", 8)
    import pyarrow as pa

    held = al.Aligner(A, B)
    monkeypatch.setattr(al, "aligner", lambda *_: held)
    texts = [f"word{i % 3} other{i} thing{i % 2}" for i in range(40)]
    monkeypatch.setattr(al, "SLICE_BYTES", 60)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(40)), pa.array(range(40)), pa.array(texts)], ["row", "doc_id", "text"]
    )
    out = pa.Table.from_batches(list(al._align(A, B)(iter([batch]))))
    regular = out.filter(pa.compute.equal(out["kind"], al.REGULAR))
    assert len(held.units) <= 8 + 9
    want = Counter()
    for t in texts:
        x, bx, y, by = plain(t)
        for s, p in zip(spans(bx), x):
            want[p] += any(s == q and held.identity[p] == b for q, b in zip(spans(by), y))
    have = Counter()
    for pairs, n in zip(regular["pairs"].to_pylist(), regular["n"].to_pylist()):
        have[pairs[0] // held.size_b] += n
    assert have == +want


def test_a_large_table_of_groups_is_not_broadcast(spark, plain, monkeypatch):
    monkeypatch.setattr(lookups.join_lookup, "__defaults__", ("inner", 1, 0.01))
    rows = [(i, t) for i, t in enumerate(SPACED)]
    assert got(al.alignment(spark.createDataFrame(rows, SCHEMA), A, B)) == expected(rows, plain)


def test_empty_table(no_docs):
    assert al.alignment(no_docs, A, B).count() == 0


def test_identity_maps_equal_bytes():
    held = al.aligner(A, B)
    mapped = np.flatnonzero(held.identity >= 0)
    assert len(mapped) > 10_000
    assert all(held.bytes_a[i] == held.bytes_b[held.identity[i]] for i in mapped)
