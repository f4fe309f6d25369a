from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from answerclock.llm import encoding, token_binary
from answerclock.llm.registry import END_ID, tokenizer_path
from answerclock.llm.wavelet import WaveletMatrix
from answerclock.operators.storage import shared_folder


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.mark.parametrize(("n", "top"), [(1, 5), (511, 3), (512, 300), (5000, 50257), (1500, 2)])
def test_wavelet_matrix_equals_a_list(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint16)
    matrix = WaveletMatrix.of(ids, 16)
    assert (matrix.ids() == ids).all() and len(matrix) == n
    for at in {0, n // 2, n - 1}:
        assert matrix.access(at) == ids[at]
    for token in {int(ids[0]), int(ids[-1]), top + 1, 1 << 20}:
        assert matrix.count(token) == (ids == token).sum()
        assert matrix.count(token, n // 3, n // 2) == (ids[n // 3 : n // 2] == token).sum()
        assert matrix.occurrences(token) == np.flatnonzero(ids == token).tolist()


def test_cached_encoding_equals_the_library(tokenizer, monkeypatch):
    monkeypatch.setattr(encoding, "MAX_PIECES", 500)  # emptied now and then
    monkeypatch.setattr(encoding, "MAX_UNITS", 300)
    monkeypatch.setattr(encoding, "LOT", 3)
    coder, rng = encoding.CachedEncoder(tokenizer_path()), random.Random(1)
    parts = list("abAB12  \n\t,.;:!?'\"()éß×_-$½²") + [
        "'s", "'ll", "  ", "<|endoftext|>", " ", "日", "́", "\r\n", "\x1c", " ",
    ]
    for _ in range(40):
        texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(100)] + [None]
        ids, counts = coder.encode(texts)
        cuts = np.cumsum([0, *counts])
        for text, a, b in zip(texts, cuts, cuts[1:]):
            assert ids[a:b].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def expected(rows, tokenizer):
    start, out = 0, []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip(docs, texts, tokenizer):
    got = token_binary.round_trip(docs, tokenizer_path(), END_ID).collect()
    assert sorted(map(tuple, got)) == expected(sorted(texts), tokenizer)


def test_shards_answer_lookups(spark, docs, texts, tokenizer):
    folder = shared_folder(spark)
    token_binary.write_shards(docs, folder, tokenizer_path(), END_ID, shard_tokens=1000)
    shards = token_binary.read_shards(spark, folder)
    assert shards.count() > 5
    counted = sum(r.value for r in token_binary.count_token(shards, END_ID).collect())
    own = sum(
        tokenizer.encode(t or "", add_special_tokens=False).ids.count(END_ID) for _, t in texts
    )
    assert counted == len(texts) + own
    at = {(r.part, r.seq, r.value) for r in token_binary.locate_token(shards, END_ID).collect()}
    assert len(at) == counted
    again = token_binary.document_digests(shards).collect()
    assert sorted(map(tuple, again)) == expected(sorted(texts), tokenizer)


def test_empty_table_and_equal_keys(spark, no_docs, tokenizer):
    assert token_binary.round_trip(no_docs, tokenizer_path(), END_ID).count() == 0
    rows = [(None, "a"), (3, "b"), (3, "b"), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_binary.round_trip(df, tokenizer_path(), END_ID).collect()
    assert sorted((r.start, r.n_tokens, str(r.doc_id)) for r in got) == [
        (0, 2, "None"), (2, 2, "3"), (4, 2, "3"), (6, 1, "7"),
    ]


def test_one_key_on_all_rows_is_spread(spark, tokenizer, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = [(None, f"text number {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    folder = shared_folder(spark)
    token_binary.write_shards(df, folder, tokenizer_path(), END_ID)
    shards = token_binary.read_shards(spark, folder)
    assert shards.count() > 3
    got = sorted(r.ids_crc32 for r in token_binary.document_digests(shards).collect())
    assert got == sorted(x[3] for x in expected(rows, tokenizer))


def test_grouped_equals_unique():
    rng = np.random.default_rng(3)
    for hashes in (rng.integers(0, 1 << 63, 500).astype(np.uint64), np.array([5, 4, 5, 6, 4], np.uint64), np.empty(0, np.uint64)):
        unique, at, inverse = encoding._grouped(np.concatenate([hashes, hashes[: len(hashes) // 2]]))
        want = np.unique(hashes)
        assert (unique == want).all() and (unique[inverse][: len(hashes)] == hashes).all()
        assert (np.concatenate([hashes, hashes])[at] == want).all() or len(hashes) < 6
