from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from answerclock.llm import batches
from tests.llm.helpers import AWKWARD, sentences


@pytest.mark.parametrize("piece", [16, 64, 1 << 20])
@pytest.mark.parametrize("width", [1, 3, 5])
def test_hashes_stand_for_words_and_windows(monkeypatch, piece, width):
    monkeypatch.setattr(batches, "PIECE_BYTES", piece)
    rng = random.Random(width)
    texts = AWKWARD + [sentences(rng, 9, rng.randrange(0, 40)) for _ in range(50)]
    data, offsets = batches.text_bytes(pa.array(texts))
    hasher = batches.WindowHasher(width)
    found, starts, ends, first = hasher.words(data, offsets)
    plain = [(t or "").encode().split() for t in texts]
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == [w for own in plain for w in own]
    at, hashes = hasher.windows(found, first, short=True)
    cuts = batches.per_text(at, first)
    names = {}
    for i, own in enumerate(plain):
        windows = [tuple(own[j : j + width]) for j in range(max(len(own) - width + 1, min(len(own), 1)))]
        assert cuts[i + 1] - cuts[i] == len(windows)
        for window, value in zip(windows, hashes[cuts[i] : cuts[i + 1]]):
            assert names.setdefault(window, value) == value
    assert len(set(names.values())) == len(names)


def test_lowering_touches_ascii_letters_only():
    hasher = batches.WindowHasher(1, lower=True)
    found = hasher.words(*batches.text_bytes(pa.array(["ABC abc É é"])))[0]
    assert found[0] == found[1] and found[2] != found[3]


def test_slices_cover_all_rows():
    offsets = np.array([0, 5, 5, 30, 31, 90])
    assert [b for _, b in batches.slices(offsets, 10)][-1] == 5
    assert [a for a, _ in batches.slices(offsets, 10)][1:] == [b for _, b in batches.slices(offsets, 10)][:-1]
