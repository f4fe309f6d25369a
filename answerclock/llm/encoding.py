"""Token ids of texts by a byte-level BPE of the tokenizers library, with repeated parts cached.

Texts are cut at spaces into units, and units into pieces. A worker keeps the ids of both, so
the regular expression sees each different unit once and the tokenizer each different piece.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa

from answerclock.llm.batches import WindowHasher, text_bytes

# A text may be cut before spaces, tabs and line ends that follow a visible character, and
# between a common letter or digit and a punctuation mark: no token of a byte-level BPE
# reaches over such a place. Other white space (fixed values below) may join with them, so
# units that have any are encoded in one piece.
_PIECES = re.compile(
    "[ \t\n\r]*(?:[^ \t\n\r,.;:!?]*[0-9A-Za-zÀ-ÖØ-öø-ÿ](?=[,.;:!?])|[^ \t\n\r]+)|[ \t\n\r]+"
)
_OTHER_SPACE = re.compile(
    r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
_ONE_WORD = re.compile(r" \S+")
_PLACE_BITS = 20
_FIRST = np.uint64(0x9E6C63D0876A9A47)
_AFTER_VISIBLE = re.compile(r"(?<=\S)(?= )")
MAX_UNITS = 500_000
MAX_PIECES = 400_000
BATCH = 8192  # new pieces given to the tokenizer at once; its answers are large
LOT = 64  # words given to it as one text, which spares an answer for each


class _Places(dict):
    """Number of each key; a new one is noted in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, key) -> int:
        place = self[key] = len(self)
        self.new.append(key)
        return place


class _Lists:
    """Lists of ids on end, with the start and length of each; room is doubled when it is full."""

    def __init__(self):
        self._ids, self._used, self._count = np.zeros(1 << 16, np.uint32), 0, 0
        self._starts, self.lengths = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        used, count = self._used + len(ids), self._count + len(lengths)
        while len(self._ids) < used:
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        while len(self._starts) < count:
            self._starts = np.concatenate([self._starts, np.zeros_like(self._starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self._ids[self._used : used] = ids
        self.lengths[self._count : count] = lengths
        self._starts[self._count : count] = self._used + np.cumsum(lengths) - lengths
        self._used, self._count = used, count

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all ``places`` on end, number of each)."""
        lengths = self.lengths[places]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self._starts[places] - ends + lengths, lengths) + np.arange(total)
        return self._ids[at], lengths


class EachAlone:
    """Ids of many strings, each encoded as if it stood alone.

    Words with one space before them and none inside are joined: only the first token of
    each begins with a space, which tells them apart again.
    """

    def __init__(self, tokenizer):
        self._tokenizer = tokenizer
        entries = (tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size()))
        self._begins = np.array([entry.startswith("\u0120") for entry in entries])

    def _coded(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all ``pieces`` on end, number of each)."""
        is_word = np.fromiter((bool(_ONE_WORD.fullmatch(p)) for p in pieces), bool, len(pieces))
        words = [p for p, good in zip(pieces, is_word.tolist(), strict=True) if good]
        lots = ["".join(words[a : a + LOT]) for a in range(0, len(words), LOT)]
        joined = np.array([i for ids in self._coded(lots) for i in ids], np.uint32)
        starts = np.flatnonzero(self._begins[joined])
        if len(starts) != len(words):
            raise ValueError("the tokenizer does not begin each word with a token of its own")
        others = self._coded([p for p, good in zip(pieces, is_word.tolist(), strict=True) if not good])
        lengths = np.zeros(len(pieces), np.int64)
        lengths[is_word] = np.diff(np.append(starts, len(joined)))
        lengths[~is_word] = [len(ids) for ids in others]
        ids = np.zeros(int(lengths.sum()), np.uint32)
        of_word = np.repeat(is_word, lengths)
        ids[of_word] = joined
        ids[~of_word] = [i for x in others for i in x]
        return ids, lengths


def _per_list(lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of ``lengths`` over neighbouring stretches of ``counts`` entries."""
    sums = np.concatenate([[0], np.cumsum(lengths)])
    return np.diff(sums[np.concatenate([[0], np.cumsum(counts)])])


def _grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values ascending, place of one of each, number of its value for each).

    Sorting numbers that end in their place is faster than sorting places.
    """
    if len(hashes) >> _PLACE_BITS == 0:
        low = np.uint64((1 << _PLACE_BITS) - 1)
        order = np.sort((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)) & low
        order = order.astype(np.int64)
        ranked = hashes[order]
        new = np.ones(len(hashes), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        unique = ranked[new]
        if (unique[1:] > unique[:-1]).all():  # else two values differ in their last bits only
            inverse = np.empty(len(hashes), np.int64)
            inverse[order] = np.cumsum(new) - 1
            return unique, order[new], inverse
    return np.unique(hashes, return_index=True, return_inverse=True)


class CachedEncoder:
    """Encodes texts; the ids of units are kept, and the rarer half goes when they are too many.

    Units are found by a hash of their bytes, worked out for a whole slice of texts at once, so
    Python sees each new unit only. Size and byte sum of every unit are held against those of
    the unit that is kept; where they differ, the slice is encoded without hashes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.size = tokenizer.get_vocab_size()
        self._each = EachAlone(tokenizer)
        self._hasher = WindowHasher(1, separators=b" ")
        self._no_pieces()
        self._no_units()

    def _no_pieces(self) -> None:
        self._pieces, self._piece_ids = _Places(), _Lists()

    def _no_units(self) -> None:
        self._hashes, self._places = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # by hash
        self._unit_ids = _Lists()
        # By place: size, byte sum, whether a text may not be cut after it, and its uses.
        self._sizes, self._sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._open, self._uses = np.zeros(0, bool), np.zeros(0, np.int64)

    def _trim(self) -> None:
        if len(self._hashes) <= MAX_UNITS:
            return
        kept = np.argsort(-self._uses, kind="stable")[: MAX_UNITS // 2]
        place = np.full(len(self._uses), -1)
        place[kept] = np.arange(len(kept))
        still = place[self._places] >= 0
        ids = _Lists()
        ids.add(*self._unit_ids.of(kept))
        self._hashes, self._places = self._hashes[still], place[self._places][still]
        self._unit_ids, self._uses = ids, self._uses[kept] // 2
        self._sizes, self._sums, self._open = self._sizes[kept], self._sums[kept], self._open[kept]

    def _ids_of(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all ``units`` on end, number of each), by their pieces."""
        if len(self._pieces) > MAX_PIECES:
            self._no_pieces()
        pieces: list[str] = []
        counts = np.zeros(len(units), np.int64)
        for i, unit in enumerate(units):
            own = [unit] if _OTHER_SPACE.search(unit) else _PIECES.findall(unit)
            counts[i] = len(own)
            pieces += own
        places = np.fromiter(map(self._pieces.__getitem__, pieces), np.int64, len(pieces))
        new, self._pieces.new = self._pieces.new, []
        for a in range(0, len(new), BATCH):
            self._piece_ids.add(*self._each(new[a : a + BATCH]))
        ids, lengths = self._piece_ids.of(places)
        return ids, _per_list(lengths, counts)

    def _learn(self, hashes, names: list[str], sizes, sums) -> None:
        """Keep units with ascending new ``hashes``."""
        count = len(self._sizes)
        self._unit_ids.add(*self._ids_of(names))
        is_open = np.array([not n or n[-1].isspace() for n in names], bool)
        at = np.searchsorted(self._hashes, hashes)
        self._hashes = np.insert(self._hashes, at, hashes)
        self._places = np.insert(self._places, at, count + np.arange(len(hashes)))
        self._sizes, self._sums = np.append(self._sizes, sizes), np.append(self._sums, sums)
        self._open = np.append(self._open, is_open)
        self._uses = np.append(self._uses, np.zeros(len(hashes), np.int64))

    def _plainly(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Texts cut after visible characters only, without the kept units."""
        cut = [_AFTER_VISIBLE.split(t.decode()) if t else [] for t in texts]
        ids, lengths = self._ids_of([unit for units in cut for unit in units])
        return ids, _per_list(lengths, np.array([len(units) for units in cut], np.int64))

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts on end, number of ids of each) of UTF-8 texts."""
        self._trim()
        n = len(offsets) - 1
        hashes, starts, ends, first = self._hasher.words(data, offsets)
        counts = np.diff(first)
        spaces = np.concatenate([[0], np.cumsum(data == ord(" "))])
        # One unit more than spaces, or else spaces stand together or at an end.
        plain = (counts != np.diff(spaces[offsets]) + 1) & (np.diff(offsets) > 0)
        begins = first[:-1][counts > 0]
        hashes[begins] ^= _FIRST  # a text's first unit has no space before it
        sums = np.concatenate([[0], np.cumsum(data, dtype=np.int64)])
        sums, sizes = sums[ends] - sums[starts], ends - starts
        unique, at, inverse = _grouped(hashes)
        place = np.searchsorted(self._hashes, unique)
        held = np.append(self._hashes, np.uint64(0))[place] == unique
        held &= place < len(self._hashes)
        if not held.all():
            new = at[~held]
            is_first = np.zeros(len(hashes), bool)
            is_first[begins] = True
            raw = data.tobytes()
            names = [
                ("" if alone else " ") + raw[a:b].decode()
                for a, b, alone in zip(starts[new].tolist(), ends[new].tolist(), is_first[new].tolist())
            ]
            self._learn(unique[~held], names, sizes[new], sums[new])
            place = np.searchsorted(self._hashes, unique)
        places = self._places[place][inverse]
        if not ((self._sizes[places] == sizes) & (self._sums[places] == sums)).all():
            plain[:] = True
        last = np.zeros(len(places), bool)
        last[first[1:][counts > 0] - 1] = True
        of = np.repeat(np.arange(n), counts)
        plain[of[self._open[places] & ~last]] = True
        self._uses += np.bincount(places, minlength=len(self._uses))
        kept = ~plain[of]
        ids, lengths = self._unit_ids.of(places[kept])
        totals = _per_list(lengths, np.where(plain, 0, counts))
        if not plain.any():
            return ids, totals
        chosen = np.flatnonzero(plain).tolist()
        others, other_lengths = self._plainly([data[offsets[i] : offsets[i + 1]].tobytes() for i in chosen])
        totals[plain] = other_lengths
        out = np.zeros(int(totals.sum()), np.uint32)
        from_plain = np.repeat(plain, totals)
        out[from_plain], out[~from_plain] = others, ids
        return out, totals

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``encode_bytes`` of a list; null is empty."""
        return self.encode_bytes(*text_bytes(pa.array(texts, pa.string())))


@functools.cache
def encoder(path: str) -> CachedEncoder:
    """The worker's one encoder for ``path``."""
    return CachedEncoder(path)
