"""A wavelet matrix over token ids: bit planes from the highest bit down.

Plane by plane the ids are dealt stably by that bit, zeros first. Each plane keeps
its bits and, for every block of 512, the number of ones before it, which is all
that access, counting and occurrence lookup need.
"""

from __future__ import annotations

import numpy as np

BLOCK_BITS = 512
_BLOCK_BYTES = BLOCK_BITS // 8


class Plane:
    """One bit per position, with rank and select."""

    def __init__(self, size: int, bits: np.ndarray, ones_before: np.ndarray):
        self.size, self.bits, self.ones_before = size, bits, ones_before

    @classmethod
    def of(cls, flags: np.ndarray) -> Plane:
        packed = np.packbits(flags, bitorder="little")
        blocks = -(-len(packed) // _BLOCK_BYTES)
        padded = np.zeros(blocks * _BLOCK_BYTES, np.uint8)
        padded[: len(packed)] = packed
        counts = np.bitwise_count(padded.view(np.uint64)).reshape(blocks, -1).sum(1)
        before = np.zeros(blocks + 1, np.uint32)
        np.cumsum(counts, out=before[1:])
        return cls(len(flags), packed, before)

    @property
    def zeros(self) -> int:
        return self.size - int(self.ones_before[-1])

    def flags(self) -> np.ndarray:
        return np.unpackbits(self.bits, count=self.size, bitorder="little").view(bool)

    def rank1(self, at: int) -> int:
        """Ones before position ``at``."""
        block = at // BLOCK_BITS
        part = self.bits[block * _BLOCK_BYTES : -(-at // 8)]
        ones = int(np.bitwise_count(part).sum())
        if at % 8:
            ones -= int(part[-1] >> (at % 8)).bit_count()
        return int(self.ones_before[block]) + ones

    def get(self, at: int) -> int:
        return int(self.bits[at >> 3]) >> (at & 7) & 1

    def select(self, bit: int, nth: int) -> int:
        """Position of the ``nth`` (from 0) position that holds ``bit``."""
        before = self.ones_before.astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK_BITS - before
        block = int(np.searchsorted(before, nth, "right")) - 1
        part = self.bits[block * _BLOCK_BYTES : (block + 1) * _BLOCK_BYTES]
        flags = np.unpackbits(part, bitorder="little") == bit
        return block * BLOCK_BITS + int(np.flatnonzero(flags)[nth - int(before[block])])


class WaveletMatrix:
    """Ids in ``planes``, highest bit first."""

    def __init__(self, planes: list[Plane]):
        self.planes = planes

    @classmethod
    def of(cls, ids: np.ndarray, levels: int) -> WaveletMatrix:
        planes = []
        for level in reversed(range(levels)):
            ones = (ids & ids.dtype.type(1 << level)) != 0
            planes.append(Plane.of(ones))
            ids = np.concatenate([np.compress(~ones, ids), np.compress(ones, ids)])
        return cls(planes)

    def __len__(self) -> int:
        return self.planes[0].size

    def ids(self) -> np.ndarray:
        """All ids, put together from the lowest plane up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        out = np.zeros(len(self), kind)
        for shift, plane in enumerate(reversed(self.planes)):
            ones, dealt, zeros = plane.flags(), out, plane.zeros
            out = np.empty_like(dealt)
            out[np.flatnonzero(~ones)] = dealt[:zeros]
            out[np.flatnonzero(ones)] = dealt[zeros:] | kind(1 << shift)
        return out

    def access(self, at: int) -> int:
        token = 0
        for plane in self.planes:
            bit, ones = plane.get(at), plane.rank1(at)
            token = token << 1 | bit
            at = plane.zeros + ones if bit else at - ones
        return token

    def _span(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the ids equal to ``token`` of positions [start, end) lie below the last plane."""
        if token >> len(self.planes):
            return 0, 0
        for level, plane in enumerate(self.planes):
            before, upto = plane.rank1(start), plane.rank1(end)
            if token >> (len(self.planes) - 1 - level) & 1:
                start, end = plane.zeros + before, plane.zeros + upto
            else:
                start, end = start - before, end - upto
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        first, last = self._span(token, start, len(self) if end is None else end)
        return last - first

    def occurrences(self, token: int) -> list[int]:
        """Positions of ``token``, ascending."""
        found = []
        for at in range(*self._span(token, 0, len(self))):
            for plane in reversed(self.planes):
                ones = at >= plane.zeros
                at = plane.select(int(ones), at - plane.zeros if ones else at)
            found.append(at)
        return found
