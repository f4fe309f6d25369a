"""What the Arrow kernels share: bytes of a text column, words, and hashes of word windows.

A word is a maximal run of bytes that are no separators. All hashes are 64-bit
polynomials over wrapping integers, mixed at the end, and depend on the words
alone, so they agree across batches, tasks and runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The separators space, \t, \n, \v, \f and \r.
WHITE_SPACE = b" \t\n\v\f\r"
PIECE_BYTES = 1 << 20

_MODULUS = 1 << 64
_BYTE_BASE = 0x9E3779B97F4A7C15
_WINDOW_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    binary = column.cast(pa.large_binary() if large else pa.binary())
    if binary.null_count:
        binary = pc.fill_null(binary, b"")
    _, ends, data = binary.buffers()
    kind = np.int64 if large else np.int32
    first = binary.offset
    if len(binary) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, kind)[first : first + len(binary) + 1].astype(np.int64)
    whole = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer row stands alone."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each number over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of an odd base and of its inverse, modulo 2**64, made as far as asked for."""

    def __init__(self, base: int):
        self._bases = (base, pow(base, -1, _MODULUS))
        self._tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._tables[0]) < n:
            size = 1 << int(n - 1).bit_length()
            for i, base in enumerate(self._bases):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                self._tables[i] = np.cumprod(table)
        return self._tables[0][:n], self._tables[1][:n]


class WindowHasher:
    """Hashes of words and of windows of ``width`` consecutive words of one text."""

    def __init__(self, width: int, lower: bool = False, separators: bytes = WHITE_SPACE):
        self.width = width
        self._space = np.zeros(256, bool)
        self._space[list(separators)] = True
        codes = np.arange(256, dtype=np.uint64)
        if lower:
            codes[ord("A") : ord("Z") + 1] += np.uint64(32)
        self._byte_value = mixed(codes + np.uint64(1))
        self._byte_powers = _Powers(_BYTE_BASE)
        self._word_powers = [_Powers(base) for base in _WINDOW_BASES]

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """(hash, start, end) of every word and, per text, the place of its first word.

        Works through pieces of about ``PIECE_BYTES`` that end between words.
        """
        found = [self._piece(data, a, b, offsets) for a, b in self._pieces(data)]
        if found:
            hashes, starts, ends = (np.concatenate(x) for x in zip(*found, strict=True))
        else:
            hashes, starts, ends = np.empty(0, np.uint64), np.empty(0, int), np.empty(0, int)
        return hashes, starts, ends, np.searchsorted(starts, offsets)

    def _pieces(self, data: np.ndarray) -> Iterator[tuple[int, int]]:
        a, n = 0, len(data)
        while a < n:
            b = min(a + PIECE_BYTES, n)
            while b < n:
                gaps = np.flatnonzero(self._space[data[a:b]])
                if len(gaps):
                    b = a + int(gaps[-1]) + 1
                    break
                b = min(b + PIECE_BYTES, n)
            yield a, b
            a = b

    def _piece(self, data, a, b, offsets):
        part = data[a:b]
        gap = self._space[part]
        cut = np.zeros(b - a + 1, bool)  # a text ends before this byte
        cut[0] = cut[-1] = True
        inner = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b, "right")]
        cut[inner - a] = True
        before = np.empty(b - a, bool)
        before[0], before[1:] = True, gap[:-1]
        starts = np.flatnonzero(~gap & (before | cut[:-1]))
        after = np.empty(b - a, bool)
        after[-1], after[:-1] = True, gap[1:]
        ends = np.flatnonzero(~gap & (after | cut[1:])) + 1
        powers, inverse = self._byte_powers.upto(b - a)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(self._byte_value[part] * powers, out=sums[1:])
        hashes = mixed((sums[ends] - sums[starts]) * inverse[starts])
        return hashes, starts + a, ends + a

    def windows(
        self, words: np.ndarray, first: np.ndarray, short: bool = False, parts: int = 1
    ) -> tuple[np.ndarray, ...]:
        """(place of the first word, ``parts`` hash arrays) of every window.

        ``first`` has the place of each text's first word. With ``short``, a text
        of fewer words than ``width`` counts as one window.
        """
        counts = np.diff(first)
        lengths = np.repeat(np.minimum(counts, self.width), counts)
        left = np.repeat(first[1:], counts) - np.arange(first[0], first[-1])
        at = np.flatnonzero((lengths <= left) & (short | (lengths == self.width)))
        lengths = lengths[at]
        hashes = []
        for powers in self._word_powers[:parts]:
            up, inverse = powers.upto(len(words) + 1)
            sums = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(words * up[: len(words)], out=sums[1:])
            hashes.append(mixed((sums[at + lengths] - sums[at]) * inverse[at]))
        return at, *hashes


def per_text(at: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where each text's windows begin among all windows ``at``."""
    return np.searchsorted(at, first)
