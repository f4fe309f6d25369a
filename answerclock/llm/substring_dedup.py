"""Exact repeats of ``WINDOW`` words, found by fixed-block anchors.

A window of 20 words holds a whole block of 10 words wherever the blocks of its document
begin. So the non-overlapping blocks of all documents are the index, every rolling window
of 10 words is a probe, and only where a probe meets a block of another place can a window
of 20 be a repeat. Around these hits the windows of 20 are compared; the repeated ones run
together to maximal exact repeats.

Documents are dealt by key into slabs of about ``SLAB_BYTES`` of text, which are the only
thing that holds texts: one shuffle, used three times. Between slabs only sorted hashes move,
packed by range of the hash (shard): each slab sends a hash once, so a passage that a third
of all documents share costs one entry per slab, and a shard holds about
``SLAB_BYTES / 8`` entries whatever the counts.

1. Slab: distinct hashes of its probes, each with whether it is a block and whether it recurs.
   Shard: those that are a block somewhere and occur twice or more go back to their slabs.
2. Slab: hashes of its windows of 20 around such hits, each with its smallest key.
   Shard: the slab with the smallest key keeps the window; the others learn that theirs recur.
3. Slab: all such windows, and those after the first one inside a slab, cover the words that go.

Probes are compared by 48 bits of their hash, which can only add candidates, windows by 64
bits. Windows are judged on the input. Null texts have no words. Rows with equal keys come in
some fixed order, those with equal texts side by side; null keys come before all others, too.
Repeated rows stay as rows; the later one loses its repeated words. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerclock.llm.batches import WindowHasher, slices, text_bytes
from answerclock.llm.cluster import ship, total_bytes

WINDOW = 20
BLOCK = 10  # at most (WINDOW + 1) / 2, so that each window holds a whole block
SLAB_BYTES = 16 * 1024 * 1024
LEAST_SLAB_BYTES = 2 * 1024 * 1024
SHARD_BYTES = 8 * 1024 * 1024
SLICE_BYTES = 2 * 1024 * 1024
PROBE_BITS = 48

_NO_KEY = np.iinfo(np.int64).min
_BLOCKS, _AGAIN = np.uint8(1), np.uint8(2)

PACKETS = "shard int, slab int, n long, packed binary"
REPLIES = "slab int, n long, packed binary"
RESULT = (
    "doc_id long, n_words long, n_removed long, kept_sha256 string, "
    "spans array<struct<start:long,end:long>>"
)


def pack(hashes: np.ndarray, *columns: np.ndarray) -> bytes:
    """Ascending hashes as differences, with their columns, byte by byte and compressed."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    planes = [np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()]
    for column in columns:
        width = column.dtype.itemsize
        planes.append(np.ascontiguousarray(column.view(np.uint8).reshape(-1, width).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(packed: bytes, n: int, *kinds: type) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    found, at = [], 0
    for kind in (np.uint64, *kinds):
        width = np.dtype(kind).itemsize
        planes = raw[at : at + n * width].reshape(width, n)
        found.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * width
    found[0] = np.cumsum(found[0], dtype=np.uint64)
    return found


def _merged(table: pa.Table, *kinds: type) -> list[np.ndarray]:
    """The packets of a table on end, and the number of its row for each entry."""
    rows = [
        unpack(packed, n, *kinds)
        for n, packed in zip(table["n"].to_pylist(), table["packed"].to_pylist(), strict=True)
    ]
    if not rows:
        return [np.empty(0, kind) for kind in (np.uint64, *kinds, np.int64)]
    of = np.repeat(np.arange(len(rows)), [len(row[0]) for row in rows])
    return [np.concatenate(x) for x in zip(*rows, strict=True)] + [of]


def _packets(slab: int, shards: int, hashes: np.ndarray, bits: int, *columns) -> pa.Table:
    """One packet for each range of the hash that has entries."""
    limits = (np.arange(1, shards, dtype=object) * (1 << bits)) // shards
    cuts = np.searchsorted(hashes, np.array(limits, np.uint64))
    cuts = np.concatenate([[0], cuts, [len(hashes)]]).astype(np.int64)
    full = np.flatnonzero(np.diff(cuts))
    spans = [slice(cuts[i], cuts[i + 1]) for i in full]
    return pa.table(
        {
            "shard": pa.array(full, pa.int32()),
            "slab": pa.array(np.full(len(full), slab), pa.int32()),
            "n": pa.array(np.diff(cuts)[full], pa.int64()),
            "packed": pa.array([pack(hashes[s], *(c[s] for c in columns)) for s in spans], pa.binary()),
        }
    )


def _replies(slabs: np.ndarray, of: np.ndarray, hashes: np.ndarray, *columns) -> pa.Table:
    """One packet for each slab; entries come in ascending order of the hash."""
    order = np.argsort(of, kind="stable")
    which, starts, counts = np.unique(of[order], return_index=True, return_counts=True)
    spans = [order[a : a + n] for a, n in zip(starts, counts, strict=True)]
    return pa.table(
        {
            "slab": pa.array(slabs[which], pa.int32()),
            "n": pa.array(counts, pa.int64()),
            "packed": pa.array([pack(hashes[s], *(c[s] for c in columns)) for s in spans], pa.binary()),
        }
    )


class Slab:
    """The texts of one slab, in order of key and text, in slices of bounded size."""

    def __init__(self, table: pa.Table):
        order = [("doc_id", "ascending"), ("text", "ascending")]
        self.table = table.sort_by(order, null_placement="at_start")
        keys = self.table["doc_id"].combine_chunks().fill_null(_NO_KEY)
        self.keys = keys.to_numpy(zero_copy_only=False)
        self.data, self.offsets = text_bytes(self.table["text"])
        self.hashers = {n: WindowHasher(n) for n in (BLOCK, WINDOW)}

    def slices(self) -> Iterator[tuple]:
        """(number of the first text, word starts, word ends, hashes, first words, base)."""
        for a, b in slices(self.offsets, SLICE_BYTES):
            base = int(self.offsets[a])
            own = self.offsets[a : b + 1] - base
            data = self.data[base : base + int(own[-1])]
            words, starts, ends, first = self.hashers[BLOCK].words(data, own)
            yield a, data, starts, ends, words, first

    def probes(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, cut hash) of every rolling window of ``BLOCK`` words."""
        at, hashes = self.hashers[BLOCK].windows(words, first)
        return at, hashes >> np.uint64(64 - PROBE_BITS)


def _text_of(at: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.searchsorted(first, at, "right") - 1


def _sender(shards: int):
    def kernel(table: pa.Table) -> pa.Table:
        slab, hashes, flags = Slab(table), [], []
        for _, _, _, _, words, first in slab.slices():
            at, probes = slab.probes(words, first)
            is_block = (at - first[_text_of(at, first)]) % BLOCK == 0
            hashes.append(probes)
            flags.append(is_block.astype(np.uint8))
        every = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(every)
        unique, starts, counts = np.unique(every[order], return_index=True, return_counts=True)
        marks = np.empty(0, np.uint8)
        if len(unique):
            marks = np.maximum.reduceat(np.concatenate(flags)[order], starts)
            marks = marks | (counts > 1).astype(np.uint8) * _AGAIN
        number = table["slab"][0].as_py()
        return _packets(number, shards, unique, PROBE_BITS, marks)

    return kernel


def _groups(hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(order, start of each run of equal hashes, its length)."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    return order, starts, np.diff(np.concatenate([starts, [len(ranked)]]))


def _anchors(table: pa.Table) -> pa.Table:
    """Probes that are a block somewhere and occur twice or more, back to their slabs."""
    slabs = table["slab"].to_numpy()
    hashes, marks, of = _merged(table, np.uint8)
    order, starts, counts = _groups(hashes)
    seen = np.bitwise_or.reduceat(marks[order], starts)
    hit = (seen & _BLOCKS > 0) & ((counts > 1) | (seen & _AGAIN > 0))
    chosen = order[np.repeat(hit, counts)]
    return _replies(slabs, of[chosen], hashes[chosen])


def _in(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    """Place of each value in ``sorted_set``, or -1."""
    if not len(sorted_set):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return np.where(sorted_set[at] == values, at, -1)


def _candidates(shards: int):
    def kernel(texts: pa.Table, replies: pa.Table) -> pa.Table:
        anchors = np.sort(_merged(replies)[0])
        hashes, keys = [], []
        slab = Slab(texts)
        for number, _, _, _, words, first in slab.slices() if len(anchors) else ():
            at, probes = slab.probes(words, first)
            hits = np.zeros(len(words) + 1, np.int64)
            hits[at[_in(probes, anchors) >= 0] + 1] = 1
            hits = np.cumsum(hits)
            start, windows = slab.hashers[WINDOW].windows(words, first)
            near = hits[start + WINDOW - BLOCK + 1] > hits[start]
            hashes.append(windows[near])
            keys.append(slab.keys[number + _text_of(start[near], first)])
        every = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(every, kind="stable")  # texts come in order of their keys
        unique, starts, counts = np.unique(every[order], return_index=True, return_counts=True)
        least = np.concatenate(keys)[order[starts]] if hashes else np.empty(0, np.int64)
        again = (counts > 1).astype(np.uint8)
        number = texts["slab"][0].as_py() if texts.num_rows else replies["slab"][0].as_py()
        return _packets(number, shards, unique, 64, least, again)

    return kernel


def _losers(table: pa.Table) -> pa.Table:
    """For each slab its windows that recur: 1 if another slab has the first one, else 0."""
    slabs = table["slab"].to_numpy()
    hashes, keys, again, of = _merged(table, np.int64, np.uint8)
    order = np.lexsort((slabs[of], keys, hashes))
    ranked = hashes[order]
    lost = np.concatenate([[False], ranked[1:] == ranked[:-1]])
    chosen = lost | (again[order] > 0)
    order, lost = order[chosen], lost[chosen].astype(np.uint8)
    return _replies(slabs, of[order], hashes[order], lost)


def _covered(starts: np.ndarray, words: int) -> np.ndarray:
    marks = np.zeros(words + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + WINDOW, words), -1)
    return np.cumsum(marks[:-1]) > 0


def _cut(with_text: bool):
    def kernel(texts: pa.Table, replies: pa.Table) -> pa.Table:
        hashes, lost, _ = _merged(replies, np.uint8)
        order = np.argsort(hashes)
        hashes, lost = hashes[order], lost[order] > 0
        seen = lost.copy()  # a window seen before, here or in another slab
        slab = Slab(texts)
        columns: dict[str, list] = {name: [] for name in ("n", "gone", "sha", "spans", "text")}
        for _, data, starts, ends, words, first in slab.slices():
            at, windows = slab.hashers[WINDOW].windows(words, first)
            place = _in(windows, hashes)
            at, place = at[place >= 0], place[place >= 0]
            earliest = np.zeros(len(at), bool)
            earliest[np.unique(place, return_index=True)[1]] = True
            repeat = seen[place] | ~earliest
            seen[place] = True
            removed = _covered(at[repeat], len(words))
            for i in range(len(first) - 1):
                _finish(columns, data, starts, ends, removed, first[i], first[i + 1], with_text)
        out = {
            "doc_id": slab.table["doc_id"],
            "n_words": pa.array(columns["n"], pa.int64()),
            "n_removed": pa.array(columns["gone"], pa.int64()),
            "kept_sha256": pa.array(columns["sha"], pa.string()),
            "spans": pa.array(
                columns["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            ),
        }
        if with_text:
            out["kept_text"] = pa.array(columns["text"], pa.string())
        return pa.table(out)

    return kernel


def _finish(columns, data, starts, ends, removed, a: int, b: int, with_text: bool) -> None:
    """Append the result of the text whose words are [a, b)."""
    gone = removed[a:b]
    if a == b:
        kept = b""
    else:
        words = data[starts[a] : ends[b - 1]].tobytes().split()
        kept = b" ".join([w for w, out in zip(words, gone, strict=True) if not out] if gone.any() else words)
    edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
    columns["n"].append(b - a)
    columns["gone"].append(int(gone.sum()))
    columns["sha"].append(hashlib.sha256(kept).hexdigest())
    columns["spans"].append(
        [{"start": int(s), "end": int(e)} for s, e in edges.reshape(-1, 2)]
    )
    if with_text:
        columns["text"].append(kept.decode())


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans) of every row of ``docs``.

    ``spans`` are the maximal runs of removed words. ``with_text`` adds ``kept_text``.
    """
    ship(docs.sparkSession)
    size = total_bytes(docs, text)
    slabs, shards = (max(1, -(-size // limit)) for limit in (SLAB_BYTES, SHARD_BYTES))
    # A small table is cut finer, so that all cores have some of it.
    cores = docs.sparkSession.sparkContext.defaultParallelism
    slabs = max(slabs, min(cores, -(-size // LEAST_SLAB_BYTES)))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    place = F.xxhash64("doc_id", "text")  # rows with one key or none spread by their texts
    rows = rows.withColumn("slab", F.pmod(place, F.lit(slabs)).cast("int"))
    by_slab = rows.groupBy("slab")

    def answered(packets: DataFrame, kernel) -> DataFrame:
        return packets.groupBy("shard").applyInArrow(kernel, REPLIES)

    anchors = answered(by_slab.applyInArrow(_sender(shards), PACKETS), _anchors)
    windows = by_slab.cogroup(anchors.groupBy("slab")).applyInArrow(_candidates(shards), PACKETS)
    losers = answered(windows, _losers)
    result = RESULT + (", kept_text string" if with_text else "")
    return by_slab.cogroup(losers.groupBy("slab")).applyInArrow(_cut(with_text), result)
