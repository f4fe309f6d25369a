"""Exact repeats of ``WINDOW`` bytes, found with run-compressed Burrows-Wheeler indexes.

A byte goes if a string of 200 bytes that covers it also starts anywhere else, in the same text
or in another one; every occurrence goes, overlaps count, and no string crosses a text's end.

Texts that share a passage must meet in one index, wherever they are stored. So each window of
200 bytes is given an anchor, the least hash among its substrings of ``ANCHOR`` bytes, which
depends on the window alone. A run of windows with one anchor is a region (their bytes taken
together, ``REGION_WINDOWS`` windows at most). Equal windows lie in regions with equal anchors,
so regions whose anchor occurs once, in one place, are left out, and each anchor can be settled
by itself:

1. Per text: its regions, as (anchor, hash of the region). Anchors are counted; a region that
   occurs more than once goes on once, with its number of copies. A region that holds its own
   anchor twice may repeat a window inside itself (a short period), so it goes on even alone.
2. Anchors with more than ``REGION_LIMIT`` different regions (the ragged edges of a passage that
   very many texts share) are cut: every single window is an anchor and a region of its own, so
   no anchor has an unbounded group, and windows that occur once drop out before any text moves.
3. Regions are dealt by anchor to shards. There a suffix array gives the Burrows-Wheeler
   transform, of which only the runs are kept, with the two ends of each run sampled: text
   position, and length of the common prefix with the neighbour outside the run. A region with
   copies stands for equal rows of the transform, so they only lengthen its runs. Between
   samples, matching statistics fall by one for each byte, so those of every position against
   all other positions are streamed from the samples alone. Windows with 200 or more are marked.
4. Marks go back to all texts that hold the region, and the bytes they cover are cut.

Texts are shuffled once, into a table bucketed by row; afterwards hashes, one copy of each
repeated region, and marks move. Regions are equal if anchor and hash (128 bits together) are.
Null texts are empty; empty ones and those of fewer bytes than a window lose nothing. Rows with
equal or null keys stay apart; repeated rows lose all that they share. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerclock.llm.batches import _BYTE_BASE, _WINDOW_BASES, _Powers, mixed, slices, text_bytes
from answerclock.llm.cluster import map_arrow, ship, total_bytes
from answerclock.operators.storage import bucketed, stored

WINDOW = 200
ANCHOR = 48
REGION_WINDOWS = WINDOW - ANCHOR + 1
REGION_LIMIT = 2000
SLICE_BYTES = 1 << 21
BUCKET_BYTES = 32 * 1024 * 1024
SHARD_BYTES = 8 * 1024 * 1024
# Symbols of one index. Rank, rank and place of a suffix share 64 bits, which is more than
# REGION_LIMIT regions need; smaller indexes stay in the processor's cache.
INDEX_SYMBOLS = 1 << 18
INDEX_BITS = 21

OCCURRENCE = "row long, at int, n int, anchor long, region long, twice boolean"
PIECE = "shard int, anchor long, region long, copies long, bytes binary"
HIT = "anchor long, region long, ranges array<struct<start:int,end:int>>"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))


class _Sums:
    """Hashes of any substrings of one stretch of bytes."""

    _bases = [_Powers(_BYTE_BASE), _Powers(_WINDOW_BASES[0])]

    def __init__(self, data: np.ndarray, which: int):
        up, self._inverse = self._bases[which].upto(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * up[: len(data)], out=self._sums[1:])

    def rolling(self, width: int) -> np.ndarray:
        """Hash of every substring of ``width`` bytes."""
        n = len(self._sums) - width
        return mixed((self._sums[width:] - self._sums[:n]) * self._inverse[:n])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        hashes = mixed((self._sums[ends] - self._sums[starts]) * self._inverse[starts])
        return mixed(hashes + (ends - starts).astype(np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbouring values."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _anchored_twice(hashes, anchors, starts, n) -> np.ndarray:
    """Whether a region's bytes hold two substrings that are anchors with one hash.

    Two equal windows of a region hold its anchor in two places. Between neighbouring places
    of a region's anchor no other substring is an anchor, so only neighbours are compared.
    """
    around = REGION_WINDOWS - 1
    edge = np.zeros(around, np.uint64)
    # A substring is an anchor if its hash is the greatest anchor of the windows that hold it.
    greatest = ~_least(~np.concatenate([edge, anchors, edge]), REGION_WINDOWS)
    places = np.flatnonzero(hashes == greatest)
    same = np.flatnonzero(hashes[places[1:]] == hashes[places[:-1]])
    first, second = places[same], np.append(places[same + 1], len(hashes) + around)
    return second[np.searchsorted(first, starts)] < starts + n + around


def regions(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first window in ``data``, windows, anchor, hash, twice) of every region of some texts.

    ``twice`` is true where a window may occur twice inside the region.
    """
    windows = len(data) - WINDOW + 1
    if windows <= 0:
        return tuple(np.empty(0, kind) for kind in (int, int, int, np.uint64, np.uint64, bool))
    hashes = _Sums(data, 0).rolling(ANCHOR)
    anchors = _least(hashes, REGION_WINDOWS)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:windows]
    inside = np.arange(windows) + WINDOW <= offsets[text + 1]
    new = np.ones(windows, bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
    edges = np.flatnonzero(new | ~inside)
    run = np.diff(np.concatenate([edges, [windows]]))
    real = inside[edges]
    edges, run = edges[real], run[real]
    # Runs in which one substring repeats may be long; they are cut into bounded regions.
    pieces = -(-run // REGION_WINDOWS)
    first = np.repeat(np.cumsum(pieces) - pieces, pieces)
    within = (np.arange(len(first)) - first) * REGION_WINDOWS
    starts = np.repeat(edges, pieces) + within
    n = np.minimum(np.repeat(run, pieces) - within, REGION_WINDOWS)
    twice = _anchored_twice(hashes, anchors, starts, n)
    return text[starts], starts, n, anchors[starts], _Sums(data, 1).of(starts, starts + n + WINDOW - 1), twice


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _batch(rows, at, n, anchors, hashes, twice) -> pa.RecordBatch:
    columns = [
        pa.array(rows, pa.int64()),
        pa.array(at.astype(np.int32)),
        pa.array(n.astype(np.int32)),
        _signed(anchors),
        _signed(hashes),
        pa.array(twice),
    ]
    return pa.RecordBatch.from_arrays(columns, ["row", "at", "n", "anchor", "region", "twice"])


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(number of the first text, bytes, offsets) of bounded stretches of a batch's texts."""
    data, offsets = text_bytes(batch.column("text"))
    for a, b in slices(offsets, SLICE_BYTES):
        base = int(offsets[a])
        own = offsets[a : b + 1] - base
        yield a, data[base : base + int(own[-1])], own


def _find_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column("row").to_numpy()
        for first, data, offsets in _stretches(batch):
            text, starts, n, anchors, hashes, twice = regions(data, offsets)
            if len(text):
                yield _batch(rows[first + text], starts - offsets[text], n, anchors, hashes, twice)


def _find_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the listed regions as an anchor and a region of its own."""
    for batch in batches:
        for i in range(batch.num_rows):
            data, _ = text_bytes(batch.column("text")[i : i + 1])
            spans = batch.column("spans")[i].values
            starts = spans.field("at").to_numpy().astype(np.int64)
            counts = spans.field("n").to_numpy().astype(np.int64)
            ends = np.cumsum(counts)
            at = np.repeat(starts - ends + counts, counts) + np.arange(int(ends[-1]))
            anchors, hashes = (_Sums(data, k).of(at, at + WINDOW) for k in (0, 1))
            row = np.full(len(at), batch.column("row")[i].as_py())
            yield _batch(row, at, np.ones(len(at), int), anchors, hashes, np.zeros(len(at), bool))


def _cut_pieces(shards: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = text_bytes(batch.column("text")[i : i + 1])[0].tobytes()
                spans = batch.column("spans")[i].values
                starts = spans.field("at").to_numpy().astype(np.int64)
                ends = starts + spans.field("n").to_numpy() + WINDOW - 1
                anchors = spans.field("anchor").to_numpy()
                shard = mixed(anchors.view(np.uint64)) % np.uint64(shards)
                pieces = [data[a:b] for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.astype(np.int32)),
                        pa.array(anchors),
                        spans.field("region"),
                        spans.field("copies"),
                        pa.array(pieces, pa.binary()),
                    ],
                    ["shard", "anchor", "region", "copies", "bytes"],
                )

    return kernel


class SuffixOrder:
    """Suffix array of some texts, each ended by a terminator of its own, by prefix doubling.

    Terminators are smaller than all bytes and ordered by their text. The ranks of each round
    are kept: they give the common prefix of any two suffixes.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        lengths = np.diff(offsets)
        n = len(data) + len(lengths)
        if n >= 1 << INDEX_BITS:
            raise ValueError("too many symbols for one index")
        self.text = np.repeat(np.arange(len(lengths), dtype=np.uint32), lengths + 1)
        self.ends = offsets[1:] + np.arange(len(lengths))  # places of the terminators
        self.left = (self.ends[self.text] - np.arange(n)).astype(np.int32)  # bytes of each suffix
        self.symbols = np.zeros(n, np.uint64)
        present = np.bincount(data, minlength=256) > 0
        codes = np.cumsum(present).astype(np.uint64)  # bytes in use from 1 up, in their order
        self.symbols[self.left > 0] = codes[data]
        self.rounds: list[tuple[int, np.ndarray]] = []
        self._sort(n, max(1, int(codes[-1]).bit_length()))

    def _sort(self, n: int, bits: int) -> None:
        width = (64 - INDEX_BITS) // bits
        packed, more = self.symbols, np.zeros(n, np.uint64)
        for i in range(1, width):  # what follows a terminator does not count
            more[:-1] = packed[1:]
            more[-1] = 0
            more[self.left == 0] = 0
            packed = (self.symbols << np.uint64(bits * i)) | more
        self.first_width = width
        rank = np.empty(n, np.uint32)
        places, slots = np.arange(n), np.arange(n, dtype=np.uint32)
        places, slots, first = self._refine(places, slots, None, packed, rank)
        while len(places):
            self.rounds.append((width, rank))
            rank = rank.copy()
            # A suffix that ends within ``width`` is told from its equals by its terminator.
            beyond = np.minimum(places + width, n - 1)
            before_end = self.left[places] >= width
            second = np.where(before_end, self.rounds[-1][1][beyond], self.text[places])
            places, slots, first = self._refine(places, slots, first, second.astype(np.uint64), rank)
            width *= 2
        self.order = np.empty(n, np.int64)
        self.order[rank] = np.arange(n)

    @staticmethod
    def _refine(places, slots, first, second, rank):
        """Sort ``places`` by (first, second), note their ranks; the ones that are still tied.

        ``slots`` are the places in the suffix array that they take together; the rank of
        equal suffixes is the first of their slots.
        """
        bits = np.uint64(INDEX_BITS)
        key = (second << bits) | np.arange(len(places), dtype=np.uint64)
        if first is not None:
            key |= first.astype(np.uint64) << (bits + bits)
        key.sort()
        places = places[(key & np.uint64((1 << INDEX_BITS) - 1)).astype(np.int64)]
        key >>= bits
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, int)
        sizes = np.diff(np.append(starts, len(key)))
        ranks = np.repeat(slots[starts], sizes)
        rank[places] = ranks
        tied = np.repeat(sizes > 1, sizes)
        return places[tied], slots[tied], ranks[tied]

    def common(self, a: np.ndarray, b: np.ndarray, least: int = 0) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b``; 0 if below ``least``."""
        shared = np.zeros(len(a), np.int64)
        chosen = np.arange(len(a))
        for width, rank in reversed(self.rounds):
            if width <= least:  # the widest round that all long ones are tied in
                chosen = np.flatnonzero(rank[a] == rank[b])
                break
        a, b = a[chosen], b[chosen]
        found = np.zeros(len(a), np.int64)
        last = len(self.text) - 1
        for width, rank in reversed(self.rounds):
            fits = np.minimum(self.left[a], self.left[b]) >= width
            step = np.where(fits & (rank[a] == rank[b]), width, 0)
            found += step
            a, b = np.minimum(a + step, last), np.minimum(b + step, last)
        same = np.ones(len(a), bool)
        for _ in range(self.first_width):
            same &= (self.symbols[a] == self.symbols[b]) & (self.symbols[a] > 0)
            found += same
            a, b = np.minimum(a + same, last), np.minimum(b + same, last)
        shared[chosen] = np.where(found >= least, found, 0)
        return shared


class RunIndex:
    """Runs of the Burrows-Wheeler transform of some texts, with samples at both ends of each.

    Common prefixes shorter than ``least`` are sampled as 0.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, copies: np.ndarray, least: int = 0):
        suffixes = SuffixOrder(data, offsets)
        order, n = suffixes.order, len(suffixes.order)
        before = suffixes.symbols[order - 1]  # the symbol before each suffix, in their order
        # No two texts' starts are one run: what precedes them is a terminator each.
        new = np.ones(n, bool)
        new[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        first = np.flatnonzero(new)
        last = np.append(first[1:], n) - 1
        self.run_symbols = before[first]
        self.run_lengths = np.add.reduceat(copies[suffixes.text[order]], first)  # all copies counted
        # Where two runs meet, the end of one and the start of the next have the same prefix.
        meet = suffixes.common(order[last[:-1]], order[first[1:]], least)
        self.samples = [
            (order[first], np.concatenate([[0], meet])),
            (order[last], np.concatenate([meet, [0]])),
        ]
        self.text, self.left, self.copies = suffixes.text, suffixes.left, copies

    def matching_statistics(self) -> np.ndarray:
        """For each place the longest prefix of its suffix that also starts anywhere else.

        From one sample to the next the match with the neighbour above (or below) keeps its
        place in the order and loses a byte at each step.
        """
        n = len(self.text)
        place = np.arange(n)
        best = np.where(self.copies[self.text] > 1, self.left, 0).astype(np.int64)
        for places, common in self.samples:
            # The last sample at or before each place; later samples have greater places.
            held = np.zeros(n, np.int64)
            held[places] = places
            held = np.maximum.accumulate(held)
            reach = np.zeros(n, np.int64)
            reach[places] = places + common
            best = np.maximum(best, reach[held] - place)
        return best


def _index_runs(table: pa.Table) -> Iterator[tuple[int, int]]:
    """Row ranges of whole anchors, of about ``INDEX_SYMBOLS`` or of one anchor."""
    anchors = table["anchor"].to_numpy()
    sizes = pc.binary_length(table["bytes"]).to_numpy() + 1
    edges = np.flatnonzero(np.diff(anchors)) + 1
    edges = np.concatenate([[0], edges, [len(anchors)]])
    sums = np.concatenate([[0], np.cumsum(sizes)])
    a = 0
    while a < len(edges) - 1:
        b = int(np.searchsorted(sums[edges], sums[edges[a]] + INDEX_SYMBOLS, "right")) - 1
        b = max(a + 1, b)
        yield int(edges[a]), int(edges[b])
        a = b


def _mark(table: pa.Table) -> pa.Table:
    """Ranges of windows of each region that occur elsewhere too."""
    table = table.sort_by([("anchor", "ascending"), ("region", "ascending")])
    found = []
    for a, b in _index_runs(table) if table.num_rows else ():
        part = table.slice(a, b - a)
        data, offsets = text_bytes(part["bytes"])
        index = RunIndex(data, offsets, part["copies"].to_numpy(), WINDOW)
        long = index.matching_statistics() >= WINDOW
        change = np.flatnonzero(np.diff(long.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
        text = index.text[change[:, 0]]
        base = (offsets[:-1] + np.arange(len(offsets) - 1))[text]
        counts = np.bincount(text, minlength=b - a)
        hit = np.flatnonzero(counts)
        ranges = pa.StructArray.from_arrays(
            [pa.array((change[:, i] - base).astype(np.int32)) for i in (0, 1)], ["start", "end"]
        )
        ends = np.concatenate([[0], np.cumsum(counts[hit])]).astype(np.int32)
        found.append(
            pa.table(
                {
                    "anchor": part["anchor"].take(hit),
                    "region": part["region"].take(hit),
                    "ranges": pa.ListArray.from_arrays(ends, ranges),
                }
            )
        )
    if found:
        return pa.concat_tables(found)
    ranges = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.table({"anchor": pa.array([], pa.int64()), "region": pa.array([], pa.int64()), "ranges": pa.array([], ranges)})


def _cut(with_text: bool):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("n", "gone", "spans", "sha", "text")}
            for i in range(batch.num_rows):
                data = text_bytes(batch.column("text")[i : i + 1])[0]
                marks = np.zeros(len(data) + 1, np.int64)
                held = batch.column("marks")[i]
                if held.is_valid and len(held.values):
                    np.add.at(marks, held.values.field("start").to_numpy(), 1)
                    np.add.at(marks, held.values.field("end").to_numpy() + WINDOW - 1, -1)
                gone = np.cumsum(marks[:-1]) > 0
                kept = data[~gone].tobytes()
                out["n"].append(len(data))
                out["gone"].append(int(gone.sum()))
                out["spans"].append(int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)))
                out["sha"].append(hashlib.sha256(kept).hexdigest())
                out["text"].append(kept if with_text else None)
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array(out["n"], pa.int64()),
                "n_removed": pa.array(out["gone"], pa.int64()),
                "n_spans": pa.array(out["spans"], pa.int64()),
                "kept_sha256": pa.array(out["sha"], pa.string()),
            }
            if with_text:
                columns["kept_bytes"] = pa.array(out["text"], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return kernel


def _recurring(occurrences: DataFrame) -> DataFrame:
    """The occurrences whose anchor occurs twice or more, be it inside one region."""
    counts = occurrences.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("_n"), F.max("twice").alias("_twice")
    )
    # Stored, so that adaptive execution can split a hot anchor of the join.
    again = stored(counts.filter("_n > 1 OR _twice").select("anchor"))
    return stored(occurrences.drop("twice").join(again, "anchor", "left_semi"))


def _distinct(occurrences: DataFrame) -> DataFrame:
    """Each region once: its number of copies and the place of one of them."""
    place = F.min(F.struct("row", "at", "n")).alias("place")
    counted = occurrences.groupBy("anchor", "region").agg(F.count(F.lit(1)).alias("copies"), place)
    return stored(counted.select("anchor", "region", "copies", "place.*"))


def _with_spans(texts: DataFrame, spans: DataFrame, *columns: str) -> DataFrame:
    """Texts with the list of their spans; a list is no longer than its text."""
    lists = spans.groupBy("row").agg(F.collect_list(F.struct(*columns)).alias("spans"))
    return texts.join(lists, "row").select("row", "text", "spans")


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    with_text: bool = False,
    region_limit: int = REGION_LIMIT,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs``.

    ``with_text`` adds ``kept_bytes``, which may end inside a character.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    size = total_bytes(rows, "text")
    texts = bucketed(rows, "row", max(1, -(-size // BUCKET_BYTES)))
    every = stored(map_arrow(texts.select("row", "text"), _find_regions, OCCURRENCE))
    found = _recurring(every)
    distinct = _distinct(found)
    crowded = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n"))
    crowded = stored(crowded.filter(F.col("_n") > region_limit).select("anchor"))
    if not crowded.isEmpty():
        listed = _with_spans(texts, found.join(crowded, "anchor", "left_semi"), "at", "n")
        windows = _recurring(stored(map_arrow(listed, _find_windows, OCCURRENCE)))
        found = found.join(crowded, "anchor", "left_anti").unionByName(windows)
        distinct = distinct.join(crowded, "anchor", "left_anti").unionByName(_distinct(windows))
    held = distinct.agg(F.coalesce(F.sum(F.col("n") + WINDOW - 1), F.lit(0))).first()[0]
    shards = max(1, -(-held // SHARD_BYTES))
    listed = _with_spans(texts, distinct, "at", "n", "anchor", "region", "copies")
    pieces = map_arrow(listed, _cut_pieces(shards), PIECE)
    hits = stored(pieces.groupBy("shard").applyInArrow(_mark, HIT))
    marked = found.join(hits, ["anchor", "region"]).select("row", "at", F.explode("ranges").alias("range"))
    own = F.struct(
        (F.col("at") + F.col("range.start")).alias("start"),
        (F.col("at") + F.col("range.end")).alias("end"),
    )
    marks = marked.groupBy("row").agg(F.collect_list(own).alias("marks"))
    joined = texts.join(marks, "row", "left").select("doc_id", "text", "marks")
    result = RESULT + (", kept_bytes binary" if with_text else "")
    return map_arrow(joined, _cut(with_text), result)
