"""Alignment of two tokenizers: which tokens of A and B cover the same bytes, and how often.

The tokens of a text in A (byte-level BPE of the tokenizers library) and in B (pieces of
sentencepiece) are cut into groups wherever both end at the same byte. Tokens of a group that
overlap are linked; the count of a pair of ids is the number of its links in all texts.

Most groups are one token on each side. Such a group has equal bytes on both sides, so an array
from each id of A to the id of B with the same bytes names it by its A id alone: these groups
are counted in vectors as long as A's vocabulary, one for each task, and scored from such a
vector. Only the other, irregular groups are keyed rows: each task sends a group once with its
number, pairs and their counts come from distinct groups, and texts meet the sums of their
distinct groups in one join (broadcast under a checked size, else split by hot groups).

Neither tokenizer joins a visible character with a space after it (A by its pattern, B because
no piece holds a space after another character, which is checked; otherwise texts stay whole).
So a text is cut there, and each distinct unit is encoded and aligned once in a worker. B must
not change the text before it cuts it; texts whose tokens do not spell them have no tokens.

Null and empty texts have no tokens: zeros and an empty hash. Rows with equal or null keys stay
apart; repeated rows count as often as they stand there; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerclock.llm.batches import slices, text_bytes
from answerclock.llm.cluster import map_arrow, ship
from answerclock.llm.encoding import LOT, EachAlone
from answerclock.operators.lookups import join_lookup
from answerclock.operators.storage import stored

SLICE_BYTES = 1 << 20
MAX_UNITS = 400_000
LEARN = 4096  # units given to the tokenizers at once
DOC, GROUP, REGULAR = 0, 1, 2

ALIGNED = (
    "kind int, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, ids array<int>, ids_n array<int>, groups array<string>, "
    "groups_n array<int>, pairs array<long>, n long"
)
DIGEST = ("n_a", "n_b", "n_groups", "n_links")

_SPACE_AFTER_SPACE = re.compile(r"[^\S ] |  |^ ")
_WORD = re.compile(r"[^\s▁]+")
_CUT = re.compile(r"(?<=\S)(?= )")


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte: itself if printable."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def token_bytes_a(tokenizer) -> list[bytes | None]:
    letters, found = byte_letters(), []
    for i in range(tokenizer.get_vocab_size()):
        entry = tokenizer.id_to_token(i)
        good = entry is not None and all(c in letters for c in entry)
        found.append(bytes(letters[c] for c in entry) if good else None)
    return found


def token_bytes_b(processor) -> list[bytes | None]:
    found: list[bytes | None] = []
    for i in range(processor.vocab_size()):
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            found.append(bytes([int(piece[3:-1], 16)]))
        elif processor.is_control(i) or processor.is_unknown(i):
            found.append(None)
        else:
            found.append(piece.replace("▁", " ").encode())
    return found


class _Units(dict):
    """Number of each unit; a new one is noted in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        place = self[unit] = len(self)
        self.new.append(unit)
        return place


class Flat:
    """Lists of numbers on end, with the place and length of each."""

    def __init__(self):
        self.values, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)

    def add(self, values: np.ndarray, lengths: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.values) + np.cumsum(lengths) - lengths])
        self.values = np.concatenate([self.values, values])
        self.lengths = np.concatenate([self.lengths, lengths])

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values of all ``places`` on end, number of each)."""
        n = self.lengths[places]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.values[np.repeat(self.starts[places] - ends + n, n) + np.arange(total)], n


def links_of(a: list[int], b: list[int], length_a, length_b) -> list[tuple[int, int]]:
    """All pairs of overlapping tokens of one group."""
    found, i, j = [], 0, 0
    end_a, end_b = length_a[a[0]], length_b[b[0]]
    while True:
        found.append((a[i], b[j]))
        if end_a == end_b:
            return found
        if end_a < end_b:
            i += 1
            end_a += length_a[a[i]]
        else:
            j += 1
            end_b += length_b[b[j]]


class PiecesAlone:
    """Ids in B of many units, each as if it stood alone after its space.

    Words without white space are joined by spaces: each begins with a piece that has a space,
    and no other piece of it has one.
    """

    def __init__(self, processor):
        self._processor = processor
        pieces = (processor.id_to_piece(i) for i in range(processor.vocab_size()))
        self._begins = np.array([p.startswith("▁") for p in pieces])
        self._space = [processor.piece_to_id("▁")]

    def __call__(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all ``units`` on end, number of each)."""
        is_word = np.fromiter((bool(_WORD.fullmatch(u)) for u in units), bool, len(units))
        words = [u for u, good in zip(units, is_word.tolist(), strict=True) if good]
        lots = [" ".join(words[a : a + LOT]) for a in range(0, len(words), LOT)]
        joined = np.array([i for x in self._processor.encode(lots, num_threads=1) for i in x], np.int64)
        starts = np.flatnonzero(self._begins[joined])
        if len(starts) != len(words):
            raise ValueError("the pieces do not begin each word with a space")
        others = [u for u, good in zip(units, is_word.tolist(), strict=True) if not good]
        coded = self._processor.encode(others, num_threads=1) if others else []
        coded = [ids if unit else self._space for ids, unit in zip(coded, others, strict=True)]
        lengths = np.zeros(len(units), np.int64)
        lengths[is_word] = np.diff(np.append(starts, len(joined)))
        lengths[~is_word] = [len(ids) for ids in coded]
        ids = np.zeros(int(lengths.sum()), np.int64)
        of_word = np.repeat(is_word, lengths)
        ids[of_word] = joined
        ids[~of_word] = [i for x in coded for i in x]
        return ids, lengths


class Aligner:
    """Units of text with their groups, kept between batches; the rare half goes when it is full."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        a = Tokenizer.from_file(path_a)
        a.encode_special_tokens = True
        b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self._each_a, self._each_b = EachAlone(a), PiecesAlone(b)
        self.bytes_a, self.bytes_b = token_bytes_a(a), token_bytes_b(b)
        self._length_a = [len(x or b"") for x in self.bytes_a]
        self._length_b = [len(x or b"") for x in self.bytes_b]
        self._lengths_a, self._lengths_b = np.array(self._length_a), np.array(self._length_b)
        self.size_a, self.size_b = len(self.bytes_a), len(self.bytes_b)
        pieces = (b.id_to_piece(i) for i in range(self.size_b))
        self._cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        self.identity = self._identity(b)
        self.units, self.uses = _Units(), np.zeros(0, np.int64)
        self._empty_groups()
        self._empty_units()

    def _identity(self, b) -> np.ndarray:
        """The B id with the bytes of each A id, or -1; whole pieces go before single bytes."""
        by_bytes: dict[bytes, int] = {}
        for i in sorted(range(self.size_b), key=b.is_byte, reverse=True):
            if self.bytes_b[i] is not None:
                by_bytes[self.bytes_b[i]] = i
        return np.array([by_bytes.get(x, -1) for x in self.bytes_a], np.int64)

    def _empty_groups(self) -> None:
        self.group_places: dict[str, int] = {}
        self.group_names: list[str] = []
        self.group_pairs: list[list[int]] = []

    def _empty_units(self) -> None:
        self.parts: list[str] = []  # the groups of each unit as text
        self.numbers = np.zeros((0, 5), np.int64)  # n_a, n_b, n_groups, n_links, spelt otherwise
        self.regular, self.irregular = Flat(), Flat()

    def trim(self) -> None:
        """Keep the more frequent half of the units if there are too many; call between tasks.

        Groups are numbered anew, as those of dropped units go too.
        """
        if len(self.units) <= MAX_UNITS:
            return
        kept = np.argsort(-self.uses, kind="stable")[: MAX_UNITS // 2]
        names, parts, numbers, uses = list(self.units), self.parts, self.numbers[kept], self.uses[kept]
        regular, irregular = self.regular.of(kept), self.irregular.of(kept)
        group_names, group_pairs = self.group_names, self.group_pairs
        self.units = _Units()
        self._empty_groups()
        self._empty_units()
        for i in kept.tolist():
            self.units[names[i]]
        self.units.new.clear()
        groups, again = np.unique(irregular[0], return_inverse=True)
        self.group_names = [group_names[g] for g in groups.tolist()]
        self.group_pairs = [group_pairs[g] for g in groups.tolist()]
        self.group_places = {name: i for i, name in enumerate(self.group_names)}
        self.parts = [parts[i] for i in kept.tolist()]
        self.numbers, self.uses = numbers, uses // 2
        self.regular.add(*regular)
        self.irregular.add(again.astype(np.int64), irregular[1])

    def units_of(self, text: str) -> list[str]:
        """The units of space + text, each without its first space."""
        if not self._cuts:
            return [text]
        if _SPACE_AFTER_SPACE.search(text):
            return [unit[1:] for unit in _CUT.split(" " + text)]
        return text.split(" ")

    def learn(self) -> None:
        new, self.units.new = self.units.new, []
        for at in range(0, len(new), LEARN):
            some = new[at : at + LEARN]
            ids_a, n_a = self._each_a([" " + u for u in some])
            ids_b, n_b = self._each_b(some)
            spelt = self._spelt(some, ids_a, n_a, ids_b, n_b)
            if not spelt.all():
                ids_a, ids_b = ids_a[np.repeat(spelt, n_a)], ids_b[np.repeat(spelt, n_b)]
                n_a, n_b = np.where(spelt, n_a, 0), np.where(spelt, n_b, 0)
            self._note(spelt, ids_a.astype(np.int64), n_a, ids_b, n_b)
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])

    def _spelt(self, units, ids_a, n_a, ids_b, n_b) -> np.ndarray:
        """Whether the tokens of each unit spell it, on both sides."""
        want = [(" " + u).encode() for u in units]
        sizes = np.array([len(w) for w in want])
        good = np.ones(len(units), bool)
        for ids, n, names, lengths in (
            (ids_a, n_a, self.bytes_a, self._lengths_a),
            (ids_b, n_b, self.bytes_b, self._lengths_b),
        ):
            have = [names[i] or b"" for i in ids.tolist()]
            ends = np.concatenate([[0], np.cumsum(n)])
            sums = np.concatenate([[0], np.cumsum(lengths[ids])])
            if (np.diff(sums[ends]) == sizes).all() and b"".join(have) == b"".join(want):
                continue
            cuts = ends.tolist()
            good &= np.array([b"".join(have[a:b]) == w for a, b, w in zip(cuts, cuts[1:], want)])
        return good

    def _note(self, spelt, ids_a, n_a, ids_b, n_b) -> None:
        """Cut the tokens of some units into groups, all at once; units end groups, too."""
        end_a, end_b = np.cumsum(self._lengths_a[ids_a]), np.cumsum(self._lengths_b[ids_b])
        at_b = np.searchsorted(end_b, end_a)
        last_a = np.flatnonzero(end_b[at_b] == end_a) if len(end_a) else np.empty(0, np.int64)
        last_b = at_b[last_a]
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        unit = np.searchsorted(np.cumsum(n_a), last_a, "right")
        one = (size_a == 1) & (size_b == 1)
        regular = one & (self.identity[ids_a[last_a]] == ids_b[last_b])
        flat_a, flat_b = ids_a.tolist(), ids_b.tolist()
        names = [f"{flat_a[i]}|{flat_b[j]}" for i, j in zip(last_a.tolist(), last_b.tolist(), strict=True)]
        others = np.zeros(len(names), np.int64)
        for g in np.flatnonzero(~regular).tolist():
            i, j = int(last_a[g]) + 1, int(last_b[g]) + 1
            a, b = flat_a[i - int(size_a[g]) : i], flat_b[j - int(size_b[g]) : j]
            if not one[g]:
                names[g] = f"{','.join(map(str, a))}|{','.join(map(str, b))}"
            others[g] = self._group(names[g], a, b)
        units = len(spelt)
        counts = np.bincount(unit, minlength=units)
        links = np.bincount(unit, weights=size_a + size_b - 1, minlength=units).astype(np.int64)
        columns = [n_a, n_b, counts, links, (~spelt).astype(np.int64)]
        self.numbers = np.concatenate([self.numbers, np.stack(columns, axis=1).astype(np.int64)])
        cuts = np.concatenate([[0], np.cumsum(counts)]).tolist()
        self.parts += [";".join(names[a:b]) for a, b in zip(cuts, cuts[1:])]
        self.regular.add(ids_a[last_a[regular]], np.bincount(unit[regular], minlength=units))
        self.irregular.add(others[~regular], np.bincount(unit[~regular], minlength=units))

    def _group(self, name: str, a: list[int], b: list[int]) -> int:
        place = self.group_places.get(name)
        if place is None:
            place = self.group_places[name] = len(self.group_names)
            self.group_names.append(name)
            links = links_of(a, b, self._length_a, self._length_b)
            self.group_pairs.append([x * self.size_b + y for x, y in links])
        return place


@functools.cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's one aligner for the two files."""
    return Aligner(path_a, path_b)


def _lists(of: np.ndarray, values: np.ndarray, rows: int, span: int) -> tuple[np.ndarray, ...]:
    """Distinct values of each row: (offsets, values, how often each)."""
    codes, counts = np.unique(of * span + values, return_counts=True)
    ends = np.searchsorted(codes, np.arange(rows + 1) * span)
    return ends.astype(np.int32), codes % span, counts.astype(np.int32)


def _records(size: int, kind: int, **columns) -> pa.RecordBatch:
    """A batch of ``ALIGNED`` with nulls in the columns that are not named."""
    arrays = [columns.get(f.name, pa.nulls(size, f.type)) for f in _SCHEMA]
    arrays[0] = pa.array(np.full(size, kind, np.int32))
    return pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64())]
    + [(name, pa.int64()) for name in DIGEST]
    + [("groups_sha256", pa.string())]
    + [("ids", pa.list_(pa.int32())), ("ids_n", pa.list_(pa.int32()))]
    + [("groups", pa.list_(pa.string())), ("groups_n", pa.list_(pa.int32()))]
    + [("pairs", pa.list_(pa.int64())), ("n", pa.int64())]
)


def _documents(held: Aligner, rows: pa.Array, keys: pa.Array, texts: list, totals: list) -> pa.RecordBatch:
    """The rows of some texts; their groups are added to ``totals`` (regular, irregular)."""
    n = len(texts)
    units: list[str] = []
    counts = np.zeros(n, np.int64)
    for i, text in enumerate(texts):
        if text:
            own = held.units_of(text)
            counts[i] = len(own)
            units += own
    places = np.fromiter(map(held.units.__getitem__, units), np.int64, len(units))
    if held.units.new:
        held.learn()
    held.uses += np.bincount(places, minlength=len(held.uses))
    of = np.repeat(np.arange(n), counts)
    numbers = np.zeros((n, 5), np.int64)
    np.add.at(numbers, of, held.numbers[places])
    good = (counts > 0) & (numbers[:, 4] == 0)
    numbers[~good] = 0
    places, of = places[good[of]], of[good[of]]
    counts = np.where(good, counts, 0)
    ends = np.concatenate([[0], np.cumsum(counts)])
    flat = places.tolist()
    names = held.parts
    hashes = [
        hashlib.sha256(";".join([names[p] for p in flat[ends[i] : ends[i + 1]]]).encode()).hexdigest()
        if good[i]
        else ""
        for i in range(n)
    ]
    ids, each = held.regular.of(places)
    totals[0] += np.bincount(ids, minlength=held.size_a)
    id_ends, id_values, id_counts = _lists(np.repeat(of, each), ids, n, held.size_a)
    found, each = held.irregular.of(places)
    more = len(held.group_names) - len(totals[1])
    totals[1] = np.concatenate([totals[1], np.zeros(more, np.int64)])
    totals[1] += np.bincount(found, minlength=len(totals[1]))
    span = max(1, len(held.group_names))
    group_ends, group_values, group_counts = _lists(np.repeat(of, each), found, n, span)
    listed = pa.array([held.group_names[g] for g in group_values.tolist()], pa.string())
    return _records(
        n,
        DOC,
        row=rows,
        doc_id=keys,
        **{name: pa.array(numbers[:, i]) for i, name in enumerate(DIGEST)},
        groups_sha256=pa.array(hashes, pa.string()),
        ids=pa.ListArray.from_arrays(id_ends, pa.array(id_values.astype(np.int32))),
        ids_n=pa.ListArray.from_arrays(id_ends, pa.array(id_counts)),
        groups=pa.ListArray.from_arrays(group_ends, listed),
        groups_n=pa.ListArray.from_arrays(group_ends, pa.array(group_counts)),
    )


def _counted(held: Aligner, totals: list) -> Iterator[pa.RecordBatch]:
    """What a task has counted: regular groups by A id, irregular ones by their ids."""
    ids = np.flatnonzero(totals[0])
    pairs = ids * held.size_b + held.identity[ids]
    ends = np.arange(len(ids) + 1, dtype=np.int32)
    yield _records(
        len(ids),
        REGULAR,
        pairs=pa.ListArray.from_arrays(ends, pa.array(pairs, pa.int64())),
        n=pa.array(totals[0][ids], pa.int64()),
    )
    found = np.flatnonzero(totals[1])
    for a in range(0, len(found), LEARN):
        some = found[a : a + LEARN].tolist()
        ends = np.arange(len(some) + 1, dtype=np.int32)
        names = pa.array([held.group_names[g] for g in some], pa.string())
        yield _records(
            len(some),
            GROUP,
            groups=pa.ListArray.from_arrays(ends, names),
            pairs=pa.array([held.group_pairs[g] for g in some], pa.list_(pa.int64())),
            n=pa.array(totals[1][some], pa.int64()),
        )


def _align(path_a: str, path_b: str):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = aligner(path_a, path_b)
        nothing = lambda: [np.zeros(held.size_a, np.int64), np.zeros(0, np.int64)]
        totals = nothing()
        for batch in batches:
            offsets = text_bytes(batch.column(2))[1]
            for a, b in slices(offsets, SLICE_BYTES):
                part = batch.slice(a, b - a)
                yield _documents(held, part.column(0), part.column(1), part.column(2).to_pylist(), totals)
                if len(held.units) > MAX_UNITS:
                    yield from _counted(held, totals)
                    totals = nothing()
                    held.trim()
        yield from _counted(held, totals)

    return kernel


def aligned(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of all texts, and of all groups that the tasks have counted, by ``kind``."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")
    )
    return stored(map_arrow(rows, _align(path_a, path_b), ALIGNED))


def irregular_groups(found: DataFrame) -> DataFrame:
    """(group, pairs, n) of every irregular group of all texts; pairs are A id * |B| + B id."""
    sent = found.filter(F.col("kind") == GROUP).select(F.get("groups", F.lit(0)).alias("group"), "pairs", "n")
    return sent.groupBy("group").agg(F.any_value("pairs").alias("pairs"), F.sum("n").alias("n"))


def pair_counts(found: DataFrame, groups: DataFrame, size_b: int) -> DataFrame:
    """(pair, links, best) of every linked pair of ids; ``best`` if no A id has more with its B id."""
    regular = found.filter(F.col("kind") == REGULAR).select(F.get("pairs", F.lit(0)).alias("pair"), "n")
    irregular = groups.select(F.explode("pairs").alias("pair"), "n")
    counts = stored(regular.unionByName(irregular).groupBy("pair").agg(F.sum("n").alias("links")))
    counts = counts.withColumn("b", F.col("pair") % size_b)
    highest = counts.groupBy("b").agg(F.max("links").alias("highest"))  # as long as B's vocabulary
    joined = counts.join(F.broadcast(highest), "b")
    return joined.select("pair", "links", (F.col("links") == F.col("highest")).cast("long").alias("best"))


def _score(links: np.ndarray, best: np.ndarray):
    """Sums over the regular groups of each text, from vectors as long as A's vocabulary."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, times = batch.column("ids"), batch.column("ids_n")
            of = np.repeat(np.arange(batch.num_rows), np.diff(ids.offsets.to_numpy()))
            at, n = ids.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            for held, vector in zip(sums, (links, best), strict=True):
                np.add.at(held, of, vector[at] * n)
            columns = {name: batch.column(name) for name in ("row", "doc_id", *DIGEST, "groups_sha256")}
            yield pa.RecordBatch.from_pydict(
                columns | {"regular_sum": pa.array(sums[0]), "regular_best": pa.array(sums[1])}
            )

    return kernel


def alignment(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    ship(docs.sparkSession)
    held = aligner(path_a, path_b)
    found = aligned(docs, path_a, path_b, key, text)
    groups = stored(irregular_groups(found))
    pairs = stored(pair_counts(found, groups, held.size_b))
    links, best = np.zeros(held.size_a, np.int64), np.zeros(held.size_a, np.int64)
    regular = found.filter(F.col("kind") == REGULAR).select(F.get("pairs", F.lit(0)).alias("pair"))
    for pair, n, top in pairs.join(regular.distinct(), "pair").toLocalIterator():  # A's vocabulary at most
        links[pair // held.size_b], best[pair // held.size_b] = n, top
    texts = found.filter(F.col("kind") == DOC)
    scored = map_arrow(
        texts.select("row", "doc_id", *DIGEST, "groups_sha256", "ids", "ids_n"),
        _score(links, best),
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string, regular_sum long, regular_best long",
    )
    of_group = groups.select("group", "n", F.explode("pairs").alias("pair")).join(pairs, "pair")
    values = of_group.groupBy("group").agg(
        F.sum("links").alias("group_sum"), F.sum("best").alias("group_best"), F.max("n").alias("n")
    )
    listed = texts.select("row", F.explode(F.arrays_zip("groups", "groups_n")).alias("entry"))
    listed = listed.select("row", F.col("entry.groups").alias("group"), F.col("entry.groups_n").alias("times"))
    sums = join_lookup(listed, values, "group", "n").groupBy("row").agg(
        F.sum(F.col("group_sum") * F.col("times")).alias("other_sum"),
        F.sum(F.col("group_best") * F.col("times")).alias("other_best"),
    )
    total = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).cast("long")
    return scored.join(sums, "row", "left").select(
        "doc_id",
        *DIGEST,
        total("regular_best", "other_best").alias("n_best"),
        total("regular_sum", "other_sum").alias("count_sum"),
        "groups_sha256",
    )
