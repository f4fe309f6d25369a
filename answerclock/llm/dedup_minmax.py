"""Near-duplicate documents by min-max hashing.

1. Every document becomes the set of its distinct five-word shingles (64-bit hashes).
   Under each permutation both the least and the greatest value are kept, so a
   signature of ``2 * PERMUTATIONS`` values costs ``PERMUTATIONS`` hash evaluations.
   ``BANDS`` bands of ``ROWS`` values each: a pair at similarity 0.85 shares none
   with a probability of 6e-9, one at 0.8 with 5e-6.
2. Documents with equal sets become one node, however many they are.
3. In every bucket the least node is the centre. Each (centre, member) pair is checked
   on full sets; linked ones form components.
4. Where a bucket still holds several components, every pair across them is checked
   on full sets, in blocks of bounded size that only meet one another (counts of common
   shingles come from products of 0/1 matrices). So no link is lost, and copies and
   dense groups are never expanded into pairs of rows.

Shingles are compared by hash: two different ones are taken for equal with a
probability of 2**-64. A document of fewer words is one shingle; null and empty
texts have an empty set and stand alone. Repeated rows and equal keys are allowed, a
null key forms no smallest one unless all are null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerclock.llm.batches import WindowHasher, mixed, per_text, slices, text_bytes
from answerclock.llm.cluster import map_arrow, unused
from answerclock.llm.components import components
from answerclock.operators.storage import stored

SHINGLE_WORDS = 5
ROWS = 6
BANDS = 40
PERMUTATIONS = ROWS * BANDS // 2
LEAST_PERCENT = 85

SLICE_BYTES = 1 << 20
BLOCK_NODES = 1024
STAR_NODES = 256  # of a block that meets one node only
BLOCK_SHINGLES = 1 << 20
MATRIX_COLUMNS = 2048

FEATURES = (
    "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, row long"
)
_rng = np.random.default_rng(20240229)
_FACTORS = _rng.integers(1, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, PERMUTATIONS, np.uint64)
_BAND_FACTORS = _rng.integers(1, 1 << 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_MARKS = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))


def shingle_sets(hasher: WindowHasher, data: np.ndarray, offsets: np.ndarray):
    """(distinct shingles of all texts on end, where each text's begin), ascending in each text."""
    words, _, _, first = hasher.words(data, offsets)
    at, hashes = hasher.windows(words, first, short=True)
    cuts = per_text(at, first)
    sets = [np.unique(hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in sets], dtype=np.int64)])
    return (np.concatenate(sets) if sets else hashes), starts


def set_digests(shingles: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set: equal sets have equal ones."""
    sums = []
    for mark in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        upto = np.zeros(len(shingles) + 1, np.uint64)
        np.cumsum(mixed(shingles ^ np.uint64(mark)), out=upto[1:])
        sums.append((upto[starts[1:]] - upto[starts[:-1]]).view(np.int64))
    return sums[0], sums[1]


def signatures(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Least and greatest value of every (not empty) set under every permutation."""
    out = np.empty((2 * PERMUTATIONS, len(starts)), np.uint64)
    for i in range(PERMUTATIONS):
        values = shingles * _FACTORS[i] + _SHIFTS[i]
        np.minimum.reduceat(values, starts, out=out[2 * i])
        np.maximum.reduceat(values, starts, out=out[2 * i + 1])
    return out


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """(sets, BANDS): one 64-bit hash of each band, different between bands."""
    rows = signature.reshape(BANDS, ROWS, -1)
    sums = (rows * _BAND_FACTORS[:, :, None]).sum(1, dtype=np.uint64) + _BAND_MARKS[:, None]
    return mixed(sums).T.view(np.int64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WindowHasher(SHINGLE_WORDS, lower=True)
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        for a, b in slices(offsets, SLICE_BYTES):
            own = offsets[a : b + 1] - offsets[a]
            shingles, starts = shingle_sets(hasher, data[offsets[a] : offsets[b]], own)
            sizes = np.diff(starts)
            full = sizes > 0
            ends = np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)
            bands = np.empty(0, np.int64)
            if full.any():
                bands = band_hashes(signatures(shingles, starts[:-1][full])).ravel()
            set_a, set_b = set_digests(shingles, starts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[a:b],
                    pa.array(sizes, pa.int64()),
                    pa.array(set_a),
                    pa.array(set_b),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(bands)),
                    batch.column(2)[a:b],
                ],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands", "row"],
            )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed before they are shuffled."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        raw = memoryview(np.ascontiguousarray(data))
        packed = [press.compress(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(2), pa.array(packed, pa.binary())], ["row", "packed"]
        )


def _matrix(sets: list[np.ndarray], vocabulary: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(vocabulary)), np.float32)
    for i, one in enumerate(sets):
        at = np.searchsorted(vocabulary, one)
        at[at == len(vocabulary)] = 0
        out[i, at[vocabulary[at] == one]] = 1
    return out


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of every set in ``left`` with every one in ``right``."""
    both = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)))
    counts = np.zeros((len(left), len(right)), np.float32)
    for a in range(0, len(both), MATRIX_COLUMNS):
        part = both[a : a + MATRIX_COLUMNS]
        inside = [[x[np.searchsorted(x, part[0]) : np.searchsorted(x, part[-1], "right")]
                   for x in side] for side in (left, right)]
        counts += _matrix(inside[0], part) @ _matrix(inside[1], part).T
    return counts.astype(np.int64)


LINKS = "a long, b long"


def _checked(table: pa.Table, least_percent: int) -> pa.Table:
    """Links between the ``x`` and the others of one block, one for each component linked."""
    hasher = WindowHasher(SHINGLE_WORDS, lower=True)
    unpack = zstandard.ZstdDecompressor()
    sets, seen = {}, {}
    for node, packed, a, b in zip(
        *(table[c].to_pylist() for c in ("node", "packed", "set_a", "set_b")), strict=True
    ):
        if node not in sets:
            data = np.frombuffer(unpack.decompress(packed), np.uint8)
            shingles, starts = shingle_sets(hasher, data, np.array([0, len(data)]))
            own_a, own_b = set_digests(shingles, starts)
            if (own_a[0], own_b[0]) != (a, b):
                raise ValueError("a text is not the one that its node was made of")
            sets[node] = shingles
    for node, root, x in zip(*(table[c].to_pylist() for c in ("node", "root", "x")), strict=True):
        if node in sets:
            seen[(node, x)] = root
    left = [node for node, x in seen if x]
    right = [node for node, x in seen if not x]
    found_a, found_b = [], []
    if left and right:
        common = common_counts([sets[n] for n in left], [sets[n] for n in right])
        sizes = [np.array([len(sets[n]) for n in side]) for side in (left, right)]
        union = sizes[0][:, None] + sizes[1][None, :] - common
        roots = np.array([seen[(n, False)] for n in right])
        for i, row in enumerate(100 * common >= least_percent * union):
            for j in np.flatnonzero(row)[np.unique(roots[row], return_index=True)[1]]:
                if left[i] != right[j]:
                    found_a.append(left[i])
                    found_b.append(right[j])
    return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})


def _blocks(nodes: str, shingles: str, others: str):
    """Number of blocks that keeps each within the bounds on nodes and shingles."""
    most = F.when(F.col(others) == 1, STAR_NODES).otherwise(BLOCK_NODES)
    return F.ceil(
        F.greatest(F.col(nodes) / most, F.col(shingles) / BLOCK_SHINGLES, F.lit(1))
    ).cast("int")


def verified_links(tasks: DataFrame, nodes: DataFrame, least_percent: int) -> DataFrame:
    """Exact links (a, b) between the two sides of every group of ``tasks``.

    ``tasks``: (anchor, node, root, x, n_shingles); ``x`` tells the side. Both sides of an
    anchor are cut into blocks, and every pair of blocks is one group of bounded size.
    """
    size = F.sum(F.when(F.col("x"), F.col("n_shingles")).otherwise(0)).alias("x_shingles")
    rest = F.sum(F.when(F.col("x"), 0).otherwise(F.col("n_shingles"))).alias("k_shingles")
    x_nodes = F.sum(F.col("x").cast("long")).alias("x_nodes")
    k_nodes = F.sum((~F.col("x")).cast("long")).alias("k_nodes")
    sums = tasks.groupBy("anchor").agg(x_nodes, k_nodes, size, rest)
    plan = sums.select(
        "anchor",
        _blocks("x_nodes", "x_shingles", "k_nodes").alias("x_blocks"),
        _blocks("k_nodes", "k_shingles", "x_nodes").alias("k_blocks"),
    ).filter("x_blocks > 1 OR k_blocks > 1")  # few: each of them has a full block
    x_blocks, k_blocks = (F.coalesce(F.col(c), F.lit(1)) for c in ("x_blocks", "k_blocks"))
    own = F.when(F.col("x"), x_blocks).otherwise(k_blocks)
    other = F.when(F.col("x"), k_blocks).otherwise(x_blocks)
    dealt = (
        tasks.join(plan, "anchor", "left")
        .withColumn("own", F.pmod(F.xxhash64("node"), own))
        .withColumn("other", F.explode(F.sequence(F.lit(0), other - 1)))
    )
    block = F.when(F.col("x"), F.struct("own", "other")).otherwise(
        F.struct(F.col("other").cast("long").alias("own"), F.col("own").cast("int").alias("other"))
    )
    placed = dealt.select("anchor", "node", "root", "x", block.alias("block"))
    rows = placed.join(nodes.select("node", "set_a", "set_b", "packed"), "node")
    return rows.groupBy("anchor", "block").applyInArrow(
        lambda table: _checked(table, least_percent), LINKS
    )


def _placed(docs: DataFrame, row: str) -> DataFrame:
    """``docs`` stored with a number for each row, which every later scan finds again."""
    return stored(docs.withColumn(row, F.monotonically_increasing_id()))


def _components_of(source: DataFrame, least_percent: int) -> DataFrame:
    """(doc_id, n_shingles, row, component_id, first_row) of every row of (doc_id, text, row).

    ``first_row`` is the row that stands for its group, null for rows without words. Texts are
    fetched by row, so neither null nor repeated keys meet more than their own.
    """
    features = stored(map_arrow(source, _features, FEATURES))
    digest = ["set_a", "set_b"]
    classes = features.filter("n_shingles > 0").groupBy(*digest).agg(
        F.min("doc_id").alias("first_id"),
        # The least key first, rows without one last.
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("place"),
        F.any_value("n_shingles").alias("n_shingles"),
        F.any_value("bands").alias("bands"),
    )
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()))
    banded = classes.select("node", "n_shingles", F.explode("bands").alias("band"))
    centres = banded.groupBy("band").agg(
        F.min(F.struct("node", F.col("n_shingles").alias("n"))).alias("centre"),
        F.count(F.lit(1)).alias("held"),
    )
    shared = stored(banded.join(centres.filter("held > 1"), "band"))
    pairs = shared.select("node", "n_shingles", "centre.*", "held", "band").toDF(
        "node", "n_shingles", "anchor", "anchor_n", "held", "band"
    )
    fits = F.least("n_shingles", "anchor_n") * 100 >= F.greatest("n_shingles", "anchor_n") * (
        least_percent
    )
    stars = stored(
        pairs.filter(fits & (F.col("node") != F.col("anchor")))
        .select("anchor", "anchor_n", "node", "n_shingles")
        .distinct()
    )
    needed = pairs.filter("held > 2").select("node").union(
        stars.select("node").union(stars.select("anchor"))
    )
    wanted = classes.select("node", *digest, "place.row").join(needed.distinct(), "node")
    packed = map_arrow(source, _packed, "row long, packed binary")
    fetched = stored(wanted.join(packed, "row"))
    members = stars.select(
        "anchor", "node", F.col("node").alias("root"), F.lit(True).alias("x"), "n_shingles"
    )
    hubs = stars.select(
        "anchor",
        F.col("anchor").alias("node"),
        F.col("anchor").alias("root"),
        F.lit(False).alias("x"),
        F.col("anchor_n").alias("n_shingles"),
    ).distinct()
    found = stored(verified_links(members.unionByName(hubs), fetched, least_percent))
    roots = stored(components(found))
    more = stored(verified_links(_open_tasks(shared, roots), fetched, least_percent))
    if not more.isEmpty():
        roots = stored(components(_contracted(more, roots).unionByName(_tree(roots))))
    return _labelled(features, classes, roots)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_percent: int = LEAST_PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    Texts are linked from a similarity of ``least_percent`` on.
    """
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = _components_of(_placed(source, "row"), least_percent)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return found.select("doc_id", "n_shingles", "component_id", kept)


def deduplicated(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_percent: int = LEAST_PERCENT
) -> DataFrame:
    """One row of ``docs``, all columns, of each group: the one with the smallest key.

    Rows are told apart by their place, so of several with the smallest key, or of a group
    without any key, one stays too. Of rows without words those with other keys or texts stay.
    """
    row = unused(docs, "_dedup_row")
    placed = _placed(docs, row)
    source = placed.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(row).alias("row")
    )
    found = _components_of(source, least_percent)
    chosen = found.filter("row = first_row").select("row")
    empty = found.filter("first_row IS NULL").select("row", "doc_id").join(
        source.select("row", F.col("text").alias("_text")), "row"
    )
    without = empty.groupBy("doc_id", "_text").agg(F.min("row").alias("row")).select("row")
    kept = chosen.unionByName(without).toDF(row)
    return placed.join(kept, row, "left_semi").select(*docs.columns)


def _tree(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).filter("a <> b")


def _rooted(rows: DataFrame, roots: DataFrame, column: str = "node") -> DataFrame:
    """``rows`` with ``root``, the node itself where it has no link."""
    named = roots.select(F.col("node").alias(column), F.col("root").alias("found"))
    joined = rows.join(named, column, "left")
    return joined.withColumn("root", F.coalesce("found", column)).drop("found")


def _contracted(links: DataFrame, roots: DataFrame) -> DataFrame:
    ends = _rooted(links, roots, "a").withColumnRenamed("root", "root_a")
    return _rooted(ends, roots, "b").select(F.col("root_a").alias("a"), F.col("root").alias("b"))


def _open_tasks(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Groups for the pairs across components: buckets of three or more with several of them.

    The component with most nodes in a bucket is its anchor. Its nodes and all others in
    such buckets make one side, the others alone the other side.
    """
    placed = _rooted(shared.filter("held > 2").select("band", "node", "n_shingles"), roots)
    counts = placed.groupBy("band", "root").agg(F.count(F.lit(1)).alias("nodes"))
    buckets = counts.groupBy("band").agg(
        F.max(F.struct("nodes", "root")).getField("root").alias("anchor"),
        F.count(F.lit(1)).alias("parts"),
    )
    inside = placed.join(buckets.filter("parts > 1").drop("parts"), "band")
    rows = inside.select("anchor", "node", "root", "n_shingles").distinct()
    others = rows.filter("root <> anchor")
    return rows.withColumn("x", F.lit(False)).unionByName(others.withColumn("x", F.lit(True)))


def _labelled(features: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    owned = _rooted(classes.select("node", "set_a", "set_b", "first_id", "place"), roots)
    least = owned.groupBy("root").agg(
        F.min("first_id").alias("component_id"), F.min("place").getField("row").alias("first_row")
    )
    named = owned.join(least, "root").select("set_a", "set_b", "component_id", "first_row")
    joined = features.drop("bands").join(named, ["set_a", "set_b"], "left")
    empty = F.col("n_shingles") == 0
    return joined.select(
        "doc_id",
        "n_shingles",
        "row",
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(~empty, F.col("first_row")).alias("first_row"),
    )
