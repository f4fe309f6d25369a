"""Token ids as compressed files of wavelet matrices.

Rows are dealt by ranges of the key, so each task tokenizes and writes its own
stretch of documents: one Parquet file per range, one row (shard) per stretch of
about ``SHARD_TOKENS`` ids, with its bit planes, their ranks and the documents in
it. Texts are shuffled once; ids never. The place of a shard among all ids comes
from the sums of the ranges.

Null texts and empty texts have the end id alone. Rows with equal keys stay apart,
in any order among themselves; null keys come first. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from answerclock.llm.batches import slices, text_bytes
from answerclock.llm.cluster import map_arrow, ship
from answerclock.llm.encoding import encoder
from answerclock.llm.wavelet import Plane, WaveletMatrix
from answerclock.operators.storage import delete_at_exit, shared_folder

SHARD_TOKENS = 1 << 20
SLICE_BYTES = 1 << 20

SHARD = pa.schema(
    [
        ("part", pa.int32()),
        ("seq", pa.int32()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_tokens", pa.list_(pa.int64())),
        ("bits", pa.list_(pa.binary())),
        ("ones_before", pa.list_(pa.binary())),
    ]
)
SHARD_DDL = (
    "part int, seq int, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
    "bits array<binary>, ones_before array<binary>"
)


def _shard(part: int, seq: int, keys: list, lengths: list, ids: list, levels: int):
    matrix = WaveletMatrix.of(np.concatenate(ids), levels)
    row = {
        "part": part,
        "seq": seq,
        "n_tokens": len(matrix),
        "doc_ids": keys,
        "doc_tokens": [int(n) for n in lengths],
        "bits": [plane.bits.tobytes() for plane in matrix.planes],
        "ones_before": [plane.ones_before.tobytes() for plane in matrix.planes],
    }
    return pa.RecordBatch.from_pylist([row], SHARD)


def _writer(path: str, end_id: int, shard_tokens: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        levels = max(coder.size - 1, end_id, 1).bit_length()
        kind = np.uint16 if levels <= 16 else np.uint32
        part, seq = TaskContext.get().partitionId(), 0
        keys, lengths, ids, held = [], [], [], 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in slices(offsets, min(SLICE_BYTES, shard_tokens)):
                base = int(offsets[a])
                own_data = data[base : int(offsets[b])]
                own, counts = coder.encode_bytes(own_data, offsets[a : b + 1] - base)
                own = np.insert(own.astype(kind), np.cumsum(counts), end_id)
                keys += batch.column(0)[a:b].to_pylist()
                lengths += (counts + 1).tolist()
                ids.append(own)
                held += len(own)
                if held >= shard_tokens:
                    yield _shard(part, seq, keys, lengths, ids, levels)
                    keys, lengths, ids, held, seq = [], [], [], 0, seq + 1
        if held:
            yield _shard(part, seq, keys, lengths, ids, levels)

    return kernel


def write_shards(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode ``docs`` and write their ids to ``folder`` in ascending order of ``key``."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # Rows with one key or none may be very many: their place in the scan deals them out.
    placed = rows.withColumn("place", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")
    ordered = ordered.select("doc_id", "text")
    shards = map_arrow(ordered, _writer(tokenizer_path, end_id, shard_tokens), SHARD_DDL)
    shards.write.option("compression", "zstd").parquet(folder)


def read_shards(spark, folder: str) -> DataFrame:
    return spark.read.schema(SHARD_DDL).parquet(folder)


def matrix_of(row) -> WaveletMatrix:
    """The wavelet matrix of one shard (a dict or Row with the columns of a shard)."""
    return WaveletMatrix(
        [
            Plane(row["n_tokens"], np.frombuffer(bits, np.uint8), np.frombuffer(ones, np.uint32))
            for bits, ones in zip(row["bits"], row["ones_before"], strict=True)
        ]
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        ids = matrix_of(row).ids().astype("<u4")
        ends = np.cumsum(row["doc_tokens"])
        starts = ends - row["doc_tokens"]
        crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)]
        n = len(crc)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, row["part"], np.int32)),
                pa.array(np.full(n, row["seq"], np.int32)),
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(starts, pa.int64()),
                pa.array(row["doc_tokens"], pa.int64()),
                pa.array(crc, pa.int64()),
            ],
            ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"],
        )


def document_digests(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    decoded = map_arrow(
        shards,
        _documents,
        "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long",
    )
    sizes = shards.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    before = parts.select(
        "part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("before_part")
    )
    own = Window.partitionBy("part").orderBy("seq")
    places = sizes.select(
        "part", "seq", (F.sum("n_tokens").over(own) - F.col("n_tokens")).alias("before_shard")
    ).join(before, "part")
    joined = decoded.join(places, ["part", "seq"])
    start = F.col("before_part") + F.col("before_shard") + F.col("at")
    return joined.select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def _lookup(token: int, places: bool):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            matrix = matrix_of(row)
            found = matrix.occurrences(token) if places else [matrix.count(token)]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([row["part"]] * len(found), pa.int32()),
                    "seq": pa.array([row["seq"]] * len(found), pa.int32()),
                    "value": pa.array(found, pa.int64()),
                }
            )

    return kernel


def count_token(shards: DataFrame, token: int) -> DataFrame:
    """(part, seq, value): how often ``token`` occurs in each shard, without decoding it."""
    return map_arrow(shards, _lookup(token, False), "part int, seq int, value long")


def locate_token(shards: DataFrame, token: int) -> DataFrame:
    """(part, seq, value): the positions of ``token`` in each shard, without decoding it."""
    return map_arrow(shards, _lookup(token, True), "part int, seq int, value long")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write ``docs`` to a new shared folder and return the digests read back from it."""
    spark = docs.sparkSession
    ship(spark)
    folder = shared_folder(spark)
    write_shards(docs, folder, tokenizer_path, end_id)
    delete_at_exit(spark, folder)
    return document_digests(read_shards(spark, folder))
