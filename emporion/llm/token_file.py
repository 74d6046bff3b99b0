"""Token-id files with shuffled planes.

Documents are put in ascending ``doc_id`` order by a range shuffle, encoded,
and their ids go into segments of whole documents.  A segment's ids are cut
into blocks of ``block_ids``; each block's little-endian 32-bit ids are
transposed into byte planes (or bit planes), each plane is compressed with
zstandard, and the segment stores the index of its chunks and documents.

One Parquet row is one segment, so writing and reading need nothing but Spark's
shared storage:

======================  =====================================================
shard, segment          part of the order, running number inside the part
first_id, n_ids         place of the first id inside the shard, ids held
doc_ids, doc_tokens     the documents in order, and their number of ids
block_ids, plane_sizes  ids per block; compressed size of each plane, flattened
payload                 the compressed planes, block after block
======================  =====================================================

Defined results: a null text is empty (only the end id); a null ``doc_id`` comes
first; rows with equal ``doc_id`` are ordered by text and each kept; an empty
table gives no segment; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tokens import encode

SEGMENT_SCHEMA = ("shard int, segment long, first_id long, n_ids long, doc_ids array<long>, doc_tokens array<long>, "
                  "block_ids int, plane_sizes array<int>, payload binary")
_ARROW = pa.schema([("shard", pa.int32()), ("segment", pa.int64()), ("first_id", pa.int64()), ("n_ids", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("block_ids", pa.int32()),
                    ("plane_sizes", pa.list_(pa.int32())), ("payload", pa.binary())])


def to_planes(ids: np.ndarray, plane: str) -> list[bytes]:
    """The byte (4) or bit (32) planes of a block, plane 0 the lowest."""
    cells = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if plane == "byte":
        return [x.tobytes() for x in np.ascontiguousarray(cells.T)]
    bits = np.unpackbits(cells, axis=1, bitorder="little")
    return [x.tobytes() for x in np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    rows = np.stack([np.frombuffer(p, dtype=np.uint8) for p in planes])
    if len(planes) == 4:
        return np.ascontiguousarray(rows.T).view("<u4").reshape(-1)
    bits = np.unpackbits(rows, axis=1, bitorder="little")[:, :n]
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u4").reshape(-1)


def pack_segment(ids: np.ndarray, block_ids: int, plane: str, level: int) -> tuple[list[int], bytes]:
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=level)
    parts = [squeeze.compress(p) for i in range(0, len(ids), block_ids) for p in to_planes(ids[i:i + block_ids], plane)]
    return [len(p) for p in parts], b"".join(parts)


def unpack_segment(n_ids: int, block_ids: int, sizes: list[int], payload: bytes) -> np.ndarray:
    import zstandard

    if not n_ids:
        return np.zeros(0, dtype="<u4")
    open_, out, at = zstandard.ZstdDecompressor(), [], 0
    n_blocks = -(-n_ids // block_ids)
    n_planes = len(sizes) // n_blocks
    for b in range(n_blocks):
        n, planes = min(block_ids, n_ids - b * block_ids), []
        for size in sizes[b * n_planes:(b + 1) * n_planes]:
            planes.append(open_.decompress(payload[at:at + size]))
            at += size
        out.append(from_planes(planes, n))
    return np.concatenate(out)


def write_token_file(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, block_ids: int = 1 << 16,
                     segment_ids: int = 1 << 20, plane: str = "byte", level: int = 3) -> None:
    """Encode ``docs(doc_id, text)`` and write the segments to ``path``.

    A segment closes after the document that brings it to ``segment_ids``, so
    it holds that many ids plus one document's at most.
    """
    if plane not in ("byte", "bit"):
        raise ValueError("plane must be 'byte' or 'bit'")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, segment, first = TaskContext.get().partitionId(), 0, 0
        names, parts, held = [], [], 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            sizes, payload = pack_segment(ids, block_ids, plane, level)
            row = [shard, segment, first, len(ids), list(names), [len(p) for p in parts], block_ids, sizes, payload]
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(row, _ARROW)], schema=_ARROW)

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            at = 0
            while at < len(doc_ids):  # a slice at a time, so that few ids are held at once
                for doc_id, ids in zip(doc_ids[at:at + 256], encode(batch.column("text").slice(at, 256), tokenizer, end_id)):
                    names.append(doc_id)
                    parts.append(ids)
                    held += len(ids)
                    if held >= segment_ids:
                        yield close()
                        segment, first = segment + 1, first + held
                        names, parts, held = [], [], 0
                at += 256
        if names:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    (rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
     .mapInArrow(segments, SEGMENT_SCHEMA).write.option("compression", "none").parquet(path))


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of a written file; ``ids`` are
    little-endian unsigned 32-bit, ``start`` the number of ids before them."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_segment(row["n_ids"], row["block_ids"], row["plane_sizes"], row["payload"])
                end = np.cumsum(row["doc_tokens"])
                raw = ids.tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array([row["shard"]] * len(end), pa.int32()),
                    pa.array(row["first_id"] + end - row["doc_tokens"], pa.int64()),
                    pa.array(row["doc_tokens"], pa.int64()),
                    pa.array([raw[4 * (e - n):4 * e] for e, n in zip(end.tolist(), row["doc_tokens"])], pa.binary()),
                ], names=["doc_id", "shard", "at", "n_tokens", "ids"])

    file = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    # one row per shard: as many as the writing job had tasks
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = (file.groupBy("shard").agg(F.sum("n_ids").alias("n"))
              .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    docs = file.mapInArrow(documents, "doc_id long, shard int, at long, n_tokens long, ids binary")
    return docs.join(F.broadcast(shards), "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids")
