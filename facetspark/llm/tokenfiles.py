"""Token files: ids in patched frame-of-reference blocks.

A file is a sequence of segments, in ascending order of document id. A
segment holds the ids of whole documents, about ``SEGMENT_IDS`` of them, as

    magic "PFR1" | ids | ids per block | blocks            (4 bytes each)
    start of every block, from the end of this list        (4 bytes each)
    blocks: least id (4) | width (1) | 0 (1) | exceptions (2)
            ids less the least, ``width`` bits each, low bit first
            places of the exceptions (2 each), their full values (4 each)

all little-endian. The width of a block is what the ``PERCENTILE``-th part of
its values needs; larger ones keep their low bits in place and go to the
exception list. Segments are rows of a Parquet dataset (one file per task,
committed as a whole), beside the ids and lengths of their documents, so they
live in the cluster's shared storage and a lost task is simply written again.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetspark.llm.bpe import read_spec, slices
from facetspark.llm.common import col, delete_path, running_start, small_batches, stored, worker_state
from facetspark.llm.pieces import Library
from facetspark.session import scratch_dir

MAGIC = b"PFR1"
BLOCK = 4096
PERCENTILE = 0.95
SEGMENT_IDS = 1 << 19
END_ID = 2
TIE = 32
TABLE_BITS = 21  # places of a worker's table of spans


def pack_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    ids = ids.astype("<u4")
    least = int(ids.min())
    rest = ids - np.uint32(least)
    width = int(np.partition(rest, int(percentile * (len(rest) - 1)))[int(percentile * (len(rest) - 1))]).bit_length()
    far = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.array([], dtype=np.int64)
    wide = 2 if width <= 16 else 4
    low = (rest & np.uint32((1 << width) - 1)).astype(f"<u{wide}")
    bits = np.unpackbits(low.view(np.uint8), bitorder="little").reshape(len(low), 8 * wide)[:, :width]
    return b"".join((struct.pack("<IBBH", least, width, 0, len(far)), np.packbits(bits, bitorder="little").tobytes(),
                     far.astype("<u2").tobytes(), rest[far].tobytes()))


def unpack_block(data: memoryview, n: int) -> np.ndarray:
    least, width, _, far = struct.unpack_from("<IBBH", data)
    body = -(-n * width // 8)
    # every value lies in the eight bytes from its first one on
    held = np.zeros(body + 8, dtype=np.uint8)
    held[:body] = np.frombuffer(data, np.uint8, body, 8)
    bit = np.arange(n) * width
    word = np.ndarray((body + 1,), "<u8", held, strides=(1,))[bit >> 3]
    ids = (word >> (bit & 7).astype(np.uint64) & np.uint64((1 << width) - 1)).astype("<u4")
    places = np.frombuffer(data, "<u2", far, 8 + body)
    ids[places] = np.frombuffer(data, "<u4", far, 8 + body + 2 * far)
    return ids + np.uint32(least)


def pack(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    """A segment; ``block`` is at most 65536."""
    blocks = [pack_block(ids[i:i + block], percentile) for i in range(0, len(ids), block)]
    starts = np.cumsum([0, *map(len, blocks)])[:-1].astype("<u4")
    return b"".join((MAGIC, struct.pack("<III", len(ids), block, len(blocks)), starts.tobytes(), *blocks))


def unpack(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids first..last (exclusive) of a segment; other blocks are not read."""
    if bytes(data[:4]) != MAGIC:
        raise ValueError("not a token segment")
    n, block, blocks = struct.unpack_from("<III", data, 4)
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, dtype="<u4")
    view, base = memoryview(data), 16 + 4 * blocks
    starts = np.frombuffer(data, "<u4", blocks, 16)
    low, high = first // block, -(-last // block)
    ids = [unpack_block(view[base + int(starts[b]):], min(block, n - b * block)) for b in range(low, high)]
    return np.concatenate(ids)[first - low * block:last - low * block]


@dataclass
class TokenFiles:
    """A written dataset: rows (shard, segment, ids, doc_ids, sizes, data)."""

    spark: object
    path: str

    def segments(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def delete(self) -> None:
        delete_path(self.spark, self.path)


def write_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, to: str | None = None) -> TokenFiles:
    """Encode every whole text, append ``end_id`` and write the ids by
    ascending id (null ids first; equal ids by the first ``TIE`` characters of
    the text, then by a hash of it). Rows of one id, or without one, are dealt
    over several tasks that way, and copies by their input partition.

    A null text is empty and still gets its end id. ``to``: the dataset's
    path, by default a new one in the shared checkpoint folder. Other columns
    are not written.
    """
    spark, spec = df.sparkSession, read_spec(path)
    to = to or scratch_dir(spark, "tokens")
    id_type = df.select(col(id_col)).schema[0].dataType
    rows = small_batches(df).select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumns({"tie": F.substring("text", 1, TIE), "hash": F.xxhash64("text"), "part": F.spark_partition_id()})
    rows = rows.repartitionByRange("id", "tie", "hash", "part").sortWithinPartitions("id", "tie", "hash")

    def run(batches):
        words = worker_state(("library", hash(spec)), lambda: Library(spec, bits=TABLE_BITS))
        tail, held, ids_, segment, n = struct.pack("<I", end_id), [], [], 0, 0
        shard = None

        def emit():
            data = np.frombuffer(b"".join(held), dtype="<u4")
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "segment": pa.array([segment], pa.int32()),
                "ids": pa.array([len(data)], pa.int64()), "doc_ids": pa.array([ids_], pa.list_(id_kind)),
                "sizes": pa.array([[len(x) // 4 for x in held]], pa.list_(pa.int64())),
                "data": pa.array([pack(data)], pa.binary())})

        for batch in batches:
            id_kind = batch.schema.field("id").type
            for part in slices(batch, "text"):
                shard = part.column(2)[0].as_py()
                ids, sizes = words.encode_bytes(part.column(1).to_pylist())
                data = ids.astype("<u4").tobytes()
                ends = 4 * np.cumsum(sizes)
                for i, s, e in zip(part.column(0).to_pylist(), (ends - 4 * sizes).tolist(), ends.tolist()):
                    held.append(data[s:e] + tail)
                    ids_.append(i)
                    n += (e - s) // 4 + 1
                    if n >= SEGMENT_IDS:
                        yield emit()
                        held, ids_, segment, n = [], [], segment + 1, 0
        if held:
            yield emit()

    out = rows.select("id", "text", F.spark_partition_id().alias("shard")).mapInArrow(
        run, f"shard int, segment int, ids long, doc_ids array<{id_type.simpleString()}>, sizes array<long>, data binary")
    out.write.option("compression", "zstd").parquet(to)
    return TokenFiles(spark, to)


def read_documents(files: TokenFiles, id_col: str = "doc_id") -> DataFrame:
    """One row per document read back from the files: id, start (ids before
    it in the whole dataset), n_tokens, ids_crc32 (of its ids, as 32-bit
    little-endian numbers)."""
    segments = files.segments()
    id_type = segments.schema["doc_ids"].dataType.elementType

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pydict()
                data = unpack(one["data"][0]).astype("<u4").tobytes()
                sizes = np.array(one["sizes"][0], dtype=np.int64)
                ends = np.cumsum(sizes)
                k = len(sizes)
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(one["shard"] * k, pa.int32()), "segment": pa.array(one["segment"] * k, pa.int32()),
                    "id": pa.array(one["doc_ids"][0], batch.schema.field("doc_ids").type.value_type),
                    "inside": pa.array(ends - sizes), "n_tokens": pa.array(sizes),
                    "ids_crc32": pa.array([zlib.crc32(data[4 * (e - s):4 * e]) for s, e in zip(
                        sizes.tolist(), ends.tolist())], pa.int64())})

    docs = segments.mapInArrow(run, f"shard int, segment int, id {id_type.simpleString()}, inside long, "
                                    "n_tokens long, ids_crc32 long")
    base = running_start(segments.select("shard", "segment", "ids"), [], F.col("shard"), [F.col("segment")],
                         "ids", "base").select("shard", "segment", "base")
    return docs.join(base, ["shard", "segment"]).select(
        F.col("id").alias(id_col), (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write, read back, keep the per-document figures and delete the files."""
    files = write_tokens(df, path, id_col, text_col)
    try:
        return stored(read_documents(files, id_col))
    finally:
        files.delete()
