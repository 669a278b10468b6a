"""Documents in ascending order, packed into blocks, and the exact search for keys that an earlier block has too.

A block is one row: the ids of consecutive documents and their texts, compressed. Blocks are numbered in document
order, so "seen earlier" between blocks is a comparison of two numbers, and a key needs no position beside it when it
is shuffled. Keys (hashes) of a block travel sorted and delta-coded, 5 to 6 bytes each, a key once a block; what comes
back is one bit a key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import free_shuffles, shuffle_partitions, tidy, written

BLOCK_SCHEMA = "block long, ids array<bigint>, sizes array<bigint>, data binary"
BLOCK_BYTES = 3 << 19

U64 = np.uint64
_M1, _M2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (the finalizer of MurmurHash3)."""
    x = x ^ (x >> U64(33))
    x *= _M1
    x ^= x >> U64(33)
    x *= _M2
    x ^= x >> U64(33)
    return x


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as they have been asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = (n | 0xFFFF) + 1
            self.up = self.down = None  # not both the old and the new at once
            self.up, self.down = (np.concatenate([[U64(1)], np.cumprod(np.full(size, b, U64), dtype=U64)]) for b in (self.base, self.inverse))
        return self.up[: n + 1], self.down[: n + 1]


def prefix_sums(items: np.ndarray, powers: Powers) -> np.ndarray:
    """Rabin-Karp prefix sums: entry i is the sum of items[j] * base**j over j < i."""
    out = np.zeros(len(items) + 1, U64)
    np.cumsum(items * powers.upto(len(items))[0][: len(items)], out=out[1:])
    return out


def pack(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    ids: list = []
    texts: list[bytes] = []
    held, part, number = 0, 0, 0

    def flush() -> pa.RecordBatch:
        data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
        return pa.RecordBatch.from_pydict({"block": pa.array([(part << 32) + number], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())), "sizes": pa.array([[len(x) for x in texts]], pa.list_(pa.int64())), "data": pa.array([data], pa.binary())})

    for batch in batches:
        part_of = batch.column(2)
        for i, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True)):
            text = text or b""
            if texts and held + len(text) > block_bytes:
                yield flush()
                number, held, ids, texts = number + 1, 0, [], []
            part = part_of[i].as_py() if not texts else part
            ids.append(doc)
            texts.append(text)
            held += len(text)
    if texts:
        yield flush()


def build_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, name: str = "blocks") -> DataFrame:
    """The blocks of (doc_id, text), written in the shared folder. Null ids come first, equal ids are ordered by text hash."""
    spark = docs.sparkSession
    tie = F.xxhash64("text")
    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(shuffle_partitions(spark), "doc_id", tie).sortWithinPartitions("doc_id", tie)
    packed = ranged.withColumn("part", F.spark_partition_id()).mapInArrow(lambda it: pack(it, block_bytes), BLOCK_SCHEMA)
    blocks = written(packed, name, "uncompressed")
    del ranged, packed
    free_shuffles(spark)
    return blocks


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of batches one by one, so that only one is held as Python objects."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
    tidy()


def pack_unordered(docs: DataFrame, block_bytes: int = BLOCK_BYTES, name: str = "blocks") -> DataFrame:
    """As build_blocks, but in the order in which the documents are read: no shuffle, for keys that need no order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.spark_partition_id().alias("part"))
    return written(rows.mapInArrow(lambda it: pack(it, block_bytes), BLOCK_SCHEMA), name, "uncompressed")


def block_bytes_of(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31) if data else b""


def encode_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as zstd-packed byte planes of their differences."""
    deltas = np.diff(keys, prepend=U64(0))
    planes = deltas.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def decode_keys(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").ravel(), dtype=U64)


def bucket_edges(keys: np.ndarray, n: int) -> np.ndarray:
    """Where in ascending keys each of n equal ranges of the 64-bit space begins; n + 1 positions."""
    starts = np.array([(i << 64) // n for i in range(n)], dtype=U64)
    return np.append(np.searchsorted(keys, starts), len(keys))


def seen_in_earlier_block(blocks: DataFrame, keys_of: Callable[[dict], np.ndarray], name: str, earlier_only: bool = True) -> DataFrame:
    """For each block the bits of its ascending distinct keys: whether an earlier block (or, without earlier_only, any other) has the key.

    keys_of gets a block's row and returns its ascending distinct keys. The result has (block, masks), masks being an
    array of (bucket, bits); a bucket without a set bit is left out, and so is a block without any.
    """
    n = shuffle_partitions(blocks.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            keys = keys_of(row)
            edges = bucket_edges(keys, n)
            full = [i for i in range(n) if edges[i] < edges[i + 1]]
            if full:
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(full, pa.int32()), "block": pa.array([row["block"]] * len(full), pa.int64()), "keys": pa.array([encode_keys(keys[edges[i] : edges[i + 1]]) for i in full], pa.binary())})

    def meet(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        rows = sorted(zip(table.column("block").to_pylist(), table.column("keys").to_pylist(), strict=True))
        parts = [decode_keys(x[1]) for x in rows]
        sizes = [len(x) for x in parts]
        keys = np.concatenate(parts)
        del parts
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        same = keys[1:] == keys[:-1]
        flags = np.zeros(len(keys), bool)
        flags[order[1:][same]] = True
        if not earlier_only:
            flags[order[:-1][same]] = True
        cuts = np.cumsum([0, *sizes])
        out = [(rows[i][0], zstandard.ZstdCompressor(level=1).compress(np.packbits(flags[cuts[i] : cuts[i + 1]]).tobytes())) for i in range(len(rows)) if flags[cuts[i] : cuts[i + 1]].any()]
        return pa.table({"block": pa.array([x[0] for x in out], pa.int64()), "bucket": pa.array([bucket] * len(out), pa.int32()), "bits": pa.array([x[1] for x in out], pa.binary())})

    sent = blocks.mapInArrow(send, "bucket int, block long, keys binary")
    bits = sent.groupBy("bucket").applyInArrow(meet, "block long, bucket int, bits binary")
    return written(bits.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("masks")), name)


def read_masks(keys: np.ndarray, masks: list[dict] | None, n: int) -> np.ndarray:
    """The bit of each of a block's ascending distinct keys. n: the number of buckets, as when they were sent."""
    flags = np.zeros(len(keys), bool)
    if masks:
        edges = bucket_edges(keys, n)
        for x in masks:
            a, b = edges[x["bucket"]], edges[x["bucket"] + 1]
            raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(x["bits"]), np.uint8)
            flags[a:b] = np.unpackbits(raw, count=b - a).astype(bool)
    return flags


def first_in_block(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of keys in order of their position: the ascending distinct keys, each position's index among them, whether it is the key's first."""
    distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    is_first = np.zeros(len(keys), bool)
    is_first[first] = True
    return distinct, inverse, is_first


def covered(starts: np.ndarray, n: int, width: int) -> np.ndarray:
    """Which of n items lie in a window of the width that begins where starts (booleans) says so."""
    steps = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(starts)
    np.add.at(steps, at, 1)
    np.add.at(steps, np.minimum(at + width, n), -1)
    return np.cumsum(steps[:-1]) > 0
