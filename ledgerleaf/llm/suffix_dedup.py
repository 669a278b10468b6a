"""Byte-string deduplication by deep-shallow sorting of sampled suffixes.

Every string of `width` bytes of one document is judged: one that also starts earlier (in a smaller document, or earlier
in the same) is a repeat, and the bytes that repeats cover are removed.

Sampling. The anchor of a string is the place of its gram of GRAM bytes with the least hash (leftmost of equals), so
equal strings have their anchors at the same offset. Strings that start next to each other mostly share an anchor; such
a run is described by the text left of the anchor and the text from the anchor on, both at most `width` bytes. Only the
suffixes at anchors are sorted, about one for 35 bytes, and only at anchors whose gram occurs again (found exactly by
hashes, see blocks).

Sorting. Runs are dealt out by their anchor's hash. The suffixes to the right and the reversed prefixes to the left are
put in order by deep-shallow sorting: multikey quicksort to a shallow depth, then blind tries for the groups that still
agree. Neighbours' common lengths then give, for each offset of the anchor in the string, classes of equal strings: two
runs share the string at offset o where their left sides agree in o bytes and their right sides in width - o.

Runs with the same text on both sides are sent once for each block and sorted once.

Defined cases: null text is the empty text; texts shorter than the width are kept; rows with the same doc_id are
different documents, ordered by a hash of their text; a null doc_id comes before all others; kept bytes need not be
UTF-8 and are returned as binary; the strings of a very long text are dealt out like all others; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.blocks import U64, Powers, block_bytes_of, bucket_edges, build_blocks, covered, mix, prefix_sums, read_masks, rows_of, seen_in_earlier_block
from ledgerleaf.llm.common import free_shuffles, shuffle_partitions, tidy, written
from ledgerleaf.llm.deep_shallow import deep_shallow

WIDTH = 100
GRAM = 32
BLOCK_BYTES = 1 << 20
#: Groups of runs for each shuffle partition; a group is sorted in one piece.
BUCKETS = 3
#: Runs that are described at once.
CHUNK = 4096
_POWERS = Powers(0xE7037ED1A0B428DB)


class Runs:
    """The runs of a block: anchor, first and last start of its strings, hash of the anchor's gram."""

    def __init__(self, data: bytes, sizes: list[int], width: int, gram: int):
        self.buf = np.frombuffer(data, np.uint8)
        n = len(self.buf) - width + 1
        if n < 1:
            self.anchor = self.first = self.last = np.zeros(0, np.int64)
            self.hash = np.zeros(0, U64)
            return
        sums = prefix_sums(self.buf.astype(U64) + U64(1), _POWERS)
        grams = mix((sums[gram:] - sums[:-gram]) * _POWERS.upto(len(self.buf))[1][: len(self.buf) - gram + 1])
        # the upper half of the hash decides, then the place
        keyed = (grams & U64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U64)
        span = width - gram + 1
        rows = -(-len(keyed) // span)
        table = np.full(rows * span, U64(0xFFFFFFFFFFFFFFFF))
        table[: len(keyed)] = keyed
        table = table.reshape(rows, span)
        ahead = np.minimum.accumulate(table, axis=1).ravel()
        back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
        anchor = (np.minimum(back[:n], ahead[span - 1 : span - 1 + n]) & U64(0xFFFFFFFF)).astype(np.int64)
        whole = np.zeros(n, bool)
        at = 0
        for size in sizes:
            whole[at : max(at, at + size - width + 1)] = True
            at += size
        starts = np.flatnonzero(whole)
        anchor = anchor[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (np.diff(starts) > 1)
        begin = np.flatnonzero(new)
        self.anchor, self.first = anchor[begin], starts[begin]
        self.last = starts[np.append(begin[1:], len(starts)) - 1] if len(starts) else starts
        self.hash = grams[self.anchor]

    def distinct_hashes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.unique(self.hash, return_inverse=True, return_counts=True)

    def repeated(self, masks: list[dict] | None, buckets: int) -> np.ndarray:
        """The numbers of the runs whose anchor's gram occurs at another anchor."""
        keys, index, n = self.distinct_hashes()
        return np.flatnonzero((read_masks(keys, masks, buckets) | (n > 1))[index])

    def described(self, which: np.ndarray, width: int, gram: int) -> np.ndarray:
        """A row of bytes for each run: least and largest offset, left side reversed, right side; filled up with zeros."""
        anchor, first, last = self.anchor[which], self.first[which], self.last[which]
        reach = width - gram
        low, high = anchor - last, anchor - first
        out = np.zeros((len(which), 4 + reach + width), np.uint8)
        out[:, 0], out[:, 1], out[:, 2], out[:, 3] = low & 255, low >> 8, high & 255, high >> 8
        step = np.arange(reach)
        at = anchor[:, None] - 1 - step
        out[:, 4 : 4 + reach] = np.where(step < high[:, None], self.buf[np.maximum(at, 0)], 0)
        step = np.arange(width)
        at = anchor[:, None] + step
        out[:, 4 + reach :] = np.where(step < (width - low)[:, None], self.buf[np.minimum(at, len(self.buf) - 1)], 0)
        return out


def send(batches: Iterator[pa.RecordBatch], width: int, gram: int, masked: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        runs = Runs(block_bytes_of(row["data"]), row["sizes"], width, gram)
        which, rows = sent_runs(runs, row["masks"], width, gram, masked)[:2]
        order = np.argsort(runs.hash[which], kind="stable")
        edges = bucket_edges(runs.hash[which][order], buckets)
        for b in np.flatnonzero(np.diff(edges)).tolist():
            here = np.sort(order[edges[b] : edges[b + 1]])
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([b], pa.int32()), "block": pa.array([row["block"]], pa.int64()), "runs": pa.array([zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(rows[here]).tobytes())], pa.binary())})


def sent_runs(runs: Runs, masks: list[dict] | None, width: int, gram: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs that a block sends (the first of each text) and their rows, all its repeated runs, and for those their place among the sent.

    Described a chunk at a time: a text that repeats itself has a run for every few bytes, but few different ones.
    """
    repeated = runs.repeated(masks, buckets)
    seen: dict[bytes, int] = {}
    place = np.zeros(len(repeated), np.int64)
    first: list[int] = []
    for k in range(0, len(repeated), CHUNK):
        for i, row in enumerate(runs.described(repeated[k : k + CHUNK], width, gram), k):
            n = place[i] = seen.setdefault(row.tobytes(), len(seen))
            if n == len(first):
                first.append(i)
    rows = np.frombuffer(b"".join(seen), np.uint8).reshape(-1, 4 + 2 * width - gram)
    return repeated[first], rows, repeated, place


def judged(parts: Iterable[np.ndarray], width: int, gram: int) -> Iterator[np.ndarray]:
    """For each part of the runs, in order of their places in the corpus: for each run and offset whether an earlier run has the same string.

    Of equal runs only one is held; parts are read one after the other.
    """
    reach = width - gram
    seen: dict[bytes, int] = {}
    places, news = [], []
    for rows in parts:
        before = len(seen)
        place = np.fromiter((seen.setdefault(r.tobytes(), len(seen)) for r in rows), np.int32, len(rows))
        new = np.zeros(len(rows), bool)
        fresh, at = np.unique(place, return_index=True)
        new[at[fresh >= before]] = True
        places.append(place)
        news.append(new)
    own = np.frombuffer(b"".join(seen), np.uint8).reshape(-1, 4 + reach + width)
    del seen
    low, high = own[:, 0].astype(np.int64) | own[:, 1].astype(np.int64) << 8, own[:, 2].astype(np.int64) | own[:, 3].astype(np.int64) << 8
    flags = np.zeros((len(own), reach + 1), bool)
    grams = np.ascontiguousarray(own[:, 4 + reach : 4 + reach + gram]).view(f"V{gram}").ravel()
    _, index, n = np.unique(grams, return_inverse=True, return_counts=True)
    many = np.flatnonzero(n[index] > 1)
    del grams, index
    if len(many):
        left, left_common = deep_shallow(own[many, 4 : 4 + reach])
        right, right_common = deep_shallow(own[many, 4 + reach :])
        for o in range(reach + 1):
            there = np.flatnonzero((low[many] <= o) & (o <= high[many]))
            if len(there) < 2:
                continue
            # classes of what agrees in o bytes to the left and width - o to the right
            key = np.cumsum(left_common < o)[left[there]] * (len(many) + 1) + np.cumsum(right_common < width - o)[right[there]]
            again = np.ones(len(there), bool)
            again[np.unique(key, return_index=True)[1]] = False
            flags[many[there[again]], o] = True
    for place, new in zip(places, news, strict=True):
        out = flags[place]
        out[~new] = True
        yield out


def meet(table: pa.Table, width: int, gram: int) -> pa.Table:
    blocks = table.column("block").to_numpy()
    order = np.argsort(blocks, kind="stable")
    runs = table.column("runs")
    parts = (np.frombuffer(zstandard.ZstdDecompressor().decompress(runs[int(i)].as_py()), np.uint8).reshape(-1, 4 + 2 * width - gram) for i in order)
    bits = [zstandard.ZstdCompressor(level=1).compress(np.packbits(x).tobytes()) for x in judged(parts, width, gram)]
    bucket = table.column("bucket")[0].as_py()
    out = pa.table({"block": pa.array(blocks[order], pa.int64()), "bucket": pa.array([bucket] * len(order), pa.int32()), "bits": pa.array(bits, pa.binary())})
    tidy()
    return out


def cut(batches: Iterator[pa.RecordBatch], width: int, gram: int, masked: int, buckets: int) -> Iterator[pa.RecordBatch]:
    reach = width - gram
    for row in rows_of(batches):
        data = block_bytes_of(row["data"])
        runs = Runs(data, row["sizes"], width, gram)
        sent, _, repeated, place = sent_runs(runs, row["masks"], width, gram, masked)
        flags = np.zeros((len(sent), reach + 1), bool)
        order = np.argsort(runs.hash[sent], kind="stable")
        edges = bucket_edges(runs.hash[sent][order], buckets)
        for x in row["flags"] or []:
            here = np.sort(order[edges[x["bucket"]] : edges[x["bucket"] + 1]])
            raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(x["bits"]), np.uint8)
            flags[here] = np.unpackbits(raw, count=len(here) * (reach + 1)).reshape(len(here), -1).astype(bool)
        own = flags[place]
        # a run's text that the block has had before is a repeat at every offset
        later = np.ones(len(repeated), bool)
        later[np.unique(place, return_index=True)[1]] = False
        own[later] = True
        starts = np.zeros(len(data), bool)
        for k in range(0, len(repeated), CHUNK):
            part = repeated[k : k + CHUNK]
            start = runs.anchor[part][:, None] - np.arange(reach + 1)
            inside = (start >= runs.first[part][:, None]) & (start <= runs.last[part][:, None])
            starts[start[own[k : k + CHUNK] & inside]] = True
        gone = covered(starts, len(data), width)
        out: dict[str, list] = {"n_removed": [], "n_spans": [], "kept": []}
        at = 0
        buf = runs.buf
        for size in row["sizes"]:
            g = gone[at : at + size]
            removed = int(g.sum())
            out["n_removed"].append(removed)
            out["n_spans"].append(int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()) if removed else 0)
            out["kept"].append(buf[at : at + size][~g].tobytes() if removed else data[at : at + size])
            at += size
        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(row["ids"], pa.int64()), "n_bytes": pa.array(row["sizes"], pa.int64()), "n_removed": pa.array(out["n_removed"], pa.int64()), "n_spans": pa.array(out["n_spans"], pa.int64()), "kept": pa.array(out["kept"], pa.binary())})


def dedup_bytes(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of each document; see the module for the rules."""
    if not 1 <= gram <= width or width - gram > 0xFFFF:
        raise ValueError("the gram must be from 1 to width bytes long")
    spark = docs.sparkSession
    masked = shuffle_partitions(spark)
    buckets = BUCKETS * masked
    blocks = build_blocks(docs, BLOCK_BYTES, name="bytes")
    masks = seen_in_earlier_block(blocks, lambda row: Runs(block_bytes_of(row["data"]), row["sizes"], width, gram).distinct_hashes()[0], "anchors", earlier_only=False)
    free_shuffles(spark)
    sent = blocks.join(masks, "block", "left").mapInArrow(lambda it: send(it, width, gram, masked, buckets), "bucket int, block long, runs binary")
    bits = sent.groupBy("bucket").applyInArrow(lambda t: meet(t, width, gram), "block long, bucket int, bits binary")
    flags = written(bits.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("flags")), "flags")
    free_shuffles(spark)
    small = masks.join(flags, "block", "full")
    return blocks.join(small, "block", "left").mapInArrow(lambda it: cut(it, width, gram, masked, buckets), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
