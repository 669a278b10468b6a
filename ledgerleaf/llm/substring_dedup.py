"""Substring deduplication by Rabin-Karp hashes of every fixed-length word window.

Every window of `width` consecutive words of one document gets a 64-bit polynomial hash, computed from prefix sums over
the block (constant work a window). Hashes are dealt out by range, and each range is counted in one Spark group: a
window whose hash occurs in an earlier block, or earlier in its own block, is a repeat. The words that repeats cover
are merged into maximal intervals and removed.

A word is what ASCII white space separates. Two different windows share a hash with a chance of 2**-64 a pair.

Defined cases: null or blank text has no words and is kept as the empty string; texts shorter than the window are kept
whole; rows with the same doc_id are different documents, ordered by a hash of their text; a null doc_id comes before
all others; the windows of a very long text are dealt out like all others; an empty table gives an empty table; other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerleaf.llm.blocks import U64, Powers, block_bytes_of, build_blocks, covered, first_in_block, mix, prefix_sums, read_masks, rows_of, seen_in_earlier_block
from ledgerleaf.llm.common import shuffle_partitions

WINDOW = 20
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BYTES, _WORDS = Powers(0x9E3779B97F4A7C15 | 1), Powers(0xD1342543DE82EF95)


def words_of(data: bytes, sizes: list[int], separator: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray]:
    """Of every word in a block's texts: a 64-bit hash and the document's number in the block."""
    if not data:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    buf = np.frombuffer(data, np.uint8)
    inside = ~separator[buf]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    bounds = np.cumsum([0, *sizes])
    starts_doc = bounds[:-1][bounds[:-1] < len(buf)]
    begins[starts_doc] = inside[starts_doc]
    after = np.ones(len(buf), bool)
    after[:-1] = ~inside[1:] | begins[1:]
    start, end = np.flatnonzero(begins), np.flatnonzero(inside & after) + 1
    sums = prefix_sums(buf.astype(U64) + U64(1), _BYTES)
    down = _BYTES.upto(len(buf))[1]
    hashes = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U64) * U64(0x2545F4914F6CDD1D))
    return hashes, np.searchsorted(bounds, start, side="right") - 1


def windows_of(hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each window and the index of the word it begins with."""
    if len(hashes) < width:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    sums = prefix_sums(hashes, _WORDS)
    down = _WORDS.upto(len(hashes))[1]
    n = len(hashes) - width + 1
    whole = np.flatnonzero(doc[:n] == doc[width - 1 :])
    return mix((sums[whole + width] - sums[whole]) * down[whole]), whole


def keys_of(row: dict, width: int) -> np.ndarray:
    return np.unique(windows_of(*words_of(block_bytes_of(row["data"]), row["sizes"]), width)[0])


def cut(batches: Iterator[pa.RecordBatch], width: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        data = block_bytes_of(row["data"])
        hashes, doc = words_of(data, row["sizes"])
        windows, at = windows_of(hashes, doc, width)
        distinct, index, is_first = first_in_block(windows)
        starts = np.zeros(len(hashes), bool)
        starts[at] = read_masks(distinct, row["masks"], buckets)[index] | ~is_first
        gone = covered(starts, len(hashes), width)
        words_end = np.searchsorted(doc, np.arange(len(row["ids"])), side="right")
        kept, n_words, n_removed, n_spans = [], [], [], []
        a = p = 0
        for size, b in zip(row["sizes"], words_end.tolist(), strict=True):
            out = gone[a:b]
            items = data[p : p + size].split()
            removed = int(out.sum())
            kept.append(b" ".join(compress(items, (~out).tolist()) if removed else items))
            n_words.append(b - a)
            n_removed.append(removed)
            n_spans.append(int(out[:1].sum() + (out[1:] & ~out[:-1]).sum()))
            a, p = b, p + size
        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(row["ids"], pa.int64()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})


def dedup_substrings(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, n_spans, kept_text) of each document; see the module for the rules."""
    if width < 1:
        raise ValueError("width must be at least 1")
    buckets = shuffle_partitions(docs.sparkSession)
    blocks = build_blocks(docs, name="words")
    masks = seen_in_earlier_block(blocks, lambda row: keys_of(row, width), "windows")
    return blocks.join(masks, "block", "left").mapInArrow(lambda it: cut(it, width, buckets), "doc_id long, n_words long, n_removed long, n_spans long, kept_text string")
