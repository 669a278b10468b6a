"""Token files: static range asymmetric numeral systems (rANS) over independent interleaved blocks.

Texts are encoded in ascending doc_id order; every document ends with `end_id`. Token counts over the whole corpus give
one frequency table of 2**SCALE slots that all blocks share. A block's tokens are dealt over LANES interleaved coders
with 64-bit states that give off 32-bit words, so one numpy operation codes LANES tokens. Every CHECKPOINT steps the
states and the place in the words are noted: a reader can begin at any of them. A CRC-32 of the ids guards each block.

A token file set is a folder of two tables, `blocks` (block, ids, sizes, n_tokens, words, states, checkpoints, crc32)
and `frequencies` (token, slots). Blocks are numbered in order, (range partition << 32) + place, and can be decoded in
any order and in parallel.

Words between ASCII white space are encoded once for each block and looked up; the tokenizer's pre-tokenisation never
joins text over white space, so this equals encoding the whole text.

Defined cases: null text is the empty text and gives the end id alone; rows with the same doc_id follow each other in
the order of a hash of their text; a null doc_id comes first; the ids of a very long text go over several blocks; an
empty table gives an empty file set; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerleaf.llm.blocks import rows_of
from ledgerleaf.llm.common import collector_paused, free_shuffles, shared_folder, shuffle_partitions, tidy, written

SCALE = 20
LANES = 1024
CHECKPOINT = 512
BLOCK_BYTES = 4 << 20
#: Words that a worker remembers; beyond it the half used longest ago is forgotten.
REMEMBERED = 700_000
_LOW = np.uint64(1 << 31)
_U = np.uint64

TOKENS = "block long, ids array<bigint>, sizes array<bigint>, tokens binary, counts array<struct<token:bigint,n:bigint>>"
BLOCKS = "block long, ids array<bigint>, sizes array<bigint>, n_tokens long, words binary, states binary, checkpoints array<struct<step:bigint,at:bigint,states:binary>>, crc32 long"


#: What is known to split a word into a run of letters and a run of signs: how the text is normalised before, and the pre-tokeniser's pattern.
_SIMPLE = {"NFC", "Replace", "Lowercase"}
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS_SIGNS = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]+)")
_RUN = re.compile(r"[a-zß-öø-ÿ]+|[!-&(-/:-@\[-`{-~]+")
#: The bytes that a byte-level model spells as themselves; the others, in order, are the code points from 256 on.
_SPELLED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LEVEL = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SPELLED)}


class WordEncoder:
    """Token ids of many texts, each word encoded once for as long as it is remembered.

    Where the tokenizer is known to encode letters and the signs after them apart, words are put together from those.
    A run of either is one piece to the pre-tokeniser and nothing to the normaliser, so the library's model is asked for
    it directly. Other words are joined by a special token, whose id then cuts the ids: one call of the library for many.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given the task its core
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        form = json.loads(self.tokenizer.to_str())
        steps = (form["normalizer"] or {}).get("normalizers", [])
        splits = (form["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.lower = bool(steps) and {x["type"] for x in steps} <= _SIMPLE and steps[-1]["type"] == "Lowercase"
        self.apart = self.lower and splits[0].get("pattern") == {"Regex": _PATTERN}
        plain = [x for x in form["added_tokens"] if x["special"] and not (x["lstrip"] or x["rstrip"] or x["normalized"] or x["single_word"])]
        self.cut = plain[0] if plain else None
        self.added = [x["content"] for x in form["added_tokens"]]
        byte_level = len(splits) == 2 and {k: splits[1].get(k) for k in ("type", "add_prefix_space", "use_regex")} == {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
        self.direct = self.apart and byte_level and not any(_RUN.fullmatch(x.lower()) for x in self.added)
        self.model = self.tokenizer.model
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.number: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 1
        self.flat[0] = end_id
        self.begin, self.length, self.seen = (np.zeros(1 << 16, np.int64) for _ in range(3))
        self.length[0] = 1  # number 0 is the end of a document
        self.clock = 0

    def forget(self, keep: int) -> None:
        """Remember the `keep` words used last, and no others."""
        n = len(self.number) + 1
        kept = np.zeros(n, bool)
        kept[1 + np.argsort(-self.seen[1:n], kind="stable")[:keep]] = True
        kept[0] = True
        length, old = self.length[:n][kept], self.begin[:n][kept]
        begin = np.cumsum(length) - length
        self.used = int(length.sum())
        flat = self.flat[np.repeat(old - begin, length) + np.arange(self.used)]
        self.flat = np.concatenate([flat, np.zeros(1 << 16, np.uint32)])
        seen = self.seen[:n][kept]
        self.begin, self.length, self.seen = (np.concatenate([x, np.zeros(1 << 16, np.int64)]) for x in (begin, length, seen))
        words = [w for w, k in zip(self.number, kept[1:].tolist(), strict=True) if k]  # numbers follow the order of entry
        self.number = dict(zip(words, range(1, len(words) + 1), strict=True))

    def encoded(self, words: list[str]) -> list[list[int]]:
        """The ids of each word, from the library."""
        if not self.direct:
            return self.through_all(words)
        tokenize = self.model.tokenize
        runs = [bool(_RUN.fullmatch(w)) for w in words]
        rest = iter(self.through_all([w for w, run in zip(words, runs, strict=True) if not run]))
        return [[t.id for t in tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(_BYTE_LEVEL))] if run else next(rest) for w, run in zip(words, runs, strict=True)]

    def through_all(self, words: list[str]) -> list[list[int]]:
        """The ids of each word, through all steps of the tokenizer."""
        if not self.cut:
            return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        text, token = self.cut["content"], self.cut["id"]
        out: list[list[int]] = []
        for k in range(0, len(words), 20_000):
            part = words[k : k + 20_000]
            if any(text in w for w in part):
                out += [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                continue
            for e in self.tokenizer.encode_batch_fast([text.join(part[i : i + 200]) for i in range(0, len(part), 200)], add_special_tokens=False):
                ids = e.ids
                at = 0
                while True:
                    try:
                        end = ids.index(token, at)
                    except ValueError:
                        out.append(ids[at:])
                        break
                    out.append(ids[at:end])
                    at = end + 1
        return out

    def learn(self, new: list[str]) -> None:
        split = [m.groups() if m else None for m in map(_LETTERS_SIGNS.fullmatch, new)] if self.apart else [None] * len(new)
        parts = {x for m in split if m for x in m} | {w for w, m in zip(new, split, strict=True) if not m}
        if len(self.parts) > REMEMBERED // 2:
            self.older, self.parts = self.parts, {}
        known, older = self.parts, self.older
        if older:  # what is still in use comes over
            known.update((x, older[x]) for x in parts if x in older and x not in known)
        ask = [x for x in parts if x not in known]
        known.update((x, array("I", ids).tobytes()) for x, ids in zip(ask, self.encoded(ask), strict=True))
        got = [known[m[0]] + known[m[1]] if m else known[w] for w, m in zip(new, split, strict=True)]
        first, n = len(self.number) + 1, len(new)
        self.number.update(zip(new, range(first, first + n), strict=True))
        length = np.fromiter(map(len, got), np.int64, n) // 4
        total = int(length.sum())
        while first + n > len(self.begin):
            self.begin, self.length, self.seen = (np.resize(x, 2 * len(x)) for x in (self.begin, self.length, self.seen))
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used : self.used + total] = np.frombuffer(b"".join(got), np.uint32)
        self.begin[first : first + n] = self.used + np.cumsum(length) - length
        self.length[first : first + n] = length
        self.used += total

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and how many each has, the end id included."""
        whole = pa.array(texts, pa.large_string())
        # lower case for ASCII alone, which neither composition nor the tokenizer's own lower case can tell from the text
        parts = pc.ascii_split_whitespace(pc.ascii_lower(whole) if self.lower and not self._special(texts) else whole)
        in_text = np.diff(parts.offsets.to_numpy())
        coded = parts.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.number) + len(distinct) > REMEMBERED:
            self.forget(REMEMBERED // 2)
        new = [w for w in distinct if w not in self.number]
        if new:
            self.learn(new)
        numbers = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))
        self.clock += 1
        self.seen[numbers] = self.clock
        word = numbers[coded.indices.to_numpy()] if len(distinct) else np.zeros(0, np.int64)
        ends = np.cumsum(in_text)
        word = np.insert(word, ends, 0)
        lengths = self.length[word]
        after = np.cumsum(lengths)
        ids = self.flat[np.repeat(self.begin[word] - (after - lengths), lengths) + np.arange(after[-1])]
        last = after[ends + np.arange(len(texts))]
        return ids, np.diff(last, prepend=0)

    def _special(self, texts: list[str]) -> bool:
        """Whether a text could hold an added token, whose letters' case matters."""
        return any(t[:2] in x and t.lower() in x.lower() for t in self.added for x in texts)


_encoders: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, end_id: int) -> WordEncoder:
    if (path, end_id) not in _encoders:
        _encoders.clear()
        _encoders[path, end_id] = WordEncoder(path, end_id)
    return _encoders[path, end_id]


def tokenised(batches: Iterator[pa.RecordBatch], path: str, end_id: int, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Blocks of token ids; the last of a partition carries the counts of all its tokens."""
    ids: list = []
    texts: list[str] = []
    held = number = part = 0
    total = np.zeros(0, np.int64)
    pair = pa.struct([("token", pa.int64()), ("n", pa.int64())])

    def flush(last: bool) -> pa.RecordBatch:
        nonlocal total
        with collector_paused():
            tokens, sizes = encoder(path, end_id).encode(texts)
        n = np.bincount(tokens, minlength=len(total))
        n[: len(total)] += total
        total = n
        at = np.flatnonzero(total) if last else np.zeros(0, np.int64)
        counts = pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), pa.StructArray.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], fields=list(pair)))
        return pa.RecordBatch.from_pydict({"block": pa.array([(part << 32) + number], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())), "sizes": pa.array([sizes], pa.list_(pa.int64())), "tokens": pa.array([tokens.astype("<u4").tobytes()], pa.binary()), "counts": counts})

    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            for doc, text, p in zip(*(batch.column(c).slice(i, 256).to_pylist() for c in range(3)), strict=True):
                text = text or ""
                if texts and held + len(text) > block_bytes:
                    yield flush(False)
                    number, held, ids, texts = number + 1, 0, [], []
                part = p
                ids.append(doc)
                texts.append(text)
                held += len(text)
    if texts:
        yield flush(True)
    tidy()


def slots_of(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of 2**SCALE; none that occurs becomes 0. More than 2**SCALE different tokens are refused."""
    size = 1 << SCALE
    if (counts > 0).sum() > size:
        raise ValueError("more different tokens than slots")
    if not counts.sum():
        return counts
    slots = np.where(counts > 0, np.maximum(1, counts * (size / counts.sum())).astype(np.int64), 0)
    while (over := int(slots.sum()) - size) != 0:
        order = np.argsort(-slots, kind="stable")
        if over < 0:
            slots[order[0]] -= over
        else:
            room = slots[order] - 1
            take = np.minimum(room, np.maximum(1, room // 8))
            take = np.where(np.cumsum(take) - take < over, np.minimum(take, np.maximum(0, over - (np.cumsum(take) - take))), 0)
            slots[order] -= take
    return slots


class Coder:
    """rANS over one frequency table."""

    def __init__(self, tokens: np.ndarray, slots: np.ndarray):
        self.tokens, self.freq = tokens, slots.astype(_U)
        self.cum = np.concatenate([[0], np.cumsum(slots)[:-1]]).astype(_U) if len(slots) else slots.astype(_U)
        self.symbol = np.repeat(np.arange(len(slots), dtype=np.int32), slots)
        self.place = np.full(int(tokens.max()) + 1 if len(tokens) else 0, -1, np.int32)
        self.place[tokens] = np.arange(len(tokens))

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes, list[dict]]:
        symbols = self.place[ids]
        steps = -(-len(ids) // LANES)
        state = np.full(LANES, _LOW)
        out: list[np.ndarray] = []
        notes: list[tuple[int, int, bytes]] = []
        given = 0
        shift, scale = _U(63 - SCALE), _U(SCALE)
        for step in range(steps - 1, -1, -1):
            if step and (step + 1) % CHECKPOINT == 0 and step + 1 < steps:
                notes.append((step + 1, given, state.tobytes()))
            s = symbols[step * LANES : (step + 1) * LANES]
            f, x = self.freq[s], state[: len(s)]
            full = x >= f << shift
            words = x[full].astype("<u4")
            out.append(words)
            given += len(words)
            x = np.where(full, x >> _U(32), x)
            q = x // f
            state[: len(s)] = (q << scale) + (x - q * f) + self.cum[s]
        out.reverse()
        return np.concatenate(out).tobytes() if out else b"", state.tobytes(), [{"step": a, "at": given - b, "states": c} for a, b, c in reversed(notes)]

    def decode(self, words: bytes, states: bytes, n: int, step: int = 0, at: int = 0, until: int | None = None) -> np.ndarray:
        """The ids from a step (0 or a checkpoint's, with its states and place) on; until: the step to end before."""
        words_, state = np.frombuffer(words, "<u4"), np.frombuffer(states, _U).copy()
        steps = -(-n // LANES)
        until = steps if until is None else min(until, steps)
        out = np.empty((max(0, until - step), LANES), np.int32)
        scale, mask = _U(SCALE), _U((1 << SCALE) - 1)
        for k in range(step, until):
            width = min(LANES, n - k * LANES)
            x = state[:width]
            slot = x & mask
            s = self.symbol[slot]
            x = self.freq[s] * (x >> scale) + slot - self.cum[s]
            low = np.flatnonzero(x < _LOW)
            x[low] = (x[low] << _U(32)) | words_[at : at + len(low)]
            at += len(low)
            state[:width] = x
            out[k - step, :width] = s
        flat = out.ravel()[: max(0, min(n, until * LANES) - step * LANES)]
        return self.tokens[flat].astype(np.uint32)


def encoded(batches: Iterator[pa.RecordBatch], tokens: np.ndarray, slots: np.ndarray) -> Iterator[pa.RecordBatch]:
    coder = Coder(tokens, slots)
    for row in rows_of(batches):
        ids = np.frombuffer(row["tokens"], "<u4")
        words, states, checkpoints = coder.encode(ids)
        yield pa.RecordBatch.from_pylist([{"block": row["block"], "ids": row["ids"], "sizes": row["sizes"], "n_tokens": len(ids), "words": words, "states": states, "checkpoints": checkpoints, "crc32": zlib.crc32(row["tokens"])}], schema=_schema())


def _schema() -> pa.Schema:
    point = pa.struct([("step", pa.int64()), ("at", pa.int64()), ("states", pa.binary())])
    return pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("words", pa.binary()), ("states", pa.binary()), ("checkpoints", pa.list_(point)), ("crc32", pa.int64())])


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, block_bytes: int = BLOCK_BYTES) -> None:
    """Encode docs (doc_id, text) into a token file set in the folder path."""
    spark = docs.sparkSession
    tie = F.xxhash64("text")
    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(shuffle_partitions(spark), "doc_id", tie).sortWithinPartitions("doc_id", tie).withColumn("part", F.spark_partition_id())
    tokens = written(ranged.mapInArrow(lambda it: tokenised(it, tokenizer_path, end_id, block_bytes), TOKENS), "tokens")
    del ranged
    free_shuffles(spark)
    # at most one row for each entry of the vocabulary
    counts = sorted((r["token"], r["n"]) for r in tokens.select(F.explode("counts").alias("c")).groupBy("c.token").agg(F.sum("c.n").alias("n")).collect())
    names = np.array([x[0] for x in counts], np.int64)
    slots = slots_of(np.array([x[1] for x in counts], np.int64))
    tokens.mapInArrow(lambda it: encoded(it, names, slots), BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    spark.createDataFrame([(int(a), int(b)) for a, b in zip(names, slots, strict=True)], "token long, slots long").coalesce(1).write.parquet(f"{path}/frequencies")


def decoded(batches: Iterator[pa.RecordBatch], tokens: np.ndarray, slots: np.ndarray) -> Iterator[pa.RecordBatch]:
    coder = Coder(tokens, slots)
    for row in rows_of(batches):
        ids = coder.decode(row["words"], row["states"], row["n_tokens"]).astype("<u4")
        raw = ids.tobytes()
        if zlib.crc32(raw) != row["crc32"]:
            raise ValueError(f"block {row['block']}: its checksum is wrong")
        ends = np.cumsum(row["sizes"]).tolist()
        yield pa.RecordBatch.from_pydict({"block": pa.array([row["block"]] * len(ends), pa.int64()), "doc_id": pa.array(row["ids"], pa.int64()), "offset": pa.array([b - n for b, n in zip(ends, row["sizes"], strict=True)], pa.int64()), "tokens": pa.array([raw[4 * (b - n) : 4 * b] for b, n in zip(ends, row["sizes"], strict=True)], pa.binary())})


def _read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(block, doc_id, offset, tokens) of each document, and (block, first): the ids before each block."""
    table = sorted((r["token"], r["slots"]) for r in spark.read.schema("token long, slots long").parquet(f"{path}/frequencies").collect())
    names, slots = np.array([x[0] for x in table], np.int64), np.array([x[1] for x in table], np.int64)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    sizes = blocks.select("block", "n_tokens", F.shiftright("block", 32).alias("part"))
    # one row for each range partition reaches the driver; the sums inside partitions stay distributed
    before, total = [], 0
    for r in sorted(sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()):
        before.append((r["part"], total))
        total += r["n"]
    parts = spark.createDataFrame(before, "part long, before long")
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block")) - F.col("n_tokens")
    first = sizes.withColumn("inside", inside).join(parts, "part").select("block", (F.col("before") + F.col("inside")).alias("first"))
    docs = blocks.mapInArrow(lambda it: decoded(it, names, slots), "block long, doc_id long, offset long, tokens binary")
    return docs, first


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, tokens) from a token file set; tokens are little-endian unsigned 32-bit ids, start the ids before them."""
    docs, first = _read(spark, path)
    return docs.join(first, "block").select("doc_id", (F.col("first") + F.col("offset")).alias("start"), "tokens")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), the tokens themselves dropped before any shuffle."""
    docs, first = _read(spark, path)
    light = docs.select("block", "doc_id", "offset", (F.length("tokens") / 4).cast("long").alias("n_tokens"), F.crc32("tokens").alias("ids_crc32"))
    return light.join(first, "block").select("doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
