"""Alignment of two tokenizers' tokens over the same bytes, with DuckDB inside tasks and Spark around them.

Tokenizer A is a byte-level BPE (tokenizers library), B a piece model with byte fallback that adds a space itself
(sentencepiece library). Both encode a space and the text; where tokens of both end at one byte, the text is cut into
groups, and tokens of one group are linked, each A with each B.

A task takes its documents in blocks of about `BLOCK` bytes. Neither tokenizer goes over a space between two characters
that are no white space, so a block is a table of such stretches, each encoded once, laid end to end on one axis of
bytes. DuckDB holds a table of token intervals for each tokenizer; common ends are a join; an ASOF join gives each A
token the first common end at or after its own; a window sum of the common ends passed gives each B token its group.
Groups and pairs of stretches then add up to documents, and to the block's partial counts: in how many of its documents
each pair of ids is linked. Spark merges these into corpus-wide counts, sends each block the counts of its own pairs, and
a second DuckDB step adds them up for each document. No row per token or link leaves a task.

A range join of tokens to group intervals gives the same groups; over one axis of bytes it took 2.0 CPU seconds where the
window sum took 0.8 (1.7 million tokens), and within one very long stretch it compares all pairs. It is not used.

Defined cases: a null or empty text, or one whose tokens don't give back its bytes (U+2581 is read as a space by B), has
zeros and an empty groups text; special tokens' strings are plain text; rows with the same doc_id, or a null one, are
documents of their own; an empty table gives an empty table; a text longer than a block is a block; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import tempfile
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import collector_paused, select_required, tidy, written

BLOCK = 4 << 20
#: DuckDB's limit in a task; beyond it, it writes to the task's own temporary folder.
MEMORY = "192MB"
STRETCH = re.compile(r"(?<=\S)(?= \S)")
#: Fixed value: how byte-level BPE splits a text before it merges.
SPLITS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
GROUPS = "block string, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, stretches array<int>, times array<int>, a array<int>, b array<int>, docs array<long>, link_stretch array<int>, link_pair array<int>, link_times array<long>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


#: The ids of stretches one after the other, and how many each stretch has.
Ids = tuple[np.ndarray, np.ndarray]


class Pair:
    """The two tokenizers of a task; they are made once in a worker.

    A's vocabulary and merges are read from its file; where, as in any byte-level BPE trained so, a merge's rank is its
    token's place, the tiktoken library gives the same ids in a third of the time.
    """

    def __init__(self, a_path: str, b_path: str) -> None:
        import tiktoken
        from sentencepiece import SentencePieceProcessor

        with open(a_path) as f:
            read = json.load(f)
        model, special = read["model"], {x["content"] for x in read["added_tokens"]}
        split = read["pre_tokenizer"] or {}
        if model["type"] != "BPE" or read["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex"):
            raise ValueError("A has to be a byte-level BPE with its usual splits")
        merged = [x.replace(" ", "") if isinstance(x, str) else "".join(x) for x in model["merges"]]
        places = [model["vocab"][x] for x in merged]
        if places != sorted(places) or len(merged) + 256 != len(model["vocab"].keys() - special):
            raise ValueError("A's tokens are not in the order of its merges")
        # byte-level tokens write byte n as the n-th of these characters: printable ones as themselves, others from 256 on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = (n for n in range(256) if n not in own)
        byte = {chr(n): n for n in own} | {chr(256 + k): n for k, n in enumerate(rest)}
        ranks = {bytes(byte[c] for c in entry): n for entry, n in model["vocab"].items() if entry not in special}
        self.a = tiktoken.Encoding("a", pat_str=SPLITS, mergeable_ranks=ranks, special_tokens={})
        self.b = SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(n) for n in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece goes over a space; stretches between spaces would not be independent")
        of_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(n) else p.replace("▁", " ").encode() for n, p in enumerate(pieces)]
        self.bytes = (by_id(ranks.items()), of_b)
        self.sizes = tuple(np.array([len(x) for x in side], np.int64) for side in self.bytes)

    def encode_all(self, side: int, stretches: list[str]) -> list[list[int]]:
        return [self.a.encode_ordinary(s) for s in stretches] if side == 0 else self.b.encode([s[1:] for s in stretches], num_threads=1)

    def encode_part(self, side: int, stretches: list[str]) -> Ids:
        """Ids of stretches. Those that don't end in white space are independent in one long text too, which takes less time."""
        if not any(map(ends_blank, stretches)):
            flat = np.array(self.encode_all(side, ["".join(stretches)])[0], np.int32)
            stops, ends = np.cumsum(self.sizes[side][flat]), np.cumsum([len(s.encode()) for s in stretches])
            last = np.searchsorted(stops, ends, "right")
            if np.array_equal(stops[last - 1], ends):
                return flat, np.diff(last, prepend=0).astype(np.int32)
        return packed(self.encode_all(side, stretches))

    def encode(self, stretches: list[str]) -> list[Ids]:
        parts = [stretches[k : k + 4096] for k in range(0, len(stretches), 4096)]  # what the libraries return is many times what is kept of it
        made = [[self.encode_part(side, x) for x in parts] for side in (0, 1)]
        return [(np.concatenate([x for x, _ in side]), np.concatenate([n for _, n in side])) if side else packed([]) for side in made]


def by_id(entries: Iterable[tuple[bytes, int]]) -> list[bytes]:
    out: list[bytes] = []
    for entry, n in sorted(entries, key=lambda x: x[1]):
        out += [b""] * (n - len(out)) + [entry]
    return out


def ends_blank(stretch: str) -> bool:
    return stretch[-1].isspace()


def packed(ids: list[list[int]]) -> Ids:
    sizes = np.fromiter(map(len, ids), np.int32, len(ids))
    return np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes


_pairs: dict[tuple[str, str], Pair] = {}


def pair(a_path: str, b_path: str) -> Pair:
    if (a_path, b_path) not in _pairs:
        _pairs.clear()
        _pairs[a_path, b_path] = Pair(a_path, b_path)
    return _pairs[a_path, b_path]


def broken(ids: Ids, of: Sequence[bytes], stretches: list[str]) -> list[int]:
    """Stretches whose tokens' bytes are not their own."""
    flat, sizes = ids
    if b"".join(map(of.__getitem__, flat.tolist())) == "".join(stretches).encode():
        return []
    at = np.cumsum([0, *sizes]).tolist()
    return [k for k, s in enumerate(stretches) if b"".join(map(of.__getitem__, flat[at[k] : at[k + 1]].tolist())) != s.encode()]


def intervals(ids: Ids, sizes: np.ndarray, good: np.ndarray) -> pa.Table:
    """(s, id, start, stop): a row a token of the good stretches, laid end to end."""
    flat, counts = ids
    stretch = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    held = good[stretch]
    flat, stretch = flat[held], stretch[held]
    stop = np.cumsum(sizes[flat])
    return pa.table({"s": stretch, "id": flat, "start": stop - sizes[flat], "stop": stop})


GROUPING = (
    "CREATE TEMP TABLE cuts AS SELECT a.s, a.stop, row_number() OVER (ORDER BY a.stop) AS g FROM a JOIN b USING (stop)",
    "CREATE TEMP TABLE ga AS SELECT a.s, a.start, a.id, g FROM a ASOF JOIN cuts ON a.stop <= cuts.stop",
    """CREATE TEMP TABLE gb AS SELECT b.s, b.start, b.id, 1 + coalesce(count(cuts.stop) OVER (ORDER BY b.stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g
       FROM b LEFT JOIN cuts ON b.stop = cuts.stop""",
    """CREATE TEMP TABLE links AS SELECT x.s, x.id AS a, y.id AS b, sum(x.n * y.n)::BIGINT AS n
       FROM (SELECT s, g, id, count(*) AS n FROM ga GROUP BY ALL) x JOIN (SELECT g, id, count(*) AS n FROM gb GROUP BY ALL) y USING (g) GROUP BY ALL""",
    "CREATE TEMP TABLE pairs AS SELECT a, b, (row_number() OVER () - 1)::INTEGER AS p FROM (SELECT DISTINCT a, b FROM links)",
    "CREATE TEMP TABLE known AS SELECT s, p, n FROM links JOIN pairs USING (a, b)",
)
PAIR_DOCS = "SELECT a, b, coalesce(docs, 0) AS docs FROM pairs LEFT JOIN (SELECT p, count(*) AS docs FROM (SELECT DISTINCT doc, p FROM held JOIN known USING (s)) GROUP BY p) USING (p) ORDER BY p"


def joined(texts: pa.Array, ends: np.ndarray, mark: str) -> pa.Array:
    """The texts up to each end, joined by the mark."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), texts), pa.scalar(mark, pa.large_string()))


def last_of_runs(numbers: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers end."""
    return np.append(np.flatnonzero(np.diff(numbers)) + 1, len(numbers))


def spelled_groups(db) -> tuple[np.ndarray, pa.Array]:
    """Stretches, ascending, and their groups as text, `a1,a2|b1;a3|b2,b3`."""
    sides = []
    for name in ("ga", "gb"):
        x = db.sql(f"SELECT s, g, id FROM {name} ORDER BY start").to_arrow_table()
        ends = last_of_runs(x["g"].to_numpy())
        sides.append(joined(x["id"].combine_chunks().cast(pa.large_string()), ends, ","))
    s = x["s"].to_numpy()[ends - 1]
    runs = last_of_runs(s)
    return s[runs - 1], joined(pc.binary_join_element_wise(*sides, pa.scalar("|", pa.large_string())), runs, ";")


def connection(folder: str):
    import duckdb

    return duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": folder})


def block_rows(name: str, doc_ids: list[int | None], texts: list[str | None], tokenizers: Pair) -> pa.Table:
    """A row for each document of the block, and one for the block with its pairs' counts and its stretches' pairs."""
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    places = [np.fromiter(map(number.__getitem__, STRETCH.split(" " + t)), np.int32) if t else np.zeros(0, np.int32) for t in texts]
    # those that end in white space come last, so that the others can be encoded together
    stretches = sorted(number, key=ends_blank)
    renumbered = np.zeros(len(stretches), np.int32)
    renumbered[np.fromiter(map(number.__getitem__, stretches), np.int32, len(stretches))] = np.arange(len(stretches))
    places = [renumbered[p] for p in places]
    ids = tokenizers.encode(stretches)
    bad = sorted({k for x, of in zip(ids, tokenizers.bytes, strict=True) for k in broken(x, of, stretches)})
    good = np.ones(len(stretches), bool)
    good[bad] = False
    if bad:
        places = [p if good[p].all() else np.zeros(0, np.int32) for p in places]
    n, size = len(doc_ids), len(stretches)
    flat, ends = np.concatenate([*places, np.zeros(0, np.int32)]), np.cumsum([0, *map(len, places)])
    del number, stretches, places
    # each document's different stretches, and how often it has them
    held, times = np.unique(np.repeat(np.arange(n, dtype=np.int64) << 32, np.diff(ends)) | flat, return_counts=True)
    held_ends = np.searchsorted(held, np.arange(n + 1, dtype=np.int64) << 32).astype(np.int32)
    doc, held = (held >> 32).astype(np.int32), (held & 0xFFFFFFFF).astype(np.int32)
    digests, counts = [""] * n, {k: np.zeros(size, np.int64) for k in ("n_a", "n_b", "n_groups", "n_links")}
    whole: dict[str, list] = {k: [[]] for k in ("a", "b", "docs", "link_stretch", "link_pair", "link_times")}
    if len(flat):
        with tempfile.TemporaryDirectory() as folder, connection(folder) as db:
            for side, x, sizes in zip("ab", ids, tokenizers.sizes, strict=True):
                db.register(side, intervals(x, sizes, good))
                counts[f"n_{side}"] = x[1].astype(np.int64)
            db.register("held", pa.table({"doc": doc, "s": held}))
            for step in GROUPING:
                db.execute(step)
            per = db.sql("SELECT s, groups, links FROM (SELECT s, count(*) AS groups FROM cuts GROUP BY s) JOIN (SELECT s, sum(n)::BIGINT AS links FROM links GROUP BY s) USING (s)").to_arrow_table()
            for k, c in (("n_groups", "groups"), ("n_links", "links")):
                counts[k][per["s"].to_numpy()] = per[c].to_numpy()
            counted, links = db.sql(PAIR_DOCS).to_arrow_table(), db.sql("SELECT s AS link_stretch, p AS link_pair, n AS link_times FROM known ORDER BY ALL").to_arrow_table()
            for part in (counted, links):
                whole |= {c: pa.ListArray.from_arrays([0, part.num_rows], part[c].combine_chunks()) for c in part.column_names}
            which, groups = spelled_groups(db)
        for i in range(0, n, 64):  # a few documents' texts at a time
            own = ends[i : i + 65]
            texts = joined(groups.take(pa.array(np.searchsorted(which, flat[own[0] : own[-1]]))), own[1:] - own[0], ";")
            digests[i : i + 64] = [hashlib.sha256(t.as_buffer()).hexdigest() if len(t.as_buffer()) else "" for t in texts]
    sums = {k: np.diff(np.concatenate([[0], np.cumsum(times * v[held])])[held_ends]) for k, v in counts.items()}
    lists = {k: pa.ListArray.from_arrays(pa.array(held_ends), pa.array(v, pa.int32())) for k, v in (("stretches", held), ("times", times))}
    empty = pa.nulls(n)
    rows = {"block": [name] * n, "doc_id": doc_ids} | sums | {"groups_sha256": digests} | lists | dict.fromkeys(whole, empty)
    last = {"block": [name], "doc_id": [None], **dict.fromkeys(sums, [0]), "groups_sha256": [None], **dict.fromkeys(lists, [None])} | whole
    return pa.concat_tables([pa.table(x).cast(ARROW) for x in (rows, last)])


_LIST = {"int": pa.list_(pa.int32()), "long": pa.list_(pa.int64())}
ARROW = pa.schema([(name, _LIST[kind[6:-1]] if kind.startswith("array") else {"long": pa.int64(), "string": pa.string()}[kind]) for name, kind in (x.split(" ") for x in GROUPS.split(", "))])


def grouped(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The rows of `block_rows` for all documents, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, size, ids, texts = TaskContext.get().partitionId(), 0, 0, [], []

        def block() -> Iterator[pa.RecordBatch]:
            with collector_paused():
                rows = block_rows(f"{task}-{made}", ids, texts, pair(a_path, b_path))
            yield from rows.to_batches(max_chunksize=2048)
            tidy()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc_id)
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size >= BLOCK:
                    yield from block()
                    made, size, ids, texts = made + 1, 0, [], []
        if ids:
            yield from block()

    docs = select_required(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(docs.mapInArrow(run, GROUPS), "aligned")


def pairs_of_blocks(rows: DataFrame) -> DataFrame:
    """(block, p, a, b, docs): the pairs of each block, with the documents of the block that link them."""
    zipped = F.arrays_zip("a", "b", "docs")
    return rows.where("a IS NOT NULL").select("block", F.posexplode(zipped).alias("p", "x")).select("block", "p", "x.a", "x.b", "x.docs").where("docs > 0")  # none: only in documents without tokens


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a, b, count, best): of each pair of ids, how many documents link it, and whether that is the most for its A id."""
    counts = pairs_of_blocks(rows).groupBy("a", "b").agg(F.sum("docs").alias("count"))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))


def scored_block(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a block with the counts of its pairs added up over their links."""
    with tempfile.TemporaryDirectory() as folder, connection(folder) as db:
        db.register("docs", docs)
        db.register("counts", counts)
        db.execute("""CREATE TEMP TABLE links AS SELECT unnest(link_stretch) AS s, unnest(link_pair) AS p, unnest(link_times) AS n FROM docs WHERE link_stretch IS NOT NULL""")
        db.execute("CREATE TEMP TABLE worth AS SELECT s, sum(n * best)::BIGINT AS best, sum(n * count)::BIGINT AS count FROM links JOIN counts USING (p) GROUP BY s")
        db.execute("CREATE TEMP TABLE named AS SELECT *, row_number() OVER () AS k FROM docs WHERE link_stretch IS NULL")
        return db.sql("""SELECT doc_id, n_a, n_b, n_groups, n_links, coalesce(n_best, 0)::BIGINT AS n_best, coalesce(count_sum, 0)::BIGINT AS count_sum, groups_sha256 FROM named
            LEFT JOIN (SELECT k, sum(times * best) AS n_best, sum(times * count) AS count_sum FROM (SELECT k, unnest(stretches) AS s, unnest(times) AS times FROM named) JOIN worth USING (s) GROUP BY k)
            USING (k)""").to_arrow_table()


def summed(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents of the blocks, each block brought together with the counts of its own pairs."""
    own = pairs_of_blocks(rows).join(counts, ["a", "b"]).select(F.col("block").alias("of_block"), "p", "count", "best")
    return rows.drop("a", "b", "docs").groupBy("block").cogroup(own.groupBy("of_block")).applyInArrow(scored_block, RESULT)


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Of each document: tokens of either side, groups and links, links that are the best of their A id, summed counts, a digest of the groups."""
    rows = grouped(docs, a_path, b_path)
    return summed(rows, written(pair_counts(rows), "pair-counts"))


def aligned_ids(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(a, b, count, best): the corpus's alignment of ids, for carrying embeddings or scores from one tokenizer to the other."""
    return pair_counts(grouped(docs, a_path, b_path))
