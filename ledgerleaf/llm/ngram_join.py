"""Near-duplicate join on word shingles by PartEnum signatures, exact at the threshold.

A document's set is its distinct 5-word shingles (ASCII capitals in lower case). Two sets link when their Jaccard
similarity is at least `percent` / 100.

Signatures. Sizes fall into bands whose ends have the ratio of the threshold, so linked sets lie in the same or
neighbouring bands; a set of band i has signatures for the tags i and i + 1. For a tag with sizes up to r, linked sets
differ in at most k = 2r(1 - t) / (1 + t) elements. The domain is cut into n > k parts, so at least n - k parts hold
the same elements in both; each part that holds something gives one signature. Parts that hold nothing are left out,
unless a set has n - k or more of them: then those could be all that it shares, and it gives them too. (A set that
shares only empty parts with it has as many of them and gives them as well, so no link is lost.)

Finding shared ones. Signatures travel as packed sorted hashes (see blocks); only those that two sets share come back,
and only they are spelled out.

Linking without pairs of groups. First each set is compared with the least set that shares a signature with it, and
with the one nearest by sketch among those that share one of its few smallest signatures; rounds of the second kind,
between components, go on to unite what links. Only then every signature whose sets are still in different components
is opened, and its sets of different components are compared in tiles. Sets that are already in one component are not
compared again. A comparison is first one of parity sketches, which can't reject a link (two sketches differ in no
more bits than the sets in elements); what is left is verified on the whole sets, which only then are read from the
blocks.

Equal sets are one class from the start; the class is a 64-bit hash of the set.

Defined cases: texts of fewer than 5 words have their whole sequence as one shingle; texts without a word have an
empty set and link with nothing; rows with the same doc_id are separate documents; a null doc_id takes part, and a
component's id is its least doc_id, null only if all are; a very long text has all its shingles; other columns are not
read; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.llm.blocks import U64, Powers, block_bytes_of, decode_keys, encode_keys, mix, pack_unordered, prefix_sums, read_masks, rows_of, seen_in_earlier_block
from ledgerleaf.llm.common import discard, free_shuffles, fresh, shuffle_partitions, tidy, written
from ledgerleaf.llm.components import components
from ledgerleaf.llm.substring_dedup import windows_of, words_of

SHINGLE = 5
PERCENT = 80
#: Parts of the domain for each element of the largest set of a tag; more than 2 * (1 - t) / (1 + t).
PARTS = 0.28
TILE = 4096
#: Tasks that the signatures of one component are dealt to, at least.
SLOTS = 16
REMEMBERED = 500_000
SMALLEST = 6
#: Rounds in which each set is compared with its nearest in another component, before all that is left is compared.
ROUNDS = 2
MEMBERS = "doc_id long, n long, class long, block long, slot int, sigs array<bigint>, sketch binary"
_SEQUENCE = Powers(0xBF58476D1CE4E5B9)


def bands(top: int, percent: int) -> np.ndarray:
    """The largest size of each band, until top is covered."""
    ends = [1]
    while ends[-1] < top:
        ends.append(max(ends[-1] + 1, (ends[-1] + 1) * 100 // percent))
    return np.array([*ends, max(ends[-1] + 1, (ends[-1] + 1) * 100 // percent)], np.int64)


def sets_of(data: bytes, sizes: list[int], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a block's documents, ascending and distinct within each, and how many each has."""
    hashes, doc = words_of(data.lower(), sizes)
    grams, at = windows_of(hashes, doc, width)
    of = doc[at]
    n_words = np.bincount(doc, minlength=len(sizes))
    short = np.flatnonzero((n_words > 0) & (n_words < width))
    if len(short):
        ends = np.cumsum(n_words)
        sums, down = prefix_sums(hashes, _SEQUENCE), _SEQUENCE.upto(len(hashes))[1]
        begin = ends[short] - n_words[short]
        whole = mix((sums[ends[short]] - sums[begin]) * down[begin] + n_words[short].astype(U64) * U64(0x94D049BB133111EB))
        grams, of = np.concatenate([grams, whole]), np.concatenate([of, short])
    order = np.lexsort((grams, of))
    grams, of = grams[order], of[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])
    return grams[new], np.bincount(of[new], minlength=len(sizes))


def classes_of(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(grams ^ U64(0x5851F42D4C957F2D)), dtype=U64)])
    ends = np.cumsum(counts)
    return mix(sums[ends] - sums[ends - counts] + counts.astype(U64) * U64(0xDA942042E4DD58B5))


def signatures(grams: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of a block's sets, and the document of each."""
    ends_of_bands = bands(int(counts.max(initial=1)), percent)
    band = np.searchsorted(ends_of_bands, counts)
    filled = np.flatnonzero(counts)
    spread = np.repeat(np.arange(len(counts)), counts)
    values = mix(grams ^ U64(0xA0761D6478BD642F))
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])
    out, of = [], []
    for step in (0, 1):
        tag = band[filled] + step
        r = ends_of_bands[tag]
        k = 2 * r * (100 - percent) // (100 + percent)
        n = np.maximum(k + 1, np.ceil(PARTS * r).astype(np.int64))
        parts = np.zeros(len(counts), np.int64)
        parts[filled] = n
        first = np.cumsum(parts) - parts
        cell = first[spread] + (((grams >> U64(32)) * parts[spread].astype(U64)) >> U64(32)).astype(np.int64)
        begin = np.flatnonzero(np.diff(cell, prepend=-1))
        end = np.append(begin[1:], len(cell))
        sig = np.zeros(int(parts.sum()), U64)
        held = np.zeros(len(sig), bool)
        sig[cell[begin]] = sums[end] - sums[begin]
        held[cell[begin]] = True
        owner = np.repeat(filled, n)
        empty = np.bincount(owner[~held], minlength=len(counts))
        needed = np.zeros(len(counts), bool)
        needed[filled] = empty[filled] >= n - k
        held |= needed[owner]
        label = (np.repeat(tag, n).astype(U64) << U64(40)) | (np.arange(len(sig)) - first[owner]).astype(U64)
        out.append(mix(sig + mix(label))[held])
        of.append(owner[held])
    return np.concatenate(out), np.concatenate(of)


def sketch(grams: np.ndarray) -> bytes:
    """The parity of the number of elements in each of 2**j >= len(grams) cells, 64 at least."""
    width = 1 << max(6, int(len(grams) - 1).bit_length())
    return np.packbits((np.bincount((grams & U64(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8)).tobytes()


def firsts(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each document, and which are the first of their class in the block and not empty."""
    kinds = classes_of(grams, counts)
    first = np.zeros(len(kinds), bool)
    first[np.unique(kinds, return_index=True)[1]] = True
    return kinds, first & (counts > 0)


def sets_of_firsts(row: dict, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    grams, counts = sets_of(block_bytes_of(row["data"]), row["sizes"], width)
    kinds, first = firsts(grams, counts)
    return grams, counts, kinds, grams[np.repeat(first, counts)], np.where(first, counts, 0)


def keys_of(row: dict, width: int, percent: int) -> np.ndarray:
    *_, grams, counts = sets_of_firsts(row, width)
    return np.unique(signatures(grams, counts, percent)[0])


def members(batches: Iterator[pa.RecordBatch], width: int, percent: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        all_grams, counts, kinds, grams, own = sets_of_firsts(row, width)
        sigs, of = signatures(grams, own, percent)
        distinct, index, n = np.unique(sigs, return_inverse=True, return_counts=True)
        shared = (read_masks(distinct, row["masks"], buckets) | (n > 1))[index]
        sigs, of = sigs[shared], of[shared]
        cuts = np.searchsorted(of_sorted := of[order := np.argsort(of, kind="stable")], np.arange(len(counts) + 1))
        sigs = sigs[order].view(np.int64)
        ends = np.cumsum(own)
        some = np.zeros(len(counts), bool)
        some[of_sorted] = True
        sets = [grams[ends[i] - own[i] : ends[i]] if some[i] else None for i in range(len(counts))]
        size = len(counts)
        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(row["ids"], pa.int64()), "n": pa.array(counts, pa.int64()), "class": pa.array(kinds.view(np.int64), pa.int64()), "block": pa.array([row["block"]] * size, pa.int64()), "slot": pa.array(range(size), pa.int32()), "sigs": pa.array([np.unique(sigs[cuts[i] : cuts[i + 1]]) if some[i] else None for i in range(size)], pa.list_(pa.int64())), "sketch": pa.array([None if s is None else sketch(s) for s in sets], pa.binary())})


def sets_needed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        grams, counts = sets_of(block_bytes_of(row["data"]), row["sizes"], width)
        ends = np.cumsum(counts)
        kinds = classes_of(grams, counts).view(np.int64)
        slots = sorted(set(row["slots"]))
        yield pa.RecordBatch.from_pydict({"class": pa.array(kinds[slots], pa.int64()), "n": pa.array(counts[slots], pa.int64()), "shingles": pa.array([encode_keys(grams[ends[i] - counts[i] : ends[i]]) for i in slots], pa.binary())})


def read_sets(pairs: DataFrame, light: DataFrame, blocks: DataFrame, width: int) -> DataFrame:
    """(class, n, shingles) of the sets in pairs (a, b): the blocks that hold them are read once more."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    at = light.join(needed, "class", "left_semi").groupBy("class").agg(F.min(F.struct("block", "slot")).alias("at"))
    slots = at.groupBy("at.block").agg(F.collect_list("at.slot").alias("slots"))
    return written(blocks.join(slots, "block").mapInArrow(lambda it: sets_needed(it, width), "class long, n long, shingles binary"), "sets")


def sketched(pairs: DataFrame, light: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (a, b) that sizes and sketches allow to link."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, n in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                width = 8 * min(len(x), len(y))
                apart = int(_ONES[folded(x, width) ^ folded(y, width)].sum())
                keep.append(apart * (100 + percent) <= n * (100 - percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    one = light.select("class", "n", "sketch").dropDuplicates(["class"])
    both = pairs.join(one.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a").join(one.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
    near = both.where((F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent))
    return near.select("a", "b", "sa", "sb", (F.col("na") + F.col("nb")).alias("n")).mapInArrow(check, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (a, b) whose sets link; sets: (class, shingles)."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for i in range(batch.num_rows):
                x, y = decode_keys(batch.column(2)[i].as_py()), decode_keys(batch.column(3)[i].as_py())
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    a.append(batch.column(0)[i].as_py())
                    b.append(batch.column(1)[i].as_py())
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(check, "a long, b long")


def folded(raw: bytes, width: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(raw, np.uint8))
    return np.packbits(np.bitwise_xor.reduce(bits.reshape(-1, width), axis=0))


_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint16)


def across(batches: Iterator[pa.RecordBatch], percent: int, nearest: bool) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b), a < b, in different components that the sketches allow, of rows sorted by tile (sig, p, q).

    In a tile, rows of side 0 meet those of side 1, or a side meets itself. nearest: only each row's nearest by sketch.
    """
    rest = None
    given: set[tuple[int, int]] = set()
    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        keys = np.stack([table.column(c).to_numpy() for c in ("sig", "p", "q")])
        begin = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])) if table.num_rows else np.zeros(0, np.int64)
        if len(begin) > 1:
            yield _tiles(table.slice(0, int(begin[-1])), begin[:-1], percent, nearest, given)
        rest = table.slice(int(begin[-1])) if len(begin) else table
    if rest is not None and rest.num_rows:
        yield _tiles(rest, np.zeros(1, np.int64), percent, nearest, given)
    tidy()


def _tiles(table: pa.Table, begin: np.ndarray, percent: int, nearest: bool, given: set[tuple[int, int]]) -> pa.RecordBatch:
    """given: pairs that the task has given already; it only saves repeats and is emptied when it is large."""
    n, kind, part, side = (table.column(c).to_numpy() for c in ("n", "class", "component", "side"))
    raw = table.column("sketch").to_pylist()
    pairs: set[tuple[int, int]] = set()
    for x, y in zip(begin.tolist(), [*begin[1:].tolist(), table.num_rows], strict=True):
        if y - x > 1 and (part[x:y] != part[x]).any():
            order = x + np.argsort(n[x:y], kind="stable")
            i, j = _tile(n[order], part[order], side[order], [raw[k] for k in order.tolist()], percent, nearest)
            pairs.update(zip(np.minimum(kind[order[i]], kind[order[j]]).tolist(), np.maximum(kind[order[i]], kind[order[j]]).tolist(), strict=True))
    pairs -= given
    if len(given) > REMEMBERED:
        given.clear()
    given |= pairs
    return pa.RecordBatch.from_pydict({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})


def _tile(n: np.ndarray, part: np.ndarray, side: np.ndarray, raw: list[bytes], percent: int, nearest: bool) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) of one tile, its rows ascending by size."""
    alone = not side.any() or bool(side.all())
    near, by = np.full(len(n), np.inf), np.full(len(n), -1)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    width, bits = 0, np.zeros((0, 0), np.uint8)
    for i in range(len(n) - 1):
        # only later rows up to the size that the threshold allows
        j = np.arange(i + 1, np.searchsorted(n, n[i] * 100 // percent, side="right"))
        j = j[(part[j] != part[i]) & ((side[j] != side[i]) | alone)]
        if not len(j):
            continue
        if 8 * len(raw[i]) != width:
            width = 8 * len(raw[i])
            bits = np.stack([folded(x, width) if 8 * len(x) >= width else np.zeros(width // 8, np.uint8) for x in raw])
        apart = _ONES[bits[j] ^ bits[i]].sum(axis=1, dtype=np.int64)
        both = n[i] + n[j]
        allowed = apart * (100 + percent) <= both * (100 - percent)
        j, share = j[allowed], (apart / both)[allowed]
        if not len(j):
            continue
        if not nearest:
            out.append((np.full(len(j), i), j))
            continue
        k = int(share.argmin())
        if share[k] < near[i]:
            near[i], by[i] = share[k], j[k]
        better = share < near[j]
        near[j[better]], by[j[better]] = share[better], i
    if nearest:
        found = np.flatnonzero(by >= 0)
        return found, by[found]
    return (np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def crossing(posted: DataFrame, united: DataFrame | None, light: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Pairs of sets in different components (without united: of any) that share a signature and may link by size and sketch."""
    named = posted.withColumn("component", F.col("class"))
    if united is not None:
        named = posted.join(united.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    opened = named.groupBy("sig").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("sig", "x")
    rows = written(named.join(opened, "sig"), "open")
    # many signatures are open for the same sets; one of those with the same members is enough
    same = rows.groupBy("sig").agg(F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("who"), F.count(F.lit(1)).alias("size"))
    same = same.groupBy("who", "size").agg(F.min("sig").alias("sig")).select("sig", F.ceil(F.col("size") / TILE).cast("int").alias("tiles"))
    one = light.select("class", "n", "sketch").dropDuplicates(["class"])
    tiled = rows.join(same, "sig").withColumn("tile", F.pmod(F.xxhash64("class"), F.col("tiles")).cast("int"))
    # tile i meets every tile: each row goes to the pairs of tiles that hold its own
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least(t, "tile").alias("p"), F.greatest(t, "tile").alias("q"))))
    tiled = tiled.join(one, "class").withColumn("pair", pair).withColumn("side", F.when((F.col("pair.p") != F.col("pair.q")) & (F.col("tile") == F.col("pair.q")), 1).otherwise(0))
    # sets that are alike share many signatures: those of one component meet in a few tasks, where a pair is given once
    slots = max(SLOTS, shuffle_partitions(posted.sparkSession) // SLOTS)
    tiled = tiled.withColumn("slot", F.pmod("sig", F.lit(slots))).select("sig", "pair.p", "pair.q", "side", "class", "n", "component", "sketch", "x", "slot")
    dealt = tiled.repartition("x", "slot").drop("x", "slot").sortWithinPartitions("sig", "p", "q")
    return dealt.mapInArrow(lambda it: across(it, percent, nearest), "a long, b long").distinct()


def link(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document."""
    spark = docs.sparkSession
    buckets = shuffle_partitions(spark)
    blocks = pack_unordered(docs, name="near")
    masks = seen_in_earlier_block(blocks, lambda row: keys_of(row, width, percent), "signatures", earlier_only=False)
    free_shuffles(spark)
    found = written(blocks.join(masks, "block", "left").mapInArrow(lambda it: members(it, width, percent, buckets), MEMBERS), "members")
    discard(masks)
    free_shuffles(spark)
    # a class may have a first document in many blocks; only signatures of different classes matter
    light = found.where("sigs IS NOT NULL")
    spelled = light.select("class", F.explode("sigs").alias("sig"))
    centres = spelled.groupBy("sig").agg(F.min("class").alias("centre"), F.max("class").alias("other")).where("centre < other")
    posted = written(spelled.join(centres.select("sig", "centre"), "sig").distinct(), "postings")
    free_shuffles(spark)

    stars = posted.where("class != centre").select(F.col("centre").alias("a"), F.col("class").alias("b")).distinct()
    posted = posted.select("sig", "class")
    # the smallest of a set's signatures are mostly those of the sets like it; the rounds get by with them
    few = written(posted.groupBy("class").agg(F.slice(F.sort_array(F.collect_list("sig")), 1, SMALLEST).alias("sigs")).select(F.explode("sigs").alias("sig"), "class"), "few")
    near = sketched(stars, light, percent).unionByName(crossing(few, None, light, percent, nearest=True)).distinct()
    tested = written(near, "pairs")
    # a set that can link by its few signatures is in a pair now: no later round needs another, but the last
    sets = read_sets(tested, light, blocks, width)
    edges = written(verified(tested, sets, percent), "edges")
    united = components(edges)
    free_shuffles(spark)
    stuck = False
    for k in range(ROUNDS + 1):
        nearest = k < ROUNDS
        if nearest and stuck:  # the components are those of the round before, and so are the nearest
            continue
        pairs = written(crossing(few if nearest else posted, united, light, percent, nearest).join(tested, ["a", "b"], "left_anti"), "pairs")
        if not nearest and not pairs.isEmpty():
            more = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct().join(sets, "class", "left_anti")
            sets = sets.unionByName(read_sets(more.select(F.col("class").alias("a"), F.col("class").alias("b")), light, blocks, width))
        new = written(verified(pairs, sets, percent), "edges")
        tested = tested.unionByName(pairs)
        stuck = new.isEmpty()
        if not stuck:
            edges = edges.unionByName(new)
            united = components(edges)
        free_shuffles(spark)
    final = united

    named = found.select("doc_id", "n", "class").join(final.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = named.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    out = named.join(least, "component", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """One document of each group stays, the one with the least doc_id (of several rows with that id, one); all columns of docs.

    Rows without a doc_id stay: nothing names the one to keep.
    """
    doc, n = fresh(docs, "doc", "n")
    least = link(docs, percent, width).where("component_id = doc_id").select(F.col("doc_id").alias(doc)).distinct()
    one = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    stay = docs.join(least, docs["doc_id"] == F.col(doc)).withColumn(n, one).where(F.col(n) == 1)
    names = [F.col(f"`{c}`") for c in docs.columns]
    return stay.select(*names).unionByName(docs.where("doc_id IS NULL").select(*names))
