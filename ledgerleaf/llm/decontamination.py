"""Benchmark decontamination by latent semantic retrieval.

Terms are runs of letters and digits (ASCII capitals in lower case). The vocabulary is that of the benchmark's items
without stop terms, those in more than STOP_SHARE of all documents; document frequencies are counted over the whole
corpus. Documents are cut into passages of WIDTH terms, one every STRIDE terms. A randomised SVD of the TF-IDF matrix
of all passages with a term of the vocabulary and of all items gives the latent space; the matrix is written once, and
range finding and its power iteration are Spark jobs over its rows. Every passage of the corpus that could pass the
checks is projected and compared with all items by cosine. A candidate is then checked by the longest common
subsequence of content terms around the passage: at `verbatim` or more of the item it is a leak; at `paraphrase` or more
it is one if the item's answer (its last sentence) is there too, by `answer` of its terms in order.

Beside the cosine there is an exact way, so that nothing rests on how well the space represents an item: of n terms a
leak has m = ceil(paraphrase * n) in order, so at least k of them are among the item's n - m + k rarest, whatever k.
Every place where k occurrences of those terms are near enough for one passage's surroundings gives candidates too.

What could pass: a leak needs a share of an item's content terms in one passage, so a passage with fewer terms of the
vocabulary than the smallest item needs is dropped before projection, unless the exact way names it.

The benchmark is a stated query set. It is collected in rounds of ROUND items, and each round searches all documents.

Defined cases: null text is the empty text; items without a term, and empty tables, give no row; an item of fewer than
LEAST content terms is compared on all its terms; items with the same id are separate queries and the best counts;
repeated rows of documents give one row for each doc_id and item; a very long text is searched whole; other columns are
not read by `leaks`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.blocks import U64, mix
from ledgerleaf.llm.common import discard, fresh, tidy, written
from ledgerleaf.llm.substring_dedup import words_of

WIDTH, STRIDE = 64, 32
STOP_SHARE = 0.05
RANK, OVER = 128, 16
COSINE = 0.2
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.6, 0.6
LEAST = 4
ROUND = 10_000
#: Items whose rare terms are looked up at once.
SLICE = 1024
#: Entries of the matrix that are multiplied at once, and the longest run of them that is summed in one go.
ENTRIES, RUN = 1 << 16, 32
HITS = "doc_id long, item_id long, cosine double, lcs double, answer double"

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def terms_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every term and the text it is in."""
    # a byte between texts that can't be in a term keeps terms apart
    return words_of(b"".join(texts).lower(), [len(x) for x in texts], _SEPARATOR)


def batches_of(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[tuple[list, list[bytes]]]:
    """(doc_ids, texts) of about the size in bytes."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            for doc, text in zip(batch.column(0).slice(i, 64).to_pylist(), batch.column(1).slice(i, 64).cast(pa.binary()).to_pylist(), strict=True):
                ids.append(doc)
                texts.append(text or b"")
                held += len(texts[-1])
                if held >= size:
                    yield ids, texts
                    ids, texts, held = [], [], 0
    if ids:
        yield ids, texts
    tidy()


def vocabulary_places(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """The place of each hash in the ascending vocabulary, -1 for none."""
    at = np.searchsorted(vocabulary, hashes)
    at[at == len(vocabulary)] = 0
    return np.where(vocabulary[at] == hashes, at, -1)


def answer_of(text: str) -> str:
    """The last of several sentences or lines; the whole text if there is one."""
    parts = [x for x in re.split(r"(?<=[.!?])\s+|\n+", text.strip()) if re.search(r"\w", x)]
    return parts[-1] if len(parts) > 1 else text


@dataclass
class Items:
    """The queries: ids, and for each its content terms (places in the vocabulary) and those of its answer."""

    ids: list[int]
    terms: list[np.ndarray]
    answers: list[np.ndarray]
    lengths: list[int]  # in terms of any kind
    vocabulary: np.ndarray
    idf: np.ndarray


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many documents each term of the vocabulary is, and how many documents there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(vocabulary), np.int64), 0
        for _, texts in batches_of(batches):
            hashes, of = terms_of(texts)
            at = vocabulary_places(hashes, vocabulary)
            pairs = np.unique(of[at >= 0] * len(vocabulary) + at[at >= 0])
            total += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
            n += len(texts)
        held = np.flatnonzero(total)
        tidy()
        yield pa.RecordBatch.from_pydict({"term": pa.array([-1, *held], pa.int64()), "n": pa.array([n, *total[held]], pa.int64())})

    # one row for each term of the vocabulary at most
    rows = docs.select("doc_id", "text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(len(vocabulary) + 1, np.int64)
    for r in rows:
        found[r["term"]] = r["n"]
    return found[:-1], int(found[-1])


def passages(at: np.ndarray, of: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First term, end and text of each passage of a batch."""
    counts = np.bincount(of, minlength=n_texts)
    begin = np.cumsum(counts) - counts
    n = np.where(counts > 0, np.maximum(1, -(-(counts - WIDTH) // STRIDE) + 1), 0)
    text = np.repeat(np.arange(n_texts), n)
    start = begin[text] + STRIDE * (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n))
    return start, np.minimum(start + WIDTH, (begin + counts)[text]), text


def vectors(at: np.ndarray, start: np.ndarray, end: np.ndarray, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each passage the terms and their normed tf * idf."""
    out = []
    for a, b in zip(start.tolist(), end.tolist(), strict=True):
        terms, n = np.unique(at[a:b][at[a:b] >= 0], return_counts=True)
        w = n * idf[terms]
        norm = np.sqrt((w * w).sum())
        out.append((terms, w / norm if norm else w))
    return out


def passage_rows(docs: DataFrame, items: Items) -> DataFrame:
    """(h, terms, weights) of every passage with a term of the vocabulary: a hash, and its normed tf * idf."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_terms = len(items.vocabulary)
        for ids, texts in batches_of(batches):
            hashes, of = terms_of(texts)
            at = vocabulary_places(hashes, items.vocabulary)
            start, end, text = passages(at, of, len(texts))
            known = np.flatnonzero(at >= 0)
            lo, hi = np.searchsorted(known, start), np.searchsorted(known, end)
            place, row = spread(lo, hi - lo, np.arange(len(start)))
            keys, n = np.unique(row * n_terms + at[known[place]], return_counts=True)
            if not len(keys):
                continue
            row, terms = np.divmod(keys, n_terms)
            w = n * items.idf[terms]
            new = np.flatnonzero(np.diff(row, prepend=-1))
            w /= np.repeat(np.sqrt(np.add.reduceat(w * w, new)), np.diff(new, append=len(row)))
            row, bounds = row[new], pa.array([*new, len(terms)], pa.int32())
            sums = np.concatenate([np.zeros(1, U64), np.cumsum(hashes, dtype=U64)])
            h = mix(sums[end[row]] - sums[start[row]] + np.array([i or 0 for i in ids], np.int64)[text[row]].view(U64) * U64(0x9E3779B97F4A7C15))
            yield pa.RecordBatch.from_pydict({"h": pa.array(h.view(np.int64)), "terms": pa.ListArray.from_arrays(bounds, pa.array(terms)), "weights": pa.ListArray.from_arrays(bounds, pa.array(w))})

    return docs.select("doc_id", "text").mapInArrow(cut, "h long, terms array<bigint>, weights array<double>")


def sample_of(docs: DataFrame, items: Items, size: int) -> DataFrame:
    """(h, terms, weights): the passages with the smallest hashes, however the rows are dealt; for a look at the matrix, as no space is fitted on it."""
    return passage_rows(docs, items).orderBy("h").limit(size)


def run_sums(dense: np.ndarray, index: np.ndarray, weight: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each run of entries, one after the other, the sum of weight * dense[index]; the k-th entries of all runs at once."""
    if sizes.max() > RUN:
        pieces = -(-sizes // RUN)
        of = np.full(int(pieces.sum()), RUN)
        of[np.cumsum(pieces) - 1] = sizes - RUN * (pieces - 1)
        return run_sums(run_sums(dense, index, weight, of), np.arange(len(of)), np.ones(len(of), dense.dtype), pieces)
    order = np.argsort(-sizes, kind="stable")
    first, longest_first = (np.cumsum(sizes) - sizes)[order], -sizes[order]
    total = np.zeros((len(sizes), dense.shape[1]), dense.dtype)
    for k in range(-longest_first[0]):
        at = first[: np.searchsorted(longest_first, -k)] + k
        each = dense[index[at]]
        each *= weight[at, None]
        total[: len(at)] += each
    out = np.empty_like(total)
    out[order] = total
    return out


def gram_product(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """A'(A basis) for the sparse rows A, summed by Spark in chunks of terms."""
    chunk = 512
    narrow = basis.astype(np.float32)

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(narrow.shape)
        for batch in batches:
            terms, weights = (batch.column(k).flatten().to_numpy() for k in (0, 1))
            sizes = batch.column(0).value_lengths().to_numpy().astype(np.int64)
            sizes, row = sizes[sizes > 0], 0
            ends = np.cumsum(sizes)
            while row < len(sizes):
                lo = ends[row] - sizes[row]
                to = max(row + 1, int(np.searchsorted(ends, lo + ENTRIES, side="right")))
                t, w, n = terms[lo : ends[to - 1]], weights[lo : ends[to - 1]].astype(np.float32), sizes[row:to]
                image = run_sums(narrow, t, w, n)
                order = np.argsort(t, kind="stable")
                held, counts = np.unique(t, return_counts=True)
                total[held] += run_sums(image, np.repeat(np.arange(len(n)), n)[order], w[order], counts)
                row = to
        for k in range(0, len(total), chunk):
            yield pa.RecordBatch.from_pydict({"k": pa.array([k], pa.int64()), "part": pa.array([total[k : k + chunk].tobytes()], pa.binary())})
        tidy()

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in parts:
            for x in batch.column("part"):
                part = np.frombuffer(x.as_buffer())
                total = part.copy() if total is None else total + part
        yield pa.RecordBatch.from_pydict({"k": batch.column("k").slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros_like(basis)
    for r in rows.select("terms", "weights").mapInArrow(product, "k long, part binary").groupBy("k").applyInArrow(add, "k long, part binary").collect():
        got = np.frombuffer(r["part"]).reshape(-1, basis.shape[1])
        out[r["k"] : r["k"] + len(got)] = got
    return out


def latent_space(rows: DataFrame, n_terms: int, rank: int = RANK, over: int = OVER, power: int = 1, seed: int = 0) -> np.ndarray:
    """The right singular vectors (terms x rank) of the rows' matrix, by randomised SVD."""
    width = min(rank + over, n_terms)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, width)))[0]
    for _ in range(power):
        q = np.linalg.qr(gram_product(rows, q))[0]
    small = q.T @ gram_product(rows, q)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return (q @ turn[:, np.argsort(-values)[:rank]]).astype(np.float32)


def step_sums(at: np.ndarray, of: np.ndarray, counts: np.ndarray, weighted: np.ndarray) -> np.ndarray:
    """The projected TF-IDF sum of every STRIDE terms of each text, texts one after the other."""
    n_steps = -(-counts // STRIDE)
    first = np.cumsum(n_steps) - n_steps
    begin = np.cumsum(counts) - counts
    known = np.flatnonzero(at >= 0)
    step = first[of[known]] + (known - begin[of[known]]) // STRIDE
    out = np.zeros((int(n_steps.sum()), weighted.shape[1]), np.float32)
    new = np.flatnonzero(np.diff(step, prepend=-1))
    if len(new):
        out[step[new]] = np.add.reduceat(weighted[at[known]], new, axis=0)
    return out


def lcs_share(item: np.ndarray, region: list[int]) -> float:
    """Length of the longest common subsequence over the item's length; bit-parallel."""
    at: dict[int, int] = {}
    for k, t in enumerate(item.tolist()):
        at[t] = at.get(t, 0) | 1 << k
    whole = (1 << len(item)) - 1
    v = whole
    for t in region:
        u = v & at.get(t, 0)
        v = ((v + u) | (v - u)) & whole
    return (len(item) - v.bit_count()) / len(item)


def rare_terms(items: Items, paraphrase: float) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Of each item how many of its rare terms a leak holds at least; by slice of items, where each term's entries begin, and their items."""
    needs, slices = np.ones(len(items.ids), np.int64), []
    for lo in range(0, len(items.ids), SLICE):
        rare = []
        for q, terms in enumerate(items.terms[lo : lo + SLICE], lo):
            most = max(1, int(np.ceil(paraphrase * len(terms) - 1e-9)))
            needs[q] = (most + 2) // 3
            rare.append(np.unique(terms[np.argsort(-items.idf[terms], kind="stable")][: max(0, len(terms) - most + needs[q])]))
        flat, of = np.concatenate(rare), np.repeat(np.arange(lo, lo + len(rare)), [len(x) for x in rare])
        order = np.argsort(flat, kind="stable")
        slices.append((np.searchsorted(flat[order], np.arange(len(items.vocabulary) + 1)), of[order]))
    return needs, slices


def rare_candidates(at: np.ndarray, of: np.ndarray, counts: np.ndarray, n_passages: np.ndarray, lengths: np.ndarray, needs: np.ndarray, slices: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(passage, item), ascending: all whose surroundings hold enough of the item's rare terms."""
    begin, first_passage = np.cumsum(counts) - counts, np.cumsum(n_passages) - n_passages
    known = np.flatnonzero(at >= 0)
    found = [np.zeros(0, np.int64)]
    for first, item in slices:
        entry, pos = spread(first[at[known]], first[at[known] + 1] - first[at[known]], known)
        order = np.argsort(item[entry], kind="stable")
        q, pos = item[entry][order], pos[order]
        j = np.arange(len(q)) + needs[q] - 1
        i = np.flatnonzero(j < len(q))
        j = j[i]
        near = (q[j] == q[i]) & (of[pos[j]] == of[pos[i]]) & (pos[j] - pos[i] < WIDTH + 2 * lengths[q[i]])
        q, i, j = q[i][near], pos[i][near], pos[j][near]
        d = of[i]
        # the passages that have both ends in their surroundings; the last one of a text may be short
        lo = np.clip(-((begin[d] + WIDTH - 1 + lengths[q] - j) // STRIDE), 0, n_passages[d] - 1)
        hi = np.minimum((i + lengths[q] - begin[d]) // STRIDE, n_passages[d] - 1)
        if not (hi >= lo).any():
            continue
        q, lo, n = np.unique(np.stack([q, first_passage[d] + lo, hi - lo + 1])[:, hi >= lo], axis=1)
        passage, q = spread(lo, n, q)
        found.append(np.unique(passage * len(lengths) + q))
    return np.divmod(np.unique(np.concatenate(found)), len(lengths))


def spread(first: np.ndarray, n: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n numbers from each first on, and the value beside each."""
    return np.arange(int(n.sum())) + np.repeat(first - np.cumsum(n) + n, n), np.repeat(value, n)


def search(batches: Iterator[pa.RecordBatch], items: Items, space: np.ndarray, cosine: float, verbatim: float, paraphrase: float, answer: float) -> Iterator[pa.RecordBatch]:
    queries = np.zeros((len(items.ids), space.shape[1]), np.float32)
    weighted = space * items.idf[:, None].astype(np.float32)
    for k, terms in enumerate(items.terms):
        queries[k] = weighted[terms].sum(axis=0)
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-9)
    lengths = np.array([len(x) for x in items.terms])
    # an item of n terms lies in some passage by at least (WIDTH - STRIDE / 2) / n of it, or by all of it
    least = max(1, int(np.min(np.ceil(paraphrase * lengths)) // 2))
    widest = max(items.lengths)
    sets = [set(x.tolist()) for x in items.terms]
    wanted = [int(np.ceil(paraphrase * len(x) - 1e-9)) - (len(x) - len(own)) for x, own in zip(items.terms, sets, strict=True)]
    needs, slices = rare_terms(items, paraphrase)
    reaches = np.array(items.lengths)
    for ids, texts in batches_of(batches):
        hashes, of = terms_of(texts)
        at = vocabulary_places(hashes, items.vocabulary)
        start, end, text = passages(at, of, len(texts))
        known = np.concatenate([[0], np.cumsum(at >= 0)])
        could = known[end] - known[start] >= least
        counts = np.bincount(of, minlength=len(texts))
        rare, rare_item = rare_candidates(at, of, counts, np.bincount(text, minlength=len(texts)), reaches, needs, slices)
        could[rare] = True
        rare = (np.cumsum(could) - 1)[rare]
        start, end, text = start[could], end[could], text[could]
        if not len(start):
            continue
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        last = np.cumsum(counts)
        steps = step_sums(at, of, counts, weighted)
        first_step = np.cumsum(-(-counts // STRIDE)) - -(-counts // STRIDE)
        for lo in range(0, len(start), 4096):
            a, b, of_doc = start[lo : lo + 4096], end[lo : lo + 4096], text[lo : lo + 4096]
            k = first_step[of_doc] + (a - (last - counts)[of_doc]) // STRIDE
            # a passage is two steps; the second may be missing, or belong to the next text
            two = b - a > STRIDE
            points = steps[k]
            points[two] += steps[k[two] + 1]
            points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)
            cosines = points @ queries.T
            checked = cosines >= cosine
            here = slice(*np.searchsorted(rare, [lo, lo + len(a)]))
            checked[rare[here] - lo, rare_item[here]] = True
            wide_of = -1
            for k, q in zip(*(x.tolist() for x in np.nonzero(checked)), strict=True):
                d = int(of_doc[k])
                if wide_of != k:
                    wide_of, wide = k, set(at[max(last[d] - counts[d], a[k] - widest) : min(last[d], b[k] + widest)].tolist())
                # no subsequence is longer than the places of the item whose terms are here at all
                if len(sets[q] & wide) < wanted[q] or best.get((d, q), (0, 0, 0))[1] == 1:
                    continue
                reach = items.lengths[q]
                region = at[max(last[d] - counts[d], a[k] - reach) : min(last[d], b[k] + reach)]
                region = region[region >= 0].tolist()
                share = lcs_share(items.terms[q], region)
                if share < paraphrase:
                    continue
                told = lcs_share(items.answers[q], region)
                if share >= verbatim or told >= answer:
                    best[d, q] = max(best.get((d, q), (0.0, 0.0, 0.0)), (float(cosines[k, q]), share, told), key=lambda x: x[1])
        if best:
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array([ids[d] for d, _ in best], pa.int64()), "item_id": pa.array([items.ids[q] for _, q in best], pa.int64()), **{c: pa.array([v[i] for v in best.values()], pa.float64()) for i, c in enumerate(("cosine", "lcs", "answer"))}})


def prepared(docs: DataFrame, rows: list[tuple[int, str]], stop_share: float) -> Items | None:
    of_items = [terms_of([t.encode()])[0] for _, t in rows]
    if not any(len(x) for x in of_items):
        return None
    vocabulary = np.unique(np.concatenate(of_items))
    df, n = document_frequencies(docs, vocabulary)
    idf = np.log((n + 1) / (df + 1)) + 1
    content = df <= stop_share * n
    needed = content.copy()
    ids, terms, answers, lengths = [], [], [], []
    for (item, text), hashes in zip(rows, of_items, strict=True):
        if not len(hashes):
            continue
        at = vocabulary_places(hashes, vocabulary)
        own = at[content[at]] if content[at].sum() >= LEAST else at
        told = vocabulary_places(terms_of([answer_of(text).encode()])[0], vocabulary)
        told = told[np.isin(told, own)]
        needed[own] = True
        ids.append(item)
        terms.append(own)
        lengths.append(len(hashes))
        answers.append(told if len(told) else own)
    kept = np.flatnonzero(needed)
    place = np.full(len(vocabulary), -1)
    place[kept] = np.arange(len(kept))
    return Items(ids, [place[x] for x in terms], [place[x] for x in answers], lengths, vocabulary[kept], idf[kept])


def leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, verbatim: float = VERBATIM, paraphrase: float = PARAPHRASE, answer: float = ANSWER, stop_share: float = STOP_SHARE, round_size: int = ROUND) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer) of each document and item that it gives away."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = spark.createDataFrame([], HITS)
    queries = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL").orderBy("item_id", "text")
    rows: list[tuple[int, str]] = []
    batches = queries.toLocalIterator()
    while True:
        rows = [(r["item_id"], r["text"]) for r in islice(batches, round_size)]
        if not rows:
            break
        items = prepared(texts, rows, stop_share)
        if items is None:
            continue
        own = spark.createDataFrame([([int(x) for x in t], [float(x) for x in w]) for terms in items.terms for t, w in vectors(terms, np.array([0]), np.array([len(terms)]), items.idf)], "terms array<bigint>, weights array<double>")
        matrix = written(passage_rows(texts, items).select("terms", "weights").unionByName(own), "matrix")
        space = latent_space(matrix, len(items.vocabulary))
        discard(matrix)
        hits = texts.mapInArrow(lambda it, items=items, space=space: search(it, items, space, cosine, verbatim, paraphrase, answer), HITS)
        found = found.unionByName(hits)
    best = F.max_by(F.struct("cosine", "lcs", "answer"), F.struct("lcs", "cosine", "answer")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.cosine", "b.lcs", "b.answer")


def without_leaks(docs: DataFrame, benchmark: DataFrame, **limits: float) -> DataFrame:
    """The documents that give no item away; all columns of docs. Rows without a doc_id stay if no other such row leaks."""
    (doc,) = fresh(docs, "doc")
    hit = leaks(docs, benchmark, **limits).select(F.col("doc_id").alias(doc)).distinct()
    return docs.join(hit, docs["doc_id"].cast("long").eqNullSafe(F.col(doc)), "left_anti")
