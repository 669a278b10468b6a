"""Alignment against brute force over whole texts: no stretches, no blocks, all pairs of a group."""

import hashlib
import json
from collections import Counter, defaultdict

import cases
import public_tokenizers
import pytest

from ledgerleaf.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NONE = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def tokenizers():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def ends(ids, pieces):
    out, at = [], 0
    for n, p in zip(ids, pieces, strict=True):
        at += len(p)
        out.append((n, at))
    return out


def brute(texts, tokenizers):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each text."""
    a, b = tokenizers
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(n): n for n in own} | {chr(256 + k): n for k, n in enumerate(n for n in range(256) if n not in own)}
    with open(A) as f:
        entry = {n: bytes(byte[c] for c in x) for x, n in json.load(f)["model"]["vocab"].items() if n != 50256}
    made = []
    for text in texts:
        x = a.encode(" " + (text or ""), add_special_tokens=False).ids
        y = b.encode(text or "")
        ends_a = ends(x, [entry[n] for n in x])
        pieces = [bytes([int(b.id_to_piece(n)[3:5], 16)]) if b.is_byte(n) else b.id_to_piece(n).replace("▁", " ").encode() for n in y]
        ends_b = ends(y, pieces)
        if not text or b"".join(pieces) != (" " + text).encode() or b"".join(entry[n] for n in x) != (" " + text).encode():
            made.append(None)
            continue
        groups, last = [], 0
        for cut in sorted({e for _, e in ends_a} & {e for _, e in ends_b}):
            groups.append(([n for n, e in ends_a if last < e <= cut], [n for n, e in ends_b if last < e <= cut]))
            last = cut
        made.append((len(x), len(y), groups, Counter((m, n) for p, q in groups for m in p for n in q)))
    count = Counter(k for m in made if m for k in m[3])
    best = defaultdict(int)
    for (m, _), n in count.items():
        best[m] = max(best[m], n)
    out = []
    for m in made:
        if m is None:
            out.append(NONE)
            continue
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in m[2])
        out.append((m[0], m[1], len(m[2]), sum(m[3].values()), sum(n for k, n in m[3].items() if count[k] == best[k[0]]), sum(n * count[k] for k, n in m[3].items()), hashlib.sha256(text.encode()).hexdigest()))
    return out


ODD = [None, "", " ", "  ", "\n", "a  b   c", " lead", "trail ", "tab\tx \n y", "▁x", "a ▁ b", "<|endoftext|> <s> </s> <0x41>", "日本語 テキスト", "😀😀 x", "é é", "\x00 \x01", "  a  b", "don't I'll", "　   x", "x" * 3000, "\x1c a \x1f b\x85 c", "12345678 9"]


def aligned(df):
    return df.select("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_equals_brute_force(spark, tokenizers):
    df, rows = cases.documents(spark, 3, 70)
    texts = [r[1] for r in rows] + ODD
    more = spark.createDataFrame([(k if k % 3 else None, t, None, None, None) for k, t in enumerate(ODD)], cases.SCHEMA)
    both = df.unionByName(more, allowMissingColumns=True)
    want = sorted(brute(texts, tokenizers))
    assert sorted(map(tuple, aligned(alignment.align(both, A, B)).collect())) == want
    got = alignment.align(both.where("doc_id IS NOT NULL"), A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_blocks_of_any_size_give_the_same(spark, tokenizers):
    """The rows of a block, put together by hand, whether the texts are in one block or in many."""
    import pyarrow as pa

    texts = ["one two", "two one one", None, *ODD[5:10], "two, too"]
    made = [alignment.block_rows(str(k), [k], [t], alignment.pair(A, B)) for k, t in enumerate(texts)]
    rows = spark.createDataFrame(pa.concat_tables(made))
    got = alignment.summed(rows, alignment.pair_counts(rows))
    assert [tuple(r) for r in aligned(got.orderBy("doc_id")).collect()] == brute(texts, tokenizers)


def test_id_table(spark, tokenizers):
    df = spark.createDataFrame([(1, "the cat"), (2, "the dog"), (3, "the the")], "doc_id long, text string")
    a, b = tokenizers
    the = (a.encode(" the").ids[0], b.encode("the")[0])
    row = alignment.aligned_ids(df, A, B).where(f"a = {the[0]} AND b = {the[1]}").collect()
    assert [tuple(r) for r in row] == [(*the, 3, 1)]


def test_empty_table(spark):
    assert alignment.align(cases.empty(spark), A, B).collect() == []
    assert [tuple(r) for r in aligned(alignment.align(spark.createDataFrame([(1, None), (1, "")], "doc_id long, text string"), A, B)).collect()] == [NONE, NONE]


def test_long_text(spark, tokenizers):
    text = "Ein langes Wort, " * 30_000
    df = spark.createDataFrame([(1, text), (2, "y" * 200_000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in alignment.align(df, A, B).collect()}
    a, b = tokenizers
    assert got[1]["n_a"] == len(a.encode(" " + text).ids)
    assert got[1]["n_b"] == len(b.encode(text))
    assert got[2]["n_links"] >= got[2]["n_groups"] > 0
