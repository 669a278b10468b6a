"""Personal data, token files, SentencePiece and the pipeline."""

import random
import re
import time
import zlib

import cases
import numpy as np
import public_tokenizers
import pytest
from ledgerleaf.llm import piece_transducer, pii, token_files
from ledgerleaf.llm.piece_transducer import PieceTransducer, decode, encode, round_trip
from pyspark.sql import functions as F

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def spans(text):
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": lambda: True, "ip": lambda: all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m[0].split(".")), "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()  # noqa: B023
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans(spark):
    texts = ["a@b.com_x@y.org and x@y.co.uk.", "..@a..b a@b.c.d..e@f.g", "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3.256 001.002.003.004", "4111 1111 1111 1111 4111-1111-1111-1111x41111111111111111111 4", "+1 (555) 555-1234-- +123 +12345678901234567 ++1 23456789", "😀é +1 (222) 333-4444 a@b.cc\n𝒳 8.8.8.8", None, "", "a@" * 50 + "b.c", "x" * 50_000 + "@" + "y.z" * 3, " ".join(f"u{i}@ex.com" for i in range(600))]
    r = random.Random(0)
    texts += ["".join(r.choice("ab1.@+-_ %()2é\n😀") for _ in range(80)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans_0", F.lit(1))
    found = pii.find(df)
    got = {x.doc_id: x.s for x in found.select("doc_id", pii.as_text(F.col("spans")).alias("s")).collect()}
    assert got == {i: spans(t or "") for i, t in enumerate(texts)}
    clean = {x.doc_id: x.text for x in pii.sanitise(df).collect()}
    assert clean[6] is None and clean[7] == "" and clean[10] == " ".join(["<EMAIL>"] * 600)
    assert clean[5] == "😀é <PHONE> <EMAIL>\n𝒳 <IP>"
    assert pii.sanitise(df).columns == df.columns


def at_of(x):
    kind, start, end = x.split(":")
    return kind, int(start), int(end)


def disclosing(texts, least=pii.MIN_ENTITIES, reached=pii.REACHED):
    """Brute force: (terms, spans of each text)."""
    own = {}
    for t in {t or "" for t in texts}:
        found = [at_of(x) for x in spans(t).split(",") if x]
        b = list(t.replace("\x01", " "))
        for _, i, j in found:
            b[i:j] = "\x01" * (j - i)
        b = "".join(b)
        words = lambda x: set(re.findall(r"[^\W_]+", x.lower()))
        own[t] = ({(k, t[i:j]) for k, i, j in found}, words(b), words("\n".join(x for x in b.split("\n") if "\x01" in x)), b)
    q_text = sum(bool(e) for e, *_ in own.values()) / max(1, len(own))
    q_line = sum(len(n) for _, _, n, _ in own.values()) / max(1, sum(len(w) for _, w, _, _ in own.values()))
    out = set()
    for term in set().union(*[w for _, w, _, _ in own.values()]):
        held = [x for x in own.values() if term in x[1]]
        hit, near = [x for x in held if x[0]], [x for x in held if term in x[2]]
        for n, q in ((len(hit), q_text), (len(near), q_line)):
            if n >= least and len(hit) >= least and 0 < q < 1 and n / len(held) >= q ** (1 - reached) - 1e-12 and len(set().union(*[x[0] for x in hit])) >= least:
                out.add(term)
    places = {t: [f"term:{m.start()}:{m.end()}" for m in re.finditer(r"[^\W_]+", b) if m[0].lower() in out] for t, (*_, b) in own.items()}
    return out, [",".join([x for x in [spans(t or "")] if x] + places[t or ""]) for t in texts]


def term_texts(seed):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["été", "Größe", "\x01", "日本"]
    texts = [None, "", "Reachme", "secretly\x01 reachme", "one u1@a.example REACHME " * 3]
    for k in range(150):
        lines = [" ".join(r.choices(vocabulary, k=r.randint(0, 9))) for _ in range(r.randint(1, 5))]
        if r.random() < 0.3:
            i = r.randrange(len(lines))
            lines[i] += r.choice([" reachme ", " ", " Großbrief: "]) + r.choice([f"u{k % 60}@mail.example", "10.0.0.1", f"+1 (555) 000-{1000 + k}"]) + " " + r.choice(["secretly", "w1"])
            if r.random() < 0.8:
                lines.insert(0, r.choice(["token here", "Token there"]))
        texts.append("\n".join(lines))
    return texts + r.choices(texts, k=30) + [texts[-1]] * 200


def test_terms_are_those_of_brute_force(spark):
    texts = term_texts(0)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", *[f"{i} AS `{c}`" for i, c in enumerate(cases.CLASHING)]).repartition(3)
    want_terms, want = disclosing(texts)
    terms = {x.term: x for x in pii.disclosing_terms(pii.statistics(df)).collect()}
    assert set(terms) == want_terms >= {"token", "reachme"} and not want_terms & {"w2", "a", "mail", "example", "555"}
    assert [x.s for x in pii.find(df).orderBy("doc_id").select(pii.as_text(F.col("all_spans")).alias("s")).collect()] == want
    clean = pii.sanitise(df)
    assert clean.columns == df.columns
    got = [x.text for x in clean.orderBy("doc_id").collect()]
    for t, x, s in zip(texts, got, want, strict=True):
        for kind, i, j in sorted((at_of(y) for y in s.split(",") if y), key=lambda y: -y[1]):
            t = t[:i] + f"<{kind.upper()}>" + t[j:]
        assert x == t


def test_terms_at_the_edges(spark):
    assert pii.find(cases.empty(spark)).count() == pii.sanitise(cases.empty(spark)).count() == 0
    own = [f"please reachme today user{i}@mail.example" for i in range(12)]
    for texts in (
        [x + "\nsome words" for x in own] + ["words to reachme"],
        # every text has an entity, so a text's terms tell nothing and a line's do
        [x + "\nsome more words" for x in own] + [f"mail {i}\nplease, 10.0.0.{i}" for i in range(9)],
        # a group of copies changes nothing; one entity in many texts, or many in one text, is not enough
        own + [f"other things {i}" for i in range(30)] + [own[0]] * 100,
        [f"hot{i % 3} always the@same.example {i}" for i in range(40)] + [f"plain {i}" for i in range(40)],
        [" ".join(f"once u{i}@x.example" for i in range(50))] + [f"plain {i}" for i in range(40)],
    ):
        df = spark.createDataFrame([(i % 7 or None, x) for i, x in enumerate(texts)], "doc_id long, text string").repartition(2)
        want_terms, want = disclosing(texts)
        found, terms = pii.learned(df, pii.MIN_ENTITIES, pii.REACHED)
        assert {x.term for x in terms.collect()} == want_terms
        got = pii.with_spans(df, found, terms, "spans", "extra").select(pii.as_text(F.concat("spans", "extra")).alias("s"))
        assert sorted(x.s for x in got.collect()) == sorted(want)
    assert not want_terms


def test_a_very_long_text_of_many_entities(spark):
    n, m = 100_000, 20_000
    lines = [f"write token u{i}@ex.example" for i in range(n)]
    texts = ["\n".join(lines), " ".join(lines[:m])] + [f"token u{i}@ex.example" for i in range(9)] + [f"other {i}" for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    out = pii.with_spans(df, *pii.learned(df, pii.MIN_ENTITIES, pii.REACHED), "spans", "extra")
    out = out.select("doc_id", F.size("spans").alias("n"), F.size("extra").alias("m"), pii.replaced(F.col("text"), F.concat("spans", "extra")).alias("clean"))
    got = {x.doc_id: x for x in out.collect()}
    assert [got[i][1:3] for i in (0, 1, 2, 20)] == [(n, n), (m, m), (1, 1), (0, 0)]
    assert got[0].clean == "\n".join(["write <TERM> <EMAIL>"] * n) and got[1].clean == " ".join(["write <TERM> <EMAIL>"] * m)


def test_many_disclosing_terms_in_one_text(spark):
    n = 20_000
    terms = [f"t{i:05d}" for i in range(n)]
    text = "\n".join(" ".join(f"{t.upper() if i % 3 else t} plain{i}" for t in terms[i : i + 50]) for i in range(0, n, 50))
    texts = [text, " ".join(f"{t} w" for t in terms[:65]), " ".join(terms[:64]) + " W", f"ſ{terms[0]} {terms[1]}x u@a.example {terms[2]}", "none"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    chosen = spark.createDataFrame([(t,) for t in terms], "term string")
    begun = time.monotonic()
    got = {x.doc_id: x.s for x in pii.with_spans(df, pii.statistics(df), chosen, "spans", "extra").select("doc_id", pii.as_text(F.col("extra")).alias("s")).collect()}
    known = set(terms)
    assert got == {i: ",".join(f"term:{m.start()}:{m.end()}" for m in re.finditer(r"[^\W_]+", t) if m[0].lower() in known) for i, t in enumerate(texts)}
    # the product of words and terms would take minutes
    assert time.monotonic() - begun < 60


def test_token_files_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    df, rows = cases.documents(spark, seed=6)
    rows = [*rows, (500, "It's X<|endoftext|>y <|STARTOFTEXT|> don't Ångström'll", None, None, None)]
    df = df.unionByName(spark.createDataFrame(rows[-1:], cases.SCHEMA), allowMissingColumns=True)
    path = str(tmp_path / "set")
    token_files.write_tokens(df, path, WORDS, block_bytes=20_000)
    library = Tokenizer.from_file(WORDS)
    start, want = 0, {}
    for r in sorted(rows):
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 1]
        want[r[0]] = (start, np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert {x.doc_id: (x.start, bytes(x.tokens)) for x in token_files.read_tokens(spark, path).collect()} == want
    got = {x.doc_id: tuple(x)[1:] for x in token_files.digests(spark, path).collect()}
    assert got == {i: (s, len(t) // 4, zlib.crc32(t)) for i, (s, t) in want.items()}
    token_files.write_tokens(cases.empty(spark), str(tmp_path / "none"), WORDS)
    assert token_files.digests(spark, str(tmp_path / "none")).count() == 0


def test_coder_begins_at_checkpoints():
    r = np.random.default_rng(0)
    ids = np.minimum(r.geometric(0.05, 1_300_000), 400).astype(np.uint32)
    names, counts = np.unique(ids, return_counts=True)
    coder = token_files.Coder(names, token_files.slots_of(counts))
    words, states, points = coder.encode(ids)
    assert (coder.decode(words, states, len(ids)) == ids).all() and points
    for p in points:
        part = coder.decode(words, p["states"], len(ids), p["step"], p["at"], p["step"] + 3)
        assert (part == ids[p["step"] * token_files.LANES :][: len(part)]).all() and len(part)
    entropy = -(counts * np.log2(counts / len(ids))).sum() / 8
    assert len(words) + len(states) < 1.03 * entropy


def test_a_damaged_block_is_found(spark):
    names, counts = np.arange(5), np.array([5, 4, 3, 2, 1])
    coder = token_files.Coder(names, token_files.slots_of(counts))
    words, states, points = coder.encode(np.array([0, 1, 2, 3, 4], np.uint32))
    row = {"block": 1, "ids": [1], "sizes": [5], "n_tokens": 5, "words": words, "states": states, "checkpoints": points, "crc32": 1}
    import pyarrow as pa

    with pytest.raises(ValueError, match="checksum"):
        list(token_files.decoded(iter([pa.RecordBatch.from_pylist([row])]), names, token_files.slots_of(counts)))


def test_slots_keep_every_token():
    for counts in ([1], [10**12, 1, 1], [0, 3, 0, 5], list(range(1, 5000)), []):
        slots = token_files.slots_of(np.array(counts, np.int64))
        assert ((slots > 0) == (np.array(counts) > 0)).all() and slots.sum() == ((1 << token_files.SCALE) if sum(counts) else 0)


def test_pieces_are_the_librarys():
    from sentencepiece import SentencePieceProcessor

    ours, theirs = PieceTransducer(PIECES), SentencePieceProcessor(model_file=PIECES)
    r = random.Random(1)
    letters = "abcdeehinorst  \n\t0123.,!é日😀<>▁_-=//(){}"
    texts = ["", " ", "  a  b ", "x" * 3000, "Hello world", "<s></s><0x0A>"]
    for k in range(3000):
        texts.append("".join(r.choice(letters) for _ in range(r.randint(0, 40))) if k % 2 else " ".join(r.choice(["the", "hello", "1000", "    return", "ation", "ééé", "----------", "World", "Überführung"]) + r.choice(["", "s", "ing", " "]) for _ in range(6)))
    for t, ids in zip(texts, ours.encode_many(texts), strict=True):
        assert ids.tolist() == theirs.encode(t), t
        assert ours.decode(ids.tolist()) == t.replace("▁", " ")
    # the general search over all states finds the same paths, and the border's rule is that of merging
    for t in texts[:300]:
        for s in ours.stretches(t):
            assert ours.shortest_path(s) == tuple(theirs.encode(s.lstrip("▁"))) if s.startswith("▁") and not s.startswith("▁▁") and len(s) > 1 else True
    for key, weight in random.Random(0).sample(sorted(ours.arcs.items()), 300):
        if key >= 0:
            a, b = ours.text[key // len(ours.text)], ours.text[key % len(ours.text)]
            assert (weight == 0) == (ours.merged(a + b)[0] == [a, b])
    assert ours.decode([ours.of_byte[0xFF], *ours.encode("ok")]) == "� ok"


def test_pieces_over_a_table(spark):
    df, rows = cases.documents(spark, seed=9)
    out = decode(encode(df, PIECES), PIECES)
    assert out.columns == [*df.columns, "input_ids", "decoded"]
    assert {r.doc_id: r.decoded for r in out.collect()} == {r[0]: r[1] or "" for r in rows}
    assert all(r.same for r in round_trip(df, PIECES).collect()) and round_trip(cases.empty(spark), PIECES).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(2)
    text = lambda seed: "\n".join(cases.sentence(random.Random(f"{seed}-{k}"), 30) for k in range(5))
    leak = " ".join(f"q{k}{r.randint(0, 999)}" for k in range(30))
    rows = [(i, text(i), "en", "s", 0) for i in range(20)]
    rows += [(100, text(3), "en", "s", 0), (101, "too short", "en", "s", 0), (102, text(50) + "\n" + leak, "en", "s", 0), (103, text(60) + "\nwrite to me@example.org", "en", "s", 0), (104, None, None, None, None)]
    spark.createDataFrame(rows, cases.SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [name for name, _ in corpus_pipeline.STAGES] and corpus_pipeline.ORACLE_SQL is None
    out = {x.doc_id: x for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert sorted(out) == [*range(20), 103]
    assert out[103].text == text(60) + "\nwrite to <EMAIL>" and out[5].text == text(5)
    ours = PieceTransducer(PIECES)
    assert all(list(x.input_ids) == ours.encode(x.text) and x.n_tokens == len(x.input_ids) for x in out.values())
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == [f.name for f in cases.SCHEMA]


def test_pipeline_stages_stand_odd_tables(spark, tmp_path):
    import corpus_pipeline

    df, rows = cases.documents(spark, seed=21, n=40)
    df = df.unionByName(df.where("doc_id < 12")).unionByName(df.where("doc_id = 20").withColumn("doc_id", F.lit(None).cast("long")))
    spark.createDataFrame([(1, None), (None, "alpha beta"), (2, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for table, stages in ((df, corpus_pipeline.STAGES), (cases.empty(spark), corpus_pipeline.STAGES)):
        for name, stage in stages:
            out = stage(spark, table, str(tmp_path))
            ids = [r.doc_id for r in out.select("doc_id").collect()]
            if name == "SentencePiece encoding and decoding":
                assert out.columns == ["doc_id", "lang", "source", "n_tokens", "input_ids", "text"]
            else:
                assert out.columns == table.columns
            if table is not df:
                assert ids == []
            elif name == "n-gram Jaccard join":
                assert len(ids) == len(set(ids)) and {None, 0, 1, 2} <= set(ids) <= {None, *(r[0] for r in rows)}
            elif name == "quality rules":
                assert not {0, 1, 2, 3} & set(ids) and ids
            else:  # nothing is taken away
                assert len(ids) == len(rows) + 13
            if name == "PII":
                assert {r.text for r in out.where("doc_id = 0").collect()} <= {None}


def test_encoders_that_forget_give_the_same_ids(monkeypatch):
    """Little memory: words and stretches are forgotten and met again, beside odd spaces, white space and long words."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "REMEMBERED", 60)
    monkeypatch.setattr(piece_transducer, "REMEMBERED", 20)
    r = random.Random(3)
    vocabulary = ["".join(r.choice("abcdeé,.1") for _ in range(r.randint(1, 9))) for _ in range(400)] + ["x" * 500, "日本", "▁"]
    word_path, piece_path = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
    words, pieces = token_files.WordEncoder(word_path, 1), piece_transducer.PieceTransducer(piece_path)
    library, fresh = Tokenizer.from_file(word_path), piece_transducer.PieceTransducer(piece_path)
    for _ in range(30):
        texts = ["".join(r.choice(vocabulary) + r.choice([" ", " ", " ", "  ", "\n"]) for _ in range(r.randint(0, 12))).rstrip(r.choice([" ", "\n"])) for _ in range(r.randint(1, 9))]
        ids, sizes = words.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [[*library.encode(t, add_special_tokens=False).ids, 1] for t in texts]
        got = pieces.encode_many(texts)
        assert [x.tolist() for x in got] == [[i for s in fresh.stretches(t) for i in fresh.shortest_path(s)] for t in texts]
    assert len(words.number) <= 30 + 120


def test_runs_asked_of_the_model_alone_have_the_librarys_ids():
    """Runs of letters or signs, also accented, doubled, very long, or like an added token; and words that are no such run."""
    from tokenizers import Tokenizer

    r = random.Random(5)
    letters, signs = "abcdefghijklmnopqrstuvwxyzßàéöøüÿ", "!#$%&()*+,-./:;<=>?@[]^_`{|}~\"\\"
    runs = ["".join(r.choice(some) for _ in range(r.randint(1, 14))) for some in (letters, signs) for _ in range(2000)] + ["é" * 3000, "<|", "startoftext", "ÿ"]
    other = ["<|startoftext|>", "a1", "don't", "x.y", "1999", "日本", "Ä", "÷", "é", "ﬁ", "'s", "ab'", " a"]
    words = [w for w in runs for w in (w, r.choice(other))]
    library, ours = Tokenizer.from_file(WORDS), token_files.WordEncoder(WORDS, 1)
    assert ours.direct
    assert ours.encoded(words) == [library.encode(w, add_special_tokens=False).ids for w in words]


def test_rows_decoded_together_equal_rows_decoded_alone():
    """Empty rows first, between and last; bytes that are no text; control pieces; no row at all."""
    r = random.Random(7)
    ours = PieceTransducer(PIECES)
    texts = ["", "one", "", "日本 ok", "\U0001f984", " two  three ", "", ""]
    rows = [np.array(ours.encode(t), np.int32) for t in texts] + [np.array([r.randrange(len(ours.text)) for _ in range(r.randint(0, 40))], np.int32) for _ in range(300)]
    rows += [np.array([ours.of_byte[0xFF], *ours.silent], np.int32), np.zeros(0, np.int32)]
    assert ours.decode_many(rows) == [ours.decode(row.tolist()) for row in rows]
    assert ours.decode_many([np.zeros(0, np.int32)] * 2) == ["", ""] and ours.decode_many([]) == []
