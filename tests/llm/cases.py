"""Small tables with the cases that every operator must stand: nulls, blank and long texts, ties, repeats, clashing columns."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Names that operators use inside.
CLASHING = ["block", "part", "line", "class", "sig", "_id", "doc_0", "key_0", "gone_0", "spans_0", "score", "kept", "N", "terms", "input", "path"]
VOCABULARY = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "Nu,", "xi.", "Omikron", "été", "größe", "日本", "😀", "a|b"]


def sentence(r: random.Random, n: int) -> str:
    return " ".join(r.choice(VOCABULARY) + (str(r.randint(0, 99)) if r.random() < 0.3 else "") for _ in range(n))


def documents(spark, seed: int = 0, n: int = 60, extra: bool = True):
    """A table of about n documents; half of them copy, whole or in part, from earlier ones."""
    r = random.Random(seed)
    texts: list[str | None] = [None, "", " \t\n\x0b\x0c\r ", "one", "one two three", "one two three", "x" * 5000, "word " * 3000, " nbsp  sep", "Ein Wort\r\nnoch eins\n\n\nEin Wort"]
    while len(texts) < n:
        kind = r.random()
        if kind < 0.5:
            texts.append("\n".join(sentence(r, r.randint(5, 60)) for _ in range(r.randint(1, 6))))
        elif kind < 0.65:
            texts.append(r.choice(texts))
        elif kind < 0.85:
            w = (r.choice(texts) or "").split(" ")
            for _ in range(r.randint(1, 3)):
                w.insert(r.randint(0, len(w)), r.choice(VOCABULARY))
            texts.append(" ".join(w))
        else:
            base = r.choice(texts) or ""
            texts.append(sentence(r, 20) + "\n" + base[len(base) // 3 :])
    rows = [(i, t, r.choice(["en", "de", None]), r.choice(["s0", "s0", "s1", None]), None if t is None else len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.selectExpr("*", *[f"{i} AS `{c}`" for i, c in enumerate(CLASHING)])
    return df.repartition(3), rows


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
