"""Candidates of contained targets are hardly more than the matches, however alike the words are."""

import random

from ledgerleaf.operators import matching
from pyspark.sql import functions as F


def test_candidates_of_several_words_are_the_matches(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice(["th", "an", "in", "er", "re", "a"]) for _ in range(r.randint(1, 4)))
    texts = [" ".join(word() for _ in range(r.randint(1, 60))) for _ in range(120)]
    names = sorted({" ".join(word() for _ in range(2)) for _ in range(400)} | {"a", "ther", "z", "an in er", "a a", "th an an a"})
    targets = matching.listed(spark.createDataFrame(list(enumerate(names)), "ord int, target string"))
    kinds = [F.lit(None).cast("double").alias(k) for k in matching.KINDS]
    found = matching.contained(spark.createDataFrame([(t,) for t in texts], "norm string").select("norm", *kinds), targets)
    hashes = {x["h"]: x["norm"] for x in spark.createDataFrame([(t,) for t in texts], "norm string").select("norm", F.xxhash64("norm").alias("h")).collect()}
    got = [(hashes[x["norm_hash"]], x["wanted"]) for x in found.collect()]
    want = {(t, n) for t in texts for n in names if n in t}
    assert len(got) == len(set(got)) and want <= set(got)
    two = lambda pairs: {x for x in pairs if x[1].count(" ") == 1}
    assert len(want) > 300 and two(got) == two(want)


def test_long_texts_and_targets_of_one_word(spark):
    text = " ".join(f"w{k}x" for k in range(20_000))
    rows = spark.createDataFrame([(1, text), (2, "w7"), (3, ""), (4, None)], "id int, text string")
    targets = spark.createDataFrame([(0, "w7x W8x"), (1, "7"), (2, "w19999x"), (3, "x w1")], "ord int, target string")
    found = matching.all_targets(rows, F.col("text"), targets).select("id", "target_ord").collect()
    assert sorted(tuple(x) for x in found) == [(1, 0), (1, 1), (1, 2), (1, 3), (2, 1)]
