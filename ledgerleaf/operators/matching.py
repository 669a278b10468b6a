"""Texts against a list of targets: candidates by an equi-join on what a match must have in common, then the exact test.

A target of several words that is contained in a text has each of its spaces there, between two of the text's words: what
stands close around one of them, that which the fewest targets have, is the key of an inverted index, texts are looked up
by what stands around their spaces, and both words are compared before anything is dealt out again. A target of one word
has all its grams in a word of the text: its key is the gram that the fewest targets have. A target
whose beginning must begin the text is looked up by that beginning. A target that must be alike shares many characters:
of its characters, counted with repeats, so many rarest ones that a text without any of them can't be alike enough are
its keys, and pairs with too few characters in common are dropped before the similarity is computed. No list of targets
is paired with all texts, whatever its length; a text goes through the join as a hash, each different text once.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.functions.matching import Likeness, Match, similarity, target_match
from ledgerleaf.functions.scalars import bind, normalize_string

#: The length of a gram; targets whose longest word is shorter have it as a gram of its own length.
GRAM = 3
#: Of the word before a space and of the one behind it, so many characters are in a key: the most that the target's word has.
BEFORE, BEHIND = (1, 2, 4), (1, 3)
#: How a text is compared.
KINDS = ("prefix", "ratio")
#: Up to so many targets, contained ones are found by an expression, without a join.
SHORT_LIST = 256


def usable(targets: DataFrame) -> DataFrame:
    """Without targets that are blank."""
    return targets.where(normalize_string(F.col("target")) != "")


def listed(targets: DataFrame) -> DataFrame:
    """(target_ord, target, norm) of targets (ord, target)."""
    return usable(targets).select(F.col("ord").alias("target_ord"), "target", normalize_string(F.col("target")).alias("norm"))


def grams(word: Column, size: Column | int) -> Column:
    """The grams of a word; none where it is shorter."""
    at = F.sequence(F.lit(1), F.greatest(F.length(word) - size + 1, F.lit(1)))
    return F.when(F.length(word) >= size, F.transform(at, lambda i: F.substring(word, i, F.lit(size) if isinstance(size, int) else size))).otherwise(F.array().cast("array<string>"))


def space_key(before: Column, behind: Column) -> Column:
    """The key of a target's space."""
    most = lambda word, sizes: F.greatest(*[F.when(F.length(word) >= n, n).otherwise(sizes[0]) for n in sizes])
    return F.concat_ws(" ", F.right(before, most(before, BEFORE)), F.left(behind, most(behind, BEHIND)))


def space_keys(before: Column, behind: Column) -> Column:
    """The keys that a target may have whose space is this space of a text."""
    sizes = [(i, j) for i in BEFORE for j in BEHIND]
    return F.array_compact(F.array(*[F.when((F.length(before) >= i) & (F.length(behind) >= j), F.concat_ws(" ", F.right(before, F.lit(i)), F.left(behind, F.lit(j)))) for i, j in sizes]))


def spaces(norm: Column) -> Column:
    """The words before and behind each space of a normalised text, and whether they are its first and its last."""

    def of(words: Column) -> Column:
        return F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.struct(F.get(words, i).alias("before"), w.alias("behind"), (i == 0).alias("first"), (i == F.size(words) - 2).alias("last")))

    return bind(F.split(norm, " "), of)


def word_pairs(norm: Column) -> Column:
    """The different pairs of neighbouring words of a normalised text."""
    return bind(F.split(norm, " "), lambda words: F.array_distinct(F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", F.get(words, i), w))))


def target_keys(targets: DataFrame) -> DataFrame:
    """(target_ord, target, norm, key, before, behind, first, last) of listed targets: the space, or of one word the gram, that the fewest targets have."""
    around = F.transform(spaces(F.col("norm")), lambda x: F.struct(space_key(x["before"], x["behind"]).alias("key"), x["before"].alias("before"), x["behind"].alias("behind"), x["first"].alias("first"), x["last"].alias("last")))
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("before", "string"), ("behind", "string"), ("first", "boolean"), ("last", "boolean"))]
    inside = F.transform(F.array_distinct(grams(F.col("norm"), F.least(F.length("norm"), F.lit(GRAM)))), lambda g: F.struct(g.alias("key"), *nothing))
    spread = targets.withColumn("_at", F.explode(F.when(F.col("norm").contains(" "), around).otherwise(inside)))
    held = spread.groupBy(F.col("_at.key").alias("_key")).agg(F.count(F.lit(1)).alias("_held"))
    rarest = spread.join(held, F.col("_at.key") == F.col("_key")).groupBy("target_ord", "target", "norm").agg(F.min_by("_at", F.struct("_held", "_at")).alias("_at"))
    return rarest.select("target_ord", "target", "norm", "_at.*")


def text_grams(norm: Column, size: Column) -> Column:
    """All grams of a size of a normalised text's different words."""
    return bind(F.array_distinct(F.split(norm, " ")), lambda words: F.array_distinct(F.flatten(F.transform(words, lambda w: grams(w, size)))))


def contained(texts: DataFrame, targets: DataFrame) -> DataFrame:
    """Candidates (norm_hash, target_ord, target, wanted) of normalised texts (norm) by the inverted index of listed targets."""
    keys = target_keys(targets).withColumnsRenamed({"norm": "wanted", "before": "_before", "behind": "_behind"})
    hashed = texts.select(F.xxhash64("norm").alias("norm_hash"), "norm")
    # two words as one text, as an array of texts is made distinct by hashes and one of structs by comparing all pairs
    around = hashed.select("norm_hash", F.explode(word_pairs(F.col("norm"))).alias("_pair"))
    around = around.select("norm_hash", F.substring_index("_pair", " ", 1).alias("before"), F.substring_index("_pair", " ", -1).alias("behind"))
    around = around.withColumn("key", F.explode(space_keys(F.col("before"), F.col("behind"))))
    begins = F.when(F.col("first"), F.col("before").endswith(F.col("_before"))).otherwise(F.col("before") == F.col("_before"))
    ends = F.when(F.col("last"), F.col("behind").startswith(F.col("_behind"))).otherwise(F.col("behind") == F.col("_behind"))
    several = around.join(keys.where(F.col("_before").isNotNull()), (around["key"] == keys["key"]) & begins & ends)
    # the sizes of grams that some target of one word has: 3, 2, 1 or none
    sizes = targets.where(~F.col("norm").contains(" ")).agg(F.array_sort(F.collect_set(F.least(F.length("norm"), F.lit(GRAM))))).scalar()
    within = hashed.withColumn("_size", F.explode(sizes)).select("norm_hash", F.explode(text_grams(F.col("norm"), F.col("_size"))).alias("key"))
    single = within.join(keys.where(F.col("_before").isNull()), "key")
    found = several.select("norm_hash", "target_ord", "target", "wanted").unionByName(single.select("norm_hash", "target_ord", "target", "wanted"))
    # dealt out by texts, as they are joined back to them
    return found.repartition("norm_hash").distinct()


def beginning_size(target: Column, prefix: Column) -> Column:
    return F.ceil(F.length(target) * prefix - 1e-9).cast("int")


def beginnings(texts: DataFrame, targets: DataFrame, prefixes: Collection[float]) -> DataFrame:
    """Candidates of texts among listed targets of whose beginning the text's share of prefix must begin it."""
    keys = targets.withColumn("prefix", F.explode(F.array(*[F.lit(x) for x in sorted(prefixes)]))).withColumn("size", beginning_size(F.col("norm"), F.col("prefix"))).withColumn("key", F.left("norm", F.col("size")))
    # the lengths of beginnings are a few small numbers, whatever the number of targets: they go into the plan
    sizes = {r["prefix"]: sorted(r["sizes"]) for r in keys.groupBy("prefix").agg(F.collect_set("size").alias("sizes")).collect()}
    of_text = F.array().cast("array<int>")
    for prefix, own in sizes.items():
        of_text = F.when(F.col("prefix") == prefix, F.array(*[F.lit(n) for n in own])).otherwise(of_text)
    spread = texts.select(*KINDS, F.xxhash64("norm").alias("norm_hash"), "norm", F.explode(of_text).alias("size")).where(F.length("norm") >= F.col("size"))
    spread = spread.select(*KINDS, "norm_hash", "size", F.left("norm", F.col("size")).alias("key"))
    return spread.join(keys, ["prefix", "size", "key"]).select(*KINDS, "norm_hash", "target_ord", "target", F.col("norm").alias("wanted")).distinct()


def counted_characters(norm: Column) -> Column:
    """A text's characters, each with its number among equal ones: as sets, two texts share as many as they have in common."""

    def numbered(chars: Column) -> Column:
        return F.transform(chars, lambda c, i: F.concat(c, (i + 1 - F.array_position(chars, c)).cast("string")))

    return bind(F.array_sort(F.filter(F.split(norm, ""), lambda c: c != "")), numbered)


def sharing(texts: DataFrame, targets: DataFrame, ratios: Collection[float]) -> DataFrame:
    """Candidates of texts among listed targets that may be alike by the text's ratio, by a rare character in common.

    Alike by r, a target of n characters has at least r n / (2 - r) in common with the text.
    """
    marked = targets.withColumn("_chars", counted_characters(F.col("norm")))
    spread = marked.withColumn("key", F.explode("_chars"))
    held = spread.groupBy("key").agg(F.count(F.lit(1)).alias("_held"))
    ranked = spread.join(held, "key").withColumn("_rank", F.row_number().over(Window.partitionBy("target_ord", "target", "norm").orderBy("_held", "key")))
    n = F.length("norm")
    keys = ranked.withColumn("ratio", F.explode(F.array(*[F.lit(x) for x in sorted(ratios)]))).where(F.col("_rank") <= n - F.ceil(F.col("ratio") * n / (2 - F.col("ratio")) - 1e-9) + 1)
    marks = texts.select(*KINDS, F.xxhash64("norm").alias("norm_hash"), F.explode(counted_characters(F.col("norm"))).alias("key"))
    return marks.join(keys.select("ratio", "key", "target_ord", "target", F.col("norm").alias("wanted")), ["ratio", "key"]).select(*KINDS, "norm_hash", "target_ord", "target", "wanted").distinct()


def alike(pairs: DataFrame) -> DataFrame:
    """Of pairs (norm, wanted, ratio), those alike by ratio; only pairs with enough characters in common reach the Python function."""
    size = F.length("norm") + F.length("wanted")
    common = F.size(F.array_intersect(counted_characters(F.col("norm")), counted_characters(F.col("wanted"))))
    return pairs.where(2 * common >= F.col("ratio") * size - 1e-9).withColumn("_alike", similarity(F.col("wanted"), F.col("norm"))).where(F.col("_alike") >= F.col("ratio")).drop("_alike")


def matches(texts: DataFrame, targets: DataFrame, kinds: Collection[Likeness]) -> DataFrame:
    """(norm, prefix, ratio, target_ord, target) of different normalised texts and targets (ord, target), for each pair that matches.

    prefix and ratio say how a text is compared, null with null: contained. kinds: the likenesses that there are.
    """
    short, exact, near = listed(targets), [], []
    if any(k == Likeness() for k in kinds):
        none = {name: F.lit(None).cast("double") for name in KINDS}
        exact.append(contained(texts.where("prefix IS NULL AND ratio IS NULL"), short).withColumns(none))
    if prefixes := {k.prefix for k in kinds if k.prefix is not None}:
        found = beginnings(texts.where("prefix IS NOT NULL"), short, prefixes)
        if any(k.prefix is not None and k.ratio is None for k in kinds):
            exact.append(found.where("ratio IS NULL"))
        if any(k.prefix is not None and k.ratio is not None for k in kinds):
            near.append(found.where("ratio IS NOT NULL"))
    if ratios := {k.ratio for k in kinds if k.prefix is None and k.ratio is not None}:
        near.append(sharing(texts.where("prefix IS NULL AND ratio IS NOT NULL"), short, ratios))

    def back(found: list[DataFrame]) -> DataFrame:
        """The candidates with their texts, which a hash stood for."""
        every = reduce(DataFrame.unionByName, found).withColumnsRenamed({"prefix": "_prefix", "ratio": "_ratio"})
        same = (F.xxhash64("norm") == F.col("norm_hash")) & F.col("prefix").eqNullSafe(F.col("_prefix")) & F.col("ratio").eqNullSafe(F.col("_ratio"))
        return texts.join(every, same).select("norm", *KINDS, "target_ord", "target", "wanted")

    parts = []
    if exact:
        size = beginning_size(F.col("wanted"), F.col("prefix"))
        begins = F.left("norm", size) == F.left("wanted", size)
        parts.append(back(exact).where(F.when(F.col("prefix").isNull(), F.col("norm").contains(F.col("wanted"))).otherwise(begins)))
    if near:
        pairs = back(near)
        size = beginning_size(F.col("wanted"), F.col("prefix"))
        parts.append(alike(pairs.where(F.col("prefix").isNull() | (F.left("norm", size) == F.left("wanted", size)))))
    return reduce(DataFrame.unionByName, parts).drop("wanted")


def all_targets(rows: DataFrame, text: Column, targets: DataFrame, match: Match | Likeness = target_match) -> DataFrame:
    """rows x targets (ord, target) that match: one row for each pair, with target_ord and target.

    A predicate other than `target_match` and likenesses is any condition, for which only a loop over all pairs is left.
    """
    rows = rows.withColumn("_norm", normalize_string(text))
    if match is not target_match and not isinstance(match, Likeness):
        few = usable(targets).select(F.col("ord").alias("target_ord"), "target")
        return rows.withColumn("_text", text).join(few, match(F.col("_text"), F.col("target"))).drop("_text", "_norm")
    likeness = match if isinstance(match, Likeness) else Likeness()
    if likeness == Likeness():  # the rows themselves are compared with their candidates: texts go no further way
        found = contained(rows.where(F.col("_norm").isNotNull()).select(F.col("_norm").alias("norm")).distinct(), listed(targets))
        return rows.withColumn("norm_hash", F.xxhash64("_norm")).join(found, "norm_hash").where(F.col("_norm").contains(F.col("wanted"))).drop("_norm", "norm_hash", "wanted")
    texts = rows.where(F.col("_norm").isNotNull()).select(F.col("_norm").alias("norm"), F.lit(likeness.prefix).cast("double").alias("prefix"), F.lit(likeness.ratio).cast("double").alias("ratio")).distinct()
    found = matches(texts, targets, {likeness}).select(F.col("norm").alias("_norm"), "target_ord", "target")
    return rows.join(found, "_norm").drop("_norm")


def first_target(rows: DataFrame, key: list[str], text: Column, targets: DataFrame, match: Match | Likeness = target_match) -> DataFrame:
    """(*key, target): for each row the first target by order that matches; rows without one are left out."""
    return all_targets(rows.select(*key, text.alias("_t")), F.col("_t"), targets, match).groupBy(*key).agg(F.min_by("target", "target_ord").alias("target"))


def first_target_of(text: Column, targets: list[str], match: Match = target_match) -> Column:
    """As an expression, for a short list: no join, no shuffle. Contained targets are sought in a text that is normalised once."""

    def first(value: Column, hit) -> Column:
        out = F.lit(None).cast("string")
        for t in reversed(targets):
            if t.strip():
                out = F.when(hit(value, F.lit(t)), F.lit(t)).otherwise(out)
        return out

    if match is target_match:
        return bind(normalize_string(text), lambda norm: first(norm, lambda value, t: value.contains(normalize_string(t))))
    return first(text, match)


def members(rows: DataFrame, column: str, targets: DataFrame) -> DataFrame:
    """rows whose column is a target; the targets are broadcast only where Spark finds them small enough."""
    return rows.join(targets.select(F.col("target").alias(column)), column, "left_semi")
