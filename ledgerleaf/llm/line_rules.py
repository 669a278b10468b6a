"""Quality rules by cross-document line frequency, in DataFrame operations only.

A line is a part of a text between line feeds that holds a word. Lines are normalised (lower case, digits to 0, white
space dropped) and hashed; for each host (the source column) the distinct texts that hold a line are counted, so
that copies of one text count once: documents that are copies are left to the operators that look for near duplicates,
which keep one of them, and would all be depleted here. A line is boilerplate where it is in more than `max_texts` texts of
its host, however large the host is, or, so that small hosts have boilerplate too, in more than `share` of them and more
than `min_texts`. Boilerplate lines are removed, and a document that keeps less than `least_kept` of its words is
depleted and rejected. Beside that, base rules reject texts that are short or repeat themselves.

Plan: one pass over the texts writes the counts and line hashes of each document; lines are exploded as (host, line hash, text hash) and counted with two partial aggregations, so a host or a
line that holds a third of all rows leaves at most one row a task and key. The join that brings boilerplate lines back
to documents is salted by document.

Defined cases: null text is the empty text; a null source is a host of its own; rows with the same doc_id and text get
the same verdict; a null doc_id is a value like others; a very long text is one row, its lines an array; an empty table gives an empty table; other columns are kept by
`apply_rules` and not read by `judge`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import fresh, let, select_required, words, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_TEXTS = 20
MIN_TEXTS = 5
SHARE = 0.15
LEAST_KEPT = 0.5
SALTS = 32
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"


def chars_removed(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def n_repeat_words(tokens: Column) -> Column:
    """Of an array of words: how many lie in a 3-word window that occurs twice or more in the array."""

    def by_position(grams: Column) -> Column:
        pairs = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def flagged(s: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(s, j)["g"] == x["g"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"]))

        def total(at: Column) -> Column:
            widths = F.transform(at, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - p, F.lit(3))))
            return F.aggregate(widths, F.lit(0), lambda a, x: a + x)

        return let(let(pairs, flagged), total)

    def repeated(grams: Column) -> Column:
        some = let(F.sort_array(grams), lambda s: F.exists(F.sequence(F.lit(1), F.greatest(F.size(s) - 1, F.lit(1))), lambda i: F.coalesce(F.get(s, i) == F.get(s, i - 1), F.lit(False))))
        return F.when(some, by_position(grams)).otherwise(F.lit(0))

    def of(hashes: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(hashes) - 3), lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)))
        return F.when(F.size(hashes) < 4, F.lit(0)).otherwise(let(grams, repeated))

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), of).cast("long")


def normalised(line: Column) -> Column:
    return F.translate(F.lower(line), "123456789" + WHITE, "0" * 9)


def n_words_of(text: Column) -> Column:
    """The number of words, without making them."""
    squeezed = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    return F.when(squeezed == "", F.lit(0)).otherwise(chars_removed(squeezed, " ") + 1)


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return select_required(docs, ["doc_id", "text", "source"]).select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("host"), F.xxhash64(text).alias("text_hash"))


def scanned(docs: DataFrame) -> DataFrame:
    """One pass over the texts, written: the base columns, and of each line with a word its normal form's hash and its words."""
    rows = keyed(docs)
    text = F.col("text")

    def of_lines(lines: Column) -> Column:
        forms = F.transform(lines, lambda x: F.struct(F.xxhash64(normalised(x)).alias("line"), n_words_of(x).alias("n")))
        held = F.filter(lines, lambda x: F.length(F.translate(x, WHITE, "")) > 0)
        return let(held, lambda h: F.struct((F.size(h) - F.size(F.array_distinct(h))).cast("long").alias("n_dup_lines"), F.filter(forms, lambda y: y["n"] > 0).alias("lines")))

    found = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), n_repeat_words(w).alias("n_repeat_words")))
    rows = rows.select("doc_id", "text_hash", "host", found.alias("found"), let(F.split(text, "\n", -1), of_lines).alias("l"), (F.length(text).cast("long") - chars_removed(text, WHITE)).alias("word_chars"), chars_removed(text, SYMBOLS).alias("n_symbols"))
    rows = rows.select("doc_id", "text_hash", "host", "found.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "found.n_repeat_words", "l.lines")
    return written(rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))), "lines")


def frequent_lines(rows: DataFrame, max_texts: int, min_texts: int, share: float) -> DataFrame:
    """(host, line): the boilerplate lines of each host."""
    line = F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line")
    counted = rows.select("host", "text_hash", line).distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_texts")).where(F.col("n_texts") > min(max_texts, min_texts))
    hosts = rows.select("host", "text_hash").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_texts"))
    limit = F.least(F.lit(max_texts), F.greatest(F.lit(min_texts), share * F.col("host_texts")))
    return counted.join(hosts, "host").where(F.col("n_texts") > limit).select("host", "line")


def verdicts(rows: DataFrame, max_texts: int, min_texts: int, share: float, least_kept: float) -> DataFrame:
    """The scanned rows with removed_words, removed_lines (hashes, null for none) and kept."""
    salt = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS)).cast("int")
    here = rows.select("doc_id", "text_hash", "host", salt.alias("salt"), F.explode("lines").alias("x")).select("doc_id", "text_hash", "host", "salt", "x.line", "x.n")
    frequent = frequent_lines(rows, max_texts, min_texts, share).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hit = here.join(frequent, ["host", "line", "salt"])
    # a set of lines, so repeated rows and repeated lines don't matter; a line's form says its words but for white space
    per = hit.groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("removed_lines")).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "removed_lines")
    joined = rows.join(per, rows["doc_id"].eqNullSafe(F.col("_id")) & (rows["text_hash"] == F.col("_hash")), "left")
    lost = F.aggregate(F.filter("lines", lambda x: F.array_contains(F.col("removed_lines"), x["line"])), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    joined = joined.withColumn("removed_words", F.when(F.col("removed_lines").isNull(), F.lit(0).cast("long")).otherwise(lost))
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - F.col("removed_words") >= least_kept * F.col("n_words")))


def judge(docs: DataFrame, max_texts: int = MAX_TEXTS, min_texts: int = MIN_TEXTS, share: float = SHARE, least_kept: float = LEAST_KEPT) -> DataFrame:
    """Counts and verdict of each document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, removed_words."""
    out = verdicts(scanned(docs), max_texts, min_texts, share, least_kept)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


def apply_rules(docs: DataFrame, max_texts: int = MAX_TEXTS, min_texts: int = MIN_TEXTS, share: float = SHARE, least_kept: float = LEAST_KEPT) -> DataFrame:
    """The documents that stay, with their boilerplate lines removed; all columns of docs, text rewritten (never null)."""
    stay = verdicts(scanned(docs), max_texts, min_texts, share, least_kept).where("kept").dropDuplicates(["doc_id", "text_hash"])
    doc, key, gone = fresh(docs, "doc", "key", "gone")
    stay = stay.select(F.col("doc_id").alias(doc), F.col("text_hash").alias(key), F.col("removed_lines").alias(gone))
    text = F.coalesce(docs["text"], F.lit(""))
    joined = docs.join(stay, docs["doc_id"].cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64(text) == F.col(key)))
    rest = F.filter(F.split(text, "\n", -1), lambda x: ~F.array_contains(F.col(gone), F.xxhash64(normalised(x))))
    return joined.withColumn("text", F.when(F.col(gone).isNull(), text).otherwise(F.array_join(rest, "\n"))).select(*[F.col(f"`{c}`") for c in docs.columns])
