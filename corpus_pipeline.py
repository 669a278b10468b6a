"""A corpus pipeline of five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's docs.
All but the last return the columns of documents; where a text was changed, n_chars follows it.

Defined cases, in every stage: an empty table gives an empty table with the stage's columns; extra columns, also of names
that operators use inside, are kept by all stages but the last, which returns its own columns; nulls in lang, source and
n_chars stay (n_chars is counted anew where a stage may change texts); equal rows have one outcome,
except that near duplicates keep a single one. What a stage does with null, empty and very long texts and with ties is said below.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.llm import decontamination, line_rules, ngram_join, piece_transducer, pii
from ledgerleaf.llm.common import table, written


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Short, repetitive and depleted documents go; boilerplate lines are removed from the others.

    Null and empty texts have no words, so they go; a text of any length is judged whole.
    """
    return _counted(line_rules.apply_rules(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest doc_id.

    Of several rows with that id one stays, by a hash of its text; rows without a doc_id stay, as nothing names the one to
    keep. Documents without words are linked with nothing and stay.
    """
    return ngram_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give a benchmark item away go.

    Null and empty texts give nothing away and stay; items without words, and an empty benchmark, take nothing away.
    """
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are generalised.

    Null texts stay null; overlapping spans become one placeholder, of the kind of the first.
    """
    return _counted(pii.sanitise(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text as token ids, beside the text that they decode to.

    Null texts are the empty text, without ids; U+2581 in a text decodes to a space.
    """
    columns = docs.select("doc_id", "lang", "source", "text")
    out = piece_transducer.encode(columns, public_tokenizers.path("piece_bpe_32k.model"), decoded="decoded")
    return out.select("doc_id", "lang", "source", F.size("input_ids").cast("long").alias("n_tokens"), "input_ids", F.col("decoded").alias("text"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII", sanitise),
    ("SentencePiece encoding and decoding", encode),
]

#: SQL has no transducers, sketches or singular vectors.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k}")
    return docs
