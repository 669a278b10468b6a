"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.llm import alignment, decontamination, licenses, line_rules, mixing, ngram_join, piece_transducer, pii, ranking, rule_ensemble, token_files
from ledgerleaf.llm.common import table
from ledgerleaf.llm.substring_dedup import dedup_substrings
from ledgerleaf.llm.suffix_dedup import dedup_bytes


def op1_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rule_ensemble.score(docs, rule_ensemble.train(docs, table(spark, sf_dir, "labels")))


def op2_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "utf-8"), 256).alias("kept_sha256"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_piece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_transducer.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in pii.PATTERNS], F.sha2(F.encode(pii.as_text(F.col("spans")), "utf-8"), 256).alias("base_sha256"), pii.as_text(F.col("all_spans")).alias("spans"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # the documents have no paths of their own: a directory for each source and language
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.col("doc_id").cast("string"))
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.new_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.digests(spark, path)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(table(spark, sf_dir, "documents"))


def op11_ranked_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    apart = F.col("sale_id").isNotNull() & (F.crc32(F.col("sale_id").cast("string").cast("binary")) % 5 == 0)

    def key(value: Column) -> Column:
        return F.when(apart, F.lit(-1)).otherwise(value).cast("long")

    def rounded(value: Column) -> Column:  # a double that is no number of a long's range is none
        whole = F.floor(F.lit(100) * value + 0.5)
        return F.when(F.abs(value) < 9e16, whole).cast("long")

    lines = table(spark, sf_dir, "sale_lines").select(
        key(F.col("vendor_id")).alias("vendor_id"),
        key(F.coalesce(F.col("item_id") % 2, F.lit(-1))).alias("part"),
        key(F.coalesce(100 * F.year("shipped_at") + F.month("shipped_at"), F.lit(-1))).alias("month"),
        F.col("sale_id").cast("long").alias("sale_id"),
        F.col("line_no").cast("long").alias("line_no"),
        F.col("quantity").cast("long").alias("quantity"),
        F.floor(F.col("quantity") / 10).cast("long").alias("tens"),
        rounded(F.col("discount")).alias("percent"),
        rounded(F.col("amount")).alias("amount_cents"),
    )
    out = ranking.ranked(lines, ["vendor_id", "part", "month"], [("tens", True), ("percent", False)], ["sale_id", "line_no", "quantity", "amount_cents"], top=5)
    return out.select("vendor_id", "part", "month", "pos", "place", "sale_id", "line_no", "quantity", "percent", "amount_cents", "tied")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_rule_ensemble": op1_rule_ensemble,
    "op2_line_rules": op2_line_rules,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_piece_transducer": op5_piece_transducer,
    "op6_decontamination": op6_decontamination,
    "op7_pii": op7_pii,
    "op8_licenses": op8_licenses,
    "op9_token_files": op9_token_files,
    "op10_ngram_join": op10_ngram_join,
    "op11_ranked_ties": op11_ranked_ties,
    "op12_alignment": op12_alignment,
    "op13_mixing": op13_mixing,
}

#: Word positions restart in each document; lists are 1-based.
OP2_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce('s' || source, 'n') AS host,
                  string_split(coalesce(text, ''), chr(10)) AS lines,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
l0 AS (SELECT doc_id, host, text, unnest(lines) AS line FROM d),
l1 AS (SELECT doc_id, host, text, line, regexp_replace(translate(lower(line), '123456789', '000000000'), '[\\x20\\x09-\\x0D]', '', 'g') AS norm,
              len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n FROM l0 WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l1 GROUP BY doc_id),
hosts AS (SELECT host, count(DISTINCT text) AS host_texts FROM d GROUP BY host),
freq AS (SELECT host, norm FROM (SELECT host, norm, count(DISTINCT text) AS n_texts FROM l1 GROUP BY host, norm) JOIN hosts USING (host)
         WHERE n_texts > {line_rules.MAX_TEXTS} OR n_texts > {line_rules.MIN_TEXTS} AND n_texts > {line_rules.SHARE} * host_texts),
gone AS (SELECT doc_id, sum(n) AS removed FROM l1 SEMI JOIN freq USING (host, norm) GROUP BY doc_id),
t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
g AS (SELECT doc_id, i, word, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, w3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, word, w2, w3) > 1 AS twice FROM g),
c AS (SELECT doc_id, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS inside FROM r),
rep AS (SELECT doc_id, count(*) FILTER (inside) AS n FROM c GROUP BY doc_id),
b AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(removed, 0)::BIGINT AS removed_words
      FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)),
f AS (SELECT *, n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words - removed_words >= {line_rules.LEAST_KEPT} * n_words AS kept, removed_words FROM f
"""

#: Windows around licence words, scored once each against the clauses; all directories above a path are joined.
_ANCHORS = ", ".join(f"'{w}'" for w in licenses.ANCHORS)
_CLAUSES = ", ".join("({0[0]!r}, {0[1]}, {0[2]}, {0[3]}, {0[4]}, '{1}')".format(c, c[5].replace("'", "''")) for c in licenses.clauses())
OP8_SQL = f"""
WITH cl AS (SELECT * FROM (VALUES {_CLAUSES}) AS v(license, template, n_clauses, clause, size, phrase)),
d AS (SELECT doc_id, concat_ws('/', coalesce(source, '-'), coalesce(lang, '-'), doc_id::VARCHAR) AS path, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS t FROM documents),
a AS (SELECT doc_id, i AS pos FROM (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) - 1 AS i FROM d) WHERE w IN ({_ANCHORS})),
z AS (SELECT unnest({list(licenses.SIZES)}) AS size),
p AS (SELECT DISTINCT doc_id, size, k * greatest(1, size // 4) AS start
      FROM (SELECT doc_id, size, unnest(range(greatest(0, ceil((pos - size + 1) / greatest(1, size // 4)))::BIGINT, pos // greatest(1, size // 4) + 1)) AS k FROM a, z)),
held AS (SELECT doc_id, len(t) AS n_words, size, start, array_to_string(t[start + 1:start + size], ' ') AS words FROM p JOIN d USING (doc_id)),
u AS (SELECT DISTINCT size, words FROM held),
ct AS (SELECT size, clause, term, count(*) AS tf FROM (SELECT size, clause, unnest(regexp_extract_all(lower(phrase), '[\\p{{L}}\\p{{N}}]+')) AS term FROM cl) GROUP BY ALL),
ut AS (SELECT size, words, term, count(*) AS tf FROM (SELECT size, words, unnest(string_split(words, ' ')) AS term FROM u) WHERE term IN (SELECT term FROM ct) GROUP BY ALL),
idf AS (SELECT term, ln(((SELECT count(*) FROM u) + (SELECT count(*) FROM cl) + 1)::DOUBLE / (count(*) + 1)) + 1 AS idf
        FROM (SELECT term FROM ut UNION ALL SELECT term FROM ct) GROUP BY term),
uw AS (SELECT size, words, term, tf * idf AS w FROM ut JOIN idf USING (term)),
cw AS (SELECT size, clause, term, tf * idf AS v FROM ct JOIN idf USING (term)),
un AS (SELECT size, words, sqrt(sum(w * w)) AS un FROM uw GROUP BY ALL),
cn AS (SELECT clause, sqrt(sum(v * v)) AS cn FROM cw GROUP BY ALL),
s AS (SELECT size, words, clause, round(dot / cn / un, 6) AS score FROM (SELECT size, words, clause, sum(w * v) AS dot FROM uw JOIN cw USING (size, term) GROUP BY ALL) JOIN cn USING (clause) JOIN un USING (size, words)),
hit AS (SELECT * FROM held JOIN s USING (size, words) WHERE score >= {licenses.LEAST}),
cover AS (SELECT doc_id, count(DISTINCT i) AS line_words, max(n_words) AS n_words FROM (SELECT doc_id, n_words, unnest(range(start, least(start + size, n_words))) AS i FROM hit
          QUALIFY row_number() OVER (PARTITION BY doc_id, clause ORDER BY score DESC, start) = 1) GROUP BY doc_id),
tot AS (SELECT doc_id, license, template, n_clauses, round(sum(score), 6) AS total FROM (SELECT doc_id, clause, max(score) AS score FROM hit GROUP BY ALL) JOIN cl USING (clause) GROUP BY ALL),
own AS (SELECT doc_id, license, round(total / n_clauses, 6) AS score FROM tot QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(total * total / n_clauses, 6) DESC, license, total / n_clauses DESC) = 1),
h AS (SELECT doc_id, path, license, score, line_words >= {licenses.MOSTLY} * n_words AS is_file FROM own JOIN cover USING (doc_id) JOIN d USING (doc_id)),
f AS (SELECT regexp_replace(path, '/?[^/]*$', '') AS dir, license, score FROM h WHERE is_file
      QUALIFY row_number() OVER (PARTITION BY regexp_replace(path, '/?[^/]*$', '') ORDER BY score DESC, path) = 1),
up AS (SELECT doc_id, k, array_to_string(string_split(path, '/')[1:len(string_split(path, '/')) - k], '/') AS dir FROM (SELECT doc_id, path, unnest(range(1, len(string_split(path, '/')) + 1)) AS k FROM d)),
near AS (SELECT doc_id, license, score FROM up JOIN f USING (dir) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY k) = 1)
SELECT d.doc_id, d.path, coalesce(h.license, n.license) AS license, coalesce(h.score, n.score) AS score,
       CASE WHEN h.is_file THEN 'file' WHEN h.license IS NOT NULL THEN 'header' WHEN n.license IS NOT NULL THEN 'inherited' END AS origin
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN near n ON h.license IS NULL AND n.doc_id = d.doc_id
"""

#: Places by dense_rank over a sort of each group; crc32 by steps over a list of bytes, eight shifts (-1) after each.
OP11_SQL = """
WITH ids AS (SELECT sale_id, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(sale_id::VARCHAR, ''),
                 lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                 lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END)) % 5 = 0 AS apart
             FROM (SELECT DISTINCT sale_id FROM sale_lines WHERE sale_id IS NOT NULL)),
l AS (SELECT CASE WHEN apart THEN -1 ELSE vendor_id END AS vendor_id, CASE WHEN apart THEN -1 ELSE coalesce(item_id % 2, -1) END AS part,
             CASE WHEN apart THEN -1 ELSE coalesce(100 * year(shipped_at) + month(shipped_at), -1) END::BIGINT AS month, sale_id, line_no::BIGINT AS line_no,
             quantity::BIGINT AS quantity, floor(quantity / 10) AS tens, floor(100 * discount + 0.5)::BIGINT AS percent, floor(100 * amount + 0.5)::BIGINT AS amount_cents
      FROM sale_lines LEFT JOIN ids USING (sale_id)),
r AS (SELECT *, row_number() OVER (w ORDER BY tens DESC NULLS LAST, percent NULLS LAST, sale_id NULLS LAST, line_no NULLS LAST, quantity NULLS LAST, amount_cents NULLS LAST) AS pos,
             dense_rank() OVER (w ORDER BY tens DESC NULLS LAST, percent NULLS LAST) AS place, count(*) OVER (PARTITION BY vendor_id, part, month, tens, percent) AS tied
      FROM l WINDOW w AS (PARTITION BY vendor_id, part, month))
SELECT vendor_id, part, month, pos, place, sale_id, line_no, quantity, percent, amount_cents, tied FROM r WHERE place <= 5
"""

#: Sources from the one with the fewest words for its weight on: the first that isn't above its limit sets the level of the rest.
OP13_SQL = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS place FROM documents),
w AS (SELECT source, sum(size)::BIGINT AS source_size, [{", ".join(f"{float(w)}" for w in mixing.WEIGHTS)}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}] AS w FROM d GROUP BY source),
o AS (SELECT *, source_size / w AS ratio, sum({mixing.LIMIT} * source_size) OVER u AS most, sum(w) OVER u AS weighs FROM w
      WINDOW u AS (ORDER BY source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT *, (sum(source_size) OVER () - most + {mixing.LIMIT} * source_size)::DOUBLE AS rest, (sum(w) OVER () - weighs + w)::DOUBLE AS among FROM o),
level AS (SELECT rest, among FROM l WHERE {mixing.LIMIT} * source_size > rest * w / among ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT w.source, source_size, CASE WHEN {mixing.LIMIT} * source_size > rest * w / among THEN rest * w / among ELSE {mixing.LIMIT} * source_size END AS target
      FROM w LEFT JOIN level ON true),
x AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
             sum(size) OVER (PARTITION BY d.source ORDER BY place, size, doc_id ROWS UNBOUNDED PRECEDING) - size AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
       (size * (whole + CASE WHEN 2 * (target - whole * source_size - before) >= size THEN 1 ELSE 0 END))::BIGINT AS taken FROM x
"""

ORACLES: dict[str, str] = {"op2_line_rules": OP2_SQL, "op8_licenses": OP8_SQL, "op11_ranked_ties": OP11_SQL, "op13_mixing": OP13_SQL}
