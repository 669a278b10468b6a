"""Queries over the star-schema tables that exercise each operator, with the SQL that says the same.

The tables hold no reports, so fields are rendered as text first and then read by the operator. Every query reads its
whole table.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerleaf.fixed_values import CURRENCIES, FORMAT_URLS
from ledgerleaf.functions import scalars
from ledgerleaf.functions.geometry import in_range
from ledgerleaf.functions.matching import Likeness, prefix_similarity, similarity, target_match, target_prefix_match
from ledgerleaf.operators import holdings
from ledgerleaf.operators.extract import Positions, Walk, extract_holdings, merge_adjacent
from ledgerleaf.operators.layout import table_positions
from ledgerleaf.operators.lines import deselect, first_value_where, page_gate
from ledgerleaf.operators.matching import all_targets, first_target, members
from ledgerleaf.sources import control

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Terms that stand for issuers in tables without any, in order of precedence.
STAND_INS = ["the that", "and  a", "en de", "thand", "", "is the", "der die"]
_TARGETS_SQL = "(VALUES " + ", ".join(f"({i}, '{t}')" for i, t in enumerate(STAND_INS)) + ") AS tg(ord, target)"
_NORM = "trim(regexp_replace(lower({0}), '[\\s\\x0B\\x1c-\\x1f\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+', ' ', 'g'))"


def norm_sql(x: str) -> str:
    return _NORM.format(x)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stand_ins(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(STAND_INS)), "ord int, target string")


@query(f"SELECT doc_id, {norm_sql('text')} AS norm, regexp_replace({norm_sql('text')}, ' ', '', 'g') AS word FROM documents")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return read(spark, sf_dir, "documents").select("doc_id", scalars.normalize_string(text).alias("norm"), scalars.normalize_word(text, lower=True).alias("word"))


@query("""
WITH p AS (SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice * 100) AS BIGINT) AS c, l_linenumber % 4 AS k FROM lineitem)
SELECT l_orderkey, l_linenumber,
       CASE WHEN k = 0 THEN c / 100.0 WHEN k = 1 THEN c / 100.0 WHEN k = 2 AND c // 100 >= 1000000 THEN (c // 100)::DOUBLE WHEN k = 2 AND c // 100 >= 1000 THEN (c // 100) / 1000.0 ELSE (c // 100)::DOUBLE END AS money
FROM p
""")
def parse_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents, k = F.floor(F.col("l_extendedprice") * 100).cast("bigint"), F.col("l_linenumber") % 4
    whole, rest = F.expr("CAST(floor(l_extendedprice * 100) AS BIGINT) DIV 100"), F.lpad((cents % 100).cast("string"), 2, "0")
    grouped = F.format_number(whole, 0)
    text = F.when(k == 0, F.concat(grouped, F.lit("."), rest)).when(k == 1, F.concat(F.translate(grouped, ",", "."), F.lit(","), rest)).when(k == 2, grouped).otherwise(F.concat(F.lit("( "), whole.cast("string"), F.lit(" )")))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", scalars.to_float(text).alias("money"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 2 THEN NULL ELSE CAST(floor(l_extendedprice) AS BIGINT) END AS whole FROM lineitem")
def parse_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole, k = F.floor("l_extendedprice").cast("bigint"), F.col("l_linenumber") % 3
    grouped = F.format_number(whole, 0)
    text = F.when(k == 0, grouped).when(k == 1, F.concat(F.lit(" "), F.translate(grouped, ",", " "), F.lit(",00"))).otherwise(F.concat(whole.cast("string"), F.lit(",5")))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", scalars.to_int(text).alias("whole"))


@query("SELECT l_orderkey, l_linenumber, CAST(round(l_discount * 100) AS INT) / 100.0 AS share, CAST(round(l_tax * 100) AS INT)::DOUBLE AS raw FROM lineitem")
def parse_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = lambda c: F.round(F.col(c) * 100).cast("int").cast("string")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", scalars.perc_to_float(F.concat(whole("l_discount"), F.lit(" %")), norm=False).alias("share"), scalars.perc_to_float(F.concat(whole("l_tax"), F.lit(",0")), norm=False).alias("raw"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders
""")
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 6
    text = F.lit(None).cast("string")
    for i, layout in enumerate(("yyyy-MM-dd", "dd/MM/yyyy", "dd/MM/yy", "MM-dd-yyyy", "dd-MM-yy", "yyyy/MM/dd")):
        text = F.when(k == i, F.date_format("o_orderdate", layout)).otherwise(text)
    return read(spark, sf_dir, "orders").select("o_orderkey", scalars.to_date(text).alias("day"))


_CODES = [code for code, _ in CURRENCIES]


@query("SELECT c_custkey, list_element([" + ", ".join(f"'{scalars.CANONICAL[c]}'" for c in _CODES) + f"], CAST(c_custkey % {len(_CODES) + 1} AS INT) + 1) AS currency, list_element([" + ", ".join(f"'{c}'" for c in _CODES) + f"], CAST(c_custkey % {len(_CODES) + 1} AS INT) + 1) AS code FROM customer")
def currency_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.get(F.array(*[F.lit(f" {c.lower()}") for c in _CODES], F.lit("???")), (F.col("c_custkey") % (len(_CODES) + 1)).cast("int"))
    return read(spark, sf_dir, "customer").select("c_custkey", scalars.to_currency(text).alias("currency"), scalars.to_currency(text, canonical=False).alias("code"))


_JOIN_SQL = f"FROM documents JOIN {_TARGETS_SQL} ON {norm_sql('target')} <> '' AND contains({norm_sql('text')}, {norm_sql('target')})"


@query(f"SELECT doc_id, arg_min(target, ord) AS target {_JOIN_SQL} GROUP BY doc_id")
def target_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_target(read(spark, sf_dir, "documents"), ["doc_id"], F.col("text"), stand_ins(spark), target_match)


@query(f"SELECT doc_id, ord AS target_ord, target {_JOIN_SQL}")
def target_all_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return all_targets(docs, F.col("text"), stand_ins(spark)).select("doc_id", "target_ord", "target")


_PREFIX = "(SELECT max(k) FROM range(0, least(length(a), length(b)) + 1) r(k) WHERE left(a, k::INT) = left(b, k::INT))"


@query(f"""
WITH x AS (SELECT p_partkey, {norm_sql('p_name')} AS b, {norm_sql("'Part#000001'")} AS a FROM part)
SELECT p_partkey, length(b) >= 6 AND left(b, 6) = left(a, 6) AS matched,
       CAST(list_max(list_filter(range(0, least(length(a), length(b)) + 1), lambda k: left(a, k::INT) = left(b, k::INT))) AS DOUBLE) / length(a) AS similarity FROM x
""")
def prefix_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.lit("Part#000001")
    norm = scalars.normalize_string
    return read(spark, sf_dir, "part").select("p_partkey", target_prefix_match(0.5)(F.col("p_name"), target).alias("matched"), prefix_similarity(norm(target), norm(F.col("p_name"))).alias("similarity"))


#: Ratcliff and Obershelp: the longest common part, the first in a and then in b, and the same left and right of it.
_RATIO_SQL = """
WITH RECURSIVE p AS (SELECT DISTINCT lower(c_mktsegment) AS a, lower(p_type) AS b FROM part, customer WHERE c_mktsegment <> ''),
seg AS (SELECT a, b, 0 AS alo, length(a)::INT AS ahi, 0 AS blo, length(b)::INT AS bhi, 0 AS k FROM p
        UNION ALL
        SELECT a, b, x.alo, x.ahi, x.blo, x.bhi, x.k FROM (SELECT a, b, unnest([
            {'alo': alo, 'ahi': alo, 'blo': blo, 'bhi': blo, 'k': m.k}, {'alo': alo, 'ahi': -m.i, 'blo': blo, 'bhi': -m.j, 'k': 0}, {'alo': m.k - m.i, 'ahi': ahi, 'blo': m.k - m.j, 'bhi': bhi, 'k': 0}]) AS x
          FROM (SELECT *, list_sort(flatten(list_transform(range(alo, ahi), lambda i: list_transform(range(blo, bhi), lambda j: {
                  'k': len(list_filter(range(1, least(ahi - i, bhi - j) + 1), lambda n: substr(a, i + 1, n) = substr(b, j + 1, n)))::INT, 'i': (-i)::INT, 'j': (-j)::INT}))), 'DESC')[1] AS m
                FROM seg WHERE alo < ahi AND blo < bhi) WHERE m.k > 0)),
r AS (SELECT a, b, 2.0 * sum(k) / (length(a) + length(b)) AS ratio FROM seg GROUP BY a, b)
"""


@query(_RATIO_SQL + "SELECT p_partkey, c_mktsegment, ratio::DOUBLE AS ratio FROM part CROSS JOIN (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment <> '') JOIN r ON a = lower(c_mktsegment) AND b = lower(p_type)")
def fuzzy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The similarity of every part's type and every customer segment's name: all pairs, as the similarity itself is asked for."""
    segments = read(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_type")
    pairs = parts.join(segments, F.length("c_mktsegment") > 0)
    return pairs.select("p_partkey", "c_mktsegment", similarity(F.lower("c_mktsegment"), F.lower("p_type")).alias("ratio"))


@query(_RATIO_SQL + """SELECT p_partkey, c_mktsegment AS target FROM part CROSS JOIN (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment <> '') JOIN r ON a = lower(c_mktsegment) AND b = lower(p_type)
WHERE ratio >= 0.45""")
def fuzzy_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer segments' names that part types are alike, by candidates with rare characters in common."""
    segments = read(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("target")).distinct().withColumn("ord", F.xxhash64("target"))
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_type")
    return all_targets(parts, F.col("p_type"), segments, Likeness(ratio=0.45)).select("p_partkey", "target")


_OPENINGS_SQL = "(SELECT array_to_string(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')[2:3], ' ') AS target FROM documents)"


@query(f"SELECT DISTINCT conv_id, turn, target FROM conversations JOIN (SELECT DISTINCT target FROM {_OPENINGS_SQL} WHERE {norm_sql('target')} <> '') o ON contains({norm_sql('text')}, {norm_sql('target')})")
def target_long_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target for each different second and third word of the documents, sought in all turns by the inverted index."""
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    openings = read(spark, sf_dir, "documents").select(F.array_join(F.slice(words, 2, 2), " ").alias("target")).distinct().withColumn("ord", F.xxhash64("target"))
    turns_of = read(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return all_targets(turns_of, F.col("text"), openings).select("conv_id", "turn", "target").distinct()


@query("SELECT p_partkey, p_brand FROM part WHERE p_brand IN (SELECT DISTINCT p_brand FROM part WHERE p_size >= 45)")
def target_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    brands = part.where("p_size >= 45").select(F.col("p_brand").alias("target"))
    return members(part.select("p_partkey", "p_brand"), "p_brand", brands)


@query("SELECT c_custkey AS id, c_mktsegment AS text, c_nationkey::VARCHAR AS font FROM customer WHERE NOT ((c_mktsegment = 'BUILDING' AND c_nationkey = 3) OR (c_mktsegment = 'MACHINERY' AND c_nationkey = 7))")
def deselect_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("text"), F.col("c_nationkey").cast("string").alias("font"))
    return deselect(lines, [("BUILDING", "3"), ("MACHINERY", "7")])


@query("SELECT l_orderkey, l_linenumber, l_quantity BETWEEN 10 AND 30 AS both_sides, l_quantity <= 30 AS below, l_quantity >= 10 AS above, true AS open FROM lineitem")
def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", in_range(q, (10, 30)).alias("both_sides"), in_range(q, (None, 30)).alias("below"), in_range(q, (F.lit(10.0), F.lit(None).cast("double"))).alias("above"), in_range(q, (None, None)).alias("open"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as blocks: a turn is a block, its role's length its column."""
    return read(spark, sf_dir, "conversations").where("text IS NOT NULL").select(F.col("conv_id").alias("doc_id"), F.lit(0).alias("page_idx"), F.col("turn").alias("ord"), F.when(F.col("turn") % 3 == 0, 0).otherwise(1).alias("table_col"), F.col("text").alias("content"), F.lit("").alias("subfund"))


#: One letter pair for a target: present in some turns and not in others.
_WORD = "with the"
_WALK_SQL = f"""
WITH b AS (SELECT conv_id AS doc_id, turn AS ord, CASE WHEN turn % 3 = 0 THEN 0 ELSE 1 END AS col, text AS content FROM conversations WHERE text IS NOT NULL),
n AS (SELECT *, lead(content) OVER w AS nxt, lead(col) OVER w AS ncol, row_number() OVER w AS rn, lead(1) OVER w IS NULL AS is_last FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
c AS (SELECT *, coalesce(NOT is_last AND col = ncol AND contains({norm_sql('content || nxt')}, '{_WORD}'), false) AS cand FROM n),
s AS (SELECT *, coalesce(max(CASE WHEN NOT cand THEN rn END) OVER (PARTITION BY doc_id ORDER BY ord), 0) AS stop FROM c),
m AS (SELECT *, cand AND (rn - stop) % 2 = 1 AS merged FROM s),
p AS (SELECT *, coalesce(lag(merged) OVER w, false) AS popped,
             CASE WHEN merged THEN lead(content, 2) OVER w ELSE nxt END AS f1 FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
k AS (SELECT *, CASE WHEN merged THEN content || nxt ELSE content END AS full_content FROM p WHERE NOT popped),
o AS (SELECT *, lag(full_content) OVER w AS f_1, lag(full_content, 2) OVER w AS f_2 FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY ord))
"""


@query(_WALK_SQL + "SELECT doc_id, ord, merged, popped FROM p")
def adjacent_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_adjacent(turns(spark, sf_dir), [_WORD]).select("doc_id", "ord", "merged", "popped")


@query(_WALK_SQL + f"""
SELECT doc_id, ord, full_content AS content, f1 AS raw_quantity, f_1 AS raw_market_value, f_2 AS raw_net_assets, f1 IS NULL OR f_1 IS NULL OR f_2 IS NULL AS out_of_range
FROM o WHERE merged OR ((is_last OR col <> ncol) AND contains({norm_sql('full_content')}, '{_WORD}'))
""")
def offset_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_holdings(turns(spark, sf_dir), [_WORD], Positions(1, -1, -2), Walk())
    return out.select("doc_id", "ord", "content", "raw_quantity", "raw_market_value", "raw_net_assets", "out_of_range")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as boxes: an order is a page, the quantity and the discount give place and width."""
    x0 = F.col("l_quantity") * 10
    box = F.struct(x0.alias("x0"), F.lit(0.0).alias("y0"), (x0 + 5 + F.round(F.col("l_discount") * 100) * 8).alias("x1"), F.lit(1.0).alias("y1"))
    order = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    return read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.lit(0).alias("page_idx"), order.alias("ord"), box.alias("box"))


@query("""
WITH RECURSIVE b AS (SELECT l_orderkey AS d, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS ord, l_quantity * 10 AS x0,
                            l_quantity * 10 + 5 + round(l_discount * 100) * 8 AS x1 FROM lineitem),
s AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY x1 - x0, ord) AS k FROM b),
f AS (SELECT d, 1 AS k, [(x0 + x1) / 2] AS rulers FROM s WHERE k = 1
      UNION ALL
      SELECT f.d, s.k, CASE WHEN len(list_filter(f.rulers, lambda r: r >= s.x0 AND r <= s.x1)) > 0 THEN f.rulers ELSE list_append(f.rulers, (s.x0 + s.x1) / 2) END
      FROM f JOIN s ON s.d = f.d AND s.k = f.k + 1),
z AS (SELECT d, arg_max(rulers, k) AS rulers FROM f GROUP BY d)
SELECT s.d AS doc_id, s.ord, (list_position(list_sort(rulers), list_filter(rulers, lambda r: r >= s.x0 AND r <= s.x1)[1]) - 1)::INT AS table_col FROM s JOIN z ON s.d = z.d
""")
def table_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_positions(boxes(spark, sf_dir)).select("doc_id", "ord", "table_col")


@query("SELECT conv_id AS doc_id, turn AS ord FROM conversations WHERE conv_id IN (SELECT conv_id FROM conversations WHERE contains(text, 'the') AND role = 'user')")
def gate_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.lit(0).alias("page_idx"), F.col("turn").alias("ord"), "text", "role")
    return page_gate(lines, F.coalesce(F.col("text").contains("the") & (F.col("role") == "user"), F.lit(False))).select("doc_id", "ord")


@query("SELECT conv_id AS doc_id, turn AS ord, first_value(CASE WHEN role = 'assistant' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS subfund FROM conversations WHERE text IS NOT NULL")
def first_line_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "conversations").where("text IS NOT NULL").select(F.col("conv_id").alias("doc_id"), F.lit(0).alias("page_idx"), F.col("turn").alias("ord"), "text", "role")
    return lines.select("doc_id", "ord", first_value_where(F.col("text"), F.col("role") == "assistant").alias("subfund"))


def _bond_text() -> Column:
    rate = F.concat(F.format_number(F.col("l_discount") * 100 + 10, 2), F.lit(" %"))
    return F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("Bond "), rate, F.lit(" "), F.date_format("l_shipdate", "dd/MM/yyyy"))).when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("Note "), F.date_format("l_shipdate", "dd-MM-yy"))).otherwise(F.concat(F.lit("Share of part "), F.col("l_partkey").cast("string")))


@query("""
WITH t AS (SELECT l_orderkey, l_linenumber, l_linenumber % 3 AS k, CAST(round(l_discount * 100) AS INT) AS c, l_shipdate FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN k = 0 THEN ((c + 10) % 10)::VARCHAR || '.00 %' END AS raw_rate,
       CASE WHEN k = 0 THEN strftime(l_shipdate, '%d/%m/%Y') WHEN k = 1 THEN strftime(l_shipdate, '%d-%m-%y') END AS raw_maturity,
       CASE WHEN k = 2 THEN 'EQUITY' ELSE 'BOND' END AS instrument FROM t
""")
def bond_equity(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _bond_text()
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", scalars.interest_rate(text).alias("raw_rate"), scalars.maturity(text).alias("raw_maturity"))
    return rows.withColumn("instrument", scalars.instrument_of(F.col("raw_rate"), F.col("raw_maturity")))


@query("""
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, NULL::VARCHAR AS segment, 'S' AS "Report identifier", 'SUPPLIER' AS "Format" FROM supplier
UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment, NULL, 'CUSTOMER' FROM customer
""")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    two = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return holdings.union_jobs([(one, "SUPPLIER", "S"), (two, "CUSTOMER", None)])


def _raw_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_linenumber")
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", k.alias("page_idx"), F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("company"), F.lit(" Fund  A ").alias("subfund"), F.lit("EQUITY").alias("instrument"),
        F.when(k == 5, F.lit("n/a")).otherwise(F.col("l_quantity").cast("int").cast("string")).alias("raw_quantity"),
        F.floor("l_extendedprice").cast("string").alias("raw_market_value"),
        F.when(k == 6, F.lit("150 %")).otherwise(F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))).alias("raw_net_assets"),
        F.lit("nok").alias("raw_currency"), *[F.lit(None).cast("string").alias(f"raw_{c}") for c in ("acquisition_cost", "interest_rate", "maturity")],
    )


@query("""
WITH h AS (SELECT l_orderkey, l_linenumber, l_linenumber AS k, 'Part ' || l_partkey AS company, CAST(l_quantity AS INT) AS q, CAST(floor(l_extendedprice) AS BIGINT) AS v, CAST(round(l_discount * 100) AS INT) AS s FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN k IN (5, 6) THEN 9999 ELSE k + 2 END AS page,
       CASE WHEN k = 5 THEN 'quantity can''t be read' WHEN k = 6 THEN 'the share of net assets is not in [0, 1]' ELSE company END AS company,
       CASE WHEN k IN (5, 6) THEN '' ELSE 'Fund A' END AS subfund, CASE WHEN k IN (5, 6) THEN NULL ELSE q END::BIGINT AS quantity, CASE WHEN k IN (5, 6) THEN NULL ELSE v END::DOUBLE AS market_value,
       CASE WHEN k IN (5, 6) THEN 0 ELSE s / 100.0 END::DOUBLE AS net_assets, CASE WHEN k IN (5, 6) THEN 'EUR' ELSE 'SEK' END AS currency FROM h
""")
def holdings_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = holdings.handle_errors(holdings.validate(holdings.deserialize(_raw_holdings(spark, sf_dir))))
    return rows.select("l_orderkey", "l_linenumber", "page", "company", "subfund", "quantity", "market_value", "net_assets", "currency")


@query("""
WITH h AS (SELECT l_orderkey, l_linenumber, l_linenumber % 5 AS k, l_linenumber + 2 AS page, 'Part ' || l_partkey AS company, CAST(l_quantity AS BIGINT) AS q, floor(l_extendedprice)::DOUBLE AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN k > 2 THEN 9999 ELSE page END AS page, CASE WHEN k = 3 THEN 'expected bond or equity blocks, found NOTE' WHEN k = 4 THEN 'expected bond or equity blocks, found none' ELSE company END AS company,
       CASE k WHEN 1 THEN 'BOND' WHEN 2 THEN 'CASH' ELSE 'EQUITY' END AS instrument, CASE WHEN k < 2 THEN q END AS quantity, CASE WHEN k <= 2 THEN v END AS market_value FROM h
""")
def typed_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of five types: equities, bonds, one that is read in its own way, an unknown one, and one without a type."""
    k = F.col("l_linenumber")
    tag = F.when(k % 5 == 0, holdings.EQUITY_TARGET).when(k % 5 == 1, holdings.BOND_TARGET).when(k % 5 == 2, "CASH_TARGET").when(k % 5 == 3, "NOTE")
    raw = _raw_holdings(spark, sf_dir).withColumns({"block_type": tag, "instrument": F.when(k % 5 == 1, "BOND").otherwise("EQUITY"), "raw_net_assets": F.lit("1 %"), "raw_quantity": F.when(k % 5 != 2, F.col("l_quantity").cast("int").cast("string"))})
    cash = {"instrument": F.lit("CASH"), "quantity": F.lit(None).cast("bigint")}
    rows = holdings.handle_errors(holdings.validate(holdings.dispatch(holdings.deserialize(raw), {"CASH_TARGET": cash})))
    return rows.select("l_orderkey", "l_linenumber", "page", "company", "instrument", "quantity", "market_value")


@query("""
SELECT CAST(l_linenumber + 2 AS INT) AS "Page report", 'Part ' || l_partkey AS "Company", 'EQUITY' AS "Financial instrument", 'Fund A' AS "Sub-fund", CAST(l_quantity AS BIGINT) AS "Nominal/Quantity",
       floor(l_extendedprice)::DOUBLE AS "Market value", 'SEK' AS "Currency", CAST(round(l_discount * 100) AS INT) / 100.0 AS "% Net Assets", NULL::DOUBLE AS "Acquisition cost", NULL::DATE AS "Maturity", NULL::DOUBLE AS "Interest rate"
FROM lineitem WHERE l_linenumber NOT IN (5, 6)
""")
def holdings_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = holdings.validate(holdings.deserialize(_raw_holdings(spark, sf_dir)))
    return holdings.to_table(holdings.handle_errors(rows, holdings.DROPMALFORMED))


_URLS = [("COM", "example\\.com"), ("EN", "/en/"), ("BLOG", "^https?://blog\\."), ("SPAM", "spam")]


@query("SELECT page_id, arg_max(name, ord) AS format FROM pages JOIN (VALUES " + ", ".join(f"({i}, '{n}', '{p}')" for i, (n, p) in enumerate(_URLS)) + ") AS f(ord, name, pattern) ON regexp_matches(url, pattern) GROUP BY page_id")
def url_format_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    formats = spark.createDataFrame([(i, n, p) for i, (n, p) in enumerate(_URLS)], "ord int, format string, pattern string")
    return control.detect_formats(read(spark, sf_dir, "pages"), formats, "page_id", "url")


_FORMAT_CASES = [f"{pattern.replace('.*', 'report/')}r" for _, pattern in FORMAT_URLS]


@query("SELECT page_id, list_element([" + ", ".join(f"'{max((n for n, p in FORMAT_URLS if re.search(p, u)), key=[n for n, _ in FORMAT_URLS].index)}'" for u in _FORMAT_CASES) + f"], CAST(page_id % {len(_FORMAT_CASES) + 1} AS INT) + 1) AS format FROM pages")
def known_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The format of addresses of all known publishers' reports, and of an unknown one's."""
    url = F.get(F.array(*[F.lit(u) for u in _FORMAT_CASES], F.lit("https://nowhere/r")), (F.col("page_id") % (len(_FORMAT_CASES) + 1)).cast("int"))
    return read(spark, sf_dir, "pages").select("page_id", control.detect_format(url).alias("format"))


@query("""
WITH h AS (SELECT l_orderkey, l_linenumber, 'Part ' || l_partkey AS company, CAST(l_quantity AS BIGINT) AS q, floor(l_extendedprice)::BIGINT AS v, CAST(round(l_discount * 100) AS INT) AS s, l_linenumber + 2 AS page FROM lineitem WHERE l_linenumber NOT IN (5, 6))
SELECT 'EQUITY ' || company || '; sub-fund: Fund A; quantity: ' || q || '; value: ' || v || ' SEK; share: 0.0' || s || '; maturity: -; rate: -; page: ' || page AS described FROM h WHERE s BETWEEN 1 AND 9 AND v < 1000000
""")
def holdings_described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holdings as lines for a reader."""
    table = holdings_table(spark, sf_dir).where("`% Net Assets` BETWEEN 0.01 AND 0.09 AND `Market value` < 1000000")
    return table.withColumn("Market value", F.col("Market value").cast("bigint")).select(holdings.describe().alias("described"))


_LAST_WORDS = ["the", "and", "zzz", "of the"]
_LAST_SQL = ", ".join(f"({i}, '{t}')" for i, t in enumerate(_LAST_WORDS))


@query(f"""
WITH b AS (SELECT conv_id, turn, text FROM conversations WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1)
SELECT conv_id AS doc_id, turn AS ord, target AS company FROM b JOIN (VALUES {_LAST_SQL}) t(k, target) ON contains({norm_sql('text')}, target)
""")
def last_block_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last block of a document gives a row for each target that it names; here every block is in a column of its own."""
    blocks = turns(spark, sf_dir).withColumn("table_col", F.col("ord"))
    last = blocks.groupBy("doc_id").agg(F.max("ord").alias("ord"))
    return extract_holdings(blocks, _LAST_WORDS, Positions(1, -1, -2)).join(last, ["doc_id", "ord"]).select("doc_id", "ord", "company")


@query("SELECT page_id, coalesce(CASE WHEN page_id % 2 = 0 THEN 'EN' END, det) AS format, coalesce(page_id % 2 = 0 AND det <> 'EN', false) AS mismatch FROM (SELECT page_id, CASE WHEN contains(url, 'spam') THEN 'SPAM' WHEN contains(url, '/en/') THEN 'EN' END AS det FROM pages)")
def format_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = control.detect_format(F.col("url"), [("EN", "/en/"), ("SPAM", "spam")])
    chosen = control.reconcile(F.when(F.col("page_id") % 2 == 0, "EN"), found)
    return read(spark, sf_dir, "pages").select("page_id", chosen.alias("r")).select("page_id", "r.format", "r.mismatch")


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN true WHEN c_custkey % 4 = 1 THEN false WHEN c_custkey % 4 = 2 THEN true END AS flag FROM customer")
def str_to_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.get(F.array(F.lit(" Yes"), F.lit("OFF "), F.lit("1"), F.lit("maybe")), (F.col("c_custkey") % 4).cast("int"))
    return read(spark, sf_dir, "customer").select("c_custkey", scalars.str_to_bool(text).alias("flag"))
