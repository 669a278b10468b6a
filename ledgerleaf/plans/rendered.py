"""Reports rendered from the star schema, for queries that go from page XML to holdings, with the SQL that says the same.

`part` becomes reports of each of the formats: a brand is a document, twenty parts a page, followed by a page without the
format's header. The layout follows the format's specification: the header, a sub-fund, a table with the fields at their
offsets, and what the format's filters must keep out (lines beyond the body, deselected headings, other pages). Names
come plain, with a rate and a maturity, in two lines that are one cell, in two fonts, misspelt where the format matches
by similarity, or name nobody; some quantities can't be read. `customer` becomes plain pages for the operators on lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerleaf.functions import geometry
from ledgerleaf.functions.scalars import CANONICAL
from ledgerleaf.operators import holdings, lines as line_operators
from ledgerleaf.plans.documents import all_holdings_of, blocks_of, holdings_of
from ledgerleaf.plans.formats import SPECS, FormatSpec
from ledgerleaf.sources.pages import lines_of, unreadable, with_lines

ISSUERS = ["Alder Works", "Birch & Co", "Cedar Holdings"]
ROWS = 20
#: Formats whose names must be similar as a whole, so that they hold no rate or maturity.
SIMILAR = ("ARCA", "MEDIOLANUM")
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"))
#: Customers' keys whose lines are joined before they are joined to a page.
STRETCH = 1000


def escaped(text: Column) -> Column:
    for plain, xml in ENTITIES:
        text = F.replace(text, F.lit(plain), F.lit(xml))
    return text


def escaped_text(text: str) -> str:
    for plain, xml in ENTITIES:
        text = text.replace(plain, xml)
    return text


def font_xml(text: Column, font: Column | str) -> Column:
    chars = F.regexp_replace(escaped(text), "(?s)&(?:amp|lt|gt|quot);|.", '<char c="$0"/>')
    start = F.lit(f'<font name="{escaped_text(font)}" size="8.5">') if isinstance(font, str) else F.concat(F.lit('<font name="'), escaped(font), F.lit('" size="8.5">'))
    return F.concat(start, chars, F.lit("</font>"))


def line_xml(text: Column, x: Column, y: Column, width: Column, fonts: Column) -> Column:
    number = lambda c: c.cast("double").cast("string")
    bbox = F.concat_ws(" ", number(x), number(y), number(x + width), number(y + 8))
    return F.concat(F.lit('<line bbox="'), bbox, F.lit('" text="'), escaped(text), F.lit('">'), fonts, F.lit("</line>"))


def plain_line(text: Column | str, font: str, x: float, y: float) -> Column:
    if isinstance(text, str):
        chars = "".join(f'<char c="{escaped_text(c)}"/>' for c in text)
        return F.lit(f'<line bbox="{float(x)} {float(y)} {float(x + 40)} {float(y + 8)}" text="{escaped_text(text)}"><font name="{escaped_text(font)}" size="8.5">{chars}</font></line>')
    return line_xml(text, F.lit(x), F.lit(y), F.lit(40), font_xml(text, font))


def page_xml(lines: Column) -> Column:
    return F.concat(F.lit("<page><block>"), F.array_join(lines, ""), F.lit("</block></page>"))


def _cells(spec: FormatSpec) -> list[str]:
    """The fields of a row from left to right; the name is where the offsets are counted from."""
    at = {0: "name"} | {n: k for k, n in spec.positions.offsets().items()}
    return [at.get(n, "other") for n in range(min(at), max(at) + 1)]


def numbered_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part` with its number in its brand and its sheet, dealt out by sheets: pages are made and read by as many tasks as there are shuffle partitions.

    The rows are a hundredth of what is made of them, so by their size alone they would all go to one task.
    """
    rn = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")) - 1
    part = spark.read.parquet(f"{sf_dir}/part.parquet").withColumn("rn", rn).withColumn("sheet", F.floor(F.col("rn") / ROWS).cast("int"))
    return part.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_brand", "sheet")


def report_pages(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """(doc_id, page_idx, xml) of `part` as reports of a format."""
    spec = SPECS[name]
    key, case = F.col("p_partkey"), F.col("p_partkey") % 6
    part = numbered_parts(spark, sf_dir)
    similar = name in SIMILAR
    issuer = F.when(case == 0, "Alder Worcs" if similar else ISSUERS[0]).when(case == 1, ISSUERS[1]).when(case == 2, ISSUERS[2])
    issuer = issuer.when(case == 3, "Birch Elsewhere Unlimited" if similar else "Dune Ltd").when(case == 4, "Cedar ").otherwise(ISSUERS[0])
    due = F.date_format(F.date_add(F.lit("2030-01-01").cast("date"), (key % 300).cast("int")), "dd/MM/yyyy")
    terms = F.concat(F.lit(" "), (key % 10).cast("string"), F.lit(".00 % "), due)
    is_bond = (key % 4 == 0) & (case != 4) & F.lit(not similar)
    cents = F.floor(F.col("p_retailprice") * 100).cast("bigint")
    money = (lambda c: F.format_number((c / 100).cast("bigint"), 0)) if spec.cost_and_value_interpret_int else (lambda c: F.concat(F.format_number(F.floor(c / 100).cast("bigint"), 0), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0")))
    quantity = F.col("p_size").cast("bigint") * 1000 + key % 7
    value = {
        "name": F.concat(issuer, F.when(is_bond, terms).otherwise("")),
        "quantity": F.when(case == 5, "n/a").otherwise(F.concat(quantity.cast("string"), F.lit(".00")) if spec.quantity_interpret_float else F.format_number(quantity, 0)),
        "market_value": money(cents),
        "net_assets": F.concat((F.col("p_size") % 40).cast("string"), F.lit(" %")),
        "currency": F.when(key % 2 == 0, "USD").otherwise(" nok"),
        "acquisition_cost": money(cents * 2),
        "other": F.lit("-"),
    }
    y, width = 220 + 10 * (F.col("rn") % ROWS), 30 + 5 * (F.col("rn") % 3)
    made = []
    for k, cell in enumerate(_cells(spec)):
        x, text = F.lit(10 + 100 * k), value[cell]
        body = font_xml(text, spec.body_font)
        if cell == "name":  # every other name begins in another font
            body = F.when(key % 2 == 0, F.concat(font_xml(F.substring(text, 1, 2), "Other-Bold"), font_xml(F.substring(text, F.lit(3), F.length(text)), spec.body_font))).otherwise(body)
        made.append(line_xml(text, x, y, width, body))
        if cell == "name":
            made.append(F.when(case == 4, line_xml(F.lit("Holdings"), x, y + 8, width, font_xml(F.lit("Holdings"), spec.body_font))))
            made += [F.when(key % 3 == 0, plain_line(text, font, 10, 300)) for text, font in spec.deselect[:1]]
    rows = part.select("p_brand", "rn", "sheet", F.array_join(F.array_compact(F.array(*made)), "").alias("row"))
    pages = rows.groupBy("p_brand", "sheet").agg(F.transform(F.array_sort(F.collect_list(F.struct("rn", "row"))), lambda r: r["row"]).alias("rows"))
    sheet = F.col("sheet")
    low, high = spec.subfund_y
    fund = plain_line(F.concat(F.lit("Fund  "), sheet.cast("string")), spec.subfund_font, 10, (high - 10 if low is None else (low + high) / 2 - 4))
    top, bottom = spec.body_y
    head = [fund, *([plain_line("CHF", spec.body_font, 10, 100)] if name == "AMUNDI" else [])]
    head += [plain_line(ISSUERS[1], spec.body_font, 10, top - 40)] if isinstance(top, (int, float)) and top > 150 else []
    foot = [plain_line(ISSUERS[0], spec.body_font, 10, 900)] if bottom is not None else []
    if spec.switch:  # on every other page the anchors hold, and what stands below the second is out
        foot = [F.when(sheet % 2 == 1, F.concat(plain_line(*spec.switch[0], 10, 600), plain_line(ISSUERS[2], spec.body_font, 10, 620))), *foot]
    # out of the sub-fund's range where it is set in the same font
    header = plain_line(spec.header[0] + " 2024", spec.header[1], 10, 140 if spec.header[1] == spec.subfund_font != spec.body_font else 77)
    filled = lambda first: page_xml(F.concat(F.array(*first), F.col("rows"), F.array_compact(F.array(*foot)) if foot else F.array().cast("array<string>")))
    both = F.array(F.struct((2 * sheet).alias("page_idx"), filled([header, *head]).alias("xml")), F.struct((2 * sheet + 1).alias("page_idx"), filled(head).alias("xml")))
    return pages.select(F.col("p_brand").alias("doc_id"), F.inline(both))


def report_query(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return holdings_of(report_pages(spark, sf_dir, name), name, ISSUERS)

    return run


def report_sql(name: str, number: int | None = None) -> str:
    """number: of the format among all, for a query over them."""
    spec = SPECS[name]
    similar, cells = name in SIMILAR, _cells(spec)
    if "currency" in cells:
        currency = f"CASE WHEN p_partkey % 2 = 0 THEN '{CANONICAL['USD']}' ELSE '{CANONICAL['NOK']}' END"
    else:
        currency = f"'{CANONICAL['CHF'] if name == 'AMUNDI' else CANONICAL[spec.positions.currency]}'"
    money = (lambda c: f"CAST({c} // 100 AS DOUBLE)") if spec.cost_and_value_interpret_int else (lambda c: f"{c} / 100.0")
    cost = money("(c * 2)") if "acquisition_cost" in cells else "NULL::DOUBLE"
    bond = "false" if similar else "p_partkey % 4 = 0 AND k < 4"
    return f"""
WITH p AS (SELECT *, p_partkey % 6 AS k, CAST(floor(p_retailprice * 100) AS BIGINT) AS c, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS rn FROM part),
h AS (SELECT *, {bond} AS bond, k = 5 AS bad FROM p WHERE k <> 3)
SELECT CASE WHEN bad THEN 9999 ELSE 2 * (rn // {ROWS}) + 2 END::INT AS "Page report",
       CASE WHEN bad THEN 'quantity can''t be read' WHEN k = 0 THEN '{ISSUERS[0]}' WHEN k = 1 THEN '{ISSUERS[1]}' ELSE '{ISSUERS[2]}' END AS "Company",
       CASE WHEN bond THEN 'BOND' ELSE 'EQUITY' END AS "Financial instrument", CASE WHEN bad THEN '' ELSE 'Fund ' || (rn // {ROWS}) END AS "Sub-fund",
       CASE WHEN NOT bad THEN p_size::BIGINT * 1000 + p_partkey % 7 END::BIGINT AS "Nominal/Quantity", CASE WHEN NOT bad THEN {money("c")} END::DOUBLE AS "Market value",
       CASE WHEN bad THEN 'EUR' ELSE {currency} END AS "Currency", CASE WHEN bad THEN 0 ELSE (p_size % 40) / 100.0 END::DOUBLE AS "% Net Assets",
       CASE WHEN NOT bad THEN {cost} END::DOUBLE AS "Acquisition cost", CASE WHEN bond THEN DATE '2030-01-01' + CAST(p_partkey % 300 AS INT) END AS "Maturity",
       CASE WHEN bond THEN (p_partkey % 10) / 100.0 END::DOUBLE AS "Interest rate"{"" if number is None else f""", 'r{number}/' || p_brand AS "Report identifier", '{name}' AS "Format" """}
FROM h
"""


def report_all_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All formats' reports at once, in one plan, told apart by their identifiers; pages of an unknown format give no rows."""
    made = [report_pages(spark, sf_dir, n).withColumns({"format": F.lit(n), "report": F.concat_ws("/", F.lit(f"r{k}"), "doc_id")}) for k, n in enumerate(SPECS)]
    made.append(made[0].withColumn("format", F.lit("NONE")))
    return all_holdings_of(reduce(DataFrame.unionByName, made), ISSUERS, "report")


def all_formats_sql() -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({report_sql(n, k)}) q{k}" for k, n in enumerate(SPECS))


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nation is a document, a segment a page, a customer a line; one page a nation can't be read."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    text = F.concat(F.lit(" "), F.col("c_name"), F.lit(" <&> "))
    fonts = F.concat(font_xml(F.substring(text, 1, 3), F.concat(F.lit("Font"), (F.col("c_custkey") % 3).cast("string"))), font_xml(F.substring(text, F.lit(4), F.length(text)), "Tail"))
    x, y = F.col("c_custkey") % 500, F.col("c_custkey") % 700
    line = line_xml(text, x, y, 20 + F.col("c_custkey") % 5, fonts)
    # customers go by stretches of a page, as rows; a page is put together of few long texts, not of a row a line
    dealt = customer.select("c_custkey", "c_name", "c_nationkey", F.length("c_mktsegment").alias("n"), F.floor(F.col("c_custkey") / STRETCH).alias("stretch")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_nationkey", "n", "stretch")
    joined = lambda key, part: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, part.alias("part")))), lambda r: r["part"]), "")
    stretches = dealt.groupBy("c_nationkey", "n", "stretch").agg(joined("c_custkey", line).alias("lines"))
    pages = stretches.groupBy("c_nationkey", "n").agg(F.concat(F.lit("<page><block>"), joined("stretch", F.col("lines")), F.lit("</block></page>")).alias("xml"))
    pages = pages.select(F.col("c_nationkey").alias("doc_id"), F.col("n").alias("page_idx"), "xml")
    broken = customer.select(F.col("c_nationkey").alias("doc_id"), F.lit(99).alias("page_idx"), F.lit("<page><block>").alias("xml")).distinct()
    return pages.unionByName(broken)


_LINES_SQL = """
WITH l AS (SELECT c_nationkey AS doc_id, length(c_mktsegment)::INT AS page_idx, (row_number() OVER (PARTITION BY c_nationkey, length(c_mktsegment) ORDER BY c_custkey) - 1)::INT AS ord,
                  ' ' || c_name || ' <&> ' AS text, 'Font' || (c_custkey % 3) AS font, (c_custkey % 500)::DOUBLE AS x0, (c_custkey % 700)::DOUBLE AS y0,
                  (c_custkey % 500 + 20 + c_custkey % 5)::DOUBLE AS x1, (c_custkey % 700 + 8)::DOUBLE AS y1 FROM customer)
"""


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = F.col("box")
    out = lines_of(customer_pages(spark, sf_dir))
    return out.select("doc_id", "page_idx", "ord", "text", "content", "font", "size", F.array_join("fonts", "+").alias("fonts"), "box.*", geometry.centre(box)["x"].alias("cx"), geometry.centre(box)["y"].alias("cy"), F.size(geometry.corners(box)).alias("n_corners"), geometry.size(box)["width"].alias("width"), geometry.size(box)["height"].alias("height"), geometry.area_text(box).alias("area"))


_PAGE_LINES_SQL = _LINES_SQL + "SELECT doc_id, page_idx, ord, text, text || chr(10) AS content, font, 8.5::DOUBLE AS size, font || '+Tail' AS fonts, x0, y0, x1, y1, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy, 4 AS n_corners, x1 - x0 AS width, y1 - y0 AS height, '(' || x0 || ',' || y0 || ')-(' || x1 || ',' || y1 || ')' AS area FROM l"


def page_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unreadable(customer_pages(spark, sf_dir))


def damaged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' pages, a nation and segment each, whose lines are whole, don't close their font, or (the last) are cut off within a tag or behind one."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    key, name = F.col("c_custkey"), F.col("c_name")
    start = F.concat(F.lit('<line bbox="1 2 3 4" text="'), name, F.lit('"><font name="A" size="8"><char c="x"/>'))
    whole, unclosed = F.concat(start, F.lit('<char c=" "/></font></line>')), F.concat(start, F.lit("</line>"))
    kind = key % 3
    line = F.struct(key.alias("key"), F.when(kind == 0, unclosed).otherwise(whole).alias("line"), F.when(kind == 1, F.concat(start, F.lit('<char c="y'))).otherwise(F.lit('<line bbox="1 2')).alias("cut"))
    pages = customer.groupBy("c_nationkey", F.length("c_mktsegment").alias("n")).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    kept = F.transform(F.slice("lines", 1, F.size("lines") - 1), lambda x: x["line"])
    return pages.select(F.col("c_nationkey").alias("doc_id"), F.col("n").alias("page_idx"), F.concat(F.lit("<page><block>"), F.array_join(kept, "\n"), F.element_at("lines", -1)["cut"]).alias("xml"))


def page_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(damaged_pages(spark, sf_dir)).select("doc_id", "page_idx", "ord", "text", "content", "font", F.size("fonts").alias("n_fonts"))


_RECOVERED_SQL = """
WITH c AS (SELECT c_nationkey AS doc_id, length(c_mktsegment)::INT AS page_idx, c_name AS text, c_custkey % 3 AS kind, row_number() OVER w AS rn, count(*) OVER (PARTITION BY c_nationkey, length(c_mktsegment)) AS n
           FROM customer WINDOW w AS (PARTITION BY c_nationkey, length(c_mktsegment) ORDER BY c_custkey))
SELECT doc_id, page_idx, (rn - 1)::INT AS ord, text, CASE WHEN rn = n OR kind = 0 THEN 'x' ELSE 'x ' END || chr(10) AS content, 'A' AS font, 1 AS n_fonts FROM c WHERE rn < n OR kind = 1
"""


def lines_by_font(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a font, lines with a text and a font, and the first such line of each page."""
    found = lines_of(customer_pages(spark, sf_dir))
    conditions = {"font": line_operators.has_font("Font1"), "both": line_operators.with_text_and_font("7", "Font2"), "tail": line_operators.with_text_and_font("00", "Tail")}
    first = line_operators.lines_with_text_and_font(found, "7", "Tail", first=True).withColumn("kind", F.lit("first"))
    return reduce(DataFrame.unionByName, [rows.select("kind", "doc_id", "page_idx", "ord", "text") for rows in (line_operators.kinds_of(found, conditions), first)])


_BY_FONT_SQL = _LINES_SQL + """
SELECT 'font' AS kind, doc_id, page_idx, ord, text FROM l WHERE font = 'Font1' UNION ALL SELECT 'both', doc_id, page_idx, ord, text FROM l WHERE font = 'Font2' AND contains(text, '7')
UNION ALL SELECT 'tail', doc_id, page_idx, ord, text FROM l WHERE contains(text, '00')
UNION ALL (SELECT 'first', doc_id, page_idx, ord, text FROM l WHERE contains(text, '7') QUALIFY row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY ord) = 1)
"""


def lines_by_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose centre is in an area, or not, lines wholly in it, and the exact test of a position."""
    box = F.col("box")
    conditions = {"inside": geometry.is_inside(box, (100, 300), (None, 400)), "outside": ~geometry.is_inside(box, (100, 300), (None, 400)), "contained": geometry.is_contained(box, (100, 300), (50, None)), "positioned": geometry.is_positioned(box, (100, 300), (50, 400))}
    return line_operators.kinds_of(lines_of(customer_pages(spark, sf_dir)), conditions).select("kind", "doc_id", "page_idx", "ord")


_BY_AREA_SQL = _LINES_SQL + """, c AS (SELECT *, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy FROM l)
SELECT 'inside' AS kind, doc_id, page_idx, ord FROM c WHERE cx BETWEEN 100 AND 300 AND cy <= 400 UNION ALL SELECT 'outside', doc_id, page_idx, ord FROM c WHERE NOT (cx BETWEEN 100 AND 300 AND cy <= 400)
UNION ALL SELECT 'contained', doc_id, page_idx, ord FROM c WHERE x0 >= 100 AND x1 <= 300 AND y0 >= 50 UNION ALL SELECT 'positioned', doc_id, page_idx, ord FROM c WHERE cx BETWEEN 100 AND 300 AND cy BETWEEN 50 AND 400
"""


def report_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blocks of ANIMA's rendered reports, whose body ends at an anchor on every other page."""
    blocks = blocks_of(with_lines(report_pages(spark, sf_dir, "ANIMA")), SPECS["ANIMA"])
    return blocks.select("doc_id", "page_idx", "table_col", "subfund", F.trim(F.translate("content", "\n", "")).alias("cell"), holdings.describe_block().alias("described"))


_BLOCKS_SQL = f"""
WITH p AS (SELECT *, p_partkey % 6 AS k, CAST(floor(p_retailprice * 100) AS BIGINT) AS c, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS rn FROM part),
q AS (SELECT *, p_size::BIGINT * 1000 + p_partkey % 7 AS q, CASE k WHEN 1 THEN '{ISSUERS[1]}' WHEN 2 THEN '{ISSUERS[2]}' WHEN 3 THEN 'Dune Ltd' WHEN 4 THEN 'Cedar' ELSE '{ISSUERS[0]}' END AS name FROM p),
b AS (SELECT *, 0 AS table_col, CASE WHEN k = 5 THEN 'n/a' ELSE format('{{:,}}', q) END AS cell FROM q
      UNION ALL SELECT *, 1, name || CASE WHEN p_partkey % 4 = 0 AND k <> 4 THEN ' ' || (p_partkey % 10) || '.00 % ' || strftime(DATE '2030-01-01' + CAST(p_partkey % 300 AS INT), '%d/%m/%Y') ELSE '' END FROM q
      UNION ALL SELECT *, 1, 'Holdings' FROM q WHERE k = 4
      UNION ALL SELECT *, 2, format('{{:,}}', c // 100) FROM q UNION ALL SELECT *, 3, (p_size % 40) || ' %' FROM q)
SELECT p_brand AS doc_id, (2 * (rn // {ROWS}))::INT AS page_idx, table_col, 'Fund  ' || (rn // {ROWS}) AS subfund, cell,
       '[page ' || 2 * (rn // {ROWS}) || ', column ' || table_col || '] ' || cell || CASE WHEN cell = 'Cedar' THEN ' ' ELSE '' END || chr(10) AS described FROM b
"""


def range_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and texts of ranges with both sides and with open ones, and whether rows agree in some of their fields."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size", "p_brand")
    made = lambda a, b: F.struct(a.cast("double").alias("start"), b.cast("double").alias("end"))
    none = F.lit(None).cast("double")
    size = F.col("p_size")
    closed, opened = made(size, size * 2), made(none, size)
    fixed = geometry.range_struct(3, None)
    one, two = F.struct((F.col("p_partkey") % 2).alias("a"), F.when(size > 20, size).alias("b")), F.struct((F.col("p_partkey") % 3).alias("a"), F.when(size > 20, size).alias("b"))
    return part.select("p_partkey", geometry.range_size(closed).alias("size"), geometry.range_size(opened).alias("open_size"), geometry.range_text(closed).alias("shown"), geometry.range_text(opened).alias("open_shown"), geometry.range_text(fixed).alias("fixed"), holdings.equal_rows(one, two, ["a", "b"]).alias("same"))


_RANGES_SQL = "SELECT p_partkey, p_size::DOUBLE AS size, NULL::DOUBLE AS open_size, '[' || p_size::DOUBLE || ':' || (p_size * 2)::DOUBLE || ']' AS shown, '[-:' || p_size::DOUBLE || ']' AS open_shown, '[3.0:-]' AS fixed, p_partkey % 2 = p_partkey % 3 AS same FROM part"

QUERIES = {f"report_{n.lower()}": report_query(n) for n in SPECS} | {f.__name__: f for f in (page_lines, page_unreadable, lines_by_font, lines_by_area, report_blocks, range_values, report_all_formats, page_recovered)}
ORACLES = {f"report_{n.lower()}": report_sql(n) for n in SPECS} | {
    "page_lines": _PAGE_LINES_SQL,
    "page_unreadable": "SELECT DISTINCT c_nationkey AS doc_id, 99 AS page_idx FROM customer",
    "lines_by_font": _BY_FONT_SQL,
    "lines_by_area": _BY_AREA_SQL,
    "report_blocks": _BLOCKS_SQL,
    "range_values": _RANGES_SQL,
    "report_all_formats": all_formats_sql(),
    "page_recovered": _RECOVERED_SQL,
}
