"""Information-theoretic sanitisation of personal data, in DataFrame operations only.

Protected entities are the values that patterns and checks find: e-mail addresses, IP addresses (parts at most 255), card
numbers (Luhn) and phone numbers (number of digits). They are blanked before terms are read, so no term is a piece of an
entity. Corpus co-occurrence then estimates how strongly a term reveals that an entity is there, in two contexts: the term's
text and the term's line. With p the share of the distinct texts with a term in which an entity is in the same context,
and q the same share over everything (texts with an entity; pairs of a text and a term with the term on an entity's
line), log2(p / q) is the information that seeing the term gives, and -log2(q) the most that any term can give. A term
discloses where in either context it gives at least REACHED of the most, beside at least `min_entities` different
entities in as many distinct texts. Terms that disclose become spans of the kind "term" wherever they stand outside
entities, in every text. `sanitise` generalises every span to a placeholder of its kind.

The plan reads the texts twice: once for a table of statistics (distinct texts, their terms and those on lines with
entities), once to apply the terms. What is joined to the texts is the list of disclosing terms of each distinct text
that has any. Per-text work is linear in the text: matches are located by the pieces that splitting leaves, summed by a
scan in chunks; patterns try no start twice in a run of its characters and no group recurses; texts are cut at spans
by chunks of code points. Up to `FEW_TERMS` terms of a text are looked for as one pattern; of more, each word is looked up
in their sorted array by halving it. Both find the same words: those whose lower-case form is one of the terms.

Defined cases: null text is the empty text, without spans (`sanitise` keeps it null); copies of a text count once, in p,
in q and as texts of an entity; where every text has an entity (q = 1) only lines can disclose; repeated rows get the same
spans each; a span is in code points, its end exclusive; very long texts, in one line or many, with any number of
entities need memory and time in proportion (times the logarithm of the number of its disclosing terms); other columns are kept by `sanitise` and not read by `find`; an empty table gives
an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import fresh, let, select_required, written

_LOCAL = "A-Za-z0-9._%+-"
#: A match may begin where a run of its first characters begins or where the match before it ended.
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]
TERM = r"[\p{L}\p{N}]+"
#: Least number of different entities, and of distinct texts with one, beside which a term must stand.
MIN_ENTITIES = 10
#: Of the greatest reachable information, -log2(q): what discloses.
REACHED = 0.8
#: Most disclosing terms of a text that are looked for as one pattern.
FEW_TERMS = 64
#: What stands for a code point of an entity in a blanked text; no line ends at it and no term has it.
BLANK = "\x01"
#: Code points in a chunk that texts are cut by.
CUT = 256
#: What a scan sums at once.
CHUNK = 256
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def scan(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Inclusive prefix sums (or maxima: any associative join) of an array of bigint, in chunks: n * CHUNK + (n / CHUNK)**2 steps."""

    def plain(a: Column) -> Column:
        return F.aggregate(a, F.array().cast("array<bigint>"), lambda done, x: F.array_append(done, F.when(F.size(done) == 0, x).otherwise(join(F.get(done, F.size(done) - 1), x))))

    def chunked(a: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / CHUNK).cast("int")), lambda k: plain(F.slice(a, k * CHUNK + 1, F.lit(CHUNK))))
        whole = lambda parts: plain(F.transform(parts, lambda p: F.get(p, F.size(p) - 1)))
        return let(chunks, lambda parts: let(whole(parts), lambda tops: F.flatten(F.transform(parts, lambda p, k: F.when(k == 0, p).otherwise(F.transform(p, lambda x: join(F.get(tops, k - 1), x)))))))

    return let(values, lambda a: F.when(F.size(a) <= 1, a).otherwise(F.when(F.size(a) <= CHUNK, plain(a)).otherwise(chunked(a))))


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    if kind == "email":
        return F.lit(True)
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)


def _hint(kind: str, text: Column) -> Column:
    """What every text with a match holds; cheap to look for."""
    return text.contains("@") if kind == "email" else text.contains("+") if kind == "phone" else text.rlike("[0-9]")


def located(text: Column, pattern: str) -> Column:
    """All matches of a pattern as (start, end, value)."""

    def from_parts(x: Column) -> Column:
        pieces, found = x["p"], x["m"]
        steps = F.transform(found, lambda m, i: (F.length(F.get(pieces, i)) + F.coalesce(F.length(F.get(found, i - 1)), F.lit(0))).cast("long"))
        return let(scan(steps, lambda a, b: a + b), lambda at: F.transform(found, lambda m, i: F.struct(F.get(at, i).alias("start"), (F.get(at, i) + F.length(m)).alias("end"), m.alias("value"))))

    # lit(pattern) as the split's pattern: the same Java pattern as the extraction
    return let(F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m")), from_parts)


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end, value): by kind as listed, then start."""
    def of(kind: str, pattern: str) -> Column:
        found = F.filter(located(text, pattern), lambda s: valid(kind, s["value"]))
        named = F.transform(found, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
        return F.when(_hint(kind, text), named).otherwise(F.array().cast(_SPAN))

    return F.concat(*[of(kind, pattern) for kind, pattern in PATTERNS.items()])


def regions(spans: Column) -> Column:
    """Runs of overlapping spans: array of (start, end, kind of the first), by start."""

    def merged(x: Column) -> Column:
        s, reach = x["s"], x["reach"]
        firsts = F.filter(F.transform(s, lambda y, i: F.when((i == 0) | (y["start"] >= F.get(reach, i - 1)), F.struct(i.alias("i"), y["start"].alias("start"), y["kind"].alias("kind")))), lambda y: y.isNotNull())
        return let(firsts, lambda r: F.transform(r, lambda y, j: F.struct(y["start"].alias("start"), F.get(reach, F.coalesce(F.get(r, j + 1)["i"], F.size(s)) - 1).alias("end"), y["kind"].alias("kind"))))

    ordered = F.array_sort(F.transform(spans, lambda y: F.struct(y["start"].alias("start"), y["end"].alias("end"), y["kind"].alias("kind"))))
    return let(let(ordered, lambda s: F.struct(s.alias("s"), scan(F.transform(s, lambda y: y["end"]), lambda a, b: F.greatest(a, b)).alias("reach"))), merged)


def rewritten(text: Column, spans: Column, fill: Callable[[Column], Column]) -> Column:
    """The text with each run of overlapping spans replaced by fill(run)."""

    def cut(chunks: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / CUT)
        near = F.array_join(F.slice(chunks, (first + 1).cast("int"), (F.floor((end - 1) / CUT) - first + 1).cast("int")), "")
        return F.when(end > start, F.substring(near, (start - first * CUT + 1).cast("int"), (end - start).cast("int"))).otherwise(F.lit(""))

    def joined(x: Column) -> Column:
        chunks, r = x["chunks"], x["regions"]
        before = lambda j: F.when(j == 0, F.lit(0).cast("long")).otherwise(F.get(r, j - 1)["end"])
        pieces = F.transform(r, lambda y, j: F.concat(cut(chunks, before(j), y["start"]), fill(y)))
        return F.concat(F.array_join(pieces, ""), cut(chunks, F.get(r, F.size(r) - 1)["end"], F.length(text).cast("long")))

    parts = F.struct(F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CUT}}}"), F.lit(0)).alias("chunks"), regions(spans).alias("regions"))
    return F.when(F.size(spans) > 0, let(parts, joined)).otherwise(text)


def blanked(text: Column, spans: Column) -> Column:
    """The text with BLANK for each code point of a span, and nowhere else: all other positions stay."""
    return rewritten(F.translate(text, BLANK, " "), spans, lambda y: F.repeat(F.lit(BLANK), (y["end"] - y["start"]).cast("int")))


def replaced(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by a placeholder of the first one's kind."""
    return rewritten(text, spans, lambda y: F.concat(F.lit("<"), F.upper(y["kind"]), F.lit(">")))


def terms_of(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def key_of(text: Column) -> Column:
    """What stands for a text: 128 bits of it."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def statistics(docs: DataFrame, min_entities: int = MIN_ENTITIES) -> DataFrame:
    """One pass over the texts, written: key, entities, terms, near (the terms on lines with an entity); terms joined by spaces.

    Of a text's entities the `min_entities` smallest are kept: a union over texts has that many different ones exactly
    where the union of what is kept has.
    """
    text = F.coalesce("text", F.lit(""))

    def of_blanked(b: Column, s: Column) -> Column:
        lines = F.filter(F.split(b, "\n", -1), lambda x: x.contains(BLANK))
        near = F.when(F.size(s) > 0, terms_of(F.array_join(lines, "\n"))).otherwise(F.array().cast("array<string>"))
        values = F.slice(F.array_sort(F.array_distinct(F.transform(s, lambda y: F.md5(F.concat_ws(":", y["kind"], y["value"]).cast("binary"))))), 1, min_entities)
        return F.struct(values.alias("entities"), terms_of(b).alias("terms"), near.alias("near"))

    found = let(base_spans(text), lambda s: let(blanked(text, s), lambda b: of_blanked(b, s)))
    rows = select_required(docs, ["text"]).select(key_of(F.col("text")).alias("key"), found.alias("f"))
    return written(rows.select("key", "f.entities", F.array_join("f.terms", " ").alias("terms"), F.array_join("f.near", " ").alias("near")), "pii")


def apart(terms: str) -> Column:
    """The terms of a column of joined ones."""
    return F.when(F.length(terms) > 0, F.split(terms, " ")).otherwise(F.array().cast("array<string>"))


def disclosing_terms(found: DataFrame, min_entities: int = MIN_ENTITIES, reached: float = REACHED) -> DataFrame:
    """(term, n_texts, n_with, n_near, n_entities) of the terms that disclose, written."""
    hit = F.size("entities") > 0
    # each term of a distinct text once, and once more where it is on a line with an entity
    texts = found.select("key", hit.alias("hit"), "terms", "near").dropDuplicates(["key"])
    flag = lambda x: F.lit(x).cast("long")
    every = F.transform(apart("terms"), lambda t: F.struct(t.alias("term"), flag(1).alias("all"), F.col("hit").cast("long").alias("with"), flag(0).alias("near")))
    near = F.transform(apart("near"), lambda t: F.struct(t.alias("term"), flag(0).alias("all"), flag(0).alias("with"), flag(1).alias("near")))
    counts = texts.select(F.inline(F.concat(every, near))).groupBy("term").agg(F.sum("all").alias("n_texts"), F.sum("with").alias("n_with"), F.sum("near").alias("n_near"))
    sizes = found.select("key", hit.alias("hit"), F.size(apart("terms")).alias("all"), F.size(apart("near")).alias("near")).distinct()
    rates = sizes.agg(F.try_divide(F.count(F.when(F.col("hit"), 1)), F.count(F.lit(1))).alias("in_text"), F.try_divide(F.sum("near"), F.sum("all")).alias("on_line"))

    def tells(n: str, q: str) -> Column:
        bits = F.log2(F.try_divide(F.col(n) / F.col("n_texts"), F.col(q)))
        return (F.col(n) >= min_entities) & (F.col(q) < 1) & (bits >= -reached * F.log2(F.col(q)))

    # the rates are one row, an aggregate's
    strong = counts.where(F.col("n_with") >= min_entities).join(F.broadcast(rates)).where(tells("n_with", "in_text") | tells("n_near", "on_line")).drop("in_text", "on_line")
    strong = written(strong, "pii-strong")
    pairs = found.where(hit).select("entities", F.explode(apart("terms")).alias("term")).join(strong.select("term"), "term", "left_semi")
    different = pairs.select("term", F.explode("entities").alias("entity")).distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_entities")).where(F.col("n_entities") >= min_entities)
    return written(strong.join(different, "term"), "pii-terms")


def held_in(ordered: Column, value: Column) -> Column:
    """Whether a sorted array holds a value, by halving."""
    upto = lambda n: F.get(ordered, n - 1)
    steps = F.reverse(F.transform(F.sequence(F.lit(0), F.floor(F.log2(F.size(ordered))).cast("int")), lambda k: F.pow(F.lit(2), k).cast("int")))
    n = F.aggregate(steps, F.lit(0), lambda n, step: F.when((n + step <= F.size(ordered)) & (upto(n + step) <= value), n + step).otherwise(n))
    return let(n, lambda n: F.coalesce(upto(n) == value, F.lit(False)))


def with_spans(docs: DataFrame, found: DataFrame, terms: DataFrame, base: str, extra: str) -> DataFrame:
    """docs with the base spans and the spans of disclosing terms, each an array of (kind, start, end, value) by start."""
    key, own = fresh(docs, "key", "own")
    held = found.select("key", F.explode(apart("terms")).alias("term")).join(terms.select("term"), "term", "left_semi")
    # written, so that its size is known before the join is planned: the texts are shuffled only where it is too large to broadcast
    held = written(held.groupBy(F.col("key").alias(key)).agg(F.array_sort(F.collect_set("term")).alias(own)), "pii-held")
    text = F.coalesce(F.col("text"), F.lit(""))
    # terms are letters and digits, so they stand in a pattern as they are
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(own, "|"), F.lit(r")(?![\p{L}\p{N}])"))

    def words_of(b: Column) -> Column:
        few = F.filter(located(b, pattern), lambda m: F.array_contains(F.col(own), F.lower(m["value"])))
        return F.when(F.size(own) <= FEW_TERMS, few).otherwise(F.filter(located(b, TERM), lambda m: held_in(F.col(own), F.lower(m["value"]))))

    def both(s: Column) -> Column:
        places = let(let(blanked(text, s), words_of), lambda found: F.transform(found, lambda m: F.struct(F.lit("term").alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"))))
        return F.struct(s.alias("base"), F.when(F.col(own).isNotNull(), places).otherwise(F.array().cast(_SPAN)).alias("extra"))

    joined = docs.join(held, key_of(docs["text"]) == F.col(key), "left")
    (spans,) = fresh(joined, "both")
    return joined.withColumn(spans, let(base_spans(text), both)).select(*[F.col(f"`{c}`") for c in docs.columns], F.col(spans)["base"].alias(base), F.col(spans)["extra"].alias(extra))


def learned(docs: DataFrame, min_entities: int, reached: float) -> tuple[DataFrame, DataFrame]:
    found = statistics(docs, min_entities)
    return found, disclosing_terms(found, min_entities, reached)


def find(docs: DataFrame, min_entities: int = MIN_ENTITIES, reached: float = REACHED) -> DataFrame:
    """(doc_id, spans, all_spans) of each row: base spans, and those with the terms' after them."""
    rows = select_required(docs, ["doc_id", "text"])
    out = with_spans(rows, *learned(docs, min_entities, reached), "spans", "extra")
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "spans", F.concat("spans", "extra").alias("all_spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitise(docs: DataFrame, min_entities: int = MIN_ENTITIES, reached: float = REACHED) -> DataFrame:
    """docs with every span generalised to its kind; null text stays null, other columns stay."""
    base, extra = fresh(docs, "base", "extra")
    found = with_spans(docs, *learned(docs, min_entities, reached), base, extra)
    spans = F.concat(F.col(base), F.col(extra))
    return found.withColumn("text", F.when(F.size(spans) > 0, let(spans, lambda s: replaced(F.col("text"), s))).otherwise(F.col("text"))).select(*[F.col(f"`{c}`") for c in docs.columns])
