"""Report formats as data. A format is a page filter, positions of fields, a likeness of names and the readings of numbers.

`as_column` gives a format as a constant struct, `chosen` one of many by its name, `table` all of them as rows: each is what
the page stage and the walk read, so a plan doesn't depend on which formats, or how many, go through it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.functions.matching import Likeness
from ledgerleaf.operators.extract import Positions

Anchor = tuple[str, str]
Bound = float | Anchor | None
Side = tuple[float | None, float | None]

_BOUND = "struct<at:double,text:string,font:string>"
_ANCHOR = "struct<text:string,font:string>"
SCHEMA = (
    f"format string, header {_ANCHOR}, subfund struct<font:string,start:double,end:double>, body_font string, top {_BOUND}, bottom {_BOUND}, "
    f"switch {_ANCHOR}, switch_top {_BOUND}, switch_bottom {_BOUND}, deselect array<{_ANCHOR}>, page_fields array<struct<name:string,font:string,start:double,end:double>>, "
    "offsets map<string,int>, currency string, prefix double, ratio double, cost_and_value_interpret_int boolean, quantity_interpret_float boolean"
)


def _bound(bound: Bound) -> dict:
    return {"text": bound[0], "font": bound[1]} if isinstance(bound, tuple) else {"at": bound}


@dataclass(frozen=True)
class FormatSpec:
    """One publisher's layout.

    body_y: a side is a height, open, or an anchor (text, font): the body then begins below, or ends above, its first
    line. switch: (anchor, body_y) that holds instead on pages that have the anchor. page_fields: (field, font, range)
    of texts that a page has once, the first line in the font and range; they stand for the field in each of its rows.
    """

    name: str
    header: Anchor
    subfund_y: Side
    subfund_font: str
    body_font: str
    positions: Positions
    body_y: tuple[Bound, Bound] = (None, None)
    deselect: tuple[Anchor, ...] = ()
    likeness: Likeness = field(default_factory=Likeness)
    cost_and_value_interpret_int: bool = True
    quantity_interpret_float: bool = False
    switch: tuple[Anchor, tuple[Bound, Bound]] | None = None
    page_fields: tuple[tuple[str, str, Side], ...] = ()

    def data(self) -> dict:
        """What SCHEMA names."""
        anchor, second = self.switch or ((None, None), (None, None))
        named = lambda x: {"text": x[0], "font": x[1]}
        return {
            "format": self.name, "header": named(self.header), "subfund": {"font": self.subfund_font, "start": self.subfund_y[0], "end": self.subfund_y[1]}, "body_font": self.body_font,
            "top": _bound(self.body_y[0]), "bottom": _bound(self.body_y[1]), "switch": named(anchor), "switch_top": _bound(second[0]), "switch_bottom": _bound(second[1]),
            "deselect": [named(x) for x in self.deselect], "page_fields": [{"name": n, "font": f, "start": y[0], "end": y[1]} for n, f, y in self.page_fields],
            "offsets": self.positions.offsets(), "currency": self.positions.currency if isinstance(self.positions.currency, str) else None, **asdict(self.likeness),
            "cost_and_value_interpret_int": self.cost_and_value_interpret_int, "quantity_interpret_float": self.quantity_interpret_float,
        }


def as_column(spec: FormatSpec) -> Column:
    """The format as a constant."""
    return F.from_json(F.lit(json.dumps(spec.data())), SCHEMA)


def chosen(name: Column, specs: Iterable[FormatSpec]) -> Column:
    """The format of a name, among constants: no join, which would deal pages out by their few formats. Null for another name."""
    every = F.from_json(F.lit(json.dumps({s.name: s.data() for s in specs})), f"map<string,struct<{SCHEMA}>>")
    return F.try_element_at(every, name)


def table(spark: SparkSession, specs: Iterable[FormatSpec]) -> DataFrame:
    """(format, spec): a row a format."""
    rows = spark.createDataFrame([(s.name, json.dumps(s.data())) for s in specs], "format string, spec string")
    return rows.select("format", F.from_json("spec", SCHEMA).alias("spec"))


#: The layouts of the known report formats.
SPECS = {
    s.name: s
    for s in (
        FormatSpec("AMUNDI", ("Securities Portfolio as at", "ArialNarrow-BoldItalic"), (None, 27), "ArialMT", "ArialNarrow", Positions(1, -1, -2, "EUR"), (None, 768), page_fields=(("currency", "ArialNarrow", (None, 208)),)),
        FormatSpec("AMUNDI2", ("Titolo", "TrebuchetMS-Bold"), (None, 60), "Arial-BoldItalicMT", "TrebuchetMS", Positions(1, 4, 5, "EUR"), cost_and_value_interpret_int=False, quantity_interpret_float=True),
        FormatSpec("ANIMA", ("Holdings", "Helvetica-Bold"), (62, 82), "Helvetica-Condensed-Blac", "Helvetica-Light", Positions(-1, 1, 2, "EUR"), (103, 821), switch=(("Futures contracts", "Helvetica-Bold"), (("Holdings", "Helvetica-Bold"), ("Futures contracts", "Helvetica-Bold")))),
        FormatSpec("ARCA", ("Titoli", "TrebuchetMS-Bold"), (None, 42), "Calibri", "TrebuchetMS", Positions(3, 2, 4, 1), (83, None), likeness=Likeness(0.3, 0.8)),
        FormatSpec("ASTERIA", ("Transferable securities admitted to an official stock", "CenturyGothic-Bold"), (None, 87), "CenturyGothic-Bold", "CenturyGothic", Positions(1, 4, 5, 2, 3), (None, 810)),
        FormatSpec("ASTERIA_2023", ("Number of Shares/", "CenturyGothic-Bold"), (80, 95), "CenturyGothic-Bold", "CenturyGothic", Positions(1, 4, 5, 2, 3)),
        FormatSpec("EURIZON", ("PORTFOLIO AS AT", "Frutiger-Black"), (65, 85), "Frutiger-Black", "Frutiger-Light", Positions(-1, 3, 4, 1, 2), (160, 765), cost_and_value_interpret_int=False),
        FormatSpec("EURIZON_IT", ("Elenco", "TrebuchetMS,Bold"), (793, 803), "TrebuchetMS,Italic", "TrebuchetMS", Positions(1, 2, 4, "EUR")),
        FormatSpec("EURIZON_OLD", ("Face value/", "ArialMT-Bold"), (82, 98), "ArialMT", "Verdana", Positions(1, 4, 5, 2, 3), (195, 710), cost_and_value_interpret_int=False),
        FormatSpec(
            "FIDEURAM", ("Country", "Arial"), (None, 82), "Arial-Bold", "Arial", Positions(-1, 1, 2, -2), (103, 749),
            deselect=(("SHARES, WARRANTS, RIGHTS", "Arial"), ("TRANSFERABLE SECURITIES AND MONEY MARKET INSTRUMENTS ADMITTED TO AN OFFICIAL", "Arial"), ("EXCHANGE LISTING OR DEALT IN ON OTHER REGULATED MARKETS", "Arial"), ("BONDS AND ASSIMILATED STRUCTURED PRODUCTS", "Arial"), ("INVESTMENT FUNDS", "Arial")),
        ),
        FormatSpec("MEDIOLANUM", ("Relazione di gestione al 30 dicembre 2024", "Helvetica"), (None, 76), "Helvetica", "Helvetica", Positions(1, 2, 3, "EUR"), (83, None), likeness=Likeness(0.3, 0.65)),
    )
}


def register(spec: FormatSpec) -> None:
    """Make a further format known under its name."""
    SPECS[spec.name] = spec
