"""Sections of a text whose headings may be unknown: the cheapest way to label its lines.

Each line is of some kind: a known heading, something like a heading, a dated line, a list item, a sentence and so on. A labelling
costs what its lines cost in their parts, and something for each part it enters; all costs are negative logarithms of how often
texts with known headings do so. The cheapest labelling is found by dynamic programming over a text's lines in one
aggregate: every part either goes on or is entered from the part that was cheapest before. One map stage, no shuffle.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legajo.functions import extract as X
from legajo.functions import lexicon as L
from legajo.functions import text as T
from legajo.functions.patterns import SPACE, WORD
from legajo.operators.extract import with_sections

#: What a line can belong to; texts begin in the first, which is never entered again.
PARTS = ("lead", *L.SECTIONS)
# Words of lines about studies, and of language levels.
_STUDIES = r"universidad|instituto|colegio|academia|bachiller|licenciad|licenciatura|maestría|magíster|máster|doctorado|título|grado|egresad|técnic[oa] en|cursos?"
_LEVEL = r"nativ[oa]|materno|básico|intermedio|avanzado|[abc][12]"
_START = rf"(?iu)^[{SPACE}•*-]*+"
_TITLE = rf"^[{SPACE}]*+\p{{Lu}}(?:\p{{L}}*+ ?+){{1,4}}:?[{SPACE}]*+$"
#: Kinds of lines that are no known heading, tried in this order; an ``opening`` is a title behind a blank line.
KINDS: dict[str, str] = {
    "blank": rf"^[{SPACE}]*+$",
    "study": rf"(?iu)(?<![{WORD}])(?:{_STUDIES})",
    "language": rf"(?iu)^[^:]{{3,30}}:[{SPACE}]*+(?:{_LEVEL})(?![{WORD}])",
    "dated": rf"{_START}(?:desde[{SPACE}]+)?(?:[\p{{L}}.]+[{SPACE}]+(?:de[{SPACE}]+)?|[0-9]{{1,2}}[/.])?(?:19|20)[0-9]{{2}}(?![{WORD}])",
    "item": rf"^[{SPACE}]*+[-•*]",
    "opening": _TITLE,
    "title": _TITLE,
    "sentence": rf"[.!?][{SPACE}]*+$|^(?:[^{SPACE}]++[{SPACE}]++){{8}}",
    "list": r"^[^,.]{2,40}(?:, [^,.]{2,40}){2}",
}
_PRIVATE, _TEXT, _HEADINGS = len(KINDS), len(KINDS) + 1, len(KINDS) + 2
_N_KINDS = _HEADINGS + len(L.SECTIONS)


@dataclass(frozen=True)
class Costs:
    """Of entering and staying in each part, and of each kind of line as a part's first line and as another one."""

    enter: Sequence[int]
    stay: Sequence[int]
    first: Sequence[Sequence[int]]
    other: Sequence[Sequence[int]]


def _let(value: Column, then) -> Column:
    """``then`` of ``value``, which is computed once however often it is read."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def kinds(lines: Column) -> Column:
    """The number of each line's kind: those of KINDS, a line that may be private, anything else, and known headings by their part."""

    def kind(line: Column, i: Column, known: Column) -> Column:
        out = F.when(F.rlike(line, F.lit(KINDS["blank"])), 0)
        for part, names in enumerate(L.SECTIONS.values()):
            out = out.when(known.isin(*X.heading_names(names)), _HEADINGS + part)
        for n, (name, pattern) in enumerate(KINDS.items()):
            if name == "opening":
                # Names and addresses look like titles and sentences.
                out = out.when(X.private(line), _PRIVATE)
                behind_blank = F.coalesce(F.rlike(F.get(lines, i - 1), F.lit(KINDS["blank"])), F.lit(True))
                out = out.when(F.rlike(line, F.lit(pattern)) & behind_blank, n)
            elif n:
                out = out.when(F.rlike(line, F.lit(pattern)), n)
        return out.otherwise(_TEXT)

    return F.transform(lines, lambda line, i: _let(X.heading_name(line), lambda known: kind(line, i, known)))


_SELDOM = 0.001


def _cost(n: float, of: float) -> int:
    return round(-1000 * math.log(n / of))


def learn(df: DataFrame, text: str = "text", strange: float = 0.15, unlike: float = 0.1) -> Costs:
    """Costs from texts whose sections open with known headings.

    ``strange`` is the share of sections to be expected that open with a line that only looks like a heading, ``unlike`` that of
    lines unlike those of their part in ``df``. Counts are one aggregate over the lines; what reaches the driver has a row for each part and kind.
    """
    texts = df.select(T.plain_breaks(F.col(text)).alias("_text")).filter("_text is not null")
    cut = with_sections(texts, "_text", known=True).withColumn("_kinds", kinds(F.split("_text", "\n")))
    rows = cut.select("_kinds", F.explode_outer("sections").alias("s")).select("_kinds", "s.section", "s.start", F.posexplode_outer("s.lines").alias("pos", "line"))
    part = F.lit(0)
    for i, names in enumerate(L.SECTIONS.values(), 1):
        part = F.when(F.col("section").isin(*X.heading_names(names)), i).otherwise(part)
    opens = (F.col("pos") == 0) & F.col("section").isNotNull()
    counts = rows.groupBy(part.alias("part"), opens.alias("first"), F.get("_kinds", F.col("start") + F.col("pos")).alias("kind")).count()
    begins, other = [0] * len(PARTS), [[0] * _N_KINDS for _ in PARTS]
    for r in counts.collect():
        if r["first"]:
            begins[r["part"]] += r["count"]
        else:
            other[r["part"]][r["kind"]] += r["count"]
    total = sum(begins) + sum(map(sum, other)) + 1
    # Whatever the part, a section seldom opens with a line that does not look like a heading, and headings seldom stand inside.
    looks = {"opening": 0.7 * strange, "title": 0.3 * strange}
    opening = [looks.get(name, _SELDOM) for name in KINDS] + [0.02, _SELDOM] + [_SELDOM] * len(L.SECTIONS)
    enter, stay, first_costs, other_costs = [], [], [], []
    for p, counted in enumerate(other):
        goes_on = sum(counted)
        enter.append(_cost(begins[p] + 0.5, total))
        stay.append(_cost(goes_on + 1, goes_on + begins[p] + 2))
        own = [1 - strange if k == _HEADINGS + p - 1 else o for k, o in enumerate(opening)]
        first_costs.append([_cost(o, 1) for o in own])
        mixed = [(1 - unlike) * n / max(1, goes_on) + unlike / _HEADINGS for n in counted]
        other_costs.append([_cost(m if k < _HEADINGS else _SELDOM, 1) for k, m in enumerate(mixed)])
    return Costs(enter, stay, first_costs, other_costs)


def labelled(kinds: Column, costs: Costs) -> Column:
    """(start, part) of the cheapest labelling of lines of these kinds; parts by number."""
    none = 1 << 40
    far = lambda p, k: costs.enter[p] + costs.first[p][k] if p else none
    near = lambda p, k: costs.stay[p] + costs.other[p][k]
    cell = lambda p, k: {"on": near(p, k), "new": far(p, k), "gap": far(p, k) - near(p, k)}
    # A row for each kind, with what a line of it adds in each part; one constant.
    cells = [[cell(p, k) for p in range(len(PARTS))] for k in range(_N_KINDS)]
    table = F.from_json(F.lit(json.dumps(cells)), "array<array<struct<on:bigint,new:bigint,gap:bigint>>>")
    path = F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("part")))
    state = lambda cost, p: F.struct(F.lit(cost).cast("long").alias("cost"), F.lit(p).alias("part"), path.alias("path"))
    begin = F.array(state(0, 0), *[state(none, p) for p in range(1, len(PARTS))])
    # By cost, then by part, of which there is one each.
    cheapest = F.array_min

    def step(a: Column, line: Column) -> Column:
        def after(best: Column) -> Column:
            def one(x: Column, c: Column) -> Column:
                opened = F.concat(best["path"], F.array(F.struct(line["at"].alias("start"), x["part"].alias("part"))))
                goes_on = F.struct((x["cost"] + c["on"]).alias("cost"), x["part"].alias("part"), x["path"].alias("path"))
                enters = F.struct((best["cost"] + c["new"]).alias("cost"), x["part"].alias("part"), opened.alias("path"))
                return F.when(x["cost"] - best["cost"] <= c["gap"], goes_on).otherwise(enters)

            return F.zip_with(a, F.get(table, line["kind"]), one)

        return _let(cheapest(a), after)

    numbered = F.transform(kinds, lambda k, i: F.struct(i.alias("at"), k.alias("kind")))
    return F.aggregate(numbered, begin, step, lambda a: cheapest(a)["path"])


def segmented(df: DataFrame, costs: Costs, text: str = "text", out: str = "sections") -> DataFrame:
    """``df`` with ``out``: (start, section, lines) of each part of the text, as ``with_sections`` gives for headings.

    ``section`` is one of PARTS. Every line is in one section. The first one begins with line 0 and is ``lead`` unless the text opens with
    another part. A null text has null sections; lines may end as on any system.
    """
    lines = F.col("_lines")
    df = df.withColumn("_lines", F.split(T.plain_breaks(F.col(text)), "\n"))
    df = df.withColumn("_kinds", kinds(lines))
    df = df.withColumn("_path", labelled(F.col("_kinds"), costs))
    # A part that opens the text leaves nothing to the one before.
    df = df.withColumn("_path", F.filter("_path", lambda p, i: F.coalesce(F.get("_path", i + 1)["start"] > p["start"], F.lit(True))))

    def section(p: Column, i: Column) -> Column:
        end = F.coalesce(F.get("_path", i + 1)["start"], F.size(lines))
        name = F.element_at(F.array(*map(F.lit, PARTS)), p["part"] + 1)
        return F.struct(p["start"].alias("start"), name.alias("section"), F.slice(lines, p["start"] + 1, end - p["start"]).alias("lines"))

    return df.withColumn(out, F.transform("_path", section)).drop("_lines", "_kinds", "_path")


def part_lines(sections: Column, part: str) -> Column:
    """Lines of a part of ``segmented`` sections, in order, without a first line that is or looks like its heading."""
    mine = F.filter(sections, lambda s: s["section"] == part)
    headed = lambda line: X.heading(line, known=True) | (F.rlike(line, F.lit(_TITLE)) & ~X.private(line))
    body = lambda lines: F.slice(lines, F.when(headed(F.get(lines, F.lit(0))), 2).otherwise(1), F.size(lines))
    return F.flatten(F.transform(mine, lambda s: body(s["lines"])))
