"""Record fields from text by rule, as columns.

``lines`` and ``sections`` columns come from ``operators.extract.with_sections``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from legajo.functions import lexicon as L
from legajo.functions.patterns import SPACE, WORD
from legajo.functions.contract import DEGREES

# Four capitals or more, and blanks.
HEADING = r"^(?=(?:[^\p{Lu}]*+\p{Lu}){4})[\p{Lu} ]+:?$"
_WORDS = r"[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*[+#]*"
# Written so that long runs of digits or blanks are read once, and nothing is looked at but in front of a digit. The number may be spelled out in brackets behind it, and
# "ñ" written in two characters. An age is no experience, and neither is what a firm has behind it.
_NOT_OWN = (
    rf"(?<!(?:[eE]dad|[eE]dad:|[cC]umpl[íio]|[cC]umplid[ao]s|(?:[eE]mpresa|[cC]ompañía|[fF]irma) con)[{SPACE}]{{1,3}})"
)
_AGE = rf"(?<!(?:[tT]engo|[tT]iene)[{SPACE}]{{1,3}})|(?=[0-9]++[{SPACE}]++a(?:ñ|n\u0303)os[{SPACE}]++(?:de[{SPACE}]++(?:experiencia|trayectoria)|trabajando|como)(?![{WORD}]))"
_YEARS = (
    rf"(?iu)(?=[0-9])(?<![0-9.,]){_NOT_OWN}(?:{_AGE})([0-9]++(?:[.,][0-9]++)?)\+?(?:[{SPACE}]*+\([^()\n]{{1,30}}\))?[{SPACE}]++a(?:ñ|n\u0303)os"
    rf"(?![{SPACE}]++(?:de[{SPACE}]++(?:edad|fundad[ao]|vida)|en[{SPACE}]++el[{SPACE}]++mercado)(?![{WORD}]))"
)
_TITLE_LINE = rf"(?imu)^(?:posición|puesto|cargo|título)[ \t]*:[ \t]*([^{SPACE}].*)$"
_DATED = rf"^[0-9]{{4}}[{SPACE}]*-[{SPACE}]*[\p{{L}}\p{{N}}]+[{SPACE}]*:[{SPACE}]*([^{SPACE}].*?)(?<=[^{SPACE}])[{SPACE}]++—[{SPACE}]+[^{SPACE}]"
_BULLET = rf"^[{SPACE}]*+[-•][{SPACE}]*+(.*[^{SPACE}])[{SPACE}]*$"
_LANGUAGE_PAIR = (
    rf"^[{SPACE}-]*+(\p{{L}}++(?: ++\p{{L}}++)*+)[{SPACE}]*+:[{SPACE}]*+"
    rf"([^(:{SPACE}]++(?:[{SPACE}]++[^(:{SPACE}]++)*+)[{SPACE}]*+(?:\(.*)?$"
)
_LEVELS = r"[abc][12]|nativo|básico|intermedio|avanzado"


def listed(values: Sequence[str]) -> Column:
    """The values as one array; Spark folds it to a constant."""
    return F.split(F.lit("\n".join(values)), "\n")


def words(text: Column) -> Column:
    """Lower-case words; ``c++``, ``c#`` and ``node.js`` are one word each."""
    return F.regexp_extract_all(F.lower(text), F.lit(_WORDS), F.lit(0))


def grams(tokens: Column, n: Column) -> Column:
    """Runs of ``n`` words. ``tokens`` and ``n`` should be plain columns."""
    last = F.size(tokens) - n + 1
    starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.concat_ws(" ", F.slice(tokens, i, n)))


def term_hits(tokens: Column, terms: Sequence[str]) -> Column:
    """The one-word terms that occur among the words, each once."""
    return F.array_intersect(listed([t for t in sorted(terms) if " " not in t]), tokens)


def spaced(tokens: Column) -> Column:
    """The words in one string, a blank on either side of each."""
    return F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))


def found_terms(hits: Column, words_spaced: Column, terms: Sequence[str]) -> Column:
    """The terms that occur in a text, each once, sorted.

    ``hits`` are its words, or enough of them: the result of ``term_hits``.
    Terms of several words are looked for in ``spaced`` words, which costs less
    than building every run of words.
    """
    several = [t for t in sorted(terms) if " " in t]
    found = term_hits(hits, terms)
    if not several:
        return found
    runs = [F.when(F.contains(words_spaced, F.lit(f" {t} ")), t) for t in several]
    return F.array_sort(F.concat(found, F.array_compact(F.array(*runs))))


def years_required(text: Column) -> Column:
    """The largest "n años" in the text; null when there is none."""
    found = F.regexp_extract_all(text, F.lit(_YEARS), F.lit(1))
    return F.array_max(F.transform(found, lambda y: F.translate(y, ",", ".").try_cast("double")))


def infer_level(
    years: Column,
    bounds: Sequence[tuple[float, str]] = L.LEVEL_BOUNDS,
    top: str = L.TOP_LEVEL,
) -> Column:
    ladder = F.when(years.isNull(), F.lit(None).cast("string"))
    for bound, level in bounds:
        ladder = ladder.when(years < bound, level)
    return ladder.otherwise(top)


def degree(tokens: Column, highest: bool = True, degrees: Mapping[str, str] = L.DEGREE_WORDS) -> Column:
    """The highest, or lowest, degree named; null when none is."""
    ranks = [
        F.when(F.arrays_overlap(tokens, listed([w for w, d in degrees.items() if d == name])), name)
        for name in DEGREES
        if name in degrees.values()
    ]
    return F.coalesce(*(reversed(ranks) if highest else ranks))


_ACCENTED, _PLAIN = "ÁÀÂÄÃÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ\u0300\u0301\u0302\u0303\u0308", "AAAAAEEEEIIIIOOOOOUUUUNC"


def folded(text: Column) -> Column:
    """In capitals and without accents, however they are written."""
    return F.translate(F.upper(text), _ACCENTED, _PLAIN)


def folded_names(names: Sequence[str]) -> list[str]:
    """``folded`` for headings of the lexicon."""
    drop = {ord(c): None for c in _ACCENTED[len(_PLAIN) :]}
    return [n.upper().translate(drop | str.maketrans(_ACCENTED[: len(_PLAIN)], _PLAIN)) for n in names]


def heading_name(line: Column) -> Column:
    """A line that may be a heading as ``section_lines`` compares it: folded, without blanks and colons."""
    return F.translate(F.lower(line), _ACCENTED.lower() + " :\t\u00a0", _PLAIN.lower())


def heading_names(headings: Sequence[str]) -> list[str]:
    return sorted({name.lower().replace(" ", "") for name in folded_names(headings)})


_KNOWN_NAMES = heading_names([name for part in L.SECTIONS.values() for name in part])
# Room for a few blanks and a colon.
_LONGEST_HEADING = max(map(len, _KNOWN_NAMES)) + 10


def heading(line: Column, known: bool = False) -> Column:
    """Whether a line is a heading; with ``known`` only one that a record field can end at.

    Those are lines that hold a heading of ``lexicon.SECTIONS`` in any writing, with or without accents or a colon, and
    lines of capitals that end in a colon: capitals inside a list, such as the names of tools, leave the section open.
    """
    shaped = F.rlike(line, F.lit(HEADING))
    if not known:
        return shaped
    # A look at the length spares most lines the rest.
    named = (F.length(line) <= _LONGEST_HEADING) & heading_name(line).isin(*_KNOWN_NAMES)
    return (line.endswith(":") & shaped) | named


# How an address starts, and words inside a name that need no capital.
_ADDRESS = rf"(?iu)^[^{WORD}]*+(?:(?:dirección|domicilio)[{SPACE}]*+:|(?:av|avenida|jr|jirón|ca|calle|psje|pasaje|urb|urbanización|mz|carretera)(?![{WORD}])\.?[{SPACE}]++\p{{L}})"
_CONTACT = rf"@|(?:EMAIL|DNI|RUC|TELEFONO)_REDACTADO\]|\p{{Nd}}{{6}}|^[^{WORD}]*+\[NOMBRE_REDACTADO\][^{WORD}]*+$"
_NAMED = rf"(?iu)^[^{WORD}]*+(?:nombres?|apellidos?)(?:[{SPACE}]++y[{SPACE}]++(?:nombres?|apellidos?))?[{SPACE}]*+:"
_CAPITALISED = r"(?:\p{Lu}(?:\.|[\p{L}'’-]*+)|\[NOMBRE_REDACTADO\])"
NAME_LIKE = rf"^[{SPACE}]*+{_CAPITALISED}(?:,?[ ]++(?:(?:de|del|la|las|los|y)[ ]++)*+{_CAPITALISED}){{1,5}}[{SPACE}]*+$"


def private(line: Column) -> Column:
    """Whether a line may say who or where a person is: an address, a contact, a labelled name, or nothing but words in capitals."""
    return F.rlike(line, F.lit(f"{_CONTACT}|{_ADDRESS}|{_NAMED}")) | F.rlike(line, F.lit(NAME_LIKE))


def prose(lines: Column, public: bool = False) -> Column:
    """Lines that are text and no list; where there is none, the items of the list. With ``public`` none that is ``private``."""
    # Each list is the element of an array of one, as what a lambda names is computed once.
    full = F.array(F.filter(lines, lambda l: F.rlike(l, F.lit(rf"[^{SPACE}]")) & (~private(l) if public else F.lit(True))))
    text = lambda f: F.array(F.filter(f, lambda l: ~F.rlike(l, F.lit(_BULLET))))
    either = lambda f: F.transform(text(f), lambda t: F.when(F.size(t) > 0, t).otherwise(bullets(f)))
    return F.get(F.flatten(F.transform(full, either)), F.lit(0))


def free_lines(sections: Column) -> Column:
    """Lines of text outside any list: no heading, no item and no ``label: value``."""
    lines = F.flatten(F.transform(sections, lambda s: s["lines"]))
    listed_or_labelled = rf"{_BULLET}|^[^:]{{1,40}}:"
    plain = F.filter(lines, lambda l: ~heading(l) & ~F.rlike(l, F.lit(listed_or_labelled)))
    return F.filter(plain, lambda l: F.rlike(l, F.lit(rf"[^{SPACE}]")))


def section_lines(sections: Column, headings: Sequence[str]) -> Column:
    """Lines below the given headings, in any writing, in order, without the heading lines."""
    mine = F.filter(sections, lambda s: heading_name(s["section"]).isin(*heading_names(headings)))
    return F.flatten(F.transform(mine, lambda s: F.slice(s["lines"], F.lit(2), F.size(s["lines"]))))


def dated_titles(lines: Column) -> Column:
    """``title`` of each line ``yyyy - yyyy: title — place``."""
    dated = F.filter(lines, lambda l: F.rlike(l, F.lit(_DATED)))
    return F.transform(dated, lambda l: F.regexp_extract(l, _DATED, 1))


# Months by the first three letters, and words for a job that goes on.
_MONTHS = ("ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "set", "oct", "nov", "dic")
_ONGOING = "actualidad|actualmente|actual|presente|hoy|fecha"
_MONTH = (
    "ene(?:ro)?|feb(?:rero)?|mar(?:zo)?|abr(?:il)?|may(?:o)?|jun(?:io)?|jul(?:io)?|ago(?:sto)?|set(?:iembre)?|sep(?:t(?:iembre)?)?|oct(?:ubre)?|nov(?:iembre)?|dic(?:iembre)?"
)
_DATE = rf"(?:({_MONTH})\.?[{SPACE}]*+(?:del?[{SPACE}]++)?|([0-9]{{1,2}})[{SPACE}]*+[/.][{SPACE}]*+)?((?:19|20)[0-9]{{2}})"
_SPAN = rf"(?iu)^[{SPACE}•*-]*+(?:desde[{SPACE}]++)?{_DATE}[{SPACE}]*+(?:-|–|—|a|al|hasta)[{SPACE}]*+(?:(?:la[{SPACE}]++)?({_ONGOING})|{_DATE})(?![{WORD}])"


def _month(name: Column, number: Column, otherwise: int | None) -> Column:
    """Months from January on, 0 to 11; null for a number that is no month."""
    short = F.replace(F.lower(F.substring(name, 1, 3)), F.lit("sep"), F.lit("set"))
    by_name = F.array_position(listed(_MONTHS), short).cast("int") - 1
    by_number = F.when(number.cast("int").between(1, 12), number.cast("int") - 1)
    return F.when(name != "", by_name).when(number != "", by_number).otherwise(F.lit(otherwise).cast("int"))


def job_spans(lines: Column, as_of: Column) -> Column:
    """(start, end) of each line that opens with two dates, in months from year 0, the end not included.

    Dates are years, or a month, by name or number, and a year. A month that ends a span counts; a year that ends one does not, unless the span
    is within that year. A job that goes on, or ends later, ends in the month of ``as_of``. Lines whose end is not behind their start give nothing.
    """
    # One search gives all parts of a line; a part with a tab in it there is none.
    groups = "\t".join(f"${i}" for i in range(1, 8))
    found = F.filter(lines, lambda l: F.rlike(l, F.lit(_SPAN)))
    parts = F.transform(found, lambda l: F.split(F.regexp_replace(l, f"(?s){_SPAN}.*$", groups), "\t", 7))
    now = F.year(as_of) * 12 + F.month(as_of) - 1

    def dates(part: Column) -> Column:
        start = part[2].cast("int") * 12 + _month(part[0], part[1], 0)
        year, month = F.nullif(part[6], F.lit("")).cast("int") * 12, _month(part[4], part[5], None)
        whole = (part[4] == "") & (part[5] == "")
        end = F.when(part[3] != "", now).when(whole, F.when(year > start, year).when(year + 12 > start, year + 12)).otherwise(year + month + 1)
        return F.struct(start.alias("start"), F.when(end <= now, end).when(end > now, now).alias("end"))

    return F.filter(F.transform(parts, dates), lambda s: s["end"] > s["start"])


def covered_months(spans: Column) -> Column:
    """Months that lie in at least one span: a sweep over the spans by their start."""
    step = lambda a, s: F.struct(
        (a["months"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["until"]))).alias("months"),
        F.greatest(a["until"], s["end"]).alias("until"),
    )
    return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).alias("months"), F.lit(0).alias("until")), step, lambda a: a["months"])


def bullets(lines: Column) -> Column:
    """Items of a list, without their marks."""
    marked = F.filter(lines, lambda l: F.rlike(l, F.lit(_BULLET)))
    return F.transform(marked, lambda l: F.regexp_extract(l, _BULLET, 1))


def _language(name: Column, level: Column) -> Column:
    return F.struct(name.alias("idioma"), level.alias("nivel"))


def language_pairs(lines: Column) -> Column:
    """``name: level`` items, divided by ``|``; notes in brackets are left out."""
    items = F.flatten(F.transform(lines, lambda l: F.split(l, r"\|")))
    pairs = F.filter(items, lambda i: F.rlike(i, F.lit(_LANGUAGE_PAIR)))
    return F.transform(
        pairs,
        lambda i: _language(
            F.regexp_extract(i, _LANGUAGE_PAIR, 1), F.regexp_extract(i, _LANGUAGE_PAIR, 2)
        ),
    )


def language_mentions(text: Column, languages: Sequence[str] = L.LANGUAGES) -> Column:
    """Known language names directly followed by a level, such as "inglés B2"."""
    pattern = (
        rf"(?iu)(?<![{WORD}]{{1,2}})({'|'.join(languages)})[ \t]*:?[ \t]+({_LEVELS})(?![{WORD}])"
    )
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(
        found,
        lambda m: _language(F.regexp_extract(m, pattern, 1), F.regexp_extract(m, pattern, 2)),
    )


def labelled_title(text: Column) -> Column:
    """The job title of a labelled line; ``""`` when there is none."""
    return F.trim(F.regexp_extract(text, _TITLE_LINE, 1))
