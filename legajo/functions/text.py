"""Scalar text functions: titles, cuts, previews, token estimates, ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from legajo.functions.patterns import LINE_BREAK, SPACE, WORD

# Characters of document text placed in a request.
CV_CHARS = 3000
JD_CHARS = 4000

# Fixed value: the title that stands for "none given".
NO_TITLE = "Puesto sin título"

# Letters with a case, and everything between them.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
_CASE_RUNS = rf"([{_CASED}]+|[^{_CASED}]+)"
_TOKEN = rf"[{WORD}]+|[^{WORD}{SPACE}]"
# Blanks behind a mark, or with a line's end among them; a run of them is read from its first one only, and once.
_BLANK = SPACE.replace(r"\t-\r", r"\t\x0b-\r")
_SENTENCE_END = rf"(?<=[.!?])[{SPACE}]++|\n[{SPACE}]*+|[{_BLANK}](?<![{SPACE}]{{2}})[{_BLANK}]*+\n[{SPACE}]*+"


def _title_run(run: Column) -> Column:
    first = F.substring(run, 1, 1)
    upper = F.upper(first)
    # A letter may have a capital of several letters, of which only the first
    # stays, or a title form of its own, which initcap knows.
    several = F.concat(F.substring(upper, 1, 1), F.lower(F.substr(upper, F.lit(2))))
    head = F.when(F.length(upper) > 1, several).otherwise(F.initcap(first))
    return F.concat(head, F.lower(F.substr(run, F.lit(2))))


def title_from_stem(stem: Column) -> Column:
    """``backend-python_senior`` to ``Backend Python Senior``.

    A capital follows every character without case, so ``dev2ops`` gives
    ``Dev2Ops``; ``initcap`` looks at blanks only.
    """
    spaced = F.translate(stem, "-_", "  ")
    runs = F.regexp_extract_all(spaced, F.lit(_CASE_RUNS), F.lit(1))
    return F.array_join(F.transform(runs, _title_run), "")


def title_or_stem(title: Column, stem: Column) -> Column:
    """The given title, or one made from the file stem when null or empty."""
    return F.when(title.isNull() | (title == ""), title_from_stem(stem)).otherwise(title)


def title_fallback(extracted: Column, given: Column, placeholder: str = NO_TITLE) -> Column:
    """The extracted title unless it is null, empty or the placeholder."""
    unusable = extracted.isNull() | (extracted == "") | (extracted == placeholder)
    return F.when(unusable, given).otherwise(extracted)


def truncate_text(text: Column, chars: int) -> Column:
    """The first ``chars`` code points; to be applied after masking."""
    return F.substring(text, 1, chars)


def record_id(key: Column, salt: str) -> Column:
    """A stable id in UUID layout that does not show the key it comes from.

    The same salt and key always give the same id, so a task that is run again
    writes the same record. Keep the salt secret: it is what hides the key.
    """
    digest = F.md5(F.concat(F.lit(f"{salt}|"), key.cast("string")))
    return F.regexp_replace(
        digest, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )


def token_estimate(text: Column) -> Column:
    """Words plus punctuation marks: an estimate of model tokens, not a count."""
    return F.regexp_count(text, F.lit(_TOKEN)).cast("long")


def list_preview(items: Column, n: int = 5) -> Column:
    return F.array_join(F.slice(items, 1, n), ", ")


def line_preview(text: Column, n: int = 5) -> Column:
    """The first ``n`` lines, splitting where Python's ``splitlines`` does.

    Only ``n`` splits are made; what follows stays in one last part.
    """
    # A break at the very end closes the last line and opens no other.
    lines = F.split(F.regexp_replace(text, rf"(?:{LINE_BREAK})\z", ""), LINE_BREAK, n + 1)
    return F.array_join(F.slice(lines, 1, n), "\n")


def sentences(text: Column, limit: int = -1) -> Column:
    """The sentences of a text; a line's end is a sentence's end. What is behind ``limit - 1`` of them stays in one last part."""
    return F.split(F.trim(text), _SENTENCE_END, limit)


def leading_sentences(text: Column, n: int = 3) -> Column:
    """The first ``n`` sentences, joined by one blank."""
    parts = sentences(text, n + 1)
    return F.array_join(F.slice(parts, 1, n), " ")


def plain_breaks(text: Column) -> Column:
    """Line breaks of other systems as plain ones; a text without them is not rewritten."""
    plain = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.when(F.contains(text, F.lit("\r")), plain).otherwise(text)
