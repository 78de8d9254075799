"""The names a text gives for its person, and their mentions anywhere in it.

Names stand on the first line, where that is nothing but words in capitals, or behind a label. Their words are looked for
in the whole text in any writing that begins with a capital, with or without accents, alone or in any order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from legajo.functions import extract as X
from legajo.functions import lexicon as L
from legajo.functions import redact as R
from legajo.functions.patterns import NOT_AFTER_WORD, NOT_BEFORE_WORD

# Labels in front of a name.
_LABEL = r"(?:nombres?|apellidos?)(?:[ \t]+y[ \t]+(?:nombres?|apellidos?))?[ \t]*:"
_LABELLED = rf"(?imu)^[^\p{{L}}\n]*{_LABEL}[ \t]*([^\n|;:]{{1,80}})"
_IN_NAME = r"\p{Lu}\p{L}{2,}"
_PARTICLES = "(?:(?:de|del|la|las|los|y)[ ]+)*"
# Capitalised words of first lines that are no names.
NO_NAMES = ("POSTULANTE", "CANDIDATO", "CANDIDATA", "CURRICULUM", "VITAE", "HOJA", "VIDA", "NOMBRE", "NOMBRES", "APELLIDO", "APELLIDOS")
_VARIANTS = {"A": "[AÁÀÂÄÃ]", "E": "[EÉÈÊË]", "I": "[IÍÌÎÏ]", "O": "[OÓÒÔÖÕ]", "U": "[UÚÙÛÜ]", "N": "[NÑ]", "C": "[CÇ]"}


def name_words(text: Column, first: Column) -> Column:
    """Words of the names that the text and its ``first`` line that is not blank give, folded, each once; three letters or more.

    Both should be plain columns: they are read several times.
    """
    own = F.when(F.rlike(first, F.lit(X.NAME_LIKE)) & ~X.heading(first, known=True), first)
    labelled = F.regexp_extract_all(text, F.lit(_LABELLED), F.lit(1))
    given = F.concat_ws(" ", own, F.array_join(labelled, " "))
    words = F.transform(F.regexp_extract_all(given, F.lit(_IN_NAME), F.lit(0)), X.folded)
    other = [*NO_NAMES, *{w for part in L.SECTIONS.values() for name in X.folded_names(part) for w in name.split()}]
    return F.array_distinct(F.filter(words, lambda w: ~w.isin(*other)))


def mask_mentions(text: Column, words: Column) -> Column:
    """``text`` with every run of ``words`` replaced by the name tag. One pass; a text without names is left as it is."""
    any_word = F.array_join(words, "|")
    for letter, ways in _VARIANTS.items():
        any_word = F.replace(any_word, F.lit(letter), F.lit(ways))
    one = F.concat(F.lit(r"(?-i:(?=\p{Lu}))(?:"), any_word, F.lit(")"))
    ends = F.lit(NOT_BEFORE_WORD)
    run = F.concat(F.lit(f"(?iu){NOT_AFTER_WORD}"), one, ends, F.lit(f"(?:[ ]+{_PARTICLES}"), one, ends, F.lit(")*"))
    return F.when(F.size(words) > 0, F.regexp_replace(text, run, F.lit(R.NAME_TAG))).otherwise(text)
