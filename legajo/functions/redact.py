"""Masking of e-mails, national ids, tax ids, phones and the name line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from legajo.functions.patterns import NOT_AFTER_WORD, NOT_BEFORE_WORD, SPACE, WORD

# Tags written in place of what is masked.
EMAIL_TAG = "[EMAIL_REDACTADO]"
DNI_TAG = "[DNI_REDACTADO]"
RUC_TAG = "[RUC_REDACTADO]"
PHONE_TAG = "[TELEFONO_REDACTADO]"
NAME_TAG = "[NOMBRE_REDACTADO]"

# What counts as personal data.
#
# An address may start at any word boundary. All starts within one run of its
# characters share what follows, so only the first can succeed: the first word
# character of the run, or a sign right after the previous address. Trying no
# other keeps long runs without an address linear. Signs before that word
# character belong to the run but not to the address: group 1.
_RUN = f"{WORD}.+-"
EMAIL = (
    rf"((?<![{_RUN}]{{1,2}})[.+-]*+(?=[{WORD}])|\G(?<=[{WORD}]{{1,2}})(?=[.+-]))"
    rf"[{_RUN}]++@[{WORD}-]++\.[{WORD}.]*[{WORD}]"
)
DNI = rf"{NOT_AFTER_WORD}\p{{Nd}}{{8}}{NOT_BEFORE_WORD}"
RUC = rf"{NOT_AFTER_WORD}\p{{Nd}}{{11}}{NOT_BEFORE_WORD}"
PHONE = (
    rf"(?:(?<=[{WORD}]{{1,2}})\+51[{SPACE}]?|{NOT_AFTER_WORD})"
    rf"(?:9\p{{Nd}}{{8}}|\p{{Nd}}{{7,8}}){NOT_BEFORE_WORD}"
)
NAME_WORDS = 5

# A first line of at most NAME_WORDS words; stops reading at the sixth.
_SHORT_LINE = rf"^[{SPACE}]*+(?:[^{SPACE}]++[{SPACE}]*+){{0,{NAME_WORDS}}}+\z"
_BLANK_LEAD = rf"^(?:[{SPACE}&&[^\n]]*\n)+"

# No id or phone can match where no seven digits stand together.
DIGIT_RUN = r"\p{Nd}{7}"


def redact_email(text: Column) -> Column:
    return F.regexp_replace(text, EMAIL, f"$1{EMAIL_TAG}")


def redact_dni(text: Column) -> Column:
    return F.regexp_replace(text, DNI, DNI_TAG)


def redact_ruc(text: Column) -> Column:
    return F.regexp_replace(text, RUC, RUC_TAG)


def redact_phone(text: Column) -> Column:
    return F.regexp_replace(text, PHONE, PHONE_TAG)


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def has_name_line(text: Column) -> Column:
    """True when the first line is short enough to be taken for the name."""
    return F.rlike(first_line(text), F.lit(_SHORT_LINE))


def without_blank_lead(text: Column) -> Column:
    return F.regexp_replace(text, _BLANK_LEAD, "")


def mask_name_line(text: Column, skip_blank_lead: bool = False) -> Column:
    """Replace a short first line by the name tag.

    ``text`` should be a plain column: it is read several times.
    ``skip_blank_lead`` drops blank leading lines first, so that the name below
    them is masked. It is off by default, where a blank first line counts as
    the name line.
    """
    body = without_blank_lead(text) if skip_blank_lead else text
    rest = F.substr(body, F.length(first_line(body)) + 1)
    return F.when(has_name_line(body), F.concat(F.lit(NAME_TAG), rest)).otherwise(body)
