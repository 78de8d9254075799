"""Whole-table masking and the audit of what was masked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legajo.functions import names as N
from legajo.functions import redact as R

_STEP = "_masking"


# A prefixed phone may go on in the next line; all else ends with its line.
_ACROSS = "+51\n"


def _masked_email(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("@")), R.redact_email(text)).otherwise(text)


def _if_digits(text: Column, then: Column) -> Column:
    return F.when(F.rlike(text, F.lit(R.DIGIT_RUN)), then).otherwise(text)


def _masked_numbers(text: Column) -> Column:
    return R.redact_phone(R.redact_ruc(R.redact_dni(text)))


def _mask_items(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``, the text without e-mails, ids and phones.

    A narrow job. The regexes are the cost, so they run on the lines with an
    ``@`` or a run of digits only; a text with neither is not split at all.
    """
    raw = F.col(text)
    suspect = F.contains(raw, F.lit("@")) | F.rlike(raw, F.lit(R.DIGIT_RUN))
    no_emails = F.transform(F.split(raw, "\n"), _masked_email)
    lines = F.transform(no_emails, lambda line: _if_digits(line, _masked_numbers(line)))
    masked = (
        F.when(F.contains(raw, F.lit(_ACROSS)), _masked_numbers(R.redact_email(raw)))
        .when(suspect, F.array_join(lines, "\n"))
        .otherwise(raw)
    )
    return df.withColumn(out, masked)


def anonymize(
    df: DataFrame,
    text: str = "text",
    out: str = "text_anon",
    *,
    skip_blank_lead: bool = False,
    names: bool = False,
) -> DataFrame:
    """Mask e-mail, DNI, RUC, phone and name line, in that order, into ``out``.

    The name step is a projection of its own: it reads its input more than once
    and would repeat all regexes if nested. With ``names`` the names that the first line
    or a label gives are masked wherever the text mentions them.
    """
    masked = _mask_items(df, text, _STEP)
    if skip_blank_lead:
        masked = masked.withColumn(_STEP, R.without_blank_lead(F.col(_STEP)))
    if names:
        # In steps, as each is read several times by the next.
        masked = masked.withColumn("_first", R.first_line(R.without_blank_lead(F.col(_STEP))))
        masked = masked.select("*", F.explode(F.array(N.name_words(F.col(_STEP), F.col("_first")))).alias("_names"))
        masked = masked.withColumn(_STEP, N.mask_mentions(F.col(_STEP), F.col("_names"))).drop("_first", "_names")
    return masked.withColumn(out, R.mask_name_line(F.col(_STEP))).drop(_STEP)


# The tag that stands for each kind, and what a second look searches for.
_KINDS = {
    "emails": (R.EMAIL_TAG, R.EMAIL),
    "dnis": (R.DNI_TAG, R.DNI),
    "rucs": (R.RUC_TAG, R.RUC),
    "phones": (R.PHONE_TAG, R.PHONE),
}


def _times(text: Column, tag: str) -> Column:
    rest = F.replace(text, F.lit(tag), F.lit(""))
    return ((F.length(text) - F.length(rest)) / len(tag)).cast("long")


def _left_over(text: Column) -> Column:
    suspect = F.contains(text, F.lit("@")) | F.rlike(text, F.lit(R.DIGIT_RUN))
    found = sum((F.regexp_count(text, F.lit(p)) for _, p in _KINDS.values()), F.lit(0))
    return F.when(suspect, found).otherwise(0).cast("long")


def pii_audit(df: DataFrame, by: list[str], text: str = "text") -> DataFrame:
    """Items masked of each kind per group, and what a second look still finds.

    Tags that masking adds are counted, so no regex runs twice: a tag already in
    the text is counted before and after alike, as no match can hold one. The
    sums combine map-side, so a group of any size shuffles as one row per task.
    """
    work = _mask_items(df.select(*by, F.col(text).alias("_raw")), "_raw", _STEP)
    added = {
        kind: _times(F.col(_STEP), tag) - _times(F.col("_raw"), tag)
        for kind, (tag, _) in _KINDS.items()
    }
    counted = work.select(
        *by,
        *[n.alias(kind) for kind, n in added.items()],
        R.has_name_line(F.col(_STEP)).cast("long").alias("names"),
        R.mask_name_line(F.col(_STEP)).alias("_final"),
    )
    sums = [F.sum(kind).alias(kind) for kind in (*_KINDS, "names")]
    return counted.groupBy(*by).agg(
        F.count("*").alias("docs"), *sums, F.sum(_left_over(F.col("_final"))).alias("left_over")
    )
