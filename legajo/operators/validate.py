"""Model replies to typed records: parse, check every rule, set failures apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legajo.functions.contract import CV_RULES, JD_RULES, FieldRule, sql_type
from legajo.functions.patterns import SPACE

# A number as Python writes one in a string: digits with single underscores.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_NUMBER = (
    rf"(?i)^[{SPACE}]*[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})"
    rf"(?:e[+-]?{_DIGITS})?|inf|infinity|nan)[{SPACE}]*\z"
)
_NUMERIC = r"^(?:BIGINT|DOUBLE|FLOAT|BOOLEAN|DECIMAL)"


def _get(variant: Column, path: str, as_type: str) -> Column:
    return F.try_variant_get(variant, path, as_type)


def _type_of(variant: Column, path: str) -> Column:
    """The JSON type at ``path``; null when absent, VOID for a JSON null."""
    return F.schema_of_variant(_get(variant, path, "variant"))


def _is_string(variant: Column, path: str) -> Column:
    return F.coalesce(_type_of(variant, path) == "STRING", F.lit(False))


def _number(variant: Column, path: str) -> Column:
    """The double at ``path`` or null; reads numeric strings and booleans too."""
    kind = _type_of(variant, path)
    text = _get(variant, path, "string")
    plain = F.regexp_replace(F.lower(text), rf"[_{SPACE}]|^[{SPACE}]*\+|-(?=nan)", "")
    from_text = F.when(F.rlike(text, F.lit(_NUMBER)), plain.try_cast("double"))
    return F.when(F.rlike(kind, F.lit(_NUMERIC)), _get(variant, path, "double")).when(
        kind == "STRING", from_text
    )


def _value(variant: Column, rule: FieldRule) -> Column:
    path = f"$.{rule.name}"
    if rule.kind == "float":
        return _number(variant, path)
    kind = _type_of(variant, path)
    if rule.kind in ("str", "enum"):
        return F.when(kind == "STRING", _get(variant, path, "string"))
    if rule.kind == "list_str":
        value = F.when(kind.isin("ARRAY<STRING>", "ARRAY<VOID>"), _get(variant, path, sql_type(rule)))
    else:
        member = lambda item, m: F.when(_is_string(item, f"$.{m}"), _get(item, f"$.{m}", "string")).alias(m)
        items = F.when(kind.startswith("ARRAY<"), _get(variant, path, "array<variant>"))
        value = F.transform(items, lambda i: F.struct(*[member(i, m) for m in rule.members]))
    return F.coalesce(value, F.array().cast(sql_type(rule))) if rule.optional else value


def _valid(variant: Column, rule: FieldRule) -> Column:
    path = f"$.{rule.name}"
    kind = _type_of(variant, path)
    if rule.kind in ("str", "enum"):
        ok = kind == "STRING"
        if rule.values:
            ok = ok & _get(variant, path, "string").isin(*rule.values)
    elif rule.kind == "float":
        number = _number(variant, path)
        ok = number.isNotNull()
        if rule.minimum is not None:
            # Spark orders NaN above every number, so it is excluded by name.
            ok = ok & (number >= rule.minimum) & ~F.isnan(number)
    elif rule.kind == "list_str":
        items = _get(variant, path, "array<string>")
        # An empty list and a list of nulls only have the same type.
        ok = kind.isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.exists(items, lambda i: i.isNull())
    elif rule.kind == "list_struct":

        def incomplete(item: Column) -> Column:
            whole = F.lit(True)
            for member in rule.members:
                whole = whole & _is_string(item, f"$.{member}")
            return ~whole

        items = _get(variant, path, "array<variant>")
        ok = kind.startswith("ARRAY<") & ~F.exists(items, incomplete)
    else:
        raise ValueError(f"unknown kind: {rule.kind}")
    ok = F.coalesce(ok, F.lit(False))
    return ok | kind.isNull() if rule.optional else ok


def _is_object(variant: Column) -> Column:
    return F.coalesce(F.schema_of_variant(variant).startswith("OBJECT<"), F.lit(False))


def _record(variant: Column, rules: Sequence[FieldRule]) -> Column:
    return F.struct(*[_value(variant, r).alias(r.name) for r in rules])


def keep_together(df: DataFrame, *columns: str) -> DataFrame:
    """Compute the columns once per row, whatever is filtered on later.

    Spark moves a filter below the projection it reads and repeats the column's
    whole expression in it: here, one JSON parse per reference. Filters do not
    move below a generator, so the columns pass through a one-row ``inline``.
    """
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.inline(F.array(F.struct(*columns))))


def parse_response(df: DataFrame, rules: Sequence[FieldRule], body: str = "body") -> DataFrame:
    """Add ``is_json`` and ``record``, the typed reply.

    Unknown keys are ignored. Values that do not fit come out as null: see
    ``validate_response`` for why. Text that is not a JSON object gives a null
    record and ``is_json`` false.
    """
    variant = F.col("_v")
    parsed = (
        df.withColumn("_v", F.try_parse_json(F.col(body)))
        .withColumn("is_json", _is_object(variant))
        .withColumn("record", F.when(F.col("is_json"), _record(variant, rules)))
        .drop("_v")
    )
    return keep_together(parsed, "is_json", "record")


def validate_response(df: DataFrame, rules: Sequence[FieldRule], body: str = "body") -> DataFrame:
    """Add ``is_json``, ``errors`` and ``record``, the typed reply if it has none.

    ``errors`` names the failing fields in record order; ``["json"]`` stands for
    text that is not a JSON object. Strings are strict; a number may come as an
    integer, a numeric string or a boolean. A repeated key counts as broken JSON
    unless ``spark.sql.variant.allowDuplicateKeys`` is set, when the last stays.
    """
    variant = F.col("_v")
    failing = F.array_compact(
        F.array(*[F.when(~_valid(variant, r), F.lit(r.name)) for r in rules])
    )
    checked = (
        df.withColumn("_v", F.try_parse_json(F.col(body)))
        .withColumn("is_json", _is_object(variant))
        .withColumn("errors", F.when(F.col("is_json"), failing).otherwise(F.array(F.lit("json"))))
        .withColumn("record", F.when(F.size("errors") == 0, _record(variant, rules)))
        .drop("_v")
    )
    return keep_together(checked, "is_json", "errors", "record")


def validate_cv(df: DataFrame, body: str = "body") -> DataFrame:
    return validate_response(df, CV_RULES, body)


def validate_jd(df: DataFrame, body: str = "body") -> DataFrame:
    return validate_response(df, JD_RULES, body)


def split_quarantine(validated: DataFrame, store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined): each row of ``validated`` is in exactly one.

    With ``store``, a folder that does not exist yet, the rows are checked and
    written once, by side, and both results read from there. Without it both
    are filters, and using both checks everything twice.
    """
    sides = validated.withColumn(
        "side", F.when(F.size("errors") == 0, "good").otherwise("quarantine")
    )
    if store is not None:
        sides.write.partitionBy("side").parquet(store)
        sides = validated.sparkSession.read.schema(sides.schema).parquet(store)
    return tuple(sides.filter(F.col("side") == s).drop("side") for s in ("good", "quarantine"))
