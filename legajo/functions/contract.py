"""The two record contracts: fields, types and rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class FieldRule:
    """One field of a record.

    ``kind`` is str, enum, float, list_str or list_struct. ``optional`` lets the
    key be absent, giving an empty list; an explicit null still fails.
    """

    name: str
    kind: str
    values: tuple[str, ...] = ()
    minimum: float | None = None
    members: tuple[str, ...] = ()
    optional: bool = False


# Field names, kinds and allowed values of the two records.
LEVELS = ("junior", "semi-senior", "senior", "lead")
DEGREES = ("tecnico", "bachiller", "licenciado", "magister", "doctor")
LANGUAGE = ("idioma", "nivel")

CV_RULES = (
    FieldRule("candidato_id", "str"),
    FieldRule("nivel_experiencia", "enum", values=LEVELS),
    FieldRule("anos_experiencia", "float", minimum=0),
    FieldRule("skills_tecnicos", "list_str"),
    FieldRule("skills_blandos", "list_str"),
    FieldRule("industrias", "list_str"),
    FieldRule("cargos_anteriores", "list_str"),
    FieldRule("nivel_educacion", "enum", values=DEGREES),
    FieldRule("carreras", "list_str"),
    FieldRule("certificaciones", "list_str", optional=True),
    FieldRule("idiomas", "list_struct", members=LANGUAGE),
    FieldRule("resumen_perfil", "str"),
)

JD_RULES = (
    FieldRule("jd_id", "str"),
    FieldRule("titulo_puesto", "str"),
    FieldRule("nivel_requerido", "enum", values=LEVELS),
    FieldRule("anos_experiencia_min", "float"),
    FieldRule("skills_requeridos", "list_str"),
    FieldRule("skills_deseables", "list_str"),
    FieldRule("industria_preferida", "list_str"),
    FieldRule("nivel_educacion_minimo", "str"),
    FieldRule("idiomas_requeridos", "list_struct", members=LANGUAGE),
    FieldRule("descripcion_rol", "str"),
)

_SQL_TYPES = {"str": "string", "enum": "string", "float": "double", "list_str": "array<string>"}


def sql_type(rule: FieldRule) -> str:
    if rule.kind == "list_struct":
        return "array<struct<%s>>" % ",".join(f"{m}:string" for m in rule.members)
    return _SQL_TYPES[rule.kind]


def record_schema(rules: Sequence[FieldRule]) -> str:
    """The record as a DDL schema, for reading written records back."""
    return ", ".join(f"{r.name} {sql_type(r)}" for r in rules)
