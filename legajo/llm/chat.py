"""Chat formatting with spans found by rendering: the template is a black box.

A template is a function from a list of (role, text) to a string. Each prefix of a conversation is rendered and compared with
the prefix before: what is new is the turn's span. A template that changes what it wrote before is reported, with the first
turn that makes it do so, and its spans are left out, since no mask over such an output is right. Inside a span the text is
found by rendering the turn with two probes in its place that differ in their first and last characters: what
both outputs share in front and behind is the template's own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from os.path import commonprefix

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]
PROBES = ("ab", "ba")


def escape(text: str) -> str:
    """No ``<|`` is left: a backslash is doubled and one put inside each ``<|``."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    """What ``escape`` was given: a backslash stands for the character behind it."""
    out, parts = [], iter(text.split("\\"))
    out.append(next(parts))
    for part in parts:
        # An empty part between two backslashes is a doubled one; the part after it is plain.
        out.append(part if part else "\\" + next(parts, ""))
    return "".join(out)


def chatml(turns: list[Turn]) -> str:
    """Turns between control strings; a line break in a role is escaped as well."""
    return "".join(f"<|im_start|>{escape(role).replace(chr(10), '<' + chr(92) + 'n')}\n{escape(text)}<|im_end|>\n" for role, text in turns)


def read_turn(span: str) -> Turn:
    """Role and text of one ``chatml`` turn."""
    head, _, rest = span.removeprefix("<|im_start|>").partition("\n")
    return unescape(head.replace("<\\n", "\n")), unescape(rest.removesuffix("<|im_end|>\n"))


def spans(turns: list[Turn], template: Template) -> tuple[str, list[tuple[int, int, int, int]], int | None]:
    """The output, for each turn (start, end, text start, text end) in it, and the first turn that rewrites history, if any."""
    before, found = template([]), []
    for k in range(len(turns)):
        after = template(turns[: k + 1])
        if not after.startswith(before):
            return template(turns), [], k
        one, two = (template([*turns[:k], (turns[k][0], p)]) for p in PROBES)
        front = len(commonprefix([one, two]))
        back = len(commonprefix([one[front:][::-1], two[front:][::-1]]))
        found.append((len(before), len(after), front, len(after) - back))
        before = after
    return before, found, None


def formatted(
    conversations: DataFrame, template: Template = chatml, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: conv, formatted, turns (role and the four ends of each), rewritten_at.

    Turns are ordered by ``turn`` (nulls first), role and text, so that ties have one order; repeated rows are turns of their own.
    Null roles and texts are empty. Rows without a conversation id are one conversation. ``rewritten_at`` is null where the
    template keeps what it wrote; else the number of the first turn that changes it, and ``turns`` is empty. A conversation is
    one task's work and takes time in the square of its turns.
    """
    column = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = conversations.select(
        F.col(conv).alias("id"), F.struct(F.col(turn).alias("at"), column(role).alias("role"), column(text).alias("text")).alias("row")
    )
    rows = rows.groupBy("id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    # array_sort puts nulls within structs first.

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out = []
            for turns in df["rows"]:
                turns = [(t["role"], t["text"]) for t in turns]
                whole, found, at = spans(turns, template)
                ends = [dict(zip(("role", "start", "end", "text_start", "text_end"), (r, *f))) for (r, _), f in zip(turns, found)]
                out.append((whole, ends, at))
            result = pd.DataFrame(out, columns=["formatted", "turns", "rewritten_at"])
            result.insert(0, "id", df["id"].array)
            yield result.astype({"rewritten_at": "Int32"})

    kind = rows.schema["id"].dataType.simpleString()
    ends = "array<struct<role: string, start: int, end: int, text_start: int, text_end: int>>"
    return rows.mapInPandas(run, f"id {kind}, formatted string, turns {ends}, rewritten_at int").withColumnRenamed("id", conv)


def digests(rows: DataFrame, conv: str = "conv_id", trained: str = "assistant") -> DataFrame:
    """What can be read back from ``chatml`` outputs: turns, their digest, and the text under the loss mask.

    The mask covers the texts of turns whose role is ``trained``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out = []
            for whole, turns in zip(df["formatted"], df["turns"]):
                read = [read_turn(whole[t["start"] : t["end"]]) for t in turns]
                loss = "".join(unescape(whole[t["text_start"] : t["text_end"]]) for t, (r, _) in zip(turns, read) if r == trained)
                every = "".join(f"{r}\n{t}\n" for r, t in read)
                hexes = [hashlib.sha256(x.encode()).hexdigest() for x in (every, loss)]
                out.append((len(read), hexes[0], len(loss), hexes[1], len(whole)))
            result = pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            result.insert(0, "id", df["id"].array)
            yield result

    kind = rows.schema[conv].dataType.simpleString()
    schema = f"id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return rows.select(F.col(conv).alias("id"), "formatted", "turns").mapInPandas(run, schema).withColumnRenamed("id", conv)
