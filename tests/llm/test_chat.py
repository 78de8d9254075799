"""Formatting, spans and masks read back."""

import random

from legajo.llm import chat

PIECES = ["\\", "<", "|", "<|", "n", "\n", "|>", "<|im_end|>", "<|im_start|>assistant ", "a", "é"]


def test_escapes_and_spans_come_back():
    rng = random.Random(1)
    draw = lambda k: "".join(rng.choices(PIECES, k=rng.randint(0, k)))
    for _ in range(3_000):
        turns = [(draw(5), draw(8)) for _ in range(rng.randint(0, 4))]
        assert all("<|" not in chat.escape(t) and chat.unescape(chat.escape(t)) == t for _, t in turns)
        whole, spans, at = chat.spans(turns, chat.chatml)
        assert at is None and whole == chat.chatml(turns)
        for turn, (start, end, a, b) in zip(turns, spans, strict=True):
            assert chat.read_turn(whole[start:end]) == turn and chat.unescape(whole[a:b]) == turn[1]


def last_only(turns):
    """Thoughts stay in the last turn only, as some templates do."""
    cut = [(r, t.partition("</think>")[2] or t) for r, t in turns[:-1]]
    return chat.chatml(cut + list(turns[-1:]))


def test_a_template_that_rewrites_history_is_reported():
    turns = [("user", "a"), ("assistant", "x</think>b"), ("user", "c")]
    assert chat.spans(turns, last_only)[1:] == ([], 2)
    assert chat.spans(turns[:2], last_only)[2] is None


def test_tables_with_nulls_ties_and_clashing_names(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, None, None, None), (2, None, "assistant", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, id string")
    got = {r["conv_id"]: r for r in chat.digests(chat.formatted(df)).collect()}
    assert {k: (r["n_turns"], r["loss_chars"]) for k, r in got.items()} == {1: (3, 1), None: (1, 0), 2: (1, 0)}
    assert chat.formatted(df.filter("false")).count() == 0
    rewriting = chat.formatted(df, lambda turns: f"{len(turns)}").filter("rewritten_at is not null")
    assert {r["rewritten_at"] for r in rewriting.collect()} == {0}
