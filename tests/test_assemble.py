"""Assembly against a plain grouping."""

import random
from collections import defaultdict

from legajo.operators.assemble import assemble_pages, assemble_paragraphs, order_pages


def pages(n_docs, rng):
    rows = []
    for doc in range(n_docs):
        for page in range(rng.randint(1, 6)):
            rows.append((doc, page, rng.choice(["", " ", "\t \x1f", "uno", " dos ", "tres\ncuatro", " "])))
    rng.shuffle(rows)
    return rows


def expected(rows, keep=lambda t: True):
    docs = defaultdict(list)
    for doc, page, text in rows:
        docs[doc] += [(page, text)] if keep(text) else []
    return {d: "\n".join(t for _, t in sorted(ps)) for d, ps in docs.items()}


def test_pages(spark):
    rows = pages(300, random.Random(3))
    df = spark.createDataFrame(rows, "doc long, page int, text string").repartition(8)
    out = assemble_pages(df, "doc", "page", "text").collect()
    assert {r["doc"]: r["text"] for r in out} == expected(rows)
    assert len(out) == 300


def test_paragraphs(spark):
    rows = pages(300, random.Random(4))
    df = spark.createDataFrame(rows, "doc long, page int, text string").repartition(8)
    out = {r["doc"]: r["text"] for r in assemble_paragraphs(df, "doc", "page", "text").collect()}
    assert out == expected(rows, keep=lambda t: t.strip())
    assert "" in out.values()


def test_pages_of_a_large_document_are_ordered_over_tasks(spark):
    rows = [(d, f"2020-01-{p:02}", f"{d}.{p}") for d in range(100) for p in range(5)]
    rows += [(999, f"p{p:05}", f"texto {p}") for p in range(1_000)]
    df = spark.createDataFrame(rows, "doc long, page string, text string").repartition(8)
    ordered = order_pages(df, "doc", "page")
    assert [tuple(r) for r in ordered.collect()] == sorted(rows)
    big = assemble_pages(ordered.filter("doc = 999"), "doc", "page", "text").collect()
    assert [(r["doc"], r["text"]) for r in big] == [(999, expected(rows)[999])]


def test_null_document(spark):
    df = spark.createDataFrame([(None, 1, "b"), (None, 0, "a")], "doc long, page int, text string")
    assert [r["text"] for r in assemble_pages(df, "doc", "page", "text").collect()] == ["a\nb"]
