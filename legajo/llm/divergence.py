"""How far sources of a language differ in their words: a cube of (group, group, term) cells.

Groups are (language, source). Each language keeps the terms that occur in ``least_docs`` of its documents or more;
a group gives each kept term the smoothed share ``p = 1 + floor(SCALE * (count + 2) / (N + 2 V))`` and two groups differ by
``floor((p - q)^2 / (p + q))`` summed over the terms. Groups of a language are numbered and cut into blocks, its terms are dealt to
blocks by hash, and a cell owns one (group block, group block, term block): the slices it needs are copied to it, it adds
up its terms, and cells are summed along the term axis. A cell holds ``2 * groups_per_block * terms_per_block`` numbers
at most, whatever the corpus. Terms that neither side of a cell holds are not shipped; they count by their number.

All arithmetic is on 64-bit integers and exact: the division by ``N + 2 V`` is a long division in steps of 1,000, good for
9 * 10^15 words in a group. Null texts, languages and sources are read as ``""``. Rows count as often as they occur; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legajo.llm.scratch import saved

#: Everything but letters and bytes beyond ASCII parts terms; of the letters only A-Z change.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: Terms a task counts before it passes them on.
MOST_COUNTED = 200_000


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return (text or "").encode().translate(_FOLD).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents per group, of ``lang``, ``source`` and ``text``.

    Tasks count in bounded tables and pass sums on, so a frequent term costs a row per task and not one per occurrence.
    """

    def batch(counts: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, held) in counts.items():
            words = list(n)
            columns = [
                pa.array([lang] * len(words), pa.string()),
                pa.array([source] * len(words), pa.string()),
                pa.array(words, pa.binary()).cast(pa.string()),
                pa.array(list(n.values()), pa.int64()),
                pa.array([held[w] for w in words], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for rows in batches:
            for lang, source, text in zip(*(rows.column(i).to_pylist() for i in range(3))):
                n, held = counts.setdefault((lang, source), (Counter(), Counter()))
                found = terms(text)
                size -= len(n)
                n.update(found)
                size += len(n)
                held.update(set(found))
                if size > MOST_COUNTED:
                    yield from batch(counts)
                    counts, size = {}, 0
        yield from batch(counts)

    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    parts = docs.select(name("lang"), name("source"), "text").mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, size: Column) -> Column:
    """``1 + floor(10^9 * (count + 2) / size)`` by long division; 0 where ``size`` is 0 and there is nothing to share."""
    size = F.nullif(size, F.lit(0).cast("long"))
    rest, digits = count + 2, F.lit(0).cast("long")
    for _ in range(3):
        rest = rest * 1000
        digits = digits * 1000 + F.call_function("div", rest, size)
        rest = rest % size
    return F.coalesce(1 + digits, F.lit(0).cast("long"))


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))``; 0 for two zeros."""
    return F.coalesce(F.call_function("div", (p - q) * (p - q), F.nullif(p + q, F.lit(0).cast("long"))), F.lit(0).cast("long"))


def kept_terms(counts: DataFrame, least_docs: int = 10) -> DataFrame:
    """(lang, source, term, n, lang_n, first): counts of the kept terms; ``first`` marks one row of each term of a language."""
    w = Window.partitionBy("lang", "term")
    df = counts.select(
        "*", F.sum("docs").over(w).alias("held"), F.sum("n").over(w).alias("lang_n"), (F.min("source").over(w) == F.col("source")).alias("first")
    )
    return df.filter(F.col("held") >= least_docs).drop("docs", "held")


def groups(docs: DataFrame, kept: DataFrame, groups_per_block: int, terms_per_block: int) -> DataFrame:
    """(lang, source, no, block, blocks, term_blocks, size, lang_size, p0): one row for each group that occurs.

    ``size`` and ``lang_size`` are the divisors of the shares, 0 where a language keeps no term; ``p0`` is the share of a term
    that the group lacks. Groups of a language are numbered by name.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"), F.sum(F.col("first").cast("long")).alias("firsts"))
    df = docs.select(name("lang"), name("source")).distinct().join(sums, ["lang", "source"], "left").fillna(0, ["words", "firsts"])
    lang = Window.partitionBy("lang")
    df = df.select(
        "lang", "source", "words",
        (F.row_number().over(lang.orderBy("source")) - 1).alias("no"),
        F.sum("words").over(lang).alias("lang_words"),
        F.sum("firsts").over(lang).alias("terms"),
        F.count("*").over(lang).alias("n"),
    )
    blocks = lambda n, each: F.greatest(F.lit(1), F.ceil(n / each)).cast("int")
    size = F.col("words") + 2 * F.col("terms")
    return df.select(
        "lang", "source", "no", "terms",
        F.floor(F.col("no") / groups_per_block).cast("int").alias("block"),
        blocks(F.col("n"), groups_per_block).alias("blocks"),
        blocks(F.col("terms"), terms_per_block).alias("term_blocks"),
        size.alias("size"),
        (F.col("lang_words") + 2 * F.col("terms")).alias("lang_size"),
        share(F.lit(0).cast("long"), size).alias("p0"),
    )


def _cell(key: tuple, rows: pd.DataFrame, groups_per_block: int) -> pd.DataFrame:
    """Sums over a cell's terms for each pair of its two group blocks, and how many terms the cell has."""
    lang, low, high, _ = key
    heads = rows[rows["term"].isna()].sort_values("no")
    rows = rows[rows["term"].notna()]
    numbers = heads["no"].to_numpy()
    code, found = pd.factorize(rows["term"])
    shares = np.repeat(heads["p"].to_numpy()[:, None], len(found), axis=1)
    shares[np.searchsorted(numbers, rows["no"].to_numpy()), code] = rows["p"].to_numpy()
    block = numbers // groups_per_block
    right = np.flatnonzero(block == high)
    out = []
    for i in np.flatnonzero(block == low):
        others = right[numbers[right] > numbers[i]]
        p, q = shares[i], shares[others]
        out.append(pd.DataFrame({"a": numbers[i], "b": numbers[others], "part": ((p - q) ** 2 // np.maximum(p + q, 1)).sum(axis=1)}))
    return pd.concat(out).assign(lang=lang, seen=len(found))[["lang", "a", "b", "part", "seen"]]


def pair_sums(kept: DataFrame, known: DataFrame, groups_per_block: int) -> DataFrame:
    """(lang, a, b, value) for ``a < b``, numbers of two groups of a language; only the cells on and above the diagonal are computed."""
    about = known.select("lang", "source", "no", "block", "blocks", "term_blocks", "size")
    rows = kept.join(about, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("size")))
    rows = rows.withColumn("term_block", F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int"))
    # Each cell learns of every group of its blocks, whether it holds one of the terms or none.
    heads = known.withColumn("term_block", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)))
    heads = heads.withColumns({"term": F.lit(None).cast("string"), "p": F.col("p0")})
    columns = ["lang", "no", "block", "blocks", "term_block", "term", "p"]
    slices = rows.select(*columns).unionByName(heads.select(*columns))
    slices = slices.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = slices.select("lang", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "term_block", "no", "term", "p")
    parts = cells.groupBy("lang", "low", "high", "term_block").applyInPandas(
        lambda key, rows: _cell(key, rows, groups_per_block), "lang string, a int, b int, part long, seen long"
    )
    return parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("part"), F.sum("seen").alias("seen"))


def audit(docs: DataFrame, least_docs: int = 10, top: int = 10, groups_per_block: int = 64, terms_per_block: int = 4096) -> DataFrame:
    """(lang, source, part, item, value, rank) for every group of ``docs``.

    Part ``pair``: the divergence from each other source of the language. Part ``term``: the ``top`` terms that the group uses more
    than its language does, by their term of the sum. Ranks count from 1 by value, then by the item's UTF-8. A language with one source
    has no pairs; groups of a language that keeps no term differ by 0.
    """
    kept = saved(kept_terms(saved(term_counts(docs), "term-counts"), least_docs), "kept-terms")
    known = saved(groups(docs, kept, groups_per_block, terms_per_block), "groups")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(best).alias("rank")

    sums = saved(pair_sums(kept, known, groups_per_block), "pair-sums")
    a = known.select("lang", F.col("no").alias("a"), F.col("source").alias("source_a"), F.col("p0").alias("p"), "terms")
    b = known.select("lang", F.col("no").alias("b"), F.col("source").alias("source_b"), F.col("p0").alias("q"))
    pairs = sums.join(a, ["lang", "a"]).join(b, ["lang", "b"])
    value = F.col("part") + (F.col("terms") - F.col("seen")) * gap(F.col("p"), F.col("q"))
    pairs = pairs.select("lang", value.alias("value"), F.inline(F.array(
        F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
        F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")),
    )))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank)

    words = kept.join(known.select("lang", "source", "size", "lang_size"), ["lang", "source"])
    words = words.select("lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("size")).alias("p"), share(F.col("lang_n"), F.col("lang_size")).alias("q"))
    words = words.filter("p > q").select("lang", "source", F.lit("term").alias("part"), "item", gap(F.col("p"), F.col("q")).alias("value"))
    words = words.select("*", rank).filter(F.col("rank") <= top)
    return pairs.unionByName(words)
