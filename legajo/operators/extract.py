"""Rule-based extraction over whole tables of documents.

In place of a hosted model these fill the record fields by rule, with results
that follow the record contract but are not what a model would write. All but
the large-lexicon path are narrow: each document is read where it lies and
nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legajo.functions import extract as X
from legajo.functions import lexicon as L
from legajo.functions import text as T


def with_sections(df: DataFrame, text: str = "text", out: str = "sections", known: bool = False) -> DataFrame:
    """Add ``out``: the text cut at its headings.

    An array of (start, section, lines): the number of the first line, the
    heading (null before the first one) and the lines, heading included. A
    heading is a line of four or more capitals, and blanks, with or without a
    colon; for ``known``, whose headings come out in capitals and without accents,
    see ``functions.extract.heading``. Lines may end as on any system.
    """
    lines, heads, starts = F.col("_lines"), F.col("_heads"), F.col("_starts")
    is_heading = lambda line: X.heading(line, known)
    numbered = F.transform(lines, lambda line, i: F.when(is_heading(line), i))

    def section(start: Column, i: Column) -> Column:
        end = F.coalesce(F.get(starts, i + 1), F.size(lines))
        head = F.get(lines, start)
        # Only the first section may begin without a heading.
        headed = (i > 0) | F.coalesce(F.get(heads, F.lit(0)) == 0, F.lit(False))
        name = F.when(headed, X.heading_name(head) if known else F.trim(F.regexp_replace(head, ":$", "")))
        return F.struct(
            start.alias("start"),
            name.alias("section"),
            F.slice(lines, start + 1, end - start).alias("lines"),
        )

    opens = F.when(F.get(heads, F.lit(0)) == 0, heads).otherwise(F.concat(F.array(F.lit(0)), heads))
    return (
        df.withColumn("_lines", F.split(T.plain_breaks(F.col(text)), "\n"))
        .withColumn("_heads", F.filter(numbered, lambda i: i.isNotNull()))
        .withColumn("_starts", opens)
        .withColumn(out, F.transform(starts, section))
        .drop("_lines", "_heads", "_starts")
    )


def tag_sections(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc``, pos, line, section): each line with the last heading seen."""
    cut = with_sections(df.select(doc, text).filter(F.col(text).isNotNull()), text)
    # There is always a line, so "outer" changes no row. It keeps Spark from
    # adding a not-empty filter, which would repeat all of the above.
    parts = cut.select(doc, F.explode_outer("sections").alias("s"))
    lines = parts.select(
        doc,
        F.col("s.start").alias("start"),
        F.col("s.section").alias("section"),
        F.posexplode_outer("s.lines"),
    )
    return lines.select(
        doc, (F.col("start") + F.col("pos")).cast("long").alias("pos"), F.col("col").alias("line"), "section"
    )


def with_words(df: DataFrame, text: str, terms: Sequence[str], prefix: str = "") -> DataFrame:
    """Add ``_hits`` and ``_spaced``, what ``found_terms`` needs for ``terms``."""
    hits, spaced, words = f"{prefix}_hits", f"{prefix}_spaced", f"{prefix}_words"
    return (
        df.withColumn(words, X.words(F.col(text)))
        .withColumn(hits, X.term_hits(F.col(words), terms))
        .withColumn(spaced, X.spaced(F.col(words)))
        .drop(words)
    )


def _constant(one: DataFrame) -> Column:
    """The one value of ``one`` as a constant: lambdas take no subquery, so it comes to the driver and goes out with the plan."""
    field = one.schema[0]
    return F.from_json(F.lit(one.select(F.to_json(field.name)).first()[0]), field.dataType)


def _word_index(lexicon: DataFrame, buckets: int) -> Column:
    """All terms of (term, category) as one constant: ``buckets`` arrays of (first, words, term, category), dealt by their first word."""
    words = X.words(F.col("term"))
    terms = lexicon.select("term", "category", words.alias("words")).filter(F.size("words") > 0)
    entry = F.struct(F.get("words", F.lit(0)).alias("first"), "words", "term", "category")
    held = terms.groupBy(_bucket(F.get("words", F.lit(0)), buckets).alias("id")).agg(F.collect_list(entry).alias("terms"))
    none = F.array().cast(held.schema["terms"].dataType)
    dense = lexicon.sparkSession.range(buckets).join(held, "id", "left").select("id", F.coalesce("terms", none).alias("terms"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("id").cast("int").alias("id"), "terms")))
    return _constant(dense.agg(F.transform(ordered, lambda b: b["terms"]).alias("index")))


def _bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets))


def extract_terms(
    df: DataFrame,
    lexicon: Mapping[str, str] = L.TERMS,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(``doc``, one sorted array per category of the lexicon's terms found).

    Terms are met as runs of words, in any case, and come out as the lexicon writes them. Each row gives
    a row, also where ids repeat; a null text has no terms. The lexicon, which the caller holds in memory, becomes an index
    by first words that goes to the tasks as one constant: a text's words are looked up one by one, and only where a term
    begins with one are the words behind it compared. One map stage at any size of lexicon; ``extract_terms_table`` is for
    lexicons that are tables.
    """
    categories = list(dict.fromkeys(lexicon.values()))
    buckets = 1 << max(4, len(lexicon).bit_length())
    rows = df.sparkSession.createDataFrame(list(lexicon.items()), "term string, category string")
    index = _word_index(rows, buckets)
    # Words come through an explode, so that the look-ups do not build them anew.
    work = df.select(doc, F.explode_outer(F.array(X.words(F.coalesce(F.col(text), F.lit(""))))).alias("_words"))

    def begun(word: Column, i: Column) -> Column:
        size = lambda e: F.size(e["words"])
        met = lambda e: (e["first"] == word) & ((size(e) == 1) | (F.slice("_words", i + 1, size(e)) == e["words"]))
        return F.filter(F.get(index, _bucket(word, buckets)), met)

    found = F.array_distinct(F.flatten(F.transform("_words", begun)))
    work = work.select(doc, F.explode_outer(F.array(found)).alias("_found"))
    of = lambda c: F.transform(F.filter("_found", lambda e: e["category"] == c), lambda e: e["term"])
    return work.select(doc, *[F.array_sort(of(c)).alias(c) for c in categories])


def _lexicon_filter(runs: DataFrame, bits: int, ways: int = 3) -> Callable[[Column], Column]:
    """A test whether a run may be one of ``_run``, by a Bloom filter that is one constant of ``bits`` bits; a no is never wrong."""
    places = F.array(*[F.pmod(F.xxhash64("_run", F.lit(k)), F.lit(bits)) for k in range(ways)])
    place = runs.select(F.explode(places).alias("p")).select(F.shiftright("p", 6).alias("id"), (F.col("p") % 64).cast("int").alias("bit"))
    word = place.groupBy("id").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("w"))
    dense = runs.sparkSession.range(bits >> 6).join(word, "id", "left").select("id", F.coalesce("w", F.lit(0).cast("long")).alias("w"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("id").cast("int").alias("id"), "w")))
    value = _constant(dense.agg(F.transform(ordered, lambda x: x["w"]).alias("bits")))

    def may_hold(run: Column) -> Column:
        test = F.lit(True)
        for k in range(ways):
            p = F.pmod(F.xxhash64(run, F.lit(k)), F.lit(bits))
            test = test & (F.getbit(F.get(value, F.shiftright(p, 6)), (p % 64).cast("int")) == 1)
        return test

    return may_hold


def extract_terms_table(
    df: DataFrame,
    lexicon: DataFrame,
    categories: Sequence[str],
    doc: str = "doc_id",
    text: str = "text",
    filter_bits: int = 1 << 20,
) -> DataFrame:
    """``extract_terms`` for a lexicon table (term, category) of any size.

    Terms of any number of words and in any case are found; runs of words are
    built in the lengths that the lexicon has, read from it first. Terms come out
    as the lexicon writes them. A filter of ``filter_bits`` bits, an eighth of a megabyte whatever the lexicon, leaves out nearly all
    runs that are no term before any is a row, so that what is shuffled grows with the hits; from some 100,000 terms on more bits
    leave out more. The join then decides: how it meets the lexicon is left to Spark's statistics and its handling of
    skew. A text without a hit is one row. ``doc`` must be unique.
    """
    key = X.words(F.col("term"))
    lexicon = lexicon.select("term", "category", F.concat_ws(" ", key).alias("_run"), F.size(key).alias("_n"))
    lexicon = lexicon.filter("_n > 0")
    lengths = _constant(lexicon.agg(F.array_sort(F.collect_set("_n")).alias("lengths")))
    may_hold = _lexicon_filter(lexicon, filter_bits)
    work = df.select(doc, F.explode_outer(F.array(X.words(F.col(text)))).alias("_words"))
    hits = F.flatten(F.transform(lengths, lambda n: F.filter(X.grams(F.col("_words"), n), may_hold)))
    runs = work.select(doc, F.explode_outer(F.array_distinct(hits)).alias("_run"))
    hits = runs.join(lexicon.drop("_n"), "_run", "left")
    found = [F.array_sort(F.collect_set(F.when(F.col("category") == c, F.col("term")))).alias(c) for c in categories]
    return hits.groupBy(doc).agg(*found)


def extract_years(df: DataFrame, doc: str = "doc_id", text: str = "text", default: float | None = 0.0) -> DataFrame:
    """(``doc``, years): the largest "n años", else ``default``."""
    years = X.years_required(F.col(text))
    return df.select(doc, F.coalesce(years, F.lit(default).cast("double")).alias("years"))


def extract_education(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc``, highest, lowest) degree named; null when none is."""
    work = df.select(doc, X.words(F.col(text)).alias("_words"))
    return work.select(
        doc,
        X.degree(F.col("_words"), highest=True).alias("highest"),
        X.degree(F.col("_words"), highest=False).alias("lowest"),
    )


def experience_from_jobs(df: DataFrame, as_of: Column, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc``, jobs, months, years): the time that the dated jobs of the experience section cover up to ``as_of``.

    Jobs at the same time count once. A text without dated jobs has none, and 0 of all. Spans are swept within their row: one map stage.
    """
    cut = with_sections(df.select(doc, text), text, known=True)
    spans = X.job_spans(X.section_lines(F.col("sections"), L.SECTIONS["experience"]), as_of)
    swept = cut.select(doc, F.coalesce(spans, F.array().cast("array<struct<start:int,end:int>>")).alias("_spans"))
    swept = swept.select(doc, F.size("_spans").cast("long").alias("jobs"), X.covered_months(F.col("_spans")).cast("long").alias("months"))
    return swept.withColumn("years", F.round(F.col("months") / 12, 1))


def _from_section(df: DataFrame, doc: str, text: str, part: str, out: str, rule) -> DataFrame:
    cut = with_sections(df.select(doc, text), text, known=True)
    return cut.select(doc, rule(X.section_lines(F.col("sections"), L.SECTIONS[part])).alias(out))


def extract_languages(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc``, languages) from the language section of a CV."""
    return _from_section(df, doc, text, "languages", "languages", X.language_pairs)


def extract_positions(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc``, positions): job titles without company or dates."""
    return _from_section(df, doc, text, "experience", "positions", X.dated_titles)


def extract_careers(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc``, careers): studies without place or dates."""
    return _from_section(df, doc, text, "education", "careers", X.dated_titles)


def split_requirements(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc``, must_items, nice_items, must_skills, nice_skills)."""
    cut = with_sections(df.select(doc, text), text, known=True)
    items = cut.select(
        doc,
        *[
            X.bullets(X.section_lines(F.col("sections"), L.SECTIONS[part])).alias(name)
            for part, name in (("mandatory", "must_items"), ("desirable", "nice_items"))
        ],
    )
    for kind in ("must", "nice"):
        items = items.withColumn(f"_{kind}", F.array_join(f"{kind}_items", " | "))
        items = with_words(items, f"_{kind}", L.TECHNICAL, kind)
    skills = [
        X.found_terms(F.col(f"{k}_hits"), F.col(f"{k}_spaced"), L.TECHNICAL).alias(f"{k}_skills")
        for k in ("must", "nice")
    ]
    return items.select(doc, "must_items", "nice_items", *skills)


def extract_job_title(df: DataFrame, doc: str = "doc_id", text: str = "text", given: str = "title") -> DataFrame:
    """(``doc``, job_title): a labelled line, else the given title."""
    return df.select(
        doc, T.title_fallback(X.labelled_title(F.col(text)), F.col(given)).alias("job_title")
    )


def summary(section: Column, sentences: int = 3, public: bool = False) -> Column:
    """Leading sentences of the section's prose; ``""`` where it has none.

    Lines outside the section are never taken: those above the first heading
    are where names and addresses stand. With ``public`` neither are lines inside that may be private.
    """
    return T.leading_sentences(F.array_join(F.coalesce(X.prose(section, public), F.array()), "\n"), sentences)


def summarize(df: DataFrame, doc: str = "doc_id", text: str = "text", sentences: int = 3, plain: bool = False) -> DataFrame:
    """(``doc``, summary) from the profile section of a CV, without lines that may tell who it is about.

    A text without a profile section has none; with ``plain`` texts without any heading, which are no CVs, are all prose.
    """
    cut = with_sections(df.select(doc, text), text, known=True)
    lines = X.section_lines(F.col("sections"), L.SECTIONS["profile"])
    if plain:
        bare = ~F.exists("sections", lambda s: s["section"].isNotNull())
        lines = F.when(bare, F.flatten(F.transform("sections", lambda s: s["lines"]))).otherwise(lines)
    return cut.withColumn("_lines", lines).select(doc, summary(F.col("_lines"), sentences, not plain).alias("summary"))
