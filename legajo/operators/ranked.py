"""Summaries of the sentences that say most, by word weights counted over the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legajo.functions import extract as X
from legajo.functions import lexicon as L
from legajo.functions import text as T
from legajo.operators.extract import _bucket, _constant, with_sections
from legajo.session import scratch_path


#: Bits of a code that hold its word's weight: 1000 ln of any number of rows is below 2 ** 16.
WEIGHT_BITS = 16


def _code(number: Column, weight: Column) -> Column:
    """A word as one number, its own and its weight side by side: sets of them are compared by hashes and carry their weights along."""
    return F.shiftleft(number, WEIGHT_BITS).bitwiseOR(weight)


def _total(codes: Column) -> Column:
    weight = lambda code: code.bitwiseAND(F.lit((1 << WEIGHT_BITS) - 1).cast("long"))
    return F.aggregate(codes, F.lit(0).cast("long"), lambda a, c: a + weight(c))


def _picked(sentences: Column, n: int) -> Column:
    """Numbers of the ``n`` sentences taken one after the other, in order; each time the one that adds most for its words.

    A sentence adds the weights of those of its words that no sentence taken before it has. Ties go to the earlier one.
    ``sentences`` holds (at, words, total), words by their codes, and should be a plain column.
    """

    def adds(s: Column, taken: Column) -> Column:
        gain = s["total"] - _total(F.array_intersect(s["words"], taken))
        gain = F.call_function("div", gain * 1000, F.size(s["words"]))
        return F.struct(gain.alias("gain"), (-s["at"]).alias("at"), s["words"].alias("words"))

    def step(picked: Column, _: Column) -> Column:
        left = F.filter(sentences, lambda s: ~F.exists(picked, lambda b: -b["at"] == s["at"]))
        # An array of one, whose element names the words taken, so that they are gathered once and not for each sentence.
        taken = F.array(F.flatten(F.transform(picked, lambda b: b["words"])))
        best = F.transform(taken, lambda words: F.array_max(F.transform(left, lambda s: adds(s, words))))
        # An array of none or one, so that a text with fewer sentences gives them all.
        return F.concat(picked, F.filter(best, lambda b: b.isNotNull()))

    none = F.array().cast("array<struct<gain:bigint,at:int,words:array<bigint>>>")
    return F.array_sort(F.aggregate(F.sequence(F.lit(1), F.lit(n)), none, step, lambda picked: F.transform(picked, lambda b: -b["at"])))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``name``, computed once per row however often it is read."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def _packed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir``, densely, and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _code_index(codes: DataFrame, buckets: int) -> Column:
    """All of (word, code) as one constant: ``buckets`` arrays of them, dealt by their word."""
    held = codes.groupBy(_bucket(F.col("word"), buckets).alias("id")).agg(F.collect_list(F.struct("word", "code")).alias("words"))
    none = F.array().cast(held.schema["words"].dataType)
    dense = codes.sparkSession.range(buckets).join(held, "id", "left").select("id", F.coalesce("words", none).alias("words"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("id").cast("int").alias("id"), "words")))
    return _constant(dense.agg(F.transform(ordered, lambda b: b["words"]).alias("index")))


def _by_sentence(held: Column) -> Column:
    """Codes by the number of their sentence, from (at, codes) in that order; sentences between them have none."""
    none = F.array().cast("array<bigint>")

    def upto(h: Column, i: Column) -> Column:
        before = F.coalesce(F.get(held, i - 1)["at"], F.lit(-1))
        return F.concat(F.array_repeat(none, h["at"] - before - 1), F.array(h["codes"]))

    return F.flatten(F.transform(held, upto))


def summarize_ranked(
    df: DataFrame, doc: str = "doc_id", text: str = "text", sentences: int = 2, plain: bool = False, common: int = 1 << 16
) -> DataFrame:
    """(``doc``, summary): the sentences of a CV's profile section that say most, in their order, without lines that may tell who it is about.

    Texts and ``plain`` are those of ``summarize``. A word weighs ``1000 ln(rows / rows that have it)``, counted over these sentences of all rows;
    a sentence without a word is none. Each row gives a row, also with a null or repeated ``doc``; without a sentence the summary is ``""``.

    The sentences to choose from are cut once and written. Rows that have a word are counted map-side. The ``common`` words of most rows go to the tasks
    as one constant and are weighed where the text lies; only other words leave their text, to meet their weights in a join whose words are all rare, and come
    back as numbers in one row per text. Every word has its weight and a number of its own, whatever ``common`` is; a corpus with no more words than that shuffles counts only.
    """
    cut = with_sections(df.select(doc, text), text, known=True)
    lines = X.section_lines(F.col("sections"), L.SECTIONS["profile"])
    if plain:
        bare = ~F.exists("sections", lambda s: s["section"].isNotNull())
        lines = F.when(bare, F.flatten(F.transform("sections", lambda s: s["lines"]))).otherwise(lines)
    cut = _once(_once(cut.select(F.col(doc).alias("_doc"), "sections"), "_lines", lines), "_prose", X.prose(F.col("_lines"), not plain))
    body = F.array_join(F.coalesce("_prose", F.array()), "\n")
    cut = _once(cut.select("_doc", body.alias("_body")), "_parts", T.sentences(F.col("_body")))
    texts = _packed(cut.select("_doc", F.monotonically_increasing_id().alias("_id"), "_parts"), "ranked-texts")
    total = texts.count()
    words = F.transform("_parts", lambda s: F.array_distinct(X.words(s)))
    # "outer", as the filter that Spark adds to other explodes would find the words once more.
    each = texts.select(F.explode_outer(F.array_distinct(F.flatten(words))).alias("word")).filter("word is not null")
    # As many parts as leave the number of a word room beside its weight.
    counted = each.groupBy("word").agg(F.count("*").alias("_rows")).coalesce(1 << 14)
    rows = _packed(counted.withColumn("_number", F.monotonically_increasing_id()), "ranked-words")
    weight = F.floor(1000 * F.log(F.lit(float(total)) / F.col("_rows"))).cast("long")
    codes = rows.select("word", "_rows", _code(F.col("_number"), weight).alias("code"))
    known = rows.count()
    top = codes if known <= common else codes.orderBy(F.desc("_rows"), "word").limit(common)
    buckets = 1 << max(4, min(known, common).bit_length())
    index = _code_index(top, buckets)
    # Null for a word that is not in the index.
    code_of = lambda w: F.get(F.filter(F.get(index, _bucket(w, buckets)), lambda e: e["word"] == w), F.lit(0))["code"]
    here = F.transform(words, lambda ws: F.array_compact(F.transform(ws, code_of)))
    if known <= common:
        cut = _once(texts, "_words", here)
    else:
        rare = F.transform(words, lambda ws: F.filter(ws, lambda w: code_of(w).isNull()))
        left = texts.select("_id", F.posexplode_outer(rare).alias("at", "rare")).select("_id", "at", F.explode_outer("rare").alias("word"))
        # A text's words are together in one task, whose two aggregates need no other shuffle.
        met = left.filter("word is not null").join(codes, "word").select("_id", "at", "code").repartition("_id")
        held = met.groupBy("_id", "at").agg(F.collect_list("code").alias("codes"))
        held = held.groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("at", "codes"))).alias("_held"))
        cut = _once(_once(texts.join(held, "_id", "left"), "_here", here), "_rare", _by_sentence(F.col("_held")))
        none = F.array().cast("array<bigint>")
        whole = F.transform("_here", lambda ws, at: F.concat(ws, F.coalesce(F.get("_rare", at), none)))
        cut = _once(cut.select("_doc", "_parts", "_here", "_rare"), "_words", whole)
    numbered = F.filter(F.transform("_words", lambda ws, at: F.struct(at.alias("at"), ws.alias("words"))), lambda s: F.size(s["words"]) > 0)
    summed = F.transform(numbered, lambda s: F.struct(s["at"], s["words"], _total(s["words"]).alias("total")))
    cut = _once(cut.select("_doc", "_parts", "_words"), "_sentences", summed)
    cut = _once(cut.select("_doc", "_parts", "_sentences"), "_picked", _picked(F.col("_sentences"), sentences))
    return cut.select(F.col("_doc").alias(doc), F.array_join(F.transform("_picked", lambda i: F.get("_parts", i)), " ").alias("summary"))
