"""Quality rules whose cutoffs keep false rejection below a proven limit.

Two layers. The base rules are fixed: at least 20 words, and at most 30 % of the words in
8-word windows that occur twice or more in the text. The method then sets one cutoff per
stratum from labelled documents. All rules are shares, so they share one path of cutoffs from lenient to
strict: at a cutoff a document is rejected if any of its shares reaches it. A cutoff is valid if an exact binomial test shows, at the
stratum's level, that it rejects at most ``limit`` of the good documents there, by all rules together.
Stricter cutoffs reject supersets, so this is a fixed-sequence test and needs no correction among them. Strata share the error
``delta`` in proportion to their good labels, and a stratum whose whole path is valid passes its part on to the others
(weighted step-down after Holm). Of the valid cutoffs the one that
rejects most bad documents is taken, a good one counting ten times, so that a stratum whose rules do not tell bad from
good, or with too few labels to prove anything, gets no cutoff and rejects nothing.

Everything is built from DataFrame functions. A text is measured where it is read; only labelled rows'
numbers are shuffled, and all labels count: they fold map-side into a histogram per stratum. Cutoffs are broadcast:
a stratum has one only with ``ln(1/level) / limit`` labelled good documents or more (some 150 at the default limits), so
that there are that many times fewer of them than labels.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legajo.llm.scratch import saved

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Name and value of each rule; a document is rejected if any value is that of the cutoff or more.
RULES = {
    "symbols": lambda: F.try_divide("n_symbols", "n_words"),
    "repeats": lambda: F.try_divide("n_repeat_words", "n_words"),
    "lines": lambda: F.try_divide("n_dup_lines", "n_lines"),
    "capitals": lambda: F.try_divide("n_capitals", "word_chars"),
    "marks": lambda: F.try_divide("n_marks", "n_words"),
}
#: Cutoffs are tried at multiples of 1 / STEPS up to 1.
STEPS = 50


def _covered(pairs: Column) -> Column:
    """Words covered by 8-word windows that have a twin; ``pairs`` are all (hash, start), sorted."""

    def twin(pair: Column, j: Column) -> Column:
        before = (j > 0) & (F.get(pairs, j - 1)["h"] == pair["h"])
        after = F.get(pairs, j + 1)["h"] == pair["h"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    starts = F.array_sort(F.transform(F.filter(pairs, twin), lambda p: p["i"]))
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-8).alias("at")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(8), i - a["at"])).alias("n"), i.alias("at")),
        lambda a: a["n"],
    )


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with MEASURES, counts of capitals, of ``!`` and ``?`` and of lines with a word, and ``base_failed``, of whole texts.

    A null text has no words. Windows are compared by 64-bit hashes of their words, within one text only.
    Existing columns of the same names are replaced.
    """
    out = [*MEASURES, "n_capitals", "n_marks", "n_lines"]
    kept = [c for c in docs.columns if c not in [*out, "base_failed"]]
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.size("__hashed")
    hashed = F.transform(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))
    # An array that a lambda reads goes through an explode of one row: a plain column would be merged into
    # the lambda and computed anew for every word.
    df = docs.select("*", F.explode_outer(F.array(hashed)).alias("__hashed"))
    df = df.withColumn("__lines", F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)))
    # Hashes of 8 words from hashes of 4, of 2 and of 1.
    df = df.withColumn("__windows", F.when(n >= 8, F.col("__hashed")).otherwise(F.array().cast("array<bigint>")))
    for width in (1, 2, 4):
        m = F.greatest(F.size("__windows") - width, F.lit(0))
        both = F.zip_with(F.slice("__windows", 1, m), F.slice("__windows", 1 + width, m), lambda x, y: F.xxhash64(x, y))
        df = df.withColumn("__windows", both)
    # Most texts repeat nothing: only the others pay for sorting.
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    pairs = F.array_sort(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("__pairs", F.when(repeats, pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    numbers = {
        "n_words": n,
        "word_chars": F.length(F.regexp_replace(t, GAP, "")),
        "n_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")),
        "n_capitals": F.length(F.regexp_replace(t, r"\P{Lu}+", "")),
        "n_marks": F.length(F.regexp_replace(t, r"[^!?]+", "")),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": _covered(F.col("__pairs")),
        "n_lines": F.size("__lines"),
    }
    # The explode also keeps filters on the numbers from computing them once more.
    row = F.struct(*[v.cast("long").alias(k) for k, v in numbers.items()])
    df = df.select(*kept, F.explode_outer(F.array(row)).alias("__row")).select(*kept, *[F.col("__row")[c].alias(c) for c in out])
    return df.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def _log_tail(k: Column, n: Column, rate: float) -> Column:
    """Log of the chance of ``k`` or fewer of ``n`` at ``rate``, summed exactly term by term."""
    first = n * F.log1p(F.lit(-rate))
    odds = F.log(F.lit(rate / (1 - rate)))

    def step(a: Column, j: Column) -> Column:
        term = a["t"] + F.log(n - j + 1) - F.log(j) + odds
        total = F.greatest(a["s"], term) + F.log1p(F.exp(-F.abs(a["s"] - term)))
        return F.struct(term.alias("t"), total.alias("s"))

    start = F.struct(first.alias("t"), first.alias("s"))
    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(terms, start, step, lambda a: a["s"])


def _worst() -> Column:
    """A document's place on the path, 0 to STEPS: the largest share of all rules."""
    shares = [F.coalesce(value(), F.lit(0.0)) for value in RULES.values()]
    return F.least(F.lit(STEPS), F.floor(F.greatest(*shares) * STEPS)).cast("int")


def cutoffs(
    numbers: DataFrame,
    labels: DataFrame,
    doc: str = "doc_id",
    stratum: str = "lang",
    limit: float = 0.02,
    delta: float = 0.05,
) -> DataFrame:
    """(stratum, cut, good, rejected): the chosen cutoffs, with the labelled good documents and those of them that it rejects.

    ``numbers`` has ``doc``, ``stratum`` and the measures; ``labels`` has ``doc`` and ``quality`` (1 good, 0 bad).
    Documents that the base rules reject are not counted: the limit is on what the cutoffs add. A document labelled
    twice counts by its lowest label; null labels and null ids are left out; a null stratum is the stratum ``""``.
    """
    labels = labels.select(F.col(doc).alias("__doc"), F.col("quality").alias("__good")).dropna()
    labels = labels.groupBy("__doc").agg(F.min("__good").alias("__good"))
    df = numbers.filter("not base_failed").join(labels, numbers[doc] == F.col("__doc"))
    df = df.select(F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), "__good", _worst().alias("step"))
    good, bad = F.sum(F.when(F.col("__good") >= 1, 1).otherwise(0)), F.sum(F.when(F.col("__good") < 1, 1).otherwise(0))
    counts = df.groupBy("stratum", "step").agg(good.alias("good"), bad.alias("bad"))
    # From here on there are at most STEPS + 1 rows for each stratum.
    hist = counts.groupBy("stratum").agg(F.sum("good").alias("n"), F.array_sort(F.collect_list(F.struct("step", "good", "bad"))).alias("hist"))

    def above(name: str) -> Column:
        rest = lambda c: F.filter("hist", lambda x: x["step"] >= c)
        return lambda c: F.aggregate(rest(c), F.lit(0).cast("long"), lambda a, x: a + x[name])

    tried = F.transform(
        F.sequence(F.lit(1), F.lit(STEPS)), lambda c: F.struct(c.alias("c"), above("good")(c).alias("k"), above("bad")(c).alias("bad"))
    )
    tried = hist.filter("n > 0").select("stratum", "n", F.inline(tried))
    chance = F.when(F.col("k") <= limit * F.col("n"), _log_tail(F.col("k"), F.col("n"), limit)).otherwise(F.lit(0.0))
    tried = saved(tried.withColumn("chance", chance), "tried")
    # Step-down: strata whose strictest cutoff is valid, one after the other, each with what those before it left.
    ends = tried.filter("c = 1").select(F.struct((F.col("chance") - F.log("n")).alias("at"), "stratum", "n", "chance").alias("end"))
    ends = ends.agg(F.array_sort(F.collect_list("end")).alias("ends"), F.sum("end.n").alias("all"))
    level = lambda n, left: F.lit(log(delta)) + F.log(n) - F.log(left)

    def passed(a: Column, x: Column) -> Column:
        valid = a["going"] & (x["chance"] <= level(x["n"], a["left"]))
        return F.struct(F.when(valid, a["left"] - x["n"]).otherwise(a["left"]).alias("left"), valid.alias("going"))

    left = F.aggregate("ends", F.struct(F.col("all").alias("left"), F.lit(True).alias("going")), passed, lambda a: a["left"])
    # The strata that are wholly valid are so at the level they had; what is left is that of the others.
    left = ends.select(left.alias("left")).scalar()
    valid = tried.filter(F.col("chance") <= level(F.col("n"), F.greatest(left, F.col("n"))))
    gain = F.col("bad") - 10 * F.col("k")
    best = valid.filter(gain > 0).groupBy("stratum").agg(F.max(F.struct(gain.alias("gain"), "c", "n", "k")).alias("best"))
    return best.select("stratum", (F.col("best.c") / STEPS).alias("cut"), F.col("best.n").alias("good"), F.col("best.k").alias("rejected"))


def judged(numbers: DataFrame, cuts: DataFrame, stratum: str = "lang") -> DataFrame:
    """``numbers`` (and whatever else it has) with ``kept``: passed by the base rules and by the cutoff of its stratum."""
    cuts = cuts.select(F.col("stratum").alias("__stratum"), F.col("cut").alias("__cut"))
    key = F.coalesce(F.col(stratum).cast("string"), F.lit(""))
    df = numbers.join(F.broadcast(cuts), key == F.col("__stratum"), "left")
    over = F.coalesce(_worst() >= F.round(F.col("__cut") * STEPS), F.lit(False))
    return df.withColumn("kept", ~F.col("base_failed") & ~over).drop("__stratum", "__cut")
