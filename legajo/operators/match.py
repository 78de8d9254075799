"""The best CVs for each job description, by a score of 0 to 1,000.

A top-k set-similarity join. Rows that score alike are one class on either side. CV classes are an inverted index by skill; a
description looks its skills up from the rarest on, some at a time, and each pair is met at the first skill it shares. What is
still unseen can hold only skills not yet looked up, which bounds its score: a description whose k-th best is above that
bound is done, so that frequent skills, which say little, are mostly never looked up. Both sides of a frequent skill are
cut into blocks, so that no task meets all of it. Nothing is dropped: results are those of scoring all pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legajo.functions.contract import DEGREES
from legajo.session import scratch_path

#: What skills, years and degree add to a score, and what a required skill counts beside a desirable one.
SKILLS, YEARS, DEGREE = 700, 200, 100
REQUIRED, DESIRABLE = 2, 1
#: Shares of a description's weight that are still to be looked up after each round.
ROUNDS = (0.75, 0.5, 0.25, 0.0)


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _set(items: Column) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(F.coalesce(items, F.array().cast("array<string>")))))


def _tenths(years: Column) -> Column:
    """Years to one decimal, as a number without fractions; negative and missing ones are none."""
    return F.greatest(F.lit(0), F.coalesce(F.round(years * 10), F.lit(0))).cast("long")


def _rank(degree: Column) -> Column:
    return F.coalesce(F.array_position(F.array(*map(F.lit, DEGREES)), degree), F.lit(0)).cast("int")


def score(met: Column, weight: Column, has: Column, asked: Column, degree: Column, least: Column) -> Column:
    """Points for ``met`` of ``weight``, years ``has`` of ``asked`` in tenths, and a degree of rank ``least`` or more."""
    div = lambda a, b: F.call_function("div", a, F.greatest(b, F.lit(1).cast("long")))
    years = F.when(asked <= 0, F.lit(YEARS).cast("long")).otherwise(div(YEARS * F.least(has, asked), asked))
    return div(SKILLS * met.cast("long"), weight.cast("long")) + years + F.when(degree >= least, DEGREE).otherwise(0)


def cv_classes(cvs: DataFrame, k: int) -> DataFrame:
    """(cv_class, cv, skills, has, degree): the ``k`` smallest ids of each class, which is named by the smallest."""
    rows = cvs.select(
        F.col("cv"), _set(F.col("skills")).alias("skills"), _tenths(F.col("years")).alias("has"), _rank(F.col("degree")).alias("degree")
    ).filter("cv is not null and size(skills) > 0")
    alike = Window.partitionBy("skills", "has", "degree")
    rows = rows.distinct().withColumn("place", F.row_number().over(alike.orderBy("cv"))).filter(F.col("place") <= k)
    return rows.withColumn("cv_class", F.min("cv").over(alike))


def jd_classes(jds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(jd_class, must, nice, weight, asked, least), one row a class, and (jd_class, jd) of all descriptions with a skill."""
    must, nice = _set(F.col("must")), _set(F.col("nice"))
    rows = jds.select(
        "jd", must.alias("must"), F.array_except(nice, must).alias("nice"), _tenths(F.col("years")).alias("asked"), _rank(F.col("degree")).alias("least")
    ).filter("jd is not null and size(must) + size(nice) > 0").distinct()
    rows = _saved(rows, "jds")
    key = ["must", "nice", "asked", "least"]
    classes = rows.groupBy(*key).agg(F.min("jd").alias("jd_class"))
    classes = _saved(classes.withColumn("weight", REQUIRED * F.size("must") + DESIRABLE * F.size("nice")), "jd-classes")
    return classes, rows.join(classes.drop("weight"), key).select("jd_class", "jd")


def _ordered(classes: DataFrame, held: DataFrame) -> DataFrame:
    """``classes`` with ``terms``: (held, term, w, rest), the rarest first, ``rest`` the weight from a term on."""
    term = lambda c, w: F.transform(c, lambda t: F.struct(t.alias("term"), F.lit(w).alias("w")))
    terms = classes.select("jd_class", F.inline(F.concat(term("must", REQUIRED), term("nice", DESIRABLE))))
    # Skills that no CV has are looked up by nobody, but count.
    terms = terms.join(held, "term", "left").withColumn("held", F.coalesce("held", F.lit(0).cast("long")))
    terms = terms.groupBy("jd_class").agg(F.array_sort(F.collect_list(F.struct("held", "term", "w"))).alias("terms"))
    rest = lambda i: F.aggregate(F.slice("terms", i + 1, F.size("terms")), F.lit(0), lambda a, t: a + t["w"])
    terms = terms.withColumn("rest", F.transform(F.sequence(F.lit(0), F.size("terms") - 1), rest))
    both = F.zip_with("terms", "rest", lambda t, r: F.struct(t["held"].alias("held"), t["term"].alias("term"), t["w"].alias("w"), r.alias("rest")))
    return classes.join(terms.select("jd_class", both.alias("terms")), "jd_class")


def _met(probes: DataFrame, index: DataFrame, block: int) -> DataFrame:
    """Scored pairs that first share the skill looked up; both sides of a frequent skill in blocks of about ``block`` rows."""
    asked = probes.groupBy("term").agg(F.ceil(F.count("*") / block).cast("int").alias("jd_blocks"))
    blocks = lambda n: F.sequence(F.lit(0), n - 1)
    dealt = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
    cvs = index.join(asked, "term").withColumn("cv_block", dealt("cv_class", F.col("cv_blocks"))).drop("cv_blocks")
    cvs = cvs.withColumn("jd_block", F.explode(blocks(F.col("jd_blocks")))).drop("jd_blocks", "held")
    jds = probes.join(asked, "term").withColumn("jd_block", dealt("jd_class", F.col("jd_blocks"))).drop("jd_blocks")
    jds = jds.withColumn("cv_block", F.explode(blocks(F.ceil(F.col("held") / block).cast("int"))))
    pairs = jds.join(cvs, ["term", "cv_block", "jd_block"]).filter(~F.arrays_overlap("before", "skills"))
    pairs = pairs.withColumns({"must_met": F.size(F.array_intersect("must", "skills")), "nice_met": F.size(F.array_intersect("nice", "skills"))})
    met = REQUIRED * F.col("must_met") + DESIRABLE * F.col("nice_met")
    points = score(met, F.col("weight"), F.col("has"), F.col("asked"), F.col("degree"), F.col("least"))
    return pairs.select("jd_class", "cv_class", points.alias("score"), "must_met", "nice_met")


def _best(pairs: DataFrame, k: int, of: Sequence[str], key: str) -> DataFrame:
    """The ``k`` best rows of each ``of``, ties by the smaller ``key``; the limit also acts before rows are shuffled."""
    order = Window.partitionBy(*of).orderBy(F.desc("score"), key)
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_matches(cvs: DataFrame, jds: DataFrame, k: int = 5, block: int = 4096) -> DataFrame:
    """(jd, rank, cv, score, must_met, nice_met): the ``k`` best CVs of each description that share a skill with it.

    ``cvs`` has cv, skills, years and degree; ``jds`` has jd, must, nice, years and degree. Of 1,000 points the share of skills met gives
    ``SKILLS``, a required one counting twice, the share of the years asked for ``YEARS`` and the degree ``DEGREE``; what is not asked for is met.
    Ties go to the smaller id. A skill named twice, or as required and desirable, counts once, as required; null skills, rows
    without an id or a skill, and repeated rows give nothing more. Skills are compared as they are.
    """
    members = _saved(cv_classes(cvs, k), "cv-classes")
    index = members.filter("place = 1").select("cv_class", "skills", "has", "degree", F.explode("skills").alias("term"))
    held = _saved(index.groupBy("term").agg(F.count("*").alias("held")), "held")
    index = _saved(index.join(held, "term").withColumn("cv_blocks", F.ceil(F.col("held") / block).cast("int")), "index")
    classes, descriptions = jd_classes(jds)
    active = _saved(_ordered(classes, held), "active")
    best: DataFrame | None = None
    for before, after in zip((1.1, *ROUNDS), ROUNDS):
        # A term is looked up in the round in which the weight from it on is what is left.
        now = lambda t: (t["rest"] <= before * F.col("weight")) & (t["rest"] > after * F.col("weight"))  # noqa: B023, E731
        probes = active.select("*", F.posexplode("terms").alias("at", "now")).filter(now(F.col("now")) & (F.col("now.held") > 0))
        probes = probes.select(
            "jd_class", "must", "nice", "weight", "asked", "least", "now.term", "now.held",
            F.transform(F.slice("terms", 1, F.col("at")), lambda t: t["term"]).alias("before"),
        )
        pairs = _met(probes, index, block)
        best = _saved(_best(pairs if best is None else pairs.unionByName(best), k, ["jd_class"], "cv_class").drop("rank"), "best")
        last = best.groupBy("jd_class").agg(F.when(F.count("*") >= k, F.min("score")).alias("last"))
        rest = F.filter("terms", lambda t: t["rest"] <= after * F.col("weight"))  # noqa: B023
        unseen = F.call_function("div", SKILLS * F.get(rest, F.lit(0))["rest"].cast("long"), F.col("weight").cast("long")) + YEARS + DEGREE
        open_ = active.join(last, "jd_class", "left").filter((F.size(rest) > 0) & F.coalesce(F.col("last") <= unseen, F.lit(True)))
        active = _saved(open_.drop("last"), "active")
        if active.isEmpty():
            break
    rows = best.join(members.select("cv_class", "cv"), "cv_class").drop("cv_class")
    rows = _best(rows, k, ["jd_class"], "cv").join(descriptions, "jd_class")
    return rows.select("jd", "rank", "cv", "score", "must_met", "nice_met")
