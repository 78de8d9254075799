"""Toxicity scores: boosted trees over dense features, with isotonic calibration.

Features of a whole text are densities of a lexicon, its terms close to a second person, capitals, punctuation and obfuscated
words. The lexicon is part of the model: the word stems with the highest weight of evidence among the training documents. Trees are
fitted on one part of them and the isotonic step on the rest, so that a score of 0.7 is a chance of 0.7. Training takes a bounded
number of labelled documents; scoring is one pass over the texts, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legajo.llm.scratch import saved

FEATURES = [
    "strong_rate", "weak_rate", "strong_terms", "strong_distinct", "near_you", "you_rate", "weight_rate", "weight_max",
    "capital_rate", "mark_rate", "obfuscated_rate", "log_words",
]
#: Second persons of the corpus languages, and signs that stand for letters.
SECOND_PERSONS = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes vos".split())
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
STEMS = (5, 6, 7)
_token = re.compile(r"[^\W_](?:[\w@$!*'-]*[^\W_])?")


def tokens(text: str) -> list[tuple[str, bool]]:
    """Lower-case words with look-alike signs read as letters, and whether there were any inside."""
    out = []
    for word in _token.findall(text.lower()):
        if word.isalpha():
            out.append((word, False))
        elif any(c.isalpha() for c in word):
            plain = "".join(c for c in word.translate(LOOKALIKES) if c.isalpha())
            out.append((plain, True))
    return out


def terms(word: str) -> list[str]:
    """The word itself, marked as whole, and its stems."""
    return [word + ".", *[word[:n] for n in STEMS if len(word) > n]]


@dataclass
class Model:
    """A lexicon with weights, the trees and the calibration."""

    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    steps: IsotonicRegressionModel | None
    base: float


def in_training(doc: Column) -> Column:
    """False for the held-out third, by the id alone; rows without an id are no training rows."""
    return F.coalesce(F.pmod(F.crc32(doc.cast("string")), F.lit(3)) != 1, F.lit(False))


def learn_lexicon(labelled: DataFrame, least: int = 5, size: int = 400) -> dict[str, float]:
    """Up to ``size`` terms by the log of how much more often toxic documents hold them; each in ``least`` of them or more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for toxic, text in zip(df["toxic"], df["text"]):
                seen = {t for word, _ in tokens(text or "") for t in terms(word)}
                yield pd.DataFrame({"term": list(seen), "toxic": toxic})

    n = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return {}
    counts = labelled.mapInPandas(run, "term string, toxic int").groupBy("term")
    counts = counts.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")).filter(F.col("bad") >= least)
    weight = F.log((F.col("bad") + 0.5) / (n[1] + 1)) - F.log((F.col("good") + 0.5) / (n[0] + 1))
    # Seldom terms need more than chance: the weight counts by its distance from zero in standard errors too.
    sure = weight - 2 * F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    top = counts.select("term", weight.alias("weight"), sure.alias("sure")).filter("sure > 0.7").orderBy(F.desc("sure"), "term").limit(size)
    return {r["term"]: r["weight"] for r in top.collect()}


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    words = tokens(text)
    n = max(1, len(words))
    weights, strong, weak, near, hits = 0.0, 0, 0, 0, set()
    persons = [i for i, (w, _) in enumerate(words) if w in SECOND_PERSONS]
    close = {j for i in persons for j in range(i - 5, i + 6)}
    top = 0.0
    for i, (word, _) in enumerate(words):
        w = max((lexicon[t] for t in terms(word) if t in lexicon), default=0.0)
        if w:
            weights += w
            top = max(top, w)
            if w >= 3:
                strong += 1
                hits.add(word)
                near += i in close
            else:
                weak += 1
    letters = max(1, sum(map(len, (w for w, _ in words))))
    capitals = sum(map(str.isupper, text)) if not text.islower() else 0
    marks = text.count("!") + text.count("?")
    return [
        strong / n, weak / n, float(strong), float(len(hits)), near / n, len(persons) / n, weights / n, top,
        capitals / letters, marks / n, sum(o for _, o in words) / n, float(len(words)) ** 0.25,
    ]


def _featured(docs: DataFrame, lexicon: dict[str, float], *keep: str) -> DataFrame:
    """The columns ``keep`` and ``x``, the features of ``text``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            df["x"] = [features(t or "", lexicon) for t in df.pop("text")]
            yield df

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", x array<double>"
    return docs.select(*keep, "text").mapInPandas(run, schema)


def fit(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", max_rows: int = 20_000) -> Model:
    """Learn from the labelled training documents, ``max_rows`` of them at most, taken by the hash of their ids.

    ``labels`` has ``doc`` and ``toxic``; null labels and ids are left out, and a document labelled twice counts as toxic if one label says so.
    Without both kinds of labels every score is the share of toxic ones, or 0.
    """
    labels = labels.filter(in_training(F.col(doc))).select(F.col(doc).alias("id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    labels = labels.groupBy("id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, max_rows / max(1, labels.count()))
    labels = labels.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = docs.select(F.col(doc).alias("id"), F.col(text).alias("text")).join(labels, "id")
    rows = saved(rows, "labelled")
    # A text that occurs in both parts would make the calibration too sure.
    rows = rows.withColumn("calibrates", F.pmod(F.xxhash64("text"), F.lit(4)) == 0)
    base = rows.agg(F.avg("toxic")).first()[0] or 0.0
    train = rows.filter("not calibrates")
    lexicon = learn_lexicon(train)
    if not lexicon:
        return Model({}, None, None, base)
    x = saved(_featured(rows, lexicon, "id", "toxic", "calibrates"), "features").withColumn("features", array_to_vector("x"))
    trees = GBTClassifier(
        labelCol="toxic", maxIter=25, maxDepth=4, stepSize=0.15, subsamplingRate=0.8, minInstancesPerNode=5, seed=7
    ).fit(x.filter("not calibrates").repartition(4, "id"))
    scored = trees.transform(x.filter("calibrates")).select(vector_to_array("probability")[1].alias("raw"), F.col("toxic").cast("double").alias("label"))
    steps = None
    if scored.agg(F.countDistinct("label")).first()[0] == 2:
        steps = IsotonicRegression(featuresCol="raw", labelCol="label").fit(scored)
    return Model(lexicon, trees, steps, base)


def scored(docs: DataFrame, model: Model, doc: str = "doc_id", text: str = "text", cut: float = 0.7) -> DataFrame:
    """(doc, held_out, score, predicted), one row per row; a null text is scored as the empty one."""
    held_out = F.coalesce(F.pmod(F.crc32(F.col(doc).cast("string")), F.lit(3)) == 1, F.lit(False)).alias("held_out")
    rows = docs.select(F.col(doc).alias("id"), held_out, F.col(text).alias("text"))
    if model.trees is None:
        df = rows.withColumn("score", F.lit(float(model.base)))
    else:
        df = _featured(rows, model.lexicon, "id", "held_out").withColumn("features", array_to_vector("x"))
        raw = model.trees.transform(df).withColumn("raw", vector_to_array("probability")[1]).select("id", "held_out", "raw")
        df = raw.withColumn("score", F.col("raw"))
        if model.steps is not None:
            df = model.steps.transform(raw).withColumn("score", F.col("prediction"))
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score")))
    return df.select(F.col("id").alias(doc), "held_out", score.alias("score"), (score >= cut).cast("int").alias("predicted"))
