"""Scores on held-out documents, and odd rows."""

from pyspark.sql import functions as F

from legajo.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy_and_labels_stay_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels)
    marked = docs.join(labels.select("doc_id", "toxic"), "doc_id")
    rows = toxicity.scored(marked, model).join(labels, "doc_id").filter("held_out").collect()
    toxic = [r["score"] for r in rows if r["toxic"]]
    clean = [r["score"] for r in rows if not r["toxic"]]
    assert sum(s >= 0.7 for s in toxic) > 0.85 * len(toxic) and sum(s >= 0.7 for s in clean) < 0.01 * len(clean)
    # Held-out labels, turned round, change no score.
    turned = labels.withColumn("toxic", F.when(toxicity.in_training(F.col("doc_id")), F.col("toxic")).otherwise(1 - F.col("toxic")))
    again = toxicity.fit(docs, turned)
    some = docs.filter("doc_id < 300")
    assert sorted(toxicity.scored(some, again).collect()) == sorted(toxicity.scored(some, model).collect())
    odd = [(None, "idiot"), (5, None), (5, None), (6, ""), (7, "w" * 100_000), (8, "@!$ 1d10t"), (9, "x " * 30_000)]
    got = toxicity.scored(spark.createDataFrame([(*r, "z") for r in odd], "doc_id long, text string, x string"), model).collect()
    assert len(got) == len(odd) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]


def test_without_labels_of_both_kinds(spark):
    docs = spark.createDataFrame([(i, f"texto {i}") for i in range(30)], "doc_id long, text string")
    for labels in ([], [(i, 0) for i in range(30)], [(1, None), (None, 1)]):
        df = spark.createDataFrame(labels, "doc_id long, toxic int")
        scores = {r["score"] for r in toxicity.scored(docs, toxicity.fit(docs, df)).collect()}
        assert scores == {0.0}


def test_words_behind_signs():
    assert toxicity.tokens("You 1d10t, st@r! b-a-d 2024") == [("you", False), ("idiot", True), ("star", True), ("bad", True)]
