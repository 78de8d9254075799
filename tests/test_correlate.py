"""Correlation against dictionaries, with hot, unknown and null keys."""

import random
from collections import Counter

from legajo.operators.correlate import correlate_responses


def test_statuses_with_a_hot_document(spark, tmp_path):
    rng = random.Random(5)
    asked = [(d, f"id-{d}") for d in range(300)]
    replies = [(rng.randint(-20, 320), rng.choice(["ok", None, "otro"])) for _ in range(600)]
    replies += [(7, "ok")] * 500 + [(None, "ok")] * 300 + [(-5, "ok")] * 200
    replies = [(d, f"id-{d}" if e == "ok" else e) for d, e in replies]
    # Replies are read from a table, as they would be.
    path = str(tmp_path / "replies")
    spark.createDataFrame(replies, "doc_id long, rid string").repartition(6).write.parquet(path)
    requests = spark.createDataFrame(asked, "doc_id long, record_id string")
    out = correlate_responses(requests, spark.read.parquet(path)).collect()
    want, ids = Counter(), dict(asked)
    for d, e in replies:
        status = "unknown" if d not in ids else "matched" if e == ids[d] else "id_mismatch"
        want[(d, e, ids.get(d), status)] += 1
    for d in set(ids) - {d for d, _ in replies}:
        want[(d, None, ids[d], "unanswered")] += 1
    assert Counter((r["doc_id"], r["rid"], r["record_id"], r["status"]) for r in out) == want


def test_repeated_requests_are_reported_once_per_reply(spark):
    requests = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "doc_id long, record_id string")
    replies = spark.createDataFrame([(1, "a"), (2, "c")], "doc_id long, rid string")
    out = correlate_responses(requests, replies).collect()
    assert sorted((r["doc_id"], r["status"]) for r in out) == [(1, "repeated"), (2, "matched")]
