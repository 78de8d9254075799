"""The life of requests about CVs: attempts, replies, records, quarantine."""

import json

from legajo.plans import replies

GOOD = json.dumps({
    "candidato_id": "x", "nivel_experiencia": "senior", "anos_experiencia": 6, "skills_tecnicos": [], "skills_blandos": [], "industrias": [],
    "cargos_anteriores": [], "nivel_educacion": "bachiller", "carreras": [], "idiomas": [], "resumen_perfil": "p",
})
ASKED = [(i, f"r{i}") for i in range(1, 10)] + [(9, "r9b")]
LOG = [
    (1, 1, None, None), (2, 1, "RateLimitError", "x"), (2, 2, "RateLimitError", "x"), (2, 3, "RateLimitError", "x"), (2, 4, None, None),
    (3, 1, "ValueError", "x"), (3, 2, None, None), (4, 1, "Timeout", "x"), (5, 1, "Timeout", "x"), (5, 2, None, None), (6, 1, None, None),
    (7, 1, None, None), (None, 1, None, None), (77, 1, None, None),
]
SENT = [
    (1, "r1", GOOD), (2, "r2", GOOD), (3, "r3", GOOD), (5, "r1", GOOD), (6, "r6", "{"), (7, "r7", None), (9, "r9", GOOD), (99, "r9", GOOD), (None, "r1", GOOD),
]


def tables(spark):
    asked = spark.createDataFrame(ASKED, "doc_id long, record_id string")
    log = spark.createDataFrame([(*r, "extra") for r in LOG], "doc_id long, n int, error_class string, message string, status string")
    sent = spark.createDataFrame(SENT, "doc_id long, rid string, body string")
    return asked, log, sent


def test_every_request_and_reply_once(spark):
    rows = replies.cv_records(*tables(spark), ["n"]).collect()
    got = sorted((str(r["doc_id"]), r["status"], r["attempts"], r["wait_s"], r["record"] is not None, ",".join(r["errors"])) for r in rows)
    assert got == [
        ("1", "matched", 1, 0, True, ""),
        ("2", "exhausted", 3, 6, False, "exhausted"),
        ("3", "fatal", 1, 0, False, "fatal"),
        ("4", "pending", 1, 2, False, "pending"),
        ("5", "id_mismatch", 2, 2, False, "id_mismatch"),
        ("6", "matched", 1, 0, False, "json"),
        ("7", "unanswered", 1, 0, False, "unanswered"),
        ("8", "unanswered", None, None, False, "unanswered"),
        ("9", "repeated", None, None, False, "repeated"),
        ("99", "unknown", None, None, False, "unknown"),
        ("None", "unknown", None, None, False, "unknown"),
    ]


def test_records_and_quarantine_are_written_once(spark, tmp_path):
    folder = str(tmp_path / "out")
    replies.write_cv_records(replies.cv_records(*tables(spark), ["n"]), folder)
    assert [r["candidato_id"] for r in spark.read.json(f"{folder}/records").collect()] == ["x"]
    kept = spark.read.json(f"{folder}/quarantine").collect()
    assert len(kept) == 10 and sum(r["body"] == GOOD for r in kept) == 6


def test_nothing_asked(spark):
    asked, log, sent = tables(spark)
    rows = replies.cv_records(asked.limit(0), log.limit(0), sent, ["n"]).collect()
    assert {r["status"] for r in rows} == {"unknown"} and len(rows) == 8
