"""Archives written, read and put together again."""

import base64
import hashlib
from collections import defaultdict

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from legajo.llm import warc


def test_round_trip(spark, tmp_path):
    rows = [(i, f"http://h/{i}\r\nX: y", ["a", "", "é\r\n\r\nz", None, "w" * 50_000][i % 5]) for i in range(40)] + [(None, None, "solo"), (None, None, "a"), (39, "u", "a")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, address string").repartition(4)
    folder = str(tmp_path / "warc")
    warc.archive(df, folder)
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[html or ""].append(i)
    last = {h: max((i for i in ids if i is not None), default=None) for h, ids in groups.items()}
    payloads = warc.read_payloads(spark, folder).collect()
    assert sorted(bytes(p["payload"]).decode() for p in payloads) == sorted(groups)
    for p in payloads:
        assert p["payload_digest"] == base64.b32encode(hashlib.sha1(bytes(p["payload"])).digest()).decode()
    heads = warc.read_headers(spark, folder).collect()
    assert len(heads) == len(rows)
    whole = {(r["id"], bytes(r["record"])) for r in warc.records(spark, folder, revisits_whole=True).collect()}
    for i, url, html in rows:
        body = (html or "").encode()
        response = last[html or ""]
        kind = "response" if i == response else "revisit"
        mine = [r for n, r in whole if n == i and r.endswith(b"\r\n\r\n" + body + b"\r\n\r\n")]
        assert any(f"WARC-Type: {kind}\r\n".encode() in r and r.count(b"\nX: y") == 0 for r in mine), (i, url)
    for r in heads:
        assert (r["refers_to"] is None) == (r["record_type"] == "response")


def test_a_changed_payload_is_found(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "a")], "page_id long, url string, html string")
    folder = str(tmp_path / "warc")
    warc.archive(df, folder)
    stored = spark.read.parquet(f"{folder}/payloads").withColumn("payload", F.lit(b"b"))
    other = str(tmp_path / "other")
    stored.write.parquet(f"{other}/payloads")
    with pytest.raises(PySparkException):
        warc.read_payloads(spark, other).collect()
    warc.archive(df.filter("false"), str(tmp_path / "none"))
    assert warc.records(spark, str(tmp_path / "none")).count() == 0
