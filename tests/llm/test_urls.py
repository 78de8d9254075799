"""The cascade against a set, rules against a loop."""

import random

from pyspark.sql import functions as F

from legajo.llm import urls

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")]


def test_membership_is_exact_over_the_universe(spark):
    rng = random.Random(2)
    keys = [(f"host{i}.example.org", rng.random() < 0.3) for i in range(20_000)] + [(None, True), ("", False)]
    df = spark.createDataFrame(keys, "key string, mark boolean").repartition(6)
    for words in (1 << 17, 300):
        filters = urls.cascade(df, "key", "mark", max_words=words)
        assert (filters.shards > 1) == (words == 300) and all(len(x) > 1 for x in filters.levels)
        wrong = df.filter("key is not null").filter(filters.listed(F.col("key")) != F.col("mark"))
        assert wrong.count() == 0


def by_hand(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for mark in "/?#":
        host = host.split(mark)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: len(r[0] + r[1]), default=None)
    bad = host == "bad.org"
    return host, path, best and best[0] + best[1], best[2] if best else ("block" if bad else "allow")


def test_verdicts(spark):
    cases = [
        "http://EXAMPLE.com/en/x", "http://www.example.com/en/", "http://a.www.example.com/en/y?z", "http://myexample.com/en/", "http://b.net/es/1#t",
        "http://b.net", "x://", "no scheme", None, "", "http://bad.org?q", "a://b://c/d", "http://É.com/Ä", "http://bad.org/\n/x", "http://bad.org",
    ]
    df = spark.createDataFrame([(c, "old") for c in cases], "url string, rule string")
    got = urls.judged(df, "url", RULES, F.col("host") == "bad.org").collect()
    assert sorted(map(repr, [(r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got])) == sorted(
        map(repr, [(c, *by_hand(c)) for c in cases])
    )
    assert urls.judged(df.filter("false"), "url", RULES, F.lit(True)).count() == 0
