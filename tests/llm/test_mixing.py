"""Slots against a schedule made step by step."""

import random
from collections import Counter
from fractions import Fraction
from math import ceil, floor

from pyspark.sql import functions as F

from legajo.llm import mixing


def by_hand(parts):
    total, nth, out = sum(parts.values()), Counter(), []
    for t in range(total):
        ready = [s for s in parts if floor(Fraction(nth[s] * total, parts[s])) <= t]
        pick = min(ready, key=lambda s: (ceil(Fraction((nth[s] + 1) * total, parts[s])), s))
        out.append((t, pick, nth[pick]))
        nth[pick] += 1
    return out


def test_period(spark):
    parts = {"a": 50, "b": 1, "c": 1, "": 17, "d": 31}
    targets = spark.createDataFrame([*parts.items(), ("none", 0)], "source string, parts int")
    rows = sorted((r["slot"], r["source"], r["nth"]) for r in mixing.period(targets).collect())
    assert rows == by_hand(parts)
    done = Counter()
    for slot, source, _ in rows:
        done[source] += 1
        assert all(abs(done[s] - Fraction((slot + 1) * w, 100)) < 1 for s, w in parts.items())


def test_rows_are_kept_and_mixed(spark, monkeypatch):
    rows = [(i, "big" if i % 3 else ("b", "c", None)[i // 3 % 3], "x") for i in range(6_000)] + [(None, "big", "x")] * 40 + [(1, "odd", "y")]
    df = spark.createDataFrame(rows, "doc_id long, source string, parts string").repartition(5)
    targets = spark.createDataFrame([("big", 3), ("b", 2), ("c", 2), ("", 1)], "source string, parts int")
    # A source in many bins, each with blocks that it shares with the next.
    monkeypatch.setattr(mixing, "BIN_ROWS", 100)
    got = mixing.scheduled(df, targets, block=7).collect()
    assert Counter((r["doc_id"], r["source"], r["parts"]) for r in got) == Counter(rows)
    placed = [r for r in got if r["position"] is not None]
    assert {r["source"] for r in got if r["position"] is None} == {"odd"}
    assert len({r["position"] for r in placed}) == len(placed)
    blocks = {(r["slot"], r["source"], r["block_no"]) for r in placed}
    assert len({s for s, _, _ in blocks}) == len(blocks)
    # Until a source runs dry every slot is used and shares are kept.
    done, last = Counter(), Counter(s for _, s, _ in blocks)
    for t, (slot, source, _) in enumerate(sorted(blocks, key=lambda b: b[0])):
        done[source] += 1
        assert slot == t and abs(done["big"] - Fraction((t + 1) * 3, 8)) < 1
        if done[source] == last[source]:
            break
    mixed = mixing.mixed(df, targets, block=7)
    assert mixed.columns == df.columns
    order = {(r["doc_id"]): r["position"] for r in placed if r["doc_id"] is not None and r["source"] != "odd"}
    seen = [order[r["doc_id"]] for r in mixed.collect() if r["doc_id"] is not None and r["source"] != "odd"]
    assert seen == sorted(seen)


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, source string")
    assert mixing.mixed(df, mixing.tempered_parts(df)).count() == 0


def lags(spark, parts, horizon):
    """The largest lag in blocks over ``horizon`` slots, all of which must be used once."""
    targets = spark.createDataFrame(list(parts.items()), "source string, parts long")
    total = sum(parts.values())
    blocks = [(s, b) for s, w in parts.items() for b in range(horizon * w // total + 8)]
    rows = spark.createDataFrame(blocks, "source string, block_no long").join(mixing.splits(targets).withColumnRenamed("steps", "__steps"), "source")
    got = rows.select("source", "block_no", mixing._slot(total).alias("slot")).collect()
    assert len(got) == len(blocks)
    slots = sorted((r["slot"], r["source"], r["block_no"]) for r in got)
    assert [s for s, _, _ in slots[:horizon]] == list(range(horizon)) and len({s for s, _, _ in slots}) == len(slots)
    done, most = Counter(), 0
    for slot, source, nth in slots[:horizon]:
        assert nth == done[source]
        # Just before and just after the block.
        most = max(most, slot * parts[source] / total - nth, nth + 1 - (slot + 1) * parts[source] / total)
        done[source] += 1
    return most


def test_halves_keep_any_parts(spark, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(mixing, "GROUP_SOURCES", 20)
    parts = {f"s{i}": rng.choice([1, 2, 3, 5]) for i in range(300)} | {"big": 9_000, "": 4_000, "mid": 700, "odd": 77}
    assert lags(spark, parts, 20_000) < 6
    huge = {s: w * 10**12 + 1 for s, w in parts.items()}
    assert lags(spark, huge, 3_000) < 6
    assert lags(spark, {"only": 5}, 50) == 0


def lag_of_deadlines(spark, sizes):
    """The largest lag in blocks over one period, for sources of so many rows."""
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, n long")
    # As tempered_parts counts them, without making the rows.
    rows = df.select("source", F.pow("n", F.lit(0.7)).alias("size"))
    total, least = rows.agg(F.sum("size"), F.min("size")).first()
    scale = min(max(1000 / total, mixing.LEAST_PARTS / least), mixing.MOST_PARTS / total)
    parts = {r["source"]: max(1, round(r["size"] * scale)) for r in rows.collect()}
    targets = spark.createDataFrame(list(parts.items()), "source string, parts long")
    h, done, most = sum(parts.values()), Counter(), 0
    slots = sorted((r["slot"], r["source"], r["nth"]) for r in mixing.period(targets).collect())
    assert [t for t, _, _ in slots] == list(range(h))
    for slot, source, nth in slots:
        assert nth == done[source]
        most = max(most, slot * parts[source] / h - nth, nth + 1 - (slot + 1) * parts[source] / h)
        done[source] += 1
    assert done == parts
    return h, most


def test_one_promise_at_every_size(spark):
    parts, lag = lag_of_deadlines(spark, {f"s{i}": int(10 ** (1 + 4 * i / 29)) for i in range(30)})
    assert parts > 15_000 and lag < 1
    parts, lag = lag_of_deadlines(spark, {f"s{i}": 1 + i % 7 for i in range(2_500)})
    assert parts > 20_000 and lag < 1


def test_many_blocks_ready_are_taken_in_order(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 4)
    monkeypatch.setattr(mixing, "AHEAD", 3)
    rng = random.Random(8)
    parts = {f"s{i:03}": rng.choice([1, 1, 2, 3, 40]) for i in range(60)}
    targets = spark.createDataFrame(list(parts.items()), "source string, parts int")
    assert sorted((r["slot"], r["source"], r["nth"]) for r in mixing.period(targets).collect()) == by_hand(parts)


def test_many_sources(spark):
    rows = [(i, f"s{i % 1_900}") for i in range(3_800)] + [(-1 - i, "big") for i in range(6_000)] + [(None, None), (None, None), (7, "none")]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    targets = mixing.tempered_parts(df.filter("source is null or source <> 'none'"))
    shares = {r["source"]: r["parts"] for r in targets.collect()}
    assert sum(shares.values()) > 15_000 and abs(shares["big"] / shares["s1"] - 3_000**0.7) < 0.07 * 3_000**0.7
    for by in ("deadlines", "halves"):
        got = mixing.scheduled(df, targets, block=2, by=by).collect()
        assert Counter((r["doc_id"], r["source"]) for r in got) == Counter(rows)
        assert [r["source"] for r in got if r["position"] is None] == ["none"]
        assert len({r["position"] for r in got if r["position"] is not None}) == len(rows) - 1


def test_rounding_is_stated(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_PARTS", 100)
    df = spark.createDataFrame([("a",)] * 5_000 + [("b",)] + [("c",)] * 40, "source string")
    got = {r["source"]: (r["parts"], r["share"]) for r in mixing.tempered_parts(df, power=1.0).collect()}
    assert got == {"a": (99, 5_000 / 5_041), "b": (1, 1 / 5_041), "c": (1, 40 / 5_041)}
    got = mixing.tempered_parts(df, power=0.0, weight=F.length("source") + (F.col("source") == "a").cast("int"), parts=8).collect()
    assert {r["source"]: r["parts"] for r in got} == {"a": 16, "b": 8, "c": 8}


def test_small_targets_keep_their_proportions(spark):
    df = spark.createDataFrame([(f"s{i}",) for i in range(3_000) for _ in range(1 + i % 3)], "source string")
    parts = {r["source"]: r["parts"] for r in mixing.tempered_parts(df).collect()}
    for a, n in (("s1", 2), ("s2", 3)):
        assert abs(parts[a] / parts["s0"] / n**0.7 - 1) < 1 / 16
