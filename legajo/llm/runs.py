"""Maximal repetitions of words: Lyndon arrays from a suffix sorter's grouping phase, extended by common prefixes.

A run is a stretch of words with a smallest period that no neighbouring word extends. By the runs theorem each run holds a Lyndon word
of its period's length that is the longest Lyndon word at its start, in the order of the alphabet or in the opposite one. So for
both orders the first phase of Baier's suffix sorter groups positions by their longest Lyndon words, whose lengths are the Lyndon
array; every such word is a possible root, and longest common extensions to both sides turn it into a run or rule it out.

Where runs of five words and four periods or more are wanted, only stretches of a text that can hold one go through this: within
such a run each three words recur a quarter of its length away or less, so that all others are left out exactly.
One row is one text, and rows are independent: a single map stage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def lyndon_array(ids: list[int]) -> np.ndarray:
    """The length of the longest Lyndon word at each position, a shorter word ranking before its extensions.

    Groups are intervals of ranks, named by their first rank, and hold positions whose words found so far are equal. They are taken from the
    highest down: the positions of a group are prefixed to the nearest earlier position of a lower group, which extends that one's word by one
    word of the group for each of them and moves it up, to a group of its own right above its old one.
    """
    n = len(ids)
    start_of, members, sizes, at = {}, {}, {}, 0
    by_id: dict[int, list[int]] = {}
    for i, w in enumerate(ids):
        by_id.setdefault(w, []).append(i)
    for w in sorted(by_id):
        start_of[w] = at
        members[at], sizes[at] = by_id[w], len(by_id[w])
        at += len(by_id[w])
    group = [start_of[w] for w in ids]
    length = [1] * n
    before = [-1] * n
    s = max(members, default=-1)
    # The next group down ends where this one starts.
    ends = {start + sizes[start]: start for start in members}
    while s >= 0:
        extended: list[tuple[int, int]] = []
        last, times = -1, 0
        own = 0
        for i in members.pop(s):
            if group[i] != s:
                continue
            own = i
            j = i - 1
            while j >= 0 and group[j] >= s:
                j = before[j]
            before[i] = j
            if j != last:
                if last >= 0:
                    extended.append((last, times))
                last, times = j, 0
            times += 1
        if last >= 0:
            extended.append((last, times))
        if extended:
            u = length[own]
            moved: dict[tuple[int, int], list[int]] = {}
            for j, k in extended:
                moved.setdefault((-k, group[j]), []).append(j)
            for (k, old), positions in sorted(moved.items()):
                # Taken off the end of the old interval; more repeats rank higher, so they come first.
                end = old + sizes[old]
                new = end - len(positions)
                sizes[old] -= len(positions)
                if new == old:
                    # The whole group moves in place.
                    members[old] = positions
                    sizes[old] = len(positions)
                else:
                    members[new], sizes[new] = positions, len(positions)
                    ends[end], ends[new] = new, old
                for j in positions:
                    group[j] = new
                    length[j] -= k * u
        s = ends.get(s, -1)
    return np.array(length, dtype=np.int64)


class Extensions:
    """Longest common extensions of many pairs of positions at once, by names of blocks of 1, 2, 4, … words."""

    def __init__(self, ids: np.ndarray) -> None:
        self.n = len(ids)
        name = np.unique(ids, return_inverse=True)[1].astype(np.int64)
        self.names = [name.astype(np.int32)]
        width = 1
        while 2 * width <= self.n:
            pair = name[: self.n - 2 * width + 1] * self.n + name[width : self.n - width + 1]
            name = np.unique(pair, return_inverse=True)[1].astype(np.int64)
            self.names.append(name.astype(np.int32))
            width *= 2

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from ``a`` and from ``b > a`` on."""
        a, b, got = a.copy(), b.copy(), np.zeros(len(a), dtype=np.int64)
        for k in reversed(range(len(self.names))):
            name, width = self.names[k], 1 << k
            fits = np.flatnonzero(b + width <= self.n)
            same = fits[name[a[fits]] == name[b[fits]]]
            for x in (a, b, got):
                x[same] += width
        return got

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words before ``a`` and before ``b > a``."""
        a, b, got = a.copy(), b.copy(), np.zeros(len(a), dtype=np.int64)
        for k in reversed(range(len(self.names))):
            name, width = self.names[k], 1 << k
            fits = np.flatnonzero(a >= width)
            same = fits[name[a[fits] - width] == name[b[fits] - width]]
            a[same] -= width
            b[same] -= width
            got[same] += width
        return got


def all_runs(ids: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """(start, length, period) of the runs of ``least`` words and ``times`` periods or more, by start, then period."""
    ids = np.asarray(ids, dtype=np.int64)
    n = len(ids)
    found = [np.empty((0, 3), dtype=np.int64)]
    common = None
    for order in (ids.tolist(), (-ids).tolist()):
        period = lyndon_array(order)
        # The first root of a run starts in the run's first period.
        root = np.flatnonzero(np.arange(n) + (times - 1) * period <= n)
        period = period[root]
        common = common or Extensions(ids)
        ahead = common.forward(root, root + period)
        behind = common.backward(root, root + period)
        length = behind + period + ahead
        good = (length >= least) & (length >= times * period)
        found.append(np.stack([root - behind, length, period], axis=1)[good])
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _stretches(ids: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """(start, end) of the stretches that each hold whole runs of ``least`` words and ``times`` periods, all of them together."""
    n = len(ids)
    if n < least:
        return []
    if least < 5 or times < 4:
        return [(0, n)]
    # Collisions of the mixed names only keep words that could have gone.
    key = (ids[:-2] * np.int64(0x9E3779B97F4A7C15 - (1 << 64)) + ids[1:-1]) * np.int64(0xC2B2AE3D27D4EB4F - (1 << 64)) + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    gaps = np.where(same, np.diff(order), n)
    nearest = np.full(len(key), n, dtype=np.int64)
    nearest[order[1:]] = gaps
    nearest[order[:-1]] = np.minimum(nearest[order[:-1]], gaps)
    todo, done = [(0, len(key))], []
    while todo:
        a, b = todo.pop()
        # The stretch of b - a windows has b - a + 2 words.
        near = nearest[a:b] * times <= b - a + 2
        if near.all():
            done.append((a, b + 2))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], near, [False]])))
        todo += [(a + x, a + y) for x, y in zip(edges[::2].tolist(), edges[1::2].tolist()) if y - x + 2 >= least]
    return sorted(done)


def word_runs(words: list[bytes], least: int = 6, times: int = 4) -> np.ndarray:
    """``all_runs`` of a list of words, looking only where there can be one."""
    n = len(words)
    seen: dict[bytes, int] = {}
    ids = np.fromiter(map(seen.setdefault, words, count()), np.int64, n)
    if len(seen) == n or n < least:
        return np.empty((0, 3), dtype=np.int64)
    out = [np.empty((0, 3), dtype=np.int64)]
    for a, b in _stretches(ids, least, times):
        out.append(all_runs(ids[a:b], least, times) + [a, 0, 0])
    runs = np.concatenate(out)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether each of ``n`` words stays when every run is cut down to its first period."""
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(cover[:n]) == 0


def periodic_runs(docs: DataFrame, doc: str = "doc_id", text: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """(doc, n_words, runs, collapsed): the runs of each row's whole text, and the text without repeats, words joined by one blank.

    ``runs`` are structs of start, length and period, by start, then period. Words are parted by ASCII white space. Null and
    empty texts have no words, no runs and an empty collapsed text; repeated rows stay apart, other columns are not read.
    """
    if times < 2:
        raise ValueError("a run has two periods or more")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            rows = []
            for value in df["text"]:
                words = (value or "").encode().split()
                runs = word_runs(words, least, times)
                keep = words if not len(runs) else [w for w, k in zip(words, kept_words(len(words), runs).tolist()) if k]
                found = [{"start": s, "length": n, "period": p} for s, n, p in runs.tolist()]
                rows.append((len(words), found, b" ".join(keep).decode()))
            df = df[["id"]].copy()
            df["n_words"], df["runs"], df["collapsed"] = zip(*rows) if rows else ([], [], [])
            yield df

    kind = docs.schema[doc].dataType.simpleString()
    schema = f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select(F.col(doc).alias("id"), F.col(text).alias("text")).mapInPandas(run, schema).withColumnRenamed("id", doc)


def digests(found: DataFrame) -> DataFrame:
    """``periodic_runs`` as numbers and hashes; the run with most periods stands for all, of equal ones the first."""
    zero = F.lit(0).cast("long")
    first = F.struct(zero.alias("start"), zero.alias("length"), F.lit(1).cast("long").alias("period"))
    # Runs come by start, then period; fractions are compared by products.
    more = lambda a, x: F.when(x["length"] * a["period"] > a["length"] * x["period"], x).otherwise(a)
    best = F.when(F.size("runs") > 0, F.aggregate("runs", first, more)).alias("best")
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    df = found.select("*", best, lines.alias("lines"))
    return df.select(
        *[c for c in found.columns if c not in ("runs", "collapsed", "n_words")],
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.call_function("div", 1000 * F.col("best.length"), F.col("best.period")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
