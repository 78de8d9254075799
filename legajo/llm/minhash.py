"""Near-duplicate documents: banded MinHash, sequential Bayesian pruning, exact confirmation.

1. Sets: each text becomes its distinct shingles, as 64-bit hashes, a signature of HASHES minima and a digest
   of the whole set. Texts with equal sets are one class, represented by its smallest id.
2. Candidates: classes that agree on all minima of a band share a bucket. Bands are as long as they may be for
   a link at the threshold to be missed by all of them with a chance below MISSED (six minima at 0.85, five at 0.8).
3. First pass: every class of a bucket is compared with the bucket's smallest id only, so a bucket of n gives n - 1 pairs.
4. Second pass: buckets whose classes are not yet one component are cut into blocks, and each pair of blocks is one task
   entry that compares what is still apart. It returns a spanning forest of the links found, never all pairs.
5. Comparing: batches of the signatures are read one after the other; a pair is dropped as soon as the posterior chance of
   a similarity at the threshold or above, given the minima that agree so far, is below ``miss``. What is left is confirmed on the full
   sets.

Ids and signatures are shuffled; texts move only for pairs and buckets that are left after pruning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import exp, lgamma, log

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legajo.llm.graph import components
from legajo.llm.scratch import saved

HASHES, BATCH, MISSED = 180, 30, 1e-6
_rng = np.random.default_rng(20)
FACTORS = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SUMMANDS = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
POSITIONS = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Words(dict):
    """Hashes of words seen, emptied when there are a million."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15 | 1)
    return x ^ (x >> np.uint64(29))


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; of the whole sequence where it is shorter."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = min(width, len(h))
    total = np.full(len(h) - n + 1, np.uint64(n))
    for k in range(n):
        total = _mix(total + h[k : len(h) - n + 1 + k] * POSITIONS[k])
    return np.unique(total)


def signature(hashes: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, np.uint64(2**64 - 1))
    for k in range(0, len(hashes), 2048):
        block = hashes[k : k + 2048, None] * FACTORS
        block += SUMMANDS
        np.minimum(low, block.min(0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def jaccard_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = min(len(a), len(b)), max(len(a), len(b))
    if 100 * small < percent * large:
        return False
    both = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * both >= percent * (len(a) + len(b) - both)


@lru_cache(maxsize=8)
def least_matches(percent: int, miss: float) -> tuple[int, ...]:
    """For 1, 2, ... batches: fewest agreeing minima at which the posterior of a link is ``miss`` or more.

    The prior of the similarity is uniform, so after m of n agree it is Beta(m + 1, n - m + 1), and its tail beyond s
    is the chance of m or fewer heads among n + 1 tosses at s.
    """
    s, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, 0
        while m <= n:
            tail += exp(lgamma(n + 2) - lgamma(m + 1) - lgamma(n - m + 2) + m * log(s) + (n + 1 - m) * log(1 - s))
            if tail >= miss:
                break
            m += 1
        out.append(m)
    return tuple(out)


def survivors(a: np.ndarray, b: np.ndarray, percent: int, miss: float) -> np.ndarray:
    """Which rows of two equally long arrays of signatures may still be links."""
    left, agree = np.arange(len(a)), np.zeros(len(a), np.int32)
    for k, least in enumerate(least_matches(percent, miss)):
        part = slice(k * BATCH, (k + 1) * BATCH)
        agree = agree + (a[left, part] == b[left, part]).sum(1)
        keep = agree >= least
        left, agree = left[keep], agree[keep]
    return left


def rows_of(percent: int) -> int:
    """Minima to a band."""
    fits = [r for r in (6, 5, 4, 3, 2) if (1 - (percent / 100) ** r) ** (HASHES // r) < MISSED]
    return max(fits, default=1)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """doc, n_shingles, digest and signature of each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            n, digest, sig = [], [], []
            for text in df["text"]:
                s = shingles(text or "", width)
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pd.DataFrame({"doc": df["doc"], "n_shingles": n, "digest": digest, "sig": sig})

    return docs.mapInPandas(run, "doc long, n_shingles long, digest binary, sig binary")


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            last, of_b = None, None
            keep = []
            for b, x, y in zip(df["b"], df["text_a"], df["text_b"]):
                if b != last:
                    last, of_b = b, shingles(y or "", width)
                keep.append(jaccard_at_least(shingles(x or "", width), of_b, percent))
            yield df.loc[keep, ["a", "b"]]

    both = pairs.join(texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInPandas(run, "a long, b long")


def _forest(df: pd.DataFrame, width: int, percent: int, miss: float) -> pd.DataFrame:
    """Links of one pair of blocks that join components which are apart."""
    df = df.sort_values("doc", ignore_index=True)
    sig = np.frombuffer(b"".join(df["sig"]), np.uint32).reshape(len(df), HASHES)
    comp, size = df["comp"].to_numpy(), df["n_shingles"].to_numpy()
    mine, within = df["mine"].to_numpy(), df["within"].to_numpy()
    root = {c: c for c in comp.tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    found, sets = [], {}
    for i in range(len(df) - 1):
        # Both in one block, or one in each, by the blocks' numbers of this entry.
        j = np.arange(i + 1, len(df))
        j = j[(comp[j] != comp[i]) & ((mine[j] != mine[i]) | within[j])]
        j = j[100 * np.minimum(size[j], size[i]) >= percent * np.maximum(size[j], size[i])]
        j = j[survivors(np.broadcast_to(sig[i], (len(j), HASHES)), sig[j], percent, miss)]
        for j in j.tolist():
            a, b = find(comp[i].item()), find(comp[j].item())
            if a == b:
                continue
            for x in (i, j):
                if x not in sets:
                    sets[x] = shingles(df.at[x, "text"] or "", width)
            if jaccard_at_least(sets[i], sets[j], percent):
                root[max(a, b)] = min(a, b)
                found.append((df.at[i, "doc"], df.at[j, "doc"]))
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def near_duplicates(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, miss: float = 1e-7, block: int = 512
) -> DataFrame:
    """One row per row of ``docs``: doc, n_shingles, component_id and kept.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets; words are runs of anything but
    ASCII white space, A-Z in lower case. ``component_id`` is the smallest id that can be reached, ``kept`` says that it is
    the row's own. A null or empty text has an empty set and is linked with nothing. Rows of one id are one
    document: they share the component of all their texts. A row without id is linked with nothing and kept.
    """
    rows = docs.select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("text"))
    sets = saved(_sets(rows, width), "sets")
    some = sets.filter("n_shingles > 0 and doc is not null")
    classes = some.groupBy("digest").agg(F.min("doc").alias("rep"))
    owned = some.select("doc", "digest").join(classes, "digest").select("doc", "digest", "rep").distinct()
    owned = saved(owned, "classes")
    reps = some.join(owned.filter("doc = rep").select("doc", "digest"), ["doc", "digest"], "left_semi")
    reps = saved(reps.dropDuplicates(["doc", "digest"]).drop("digest"), "representatives")

    per = rows_of(percent)
    keys = F.expr(f"transform(sequence(0, {HASHES // per - 1}), k -> xxhash64(k, substring(sig, k * {4 * per} + 1, {4 * per})))")
    bands = reps.select("doc", F.explode(keys).alias("key"))
    bucket = bands.groupBy("key").agg(
        F.min("doc").alias("leader"), F.count("*").alias("n"), F.expr("bit_xor(xxhash64(doc))").alias("same")
    )
    bucket = saved(bucket.filter("n > 1"), "buckets")
    inside = saved(bands.join(bucket, "key"), "members")
    # Texts are shuffled once, for the classes that share a bucket with another.
    texts = saved(rows.join(inside.select("doc").distinct(), "doc", "left_semi"), "texts")
    pairs = inside.filter("doc <> leader").select(F.col("doc").alias("a"), F.col("leader").alias("b")).distinct()
    of = lambda side: reps.select(F.col("doc").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("sig").alias(f"sig_{side}"))
    pairs = pairs.join(of("a"), "a").join(of("b"), "b")
    pairs = pairs.filter(F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b"))

    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            a, b = (np.frombuffer(b"".join(df[c]), np.uint32).reshape(len(df), HASHES) for c in ("sig_a", "sig_b"))
            yield df.iloc[survivors(a, b, percent, miss)][["a", "b"]]

    pairs = pairs.select("a", "b", "sig_a", "sig_b").mapInPandas(prune, "a long, b long")
    links = saved(_confirm(pairs, texts, width, percent), "links-1")

    comps = components(links)
    inside = inside.filter("n > 2").join(comps, inside["doc"] == comps["node"], "left")
    inside = saved(inside.select("doc", "key", "n", "same", F.coalesce("component", "doc").alias("comp")), "apart")
    apart = inside.groupBy("n", "same").agg(F.min("key").alias("key"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    apart = apart.filter("low <> high").select("key")
    # Buckets with the same members are looked at once; large ones in blocks of about ``block`` members.
    todo = inside.join(apart, "key").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    todo = todo.withColumn("mine", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    todo = todo.select("doc", "key", "comp", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    todo = todo.select(
        "doc", "key", "comp", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"),
        "mine", (F.col("mine") == F.col("other")).alias("within"),
    )
    todo = todo.join(reps.select("doc", "n_shingles", "sig"), "doc").join(texts, "doc")
    more = todo.groupBy("key", "x", "y").applyInPandas(
        lambda df: _forest(df, width, percent, miss), "a long, b long"
    )
    links = saved(links.union(more).union(owned.select("doc", "rep")), "links")
    comps = components(links)
    out = sets.join(comps, sets["doc"] == comps["node"], "left")
    component = F.coalesce("component", "doc")
    kept = F.coalesce(F.col("doc") == component, F.lit(True))
    return out.select(F.col("doc").alias(doc), "n_shingles", component.alias("component_id"), kept.alias("kept"))
