"""Near-duplicate vectors: strips of near vectors in the order of the principal components, met pair by pair without a shuffle.

Vectors are scaled to length one and turned to the principal axes of a bounded sample (a rotation changes no product, so the
sample affects the speed alone). A vector's place is its leading components and the length of the rest: vectors are no nearer
than their places. Medians of the sample's places make a tree; a leaf's vectors are shuffled to one partition once and written as strips
of at most ``STRIP`` blocks. Each task reads some strips and some others from there, so that no vector is copied to the strips it meets.

Strips, blocks and vectors whose places are further apart than a link can be, from box to box or from vector to box, are never compared.
For the others the product of places, which is no less than that of the vectors, leaves few pairs, and these are decided by the product
of the given numbers in double precision. A task returns, per vector, how many others it links to and the smallest
vector it is connected with inside the task: never its pairs.

Equal vectors are one class, compared once, so that a vector that makes up a third of all rows is one row here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from legajo.llm.graph import components
from legajo.llm.scratch import saved

#: A float32 product of places is off by less than SLACK; a double product of vectors by less than EXACT.
SLACK, EXACT = 1e-4, 1e-9
#: Blocks in a strip, strips that a task reads from either side, bytes of a strip and pairs that are compared at once, at most or so.
STRIP, SIDE, STRIP_BYTES, AT_ONCE = 16, 8, 1 << 23, 1 << 20
DEALT_ROW = "leaf int, given binary, low long, known boolean, weight long"
STRIP_ROW = "at long, low array<double>, high array<double>, cuts binary, given binary, weights binary, lows binary, known binary"


def _unit(given: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that no square over- or underflows.
    given = given / np.abs(given).max(1, keepdims=True)
    return given / np.sqrt((given * given).sum(1, keepdims=True))


def _matrix(given: list[bytes], kind: str, dims: int) -> np.ndarray:
    """Packed vectors as rows of doubles, continued with zeros."""
    width = np.dtype(kind).itemsize * dims
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in given), kind).reshape(-1, dims).astype(float)


def _bare(given: bytes, kind: str) -> bytes:
    """A packed vector without trailing zeros."""
    size = np.dtype(kind).itemsize
    return given[: -(-len(given.rstrip(b"\0")) // size) * size]


def _bytes(lists: pa.ListArray, kind: str) -> pa.BinaryArray:
    """Each list's numbers as bytes; null for null."""
    starts = lists.offsets.to_numpy()
    numbers = lists.values.slice(starts[0], starts[-1] - starts[0]).to_numpy(zero_copy_only=False).astype(kind)
    offsets = ((starts - starts[0]) * numbers.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lists), [lists.is_valid().buffers()[1], pa.py_buffer(offsets), pa.py_buffer(numbers.tobytes())])


class Places:
    """Where vectors lie, by the sample ``x`` of unit vectors: the axes, how many of them lead, and a tree of at most 2 x ``leaves``."""

    def __init__(self, x: np.ndarray, threshold: float, leaves: int):
        dims = x.shape[1]
        turn = np.linalg.eigh(x.T @ x)[1][:, ::-1]
        a, b = x[:500], x[500:1000]
        unlinked = a @ b.T < threshold - SLACK
        steps = [k for k in (4, 8, 12, 16, 20, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512) if k < dims] + [dims]
        costs = []
        for k in steps:
            self.turn = np.ascontiguousarray(turn[:, :k])
            near = unlinked & (self.of(a) @ self.of(b).T >= threshold - SLACK)
            # To decide a pair takes as long as thousands of multiplications in a product of matrices.
            costs.append(k + 4000 * near.mean() if near.size else -k)
        self.turn = np.ascontiguousarray(turn[:, : steps[int(np.argmin(costs))]])
        # Eight vectors of the sample for a leaf at least.
        self.depth = max(0, min(leaves, len(x) // 8) - 1).bit_length()
        self.leaves = 1 << self.depth
        self.axis, self.cut = np.zeros(self.leaves - 1, int), np.zeros(self.leaves - 1, np.float32)
        own = {0: self.of(x)}
        for node in range(self.leaves - 1):
            at = own.pop(node)
            if len(at):
                axis = np.ptp(at, 0).argmax()
                self.axis[node], self.cut[node] = axis, np.median(at[:, axis])
            above = at[:, self.axis[node]] > self.cut[node]
            own[2 * node + 1], own[2 * node + 2] = at[~above], at[above]

    def of(self, x: np.ndarray) -> np.ndarray:
        """Places of unit vectors."""
        return self._with_rest(x @ self.turn)

    def _with_rest(self, lead: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0, 1 - (lead * lead).sum(1, keepdims=True)))
        return np.hstack([lead, rest]).astype(np.float32)

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """Leaves of unit vectors: those of equal vectors are equal, as the sums of each are made in one order."""
        out = np.empty(len(x), np.int32)
        for s in range(0, len(x), 1024):
            part = x[s : s + 1024]
            lead = np.zeros((len(part), self.turn.shape[1]))
            for j, row in enumerate(self.turn):
                lead += part[:, j, None] * row
            at, node = self._with_rest(lead), np.zeros(len(part), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (at[np.arange(len(at)), self.axis[node]] > self.cut[node])
            out[s : s + 1024] = node - self.leaves + 1
        return out


def _halved(at: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows in groups of at most ``most``, halved along the widest axis."""
    done, open_ = [], [np.arange(len(at))]
    while open_:
        rows = open_.pop()
        if len(rows) <= most:
            done.append(rows)
            continue
        values = at[rows, np.ptp(at[rows], 0).argmax()]
        order, half = np.argpartition(values, len(rows) // 2), len(rows) // 2
        open_ += [rows[order[half:]], rows[order[:half]]]
    return done


class _Strip:
    """The vectors of a written strip. Places are made anew, as they take less time to make than to carry."""

    def __init__(self, row: dict, side: str, places: Places, kind: str, dims: int):
        get = lambda c, kind: np.frombuffer(row[f"{side}_{c}"], kind)
        self.weights, self.cuts = get("weights", np.int64), get("cuts", np.int64)
        self.given, self.places = get("given", kind).reshape(-1, dims), places
        self.at = places.of(self.unit)
        self.boxes = [(p.min(0), p.max(0)) for p in (self.at[s] for s in self.blocks)]

    @cached_property
    def unit(self) -> np.ndarray:
        out = np.empty(self.given.shape)
        for s in self.blocks:
            out[s] = _unit(self.given[s].astype(float))
        return out

    @property
    def blocks(self) -> list[slice]:
        return [slice(*ends) for ends in zip(self.cuts[:-1], self.cuts[1:], strict=True)]


def _outside(at: np.ndarray, box: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Squared distances from a box."""
    out = np.maximum(0, np.maximum(box[0] - at, at - box[1]))
    return np.einsum("ij,ij->i", out, out)


def _true(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the few true cells, looked for in eights."""
    flat = mask.ravel()
    eights = len(flat) & ~7
    at = (np.flatnonzero(flat[:eights].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return np.divmod(np.r_[at[flat[at]], eights + np.flatnonzero(flat[eights:])], mask.shape[1])


def _near(a: _Strip, b: _Strip, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of ``a``, rows of ``b`` and which of their pairs may be linked; in one strip each pair once."""
    reach = max(0.0, 2 - 2 * threshold) + 2 * SLACK
    for k, (s, box) in enumerate(zip(a.blocks, a.boxes, strict=True)):
        for m, (t, other) in enumerate(zip(b.blocks, b.boxes, strict=True)):
            gap = np.maximum(0, np.maximum(box[0] - other[1], other[0] - box[1]))
            gap = float(gap @ gap)
            if same and m < k or gap > reach:
                continue
            # Along each axis two vectors are as far apart as the one is from the other's box and the other from its, without the boxes' gap:
            # their squared distance is no less than the sum of both squared distances without the squared gap.
            far, back = _outside(a.at[s], other), _outside(b.at[t], box)
            i, j = np.flatnonzero(far <= reach), np.flatnonzero(back <= reach)
            i, j = i[np.argsort(far[i], kind="stable")], j[np.argsort(back[j], kind="stable")]
            far, back, i, j = far[i], back[j], i + s.start, j + t.start
            right = np.ascontiguousarray(b.at[j].T)
            step = max(1, min(256, AT_ONCE // max(1, len(j))))
            for p in range(0, len(i), step):
                some = i[p : p + step]
                n = np.searchsorted(back, reach + gap - far[p], "right")
                maybe = a.at[some] @ right[:, :n] >= threshold - SLACK
                if same and m == k:
                    maybe &= some[:, None] < j[:n]
                if maybe.any():
                    yield some, j[:n], maybe


def _connected(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node connected with it."""
    low = np.arange(n)
    while len(i):
        m = np.minimum(low[i], low[j])
        before = low.copy()
        for ends in (i, j):
            np.minimum.at(low, low[ends], m)
            np.minimum.at(low, ends, m)
        low = low[low]
        if (low == before).all():
            return low
    return low


class _Links:
    """Links between two strips: how many rows each vector is linked with, and pairs that connect all that are linked."""

    def __init__(self, a: _Strip, b: _Strip, same: bool, threshold: float):
        self.a, self.b, self.threshold = a, b, threshold
        # Nodes are the vectors of a, and behind them those of b.
        self.shift = 0 if same else len(a.at)
        self.weights = a.weights if same else np.r_[a.weights, b.weights]
        self.n, self.low = np.zeros(len(self.weights), np.int64), np.arange(len(self.weights))
        for i, j, maybe in _near(a, b, same, threshold):
            if np.count_nonzero(maybe) > maybe.size // 50:
                self._many(i, j, maybe)
            else:
                p, q = _true(maybe)
                p, q = i[p], j[q]
                keep = self._decided(p, q)
                p, q = p[keep], q[keep] + self.shift
                np.add.at(self.n, p, self.weights[q])
                np.add.at(self.n, q, self.weights[p])
                self._join(p, q)

    def _decided(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        keep = np.empty(len(i), bool)
        for s in range(0, len(i), 1 << 15):
            p = slice(s, s + (1 << 15))
            keep[p] = np.einsum("ij,ij->i", self.a.unit[i[p]], self.b.unit[j[p]]) >= self.threshold
        return keep

    def _many(self, i: np.ndarray, j: np.ndarray, maybe: np.ndarray) -> None:
        # So many are close that the whole product is cheaper than gathering them; only those at the threshold are gathered.
        product = self.a.unit[i] @ self.b.unit[j].T
        linked = maybe & (product >= self.threshold + EXACT)
        p, q = np.nonzero(maybe & (np.abs(product - self.threshold) < EXACT))
        linked[p, q] = self._decided(i[p], j[q])
        j = j + self.shift
        ones = linked.astype(float)
        self.n[i] += np.rint(ones @ self.weights[j]).astype(np.int64)
        self.n[j] += np.rint(self.weights[i] @ ones).astype(np.int64)
        # Each row by its first link, then those that are still apart, until none is.
        while (apart := linked & (self.low[i][:, None] != self.low[j])).any():
            p = np.flatnonzero(apart.any(1))
            self._join(i[p], j[apart[p].argmax(1)])

    def _join(self, i: np.ndarray, j: np.ndarray) -> None:
        i, j = self.low[i], self.low[j]
        apart = i != j
        if apart.any():
            ends, at = np.unique(np.r_[i[apart], j[apart]], return_inverse=True)
            low = np.arange(len(self.low))
            low[ends] = ends[_connected(len(ends), *np.split(at, 2))]
            self.low = low[self.low]


def near_duplicates(
    vectors: DataFrame, vec: str = "vec_id", embedding: str = "embedding", threshold: float = 0.95, fit_rows: int = 20_000, block: int = 4096
) -> DataFrame:
    """One row per row of ``vectors``: vec, n_links, component_id and kept.

    Two vectors are linked if their cosine, in double precision, is ``threshold`` or more. ``n_links`` counts the other rows
    linked directly, ``component_id`` is the smallest id that can be reached, ``kept`` says that it is the row's own. A null
    vector, and one that is zero, empty or has null or non-finite components, is linked with nothing. Shorter vectors
    count as continued with zeros. Rows without an id are counted as links of others and share their component, the
    smallest id in it, or null where none has one; repeated ids are rows of their own.
    """
    rows = vectors.select(F.col(vec).cast("long").alias("id"), F.col(embedding).alias("given"))
    # Floats stay floats where they are kept, and are doubles where they are compared.
    single = isinstance(t := rows.schema["given"].dataType, ArrayType) and isinstance(t.elementType, FloatType)
    kind, name = ("<f4", "float") if single else ("<f8", "double")
    rows = rows.withColumn("given", F.col("given").cast("array<double>"))
    fine = F.forall("given", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(fine & F.exists("given", lambda x: x != 0), F.lit(False))
    # Trailing zeros and the sign of zeros do not make vectors differ.
    last = F.array_max(F.transform("given", lambda x, i: F.when(x != 0, i + 1)))
    plain = F.transform(F.slice("given", 1, last), lambda x: F.when(x == 0, 0.0).otherwise(x))
    rows = rows.select("id", F.when(usable, plain).cast(f"array<{name}>").alias("given"))

    def bare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for df in batches:
            yield pa.RecordBatch.from_arrays([df.column("id"), _bytes(df.column("given"), kind)], ["id", "given"])

    rows = saved(rows.mapInArrow(bare, "id long, given binary"), "vectors")
    full = rows.filter("given is not null")
    width, distinct = full.agg(F.max(F.octet_length("given")), F.approx_count_distinct(F.xxhash64("given"))).first()
    dims = (width or np.dtype(kind).itemsize) // np.dtype(kind).itemsize
    most = int(min(STRIP * block, max(block, distinct // STRIP), max(256, STRIP_BYTES // (width or 1))))
    # The sample, by hash; only a share of that size is sorted.
    h = F.xxhash64("given")
    drawn = full.filter(F.pmod(h, F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.5 * fit_rows / max(1, distinct))))
    drawn = drawn.select("given").distinct().orderBy(h, "given").limit(fit_rows).toPandas()["given"]
    places = Places(_unit(_matrix(drawn, kind, dims)) if len(drawn) else np.zeros((0, dims)), threshold, -(-distinct // most))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for df in batches:
            # Equal vectors of a batch are one row from here on.
            at, given = pd.factorize(df.column("given").to_pandas())
            known = df.column("id").is_valid().to_numpy(zero_copy_only=False)
            low = np.full(len(given), np.iinfo(np.int64).max)
            np.minimum.at(low, at[known], df.column("id").drop_null().to_numpy())
            leaf = places.leaf(_unit(_matrix(given, kind, dims)))
            cols = leaf, pa.array(given, pa.binary()), low, np.bincount(at, known) > 0, np.bincount(at)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["leaf", "given", "low", "known", "weight"])

    def packed(df: pd.DataFrame, at: int) -> pd.DataFrame:
        given = _matrix(df["given"], kind, dims)
        p = places.of(_unit(given))
        blocks = _halved(p, block)
        order, cuts = np.concatenate(blocks), np.cumsum([0, *map(len, blocks)])
        get = lambda c: df[c].to_numpy()[order].tobytes()
        return pd.DataFrame([{
            "at": at, "low": p.min(0).astype(float), "high": p.max(0).astype(float), "cuts": cuts.astype(np.int64).tobytes(), "given": given[order].astype(kind).tobytes(),
            "weights": get("weight"), "lows": get("low"), "known": get("known"),
        }])

    def strips(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, made = pd.DataFrame(), {}

        def strip(df: pd.DataFrame) -> pd.DataFrame:
            leaf = int(df["leaf"].iloc[0])
            made[leaf] = made.get(leaf, -1) + 1
            return packed(df, leaf + places.leaves * made[leaf])

        for df in batches:
            held = pd.concat([held, df], ignore_index=True) if len(held) else df
            new = held["given"].ne(held["given"].shift())
            if not new.all():
                held = held.groupby(new.cumsum()).agg({"leaf": "first", "given": "first", "low": "min", "known": "max", "weight": "sum"})
            # What stays behind has the last vector, which may come again.
            while len(held) and (n := min(most, int((held["leaf"] == held["leaf"].iloc[0]).sum()))) < len(held):
                yield strip(held.iloc[:n])
                held = held.iloc[n:]
        if len(held):
            yield strip(held)

    flat = full.mapInArrow(dealt, DEALT_ROW).repartitionById(places.leaves, "leaf").sortWithinPartitions("leaf", "given")
    blocks = saved(flat.mapInPandas(strips, STRIP_ROW), "strips")

    # Two unit vectors with a cosine of t are sqrt(2 - 2t) apart, and their places no further.
    reach = max(0.0, 2 - 2 * threshold) + 2 * SLACK
    sides = max(STRIP, -(-places.leaves // SIDE))
    one, two = (blocks.select(*[F.col(c).alias(f"{s}_{c}") for c in ("at", "low", "high", "cuts", "given", "weights")]).coalesce(sides) for s in "ij")
    over = lambda low, high: F.zip_with(low, high, lambda x, y: F.greatest(x - y, F.lit(0.0)))
    gap = F.zip_with(over("i_low", "j_high"), over("j_low", "i_high"), lambda x, y: x + y)
    near = F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x) <= reach
    # Each pair in one of its two orders, by hash, so that all tasks have as many.
    even = F.pmod(F.xxhash64(F.least("i_at", "j_at"), F.greatest("i_at", "j_at")), F.lit(2)) == 0
    once = (F.col("i_at") == F.col("j_at")) | ((F.col("i_at") < F.col("j_at")) == even)
    tiles = one.hint("shuffle_replicate_nl").join(two, once & near)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, at, counts, ends = None, None, {}, [np.zeros((2, 0), np.int64)]
        for df in batches:
            for row in (df.slice(k, 1).to_pylist()[0] for k in range(len(df))):
                a, at = a if at == row["i_at"] else _Strip(row, "i", places, kind, dims), row["i_at"]
                same = at == row["j_at"]
                b = a if same else _Strip(row, "j", places, kind, dims)
                links = _Links(a, b, same, threshold)
                sides = [(at, len(a.at)), (row["j_at"], len(b.at))][: 2 - same]
                for (k, _), n in zip(sides, np.split(links.n, [len(a.at)]), strict=False):
                    if n.any():
                        counts[k] = counts.get(k, 0) + n
                vecs, hit = np.concatenate([k * most + np.arange(size) for k, size in sides]), links.n > 0
                ends.append(np.stack([vecs[hit], vecs[links.low[hit]]]))
        if counts:
            vecs = np.concatenate([k * most + np.flatnonzero(n) for k, n in sorted(counts.items())])
            n = np.concatenate([n[n > 0] for _, n in sorted(counts.items())])
            low = vecs[_connected(len(vecs), *np.searchsorted(vecs, np.hstack(ends)))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (vecs, n, low)], ["vec", "n", "low"])

    found = saved(tiles.mapInArrow(compared, "vec long, n long, low long"), "links")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for row in (df.slice(k, 1).to_pylist()[0] for k in range(len(df))):
                low = np.frombuffer(row["lows"], np.int64)
                each = (row["given"][p : p + len(row["given"]) // len(low)] for p in range(0, len(row["given"]), len(row["given"]) // len(low)))
                yield pd.DataFrame({
                    "vec": row["at"] * most + np.arange(len(low)), "key": [hashlib.sha256(_bare(x, kind)).digest() for x in each], "low": low,
                    "known": np.frombuffer(row["known"], bool), "weight": np.frombuffer(row["weights"], np.int64),
                })

    as_batches = lambda x: map(lambda df: pa.RecordBatch.from_pandas(df, preserve_index=False), listed(x))
    classes = blocks.select("at", "given", "weights", "lows", "known").mapInArrow(as_batches, "vec long, key binary, low long, known boolean, weight long")
    classes = classes.select("vec", "key", F.when(F.col("known"), F.col("low")).alias("low"), "weight")
    hits = components(found.select(F.col("vec").alias("a"), F.col("low").alias("b"))).withColumnRenamed("node", "vec")
    hits = hits.join(found.groupBy("vec").agg(F.sum("n").alias("n")), "vec")
    # Vectors without links that come once need no row here.
    classes = saved(classes.join(hits, "vec", "left").filter("component is not null or weight > 1").drop("vec"), "classes")
    linked, alone = classes.filter("component is not null"), classes.filter("component is null")
    linked = linked.join(linked.groupBy("component").agg(F.min("low").alias("least")), "component")
    result = linked.select("key", (F.col("n") + F.col("weight") - 1).alias("n_links"), F.col("least").alias("component"))
    result = result.unionAll(alone.select("key", F.col("weight") - 1, "low"))
    # Vectors meet their results by a digest, not by their numbers.
    keyed = full.select("id", F.unhex(F.sha2("given", 256)).alias("key"))
    out = keyed.join(result, "key", "left").select("id", "n_links", "component")
    out = out.unionAll(rows.filter("given is null").select("id", F.lit(0).cast("long"), F.lit(None).cast("long")))
    component = F.coalesce("component", "id")
    kept = F.coalesce(F.col("id") == component, F.lit(True))
    return out.select(F.col("id").alias(vec), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), kept.alias("kept"))
