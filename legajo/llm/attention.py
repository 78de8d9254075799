"""Quality scores by attention over passages: a document is a bag of passages, and only the bag is labelled.

Every passage of ``PASSAGE`` words of the whole text is encoded from dense features (shares of kinds of characters, word lengths,
capitals, marks, repeated words and word pairs) by one hidden layer; gated attention weighs the passages, and the weighted sum of
their encodings is scored. Encoder, gates and score are learned together from the documents' labels.

Members of a small ensemble are trained side by side, each in a task of its own on all folds of the labelled documents but
one, and calibrated on that one. Training takes a bounded number of labelled documents and of passages of each, spread over
the whole text; scoring is one pass over all texts, without a shuffle.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legajo.llm.scratch import saved

PASSAGE = 64
#: Bytes featured at a time; a longer text is cut behind white space into pieces whose passages are counted anew.
PIECE = 1 << 20
KINDS = ["blank", "line", "lower", "capital", "digit", "symbol", "mark", "stop", "bracket", "other", "control", "lead", "follow"]
FEATURES = [
    *[f"{kind}_rate" for kind in KINDS],
    "words", "word_bytes", "word_spread", "capital_words", "symbol_ends", "mark_ends", "stop_ends", "digit_words",
    "distinct", "doubled", "seen_words", "seen_pairs", "lead_capitals",
]


def _kinds() -> np.ndarray:
    kind = np.full(256, KINDS.index("other"), dtype=np.uint8)
    for name, chars in {
        "blank": " \t\r\x0b\x0c", "line": "\n", "lower": "abcdefghijklmnopqrstuvwxyz", "capital": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "digit": "0123456789", "symbol": "#*$%&|<>", "mark": "!?", "stop": ".,;:", "bracket": "()[]{}\"'",
    }.items():
        kind[list(chars.encode())] = KINDS.index(name)
    kind[[*range(9), *range(14, 32), 127]] = KINDS.index("control")
    kind[0x80:0xC0], kind[0xC0:] = KINDS.index("follow"), KINDS.index("lead")
    return kind


KIND = _kinds()
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, *range(9, 14)]] = True
_random = np.random.default_rng(11)
_BYTES = _random.integers(1, 1 << 62, 256).astype(np.uint64)
_PLACES = (_random.integers(1, 1 << 62, 64) | 1).astype(np.uint64)


def pieces(text: bytes) -> list[bytes]:
    """``text`` in pieces of ``PIECE`` bytes at most, cut behind white space where there is any."""
    out = []
    while len(text) > PIECE:
        cut = max(text.rfind(b, 0, PIECE) for b in (b" ", b"\n", b"\t")) + 1 or PIECE
        out.append(text[:cut])
        text = text[cut:]
    return [*out, text]


def _seen(unit: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Whether the same name stands earlier in the same unit."""
    key = name ^ (unit.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), dtype=bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    return again


def encode(units: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of some pieces of text, and the number of the piece of each; one passage of zeros for a piece without words."""
    data = np.frombuffer(b" " + b" ".join(units) + b" ", dtype=np.uint8)
    starts = 1 + np.cumsum([0, *[len(u) + 1 for u in units[:-1]]])
    inside = ~_BLANK[data]
    turns = np.flatnonzero(np.diff(inside)) + 1
    begin, end = turns[::2], turns[1::2]
    unit = np.searchsorted(starts, begin, "right") - 1
    bare = np.setdiff1d(np.arange(len(units)), unit)
    if not len(begin):
        return np.zeros((len(bare), len(FEATURES)), dtype=np.float32), bare
    first = np.searchsorted(unit, unit)
    opens = np.flatnonzero((np.arange(len(begin)) - first) % PASSAGE == 0)
    n = len(opens)
    passage = np.repeat(np.arange(n), np.diff([*opens, len(begin)]))
    kind = KIND[data]

    # A passage reaches to the next one's first byte or its text's end; what lies between counts to a passage past the last.
    ends = np.cumsum([len(u) + 1 for u in units])
    follow = np.append(begin[opens[1:]], len(data))
    stop = np.minimum(follow, ends[unit[opens]])
    place = np.repeat(np.stack([np.arange(n), np.full(n, n)], axis=1).ravel(), np.stack([stop - begin[opens], follow - stop], axis=1).ravel())
    body = kind[begin[0] :]
    rates = np.bincount(place * len(KINDS) + body, minlength=(n + 1) * len(KINDS)).reshape(n + 1, len(KINDS))[:n].astype(np.float64)
    rates /= rates.sum(axis=1, keepdims=True)

    size = end - begin
    word_of = np.repeat(np.arange(len(begin)), size)
    at = np.flatnonzero(inside)
    mixed = _BYTES[data[at]] * _PLACES[(at - begin[word_of]) % len(_PLACES)]
    name = np.add.reduceat(mixed, np.cumsum([0, *size[:-1]]))
    pair = name.copy()
    inner = np.flatnonzero(unit[1:] == unit[:-1]) + 1
    pair[inner] = name[inner - 1] * np.uint64(0xC2B2AE3D27D4EB4F) + name[inner]
    is_kind = lambda where, k: kind[where] == KINDS.index(k)
    marks = {
        "capital_words": is_kind(begin, "capital") & is_kind(end - 1, "capital") & (size > 1),
        "symbol_ends": is_kind(end - 1, "symbol"),
        "mark_ends": is_kind(end - 1, "mark"),
        "stop_ends": is_kind(end - 1, "stop"),
        "digit_words": is_kind(begin, "digit"),
        "distinct": ~_seen(passage, name),
        "doubled": np.concatenate([[False], (name[1:] == name[:-1]) & (unit[1:] == unit[:-1])]),
        "seen_words": _seen(unit, name),
        "seen_pairs": _seen(unit, pair),
        "lead_capitals": is_kind(begin, "capital"),
    }
    words = np.bincount(passage, minlength=n)
    mean = np.bincount(passage, weights=size, minlength=n) / words
    spread = np.sqrt(np.maximum(0, np.bincount(passage, weights=size * size, minlength=n) / words - mean**2))
    columns = {"words": np.log1p(words), "word_bytes": np.log1p(mean), "word_spread": np.log1p(spread)}
    columns |= {k: np.bincount(passage, weights=v, minlength=n) / words for k, v in marks.items()}
    x = np.column_stack([rates, *[columns[k] for k in FEATURES[len(KINDS) :]]]).astype(np.float32)
    return np.concatenate([x, np.zeros((len(bare), len(FEATURES)), dtype=np.float32)]), np.concatenate([unit[opens], bare])


def bags(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The passages of whole texts in order, and where each text's begin; null is read as empty."""
    parts, owners, units, of, held = [], [], [], [], 0

    def flush() -> None:
        x, unit = encode(units)
        parts.append(x)
        owners.append(np.array(of)[unit])

    for no, text in enumerate(texts):
        for unit in pieces((text or "").encode()):
            units.append(unit)
            of.append(no)
            held += len(unit)
            if held >= PIECE:
                flush()
                units, of, held = [], [], 0
    if units:
        flush()
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(parts)[order], np.searchsorted(owner[order], np.arange(len(texts)))


@dataclass
class Network:
    """Encoder, gated attention and score of a bag of passages."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0

    @classmethod
    def new(cls, x: np.ndarray, seed: int, hidden: int = 16, gates: int = 8) -> Network:
        rng = np.random.default_rng(seed)
        normal = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape)
        weights = {
            "code": normal(x.shape[1], hidden), "code0": np.zeros(hidden), "what": normal(hidden, gates), "gate": normal(hidden, gates),
            "weigh": normal(gates), "score": normal(hidden), "score0": np.zeros(1),
        }
        return cls(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3), weights)

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """All values on the way to ``logit``; ``attention`` adds up to one in each bag."""
        w = self.weights
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ w["code"] + w["code0"])
        what, gate = np.tanh(h @ w["what"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        e = (what * gate) @ w["weigh"]
        size = np.diff([*starts, len(x)])
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), size))
        attention = e / np.repeat(np.add.reduceat(e, starts), size)
        bag = np.add.reduceat(attention[:, None] * h, starts)
        return {"x": x, "h": h, "what": what, "gate": gate, "size": size, "attention": attention, "bag": bag, "logit": bag @ w["score"] + w["score0"]}

    def gradients(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy of bags labelled ``y``."""
        w, f = self.weights, self.forward(x, starts)
        h, what, gate, attention = f["h"], f["what"], f["gate"], f["attention"][:, None]
        d_logit = (1 / (1 + np.exp(-f["logit"])) - y) / len(y)
        d_bag = np.repeat(d_logit[:, None] * w["score"], f["size"], axis=0)
        pull = (h * d_bag).sum(axis=1, keepdims=True)
        d_e = attention * (pull - np.repeat(np.add.reduceat(attention * pull, starts), f["size"], axis=0))
        d_what, d_gate = d_e * w["weigh"] * gate * (1 - what**2), d_e * w["weigh"] * what * gate * (1 - gate)
        d_h = attention * d_bag + d_what @ w["what"].T + d_gate @ w["gate"].T
        d_code = d_h * (1 - h**2)
        return {
            "code": f["x"].T @ d_code, "code0": d_code.sum(axis=0), "what": h.T @ d_what, "gate": h.T @ d_gate,
            "weigh": ((what * gate) * d_e).sum(axis=0), "score": f["bag"].T @ d_logit, "score0": d_logit.sum(keepdims=True),
        }

    def scores(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.forward(x, starts)["logit"] + self.shift)))


def _bag_rows(starts: np.ndarray, total: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the chosen bags, one after the other, and where each begins."""
    size = np.diff([*starts, total])[chosen]
    begin = np.cumsum([0, *size[:-1]])
    return np.repeat(starts[chosen] - begin, size) + np.arange(size.sum()), begin


def train(x: np.ndarray, starts: np.ndarray, y: np.ndarray, seed: int, rounds: int = 40, batch: int = 128, rate: float = 0.01) -> Network:
    """A network fitted by Adam on shuffled batches of bags, with falling step size and light weight decay."""
    net, rng = Network.new(x, seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.weights.items()}
    v = {k: np.zeros_like(w) for k, w in net.weights.items()}
    step, steps = 0, rounds * -(-len(y) // batch)
    for _ in range(rounds):
        order = rng.permutation(len(y))
        for a in range(0, len(y), batch):
            chosen = order[a : a + batch]
            rows, begin = _bag_rows(starts, len(x), chosen)
            step += 1
            for k, g in net.gradients(x[rows], begin, y[chosen]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                move = (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
                net.weights[k] = net.weights[k] - rate * (1 - step / (steps + 1)) * (move + 0.01 * net.weights[k])
    return net


def calibrate(net: Network, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> None:
    """Fit slope and shift of the logit on documents not trained on, by a few Newton steps, held near 1 and 0."""
    z = net.forward(x, starts)["logit"]
    # A few wrongly labelled documents shall not flatten everything.
    y = (y * len(y) + 0.5) / (len(y) + 1)
    at = np.array([1.0, 0.0])
    design = np.stack([z, np.ones_like(z)])
    for _ in range(20):
        p = 1 / (1 + np.exp(-(at @ design)))
        slope = design @ (p - y) + 1.0 * (at - [1, 0])
        curve = (design * (p * (1 - p))) @ design.T + 1.0 * np.eye(2)
        at = at - np.clip(np.linalg.solve(curve, slope), -1, 1)
    net.slope, net.shift = max(float(at[0]), 0.05), float(at[1])


@dataclass
class Model:
    """The ensemble, or none and the share of good documents."""

    networks: list[Network]
    base: float

    def scores(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if not self.networks:
            return np.full(len(starts), self.base)
        return np.mean([net.scores(x, starts) for net in self.networks], axis=0)


def in_training(doc: Column) -> Column:
    """False for the held-out third, by the id alone; rows without an id are no training rows."""
    return F.coalesce(F.pmod(F.crc32(doc.cast("string")), F.lit(3)) != 1, F.lit(False))


def labelled_bags(docs: DataFrame, labels: DataFrame, doc: str, text: str, max_rows: int, most_passages: int) -> DataFrame:
    """(id, y, fold, n, x) of the labelled training documents: features of ``n`` passages as bytes."""
    labels = labels.filter(in_training(F.col(doc))).select(F.col(doc).alias("id"), F.col("quality").cast("double").alias("y")).dropna()
    labels = labels.groupBy("id").agg(F.min("y").alias("y"))
    share = min(1.0, max_rows / max(1, labels.count()))
    labels = labels.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = docs.select(F.col(doc).alias("id"), F.col(text).alias("text")).join(labels, "id")
    # Copies of a text go to one fold, or a member would be calibrated on what it was trained on.
    rows = rows.select("id", "y", F.pmod(F.xxhash64("text"), F.lit(4)).cast("int").alias("fold"), "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            if not len(df):
                continue
            x, starts = bags(df.pop("text").tolist())
            chosen = []
            for a, b in zip(starts, [*starts[1:], len(x)]):
                chosen.append(np.unique(np.linspace(a, b - 1, min(b - a, most_passages)).astype(int)))
            df["n"] = [len(c) for c in chosen]
            df["x"] = [x[c].tobytes() for c in chosen]
            yield df

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(run, f"id {kind}, y double, fold int, n int, x binary")


def fit(
    docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", max_rows: int = 20_000, most_passages: int = 256
) -> Model:
    """Learn from at most about ``max_rows`` labelled training documents, taken by the hash of their ids, and ``most_passages`` of each.

    ``labels`` has ``doc`` and ``quality`` (1 good, 0 bad); null labels and ids are left out, and a document labelled twice counts by
    its lowest label. Without both kinds of labels every score is the share of good ones, or 0.
    """
    rows = saved(labelled_bags(docs, labels, doc, text, max_rows, most_passages), "bags")
    kinds, base = rows.agg(F.countDistinct("y"), F.avg("y")).first()
    if kinds < 2:
        return Model([], float(base or 0.0))

    def member(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["id", "n"])
        x = np.frombuffer(b"".join(df["x"]), dtype=np.float32).reshape(-1, len(FEATURES))
        starts = np.cumsum([0, *df["n"].to_numpy()[:-1]])
        y, own = df["y"].to_numpy(), df["fold"].to_numpy() == key[0]
        part = lambda chosen: ((r := _bag_rows(starts, len(x), chosen)) and (x[r[0]], r[1], y[chosen]))
        trained = np.flatnonzero(~own)
        if len(set(y[trained])) < 2:
            return pd.DataFrame({"member": [], "network": []})
        net = train(*part(trained), seed=int(key[0]))
        if own.any():
            calibrate(net, *part(np.flatnonzero(own)))
        return pd.DataFrame({"member": [key[0]], "network": [pickle.dumps(net)]})

    every = rows.withColumn("member", F.explode(F.array(*map(F.lit, range(4)))))
    networks = every.groupBy("member").applyInPandas(member, "member int, network binary").collect()
    return Model([pickle.loads(r["network"]) for r in sorted(networks)], float(base))


def scored(docs: DataFrame, model: Model, doc: str = "doc_id", text: str = "text", cut: float = 0.5) -> DataFrame:
    """(doc, held_out, score, predicted, n_passages, top_passage), one row per row.

    ``top_passage`` is the number of the passage with the most weight, by the first network. A null text is scored as the
    empty one, which is one passage without words; other columns are not read.
    """
    held_out = F.coalesce(F.pmod(F.crc32(F.col(doc).cast("string")), F.lit(3)) == 1, F.lit(False)).alias("held_out")
    rows = docs.select(F.col(doc).alias("id"), held_out, F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, starts = bags(batch.column("text").to_pylist())
            score = np.clip(model.scores(x, starts), 0, 1)
            size = np.diff([*starts, len(x)])
            weight = model.networks[0].forward(x, starts)["attention"] if model.networks else np.ones(len(x))
            best = np.lexsort((-weight, np.repeat(np.arange(len(starts)), size)))[starts] - starts
            columns = [batch.column("id"), batch.column("held_out"), pa.array(score), pa.array((score >= cut).astype(np.int32))]
            names = ["id", "held_out", "score", "predicted", "n_passages", "top_passage"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(size), pa.array(best)], names)

    kind = docs.schema[doc].dataType.simpleString()
    schema = f"id {kind}, held_out boolean, score double, predicted int, n_passages long, top_passage long"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", doc)
