"""Byte-level BPE: ids of whole texts by a rank file, and their bytes again.

A text of up to ``chunk`` characters is encoded where it is read. A longer one is cut into chunks that overlap,
and the chunks are dealt over the cluster. Each chunk is pre-tokenised from its own start; only the ends of its
pre-tokens are kept. A pre-token depends only on what follows its start, so where two neighbours have an end in common
they agree from there on, up to the last pre-token of the earlier one, which may be cut short. Chunks are therefore stitched at a
common end in their overlap, behind a character that is not white space (white space looks ahead). Where two chunks have none, as inside a
word longer than the overlap, they are joined and pre-tokenised as one. The pieces between seams then
go back to the tasks and are encoded side by side. Decoding joins the bytes of the ids.

Tokens are looked up in the executors' own copy of the rank file, whose path is a parameter.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legajo.llm.scratch import saved


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def ends_of(text: str, start: int, pattern: str) -> list[int]:
    """Ends of the pre-tokens of a chunk that begins at ``start`` of its text and has more text behind it."""
    return [start + m.end() for m in regex.finditer(pattern, text)][:-1]


def seams(text: str, starts: list[int], ends: list[list[int]], pattern: str, overlap: int) -> list[int]:
    """Where the pieces of one text begin; ``ends`` are the chunks' own, by their starts.

    ``known`` holds ends that are right from the last seam on, as far as ``covered``.
    """
    reach = [s + overlap for s in starts[1:]] + [len(text)]
    out, known, covered = [0], ends[0], reach[0]
    for k in range(1, len(starts)):
        if starts[k] + overlap > covered:
            # No seam with the last chunk: go on from the last right end, twice as far each time.
            since = max((p for p in known if p >= out[-1]), default=out[-1])
            covered = min(len(text), 2 * (starts[k] + overlap) - since)
            known = ends_of(text[since:covered], since, pattern)
        here = set(known)
        common = [p for p in ends[k] if p in here and p > out[-1] and not text[p - 1].isspace()]
        if common:
            out.append(min(common))
            known, covered = ends[k], reach[k]
    return out


def _ids(text: str, path: str, pattern: str) -> bytes:
    # A lone surrogate has no bytes; it cannot come out of Spark's strings.
    return encoder(path, pattern).encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


def _sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time: texts are long, and Spark sizes its batches by rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _decoded(ids: list[bytes], path: str, pattern: str) -> pa.Array:
    return pa.array([hashlib.sha256(decode(x, path, pattern)).hexdigest() for x in ids], pa.string())


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", digest: bool = False, chunk: int = 1 << 15, overlap: int = 1 << 10
) -> DataFrame:
    """``docs`` with ``token_ids``: a binary of little-endian unsigned 32-bit ids, replacing a column of that name.

    Every row gets the ids of its whole text, repeated rows as well; a null text counts as empty and has no ids.
    Long texts are encoded once for all rows that hold them and joined by SHA-256. With ``digest`` the ids are decoded again
    and ``decoded_sha256`` is the hexadecimal digest of the bytes.
    """
    cols = [c for c in docs.columns if c not in ("token_ids", "decoded_sha256")]
    body = F.coalesce(F.col(text), F.lit(""))
    more = [F.lit("").alias("decoded_sha256")] if digest else []
    schema = docs.select(*cols, F.lit(b"").alias("token_ids"), *more).schema

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            ids = [_ids(t, path, pattern) for t in batch.column("__text").to_pylist()]
            out = batch.drop_columns(["__text"]).append_column("token_ids", pa.array(ids, pa.binary()))
            yield out.append_column("decoded_sha256", _decoded(ids, path, pattern)) if digest else out

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            yield batch.append_column("decoded_sha256", _decoded(batch.column("token_ids").to_pylist(), path, pattern))

    long = F.length(body) > chunk
    short = docs.filter(~long).select(*cols, body.alias("__text")).mapInArrow(whole, schema)

    texts = docs.filter(long).select(F.sha2(F.encode(body, "UTF-8"), 256).alias("key"), body.alias("body"))
    texts = saved(texts.dropDuplicates(["key"]), "long-texts")
    starts = F.sequence(F.lit(0), F.length("body") - 1, F.lit(chunk))
    part = texts.select("key", "body", F.explode(starts).alias("start"))
    part = part.select("key", "start", F.expr(f"substr(body, start + 1, {chunk + overlap})").alias("part"))
    # One chunk to a partition entry: the chunks of one text go to different tasks.
    part = part.repartition(F.col("key"), F.col("start"))

    def pre_tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            df["ends"] = [
                [e for e in ends_of(t, s, pattern) if e <= s + overlap or e > s + chunk] for t, s in zip(df.pop("part"), df["start"])
            ]
            yield df

    ends = part.mapInPandas(pre_tokenise, "key string, start int, ends array<int>")
    ends = ends.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "ends"))).alias("chunks"))

    def stitch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for key, body, chunks in zip(df["key"], df["body"], df["chunks"]):
                chunks = [(c["start"], list(c["ends"])) for c in chunks]
                cuts = seams(body, [s for s, _ in chunks], [e for _, e in chunks], pattern, overlap) + [len(body)]
                pieces = [body[a:b] for a, b in zip(cuts, cuts[1:])]
                yield pd.DataFrame({"key": key, "at": range(len(pieces)), "piece": pieces})

    pieces = texts.join(ends, "key").mapInPandas(stitch, "key string, at int, piece string")
    pieces = pieces.repartition(F.col("key"), F.col("at"))

    def encode_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            df["ids"] = [_ids(t, path, pattern) for t in df.pop("piece")]
            yield df

    ids = pieces.mapInPandas(encode_pieces, "key string, at int, ids binary")
    ids = ids.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    ids = ids.select(F.col("key").alias("__key"), joined.alias("__ids"))
    rows = docs.filter(long).select(*cols, F.sha2(F.encode(body, "UTF-8"), 256).alias("__key"))
    rest = rows.join(ids, "__key", "left").select(*cols, F.col("__ids").alias("token_ids"))
    return short.unionByName(rest.mapInArrow(again, schema) if digest else rest)


def decode(ids: bytes, path: str, pattern: str) -> bytes:
    """Bytes of a binary of ids."""
    return encoder(path, pattern).decode_bytes(memoryview(ids).cast("I").tolist())
