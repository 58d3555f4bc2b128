"""Byte-level BPE with ranked merges: whole texts to ids and back.

Each match of the splitting pattern is merged on its own. A segment tree over
its byte positions holds, per node, the leftmost smallest pair rank below it;
a merge takes the root and updates three leaves (the pair that is gone and the
two pairs with the new token), so n bytes take n log n steps, also for a match
without a blank that is as long as the text. Parts between blanks are encoded
once per worker and reused.

Defined results: a null text counts as empty and has no tokens. Special tokens
have no meaning in a text. Repeated rows give repeated rows; an empty table
gives an empty result. Extra columns of `docs` are kept out of the result,
except the id.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.pieces import PartCache, groups
from skeinwork.llm.worker import kept

_NONE = 1 << 62
ROWS = 1000             # texts that a task turns into strings at once
PARTS = 1_500_000       # parts between blanks that a worker keeps encoded; a bound on memory, not on results


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with a base64 token and a rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match of the pattern."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    leaves = 1 << (n - 1).bit_length()
    tree = [_NONE] * (2 * leaves)       # rank * n + position: the smallest rank, and of equal ones the leftmost
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            tree[leaves + i] = rank * n + i
    for node in range(leaves - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(position: int, value: int) -> None:
        node = leaves + position
        tree[node] = value
        while node > 1:
            a, b = tree[node], tree[node ^ 1]
            node >>= 1
            low = a if a < b else b
            if tree[node] == low:
                break
            tree[node] = low

    while (top := tree[1]) != _NONE:
        i = top % n
        j = after[i]
        end = after[j]
        after[i] = end
        put(j, _NONE)
        if end < n:
            before[end] = i
            rank = ranks.get(piece[i : after[end]])
            put(i, _NONE if rank is None else rank * n + i)
        else:
            put(i, _NONE)
        left = before[i]
        if left >= 0:
            rank = ranks.get(piece[left:end])
            put(left, _NONE if rank is None else rank * n + left)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str, parts: int = PARTS):
        import regex

        self.ranks = load_ranks(path)
        self.matches = regex.compile(pattern).findall
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.parts = PartCache(self._encode, size=parts)

    def _encode(self, parts: list[str]) -> Iterator[bytes]:
        ranks, matches = self.ranks, self.matches
        for part in parts:
            ids = [i for m in matches(part) for i in merge(m.encode(), ranks)]
            yield np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        for run in groups(texts):
            yield from self.parts.ids(run)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_bpe(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id and `ids`, the tokens as little-endian unsigned 32-bit integers. `path` must be there on every executor."""
    kind = docs.schema[id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(f"bpe {path} {pattern}", lambda: Codec(path, pattern))
        for batch in batches:
            ids = list(codec.encode([t or "" for t in batch.column(1).to_pylist()]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["id", "ids"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {kind.simpleString()}, ids binary").withColumnRenamed("id", id)


def decode_bpe(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for."""

    @F.pandas_udf("binary")
    def decoded(column):
        codec = kept(f"bpe {path} {pattern}", lambda: Codec(path, pattern))
        return column.map(codec.decode, na_action="ignore")

    return encoded.withColumn(out, decoded(F.col(ids)))


def bpe_digests(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text", parts: int = PARTS) -> DataFrame:
    """Per row: id, `n_tokens`, and SHA-256 of ids and of the decoded text; ids and bytes do not leave the task."""
    kind = docs.schema[id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(f"bpe {path} {pattern} {parts}", lambda: Codec(path, pattern, parts))
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            counts, digests, texts = [], [], []
            for ids in codec.encode([t or "" for t in batch.column(1).to_pylist()]):
                counts.append(len(ids) // 4)
                digests.append(hashlib.sha256(ids).hexdigest())
                texts.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = f"id {kind.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id)
