"""Scores of texts under a smoothed n-gram model, as a weighted backoff automaton.

A state is a context of up to order - 1 tokens that training has seen. From a
state, an arc per seen n-gram carries its smoothed log-probability; where there
is no arc, the failure arc leads to the state of the shorter context and
carries the log of the backoff weight. Smoothing gives a context seen c times
the share K / (c + K) for the shorter one:

    p(w | h) = (c(h w) + K p(w | h')) / (c(h) + K),   p(w) as in the base score

A text is read once from left to right; the state goes along and the arc
weights add up. All texts of a block advance together.

The model is not gathered anywhere. Documents are packed into blocks of bounded
size. A block asks for the training counts of its own distinct n-grams, and so
learns the part of the automaton that its texts can reach. Keys are 64-bit
hashes, so a bucket is a range of keys and an n-gram that is frequent in the
corpus has one request per block. Keys travel sorted, as compressed gaps, and
counts come back in the same order.

Defined results: a null text counts as empty and scores the end token alone. A
token that training lacks has the count 0 at the root. Repeated rows count and
score as often as they occur; a null id is in training. An empty table gives an
empty result. Without any training row the root is uniform over one token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.worker import kept
from skeinwork.session import materialize

BLOCK_BYTES = 5_000_000         # text of a block
BUCKET_TOKENS = 2_000_000       # tokens that one bucket of n-grams stands for
PRIOR = 30.0                    # K
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_MIX, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)
_START, _END = np.uint64(1), np.uint64(2)       # hashes of the marks around a text


class _Hashes(dict):
    """64-bit hash by word; starts anew when full."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word) | 4      # apart from the marks
        return value


def words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, split at blanks and the control characters from tab to carriage return."""
    return (text or "").encode().translate(LOWER).split()


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left * _MIX) ^ right
    mixed = (mixed ^ (mixed >> _SHIFT)) * _MIX
    return mixed ^ (mixed >> np.uint64(32))


def _pack(array: np.ndarray) -> bytes:
    """Byte planes of an integer array, compressed."""
    import zstandard

    raw = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), -1).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw).tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).reshape(-1)


def _gaps(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, "<u8"), dtype=np.uint64)


class Block:
    """Token hashes of some texts in a row, each with its end, and the n-grams that end at every position."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray, order: int):
        self.tokens, self.lengths = tokens, lengths
        ends = np.cumsum(lengths)
        first = np.zeros(len(tokens), bool)
        first[ends - lengths] = True
        self.keys = [tokens]            # by n-gram length: the hash of the n-gram that ends there
        for _ in range(1, order):
            context = np.concatenate([[_START], self.keys[-1][:-1]])
            context[first] = _START
            self.keys.append(_pair(context, tokens))

    def distinct(self, trains: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per n-gram length: sorted distinct keys, how often each is in training here, index of each position's key."""
        rows = np.repeat(trains, self.lengths)
        out = []
        for keys in self.keys:
            own, at = np.unique(keys, return_inverse=True)
            out.append((own, np.bincount(at[rows], minlength=len(own)), at))
        return out


def _blocks(docs: DataFrame, id: str, text: str, trains: Column, block_bytes: int) -> DataFrame:
    """One row per block: number, ids, training marks, lengths, vocabulary of hashes and token indexes."""
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), trains.alias("trains"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = kept("lm hashes", _Hashes)
        number = TaskContext.get().partitionId() << 32
        ids, marks, parts, size = [], [], [], 0

        def full():
            nonlocal number
            tokens = np.concatenate(parts)
            vocabulary, at = np.unique(tokens, return_inverse=True)
            lengths = np.array([len(p) for p in parts], "<u4")
            number += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number - 1], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([marks], pa.list_(pa.bool_())),
                    pa.array([_pack(lengths)], pa.binary()), pa.array([_gaps(vocabulary)], pa.binary()), pa.array([_pack(at.astype("<u4"))], pa.binary()),
                    pa.array([int(sum(lengths.tolist()))], pa.int64()), pa.array([int(np.sum(marks))], pa.int64()),
                ],
                ["block", "ids", "trains", "lengths", "vocabulary", "tokens", "n_tokens", "n_trains"],
            )

        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, t, mark in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                t = t.as_py()
                found = words(t)
                parts.append(np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found)))
                parts[-1] = np.append(parts[-1], _END)
                ids.append(key)
                marks.append(bool(mark))
                size += len(t or "") + 8
                if size >= block_bytes:
                    yield full()
                    ids, marks, parts, size = [], [], [], 0
        if parts:
            yield full()

    schema = (
        f"block long, ids array<{kind}>, trains array<boolean>, lengths binary, vocabulary binary, tokens binary, n_tokens long, n_trains long"
    )
    return materialize(rows.mapInArrow(run, schema), "lm_blocks")


def _opened(lengths: bytes, vocabulary: bytes, tokens: bytes, order: int) -> Block:
    return Block(_keys(vocabulary)[_unpack(tokens, "<u4")], _unpack(lengths, "<u4").astype(np.int64), order)


def _requests(blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    """A row per block, n-gram length and bucket: its sorted keys and their counts in the block's training texts."""
    step = -(-(1 << 64) // buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.array([i * step for i in range(buckets)], np.uint64)
        for batch in batches:
            for row in batch.to_pylist():
                opened = _opened(row["lengths"], row["vocabulary"], row["tokens"], order)
                out = {"bucket": [], "n": [], "block": [], "keys": [], "counts": []}
                for n, (keys, counts, _) in enumerate(opened.distinct(np.array(row["trains"], bool)), 1):
                    cuts = np.append(np.searchsorted(keys, bounds), len(keys))
                    for b in range(buckets):
                        lo, hi = cuts[b], cuts[b + 1]
                        if lo < hi:
                            out["bucket"].append(b)
                            out["n"].append(n)
                            out["block"].append(row["block"])
                            out["keys"].append(_gaps(keys[lo:hi]))
                            out["counts"].append(_pack(counts[lo:hi].astype("<u8")))
                yield pa.RecordBatch.from_pydict(out, schema=sent)

    sent = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
    spread = blocks.select("block", "trains", "lengths", "vocabulary", "tokens")
    return spread.mapInArrow(run, "bucket int, n int, block long, keys binary, counts binary")


def _totals(requests: DataFrame) -> DataFrame:
    """A row per request: the counts over all blocks, in the order of its keys, and what is distinct in the bucket."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        sent = [_keys(k) for k in group["keys"]]
        keys, at = np.unique(np.concatenate(sent), return_inverse=True)
        counts = np.concatenate([_unpack(c, "<u8") for c in group["counts"]])
        total = np.zeros(len(keys), "<u8")
        np.add.at(total, at, counts)        # whole numbers: exact beyond 2^53 too
        edges = np.cumsum([len(s) for s in sent])[:-1]
        answers = [_pack(total[part]) for part in np.split(at, edges)]
        # the vocabulary of the bucket goes with its first answer
        known = np.zeros(len(group), "i8")
        known[0] = int((total > 0).sum())
        return pd.DataFrame({"block": group["block"], "n": group["n"], "bucket": group["bucket"], "known": known, "totals": answers})

    return requests.groupBy("n", "bucket").applyInPandas(run, "block long, n int, bucket int, known long, totals binary")


def traverse(arcs: list[np.ndarray], backoff: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
    """Log-probability of every text by one left-to-right traversal.

    `arcs[n - 1]` has, per position, the weight of the arc of the n-gram that
    ends there (NaN: no arc), `backoff[n - 1]` the weight of the failure arc out
    of the context of n - 1 tokens before that position. The state is the length
    of the longest seen context; all texts take a step at a time, longest first.
    """
    order = len(arcs)
    by_length = np.argsort(-lengths, kind="stable")
    starts, left = (np.cumsum(lengths) - lengths)[by_length], lengths[by_length]
    # the mark before a text is a context, too
    state, sums = np.full(len(lengths), min(1, order - 1)), np.zeros(len(lengths))
    living = np.searchsorted(-left, -np.arange(left[0] if len(left) else 0), "left")
    for step, alive in enumerate(living):
        at, now = starts[:alive] + step, state[:alive].copy()
        gained = np.zeros(alive)
        for n in range(order, 0, -1):       # from the longest context down the failure arcs
            here = now == n - 1
            weight = arcs[n - 1][at]
            take = here & ~np.isnan(weight)
            gained[take] += weight[take]
            state[:alive][take] = min(n, order - 1)
            fail = here & ~take
            if n > 1:
                gained[fail] += backoff[n - 1][at][fail]
                now[fail] = n - 2
            now[take] = -1
        sums[:alive] += gained
    out = np.empty(len(lengths))
    out[by_length] = sums
    return out


def score_texts(
    docs: DataFrame, trains: Column, id: str = "doc_id", text: str = "text", order: int = 2, prior: float = PRIOR,
    block_bytes: int = BLOCK_BYTES, bucket_tokens: int = BUCKET_TOKENS,
) -> DataFrame:
    """Per row: id, `trained`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score` (log10).

    `trains` says which rows the model learns from.
    """
    spark = docs.sparkSession
    kind = docs.schema[id].dataType.simpleString()
    blocks = _blocks(docs, id, text, F.coalesce(trains, F.lit(True)), block_bytes)
    tokens, texts = blocks.agg(F.sum("n_tokens"), F.sum("n_trains")).first()
    # every token begins one n-gram of each length
    buckets = 1 + int(tokens or 0) // bucket_tokens
    answers = materialize(_totals(_requests(blocks, order, buckets)), "lm_counts")
    vocabulary = int(answers.where("n = 1").agg(F.sum("known")).first()[0] or 0)
    learned = _learned_tokens(blocks)

    def run(mine: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        row = mine.iloc[0]
        block = _opened(row["lengths"], row["vocabulary"], row["tokens"], order)
        seen = []
        for n in range(1, order + 1):
            own = counts[counts["n"] == n].sort_values("bucket")["totals"]
            index = np.unique(block.keys[n - 1], return_inverse=True)[1]
            seen.append(np.concatenate([_unpack(t, "<u8") for t in own]).astype(np.float64)[index])
        base = np.log10((seen[0] + 0.5) / (learned + 0.5 * (vocabulary + 1)))
        arcs, backoff, p = [base], [None], 10.0**base
        ends = np.cumsum(block.lengths)
        first = np.zeros(len(base), bool)
        first[ends - block.lengths] = True
        for n in range(2, order + 1):
            # a context is an n-gram one shorter that ends before; before a text stand marks, seen once per training text
            context = np.concatenate([[0.0], seen[n - 2][:-1]])
            context[first] = texts or 0
            p = (seen[n - 1] + prior * p) / (context + prior)
            arcs.append(np.where(seen[n - 1] > 0, np.log10(p), np.nan))
            backoff.append(np.log10(prior / (context + prior)))
        starts = ends - block.lengths
        return pd.DataFrame({
            "id": pd.Series(list(row["ids"]), dtype=object), "trained": list(row["trains"]), "n_tokens": block.lengths,
            "n_known": np.add.reduceat((seen[0] > 0).astype(np.int64), starts), "train_tokens": learned,
            "base_score": np.add.reduceat(base, starts), "score": traverse(arcs, backoff, block.lengths),
        })

    schema = f"id {kind}, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    own = blocks.select("block", "ids", "trains", "lengths", "vocabulary", "tokens")
    scored = own.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(run, schema)
    return scored.withColumnRenamed("id", id)


def _learned_tokens(blocks: DataFrame) -> int:
    """Tokens of the training texts."""

    @F.pandas_udf("long")
    def tokens(lengths: pd.Series, trains: pd.Series) -> pd.Series:
        return pd.Series([int(_unpack(n, "<u4")[np.array(t, bool)].sum()) for n, t in zip(lengths, trains)])

    return int(blocks.agg(F.sum(tokens("lengths", "trains"))).first()[0] or 0)
