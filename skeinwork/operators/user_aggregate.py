"""Aggregation by functions of the user: a zero, a step over rows, a merge of two states, a result."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS_HELD = 50_000      # states that a task holds before it sends them on
FAN = 64                # pieces in which the partial states of one key are merged first


def _by_key(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The rows of each key in a batch, in their order; null is a key like any other."""
    codes = pa.array([0] * batch.num_rows, pa.int64())
    for k in keys:
        column = batch.column(k).dictionary_encode(null_encoding="encode")
        codes = pc.add(pc.multiply(codes, len(column.dictionary) or 1), column.indices.cast(pa.int64()))
        codes = codes.dictionary_encode().indices.cast(pa.int64())      # numbers stay below the number of rows
    order = pc.array_sort_indices(codes)
    ordered, numbers = batch.take(order), codes.take(order).to_numpy()
    ends = [*((numbers[1:] != numbers[:-1]).nonzero()[0] + 1).tolist(), len(numbers)]
    begin = 0
    for end in ends:
        part = ordered.slice(begin, end - begin)
        yield tuple(part.column(k)[0].as_py() for k in keys), part
        begin = end


def aggregate_by_key(
    df: DataFrame,
    keys: list[str],
    zero: Callable[[], Any],
    seq: Callable[[Any, pa.RecordBatch], Any],
    comb: Callable[[Any, Any], Any],
    finish: Callable[[Any], dict],
    schema: str,
    keys_held: int = KEYS_HELD,
    fan: int = FAN,
) -> DataFrame:
    """One row per key: the key columns and what `finish` makes of the key's state.

    `zero()` is an empty state, any value that pickles; `seq(state, rows)` takes
    the rows of one key in an Arrow batch at once, `comb(a, b)` merges two states.
    Both may change and return their first argument. `finish(state)` gives a
    dictionary with the columns of `schema`. Rows and states come in any order.

    States are made per partition before the shuffle, so a key with any share of
    the rows sends a state or a few per task on, not its rows. A task holds at
    most `keys_held` states: beyond that it sends them on and starts anew. The
    partial states of a key are merged in `fan` pieces first, then into one; a
    task reads them sorted by key and holds one state. What a state holds is up
    to the functions: bound it.
    """
    types = {f.name: f.dataType for f in df.schema}
    key_schema = ", ".join(f"`{k}` {types[k].simpleString()}" for k in keys)

    def emit(states: dict, batch_schema: pa.Schema, task: int) -> pa.RecordBatch:
        columns = [pa.array([k[i] for k in states], batch_schema.field(name).type) for i, name in enumerate(keys)]
        pieces = pa.array([task % fan] * len(states), pa.int32())
        return pa.RecordBatch.from_arrays([*columns, pieces, pa.array(map(pickle.dumps, states.values()), pa.binary())], [*keys, "_piece", "_state"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        states, task, form = {}, TaskContext.get().partitionId(), None
        for batch in batches:
            form = batch.schema
            for key, rows in _by_key(batch, keys) if batch.num_rows else ():
                states[key] = seq(states[key] if key in states else zero(), rows)
            if len(states) > keys_held:
                yield emit(states, form, task)
                states = {}
        if states:
            yield emit(states, form, task)

    def merged(last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def close(key: tuple, state: Any, form: pa.Schema) -> pa.RecordBatch:
            columns = [pa.array([v], form.field(name).type) for name, v in zip(keys, key)]
            if not last:
                return pa.RecordBatch.from_arrays([*columns, pa.array([0], pa.int32()), pa.array([pickle.dumps(state)], pa.binary())], [*keys, "_piece", "_state"])
            row = finish(state)
            return pa.RecordBatch.from_arrays([*columns, *(pa.array([row[n]], t) for n, t in out_types)], [*keys, *(n for n, _ in out_types)])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            open_key, state, form, done = None, None, None, []
            for batch in batches:
                form = batch.schema
                parts = zip(*(batch.column(k).to_pylist() for k in [*keys, "_piece"]))
                for key, held in zip(parts, batch.column("_state")):
                    value = pickle.loads(held.as_py())
                    if key == open_key:
                        state = comb(state, value)
                    else:
                        if open_key is not None:
                            done.append(close(open_key[:-1], state, form))
                        open_key, state = key, value
                if len(done) >= 1000:
                    yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
                    done = []
            if open_key is not None:
                done.append(close(open_key[:-1], state, form))
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]

        return run

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    out_types = [(f.name, to_arrow_type(f.dataType)) for f in StructType.fromDDL(schema)]
    states = df.mapInArrow(partial, f"{key_schema}, _piece int, _state binary")
    in_pieces = states.repartition(*keys, "_piece").sortWithinPartitions(*keys, "_piece")
    pieces = in_pieces.mapInArrow(merged(False), f"{key_schema}, _piece int, _state binary")
    whole = pieces.repartition(*keys).sortWithinPartitions(*keys)
    return whole.mapInArrow(merged(True), f"{key_schema}, {schema}")
