"""Fill-in-the-middle: prefix, middle and suffix of a text put in another order, and back.

A text of n units (lines, or code points) is cut twice, at units that a hash of
its id names. The bytes of a batch of texts lie in one buffer. A scan finds the
cuts; a difference array has, where a segment begins, the change of the shift
between a byte's place in the input and in the output; its cumulative sum is the
shift of every byte, and one scatter builds all outputs of the batch. The way
back finds the sentinels in an output, builds the shifts in the same way, and
gathers the bytes.

The hash is SHA-256 of `<seed>:<id>`; h1 to h4 are its first four groups of eight
hexadecimal digits. The prefix ends after min(h1 % (n + 1), h2 % (n + 1)) units,
the middle after the larger. A text is `plain` (as it is) when it is empty, holds
a sentinel, or h3 % 100 >= `rate`; else `spm` when h4 % 100 < `spm_share`, else `psm`.

Defined results: a null text counts as empty; a null id is hashed as the empty
string. Equal cuts leave the middle empty. Rows with one id are cut by the same
numbers, each in its own text; repeated rows give repeated rows. A text of any
length is scattered in blocks of `BLOCK` bytes, so that the arrays next to text
and output have a bound. An empty table gives an empty result. Extra columns are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SENTINELS = ("<P>", "<S>", "<M>")       # before prefix, suffix and middle
BATCH = 2_000_000       # bytes of neighbouring texts that share a buffer; a longer text has one of its own
BLOCK = 500_000         # bytes whose places are held at once
FORMS = ("plain", "psm", "spm")
UNITS = ("line", "char")
_COLUMNS = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without nulls in one array, and the bounds of its rows."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def _text(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The reverse of `_flat`; a row's bytes are UTF-8."""
    buffers = [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, buffers)


def _runs(column: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Row ranges with about `size` bytes each, at least one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield at, to
        at = to


def _shifts(starts: np.ndarray, shifts: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per block of `size` bytes its first place and the shift of each byte; segment k begins at starts[k] (ascending)."""
    change = np.diff(shifts, prepend=0)
    carried = 0
    for low in range(0, size, BLOCK):
        high = min(size, low + BLOCK)
        a, b = np.searchsorted(starts, [low, high])
        differences = np.zeros(high - low, np.int64)
        np.add.at(differences, starts[a:b] - low, change[a:b])      # empty segments share a place: changes add up
        if high > low:
            differences[0] += carried
        moved = np.cumsum(differences)
        carried = int(moved[-1])
        yield low, moved


def scatter(data: np.ndarray, starts: np.ndarray, targets: np.ndarray, out: np.ndarray) -> None:
    """Put each segment of `data` (from starts[k] up to the next start) at targets[k] in `out`."""
    for low, moved in _shifts(starts, targets - starts, len(data)):
        places = moved + np.arange(low, low + len(moved))
        out[places] = data[low : low + len(moved)]


def gather(data: np.ndarray, starts: np.ndarray, sources: np.ndarray, size: int) -> np.ndarray:
    """`size` bytes: segment k, from starts[k] up to the next start, is read from sources[k] on in `data`."""
    out = np.empty(size, np.uint8)
    for low, moved in _shifts(starts, sources - starts, size):
        out[low : low + len(moved)] = data[moved + np.arange(low, low + len(moved))]
    return out


def _units(data: np.ndarray, bounds: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places where a unit may end (before the text's own end), and per row the first such place's number and the units."""
    begin, end = bounds[:-1], bounds[1:]
    if unit == "line":
        ends = np.flatnonzero(data == 10) + 1
    else:
        ends = np.flatnonzero((data & 0xC0) != 0x80)        # a code point ends where the next one begins
    first = np.searchsorted(ends, begin, "right")
    inner = np.maximum(np.searchsorted(ends, end, "left") - first, 0)
    return ends, first, inner + (end > begin)


def cut(data: np.ndarray, bounds: np.ndarray, at: np.ndarray, unit: str = "line") -> tuple[np.ndarray, np.ndarray]:
    """Units per row, and the places after `at[j] % (units + 1)` units for each row of numbers in `at`."""
    ends, first, n = _units(data, bounds, unit)
    begin, end = bounds[:-1], bounds[1:]
    places = []
    for numbers in at:
        k = numbers % (n + 1)
        inside = (k > 0) & (k < n)
        place = np.where(k == 0, begin, end)
        place[inside] = ends[first[inside] + k[inside] - 1]
        places.append(place)
    return n, np.array(places)


def _characters(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Code points between the places."""
    begins = (data & 0xC0) != 0x80
    return np.fromiter((np.count_nonzero(begins[x:y]) for x, y in zip(a.tolist(), b.tolist())), np.int64, len(a))


def _check(sentinels: tuple[str, str, str]) -> list[bytes]:
    """Sentinels that no neighbouring text can complete or repeat: `<`, anything but `<` and `>`, `>`."""
    if len(set(sentinels)) != 3 or not all(re.fullmatch("<[^<>]+>", s) for s in sentinels):
        raise ValueError("three different sentinels of the form <...> are needed")
    return [s.encode() for s in sentinels]


def _transformed(texts: pa.Array, h: np.ndarray, marks: list[bytes], unit: str, rate: int, spm_share: int) -> list[pa.Array]:
    data, bounds = _flat(texts)
    begin, end = bounds[:-1], bounds[1:]
    n, places = cut(data, bounds, h[:2], unit)
    low, high = places.min(axis=0), places.max(axis=0)
    holds = np.zeros(len(texts), bool)
    for mark in marks:
        holds |= pc.match_substring(texts, mark.decode()).to_numpy(zero_copy_only=False)
    plain = (end == begin) | holds | (h[2] % 100 >= rate)
    spm = ~plain & (h[3] % 100 < spm_share)
    moved = ~plain
    sizes = [len(m) for m in marks]
    out_bounds = np.zeros(len(n) + 1, np.int64)
    np.cumsum((end - begin) + np.where(plain, 0, sum(sizes)), out=out_bounds[1:])
    at = out_bounds[:-1]
    prefix, middle, suffix = low - begin, high - low, end - high
    # psm: <P> prefix <S> suffix <M> middle; spm: <S> suffix <P> prefix <M> middle
    p_mark = np.where(spm, at + sizes[1] + suffix, at)
    s_mark = np.where(spm, at, at + sizes[0] + prefix)
    m_mark = at + sizes[0] + sizes[1] + prefix + suffix
    targets = np.stack([
        np.where(plain, at, p_mark + sizes[0]),
        np.where(plain, at + prefix, m_mark + sizes[2]),
        np.where(plain, at + prefix + middle, s_mark + sizes[1]),
    ], axis=1).ravel()
    out = np.empty(int(out_bounds[-1]), np.uint8)
    scatter(data, np.stack([begin, low, high], axis=1).ravel(), targets, out)
    for mark, place in zip(marks, (p_mark, s_mark, m_mark)):
        out[place[moved][:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    form = pa.array(np.array(FORMS, object)[np.where(plain, 0, np.where(spm, 2, 1))], pa.string())
    counts = [pa.array(_characters(data, a, b), pa.int64(), mask=plain) for a, b in ((begin, low), (low, high))]
    return [pa.array(n, pa.int64()), form, *counts, _text(out, out_bounds)]


def fill_in_middle(
    docs: DataFrame, id: str = "doc_id", text: str = "text", unit: str = "line", seed: int = 7,
    rate: int = 100, spm_share: int = 50, sentinels: tuple[str, str, str] = SENTINELS, restore: bool = False,
) -> DataFrame:
    """Per row: id, `n` (units), `form`, `prefix_chars`, `middle_chars` (code points; null if plain), `output`.

    With `restore` also `restored`, the text that is rebuilt from output and form in the same task. Cuts
    between code points (`unit="char"`) hold eight bytes for each code point of the texts that share a buffer.
    """
    marks = _check(sentinels)
    if unit not in UNITS:
        raise ValueError(f"unit is one of {UNITS}")
    kind = docs.schema[id].dataType
    columns = [*_COLUMNS, "restored"] if restore else _COLUMNS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for a, b in _runs(texts, BATCH):
                h = np.array([batch.column(c).slice(a, b - a).to_numpy(zero_copy_only=False) for c in range(2, 6)])
                done = _transformed(texts.slice(a, b - a).cast(pa.large_string()), h, marks, unit, rate, spm_share)
                if restore:
                    done.append(_rebuilt(done[-1], np.array(done[1].to_pylist(), object), marks).cast(pa.string()))
                done[4] = done[4].cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *done], columns)

    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))).cast("binary"), 256)
    groups = [F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *groups)
    schema = f"id {kind.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(run, schema + ", restored string" * restore).withColumnRenamed("id", id)


def _places(column: pa.Array, mark: bytes) -> np.ndarray:
    return pc.find_substring(column, mark.decode()).to_numpy(zero_copy_only=False).astype(np.int64)


def _rebuilt(outputs: pa.Array, forms: np.ndarray, marks: list[bytes]) -> pa.Array:
    """The texts, from outputs and forms alone: a text that was moved holds each sentinel once."""
    data, bounds = _flat(outputs)
    begin, end = bounds[:-1], bounds[1:]
    plain, spm = forms == "plain", forms == "spm"
    p, s, m = (begin + np.where(plain, 0, _places(outputs, mark)) for mark in marks)
    sizes = [len(mark) for mark in marks]
    sources = np.stack([np.where(plain, begin, p + sizes[0]), np.where(plain, end, m + sizes[2]), np.where(plain, end, s + sizes[1])], axis=1)
    ends = np.stack([np.where(plain, end, np.where(spm, m, s)), end, np.where(plain, end, np.where(spm, p, m))], axis=1)
    lengths = (ends - sources).ravel()
    stops = np.cumsum(lengths)
    text = gather(data, stops - lengths, sources.ravel(), int(stops[-1]) if len(stops) else 0)
    return _text(text, np.concatenate([[0], stops[2::3]]))


def restore_text(
    moved: DataFrame, output: str = "output", form: str = "form", out: str = "restored", sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """Adds the text that an output was made from; null where output or form is null."""
    marks = _check(sentinels)

    @F.pandas_udf("string")
    def restored(outputs, forms):
        known = pa.array(outputs.where(forms.notna(), None), pa.large_string())
        texts, names = pc.fill_null(known, ""), forms.where(outputs.notna() & forms.notna(), "plain").to_numpy(object)
        parts = [_rebuilt(texts.slice(a, b - a), names[a:b], marks) for a, b in _runs(texts, BATCH)]
        found = pa.chunked_array(parts, pa.large_string()).to_pandas()
        found.index = outputs.index
        return found.where(outputs.notna() & forms.notna(), None)

    return moved.withColumn(out, restored(F.col(output), F.col(form)))
