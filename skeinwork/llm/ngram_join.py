"""Exact similarity self-join of documents on word n-grams (Jaccard).

A document's set holds the 64-bit hashes of its distinct word n-grams. Equal
sets form a class, so copies are compared once. Two classes can only link when
they share elements among the first `n - ceil(t n) + k` of their sets in a
common order: k of them at least, more when their sizes are close. The order: low hashes (a fixed share of all) that one class has
alone, low hashes that several share, those of the fewest classes first, then
the high hashes. So a set whose low elements are mostly its own has nothing in
common with another in its first ones, and is done after one shuffle of the low
elements. Which are shared is counted over all documents.

The others meet in tiles of a shared element, never in a cross join:

1. In each tile the classes are compared with one pivot, twice with different
   pivots. A tile whose classes are connected by then needs nothing more: a
   large group of near copies costs one comparison per class and pivot.
2. What is left are pairs across components that share enough first elements.
   Small tiles give them by a join on the element. A large tile, cut into blocks
   of bounded width, tests its pairs in place: sizes, bit counts, the number of
   shared first elements, and whether it is the pair's first large tile, so a
   pair is passed on once however much it shares.
3. Inside a component, classes are cut into size-banded tiles of bounded width
   to count the links of every class.

Before arrays are compared, bit counts of hashed bitmap signatures bound the
overlap from above: a bit that is set on one side only stands for at least one
element the other side lacks. What passes is decided by the intersection of the
sorted arrays.

Defined results: words are cut at blanks and control characters from tab to
carriage return, after lower-casing A-Z. A text with fewer than five words is
one n-gram; without words, or null, the set is empty and links with nothing.
Rows with a null id take part; the component of a set whose ids are all null is
null. Repeated rows are documents of their own. An empty table gives an empty
result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from skeinwork.llm.components import components
from skeinwork.llm.worker import kept
from skeinwork.operators.skew import cut_hot, hot_among, hot_keys, repeat_hot, salted_join
from skeinwork.session import materialize

WORDS = 5
PERCENT = 75
SHARED_FIRST = 4            # k: shared first elements that a pair has at least
LARGE_TILE = 48             # classes above which a tile tests its pairs in place
BLOCK = 1024                # classes on one side of a block of a large tile
LOW_SHARE = 0.4             # share of the hashes that is low
KEY_BITS = 48               # bits of a hash that stand for an element until arrays are compared
TILE = 128                  # classes on one side of a tile
SIGNATURE = 8               # 64-bit words of a bitmap signature
HELD_WORDS = 150_000        # words whose hash a worker keeps; a bound on memory, not on results
SEEN = 20_000               # sets that a task remembers
HOT_ROWS = 400              # rows of one component above which it is cut into pieces
WIDE = 32                   # of the wide one, for pairs of a large tile that pass the first
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= HELD_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: str | None, hashes: dict, width: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(width, len(one))
    mixed = np.full(len(one) - k + 1, k, np.uint64)
    for i in range(k):
        mixed = (mixed ^ one[i : i + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed)


def set_digest(elements: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(elements.tobytes())


def half_of(digest: bytes) -> int:
    """The first half of a digest as a signed integer."""
    return int.from_bytes(digest[:8], "little", signed=True)


def signature(elements: np.ndarray, words: int = SIGNATURE) -> np.ndarray:
    """Bitmap with a bit per element, as 64-bit words."""
    bits = np.zeros(words * 64, np.uint8)
    bits[(elements >> np.uint64(20)) % np.uint64(words * 64)] = 1
    return np.packbits(bits).view("<u8")


def first_size(n: int, percent: int) -> int:
    """How many first elements of a set of n count."""
    return min(n, n - -(-percent * n // 100) + SHARED_FIRST)


def least_shared(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """First elements that linked sets of these sizes share at least.

    With an overlap of o, the i-th shared element is among the first i + n - o
    of a set of n.
    """
    most = -(-percent * (a + b) // (100 + percent))
    first = lambda n: np.minimum(n, n - -(-percent * n // 100) + SHARED_FIRST)
    return np.minimum(first(a) - (a - most), first(b) - (b - most))


def first_keys(elements: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """Keys of the low elements, and of more in ascending order where the first elements that count reach beyond.

    Two elements with one key count as one; their number is returned, too, as
    linked sets may share so many keys fewer than elements.
    """
    keys = elements >> np.uint64(64 - KEY_BITS)
    keys = keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
    low = int(np.searchsorted(keys, np.uint64(int(LOW_SHARE * (1 << KEY_BITS)))))
    return keys[: max(low, first_size(len(elements), percent))].astype(np.int64), len(elements) - len(keys)


def _sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, n, set, half, keys, lost) per row; `half` is the first half of the digest `set`.

    A task gives the keys of a set once, with the first row that has it (again
    when more than `SEEN` sets have gone by): copies send no keys of their own.
    """
    kind = docs.schema["id"].dataType.simpleString()
    nothing = np.empty(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = kept("shingle words", _Hashes), set()

        def once(elements: np.ndarray, digest: bytes) -> tuple[np.ndarray, int]:
            keys, lost = first_keys(elements, percent)
            if digest in seen:
                return nothing, lost
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(digest)
            return keys, lost

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                sets = [shingle_set(t.as_py(), hashes, width) for t in batch.column(1).slice(start, 512)]
                digests = [set_digest(x) for x in sets]
                keys, lost = zip(*(once(x, d) for x, d in zip(sets, digests)))
                lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, keys)]).astype(np.int32), np.concatenate(keys))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, 512), pa.array([len(x) for x in sets], pa.int64()), pa.array(digests, pa.binary()),
                     pa.array([half_of(d) for d in digests], pa.int64()), lists, pa.array(lost, pa.int64())],
                    ["id", "n", "set", "half", "keys", "lost"],
                )

    return materialize(docs.mapInArrow(run, f"id {kind}, n long, set binary, half long, keys array<bigint>, lost long"), "sets")


def shared_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by both columns: the distinct ones whose first value occurs with two or more second values.

    Rows stream by; only the last one waits for its successor.
    """
    last = None         # (first, second, whether an earlier row has the same first)
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if last is not None:
            a, b = np.append(last[0], a), np.append(last[1], b)
        if not len(a):
            continue
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, b = a[new], b[new]
        same = np.zeros(len(a), bool)
        same[1:] = a[1:] == a[:-1]
        if last is not None:
            same[0] = last[2]
        shared = same.copy()
        shared[:-1] |= same[1:]
        shared[-1] = False          # waits
        last = (a[-1], b[-1], bool(same[-1]))
        yield pa.RecordBatch.from_arrays([pa.array(a[shared]), pa.array(b[shared])], ["element", "half"])
    if last is not None and last[2]:
        yield pa.RecordBatch.from_arrays([pa.array([last[0]]), pa.array([last[1]])], ["element", "half"])


def _tiles(sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(element, set, n, lost): the classes that may link, by the shared elements among their first ones."""
    # one shuffle of the keys; the run of a key streams through its task
    keys = sets.select(F.explode("keys").alias("element"), "half").repartition("element").sortWithinPartitions("element", "half")
    shared = materialize(keys.mapInArrow(shared_runs, "element long, half long"), "shared_keys")
    least = F.ceil(percent * F.col("n") / 100)
    first = F.least(F.col("n"), F.col("n") - least + SHARED_FIRST)
    needed = F.greatest(F.lit(1), F.least(F.lit(SHARED_FIRST), least) - F.col("lost"))
    counted = shared.groupBy("half").agg(F.count(F.lit(1)).alias("common"))
    # of the first elements, those that no other class has come before; the rest are shared ones
    open_ = counted.join(classes.select("half", "set", "n", "keys", "lost"), "half").withColumns(
        {"rank": (first - F.col("keys") + F.col("common")).cast("int"), "needed": needed}
    )
    open_ = materialize(open_.where("rank >= needed").select("half", "set", "n", "lost", "rank", "needed"), "open_classes")
    often = shared.groupBy("element").agg(F.count(F.lit(1)).alias("often"))
    # a class has no more rows here than its text has n-grams
    order = Window.partitionBy("set").orderBy("often", "element")
    chosen = shared.join(open_, "half").join(often, "element").withColumn("place", F.row_number().over(order)).where("place <= rank")
    chosen = materialize(chosen.select("element", "set", "n", "lost", "needed"), "first_elements")
    for _ in range(2):
        # an element with one class left counts no longer, nor does a class with too few elements left
        several = chosen.groupBy("element").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("element")
        chosen = materialize(chosen.join(several, "element"), "first_elements")
        enough = chosen.groupBy("set").agg(F.count(F.lit(1)).alias("c"), F.first("needed").alias("k")).where("c >= k").select("set")
        chosen = materialize(chosen.join(enough, "set"), "first_elements")
    return chosen.drop("needed")


def _arrays(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(set, n, s0.., wide, elements) of the wanted classes, from the text of one of their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = kept("shingle words", _Hashes)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                sets = [shingle_set(t.as_py(), hashes, width) for t in batch.column(1).slice(start, 256)]
                marks = np.array([signature(s) for s in sets]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_digest(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([signature(s, WIDE).tobytes() for s in sets], pa.binary()),
                     *(pa.array(marks[:, k]) for k in range(SIGNATURE))],
                    ["set", "n", "elements", "wide", *(f"s{k}" for k in range(SIGNATURE))],
                )

    wanted = classes.select(F.col("first_id").alias("wanted"))
    chosen = docs.join(wanted, F.col("id").eqNullSafe(F.col("wanted")), "left_semi")
    schema = "set binary, n long, elements binary, wide binary, " + ", ".join(f"s{k} long" for k in range(SIGNATURE))
    return materialize(chosen.mapInArrow(run, schema).dropDuplicates(["set"]), "arrays")


@F.pandas_udf(LongType())
def overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    """Size of the intersection of two sorted arrays."""

    def one(x: bytes, y: bytes) -> int:
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        if len(x) > len(y):
            x, y = y, x
        at = np.searchsorted(y, x)
        at[at == len(y)] = 0
        return int((y[at] == x).sum())

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="int64")


def _linked(pairs: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that reach the similarity."""
    marks = ["n", *(f"s{k}" for k in range(SIGNATURE))]
    side = lambda x: arrays.select(F.col("set").alias(x), *(F.col(m).alias(f"{x}_{m}") for m in marks))
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    alone = lambda x, y: sum((F.bit_count(F.col(f"{x}_s{k}").bitwiseAND(F.bitwise_not(F.col(f"{y}_s{k}")))) for k in range(SIGNATURE)), F.lit(0))
    bound = F.least(F.col("a_n") - alone("a", "b"), F.col("b_n") - alone("b", "a"))
    enough = lambda common: (100 + percent) * common >= percent * (F.col("a_n") + F.col("b_n"))
    close = materialize(met.where(enough(bound)).select("a", "b", "a_n", "b_n"), "close_pairs")
    full = lambda x: arrays.select(F.col("set").alias(x), F.col("elements").alias(f"{x}_elements"))
    exact = close.join(full("a"), "a").join(full("b"), "b").withColumn("common", overlap("a_elements", "b_elements"))
    return materialize(exact.where(enough(F.col("common"))).select("a", "b"), "links")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(set, label) after the classes' labels are joined by links."""
    ends = links.join(labels.select(F.col("set").alias("a"), F.col("label").alias("la")), "a")
    ends = ends.join(labels.select(F.col("set").alias("b"), F.col("label").alias("lb")), "b")
    roots = components(ends.select("la", "lb"), "la", "lb").withColumnRenamed("node", "label")
    hot = hot_keys(labels, ["label"], HOT_ROWS)
    moved = cut_hot(labels, ["label"], hot, ["set"]).join(repeat_hot(roots, ["label"], hot), ["label", "_piece"], "left")
    return materialize(moved.select("set", F.coalesce("root", "label").alias("label")), "labels")


def _components(tiles: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """(set, label) for the classes in the tiles. Input: (element, set, n, lost)."""
    labels = materialize(tiles.select("set").distinct().select("set", F.col("set").alias("label")), "labels")
    near = lambda a, b: 100 * F.least(a, b) >= percent * F.greatest(a, b)
    for turn in range(2):
        marked = tiles.join(labels, "set")
        pivot = F.min_by(F.struct("set", "n", "label"), F.xxhash64("set", F.lit(turn)))
        tops = marked.groupBy("element").agg(F.min("label").alias("low"), F.max("label").alias("high"), pivot.alias("p"))
        open_ = tops.where("low <> high").select("element", "p")
        met = marked.join(open_, "element").where(F.col("label") != F.col("p.label")).where(near(F.col("n"), F.col("p.n")))
        # of a component and a pivot's component one pair is enough in a turn
        pairs = met.groupBy("label", F.col("p.label").alias("other")).agg(F.min(F.struct("set", F.col("p.set").alias("b"))).alias("x"))
        pairs = pairs.select(F.least("x.set", "x.b").alias("a"), F.greatest("x.set", "x.b").alias("b")).distinct()
        labels = _merged(labels, _linked(materialize(pairs, "pairs"), arrays, percent))
    pairs = _open_pairs(materialize(tiles.join(labels, "set"), "marked"), arrays, percent)
    return _merged(labels, _linked(materialize(pairs, "pairs"), arrays, percent))


def _open_pairs(marked: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of classes across components that share enough first elements.

    Input: (element, set, n, lost, label).
    """
    tops = marked.groupBy("element").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("width"))
    open_ = materialize(marked.join(tops.where("low <> high").select("element", "low", "width"), "element"), "open_tiles")
    small = open_.where(F.col("width") <= LARGE_TILE)
    # every pair across components has a side outside the tile's first component
    side = lambda x: [F.col(c).alias(f"{x}_{c}") for c in ("set", "n", "lost", "label")]
    met = small.where("label <> low").select("element", *side("x")).join(small.select("element", *side("y")), "element")
    met = met.where("x_label <> y_label").where(100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n"))
    # a pair of two other components meets from either side
    met = met.select("element", *[F.when(F.col("x_set") < F.col("y_set"), F.col(f"{i}_{c}")).otherwise(F.col(f"{j}_{c}")).alias(f"{o}_{c}")
                                  for o, i, j in (("a", "x", "y"), ("b", "y", "x")) for c in ("set", "n", "lost")]).distinct()
    most = F.ceil(percent * (F.col("a_n") + F.col("b_n")) / (100 + percent))
    first = lambda n: F.least(n, n - F.ceil(percent * n / 100) + SHARED_FIRST)
    needed = F.least(*[first(F.col(f"{x}_n")) - (F.col(f"{x}_n") - most) for x in "ab"]) - F.least("a_lost", "b_lost")
    together = met.groupBy("a_set", "b_set", "a_n", "b_n", "a_lost", "b_lost").agg(F.count(F.lit(1)).alias("c"))
    # pairs that share an element of a large tile, too, are found there
    from_small = together.where(F.col("c") >= needed).select(F.col("a_set").alias("a"), F.col("b_set").alias("b"))

    large = open_.where(F.col("width") > LARGE_TILE)
    lists = open_.groupBy("set").agg(
        F.sort_array(F.collect_list(F.when(F.col("width") > LARGE_TILE, F.col("element")))).alias("large"),
        F.sort_array(F.collect_list(F.when(F.col("width") <= LARGE_TILE, F.col("element")))).alias("small"),
    )
    marks = [f"s{k}" for k in range(SIGNATURE)]
    rows = large.join(materialize(lists.where(F.size("large") > 0), "element_lists"), "set").join(arrays.select("set", "wide", *marks), "set")
    blocks = F.ceil(F.col("width") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
        F.least(F.col("own"), j).alias("i"), F.greatest(F.col("own"), j).alias("j"), (F.col("own") > j).alias("second")))
    rows = rows.withColumn("blocks", blocks).withColumn("own", own).withColumn("cell", F.explode(cells))
    rows = rows.select("element", "cell.*", "set", "n", "lost", "label", "large", "small", "wide", *marks)

    def tested(group: pd.DataFrame) -> pd.DataFrame:
        same = group["i"].iloc[0] == group["j"].iloc[0]
        second = group["second"].to_numpy()
        one, two = (np.arange(len(group)),) * 2 if same else (np.flatnonzero(~second), np.flatnonzero(second))
        found = block_pairs(group, one, two, percent)
        names = group["set"].to_numpy()
        ends = [(names[x], names[y]) if names[x] < names[y] else (names[y], names[x]) for x, y in found]
        return pd.DataFrame(ends, columns=["a", "b"], dtype=object)

    return from_small.union(rows.groupBy("element", "i", "j").applyInPandas(tested, "a binary, b binary")).distinct()


def block_pairs(group: pd.DataFrame, one: np.ndarray, two: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of a large tile's rows that this tile passes on.

    Labels differ, sizes and bit counts allow a link, no smaller large element
    is shared, and enough first elements are.
    """
    element, n, lost = group["element"].iloc[0], group["n"].to_numpy(), group["lost"].to_numpy()
    label = pd.factorize(group["label"])[0]
    marks = group[[f"s{k}" for k in range(SIGNATURE)]].to_numpy().view(np.uint64)
    wide = np.frombuffer(b"".join(group["wide"]), np.uint64).reshape(len(group), -1)
    lists = {c: [np.asarray(x, np.int64) for x in group[c]] for c in ("large", "small")}
    out = []

    def shared(c: str, x: int, others: np.ndarray):
        """Per other row: how many of its elements x has, and the smallest of those."""
        mine, sizes = lists[c][x], np.array([len(lists[c][y]) for y in others])
        count, least = np.zeros(len(others), np.int64), np.full(len(others), np.iinfo(np.int64).max)
        full = sizes > 0
        if len(mine) and full.any():
            joined = np.concatenate([lists[c][y] for y in others[full]])
            at = np.minimum(np.searchsorted(mine, joined), len(mine) - 1)
            hit = mine[at] == joined
            starts = np.cumsum([0, *sizes[full][:-1]])
            count[full] = np.add.reduceat(hit.astype(np.int64), starts)
            least[full] = np.minimum.reduceat(np.where(hit, joined, np.iinfo(np.int64).max), starts)
        return count, least

    diagonal = one is two
    for x in one:
        ys = two[two > x] if diagonal else two
        ys = ys[(label[ys] != label[x]) & (100 * np.minimum(n[ys], n[x]) >= percent * np.maximum(n[ys], n[x]))]
        for bits in (marks, wide):
            if len(ys):
                mine = n[x] - np.bitwise_count(bits[x] & ~bits[ys]).sum(1, dtype=np.int64)
                other = n[ys] - np.bitwise_count(bits[ys] & ~bits[x]).sum(1, dtype=np.int64)
                ys = ys[(100 + percent) * np.minimum(mine, other) >= percent * (n[x] + n[ys])]
        if len(ys):
            count, least = shared("large", x, ys)
            ys, count = ys[least == element], count[least == element]
        if len(ys):
            count = count + shared("small", x, ys)[0]
            ys = ys[count >= least_shared(n[x], n[ys], percent) - np.minimum(lost[x], lost[ys])]
            out += [(x, y) for y in ys.tolist()]
    return out


def tile_links(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of two lists link: a boolean matrix.

    Sizes and bit counts rule pairs out before the sorted arrays are intersected.
    """
    out = np.zeros((len(left), len(right)), bool)
    if not left or not right:
        return out
    ls, rs = np.array([signature(x) for x in left]), np.array([signature(x) for x in right])
    rn = np.array([len(x) for x in right])
    for i, x in enumerate(left):
        mine = len(x) - np.bitwise_count(ls[i] & ~rs).sum(1, dtype=np.int64)
        other = rn - np.bitwise_count(rs & ~ls[i]).sum(1, dtype=np.int64)
        may = np.flatnonzero((100 + percent) * np.minimum(mine, other) >= percent * (len(x) + rn))
        if not len(may):
            continue
        joined = np.concatenate([right[j] for j in may])
        at = np.searchsorted(x, joined)
        at[at == len(x)] = 0
        starts = np.cumsum([0, *rn[may][:-1]])
        common = np.add.reduceat((x[at] == joined).astype(np.int64), starts)
        out[i, may] = (100 + percent) * common >= percent * (len(x) + rn[may])
    return out


def _link_counts(classes: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """(set, links): documents of other classes that a document of the class links with."""
    members = classes.join(arrays.select("set", "elements"), "set")
    # sizes that can link differ by one band at most
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    members = members.select("label", "set", "copies", "elements", band.alias("band"))
    sizes = materialize(members.groupBy("label", "band").agg(F.count(F.lit(1)).alias("_n"), F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("here")), "bands")
    hot = hot_among(sizes, ["label", "band"], HOT_ROWS)
    near = sizes.drop("_n")
    for name, shift in (("above", -1), ("below", 1)):
        near = near.join(sizes.select("label", (F.col("band") + shift).alias("band"), F.col("here").alias(name)), ["label", "band"], "left")
    members = salted_join(members, near, ["label", "band"], ["set"], hot)
    members = members.withColumn("own", F.pmod(F.xxhash64("set"), F.col("here")).cast("int"))

    def cells(count: str, band: Column, step: int, low, high, second) -> Column:
        """The tile pairs of a class with each tile of one band; none where the band has no tile."""
        tiles = F.sequence(F.lit(0), F.coalesce(F.col(count), F.lit(1)) - 1)
        every = F.transform(tiles, lambda j: F.struct(
            band.alias("band"), F.lit(step).alias("step"), low(j).alias("low"), high(j).alias("high"), second(j).alias("second")))
        return F.filter(every, lambda x: F.col(count).isNotNull())

    mine, same, other = F.col("own"), lambda j: F.col("own"), lambda j: j
    placed = F.concat(
        cells("here", F.col("band"), 0, lambda j: F.least(mine, j), lambda j: F.greatest(mine, j), lambda j: mine > j),
        cells("above", F.col("band"), 1, same, other, lambda j: F.lit(False)),
        cells("below", F.col("band") - 1, 1, other, same, lambda j: F.lit(True)),
    )
    spread = members.select("label", "set", "copies", "elements", F.explode(placed).alias("w")).select("label", "set", "copies", "elements", "w.*")

    def count(group: pd.DataFrame) -> pd.DataFrame:
        arrays_ = [np.frombuffer(x, np.uint64) for x in group["elements"]]
        copies = group["copies"].to_numpy()
        same = group["step"].iloc[0] == 0 and group["low"].iloc[0] == group["high"].iloc[0]
        second = group["second"].to_numpy() & (not same)
        one, two = (np.arange(len(group)),) * 2 if same else (np.flatnonzero(~second), np.flatnonzero(second))
        links = tile_links([arrays_[i] for i in one], [arrays_[i] for i in two], percent)
        total = np.zeros(len(group), np.int64)
        if same:
            np.fill_diagonal(links, False)
            total = links @ copies
        else:
            total[one], total[two] = links @ copies[two], links.T @ copies[one]
        return pd.DataFrame({"set": group["set"], "links": total})

    counted = spread.groupBy("label", "band", "step", "low", "high").applyInPandas(count, "set binary, links long")
    return counted.groupBy("set").agg(F.sum("links").alias("links"))


def jaccard_components(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: id, `n_shingles`, `component_id` (smallest id reachable by links), `n_links` (documents it links with)."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    sets = _sets(rows, width, percent)
    classes = materialize(
        sets.where("n > 0").groupBy("set").agg(
            F.min("id").alias("first_id"), F.first("n").alias("n"), F.first("half").alias("half"), F.max(F.size("keys")).alias("keys"), F.first("lost").alias("lost"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "classes",
    )
    tiles = _tiles(sets, classes, percent)
    sets = sets.drop("keys", "half", "lost")
    met = materialize(tiles.select("set").distinct().join(classes, "set"), "met")
    arrays = _arrays(rows, met, width)
    labels = _components(tiles, arrays, percent)
    grouped = labels.join(classes, "set")
    joined = grouped.groupBy("label").agg(F.min("first_id").alias("component"), F.count(F.lit(1)).alias("classes"))
    joined = materialize(joined.where("classes > 1"), "joined")
    hot = hot_among(joined.withColumnRenamed("classes", "_n"), ["label"], HOT_ROWS)
    placed = materialize(salted_join(grouped, joined, ["label"], ["set"], hot), "placed")
    counts = _link_counts(placed, arrays, percent)
    found = materialize(placed.join(counts, "set", "left").select("set", "component", "links"), "found")
    per_set = classes.join(found, "set", "left").select(
        "set", F.when(F.col("component").isNotNull(), F.col("component")).otherwise(F.col("first_id")).alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
    )
    return sets.join(per_set, "set", "left").select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def one_of_each_component(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows whose id is the smallest of their component, with the columns of `docs`.

    `id` names a document: rows that share an id stay or go together.
    """
    found = jaccard_components(docs, id, text, width, percent)
    gone = materialize(found.where(~F.col(id).eqNullSafe(F.col("component_id"))).select(F.col(id).alias("gone")).distinct(), "near_copies")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id].alias("id"))
    return rows.join(gone, F.col("id").eqNullSafe(F.col("gone")), "left_anti").select("row.*")
