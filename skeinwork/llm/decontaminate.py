"""Benchmark decontamination: documents that hold a benchmark item, whole or nearly so.

An index of the items' word n-grams finds what a document shares with each item.
A similarity asks for a least number of common n-grams, so an item is left out
where the document has fewer places that hold one of its n-grams: no hit is
lost. For the others, a window of the item's length is cut wherever a shared
n-gram lets the item begin (a window that shares none has similarity 0).
Windows with equal words are judged once.

Windows and items get a 64-bit SimHash of their words. It is cut into radius + 1
blocks: two fingerprints that differ in `radius` bits at most agree on a block,
so an index on (item size, block, value) finds every such pair. These pairs are
verified by the weighted Jaccard similarity of the word n-grams, a weight being
the times an n-gram occurs. A window that reaches the similarity differs from
the item in few words, and `RADIUS` is so wide that the exact check decides.
`radius=None` verifies every window that was cut, without fingerprints.

Everything is DataFrame functions. The n-grams of the items are a small table
as a rule; it is written first, so Spark broadcasts it only when it is below
its threshold, and shuffles otherwise.

Defined results: words are cut at blanks and control characters from tab to
carriage return, after lower-casing A-Z. An item with fewer than five words is
one n-gram of that length; an item without words, or null, is found nowhere. A
document shorter than an item is compared as a whole. Items with equal words
are all reported. Null ids are carried along; repeated rows of a document are
reported once. Empty tables give an empty result. Extra columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.session import materialize

WORDS = 5
PERCENT = 75
RADIUS = 24     # bits; windows that reach the similarity lie within it, see the README for figures


def word_list(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, r"[\x20\x09-\x0D]+"), "")


def _ngrams(words: Column, width: Column, make) -> Column:
    """`make(i)` for every start of an n-gram of that width; one start where there are fewer words."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - width, F.lit(0))), make)


def _hashed(words: Column, width: int) -> Column:
    return F.when(
        F.size(words) >= width,
        _ngrams(words, F.lit(width), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)])),
    )


def simhash(rows: DataFrame, key: str, words: str) -> DataFrame:
    """(key, print): per bit the sign of the sum over all words of +1 or -1."""
    hashed = rows.select(key, F.explode(words).alias("word")).select(key, F.xxhash64("word").alias("h"))
    bit = lambda b: F.getbit("h", F.lit(b))
    sums = hashed.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *[F.sum(bit(b).cast("int")).alias(f"b{b}") for b in range(64)])
    value = F.lit(0).cast("bigint")
    for b in range(64):
        value = value.bitwiseOR(F.when(2 * F.col(f"b{b}") > F.col("n"), F.shiftleft(F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint")))
    return sums.select(key, value.alias("print"))


def _blocks(prints: DataFrame, key: str, radius: int) -> DataFrame:
    """A row per block of a fingerprint."""
    edges = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    cut = [
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(f"{key}_print", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1 if hi - lo < 64 else -1)).alias("value"))
        for i, (lo, hi) in enumerate(zip(edges, edges[1:]))
    ]
    return prints.withColumnRenamed("print", f"{key}_print").withColumn("c", F.explode(F.array(*cut))).select("*", "c.*").drop("c")


def within_radius(windows: DataFrame, items: DataFrame, radius: int, by: tuple[str, ...] = ()) -> DataFrame:
    """(win, item): all pairs whose fingerprints differ in `radius` bits at most. Inputs: (win, print), (item, print).

    Both may have columns `by`; then only pairs that agree in them meet.
    """
    met = _blocks(windows, "win", radius).join(_blocks(items, "item", radius), [*by, "block", "value"])
    return met.where(F.bit_count(F.col("win_print").bitwiseXOR(F.col("item_print"))) <= radius).select("win", "item").distinct()


def _counted(rows: DataFrame, key: str, words: str, width: Column) -> DataFrame:
    """(key, width, gram, times)."""
    grams = _ngrams(F.col(words), F.col("width"), lambda i: F.array_join(F.slice(F.col(words), i + 1, F.col("width")), " "))
    return rows.select(key, words, width.alias("width")).select(key, "width", F.explode(grams).alias("gram")).groupBy(key, "width", "gram").agg(
        F.count(F.lit(1)).alias(f"{key}_times")
    )


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    width: int = WORDS, percent: int = PERCENT, radius: int | None = RADIUS,
) -> DataFrame:
    """Per document and item found: id, item id, `start` (first word of the best window; of equal ones the first that lines
    up with the item), `n_words`, `common` and `total` (weights of the n-grams in both and in either), `similarity`, and
    `text_key`, which tells texts with one id apart.
    """
    body = F.array_join("words", " ")
    listed = benchmark.select(F.col(item_id).alias("item_id"), word_list(F.col(item_text)).alias("words")).where(F.size("words") > 0)
    listed = materialize(listed.withColumn("item", F.unhex(F.md5(body))), "listed_items")
    items = materialize(
        listed.dropDuplicates(["item"]).select("item", "words", F.size("words").alias("size"), F.least(F.size("words"), F.lit(width)).alias("width")), "items"
    )
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("text_key"), word_list(F.col(text)).alias("words"))
    weight = lambda words, width: F.greatest(words - width, F.lit(0)) + 1     # n-grams of so many words
    starts = None
    for w in sorted(r["width"] for r in items.select("width").distinct().collect()):      # at most `width` numbers
        own = items.where(F.col("width") == w).select("item", "size", F.posexplode(_hashed(F.col("words"), w)).alias("offset", "gram"))
        grams = materialize(own.groupBy("item", "size", "gram").agg(F.collect_list("offset").alias("offsets")), "item_grams")
        held = rows.select("id", "text_key", F.size("words").alias("n"), F.posexplode(_hashed(F.col("words"), w)).alias("at", "gram"))
        met = held.join(grams.select("item", "size", "gram"), "gram")
        shared = met.groupBy("id", "text_key", "n", "item", "size").agg(F.collect_set(F.struct("at", "gram")).alias("spots"))
        # 100 common >= percent (window + item - common), and common is at most the number of places
        both = weight(F.least("size", "n"), F.lit(w)) + weight(F.col("size"), F.lit(w))
        shared = materialize(shared.where((100 + percent) * F.size("spots") >= percent * both), "shared")
        spots = shared.select("id", "text_key", "n", "item", F.explode("spots").alias("s")).select("id", "text_key", "n", "item", "s.at", "s.gram")
        lined = spots.join(grams, ["item", "gram"]).select("id", "text_key", "n", "item", "size", "at", F.explode("offsets").alias("offset"))
        begun = lined.select(
            "id", "text_key", "item", F.lit(w).alias("width"), "size",
            F.greatest(F.lit(0), F.least(F.col("at") - F.col("offset"), F.col("n") - F.col("size"))).alias("start"),
        )
        starts = begun if starts is None else starts.union(begun)
    if starts is None:
        starts = rows.select(
            "id", "text_key", F.lit(None).cast("binary").alias("item"), *[F.lit(0).alias(c) for c in ("width", "size", "start")]
        ).limit(0)
    # the short documents: fewer words than an n-gram of the item, compared as a whole, can only equal a shorter item's text
    wanted = materialize(
        starts.distinct().groupBy("id", "text_key").agg(F.collect_list(F.struct("item", "width", "size", "start")).alias("cuts")), "starts"
    )
    wanted = wanted.withColumnsRenamed({"id": "wanted_id", "text_key": "wanted_key"})
    chosen = rows.join(wanted, F.col("id").eqNullSafe(F.col("wanted_id")) & (F.col("text_key") == F.col("wanted_key")))
    cut = chosen.select("id", "text_key", "words", F.explode("cuts").alias("c")).select(
        "id", "text_key", "c.item", "c.width", "c.size", "c.start", F.slice("words", F.col("c.start") + 1, F.col("c.size")).alias("words")
    )
    windows = materialize(cut.withColumn("win", F.unhex(F.md5(body))), "windows").distinct()
    contents = materialize(windows.groupBy("win").agg(F.first("words").alias("words")), "window_words")
    pairs = materialize(windows.select("win", "item", "width", "size").distinct(), "cut_pairs")
    if radius is not None:
        # a window was cut to the size of an item: it meets items of that size
        cut_to = simhash(contents, "win", "words").join(pairs.select("win", "size").distinct(), "win")
        prints = simhash(items, "item", "words").join(items.select("item", "size"), "item")
        near = within_radius(materialize(cut_to, "window_prints"), materialize(prints, "item_prints"), radius, ("size",))
        pairs = materialize(pairs.join(near, ["win", "item"]), "pairs")
    pairs = pairs.drop("size")
    needed = pairs.select("win", "width").distinct().join(contents, "win")
    left = _counted(needed, "win", "words", F.col("width"))
    right = _counted(items, "item", "words", F.col("width"))
    both = pairs.join(left, ["win", "width"]).join(right, ["item", "width", "gram"])
    common = both.groupBy("win", "item").agg(F.sum(F.least("win_times", "item_times")).alias("common"))
    size = lambda rows, key: rows.select(key, F.size("words").alias(f"{key}_size"))
    judged = common.join(pairs, ["win", "item"]).join(size(contents, "win"), "win").join(size(items, "item"), "item")
    judged = judged.withColumn("total", weight(F.col("win_size"), F.col("width")) + weight(F.col("item_size"), F.col("width")) - F.col("common"))
    judged = judged.where(100 * F.col("common") >= percent * F.col("total"))
    hits = windows.join(judged.select("win", "item", "common", "total", F.col("win_size").alias("n_words")), ["win", "item"])
    best = F.max(F.struct((F.col("common") / F.col("total")).alias("similarity"), (-F.col("start")).alias("back"), "n_words", "common", "total"))
    found = materialize(hits.groupBy("id", "text_key", "item").agg(best.alias("x")), "hits")
    return found.join(listed.select("item", "item_id").distinct(), "item").select(
        F.col("id").alias("doc_id" if id == "item_id" else id), F.col("item_id").alias("item_id"), (-F.col("x.back")).alias("start"),
        F.col("x.n_words").alias("n_words"), F.col("x.common").alias("common"), F.col("x.total").alias("total"),
        F.col("x.similarity").alias("similarity"), "text_key",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows without a benchmark item, with the columns of `docs`."""
    hits = benchmark_hits(docs, benchmark, id, text, **how)
    hit = materialize(hits.select(F.col(id).alias("hit_id"), F.col("text_key").alias("hit_key")).distinct(), "hit_docs")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id].alias("id"), F.xxhash64(docs[text]).alias("key"))
    return rows.join(hit, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key")), "left_anti").select("row.*")
