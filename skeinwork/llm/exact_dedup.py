"""Exact duplicates: one row per text stays.

Rows are grouped by a 128-bit hash of the whole text; inside a hash group the
bytes themselves are compared, so two texts that share a hash stay apart. Only
rows whose hash occurs twice carry their text on: a corpus without copies moves
16 bytes and the id per row.

Defined results: a null text counts as the empty text. The row with the largest
id of a text stays (null ids rank below all others). Rows that repeat both id
and text are one document: `exact_dedup` marks all of them alike, and
`drop_copies` returns one of them. A very long text moves as 16 bytes unless its
hash occurs twice; then one copy per task does. An empty table gives an empty
result. Extra columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.session import materialize


def content_hash(body: Column) -> Column:
    """The 128-bit hash that brings equal texts together."""
    return F.unhex(F.md5(body.cast("binary")))


def _keyed(docs: DataFrame, id: str, text: str, hash_of: Callable[[Column], Column], *more: Column) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(id).alias("id"), hash_of(body).alias("key"), F.sha2(body.cast("binary"), 256).alias("sha"), body.alias("body"), *more
    )


def _grouped(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a hash of their own, and the others next to keeper and size of their text.

    Copies are combined before the shuffle, so a text that makes up any share of
    the rows reaches a task once per task that has read it.
    """
    shared = materialize(
        rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "shared_hashes"
    )
    members = materialize(rows.join(shared, "key", "left_semi"), "shared_rows")
    texts = materialize(
        members.groupBy("key", "sha", "body").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("size")), "texts"
    )
    return rows.join(shared, "key", "left_anti"), members.join(texts, ["key", "sha", "body"])


def exact_dedup(
    docs: DataFrame, id: str = "doc_id", text: str = "text", hash_of: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """Per row: id, `keep_id`, `group_size`, `kept`, `text_sha256` (lowercase hex of the UTF-8 text)."""
    single, copies = _grouped(_keyed(docs, id, text, hash_of))
    alone = single.select(
        F.col("id").alias(id), F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"),
    )
    grouped = copies.select(
        F.col("id").alias(id), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"), F.col("sha").alias("text_sha256"),
    )
    return alone.unionByName(grouped)


def drop_copies(
    docs: DataFrame, id: str = "doc_id", text: str = "text", hash_of: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """The rows that stay, with the columns of `docs`."""
    single, copies = _grouped(_keyed(docs, id, text, hash_of, F.struct(*[docs[c] for c in docs.columns]).alias("row")))
    keepers = copies.where(F.col("id").eqNullSafe(F.col("keep"))).dropDuplicates(["key", "sha", "body", "id"])
    return single.select("row.*").unionByName(keepers.select("row.*"))
