"""From raw documents to token counts of clean ones, stage by stage.

Each stage works on all that the stage before kept; its result is written and
read again. All but the last return the columns of the documents.

Defined results: null and empty texts, and texts without a letter, have no
language and leave in the first stage; a null language label teaches nothing. Of
equal texts the row with the largest id stays, of linked ones that with the
smallest; rows that share id and text are one document, and a null id stands
below all others. Texts of any length pass every stage whole. An empty table
passes all stages. Extra columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.catalog.registry import query, table
from skeinwork.llm.bpe import bpe_digests
from skeinwork.llm.catalog import pattern, vocabulary
from skeinwork.llm.decontaminate import drop_contaminated
from skeinwork.llm.exact_dedup import drop_copies
from skeinwork.llm.language_id import drop_rejected, fit_dictionaries, is_held_out
from skeinwork.llm.ngram_join import one_of_each_component
from skeinwork.session import materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; null and letterless texts go."""
    return drop_rejected(docs, fit_dictionaries(docs.where(~is_held_out(F.col("doc_id")))))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, the one with the smallest id."""
    return one_of_each_component(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: number of tokens, and digests of its ids and of the text decoded from them."""
    return bpe_digests(docs, vocabulary("byte_bpe_multi_50k.tiktoken"), pattern(), parts=PARTS)


# parts that a worker of the last stage keeps encoded: the workers of the stages before it are there, too
PARTS = 400_000

STAGES = [
    ("language", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("bpe", encoded),
]

# dictionaries, merges and fingerprints are not expressible in SQL
ORACLE_SQL = None


BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
# texts that a stage hands to a worker at once; a bound on memory outside the heap, in the executor and in the workers
TEXTS_AT_ONCE = {"bpe": 1000}


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with batches_of(spark, TEXTS_AT_ONCE.get(name)):
            docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs


@contextmanager
def batches_of(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Inside, Arrow batches of at most so many rows; the session's own number is put back."""
    own = spark.conf.get(BATCH_CONF)
    if rows is None or 0 < int(own) <= rows:
        yield
        return
    spark.conf.set(BATCH_CONF, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, own)


@query(ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
