"""Language identification from character trigrams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.operators.skew import spread
from skeinwork.session import materialize

WIDE = 32       # languages up to which each has a column of weights


def normalized(text: Column) -> Column:
    """Lower case, every run of non-letters one blank, blanks at both ends."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")), F.lit(" "))


def trigrams(text: Column) -> Column:
    """All trigrams of the normalised text, in order of occurrence.

    A look-ahead that captures three characters matches at every position, so
    the text is walked once.
    """
    return F.regexp_extract_all(normalized(text), F.lit("(?s)(?=(...))"), F.lit(1))


def build_profiles(df: DataFrame, text: str, lang: str) -> DataFrame:
    """Profile table (gram, lang, weight): trigram counts of labelled text, scaled to length 1.

    Counting combines on the map side; the table is a model and is written once.
    Rows without a label teach nothing.
    """
    counts = materialize(
        spread(df.select(lang, text).where(F.col(lang).isNotNull()))
        .select(F.col(lang).alias("lang"), F.explode(trigrams(F.col(text))).alias("gram"))
        .groupBy("lang", "gram")
        .agg(F.count(F.lit(1)).alias("n")),
        "profile_counts",
    )
    # one row per language
    norms = counts.groupBy("lang").agg(F.sqrt(F.sum(F.col("n").cast("double") * F.col("n"))).alias("_norm"))
    return counts.join(norms, "lang").select("gram", "lang", (F.col("n") / F.col("_norm")).alias("weight"))


def detect_lang(df: DataFrame, id: str | list[str], text: str, profiles: DataFrame) -> DataFrame:
    """(id, detected, score): the language whose profile has the largest mean weight
    over the trigrams of the text that any profile knows; NULL when none is known.

    `id` (one column or several) must be unique. The profile table becomes one
    row per trigram. It is written, so Spark knows its bytes: below the broadcast
    threshold a text shrinks to one row before the only shuffle, beyond it the
    trigrams are joined in a shuffle whose hot ones Spark splits. Up to `WIDE`
    languages have a column of weights each, summed side by side; more of them
    are a list per trigram, and a row per trigram and language.
    """
    keys = [id] if isinstance(id, str) else list(id)
    langs = sorted(r["lang"] for r in profiles.select("lang").distinct().limit(WIDE + 1).collect())
    if len(langs) > WIDE:
        return _detect_many(df, keys, text, profiles)
    weights = [F.max(F.when(F.col("lang") == lang, F.col("weight"))).alias(f"_w{i}") for i, lang in enumerate(langs)]
    model = materialize(profiles.groupBy("gram").agg(F.lit(1).alias("_in"), *weights), "profile")
    sums = _grams(df, keys, text).join(model, "gram", "left").groupBy(*keys).agg(
        F.count("_in").alias("_grams"), *[F.sum(f"_w{i}").alias(f"_s{i}") for i in range(len(langs))]
    )
    no_language = F.struct(F.lit(None).cast("double").alias("s"), F.lit(None).cast("string").alias("lang"))
    of_each = [F.struct(F.col(f"_s{i}").alias("s"), F.lit(lang).alias("lang")) for i, lang in enumerate(langs)]
    return _best(sums.withColumn("_best", F.array_max(F.array(no_language, *of_each))), keys)


def _grams(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    return spread(df.select(*keys, text)).select(*keys, F.explode_outer(trigrams(F.col(text))).alias("gram"))


def _best(scored: DataFrame, keys: list[str]) -> DataFrame:
    known = F.col("_best.s") > 0
    return scored.select(
        *keys, F.when(known, F.col("_best.lang")).alias("detected"), F.when(known, F.col("_best.s") / F.col("_grams")).alias("score")
    )


def _detect_many(df: DataFrame, keys: list[str], text: str, profiles: DataFrame) -> DataFrame:
    model = materialize(profiles.groupBy("gram").agg(F.collect_list(F.struct("lang", "weight")).alias("_of")), "profile")
    weighted = _grams(df, keys, text).join(model, "gram", "left").select(*keys, F.posexplode_outer("_of").alias("_nth", "_of"))
    sums = weighted.groupBy(*keys, F.col("_of.lang").alias("_lang")).agg(
        F.sum("_of.weight").alias("_sum"), F.count_if(F.col("_nth") == 0).alias("_known")
    )
    scored = sums.groupBy(*keys).agg(F.max(F.struct(F.col("_sum").alias("s"), F.col("_lang").alias("lang"))).alias("_best"), F.sum("_known").alias("_grams"))
    return _best(scored, keys)
