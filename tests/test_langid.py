import pytest
from pyspark.sql import functions as F

from skeinwork.operators import langid

TEXTS = [
    (1, "the cat and the dog and the other thing", "en"), (2, "there is nothing in the house", "en"),
    (3, "le chat et le chien dans la maison", "fr"), (4, "il n'y a rien dans la rue", "fr"),
    (5, "der hund und die katze in dem haus", "de"), (6, "nicht auf der straße", "de"),
]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame(TEXTS, "id int, text string, lang string")
    return docs, langid.build_profiles(docs, "text", "lang")


def test_profiles_have_length_one(model):
    _, profiles = model
    for r in profiles.groupBy("lang").agg(F.sum(F.col("weight") ** 2).alias("n")).collect():
        assert abs(r["n"] - 1) < 1e-9


def test_same_answer_on_both_paths(spark, rows, model):
    docs, profiles = model
    more = docs.select("id", "text").unionByName(spark.createDataFrame([(7, "12 !!"), (8, ""), (9, "zq"), (10, None)], "id int, text string"))
    broadcast = langid.detect_lang(more, "id", "text", profiles)
    found = {r["id"]: r["detected"] for r in broadcast.collect()}
    assert found == {**{i: lang for i, _, lang in TEXTS}, 7: None, 8: None, 9: None, 10: None}
    rounded = lambda df: rows(df.withColumn("score", F.round("score", 9)))
    want = rounded(broadcast)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rounded(langid.detect_lang(more, "id", "text", profiles)) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_columns_and_lists_give_the_same(spark, rows, model, monkeypatch):
    docs, profiles = model
    more = docs.select("id", "text").unionByName(spark.createDataFrame([(7, "12 !!"), (9, "zq"), (10, None)], "id int, text string"))
    rounded = lambda df: rows(df.withColumn("score", F.round("score", 9)))
    wide = rounded(langid.detect_lang(more, "id", "text", profiles))
    monkeypatch.setattr(langid, "WIDE", 2)
    assert rounded(langid.detect_lang(more, "id", "text", profiles)) == wide
    monkeypatch.setattr(langid, "WIDE", 32)
    assert {r["detected"] for r in langid.detect_lang(more, "id", "text", profiles.limit(0)).collect()} == {None}


def test_any_number_of_languages(spark):
    """A word of its own for each of 300 languages; rows without a label teach nothing."""
    word = lambda i: "".join(chr(97 + i // 26**k % 26) * 3 for k in range(3))
    docs = spark.createDataFrame([(i, word(i), f"l{i:03}") for i in range(300)] + [(999, word(5), None)], "id int, text string, lang string")
    found = langid.detect_lang(docs, "id", "text", langid.build_profiles(docs, "text", "lang"))
    got = {r["id"]: r["detected"] for r in found.collect()}
    assert sum(got[i] == f"l{i:03}" for i in range(300)) == 300 and got[999] == "l005"
