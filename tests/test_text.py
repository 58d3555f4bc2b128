from pyspark.sql import functions as F

from skeinwork.functions import text, titles
from skeinwork.functions.langname import with_language_name
from skeinwork.operators.totals import lang_totals


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first()["c"]


def test_separators(spark):
    assert one(spark, text.before_first(F.lit("fr.co.x"), ".")) == "fr"
    assert one(spark, text.before_first(F.lit("fr"), ".")) == "fr"
    assert one(spark, text.after_first(F.lit("SN:chr1:b"), ":")) == "chr1:b"
    assert one(spark, text.after_first(F.lit("none"), ":")) == ""


def test_clean_tweet(spark):
    message = "x RT @Zoé: see https://a.b/c now\nRT @bob1 http://q"
    assert one(spark, text.clean_tweet(F.lit(message))) == "x  : see now\nRT 1 "
    assert one(spark, text.one_line(F.lit("a\r\nb\nc"))) == "a  b c"


def test_script_override(spark):
    cases = [("lt", "ひ", "ja"), ("lt", "한", "ko"), ("lt", "ひ한", "ja"), ("en", "ひ", "en"), ("lt", "abc", "lt")]
    df = spark.createDataFrame(cases, "lang string, text string, want string")
    got = df.withColumn("got", text.script_override(F.col("lang"), F.col("text")))
    assert got.where("got <> want").count() == 0


def test_titles(spark):
    cases = [
        ("Film X (2012)  [Bob]  <3>", "Film X (2012)", "2012"),
        ("Y (sub) (2014/II) (TV)", "Y (sub) (2014/II)", "2014"),
        ("Z (????)\n", "Z (????)", "????"),
        ("no year", "", ""),
        ("(abc) none", "", ""),
    ]
    df = spark.createDataFrame(cases, "raw string, movie string, year string")
    got = df.select(titles.title_key(F.col("raw")).alias("m"), titles.title_year(titles.title_key(F.col("raw"))).alias("y"), "movie", "year")
    assert all(r["m"] == r["movie"] and r["y"] == r["year"] for r in got.collect())


def test_language_names(spark, rows):
    df = spark.createDataFrame([("fr",), ("ZZ",), ("iw",), ("English",), ("WAR",), ("ceb",), (None,)], "code string")
    want = [("English", "english"), ("WAR", "Waray"), ("ZZ", "zz"), ("ceb", "Cebuano"), ("fr", "French"), ("iw", "Hebrew"), (None, None)]
    assert rows(with_language_name(df, "code", "name")) == want


def test_percent_of_nothing_is_null(spark):
    assert one(spark, text.percent(F.lit(1), F.lit(0))) is None
    assert one(spark, text.percent(F.lit(1), F.lit(8))) == 12.5


def test_totals_do_not_depend_on_partitions(spark, rows):
    data = [("fr", "Accueil", 120), ("fr", "Tour", 120), ("fr", "fr", 700), ("zz", "Only", 5), ("de", "de", 9)]
    df = spark.createDataFrame(data, "code string, title string, views bigint")
    want = [("French", "fr", 240, "Tour", 120), ("zz", "zz", 5, "Only", 5)]
    assert rows(lang_totals(df.repartition(1))) == want
    assert rows(lang_totals(df.repartition(8))) == want
    assert len(rows(lang_totals(df, exclude_self=False))) == 3
    untitled = df.unionByName(spark.createDataFrame([("zz", None, 9)], df.schema))
    assert rows(lang_totals(untitled)) == [("French", "fr", 240, "Tour", 120), ("zz", "zz", 14, None, 9)]
