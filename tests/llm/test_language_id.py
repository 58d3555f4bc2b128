import random
import zlib

from pyspark.sql import functions as F

from skeinwork.llm.language_id import MARGIN, PIECE, Classifier, drop_rejected, fit_dictionaries, is_held_out, predict_language, spelled

SCHEMA = "doc_id long, text string, lang string, language string, score int"
SF_DIR = "/root/testdata/sf0.01"


def test_folds(spark):
    got = spark.range(200).select("id", is_held_out(F.col("id")).alias("h"), is_held_out(F.col("id"), 1).alias("one")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) and r["one"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 1) for r in got)


def test_edges(spark):
    words = {"aa": "kato lemi suro pani ", "bb": "wexi dubo qyrt zolk "}
    data = [(i, words[x] * (2 + i % 5), x, "clash", 1) for i in range(60) for x in words]
    data += [(90, None, "aa", None, None), (91, "lost label", None, None, None), (92, "", "aa", None, None), (None, "kato suro", "aa", None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    dictionaries = fit_dictionaries(df)
    assert list(dictionaries) == ["aa", "bb"] and fit_dictionaries(df, docs=3)["aa"].count(b"kato") <= 3 * 6
    odd = [(1, "kato suro lemi pani kato", None, "k", 5), (2, None, "aa", "k", 5), (3, "12 ,.! \n_", "aa", "k", 5), (4, "", "bb", "k", 5),
           (None, "DUBO zolk, wexi! qyrt", "aa", "k", 5), (1, "kato suro lemi pani kato", None, "k", 5), (6, "wexi dubo " * 40_000, None, None, None)]
    got = predict_language(spark.createDataFrame(odd, SCHEMA), dictionaries, carry=["doc_id"]).select("row.doc_id", "language.*").collect()
    assert [r["lang_pred"] for r in got] == ["aa", "und", "und", "und", "bb", "aa", "bb"]
    assert all(0 <= r["score"] <= 1 for r in got) and [r["rejected"] for r in got] == [False, True, True, True, False, False, False]
    kept = drop_rejected(spark.createDataFrame(odd, SCHEMA), dictionaries)
    assert kept.columns == ["doc_id", "text", "lang", "language", "score"] and kept.count() == 4
    empty = spark.createDataFrame([], SCHEMA)
    assert predict_language(empty, dictionaries).count() == 0
    nothing = predict_language(spark.createDataFrame(odd, SCHEMA), fit_dictionaries(empty)).select("language.*").collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


def test_same_as_one_by_one():
    dictionaries = {"aa": spelled("kato lemi " * 20), "bb": spelled("wexi dubo " * 20)}
    classify = Classifier(dictionaries)
    assert classify("Kato! LEMI")[0] == "aa" and classify("dubo wexi")[0] == "bb" and classify("7")[0] == "und"


def test_the_margin_does_not_depend_on_the_length(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    held_out = is_held_out(F.col("doc_id"))
    classify = Classifier(fit_dictionaries(docs.where(~held_out)))
    prose = [r["text"] for r in docs.where(held_out & (F.col("lang") == "en") & (F.length("text") > 200)).orderBy("doc_id").collect()]
    # sentences of held-out prose in an order of their own each time, so that it varies
    rng, parts, size = random.Random(5), [], 0
    words = [w for t in prose for w in t.split()]
    while size < 10_000_000:
        at = rng.randrange(len(words) - 5)
        parts.append(" ".join(words[at : at + rng.randrange(1, 6)]))
        size += len(parts[-1]) + 1
    text = " ".join(parts)
    (lang, score), (_, short) = classify(text), classify(text[: PIECE // 2])
    assert lang == "en" and score >= 3 * MARGIN and score >= short / 3
    assert len(text) >= 10_000_000


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    held_out = is_held_out(F.col("doc_id"))
    found = predict_language(docs.where(held_out), fit_dictionaries(docs.where(~held_out)))
    right, n, rejected = found.agg(F.count_if(F.col("row.lang") == F.col("language.lang_pred")), F.count("*"), F.count_if("language.rejected")).first()
    assert right >= 0.97 * n and rejected <= 0.02 * n


def test_no_step_in_the_score_with_the_length():
    """A text that grows by a byte or two has about the same score, at 2,000 bytes as elsewhere."""
    rng = random.Random(2)
    words = {"aa": ["kato", "lemi", "suro", "pani", "mosa"], "bb": ["wexi", "dubo", "qyrt", "zolk", "kato"]}
    sample = lambda x, n: " ".join(rng.choice(words[x]) for _ in range(n))
    classify = Classifier({x: spelled(sample(x, 3000)) for x in words})
    text = sample("aa", 1000)
    scores = [classify(text[:n]) for n in range(1980, 2021)]
    assert {s[0] for s in scores} == {"aa"}
    assert max(abs(a[1] - b[1]) for a, b in zip(scores, scores[1:])) < 0.03


def test_numerals_are_no_letters(spark):
    classify = Classifier({"aa": spelled("kato lemi " * 20), "bb": spelled("wexi dubo " * 20)})
    for text in ("½", "² ³", "Ⅷ ①", "٣", "½ 12 _"):
        assert not any(c.isalpha() for c in text) and classify(text) == ("und", 0.0)
    assert spelled("x²y ½kato") == b" x y kato " and spelled("日本 été ª") == " 日本 été ª ".encode()


def test_a_dirty_label_column(spark):
    """10,000 labels: the most frequent ones are learned, the driver holds no more."""
    rows = [(i, f"word{i} of its own", f"junk{i:05}", None, None) for i in range(10_000)]
    rows += [(20_000 + i, "kato lemi suro", "aa", None, None) for i in range(5)] + [(30_000 + i, "wexi dubo", "bb", None, None) for i in range(5)]
    dictionaries = fit_dictionaries(spark.createDataFrame(rows, SCHEMA), languages=4)
    assert list(dictionaries) == ["aa", "bb", "junk00000", "junk00001"]
