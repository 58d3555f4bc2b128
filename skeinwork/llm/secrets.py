"""Secret scan: candidates by pattern, false positives removed by a random forest.

A candidate is a run of 16 or more characters that tokens and keys are made of,
or a value of 8 or more characters that is assigned to a word which announces a
credential (`password = "..."`, `token:...`), whatever characters it has.
Its features are: length; shares of digits, capitals and other characters, and
how often the kind of character changes; how surprising its characters are one
after another, under the transitions of the corpus's words; how many of its
letter trigrams occur in words of the corpus, and how much of it is such words;
marks of the path; and the words around it, hashed, with marks for words that
announce a credential and for an assignment.

The forest is fitted on labelled findings, of which at most `LABELLED` per label
are used, the first in the order of a hash. The words of the dictionary are
counted over all texts. Every candidate of every text is scored.

`weak_labels` labels findings where no one has, by two views that must agree:
what stands around a value (an announcing word and an assignment, or neither),
and the value itself (mixed characters that are no words, or words and numbers).
The forest sees more than either view has, so it can find formats that no label had.

Defined results: a null or empty text has no candidates, a null path is an empty
path. A candidate is reported where it occurs, so repeated rows are reported
repeatedly, and equal values in one word each have their own surroundings. A
score equal to the threshold is a secret. A value of any length is one candidate,
and a text of any length is read whole. Without labels of both kinds there is nothing to learn: every
candidate gets the share of secrets among the labels, 0 without labels. Empty
tables give an empty result. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.session import materialize, scratch_path

CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
SPACE = r"[\x20\x09-\x0D]+"
LABELLED = 10_000           # labelled findings per label that the forest sees
DICTIONARY_COUNT = 5        # times a word must occur to count as a word
THRESHOLD = 0.5
ANNOUNCE = r"(?i)token|secret|passw|pwd|api.?key|apikey|auth|bearer|credential|private"
# formats of well-known credentials: fixed values
FORMATS = r"^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{10,}.*)$"
ASSIGNED = 8                # characters of an assigned value, at least
CLASSES = 64                # characters that may follow one another, for smoothing the transitions
_NUMBERS = ["length", "digits", "capitals", "others", "changes", "surprise", "coverage", "known_words", "announced", "assigned", "quoted", "config_path", "test_path", "depth"]
_NEIGHBOURS = ["before2", "before1", "after1"]


def _count(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern))


_INLINE = ANNOUNCE.replace("(?i)", r"(?i)(?:", 1) + r""")[^\s=:]*[=:]+["'`]?([^\s"'`]{%d,})""" % ASSIGNED
_OPEN = ANNOUNCE.replace("(?i)", r"(?i)(?:", 1) + r""")[^\s]*[=:]["'`]?$"""
_NAME = ANNOUNCE.replace("(?i)", r"(?i)(?:", 1) + r""")[^\s=:]*["'`]?$"""
_BARE = r"""^["'`(]*([^\s"'`]{%d,}?)["'`),.;]*$""" % ASSIGNED


def candidates(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """A row per candidate: id, `word_no`, `nth` (in the word), `value`, `before2`, `before1`, `after1`, `path`, the `word`, and what stands `before` it there.

    An assigned value comes after the runs of its word, of which some may lie inside it.
    """
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), F.col(text).alias("text"))
    words = rows.where(F.col("text").rlike(CANDIDATE) | F.col("text").rlike(ANNOUNCE)).select("id", "path", F.split("text", SPACE).alias("w"))
    word = lambda i: F.coalesce(F.get("w", i), F.lit(""))
    # the word before ends in an assignment to an announcing word, or is one and that word stands before it
    opened = lambda i: word(i - 1).rlike(_OPEN) | (word(i - 1).isin("=", ":", ":=") & word(i - 2).rlike(_NAME))
    assigned = lambda x, i: F.when(x.rlike(_INLINE), F.regexp_extract(x, _INLINE, 1)).when(opened(i) & x.rlike(_BARE), F.regexp_extract(x, _BARE, 1)).otherwise("")
    spots = F.filter(
        F.transform("w", lambda x, i: F.struct(i.alias("word_no"), x.alias("word"), F.when(F.length(x) >= ASSIGNED, assigned(x, i)).otherwise("").alias("assigned"))),
        lambda s: s["word"].rlike(CANDIDATE) | (s["assigned"] != ""),
    )
    around = words.select("w", "id", "path", F.explode(spots).alias("c")).select(
        "id", "path", "c.*", *[F.coalesce(F.get("w", F.col("c.word_no") + d), F.lit("")).alias(n) for n, d in (("before2", -2), ("before1", -1), ("after1", 1))]
    )
    runs = F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(0))
    between = F.split("word", CANDIDATE)
    own = F.transform(runs, lambda v, n: F.struct(v.alias("value"), F.array_join(F.slice(between, 1, n + 1), " ").alias("before")))
    # an assigned value that is the word's only run is that run; substring_index with -1 gives what stands after it
    given = F.when((F.col("assigned") != "") & ~F.coalesce((F.size(runs) == 1) & (F.get(runs, F.lit(0)) == F.col("assigned")), F.lit(False)), F.array(F.struct(
        F.col("assigned").alias("value"), F.expr("left(word, length(word) - length(substring_index(word, assigned, -1)) - length(assigned))").alias("before"))))
    values = F.when(given.isNull(), own).otherwise(F.concat(own, given))
    found = around.select("*", F.posexplode(values).alias("nth", "x")).select("*", "x.value", "x.before")
    # neighbours without their punctuation
    plain = [F.regexp_replace(F.lower(n), r"[^\p{L}\p{N}_=:]+", "").alias(n) for n in _NEIGHBOURS]
    return found.select("id", "path", "word_no", "nth", "value", "word", "before", *plain)


def dictionary_words(docs: DataFrame, text: str = "text", count: int = DICTIONARY_COUNT) -> DataFrame:
    """(word, n): the words of three letters or more that occur `count` times in the corpus. Counts combine before the shuffle."""
    words = docs.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word")).where(F.length("word") >= 3)
    return materialize(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= count), "dictionary_words")


def dictionary_trigrams(docs: DataFrame, text: str = "text", count: int = DICTIONARY_COUNT, words: DataFrame | None = None) -> DataFrame:
    """Distinct letter trigrams (`gram`) of the dictionary's words."""
    words = dictionary_words(docs, text, count) if words is None else words
    return materialize(words.select(F.explode(_pieces(F.col("word"), 3)).alias("gram")).distinct(), "dictionary")


def transitions(words: DataFrame) -> DataFrame:
    """(pair, cost): -log10 of the probability that a character follows another in the dictionary's words, each as often as it occurs.

    At most one row per pair of letters that occurs; a pair that does not costs `UNSEEN`.
    """
    pairs = words.select("n", F.explode(_pieces(F.col("word"), 2)).alias("pair")).groupBy("pair").agg(F.sum("n").alias("n"))
    first = pairs.groupBy(F.substring("pair", 1, 1).alias("first")).agg(F.sum("n").alias("all"))
    rows = pairs.join(first, F.substring("pair", 1, 1) == F.col("first"))
    return materialize(rows.select("pair", (-F.log10((F.col("n") + 0.5) / (F.col("all") + 0.5 * CLASSES))).alias("cost")), "transitions")


UNSEEN = 6.0        # cost of a pair of characters that no word has


def _pieces(letters: Column, size: int) -> Column:
    """All pieces of that many characters; none of a shorter text."""
    starts = F.when(F.length(letters) >= size, F.sequence(F.lit(1), F.length(letters) - (size - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substr(letters, i, F.lit(size)))


def _per_value(found: DataFrame, grams: DataFrame, words: DataFrame | None, pairs: DataFrame | None) -> DataFrame:
    """(value, coverage, known_words, surprise), once per distinct value."""
    value = F.col("value")
    values = materialize(found.select("value").distinct(), "values")
    letters = F.regexp_replace(F.lower(value), "[^a-z]+", "")
    met = values.select("value", F.explode(_pieces(letters, 3)).alias("gram")).join(grams.withColumn("known", F.lit(1)), "gram", "left")
    out = values.join(met.groupBy("value").agg((F.coalesce(F.sum("known"), F.lit(0)) / F.count(F.lit(1))).alias("coverage")), "value", "left")
    if words is not None:
        parts = F.transform(F.regexp_extract_all("value", F.lit(r"\p{Lu}?\p{Ll}+|\p{Lu}+"), F.lit(0)), lambda p: F.lower(p))
        met = values.select("value", F.explode(parts).alias("word")).join(words.select("word"), "word")
        share = (F.sum(F.length("word")) / F.length(F.first("value"))).alias("known_words")
        out = out.join(met.groupBy("value").agg(share), "value", "left")
    if pairs is not None:
        spelled = F.regexp_replace(F.regexp_replace(F.lower(value), "[0-9]", "0"), r"[^\p{L}0]", "_")
        met = values.select("value", F.explode(_pieces(spelled, 2)).alias("pair")).join(pairs, "pair", "left")
        out = out.join(met.groupBy("value").agg(F.avg(F.coalesce("cost", F.lit(UNSEEN))).alias("surprise")), "value", "left")
    for name in ("known_words", "surprise"):
        out = out if name in out.columns else out.withColumn(name, F.lit(0.0))
    return materialize(out.na.fill(0.0, ["coverage", "known_words", "surprise"]), "of_values")     # the join back can then be split at a value that occurs often


def featured(found: DataFrame, grams: DataFrame, words: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """Candidates with numeric features. `words` and `pairs` are those of `dictionary_words` and `transitions`; 0 without them."""
    value, before = F.col("value"), F.col("before")
    share = lambda pattern: _count(value, pattern) / F.length(value)
    kinds = ["a-z", "A-Z", "0-9", "+/_=-"]
    changes = "|".join(f"(?<=[{k}])(?=[^{k}])" for k in kinds)
    marks = found.join(_per_value(found, grams, words, pairs), "value", "left")
    flag = lambda c: c.cast("double")
    return marks.select(
        *found.columns, "coverage", "known_words", "surprise",
        F.length(value).cast("double").alias("length"), share("[0-9]").alias("digits"), share("[A-Z]").alias("capitals"), share("[+/_=-]").alias("others"),
        ((_count(value, changes)) / F.greatest(F.length(value) - 1, F.lit(1))).alias("changes"),
        flag(F.concat_ws(" ", "before2", "before1", before).rlike(ANNOUNCE)).alias("announced"),
        flag(F.col("before1").rlike("[=:]$") | before.rlike(r"[=:]")).alias("assigned"), flag(before.rlike("[\"'`]$")).alias("quoted"),
        flag(F.col("path").rlike(r"(?i)\.(?:env|cfg|conf|ini|ya?ml|json|toml|pem|properties)$")).alias("config_path"),
        flag(F.col("path").rlike("(?i)test|example|sample|docs?/")).alias("test_path"), _count(F.col("path"), "/").cast("double").alias("depth"),
    )


def weak_labels(rows: DataFrame, formats: str = FORMATS) -> DataFrame:
    """Adds `label` (1.0 secret, 0.0 not) to the findings on which two views agree, and keeps those.

    The views: what stands around the value, and the value itself. A value of a
    known format counts as mixed characters; words and numbers are no secrets
    whatever stands around them.
    """
    plain = F.col("value").rlike(r"^[\p{L}_-]+$|^[0-9-]+$") | (F.col("known_words") >= 0.6)
    mixed = F.col("value").rlike(formats) | ((F.col("changes") >= 0.15) & ~plain)
    around = (F.col("announced") > 0) & (F.col("assigned") > 0)
    label = F.when(around & mixed, 1.0).when(plain & (F.col("value").rlike(formats) == F.lit(False)), 0.0).when((F.col("announced") == 0) & ~mixed, 0.0)
    return rows.withColumn("label", label).where("label is not null")


class Forest:
    """Scores candidates; constant where the labels are all alike."""

    def __init__(self, labelled: DataFrame, limit: int = LABELLED, trees: int = 24, depth: int = 7, seed: int = 7):
        first = [
            labelled.where(F.col("label") == kind).orderBy(F.xxhash64("value", "id", "word_no"), "value", "id", "word_no", "nth").limit(limit)
            for kind in (0.0, 1.0)
        ]
        sample = materialize(first[0].union(first[1]).select("label", *_NUMBERS, *_NEIGHBOURS), "labelled")
        counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
        self.constant, self.model = counts.get(1.0, 0) / max(1, sum(counts.values())), None
        if len(counts) == 2:
            hashed = FeatureHasher(inputCols=_NEIGHBOURS, outputCol="neighbours", numFeatures=128)
            together = VectorAssembler(inputCols=[*_NUMBERS, "neighbours"], outputCol="features")
            forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.7)
            fitted = Pipeline(stages=[hashed, together, forest]).fit(sample.repartition(1).sortWithinPartitions(*sample.columns))
            # written and read: a fitted forest holds its training summary and with it the session, which cannot go to the tasks
            path = scratch_path(labelled.sparkSession, "forest")
            fitted.write().save(path)
            self.model = PipelineModel.load(path)

    def __call__(self, rows: DataFrame) -> DataFrame:
        if self.model is None:
            return rows.withColumn("score", F.lit(float(self.constant)))
        return self.model.transform(rows).withColumn("score", vector_to_array("probability")[1])


def scan_secrets(
    docs: DataFrame, learn: Column, id: str = "doc_id", text: str = "text", path: str = "source",
    labels=weak_labels, limit: int = LABELLED, threshold: float = THRESHOLD,
) -> DataFrame:
    """Per candidate: id, `word_no`, `nth`, `value`, `score` (0 to 1) and `secret`.

    `learn` says of which rows (by id) labels may be used; `labels` adds them to featured candidates.
    """
    words = dictionary_words(docs, text)
    spotted = materialize(candidates(docs, id, text, path), "candidates")
    found = materialize(featured(spotted, dictionary_trigrams(docs, text, words=words), words, transitions(words)), "featured")
    forest = Forest(labels(found.withColumnRenamed("id", id).where(learn).withColumnRenamed(id, "id")), limit)
    return forest(found).select(
        F.col("id").alias(id), "word_no", "nth", "value", "score", (F.col("score") >= threshold).alias("secret")
    )
