"""Language identification by compression.

Per language, labelled texts make up a raw-content zstandard dictionary. A text
is compressed once with each dictionary; the smallest result names the
language. A long text is cut into pieces of near equal size that cover all of
it, each is compressed with the dictionary, and the sizes are added: what a
dictionary saves then grows with the text, as its size does. When the runner-up is nearly as small, the text is rejected. Only the
words count: letters in lower case, one blank between them.

The dictionaries are a classifier fitted on a bounded sample: `DOCS_PER_LANGUAGE`
texts of at most `LONGEST_SAMPLE` characters per language, the first in the
order of a hash of their id, and `DICTIONARY_BYTES` per language, for at most
`LANGUAGES` languages. Labels are not used for anything else; every text is
scored whole.

Defined results: a null text, or one without a letter, is `und` with score 0
and counts as rejected. Equal sizes go to the alphabetically first language,
with score 0. Rows without a label or text teach nothing; without any labelled
row every text is `und`. Repeated rows give repeated rows; an empty table gives
an empty result. Extra columns are not read, and `drop_rejected` returns them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinwork.llm.worker import kept

DOCS_PER_LANGUAGE = 96
LONGEST_SAMPLE = 20_000
DICTIONARY_BYTES = 65_536
LANGUAGES = 256     # languages learned at most: those with the most labelled texts
LEVEL = 9           # of compression, for texts of any length
PIECE = 131_072     # bytes that are compressed at once, at most
MARGIN = 0.003      # share of the runner-up's size that the winner must save
UNKNOWN = "und"


def is_held_out(id: Column, rest: int = 0, folds: int = 5) -> Column:
    """Whether the checksum of the id as text leaves `rest` modulo `folds`; false for a null id."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % folds == rest, F.lit(False))


def fit_dictionaries(
    labelled: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang",
    docs: int = DOCS_PER_LANGUAGE, longest: int = LONGEST_SAMPLE, size: int = DICTIONARY_BYTES, languages: int = LANGUAGES,
) -> dict[str, bytes]:
    """Dictionary content per language; the driver receives at most `docs` texts of each of at most `languages` languages.

    A label column with more values than that is taken for dirty: the most frequent ones are learned (of equally frequent ones the first by name).
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(id), F.col(text)).alias("h"))
    rows = rows.where("lang is not null and length(trim(text)) > 0").where(F.length("text") <= longest)
    often = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    rows = rows.join(F.broadcast(often.select("lang")), "lang", "left_semi")        # `languages` rows
    # the rank limit is applied before the shuffle too, so a language with most of the rows sends `docs` of them per task
    first = rows.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("r") <= docs)
    texts: dict[str, list[bytes]] = {}
    for row in sorted(first.select("lang", "r", "text").collect()):
        texts.setdefault(row["lang"], []).append(spelled(row["text"]))
    return {name: b"".join(dict.fromkeys(parts))[:size] for name, parts in sorted(texts.items())}


_WORD = re.compile(r"[^\W\d_]+")
# numbers that are no decimal digits (½ ² Ⅷ ①) count as word characters in the pattern, but are no letters
_LETTERLESS = re.compile("[" + "".join(c for c in map(chr, range(0x110000)) if _WORD.match(c) and not c.isalpha()) + "]+")


def spelled(text: str) -> bytes:
    """The words of a text, in lower case, with one blank before and after each."""
    found = _WORD.findall(text.lower())
    if found and not "".join(found).isalpha():
        found = _WORD.findall(_LETTERLESS.sub(" ", text.lower()))
    return f" {' '.join(found)} ".encode()


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard as z

        self.names = list(dictionaries)
        self.compressors = []
        for content in dictionaries.values():
            content = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.compressors.append(z.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False, write_dict_id=False).compress)

    def __call__(self, text: str | None) -> tuple[str, float]:
        """Language and score: the share of the runner-up's size that the best dictionary saves."""
        raw = spelled(text or "")
        if not raw.strip() or not self.names:
            return UNKNOWN, 0.0
        step = -(-len(raw) // -(-len(raw) // PIECE))
        pieces = [raw[at : at + step] for at in range(0, len(raw), step)]
        sizes = [sum(len(c(piece)) for piece in pieces) for c in self.compressors]
        best = min(sizes)
        others = sorted(sizes)[1:2]
        return self.names[sizes.index(best)], 1 - best / others[0] if others else 1.0


def predict_language(
    docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", margin: float = MARGIN, carry: list[str] | None = None
) -> DataFrame:
    """Two structs: `row` with the columns `carry` (all by default), `language` with `lang_pred`, `score` (0 to 1), `rejected`."""

    name = "languages " + hashlib.sha256(repr(dictionaries).encode()).hexdigest()

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def language(column: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classify = kept(name, lambda: Classifier(dictionaries))
        for texts in column:
            found = [classify(t) for t in texts]
            yield pd.DataFrame({
                "lang_pred": [x[0] for x in found], "score": [x[1] for x in found],
                "rejected": [x[0] == UNKNOWN or x[1] < margin for x in found],
            })

    carried = docs.columns if carry is None else carry
    return docs.select(F.struct(*[docs[c] for c in carried]).alias("row"), language(docs[text]).alias("language"))


def drop_rejected(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", margin: float = MARGIN) -> DataFrame:
    """The rows whose language is clear, with the columns of `docs`."""
    return predict_language(docs, dictionaries, text, margin).where("not language.rejected").select("row.*")
