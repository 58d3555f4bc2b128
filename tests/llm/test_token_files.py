import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skeinwork.llm.token_files import TokenFile, TokenFileWriter, from_planes, read_token_files, to_planes, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, path string, ids long"


class Held(io.BytesIO):
    def size(self):
        return len(self.getvalue())


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_planes_round_trip(unit):
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 65_536):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype("<u4")
        planes = to_planes(ids, unit)
        assert len(planes) == (4 if unit == "byte" else 32) and (from_planes(planes, n) == ids).all()


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_file_round_trip(unit):
    rng = np.random.default_rng(2)
    docs = [(i if i % 7 else None, rng.integers(0, 50_257, n, dtype="u4")) for i, n in enumerate([0, 1, 63, 64, 65, 1000, 0, 3, 128])]
    out = Held()
    writer = TokenFileWriter(out, unit, block=64)
    for doc, ids in docs:
        writer.add(doc, ids.tobytes())
    assert writer.finish() == (len(docs), sum(len(x) for _, x in docs))
    found = TokenFile(Held(out.getvalue()))
    every = np.concatenate([x for _, x in docs])
    at = 0
    for (doc, ids), (got, start, pieces) in zip(docs, found.documents(), strict=True):
        assert got == doc and start == at and np.concatenate([np.empty(0, "u4"), *pieces]).tolist() == ids.tolist()
        at += len(ids)
    for first, count in ((0, 0), (0, 5), (60, 10), (64, 64), (100, 1000), (len(every) - 1, 1)):
        assert (found.ids(first, count) == every[first : first + count]).all()


@pytest.mark.parametrize("docs_per_file", [20_000, 5])
def test_against_library(spark, docs_per_file):
    texts = ["", None, "a  b", "don't été", "x " * 5000, "<|endoftext|> in text", "same", "\n \n", "q" * 3000, "a  b\x1c c"]
    data = [(97 * i % 101, t, "p", 1) for i, t in enumerate(texts * 4)] + [(None, "null id", None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    start, want = 0, []
    for i, t, *_ in sorted(data, key=lambda r: -1 if r[0] is None else r[0]):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = read_token_files(write_token_files(df, PATH, 2, docs_per_file=docs_per_file, block=256))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[1]) == want


def test_empty(spark):
    assert read_token_files(write_token_files(spark.createDataFrame([], SCHEMA), PATH, 2)).count() == 0


def test_repeated_ids_have_an_order(spark):
    """Rows with one id and different texts: the same files whatever the order of the rows."""
    data = [(i % 3 if i % 7 else None, f"text {i * 7919 % 50} " * (1 + i % 4), "p", 1) for i in range(60)]
    found = set()
    for n, rows in ((1, data), (5, data[::-1]), (3, data[30:] + data[:30])):
        df = spark.createDataFrame(rows, SCHEMA).repartition(n)
        got = read_token_files(write_token_files(df, PATH, 2, docs_per_file=10)).collect()
        found.add(tuple(sorted((tuple(r) for r in got), key=lambda r: r[1])))
    assert len(found) == 1 and len(next(iter(found))) == 60


def test_texts_are_encoded_in_large_runs(spark, tmp_path, monkeypatch):
    """A part of neighbouring texts is looked for once per run; the files do not depend on the size of a run."""
    from skeinwork.llm import token_files as tf

    assert tf.CHARACTERS > 1_000_000
    docs = spark.createDataFrame([(i, "one two  three " * (i % 7) if i % 5 else None) for i in range(40)], "doc_id bigint, text string")
    found = []
    for size in (tf.CHARACTERS, 30):
        monkeypatch.setattr(tf, "CHARACTERS", size)
        files = tf.write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), 2)
        found.append(sorted(map(tuple, tf.read_token_files(files).collect())))
    assert found[0] == found[1] and len(found[0]) == 40
