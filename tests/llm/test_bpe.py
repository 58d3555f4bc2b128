import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from skeinwork.llm.bpe import Codec, bpe_digests, decode_bpe, encode_bpe, load_ranks, merge
from skeinwork.llm.pieces import split

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, ids string, n_tokens int"
TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \nb", "a\n b", "\t a\n\n  b \n", "don't we'll I'M it's", "x1 22 333 été naïve",
    "日本語 の text \U0001f600\U0001f600", "<|endoftext|> x", "a  b   c", "a\x1c b\x1f c \x85 d\x0b e", "zzzz" * 4000, "ab " * 20000,
    "=" * 3001 + " " * 501 + "q", "The, the. THE; (the)\r\n\r\nthe",
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})


def test_same_as_library(library):
    rng = random.Random(5)
    alphabet = "aeTh .,'\n\t 19éß中-_\x1c  "
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(80))) for _ in range(3000)]
    texts += ["a" + chr(c) + " " + chr(c) + "b" for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    codec = Codec(PATH, PATTERN)
    for text, ids in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), repr(text[:80])
        assert codec.decode(ids) == text.encode()


def test_split_joins_again():
    for text in TEXTS:
        assert " ".join(split(text)) == text


def test_leftmost_pair_first():
    ranks = {bytes([b]): i for i, b in enumerate(b"ab")} | {b"aa": 2, b"aab": 3}
    assert merge(b"aaab", ranks) == [2, 0, 1]
    assert merge(b"baab", ranks) == [1, 3]


def test_query_form(spark, library):
    data = [(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(50, None, None, None), (None, "x", None, None), (3, "a", "clash", 1)]
    df = spark.createDataFrame(data, SCHEMA)
    want = []
    for i, t, *_ in data:
        ids = np.array(library.encode_ordinary(t or ""), "<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = [tuple(r) for r in bpe_digests(df, PATH, PATTERN).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    back = decode_bpe(encode_bpe(df, PATH, PATTERN), PATH, PATTERN).collect()
    assert sorted(((r["doc_id"], bytes(r["decoded"])) for r in back), key=repr) == sorted(((i, (t or "").encode()) for i, t, *_ in data), key=repr)
    assert bpe_digests(df.limit(0), PATH, PATTERN).count() == 0
