"""Splitting a text where no token of a byte-level tokenizer can cross, so that parts can be encoded once and reused."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

# white space before a blank: there the blank need not begin a token
_ODD = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) ")
LONGEST_KEPT = 200          # characters of a part that a cache keeps
CACHE_PARTS = 1_500_000     # parts that a cache holds before it starts anew; a bound on memory, not on results


def split(text: str) -> list[str]:
    """Parts of `text`; all but the first had a blank before them.

    The pattern of these tokenizers joins a blank to what follows it, and no
    token goes on from a non-space character over a blank. So a text may be cut
    before every blank that follows a non-space character, and the parts encoded
    one by one give the tokens of the whole.
    """
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


class PartCache:
    """Encoded parts by text.

    `encode` takes a list of strings and gives the little-endian 32-bit ids of
    each; `encode_run` does so for strings that each begin with a blank.
    """

    def __init__(
        self, encode: Callable[[list[str]], Iterable[bytes]], encode_run: Callable[[list[str]], Iterable[bytes]] | None = None, size: int = CACHE_PARTS
    ):
        self.encode, self.encode_run, self.size = encode, encode_run or encode, size
        self.inner: dict[str, bytes] = {}       # parts that follow a blank

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text."""
        parts = [split(t) for t in texts]
        firsts = list(self.encode([p[0] for p in parts]))
        missing = set().union(*(p[1:] for p in parts)).difference(self.inner)
        once = {}
        if missing:
            if len(self.inner) + len(missing) > self.size:
                self.inner.clear()
                missing = set().union(*(p[1:] for p in parts))
            ordered = list(missing)
            for part, ids in zip(ordered, self.encode_run([" " + m for m in ordered])):
                (self.inner if len(part) <= LONGEST_KEPT else once)[part] = ids
        for first, p in zip(firsts, parts):
            del p[0]
            if once:
                yield first + b"".join([self.inner[x] if x in self.inner else once[x] for x in p])
            else:
                yield first + b"".join(map(self.inner.__getitem__, p))


def groups(texts: list[str], characters: int = 500_000) -> Iterator[list[str]]:
    """Runs of neighbouring texts with about so many characters."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= characters:
            yield run
            run, size = [], 0
    if run:
        yield run
