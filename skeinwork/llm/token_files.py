"""Token ids in binary files of compressed byte or bit planes.

A file holds the ids of consecutive documents, in ascending order of their id.
The id stream is cut into blocks of a fixed number of ids. A block is
transposed: plane k holds byte (or bit) k of every id, and each plane is
compressed with zstandard on its own, so high planes that are all zero or vary
little take next to nothing.

    8 bytes     magic
    payload     the planes of block 0, of block 1, ...
    footer      zstandard: JSON header, chunk index, document index
    16 bytes    offset and length of the footer (little-endian)
    8 bytes     magic

The chunk index has a row per block: first id, number of ids, offset of the
first plane, and the length of each plane; any range of ids can be read by
seeking. The document index has id, null mark and number of ids per document.

A task writes its file under a name of its own and renames it when complete; the
list of files names the one of the attempt that counted. The folder must be one that executors
reach (any file system that pyarrow opens).

Defined results: a null text has the end id alone. Documents with a null id
come first; rows with equal ids are ordered by their text, so the files are the
same in every run; repeated rows are stored as often as they occur. A very long
text is encoded in parts between blanks, and its ids go through the blocks like
any others. An empty table gives a folder without files. Extra columns are not read.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinwork.llm.pieces import PartCache, groups
from skeinwork.llm.worker import kept
from skeinwork.session import materialize, scratch_path

MAGIC = b"IDPLANE1"
BLOCK = 65_536
DOCS_PER_FILE = 20_000
CHARACTERS = 1_500_000      # of texts that are encoded together: a part that occurs in several is looked for once


def file_system(path: str):
    """The pyarrow file system of a URI or absolute path, and the path in it."""
    from pyarrow import fs

    if urlsplit(path).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlsplit(path).path
    return fs.FileSystem.from_uri(path)


def to_planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """The byte or bit planes of 32-bit ids, lowest first."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if unit == "byte":
        return [raw[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, k]).tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        raw = np.stack([np.frombuffer(p, np.uint8, n) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


class TokenFileWriter:
    def __init__(self, out, unit: str = "byte", block: int = BLOCK, level: int = 3):
        import zstandard

        self.out, self.unit, self.block = out, unit, block
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.offset = out.write(MAGIC)
        self.waiting, self.held, self.first = [], 0, 0
        self.chunks, self.docs, self.nulls, self.lengths = [], [], [], []

    def add(self, doc: int | None, ids: bytes) -> None:
        self.docs.append(doc or 0)
        self.nulls.append(doc is None)
        self.lengths.append(len(ids) // 4)
        self.waiting.append(ids)
        self.held += len(ids) // 4
        if self.held >= self.block:
            stream = np.frombuffer(b"".join(self.waiting), "<u4")
            whole = len(stream) // self.block * self.block
            for i in range(0, whole, self.block):
                self._put(stream[i : i + self.block])
            self.waiting, self.held = [stream[whole:].tobytes()], len(stream) - whole

    def _put(self, ids: np.ndarray) -> None:
        planes = [self.zstd.compress(p) for p in to_planes(ids, self.unit)]
        self.chunks.append([self.first, len(ids), self.offset, *map(len, planes)])
        for p in planes:
            self.out.write(p)
        self.offset += sum(map(len, planes))
        self.first += len(ids)

    def finish(self) -> tuple[int, int]:
        """Writes index and footer; documents and ids in the file."""
        if self.held:
            self._put(np.frombuffer(b"".join(self.waiting), "<u4"))
        index = [np.array(self.chunks, "<i8"), np.array(self.docs, "<i8"), np.array(self.nulls, "u1"), np.array(self.lengths, "<i8")]
        head = json.dumps({"unit": self.unit, "block": self.block, "chunks": len(self.chunks), "docs": len(self.docs), "ids": self.first})
        footer = self.zstd.compress(b"".join([struct.pack("<I", len(head)), head.encode(), *(a.tobytes() for a in index)]))
        self.out.write(footer + struct.pack("<QQ", self.offset, len(footer)) + MAGIC)
        return len(self.docs), self.first


class TokenFile:
    """Reads a file by its index."""

    def __init__(self, source):
        import zstandard

        self.source, self.zstd = source, zstandard.ZstdDecompressor()
        size = source.size()
        source.seek(size - 24)
        offset, length, magic = struct.unpack("<QQ8s", source.read(24))
        if magic != MAGIC:
            raise ValueError("not a token file")
        source.seek(offset)
        footer = self.zstd.decompress(source.read(length))
        (n,) = struct.unpack_from("<I", footer)
        self.head = json.loads(footer[4 : 4 + n])
        at, planes, docs = 4 + n, 4 if self.head["unit"] == "byte" else 32, self.head["docs"]
        self.chunks = np.frombuffer(footer, "<i8", self.head["chunks"] * (3 + planes), at).reshape(-1, 3 + planes)
        at += self.chunks.nbytes
        self.docs = np.frombuffer(footer, "<i8", docs, at)
        self.nulls = np.frombuffer(footer, "u1", docs, at + 8 * docs).astype(bool)
        self.lengths = np.frombuffer(footer, "<i8", docs, at + 9 * docs)

    def chunk(self, k: int) -> np.ndarray:
        _, n, offset, *lengths = self.chunks[k].tolist()
        self.source.seek(offset)
        return from_planes([self.zstd.decompress(self.source.read(x)) for x in lengths], n)

    def ids(self, first: int, count: int) -> np.ndarray:
        """`count` ids from position `first` on."""
        if not count:
            return np.empty(0, "<u4")
        k = int(np.searchsorted(self.chunks[:, 0], first, "right")) - 1
        got, start = [], int(self.chunks[k, 0])
        while k < len(self.chunks) and self.chunks[k, 0] < first + count:
            got.append(self.chunk(k))
            k += 1
        return np.concatenate(got)[first - start : first - start + count]

    def documents(self) -> Iterator[tuple[int | None, int, list[np.ndarray]]]:
        """Id, first position and ids (in pieces) of each document; one block is decoded at a time."""
        k, block, at, position = -1, np.empty(0, "<u4"), 0, 0
        for doc, null, n in zip(self.docs.tolist(), self.nulls.tolist(), self.lengths.tolist()):
            pieces, left = [], n
            while left:
                if at == len(block):
                    k += 1
                    block, at = self.chunk(k), 0
                pieces.append(block[at : at + left])
                at += len(pieces[-1])
                left -= len(pieces[-1])
            yield None if null else doc, position, pieces
            position += n


def _library(path: str) -> PartCache:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True              # their strings in a text are ordinary text

    def encode(parts: list[str]) -> Iterator[bytes]:
        for found in tokenizer.encode_batch_fast(parts, add_special_tokens=False):
            yield np.array(found.ids, "<u4").tobytes()

    # a token of the byte-level alphabet has a character per byte
    vocabulary = tokenizer.get_vocab()
    width = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, i in vocabulary.items():
        width[i] = len(token)

    def encode_run(parts: list[str]) -> Iterator[bytes]:
        """One call for many short strings: tokens do not cross the blanks, so the ids are cut where the bytes of a part end."""
        ids = np.array(tokenizer.encode_batch_fast(["".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        reached, ends = np.cumsum(width[ids]), np.cumsum([len(p.encode()) for p in parts])
        at = np.minimum(np.searchsorted(reached, ends), max(len(ids) - 1, 0))
        if len(ids) and (reached[at] == ends).all():
            low = 0
            for high in (at + 1).tolist():
                yield ids[low:high].tobytes()
                low = high
        else:
            yield from encode(parts)

    return PartCache(encode, encode_run)


def write_token_files(
    docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None, id: str = "doc_id", text: str = "text",
    unit: str = "byte", block: int = BLOCK, docs_per_file: int = DOCS_PER_FILE,
) -> DataFrame:
    """Encodes the texts, writes the files, and gives a row per file: `part`, `path`, `docs`, `ids`.

    `vocabulary` is a file of a byte-level BPE tokenizer, present on every
    executor. The texts are put in order by one range shuffle; a file is a range
    of ids, so the order of the parts is the order of the documents.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token_files")
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).cast("bigint").alias("id"), body.alias("text"), F.xxhash64(body).alias("hash"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + rows.count() // docs_per_file)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, encoder = task.partitionId(), kept(f"tokenizer {vocabulary}", lambda: _library(vocabulary))
        fs, where = file_system(folder)
        name = f"ids-{part:07d}-{task.taskAttemptId()}.bin"       # a repeated task writes a file of its own; the list names one
        draft, out, writer = f"{where}/.draft-{part}-{task.taskAttemptId()}", None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                fs.create_dir(where, recursive=True)
                out = fs.open_output_stream(draft)
                writer = TokenFileWriter(out, unit, block)
            keys, at = batch.column(0).to_pylist(), 0
            for run_of_texts in groups(batch.column(1).to_pylist(), CHARACTERS):
                for ids in encoder.ids(run_of_texts):
                    writer.add(keys[at], ids + end)
                    at += 1
        if writer is not None:
            n_docs, n_ids = writer.finish()
            out.close()
            fs.move(draft, f"{where}/{name}")
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [f"{folder}/{name}"], "docs": [n_docs], "ids": [n_ids]})

    # rows with one id are ordered by their text; the hash is what ranges are cut by
    ordered = rows.repartitionByRange(parts, "id", "hash").sortWithinPartitions("id", "hash", F.length("text"), "text").drop("hash")
    files = ordered.mapInArrow(run, "part int, path string, docs long, ids long")
    return materialize(files, "token_file_list")


def read_token_files(files: DataFrame, id: str = "doc_id") -> DataFrame:
    """From the files: id, `start` (ids of all documents before it), `n_tokens`, `ids_crc32`.

    `files` is the list that `write_token_files` gives, one row per file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, where = file_system(path)
                with fs.open_input_file(where) as source:
                    found = TokenFile(source)
                    ids, starts, sums = [], [], []
                    for doc, position, pieces in found.documents():
                        crc = 0
                        for p in pieces:
                            crc = zlib.crc32(p, crc)
                        ids.append(doc)
                        starts.append(before + position)
                        sums.append(crc)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(found.lengths, pa.int64()), pa.array(sums, pa.int64())],
                        ["id", "start", "n_tokens", "ids_crc32"],
                    )

    # one row per file
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    spread = placed.repartition(max(files.count(), 1))
    return spread.mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id)
