"""Operators 5 and 7: best-fit-decreasing packing of token ids.

Every document becomes ids plus one end id.  A document longer than a window
is first cut into full windows; what remains of each document is packed,
longest first, into the open window with the tightest sufficient capacity,
found by a segment tree indexed by remaining capacity.

The work needs no shuffle: each scan partition packs its own documents, in
runs of at most ``RUN_PIECES`` remainders (or ``RUN_IDS`` ids), so memory is
bounded whatever the partition holds, and one hot source or one group of
copies makes no task larger.  A sequence id is (partition number << 40) +
counter; partitions and their row order come from the scan, so a recomputed
task gives the same ids.

Edge cases: null or empty text is the single end id; a null id stays null;
repeated rows are packed each; a very long text gives full windows and one
remainder; an empty table gives no rows.  Each id lies in exactly one piece.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from forecastry.llm.common import id_and_text

RUN_PIECES = 32_768
RUN_IDS = 4_000_000
END = b"\0\0\0\0"

PIECES_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
MATRIX_SCHEMA = (
    "sequence_id long, n_tokens int, ids binary, ids_crc32 long, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<long>, doc_starts array<long>"
)

# The byte-level pre-tokenizer's pattern, and the characters on
# which both tokenizer libraries were compared one by one (tests/llm).
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
COMPARED = re.compile("[^\x00-\u024f]")


def byte_of_char() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable
    Latin-1 characters are themselves, the rest follow from U+0100."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in keep]
    return {chr(b): b for b in keep} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Text to ids (little-endian unsigned 32 bit), as the tokenizer file gives
    them without added special tokens.

    Where the file is a byte-level BPE whose ids are its merge ranks, texts of
    compared characters without a special string go through tiktoken with the
    same ranks (the same ids in a third of the time); all others go through
    the tokenizers library.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = self._fast(json.load(open(path, encoding="utf-8")))

    @staticmethod
    def _fast(spec: dict) -> tiktoken.Encoding | None:
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        if model["type"] != "BPE" or not plain or spec.get("normalizer") or model.get("ignore_merges"):
            return None
        vocab, special = model["vocab"], {t["content"] for t in spec["added_tokens"]}
        merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merged)):
            return None
        chars = byte_of_char()
        ranks = {bytes(chars[c] for c in t): i for t, i in vocab.items() if t not in special}
        return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if self.fast and not COMPARED.search(text) and not any(s in text for s in self.special):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()


class CapacityTree:
    """Segment tree over remaining capacities 0..window: how many windows are
    open at each capacity; ``tightest(n)`` is the least capacity >= n."""

    def __init__(self, window: int):
        self.size = 1 << (window + 1 - 1).bit_length() if window else 1
        while self.size < window + 1:
            self.size *= 2
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, d: int) -> None:
        i = capacity + self.size
        while i:
            self.count[i] += d
            i >>= 1

    def put(self, capacity: int, window_id: int) -> None:
        self.open[capacity].append(window_id)
        self._add(capacity, 1)

    def take(self, capacity: int) -> int:
        self._add(capacity, -1)
        return self.open[capacity].pop()

    def tightest(self, n: int) -> int | None:
        i = n + self.size
        if self.count[i]:
            return n
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int], int]:
    """Window number and offset of every piece, and the number of windows."""
    tree = CapacityTree(window)
    where, offset, n = [0] * len(lengths), [0] * len(lengths), 0
    for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[k]
        capacity = tree.tightest(size)
        if capacity is None:
            w, capacity, n = n, window, n + 1
        else:
            w = tree.take(capacity)
        where[k], offset[k] = w, window - capacity
        if capacity > size:
            tree.put(capacity - size, w)
    return where, offset, n


def cut(n_ids: int, window: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full windows, then the rest."""
    return [(s, min(window, n_ids - s)) for s in range(0, n_ids, window)]


class Packer:
    """Packs the documents of one partition; yields finished sequences as
    lists of (doc_id, start, ids, doc_tokens)."""

    def __init__(self, window: int):
        self.window = window
        self.rest: list[tuple] = []
        self.rest_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[list[tuple]]:
        n = len(ids) // 4
        for start, length in cut(n, self.window):
            piece = (doc_id, start, ids[4 * start : 4 * (start + length)], n)
            if length == self.window:
                yield [piece]
            else:
                self.rest.append(piece)
                self.rest_ids += length
        if len(self.rest) >= RUN_PIECES or self.rest_ids >= RUN_IDS:
            yield from self.flush()

    def flush(self) -> Iterator[list[tuple]]:
        pieces, self.rest, self.rest_ids = self.rest, [], 0
        where, offset, n = best_fit_decreasing([len(p[2]) // 4 for p in pieces], self.window)
        windows: list[list[tuple]] = [[] for _ in range(n)]
        for k in sorted(range(len(pieces)), key=offset.__getitem__):
            windows[where[k]].append(pieces[k])
        yield from windows


def _sequences(batches, tokenizer_path: str, window: int, cache: dict) -> Iterator[tuple[int, list[tuple]]]:
    encoder = cache.get(tokenizer_path)
    if encoder is None:
        encoder = cache[tokenizer_path] = Encoder(tokenizer_path)
    packer, counter = Packer(window), TaskContext.get().partitionId() << 40
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            for pieces in packer.add(doc_id.as_py(), encoder.encode(text.as_py() or "") + END):
                yield counter, pieces
                counter += 1
    for pieces in packer.flush():
        yield counter, pieces
        counter += 1


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    columns: list[list] = [[] for _ in schema]
    for row in rows:
        for column, value in zip(columns, row, strict=True):
            column.append(value)
        if len(columns[0]) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            columns = [[] for _ in schema]
    if columns[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def pack_pieces(
    df: DataFrame, tokenizer_path: str, window: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Operator 5: one row per piece, with its sequence and offset there."""
    cache: dict = {}
    schema = pa.schema([(n, pa.int64()) for n in
                        ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])

    def rows(batches):
        for sequence_id, pieces in _sequences(batches, tokenizer_path, window, cache):
            offset = 0
            for doc_id, start, ids, n in pieces:
                yield doc_id, start, len(ids) // 4, zlib.crc32(ids), n, sequence_id, offset
                offset += len(ids) // 4

    return id_and_text(df, id_col, text_col).mapInArrow(
        lambda batches: _batched(rows(batches), schema, 20_000), PIECES_SCHEMA
    )


def pack_matrices(
    df: DataFrame, tokenizer_path: str, window: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Operator 7: one row per sequence.

    ``ids`` is the padded row of the id matrix (``window`` little-endian
    unsigned 32-bit ids; 0 is padding after ``n_tokens``), ``cu_seqlens`` the
    cumulative segment lengths from 0, ``position_resets`` the offsets at
    which position ids start again from 0, ``doc_ids`` and ``doc_starts`` tell
    which ids of which document a segment holds: nothing is lost.
    """
    cache: dict = {}
    i32, i64 = pa.int32(), pa.int64()
    schema = pa.schema([
        ("sequence_id", i64), ("n_tokens", i32), ("ids", pa.binary()), ("ids_crc32", i64), ("cu_seqlens", pa.list_(i32)),
        ("position_resets", pa.list_(i32)), ("doc_ids", pa.list_(i64)), ("doc_starts", pa.list_(i64)),
    ])

    def rows(batches):
        for sequence_id, pieces in _sequences(batches, tokenizer_path, window, cache):
            ends = np.cumsum([len(p[2]) // 4 for p in pieces]).tolist()
            ids = b"".join(p[2] for p in pieces)
            yield (sequence_id, ends[-1], ids.ljust(4 * window, b"\0"), zlib.crc32(ids), [0, *ends], [0, *ends[:-1]],
                   [p[0] for p in pieces], [p[1] for p in pieces])

    return id_and_text(df, id_col, text_col).mapInArrow(
        lambda batches: _batched(rows(batches), schema, 500), MATRIX_SCHEMA
    )


def write_matrices(packed: DataFrame, path: str) -> DataFrame:
    """Write the matrices (a folder any Spark reader opens) and read them back."""
    packed.write.mode("overwrite").parquet(path)
    return packed.sparkSession.read.parquet(path)


def position_ids(position_resets: list[int], n_tokens: int, window: int) -> np.ndarray:
    """Position ids of one matrix row: 0,1,2,... from every reset; 0 in the padding."""
    out = np.arange(window)
    marks = np.zeros(window, dtype=np.int64)
    marks[position_resets] = position_resets
    out -= np.maximum.accumulate(marks)
    out[n_tokens:] = 0
    return out
