"""Operator 4: token counts with a whole-token shortcut.

Offline, every vocabulary string that ends a word is encoded alone by the
tokenizer's own model; those that come back as exactly one token are *proven*
whole tokens.  At run time a pre-token in the proven set counts as 1 without
any merging; only the rest goes through the merges.

The tokenizer's normaliser and pre-tokenizer never look across a plain space
or line feed (white space is a separator and is dropped), so the count of a
text is the sum over its space- or line-separated chunks; special-token
strings hold no white space and are found inside a chunk.  Chunk counts are
remembered in a bounded table per Python worker.

Edge cases: null or empty text counts 0 tokens and 0 bytes; a null id stays
null; repeated rows are counted each; one very long chunk is encoded whole
and not remembered.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from forecastry.llm.common import id_and_text, map_batches

CACHE_ENTRIES = 400_000
CACHED_CHARS = 64
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def proven_whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings (without the word-end mark) that encode alone as
    one token: checked one by one against the model's own merges."""
    tokenizer = Tokenizer.from_file(path)
    end = getattr(tokenizer.model, "end_of_word_suffix", None) or ""
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    proven = set()
    for token in tokenizer.get_vocab(with_added_tokens=False):
        if token in special or not token.endswith(end):
            continue
        word = token[: len(token) - len(end)]
        if word and len(tokenizer.model.tokenize(word)) == 1:
            proven.add(word)
    return frozenset(proven)


class ChunkCounts(dict):
    """chunk -> number of tokens, filled on first use."""

    def __init__(self, path: str, proven: frozenset[str]):
        self.proven = proven
        self.tokenizer = Tokenizer.from_file(path)
        self.special = re.compile(
            "|".join(
                re.escape(t.content)
                for t in sorted(self.tokenizer.get_added_tokens_decoder().values(), key=lambda t: -len(t.content))
            )
            or r"(?!)"
        )

    def count(self, chunk: str) -> int:
        pieces = self.special.split(chunk)
        total = len(pieces) - 1
        for piece in pieces:
            if not piece:
                continue
            if self.tokenizer.normalizer is not None:
                piece = self.tokenizer.normalizer.normalize_str(piece)
            for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(piece):
                total += 1 if word in self.proven else len(self.tokenizer.model.tokenize(word))
        return total

    def __missing__(self, chunk: str) -> int:
        n = self.count(chunk)
        if len(chunk) <= CACHED_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[chunk] = n
        return n

    def text_tokens(self, text: str) -> int:
        return sum(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def token_counts(
    df: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokens of every text; ``tokenizer_path`` must exist on the executors.
    The proven set is bounded by the vocabulary, so shipping it is safe."""
    spark = df.sparkSession
    proven = spark.sparkContext.broadcast(proven_whole_tokens(tokenizer_path))
    counters: dict[str, ChunkCounts] = {}

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = counters.get(tokenizer_path)
        if counter is None:
            counter = counters[tokenizer_path] = ChunkCounts(tokenizer_path, proven.value)
        n_bytes, n_tokens = [], []
        for value in batch.column("text"):
            text = value.as_py() or ""
            n_bytes.append(len(text.encode()))
            n_tokens.append(counter.text_tokens(text))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n_bytes, pa.int64()),
                pa.array(n_tokens, pa.int64()),
                pa.array([n > limit for n in n_tokens], pa.bool_()),
            ],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    return map_batches(id_and_text(df, id_col, text_col), count, SCHEMA)
