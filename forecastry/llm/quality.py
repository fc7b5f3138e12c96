"""Operator 6: quality by perplexity under a modified Kneser-Ney model.

The model is interpolated modified Kneser-Ney at every level, counted from *all*
trusted texts.  A text is cut into words (``WORD``: a run of letters or of marks with
the blank before it, at most 33 characters):

* the top level has pairs of words, a word after the one before it (or after the start
  of the text): discounted counts of every trusted pair, and the rest of a context's
  probability goes to the middle level;
* the middle level has the words themselves, an open vocabulary that grows with the
  corpus: of every trusted word, discounted, the number of different words before it,
  and the rest goes to the lower level (of words by themselves: their counts);
* the lower level spells any word: n-grams of order ``ORDER`` over ``ALPHABET``
  symbols (classes of UTF-8 bytes), counted from the different words and joined, order
  by order, with the sharded counts of their contexts.  It has ALPHABET ** ORDER
  n-grams at most whatever the corpus, so its table is sent to the tasks.

Words and pairs are counted in shards, and a document's perplexity comes from joining
its words and pairs with them; no count is sent to the tasks.  Documents are taken in
chunks, and a chunk asks every shard once for all of its different words there; the shard
finds their counts, spells and numbers them, and the values go back to their chunk.  By
the words' numbers the chunk counts its trusted pairs for the shards of pairs, then asks
those for its different pairs, and sums by document.  So a word or pair that a third of
all documents hold is asked for once a chunk like any other.  A trusted document is scored
by the counts of the others (its own are taken off), so that it is no less surprising than
a document that the model has not seen.

A document has two perplexities, of its words by themselves (``perplexity``) and after
the words before them (``pair_perplexity``).  A score is a mean negative log-likelihood
against that of the language's middle, in standard errors for the document's length.
Outside the language's limits of words by themselves (too surprising, or too repetitive to
be prose) a document is rejected, and beyond the upper one of pairs (words in no order).
Pairs have no lower limit: a copy of a trusted text is as little surprising as text can be.
For each limit two estimates are blended by the number n of the language's trusted documents, the first with
the weight n^2 / (n^2 + ``HALF``^2):

* the trusted documents' mean and spread, and the ``TAIL`` and 1 - ``TAIL`` quantiles of
  their scores, widened by ``MARGIN``;
* the medians over all documents of the language, and what lies ``FENCE`` quartile
  distances beyond their quartiles (more with few documents: a language of m
  documents has fences 1 + ``HALF`` / m times as far).

So no language is held to the limits of others, and nothing changes suddenly as
labels or documents come in.

Edge cases: null or empty text has no symbols, score null, and is rejected; a
null language (which may be a mixture) is scored against no limits, so all but its
empty texts is accepted; a language that is junk for the most part and has no
trusted documents is judged by junk.  Without any trusted document nothing but
empty text is rejected; repeated rows are scored each; null ids are never trusted.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecastry.llm.common import checkpointed, fresh
from forecastry.llm.neardup import _among
from forecastry.session import drop_scratch, scratch_path

ORDER = 4
#: Every character is in one word; longer runs are cut.
WORD = re.compile(r"\s?\w{1,32}|\s?[^\w\s]{1,32}|\s{1,32}")
#: A chunk ends with the document at which it has so many characters, or its head,
#: the list of its different words, so many words.
PART_CHARS = 16_000_000
HEAD_WORDS = 1 << 18
#: Trusted words of a shard, on average.
SHARD_WORDS = 25_000
#: Words of trusted texts to a shard of pairs, on average.
SHARD_TOKENS = 500_000
#: The number of the start of a text; the words' numbers follow, 0 is no trusted word.
START = 1
#: A task that counts trusted words remembers so many.
REMEMBERED = 100_000
TAIL = 0.001
MARGIN = 1.25
#: Trusted documents of a language at which they count half.
HALF = 50
#: Limits from a language's own documents, in quartile distances beyond their
#: quartiles (of scores: a distance counts as 1.35, the normal one, at least, so
#: that copies of one text do not narrow them).
FENCE = 6.0
#: The limits of so many languages at most are broadcast; more are joined by shuffle.
BROADCAST_LANGUAGES = 10_000
#: Added to a document's variance of the mean: real differences between texts.
SPREAD = 0.05


def symbol_classes() -> np.ndarray:
    """Symbol of every byte; 0 is the boundary before a text."""
    out = np.full(256, 37, np.int64)  # other punctuation
    out[:32] = 31
    out[127] = 31
    for c in range(26):
        out[ord("a") + c], out[ord("A") + c] = 1 + c, 27
    for s, group in ((28, "0123456789"), (29, " "), (30, "\n"), (32, "."), (33, ","), (34, ";:!?"), (35, "|"),
                     (36, "'\"-()")):
        for c in group:
            out[ord(c)] = s
    out[0x80:0xC0] = 38 + np.arange(64) % 16  # the second byte tells accented letters apart
    out[0xC0:] = 55
    out[0xC3] = 54
    return out


ALPHABET = 56
CODES = ALPHABET**ORDER


def word_codes(words: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of the ORDER symbols that end at each symbol of every word and at its end
    (0), word after word, and each word's number of them."""
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    before = np.cumsum(lengths) - lengths
    byte_at = np.arange(int(lengths.sum())) + np.repeat(np.arange(1, len(raw) + 1) * (ORDER - 1) + np.arange(len(raw)), lengths)
    s = np.zeros(int(lengths.sum()) + ORDER * len(raw), np.int64)
    s[byte_at] = table[np.frombuffer(b"".join(raw), np.uint8)]
    sizes = lengths + 1
    at = np.arange(int(sizes.sum())) + np.repeat(np.arange(1, len(raw) + 1) * (ORDER - 1), sizes)
    code = s[at - ORDER + 1]
    for k in range(ORDER - 2, -1, -1):
        code = code * ALPHABET + s[at - k]
    return code, sizes


def spelled(words: list[str], nll: np.ndarray | None, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Negative log-probability of each word by the lower level, and its symbols."""
    if not words:
        return np.zeros(0), np.zeros(0, np.int64)
    code, sizes = word_codes(words, table)
    if nll is None:
        return np.zeros(len(words)), sizes
    return np.add.reduceat(nll[code].astype(np.float64), np.cumsum(sizes) - sizes), sizes


def packed(docs: DataFrame) -> DataFrame:
    """doc_id and the text's words to be, compressed: half of what a shuffle writes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [zlib.compress((t.as_py() or "").encode("utf-8", "surrogatepass"), 3) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(raw, pa.binary())], names=["doc_id", "raw"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, raw binary")


def count_words(trusted: DataFrame) -> DataFrame:
    """(word, c) over all ``packed`` texts; a task adds up as it goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "c"]
            )
            counts.clear()
            return out

        for batch in batches:
            for raw in batch.column("raw"):
                counts.update(WORD.findall(zlib.decompress(raw.as_py()).decode("utf-8", "surrogatepass")))
                if len(counts) > REMEMBERED:
                    yield flush()
        yield flush()

    return trusted.select("raw").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def count_ngrams(words: DataFrame) -> DataFrame:
    """(g, c): the n-grams of the highest order in all different words.  A task
    adds its words up in one dense array and sends what occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total, any_word = symbol_classes(), np.zeros(CODES, np.int32), False
        for batch in batches:
            if batch.num_rows:
                any_word = True
                codes, n = np.unique(word_codes(batch.column("word").to_pylist(), table)[0], return_counts=True)
                total[codes] += n.astype(np.int32)
        if any_word:
            g = np.flatnonzero(total)
            for k in range(0, len(g), 100_000):
                part = g[k : k + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array(total[part].astype(np.int64))], names=["g", "c"]
                )

    return words.select("word").mapInArrow(run, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """D1, D2 and D3+ from the counts of counts."""
    return discounts_of(*counts.agg(*[F.count_if(F.col("c") == k) for k in (1, 2, 3, 4)]).first())


def discounts_of(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    if not (n1 and n2):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0)
    return tuple(min(max(x, 0.05), k + 0.95) for k, x in enumerate(d))


def discounted(counts: DataFrame) -> DataFrame:
    """(g, a, ctx, gamma): (c - D(c)) / c(ctx) of every n-gram, and the back-off
    weight of its context, by a join of n-gram and context counts."""
    d1, d2, d3 = discounts(counts)
    rows = counts.withColumn("ctx", F.expr(f"g div {ALPHABET}"))
    contexts = rows.groupBy("ctx").agg(
        F.sum("c").alias("total"),
        *[F.count_if(F.col("c") == k).alias(f"n{k}") for k in (1, 2)], F.count_if(F.col("c") > 2).alias("n3"),
    )
    d = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
    gamma = (d1 * F.col("n1") + d2 * F.col("n2") + d3 * F.col("n3")) / F.col("total")
    return rows.join(contexts, "ctx").select("g", ((F.col("c") - d) / F.col("total")).alias("a"), "ctx", gamma.alias("gamma"))


def fit(words: DataFrame) -> list[tuple[np.ndarray, ...]] | None:
    """Per order, from 1: codes, discounted counts, and back-off weights by
    context, as arrays of what occurs (at most ALPHABET ** ORDER entries)."""
    counts = checkpointed(count_ngrams(words))
    orders = []
    for k in range(ORDER, 0, -1):
        got = discounted(counts).toPandas()
        if not len(got):
            return None
        orders.append(tuple(got[c].to_numpy() for c in ("g", "a", "ctx", "gamma")))
        if k > 1:  # the order below counts the distinct symbols before an n-gram
            counts = counts.groupBy((F.col("g") % ALPHABET ** (k - 1)).alias("g")).agg(F.count(F.lit(1)).alias("c"))
    return orders[::-1]


def log_probabilities(orders: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    """Negative log-probability of every code of the highest order."""
    lower = np.full((1, 1), 1 / ALPHABET, np.float32)  # context x symbol
    for k, (g, a, ctx, gamma) in enumerate(orders, 1):
        weight = np.ones(ALPHABET ** (k - 1), np.float32)
        weight[ctx] = gamma
        # of order 1 the rest goes to all symbols alike; above, to the shorter n-gram
        if k == 1:
            p = np.full(ALPHABET, weight[0] * lower[0, 0], np.float32)
        else:
            p = (weight.reshape(ALPHABET, len(lower), 1) * lower[None]).reshape(-1)
        p[g] += a.astype(np.float32)
        lower = p.reshape(-1, ALPHABET)
    p = lower.reshape(-1)
    return np.negative(np.log(p, out=p), out=p)


class Upper(NamedTuple):
    """The upper level's discounts, the sum of its counts, and -log of its rest."""

    d: tuple[float, float, float]
    total: int
    rest: float


def upper_level(counts: DataFrame) -> Upper:
    d = discounts(counts)
    total, *n = counts.agg(F.sum("c"), *[F.count_if(F.col("c") == k) for k in (1, 2)], F.count_if(F.col("c") > 2)).first()
    return Upper(d, total or 0, -math.log(sum(x * y for x, y in zip(d, n)) / total) if total else 0.0)


def with_counts(x: np.ndarray, c: np.ndarray, upper: Upper) -> np.ndarray:
    """Negative log-probability of words spelled at ``x`` and counted ``c`` times."""
    if not upper.total:
        return x
    share = (c - np.array(upper.d)[np.clip(c, 1, 3).astype(np.int64) - 1]) / upper.total
    return np.where(c > 0, -np.log(np.where(c > 0, share + np.exp(-x), 1)), x)


def shards_of(words: list[str], n_shards: int) -> np.ndarray:
    raw = (w.encode("utf-8", "surrogatepass") for w in words)
    return np.fromiter((xxhash.xxh3_64_intdigest(w) % n_shards for w in raw), np.int32, len(words))


def in_shards(counts: DataFrame, n_shards: int) -> DataFrame:
    """(shard, word, c)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards = pa.array(shards_of(batch.column("word").to_pylist(), n_shards))
            yield pa.RecordBatch.from_arrays([shards, batch.column("word"), batch.column("c")], names=["shard", "word", "c"])

    return counts.select("word", "c").mapInArrow(run, "shard int, word string, c long")


def planes(*arrays: np.ndarray) -> bytes:
    """Numbers compressed: of each array all lowest bytes first, then all second ones
    and so on."""
    return zlib.compress(b"".join(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays), 3)


def from_planes(raw: bytes, *types: str) -> list[np.ndarray]:
    data, out, first = np.frombuffer(zlib.decompress(raw), np.uint8), [], 0
    n = len(data) // sum(np.dtype(t).itemsize for t in types)
    for t in map(np.dtype, types):
        part = data[first : first + n * t.itemsize].reshape(t.itemsize, n)
        out.append(np.ascontiguousarray(part.T).view(t).reshape(-1))
        first += n * t.itemsize
    return out


def of_words(words: list[str]) -> bytes:
    return zlib.compress(b"\xff".join(w.encode("utf-8", "surrogatepass") for w in words), 3)


def from_words(raw: bytes) -> list[str]:
    return [w.decode("utf-8", "surrogatepass") for w in zlib.decompress(raw).split(b"\xff")]


def of_places(at: np.ndarray, times: np.ndarray) -> bytes:
    """The places of a text's words and how often each occurs."""
    order = np.argsort(at)
    return planes(np.diff(at[order], prepend=np.int32(0)).astype("<i4"), times[order].astype("<i4"))


def from_places(own: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, times = from_planes(own, "<i4", "<i4")
    return np.cumsum(steps), times


def in_chunks(docs: DataFrame, n_shards: int) -> DataFrame:
    """A row per row of ``docs`` with its ``own`` words (``of_places``) and their order (of
    every word its number among them), and the heads of the chunks, a row of ``words`` per
    shard: a word's place is that in the head, by shard and then as listed."""
    schema = pa.schema([("chunk", pa.int64()), ("k1", pa.int64()), ("k2", pa.int32()), ("doc_id", pa.int64()),
                        ("lang", pa.string()), ("own", pa.binary()), ("order", pa.binary()), ("shard", pa.int32()),
                        ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, chars = TaskContext.get().partitionId() << 32, 0
        found: dict[str, int] = {}
        rows: list[dict] = []

        def whole() -> Iterator[pa.RecordBatch]:
            words = sorted(found)
            shards = shards_of(words, n_shards)
            order = np.argsort(shards, kind="stable")
            places = np.zeros(len(words), np.int32)
            places[[found[words[k]] for k in order]] = np.arange(len(words), dtype=np.int32)
            for k in range(0, len(rows), 1000):
                part = []
                for r in rows[k : k + 1000]:
                    at = places[r["at"]]
                    number = np.empty(len(at), np.int32)
                    number[np.argsort(at)] = np.arange(len(at), dtype=np.int32)
                    part.append({**r, "own": of_places(at, r["times"]), "order": planes(number[r["order"]].astype("<i4"))})
                yield pa.RecordBatch.from_pylist(part, schema)
            for part in np.split(order, np.flatnonzero(np.diff(shards[order])) + 1):
                if len(part):
                    head = {"chunk": chunk, "shard": int(shards[part[0]]), "words": of_words([words[k] for k in part])}
                    yield pa.RecordBatch.from_pylist([head], schema)
            found.clear()
            rows.clear()

        for batch in batches:
            for row in (r for k in range(0, batch.num_rows, 50) for r in batch.slice(k, 50).to_pylist()):
                text = row.pop("text") or ""
                if chars and (chars >= PART_CHARS or len(found) >= HEAD_WORDS):
                    yield from whole()
                    chunk, chars = chunk + 1, 0
                words = WORD.findall(text)
                counts = Counter(words)
                at = [found.setdefault(w, len(found)) for w in counts]
                number = dict(zip(counts, range(len(counts))))
                row.update(chunk=chunk, at=np.array(at, np.int32), times=np.fromiter(counts.values(), np.int32, len(counts)),
                           order=np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                rows.append(row)
                chars += len(text)
        yield from whole()

    return docs.mapInArrow(
        run, "chunk long, k1 long, k2 int, doc_id long, lang string, own binary, order binary, shard int, words binary"
    )


def word_values(chunks: DataFrame, counts: DataFrame, spelling, upper: Upper) -> DataFrame:
    """(chunk, shard, found, ranks): for every word of every chunk's head its count, by a
    join with the shards of ``in_shards`` (0: no trusted word), its spelling's negative
    log-likelihood, its symbols, and its rank among the shard's words, the most frequent
    first (-1: no trusted word)."""
    lower: list = []  # a task's

    def run(heads: pa.Table, counts: pa.Table) -> pa.Table:
        if not lower:
            lower.extend([symbol_classes(), spelling.value and log_probabilities(spelling.value)])
        table, nll = lower
        asked = [from_words(raw.as_py()) for raw in heads["words"]]
        index = {w: k for k, w in enumerate(dict.fromkeys(w for words in asked for w in words))}
        x, size = spelled(list(index), nll, table)
        c, rank = np.zeros(len(index), np.int64), np.full(len(index), -1, np.int32)
        counts = counts.sort_by([("c", "descending"), ("word", "ascending")])
        for k, (w, n) in enumerate(zip(counts["word"].to_pylist(), counts["c"].to_pylist(), strict=True)):
            if w in index:
                c[index[w]], rank[index[w]] = n, k
        found, ranks = [], []
        for words in asked:
            at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
            found.append(planes(c[at], x[at] + upper.rest, size[at].astype("<i4")))
            ranks.append(planes(rank[at].astype("<i4")))
        return pa.Table.from_arrays(
            [heads["chunk"], heads["shard"], pa.array(found, pa.binary()), pa.array(ranks, pa.binary())],
            names=["chunk", "shard", "found", "ranks"],
        )

    heads = chunks.where("words IS NOT NULL").select("chunk", "shard", "words")
    return heads.groupBy("shard").cogroup(counts.groupBy("shard")).applyInArrow(
        run, "chunk long, shard int, found binary, ranks binary"
    )


class Sequences(NamedTuple):
    """The words of a chunk's documents in order, document after document: their places,
    those before (-1: the start), and each document's number of them."""

    place: np.ndarray
    before: np.ndarray
    lengths: np.ndarray


def sequences(docs: pa.Table) -> Sequences:
    parts = [from_places(own.as_py())[0][from_planes(order.as_py(), "<i4")[0]] for own, order in zip(docs["own"], docs["order"])]
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    place = np.concatenate(parts, dtype=np.int64) if parts else np.zeros(0, np.int64)
    before = np.roll(place, 1)
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = -1
    return Sequences(place, before, lengths)


def numbers_of(values: pa.Table, n_shards: int) -> np.ndarray:
    """The number of the word at every place of a chunk, and last that of the start, which
    so is at place -1."""
    parts = []
    for shard, raw in zip(values["shard"].to_pylist(), values["ranks"]):
        rank = from_planes(raw.as_py(), "<i4")[0].astype(np.int64)
        parts.append(np.where(rank < 0, 0, START + 1 + rank * n_shards + shard))
    return np.concatenate([*parts, [START]])


def pair_keys(words: Sequences, number: np.ndarray) -> np.ndarray:
    """Of every word the pair it ends, both numbers in one; 0 if either is no trusted word."""
    v, w = number[words.before].astype(np.uint64), number[words.place].astype(np.uint64)
    return np.where((v > 0) & (w > 0), v << np.uint64(32) | w, np.uint64(0))


def different(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All different pairs, ascending, and how often each occurs."""
    keys = np.sort(keys[keys > 0])
    first = np.flatnonzero(np.diff(keys, prepend=np.uint64(0)))
    return keys[first], np.diff(first, append=len(keys))


def by_pair_shard(keys: np.ndarray, n_shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of ascending pairs by shard and then ascending, and the shards so."""
    shards = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(n_shards)
    order = np.argsort(shards.astype(np.int32), kind="stable")
    return order, shards[order].astype(np.int32)


def of_pairs(keys: np.ndarray, *counts: np.ndarray) -> bytes:
    """Ascending pairs, and numbers of each."""
    v, w = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype("<u4")
    return planes(np.diff(v, prepend=0).astype("<u4"), w, *(c.astype("<i8") for c in counts))


def from_pairs(raw: bytes, n_counts: int = 0) -> list[np.ndarray]:
    steps, w, *counts = from_planes(raw, "<u4", "<u4", *["<i8"] * n_counts)
    return [np.cumsum(steps, dtype=np.uint64) << np.uint64(32) | w.astype(np.uint64), *counts]


def slices(at: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, first, end) of every run of equal values."""
    cuts = np.flatnonzero(np.diff(at)) + 1
    for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
        if end > first:
            yield int(at[first]), first, end


#: What a chunk is told: ``found`` and ``ranks`` of its words by shard, ``stats`` of its
#: words by shard, ``pairs`` by shard of pairs, and the ids of its trusted documents.
TOLD = {"chunk": "long", "shard": "int", "found": "binary", "ranks": "binary", "stats": "binary", "pairs": "binary", "id": "long"}


def told(*tables: DataFrame) -> DataFrame:
    out = None
    for t in tables:
        t = t.select(*[F.col(c) if c in t.columns else F.lit(None).cast(kind).alias(c) for c, kind in TOLD.items()])
        out = t if out is None else out.union(t)
    return out


def part_of(values: pa.Table, column: str) -> pa.Table:
    """The rows that have ``column``, by shard."""
    return values.filter(values[column].is_valid()).sort_by("shard")


def trusted_rows(docs: pa.Table, values: pa.Table) -> np.ndarray:
    return pc.is_in(docs["doc_id"], value_set=part_of(values, "id")["id"]).to_numpy()


def chunk_pairs(chunks: DataFrame, values: DataFrame, n_shards: int, n_pair_shards: int) -> DataFrame:
    """(chunk, shard, asked, own): by shard of pairs every chunk's different pairs of
    trusted words, and those of its trusted documents with their counts."""

    def run(docs: pa.Table, values: pa.Table) -> pa.Table:
        words = sequences(docs)
        keys = pair_keys(words, numbers_of(part_of(values, "ranks"), n_shards))
        trusted = np.repeat(trusted_rows(docs, values), words.lengths)
        (asked, _), (own, c) = different(keys), different(keys[trusted])
        rows: dict[int, dict] = {}
        for name, keys, counts in (("asked", asked, []), ("own", own, [c])):
            order, shards = by_pair_shard(keys, n_pair_shards)
            for shard, first, end in slices(shards):
                part = order[first:end]
                rows.setdefault(shard, {"chunk": docs["chunk"][0].as_py(), "shard": shard})[name] = of_pairs(keys[part], *(k[part] for k in counts))
        return pa.Table.from_pylist(list(rows.values()), pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("asked", pa.binary()), ("own", pa.binary())]))

    docs = chunks.where("own IS NOT NULL").select("chunk", "doc_id", "own", "order")
    return docs.groupBy("chunk").cogroup(values.groupBy("chunk")).applyInArrow(run, "chunk long, shard int, asked binary, own binary")


def classes(c: np.ndarray) -> np.ndarray:
    """0, 1, 2, and 3 for all above."""
    return np.clip(c, 0, 3).astype(np.int64)


def summed(at: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.bincount(at, values).astype(np.int64)


def pair_counts(pairs: DataFrame, n_shards: int) -> DataFrame:
    """The counts of all trusted pairs: a row per shard of pairs, of ``pairs`` and n1 to n4,
    its counts of counts; and ``stats`` rows by shard of words, of what the pairs add to a
    word's number of words before it, and, as a context, to its count and numbers of pairs
    by count."""
    schema = pa.schema([("shard", pa.int32()), ("pairs", pa.binary()), ("stats", pa.binary()), *((f"n{k}", pa.int64()) for k in (1, 2, 3, 4))])

    def run(rows: pa.Table) -> pa.Table:
        parts = [from_pairs(raw.as_py(), 1) for raw in rows["own"]]
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        c = summed(at, np.concatenate([n for _, n in parts]))
        v, w = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        number, at = np.unique(np.concatenate([v, w]), return_inverse=True)
        of_v, of_w, kind = at[: len(v)], at[len(v) :], classes(c)
        size = len(number)
        columns = [np.bincount(of_w, minlength=size), *(np.bincount(of_v, x, size).astype(np.int64) for x in (c, kind == 1, kind == 2, kind == 3))]
        shard = (number - START - 1) % n_shards
        order = np.argsort(shard, kind="stable")
        out = [{"shard": rows["shard"][0].as_py(), "pairs": of_pairs(keys, c), **{f"n{k}": int((c == k).sum()) for k in (1, 2, 3, 4)}}]
        for k, first, end in slices(shard[order]):
            part = order[first:end]
            out.append({"shard": k, "stats": planes(*(x[part].astype("<i8") for x in (number, *columns)))})
        return pa.Table.from_pylist(out, schema)

    return pairs.where("own IS NOT NULL").select("shard", "own").groupBy("shard").applyInArrow(
        run, "shard int, pairs binary, stats binary, n1 long, n2 long, n3 long, n4 long"
    )


def word_stats(counts: DataFrame) -> DataFrame:
    """A row per shard of words: ``table``, of all its numbers, ascending, their sums of
    ``pair_counts``; n1 to n4 and ``total``, the counts of counts and the sum of the
    numbers of words before; and ``start``, the start's own row, if it is there."""
    kinds = ["<i8"] * 6
    schema = pa.schema([("shard", pa.int32()), ("table", pa.binary()), *((f"n{k}", pa.int64()) for k in (1, 2, 3, 4)),
                        ("more", pa.int64()), ("total", pa.int64()), ("start", pa.list_(pa.int64()))])

    def run(rows: pa.Table) -> pa.Table:
        parts = [from_planes(raw.as_py(), *kinds) for raw in rows["stats"]]
        number, *columns = (np.concatenate(p) for p in zip(*parts, strict=True))
        number, at = np.unique(number, return_inverse=True)
        columns = [summed(at, x) for x in columns]
        before = columns[0]
        start = [x[0].item() for x in columns[1:]] if number[0] == START else None
        return pa.Table.from_pylist([{
            "shard": rows["shard"][0].as_py(), "table": planes(number, *columns), "start": start, "total": int(before.sum()),
            "more": int((before > 2).sum()), **{f"n{k}": int((before == k).sum()) for k in (1, 2, 3, 4)},
        }], schema)

    return counts.where("stats IS NOT NULL").select("shard", "stats").groupBy("shard").applyInArrow(
        run, "shard int, table binary, n1 long, n2 long, n3 long, n4 long, more long, total long, start array<long>"
    )


def told_stats(values: DataFrame, stats: DataFrame, n_shards: int) -> DataFrame:
    """(chunk, shard, stats): the sums of every word of every chunk's head."""

    def run(asked: pa.Table, stats: pa.Table) -> pa.Table:
        number, *columns = from_planes(stats["table"][0].as_py(), *["<i8"] * 6) if stats.num_rows else [np.zeros(0, np.int64)] * 6
        out = []
        for shard, raw in zip(asked["shard"].to_pylist(), asked["ranks"]):
            rank = from_planes(raw.as_py(), "<i4")[0].astype(np.int64)
            at = np.searchsorted(number, START + 1 + rank * n_shards + shard)
            known = rank >= 0
            out.append(planes(*(np.where(known, x[np.where(known, at, 0)], 0) if len(x) else np.zeros(len(rank), np.int64) for x in columns)))
        return pa.Table.from_arrays([asked["chunk"], asked["shard"], pa.array(out, pa.binary())], names=["chunk", "shard", "stats"])

    asked = values.select("chunk", "shard", "ranks")
    return asked.groupBy("shard").cogroup(stats.select("shard", "table").groupBy("shard")).applyInArrow(run, "chunk long, shard int, stats binary")


def told_pairs(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """(chunk, shard, pairs): the counts of every chunk's different pairs (0: no trusted
    one), by a join with the shards of ``pair_counts``."""

    def run(asked: pa.Table, counts: pa.Table) -> pa.Table:
        keys, c = from_pairs(counts["pairs"][0].as_py(), 1) if counts.num_rows else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        out = []
        for raw in asked["asked"]:
            (own,) = from_pairs(raw.as_py())
            at = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
            out.append(planes((np.where(keys[at] == own, c[at], 0) if len(keys) else np.zeros(len(own))).astype("<i8")))
        return pa.Table.from_arrays([asked["chunk"], asked["shard"], pa.array(out, pa.binary())], names=["chunk", "shard", "pairs"])

    asked = pairs.where("asked IS NOT NULL").select("chunk", "shard", "asked")
    known = counts.where("pairs IS NOT NULL").select("shard", "pairs")
    return asked.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(run, "chunk long, shard int, pairs binary")


class Context(NamedTuple):
    """The two levels of pairs: their discounts (of a count's class), the number of
    different pairs and the sum of what is taken off their words, and the start's sums."""

    d_pair: np.ndarray
    d_word: np.ndarray
    types: int
    off: float
    start: tuple[int, ...]


def context_of(counts: DataFrame, stats: DataFrame) -> Context:
    sums = [F.coalesce(F.sum(f"n{k}"), F.lit(0)) for k in (1, 2, 3, 4)]
    d_pair = discounts_of(*counts.where("pairs IS NOT NULL").agg(*sums).first())
    *n, more, types = stats.agg(*sums, *[F.coalesce(F.sum(c), F.lit(0)) for c in ("more", "total")]).first()
    d_word = discounts_of(*n)
    start = stats.where("start IS NOT NULL").select("start").first()
    off = sum(x * y for x, y in zip(d_word, (n[0], n[1], more)))
    return Context(np.array([0, *d_pair]), np.array([0, *d_word]), types, off, tuple(start.start if start else [0] * 4))


def pair_surprise(spell: np.ndarray, before, c, total, off_pair, types, off_word, context: Context) -> np.ndarray:
    """Negative log-probability of a word spelled at ``spell`` with ``before`` different
    words before it, after a context it follows ``c`` times: ``total`` and ``off_pair``
    are the context's count and what is taken off its pairs, ``types`` and ``off_word``
    the number of all pairs and what is taken off all words."""
    rest = np.log(np.where(types > 0, off_word / np.maximum(types, 1), 1.0)) - spell
    share = (before - context.d_word[classes(before)]) / np.maximum(types, 1)
    word = np.where(before > 0, np.log(np.where(before > 0, share + np.exp(rest), 1)), rest)
    seen = total > 0
    rest = word + np.log(np.where(seen, off_pair / np.maximum(total, 1), 1.0))
    share = (c - context.d_pair[classes(c)]) / np.maximum(total, 1)
    return -np.where(seen & (c > 0), np.log(np.where(seen & (c > 0), share + np.exp(rest), 1)), rest)


SUMS = ("nll", "nll2", "pair_nll", "pair_nll2")


def document_sums(chunks: DataFrame, values: DataFrame, upper: Upper, context: Context, n_shards: int, n_pair_shards: int) -> DataFrame:
    """Per document row of ``chunks``: its symbols, the sums of its words' negative
    log-likelihoods by themselves and, by symbol, of their squares (nll, nll2), and the
    same after the words before them (pair_nll, pair_nll2).  A trusted document's own words
    and pairs are taken off the counts."""

    def run(docs: pa.Table, values: pa.Table) -> pa.Table:
        def columns(name: str, *kinds: str) -> list[np.ndarray]:
            parts = [from_planes(raw.as_py(), *kinds) for raw in part_of(values, name)[name]]
            return [np.concatenate(p) for p in zip(*parts, strict=True)] if parts else [np.zeros(0, k) for k in kinds]

        c, x, size = columns("found", "<i8", "<f8", "<i4")
        # of the words by place, and last (at place -1) of the start
        before, total, *numbers = (np.append(k, s) for k, s in zip(columns("stats", *["<i8"] * 5), (0, *context.start)))
        off_pair = sum(d * n for d, n in zip(context.d_pair[1:], numbers))
        words = sequences(docs)
        keys = pair_keys(words, numbers_of(part_of(values, "ranks"), n_shards))
        asked, _ = different(keys)
        of_asked = np.zeros(len(asked) + 1, np.int64)
        of_asked[by_pair_shard(asked, n_pair_shards)[0]] = columns("pairs", "<i8")[0]
        trusted = trusted_rows(docs, values)
        ends = np.cumsum(words.lengths)
        n_places = len(x) + 1
        sums = np.zeros((5, docs.num_rows))
        for first in range(0, docs.num_rows, 1000):  # so many documents' words at once
            n_docs = min(1000, docs.num_rows - first)
            part = slice(ends[first] - words.lengths[first], ends[first + n_docs - 1])
            doc = np.repeat(np.arange(n_docs), words.lengths[first : first + n_docs])
            v, w, key = words.before[part], words.place[part], keys[part]
            # every different word after a word, of every document, and how often
            _, one, n = np.unique((doc * n_places + v + 1) * n_places + w, return_index=True, return_counts=True)
            doc, v, w, key = doc[one], v[one], w[one], key[one]
            pair = np.where(key > 0, of_asked[np.searchsorted(asked, key)], 0)
            mine = trusted[first + doc]
            left = np.where(mine, np.maximum(pair - n, 0), pair)
            # what a document's own pairs are of its words' and its contexts' sums
            of_w, at_w, in_w = np.unique(doc * n_places + w, return_index=True, return_inverse=True)
            in_v = np.unique(doc * n_places + v + 1, return_inverse=True)[1]
            gone = np.bincount(in_w, (pair > 0) & (left == 0), len(of_w)).astype(np.int64)
            kept = np.maximum(before[w[at_w]] - gone, 0)
            off_word = context.off - np.bincount(
                doc[at_w], context.d_word[classes(before[w[at_w]])] - context.d_word[classes(kept)], n_docs)
            types = context.types - np.bincount(doc[at_w], gone, n_docs).astype(np.int64)
            total_left = np.maximum(total[v] - np.bincount(in_v, pair - left)[in_v], 0)
            off_left = off_pair[v] - np.bincount(in_v, context.d_pair[classes(pair)] - context.d_pair[classes(left)])[in_v]
            y = pair_surprise(x[w] - upper.rest, kept[in_w], left, total_left, np.maximum(off_left, 1e-9),
                              types[doc], np.maximum(off_word, 1e-9)[doc], context)
            times = np.bincount(in_w, n, len(of_w))
            alone = with_counts(x[w[at_w]], np.maximum(c[w[at_w]] - np.where(mine[at_w], times, 0), 0), upper)
            at = slice(first, first + n_docs)
            sums[0, at] = np.bincount(doc, n * size[w], n_docs)
            sums[1, at] = np.bincount(doc[at_w], times * alone, n_docs)
            sums[2, at] = np.bincount(doc[at_w], times * alone * alone / size[w[at_w]], n_docs)
            sums[3, at] = np.bincount(doc, n * y, n_docs)
            sums[4, at] = np.bincount(doc, n * y * y / size[w], n_docs)
        return pa.Table.from_arrays(
            [*(docs[c] for c in ("k1", "k2", "doc_id", "lang")), pa.array(sums[0].astype(np.int64)), *map(pa.array, sums[1:])],
            names=["k1", "k2", "doc_id", "lang", "n_symbols", *SUMS],
        )

    docs = chunks.where("own IS NOT NULL").select("chunk", "k1", "k2", "doc_id", "lang", "own", "order")
    return docs.groupBy("chunk").cogroup(values.groupBy("chunk")).applyInArrow(
        run, "k1 long, k2 int, doc_id long, lang string, n_symbols long, " + ", ".join(f"{c} double" for c in SUMS)
    )


def log_likelihoods(docs: DataFrame, trusted_ids: DataFrame) -> tuple[str, bool]:
    """A written table of one row per row of ``docs`` (k1, k2, doc_id, lang, text):
    all but its text, and n_symbols and ``SUMS`` (``document_sums``); and whether any text
    is trusted."""
    spark = docs.sparkSession
    # few other texts are shuffled; one plan at every size: a sort-merge join
    maybe = _among(docs.select("doc_id", "text"), trusted_ids.withColumnRenamed("doc_id", "node"))
    counts = checkpointed(count_words(packed(maybe).join(trusted_ids.hint("merge"), "doc_id", "left_semi")))
    orders = fit(counts)
    spelling = spark.sparkContext.broadcast(orders)
    upper = upper_level(counts)
    written = {name: scratch_path(spark, name) for name in ("chunks", "values", "pairs", "counts", "stats", "told", "scores")}

    def once(df: DataFrame, name: str, *by: str) -> DataFrame:
        df.write.partitionBy(*by).parquet(written[name])
        spark._jvm.System.gc()  # Spark deletes shuffle files once what they were written for is collected
        return spark.read.schema(df.schema).parquet(written[name])

    n_shards, n_pair_shards = 1 + counts.count() // SHARD_WORDS, 1 + upper.total // SHARD_TOKENS
    # what a chunk holds is fixed by being written; the heads go once they are answered
    chunks = once(in_chunks(docs, n_shards).withColumn("head", F.col("words").isNotNull()), "chunks", "head")
    values = once(word_values(chunks, in_shards(counts, n_shards), spelling, upper), "values")
    drop_scratch(spark, f"{written['chunks']}/head=true")
    chunks = spark.read.schema(chunks.schema).parquet(written["chunks"])
    ids = chunks.where("own IS NOT NULL").select("chunk", F.col("doc_id").alias("id")).distinct().join(
        trusted_ids.withColumnRenamed("doc_id", "id"), "id", "left_semi")
    pairs = once(chunk_pairs(chunks, told(values.select("chunk", "shard", "ranks"), ids), n_shards, n_pair_shards), "pairs")
    known = once(pair_counts(pairs, n_shards), "counts")
    stats = once(word_stats(known), "stats")
    of_chunks = once(told_pairs(pairs, known), "told")
    drop_scratch(spark, written["pairs"])
    context = context_of(known, stats)
    answers = told(values, told_stats(values, stats, n_shards), of_chunks, ids)
    once(document_sums(chunks, answers, upper, context, n_shards, n_pair_shards), "scores")
    whole = written.pop("scores")
    for path in written.values():
        drop_scratch(spark, path)
    return whole, orders is not None


def _score(mean, deviation, nll: str = "nll"):
    n = F.when(F.col("n_symbols") > 0, F.col("n_symbols"))
    return (F.col(nll) / n - mean) / F.sqrt(deviation * deviation / n + SPREAD * SPREAD)


def _by_language(table: DataFrame) -> DataFrame:
    """A table of one row a language, to be joined: broadcast where it has at
    most ``BROADCAST_LANGUAGES`` rows, so that nothing is shuffled by language."""
    table = checkpointed(table)
    return F.broadcast(table) if table.count() <= BROADCAST_LANGUAGES else table


def fit_limits(scored: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """lang, mean, deviation, low, high of every language."""
    rows = scored.where((F.col("n_symbols") > 0) & F.col("lang").isNotNull()).join(
        trusted_ids.select("doc_id", F.lit(True).alias("trusted")), "doc_id", "left"
    ).withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    x = F.col("nll") / F.col("n_symbols")
    spread = F.sqrt(F.greatest(F.col("nll2") / F.col("n_symbols") - x * x, F.lit(1e-6)))

    def of_trusted(c: str):
        return F.sum(F.when(F.col("trusted"), F.col(c)))

    of_lang = rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("trusted").alias("n_trusted"),
        F.percentile_approx(x, 0.5, 10_000).alias("middle"), F.percentile_approx(spread, 0.5, 10_000).alias("own_spread"),
        (of_trusted("nll") / of_trusted("n_symbols")).alias("trusted_mean"),
        (of_trusted("nll2") / of_trusted("n_symbols")).alias("trusted_square"),
    )
    weight = F.col("n_trusted") * F.col("n_trusted") / (F.col("n_trusted") * F.col("n_trusted") + HALF * HALF)

    def blended(trusted, own):
        return F.col("weight") * F.coalesce(trusted, own) + (1 - F.col("weight")) * own

    trusted_spread = F.sqrt(F.greatest(F.col("trusted_square") - F.col("trusted_mean") ** 2, F.lit(1e-6)))
    middles = of_lang.withColumn("weight", weight).select(
        F.col("lang").alias("l"), "n", "weight", blended(F.col("trusted_mean"), F.col("middle")).alias("mean"),
        blended(trusted_spread, F.col("own_spread")).alias("deviation"),
    )
    keyed = rows.join(_by_language(middles), rows.lang == F.col("l"))
    score = _score(F.col("mean"), F.col("deviation"))
    quantiles = keyed.groupBy("lang", "n", "weight", "mean", "deviation").agg(
        F.percentile_approx(F.when(F.col("trusted"), score), [TAIL, 1 - TAIL], 10_000).alias("t"),
        F.percentile_approx(score, [0.25, 0.75], 10_000).alias("q"),
    )
    wide = FENCE * (1 + HALF / F.col("n")) * F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(1.35))
    return quantiles.select(
        "lang", "mean", "deviation",
        blended(MARGIN * F.least(F.col("t")[0], F.lit(0.0)), F.col("q")[0] - wide).alias("low"),
        blended(MARGIN * F.greatest(F.col("t")[1], F.lit(0.0)), F.col("q")[1] + wide).alias("high"),
    )


def judge(df: DataFrame, trusted_ids: DataFrame, into: str = "quality") -> DataFrame:
    """Every column of ``df`` (doc_id, text and lang among them), and a struct
    ``into`` of n_symbols, perplexity, score, low, high, accepted, pair_perplexity,
    pair_score and pair_high (a column of that name in the input is replaced)."""
    docs = df.drop(into)
    # what a row is: its id and its text; rows alike in both have the same sums
    keys = [F.xxhash64("doc_id", "text").alias("k1"), F.hash("doc_id", "text").alias("k2")]
    of_lm = docs.select(*keys, F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    trusted_ids = trusted_ids.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct()
    spark = df.sparkSession
    path, any_trusted = log_likelihoods(of_lm, trusted_ids)
    rows = spark.read.parquet(path)
    limits = fit_limits(rows, trusted_ids).withColumnRenamed("lang", "l").join(
        fit_limits(rows.withColumns({"nll": F.col("pair_nll"), "nll2": F.col("pair_nll2")}), trusted_ids)
        .withColumnsRenamed({c: f"pair_{c}" for c in ("lang", "mean", "deviation", "low", "high")}), F.col("l") == F.col("pair_lang")
    )
    if not any_trusted:
        limits = limits.limit(0)  # nothing was trusted: no limits
    limits = _by_language(limits)
    sums = checkpointed(rows.groupBy("k1", "k2").agg(*[F.max(c).alias(c) for c in ("n_symbols", *SUMS)]))
    drop_scratch(spark, path)
    names = [f"`{c}`" for c in docs.columns]
    hidden = [f"__{i}" for i in range(len(names))]  # the input's columns, out of the way of our own names
    work = docs.select(*[F.col(c).alias(h) for c, h in zip(names, hidden)], *keys, F.col("lang").cast("string").alias("lang"))
    scored = work.join(sums, ["k1", "k2"], "left")
    found = scored.join(limits, scored.lang == F.col("l"), "left")
    infinite = float("inf")
    # without a language: a score for information, no limits
    mean, deviation, low, high, pair_mean, pair_deviation, pair_high = (
        F.coalesce(F.col(c), F.lit(v))
        for c, v in (("mean", 0.0), ("deviation", 1.0), ("low", -infinite), ("high", infinite),
                     ("pair_mean", 0.0), ("pair_deviation", 1.0), ("pair_high", infinite)))
    score, pair_score = _score(mean, deviation), _score(pair_mean, pair_deviation, "pair_nll")

    def perplexity_of(nll: str):
        return F.when(F.col("n_symbols") > 0, F.exp(F.col(nll) / F.col("n_symbols")))

    quality = F.struct(
        "n_symbols",
        perplexity_of("nll").alias("perplexity"),
        score.alias("score"), low.alias("low"), high.alias("high"),
        F.coalesce(score.between(low, high) & (pair_score <= pair_high), F.lit(False)).alias("accepted"),
        perplexity_of("pair_nll").alias("pair_perplexity"), pair_score.alias("pair_score"), pair_high.alias("pair_high"),
    ).alias(into)
    return found.select(*[F.col(h).alias(c.strip("`")) for c, h in zip(names, hidden)], quality)


def keep_accepted(df: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """The rows of ``df`` that are accepted, with its columns."""
    into = fresh(df, "__judged")
    return judge(df, trusted_ids, into).where(F.col(into)["accepted"]).drop(into)


def perplexity(text: str, orders: list[tuple[np.ndarray, ...]]) -> float:
    """Of one text by spelling alone, on the driver (for tests and for looking at a model)."""
    x, size = spelled(WORD.findall(text), log_probabilities(orders), symbol_classes())
    return math.exp(float(x.sum() / size.sum()))
