"""Operator 9: benchmark decontamination with suffix arrays of the corpus.

The corpus is cut into shards (Arrow batches of a scan partition, at most
``SHARD_WORDS`` words each, a longer document alone).  A shard's words become
ids of the benchmark vocabulary (0: not in it) and its suffixes are sorted
into a suffix array.  Every suffix of every benchmark item is then binary-
searched in every shard: the range of suffixes that begin with the item's next
``window`` words gives all verbatim matches with their locations.

The words hit come from the ranges, and the items from the sets of items that
share a window, so a text that repeats a window that an item repeats costs its
length, not the product.  The longest matches, if asked for, are found as pairs of
a place and an item's word whose predecessors differ; how far each goes is told by
the ranks of ever longer prefixes, so a diagonal is never walked.

Suffixes that meet a word outside the vocabulary before the shortest window is
full cannot hold a window; they are left out of the array, which changes no
result.  There is no shuffle: documents stay in their partition and a task
holds one shard.  The benchmark is broadcast in parts of at most
``part_bytes``; long items are cut into pieces that overlap by a window less a
word.  One part is the rule; more are searched one after the other, each pass
writing the documents with the words hit so far, so memory has the same bound.

Edge cases: null or empty text has no words and no hits; an item with a null
id or text, or without words, takes no part; an item shorter than the window
is one window; repeated items and repeated documents are reported each (item
ids once a document); empty tables give no rows, or no hits.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecastry.llm.common import LOWER, fresh
from forecastry.session import drop_scratch, scratch_path

SHARD_WORDS = 2_000_000
PIECE_WORDS = 100_000  # of an item; longer ones are cut
# Word bytes: 0-9, a-z (after lowering), and everything beyond ASCII.
WORD_BYTES = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in LOWER)
MATCH = "struct<item_id:string,item_start:int,doc_start:int,n_words:int>"


def words(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


class BenchmarkIndex(NamedTuple):
    """The items' own vocabulary, their distinct windows, the set of items that
    each is in (by number), and each piece's windows in order."""

    vocabulary: dict[bytes, int]
    windows: dict[tuple[int, ...], int]
    set_of: list[int]
    sets: list[tuple[str, ...]]
    pieces: list[tuple[str, int, list[int]]]
    depth: int
    least: int


def index_items(items: Iterable[tuple], window: int) -> BenchmarkIndex:
    """Of (item, text) pairs, or (item, first word, text) pieces of items."""
    vocabulary: dict[bytes, int] = {}
    windows: dict[tuple[int, ...], int] = {}
    pieces = []
    for item_id, *first, text in items:
        ids = tuple([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text)])
        starts = range(max(1, len(ids) - window + 1) if ids else 0)
        pieces.append((item_id, first[0] if first else 0, [windows.setdefault(ids[s : s + window], len(windows)) for s in starts]))
    of: list[set] = [set() for _ in windows]
    for item_id, _, found in pieces:
        for w in set(found):
            of[w].add(item_id)
    numbers: dict[tuple[str, ...], int] = {}
    set_of = [numbers.setdefault(tuple(sorted(i)), len(numbers)) for i in of]
    return BenchmarkIndex(vocabulary, windows, set_of, list(numbers), pieces,
                          max(map(len, windows), default=0), min(map(len, windows), default=0))


def window_keys(index: BenchmarkIndex) -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
    """The windows, and the least and greatest key with each as prefix."""
    wins = list(index.windows)
    low = np.zeros((len(wins), index.depth), dtype=">u4")
    high = np.full((len(wins), index.depth), 0xFFFFFFFF, dtype=">u4")
    for i, w in enumerate(wins):
        low[i, : len(w)] = high[i, : len(w)] = w
    return wins, _as_bytes(low), _as_bytes(high)


def _as_bytes(rows: np.ndarray) -> np.ndarray:
    """Rows of big-endian ids as fixed-length strings: compared word by word."""
    return np.ascontiguousarray(rows).view(f"S{4 * rows.shape[1]}").ravel()


def suffix_array(ids: np.ndarray, depth: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose next ``least`` words are all in the vocabulary, sorted by
    their next ``depth`` words, and those words as sortable keys.  ``ids`` ends
    every document with a 0."""
    zero = np.flatnonzero(ids == 0)
    next_zero = zero[np.searchsorted(zero, np.arange(len(ids)))] if len(zero) else np.empty(0, int)
    run = next_zero - np.arange(len(ids))
    at = np.flatnonzero(run >= least)
    reach = np.minimum(run[at], depth)
    rows = np.zeros((len(at), depth), dtype=">u4")
    for k in range(depth):
        inside = reach > k
        rows[inside, k] = ids[at[inside] + k]
    keys = _as_bytes(rows)
    order = np.argsort(keys, kind="stable")
    return at[order], keys[order]


class Found(NamedTuple):
    """Of a document: ranges of words hit, numbers of the sets of items found,
    and the windows at its places (place, window), if matches are asked for."""

    ranges: list[tuple[int, int]]
    sets: list[int]
    places: list[tuple[int, int]]


def find_windows(docs: list[np.ndarray], index: BenchmarkIndex, keys: tuple, with_places: bool) -> list[Found]:
    starts = np.cumsum([0] + [len(d) + 1 for d in docs])
    ids = np.zeros(starts[-1], dtype=np.int64)
    for s, d in zip(starts, docs):
        ids[s : s + len(d)] = d
    wins, low, high = keys
    at, sorted_keys = suffix_array(ids, index.depth, index.least)
    lo, hi = np.searchsorted(sorted_keys, low, "left"), np.searchsorted(sorted_keys, high, "right")
    cover = np.zeros(len(ids) + 1, dtype=np.int64)
    sets: dict[int, set] = defaultdict(set)
    places: dict[int, list] = defaultdict(list)
    for w in np.flatnonzero(hi > lo).tolist():
        p = at[lo[w] : hi[w]]
        cover[p] += 1  # a place is there once
        cover[p + len(wins[w])] -= 1
        of = np.searchsorted(starts, p, "right") - 1
        for doc in np.unique(of).tolist():
            sets[doc].add(index.set_of[w])
        if with_places:
            for doc, k in zip(of.tolist(), p.tolist()):
                places[doc].append((k - int(starts[doc]), w))
    edge = np.diff(np.concatenate([[0], (np.cumsum(cover[:-1]) > 0).astype(np.int8)]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    of = np.searchsorted(starts, begin, "right") - 1
    ranges: dict[int, list] = defaultdict(list)
    for doc, b, e in zip(of.tolist(), begin.tolist(), end.tolist()):  # a text ends with a word that is never hit
        ranges[doc].append((b - int(starts[doc]), e - int(starts[doc])))
    return [Found(ranges.get(k, []), sorted(sets.get(k, ())), places.get(k, [])) for k in range(len(docs))]


def _prefix_ranks(ids: np.ndarray, longest: int) -> list[np.ndarray]:
    """Ranks of the next 1, 2, 4, ... elements at every position, up to ``longest``."""
    ranks = [np.unique(ids, return_inverse=True)[1].astype(np.int64)]
    while 2 ** len(ranks) <= longest:
        last, step = ranks[-1], 2 ** (len(ranks) - 1)
        ahead = np.concatenate([last[step:], np.full(min(step, len(last)), -1)])
        ranks.append(np.unique(last * (len(last) + 1) + ahead + 1, return_inverse=True)[1].astype(np.int64))
    return ranks


def longest_matches(places: list[tuple[int, int]], index: BenchmarkIndex, window: int) -> list[tuple]:
    """(item, item_start, doc_start, n) of all matches that cannot be extended by a window."""
    if not places:
        return []
    lengths = [len(w) for w in index.windows]
    short = [(p, w) for p, w in places if lengths[w] < window]
    full = {p: w for p, w in places if lengths[w] == window}
    hit = {w for _, w in places}
    pieces = [(item, first, ws) for item, first, ws in index.pieces if not hit.isdisjoint(ws)]
    out = [(item, first, p, lengths[w]) for p, w in short for item, first, ws in pieces if ws == [w]]
    pieces = [x for x in pieces if lengths[x[2][0]] == window]
    if full and pieces:
        # the document's windows (-1: none), then every piece's, each ended by a number of its own
        n = max(full) + 2
        parts, offsets = [np.full(n, -1, np.int64)], []
        parts[0][list(full)] = list(full.values())
        for k, (_, _, ws) in enumerate(pieces):
            offsets.append(n + 1)
            parts += [np.array([-2 - k]), np.array(ws, np.int64)]
            n += 1 + len(ws)
        ids = np.concatenate([*parts, [-2 - len(pieces)]])
        doc = np.array(sorted(full), np.int64)
        item_at = np.concatenate([o + np.arange(len(ws)) for o, (_, _, ws) in zip(offsets, pieces)])
        item_at = item_at[np.isin(ids[item_at], ids[doc])]
        before_doc = np.where(doc > 0, ids[doc - 1], -1)

        def grouped(key: np.ndarray, value: np.ndarray) -> dict[int, np.ndarray]:
            order = np.argsort(key, kind="stable")
            cut = np.flatnonzero(np.diff(key[order])) + 1
            return {int(key[g[0]]): value[g] for g in np.split(order, cut) if len(g)}

        a, b = [], []
        of_item = grouped(ids[item_at], item_at)
        for w, group in grouped(ids[doc], np.arange(len(doc))).items():
            if w not in of_item:
                continue
            by_last = grouped(ids[of_item[w] - 1], of_item[w])
            for last, same in grouped(before_doc[group], doc[group]).items():
                # a place goes with the item's words that another window comes before; one without a window before, with all
                for other, starts in by_last.items():
                    if other != last or last < 0:
                        a.append(np.repeat(same, len(starts))), b.append(np.tile(starts, len(same)))
        if a:
            p, q = np.concatenate(a), np.concatenate(b)
            x, y = p.copy(), q.copy()
            ranks = _prefix_ranks(ids, max(len(ws) for _, _, ws in pieces))
            for k in reversed(range(len(ranks))):
                same = ranks[k][np.minimum(x, len(ids) - 1)] == ranks[k][np.minimum(y, len(ids) - 1)]
                x, y = x + same * 2**k, y + same * 2**k
            of = np.searchsorted(offsets, q, "right") - 1
            firsts = np.array([f for _, f, _ in pieces])[of] + q - np.array(offsets)[of]
            out += [(pieces[o][0], int(f), int(d), int(n)) for o, f, d, n in zip(of, firsts, p, x - p + window - 1)]
    return _join_diagonals(out)


def _join_diagonals(found: list[tuple]) -> list[tuple]:
    """Matches of pieces that are one match of their item, as one."""
    out: list[list] = []
    for item, i, d, n in sorted(found, key=lambda m: (m[0], m[2] - m[1], m[2])):
        if out and out[-1][0] == item and out[-1][2] - out[-1][1] == d - i and d <= out[-1][2] + out[-1][3]:
            out[-1][3] = max(out[-1][3], d + n - out[-1][2])
        else:
            out.append([item, i, d, n])
    return [tuple(m) for m in sorted(out, key=lambda m: (m[2], m[0], m[1]))]


def search_shard(docs: list[np.ndarray], index: BenchmarkIndex, keys: tuple) -> list[tuple[int, list[tuple]]]:
    """(number of words hit, longest matches) of each document of a shard."""
    found = find_windows(docs, index, keys, True)
    return [(sum(e - b for b, e in f.ranges), longest_matches(f.places, index, index.depth)) for f in found]


def joined_ranges(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted([*a, *b]):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _shards(values: Iterator, vocabulary: dict) -> Iterator[list[np.ndarray]]:
    class Lookup(dict):
        def __missing__(self, _):
            return 0

    get = Lookup(vocabulary).__getitem__
    shard, size = [], 0
    for value in values:
        ws = words(value.as_py() or "")
        shard.append(np.fromiter(map(get, ws), dtype=np.int64, count=len(ws)))
        size += len(ws)
        if size >= SHARD_WORDS:
            yield shard
            shard, size = [], 0
    if shard:
        yield shard


def _pieces(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """(item, first, text) of at most ``PIECE_WORDS`` words: long items are cut so
    that every window is whole in one piece."""
    step = max(1, PIECE_WORDS - window + 1)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ws = words(text)
                if len(ws) <= PIECE_WORDS:
                    out.append((item, 0, text))
                    continue
                out += [(item, k, b" ".join(ws[k : k + PIECE_WORDS]).decode()) for k in range(0, len(ws) - window + 1, step)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.string()))], names=["item", "first", "text"]
                )

    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).dropna()
    return items.mapInArrow(cut, "item string, first long, text string")


def _parts(pieces: DataFrame, part_bytes: int) -> list[DataFrame]:
    """The pieces dealt to parts of at most ``part_bytes`` (or of one piece)."""
    weight = F.sum(F.octet_length("text") + 16)
    size = pieces.agg(weight).first()[0] or 0
    n, of = 1, None
    if size > part_bytes:
        n = -(-2 * size // part_bytes)
        while True:
            of = F.pmod(F.xxhash64("item", "first", "text"), F.lit(n).cast("long"))
            worst = pieces.groupBy(of.alias("p")).agg(weight.alias("w"), F.count_distinct("item", "first", "text").alias("k"))
            # a part of one piece (and its copies) cannot be cut further
            if not worst.where((F.col("w") > part_bytes) & (F.col("k") > 1)).count():
                break
            n *= 2
    return [pieces if of is None else pieces.where(of == k).distinct() for k in range(n)]


def find_overlaps(
    df: DataFrame, benchmark: DataFrame, window: int = 10, part_bytes: int = 64 << 20,
    text_col: str = "text", item_col: str = "item_id", benchmark_text_col: str = "text", into: str = "overlap",
    matches: bool = True,
) -> DataFrame:
    """Every column of ``df`` and a struct column ``into`` with n_words,
    n_hit (words inside any occurrence of a window), items (those with an
    occurring window, sorted) and matches (the longest verbatim matches; null unless
    asked for).  A column of that name in the input is replaced."""
    spark, keep = df.sparkSession, [c for c in df.columns if c != into]
    parts = _parts(_pieces(benchmark, window, item_col, benchmark_text_col), part_bytes)
    rows, last = df.select(*[F.col(f"`{c}`") for c in keep]), None
    for k, part in enumerate(parts):
        index = index_items(sorted((r["item"], r["first"], r["text"]) for r in part.collect()), window)
        rows = _search_part(rows, spark.sparkContext.broadcast(tuple(index)), window, text_col, into, matches, again=k > 0)
        if k < len(parts) - 1:  # each pass ends in a table, so that one part is held at a time
            path = scratch_path(spark, "overlaps")
            rows.write.parquet(path)
            rows = spark.read.parquet(path)
            if last:
                drop_scratch(spark, last)
            last = path
    names = ["n_words", "n_hit", "items", "matches"]
    return rows.select(*[F.col(f"`{c}`") for c in keep], F.struct(*[F.col(f"`{into}`.{n}") for n in names]).alias(into))


def _search_part(rows: DataFrame, index, window: int, text_col: str, into: str, matches: bool, again: bool) -> DataFrame:
    """The documents with what this part of the benchmark adds (``again``: to the part before)."""
    ready: list = []
    match = pa.struct([("item_id", pa.string()), ("item_start", pa.int32()), ("doc_start", pa.int32()),
                       ("n_words", pa.int32())])
    overlap = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                         ("matches", pa.list_(match)), ("ranges", pa.list_(pa.list_(pa.int32())))])
    keep = [c for c in rows.columns if c != into]
    nothing = Found([], [], [])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not ready:
            got = BenchmarkIndex(*index.value)
            ready.append((got, window_keys(got) if got.windows else None))
        idx, keys = ready[0]
        for batch in batches:
            out = []
            before = batch.column(into).to_pylist() if again else None
            for shard in _shards(iter(batch.column(text_col)), idx.vocabulary):
                found = find_windows(shard, idx, keys, matches) if keys else [nothing] * len(shard)
                for doc, f in zip(shard, found):
                    old = before[len(out)] if again else {"ranges": [], "items": [], "matches": []}
                    ranges = joined_ranges([tuple(r) for r in old["ranges"]], f.ranges)
                    longest = None
                    if matches:
                        longest = [tuple(m.values()) for m in old["matches"]] + longest_matches(f.places, idx, window)
                        longest = [dict(zip(("item_id", "item_start", "doc_start", "n_words"), m)) for m in
                                   (_join_diagonals(longest) if again else longest)]
                    out.append({"n_words": len(doc), "n_hit": sum(e - b for b, e in ranges),
                                "items": sorted({i for k in f.sets for i in idx.sets[k]} | set(old["items"])),
                                "matches": longest, "ranges": ranges})
            columns = [batch.column(c) for c in keep] + [pa.array(out, overlap)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, into])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != into)
    schema = (fields + ", " if fields else "") + (
        f"`{into}` struct<n_words:bigint,n_hit:bigint,items:array<string>,matches:array<{MATCH}>,ranges:array<array<int>>>"
    )
    return rows.mapInArrow(search, schema)


def remove_contaminated(df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` without any benchmark window, all columns as they were."""
    into = fresh(df, "__overlap")
    return find_overlaps(df, benchmark, into=into, matches=False, **options).where(F.col(into)["n_hit"] == 0).drop(into)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(set(items))).encode()).hexdigest()
