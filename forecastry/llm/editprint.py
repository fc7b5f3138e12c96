"""Operator 13: document fingerprints by a randomised edit embedding.

All texts share one random function of (step, character) to {stay, move on}.  A
walk reads the character it stands on at every step, writes it down and stays or
moves on; texts a few edits apart soon walk in step again, so their edit distance
becomes a Hamming distance of what is written.  Of that, a fixed sample of steps
is kept as one random bit of the character each: every step up to ``2 * LEVEL``,
then ``LEVEL`` of every octave.  A fingerprint is the number of sampled steps its
walk took and their bits, in hex.  It depends on the whole text.

The likeness of two fingerprints estimates the share of equal steps: agreement of
the sampled bits, weighted by the steps each stands for, with the steps that only
the longer walk took counting as different; 1 for equal fingerprints, about 0 for
unrelated texts (a random bit agrees half the time, which is taken off).

:func:`edited_fingerprints` also needs the next document.  Rows are dealt by
ranges of ids, whose borders are ids of the table, and the row of a border goes to
the range before, too: one shuffle of the texts.  Within a range rows run from the
greatest id down, so that the next document is always the one before.  An id of
more rows than a range has several ranges, each with the next document.

:func:`similar_documents` samples bits of the fingerprints into bands, verifies
the fingerprints of those that share a band, and joins what is alike.

Edge cases: null text is empty; an empty text has an empty walk, whose fingerprint
is like itself only; rows that repeat an id are one document whose text, as the
next one's, is the least by digest, and are returned each; null ids come before
all others; the only document is its own next; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecastry.llm.common import id_and_text
from forecastry.llm.graph import connected_components
from forecastry.llm.neardup import block_count, in_block_pairs

LEVEL = 128
KINDS = 256  # code points are hashed to so many kinds; the last ends a text
PERIOD = 4096  # steps after which the random function repeats
AHEAD = 64  # steps between looks for walks that have ended
FEW = 24  # walks left that are finished one by one
BATCH = 4_000_000  # characters walked at once
#: Ranges of ids for every shuffle partition.
RANGES = 2


def sampled_steps() -> list[int]:
    """The sampled steps, ascending: of an octave one of every ``LEVEL``-th part."""
    random = np.random.RandomState(7)
    out = list(range(2 * LEVEL))
    lo = 2 * LEVEL
    while lo < 1 << 60:
        part = lo // LEVEL
        out += [lo + part * k + int(random.randint(part)) for k in range(LEVEL)]
        lo *= 2
    return out


def weights(n: int) -> np.ndarray:
    """Steps that each of the first ``n`` sampled steps stands for."""
    k = np.arange(n)
    return 2.0 ** np.maximum(0, k // LEVEL - 1)


class Walks:
    """The shared random function: moves by step and kind, bits by sampled step and kind."""

    def __init__(self):
        random = np.random.RandomState(13)
        self.moves = random.randint(0, 2, (PERIOD, KINDS)).astype(np.int64)
        self.moves[:, -1] = 0
        self.rows = [bytes(r) for r in self.moves.astype(np.uint8)]
        self.steps = sampled_steps()
        self.seeds = random.randint(0, 2, (len(self.steps), KINDS)).astype(np.uint8)

    def fingerprints(self, texts: list[str]) -> list[str]:
        out: list[str] = []
        lo = size = 0
        for k, text in enumerate(texts):
            size += len(text) + AHEAD
            if size > BATCH or k == len(texts) - 1:
                out += self._walk(texts[lo : k + 1])
                lo, size = k + 1, 0
        return out

    def _walk(self, texts: list[str]) -> list[str]:
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = ((points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(KINDS - 1)
        length = np.array([len(t) for t in texts], np.int64)
        start = np.concatenate([[0], np.cumsum(length + 1)])[:-1]
        track = np.full(len(points) + len(texts), KINDS - 1, np.uint8)  # every text ends with the last kind
        track[np.arange(len(points)) + np.repeat(np.arange(len(texts)), length)] = kinds
        bits = [bytearray() for _ in texts]
        walk, at, step, k = np.flatnonzero(length), start[length > 0].copy(), 0, 0
        taken: list[np.ndarray] = []  # bits of the present walks since they were last handed over

        def hand_over(walk: np.ndarray) -> None:
            if taken:
                for w, row in zip(walk.tolist(), np.array(taken).T, strict=True):
                    bits[w] += row[row < 2].tobytes()
                taken.clear()

        while len(walk) > FEW:
            for step in range(step, step + AHEAD):
                here = track[at]
                if step == self.steps[k]:
                    taken.append(np.where(here == KINDS - 1, 2, self.seeds[k][here]).astype(np.uint8))
                    k += 1
                at += self.moves[step % PERIOD][here]
            step += 1
            on = track[at] != KINDS - 1
            if not on.all() or len(taken) > 4 * LEVEL:
                hand_over(walk)
                walk, at = walk[on], at[on]
        hand_over(walk)
        for w, position in zip(walk.tolist(), at.tolist(), strict=True):
            bits[w] += self._finish(track[position : start[w] + length[w] + 1].tobytes(), step, k)
        return [f"{len(b):x}:" + np.packbits(np.frombuffer(bytes(b), np.uint8)).tobytes().hex() for b in bits]

    def _finish(self, track: bytes, step: int, k: int) -> bytes:
        """The bits of one walk from its present step on."""
        out, at, end = bytearray(), 0, KINDS - 1
        while track[at] != end:
            stop = self.steps[k]
            while step < stop:
                # up to the next sampled step, as far as the random function goes on
                n = min(stop - step, PERIOD - step % PERIOD)
                for row in self.rows[step % PERIOD : step % PERIOD + n]:
                    at += row[track[at]]
                step += n
                if track[at] == end:
                    return bytes(out)
            out.append(self.seeds[k][track[at]])
            at += self.rows[step % PERIOD][track[at]]
            step, k = step + 1, k + 1
        return bytes(out)


def bits_of(fingerprint: str) -> np.ndarray:
    n, _, hexed = fingerprint.partition(":")
    return np.unpackbits(np.frombuffer(bytes.fromhex(hexed), np.uint8), count=int(n, 16))


def likeness(a: str, b: str) -> float:
    """Of two fingerprints, from 0 to 1."""
    if a == b:
        return 1.0
    x, y = bits_of(a), bits_of(b)
    both, longest = min(len(x), len(y)), max(len(x), len(y))
    w = weights(longest)
    agree = (w[:both] * (x[:both] == y[:both])).sum()
    return float(max(0.0, 2 * agree - w[:both].sum()) / w.sum())


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of every row's whole text; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = Walks()
        for batch in batches:
            got = walks.fingerprints([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got, pa.string())], names=["doc_id", "fingerprint"])

    return id_and_text(df, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")


NULL_ID = -(2**63)  # ids are shifted so that a null id sorts before all


def borders(ids: DataFrame, ranges: int) -> tuple[list[int], list[int]]:
    """Ids at which ranges begin, ascending from the least, and the number of
    ranges of each: more than one if the id alone fills that many."""
    found = ids.agg(
        F.percentile_approx("id", [k / ranges for k in range(ranges)], 100 * ranges).alias("q"), F.min("id").alias("lo")
    ).first()
    if found.lo is None:
        return [], []
    starts = sorted([found.lo, *found.q])
    times = {s: starts.count(s) - (s == found.lo) for s in starts}  # the least is there once more
    hot = [s for s, n in times.items() if n > 1]
    if hot:  # what comes after a hot id begins a range of its own
        after = ids.agg(*[F.min(F.when(F.col("id") > s, F.col("id"))).alias(f"n{k}") for k, s in enumerate(hot)]).first()
        times |= {s: max(1, times.get(s, 1)) for s in after if s is not None}
    return sorted(times), [max(1, times[s]) for s in sorted(times)]


def deal(batches: Iterator[pa.RecordBatch], starts: list[int], times: list[int]) -> Iterator[pa.RecordBatch]:
    """Rows with their range (``part``), and the rows of borders again (``ahead``) for the
    ranges before: of a task, the least by digest of each border."""
    first = np.concatenate([[0], np.cumsum(times)])  # parts of border k: first[k] .. first[k + 1] - 1
    at_border = {s: k for k, s in enumerate(starts)}
    border, turn, least = np.array(starts, np.int64), 0, {}
    for batch in batches:
        ids = np.asarray(batch.column("id"))
        k = np.searchsorted(border, ids, "right") - 1
        times_of = np.array(times)[k]
        part = first[k] + (turn + np.arange(len(ids))) % times_of
        turn += len(ids)
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(np.zeros(n, bool)), *(batch.column(c) for c in ("id", "digest", "text"))],
            names=["part", "ahead", "id", "digest", "text"],
        )
        for row in np.flatnonzero(border[k] == ids).tolist():
            key = at_border[int(ids[row])]
            digest = batch.column("digest")[row].as_py()
            if key not in least or digest < least[key][0]:
                least[key] = (digest, batch.column("text")[row].as_py())
    for key, (digest, text) in least.items():
        before = (key - 1) % len(starts)  # after the last comes the first
        parts = list(range(first[before], first[before + 1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int64()), pa.array([True] * len(parts)), pa.array([starts[key]] * len(parts), pa.int64()),
             pa.array([digest] * len(parts), pa.binary()), pa.array([text] * len(parts), pa.string())],
            names=["part", "ahead", "id", "digest", "text"],
        )


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the next text's first."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def compare_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part, those ahead first and then the greatest id first, to
    the result; one batch and one document are held."""
    walks = Walks()
    part = current = own = following = None  # own, following: (text, fingerprint) of this id and of the next
    for whole in batches:
        sizes = np.cumsum([0, *(len(t or "") for t in whole.column("text").to_pylist())])
        lo = 0
        while lo < whole.num_rows:
            hi = max(lo + 1, int(np.searchsorted(sizes, sizes[lo] + BATCH, "right")) - 1)
            batch = whole.slice(lo, hi - lo)
            lo = hi
            texts = batch.column("text").to_pylist()
            prints = walks.fingerprints(texts)
            rows, edits, nexts = [], [], []
            for p, ahead, i, text, fp in zip(*(batch.column(c).to_pylist() for c in ("part", "ahead", "id")), texts, prints, strict=True):
                if p != part:
                    part, current, own, following = p, None, None, None
                if ahead:  # the least by digest of all tasks comes first
                    own = own or (text, fp)
                    current = NULL_ID - 1  # of no row: the next row's id differs
                    continue
                if i != current:
                    following, current, own = own, i, (text, fp)
                rows.append((i, text, fp))
                edits.append(edit(text, following[0]))
                nexts.append(following[1])
            changed = walks.fingerprints(edits)
            yield pa.RecordBatch.from_arrays([
                pa.array([None if i == NULL_ID else i for i, _, _ in rows], pa.int64()),
                pa.array([len(t) for _, t, _ in rows], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edits], pa.string()),
                pa.array([fp for _, _, fp in rows], pa.string()), pa.array(changed, pa.string()),
                pa.array([likeness(fp, e) for (_, _, fp), e in zip(rows, changed, strict=True)], pa.float64()),
                pa.array([likeness(fp, n) for (_, _, fp), n in zip(rows, nexts, strict=True)], pa.float64()),
            ], schema=RESULT)


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next
    of every row; the edited text has its last half replaced by the beginning of
    the next document, in the order of ids (after the last: the first)."""
    spark = df.sparkSession
    docs = id_and_text(df, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("digest", F.unhex(F.md5("text")))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts, times = borders(docs.select("id"), RANGES * partitions)
    schema = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'double' if f.type == pa.float64() else 'string'}" for f in RESULT)
    if not starts:
        return spark.createDataFrame([], schema)
    dealt = docs.select("id", "digest", "text").mapInArrow(
        lambda batches: deal(batches, starts, times), "part long, ahead boolean, id long, digest binary, text string"
    )
    order = ["part", F.desc("ahead"), F.desc("id"), "digest"]
    return dealt.repartition(partitions, "part").sortWithinPartitions(*order).mapInArrow(compare_ranges, schema)


BANDS = 16
BAND_BITS = 24
GROUP_ROWS = 1024


def band_keys(fingerprint: str) -> list[str]:
    """Sampled bits of the fingerprint: ``BANDS`` bands of ``BAND_BITS`` bits for each of the
    two octaves of sampled steps it reaches last, so that texts near a border
    between octaves share one.  Shorter ones are a band of their own."""
    x = bits_of(fingerprint)
    top = len(x) // LEVEL
    out = []
    for octave in range(max(0, top - 2), top):
        bits = x[octave * LEVEL : (octave + 1) * LEVEL]
        random = np.random.RandomState(octave)
        out += [f"{octave}.{b}." + np.packbits(bits[random.choice(LEVEL, BAND_BITS, replace=False)]).tobytes().hex() for b in range(BANDS)]
    return out or [fingerprint]


def similar_links(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (band, i, j) to the links of each group, enough to keep its
    components: a row already joined to the first of a component is not compared again."""
    group, heads = None, []
    for batch in batches:
        a, b = [], []
        columns = (batch.column(c).to_pylist() for c in ("band", "i", "j", "node", "fingerprint"))
        for band, i, j, node, fp in zip(*columns, strict=True):
            if (band, i, j) != group:
                group, heads = (band, i, j), []
            near = [h for h in heads if any(likeness(fp, f) >= least for _, f in h)]
            for h in near:
                a.append(node), b.append(h[0][0])
            heads = [h for h in heads if h not in near] + [[x for h in near for x in h] + [(node, fp)]]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def similar_documents(df: DataFrame, least: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint and component_id (the smallest id reachable over
    fingerprints of a likeness of ``least``) of every row with an id.

    The embedding is random: a walk now and then stays out of step after an edit,
    and then a near copy is not found.  Equal fingerprints are one node.  A band of more than ``GROUP_ROWS`` nodes is
    cut into blocks whose pairs are worked on one by one: no pair is left out."""
    rows = fingerprints(df, id_col, text_col).where("doc_id is not null")
    nodes = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("node"))

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [band_keys(fp) for fp in batch.column("fingerprint").to_pylist()]
            at = np.repeat(np.arange(batch.num_rows), [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for ks in keys for k in ks], pa.string()), *(batch.column(c).take(pa.array(at)) for c in ("node", "fingerprint"))],
                names=["band", "node", "fingerprint"],
            )

    banded = nodes.mapInArrow(bands, "band string, node long, fingerprint string")
    sizes = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "band", block_count(F.col("n"), GROUP_ROWS)
    )
    group = ["band", "i", "j"]
    links = in_block_pairs(banded, ["band"], sizes).repartition(*group).sortWithinPartitions(*group).mapInArrow(
        lambda batches: similar_links(batches, least), "a long, b long"
    )
    roots = connected_components(links)
    of_node = nodes.join(roots, "node", "left").select("fingerprint", F.coalesce("root", "node").alias("component_id"))
    return rows.join(of_node, "fingerprint").select("doc_id", "fingerprint", "component_id")
