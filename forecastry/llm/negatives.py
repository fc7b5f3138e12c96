"""Operator 12: hard negatives by angular triangle filtering.

Rows become integer vectors (``floor(scale * x)``).  Each stores its norm and its
angles to ``REFERENCES`` fixed directions.  The angle between two vectors lies
between the difference and the sum of their angles to any direction, so the
directions together give an interval of cosines and, times the norms, bounds of
the inner product, widened by more than rounding can cost.

Search goes in two passes of anchors against all rows, in blocks:

1. Positives: among an anchor's own label, the ``positives``-th greatest lower
   bound is a sure least score; only rows whose upper bound reaches it get the
   integer product.
2. Negatives: a positive's window of scores is known then; only rows of another
   label whose interval overlaps a window, and reaches the ``negatives``-th
   greatest lower bound of the rows surely inside, get the integer product.

Every scan task packs its rows into blocks, so no row is shuffled alone.  Blocks
are dealt in turn to row slices and anchors to anchor slices, and a cell of one
row slice and one anchor slice is one piece of work: its anchors are held, row
blocks stream by, and an anchor's best few rows of each block are sent.

Edge cases: rows with a null id, label or vector, or a null or non-finite
component (also after scaling) take no part; vectors of different lengths never
meet, as they have no inner product; rows that repeat an id are rows of their
own, as anchors, positives and negatives (only the anchor's own row is left
out); products beyond 2^53 are computed in Python's integers, and scores beyond a
long are null, but ranked (as far as 10^35); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecastry.llm.common import checkpointed
from forecastry.session import drop_scratch, scratch_path

REFERENCES = 8
BLOCK_ROWS = 4096
BLOCK_COMPONENTS = 1 << 20
CELL_ROWS = 32_768
CELL_ANCHORS = 256
#: Stored angles and their cosines are off by far less (arccos near 1: 5e-8).
ANGLE_GUARD = 1e-6
SCORE_GUARD = 1e-9
EXACT = 2.0**53
LARGEST = 10**35  # scores beyond it count as it


def directions(d: int) -> np.ndarray:
    """The reference directions: half random, half with all components of one
    sign in turn over halves, quarters, ... of the components."""
    random = np.random.RandomState(12).normal(size=(REFERENCES, d))
    at = np.arange(d)
    for k in range(REFERENCES // 2):
        random[k] = np.where((at >> max(0, d.bit_length() - 1 - k)) % 2, -1.0, 1.0)
    return random / np.sqrt((random * random).sum(1))[:, None]


def angles(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms of the rows, and their angles to the directions (0 for a zero row)."""
    largest = np.abs(x).max(1, initial=0.0)
    unit = x / np.where(largest > 0, largest, 1)[:, None]
    norm = np.sqrt((unit * unit).sum(1))
    unit /= np.where(norm > 0, norm, 1)[:, None]
    return norm * largest, np.arccos(np.clip(unit @ directions(x.shape[1]).T, -1, 1))


def bounds(norm: float, angle: np.ndarray, norms: np.ndarray, stored: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of a vector with each of the rows."""
    least = np.abs(stored - angle).max(1) - ANGLE_GUARD
    both = stored + angle
    most = np.minimum(both, 2 * np.pi - both).min(1) + ANGLE_GUARD
    product = norm * norms
    guard = product * SCORE_GUARD + 1
    return (product * np.cos(np.clip(most, 0, np.pi)) - guard, product * np.cos(np.clip(least, 0, np.pi)) + guard)


def products(a: np.ndarray, norm: float, x: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Integer inner products of a vector with rows: exact in double precision
    where all sums stay below 2^53, otherwise by Python's integers."""
    if not len(x):
        return np.empty(0, np.int64)
    if norm * norms.max() < EXACT / 2:  # also bounds every partial sum, by Cauchy and Schwarz
        return (x @ a).astype(np.int64)
    whole = [int(v) for v in a]
    return np.array([sum(p * int(v) for p, v in zip(whole, row, strict=True)) for row in x], dtype=object)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k greatest scores, ties to the smaller id."""
    if score.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-score[i], ids[i]))[:k], np.int64)
    if len(score) > 4 * k:
        top = np.flatnonzero(score >= np.partition(score, -k)[-k])
        return top[np.lexsort((ids[top], -score[top]))[:k]]
    return np.lexsort((ids, -score))[:k]


class Rows:
    """A block of rows: ids, row numbers, labels, vectors, norms, angles."""

    def __init__(self, r: dict):
        self.ids, self.at = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["at"], np.int64)
        self.labels = np.frombuffer(r["labels"], np.int64)
        self.x = np.frombuffer(r["x"], np.float64).reshape(len(self.ids), r["d"])
        self.norms = np.frombuffer(r["norms"], np.float64)
        self.angles = np.frombuffer(r["angles"], np.float64).reshape(-1, REFERENCES)


def positives_in(anchor: Rows, rows: Rows, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of the k best rows of an anchor's label."""
    own = np.flatnonzero((rows.labels == anchor.labels[0]) & (rows.at != anchor.at[0]))
    if len(own) > k:
        low, high = bounds(anchor.norms[0], anchor.angles[0], rows.norms[own], rows.angles[own])
        own = own[high >= np.partition(low, -k)[-k]]
    score = products(anchor.x[0], anchor.norms[0], rows.x[own], rows.norms[own])
    top = best(score, rows.ids[own], k)
    return own[top], score[top]


def negatives_in(
    anchor: Rows, rows: Rows, scores: list[int], share: tuple[int, int], k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of the rows of another label that are among the k
    best of the window of any of the positive scores."""
    other = np.flatnonzero(rows.labels != anchor.labels[0])
    windows = [(share[0] * s, share[1] * s) for s in sorted(set(scores)) if s >= 0]  # of 100 times a score; below 0 it is empty
    if not len(other) or not windows:
        return other[:0], np.empty(0, np.int64)
    low, high = bounds(anchor.norms[0], anchor.angles[0], rows.norms[other], rows.angles[other])
    low, high = 100 * low, 100 * high
    wanted = np.zeros(len(other), bool)
    for least, most in windows:
        overlaps = (high >= least) & (low <= most)
        inside = low[(low >= least) & (high <= most)]
        if len(inside) > k:
            overlaps &= high >= np.partition(inside, -k)[-k]
        wanted |= overlaps
    other = other[wanted]
    score = products(anchor.x[0], anchor.norms[0], rows.x[other], rows.norms[other])
    keep = np.zeros(len(other), bool)
    for least, most in windows:
        within = np.flatnonzero((100 * score >= least) & (100 * score <= most))
        keep[within[best(score[within], rows.ids[other[within]], k)]] = True
    return other[keep], score[keep]


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows to blocks of one dimension each, as they come, with a number (``block``) of their own
    and norms and angles; ``at`` numbers the rows."""
    task, seen = TaskContext.get().partitionId(), 0
    for batch in batches:
        lengths = np.asarray(batch.column("d"))
        for d in np.unique(lengths).tolist():
            mine = np.flatnonzero(lengths == d)
            size = max(1, min(BLOCK_ROWS, BLOCK_COMPONENTS // max(1, d)))
            for k in range(0, len(mine), size):
                part = batch.take(pa.array(mine[k : k + size]))
                x = np.floor(np.asarray(part.column("v").flatten(), np.float64)).reshape(part.num_rows, d)
                norms, stored = angles(x)
                at = (task << 40) + seen + np.arange(part.num_rows)
                blobs = [np.asarray(part.column("vec_id")), at, np.asarray(part.column("label")), x, norms, stored]
                # the task's blocks start where its number says, so that tasks of one block each are dealt evenly
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task + seen // size], pa.int64()), pa.array([d], pa.int64()), pa.array([part.num_rows], pa.int64()),
                     *[pa.array([np.ascontiguousarray(b).tobytes()], pa.binary()) for b in blobs]],
                    names=["block", "d", "n", "ids", "at", "labels", "x", "norms", "angles"],
                )
                seen += part.num_rows


PACKED = "block long, d long, n long, ids binary, at binary, labels binary, x binary, norms binary, angles binary"
BLOBS = ["ids", "at", "labels", "x", "norms", "angles"]


def single_anchors(batches: Iterator[pa.RecordBatch], every: int) -> Iterator[pa.RecordBatch]:
    """The anchors of each block, each packed alone under its row's number."""
    for batch in batches:
        for r in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
            block = Rows(r)
            mine = np.flatnonzero(block.ids % every == 0)
            parts = [block.ids, block.at, block.labels, block.x, block.norms, block.angles]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.at[mine]), pa.array([r["d"]] * len(mine), pa.int64()), pa.array(block.ids[mine]),
                 *[pa.array([np.ascontiguousarray(p[m : m + 1]).tobytes() for m in mine], pa.binary()) for p in parts]],
                names=["anchor_at", "d", "anchor_id", *BLOBS],
            )


def in_cells(rows: DataFrame, anchors: DataFrame, p: int, q: int) -> DataFrame:
    """Blocks of rows and single anchors (``kind`` 1 and 0; these with the
    scores of their positives) in the cells of ``p`` row and ``q`` anchor slices."""
    every_p, every_q = (F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")) for n in (p, q))
    of_rows = rows.select("d", F.pmod("block", F.lit(p).cast("long")).alias("i"), F.explode(every_q).alias("j"),
                          F.lit(1).alias("kind"), F.lit(None).cast("array<string>").alias("scores"), *BLOBS)
    of_anchors = anchors.select("d", F.explode(every_p).alias("i"),
                                F.pmod(F.xxhash64("anchor_at"), F.lit(q).cast("long")).alias("j"), F.lit(0).alias("kind"), "scores", *BLOBS)
    return of_rows.union(of_anchors).repartition("d", "i", "j").sortWithinPartitions("d", "i", "j", "kind")


def search_cells(batches: Iterator[pa.RecordBatch], find: Callable) -> Iterator[pa.RecordBatch]:
    """Cells, anchors first, to the rows that ``find(anchor, scores, block)``
    names; a cell's anchors and one row block are held."""
    cell, held = None, []
    for batch in batches:
        for r in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
            if (r["d"], r["i"], r["j"]) != cell:
                cell, held = (r["d"], r["i"], r["j"]), []
            block = Rows(r)
            if not r["kind"]:
                held.append((block, [int(s) for s in r["scores"] or ()]))
                continue
            found = [(anchor.at[0], *find(anchor, scores, block)) for anchor, scores in held]
            at = np.concatenate([at for _, at, _ in found]) if found else np.empty(0, np.int64)
            names = np.repeat([a for a, _, _ in found], [len(at) for _, at, _ in found]) if found else at
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(block.ids[at]), pa.array(block.at[at]),
                 pa.array([str(max(-LARGEST, min(LARGEST, int(s)))) for _, _, score in found for s in score], pa.string())],
                names=["anchor_at", "vec_id", "at", "score"],
            )


def _found(cells: DataFrame, find: Callable) -> DataFrame:
    found = cells.mapInArrow(lambda batches: search_cells(batches, find), "anchor_at long, vec_id long, at long, score string")
    return found.withColumn("score", F.col("score").cast("decimal(38,0)"))


def _first(rows: DataFrame, key: list[str], k: int) -> DataFrame:
    """``rank`` 1 to ``k`` of every key, by score, id and row number."""
    order = Window.partitionBy(*key).orderBy(F.desc("score"), "vec_id", "at")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame, anchor_every: int = 100, positives: int = 5, negatives: int = 10, share: tuple[int, int] = (30, 90),
    scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``anchor_every``; a positive's
    negatives score between ``share`` percent of its score, ends included."""
    spark, base = df.sparkSession, scratch_path(df.sparkSession, "negatives")
    taking_part = df.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
        F.transform(F.col(vector_col).cast("array<double>"), lambda c: c * F.lit(scale)).alias("v"),
    ).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    ).withColumn("d", F.size("v").cast("long"))
    taking_part.mapInArrow(pack, PACKED).write.parquet(f"{base}/rows")
    rows = spark.read.parquet(f"{base}/rows")
    rows.mapInArrow(
        lambda batches: single_anchors(batches, anchor_every),
        "anchor_at long, d long, anchor_id long, " + ", ".join(f"{b} binary" for b in BLOBS),
    ).write.parquet(f"{base}/anchors")
    anchors = spark.read.parquet(f"{base}/anchors")
    n, m = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], anchors.count()
    p, q = max(1, -(-n // CELL_ROWS)), max(1, -(-m // CELL_ANCHORS))

    cells = in_cells(rows, anchors.withColumn("scores", F.lit(None).cast("array<string>")), p, q)
    _first(_found(cells, lambda anchor, _, block: positives_in(anchor, block, positives)), ["anchor_at"], positives).select(
        "anchor_at", F.col("vec_id").alias("positive_id"), F.col("at").alias("positive_at"), F.col("score").alias("positive_score")
    ).write.parquet(f"{base}/positives")
    chosen = spark.read.parquet(f"{base}/positives")

    scores = chosen.groupBy("anchor_at").agg(F.collect_list(F.col("positive_score").cast("string")).alias("scores"))
    cells = in_cells(rows, anchors.join(scores, "anchor_at"), p, q)
    found = _found(cells, lambda anchor, scores, block: negatives_in(anchor, block, scores, share, negatives))
    inside = (F.col("score") * 100 >= F.col("positive_score") * share[0]) & (F.col("score") * 100 <= F.col("positive_score") * share[1])
    ranked = _first(found.join(chosen, "anchor_at").where(inside), ["anchor_at", "positive_at"], negatives)
    result = checkpointed(ranked.join(anchors.select("anchor_at", "anchor_id"), "anchor_at").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        F.col("positive_score").try_cast("long").alias("positive_score"), F.col("score").try_cast("long").alias("negative_score"),
    ))
    drop_scratch(spark, base)
    return result
