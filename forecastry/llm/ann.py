"""Operator 8: nearest neighbours by randomly rotated one-bit codes.

Every vector is centred, turned by one random rotation and kept as the signs of
its coordinates (packed bits) with two correction scalars: the length of the
centred vector, and the cosine between it and its code.  From a query and a
code the inner product is estimated without bias, with an error bound of
``BOUND`` standard deviations.  In every block of vectors a query first scores
its best estimates exactly, which gives a sure least score; then every vector
whose estimate plus bound reaches that score is scored exactly.  Only those.

The stated query set runs against all rows in blocks: rows are dealt evenly
into blocks of at most about ``BLOCK_ROWS`` (by row number, so copies and hot ids
spread), queries into blocks of about ``BLOCK_QUERIES``, and every pair of a query
block and a row block is a group of its own, joined by both numbers, so pairs
spread over all tasks.  A query's best of each block are merged in a stream.

Vectors of different lengths have no inner product: each length is searched by
itself.  Edge cases: vectors that are null, empty, zero, or hold a null or
non-finite component take no part, nor do rows with a null id;
rows with the query's id are the query's own; ties go to the smaller id; with
fewer candidates than ``k`` all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 8192  # at most; fewer where vectors are long
BLOCK_COMPONENTS = 1 << 22
BLOCK_QUERIES = 1024
SLICE = 128  # queries whose estimates are held at once
BOUND = 2.5
FIRST = 64  # estimates scored exactly before the bound is applied
SCHEMA = "query_id long, rank int, vec_id long, score double"


def rotation(d: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.RandomState(seed).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bits, lengths and code cosines of the rows of ``x``."""
    y = (x - centre) @ turn.T
    length = np.sqrt((y * y).sum(1))
    cosine = np.abs(y).sum(1) / np.where(length > 0, length, 1) / np.sqrt(x.shape[1])
    return np.packbits(y > 0, axis=1), length, np.where(length > 0, cosine, 1)


def estimates(
    q: np.ndarray, bits: np.ndarray, length: np.ndarray, cosine: np.ndarray, centre: np.ndarray, turn: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of queries with coded rows, and their error bounds."""
    d = q.shape[1]
    signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32) * 2 - 1
    turned = (q @ turn.T).astype(np.float32)
    product = (turned @ signs.T).astype(np.float64) / np.sqrt(d)
    estimate = (q @ centre)[:, None] + product * (length / cosine)
    spread = np.sqrt(np.maximum(1 - cosine**2, 0)) / cosine / np.sqrt(max(1, d - 1))
    return estimate, np.sqrt((q * q).sum(1))[:, None] * (length * spread * BOUND)[None, :] + 1e-6


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed component by component."""
    return np.add.accumulate(x * q, axis=1)[:, -1]


def search_block(q_ids, q, ids, x, codes, centre, turn, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, ids, scores) of each query's k best in a block of rows."""
    for i in range(len(q)):
        if i % SLICE == 0:
            estimate, bound = estimates(q[i : i + SLICE], *codes, centre, turn)
        other = np.flatnonzero(ids != q_ids[i])
        if not len(other):
            continue
        e = estimate[i % SLICE, other]
        if len(other) > max(FIRST, k):
            first = other[np.argpartition(-e, max(FIRST, k))[: max(FIRST, k)]]
            least = np.partition(exact(q[i], x[first]), -k)[-k]
            other = other[e + bound[i % SLICE, other] >= least]
        score = exact(q[i], x[other])
        best = np.lexsort((ids[other], -score))[:k]
        yield int(q_ids[i]), ids[other[best]], score[best]


def _pack(batches: Iterator[pa.RecordBatch], d: int, centre: list[float] | None) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block to one row per block, with codes if a centre is given."""
    turn = rotation(d) if centre is not None else None
    block, ids, parts = None, [], []

    def packed() -> Iterator[pa.RecordBatch]:
        if block is not None:
            x = np.concatenate(parts)
            blobs = [np.concatenate(ids).tobytes(), x.tobytes()]
            names = ["ids", "x"]
            if centre is not None:
                blobs += [a.tobytes() for a in encode(x, np.array(centre), turn)]
                names += ["bits", "length", "cosine"]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), *[pa.array([b], pa.binary()) for b in blobs]], names=["block", *names]
            )

    for batch in batches:
        b = np.asarray(batch.column("block"))
        v = np.asarray(batch.column("v").flatten(), dtype=np.float64).reshape(-1, d)
        n = np.asarray(batch.column("vec_id"))
        edges = [0, *(np.flatnonzero(np.diff(b)) + 1).tolist(), len(b)]
        for lo, hi in zip(edges, edges[1:], strict=False):
            if hi > lo:
                if b[lo] != block:
                    yield from packed()
                    block, ids, parts = int(b[lo]), [], []
                ids.append(n[lo:hi])
                parts.append(v[lo:hi])
    yield from packed()


def _merged(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by query to each query's k best, held one query at a time."""
    schema = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])
    query, best = None, []

    def rows():
        return [(query, r, i, -s) for r, (s, i) in enumerate(best, 1)]

    for batch in batches:
        out = []
        for q, ids, scores in zip(*(batch.column(c).to_pylist() for c in ("query_id", "ids", "scores")), strict=True):
            if q != query:
                out += rows()
                query, best = q, []
            best = heapq.nsmallest(k, best + [(-s, i) for s, i in zip(scores, ids, strict=True)])
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    columns = list(zip(*rows(), strict=True)) if best else [[]] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def nearest(
    df: DataFrame, k: int = 20, query_every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of the largest inner
    product with each row whose id is divisible by ``query_every``."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
        & F.exists("v", lambda c: c != 0)
    )
    is_query = F.col("vec_id") % query_every == 0
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q"))
    found = df.sparkSession.createDataFrame([], SCHEMA)
    for r in lengths.where("q > 0").orderBy("d").collect():
        found = found.union(_of_length(rows.where(F.size("v") == r.d), r.d, r.n, r.q, is_query, k))
    return found


def _centre(rows: DataFrame, d: int, n: int) -> list[float]:
    """The mean vector: every task adds its rows up."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d)
        for batch in batches:
            total += np.asarray(batch.column("v").flatten(), np.float64).reshape(-1, d).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(total)], names=["i", "c"])

    sums = rows.select("v").mapInArrow(add, "i long, c double").groupBy("i").agg(F.sum("c").alias("c"))
    return [r.c / n for r in sums.orderBy("i").collect()]


def _of_length(rows: DataFrame, d: int, n: int, n_queries: int, is_query, k: int) -> DataFrame:
    query_blocks = -(-n_queries // BLOCK_QUERIES)
    blocks = -(-n // max(256, min(BLOCK_ROWS, BLOCK_COMPONENTS // d)))
    centre = _centre(rows, d, n)

    def blocked(part: DataFrame, n: int, at: list[float] | None, fields: str) -> DataFrame:
        dealt = part.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(n)))
        return dealt.repartition("block").sortWithinPartitions("block").mapInArrow(
            lambda batches: _pack(batches, d, at), f"block long, ids binary, x binary{fields}"
        )

    def numbers(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))

    of_rows = blocked(rows, blocks, centre, ", bits binary, length binary, cosine binary").withColumn("query_block", numbers(query_blocks))
    of_queries = blocked(rows.where(is_query), query_blocks, None, "").select(
        F.col("block").alias("query_block"), F.col("ids").alias("q_ids"), F.col("x").alias("q"), numbers(blocks).alias("block"),
    )

    def search(group: pa.Table) -> pa.Table:
        turn, c, out = rotation(d), np.array(centre), []
        for r in group.to_pylist():
            def floats(name: str) -> np.ndarray:
                return np.frombuffer(r[name], np.float64)

            ids = np.frombuffer(r["ids"], np.int64)
            codes = (np.frombuffer(r["bits"], np.uint8).reshape(len(ids), -1), floats("length"), floats("cosine"))
            out += search_block(np.frombuffer(r["q_ids"], np.int64), floats("q").reshape(-1, d), ids,
                                floats("x").reshape(-1, d), codes, c, turn, k)
        return pa.table({
            "query_id": pa.array([q for q, _, _ in out], pa.int64()),
            "ids": pa.array([i.tolist() for _, i, _ in out], pa.list_(pa.int64())),
            "scores": pa.array([s.tolist() for _, _, s in out], pa.list_(pa.float64())),
        })

    found = of_rows.join(of_queries, ["block", "query_block"]).groupBy("block", "query_block").applyInArrow(
        search, "query_id long, ids array<long>, scores array<double>"
    )
    return found.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(
        lambda batches: _merged(batches, k), SCHEMA
    )
