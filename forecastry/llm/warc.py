"""Operator 3: Merkle fixity audit of web-archive replicas.

A writer lays the pages of a scan partition out as archive records, one after
the other, in segments of ``SEGMENT_RECORDS``; a record's leaf is the hash of
its offset range and of its bytes.  Leaves are hashed into trees of ``FANOUT``
children a node, up to one root per segment, with the offset range each node
covers.  An audit compares the segments' roots and then descends level by
level, looking only below nodes that differ, down to the damaged records.

Records never move: a segment belongs to the partition that wrote it, a task
holds one record, and only digests are shuffled (at most ``FANOUT`` rows a
group).  Replicas must be laid out alike; two scans of the same files are.

Edge cases: null url or html is written as empty; a null id is kept; repeated
pages are records each; very long pages are one record; an empty table has no
segments and no differences; a record missing in one replica, its range left
as a hole, is reported as lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastry.llm.common import checkpointed

FANOUT = 16
LEVELS = 2  # above the leaves; FANOUT ** LEVELS records fill a segment
SEGMENT_RECORDS = FANOUT**LEVELS
LEAVES = "segment long, record_no long, page_id long, offset long, length long, digest string"


def record_bytes(page_id: int | None, url: str, html: str) -> bytes:
    body = html.encode("utf-8", "surrogatepass")
    head = (
        f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{page_id}>\r\nWARC-Target-URI: {url}\r\n"
        f"Content-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n"
    )
    return head.encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"


def leaf_digest(offset: int, record: bytes) -> str:
    range_of = b"%d:%d:" % (offset, offset + len(record))
    return hashlib.sha256(range_of + hashlib.sha256(record).digest()).hexdigest()


def leaves(
    pages: DataFrame, lost: Column | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per record: its segment, number, offset range and digest.  Where
    ``lost`` holds, the range is left as a hole."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
        (F.lit(False) if lost is None else F.coalesce(lost, F.lit(False))).alias("lost"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, offset, first = 0, 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            out = []
            for page_id, url, html, gone in zip(*(batch.column(c) for c in ("page_id", "url", "html", "lost")), strict=True):
                if n % SEGMENT_RECORDS == 0:
                    offset = 0
                page = page_id.as_py()
                record = record_bytes(page, url.as_py(), html.as_py())
                if not gone.as_py():
                    out.append((first + n // SEGMENT_RECORDS, n % SEGMENT_RECORDS, page, offset, len(record),
                                leaf_digest(offset, record)))
                offset += len(record)
                n += 1
            names = ["segment", "record_no", "page_id", "offset", "length", "digest"]
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if name == "digest" else pa.int64()) for c, name in zip(columns, names)], names=names
            )

    return rows.mapInArrow(write, LEAVES)


def tree(records: DataFrame) -> list[DataFrame]:
    """Levels 0 (leaves) to LEVELS (roots): segment, node, digest and the range
    [first, after) of offsets covered."""
    levels = [records.select("segment", F.col("record_no").alias("node"), "digest", F.col("offset").alias("first"),
                             (F.col("offset") + F.col("length")).alias("after"))]
    for _ in range(LEVELS):
        children = F.array_sort(F.collect_list(F.struct("node", "digest")))
        named = F.transform(children, lambda c: F.concat_ws(":", c["node"].cast("string"), c["digest"]))
        levels.append(
            checkpointed(levels[-1].groupBy("segment", F.expr(f"node div {FANOUT}").alias("parent")).agg(
                F.sha2(F.concat_ws(",", named), 256).alias("digest"), F.min("first").alias("first"),
                F.max("after").alias("after"),
            ).withColumnRenamed("parent", "node"))
        )
    return levels


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """(segment, node) of the nodes that are not alike in both."""
    other = b.select("segment", "node", F.col("digest").alias("other"))
    return a.select("segment", "node", "digest").join(other, ["segment", "node"], "full").where(
        ~F.col("digest").eqNullSafe(F.col("other"))
    ).select("segment", "node")


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """Records that differ between two replicas' leaves: page_id, segment,
    record_no, offset, length and status (corrupt, or lost in a or b)."""
    a, b = checkpointed(a), checkpointed(b)
    tree_a, tree_b = tree(a), tree(b)
    bad = differing(tree_a[LEVELS], tree_b[LEVELS])
    for level in range(LEVELS - 1, -1, -1):
        below = bad.withColumnRenamed("node", "parent")
        inside = [
            t[level].withColumn("parent", F.expr(f"node div {FANOUT}")).join(below, ["segment", "parent"], "left_semi")
            for t in (tree_a, tree_b)
        ]
        bad = differing(*inside)
    key = ["segment", "record_no"]
    bad = bad.withColumnRenamed("node", "record_no")
    found = [r.join(bad, key, "left_semi").select(*key, F.struct("page_id", "offset", "length").alias(n))
             for r, n in ((a, "a"), (b, "b"))]
    status = F.when(F.col("b").isNull(), "lost in b").when(F.col("a").isNull(), "lost in a").otherwise("corrupt")
    return found[0].join(found[1], key, "full").select(F.coalesce("a", "b").alias("r"), *key, status.alias("status")).select(
        "r.page_id", *key, "r.offset", "r.length", "status"
    )
