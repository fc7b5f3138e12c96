"""Operator 10: near duplicates by an LSH forest of MinHash signatures.

1. Every whole text becomes its set of word shingles (64-bit hashes) and a
   signature of ``HASHES`` MinHash values.  Texts with equal sets are one
   *class* and its smallest doc_id stands for it: copies never meet in pairs.
2. The forest has ``TREES`` sorted orders.  In tree t a class has a key (its
   ``PREFIX`` leading MinHash values there) and, after it, the rest of its
   signature.  The rows are range-partitioned and sorted by (tree, key, rest),
   so a dense region is split between tasks at a deeper level.  Neighbours are
   the rows with the longest common prefix; a row looks at the ``REACH`` rows
   before it, so its depth is ``PREFIX`` in a thin region and as deep as the
   ``REACH`` nearest share in a dense one.  Neighbours whose signatures agree
   enough (six standard deviations below the threshold) are chained.  ``REACH``
   is no cap: rows of a region with more of them, or cut by a partition's
   border, are dealt anew by region and all their signatures compared there, a
   region of more than ``REGION_ROWS`` rows in pairs of blocks.
3. Chains of all trees are contracted to *clusters*: what one or more trees
   hold close.  Within a cluster every link is confirmed on full sets by an
   inverted index, and only as many links as keep the components are sent on.
   A cluster of more than ``CLUSTER_SHINGLES`` shingles is cut into blocks and
   every pair of blocks is one piece of work of bounded size: nothing is capped.
4. Confirmed links, and those between the classes of an id with several texts, are
   contracted to components.

Two sets at the threshold 0.85 meet in no tree with probability 2e-7 (0.8:
1e-5).  Edge cases: null or empty text has an empty set, is linked with
nothing and is its own component; a text of fewer words than a shingle is one
shingle; a null doc_id takes no part (component null); a doc_id with several texts
is linked as all of them, and its rows are all in its component, but a row without
words is its own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from forecastry.llm.common import LOWER, checkpointed, fresh, id_and_text
from forecastry.llm.graph import connected_components
from forecastry.session import drop_scratch, scratch_path

HASHES = 64
TREES = 16
PREFIX = 3
REACH = 12
CLUSTER_SHINGLES = 1_000_000
REGION_ROWS = 65_536
FILTER_BITS = 1 << 23  # 1 MB
#: Simple types that cannot be sorted by.
UNORDERED = ("variant", "interval", "void")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; words are
    runs without ASCII white space, A-Z lowered."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(size, len(words))
    n = len(words) - k + 1
    s = np.full(n, k, np.uint64)
    for i in range(k):
        s = (s ^ h[i : i + n]) * _MIX
        s ^= s >> np.uint64(29)
    return np.unique(s)


def hash_factors() -> np.ndarray:
    return np.random.RandomState(11).randint(1, 2**62, HASHES).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def minhash(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The MinHash values: for each factor the least mixed product."""
    out = np.empty(len(factors), np.uint64)
    for j, f in enumerate(factors):
        x = shingles * f
        x ^= x >> np.uint64(32)
        x *= _MIX
        out[j] = x.min()
    return out


def agreement(threshold: float) -> int:
    """Least number of agreeing signature values at which a pair is followed."""
    return max(1, int(HASHES * threshold - 6 * (HASHES * threshold * (1 - threshold)) ** 0.5))


def signatures(df: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, digest (of the text), n_shingles, set_key (digest of the set), keys (one per tree) and
    sig (the low byte of every MinHash value: the top byte of a least of many is
    nearly always 0, in unrelated texts too)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = hash_factors()
        for batch in batches:
            digest, n, set_key, keys, sig = [], [], [], [], []
            for value in batch.column("text"):
                text = value.as_py()
                digest.append(None if text is None else hashlib.md5(text.encode()).digest())
                s = shingle_set(text or "", size)
                n.append(len(s))
                if not len(s):
                    set_key.append(None), keys.append(None), sig.append(None)
                    continue
                m = minhash(s, factors)
                set_key.append(hashlib.md5(s.tobytes()).digest())
                keys.append([
                    int.from_bytes(hashlib.blake2b(m[PREFIX * t : PREFIX * (t + 1)].tobytes(), digest_size=8).digest(),
                                   "little", signed=True)
                    for t in range(TREES)
                ])
                sig.append((m & np.uint64(0xFF)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(digest, pa.binary()), pa.array(n, pa.int64()), pa.array(set_key, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                names=["doc_id", "digest", "n_shingles", "set_key", "keys", "sig"],
            )

    return id_and_text(df, id_col, text_col).mapInArrow(
        run, "doc_id long, digest binary, n_shingles long, set_key binary, keys array<long>, sig binary"
    )


def chains(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (tree, key, rest) to links (a, b) between close neighbours:
    each run of neighbours to its first row, and runs to one another.

    The rows of a region (one tree and key) whose pairs were perhaps not all
    compared come out too, as (a, null, tree, key, rest): regions of more than
    REACH + 1 rows, and the first and last of the partition, which its border may cut."""
    tree = key = node = np.empty(0, np.int64)
    sig = np.empty((0, HASHES), np.uint8)

    def region_starts() -> np.ndarray:
        return np.flatnonzero(np.concatenate([[True], (tree[1:] != tree[:-1]) | (key[1:] != key[:-1])]))

    def compared(n: int, first: bool, last: bool) -> pa.RecordBatch:
        """The first ``n`` rows, which end with a region."""

        def close(lag: int) -> np.ndarray:
            """Rows that are close to the row ``lag`` before."""
            i = np.arange(lag, n)
            i = i[(tree[i] == tree[i - lag]) & (key[i] == key[i - lag])]
            return i[(sig[i] == sig[i - lag]).sum(1) >= least]

        after = close(1)
        joined = np.zeros(n, bool)
        joined[after] = True
        run = np.cumsum(~joined) - 1
        head = np.flatnonzero(~joined)
        a, b = [node[after]], [node[head[run[after]]]]
        for lag in range(2, min(REACH, n - 1) + 1):
            i = close(lag)
            i = i[run[i] != run[i - lag]]
            if len(i):
                _, one = np.unique(run[i] * n + run[i - lag], return_index=True)
                a.append(node[i[one]])
                b.append(node[i[one] - lag])
        a, b = np.concatenate(a), np.concatenate(b)
        a, b = a[a != b], b[a != b]
        starts = region_starts()
        size = np.diff(np.append(starts[starts < n], n))
        rest = size > REACH + 1
        rest[0] |= first
        rest[-1] |= last
        rest = np.flatnonzero(np.repeat(rest & (size > (0 if first or last else 1)), size))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([a, node[rest]])),
             pa.array(np.concatenate([b, np.zeros(len(rest), np.int64)]), mask=np.arange(len(a) + len(rest)) >= len(a)),
             *(pa.array(np.concatenate([np.zeros(len(a), np.int64), x[rest]])) for x in (tree, key)),
             pa.array([None] * len(a) + [row.tobytes() for row in sig[rest]], pa.binary())],
            names=["a", "b", "tree", "key", "rest"],
        )

    first = True
    for batch in batches:
        tree = np.concatenate([tree, np.asarray(batch.column("tree"))])
        key = np.concatenate([key, np.asarray(batch.column("key"))])
        node = np.concatenate([node, np.asarray(batch.column("node"))])
        new = b"".join(v.as_py() for v in batch.column("rest"))
        sig = np.concatenate([sig, np.frombuffer(new, np.uint8).reshape(-1, HASHES)])
        n = region_starts()[-1] if len(node) else 0
        if n:
            yield compared(n, first, False)
            first = False
            tree, key, node, sig = (x[n:] for x in (tree, key, node, sig))
    if len(node):
        yield compared(len(node), first, True)


def region_links(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (tree, key, i, j) to the links of each group, every pair
    of whose signatures counts; one group is held.

    A row is compared with all others; once all that were not compared yet are
    in one component, no pair is left that could join two."""
    group, nodes, parts = None, [], []

    def links() -> Iterator[pa.RecordBatch]:
        node = np.array(nodes, np.int64)
        sig = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, HASHES)
        n = len(node)
        label, waiting = np.arange(n), np.ones(n, bool)
        while waiting.any():
            left = np.flatnonzero(waiting)
            counts = np.bincount(label[left], minlength=n)
            if np.count_nonzero(counts) == 1:
                break
            # outside the largest component first
            i = left[0] if len(left) == n else left[label[left] != counts.argmax()][0]
            waiting[i] = False
            labels = np.unique(label[(sig == sig[i]).sum(1) >= least])
            if len(labels) > 1:
                label[np.isin(label, labels)] = labels[0]
        root = node[label]
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[node != root]), pa.array(root[node != root])], names=["a", "b"]
        )

    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("tree", "key", "i", "j", "node", "rest")), strict=True)
        for *at, node, rest in keys:
            if at != group:
                if len(nodes) > 1:
                    yield from links()
                group, nodes, parts = at, [], []
            nodes.append(node)
            parts.append(rest)
    if len(nodes) > 1:
        yield from links()


def in_block_pairs(rows: DataFrame, key: list[str], weights: DataFrame) -> DataFrame:
    """``rows`` (``node`` among them) with block numbers (i, j): a key of ``blocks``
    blocks in ``weights`` is cut by node, and its rows go to every pair of blocks
    they take part in, so that all pairs of the key's rows meet somewhere."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: k != F.col("own"))
    )
    return (
        rows.join(weights, key).withColumn("own", own)
        .select(*rows.columns, "own", F.explode(other).alias("k"))
        .select(*rows.columns, F.least("own", "k").alias("i"), F.greatest("own", "k").alias("j"))
    )


def block_count(weight, largest: int):
    """1, or beyond ``largest`` so many blocks that two of them weigh about ``largest``."""
    return F.when(weight <= largest, 1).otherwise(F.ceil(2 * weight / largest)).cast("int").alias("blocks")


def forest_links(classes: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between classes that some tree holds close."""
    least = agreement(threshold)
    rest = "concat(substring(sig, 3 * tree + 1), substring(sig, 1, 3 * tree))".replace("3", str(PREFIX))
    rows = classes.select("node", "sig", F.posexplode("keys").alias("tree", "key")).select(
        F.col("tree").cast("long").alias("tree"), "key", "node", F.expr(rest).alias("rest")
    )
    order = ["tree", "key", "rest", "node"]
    found = checkpointed(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(lambda batches: chains(batches, least), "a long, b long, tree long, key long, rest binary")
    )
    region = ["tree", "key"]
    dense = found.where("b is null").select(*region, F.col("a").alias("node"), "rest")
    sizes = dense.groupBy(*region).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        *region, block_count(F.col("n"), REGION_ROWS)
    )
    group = [*region, "i", "j"]
    return found.where("b is not null").select("a", "b").union(
        in_block_pairs(dense, region, sizes).repartition(*group).sortWithinPartitions(*group)
        .mapInArrow(lambda batches: region_links(batches, least), "a long, b long")
    )


def resolve(nodes: list[int], sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Links (node, root) of the components under den * |A and B| >= num * |A or B|.

    Sets are looked up in an inverted index one by one.  A set needs no look-up
    once all that were not looked up yet are in its component, so a group of
    copies of one text takes a few look-ups, not one per pair."""
    n = len(nodes)
    size = np.array([len(s) for s in sets], np.int64)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    label = np.arange(n)
    same: dict[int, int] = {}
    for i, node in enumerate(nodes):  # rows that repeat a doc_id
        label[i] = label[same.setdefault(node, i)]
    waiting = np.ones(n, bool)
    # the set whose shingles are the most common first: it links the most
    start = np.searchsorted(values, values, "left")
    stop = np.searchsorted(values, values, "right")
    common = np.bincount(owner, stop - start, minlength=n) / np.maximum(size, 1)
    queue = np.argsort(-common, kind="stable")
    while True:
        left = queue[waiting[queue]]
        if not len(left):
            break
        counts = np.bincount(label[left], minlength=n)
        if np.count_nonzero(counts) == 1:
            break
        if waiting.all():
            i = left[0]
        else:  # outside the largest component first
            i = left[label[left] != counts.argmax()][0]
        waiting[i] = False
        lo, hi = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
        reps = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(reps)[:-1]]), reps) + np.arange(reps.sum())
        both = np.bincount(owner[at], minlength=n)
        linked = np.flatnonzero((den * both >= num * (size + size[i] - both)) & (both > 0))
        labels = np.unique(label[linked])
        if len(labels) > 1:
            label[np.isin(label, labels)] = labels[0]
    least: dict[int, int] = {}
    for i in range(n):
        least[label[i]] = min(least.get(label[i], nodes[i]), nodes[i])
    return [(nodes[i], least[label[i]]) for i in range(n) if least[label[i]] != nodes[i]]


def confirmed(batches: Iterator[pa.RecordBatch], size: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group to the links of each group; one group is held."""
    group, nodes, sets = None, [], []

    def links() -> Iterator[pa.RecordBatch]:
        if len(set(nodes)) > 1:
            got = resolve(nodes, sets, num, den)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in got], pa.int64()), pa.array([b for _, b in got], pa.int64())], names=["a", "b"]
            )

    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("cluster", "i", "j", "node")), strict=True)
        for (c, i, j, node), text in zip(keys, batch.column("text"), strict=True):
            if (c, i, j) != group:
                yield from links()
                group, nodes, sets = (c, i, j), [], []
            nodes.append(node)
            sets.append(shingle_set(text.as_py() or "", size))
    yield from links()


def _among(docs: DataFrame, clusters: DataFrame) -> DataFrame:
    """``docs`` without most rows whose id is in no cluster: a filter in the scan
    by a table of ``FILTER_BITS`` bits, of the same size whatever the number of ids,
    so that few other texts are shuffled by the join that follows."""
    hashed = F.xxhash64(F.col("node"))
    words = FILTER_BITS // 32
    marks = clusters.select(
        F.pmod(hashed, F.lit(words)).cast("int").alias("word"),
        F.pmod(F.shiftrightunsigned(hashed, 32), F.lit(32)).cast("int").alias("bit"),
    ).groupBy("word").agg(*[F.max(F.col("bit") == b).alias(f"b{b}") for b in range(32)])
    packed = marks.select("word", F.expr(" + ".join(f"if(b{b}, {1 << b}L, 0L)" for b in range(32))).alias("bits"))
    table = np.zeros(words, np.uint32)
    for batch in packed.toArrow().to_batches():  # at most FILTER_BITS / 32 rows of 12 bytes
        table[np.asarray(batch.column("word"))] = np.asarray(batch.column("bits")).astype(np.uint32)
    known = docs.sparkSession.sparkContext.broadcast(table)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.asarray(batch.column("h"))
            hit = (known.value[h % words] >> ((h.view(np.uint64) >> np.uint64(32)) % np.uint64(32)).astype(np.uint32)) & np.uint32(1)
            yield batch.select(["doc_id", "text"]).filter(pa.array(hit == 1))

    hashes = docs.where("doc_id is not null").withColumn("h", F.xxhash64("doc_id"))
    return hashes.mapInArrow(keep, "doc_id long, text string")


def _percent(threshold: float) -> tuple[int, int]:
    return round(threshold * 1000), 1000


def near_duplicates(
    df: DataFrame, threshold: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest
    doc_id reachable over links of at least ``threshold``), kept."""
    return _placed(df, threshold, shingle, id_col, text_col, by_id=True).drop("digest")


def _placed(df: DataFrame, threshold: float, shingle: int, id_col: str, text_col: str, by_id: bool) -> DataFrame:
    """The rows of :func:`near_duplicates`, with the digest of each one's text;
    ``by_id``: the texts of one id are linked."""
    spark = df.sparkSession
    num, den = _percent(threshold)
    docs = id_and_text(df, id_col, text_col)

    base = scratch_path(spark, "neardup")
    signatures(df, shingle, id_col, text_col).write.parquet(f"{base}/signatures")
    sigs = spark.read.parquet(f"{base}/signatures")
    with_set = sigs.where("set_key is not null and doc_id is not null")
    with_set.groupBy("set_key").agg(
        F.min("doc_id").alias("node"),
        F.any_value("n_shingles").alias("n_shingles"), F.any_value("keys").alias("keys"), F.any_value("sig").alias("sig"),
    ).write.parquet(f"{base}/classes")
    classes = spark.read.parquet(f"{base}/classes")

    clusters = connected_components(forest_links(classes, threshold)).withColumnRenamed("root", "cluster")
    weights = (
        clusters.join(classes.select("node", "n_shingles"), "node")
        .groupBy("cluster").agg(F.sum("n_shingles").alias("w"))
        .select("cluster", block_count(F.col("w"), CLUSTER_SHINGLES))
    )
    members = in_block_pairs(clusters, ["cluster"], weights)
    group = ["cluster", "i", "j"]
    links = (
        _among(docs, clusters).join(members, F.col("doc_id") == members.node).select(*group, "node", "text")
        .repartition(*group).sortWithinPartitions(*group, "node")
        .mapInArrow(lambda batches: confirmed(batches, shingle, num, den), "a long, b long")
    )
    if by_id:
        several = with_set.groupBy("doc_id").agg(F.min("set_key").alias("lo"), F.max("set_key").alias("hi")).where("lo < hi")
        of_several = with_set.select("doc_id", "set_key").join(several.select("doc_id"), "doc_id").join(
            classes.select("set_key", "node"), "set_key"
        )
        links = links.union(of_several.select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    roots = connected_components(links)
    of_class = classes.select("set_key", "node").join(roots, "node", "left").select(
        "set_key", F.coalesce("root", "node").alias("found")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    found = checkpointed(
        sigs.select("doc_id", "digest", "n_shingles", "set_key").join(of_class, "set_key", "left")
        .select("doc_id", "digest", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )
    drop_scratch(spark, base)
    return found


def drop_near_duplicates(
    df: DataFrame, threshold: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``df`` without those whose own text's component has a smaller
    doc_id; another text of the same id is judged for itself, so no text is lost
    that is unlike all others.  Of rows that repeat an id and a text the one that
    comes first by its other (atomic) columns stays; among rows with a null id,
    which take no part otherwise, so does one of each text.  Rows without a word
    all stay."""
    id_, digest, n_ = (fresh(df, c) for c in ("__id", "__digest", "__n"))
    key = [F.col(f"`{id_col}`").cast("long").alias(id_), F.unhex(F.md5(F.col(f"`{text_col}`").cast("binary"))).alias(digest)]
    found = _placed(df, threshold, shingle, id_col, text_col, by_id=False).where("n_shingles > 0")
    marks = found.groupBy("doc_id", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce("kept", F.lit(True))).alias("kept")
    ).where("n > 1 or not kept")
    rows = df.select("*", *key)

    def same(marks: DataFrame):
        return rows[id_].eqNullSafe(marks.doc_id) & (rows[digest] == marks.digest)

    single = rows.join(marks, same(marks), "left_anti")
    again = marks.where("kept")
    atomic = [F.col(f"`{f.name}`") for f in df.schema if isinstance(t := f.dataType.jsonValue(), str) and t not in UNORDERED]
    first = Window.partitionBy(id_, digest).orderBy(*atomic)
    repeated = rows.join(again, same(again), "left_semi").withColumn(n_, F.row_number().over(first)).where(F.col(n_) == 1)
    return single.unionByName(repeated.drop(n_)).drop(id_, digest)
