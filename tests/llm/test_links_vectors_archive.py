"""Operators 3, 8 and 10 and the pipeline against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_cases import SF, edges  # noqa: F401

from forecastry.llm import ann, graph, neardup, warc


def brute_components(rows, num=85, den=100):
    sets = {}
    for d, t in rows:
        sets.setdefault(d, []).append(set(neardup.shingle_set(t or "").tolist()))
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if any(x and den * len(x & y) >= num * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def near_copies(seed, n):
    r = random.Random(seed)
    base = [f"w{r.randint(0, 500)}" for _ in range(120)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = f"e{r.randint(0, 10**6)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_equal_brute_force(spark):
    texts = [t for k in range(6) for t in near_copies(k, 25)] + ["", None, "tiny", "tiny", "two words"]
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cluster", F.lit("x"))
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df, 0.85).collect()}
    assert got == brute_components(rows)


def test_an_id_with_several_texts_links_their_components(spark):
    a, b, c = near_copies(3, 3)[0], near_copies(4, 3)[0], near_copies(5, 3)[0]
    rows = [(3, a), (5, a), (5, b), (7, b), (7, b), (9, c), (9, ""), (2, "one two"), (9, "one two"), (11, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles > 0, r.component_id, r.kept) for r in neardup.near_duplicates(df, 0.85).collect())
    root = brute_components(rows)
    assert {k: root[k] for k in (3, 5, 7)} == dict.fromkeys((3, 5, 7), 3) and root[9] == 2
    want = [(d, bool(t), root[d] if t else d, d == (root[d] if t else d)) for d, t in rows]
    assert got == sorted(want)


def test_the_scan_filter_keeps_every_member(spark, monkeypatch):
    monkeypatch.setattr(neardup, "FILTER_BITS", 64)  # two words: nearly everything passes, nothing wanted is lost
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    members = spark.range(0, 3000, 7).select(F.col("id").alias("node"))
    for bits in (64, 1 << 23):
        monkeypatch.setattr(neardup, "FILTER_BITS", bits)
        left = {r.doc_id for r in neardup._among(docs, members).collect()}
        assert set(range(0, 3000, 7)) <= left
    assert len(left) < 440  # few others


def test_components_of_a_long_chain(spark):
    n = 5000  # a path: more rounds than any of the others
    links = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r.node: r.root for r in graph.connected_components(links).collect()}
    assert got == dict.fromkeys(range(n), 0)


def test_large_clusters_in_blocks_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CLUSTER_SHINGLES", 900)  # a group of 40 copies takes about ten blocks
    rows = list(enumerate(near_copies(9, 40)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df, 0.85).collect()} == brute_components(rows)


def test_large_regions_in_blocks_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(neardup, "REGION_ROWS", 8)
    rows = list(enumerate(near_copies(10, 40) + near_copies(11, 30)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df, 0.85).collect()} == brute_components(rows)


def joined(n, links):
    label = list(range(n))
    for a, b in links:
        label = [label[b] if x == label[a] else x for x in label]
    return {frozenset(i for i in range(n) if label[i] == x) for x in label}


@pytest.mark.parametrize("batch_rows, borders", [(1000, []), (7, []), (50, [60, 130])])
def test_regions_lose_no_pair_beyond_reach_or_borders(batch_rows, borders):
    """Regions far larger than REACH whose close rows are not neighbours."""
    r = np.random.RandomState(5)
    rows = []
    for key, centres in ((1, 9), (2, 1), (3, 25)):
        base = r.randint(0, 256, (centres, neardup.HASHES))
        for i in range(80 if centres > 1 else 5):
            sig = base[i % centres].copy()
            sig[r.randint(0, neardup.HASHES, 14)] = r.randint(0, 256, 14)  # leading values differ: sorted far apart
            rows.append((key, sig.astype(np.uint8).tobytes()))
    rows = [(0, key, rest, node) for node, (key, rest) in enumerate(rows)]
    rows.sort()
    least = 40
    sigs = np.array([np.frombuffer(x[2], np.uint8) for x in rows])
    close = ((sigs[:, None] == sigs[None]).sum(2) >= least) & np.equal.outer(*[[x[1] for x in rows]] * 2)
    want = joined(len(rows), [(rows[i][3], rows[j][3]) for i, j in zip(*np.nonzero(np.triu(close, 1)))])

    def batches(part, names):
        for k in range(0, len(part), batch_rows):
            yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in part[k : k + batch_rows]])

    links, dense = [], []
    for lo, hi in zip([0, *borders], [*borders, len(rows)]):
        for out in neardup.chains(batches(rows[lo:hi], ("tree", "key", "rest", "node")), least):
            for x in out.to_pylist():
                if x["b"] is None:
                    dense.append((x["tree"], x["key"], 0, 0, x["a"], x["rest"]))
                else:
                    links.append((x["a"], x["b"]))
    dense.sort()
    assert joined(len(rows), links) != want  # the neighbours alone do not find all
    for out in neardup.region_links(batches(dense, ("tree", "key", "i", "j", "node", "rest")), least):
        links += [(x["a"], x["b"]) for x in out.to_pylist()]
    assert joined(len(rows), links) == want


def test_signatures_of_unrelated_long_texts_differ(spark):
    r = np.random.RandomState(5)
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in r.randint(0, 50_000, 1000))) for i in range(12)],
                                 "doc_id long, text string")
    sig = np.array([list(x.sig) for x in neardup.signatures(docs, 5, "doc_id", "text").collect()])
    agree = [(sig[i] == sig[j]).sum() for i in range(12) for j in range(i)]
    assert max(agree) <= 5


def test_near_duplicate_edges(spark, edges):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(edges, 0.85).collect()}
    assert {(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 2, 4, True), (5, 2, 4, False),
            (None, 2, None, None), (6, 1, 6, True), (8, 0, 8, True)} <= got
    kept = neardup.drop_near_duplicates(edges, 0.85)
    assert kept.columns == edges.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8]
    assert neardup.near_duplicates(edges.limit(0)).count() == 0


def test_repeated_rows_leave_one(spark):
    a, b = "a b c d e f", "g h i j k l"
    rows = [(1, a, "y"), (1, a, "x"), (1, b, "x"), (2, a, "x"), (2, "m n o p q r", "x"), (None, b, "x"), (None, b, "x"),
            (None, "s t u v w x", "x"), (3, "", "x"), (3, "", "x"), (4, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = sorted(map(str, map(tuple, neardup.drop_near_duplicates(docs, 0.8).collect())))
    assert kept == sorted(map(str, [rows[k] for k in (1, 2, 4, 5, 7, 8, 9, 10)]))


@settings(max_examples=5, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=25))
def test_components(spark, links):
    root = list(range(31))
    for _ in range(31):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in graph.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: root[n] for a, b in links for n in (a, b) if a != b}


@pytest.mark.parametrize("rows_per_block", [8192, 300])
def test_nearest_equals_brute_force(spark, monkeypatch, rows_per_block):
    monkeypatch.setattr(ann, "BLOCK_ROWS", rows_per_block)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = {r.vec_id: np.array(r.embedding) for r in df.collect()}
    ids, x = np.array(list(data)), np.array(list(data.values()))
    want = set()
    for q in ids[ids % 20 == 0]:
        s = ann.exact(data[q], x)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
        want |= {(int(q), int(ids[i])) for i in order}
    got = {(r.query_id, r.vec_id) for r in ann.nearest(df).collect()}
    assert len(got & want) / len(want) > 0.99


def test_nearest_searches_each_length(spark):
    r = np.random.RandomState(1)
    rows = [(i, r.normal(size=3 + i % 3).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(x.query_id, x.rank): x.vec_id for x in ann.nearest(df, k=4).collect()}
    want = {}
    for q, v in rows:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
            want |= {(q, k): i for k, (_, i) in enumerate(scores[:4], 1)}
    assert got.keys() == want.keys() and np.mean([got[k] == want[k] for k in want]) > 0.97


def test_nearest_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (20, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0]), (9, [])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, block int, v int")
    got = sorted(tuple(r) for r in ann.nearest(df, k=2).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0)]
    assert ann.nearest(df.limit(0)).count() == 0


def test_fixity_audit_names_the_damage(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").repartition(3, "page_id").persist()
    a = warc.leaves(pages)
    assert warc.audit(a, warc.leaves(pages)).count() == 0
    damaged = pages.withColumn("html", F.when(F.col("page_id") % 100 == 7, F.overlay("html", F.lit("~"), 1)).otherwise(F.col("html")))
    got = warc.audit(a, warc.leaves(damaged, lost=F.col("page_id") % 250 == 9)).collect()
    ids = [r.page_id for r in pages.collect()]
    assert sorted((r.page_id, r.status) for r in got) == sorted(
        [(i, "corrupt") for i in ids if i % 100 == 7] + [(i, "lost in b") for i in ids if i % 250 == 9])
    where = {(r.segment, r.record_no): (r.page_id, r.offset, r.length) for r in a.collect()}
    assert all(where[r.segment, r.record_no] == (r.page_id, r.offset, r.length) for r in got)
    ranges = sorted((s, o, o + n) for (s, _), (_, o, n) in where.items())
    assert all(e == o2 for (s, _, e), (s2, o2, _) in zip(ranges, ranges[1:]) if s == s2)


def test_fixity_edges(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "x" * 200_000), (2, "u", "x" * 200_000)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, segment string").coalesce(1)
    leaves = warc.leaves(pages)
    assert leaves.count() == 4 and warc.audit(leaves, leaves).count() == 0
    assert warc.audit(leaves, leaves.limit(0)).where("status = 'lost in b'").count() == 4
    assert warc.audit(leaves.limit(0), leaves.limit(0)).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as C

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    pieces = C.run(spark, "/root/testdata/sf0.01")
    left = {r.doc_id for r in pieces.select("doc_id").distinct().collect()}
    assert 0.6 < len(left) / len(before) < 0.95
    kept = brute_components([(d, t) for d, t in before.items() if d in left], 80, 100)
    assert all(d == c for d, c in kept.items())  # no near copies among them
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    from forecastry.llm import decontam

    hit = decontam.find_overlaps(docs, bench).where("overlap.n_hit > 0").select("doc_id").collect()
    assert not left & {r.doc_id for r in hit}


def test_oracles(spark):
    import duckdb

    from forecastry.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in ORACLES.items():
        want = con.execute(sql).df()
        got = QUERIES[name](spark, SF).toPandas()
        columns = sorted(want.columns)
        assert sorted(got.columns) == columns
        assert sorted(map(str, got[columns].itertuples(index=False))) == sorted(map(str, want[columns].itertuples(index=False)))
