"""Operators 11 to 13 against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import EDGES, SF, edges  # noqa: F401

from forecastry.llm import editprint, negatives, queries, variants

# ---- operator 11 -----------------------------------------------------------


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(rows, least_letters=7, least_count=2, ratio=10, every=31):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    words = {w: n for w, n in total.items() if n >= least_count and len(w) >= least_letters}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    form, near = {}, {}
    for w, n in words.items():
        others = [o for k in (-1, 0, 1) for o in by_length.get(len(w) + k, ()) if is_near(w, o)]
        near[w] = len(others)
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            if words[best] >= ratio * n:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, n, near[w], form.get(w), words[form[w]] if w in form else None, root(w)) for w, n in words.items()}


def found_variants(df, **options):
    got = [tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root")) for r in variants.spelling_variants(df, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_variants_equal_brute_force_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in queries.op11_spelling_variants(spark, SF).collect()}
    assert got == brute_variants(rows)


def misspelt(seed, words=40):
    """Words with chains of ever rarer misspellings, and words that share all letters."""
    r = random.Random(seed)
    out = []
    for _ in range(words):
        w = "".join(r.choice("abcdeéÿ") for _ in range(r.randint(6, 11)))
        n = 300
        while n:
            out += [w] * n
            k = r.randrange(len(w))
            w = r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice("abcdeé") + w[k:], w[:k] + r.choice("abcdeé") + w[k + 1 :]])
            n //= 10
        out += ["".join(r.sample(w, len(w)))] * 2
    r.shuffle(out)
    return [(k, " ".join(out[k::20]).upper() if k % 3 else " ".join(out[k::20])) for k in range(20)]


@pytest.mark.parametrize("block", [3, 1024])
def test_variants_in_any_block_size(spark, monkeypatch, block):
    monkeypatch.setattr(variants, "BLOCK_WORDS", block)  # cells of many blocks
    rows = misspelt(1)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for options, brute in (({"edit_every": 31}, {}), ({"ratio": 2, "least_letters": 5}, {"ratio": 2, "least_letters": 5, "every": None})):
        want = brute_variants(rows, **brute)
        assert found_variants(df, **options) == want
        assert any(r[3] is not None for r in want)


def test_variants_follow_chains_to_the_last_form(spark):
    rows = [(1, " ".join(["abcdefgh"] * 2000 + ["abcdefghi"] * 200 + ["abcdefghij"] * 20 + ["abcdefghijk"] * 2))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: r.root for r in variants.spelling_variants(df).collect()}
    assert got == dict.fromkeys(["abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk"], "abcdefgh")


def test_variants_ties_copies_and_long_runs(spark, edges):  # noqa: F811
    long = "ab" * 70_000
    rows = [(1, "xxxxxxxa " * 30 + "xxxxxxxb " * 30 + "xxxxxxxc " * 3), (1, "xxxxxxxc " * 3), (None, f"{long} {long} {long}a {long}a × ÷÷÷÷÷÷÷ ÷÷÷÷÷÷÷")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(1))
    assert found_variants(df, edit_every=31) == brute_variants(rows)
    assert {r.word: r.form for r in variants.spelling_variants(df, ratio=5).collect()}["xxxxxxxc"] == "xxxxxxxa"
    assert found_variants(edges, edit_every=31) == brute_variants(EDGES)
    assert found_variants(edges.limit(0)) == set()


# ---- operator 12 -----------------------------------------------------------


def brute_negatives(rows, every=100, positives=5, negatives_=10, share=(30, 90)):
    kept = []
    for vec_id, label, v in rows:
        if None in (vec_id, label, v) or any(c is None or not np.isfinite(c) or not np.isfinite(256.0 * c) for c in v):
            continue
        kept.append((vec_id, label, [int(np.floor(256.0 * c)) for c in v]))

    def product(a, b):
        return sum(x * y for x, y in zip(a, b, strict=True))

    out = []
    for k, (a, label, v) in enumerate(kept):
        if a % every:
            continue
        others = [(product(v, w), i, lab) for j, (i, lab, w) in enumerate(kept) if j != k and len(w) == len(v)]
        for s, p, _ in sorted((o for o in others if o[2] == label), key=lambda o: (-o[0], o[1]))[:positives]:
            inside = [o for o in others if o[2] != label and share[0] * s <= 100 * o[0] <= share[1] * s]
            for rank, (t, i, _) in enumerate(sorted(inside, key=lambda o: (-o[0], o[1]))[:negatives_], 1):
                out.append((a, p, rank, i, s, t))
    return sorted(out)


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def found_negatives(df, **options):
    return sorted(tuple(r[c] for c in COLUMNS) for r in negatives.hard_negatives(df, **options).collect())


def test_negatives_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({queries.ORACLES['op12_hard_negatives']})").fetchall())
    got = sorted(tuple(r[c] for c in COLUMNS) for r in queries.op12_hard_negatives(spark, SF).collect())
    assert got == want and len(want) > 100


SCHEMA = "vec_id long, label int, embedding array<double>, d int, block int, at string"


def vectors(seed, n, d=6, labels=3, copies=0):
    r = np.random.RandomState(seed)
    rows = [(i, int(r.randint(labels)), (r.normal(size=d) + 1).tolist()) for i in range(n)]
    return rows + [rows[0]] * copies


@pytest.mark.parametrize("cell_rows, cell_anchors, block", [(32_768, 256, 4096), (40, 3, 7)])
def test_negatives_in_any_cells(spark, monkeypatch, cell_rows, cell_anchors, block):
    for name, value in (("CELL_ROWS", cell_rows), ("CELL_ANCHORS", cell_anchors), ("BLOCK_ROWS", block)):
        monkeypatch.setattr(negatives, name, value)
    rows = vectors(3, 300) + [(i, k, v[:4]) for i, k, v in vectors(4, 80)]  # two dimensions
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)
    want = brute_negatives(rows, every=10)
    assert found_negatives(df, anchor_every=10) == want and len(want) > 500


def test_negatives_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(5, 60, copies=40) + [  # a hot vector, an anchor among its copies
        (None, 1, [1.0] * 6), (200, None, [1.0] * 6), (300, 1, None), (400, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
        (500, 1, [nan] * 6), (600, 1, [inf] * 6), (700, 1, [1e308] * 6), (800, 1, [0.0] * 6), (900, 1, []), (901, 2, []),
        (1000, 1, [1e6] * 6), (1001, 1, [1e6] * 6), (1002, 2, [5e5] * 6), (1003, 2, [-1e6] * 6),
    ]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)
    got, want = found_negatives(df), brute_negatives(rows)
    assert got == want and any(a == 1000 for a, *_ in want)
    assert found_negatives(df.limit(0)) == []
    huge = spark.createDataFrame([(0, 1, [1e12, 1.0]), (1, 1, [1e12, 2.0]), (2, 2, [5e11, 0.0])], "vec_id long, label int, embedding array<double>")
    assert found_negatives(huge) == [(0, 1, 1, 2, None, None)]


def test_bounds_hold(spark):
    r = np.random.RandomState(2)
    x = np.floor(r.normal(size=(400, 16)) * 256)
    x[:3] = [np.zeros(16), x[5], -x[5]]
    norms, stored = negatives.angles(x)
    for i in range(0, 400, 7):
        low, high = negatives.bounds(norms[i], stored[i], norms, stored)
        score = x @ x[i]
        assert (low <= score).all() and (score <= high).all()


# ---- operator 13 -----------------------------------------------------------


def brute_edits(rows):
    """(doc_id, n_chars, sha256 of the edited text) of every row."""
    key = {i: min((t or "" for d, t in rows if d == i), key=lambda t: hashlib.md5(t.encode()).digest()) for i, _ in rows}
    ids = sorted(key, key=lambda i: (i is not None, i))
    out = []
    for d, t in rows:
        t, nxt = t or "", key[ids[(ids.index(d) + 1) % len(ids)]]
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), nxt))
    return out


def check_edits(spark, df, rows):
    got = editprint.edited_fingerprints(df).collect()
    want = brute_edits(rows)
    flat = sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got)
    assert flat == sorted((str(d), n, s) for d, n, s, _ in want)
    walks, of = editprint.Walks(), {}
    for (d, n, sha, nxt), (_, t) in zip(want, rows, strict=True):
        t = t or ""
        fp, edited = walks.fingerprints([t, t[: n - n // 2] + nxt[: n // 2]])
        near = editprint.likeness(fp, walks.fingerprints([nxt])[0])
        of.setdefault((d, sha), set()).add((fp, edited, editprint.likeness(fp, edited), near))
    for r in got:
        assert (r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) in of[r.doc_id, r.edited_sha256]
    return got


def test_fingerprints_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = check_edits(spark, spark.read.parquet(f"{SF}/documents.parquet"), rows)
    text, prints = dict(rows), {}
    for r in got:
        assert prints.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
    alike = [r for r in got if r.n_chars > 400]
    assert np.mean([0.35 < r.near_edited < 0.75 for r in alike]) > 0.97
    assert np.mean([r.near_edited > r.near_next for r in alike]) > 0.97


def test_fingerprints_edge_cases(spark, edges):  # noqa: F811
    check_edits(spark, edges, EDGES)
    assert editprint.edited_fingerprints(edges.limit(0)).count() == 0
    one = spark.createDataFrame([(7, "abcdef")], "doc_id long, text string")
    assert editprint.edited_fingerprints(one).first().edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()


def test_fingerprints_of_a_hot_id_and_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(editprint, "RANGES", 6)
    r = random.Random(4)
    rows = [(i, "".join(r.choice("ab cd") for _ in range(r.randint(0, 40)))) for i in range(150)]
    rows += [(70, f"copy {k % 3} of one id") for k in range(120)] + [(149, "the last id again")] * 60 + [(0, "the first")] * 60
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check_edits(spark, df, rows)


def words(r, n):
    return " ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(n))


def test_likeness_follows_edits():
    r, walks = random.Random(6), editprint.Walks()
    for n in (100, 3000):
        a = words(r, n)
        few, many = list(a), list(a)
        for _ in range(4):
            k = r.randrange(len(few))
            few[k : k + r.randint(0, 1)] = r.choice(["x", "yy", ""])
        for _ in range(len(a) // 10):
            many[r.randrange(len(many))] = "z"
        x, f, m, o = walks.fingerprints([a, "".join(few), "".join(many), words(r, n)])
        assert editprint.likeness(x, f) > 0.6 > 0.3 > editprint.likeness(x, o)
        assert editprint.likeness(x, f) > editprint.likeness(x, m) > editprint.likeness(x, o)


def test_fingerprint_does_not_depend_on_its_batch(monkeypatch):
    r = random.Random(8)
    texts = [words(r, n) for n in (1, 5, 50, 700, 2, 300)] + ["", "é\U0001f600"] * 2
    one_by_one = [editprint.Walks().fingerprints([t])[0] for t in texts]
    monkeypatch.setattr(editprint, "FEW", 1)
    monkeypatch.setattr(editprint, "BATCH", 500)
    assert editprint.Walks().fingerprints(texts) == one_by_one


@pytest.mark.parametrize("group", [4096, 5])
def test_similar_documents_find_near_copies(spark, monkeypatch, group):
    monkeypatch.setattr(editprint, "GROUP_ROWS", group)
    r, rows = random.Random(9), []
    for k in range(12):
        base = words(r, 120)
        for c in range(8):
            text = list(base)
            for _ in range(c % 3):
                text[r.randrange(len(text))] = "#"
            rows.append((100 * k + c, "".join(text)))
    rows += [(5000, ""), (5001, None), (None, "x y z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("band", F.lit(1))
    got = {x.doc_id: x.component_id for x in editprint.similar_documents(df).collect()}
    whole = {d: 5000 if d >= 5000 else d // 100 * 100 for d, _ in rows if d is not None}
    assert got.keys() == whole.keys() and all(whole[c] == whole[d] for d, c in got.items())  # nothing foreign is joined
    text = dict(rows)
    assert all(got[d] == got[e] for d in got for e in got if (text[d] or "") == (text[e] or ""))
    assert np.mean([got[d] == whole[d] for d in got]) >= 0.9  # a walk may stay out of step after an edit
