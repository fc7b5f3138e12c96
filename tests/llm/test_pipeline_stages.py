"""Every stage of the pipeline against a plain version on that stage's input."""

import os
import tempfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from test_links_vectors_archive import brute_components
from test_text_operators import brute_hits

from forecastry.llm import pii, quality
from forecastry.session import checkpoint_root


@pytest.fixture(scope="module")
def folder(spark):
    """The smallest tables, with copies, nulls, repeated rows and clashing columns added."""
    root = tempfile.mkdtemp(prefix="pipeline-")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    again = docs.where("doc_id in (3, 5, 8)")
    other = docs.where("doc_id in (20, 21)").withColumn("doc_id", F.lit(7).cast("long"))  # an id of several texts
    nulls = docs.where("doc_id in (11, 12)").withColumn("doc_id", F.lit(None).cast("long"))
    blank = docs.limit(3).withColumns({"text": F.lit(None).cast("string"), "doc_id": F.col("doc_id") + 100_000})
    rows = docs.union(again).union(other).union(nulls).union(nulls).union(blank)
    for c in ("node", "cluster", "overlap", "quality", "word", "__id"):
        rows = rows.withColumn(c, F.lit("x"))
    rows.repartition(4).write.parquet(f"{root}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{root}/{t}.parquet")
    return root


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_stages_equal_plain_versions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(C.STAGES)
    columns = docs.columns

    # quality: exactly the rows that are judged acceptable; no text, no document
    kept = stages["quality classifier"](spark, docs, folder).persist()
    trusted = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").select("doc_id")
    judged = quality.judge(docs, trusted, "judged")
    assert kept.columns == columns
    assert rows_of(kept) == rows_of(judged.where("judged.accepted").select(*columns))
    assert kept.where("text is null").count() == 0 and 0.7 < kept.count() / docs.count() < 1

    # near duplicates: of each component the rows of its smallest id; repeated rows once
    rest = stages["near-duplicates"](spark, kept, folder).persist()
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    root = brute_components([x for x in rows if x[0] is not None], 80, 100)
    want = {(d, t) for d, t in rows if d is None or root[d] == d}
    got = [(r.doc_id, r.text) for r in rest.collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(rows) > len(want) and rest.columns == columns

    # decontamination: exactly the rows without a window of any item
    clean = stages["decontamination"](spark, rest, folder).persist()
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert clean.columns == columns
    assert rows_of(clean) == sorted(str(r) for r in rest.collect() if not brute_hits(r.text, items)[1])

    # personal data: each text with the spans that the operator finds in it replaced
    masked = stages["personal data"](spark, clean, folder).persist()
    spans = {}
    for r in pii.find(clean).collect():
        spans.setdefault(r.doc_id, set()).add(r.spans)
    by_rest = {str(r.asDict() | {"text": None, "n_chars": None}): r for r in clean.collect()}
    for r in masked.collect():
        before = by_rest[str(r.asDict() | {"text": None, "n_chars": None})] if r.doc_id not in (7, None) else None
        if before is None:
            continue
        (of,) = spans[r.doc_id]
        out, at = [], 0
        for kind, lo, hi in sorted(((k, int(a), int(b)) for k, a, b in (s.split(":") for s in of.split(",") if s)), key=lambda s: (s[1], -s[2])):
            if lo >= at:
                out += [before.text[at:lo], f"[{kind.upper()}]"]
                at = hi
        assert r.text == "".join(out) + before.text[at:] and r.n_chars == len(r.text)
    assert masked.columns == columns and masked.count() == clean.count()

    # packing: every id of every row in one piece, in order; sequences without gaps
    pieces = stages["packing"](spark, masked, folder).collect()
    tokenizer = Tokenizer.from_file(C.tokenizer_path("byte_bpe_50k.json"))
    texts = {}
    for r in masked.collect():
        texts.setdefault(r.doc_id, []).append([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0])
    of_doc, sequences = {}, {}
    for r in pieces:
        of_doc.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert of_doc.keys() == texts.keys()
    for d, ids in texts.items():
        if len(ids) == 1:
            at = 0
            for r in sorted(of_doc[d], key=lambda r: r.start):
                part = np.array(ids[0][at : at + r.length], "<u4")
                assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids[0]), zlib.crc32(part.tobytes()))
                at += r.length
            assert at == len(ids[0])
        else:
            assert sum(r.length for r in of_doc[d]) == sum(map(len, ids))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_run_equals_its_stages_and_leaves_no_folder(spark, folder):
    where = checkpoint_root(spark).replace("file:", "")
    got = sorted((str(r.doc_id), r.doc_tokens) for r in C.run(spark, folder).where("start = 0").collect())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in C.STAGES:
        docs = stage(spark, docs, folder).persist()
    assert got == sorted((str(r.doc_id), r.doc_tokens) for r in docs.where("start = 0").collect()) and len(got) > 50
    assert not [f for f in os.listdir(where) if f.startswith("pipeline-")]


def test_run_on_empty_tables(spark, folder):
    root = tempfile.mkdtemp(prefix="pipeline-")
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{root}/{t}.parquet")
    assert C.run(spark, root).count() == 0
    spark.read.parquet(f"{folder}/documents.parquet").limit(20).write.mode("overwrite").parquet(f"{root}/documents.parquet")
    assert C.run(spark, root).count() > 0
