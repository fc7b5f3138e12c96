"""Registered queries of the training-data operators, with production
parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastry.llm import (
    ann, decontam, editprint, neardup, negatives, packing, pii, quality, tokens, toxicity, variants, warc,
)
from forecastry.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_pii(spark, sf):
    """Personal data in every document: the rules' spans and the model's."""
    return pii.find(table(spark, sf, "documents"))


def op2_toxicity(spark, sf):
    """A chain over the labels: low quality, toxic, and both at once."""
    labels = table(spark, sf, "labels").select(
        "doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic",
        ((1 - F.col("quality")) * F.col("toxic")).alias("toxic_low_quality"),
    )
    return toxicity.score(table(spark, sf, "documents"), labels, ["low_quality", "toxic", "toxic_low_quality"])


def op3_fixity(spark, sf):
    """All pages as an archive and a replica of it in which, by a rule on the
    page id, some records have one byte changed and some are lost: the audit
    names exactly those."""
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    changed = F.concat(F.lit("~"), F.expr("substring(html, 2)"))
    ascii_first = F.octet_length(F.substring("html", 1, 1)) == 1
    replica = pages.withColumn("html", F.when((F.col("page_id") % 97 == 13) & ascii_first, changed).otherwise(F.col("html")))
    return warc.audit(warc.leaves(pages), warc.leaves(replica, lost=F.col("page_id") % 389 == 7))


def op4_token_counts(spark, sf):
    """Tokens of every document by the word-end vocabulary, limit 2048."""
    return tokens.token_counts(table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"), limit=2048)


def op5_packing(spark, sf):
    """All documents packed into sequences of at most 1024 ids: the pieces."""
    return packing.pack_pieces(table(spark, sf, "documents"), tokenizer_path("byte_bpe_50k.json"), window=1024)


def op6_quality(spark, sf):
    """Every document's perplexity under the model of the documents labelled
    good, its language's limits, and the decision."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    judged = quality.judge(docs, table(spark, sf, "labels").where("quality = 1").select("doc_id"))
    return judged.select("doc_id", "lang", "quality.*")


def op7_packed_matrices(spark, sf):
    """The packed id matrices: one row of 2048 ids per sequence, with segment
    lengths, position resets and the documents they come from."""
    return packing.pack_matrices(table(spark, sf, "documents"), tokenizer_path("byte_bpe_50k.json"), window=2048)


def op8_nearest(spark, sf):
    """The 20 nearest of all vectors to each whose id is divisible by 20."""
    return ann.nearest(table(spark, sf, "embeddings"), k=20, query_every=20)


def op9_decontamination(spark, sf):
    """Benchmark windows of ten words in every document."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontam.find_overlaps(docs, table(spark, sf, "benchmark"), window=10, matches=False)
    items = F.col("overlap.items")
    return found.select(
        "doc_id",
        F.col("overlap.n_words").alias("n_words"),
        F.col("overlap.n_hit").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        (F.col("overlap.n_hit") > 0).alias("contaminated"),
    )


def op10_near_duplicates(spark, sf):
    """Components of documents linked at 0.85 on sets of five-word shingles."""
    return neardup.near_duplicates(table(spark, sf, "documents"), threshold=0.85, shingle=5)


def op11_spelling_variants(spark, sf):
    """Words of seven letters and more, their near words and forms."""
    return variants.spelling_variants(
        table(spark, sf, "documents"), least_letters=7, least_count=2, ratio=10, edit_every=31
    )


def op12_hard_negatives(spark, sf):
    """Hard negatives of each vector whose id is divisible by 100; labels move
    on by one where the id is divisible by 7."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return negatives.hard_negatives(rows, anchor_every=100, positives=5, negatives=10, share=(30, 90), scale=256)


def op13_fingerprints(spark, sf):
    """Fingerprints of every document and of its edited text, and how alike they
    are to each other and to the next document's."""
    return editprint.edited_fingerprints(table(spark, sf, "documents"))


QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_toxicity": op2_toxicity,
    "op3_fixity": op3_fixity,
    "op4_token_counts": op4_token_counts,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_packed_matrices": op7_packed_matrices,
    "op8_nearest": op8_nearest,
    "op9_decontamination": op9_decontamination,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_fingerprints": op13_fingerprints,
}

ORACLES: dict[str, str] = {
    "op12_hard_negatives": """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e, row_number() OVER () AS r
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.r AS a_r, a.vec_id AS anchor_id, a.label = o.label AS alike, o.vec_id, o.r,
           CAST(list_inner_product(a.e, o.e) AS BIGINT) AS score
    FROM v AS a JOIN v AS o ON a.vec_id % 100 = 0 AND a.r <> o.r
), p AS (
    SELECT a_r, r AS p_r, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
    QUALIFY row_number() OVER (PARTITION BY a_r ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY a_r, p_r ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM s JOIN p USING (a_r)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""",
    "op8_nearest": """
WITH v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
    FROM v AS q JOIN v AS c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT * FROM (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score FROM s
) WHERE rank <= 20
""",
    "op9_decontamination": r"""
WITH d AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents
), b AS (
    SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark
), bw AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s + 1 : s + 10], ' ') AS win
    FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS s FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw
), dw AS (
    SELECT doc_id, s, n, array_to_string(w[s + 1 : s + n], ' ') AS win
    FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)
), m AS (SELECT dw.doc_id, dw.s, dw.n, bw.item_id FROM dw JOIN bw USING (win, n)
), hits AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM m) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits h USING (doc_id) LEFT JOIN items i USING (doc_id)
""",
}
