"""Corpus pipeline: documents through five training-data operators.

Every stage works on all rows its predecessor kept and takes effect: three
drop documents, one masks text, the last returns packed pieces.  A stage's
result is a Parquet table in the shared folder and the next stage reads it, so
a lost executor costs at most the running stage.

Edge cases: null and empty texts are rejected by the first stage; rows that repeat
an id and a text leave one row, rows of an id with several texts go or stay
together, and a null id stays null throughout (near duplicates take it for no
document but drop its copies); columns beside those of documents are kept up to the
last stage, whatever their names; an empty table gives no pieces, and without
labels or benchmark items those stages drop nothing but empty text.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastry.llm import decontam, neardup, packing, pii, quality
from forecastry.llm.common import table
from forecastry.session import drop_scratch, scratch_path, settled


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents outside their language's perplexity limits go; the
    model is that of the documents labelled good."""
    return quality.keep_accepted(docs, table(spark, sf_dir, "labels").where("quality = 1").select("doc_id"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each component at 0.8 on five-word shingles, the document
    with the smallest id stays."""
    return neardup.drop_near_duplicates(docs, threshold=0.8, shingle=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a benchmark window of ten words go."""
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: found spans become [EMAIL], [IP], [CARD] or [PHONE]."""
    masked = pii.mask(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: what is left, packed into sequences of 1024 ids."""
    return packing.pack_pieces(docs, tokenizer_path("byte_bpe_50k.json"), window=1024)


STAGES = [
    ("quality classifier", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("personal data", mask_personal_data),
    ("packing", pack),
]

# The language model, the similarity links and the packing have no SQL form;
# tests/llm compares each stage's rows with a plain version on that stage's input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again, and a
    table that has been read is removed, the last one's once checkpointed."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_scratch(spark, before)
        before = path
    return settled(docs, before)
