"""Corpus preparation: five stages over ``documents``, each calling one operator.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet in the shared folder and reads again as the next one's docs.
All but the last return the columns of ``documents``; other columns of its input
are left out, whatever their names. An empty table stays empty through all stages.
A text counts whole, as one block in memory (see the operators).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.llm import bpe, minhash, mixing, quality, substring_dedup
from stocktake.llm.common import id_mod, table
from stocktake.session import remove_path, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects; it learns from labels of four folds in five.

    Every row is judged by its text alone: rows without id or that repeat like any
    other, a NULL or empty text by the bias. Without labels every score is 1/2, so all stay.
    """
    fold = F.coalesce(id_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", ~fold)
    return quality.with_score(docs.select(*COLUMNS), model).where(F.col("score") >= 0.3).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row, of smallest id, of each group of near copies, by five-word shingles at 0.8.

    Of rows that repeat one stays; rows without id are grouped by similarity like
    others; NULL and empty texts, alike nothing, all stay.
    """
    return minhash.survivors(docs.select(*COLUMNS), n=5, percent=80)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of 35 words and more that occur more than once, every occurrence.

    NULL stays NULL; a text that is removed whole becomes empty and stays as a row.
    """
    n_chars = F.coalesce(F.length("kept_text").cast("bigint"), F.col("n_chars"))
    return (substring_dedup.dedup_substrings(docs.select(*COLUMNS), n=35)
            .select("doc_id", F.col("kept_text").alias("text"), "lang", "source", n_chars.alias("n_chars")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Brings sources to their target weights: a document returns as often as the mix takes it.

    NULL is a source of its own; rows that tie are split at the target; texts
    without words, of size 0, return once per certain copy.
    """
    return mixing.mixed_rows(docs.select(*COLUMNS))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of the ids and of what they decode to; a NULL text is empty."""
    import public_tokenizers
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.tokenize(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: The classifier of the first stage has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's files go once the next one's are written."""
    docs = table(spark, sf_dir, "documents")
    base, before = scratch_path(spark, "pipeline"), None
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}-{name}")
        if before:
            remove_path(spark, before)
        before = f"{base}/{k}-{name}"
        docs = spark.read.parquet(before)
    return docs
