"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geonest.llm.common import small_batches, table, write_table
from geonest.llm.decontaminate import drop_contaminated
from geonest.llm.hd_language import UNKNOWN, identify_languages
from geonest.llm.jaccard_join import jaccard_groups
from geonest.llm.line_dedup import dedup_lines
from geonest.llm.packing import pack_documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (null text, or no letter); ``lang``
    becomes the predicted one."""
    small_batches(spark)
    found = identify_languages(docs, keep=("text", "source", "n_chars"))
    return found.where(F.col("lang_pred") != UNKNOWN).withColumnRenamed("lang_pred", "lang").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that many documents share, and documents that lose all
    their lines; ``n_chars`` is counted anew."""
    small_batches(spark)
    kept = dedup_lines(docs, keep=("lang", "source"))
    return kept.where("n_dropped < n_lines").withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id (of texts under one id, the one
    whose SHA-256 is smallest) of each group of near duplicates. Rows that
    repeat an id are judged each by its own text; rows of one id and text
    are one document. Documents without words, and rows without an id, all
    stay."""
    small_batches(spark)
    keyed = docs.select(*COLUMNS, F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("digest"))
    groups = write_table(jaccard_groups(docs), "near-duplicate-groups").where("group is not null")
    first = groups.groupBy("group").agg(F.min(F.struct("doc_id", "digest")).alias("first")).select("first.*")
    alone = keyed.where("doc_id is null").unionByName(
        # no words, so no group
        keyed.where("doc_id is not null").where(~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    )
    rest = [c for c in COLUMNS if c != "doc_id"]
    one = (
        keyed.join(first.hint("merge"), ["doc_id", "digest"], "left_semi")
        .groupBy("doc_id", "digest").agg(F.min(F.struct(*rest)).alias("row")).select("doc_id", *(f"row.{c}" for c in rest))
    )
    return one.union(alone.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that give a benchmark item away."""
    small_batches(spark)
    return drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids, packed into sequences of 2048."""
    small_batches(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: SQL has no tokenizer, so it cannot express the last stage's rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each stage's result written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
