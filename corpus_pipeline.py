"""Corpus pipeline: from ``documents`` to token ids, in five stages.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns a DataFrame; all but the last return the columns of ``docs``. Every
result is written as Parquet in the shared scratch folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import flagged, stored
from strata.llm.decontamination import drop_contaminated
from strata.llm.exact_dedup import exact_dedup
from strata.llm.ngram_join import ngram_join
from strata.llm.quality_classifier import quality
from strata.llm.queries import held_out, table
from strata.llm.sentencepiece_codec import encode_decode

QUALITY = 0.3
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def filtering(stage: Stage) -> Stage:
    """A stage that sees ids and texts only: the other columns, whatever their names, go along as one, ``_rest``."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in ("doc_id", "text")]
        quoted = [f"`{c.replace('`', '``')}`" for c in others]
        rest = F.struct(*[F.col(q).alias(f"c{i}") for i, q in enumerate(quoted)], F.lit(None).cast("int").alias("end"))
        kept = stage(spark, docs.select("doc_id", "text", rest.alias("_rest")), sf_dir)
        back = {c: F.col(f"_rest.c{i}").alias(c) for i, c in enumerate(others)}
        return kept.select(*[back[c] if c in back else F.col(c) for c in docs.columns])

    return run


@filtering
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = table(spark, sf_dir, "labels").where(~held_out(5, 0))
    return quality(docs, labels, output="_quality").where(F.col("_quality") >= QUALITY).select(*docs.columns)


@filtering
def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents of equal text, the one with the smallest id."""
    return exact_dedup(docs, carry=docs.columns).where("kept").select(*docs.columns)


@filtering
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates, the document with the smallest id.

    Rows are told apart by id and text, as ids may be null (these come last) or
    repeated. Only documents that may go are joined; the others are not shuffled.
    """
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    found = ngram_join(docs.select(row.alias("_row"), "text"), id_column="_row")
    gone = found.where("_row <> component_id").select(F.col("_row.id").alias("_gone"), F.col("_row.text").alias("_of"))
    gone = stored(gone, "near-gone")
    rows = flagged(docs.withColumn("_text", F.xxhash64("text")), "_text", gone.select(F.col("_of").alias("_text")), "_may")
    checked = rows.where("_may").join(gone, F.col("doc_id").eqNullSafe(F.col("_gone")) & (F.col("_text") == F.col("_of")), "left_anti")
    return rows.where("not _may").unionByName(checked).select(*docs.columns)


@filtering
def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the text that they decode to."""
    return encode_decode(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("SentencePiece encoding and decoding", token_stage),
]

# SQL expresses neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
