"""The corpus pipeline: quality, line dedup, near duplicates, mixing, token ids.

Part of the subpackage ``ledgerly.llm``. Every stage takes (spark, docs,
sf_dir) and returns a DataFrame; each result is written as Parquet and read
again as the next stage's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerly.llm import bpe, line_dedup, mixing, quality, simhash
from ledgerly.llm.common import written
from ledgerly.session import let_workers_import
from ledgerly.sources.tables import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model rejects go; extra columns are dropped, null texts are judged as empty ones."""
    return quality.classify(docs.select(*COLUMNS), table(spark, sf_dir, "labels")).filter("predicted = 1").select(*COLUMNS)


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share go; a document whose lines all go stays with an empty text."""
    kept = line_dedup.line_dedup(docs.select(*COLUMNS), min_docs=10, min_chars=1)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id."""
    return simhash.keep_one(docs.select(*COLUMNS), words=3, distance=3, seed=42).select(*COLUMNS)


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 1, 2, 3 in turn: a document is repeated once for each time that the mix takes it."""
    return mixing.take(docs.select(*COLUMNS), weights=[1, 2, 3], max_epochs=3)


def stage_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and ids (packed little-endian 32-bit integers) of every document that the mix holds."""
    ids = bpe.encode_documents(docs.select("doc_id", "source", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return ids.select(
        "doc_id", "source", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids")


def _staged(stage):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        let_workers_import(spark)
        return stage(spark, docs, sf_dir)
    return run_stage


STAGES = [("quality classifier", stage_quality), ("line dedup", stage_lines), ("SimHash near-dedup", stage_near_duplicates),
          ("mixing sources", stage_mix), ("BPE encoding", stage_tokens)]
STAGES = [(name, _staged(stage)) for name, stage in STAGES]

#: No SQL expresses the line model, the fingerprints or the token ids; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
