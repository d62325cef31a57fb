"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerly.session import checkpoint_dir

#: Fixed value: the white space of the contracts, as a regex class body.
WS = r"\x20\x09-\x0D"


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Cut the lineage with a parquet table in the shared folder.

    The rows are fixed from then on: a lost executor rereads the table instead
    of recomputing, so generated row ids and names cannot change.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(row_id: Column, text: Column) -> Column:
    """128 bits that stand for a row's id and whole text; repeated rows share them."""
    return F.unhex(F.md5(F.concat_ws("|", F.coalesce(row_id.cast("string"), F.lit("-")), F.coalesce(text, F.lit("")))))


def collapse_ws(text: Column) -> Column:
    """Each run of white space becomes one space; lone spaces are left alone, so few replacements are made."""
    return F.regexp_replace(text, rf"[\x09-\x0D][{WS}]*|\x20[{WS}]+", " ")


def word_count(text: Column) -> Column:
    """Number of maximal runs of non-white-space; null counts 0."""
    flat = F.trim(collapse_ws(F.coalesce(text, F.lit(""))))
    return F.when(flat == "", F.lit(0)).otherwise(
        F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1).cast("long")


def dense_names(values: DataFrame, by: list[str], then: list[str], keep: list[str], label: str) -> DataFrame:
    """Integer names 0..n-1 for distinct rows, in the order of ``by`` and ``then``.

    The rows are dealt by ranges of ``by`` and sorted in place; a row's name is
    its partition's offset plus its place, so no task sees more than one range
    and only one row per partition meets in the offsets' window. The driver
    sees a sample of ``by``, which should be short and tell most rows apart.
    Returns ``keep`` and ``name``. Names depend on the values alone, not on the
    partitioning.
    """
    ranged = values.repartitionByRange(*by).sortWithinPartitions(*by, *then)
    placed = written(ranged.select(*keep, F.monotonically_increasing_id().alias("_at")), label)
    placed = placed.select(*keep, F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_place"))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part")) - F.col("_n")
    offsets = sizes.select("_part", before.alias("_before"))
    return placed.join(offsets, "_part").select(*keep, (F.col("_before") + F.col("_place")).alias("name"))
