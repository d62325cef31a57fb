"""Shared plumbing for operators: rule tables with a proven size bound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A rule or parameter table is written by a person (price lists, keyword rules,
# rates). Anything larger is data and goes through a shuffle join instead.
MAX_RULE_ROWS = 10_000
MAX_RULE_BYTES = 8 << 20


def rule_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A parameter table, hinted for broadcast while it is proven small.

    The bound is checked on the driver-side list, so the broadcast can never
    grow with the fact tables; a longer list is a plain table.
    """
    table = spark.createDataFrame(list(rows), schema)
    small = len(rows) <= MAX_RULE_ROWS and sum(len(repr(r)) for r in rows) <= MAX_RULE_BYTES
    return F.broadcast(table) if small else table


def fits_broadcast(df: DataFrame, max_rows: int = MAX_RULE_ROWS) -> bool:
    """Size check of a small side, rows and bytes: reads at most ``max_rows + 1`` rows of it."""
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(F.length(F.to_json(F.struct(*df.columns))))).first()
    return n <= max_rows and (size or 0) <= MAX_RULE_BYTES


def checked_broadcast(df: DataFrame, max_rows: int = MAX_RULE_ROWS) -> DataFrame:
    """Broadcast hint only when the frame is proven small; otherwise the
    frame is returned as is and Catalyst plans a shuffle join."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def as_rule_table(spark: SparkSession, rules, schema: str) -> DataFrame:
    """Accept either a DataFrame (trusted caller) or a list of tuples."""
    if isinstance(rules, DataFrame):
        return rules
    return rule_table(spark, rules, schema)


def when_chain(cases: Sequence[tuple], default=None):
    """Fold ``[(predicate, value), ...]`` into one CASE WHEN, first match wins."""
    out = None
    for pred, val in cases:
        v = val if hasattr(val, "alias") else F.lit(val)
        out = F.when(pred, v) if out is None else out.when(pred, v)
    if out is None:
        return F.lit(default) if not hasattr(default, "alias") else default
    if default is None:
        return out
    return out.otherwise(default if hasattr(default, "alias") else F.lit(default))
