"""Sorts, set operations and pick lists (SO-1 .. SO-7, ST-1 .. ST-4, SR-5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*dfs: DataFrame) -> DataFrame:
    """ST-1: UNION ALL by column name (missing columns become null)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """ST-2 / ST-4: UNION (distinct)."""
    return union_all(*dfs).distinct()


def audit_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """ST-3 + SO-3: two movement sources in one list, newest first, then
    largest absolute amount first (columns ``day``, ``amount``)."""
    return union_all(a, b).orderBy(F.col("day").desc(), F.abs(F.col("amount")).desc())


def order_by_amount(df: DataFrame, col: str) -> DataFrame:
    """SO-1."""
    return df.orderBy(F.col(col).desc())


def order_names(df: DataFrame, col: str, last: str) -> DataFrame:
    """SO-6: alphabetical with a sentinel value last."""
    return df.orderBy((F.col(col) == last).asc_nulls_first(), F.col(col))


def distinct_values(df: DataFrame, col: str, last: str | None = None) -> DataFrame:
    """SR-5: distinct values of a column for a pick list, sentinel last."""
    d = df.select(col).where(F.col(col).isNotNull()).distinct()
    return order_names(d, col, last) if last else d.orderBy(col)


def order_by_month_value(df: DataFrame, row: str, month_col: str, value: str, month) -> DataFrame:
    """SO-2: rows ordered by their value in the chosen month (others after)."""
    m = df.where(F.col(month_col) == F.lit(month).cast("date")).groupBy(row).agg(F.sum(value).alias("__mv"))
    return df.join(m, row, "left").orderBy(F.col("__mv").desc_nulls_last(), F.col(row)).drop("__mv")


def merge_ordered(df: DataFrame, extra: DataFrame, order: list[Column]) -> DataFrame:
    """SO-4: add synthetic rows and order everything together."""
    return union_all(df, extra).orderBy(*order)
