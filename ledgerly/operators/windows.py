"""Window operators (WN-3 .. WN-9) and the calendar (CA-1, CA-2, CA-4, CA-5).

Windows partition by an entity key (nation, account, customer) and order by
month or day; the frames are running frames, which Spark evaluates in one
streaming pass over the sorted partition. Money stays DECIMAL so running
sums are exact whatever order partial results arrive in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerly.functions import dates as D


def running_balance(df: DataFrame, keys: Sequence[str], order: str, net: str,
                    opening: str | None = None) -> DataFrame:
    """WN-3 / WN-4: closing = opening + running sum of net; the period's
    opening is closing minus its net (so next opening = this closing)."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    seed = F.col(opening) if opening else F.lit(0)
    closing = seed + F.sum(F.col(net)).over(w)
    return df.withColumn("closing", closing).withColumn("opening", F.col("closing") - F.col(net))


def trailing_base(df: DataFrame, keys: Sequence[str], month: str, value: str, n: int = 12) -> DataFrame:
    """WN-5: the sum of the ``n`` previous months; with fewer months of
    history the average of those months times ``n`` (annualised); null with
    none. ``df`` must hold one row per key and month (a spine)."""
    w = Window.partitionBy(*keys).orderBy(month).rowsBetween(-n, -1)
    s = F.sum(F.col(value)).over(w)
    c = F.count(F.col(value)).over(w)
    base = F.when(c >= n, s.cast("double")).when(c > 0, s.cast("double") / c * n)
    return df.withColumn("trailing_base", base).withColumn("history_months", c)


def carry_forward(df: DataFrame, keys: Sequence[str], order: str, value: str, seed=0,
                  out: str = "carried_in") -> DataFrame:
    """WN-6: last period's value carried into this one (``seed`` for the first)."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn(out, F.lag(F.col(value), 1, seed).over(w))


def slot_totals(df: DataFrame, key: str, slot_cols: Sequence[str], sums: dict[str, Column], out: str = "n_slots") -> DataFrame:
    """WN-7: distinct slots per key, with sums over the key's rows.

    Rows are summed per slot and the slots per key, so a hot key shuffles one
    row per slot and task, and no join brings the count back to the rows.
    """
    slots = df.groupBy(key, *slot_cols).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    return slots.groupBy(key).agg(F.count(F.lit(1)).alias(out), *[F.sum(n).alias(n) for n in sums])


def weighted_share(df: DataFrame, keys: Sequence[str], order: str, weight: str,
                   out: str = "share_of_remaining") -> DataFrame:
    """WN-8: a day's weight over the sum of the weights from that day to the end."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumn(out, F.try_divide(F.col(weight).cast("double"),
                                           F.sum(F.col(weight)).over(w).cast("double")))


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """WN-9: the first row per key under a total order (what ``row_number() = 1``
    gives), computed as ``min_by`` so it aggregates map-side: a key holding a
    third of the rows is reduced before the shuffle instead of sorted in one task."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("__r")).select(*keys, *[F.col("__r")[c].alias(c) for c in rest])


# ------------------------------------------------------------ calendar
def calendar(months: DataFrame, month: str = "month") -> DataFrame:
    """One row per day of each month in ``months`` (a day spine built by
    ``explode(sequence)``: no join, no driver list)."""
    m = D.month_start(month)
    return months.select(F.col(month), F.explode(D.day_sequence(m, F.last_day(m))).alias("day")) \
                 .withColumn("js_dow", D.js_dow("day")).withColumn("isodow", D.isodow("day"))


def weekday_count(cal: DataFrame, month: str = "month") -> DataFrame:
    """CA-1: occurrences of each weekday (JS numbering) in each month."""
    return cal.groupBy(month, "js_dow").agg(F.count(F.lit(1)).alias("occurrences"))


def open_hours(cal: DataFrame, schedule: Sequence[tuple], month: str = "month") -> DataFrame:
    """CA-2: open hours of each month from a weekday schedule ``[(js_dow, hours)]``."""
    h = None
    for dow, hours in schedule:
        h = F.when(F.col("js_dow") == dow, F.lit(float(hours))) if h is None else \
            h.when(F.col("js_dow") == dow, F.lit(float(hours)))
    return cal.groupBy(month).agg(F.sum(h.otherwise(F.lit(0.0))).alias("open_hours"))


def month_progress(cal: DataFrame, as_of, weight: Column, month: str = "month") -> DataFrame:
    """CA-5: elapsed and remaining weight of each month at ``as_of`` (a date,
    or a Column per month; days before ``as_of`` are elapsed, the as-of day
    and later remain, as in the daily model)."""
    a = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return cal.groupBy(month).agg(F.sum(F.when(F.col("day") < a, weight).otherwise(F.lit(0.0))).alias("elapsed"),
                                  F.sum(F.when(F.col("day") >= a, weight).otherwise(F.lit(0.0))).alias("remaining"))
