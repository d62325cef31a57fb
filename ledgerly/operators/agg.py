"""Aggregations (AG-1 .. AG-33) as grouped DataFrame calls.

Every aggregate here is an ordinary ``groupBy``/``agg`` (partial aggregation
map-side, final after the shuffle) or a window over an already aggregated
frame. No group of rows is collected into a list (only the few provider
classes of one key are); money sums stay DECIMAL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerly.functions import num as N


def with_total(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column],
               total_label: str = "TOTAL") -> DataFrame:
    """AG-9 / AG-10: grouped rows plus total rows via ``rollup``.

    ``is_total`` marks rows where the last key is rolled up; the rolled-up
    key shows ``total_label``. With two keys (section, name) this yields a
    subtotal per section and a grand total.
    """
    keys = list(keys)
    g = df.rollup(*keys).agg(*aggs, F.grouping_id().alias("__gid"))
    out = g.withColumn("is_total", F.col("__gid") > 0)
    for i, k in enumerate(keys):
        rolled = F.col("__gid").bitwiseAND(1 << (len(keys) - 1 - i)) > 0
        out = out.withColumn(k, F.when(rolled, F.lit(total_label)).otherwise(F.col(k).cast("string")))
    return out.drop("__gid")


def cash_long(df: DataFrame, month: str, flow: str, category: str, value: str) -> DataFrame:
    """AG-11: month x activity x category net, long form."""
    return df.groupBy(month, flow, category).agg(F.sum(value).alias("net"))


def pivot_months(df: DataFrame, rows: Sequence[str], month: str, value: str,
                 months: Sequence[str]) -> DataFrame:
    """AG-12: months as columns. The month list is a parameter, so Spark does
    not run a separate job to discover the pivot values."""
    return df.groupBy(*rows).pivot(month, list(months)).agg(F.sum(value))


def month_kpis(df: DataFrame, month: str, value: str, payer: str) -> DataFrame:
    """AG-13: revenue and distinct payers per month."""
    return df.groupBy(month).agg(F.sum(value).alias("revenue"),
                                 F.countDistinct(payer).alias("payers"))


def share(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "share_pct") -> DataFrame:
    """AG-15: percent of the total of the ``by`` partition (zero total -> 0)."""
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    tot = F.sum(F.col(value)).over(w)
    return df.withColumn(out, F.coalesce(F.try_divide(F.col(value).cast("double") * 100,
                                                      tot.cast("double")), F.lit(0.0)))


def rescale(detail: DataFrame, totals: DataFrame, keys: Sequence[str], part: str, value: str,
            total: str, fallback_label: str, out: str = "rescaled") -> DataFrame:
    """AG-19: scale a breakdown so its parts sum to a control total per key;
    a key with a total and no detail gets one ``fallback_label`` row."""
    keys = list(keys)
    s = detail.groupBy(*keys).agg(F.sum(value).alias("__sum"))
    d = detail.join(s, keys).join(totals.select(*keys, total), keys, "inner")
    d = d.withColumn(out, F.coalesce(F.try_divide(F.col(value).cast("double") * F.col(total).cast("double"),
                                                  F.col("__sum").cast("double")), F.lit(0.0)))
    lone = totals.join(s, keys, "left_anti").select(*keys, F.lit(fallback_label).alias(part),
                                                     F.col(total).cast("double").alias(out))
    return d.select(*keys, part, out).unionByName(lone)


def latest_month_sum(df: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """AG-21: the sum in each key's latest month."""
    per = df.groupBy(key, month).agg(F.sum(value).alias("__s"))
    return per.groupBy(key).agg(F.max(month).alias("latest_month"),
                                F.max_by("__s", F.col(month)).alias("latest_sum"))


def balance_due(earned: DataFrame, paid: DataFrame, keys: Sequence[str], e_val: str,
                p_val: str) -> DataFrame:
    """AG-24: earned minus paid out per key, floored at zero (full outer on the key)."""
    keys = list(keys)
    e = earned.groupBy(*keys).agg(F.sum(e_val).alias("earned"))
    p = paid.groupBy(*keys).agg(F.sum(p_val).alias("paid"))
    j = e.join(p, keys, "full_outer")
    zero = F.lit(0).cast("decimal(18,2)")
    return j.select(*keys, F.coalesce("earned", zero).alias("earned"), F.coalesce("paid", zero).alias("paid"),
                    F.greatest(zero, F.coalesce("earned", zero) - F.coalesce("paid", zero)).alias("due"))


def in_out_net(df: DataFrame, by: Sequence[str], value: str, is_in: Column) -> DataFrame:
    """AG-25: inflow, outflow and net per category."""
    v = F.col(value)
    return df.groupBy(*by).agg(F.sum(F.when(is_in, v)).alias("inflow"),
                               F.sum(F.when(~is_in, v)).alias("outflow"),
                               F.sum(F.when(is_in, v).otherwise(-v)).alias("net"))


def latest(df: DataFrame, key: str, value: str, ts: str) -> DataFrame:
    """AG-26: value at the latest ``ts`` per key (ties: the larger value)."""
    return df.groupBy(key).agg(F.max(ts).alias("latest_ts"),
                               F.max_by(F.col(value), F.struct(F.col(ts), F.col(value))).alias("latest_value"))


def investment_balance(df: DataFrame, keys: Sequence[str], date: str, value: str, opening,
                       start, end) -> DataFrame:
    """AG-27: opening balance plus signed movements from ``start`` to ``end``;
    a key without a movement in between keeps its opening."""
    d = F.col(date)
    inside = (d >= F.lit(start).cast("date")) & (d <= F.lit(end).cast("date"))
    moved = F.coalesce(F.sum(F.when(inside, F.col(value))), F.lit(0).cast("decimal(18,2)"))
    return df.groupBy(*keys).agg((F.lit(opening).cast("decimal(18,2)") + moved).alias("balance"))


def capacity(hours: Column, n_units: Column, floor: int) -> Column:
    """AG-30: open hours times distinct units, with a floor on the unit count."""
    return F.greatest(n_units, F.lit(floor)) * hours


def free_capacity(capacity: Column, *taken: Column) -> Column:
    """AG-31: hours of a capacity that no other use takes, not below zero; a null use takes none."""
    left = capacity
    for hours in taken:
        left = left - F.coalesce(hours, F.lit(0.0))
    return F.greatest(F.lit(0.0), left)


def rental_projection(free: Column, rented: Column, future_free: Column, ticket: Column, variable: Column, step: Column,
                      rate_growth: float = 0.05, rate_cap: float = 0.35, default_rate: float = 0.1641,
                      other_growth: float = 0.0) -> Column:
    """AG-31: ``struct(rate, rental_hours, rental_revenue, other_revenue, total)`` of a month ``step`` months ahead.

    The base month's share of rented in free hours (``default_rate`` without
    free hours) grows by ``rate_growth`` a month up to ``rate_cap`` and meets
    the future free hours at the average ticket. What the base month's
    variable revenue holds beyond rentals, floored at zero, grows on its own.
    """
    base_rate = F.when(free > 0, rented / free).otherwise(F.lit(default_rate))
    rate = F.least(F.lit(rate_cap), base_rate * F.pow(F.lit(1.0 + rate_growth), step))
    hours = future_free * rate
    other = F.greatest(F.lit(0.0), variable - rented * ticket) * F.pow(F.lit(1.0 + other_growth), step)
    return F.struct(rate.alias("rate"), hours.alias("rental_hours"), (hours * ticket).alias("rental_revenue"),
                    other.alias("other_revenue"), N.round2(hours * ticket + other).alias("total"))


def split_online(payments: DataFrame, online: DataFrame, keys: Sequence[str], method: str, value: str,
                 online_class: str, amount: str, online_method: str, labels: Sequence[tuple], other: str) -> DataFrame:
    """RP-5 (CL-8, AG-19): the row of ``online_method`` gives way to one row per class of the provider's payments.

    ``payments`` holds one ``value`` per key and method, ``online`` the
    provider's payments; each class gets its share of the online value, in
    cents. Classes without a positive sum have no row; a key whose provider
    sum is not positive keeps its online value under the label ``other``; an
    online value of zero or less vanishes. Labels of equal name are not merged.
    """
    keys, name = list(keys), F.create_map(*[F.lit(x) for pair in labels for x in pair])
    per = online.groupBy(*keys, F.col(online_class).alias("__c")).agg(F.sum(amount).alias("__a"))
    per = per.groupBy(*keys).agg(F.sum("__a").alias("__sum"), F.collect_list(F.struct("__c", "__a")).alias("__parts"))
    is_online = F.coalesce(F.col(method) == online_method, F.lit(False))
    rest = payments.where(~is_online).select(*keys, method, F.col(value).cast("double").alias(value))
    whole = payments.where(is_online & (F.col(value) > 0)).join(per, keys, "left")
    known = F.coalesce(F.col("__sum"), F.lit(0)) > 0
    v = F.col(value).cast("double")
    parts = F.transform(F.filter("__parts", lambda p: p["__a"] > 0), lambda p: F.struct(
        name[p["__c"]].alias("m"), N.round2(p["__a"].cast("double") * (v / F.col("__sum").cast("double"))).alias("v")))
    lone = F.array(F.struct(F.lit(other).alias("m"), N.round2(v).alias("v")))
    x = whole.select(*keys, F.explode(F.when(known, parts).otherwise(lone)).alias("__x"))
    return rest.unionByName(x.select(*keys, F.col("__x.m").alias(method), F.col("__x.v").alias(value)))


def provision(gap: Column, scheduled: Column, rate: float, days: Column) -> Column:
    """AG-33: gap to the base month (not below zero) plus a safety share of the
    scheduled amount and that gap, in cents, spread over the days of the month."""
    gap = F.greatest(gap, F.lit(0.0))
    return F.try_divide(N.round2(gap + (scheduled + gap) * F.lit(rate)), days.cast("double"))
