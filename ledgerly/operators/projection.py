"""Projections (RP-18, RP-19, AL-11, CA-5, CA-6).

RP-19 is a recurrence with feedback: each month's expense provision uses the
average of all earlier months' results, and each month receives the 30-day
money of the month before. Entities stay independent, so each entity's few
months are gathered into one sorted array (bounded by the horizon, never by
the data) and folded with ``F.aggregate`` — entities run in parallel and no
row leaves its partition for the recurrence.

Every step rounds like the reference (``Math.round(v*100)/100``), so the
arithmetic is written in one fixed order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerly.operators.joins import with_exists


def r2(c: Column) -> Column:
    return (F.floor(c * 100 + 0.5) / 100).cast("double")


@dataclass(frozen=True)
class ProjectionParams:
    growth: float = 0.02            # monthly growth of tuition, fixed hours, other revenue
    safety: float = 0.10            # safety share applied to the provision base
    commission: float = 0.10        # commission on tuition
    courts: int = 4                 # courts (units) for capacity
    occupancy: float = 0.20         # base rental occupancy
    occupancy_growth: float = 1.05  # monthly growth of occupancy
    occupancy_cap: float = 0.35     # occupancy cap
    ticket: float = 100.0           # average rental ticket per hour
    card_fee: float = 0.025         # fee on 30-day receipts
    debit_fee: float = 0.0099       # fee on same-day tuition of customers who pay by debit card
    tuition_share: float = 0.84     # tuition share of imported receipts when nothing is planned


def split_by_plan(total: Column, planned_t: Column, planned_v: Column, default_share: float) -> tuple[Column, Column]:
    """AL-11: split imported receipts by the planned tuition/variable shares."""
    planned = planned_t + planned_v
    share = F.when(planned > 0, planned_t / planned).otherwise(F.lit(default_share))
    return r2(total * share), r2(total * (F.lit(1.0) - share))


def debit_base(prices: DataFrame, payments: DataFrame, keys: Sequence[str], growth: float,
               customer: str = "customer_code", method: str = "pay_method", debit: str = "cartão débito") -> DataFrame:
    """Per ``keys``, the grown monthly prices of the slots whose customer has ever paid by debit card (JN-15).

    Each slot's price is grown by one month and rounded on its own, as the
    projection charges it; customers without a name match nobody.
    """
    paid = payments.where(F.lower(method) == debit).select(customer)
    flagged = with_exists(prices, paid, [customer], "__debit")
    value = F.when(F.col("__debit"), r2(F.col("monthly_price") * F.lit(1.0 + growth))).otherwise(F.lit(0.0))
    return flagged.groupBy(*keys).agg(F.sum(value.cast("decimal(28,2)")).cast("double").alias("debit_base"))


def month_projection(entities: DataFrame, key: str, p: ProjectionParams = ProjectionParams(),
                     static_hours: str | None = None) -> DataFrame:
    """RP-19: fold each entity's months.

    ``entities`` columns: ``key``, ``base_tuition``, ``other_base``,
    ``fixed_hours``, ``r0``, ``r30``, ``pt0``, ``pv0``, ``roll_sum``,
    ``roll_cnt``, ``opening`` (doubles) and ``months``: array of structs
    ``(month, open_hours, sched_ops, sched_inv, imported)`` in month order;
    with ``debit_base`` (:func:`debit_base`) the debit-card fee on its same-day
    share is part of each month's fees. Returns one row per entity and month.
    """
    debit = F.col("debit_base") * F.col("r0") * F.lit(p.debit_fee) if "debit_base" in entities.columns else F.lit(0.0)
    acc0 = F.struct(F.col("pt0").alias("pt"), F.col("pv0").alias("pv"), F.col("roll_sum").alias("rs"),
                    F.col("roll_cnt").cast("double").alias("rc"), F.col("opening").alias("bal"),
                    F.lit(1.0).alias("f"), F.lit(1.0).alias("fo"),
                    F.array().cast("array<struct<month:date,initial:double,inflow:double,provision:double,"
                                   "out_ops:double,net:double,final:double>>").alias("out"))
    g1 = F.lit(1.0 + p.growth)

    def step(acc, m):
        f = acc["f"] * g1
        fo = acc["fo"] * F.lit(p.occupancy_growth)
        tuition = r2(F.col("base_tuition") * f)
        td0, td30 = r2(tuition * F.col("r0")), r2(tuition * F.col("r30"))
        cap = m["open_hours"] * F.lit(float(p.courts))
        if static_hours:
            cap = cap - F.col(static_hours)          # maintenance and single lessons do not grow
        free = F.greatest(F.lit(0.0), cap - F.col("fixed_hours") * f)
        occ = F.least(F.lit(p.occupancy_cap), F.lit(p.occupancy) * fo)
        var = r2(free * occ * F.lit(p.ticket) + F.col("other_base") * f)
        vd0, vd30 = r2(var * F.col("r0")), r2(var * F.col("r30"))
        imp_t, imp_v = split_by_plan(m["imported"], acc["pt"], acc["pv"], p.tuition_share)
        trec = F.when(m["imported"].isNull(), acc["pt"]).otherwise(imp_t)
        vrec = F.when(m["imported"].isNull(), acc["pv"]).otherwise(imp_v)
        inflow = r2(td0 + trec + vd0 + vrec)
        ops, inv = r2(m["sched_ops"]), r2(m["sched_inv"])
        prov = r2(F.greatest(ops, acc["rs"] / acc["rc"]) * F.lit(p.safety))
        comm = r2(tuition * F.lit(p.commission))
        fees = r2((trec * F.lit(p.card_fee) + debit) + vrec * F.lit(p.card_fee))
        out_ops = r2(ops + prov + comm + fees)
        net = r2(r2(inflow - out_ops) - inv)
        final = r2(acc["bal"] + net)
        row = F.struct(m["month"].alias("month"), acc["bal"].alias("initial"), inflow.alias("inflow"),
                       prov.alias("provision"), out_ops.alias("out_ops"), net.alias("net"), final.alias("final"))
        return F.struct(td30.alias("pt"), vd30.alias("pv"), (acc["rs"] + (ops + prov)).alias("rs"),
                        (acc["rc"] + 1).alias("rc"), final.alias("bal"), f.alias("f"), fo.alias("fo"),
                        F.array_append(acc["out"], row).alias("out"))

    folded = entities.select(key, F.aggregate("months", acc0, step)["out"].alias("out"))
    return folded.select(key, F.inline("out"))


def daily_projection(days: DataFrame, key: str, opening: str) -> DataFrame:
    """RP-18 core: a running balance over a day spine (WN-4) of each day's
    receipts minus outflows; ``days`` has ``key, day, receipts, outflows``."""
    from pyspark.sql import Window
    w = Window.partitionBy(key).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    net = r2(F.col("receipts") - F.col("outflows"))
    out = days.withColumn("net", net)
    return out.withColumn("closing", F.col(opening) + F.sum(F.col("net").cast("decimal(18,2)")).over(w).cast("double"))
