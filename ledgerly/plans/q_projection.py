"""Projection queries by nation with a fixed as-of month: RP-19 (with AL-11,
AG-20, CA-2, WN-6) and RP-18 (with WN-4, WN-8, FL-10, CA-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerly.functions.num import money
from ledgerly.operators import projection as P
from ledgerly.operators import windows as W
from ledgerly.plans.q_agg import OPEN_HOURS
from ledgerly.plans.registry import register
from ledgerly.sources.tables import table

# Fixed values of the test mapping: base month, horizon, scale. The cost history is all that the data hold.
BASE_MONTH, HORIZON = "1998-07-01", 3
SCALE = "0.02"


def _orders(spark, d):
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_nationkey").alias("nation"), F.trunc(F.to_date("o_orderdate"), "MM").alias("month"),
        F.to_date("o_orderdate").alias("day"), "o_orderpriority", "o_orderstatus", "o_custkey",
        (money("o_totalprice") * F.lit(SCALE).cast("decimal(3,2)")).alias("v"))


def projection_inputs(spark, d):
    o = _orders(spark, d)
    base = F.lit(BASE_MONTH).cast("date")
    z = F.lit(0).cast("decimal(18,4)")
    in_base = F.col("month") == base
    past_cost = (F.col("month") <= base) & (F.col("o_orderstatus") == "O")
    immediate = F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    seeds = o.groupBy("nation").agg(
        F.sum(F.when(in_base & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), F.col("v"))
               .otherwise(z)).cast("double").alias("base_tuition"),
        F.sum(F.when(in_base & (F.col("o_orderpriority") == "5-LOW"), F.col("v")).otherwise(z)).cast("double")
         .alias("other_base"),
        F.sum(F.when(in_base, 1).otherwise(0)).cast("double").alias("fixed_hours"),
        F.sum(F.when(in_base & immediate, F.col("v")).otherwise(z)).alias("__imm"),
        F.sum(F.when(in_base & ~immediate, F.col("v")).otherwise(z)).alias("__d30"),
        F.sum(F.when(in_base, F.col("v")).otherwise(z)).alias("__tot"),
        F.sum(F.when(past_cost, F.col("v")).otherwise(z)).cast("double").alias("roll_sum"),
        F.greatest(F.countDistinct(F.when(past_cost, F.col("month"))), F.lit(1)).cast("int").alias("roll_cnt"))
    ratio = lambda c: F.coalesce(F.try_divide(F.col(c).cast("double"), F.col("__tot").cast("double")), F.lit(0.0))
    seeds = seeds.withColumn("r0", ratio("__imm")).withColumn("r30", ratio("__d30")) \
                 .withColumn("pt0", P.r2(F.col("base_tuition") * F.col("r30"))) \
                 .withColumn("pv0", P.r2(F.col("other_base") * F.col("r30"))).drop("__imm", "__d30", "__tot")
    opening = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation")) \
                                         .agg(F.sum(money("c_acctbal")).cast("double").alias("opening"))
    # the horizon's months per nation, with open hours, scheduled costs and imported receipts
    months = seeds.select("nation", F.explode(F.sequence(F.add_months(base, 1), F.add_months(base, HORIZON),
                                                         F.expr("interval 1 month"))).alias("month"))
    hours = W.open_hours(W.calendar(months.select("month").distinct()), OPEN_HOURS)
    sched = o.where(F.col("o_orderstatus") == "O").groupBy("nation", "month").agg(
        F.sum(F.when(F.col("o_orderpriority") != "2-HIGH", F.col("v")).otherwise(z)).cast("double").alias("sched_ops"),
        F.sum(F.when(F.col("o_orderpriority") == "2-HIGH", F.col("v")).otherwise(z)).cast("double").alias("sched_inv"))
    li = table(spark, d, "lineitem").where(F.col("l_returnflag") == "A")
    oc = table(spark, d, "orders").select("o_orderkey", "o_custkey") \
        .join(table(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    imported = li.join(oc, li.l_orderkey == oc.o_orderkey).groupBy(
        F.col("c_nationkey").alias("nation"), F.trunc(F.to_date("l_shipdate"), "MM").alias("month")) \
        .agg(F.sum(money("l_extendedprice") * F.lit(SCALE).cast("decimal(3,2)")).cast("double").alias("imported"))
    m = months.join(hours, "month").join(sched, ["nation", "month"], "left").join(imported, ["nation", "month"], "left") \
              .select("nation", F.struct("month", "open_hours",
                                         F.coalesce("sched_ops", F.lit(0.0)).alias("sched_ops"),
                                         F.coalesce("sched_inv", F.lit(0.0)).alias("sched_inv"),
                                         "imported").alias("m"))
    arr = m.groupBy("nation").agg(F.array_sort(F.collect_list("m")).alias("months"))
    return seeds.join(opening, "nation", "left").withColumn("opening", F.coalesce("opening", F.lit(0.0))) \
                .join(arr, "nation")


@register("month_projection", sql=f"""
WITH RECURSIVE
o AS (SELECT c.c_nationkey AS nation, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month,
             o.o_orderpriority AS pri, o.o_orderstatus AS st, CAST(o.o_totalprice AS DECIMAL(18,2)) * 0.02 AS v
      FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
s0 AS (SELECT nation,
              CAST(sum(CASE WHEN month = DATE '{BASE_MONTH}' AND pri IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN v ELSE 0 END) AS DOUBLE) AS base_tuition,
              CAST(sum(CASE WHEN month = DATE '{BASE_MONTH}' AND pri = '5-LOW' THEN v ELSE 0 END) AS DOUBLE) AS other_base,
              CAST(sum(CASE WHEN month = DATE '{BASE_MONTH}' THEN 1 ELSE 0 END) AS DOUBLE) AS fixed_hours,
              sum(CASE WHEN month = DATE '{BASE_MONTH}' AND pri IN ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW') THEN v ELSE 0 END) AS imm,
              sum(CASE WHEN month = DATE '{BASE_MONTH}' AND pri NOT IN ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW') THEN v ELSE 0 END) AS d30,
              sum(CASE WHEN month = DATE '{BASE_MONTH}' THEN v ELSE 0 END) AS tot,
              CAST(sum(CASE WHEN month <= DATE '{BASE_MONTH}' AND st = 'O' THEN v ELSE 0 END) AS DOUBLE) AS roll_sum,
              greatest(count(DISTINCT CASE WHEN month <= DATE '{BASE_MONTH}' AND st = 'O' THEN month END), 1) AS roll_cnt
       FROM o GROUP BY 1),
s1 AS (SELECT *, coalesce(CASE WHEN CAST(tot AS DOUBLE) <> 0 THEN CAST(imm AS DOUBLE) / CAST(tot AS DOUBLE) END, 0.0) AS r0,
              coalesce(CASE WHEN CAST(tot AS DOUBLE) <> 0 THEN CAST(d30 AS DOUBLE) / CAST(tot AS DOUBLE) END, 0.0) AS r30
       FROM s0),
op AS (SELECT c_nationkey AS nation, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS opening FROM customer GROUP BY 1),
seeds AS (SELECT s1.*, floor(base_tuition * r30 * 100 + 0.5) / 100 AS pt0, floor(other_base * r30 * 100 + 0.5) / 100 AS pv0,
                 coalesce(op.opening, 0.0) AS opening
          FROM s1 LEFT JOIN op USING (nation)),
mi AS (SELECT nation, i, CAST(DATE '{BASE_MONTH}' + INTERVAL (i) MONTH AS DATE) AS month
       FROM seeds, range(1, {HORIZON + 1}) t(i)),
cal AS (SELECT month, sum(CASE WHEN dayofweek(day) IN (0, 6) THEN 11.0 ELSE 15.0 END)::DOUBLE AS open_hours
        FROM (SELECT DISTINCT month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day FROM mi)
        GROUP BY 1),
sch AS (SELECT nation, month, CAST(sum(CASE WHEN pri <> '2-HIGH' THEN v ELSE 0 END) AS DOUBLE) AS sched_ops,
               CAST(sum(CASE WHEN pri = '2-HIGH' THEN v ELSE 0 END) AS DOUBLE) AS sched_inv
        FROM o WHERE st = 'O' GROUP BY 1, 2),
imp AS (SELECT c.c_nationkey AS nation, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS month,
               CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 0.02) AS DOUBLE) AS imported
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
        WHERE l.l_returnflag = 'A' GROUP BY 1, 2),
mon AS (SELECT mi.nation, mi.i, mi.month, cal.open_hours, coalesce(sch.sched_ops, 0.0) AS sched_ops,
               coalesce(sch.sched_inv, 0.0) AS sched_inv, imp.imported
        FROM mi JOIN cal USING (month) LEFT JOIN sch USING (nation, month) LEFT JOIN imp USING (nation, month)),
rec AS (
  SELECT nation, 0 AS i, pt0 AS pt, pv0 AS pv, roll_sum AS rs, CAST(roll_cnt AS DOUBLE) AS rc, opening AS bal,
         1.0::DOUBLE AS f, 1.0::DOUBLE AS fo, NULL::DATE AS month, NULL::DOUBLE AS initial, NULL::DOUBLE AS inflow,
         NULL::DOUBLE AS provision, NULL::DOUBLE AS out_ops, NULL::DOUBLE AS net, NULL::DOUBLE AS final
  FROM seeds
  UNION ALL
  SELECT nation, i, x_td30, x_vd30, x_rs, x_rc, x_fin, x_f, x_fo, x_month, x_initial, x_in, x_prov, x_out, x_net, x_fin FROM (
    SELECT r.nation, m.i,
           r.f * (1.0 + 0.02) AS x_f, r.fo * 1.05 AS x_fo,
           floor(s.base_tuition * x_f * 100 + 0.5) / 100 AS x_tu,
           floor(x_tu * s.r0 * 100 + 0.5) / 100 AS x_td0, floor(x_tu * s.r30 * 100 + 0.5) / 100 AS x_td30,
           greatest(0.0, m.open_hours * 4.0 - s.fixed_hours * x_f) AS x_free,
           least(0.35, 0.20 * x_fo) AS x_occ,
           floor((x_free * x_occ * 100.0 + s.other_base * x_f) * 100 + 0.5) / 100 AS x_var,
           floor(x_var * s.r0 * 100 + 0.5) / 100 AS x_vd0, floor(x_var * s.r30 * 100 + 0.5) / 100 AS x_vd30,
           CASE WHEN r.pt + r.pv > 0 THEN r.pt / (r.pt + r.pv) ELSE 0.84 END AS x_sh,
           CASE WHEN m.imported IS NULL THEN r.pt ELSE floor(m.imported * x_sh * 100 + 0.5) / 100 END AS x_tr,
           CASE WHEN m.imported IS NULL THEN r.pv ELSE floor(m.imported * (1.0 - x_sh) * 100 + 0.5) / 100 END AS x_vr,
           floor((x_td0 + x_tr + x_vd0 + x_vr) * 100 + 0.5) / 100 AS x_in,
           floor(m.sched_ops * 100 + 0.5) / 100 AS x_ops, floor(m.sched_inv * 100 + 0.5) / 100 AS x_inv,
           floor(greatest(x_ops, r.rs / r.rc) * 0.10 * 100 + 0.5) / 100 AS x_prov,
           floor(x_tu * 0.10 * 100 + 0.5) / 100 AS x_comm,
           floor((x_tr * 0.025 + x_vr * 0.025) * 100 + 0.5) / 100 AS x_fees,
           floor((x_ops + x_prov + x_comm + x_fees) * 100 + 0.5) / 100 AS x_out,
           floor((floor((x_in - x_out) * 100 + 0.5) / 100 - x_inv) * 100 + 0.5) / 100 AS x_net,
           floor((r.bal + x_net) * 100 + 0.5) / 100 AS x_fin,
           r.bal AS x_initial, m.month AS x_month,
           r.rs + (x_ops + x_prov) AS x_rs, r.rc + 1 AS x_rc
    FROM rec r JOIN mon m ON m.nation = r.nation AND m.i = r.i + 1 JOIN seeds s ON s.nation = r.nation))
SELECT nation, month, initial, inflow, provision, out_ops, net, final FROM rec WHERE i > 0
""")
def month_projection(spark, d):
    """RP-19: three-month cash projection per nation, folded month by month with feedback."""
    ent = projection_inputs(spark, d)
    return P.month_projection(ent, "nation")


# Weekday weights of the daily model (Sunday first) and the test
# parameters of RP-18 (report month, as-of day, pace ratio, fee and commission rates).
DOW_WEIGHTS = [0.5, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0]
DAILY_MONTH, DAILY_AS_OF, PACE = "1998-08-01", "1998-08-10", 1.0
D30_FEE, COMMISSION_RATE, COMMISSION_CUT = 0.025, 0.10, 20


@register("daily_projection", sql=f"""
WITH
o AS (SELECT c.c_nationkey AS nation, CAST(o.o_orderdate AS DATE) AS day, o.o_orderpriority AS pri, o.o_orderstatus AS st,
             CAST(o.o_totalprice AS DECIMAL(18,2)) * 0.02 AS v
      FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
nat AS (SELECT c_nationkey AS nation, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS opening FROM customer GROUP BY 1),
cal AS (SELECT CAST(unnest(generate_series(DATE '{DAILY_MONTH}', last_day(DATE '{DAILY_MONTH}'), INTERVAL 1 DAY)) AS DATE) AS day),
cw AS (SELECT day, CASE WHEN dayofweek(day) = 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS w FROM cal),
tw AS (SELECT sum(w) AS total_w, greatest(sum(CASE WHEN day >= DATE '{DAILY_AS_OF}' THEN w ELSE 0.0 END), 1.0) AS rem_w FROM cw),
base AS (SELECT nation,
                CAST(sum(CASE WHEN day >= DATE '{DAILY_MONTH}' - INTERVAL 1 MONTH AND day < DATE '{DAILY_MONTH}'
                              AND pri IN ('1-URGENT', '2-HIGH') THEN v ELSE 0 END) AS DOUBLE) AS d30_due,
                CAST(sum(CASE WHEN day >= DATE '{DAILY_MONTH}' - INTERVAL 1 MONTH AND day < DATE '{DAILY_MONTH}'
                              AND pri NOT IN ('1-URGENT', '2-HIGH') THEN v ELSE 0 END) AS DOUBLE) AS d0_month,
                CAST(sum(CASE WHEN st = 'F' AND day >= DATE '{DAILY_MONTH}' AND day <= last_day(DATE '{DAILY_MONTH}')
                              AND day(day) <= {COMMISSION_CUT} THEN v * {COMMISSION_RATE} ELSE 0 END) AS DOUBLE) AS comm1,
                CAST(sum(CASE WHEN st = 'F' AND day >= DATE '{DAILY_MONTH}' AND day <= last_day(DATE '{DAILY_MONTH}')
                              AND day(day) > {COMMISSION_CUT} THEN v * {COMMISSION_RATE} ELSE 0 END) AS DOUBLE) AS comm2,
                CAST(sum(CASE WHEN st = 'O' AND pri <> '2-HIGH' AND day < DATE '{DAILY_AS_OF}' THEN v ELSE 0 END) AS DOUBLE) AS overdue_ops,
                CAST(sum(CASE WHEN st = 'O' AND pri = '2-HIGH' AND day < DATE '{DAILY_AS_OF}' THEN v ELSE 0 END) AS DOUBLE) AS overdue_inv
         FROM o GROUP BY 1),
imp AS (SELECT c.c_nationkey AS nation, CAST(l.l_shipdate AS DATE) AS day,
               CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 0.02) AS DOUBLE) AS imported
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
        WHERE l.l_returnflag = 'A' AND l.l_shipdate >= DATE '{DAILY_MONTH}' AND l.l_shipdate < DATE '{DAILY_MONTH}' + INTERVAL 1 MONTH
        GROUP BY 1, 2),
has_imp AS (SELECT DISTINCT nation FROM imp),
daily AS (SELECT nation, day,
                 CAST(sum(CASE WHEN st = 'O' AND pri <> '2-HIGH' THEN v ELSE 0 END) AS DOUBLE) AS sched_ops,
                 CAST(sum(CASE WHEN st = 'O' AND pri = '2-HIGH' THEN v ELSE 0 END) AS DOUBLE) AS sched_inv,
                 CAST(sum(CASE WHEN st = 'F' THEN v ELSE 0 END) AS DOUBLE) AS received
          FROM o GROUP BY 1, 2),
g AS (SELECT b.nation, cw.day, cw.w, tw.total_w, tw.rem_w, b.*, n.opening,
             CASE WHEN h.nation IS NOT NULL THEN coalesce(i.imported, 0.0)
                  ELSE floor(b.d30_due * (cw.w / tw.rem_w) * 100 + 0.5) / 100 END AS block1,
             floor(b.d0_month * cw.w / tw.total_w * {PACE} * 100 + 0.5) / 100 AS block2,
             coalesce(dl.sched_ops, 0.0) AS sched_ops, coalesce(dl.sched_inv, 0.0) AS sched_inv,
             coalesce(dl.received, 0.0) AS received
      FROM base b JOIN nat n USING (nation) CROSS JOIN cw CROSS JOIN tw
           LEFT JOIN has_imp h ON h.nation = b.nation LEFT JOIN imp i ON i.nation = b.nation AND i.day = cw.day
           LEFT JOIN daily dl ON dl.nation = b.nation AND dl.day = cw.day
      WHERE cw.day >= DATE '{DAILY_AS_OF}'),
f AS (SELECT nation, day, opening,
             CASE WHEN day = DATE '{DAILY_AS_OF}'
                  THEN floor(greatest(0.0, floor((block1 + block2) * 100 + 0.5) / 100 - floor(received * 100 + 0.5) / 100) * 100 + 0.5) / 100
                  ELSE floor((block1 + block2) * 100 + 0.5) / 100 END AS inflow,
             floor((floor(block1 * {D30_FEE} * 100 + 0.5) / 100 + sched_ops
                    + CASE WHEN day = DATE '{DAILY_AS_OF}' THEN overdue_ops ELSE 0.0 END
                    + CASE WHEN day(day) = {COMMISSION_CUT} THEN comm1 ELSE 0.0 END
                    + CASE WHEN day = last_day(day) THEN comm2 ELSE 0.0 END) * 100 + 0.5) / 100 AS outflow_ops,
             floor((sched_inv + CASE WHEN day = DATE '{DAILY_AS_OF}' THEN overdue_inv ELSE 0.0 END) * 100 + 0.5) / 100 AS outflow_inv
      FROM g),
n AS (SELECT *, floor((floor((inflow - outflow_ops) * 100 + 0.5) / 100 - outflow_inv) * 100 + 0.5) / 100 AS net FROM f)
SELECT nation, day, inflow, outflow_ops, outflow_inv, net,
       opening + CAST(sum(CAST(net AS DECIMAL(18,2))) OVER (PARTITION BY nation ORDER BY day
                                                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS closing
FROM n
""")
def daily_projection(spark, d):
    """RP-18: daily cash projection per nation from the as-of day to month end:
    imported receipts by day (or the prior month's 30-day money spread by
    weekday weight over the remaining days, WN-8), own-month sales by weight,
    today's receipts netted, scheduled costs, overdue items on the first day
    (FL-10), commission at day 20 and at month end, running balance (WN-4)."""
    o = _orders(spark, d)
    month = F.lit(DAILY_MONTH).cast("date")
    as_of = F.lit(DAILY_AS_OF).cast("date")
    z = F.lit(0).cast("decimal(18,4)")
    prev = (F.col("day") >= F.add_months(month, -1)) & (F.col("day") < month)
    in_m = (F.col("day") >= month) & (F.col("day") <= F.last_day(month))
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    inv = F.col("o_orderpriority") == "2-HIGH"
    st = F.col("o_orderstatus")
    rate = F.lit(str(COMMISSION_RATE)).cast("decimal(3,2)")
    base = o.groupBy("nation").agg(
        F.sum(F.when(prev & urgent, F.col("v")).otherwise(z)).cast("double").alias("d30_due"),
        F.sum(F.when(prev & ~urgent, F.col("v")).otherwise(z)).cast("double").alias("d0_month"),
        F.sum(F.when((st == "F") & in_m & (F.dayofmonth("day") <= COMMISSION_CUT), F.col("v") * rate)
               .otherwise(z)).cast("double").alias("comm1"),
        F.sum(F.when((st == "F") & in_m & (F.dayofmonth("day") > COMMISSION_CUT), F.col("v") * rate)
               .otherwise(z)).cast("double").alias("comm2"),
        F.sum(F.when((st == "O") & ~inv & (F.col("day") < as_of), F.col("v"))
               .otherwise(z)).cast("double").alias("overdue_ops"),
        F.sum(F.when((st == "O") & inv & (F.col("day") < as_of), F.col("v"))
               .otherwise(z)).cast("double").alias("overdue_inv"))
    opening = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation")) \
                                         .agg(F.sum(money("c_acctbal")).cast("double").alias("opening"))
    # weekday weights; totals over the month and over the remaining days (CA-5),
    # folded in-row over the month's day sequence (at most 31 elements)
    warr = F.array(*[F.lit(x) for x in DOW_WEIGHTS])
    weight = lambda c: F.element_at(warr, F.dayofweek(c))
    all_days = F.sequence(month, F.last_day(month))
    total_w = F.aggregate(F.transform(all_days, weight), F.lit(0.0), lambda a, x: a + x)
    rem_w = F.greatest(F.aggregate(F.transform(all_days, lambda c: F.when(c >= as_of, weight(c)).otherwise(F.lit(0.0))),
                                   F.lit(0.0), lambda a, x: a + x), F.lit(1.0))
    li = table(spark, d, "lineitem").where((F.col("l_returnflag") == "A") & (F.col("l_shipdate") >= month)
                                           & (F.col("l_shipdate") < F.add_months(month, 1)))
    oc = table(spark, d, "orders").select("o_orderkey", "o_custkey") \
        .join(table(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    imp = li.join(oc, li.l_orderkey == oc.o_orderkey).groupBy(F.col("c_nationkey").alias("nation"),
                                                              F.to_date("l_shipdate").alias("day")) \
            .agg(F.sum(money("l_extendedprice") * F.lit(SCALE).cast("decimal(3,2)")).cast("double").alias("imported"))
    has_imp = imp.select("nation").distinct().withColumn("has_imp", F.lit(True))
    daily = o.groupBy("nation", "day").agg(
        F.sum(F.when((st == "O") & ~inv, F.col("v")).otherwise(z)).cast("double").alias("sched_ops"),
        F.sum(F.when((st == "O") & inv, F.col("v")).otherwise(z)).cast("double").alias("sched_inv"),
        F.sum(F.when(st == "F", F.col("v")).otherwise(z)).cast("double").alias("received"))
    # each nation row carries its own day spine (explode, not a cross join)
    spine = base.join(opening, "nation").select("*", total_w.alias("total_w"), rem_w.alias("rem_w"),
                                                F.explode(F.sequence(as_of, F.last_day(month))).alias("day")) \
                .withColumn("w", weight(F.col("day")))
    g = spine.join(has_imp, "nation", "left").join(imp, ["nation", "day"], "left").join(daily, ["nation", "day"], "left")
    r2 = P.r2
    block1 = F.when(F.col("has_imp").isNotNull(), F.coalesce("imported", F.lit(0.0))) \
              .otherwise(r2(F.col("d30_due") * (F.col("w") / F.col("rem_w"))))
    block2 = r2(F.col("d0_month") * F.col("w") / F.col("total_w") * F.lit(PACE))
    first = F.col("day") == as_of
    raw_in = r2(block1 + block2)
    inflow = F.when(first, r2(F.greatest(F.lit(0.0), raw_in - r2(F.coalesce("received", F.lit(0.0)))))).otherwise(raw_in)
    out_ops = r2(r2(block1 * F.lit(D30_FEE)) + F.coalesce("sched_ops", F.lit(0.0))
                 + F.when(first, F.col("overdue_ops")).otherwise(F.lit(0.0))
                 + F.when(F.dayofmonth("day") == COMMISSION_CUT, F.col("comm1")).otherwise(F.lit(0.0))
                 + F.when(F.col("day") == F.last_day("day"), F.col("comm2")).otherwise(F.lit(0.0)))
    out_inv = r2(F.coalesce("sched_inv", F.lit(0.0)) + F.when(first, F.col("overdue_inv")).otherwise(F.lit(0.0)))
    x = g.select("nation", "day", "opening", inflow.alias("inflow"), out_ops.alias("outflow_ops"),
                 out_inv.alias("outflow_inv"))
    x = x.withColumn("net", r2(r2(F.col("inflow") - F.col("outflow_ops")) - F.col("outflow_inv")))
    from pyspark.sql import Window
    wn = Window.partitionBy("nation").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("closing", F.col("opening") + F.sum(F.col("net").cast("decimal(18,2)")).over(wn).cast("double"))
    return x.select("nation", "day", "inflow", "outflow_ops", "outflow_inv", "net", "closing")
