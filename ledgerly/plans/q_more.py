"""Further report queries: RP-3 (CL-5, AG-23), RP-5 (CL-8, AG-19), JN-18,
JN-19, JN-20, RP-4, RP-7, RP-11."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerly.functions.num import money, round2
from ledgerly.operators import agg as G
from ledgerly.operators import rules as R
from ledgerly.operators import windows as W
from ledgerly.operators.common import rule_table
from ledgerly.plans.q_agg import OPEN_HOURS
from ledgerly.plans.q_reports import TEST_PAY_METHODS
from ledgerly.plans.registry import register
from ledgerly.sources.tables import table

# Fixed values of the test mapping: a three-class rule set shaped like the cash
# reconciliation (lesson words, then rental unless a lesson word is present).
RECON_RULES = [
    ("lesson", ("any", [("contains", "p_name", "gear"), ("contains", "p_name", "widget"),
                        ("equals", "p_type", "promo")])),
    ("rental", ("all", [("not", ("any", [("contains", "p_name", "gear"), ("contains", "p_name", "widget")])),
                        ("any", [("equals", "p_type", "large"), ("contains", "p_name", "plate")])])),
]


@register("cash_reconciliation", sql="""
WITH x AS (SELECT CAST(date_trunc('month', l.l_shipdate) AS DATE) AS month, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS v,
                  CASE WHEN contains(lower(p.p_name), 'gear') OR contains(lower(p.p_name), 'widget') OR lower(p.p_type) = 'promo' THEN 'lesson'
                       WHEN NOT (contains(lower(p.p_name), 'gear') OR contains(lower(p.p_name), 'widget'))
                            AND (lower(p.p_type) = 'large' OR contains(lower(p.p_name), 'plate')) THEN 'rental'
                       ELSE 'other' END AS cls
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey)
SELECT month, CAST(sum(CASE WHEN cls = 'lesson' THEN v ELSE 0 END) AS DOUBLE) AS lesson,
       CAST(sum(CASE WHEN cls = 'rental' THEN v ELSE 0 END) AS DOUBLE) AS rental,
       CAST(sum(CASE WHEN cls = 'other' THEN v ELSE 0 END) AS DOUBLE) AS other,
       CAST(sum(v) AS DOUBLE) AS total,
       CAST(sum(v) - (sum(CASE WHEN cls = 'lesson' THEN v ELSE 0 END) + sum(CASE WHEN cls = 'rental' THEN v ELSE 0 END)
                      + sum(CASE WHEN cls = 'other' THEN v ELSE 0 END)) AS DOUBLE) AS residual
FROM x GROUP BY 1
""")
def cash_reconciliation(spark, d):
    """RP-3 (CL-5, AG-23): monthly sales by class with the residual against the total."""
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part")
    x = li.join(p, li.l_partkey == p.p_partkey).select(
        F.trunc(F.to_date("l_shipdate"), "MM").alias("month"), money("l_extendedprice").alias("v"),
        R.revenue_class(RECON_RULES, "other").alias("cls"))
    z = F.lit(0).cast("decimal(18,2)")
    parts = {c: F.sum(F.when(F.col("cls") == c, F.col("v")).otherwise(z)) for c in ("lesson", "rental", "other")}
    g = x.groupBy("month").agg(*[v.alias(k) for k, v in parts.items()], F.sum("v").alias("total"))
    g = g.withColumn("residual", F.col("total") - (F.col("lesson") + F.col("rental") + F.col("other")))
    return g.select("month", *[F.col(c).cast("double").alias(c) for c in ("lesson", "rental", "other", "total", "residual")])


@register("payment_breakdown", sql="""
WITH p AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                  CASE o_orderpriority WHEN '1-URGENT' THEN 'tarjeta' WHEN '2-HIGH' THEN 'Cartão Crédito'
                       WHEN '3-MEDIUM' THEN 'Cartão Débito' ELSE 'pix' END AS method,
                  CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders),
det AS (SELECT month, method, sum(v) AS v FROM p GROUP BY 1, 2),
s AS (SELECT month, sum(v) AS s FROM det GROUP BY 1),
tot AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total
        FROM lineitem GROUP BY 1)
SELECT det.month, det.method,
       floor(coalesce(CAST(det.v AS DOUBLE) * CAST(tot.total AS DOUBLE) / CAST(s.s AS DOUBLE), 0.0) * 100 + 0.5) / 100 AS value
FROM det JOIN s USING (month) JOIN tot USING (month)
UNION ALL
SELECT tot.month, 'sem detalhe', floor(CAST(tot.total AS DOUBLE) * 100 + 0.5) / 100
FROM tot WHERE tot.month NOT IN (SELECT month FROM s)
""")
def payment_breakdown(spark, d):
    """RP-5 (CL-8 style method map, AG-19): month totals by payment method rescaled to the
    month's settled total; months without detail get one fallback line."""
    o = table(spark, d, "orders")
    cc = F.col("o_orderpriority")
    method = F.coalesce(*[F.when(cc == k, F.lit(v)) for k, v in TEST_PAY_METHODS], F.lit("pix"))
    det = o.groupBy(F.trunc(F.to_date("o_orderdate"), "MM").alias("month"), method.alias("method")) \
           .agg(F.sum(money("o_totalprice")).alias("v"))
    tot = table(spark, d, "lineitem").groupBy(F.trunc(F.to_date("l_shipdate"), "MM").alias("month")) \
                                     .agg(F.sum(money("l_extendedprice")).alias("total"))
    r = G.rescale(det, tot, ["month"], "method", "v", "total", "sem detalhe")
    return r.select("month", "method", round2("rescaled").alias("value"))


# Fixed values of the test mapping: dated recurring costs (category, from, to, monthly amount).
ACCRUALS = [("rent", "1995-01-15", None, "5000.00"), ("energy", "1996-03-01", "1999-12-31", "1200.00"),
            ("insurance", "1998-06-10", "1998-12-31", "300.00")]


@register("accruals", sql="""
WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
c(category, s, e, amount) AS (VALUES ('rent', DATE '1995-01-15', NULL, 5000.00),
                                     ('energy', DATE '1996-03-01', DATE '1999-12-31', 1200.00),
                                     ('insurance', DATE '1998-06-10', DATE '1998-12-31', 300.00))
SELECT m.month, c.category,
       CASE WHEN c.s > m.month
            THEN floor(CAST(c.amount AS DOUBLE) * (day(last_day(m.month)) - day(c.s) + 1) / day(last_day(m.month)) * 100 + 0.5) / 100
            ELSE CAST(c.amount AS DOUBLE) END AS amount
FROM m JOIN c ON c.s <= last_day(m.month) AND (c.e IS NULL OR c.e >= m.month)
""")
def accruals(spark, d):
    """JN-19: each month takes the dated cost rows valid in it; a row starting
    inside the month is prorated by the days it covers (a part month first)."""
    months = table(spark, d, "orders").select(F.trunc(F.to_date("o_orderdate"), "MM").alias("month")).distinct()
    costs = rule_table(spark, [(c, s, e, a) for c, s, e, a in ACCRUALS],
                       "category string, s string, e string, amount string") \
        .select("category", F.col("s").cast("date").alias("s"), F.col("e").cast("date").alias("e"),
                F.col("amount").cast("decimal(18,2)").alias("amount"))
    # range join against a size-checked parameter table (broadcast)
    j = months.join(costs, (F.col("s") <= F.last_day("month"))
                    & (F.col("e").isNull() | (F.col("e") >= F.col("month"))), "inner")
    dim = F.dayofmonth(F.last_day("month"))
    part = round2(F.col("amount").cast("double") * (dim - F.dayofmonth("s") + 1) / dim)
    return j.select("month", "category", F.when(F.col("s") > F.col("month"), part)
                    .otherwise(F.col("amount").cast("double")).alias("amount"))


@register("by_day", sql="""
WITH b AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
sp AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b),
e AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n_events, sum(CAST(value AS DECIMAL(18,2))) AS value
      FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY 1)
SELECT sp.day, coalesce(e.n_events, 0) AS n_events, CAST(coalesce(e.value, 0) AS DOUBLE) AS value
FROM sp LEFT JOIN e USING (day)
""")
def by_day(spark, d):
    """JN-18: scheduled items aggregated per day, then a day spine left-joined with zero fill."""
    ev = table(spark, d, "events")
    e = ev.where(F.col("event_type").isin("purchase", "signup")).groupBy(F.to_date("ts").alias("day")) \
          .agg(F.count(F.lit(1)).alias("n_events"), F.sum(money("value")).alias("value"))
    spine = ev.agg(F.min(F.to_date("ts")).alias("lo"), F.max(F.to_date("ts")).alias("hi")) \
              .select(F.explode(F.sequence("lo", "hi")).alias("day"))
    j = spine.join(e, "day", "left")
    return j.select("day", F.coalesce("n_events", F.lit(0)).cast("bigint").alias("n_events"),
                    F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"))


@register("kpi_history", sql="""
WITH b AS (SELECT min(date_trunc('month', l_shipdate)) AS lo, max(date_trunc('month', l_shipdate)) AS hi FROM lineitem),
sp AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM b),
r AS (SELECT CAST(date_trunc('month', l.l_shipdate) AS DATE) AS month, sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS revenue,
             count(DISTINCT o.o_custkey) AS payers
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1),
h AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS hours FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
cal AS (SELECT month, sum(CASE WHEN dayofweek(day) IN (0, 6) THEN 11.0 ELSE 15.0 END)::DOUBLE AS open_hours
        FROM (SELECT month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day FROM sp)
        GROUP BY 1)
SELECT sp.month, CAST(coalesce(r.revenue, 0) AS DOUBLE) AS revenue, coalesce(r.payers, 0) AS payers,
       floor(coalesce(CAST(r.revenue AS DOUBLE) / r.payers, 0.0) * 100 + 0.5) / 100 AS ticket,
       coalesce(h.hours, 0) AS hours,
       floor(coalesce(h.hours, 0) * 100.0 / (4 * cal.open_hours) * 100 + 0.5) / 100 AS occupancy_pct
FROM sp JOIN cal USING (month) LEFT JOIN r USING (month) LEFT JOIN h USING (month)
""")
def kpi_history(spark, d):
    """RP-7 (JN-17, AG-13, CA-2, FL-8): revenue, payers, ticket and occupancy over the whole month range."""
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders")
    r = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey) \
          .groupBy(F.trunc(F.to_date("l_shipdate"), "MM").alias("month")) \
          .agg(F.sum(money("l_extendedprice")).alias("revenue"), F.countDistinct("o_custkey").alias("payers"))
    h = o.withColumn("kind", F.when(F.col("o_orderstatus") == "P", "manutenção").otherwise("aula"))
    from ledgerly.operators.filters import productive
    h = productive(h, "kind").groupBy(F.trunc(F.to_date("o_orderdate"), "MM").alias("month")) \
                             .agg(F.count(F.lit(1)).alias("hours"))
    # the few months come back as one row, which gives the spine and each month's sums: the lines are read once
    whole = r.agg(F.min("month").alias("lo"), F.max("month").alias("hi"), F.map_from_entries(F.collect_list(
        F.struct("month", F.struct("revenue", "payers")))).alias("by")).where("lo is not null")
    spine = whole.select("by", F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month"))
    spine = spine.select("month", F.try_element_at("by", F.col("month")).alias("m")).select("month", "m.*")
    days = F.sequence("month", F.last_day("month"))
    hours_of = F.create_map(*[F.lit(x) for dow, n in OPEN_HOURS for x in (dow, float(n))])
    open_hours = F.aggregate(F.transform(days, lambda c: F.element_at(hours_of, F.dayofweek(c) - 1)), F.lit(0.0), lambda x, y: x + y)
    j = spine.withColumn("open_hours", open_hours).join(h, "month", "left")
    hours = F.coalesce("hours", F.lit(0)).cast("bigint")
    return j.select("month", F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("revenue"),
                    F.coalesce("payers", F.lit(0)).cast("bigint").alias("payers"),
                    round2(F.coalesce(F.try_divide(F.col("revenue").cast("double"), F.col("payers")), F.lit(0.0)))
                    .alias("ticket"), hours.alias("hours"),
                    round2(hours * 100.0 / (F.lit(4) * F.col("open_hours"))).alias("occupancy_pct"))


@register("court_occupancy", sql="""
WITH x AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority AS court,
                  count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS productive,
                  count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS maintenance
           FROM orders GROUP BY 1, 2),
cal AS (SELECT month, sum(CASE WHEN dayofweek(day) IN (0, 6) THEN 11.0 ELSE 15.0 END)::DOUBLE AS open_hours
        FROM (SELECT month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day
              FROM (SELECT DISTINCT month FROM x)) GROUP BY 1)
SELECT month, court, productive, maintenance,
       floor(productive * 100.0 / open_hours * 100 + 0.5) / 100 AS occupancy_pct
FROM x JOIN cal USING (month)
""")
def court_occupancy(spark, d):
    """RP-11 (AG-28, CA-2): hours per court and month, productive vs maintenance, occupancy of open hours."""
    o = table(spark, d, "orders").withColumn("month", F.trunc(F.to_date("o_orderdate"), "MM")) \
        .withColumn("kind", F.when(F.col("o_orderstatus") == "P", "maintenance").otherwise("productive"))
    p = o.groupBy("month", F.col("o_orderpriority").alias("court")).pivot("kind", ["productive", "maintenance"]).count()
    p = p.select("month", "court", *[F.coalesce(F.col(k), F.lit(0)).cast("bigint").alias(k)
                                     for k in ("productive", "maintenance")])
    cal = W.open_hours(W.calendar(p.select("month").distinct()), OPEN_HOURS)
    j = p.join(cal, "month")
    return j.select("month", "court", "productive", "maintenance",
                    round2(F.col("productive") * 100.0 / F.col("open_hours")).alias("occupancy_pct"))


@register("operations_kpis", sql="""
WITH l AS (SELECT CAST(date_trunc('month', l.l_shipdate) AS DATE) AS month, o.o_custkey,
                  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS gross,
                  CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(18,2)) AS disc
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
k AS (SELECT month, sum(gross - disc) AS revenue, sum(disc) AS discount, sum(gross) AS gross,
             count(DISTINCT o_custkey) AS payers FROM l GROUP BY 1),
h AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS hours FROM orders
      WHERE o_orderstatus <> 'P' GROUP BY 1)
SELECT k.month, CAST(k.revenue AS DOUBLE) AS revenue, CAST(k.discount AS DOUBLE) AS discount,
       floor(coalesce(CAST(k.discount AS DOUBLE) * 100 / CAST(k.gross AS DOUBLE), 0.0) * 100 + 0.5) / 100 AS discount_share,
       k.payers, floor(coalesce(CAST(k.revenue AS DOUBLE) / k.payers, 0.0) * 100 + 0.5) / 100 AS ticket,
       coalesce(h.hours, 0) AS productive_hours
FROM k LEFT JOIN h USING (month)
""")
def operations_kpis(spark, d):
    """RP-4 (AG-16, AG-7, FL-8): revenue, discount, payers, ticket and productive hours per month."""
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders")
    x = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey).select(
        F.trunc(F.to_date("l_shipdate"), "MM").alias("month"), "o_custkey", money("l_extendedprice").alias("gross"),
        (money("l_extendedprice") * money("l_discount")).alias("disc"))
    k = x.groupBy("month").agg(F.sum(F.col("gross") - F.col("disc")).alias("revenue"), F.sum("disc").alias("discount"),
                               F.sum("gross").alias("gross"), F.countDistinct("o_custkey").alias("payers"))
    h = o.where(F.col("o_orderstatus") != "P").groupBy(F.trunc(F.to_date("o_orderdate"), "MM").alias("month")) \
         .agg(F.count(F.lit(1)).alias("hours"))
    j = k.join(h, "month", "left")
    return j.select("month", F.col("revenue").cast("double").alias("revenue"),
                    F.col("discount").cast("double").alias("discount"),
                    round2(F.coalesce(F.try_divide(F.col("discount").cast("double") * 100, F.col("gross").cast("double")),
                                      F.lit(0.0))).alias("discount_share"),
                    "payers",
                    round2(F.coalesce(F.try_divide(F.col("revenue").cast("double"), F.col("payers")), F.lit(0.0)))
                    .alias("ticket"),
                    F.coalesce("hours", F.lit(0)).cast("bigint").alias("productive_hours"))


# Fixed values of the test mapping: date-effective monthly targets (from, to, class, target).
GOAL_TARGETS = [("1995-01-01", "1997-12-31", "lesson", "400000.00"), ("1998-01-01", None, "lesson", "500000.00"),
                ("1995-01-01", None, "other", "900000.00")]
GOAL_RULES = [("lesson", ("any", [("contains", "p_name", "gear"), ("contains", "p_name", "widget")]))]


@register("goals", sql="""
WITH a AS (SELECT CAST(date_trunc('month', l.l_shipdate) AS DATE) AS month,
                  CASE WHEN contains(lower(p.p_name), 'gear') OR contains(lower(p.p_name), 'widget') THEN 'lesson' ELSE 'other' END AS cls,
                  sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS actual
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1, 2),
m AS (SELECT DISTINCT month FROM a),
t(s, e, cls, target) AS (VALUES (DATE '1995-01-01', DATE '1997-12-31', 'lesson', 400000.00),
                                (DATE '1998-01-01', NULL, 'lesson', 500000.00),
                                (DATE '1995-01-01', NULL, 'other', 900000.00)),
mt AS (SELECT m.month, t.cls, t.target FROM m JOIN t ON t.s <= m.month AND (t.e IS NULL OR t.e >= m.month))
SELECT mt.month, mt.cls, CAST(mt.target AS DOUBLE) AS target, CAST(coalesce(a.actual, 0) AS DOUBLE) AS actual,
       floor(CAST(coalesce(a.actual, 0) AS DOUBLE) * 100 / CAST(mt.target AS DOUBLE) * 100 + 0.5) / 100 AS pct,
       CAST(mt.target - coalesce(a.actual, 0) AS DOUBLE) AS gap
FROM mt LEFT JOIN a USING (month, cls)
""")
def goals(spark, d):
    """RP-12 (CL-7, JN-16): monthly actuals by class against date-effective targets; percent and gap."""
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part")
    a = li.join(p, li.l_partkey == p.p_partkey).groupBy(
        F.trunc(F.to_date("l_shipdate"), "MM").alias("month"), R.revenue_class(GOAL_RULES, "other").alias("cls")) \
        .agg(F.sum(money("l_extendedprice")).alias("actual"))
    t = rule_table(spark, GOAL_TARGETS, "s string, e string, cls string, target string") \
        .select(F.col("s").cast("date").alias("s"), F.col("e").cast("date").alias("e"), "cls",
                F.col("target").cast("decimal(18,2)").alias("target"))
    m = a.select("month").distinct()
    mt = m.join(t, (F.col("s") <= F.col("month")) & (F.col("e").isNull() | (F.col("e") >= F.col("month"))))
    j = mt.select("month", "cls", "target").join(a, ["month", "cls"], "left")
    act = F.coalesce("actual", F.lit(0).cast("decimal(18,2)"))
    return j.select("month", "cls", F.col("target").cast("double").alias("target"), act.cast("double").alias("actual"),
                    round2(act.cast("double") * 100 / F.col("target").cast("double")).alias("pct"),
                    (F.col("target") - act).cast("double").alias("gap"))


# Fixed values of the test mapping: planned hourly rate per order priority.
PLAN_RATES = [("1-URGENT", "25000.00"), ("2-HIGH", "24000.00"), ("3-MEDIUM", "23000.00"),
              ("4-NOT SPECIFIED", "22000.00"), ("5-LOW", "21000.00")]


@register("hourly_rate_vs_plan", sql="""
WITH x AS (SELECT o.o_orderpriority AS type, o.o_orderkey, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS gross,
                  CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(18,2))) AS net
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
g AS (SELECT type, count(DISTINCT o_orderkey) AS hours, sum(gross) AS gross, sum(net) AS net FROM x GROUP BY ROLLUP (type)),
p(type, plan) AS (VALUES ('1-URGENT', 25000.00), ('2-HIGH', 24000.00), ('3-MEDIUM', 23000.00),
                         ('4-NOT SPECIFIED', 22000.00), ('5-LOW', 21000.00))
SELECT coalesce(g.type, 'TOTAL') AS type, g.hours,
       floor(CAST(g.gross AS DOUBLE) / g.hours * 100 + 0.5) / 100 AS gross_rate,
       floor(CAST(g.net AS DOUBLE) / g.hours * 100 + 0.5) / 100 AS net_rate,
       CAST(p.plan AS DOUBLE) AS plan_rate,
       floor((CAST(g.net AS DOUBLE) / g.hours - CAST(p.plan AS DOUBLE)) * 100 / CAST(p.plan AS DOUBLE) * 100 + 0.5) / 100 AS diff_pct
FROM g LEFT JOIN p ON p.type = g.type
""")
def hourly_rate_vs_plan(spark, d):
    """RP-9 (JN-16, AG-14): gross and net revenue per hour by type against plan, with a weighted total row."""
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("type"))
    x = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "type", "o_orderkey", money("l_extendedprice").alias("gross"),
        (money("l_extendedprice") * (F.lit(1) - money("l_discount"))).alias("net"))
    g = x.rollup("type").agg(F.countDistinct("o_orderkey").alias("hours"), F.sum("gross").alias("gross"),
                             F.sum("net").alias("net"))
    plan = rule_table(spark, PLAN_RATES, "ptype string, plan string") \
        .select("ptype", F.col("plan").cast("decimal(18,2)").alias("plan"))
    j = g.join(plan, g.type == plan.ptype, "left")
    net_rate = F.col("net").cast("double") / F.col("hours")
    plan_d = F.col("plan").cast("double")
    return j.select(F.coalesce("type", F.lit("TOTAL")).alias("type"), "hours",
                    round2(F.col("gross").cast("double") / F.col("hours")).alias("gross_rate"),
                    round2(net_rate).alias("net_rate"), plan_d.alias("plan_rate"),
                    round2((net_rate - plan_d) * 100 / plan_d).alias("diff_pct"))


@register("mix_history", sql="""
WITH x AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority AS type, count(*) AS hours,
                  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
           FROM orders GROUP BY 1, 2)
SELECT month, type, hours,
       floor(coalesce(hours * 100.0 / sum(hours) OVER (PARTITION BY month), 0.0) * 100 + 0.5) / 100 AS share_pct,
       floor(CAST(revenue AS DOUBLE) / hours * 100 + 0.5) / 100 AS rate
FROM x
""")
def mix_history(spark, d):
    """RP-10 (JN-17, AG-15, AG-14): each month's hour mix by type and revenue per hour."""
    o = table(spark, d, "orders")
    x = o.groupBy(F.trunc(F.to_date("o_orderdate"), "MM").alias("month"), F.col("o_orderpriority").alias("type")) \
         .agg(F.count(F.lit(1)).alias("hours"), F.sum(money("o_totalprice")).alias("revenue"))
    x = G.share(x, "hours", ["month"], "share")
    return x.select("month", "type", "hours", round2("share").alias("share_pct"),
                    round2(F.col("revenue").cast("double") / F.col("hours")).alias("rate"))


# Fixed values of the test mapping: statement exclusion rules (column, value, from date or none).
EXCLUSIONS = [("o_orderpriority", "5-LOW", None, None), ("o_orderstatus", "P", "1998-01-01", "due")]


@register("expense_lines", sql="""
WITH x AS (SELECT CAST(o_orderdate AS DATE) AS due, o_orderpriority, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS v
           FROM orders WHERE o_orderstatus <> 'F')
SELECT CAST(date_trunc('month', due) AS DATE) AS month, count(*) AS n, CAST(sum(v) AS DOUBLE) AS value
FROM x
WHERE NOT (coalesce(o_orderpriority = '5-LOW', false) OR (coalesce(o_orderstatus = 'P', false) AND due >= DATE '1998-01-01'))
GROUP BY 1
""")
def expense_lines(spark, d):
    """FL-9: expense lines of the statement after the exclusion rules (one of them dated)."""
    from ledgerly.operators.filters import expense_lines as excl
    o = table(spark, d, "orders").where(F.col("o_orderstatus") != "F") \
        .withColumn("due", F.to_date("o_orderdate"))
    x = excl(o, EXCLUSIONS)
    return x.groupBy(F.trunc("due", "MM").alias("month")).agg(F.count(F.lit(1)).alias("n"),
                                                             F.sum(money("o_totalprice")).cast("double").alias("value"))


# Fixed values of the test mapping for RP-20 / JN-20: report month, as-of day,
# commission items (day 20 and month end) and overrides of computed items.
PAY_MONTH, PAY_AS_OF = "1998-08-01", "1998-08-15"
ITEM_OVERRIDES = [(3, 1, True, None), (7, 2, False, "1234.56")]


def commission_items(spark, d):
    """Computed commission instalments per nation: period 1 due on day 20,
    period 2 at month end (10% of finished order value, scaled)."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    m = F.lit(PAY_MONTH).cast("date")
    x = o.join(c, o.o_custkey == c.c_custkey).where(
        (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= m) & (F.col("o_orderdate") < F.add_months(m, 1)))
    period = F.when(F.dayofmonth("o_orderdate") <= 20, 1).otherwise(2)
    g = x.groupBy(F.col("c_nationkey").alias("nation"), period.alias("period")).agg(
        F.sum(money("o_totalprice") * F.lit("0.002").cast("decimal(4,3)")).alias("amount"))
    due = F.when(F.col("period") == 1, F.date_add(m, 19)).otherwise(F.last_day(m))
    return g.withColumn("due", due)


@register("override_items", sql=f"""
WITH x AS (SELECT c.c_nationkey AS nation, CASE WHEN day(o.o_orderdate) <= 20 THEN 1 ELSE 2 END AS period,
                  CAST(o.o_totalprice AS DECIMAL(18,2)) * 0.002 AS v
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
           WHERE o.o_orderstatus = 'F' AND o.o_orderdate >= DATE '{PAY_MONTH}' AND o.o_orderdate < DATE '{PAY_MONTH}' + INTERVAL 1 MONTH),
g AS (SELECT nation, period, sum(v) AS amount FROM x GROUP BY 1, 2),
ov(nation, period, is_deleted, amount) AS (VALUES (3, 1, true, NULL), (7, 2, false, 1234.56))
SELECT g.nation, g.period,
       CAST(CASE WHEN coalesce(ov.is_deleted, false) THEN 0 ELSE round(coalesce(ov.amount, g.amount), 2) END AS DOUBLE) AS amount
FROM g LEFT JOIN ov ON ov.nation = g.nation AND ov.period = g.period
""")
def override_items(spark, d):
    """JN-20: computed commission instalments overridden by key; a deleted item counts 0."""
    g = commission_items(spark, d)
    ov = rule_table(spark, ITEM_OVERRIDES, "nation int, period int, is_deleted boolean, amount string") \
        .select(F.col("nation").alias("ov_nation"), F.col("period").alias("ov_period"), "is_deleted",
                F.col("amount").cast("decimal(18,2)").alias("ov_amount"))
    j = g.join(ov, (g.nation == F.col("ov_nation")) & (g.period == F.col("ov_period")), "left")
    amt = F.when(F.coalesce("is_deleted", F.lit(False)), F.lit(0.0)) \
           .otherwise(F.round(F.coalesce(F.col("ov_amount"), F.col("amount")), 2).cast("double"))
    return j.select("nation", "period", amt.alias("amount"))


@register("payables", sql=f"""
WITH l AS (SELECT 'ledger' AS source, o_orderkey AS ref, CAST(o_orderdate AS DATE) + 30 AS due,
                  CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.02 AS DOUBLE) AS amount
           FROM orders WHERE o_orderstatus <> 'F'),
lb AS (SELECT *, CASE WHEN due < DATE '{PAY_AS_OF}' THEN 'overdue'
                      WHEN due >= DATE '{PAY_AS_OF}' AND due <= last_day(DATE '{PAY_MONTH}') THEN 'upcoming' END AS bucket FROM l),
x AS (SELECT c.c_nationkey AS nation, CASE WHEN day(o.o_orderdate) <= 20 THEN 1 ELSE 2 END AS period,
             CAST(o.o_totalprice AS DECIMAL(18,2)) * 0.002 AS v
      FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
      WHERE o.o_orderstatus = 'F' AND o.o_orderdate >= DATE '{PAY_MONTH}' AND o.o_orderdate < DATE '{PAY_MONTH}' + INTERVAL 1 MONTH),
ci AS (SELECT 'commission' AS source, CAST(nation * 10 + period AS BIGINT) AS ref,
              CASE WHEN period = 1 THEN DATE '{PAY_MONTH}' + 19 ELSE last_day(DATE '{PAY_MONTH}') END AS due,
              CAST(round(sum(v), 2) AS DOUBLE) AS amount
       FROM x GROUP BY nation, period)
SELECT source, ref, due, amount, bucket FROM lb WHERE bucket IS NOT NULL
UNION ALL
SELECT source, ref, due, amount, CASE WHEN due < DATE '{PAY_AS_OF}' THEN 'overdue' ELSE 'upcoming' END FROM ci
""")
def payables(spark, d):
    """RP-20 (FL-10, SO-4): unpaid ledger items overdue or due this month at the
    as-of date, with the month's commission instalments merged in date order."""
    from ledgerly.operators.filters import due_buckets
    from ledgerly.operators.setops import merge_ordered
    o = table(spark, d, "orders").where(F.col("o_orderstatus") != "F")
    led = o.select(F.lit("ledger").alias("source"), F.col("o_orderkey").alias("ref"),
                   F.date_add(F.to_date("o_orderdate"), 30).alias("due"),
                   (money("o_totalprice") * F.lit("0.02").cast("decimal(3,2)")).cast("double").alias("amount"),
                   F.lit(False).alias("paid"))
    led = due_buckets(led, "due", "paid", PAY_AS_OF, PAY_MONTH).drop("paid")
    ci = commission_items(spark, d)
    a = F.lit(PAY_AS_OF).cast("date")
    ci = ci.select(F.lit("commission").alias("source"), (F.col("nation") * 10 + F.col("period")).cast("bigint").alias("ref"),
                   "due", F.round("amount", 2).cast("double").alias("amount"),
                   F.when(F.col("due") < a, "overdue").otherwise("upcoming").alias("bucket"))
    return merge_ordered(led, ci, [F.col("due"), F.col("source"), F.col("ref")])


@register("provision", sql="""
WITH o AS (SELECT c.c_nationkey AS nation, CAST(o.o_orderdate AS DATE) AS day, o.o_orderstatus AS st,
                  CAST(o.o_totalprice AS DECIMAL(18,2)) * 0.02 AS v
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
g AS (SELECT nation,
             sum(CASE WHEN st = 'O' AND day >= DATE '1998-07-01' AND day < DATE '1998-08-01' THEN v ELSE 0 END) AS base,
             sum(CASE WHEN st = 'O' AND day >= DATE '1998-08-01' AND day < DATE '1998-09-01' THEN v ELSE 0 END) AS scheduled,
             sum(CASE WHEN day >= DATE '1998-08-01' AND day < DATE '1998-09-01' THEN v ELSE 0 END) AS sales,
             sum(CASE WHEN st = 'F' AND day >= DATE '1998-08-01' AND day < DATE '1998-09-01' THEN v ELSE 0 END) AS tuition,
             sum(CASE WHEN st = 'F' AND day >= DATE '1998-08-01' AND day <= DATE '1998-08-10' THEN v ELSE 0 END) AS received
      FROM o GROUP BY 1)
SELECT nation, CAST(greatest(0, sales - tuition) AS DOUBLE) AS variable_revenue, CAST(received AS DOUBLE) AS received_to_date,
       floor(floor((gap + (CAST(scheduled AS DOUBLE) + gap) * 0.10::DOUBLE) * 100 + 0.5) / 100 / 31 * 100 + 0.5) / 100 AS provision_per_day
FROM (SELECT *, CAST(greatest(base - scheduled, 0) AS DOUBLE) AS gap FROM g)
""")
def provision(spark, d):
    """AG-32 / AG-33: variable revenue (sales less tuition, floored), received so far,
    and the daily expense provision (gap to the base month plus a safety share of scheduled and gap, over the days of the month)."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    x = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_nationkey").alias("nation"), F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("st"),
        (money("o_totalprice") * F.lit("0.02").cast("decimal(3,2)")).alias("v"))
    z = F.lit(0).cast("decimal(18,4)")

    def between(lo, hi_excl):
        return (F.col("day") >= F.lit(lo).cast("date")) & (F.col("day") < F.lit(hi_excl).cast("date"))
    g = x.groupBy("nation").agg(
        F.sum(F.when((F.col("st") == "O") & between("1998-07-01", "1998-08-01"), F.col("v")).otherwise(z)).alias("base"),
        F.sum(F.when((F.col("st") == "O") & between("1998-08-01", "1998-09-01"), F.col("v")).otherwise(z)).alias("scheduled"),
        F.sum(F.when(between("1998-08-01", "1998-09-01"), F.col("v")).otherwise(z)).alias("sales"),
        F.sum(F.when((F.col("st") == "F") & between("1998-08-01", "1998-09-01"), F.col("v")).otherwise(z)).alias("tuition"),
        F.sum(F.when((F.col("st") == "F") & between("1998-08-01", "1998-08-11"), F.col("v")).otherwise(z)).alias("received"))
    prov = G.provision((F.col("base") - F.col("scheduled")).cast("double"), F.col("scheduled").cast("double"), 0.10, F.lit(31))
    return g.select("nation", F.greatest(F.lit(0).cast("decimal(18,4)"), F.col("sales") - F.col("tuition"))
                    .cast("double").alias("variable_revenue"),
                    F.col("received").cast("double").alias("received_to_date"), round2(prov).alias("provision_per_day"))
