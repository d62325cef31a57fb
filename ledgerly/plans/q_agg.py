"""Aggregate and window queries on the test tables (AG-*, WN-*, CA-*, CL-9, CL-11, PJ-3, ST-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerly.functions import dates as D
from ledgerly.functions.num import money, round2
from ledgerly.operators import agg as G
from ledgerly.operators import rules as R
from ledgerly.operators import windows as W
from ledgerly.operators.alloc import share_split as _share_split
from ledgerly.plans.registry import register
from ledgerly.sources.tables import table

MONTH_SQL = "CAST(date_trunc('month', {c}) AS DATE)"


def _month(c):
    return F.trunc(F.to_date(c), "MM")


@register("totals_rollup", sql="""
SELECT CASE WHEN GROUPING(r.r_name) = 1 THEN 'TOTAL' ELSE r.r_name END AS r_name,
       CASE WHEN GROUPING(n.n_name) = 1 THEN 'TOTAL' ELSE n.n_name END AS n_name,
       (GROUPING(r.r_name) + GROUPING(n.n_name)) > 0 AS is_total,
       count(*) AS n_lines,
       CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
     JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
GROUP BY ROLLUP (r.r_name, n.n_name)
""")
def totals_rollup(spark, d):
    """AG-9 / AG-10: supplier region and nation totals with subtotal and grand-total rows."""
    li = table(spark, d, "lineitem").select("l_suppkey", "l_extendedprice")
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    x = li.join(s, li.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == n.n_nationkey) \
          .join(r, n.n_regionkey == r.r_regionkey)
    t = G.with_total(x, ["r_name", "n_name"], [F.count(F.lit(1)).alias("n_lines"),
                                                F.sum(money("l_extendedprice")).alias("revenue")])
    return t.select("r_name", "n_name", "is_total", "n_lines", F.col("revenue").cast("double").alias("revenue"))


# Fixed values of the test mapping: order priority -> cost centre text.
TEST_COST_CENTRES = [("1-URGENT", "Operação"), ("2-HIGH", "Investimentos"), ("3-MEDIUM", "Sócios"),
                     ("4-NOT SPECIFIED", "Operação")]

SQL_LEDGER = """
  ledger AS (
    SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
           CASE CASE o_orderpriority WHEN '1-URGENT' THEN 'Operação' WHEN '2-HIGH' THEN 'Investimentos'
                    WHEN '3-MEDIUM' THEN 'Sócios' WHEN '4-NOT SPECIFIED' THEN 'Operação' END
                WHEN 'Operação' THEN 'fco' WHEN 'Investimentos' THEN 'fci' WHEN 'Sócios' THEN 'fcs' END AS flow,
           o_orderstatus AS category,
           CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2))
                ELSE -CAST(o_totalprice AS DECIMAL(18,2)) END AS value
    FROM orders)"""


def ledger(spark, d):
    """Orders as ledger rows: cost centre by priority, revenue when finished (PJ-3)."""
    o = table(spark, d, "orders")
    cc = F.col("o_orderpriority")
    centre = None
    for k, v in TEST_COST_CENTRES:
        centre = F.when(cc == k, v) if centre is None else centre.when(cc == k, v)
    o = o.withColumn("cost_centre", centre)
    return o.select("o_orderkey", _month("o_orderdate").alias("month"),
                    R.flow_class("cost_centre").alias("flow"),
                    F.col("o_orderstatus").alias("category"),
                    F.when(F.col("o_orderstatus") == "F", money("o_totalprice"))
                     .otherwise(-money("o_totalprice")).alias("value"))


@register("cash_long", sql=f"""
WITH {SQL_LEDGER}
SELECT month, flow, category, CAST(sum(value) AS DOUBLE) AS net
FROM ledger WHERE flow IS NOT NULL GROUP BY 1, 2, 3
""")
def cash_long(spark, d):
    """AG-11 with CL-9 and PJ-3: month x activity x category net; unmapped centres dropped."""
    x = ledger(spark, d).where(F.col("flow").isNotNull())
    return G.cash_long(x, "month", "flow", "category", "value") \
            .withColumn("net", F.col("net").cast("double"))


MONTH_COLS = [f"m{i:02d}" for i in range(1, 13)]


@register("cash_pivot", sql=f"""
WITH {SQL_LEDGER}
SELECT year(month) AS year, flow, category,
       {", ".join(f"CAST(sum(CASE WHEN month(month) = {i} THEN value END) AS DOUBLE) AS m{i:02d}" for i in range(1, 13))}
FROM ledger WHERE flow IS NOT NULL GROUP BY 1, 2, 3
""")
def cash_pivot(spark, d):
    """AG-12: the cash-flow long form pivoted to one column per month of the year."""
    x = ledger(spark, d).where(F.col("flow").isNotNull()) \
        .withColumn("year", F.year("month").cast("bigint")) \
        .withColumn("mcol", F.concat(F.lit("m"), F.lpad(F.month("month").cast("string"), 2, "0")))
    p = G.pivot_months(x, ["year", "flow", "category"], "mcol", "value", MONTH_COLS)
    return p.select("year", "flow", "category", *[F.col(m).cast("double").alias(m) for m in MONTH_COLS])


@register("month_kpis", sql="""
WITH b AS (SELECT min(date_trunc('month', o_orderdate)) AS lo, max(date_trunc('month', o_orderdate)) AS hi FROM orders),
sp AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM b),
k AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
             sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue, count(DISTINCT o_custkey) AS payers
      FROM orders GROUP BY 1)
SELECT sp.month, CAST(coalesce(k.revenue, 0) AS DOUBLE) AS revenue, coalesce(k.payers, 0) AS payers,
       floor(coalesce(CAST(k.revenue AS DOUBLE) / k.payers, 0.0) * 100 + 0.5) / 100 AS ticket
FROM sp LEFT JOIN k USING (month)
""")
def month_kpis(spark, d):
    """JN-17 with AG-13 and AG-14: month spine, revenue, distinct payers, average ticket."""
    o = table(spark, d, "orders").select(_month("o_orderdate").alias("month"), "o_totalprice", "o_custkey")
    k = G.month_kpis(o.withColumn("v", money("o_totalprice")), "month", "v", "o_custkey")
    spine = o.agg(F.min("month").alias("lo"), F.max("month").alias("hi")) \
             .select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month"))
    j = spine.join(k, "month", "left")
    return j.select("month", F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("revenue"),
                    F.coalesce("payers", F.lit(0)).cast("bigint").alias("payers"),
                    round2(F.coalesce(F.try_divide(F.col("revenue").cast("double"), F.col("payers")),
                                      F.lit(0.0))).alias("ticket"))


@register("ticket_kpis", sql="""
WITH x AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
                  sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS gross,
                  sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS disc,
                  count(DISTINCT l_orderkey) AS n_orders
           FROM lineitem GROUP BY 1)
SELECT month, CAST(gross AS DOUBLE) AS gross, CAST(disc AS DOUBLE) AS discount, n_orders,
       floor(coalesce(CAST(disc AS DOUBLE) * 100 / CAST(gross AS DOUBLE), 0.0) * 100 + 0.5) / 100 AS discount_share,
       floor(coalesce(CAST(gross - disc AS DOUBLE) / n_orders, 0.0) * 100 + 0.5) / 100 AS avg_ticket
FROM x
""")
def ticket_kpis(spark, d):
    """AG-16 with AG-14: discount share and average ticket per ship month."""
    li = table(spark, d, "lineitem")
    x = li.groupBy(_month("l_shipdate").alias("month")).agg(
        F.sum(money("l_extendedprice")).alias("gross"),
        F.sum(money("l_extendedprice") * money("l_discount")).alias("disc"),
        F.countDistinct("l_orderkey").alias("n_orders"))
    return x.select("month", F.col("gross").cast("double").alias("gross"),
                    F.col("disc").cast("double").alias("discount"), "n_orders",
                    round2(F.coalesce(F.try_divide(F.col("disc").cast("double") * 100, F.col("gross").cast("double")),
                                      F.lit(0.0))).alias("discount_share"),
                    round2(F.coalesce(F.try_divide((F.col("gross") - F.col("disc")).cast("double"),
                                                   F.col("n_orders")), F.lit(0.0))).alias("avg_ticket"))


# Fixed values of the test mapping: target share (percent) of each event type.
EVENT_TARGETS = [("click", 30.0), ("view", 30.0), ("purchase", 15.0), ("signup", 15.0), ("error", 10.0)]


@register("mix_vs_target", sql="""
WITH t(event_type, target_pct) AS (VALUES ('click', 30.0), ('view', 30.0), ('purchase', 15.0), ('signup', 15.0), ('error', 10.0)),
days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
c AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2),
tot AS (SELECT CAST(ts AS DATE) AS day, count(*) AS total FROM events GROUP BY 1),
j AS (SELECT days.day, t.event_type, CAST(t.target_pct AS DOUBLE) AS target_pct, coalesce(c.n, 0) AS n,
             coalesce(coalesce(c.n, 0) * 100.0 / tot.total, 0.0) AS share
      FROM days JOIN t ON true LEFT JOIN c ON c.day = days.day AND c.event_type = t.event_type
      LEFT JOIN tot ON tot.day = days.day)
SELECT day, event_type, target_pct, n, floor(share * 100 + 0.5) / 100 AS share_pct,
       floor((share - target_pct) * 100 + 0.5) / 100 AS deviation,
       CASE WHEN share - target_pct >= 10 THEN 'MUITO ACIMA' WHEN share - target_pct <= -10 THEN 'MUITO ABAIXO'
            WHEN share - target_pct <= -3 THEN 'ABAIXO' WHEN share - target_pct >= 3 THEN 'ACIMA'
            ELSE 'NO ALVO' END AS band
FROM j
""")
def mix_vs_target(spark, d):
    """RP-8 (JN-16, AG-15, CL-11): daily event mix against target shares, banded."""
    e = table(spark, d, "events").select(F.to_date("ts").alias("day"), "event_type")
    c = e.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"))
    targets = F.array(*[F.struct(F.lit(t).alias("event_type"), F.lit(p).alias("target_pct"))
                        for t, p in EVENT_TARGETS])
    spine = e.select("day").distinct().select("day", F.inline(targets))
    j = spine.join(c, ["day", "event_type"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))
    j = G.share(j, "n", ["day"], "share")
    dev = F.col("share") - F.col("target_pct")
    return j.select("day", "event_type", "target_pct", "n", round2("share").alias("share_pct"),
                    round2(dev).alias("deviation"), R.band(dev).alias("band"))


@register("rescale", sql="""
WITH det AS (SELECT c.c_mktsegment AS segment, o.o_orderpriority AS part,
                    sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS v
             FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2),
tot AS (SELECT c.c_mktsegment AS segment, sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS total
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
        GROUP BY 1),
s AS (SELECT segment, sum(v) AS s FROM det GROUP BY 1)
SELECT det.segment, det.part,
       floor(coalesce(CAST(det.v AS DOUBLE) * CAST(tot.total AS DOUBLE) / CAST(s.s AS DOUBLE), 0.0) * 100 + 0.5) / 100 AS rescaled
FROM det JOIN s USING (segment) JOIN tot USING (segment)
UNION ALL
SELECT tot.segment, 'Outros' AS part, floor(CAST(tot.total AS DOUBLE) * 100 + 0.5) / 100 AS rescaled
FROM tot WHERE tot.segment NOT IN (SELECT segment FROM s)
""")
def rescale(spark, d):
    """AG-19: order value by segment and priority rescaled to the segment's line total."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    oc = o.join(c, o.o_custkey == c.c_custkey)
    det = oc.groupBy("segment", F.col("o_orderpriority").alias("part")).agg(F.sum(money("o_totalprice")).alias("v"))
    li = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice")
    tot = li.join(oc.select("o_orderkey", "segment"), li.l_orderkey == oc.o_orderkey) \
            .groupBy("segment").agg(F.sum(money("l_extendedprice")).alias("total"))
    r = G.rescale(det, tot, ["segment"], "part", "v", "total", "Outros")
    return r.select("segment", "part", round2("rescaled").alias("rescaled"))


@register("latest_month_sum", sql="""
WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s
           FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT o_custkey, max(month) AS latest_month, CAST(arg_max(s, month) AS DOUBLE) AS latest_sum FROM m GROUP BY 1
""")
def latest_month_sum(spark, d):
    """AG-21: each customer's total in their latest month with a finished order."""
    o = table(spark, d, "orders").where(F.col("o_orderstatus") == "F") \
        .select("o_custkey", _month("o_orderdate").alias("month"), money("o_totalprice").alias("v"))
    r = G.latest_month_sum(o, "o_custkey", "month", "v")
    return r.select("o_custkey", "latest_month", F.col("latest_sum").cast("double").alias("latest_sum"))


@register("balance_due", sql="""
WITH e AS (SELECT o_custkey AS cust_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                  CASE WHEN day(o_orderdate) <= 20 THEN 1 ELSE 2 END AS period,
                  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS earned FROM orders GROUP BY 1, 2, 3),
p AS (SELECT o.o_custkey AS cust_key, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS month,
             CASE WHEN day(l.l_shipdate) <= 20 THEN 1 ELSE 2 END AS period,
             sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS paid
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2, 3)
SELECT cust_key, month, period, CAST(coalesce(earned, 0) AS DOUBLE) AS earned, CAST(coalesce(paid, 0) AS DOUBLE) AS paid,
       CAST(greatest(0, coalesce(earned, 0) - coalesce(paid, 0)) AS DOUBLE) AS due
FROM e FULL OUTER JOIN p USING (cust_key, month, period)
""")
def balance_due(spark, d):
    """AG-24 with CL-17: earned (orders) minus paid (lines) per customer, month and half-month."""
    o = table(spark, d, "orders")
    e = o.select(F.col("o_custkey").alias("cust_key"), _month("o_orderdate").alias("month"),
                 D.period_of("o_orderdate").alias("period"), money("o_totalprice").alias("v"))
    li = table(spark, d, "lineitem")
    p = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey) \
          .select(F.col("o_custkey").alias("cust_key"), _month("l_shipdate").alias("month"),
                  D.period_of("l_shipdate").alias("period"), money("l_extendedprice").alias("v"))
    r = G.balance_due(e, p, ["cust_key", "month", "period"], "v", "v")
    return r.select("cust_key", "month", "period", *[F.col(c).cast("double").alias(c) for c in ("earned", "paid", "due")])


@register("latest_snapshot", sql="""
SELECT user_id, max(ts) AS latest_ts, arg_max(value, (ts, value)) AS latest_value FROM events GROUP BY 1
""")
def latest_snapshot(spark, d):
    """AG-26: each user's value at their latest event."""
    return G.latest(table(spark, d, "events"), "user_id", "value", "ts")


@register("in_out_net", sql="""
SELECT user_id,
       CAST(sum(CASE WHEN event_type IN ('purchase', 'signup') THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS inflow,
       CAST(sum(CASE WHEN event_type NOT IN ('purchase', 'signup') THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS outflow,
       CAST(sum(CASE WHEN event_type IN ('purchase', 'signup') THEN CAST(value AS DECIMAL(18,2))
                     ELSE -CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS net
FROM events GROUP BY 1
""")
def in_out_net(spark, d):
    """AG-25: inflow, outflow and net per user (purchases and signups flow in)."""
    e = table(spark, d, "events").withColumn("v", money("value"))
    r = G.in_out_net(e, ["user_id"], "v", F.col("event_type").isin("purchase", "signup"))
    return r.select("user_id", *[F.col(c).cast("double").alias(c) for c in ("inflow", "outflow", "net")])


@register("investment_balance", sql="""
SELECT user_id, CAST(1000.00 + coalesce(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2))
                                                  ELSE -CAST(value AS DECIMAL(18,2)) END)
                       FILTER (WHERE CAST(ts AS DATE) >= DATE '2024-01-05' AND CAST(ts AS DATE) <= DATE '2024-01-25'), 0) AS DOUBLE) AS balance
FROM events
WHERE event_type = 'purchase' OR regexp_matches(lower(coalesce(props, '') || ' ' || event_type), 'signup|resgate')
GROUP BY 1
""")
def investment_balance(spark, d):
    """AG-27 with FL-7: opening plus buys minus redemptions in a date window, per user."""
    from ledgerly.operators.filters import investment_moves
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    m = investment_moves(e, type_col="event_type", type_value="purchase", text_cols=["props", "event_type"],
                         words=["signup", "resgate"])
    m = m.withColumn("v", F.when(F.col("event_type") == "purchase", money("value")).otherwise(-money("value")))
    r = G.investment_balance(m, ["user_id"], "day", "v", 1000, "2024-01-05", "2024-01-25")
    return r.select("user_id", F.col("balance").cast("double").alias("balance"))


SQL_NATION_MONTH = """
  nm AS (SELECT c.c_nationkey AS nation, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month,
                sum(CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_totalprice AS DECIMAL(18,2))
                         ELSE -CAST(o.o_totalprice AS DECIMAL(18,2)) END) AS net
         FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2)"""


def nation_month(spark, d):
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    x = o.join(c, o.o_custkey == c.c_custkey)
    v = F.when(F.col("o_orderstatus") == "F", money("o_totalprice")).otherwise(-money("o_totalprice"))
    return x.groupBy(F.col("c_nationkey").alias("nation"), _month("o_orderdate").alias("month")) \
            .agg(F.sum(v).alias("net"))


@register("running_balance", sql=f"""
WITH {SQL_NATION_MONTH},
seed AS (SELECT c_nationkey AS nation, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS opening0 FROM customer GROUP BY 1),
r AS (SELECT nm.*, coalesce(seed.opening0, 0) + sum(net) OVER (PARTITION BY nm.nation ORDER BY month
                                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS closing
      FROM nm LEFT JOIN seed USING (nation))
SELECT nation, month, CAST(closing - net AS DOUBLE) AS opening, CAST(net AS DOUBLE) AS net, CAST(closing AS DOUBLE) AS closing FROM r
""")
def running_balance(spark, d):
    """WN-3: monthly balance per nation from an opening seed (customer balances)."""
    nm = nation_month(spark, d)
    seed = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation")) \
                                      .agg(F.sum(money("c_acctbal")).alias("seed"))
    x = nm.join(seed, "nation", "left").withColumn("seed", F.coalesce("seed", F.lit(0).cast("decimal(18,2)")))
    r = W.running_balance(x, ["nation"], "month", "net", "seed")
    return r.select("nation", "month", *[F.col(c).cast("double").alias(c) for c in ("opening", "net", "closing")])


@register("daily_balance", sql="""
WITH b AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
sp AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b),
n AS (SELECT CAST(ts AS DATE) AS day,
             sum(CASE WHEN event_type IN ('purchase', 'signup') THEN CAST(value AS DECIMAL(18,2))
                      ELSE -CAST(value AS DECIMAL(18,2)) END) AS net FROM events GROUP BY 1),
j AS (SELECT sp.day, coalesce(n.net, 0) AS net FROM sp LEFT JOIN n USING (day))
SELECT day, CAST(net AS DOUBLE) AS net,
       CAST(10000.00 + sum(net) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS closing
FROM j
""")
def daily_balance(spark, d):
    """WN-4: running cash balance by day over a day spine, from a fixed opening."""
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    v = F.when(F.col("event_type").isin("purchase", "signup"), money("value")).otherwise(-money("value"))
    n = e.groupBy("day").agg(F.sum(v).alias("net"))
    spine = e.agg(F.min("day").alias("lo"), F.max("day").alias("hi")) \
             .select(F.explode(F.sequence("lo", "hi")).alias("day"))
    j = spine.join(n, "day", "left").withColumn("net", F.coalesce("net", F.lit(0).cast("decimal(18,2)"))) \
             .withColumn("k", F.lit(1)).withColumn("seed", F.lit(10000).cast("decimal(18,2)"))
    r = W.running_balance(j, ["k"], "day", "net", "seed")
    return r.select("day", F.col("net").cast("double").alias("net"), F.col("closing").cast("double").alias("closing"))


@register("trailing_base", sql=f"""
WITH {SQL_NATION_MONTH},
b AS (SELECT nation, min(month) AS lo, max(month) AS hi FROM nm GROUP BY 1),
sp AS (SELECT nation, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM b),
j AS (SELECT sp.nation, sp.month, nm.net FROM sp LEFT JOIN nm USING (nation, month)),
w AS (SELECT nation, month, net,
             sum(net) OVER (PARTITION BY nation ORDER BY month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS s,
             count(net) OVER (PARTITION BY nation ORDER BY month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS c
      FROM j)
SELECT nation, month, CAST(net AS DOUBLE) AS net, c AS history_months,
       floor(CASE WHEN c >= 12 THEN CAST(s AS DOUBLE) WHEN c > 0 THEN CAST(s AS DOUBLE) / c * 12 END * 100 + 0.5) / 100 AS trailing_base
FROM w
""")
def trailing_base(spark, d):
    """WN-5: trailing 12-month base per nation on a month spine; short history annualised."""
    nm = nation_month(spark, d)
    spine = nm.groupBy("nation").agg(F.min("month").alias("lo"), F.max("month").alias("hi")) \
              .select("nation", F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month"))
    j = spine.join(nm, ["nation", "month"], "left")
    r = W.trailing_base(j, ["nation"], "month", "net", 12)
    return r.select("nation", "month", F.col("net").cast("double").alias("net"),
                    F.col("history_months").cast("bigint").alias("history_months"),
                    round2("trailing_base").alias("trailing_base"))


@register("carry_forward", sql=f"""
WITH {SQL_NATION_MONTH}
SELECT nation, month, CAST(net AS DOUBLE) AS net,
       CAST(coalesce(lag(net, 1) OVER (PARTITION BY nation ORDER BY month), 0) AS DOUBLE) AS carried_in
FROM nm
""")
def carry_forward(spark, d):
    """WN-6: last month's net carried into the next month per nation."""
    nm = nation_month(spark, d)
    r = W.carry_forward(nm, ["nation"], "month", "net", seed=0)
    return r.select("nation", "month", F.col("net").cast("double").alias("net"),
                    F.col("carried_in").cast("double").alias("carried_in"))


@register("weighted_share", sql="""
WITH c AS (SELECT CAST(ts AS DATE) AS day, count(*) AS weight FROM events GROUP BY 1)
SELECT day, weight,
       floor(CAST(weight AS DOUBLE) / CAST(sum(weight) OVER (ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE)
             * 10000 * 100 + 0.5) / 100 AS share_bp
FROM c
""")
def weighted_share(spark, d):
    """WN-8: each day's weight over the weights still ahead (basis points, 2 decimals)."""
    c = table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("weight")) \
        .withColumn("k", F.lit(1))
    r = W.weighted_share(c, ["k"], "day", "weight", "s")
    return r.select("day", "weight", round2(F.col("s") * 10000).alias("share_bp"))


# Open hours per JS weekday (0 = Sunday .. 6 = Saturday).
OPEN_HOURS = [(0, 11), (1, 15), (2, 15), (3, 15), (4, 15), (5, 15), (6, 11)]


def order_months(spark, d):
    return table(spark, d, "orders").select(_month("o_orderdate").alias("month")).distinct()


@register("weekday_count", sql="""
WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
c AS (SELECT month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day FROM m)
SELECT month, dayofweek(day) AS js_dow, count(*) AS occurrences FROM c GROUP BY 1, 2
""")
def weekday_count(spark, d):
    """CA-1: occurrences of each weekday in every month that has orders."""
    cal = W.calendar(order_months(spark, d))
    return W.weekday_count(cal).select("month", F.col("js_dow").cast("bigint").alias("js_dow"),
                                       F.col("occurrences").cast("bigint").alias("occurrences"))


@register("open_hours", sql="""
WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
c AS (SELECT month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day FROM m)
SELECT month, sum(CASE WHEN dayofweek(day) IN (0, 6) THEN 11.0 ELSE 15.0 END)::DOUBLE AS open_hours FROM c GROUP BY 1
""")
def open_hours(spark, d):
    """CA-2: open hours per month from the weekday schedule."""
    cal = W.calendar(order_months(spark, d))
    return W.open_hours(cal, OPEN_HOURS)


@register("slot_frequency", sql="""
WITH e AS (SELECT user_id, dayofweek(ts) AS dow, hour(ts) AS h,
                  dayofweek(ts) BETWEEN 1 AND 5 AND hour(ts) BETWEEN 10 AND 15 AS off_peak FROM events),
s AS (SELECT user_id, count(*) AS n_slots FROM (SELECT DISTINCT user_id, dow, h FROM e) GROUP BY 1),
o AS (SELECT user_id, count(*) AS n_events, CAST(sum(CASE WHEN off_peak THEN 1 ELSE 0 END) AS BIGINT) AS n_off_peak FROM e GROUP BY 1)
SELECT o.user_id, s.n_slots, CASE WHEN s.n_slots = 2 THEN 0.05 WHEN s.n_slots >= 3 THEN 0.07 ELSE 0.0 END::DOUBLE AS freq_discount,
       o.n_events, o.n_off_peak
FROM o JOIN s USING (user_id)
""")
def slot_frequency(spark, d):
    """CL-13, CL-15 and WN-7: weekly slots per user, frequency discount, off-peak count."""
    e = table(spark, d, "events").select("user_id", D.js_dow("ts").alias("dow"), F.hour("ts").alias("h"),
                                         R.is_off_peak("ts", F.hour("ts")).alias("off_peak"))
    r = W.slot_totals(e, "user_id", ["dow", "h"], {"n_events": F.lit(1), "n_off_peak": F.col("off_peak").cast("int")})
    return r.select("user_id", F.col("n_slots").cast("bigint").alias("n_slots"),
                    R.freq_discount("n_slots").alias("freq_discount"), "n_events",
                    F.col("n_off_peak").cast("bigint").alias("n_off_peak"))


@register("share_split", sql="""
WITH x AS (SELECT l.l_orderkey, l.l_linenumber, s.s_name, l.l_extendedprice,
                  isodow(l.l_shipdate) = 6 AND l.l_returnflag = 'R' AS split
           FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey)
SELECT l_orderkey, l_linenumber, s_name AS person, floor(l_extendedprice * 1.0 * 100 + 0.5) / 100 AS value FROM x WHERE NOT split
UNION ALL
SELECT l_orderkey, l_linenumber, s_name AS person, floor(l_extendedprice * 0.5 * 100 + 0.5) / 100 AS value FROM x WHERE split
UNION ALL
SELECT l_orderkey, l_linenumber, 'Supplier#000000000' AS person, floor(l_extendedprice * 0.5 * 100 + 0.5) / 100 AS value FROM x WHERE split
""")
def share_split(spark, d):
    """ST-5 (one scan instead of ST-1's two): Saturday returned lines split half to a partner supplier."""
    li = table(spark, d, "lineitem")
    s = table(spark, d, "supplier").select("s_suppkey", "s_name")
    x = li.join(s, li.l_suppkey == s.s_suppkey)
    cond = (D.isodow("l_shipdate") == 6) & (F.col("l_returnflag") == "R")
    r = _share_split(x, cond, "s_name", "Supplier#000000000", ["l_extendedprice"])
    return r.select("l_orderkey", "l_linenumber", F.col("s_name").alias("person"),
                    round2("l_extendedprice").alias("value"))


@register("audit_list", sql="""
SELECT 'ledger' AS source, o_orderkey AS ref, CAST(o_orderdate AS DATE) AS day,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE -o_totalprice END AS amount
FROM orders WHERE o_orderstatus IN ('F', 'O')
UNION ALL
SELECT 'bank' AS source, event_id AS ref, CAST(ts AS DATE) AS day,
       CASE WHEN event_type = 'purchase' THEN value ELSE -value END AS amount
FROM events WHERE event_type IN ('purchase', 'error')
""")
def audit_list(spark, d):
    """RP-17 (ST-3, PJ-3, SO-3): paid ledger and bank movements in one list, newest and largest first."""
    from ledgerly.operators.setops import audit_union
    o = table(spark, d, "orders").where(F.col("o_orderstatus").isin("F", "O")) \
        .select(F.lit("ledger").alias("source"), F.col("o_orderkey").alias("ref"),
                F.to_date("o_orderdate").alias("day"),
                F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(-F.col("o_totalprice")).alias("amount"))
    e = table(spark, d, "events").where(F.col("event_type").isin("purchase", "error")) \
        .select(F.lit("bank").alias("source"), F.col("event_id").alias("ref"), F.to_date("ts").alias("day"),
                F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(-F.col("value")).alias("amount"))
    return audit_union(o, e)
