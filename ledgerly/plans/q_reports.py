"""Rule classification and report queries: CL-1, CL-6, CL-19, FL-1, AG-7, AG-18,
AG-30, AG-31, RP-6, RP-11, RP-13, RP-14, RP-15, RP-16 on the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerly.functions.num import money, round2
from ledgerly.operators import agg as G
from ledgerly.operators import filters as FL
from ledgerly.operators import rules as R
from ledgerly.operators import windows as W
from ledgerly.plans.q_agg import OPEN_HOURS, ledger
from ledgerly.plans.registry import register
from ledgerly.sources.tables import table

# Fixed values of the test mapping: a first-match label rule set over part and
# line columns, the fallback pattern and the sentinel (shape of CL-1).
LABEL_RULES = [
    ("widget promo", ("all", [("contains", "p_name", "widget"), ("equals", "p_type", "PROMO")])),
    ("red goods", ("contains", "p_name", "red")),
    ("large or promo", ("in", "p_type", ["PROMO", "LARGE"])),
]
LABEL_FALLBACK_RE = r"(?i)brand#\s*([^.(]+)"
LABEL_DEFAULT = "unlabelled"


@register("classify_first_match", sql="""
WITH x AS (SELECT l.l_extendedprice, p.p_name, p.p_type, p.p_brand
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
           WHERE l.l_linestatus = 'F' AND l.l_returnflag IN ('A', 'R') AND NOT (p.p_name ILIKE '%old%')),
y AS (SELECT l_extendedprice,
             COALESCE(CASE WHEN p_name ILIKE '%widget%' AND lower(p_type) = 'promo' THEN 'widget promo'
                           WHEN p_name ILIKE '%red%' THEN 'red goods'
                           WHEN p_type IN ('PROMO', 'LARGE') THEN 'large or promo' END,
                      nullif(trim(regexp_replace(regexp_extract(p_brand, '(?i)brand#\\s*([^.(]+)', 1), '\\s+', ' ', 'g')), ''),
                      'unlabelled') AS label
      FROM x)
SELECT label, count(*) AS n_lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM y GROUP BY 1
""")
def classify_first_match(spark, d):
    """CL-1 with FL-1: active lines (finished, A/R, no 'old' part) labelled by the
    first matching rule, else the brand number from a regex, else a sentinel."""
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part")
    x = li.join(p, li.l_partkey == p.p_partkey)
    x = FL.active(x, "l_linestatus", "F", "l_returnflag", ["A", "R"], "p_name", ["old"])
    lbl = R.resolve_label(LABEL_RULES, "p_brand", LABEL_FALLBACK_RE, LABEL_DEFAULT)
    return x.groupBy(lbl.alias("label")).agg(F.count(F.lit(1)).alias("n_lines"),
                                             F.sum(money("l_extendedprice")).cast("double").alias("value"))


# Fixed values of the test mapping: a five-class rule set shaped like the
# operations classification (first match; the last class is the default).
CLASS_RULES = [
    ("Monthly rental", ("contains", "p_type", "promo")),
    ("Court rental", ("any", [("equals", "c_mktsegment", "building"), ("contains", "p_name", "plate")])),
    ("Single lessons", ("all", [("any", [("equals", "c_mktsegment", "machinery"), ("contains", "p_name", "gear")]),
                                ("any", [("contains", "p_name", "small"), ("contains", "p_type", "small")])])),
    ("Regular lessons", ("any", [("equals", "c_mktsegment", "machinery"), ("contains", "p_name", "gear")])),
]
CLASS_DEFAULT = "Snack bar"


@register("revenue_class", sql="""
WITH x AS (SELECT o.o_custkey, l.l_extendedprice,
                  CASE WHEN lower(p.p_type) LIKE '%promo%' THEN 'Monthly rental'
                       WHEN lower(c.c_mktsegment) = 'building' OR lower(p.p_name) LIKE '%plate%' THEN 'Court rental'
                       WHEN (lower(c.c_mktsegment) = 'machinery' OR lower(p.p_name) LIKE '%gear%')
                            AND (lower(p.p_name) LIKE '%small%' OR lower(p.p_type) LIKE '%small%') THEN 'Single lessons'
                       WHEN lower(c.c_mktsegment) = 'machinery' OR lower(p.p_name) LIKE '%gear%' THEN 'Regular lessons'
                       ELSE 'Snack bar' END AS class
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
                JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey)
SELECT CASE WHEN GROUPING(class) = 1 THEN 'TOTAL' ELSE class END AS class, GROUPING(class) = 1 AS is_total,
       count(DISTINCT o_custkey) AS clients, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM x GROUP BY ROLLUP (class)
""")
def revenue_class(spark, d):
    """RP-6 (CL-6, AG-7, AG-10): revenue and distinct clients per class, with a total row."""
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    x = li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey) \
          .join(c, F.col("o_custkey") == c.c_custkey)
    x = x.withColumn("class", R.revenue_class(CLASS_RULES, CLASS_DEFAULT))
    t = G.with_total(x, ["class"], [F.countDistinct("o_custkey").alias("clients"),
                                    F.sum(money("l_extendedprice")).alias("total")])
    return t.select("class", "is_total", "clients", F.col("total").cast("double").alias("total"))


# Fixed values of the test mapping: order priority -> payment method.
TEST_PAY_METHODS = [("1-URGENT", "tarjeta"), ("2-HIGH", "Cartão Crédito"), ("3-MEDIUM", "Cartão Débito")]
PROVIDER_FEE_RATE = "0.0099"


@register("fees", sql="""
WITH p AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(o_totalprice AS DECIMAL(18,2)) AS amt,
                  CASE o_orderpriority WHEN '1-URGENT' THEN 'tarjeta' WHEN '2-HIGH' THEN 'Cartão Crédito'
                       WHEN '3-MEDIUM' THEN 'Cartão Débito' ELSE 'pix' END AS method, o_orderstatus
           FROM orders)
SELECT month,
       CAST(round(sum(amt * CASE method WHEN 'tarjeta' THEN 0.0193 WHEN 'Cartão Crédito' THEN 0.0193
                                        WHEN 'Cartão Débito' THEN 0.0099 ELSE 0.0 END), 2) AS DOUBLE) AS card_fees,
       CAST(round(sum(CASE WHEN o_orderstatus = 'O' THEN amt * 0.0099 ELSE 0 END), 2) AS DOUBLE) AS provider_fees,
       CAST(round(sum(amt * CASE method WHEN 'tarjeta' THEN 0.0193 WHEN 'Cartão Crédito' THEN 0.0193
                                        WHEN 'Cartão Débito' THEN 0.0099 ELSE 0.0 END)
                  + sum(CASE WHEN o_orderstatus = 'O' THEN amt * 0.0099 ELSE 0 END), 2) AS DOUBLE) AS total_fees
FROM p GROUP BY 1
""")
def fees(spark, d):
    """AG-18 with CL-19: card fees by method rate plus provider fees, per month."""
    o = table(spark, d, "orders")
    cc = F.col("o_orderpriority")
    method = F.coalesce(*[F.when(cc == k, F.lit(v)) for k, v in TEST_PAY_METHODS], F.lit("pix"))
    rate = R.fee_rate("method").cast("decimal(6,4)")
    x = o.select(F.trunc(F.to_date("o_orderdate"), "MM").alias("month"), money("o_totalprice").alias("amt"),
                 method.alias("method"), "o_orderstatus").withColumn("rate", rate)
    prov = F.when(F.col("o_orderstatus") == "O", F.col("amt") * F.lit(PROVIDER_FEE_RATE).cast("decimal(6,4)")) \
            .otherwise(F.lit(0).cast("decimal(6,4)"))
    g = x.groupBy("month").agg(F.sum(F.col("amt") * F.col("rate")).alias("card"), F.sum(prov).alias("prov"))
    return g.select("month", F.round("card", 2).cast("double").alias("card_fees"),
                    F.round("prov", 2).cast("double").alias("provider_fees"),
                    F.round(F.col("card") + F.col("prov"), 2).cast("double").alias("total_fees"))


@register("capacity", sql="""
WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS hours,
                  count(DISTINCT o_orderpriority) AS units,
                  sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS maint_hours
           FROM orders GROUP BY 1),
c AS (SELECT month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day FROM m),
h AS (SELECT month, sum(CASE WHEN dayofweek(day) IN (0, 6) THEN 11.0 ELSE 15.0 END)::DOUBLE AS open_hours FROM c GROUP BY 1)
SELECT m.month, m.hours, m.units, h.open_hours, greatest(m.units, 4) * h.open_hours AS capacity,
       floor(coalesce(m.hours * 100.0 / (greatest(m.units, 4) * h.open_hours), 0.0) * 100 + 0.5) / 100 AS occupancy_pct,
       greatest(0.0, greatest(m.units, 4) * h.open_hours - m.hours) AS free_hours,
       CAST(m.hours - m.maint_hours AS BIGINT) AS productive_hours
FROM m JOIN h USING (month)
""")
def capacity(spark, d):
    """AG-30 / AG-31 with CA-2, FL-8: monthly capacity (open hours x units, floor 4), occupancy, free hours."""
    o = table(spark, d, "orders").withColumn("month", F.trunc(F.to_date("o_orderdate"), "MM"))
    m = o.groupBy("month").agg(F.count(F.lit(1)).alias("hours"), F.countDistinct("o_orderpriority").alias("units"),
                               F.sum(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("maint_hours"))
    h = W.open_hours(W.calendar(m.select("month")), OPEN_HOURS)
    x = m.join(h, "month")
    cap = G.capacity(F.col("open_hours"), F.col("units"), 4)
    return x.select("month", "hours", "units", "open_hours", cap.alias("capacity"),
                    round2(F.coalesce(F.try_divide(F.col("hours") * 100.0, cap), F.lit(0.0))).alias("occupancy_pct"),
                    F.greatest(F.lit(0.0), cap - F.col("hours")).alias("free_hours"),
                    (F.col("hours") - F.col("maint_hours")).cast("bigint").alias("productive_hours"))


# Progressive brackets (upper bound of the trailing base, nominal
# rate, deduction), the first bracket being a flat rate, and the 4% / 96% split.
BRACKETS = [(180000.0, 0.06, 0.0), (360000.0, 0.112, 9360.0), (720000.0, 0.135, 17640.0),
            (1800000.0, 0.16, 35640.0), (3600000.0, 0.143, 125640.0), (None, 0.19, 378000.0)]
INCOME_TAX_SHARE, OTHER_TAX_SHARE = 0.04, 0.96
TEST_SCALE = "0.02"          # the test mapping scales order value down to a small business
TEST_COMMISSION = "0.10"


def statement_base(spark, d):
    """Gross revenue and commission per nation and month on a zero-filled month spine."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    x = o.join(c, o.o_custkey == c.c_custkey)
    sc = F.lit(TEST_SCALE).cast("decimal(4,2)")
    v = money("o_totalprice") * sc
    g = x.groupBy(F.col("c_nationkey").alias("nation"), F.trunc(F.to_date("o_orderdate"), "MM").alias("month")) \
         .agg(F.sum(v).alias("gross"),
              F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", v * F.lit(TEST_COMMISSION).cast("decimal(3,2)"))
                     .otherwise(F.lit(0))).alias("commission"),
              F.sum(F.when(F.col("o_orderstatus") == "P", v).otherwise(F.lit(0))).alias("opex"))
    spine = g.groupBy("nation").agg(F.min("month").alias("lo"), F.max("month").alias("hi")) \
             .select("nation", F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month"))
    z = F.lit(0).cast("decimal(18,2)")
    return spine.join(g, ["nation", "month"], "left").select(
        "nation", "month", *[F.coalesce(F.col(k), z).alias(k) for k in ("gross", "commission", "opex")])


def bracket_tax(df, base: str = "base", keys=("nation",), month: str = "month", brackets=None,
                income_share: float = INCOME_TAX_SHARE):
    """RP-15: trailing-12 base (WN-5 rule, counting spine months) and the
    progressive bracket tax split 4% / 96%. ``df`` holds one row per key and
    month (a spine)."""
    brackets = brackets or BRACKETS
    w_all = Window.partitionBy(*keys).orderBy(month).rowsBetween(Window.unboundedPreceding, -1)
    w_12 = Window.partitionBy(*keys).orderBy(month).rowsBetween(-12, -1)
    n_prior = F.count(F.lit(1)).over(w_all)
    rbt = (F.when(n_prior == 0, F.col(base).cast("double") * 12)
            .when(n_prior < 12, F.sum(base).over(w_all).cast("double") / n_prior * 12)
            .otherwise(F.sum(base).over(w_12).cast("double")))
    x = df.withColumn("rbt12", rbt)
    r = F.col("rbt12")
    nominal = F.lit(brackets[-1][1])
    deduct = F.lit(brackets[-1][2])
    for hi, rate, ded in reversed(brackets[:-1]):
        nominal = F.when(r <= hi, F.lit(rate)).otherwise(nominal)
        deduct = F.when(r <= hi, F.lit(ded)).otherwise(deduct)
    eff = F.when(r <= brackets[0][0], nominal).otherwise((r * nominal - deduct) / r)
    total = F.col(base).cast("double") * F.greatest(F.lit(0.0), eff)
    return x.withColumn("eff_rate", eff).withColumn("ir", round2(total * income_share)) \
            .withColumn("taxes", round2(total * (1.0 - income_share) if income_share != INCOME_TAX_SHARE
                                        else total * OTHER_TAX_SHARE))


#: From s(nation, month, base, ...) to x with the taxes of each month.
SQL_TAX = """
  t AS (SELECT s.*,
               count(*) OVER (PARTITION BY nation ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n_prior,
               sum(base) OVER (PARTITION BY nation ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s_all,
               sum(base) OVER (PARTITION BY nation ORDER BY month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS s_12
        FROM s),
  r AS (SELECT t.*, CASE WHEN n_prior = 0 THEN CAST(base AS DOUBLE) * 12
                         WHEN n_prior < 12 THEN CAST(s_all AS DOUBLE) / n_prior * 12
                         ELSE CAST(s_12 AS DOUBLE) END AS rbt12 FROM t),
  k AS (SELECT r.*, CASE WHEN rbt12 <= 180000.0 THEN 0.06 WHEN rbt12 <= 360000.0 THEN 0.112
                         WHEN rbt12 <= 720000.0 THEN 0.135 WHEN rbt12 <= 1800000.0 THEN 0.16
                         WHEN rbt12 <= 3600000.0 THEN 0.143 ELSE 0.19 END::DOUBLE AS nominal,
                    CASE WHEN rbt12 <= 180000.0 THEN 0.0 WHEN rbt12 <= 360000.0 THEN 9360.0
                         WHEN rbt12 <= 720000.0 THEN 17640.0 WHEN rbt12 <= 1800000.0 THEN 35640.0
                         WHEN rbt12 <= 3600000.0 THEN 125640.0 ELSE 378000.0 END::DOUBLE AS deduct FROM r),
  e AS (SELECT k.*, CASE WHEN rbt12 <= 180000.0 THEN nominal ELSE (rbt12 * nominal - deduct) / rbt12 END AS eff FROM k),
  x AS (SELECT e.*, floor(CAST(base AS DOUBLE) * greatest(0.0, eff) * 0.04 * 100 + 0.5) / 100 AS ir,
               floor(CAST(base AS DOUBLE) * greatest(0.0, eff) * 0.96 * 100 + 0.5) / 100 AS taxes FROM e)"""
SQL_STATEMENT = """
  o AS (SELECT c.c_nationkey AS nation, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month,
               CAST(o.o_totalprice AS DECIMAL(18,2)) * 0.02 AS v, o.o_orderpriority, o.o_orderstatus
        FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
  g AS (SELECT nation, month, sum(v) AS gross,
               sum(CASE WHEN o_orderpriority = '1-URGENT' THEN v * 0.10 ELSE 0 END) AS commission,
               sum(CASE WHEN o_orderstatus = 'P' THEN v ELSE 0 END) AS opex
        FROM o GROUP BY 1, 2),
  b AS (SELECT nation, min(month) AS lo, max(month) AS hi FROM g GROUP BY 1),
  sp AS (SELECT nation, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM b),
  s AS (SELECT sp.nation, sp.month, coalesce(g.gross, 0) AS gross, coalesce(g.commission, 0) AS commission,
               coalesce(g.opex, 0) AS opex, greatest(0, coalesce(g.gross, 0) - coalesce(g.commission, 0)) AS base
        FROM sp LEFT JOIN g USING (nation, month)),""" + SQL_TAX


@register("bracket_tax", sql=f"""
WITH {SQL_STATEMENT}
SELECT nation, month, CAST(base AS DOUBLE) AS base, floor(rbt12 * 100 + 0.5) / 100 AS rbt12,
       floor(eff * 1000000 + 0.5) / 1000000 AS eff_rate, ir, taxes
FROM x
""")
def bracket_tax_q(spark, d):
    """RP-15 with WN-5: trailing-12 base per nation and month, bracket rate, tax split."""
    s = statement_base(spark, d)
    s = s.withColumn("base", F.greatest(F.lit(0).cast("decimal(18,2)"), F.col("gross") - F.col("commission")))
    t = bracket_tax(s)
    return t.select("nation", "month", F.col("base").cast("double").alias("base"), round2("rbt12").alias("rbt12"),
                    (F.floor(F.col("eff_rate") * 1000000 + 0.5) / 1000000).alias("eff_rate"), "ir", "taxes")


def income_lines(spark, d):
    s = statement_base(spark, d)
    s = s.withColumn("base", F.greatest(F.lit(0).cast("decimal(18,2)"), F.col("gross") - F.col("commission")))
    t = bracket_tax(s)
    gross = F.col("gross").cast("double")
    t = (t.withColumn("net_revenue", round2(gross - F.col("taxes")))
          .withColumn("gross_profit", round2(F.col("net_revenue") - F.col("commission").cast("double")))
          .withColumn("ebitda", round2(F.col("gross_profit") - F.col("opex").cast("double")))
          .withColumn("net_income", round2(F.col("ebitda") - F.col("ir"))))
    return t


LINES = ["gross", "taxes", "ir", "net_revenue", "commission", "gross_profit", "opex", "ebitda", "net_income"]


@register("income_statement", sql=f"""
WITH {SQL_STATEMENT},
y AS (SELECT nation, month, CAST(gross AS DOUBLE) AS gross, taxes, ir, CAST(commission AS DOUBLE) AS commission,
             CAST(opex AS DOUBLE) AS opex,
             floor((CAST(gross AS DOUBLE) - taxes) * 100 + 0.5) / 100 AS net_revenue FROM x),
z AS (SELECT y.*, floor((net_revenue - commission) * 100 + 0.5) / 100 AS gross_profit FROM y),
z2 AS (SELECT z.*, floor((gross_profit - opex) * 100 + 0.5) / 100 AS ebitda FROM z),
z3 AS (SELECT nation, month, net_revenue AS nr, gross, taxes, ir, net_revenue, commission, gross_profit, opex, ebitda,
              floor((ebitda - ir) * 100 + 0.5) / 100 AS net_income FROM z2),
u AS (UNPIVOT z3 ON {", ".join(LINES)} INTO NAME line VALUE value)
SELECT nation, month, line, value,
       floor(coalesce(CASE WHEN nr <> 0 THEN value * 100 / nr END, 0.0) * 100 + 0.5) / 100 AS pct_of_net
FROM u
""")
def income_statement(spark, d):
    """RP-14 (with RP-15): statement lines per nation and month, each also as a percent of net revenue."""
    t = income_lines(spark, d)
    cols = {k: (F.col(k).cast("double") if k in ("gross", "commission", "opex") else F.col(k)) for k in LINES}
    stack = F.explode(F.array(*[F.struct(F.lit(k).alias("line"), c.alias("value")) for k, c in cols.items()]))
    u = t.select("nation", "month", "net_revenue", stack.alias("s")).select("nation", "month", "net_revenue", "s.*")
    pct = F.coalesce(F.when(F.col("net_revenue") != 0, F.col("value") * 100 / F.col("net_revenue")), F.lit(0.0))
    return u.select("nation", "month", "line", "value", round2(pct).alias("pct_of_net"))


# Fixed values of the test mapping: investment per nation, payback cap in years.
TEST_INVESTMENT = 250000.0
PAYBACK_CAP = 99.0


@register("roi", sql=f"""
WITH {SQL_STATEMENT},
y AS (SELECT nation, month, floor((CAST(gross AS DOUBLE) - taxes) * 100 + 0.5) / 100 AS net_revenue,
             CAST(commission AS DOUBLE) AS commission, CAST(opex AS DOUBLE) AS opex, ir FROM x),
z AS (SELECT nation, month,
             floor((floor((floor((net_revenue - commission) * 100 + 0.5) / 100 - opex) * 100 + 0.5) / 100 - ir) * 100 + 0.5) / 100 AS net_income
      FROM y),
a AS (SELECT nation, count(*) AS months, sum(CAST(net_income AS DECIMAL(18,2))) AS total FROM z GROUP BY 1)
SELECT nation, months, floor(CAST(total AS DOUBLE) / months * 12 * 100 + 0.5) / 100 AS annual_income,
       floor(CAST(total AS DOUBLE) / months * 12 * 100 / 250000.0 * 100 + 0.5) / 100 AS roi_pct,
       CASE WHEN CAST(total AS DOUBLE) / months * 12 <= 0 THEN NULL
            ELSE floor(least(99.0, 250000.0 / (CAST(total AS DOUBLE) / months * 12)) * 100 + 0.5) / 100 END AS payback_years,
       CAST(total AS DOUBLE) / months * 12 <= 0 OR 250000.0 / (CAST(total AS DOUBLE) / months * 12) > 99.0 AS never
FROM a
""")
def roi(spark, d):
    """RP-16: annualised return on a fixed investment per nation, payback years with a cap and 'never'."""
    t = income_lines(spark, d)
    a = t.groupBy("nation").agg(F.count(F.lit(1)).alias("months"),
                                F.sum(F.col("net_income").cast("decimal(18,2)")).alias("total"))
    annual = F.col("total").cast("double") / F.col("months") * 12
    return a.select("nation", "months", round2(annual).alias("annual_income"),
                    round2(annual * 100 / TEST_INVESTMENT).alias("roi_pct"),
                    F.when(annual <= 0, F.lit(None).cast("double"))
                     .otherwise(round2(F.least(F.lit(PAYBACK_CAP), TEST_INVESTMENT / annual))).alias("payback_years"),
                    ((annual <= 0) | (TEST_INVESTMENT / annual > PAYBACK_CAP)).alias("never"))


# Fixed values of the test mapping: opening cash and one dated extra opening.
OPENING_CASH, EXTRA_OPENING, EXTRA_FROM = "100000.00", "50000.00", "1998-01-01"


@register("cash_flow_statement", sql="""
WITH ledger AS (
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'fco' WHEN '2-HIGH' THEN 'fci' WHEN '3-MEDIUM' THEN 'fcs'
                WHEN '4-NOT SPECIFIED' THEN 'fco' END AS flow,
           CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE -CAST(o_totalprice AS DECIMAL(18,2)) END AS value
    FROM orders),
sp AS (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM ledger WHERE flow IS NOT NULL),
m AS (SELECT sp.month, coalesce(sum(CASE WHEN flow = 'fco' THEN value END), 0) AS fco,
             coalesce(sum(CASE WHEN flow = 'fci' THEN value END), 0) AS fci,
             coalesce(sum(CASE WHEN flow = 'fcs' THEN value END), 0) AS fcs
      FROM sp LEFT JOIN ledger USING (month) GROUP BY 1),
n AS (SELECT m.*, fco + fci + fcs AS net,
             CASE WHEN month = DATE '1998-01-01' THEN 50000.00 ELSE 0 END AS extra FROM m),
r AS (SELECT n.*, 100000.00 + sum(net + extra) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                  - (SELECT 0) AS closing0 FROM n)
SELECT month, CAST(fco AS DOUBLE) AS fco, CAST(fci AS DOUBLE) AS fci, CAST(fcs AS DOUBLE) AS fcs, CAST(net AS DOUBLE) AS net,
       CAST(closing0 - net AS DOUBLE) AS opening, CAST(closing0 AS DOUBLE) AS closing
FROM r
""")
def cash_flow_statement(spark, d):
    """RP-13 (CL-9, PJ-3, AG-11, AG-12, WN-3): three activities per month with opening and closing cash;
    every month from the first to the last has a row, and the extra opening enters once, in its month."""
    x = ledger(spark, d).where(F.col("flow").isNotNull())
    z = F.lit(0).cast("decimal(18,2)")
    m = x.groupBy("month").agg(*[F.coalesce(F.sum(F.when(F.col("flow") == f, F.col("value"))), z).alias(f)
                                 for f in ("fco", "fci", "fcs")])
    spine = m.agg(F.min("month").alias("lo"), F.max("month").alias("hi")) \
        .select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month"))
    m = spine.join(m, "month", "left").select("month", *[F.coalesce(F.col(f), z).alias(f) for f in ("fco", "fci", "fcs")])
    m = m.withColumn("net", F.col("fco") + F.col("fci") + F.col("fcs")) \
         .withColumn("seed", F.lit(OPENING_CASH).cast("decimal(18,2)")) \
         .withColumn("step", F.col("net") + F.when(F.col("month") == F.lit(EXTRA_FROM).cast("date"),
                                                     F.lit(EXTRA_OPENING).cast("decimal(18,2)")).otherwise(z)) \
         .withColumn("k", F.lit(1))
    r = W.running_balance(m, ["k"], "month", "step", "seed")
    return r.select("month", *[F.col(c).cast("double").alias(c) for c in ("fco", "fci", "fcs", "net")],
                    (F.col("closing") - F.col("net")).cast("double").alias("opening"),
                    F.col("closing").cast("double").alias("closing"))
