"""RP-19 whole: the club's months projected from prices, payments, occupancy, sales, ledger and schedule of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerly.functions import dates as D
from ledgerly.operators import projection as P
from ledgerly.operators.common import when_chain
from ledgerly.plans import projection_domain as PD
from ledgerly.plans.q_finance import SQL_LEDGER, ledger_rows, scaled
from ledgerly.plans.registry import register
from ledgerly.sources.tables import table

# Fixed values of the test mapping.
CLUB_BASE, CLUB_OPENING, CLUB_COURTS = "1998-07-01", 1000.0, 40
METHODS = [("1-URGENT", "tarjeta"), ("2-HIGH", "Cartão Crédito"), ("3-MEDIUM", "Cartão Débito"), ("4-NOT SPECIFIED", "Dinheiro"), ("5-LOW", "pix")]
_R = "floor({} * 100 + 0.5) / 100"


@register("club_projection", sql=f"""
WITH RECURSIVE {SQL_LEDGER},
slots AS (SELECT o_custkey AS c, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.001 AS DECIMAL(18,2))::DOUBLE AS price FROM orders
          WHERE date_trunc('month', o_orderdate) = DATE '{CLUB_BASE}'),
debit AS (SELECT coalesce(sum(CAST({_R.format('price * (1.0::DOUBLE + 0.02::DOUBLE)')} AS DECIMAL(28,2)))::DOUBLE, 0.0) AS base FROM slots
          WHERE c IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '3-MEDIUM')),
pay AS (SELECT sum(CASE WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW') THEN a ELSE 0 END)::DOUBLE / sum(a)::DOUBLE AS r0
        FROM (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,2)) AS a FROM orders WHERE date_trunc('month', o_orderdate) = DATE '{CLUB_BASE}')),
occ AS (SELECT coalesce(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 0)::DOUBLE AS fixed_hours,
               coalesce(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 0)::DOUBLE AS static_hours,
               sum(CASE WHEN l_linestatus = 'O' AND l_quantity < 25 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.001 AS DECIMAL(18,2)) ELSE 0 END)::DOUBLE AS other_base
        FROM lineitem WHERE date_trunc('month', l_shipdate) = DATE '{CLUB_BASE}'),
hist AS (SELECT coalesce(sum(amount), 0)::DOUBLE AS rs, greatest(count(DISTINCT month), 1)::DOUBLE AS rc FROM led
         WHERE paid AND NOT revenue AND flow = 'fco' AND month <= DATE '{CLUB_BASE}'),
base AS (SELECT sum(price::DECIMAL(18,2))::DOUBLE AS tuition FROM slots),
s AS (SELECT tuition, r0, CASE WHEN r0 > 0 THEN 1.0::DOUBLE - r0 ELSE 0.0 END AS r30, occ.*, hist.*, debit.base AS debit_base,
             {_R.format('tuition * r30')} AS pt0, {_R.format('other_base * r30')} AS pv0 FROM base, pay, occ, hist, debit),
mi AS (SELECT i, CAST(DATE '{CLUB_BASE}' + INTERVAL (i) MONTH AS DATE) AS month FROM range(1, 4) t(i)),
cal AS (SELECT month, sum(CASE WHEN dayofweek(day) IN (0, 6) THEN 11.0 ELSE 15.0 END)::DOUBLE AS open_hours
        FROM (SELECT month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day FROM mi) GROUP BY 1),
due AS (SELECT CASE WHEN month = DATE '{CLUB_BASE}' THEN DATE '1998-08-01' ELSE month END AS month,
               coalesce(sum(CASE WHEN flow = 'fco' THEN amount END), 0)::DOUBLE AS ops, coalesce(sum(CASE WHEN flow = 'fci' THEN amount END), 0)::DOUBLE AS inv
        FROM led WHERE NOT paid AND NOT revenue GROUP BY 1),
imp AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.0001 AS DECIMAL(18,2)))::DOUBLE AS imported
        FROM lineitem WHERE l_returnflag = 'A' AND l_shipdate < DATE '1998-09-01' GROUP BY 1),
mon AS (SELECT mi.*, open_hours, coalesce(ops, 0.0) AS sched_ops, coalesce(inv, 0.0) AS sched_inv, imported
        FROM mi JOIN cal USING (month) LEFT JOIN due USING (month) LEFT JOIN imp USING (month)),
rec AS (
  SELECT 0 AS i, pt0 AS pt, pv0 AS pv, rs, rc, {CLUB_OPENING}::DOUBLE AS bal, 1.0::DOUBLE AS f, 1.0::DOUBLE AS fo, NULL::DATE AS month, NULL::DOUBLE AS initial,
         NULL::DOUBLE AS inflow, NULL::DOUBLE AS provision, NULL::DOUBLE AS out_ops, NULL::DOUBLE AS net, NULL::DOUBLE AS final FROM s
  UNION ALL
  SELECT i, td30, vd30, xrs, xrc, fin, xf, xfo, xmonth, xinitial, xin, prov, xout, xnet, fin FROM (
    SELECT m.i, r.f * (1.0::DOUBLE + 0.02::DOUBLE) AS xf, r.fo * 1.05::DOUBLE AS xfo, {_R.format('s.tuition * xf')} AS tu, {_R.format('tu * s.r0')} AS td0, {_R.format('tu * s.r30')} AS td30,
           greatest(0.0, m.open_hours * {CLUB_COURTS}.0::DOUBLE - s.static_hours - s.fixed_hours * xf) AS free, least(0.35::DOUBLE, 0.20::DOUBLE * xfo) AS occ,
           {_R.format('(free * occ * 100.0::DOUBLE + s.other_base * xf)')} AS var, {_R.format('var * s.r0')} AS vd0, {_R.format('var * s.r30')} AS vd30,
           CASE WHEN r.pt + r.pv > 0 THEN r.pt / (r.pt + r.pv) ELSE 0.84 END AS sh,
           CASE WHEN m.imported IS NULL THEN r.pt ELSE {_R.format('m.imported * sh')} END AS tr,
           CASE WHEN m.imported IS NULL THEN r.pv ELSE {_R.format('m.imported * (1.0::DOUBLE - sh)')} END AS vr,
           {_R.format('(td0 + tr + vd0 + vr)')} AS xin, {_R.format('m.sched_ops')} AS xops, {_R.format('m.sched_inv')} AS xinv,
           {_R.format('greatest(xops, r.rs / r.rc) * 0.10::DOUBLE')} AS prov, {_R.format('tu * 0.10::DOUBLE')} AS comm,
           {_R.format('((tr * 0.025::DOUBLE + s.debit_base * s.r0 * 0.0099::DOUBLE) + vr * 0.025::DOUBLE)')} AS fees,
           {_R.format('(xops + prov + comm + fees)')} AS xout, {_R.format('(' + _R.format('(xin - xout)') + ' - xinv)')} AS xnet, {_R.format('(r.bal + xnet)')} AS fin,
           r.bal AS xinitial, m.month AS xmonth, r.rs + (xops + prov) AS xrs, r.rc + 1 AS xrc
    FROM rec r JOIN mon m ON m.i = r.i + 1 CROSS JOIN s))
SELECT month, initial, inflow, provision, out_ops, net, final FROM rec WHERE i > 0
""")
def club_projection(spark, d):
    """RP-19 (JN-15, AG-20, CL-5, CL-10): three months of the club, the debit-card fee by customer included.

    The base month's orders are slots of their customer, all orders are
    payments; lines are occupancy, sales and the imported schedule.
    """
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    customer = F.col("o_custkey").cast("string").alias("customer_code")
    prices = o.where(D.in_month("o_orderdate", F.lit(CLUB_BASE).cast("date"))).select(customer, scaled("o_totalprice", "0.001").alias("monthly_price"))
    payments = o.select(customer, F.col("o_orderdate").alias("payment_date"), scaled("o_totalprice", "0.01").alias("amount"),
                        when_chain([(F.col("o_orderpriority") == a, b) for a, b in METHODS]).alias("pay_method"))
    occupancy = li.select(F.trunc("l_shipdate", "MM").alias("month"), F.col("l_quantity").alias("hours"), when_chain(
        [(F.col("l_returnflag") == a, b) for a, b in (("A", "Aulas - Regular"), ("N", "Locação - Quadra Avulsa"), ("R", "Manutenção"))]).alias("kind"))
    items = li.select(F.col("l_shipdate").alias("pay_date"), scaled("l_extendedprice", "0.001").alias("valor_faturamento"),
                      F.when(F.col("l_linestatus") == "F", "Aulas").otherwise("Bar").alias("category"),
                      F.when(F.col("l_quantity") < 25, "Lanche").otherwise("Locação de quadra").alias("description"))
    schedule = li.where((F.col("l_returnflag") == "A") & (F.col("l_shipdate") < F.lit("1998-09-01").cast("date"))) \
        .select(F.to_date("l_shipdate").alias("release_date"), scaled("l_extendedprice", "0.0001").alias("value"))
    return PD.project_months(prices, payments, occupancy, items, ledger_rows(spark, d), schedule, CLUB_BASE, CLUB_OPENING,
                             p=P.ProjectionParams(courts=CLUB_COURTS))
