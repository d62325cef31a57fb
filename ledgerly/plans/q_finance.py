"""Domain reports over the test tables: RP-5 (online split), RP-6 (tickets per
class), RP-12 (goal cards, CL-7), RP-13 (with the bank side), RP-14 (all
lines), AG-31 (rental projection) and CL-8 (names of local payments)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerly.functions.num import money, round2, safe_div
from ledgerly.operators import agg as G
from ledgerly.operators import rules as R
from ledgerly.operators import windows as W
from ledgerly.operators.common import rule_table, when_chain
from ledgerly.plans import finance
from ledgerly.plans.q_agg import OPEN_HOURS
from ledgerly.plans.q_reports import SQL_TAX
from ledgerly.plans.registry import register
from ledgerly.sources.tables import table


def order_month():
    return F.trunc(F.to_date("o_orderdate"), "MM")


def scaled(col: str, factor: str):
    """Money of the test tables scaled down to a small business, in cents."""
    return (money(col) * F.lit(factor).cast("decimal(8,6)")).cast("decimal(18,2)")


def sold(spark, d):
    """Line items as sale lines of the order's customer: description, category, subcategory, product, month, client, value."""
    li, q = table(spark, d, "lineitem"), F.col("l_quantity")
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("client"))
    lines = li.select(
        "l_orderkey", F.trunc(F.to_date("l_shipdate"), "MM").alias("month"),
        F.when(F.col("l_returnflag") == "A", "AULA AVULSA").when(F.col("l_returnflag") == "N", "Água")
         .otherwise(F.when(q > 45, "Vouchers Desconto 1º Reserva").otherwise("Raquete")).alias("description"),
        F.when(q < 10, "Aulas").when(q < 30, "Outros").when(q < 40, "Locação").otherwise("Bar").alias("category"),
        F.when(F.col("l_linestatus") == "O", "Avulsa - Particular").alias("subcategory"),
        F.when(F.col("l_linenumber") == 5, "Reserva Mensal Quadra 1").alias("product"), scaled("l_extendedprice", "0.01").alias("value"))
    return lines.join(o, lines.l_orderkey == o.o_orderkey, "left").drop("l_orderkey", "o_orderkey")


SQL_SOLD = """
sold AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, o_custkey AS client,
                lower(CASE l_returnflag WHEN 'A' THEN 'AULA AVULSA' WHEN 'N' THEN 'Água'
                      ELSE CASE WHEN l_quantity > 45 THEN 'Vouchers Desconto 1º Reserva' ELSE 'Raquete' END END) AS descr,
                CASE WHEN l_quantity < 10 THEN 'aulas' WHEN l_quantity < 30 THEN 'outros' WHEN l_quantity < 40 THEN 'locação' ELSE 'bar' END AS cat,
                CASE WHEN l_linestatus = 'O' THEN 'avulsa - particular' ELSE '' END AS sub,
                CASE WHEN l_linenumber = 5 THEN 'reserva mensal quadra 1' ELSE '' END AS prod,
                CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,2)) AS v
         FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey),
flags AS (SELECT *, contains(sub, 'reserva mensal') OR contains(prod, 'reserva mensal') AS monthly,
                 cat = 'locação' OR contains(descr, 'desconto 1º reserva') AS single,
                 cat = 'aulas' OR contains(descr, 'aula') AS lesson FROM sold)"""


@register("class_tickets", sql=f"""
WITH {SQL_SOLD},
c AS (SELECT *, CASE WHEN monthly THEN 'Locação - Reserva Mensal' WHEN single THEN 'Locação - Quadra Avulsa'
                     WHEN lesson AND (contains(descr, 'avulsa') OR contains(sub, 'avulsa')) THEN 'Aulas - Avulsas'
                     WHEN lesson THEN 'Aulas - Regular' ELSE 'Lanchonete' END AS class FROM flags),
g AS (SELECT month, class, count(DISTINCT client) AS clients, CAST(sum(v) AS DOUBLE) AS total FROM c GROUP BY 1, 2
      UNION ALL SELECT month, 'TOTAL GERAL', count(DISTINCT client), CAST(sum(v) AS DOUBLE) FROM c GROUP BY 1)
SELECT month, class, clients, total, CASE WHEN clients > 0 THEN floor(total / clients * 100 + 0.5) / 100 ELSE 0 END AS ticket
FROM g WHERE total > 0.01 OR class = 'TOTAL GERAL'
""")
def class_tickets(spark, d):
    """RP-6 (CL-6, AG-7): revenue, distinct clients and ticket per class and month, with the month's total row."""
    x = sold(spark, d).withColumn("class", R.revenue_class(R.REVENUE_OPS, R.REVENUE_OPS_DEFAULT))
    g = x.groupingSets([["month", "class"], ["month"]], "month", "class").agg(
        F.countDistinct("client").alias("clients"), F.sum("value").cast("double").alias("total"), F.grouping("class").alias("whole"))
    g = g.where((F.col("whole") == 1) | (F.col("total") > 0.01))
    return g.select("month", F.when(F.col("whole") == 1, "TOTAL GERAL").otherwise(F.col("class")).alias("class"), "clients",
                    "total", round2(safe_div("total", "clients")).alias("ticket"))


# Fixed values of the test mapping: date-effective monthly goals (goal, from, to, target).
GOALS = [("students", "1995-01-01", None, "120"), ("rentals", "1995-01-01", "1998-07-31", "40000"),
         ("rentals", "1998-08-01", None, "70000"), ("snack", "1995-01-01", None, "60000"),
         ("ticket", "1995-01-01", "1998-07-31", "550"), ("ticket", "1998-08-01", None, "600"), ("occupancy", "1995-01-01", None, "10")]


@register("goal_cards", sql=f"""
WITH {SQL_SOLD},
c AS (SELECT *, CASE WHEN lesson THEN 'l' WHEN monthly OR single THEN 'r' ELSE 's' END AS cls FROM flags),
a AS (SELECT month, count(DISTINCT CASE WHEN cls = 'l' THEN client END) AS students,
             CAST(coalesce(sum(CASE WHEN cls = 'l' THEN v END), 0) AS DOUBLE) AS lessons,
             CAST(coalesce(sum(CASE WHEN cls = 'r' THEN v END), 0) AS DOUBLE) AS rentals,
             CAST(coalesce(sum(CASE WHEN cls = 's' THEN v END), 0) AS DOUBLE) AS snack FROM c GROUP BY 1),
h AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS hours, count(DISTINCT o_orderpriority) AS units
      FROM orders GROUP BY 1),
days AS (SELECT month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day FROM a),
open AS (SELECT month, sum(CASE WHEN dayofweek(day) IN (0, 6) THEN 11.0 ELSE 15.0 END)::DOUBLE AS open_hours FROM days GROUP BY 1),
v AS (SELECT a.month, CAST(students AS DOUBLE) AS students, rentals, snack,
             CASE WHEN students > 0 THEN lessons / students ELSE 0.0 END AS ticket,
             coalesce(hours, 0) / (greatest(coalesce(units, 0), 4) * open_hours) * 100 AS occupancy
      FROM a JOIN open USING (month) LEFT JOIN h USING (month)),
u AS (UNPIVOT v ON students, rentals, snack, ticket, occupancy INTO NAME goal VALUE value),
t(goal, s, e, target) AS (VALUES ('students', DATE '1995-01-01', NULL, 120.0::DOUBLE), ('rentals', DATE '1995-01-01', DATE '1998-07-31', 40000.0),
    ('rentals', DATE '1998-08-01', NULL, 70000.0), ('snack', DATE '1995-01-01', NULL, 60000.0),
    ('ticket', DATE '1995-01-01', DATE '1998-07-31', 550.0), ('ticket', DATE '1998-08-01', NULL, 600.0), ('occupancy', DATE '1995-01-01', NULL, 10.0))
SELECT month, goal, floor(value * 100 + 0.5) / 100 AS value, target, floor(value / target * 100 * 100 + 0.5) / 100 AS pct,
       value >= target AS achieved, floor((value - target) * 100 + 0.5) / 100 AS over
FROM u JOIN t USING (goal) WHERE t.s <= month AND (t.e IS NULL OR t.e >= month)
""")
def goal_cards(spark, d):
    """RP-12 (CL-7, JN-16, CA-2): students, rentals, snack bar, lesson ticket and occupancy against their targets."""
    x = sold(spark, d).withColumn("class", R.revenue_class(R.REVENUE_GOALS, R.REVENUE_GOALS_DEFAULT))
    lesson = F.col("class") == "Aulas"

    def total(cls):
        return F.coalesce(F.sum(F.when(F.col("class") == cls, F.col("value"))), F.lit(0)).cast("double")
    a = x.groupBy("month").agg(F.countDistinct(F.when(lesson, F.col("client"))).alias("students"), total("Aulas").alias("lessons"),
                               total("Locação").alias("rentals"), total("Lanchonete").alias("snack"))
    h = table(spark, d, "orders").groupBy(order_month().alias("month")).agg(
        F.count(F.lit(1)).alias("hours"), F.countDistinct("o_orderpriority").alias("units"))
    v = a.join(W.open_hours(W.calendar(a.select("month")), OPEN_HOURS), "month").join(h, "month", "left")
    cap = G.capacity(F.col("open_hours"), F.coalesce("units", F.lit(0)), 4)
    goals = {"students": F.col("students").cast("double"), "rentals": F.col("rentals"), "snack": F.col("snack"),
             "ticket": safe_div("lessons", "students"), "occupancy": safe_div(F.coalesce("hours", F.lit(0)), cap) * 100}
    u = v.select("month", F.explode(F.array(*[F.struct(F.lit(k).alias("goal"), c.alias("value")) for k, c in goals.items()])).alias("x")) \
         .select("month", "x.*")
    t = rule_table(spark, GOALS, "goal string, s string, e string, target string").select(
        "goal", F.col("s").cast("date").alias("s"), F.col("e").cast("date").alias("e"), F.col("target").cast("double").alias("target"))
    j = u.join(t, "goal").where((F.col("s") <= F.col("month")) & (F.col("e").isNull() | (F.col("e") >= F.col("month"))))
    value, target = F.col("value"), F.col("target")
    return j.select("month", "goal", round2(value).alias("value"), "target", round2(value / target * 100).alias("pct"),
                    (value >= target).alias("achieved"), round2(value - target).alias("over"))


# Fixed values of the test mapping: order priority -> name of the payment method.
PAY_NAMES = [("1-URGENT", "Pagamento online"), ("2-HIGH", "Cartão Crédito"), ("3-MEDIUM", "CARTAO DEBITO"), ("4-NOT SPECIFIED", "tarjeta")]


def paid_by(col: str = "o_orderpriority"):
    other = F.when(F.col("o_orderkey") % 3 == 0, "Efectivo").when(F.col("o_orderkey") % 3 == 1, "pix").otherwise("vale")
    return when_chain([(F.col(col) == k, v) for k, v in PAY_NAMES], other)


SQL_PAID = """
paid AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(o_totalprice AS DECIMAL(18,2)) AS v,
                CASE o_orderpriority WHEN '1-URGENT' THEN 'Pagamento online' WHEN '2-HIGH' THEN 'Cartão Crédito' WHEN '3-MEDIUM' THEN 'CARTAO DEBITO'
                     WHEN '4-NOT SPECIFIED' THEN 'tarjeta'
                     ELSE CASE o_orderkey % 3 WHEN 0 THEN 'Efectivo' WHEN 1 THEN 'pix' ELSE 'vale' END END AS pay_method FROM orders)"""


@register("local_payments", sql=f"""
WITH {SQL_PAID}
SELECT month, CASE pay_method WHEN 'Pagamento online' THEN 'online' WHEN 'Cartão Crédito' THEN 'credit' WHEN 'CARTAO DEBITO' THEN 'debit'
                   WHEN 'tarjeta' THEN 'card' WHEN 'Efectivo' THEN 'cash' WHEN 'pix' THEN 'transfer' END AS class,
       count(*) AS n, CAST(sum(v) AS DOUBLE) AS value
FROM paid GROUP BY 1, 2
""")
def local_payments(spark, d):
    """CL-8: payments per month by the class of their method's name; names outside the rules have a null class."""
    p = table(spark, d, "orders").select(order_month().alias("month"), paid_by().alias("pay_method"), money("o_totalprice").alias("v"))
    return p.groupBy("month", R.local_pay_class().alias("class")).agg(F.count(F.lit(1)).alias("n"), F.sum("v").cast("double").alias("value"))


@register("online_split", sql=f"""
WITH {SQL_PAID},
p AS (SELECT month, pay_method, CAST(sum(v) AS DOUBLE) AS v FROM paid GROUP BY 1, 2),
o AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
             CASE WHEN l_returnflag = 'A' OR l_linestatus = 'P' THEN 'Mercado Pago - Pix' WHEN l_returnflag = 'N' THEN 'Mercado Pago - Cartão Crédito'
                  WHEN l_linenumber = 1 THEN 'Mercado Pago - Saldo MP' ELSE 'Mercado Pago - Outro' END AS label,
             sum(CASE WHEN l_linenumber = 2 THEN -1 ELSE 1 END * CAST(l_extendedprice AS DECIMAL(18,2))) AS a
      FROM lineitem WHERE l_shipdate >= DATE '1996-01-01' GROUP BY 1, 2),
s AS (SELECT month, sum(a) AS s FROM o GROUP BY 1)
SELECT month, pay_method, v AS value FROM p WHERE pay_method <> 'Pagamento online'
UNION ALL
SELECT p.month, o.label, floor(CAST(o.a AS DOUBLE) * (p.v / CAST(s.s AS DOUBLE)) * 100 + 0.5) / 100
FROM p JOIN s USING (month) JOIN o USING (month) WHERE pay_method = 'Pagamento online' AND p.v > 0 AND s.s > 0 AND o.a > 0
UNION ALL
SELECT p.month, 'Mercado Pago - Outro', floor(p.v * 100 + 0.5) / 100 FROM p LEFT JOIN s USING (month)
WHERE pay_method = 'Pagamento online' AND p.v > 0 AND coalesce(s.s, 0) <= 0
""")
def online_split(spark, d):
    """RP-5 (CL-8, AG-19): payments by method, the online ones split as the provider's own payments are."""
    p = table(spark, d, "orders").select(order_month().alias("month"), paid_by().alias("pay_method"), money("o_totalprice").alias("v")) \
        .groupBy("month", "pay_method").agg(F.sum("v").alias("value"))
    flag, n = F.col("l_returnflag"), F.col("l_linenumber")
    online = table(spark, d, "lineitem").where(F.to_date("l_shipdate") >= F.lit("1996-01-01").cast("date")).select(
        F.trunc(F.to_date("l_shipdate"), "MM").alias("month"),
        F.when(flag == "A", "bank_transfer").when(flag == "N", "credit_card").when(n == 1, "account_money").otherwise("ticket").alias("type"),
        F.when(F.col("l_linestatus") == "P", "pix").alias("method"),
        F.when(n == 2, -money("l_extendedprice")).otherwise(money("l_extendedprice")).alias("amount"))
    online = online.withColumn("class", R.pay_class("type", "method"))
    return G.split_online(p, online, ["month"], "pay_method", "value", "class", "amount", R.ONLINE_METHOD, R.ONLINE_LABELS,
                          "Mercado Pago - Outro")


@register("rental_projection", sql="""
WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                  sum((o_orderpriority = '1-URGENT')::INT)::DOUBLE AS fixed, sum((o_orderpriority = '2-HIGH')::INT)::DOUBLE AS single,
                  sum((o_orderpriority = '3-MEDIUM')::INT)::DOUBLE AS maint, sum((o_orderpriority = '4-NOT SPECIFIED')::INT)::DOUBLE AS rented,
                  CAST(sum(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS rental_value,
                  CAST(sum(CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') AND o_orderstatus <> 'P'
                                THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS variable
           FROM orders GROUP BY 1),
days AS (SELECT month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day FROM m),
cap AS (SELECT month, 4 * sum(CASE WHEN dayofweek(day) IN (0, 6) THEN 11.0 ELSE 15.0 END)::DOUBLE AS cap FROM days GROUP BY 1),
b AS (SELECT m.*, cap, greatest(0.0, cap - maint - fixed - single) AS free, coalesce(rental_value / nullif(rented, 0), 0.0) AS ticket
      FROM m JOIN cap USING (month)),
p AS (SELECT b.*, step, greatest(0.0, cap - maint - fixed * pow(1.02, step) - single) AS future_free,
             least(0.35, CASE WHEN free > 0 THEN rented / free ELSE 0.1641 END * pow(1.05, step)) AS rate,
             greatest(0.0, variable - rented * ticket) * pow(1.02, step) AS other
      FROM b, (SELECT unnest([1, 2, 3]) AS step))
SELECT month, step, floor(free * 100 + 0.5) / 100 AS free, floor(rate * 1e6 + 0.5) / 1e6 AS rate,
       floor(future_free * rate * 100 + 0.5) / 100 AS rental_hours,
       floor(future_free * rate * ticket * 100 + 0.5) / 100 AS rental_revenue, floor(other * 100 + 0.5) / 100 AS other_revenue
FROM p
""")
def rental_projection(spark, d):
    """AG-31 (AG-30, CA-2): free hours of each month and its rentals projected one to three months ahead."""
    o, kind = table(spark, d, "orders").withColumn("month", order_month()), F.col("o_orderpriority")
    hours = {"fixed": "1-URGENT", "single": "2-HIGH", "maint": "3-MEDIUM", "rented": "4-NOT SPECIFIED"}
    variable = kind.isin("4-NOT SPECIFIED", "5-LOW") & (F.col("o_orderstatus") != "P")
    m = o.groupBy("month").agg(
        *[F.sum(F.when(kind == k, 1).otherwise(0)).cast("double").alias(c) for c, k in hours.items()],
        F.sum(F.when(kind == hours["rented"], money("o_totalprice"))).alias("rental_value"),
        F.sum(F.when(variable, money("o_totalprice")).otherwise(0)).cast("double").alias("variable"))
    m = m.join(W.open_hours(W.calendar(m.select("month")), OPEN_HOURS), "month")
    cap = G.capacity(F.col("open_hours"), F.lit(4), 4)
    m = m.withColumn("free", G.free_capacity(cap, F.col("maint"), F.col("fixed"), F.col("single"))) \
         .withColumn("ticket", safe_div("rental_value", "rented")) \
         .withColumn("step", F.explode(F.array(*[F.lit(k) for k in (1, 2, 3)])))
    later = G.free_capacity(cap, F.col("maint"), F.col("fixed") * F.pow(F.lit(1.02), "step"), F.col("single"))
    p = G.rental_projection(F.col("free"), F.col("rented"), later, F.col("ticket"), F.col("variable"), F.col("step"), other_growth=0.02)
    x = m.select("month", "step", "free", p.alias("p"))
    return x.select("month", "step", round2("free").alias("free"), (F.floor(F.col("p.rate") * 1e6 + 0.5) / 1e6).alias("rate"),
                    *[round2(f"p.{c}").alias(c) for c in ("rental_hours", "rental_revenue", "other_revenue")])


# Fixed values of the test mapping: categories by order number, and the rules of both statements.
LEDGER_CATEGORIES = ["Energia Elétrica", "Limpeza", "Comissão professores", "Estoque Bar/Lanchonete", None, "Simples - Imposto"]
STATEMENT_RULES = finance.FinanceRules(
    text_exclusions=[("zeta payroll", "1998-01-01")], teacher_rates=[("1-URGENT", 0.2)], multipliers=[("client", "7", "1997-01-01", 0.88)],
    accruals=[("staff", "1996-03-10", None, "31.00")], depreciation=76.67, redemptions=("1996-01-01", "1999-07-01"),
    opening=500.0, extra_openings=[("1997-03-01", 111.79)], cost_since="1996-01-01")


def ledger_rows(spark, d):
    """Orders as ledger rows."""
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    return o.select(
        k.alias("id"), F.to_date("o_orderdate").alias("due_date"), (F.col("o_orderstatus") != "O").alias("paid"),
        F.when(F.col("o_orderstatus") == "P", "revenue").otherwise("expense").alias("transaction_type"),
        scaled("o_totalprice", "0.0005").alias("amount"),
        when_chain([(k % 6 == n, F.lit(c).cast("string")) for n, c in enumerate(LEDGER_CATEGORIES)]).alias("category_name"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "Investimentos").otherwise("Operação").alias("cost_center_descricao"),
        F.when(F.col("o_custkey") % 10 == 0, "Zeta Payroll").otherwise("x").alias("name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("synced_at"), (money("o_totalprice") * 100).cast("bigint").alias("bank_account_balance_cents"))


SQL_LEDGER = """
led AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderstatus <> 'O' AS paid, o_orderstatus = 'P' AS revenue,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.0005 AS DECIMAL(18,2)) AS amount,
               CASE o_orderkey % 6 WHEN 0 THEN 'Energia Elétrica' WHEN 1 THEN 'Limpeza' WHEN 2 THEN 'Comissão professores'
                    WHEN 3 THEN 'Estoque Bar/Lanchonete' WHEN 5 THEN 'Simples - Imposto' END AS category,
               CASE WHEN o_orderpriority = '2-HIGH' THEN 'fci' ELSE 'fco' END AS flow, o_custkey % 10 = 0 AS zeta FROM orders)"""


@register("statement_lines", sql=f"""
WITH {SQL_LEDGER},
sp AS (SELECT CAST(unnest(generate_series(DATE '1994-11-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS DATE) AS month),
li AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(l_shipdate AS DATE) AS day, l_partkey, l_linenumber,
              CASE l_linenumber WHEN 3 THEN 1 WHEN 4 THEN 1 ELSE CAST(l_quantity AS DECIMAL(18,2)) END AS qty,
              CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.001 AS DECIMAL(18,2)) AS v,
              CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.00001 AS DECIMAL(18,2)) AS fee FROM lineitem),
costs AS (SELECT p_partkey, DATE '1996-01-01' AS s, DATE '1997-12-31' AS e, CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 0.0005 AS DECIMAL(18,2)) AS c FROM part
          UNION ALL SELECT p_partkey, DATE '1998-01-01', DATE '9999-12-31', CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 0.0006 AS DECIMAL(18,2)) FROM part),
i AS (SELECT month, sum(v) AS gross, sum(c * qty) AS cogs, sum(CASE WHEN l_linenumber <> 7 THEN fee END) AS online_fees
      FROM li LEFT JOIN costs ON p_partkey = l_partkey AND day BETWEEN s AND e GROUP BY 1),
o AS (SELECT o_orderkey AS k, o_orderstatus AS st, o_orderpriority AS pr, CAST(o_orderdate AS DATE) AS day, o_custkey,
             CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.0001 AS DECIMAL(18,2)) AS v,
             CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,2)) AS pay FROM orders),
earned AS (SELECT date_trunc('month', CASE WHEN k % 3 = 0 THEN day ELSE day + 10 END) AS month, pr,
                  CASE WHEN k % 4 >= 2 AND v <> 0 THEN v WHEN k % 5 = 0 THEN v * 2 ELSE v END
                  * CASE WHEN contains(CAST(o_custkey AS VARCHAR), '7') AND day >= DATE '1997-01-01' THEN 0.88 ELSE 1 END AS base
           FROM o WHERE st = 'F'
           UNION ALL SELECT date_trunc('month', day), pr, v FROM o WHERE st = 'P' AND pr <> '5-LOW' AND v > 0),
com AS (SELECT CAST(month AS DATE) AS month, sum(base * CASE WHEN pr = '1-URGENT' THEN 0.2 ELSE 0.1 END) AS commission FROM earned GROUP BY 1),
exp AS (SELECT month, sum(CASE WHEN category = 'Energia Elétrica' THEN amount END) AS energy,
               sum(CASE WHEN category IS NULL OR category = 'Limpeza' THEN amount END) AS opex
        FROM led WHERE flow = 'fco' AND NOT revenue AND NOT (zeta AND month >= DATE '1998-01-01') GROUP BY 1),
fee AS (SELECT CAST(date_trunc('month', day) AS DATE) AS month,
               sum(pay * CASE pr WHEN '1-URGENT' THEN 0.0193 WHEN '2-HIGH' THEN 0.0193 WHEN '3-MEDIUM' THEN 0.0099 ELSE 0 END) AS fees FROM o GROUP BY 1),
j AS (SELECT 0 AS nation, sp.month,
             {", ".join(f"floor(CAST(coalesce({c}, 0) AS DOUBLE) * 100 + 0.5) / 100 AS {n}" for n, c in (
                 ("gross", "gross"), ("cogs", "cogs"), ("commission", "commission"), ("energy", "energy"),
                 ("fees", "coalesce(fees, 0) + coalesce(online_fees, 0)"),
                 ("opex", "coalesce(opex, 0) + CASE WHEN sp.month < DATE '1996-03-01' THEN 0.0 WHEN sp.month = DATE '1996-03-01' THEN 22.0 ELSE 31.0 END")))}
      FROM sp LEFT JOIN i USING (month) LEFT JOIN com USING (month) LEFT JOIN exp USING (month) LEFT JOIN fee USING (month)),
s AS (SELECT *, CAST(greatest(0, gross - commission) AS DECIMAL(18,2)) AS base FROM j),
{SQL_TAX.strip()},
y AS (SELECT *, floor((gross - taxes) * 100 + 0.5) / 100 AS net FROM x),
z AS (SELECT *, floor((net - cogs - commission - energy - fees) * 100 + 0.5) / 100 AS profit FROM y),
z2 AS (SELECT *, floor((profit - opex) * 100 + 0.5) / 100 AS ebitda FROM z),
z3 AS (SELECT *, floor((ebitda - 76.67::DOUBLE) * 100 + 0.5) / 100 AS ebit FROM z2),
w AS (SELECT month, gross <> 0 AS active, net AS nr, gross AS gross_revenue, taxes, net AS net_revenue, cogs, commission, energy, fees,
             profit AS gross_profit, opex AS operating_expenses, ebitda, 76.67::DOUBLE AS depreciation, ebit, ir AS income_tax,
             floor((ebit - ir) * 100 + 0.5) / 100 AS net_income FROM z3),
u AS (UNPIVOT w ON {", ".join(finance.LINES)} INTO NAME line VALUE value)
SELECT month, line, CASE WHEN active THEN value ELSE 0.0 END AS value,
       CASE WHEN active AND nr <> 0 THEN floor(value * 100 / nr * 100 + 0.5) / 100 ELSE 0.0 END AS pct_of_net
FROM u
""")
def statement_lines(spark, d):
    """RP-14 with all fourteen lines, from the domain statement over the test tables."""
    li, o, k, n = table(spark, d, "lineitem"), table(spark, d, "orders"), F.col("o_orderkey"), F.col("l_linenumber")
    part = F.col("l_partkey").cast("string")
    items = li.select(F.to_date("l_shipdate").alias("pay_date"), scaled("l_extendedprice", "0.001").alias("valor_faturamento"),
                      F.lpad(part, 9, "0").alias("sku"), F.concat(F.lit("Part "), part).alias("item_description"),
                      F.when(n == 4, F.lit(0)).when(n != 3, money("l_quantity")).alias("quantity"))
    p = table(spark, d, "part")
    costs = p.select(F.col("p_partkey").cast("string").alias("sku"), F.concat(F.lit("part  "), F.col("p_partkey").cast("string")).alias("description"),
                     F.explode(F.array(*[F.struct(F.lit(s).cast("date").alias("data_inicio"), F.lit(e).cast("date").alias("data_fim"),
                                                  scaled("p_retailprice", f).alias("custo_unitario"))
                                         for s, e, f in ((None, "1997-12-31", "0.0005"), ("1998-01-01", None, "0.0006"))])).alias("x")) \
             .select("sku", "description", "x.*")
    value, day = scaled("o_totalprice", "0.0001"), F.to_date("o_orderdate")
    detail = o.select(
        day.alias("booking_date"), F.when(k % 3 != 0, F.date_add(day, 10)).alias("pay_date"), (F.col("o_orderstatus") == "F").alias("is_paid"),
        F.col("o_orderpriority").alias("professor"), F.concat(F.lit("Client "), F.col("o_custkey").cast("string")).alias("participant_name"),
        value.cast("double").alias("booking_value"), F.when(k % 4 == 1, 0.0).when(k % 4 >= 2, value.cast("double")).alias("booking_commission_base"),
        (k % 5 == 0).alias("is_socio_benefit"))
    vouchers = o.where(F.col("o_orderstatus") == "P").select(
        F.concat(F.lit("INTENSIVO - 5 aulas - "), "o_orderpriority", F.when(F.col("o_orderpriority") == "5-LOW", " anulado").otherwise("")).alias("description"),
        value.alias("total"), day.alias("pay_date"))
    method = when_chain([(F.col("o_orderpriority") == a, b) for a, b in
                         (("1-URGENT", "tarjeta"), ("2-HIGH", "Cartão Crédito"), ("3-MEDIUM", "Cartão Débito"), ("4-NOT SPECIFIED", "Pagamento online"))], "pix")
    payments = o.select(day.alias("payment_date"), method.alias("pay_method"), scaled("o_totalprice", "0.01").alias("amount"))
    online = li.select(F.when(n != 7, F.to_date("l_shipdate")).alias("date_approved"), scaled("l_extendedprice", "0.00001").alias("fee_amount"))
    return finance.income_statement(items, detail, ledger_rows(spark, d), costs, payments, "1994-11-01", "2001-12-01", STATEMENT_RULES,
                                    vouchers, online)


def bank_rows(spark, d):
    """Line items as moves of the bank account."""
    n = F.col("l_linenumber")
    return table(spark, d, "lineitem").select(
        F.to_date("l_shipdate").alias("data_movimento"), F.when(F.col("l_returnflag") == "A", "INVESTIMENTO").otherwise("PIX").alias("tipo_transacao_inter"),
        F.when(n == 1, "Resgate automático").when(n == 2, "Aplicação").when(n == 3, "Padaria").alias("descricao"),
        F.when(n >= 6, "Fundo CDB").alias("titulo"),
        F.when(F.col("l_linestatus") == "O", -scaled("l_extendedprice", "0.0001")).otherwise(scaled("l_extendedprice", "0.0001")).alias("valor_com_sinal"))


SQL_FLOWS = f"""{SQL_LEDGER},
rows AS (SELECT month, flow, coalesce(category, 'Sem Categoria') AS category, CASE WHEN revenue THEN amount ELSE -amount END AS v
         FROM led WHERE paid AND month BETWEEN DATE '1995-06-01' AND DATE '2002-02-01'
         UNION ALL
         SELECT CAST(date_trunc('month', l_shipdate) AS DATE), 'fci', 'Resgate de Aplicação Financeira (CDB)',
                CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.0001 AS DECIMAL(18,2)) AS v
         FROM lineitem WHERE l_linenumber IN (1, 6, 7) AND l_linestatus <> 'O' AND l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1999-07-01'
                             AND CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.0001 AS DECIMAL(18,2)) > 0)"""


@register("cash_flow_categories", sql=f"""
WITH {SQL_FLOWS}
SELECT month, flow, category, CAST(sum(v) AS DOUBLE) AS net FROM rows GROUP BY 1, 2, 3
""")
def cash_flow_categories(spark, d):
    """RP-13 (FL-7, AG-11): the domain cash flow by activity and category, redemptions of investments included."""
    long, _ = finance.cash_flow_statement(ledger_rows(spark, d), "1995-06-01", "2002-02-01", STATEMENT_RULES, bank_rows(spark, d))
    return long.select("month", "flow", "category", F.col("net").cast("double").alias("net"))


@register("cash_flow_months", sql=f"""
WITH {SQL_FLOWS},
sp AS (SELECT CAST(unnest(generate_series(DATE '1995-06-01', DATE '2002-02-01', INTERVAL 1 MONTH)) AS DATE) AS month),
m AS (SELECT sp.month, coalesce(sum(CASE WHEN flow = 'fco' THEN v END), 0) AS fco, coalesce(sum(CASE WHEN flow = 'fci' THEN v END), 0) AS fci,
             0 AS fcs FROM sp LEFT JOIN rows USING (month) GROUP BY 1),
r AS (SELECT *, fco + fci AS net, 500.00 + sum(fco + fci + CASE WHEN month = DATE '1997-03-01' THEN 111.79 ELSE 0 END) OVER (ORDER BY month) AS closing FROM m)
SELECT month, CAST(fco AS DOUBLE) AS fco, CAST(fci AS DOUBLE) AS fci, CAST(fcs AS DOUBLE) AS fcs, CAST(net AS DOUBLE) AS net,
       CAST(closing - net AS DOUBLE) AS opening, CAST(closing AS DOUBLE) AS closing
FROM r
""")
def cash_flow_months(spark, d):
    """RP-13 (WN-3): the domain cash flow per month, redemptions included, with opening and closing cash."""
    _, months = finance.cash_flow_statement(ledger_rows(spark, d), "1995-06-01", "2002-02-01", STATEMENT_RULES, bank_rows(spark, d))
    return months.select("month", *[F.col(c).cast("double").alias(c) for c in ("fco", "fci", "fcs", "net", "opening", "closing")])
