"""Domain reports over the test tables: RP-2 (paid, vouchers, pending, payouts and balance of
every teacher), the teacher table of RP-21, and RP-18 with provisions and overrides."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerly.functions.num import money
from ledgerly.plans import dashboard
from ledgerly.plans import projection_domain as PD
from ledgerly.plans.q_estimates import SQL_EVENT_BOOKINGS, event_bookings
from ledgerly.plans.q_finance import SQL_LEDGER, bank_rows, ledger_rows, scaled
from ledgerly.plans.registry import register
from ledgerly.sources.tables import table

# Fixed values of the test mapping: month, and one dated multiplier rule.
TEACHER_MONTH = "2024-01-01"
TEACHER_RULES = dashboard.DashboardRules(rate=0.1, multipliers=[("s", "7", "2024-01-15", 0.88)])


def lessons(spark, d):
    """Events as rows of the commission detail: purchases are paid, every tenth two weeks later."""
    b = event_bookings(spark, d)
    return b.select(
        "booking_id", "booking_date", "start_time", "description", "booking_type",
        F.concat(F.lit("Prof "), (F.col("student") % 5).cast("string")).alias("professor"),
        F.concat(F.lit("S"), F.col("student").cast("string")).alias("participant_name"),
        (F.col("event_type") == "purchase").alias("is_paid"),
        F.date_add("booking_date", F.when(F.col("booking_id") % 10 == 0, 14).otherwise(0)).alias("pay_date"),
        F.when(F.col("booking_id") % 17 != 0, F.col("value")).alias("booking_value"),
        F.when(F.col("booking_id") % 4 == 0, F.col("value") * 2).otherwise(F.lit(0.0)).alias("booking_commission_base"),
        F.col("is_socio").alias("is_socio_benefit"))


def lesson_vouchers(spark, d):
    """Error events as vouchers; some of nobody's, some voided."""
    n = F.col("event_id")
    e = table(spark, d, "events").where(F.col("event_type") == "error")
    return e.select(F.concat(F.lit("Intensivo - 5 aulas - PROF "), (n % 7).cast("string"), F.when(n % 4 == 0, " anulado").otherwise(""))
                    .alias("description"), money("value").alias("total"), F.to_date("ts").alias("pay_date"),
                    F.when(n % 3 != 0, F.concat(F.lit("C"), n.cast("string"))).alias("customer_name"))


SQL_LESSONS = f"""
{SQL_EVENT_BOOKINGS},
les AS (SELECT pc.*, 'Prof ' || (student % 5) AS professor, event_type = 'purchase' AS is_paid,
               booking_date + CASE WHEN booking_id % 10 = 0 THEN 14 ELSE 0 END AS pay_date,
               CASE WHEN booking_id % 17 <> 0 THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END AS val,
               CASE WHEN booking_id % 4 = 0 THEN CAST(value AS DECIMAL(18,2)) * 2 ELSE 0 END AS own_base,
               CASE WHEN contains(CAST(student AS VARCHAR), '7') AND booking_date >= DATE '2024-01-15' THEN 0.88 ELSE 1 END AS mult FROM pc),
paid AS (SELECT professor, booking_date, val, CAST(CASE WHEN own_base <> 0 THEN own_base ELSE val END * mult AS DECIMAL(24,6)) AS base FROM les
         WHERE is_paid AND pay_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'),
vou AS (SELECT event_id % 7 AS n, CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(18,2)) AS v FROM events
        WHERE event_type = 'error' AND event_id % 4 <> 0 AND CAST(value AS DECIMAL(18,2)) > 0)"""


@register("teacher_table", sql=f"""
WITH {SQL_LESSONS},
r AS (SELECT professor, val, base FROM paid UNION ALL SELECT 'PROF ' || n, v, v FROM vou)
SELECT CASE WHEN GROUPING(professor) = 1 THEN 'Total Geral' ELSE professor END AS professor, GROUPING(professor) = 1 AS is_total,
       count(*) AS classes, CAST(round(sum(val), 2) AS DOUBLE) AS billed, CAST(round(CAST(sum(base) AS DECIMAL(30,6)) * 0.1, 2) AS DOUBLE) AS commission
FROM r GROUP BY ROLLUP (professor)
""")
def teacher_table(spark, d):
    """RP-21 / AG-9: classes, billed and commission per teacher, with the total row."""
    return dashboard.teacher_table(lessons(spark, d), lesson_vouchers(spark, d), TEACHER_MONTH, TEACHER_RULES)


def payouts(spark, d):
    """Customers as payouts to six teachers over two months."""
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    return c.select(F.concat(F.lit("Prof "), (k % 6).cast("string")).alias("professor"), money("c_acctbal").alias("amount"),
                    F.when(k % 4 == 0, "2023-12-01").otherwise("2024-01-01").cast("date").alias("reference_period"))


@register("teacher_balances", sql=f"""
WITH {SQL_LESSONS},
pt AS (SELECT professor, day(booking_date) <= 20 AS p1, CAST(val AS DECIMAL(24,6)) AS v, base FROM paid WHERE val > 0
       UNION ALL SELECT 'Prof ' || n, day(day) <= 20, v, v FROM vou WHERE n < 5),
paid_t AS (SELECT professor, sum(v) AS pv, sum(base) AS pb, sum(CASE WHEN p1 THEN v ELSE 0 END) AS v1, sum(CASE WHEN p1 THEN base ELSE 0 END) AS b1,
                  sum(CASE WHEN NOT p1 THEN v ELSE 0 END) AS v2, sum(CASE WHEN NOT p1 THEN base ELSE 0 END) AS b2 FROM pt GROUP BY 1),
b AS (SELECT * FROM les WHERE NOT is_paid),
s AS (SELECT student, month, dow, start_time, hour, category, unit_price, is_monthly, count(*) AS n FROM b WHERE NOT is_free GROUP BY ALL),
ns AS (SELECT student, month, count(*) AS n_slots FROM s GROUP BY 1, 2),
cal AS (SELECT month, dayofweek(day) AS dow, count(*) AS occ
        FROM (SELECT month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day
              FROM (SELECT DISTINCT month FROM s)) GROUP BY 1, 2),
f AS (SELECT s.*, CASE WHEN is_monthly THEN n / cal.occ * unit_price ELSE n * unit_price END
             * CASE WHEN dow BETWEEN 1 AND 5 AND hour BETWEEN 10 AND 15 THEN 0.88::DOUBLE
                    ELSE 1.0::DOUBLE - CASE WHEN n_slots = 2 THEN 0.05 WHEN n_slots >= 3 THEN 0.07 ELSE 0.0 END::DOUBLE END AS slot_value
      FROM s JOIN ns USING (student, month) JOIN cal USING (month, dow)),
e0 AS (SELECT b.professor, b.student, b.booking_date, b.is_free, b.own_base, b.mult, b.is_socio,
              CASE WHEN b.is_free THEN 0.0 ELSE f.slot_value / f.n END AS est
       FROM b LEFT JOIN f ON f.student = b.student AND f.month = b.month AND f.dow = b.dow AND f.start_time = b.start_time AND f.category = b.category),
e AS (SELECT *, CAST(CASE WHEN own_base <> 0 THEN CAST(own_base AS DOUBLE) WHEN is_socio THEN est * 2 ELSE est END * CAST(mult AS DOUBLE) AS DECIMAL(24,6)) AS cb FROM e0),
st AS (SELECT professor, student, sum(cb) AS cb FROM e GROUP BY 1, 2),
bl AS (SELECT student, sum(CAST(slot_value AS DECIMAL(24,6))) AS billed FROM f GROUP BY 1),
pend_t AS (SELECT professor, sum(coalesce(billed, 0)) AS qv, sum(CASE WHEN cb = 0 THEN coalesce(billed, 0) ELSE cb END) AS qb
           FROM st LEFT JOIN bl USING (student) GROUP BY 1),
pend_p AS (SELECT professor, sum(CASE WHEN day(booking_date) <= 20 THEN CAST(est AS DECIMAL(24,6)) ELSE 0 END) AS q1v,
                  sum(CASE WHEN day(booking_date) <= 20 THEN cb ELSE 0 END) AS q1b,
                  sum(CASE WHEN day(booking_date) > 20 THEN CAST(est AS DECIMAL(24,6)) ELSE 0 END) AS q2v,
                  sum(CASE WHEN day(booking_date) > 20 THEN cb ELSE 0 END) AS q2b FROM e WHERE NOT is_free GROUP BY 1),
out_t AS (SELECT 'Prof ' || (c_custkey % 6) AS professor, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS po FROM customer WHERE c_custkey % 4 <> 0 GROUP BY 1),
j AS (SELECT professor, {", ".join(f"round(coalesce({c}, 0), 2) AS {n}" for c, n in (
          ("pv", "paid_billed"), ("pb", "paid_base"), ("v1", "p1_billed"), ("b1", "p1_base"), ("v2", "p2_billed"), ("b2", "p2_base"),
          ("qv", "pending_billed"), ("qb", "pending_base"), ("q1v", "pending_p1_billed"), ("q1b", "pending_p1_base"),
          ("q2v", "pending_p2_billed"), ("q2b", "pending_p2_base"), ("po", "paid_out")))}
      FROM paid_t FULL JOIN pend_t USING (professor) FULL JOIN out_t USING (professor) LEFT JOIN pend_p USING (professor))
SELECT professor, COLUMNS(* EXCLUDE (professor))::DOUBLE, CAST(round(CAST(paid_base AS DECIMAL(18,2)) * 0.1, 2) AS DOUBLE) AS commission,
       CAST(round(CAST(pending_base AS DECIMAL(18,2)) * 0.1, 2) AS DOUBLE) AS pending_commission,
       CAST(round(CAST(paid_base AS DECIMAL(18,2)) * 0.1, 2) - paid_out AS DOUBLE) AS balance
FROM j
""")
def teacher_balances(spark, d):
    """RP-2 whole: paid, vouchers, pending by period, commission, payouts of the month and balance per teacher."""
    _, summary = dashboard.commission_dashboard(lessons(spark, d), lesson_vouchers(spark, d), payouts(spark, d), TEACHER_MONTH, TEACHER_RULES)
    return summary


@register("student_balances", sql=f"""
WITH {SQL_LESSONS},
pt AS (SELECT professor, 'S' || student AS student, is_socio, CAST(val AS DECIMAL(24,6)) AS v,
              CAST(CASE WHEN own_base <> 0 THEN own_base ELSE val END * mult AS DECIMAL(24,6)) AS base FROM les
       WHERE is_paid AND pay_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' AND val > 0
       UNION ALL SELECT 'Prof ' || (event_id % 7), CASE WHEN event_id % 3 <> 0 THEN 'C' || event_id ELSE 'Voucher' END || ' (voucher)', false,
                        CAST(value AS DECIMAL(18,2)), CAST(value AS DECIMAL(18,2)) FROM events
       WHERE event_type = 'error' AND event_id % 4 <> 0 AND event_id % 7 < 5 AND CAST(value AS DECIMAL(18,2)) > 0 AND date_trunc('month', ts) = DATE '2024-01-01'),
b AS (SELECT * FROM les WHERE NOT is_paid),
s AS (SELECT student, month, dow, start_time, hour, category, unit_price, is_monthly, count(*) AS n FROM b WHERE NOT is_free GROUP BY ALL),
ns AS (SELECT student, month, count(*) AS n_slots FROM s GROUP BY 1, 2),
cal AS (SELECT month, dayofweek(day) AS dow, count(*) AS occ
        FROM (SELECT month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day
              FROM (SELECT DISTINCT month FROM s)) GROUP BY 1, 2),
f AS (SELECT s.*, CASE WHEN is_monthly THEN n / cal.occ * unit_price ELSE n * unit_price END
             * CASE WHEN dow BETWEEN 1 AND 5 AND hour BETWEEN 10 AND 15 THEN 0.88::DOUBLE
                    ELSE 1.0::DOUBLE - CASE WHEN n_slots = 2 THEN 0.05 WHEN n_slots >= 3 THEN 0.07 ELSE 0.0 END::DOUBLE END AS slot_value
      FROM s JOIN ns USING (student, month) JOIN cal USING (month, dow)),
e0 AS (SELECT b.professor, b.student, b.booking_date, b.is_free, b.own_base, b.mult, b.is_socio,
              CASE WHEN b.is_free THEN 0.0 ELSE f.slot_value / f.n END AS est
       FROM b LEFT JOIN f ON f.student = b.student AND f.month = b.month AND f.dow = b.dow AND f.start_time = b.start_time AND f.category = b.category),
e AS (SELECT *, CAST(CASE WHEN own_base <> 0 THEN CAST(own_base AS DOUBLE) WHEN is_socio THEN est * 2 ELSE est END * CAST(mult AS DOUBLE) AS DECIMAL(24,6)) AS cb FROM e0),
st AS (SELECT professor, student, sum(cb) AS cb FROM e GROUP BY 1, 2),
bl AS (SELECT student, sum(CAST(slot_value AS DECIMAL(24,6))) AS billed FROM f GROUP BY 1),
rows AS (SELECT professor, student, 'paid' AS status, count(*) AS classes, sum(v) AS billed, sum(base) AS base, bool_or(is_socio) AS is_socio FROM pt GROUP BY 1, 2
         UNION ALL SELECT professor, 'S' || student, 'pending', n, coalesce(billed, 0), CASE WHEN cb = 0 THEN coalesce(billed, 0) ELSE cb END, member
         FROM st JOIN (SELECT student, count(*) AS n, bool_or(is_socio) AS member FROM b GROUP BY 1) USING (student) LEFT JOIN bl USING (student)),
t AS (SELECT *, CASE WHEN is_socio THEN 'Sócios' ELSE 'Regulares' END AS section FROM rows)
SELECT CASE WHEN GROUPING(student) = 0 THEN 'student' WHEN GROUPING(section) = 0 THEN 'section' WHEN GROUPING(professor) = 0 THEN 'teacher' ELSE 'total' END AS level,
       professor, section, student, status, CAST(sum(classes) AS BIGINT) AS classes, CAST(round(sum(CAST(billed AS DECIMAL(24,6))), 2) AS DOUBLE) AS billed,
       CAST(round(sum(CAST(base AS DECIMAL(24,6))), 2) AS DOUBLE) AS base
FROM t GROUP BY GROUPING SETS ((professor, section, student, status), (professor, section), (professor), ())
""")
def student_balances(spark, d):
    """RP-2 at student level (AG-8, AG-10): paid and pending rows of every student with section, teacher and grand totals."""
    students, _ = dashboard.commission_dashboard(lessons(spark, d), lesson_vouchers(spark, d), payouts(spark, d), TEACHER_MONTH, TEACHER_RULES)
    return dashboard.student_table(students)


# Fixed values of the test mapping: day of the report, money that does not come from the tables.
DAYS_AS_OF, DAYS_MONTHS = "1998-08-10", ["1998-07-01", "1998-08-01", "1998-09-01"]
DAYS_OPENING = dict(month_opening=1000.0, default_balance=17.0, investments="111.79", since="1998-07-01")
DAYS_ARGS = dict(d30_remaining=2200.0, d0_expected=1500.0, commission_p1=50.0, commission_p2=70.0,
                 pace=1.158, card_fee=0.025, base_costs=9000.0, safety=0.05)


def ledger_overrides(spark, d):
    """Edits and tombstones of the orders of medium priority, and a manual row for each of low priority."""
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    edits = o.where(F.col("o_orderpriority") == "3-MEDIUM").select(
        k.alias("id"), F.when(k % 3 == 0, F.date_add(day, 3)).alias("custom_due_date"),
        F.when(k % 2 == 0, scaled("o_totalprice", "0.001")).alias("custom_amount"), F.lit(None).cast("string").alias("custom_name"),
        F.when(k % 5 == 0, "Investimentos").alias("custom_flow"), (k % 11 == 0).alias("is_deleted"), F.lit(False).alias("is_manual"),
        F.lit(None).cast("string").alias("month_key"))
    manual = o.where(F.col("o_orderpriority") == "5-LOW").select(
        -k, day, scaled("o_totalprice", "0.0001"), F.lit("manual"), F.when(k % 2 == 0, "Investimentos").otherwise("Operação"),
        k % 3 == 0, F.lit(True), F.date_format(day, "yyyy-MM"))
    return edits.unionAll(manual)


@register("daily_cash", sql=f"""
WITH {SQL_LEDGER},
mon(m, a) AS (VALUES (DATE '1998-07-01', NULL), (DATE '1998-08-01', DATE '1998-08-10'), (DATE '1998-09-01', DATE '1998-09-01')),
base AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS due, o_orderstatus AS st, o_orderpriority = '2-HIGH' AS inv, o_orderpriority = '3-MEDIUM' AS ed, o_orderpriority = '5-LOW' AS man,
                CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders),
rows AS (SELECT CASE WHEN ed AND k % 3 = 0 THEN due + 3 ELSE due END AS due, st,
                CAST(CASE WHEN ed AND k % 2 = 0 THEN v * 0.001 ELSE v * 0.0005 END AS DECIMAL(18,2)) AS amount, inv OR ed AND k % 5 = 0 AS inv, NULL::DATE AS sole
         FROM base WHERE NOT (ed AND k % 11 = 0)
         UNION ALL SELECT due, 'O', CAST(v * 0.0001 AS DECIMAL(18,2)), k % 2 = 0, CAST(date_trunc('month', due) AS DATE)
         FROM base WHERE man AND k % 3 <> 0),
per AS (SELECT mon.m, mon.a, rows.* FROM mon JOIN rows ON (sole IS NULL OR sole = mon.m) WHERE mon.a IS NOT NULL),
tot AS (SELECT m, coalesce(sum(CASE WHEN st = 'O' AND due < a AND NOT inv THEN amount END), 0)::DOUBLE AS over_ops,
               coalesce(sum(CASE WHEN st = 'O' AND due < a AND inv THEN amount END), 0)::DOUBLE AS over_inv,
               coalesce(sum(CASE WHEN st = 'P' AND due = a THEN amount END), 0)::DOUBLE AS received,
               coalesce(sum(CASE WHEN st = 'O' AND NOT inv AND due <= last_day(m) THEN amount END), 0)::DOUBLE AS scheduled FROM per GROUP BY 1),
byday AS (SELECT m, due, coalesce(sum(CASE WHEN NOT inv THEN amount END), 0)::DOUBLE AS ops, coalesce(sum(CASE WHEN inv THEN amount END), 0)::DOUBLE AS inv
          FROM per WHERE st = 'O' GROUP BY 1, 2),
imp AS (SELECT CAST(l_shipdate AS DATE) AS day, sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.0001 AS DECIMAL(18,2)))::DOUBLE AS v
        FROM lineitem WHERE l_returnflag = 'A' AND l_shipdate < DATE '1998-09-01' GROUP BY 1),
hasi AS (SELECT DISTINCT CAST(date_trunc('month', day) AS DATE) AS m FROM imp),
cal AS (SELECT m, a, CAST(unnest(generate_series(m, last_day(m), INTERVAL 1 DAY)) AS DATE) AS day FROM mon WHERE a IS NOT NULL),
w AS (SELECT *, CASE WHEN dayofweek(day) = 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS w FROM cal),
ws AS (SELECT m, sum(w) AS total_w, sum(CASE WHEN day >= a THEN w ELSE 0 END)::DOUBLE AS rem_w FROM w GROUP BY 1),
g AS (SELECT w.m, w.a, w.day, tot.*,
             CASE WHEN w.m IN (SELECT m FROM hasi) THEN coalesce(imp.v, 0.0) ELSE floor(2200.0::DOUBLE * (w / rem_w) * 100 + 0.5) / 100 END AS b1,
             floor(1500.0::DOUBLE * w / total_w * 1.158::DOUBLE * 100 + 0.5) / 100 AS b2, coalesce(byday.ops, 0.0) AS ops, coalesce(byday.inv, 0.0) AS inv,
             greatest(0.0, 9000.0::DOUBLE - scheduled) AS gap
      FROM w JOIN ws USING (m) JOIN tot USING (m) LEFT JOIN imp ON imp.day = w.day LEFT JOIN byday ON byday.m = w.m AND byday.due = w.day WHERE w.day >= w.a),
h AS (SELECT *, floor((floor((gap + (scheduled + gap) * 0.05::DOUBLE) * 100 + 0.5) / 100) / day(last_day(day)) * 100 + 0.5) / 100 AS prov,
             floor((b1 + b2) * 100 + 0.5) / 100 AS raw,
             CASE WHEN day(day) = 20 THEN 50.0 ELSE 0.0 END + CASE WHEN day = last_day(day) THEN 70.0 ELSE 0.0 END AS comm FROM g),
i AS (SELECT m AS month, day, CASE WHEN day = a THEN floor(greatest(0.0, raw - floor(received * 100 + 0.5) / 100) * 100 + 0.5) / 100 ELSE raw END AS inflow,
             floor((floor((prov + floor(b1 * 0.025::DOUBLE * 100 + 0.5) / 100) * 100 + 0.5) / 100 + ops + CASE WHEN day = a THEN over_ops ELSE 0.0 END + comm) * 100 + 0.5) / 100 AS outflow_ops,
             floor((inv + CASE WHEN day = a THEN over_inv ELSE 0.0 END) * 100 + 0.5) / 100 AS outflow_inv FROM h),
n AS (SELECT *, floor((inflow - (outflow_ops + outflow_inv)) * 100 + 0.5) / 100 AS net FROM i)
SELECT month, day, inflow, outflow_ops, outflow_inv, net,
       CASE WHEN month = DATE '1998-08-01' THEN (SELECT CAST(arg_max(CAST(o_totalprice AS DECIMAL(18,2)), (o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)))) AS DOUBLE) FROM orders)
         + (SELECT CAST(111.79 + sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE -1 END * CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.0001 AS DECIMAL(18,2))) AS DOUBLE)
            FROM lineitem WHERE l_shipdate >= DATE '1998-07-01' AND (l_returnflag = 'A' OR l_linenumber IN (1, 2, 6, 7)))
       ELSE 1000.0::DOUBLE END + CAST(sum(CAST(net AS DECIMAL(18,2))) OVER (PARTITION BY month ORDER BY day) AS DOUBLE) AS closing FROM n
""")
def daily_cash(spark, d):
    """RP-18 (JN-13, AG-26, AG-27, AG-33, CA-6): a past, the current and a later month day by day, with provisions and
    overrides, from the opening that the bank's and the ledger's rows give."""
    li = table(spark, d, "lineitem").where((F.col("l_returnflag") == "A") & (F.to_date("l_shipdate") < F.lit("1998-09-01").cast("date")))
    schedule = li.select(F.to_date("l_shipdate").alias("release_date"), scaled("l_extendedprice", "0.0001").alias("value"))
    out = None
    for month in DAYS_MONTHS:
        opening = PD.days_opening(ledger_rows(spark, d), bank_rows(spark, d), month, DAYS_AS_OF, **DAYS_OPENING)
        rows = PD.project_days(ledger_rows(spark, d), schedule, month, DAYS_AS_OF, opening, overrides=ledger_overrides(spark, d), **DAYS_ARGS)
        rows = rows.select(F.lit(month).cast("date").alias("month"), "day", "inflow", "outflow_ops", "outflow_inv", "net", "closing")
        out = rows if out is None else out.unionByName(rows)
    return out
