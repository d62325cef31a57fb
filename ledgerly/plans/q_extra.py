"""Queries for the remaining classifiers and filters: FL-2, FL-6, FL-11, CL-8,
CL-10, CL-18, CL-20, JN-14, CA-8, WN-9."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerly.functions import dates as D
from ledgerly.functions.num import money
from ledgerly.operators import filters as FL
from ledgerly.operators import joins as J
from ledgerly.operators import rules as R
from ledgerly.operators import windows as W
from ledgerly.operators.common import rule_table
from ledgerly.plans.registry import register
from ledgerly.sources import io
from ledgerly.sources.tables import table


def sale_lines(spark, d):
    """Line items as sale lines: description, category and subcategory derived
    from flags and quantity; tax-free lines are refunds; 10% discount lines are cancelled."""
    li = table(spark, d, "lineitem")
    desc = F.when(F.col("l_returnflag") == "A", "AULA AVULSA avulsa") \
            .when(F.col("l_returnflag") == "N", "AULA AVULSA - GRUPO FIXO") \
            .otherwise("Mensalidade")
    return li.select(
        "l_orderkey", "l_linenumber", desc.alias("description"),
        F.when(F.col("l_quantity") < 10, "Aulas").when(F.col("l_quantity") < 40, "Outros").otherwise("Bar").alias("category"),
        F.when(F.col("l_linestatus") == "O", "Avulsa - Particular").alias("subcategory"),
        (F.col("l_discount") > 0.095).alias("item_canceled"), F.lit(False).alias("sale_canceled"),
        F.when(F.col("l_tax") < 0.005, "refund").alias("sale_type"), money("l_extendedprice").alias("value"))


@register("valid_sale_lines", sql="""
WITH x AS (SELECT CASE l_returnflag WHEN 'A' THEN 'AULA AVULSA avulsa' WHEN 'N' THEN 'AULA AVULSA - GRUPO FIXO'
                       ELSE 'Mensalidade' END AS description,
                  CASE WHEN l_quantity < 10 THEN 'Aulas' WHEN l_quantity < 40 THEN 'Outros' ELSE 'Bar' END AS category,
                  CASE WHEN l_linestatus = 'O' THEN 'Avulsa - Particular' END AS subcategory,
                  l_discount > 0.095 AS item_canceled, false AS sale_canceled,
                  CASE WHEN l_tax < 0.005 THEN 'refund' END AS sale_type, CAST(l_extendedprice AS DECIMAL(18,2)) AS value
           FROM lineitem),
v AS (SELECT * FROM x WHERE item_canceled = false AND sale_canceled = false AND coalesce(sale_type, '') <> 'refund'
                        AND value > 0 AND category IN ('Aulas', 'Outros')
                        AND (subcategory IS NULL OR subcategory <> 'Avulsa - Particular'))
SELECT coalesce(description ILIKE '%AULA AVULSA%' OR subcategory IN ('Avulsa - Grupo Fixo', 'Avulsa - Particular'), false) AS is_single,
       coalesce(description ILIKE '%AULA AVULSA - GRUPO FIXO%' OR subcategory = 'Avulsa - Grupo Fixo', false) AS is_fixed_group,
       count(*) AS n, CAST(sum(value) AS DOUBLE) AS value
FROM v GROUP BY 1, 2
""")
def valid_sale_lines(spark, d):
    """FL-2 with CL-18: valid sale lines (null sale type passes the refund test) by single/fixed-group flags."""
    x = FL.valid_items(sale_lines(spark, d), "item_canceled", "sale_canceled", "sale_type", "value", "category",
                       ["Aulas", "Outros"], "subcategory", "Avulsa - Particular")
    single, fixed = R.line_flags("description", "subcategory")
    return x.groupBy(single.alias("is_single"), fixed.alias("is_fixed_group")) \
            .agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("value"))


# Fixed values of the test mapping: teacher names to match in vouchers, and one
# person-specific commission rate (others take the default).
TEACHERS = [("Professor Nation_1",), ("NATION_2",), ("Professôr  Nation_30",)]
TEACHER_RATES = [("Professor Nation_1", 0.12)]
DEFAULT_RATE = 0.10


@register("voucher_match", sql="""
WITH v AS (SELECT o.o_orderkey, CAST(o.o_totalprice AS DECIMAL(18,2)) AS total,
                  'Voucher INTENSIVÃO - ' || CAST(o.o_orderkey % 9 + 1 AS VARCHAR) || ' aulas - Professor ' || n.n_name AS description,
                  CASE WHEN o.o_orderpriority = '5-LOW' THEN 'Anulado pelo caixa' END AS notes
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey),
ok AS (SELECT *, nullif(trim(regexp_replace(regexp_extract(description, '(?i)INTENSIV\\S*\\s*-\\s*\\d+\\s*aulas?\\s*-\\s*(.+)$', 1), '\\s+', ' ', 'g')), '') AS voucher_name
       FROM v),
vv AS (SELECT * FROM ok WHERE voucher_name IS NOT NULL AND total > 0 AND NOT coalesce(regexp_matches(notes, '(?i)anula'), false)),
t(name) AS (VALUES ('Professor Nation_1'), ('NATION_2'), ('Professôr  Nation_30')),
m AS (SELECT vv.*, t.name FROM vv JOIN t
        ON length(upper(trim(strip_accents(voucher_name)))) > 0 AND length(upper(trim(strip_accents(t.name)))) > 0
       AND (contains(upper(trim(strip_accents(voucher_name))), upper(trim(strip_accents(t.name))))
            OR contains(upper(trim(strip_accents(t.name))), upper(trim(strip_accents(voucher_name)))))),
r(p, rate) AS (VALUES ('Professor Nation_1', 0.12))
SELECT m.name AS teacher, count(*) AS n_vouchers, CAST(sum(total) AS DOUBLE) AS total,
       CAST(round(sum(total * CAST(coalesce(r.rate, 0.10) AS DECIMAL(4,2))), 2) AS DOUBLE) AS commission
FROM m LEFT JOIN r ON r.p = m.name GROUP BY 1
""")
def voucher_match(spark, d):
    """FL-6 with JN-14 and CL-20: valid vouchers, their teacher matched by folded
    containment either way, commission at the teacher's rate or the default."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation")
    x = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey).select(
        "o_orderkey", money("o_totalprice").alias("total"),
        F.concat(F.lit("Voucher INTENSIVÃO - "), (F.col("o_orderkey") % 9 + 1).cast("string"), F.lit(" aulas - Professor "),
                 F.col("n_name")).alias("description"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("Anulado pelo caixa")).alias("notes"))
    vv = FL.valid_vouchers(x, "description", "total", "notes")
    t = rule_table(spark, TEACHERS, "name string")
    m = J.fuzzy_contains(vv, "voucher_name", t, "name")
    m = R.rate_for(m, rule_table(spark, TEACHER_RATES, "p string, r double"), "name", DEFAULT_RATE)
    return m.groupBy(F.col("name").alias("teacher")).agg(
        F.count(F.lit(1)).alias("n_vouchers"), F.sum("total").cast("double").alias("total"),
        F.round(F.sum(F.col("total") * F.col("rate").cast("decimal(4,2)")), 2).cast("double").alias("commission"))


@register("event_classes", sql="""
WITH e AS (SELECT CASE event_type WHEN 'purchase' THEN 'credit_card' WHEN 'signup' THEN 'bank_transfer'
                                  WHEN 'click' THEN 'account_money' ELSE 'ticket' END AS ptype,
                  CASE WHEN value > 400 THEN 'pix' ELSE 'card' END AS method,
                  CASE event_type WHEN 'error' THEN 'Manutenção quadra' WHEN 'view' THEN 'Aulas - Regular'
                       WHEN 'click' THEN 'Locação - Quadra Avulsa' WHEN 'purchase' THEN 'Aulas - Avulsa Particular'
                       ELSE 'Outros' END AS kind,
                  ts, CAST(value AS DECIMAL(18,2)) AS v FROM events)
SELECT CASE WHEN ptype = 'bank_transfer' OR method = 'pix' THEN 'pix' WHEN ptype = 'credit_card' THEN 'credit'
            WHEN ptype = 'account_money' THEN 'balance' ELSE 'other' END AS pay_class,
       CASE WHEN contains(lower(kind), 'manutenção') OR contains(lower(kind), 'bloqueio') OR contains(lower(kind), 'manutencao') THEN 'maintenance'
            WHEN starts_with(lower(kind), 'aulas - regular') OR contains(lower(kind), 'reserva mensal') OR starts_with(lower(kind), 'aulas - adulto')
                 OR starts_with(lower(kind), 'aulas - kids') OR lower(kind) = 'outros' THEN 'fixed'
            WHEN contains(lower(kind), 'locação - quadra avulsa') THEN 'rental'
            WHEN contains(lower(kind), 'aulas - avulsa particular') THEN 'single' END AS hours_class,
       ['Jan','Fev','Mar','Abr','Mai','Jun','Jul','Ago','Set','Out','Nov','Dez'][month(ts)] || '/' || CAST(year(ts) AS VARCHAR) AS month_label,
       count(*) AS n, CAST(sum(v) AS DOUBLE) AS value
FROM e GROUP BY 1, 2, 3
""")
def event_classes(spark, d):
    """CL-8 payment class, CL-10 hours class and CA-8 month label over events."""
    e = table(spark, d, "events")
    et = F.col("event_type")
    x = e.select(F.when(et == "purchase", "credit_card").when(et == "signup", "bank_transfer")
                  .when(et == "click", "account_money").otherwise("ticket").alias("ptype"),
                 F.when(F.col("value") > 400, "pix").otherwise("card").alias("method"),
                 F.when(et == "error", "Manutenção quadra").when(et == "view", "Aulas - Regular")
                  .when(et == "click", "Locação - Quadra Avulsa").when(et == "purchase", "Aulas - Avulsa Particular")
                  .otherwise("Outros").alias("kind"), "ts", money("value").alias("v"))
    return x.groupBy(R.pay_class("ptype", "method").alias("pay_class"), R.hours_class().alias("hours_class"),
                     D.month_label("ts").alias("month_label")) \
            .agg(F.count(F.lit(1)).alias("n"), F.sum("v").cast("double").alias("value"))


@register("first_event", sql="""
SELECT user_id, event_id, ts, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1
""")
def first_event(spark, d):
    """WN-9: each user's first event under a total order (time, then id)."""
    e = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    return W.first_row(e, ["user_id"], [F.col("ts"), F.col("event_id")])


@register("month_progress", sql="""
WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
c AS (SELECT month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day FROM m)
SELECT month, sum(CASE WHEN day < month + 14 THEN (CASE WHEN dayofweek(day) = 0 THEN 0.5 ELSE 1.0 END) ELSE 0.0 END)::DOUBLE AS elapsed,
       sum(CASE WHEN day >= month + 14 THEN (CASE WHEN dayofweek(day) = 0 THEN 0.5 ELSE 1.0 END) ELSE 0.0 END)::DOUBLE AS remaining
FROM c GROUP BY 1
""")
def month_progress(spark, d):
    """CA-5 (with CA-6): elapsed and remaining weekday weight of each month at its 15th day."""
    from ledgerly.plans.q_projection import DOW_WEIGHTS
    months = table(spark, d, "orders").select(F.trunc(F.to_date("o_orderdate"), "MM").alias("month")).distinct()
    cal = W.calendar(months)
    w = F.element_at(F.array(*[F.lit(x) for x in DOW_WEIGHTS]), F.dayofweek("day"))
    return W.month_progress(cal, F.date_add(F.col("month"), 14), w)


@register("future_plan", sql="""
WITH t AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS ref,
                  CASE WHEN o_orderpriority = '3-MEDIUM'
                       THEN 'Mensalidade ' || ['janeiro','fevereiro','março','abril','maio','junho','julho',
                            'agosto','setembro','outubro','novembro','dezembro'][month(o_orderdate)] || ' ' || strftime(o_orderdate, '%y')
                       ELSE 'Plano' END AS txt,
                  CAST(o_totalprice AS DECIMAL(18,2)) AS v
           FROM orders)
SELECT regexp_extract(lower(txt), '(janeiro|fevereiro|março|marco|abril|maio|junho|julho|agosto|setembro|outubro|novembro|dezembro)', 1) AS month_name,
       count(*) AS n, CAST(sum(v) AS DOUBLE) AS value
FROM t WHERE ref IS NULL AND regexp_matches(txt, '(?i)(janeiro|fevereiro|março|marco|abril|maio|junho|julho|agosto|setembro|outubro|novembro|dezembro)')
GROUP BY 1
""")
def future_plan(spark, d):
    """FL-11: plan lines with no booking reference that name a month (per month name)."""
    from ledgerly.operators.alloc import MONTH_WORDS
    from ledgerly.plans.q_alloc import span_text
    o = table(spark, d, "orders")
    t = o.select(F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("ref"),
                 F.when(F.col("o_orderpriority") == "3-MEDIUM", span_text()).otherwise(F.lit("Plano")).alias("txt"),
                 money("o_totalprice").alias("v"))
    words = [w for w, _ in MONTH_WORDS]
    x = FL.future_plan(t, "ref", "txt", words)
    name = F.regexp_extract(F.lower("txt"), "(" + "|".join(words) + ")", 1)
    return x.groupBy(name.alias("month_name")).agg(F.count(F.lit(1)).alias("n"), F.sum("v").cast("double").alias("value"))


# Fixed value of the test mapping: the header line of the schedule files.
SCHEDULE_HEADER = 'Bandeira;"Data prevista";Valor líquido'


def schedule_text(spark, d):
    """Orders as numbered lines of schedule files, one file per priority and year.

    Dates are written by status: day first, ISO, or as a spreadsheet's serial
    number. Amounts are in local form, quoted or plain by priority; every
    priority 5 line of status O has no amount.
    """
    o = table(spark, d, "orders")
    day, v = F.to_date("o_orderdate"), F.col("o_totalprice").cast("decimal(18,2)")
    local = F.translate(F.format_number(v, 2), ",.", ".,")
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    text = F.when(F.col("o_orderstatus") == "F", F.date_format(day, "dd/MM/yyyy")).when(F.col("o_orderstatus") == "O", F.date_format(day, "yyyy-MM-dd")) \
        .otherwise(F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string"))
    amount = F.when(digit == 1, F.concat(F.lit("R$ "), local)).when(digit == 2, F.concat(F.lit('"'), local, F.lit('"'))) \
        .when((digit == 5) & (F.col("o_orderstatus") == "O"), "").otherwise(v.cast("string"))
    file = F.concat("o_orderpriority", F.lit("-"), F.year(day).cast("string"))
    changed = F.date_add(F.lit("2020-01-01").cast("date"), (F.year(day) * 7 + digit * 3) % 11).cast("timestamp")
    rows = o.select(file.alias("file"), changed.alias("changed"), (F.col("o_orderkey") + 1).cast("int").alias("pos"),
                    F.concat_ws(";", F.lit("visa"), text, amount).alias("line"))
    heads = rows.select("file", "changed").distinct().select("file", "changed", F.lit(0).alias("pos"), F.lit(SCHEDULE_HEADER).alias("line"))
    return rows.unionByName(heads)


@register("schedule_days", sql="""
WITH o AS (SELECT o_orderpriority || '-' || year(o_orderdate) AS file, CAST(o_orderdate AS DATE) AS day, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                  CAST(o_totalprice AS DECIMAL(18,2)) AS v, (year(o_orderdate) * 7 + CAST(o_orderpriority[1] AS INTEGER) * 3) % 11 AS changed
           FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'O')),
newest AS (SELECT month, arg_max(file, (changed, file)) AS file FROM o GROUP BY 1)
SELECT day AS release_date, 'acq' AS acquirer, CAST(sum(v) AS DOUBLE) AS value, file AS source_file FROM o JOIN newest USING (month, file) GROUP BY day, file
""")
def schedule_days(spark, d):
    """SR-4 with AG-29, F-money and F-mixed date: text lines to days, the newest file of each month."""
    return io.schedule_days(schedule_text(spark, d), "acq").drop("changed", "month")
