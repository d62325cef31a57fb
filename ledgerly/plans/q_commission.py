"""RP-1 whole: the commission view over the club's table shapes, made from the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerly.functions.num import money, round2
from ledgerly.operators.common import rule_table
from ledgerly.operators.rules import RULES_SCHEMA, label_by_rules
from ledgerly.plans.commission import CommissionRules, commission_detail
from ledgerly.plans.registry import register
from ledgerly.session import stage
from ledgerly.sources.tables import table

# Fixed values of the test mapping: order priority -> (start time, booking text).
CLASSES = [("1-URGENT", "10:00", "Turma (2 / 1) Prof: Dan"), ("2-HIGH", "18:00", "Turma (1 / 2) Prof. Eve  Two. Quadra"),
           ("3-MEDIUM", "09:00", "Turma (1 / 3)"), ("4-NOT SPECIFIED", "07:00", "Turma adulto (3 / 4) prof Gus"),
           ("5-LOW", "20:00", "RESERVA MENSAL Prof: Ida")]

RULES = CommissionRules(
    item_teacher_rules=[("Rui", ("all", [("in", "customer_code", ["000007", "000100"]), ("contains", "description", "grupo")])),
                        ("Dan", ("contains", "description", "aula avulsa")), ("Gus", ("contains", "description", "trio"))],
    booking_teacher_rules=[("Rui", ("in", "customer_code", ["000007", "000100"])), ("Eve Two", ("contains", "description", "eve  two"))],
    member_patterns=["Sócio"], double_patterns=["Patrocínio"], count_weighted_customers=["000602", "000100"],
    split_rules=[(6, "10:00", "Dan", "Hal", 0.5)], unallocated_venue="club")


def club_tables(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    """(participants, bookings, booking_payments, sales, items, clients).

    An order is a booking of its customer: status P a single lesson, others
    group classes, P with priority 5 cancelled; text and time follow the
    priority, and a status O order of priority 5 has no text. A line is a
    sale with one item, a hundredth of its price, paid if its status is F;
    its text follows its return flag and its order's status, and names another
    customer where the quantity is 48 or more. A line of flag A is also a
    payment row of its order's booking.
    """
    o, li, c = (table(spark, d, t) for t in ("orders", "lineitem", "customer"))
    code = lambda col: F.lpad(F.col(col).cast("string"), 6, "0")
    pick = lambda i: F.element_at(F.create_map(*[x for row in CLASSES for x in (F.lit(row[0]), F.lit(row[i]))]), F.col("o_orderpriority"))
    low = F.col("o_orderpriority") == "5-LOW"
    bookings = o.select(
        F.col("o_orderkey").alias("booking_id"), F.to_date("o_orderdate").alias("booking_date"), pick(1).alias("start_time"),
        F.when(low & (F.col("o_orderstatus") == "P"), "CANCELLED").otherwise("ACTIVE").alias("status"),
        F.when(F.col("o_orderstatus") == "P", "clase_suelta").otherwise("clase_colectiva").alias("booking_type"),
        F.when(~(low & (F.col("o_orderstatus") == "O")), pick(2)).alias("description"), F.lit("club").alias("venue"),
        F.concat(F.lit("Court "), F.substring("o_orderpriority", 1, 1)).alias("resource_name"))
    clients = c.select(code("c_custkey").alias("customer_code"), F.upper("c_name").alias("name"))
    participants = o.select("o_orderkey", "o_custkey").join(c.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey")) \
        .select(F.col("o_orderkey").alias("booking_id"), code("o_custkey").alias("customer_code"), F.col("c_name").alias("participant_name"))

    v = F.round(money("l_extendedprice") * F.lit("0.01").cast("decimal(3,2)"), 2).cast("decimal(18,2)")
    month = F.trunc("l_shipdate", "MM")
    dmy = lambda col: F.date_format(col, "dd/MM/yyyy")
    plain = F.when(F.col("l_returnflag") == "N", F.when(
        F.col("o_orderstatus") == "P", F.concat(F.lit("Aula avulsa "), dmy("o_orderdate"), F.lit(" "), pick(1))).otherwise("Mensalidade GRUPO")) \
        .when(F.col("l_returnflag") == "R", F.when(F.col("o_orderstatus") == "F", F.concat(
            F.lit("Plano DUPLA "), dmy(month), F.lit("-"), dmy(F.last_day(month)))).otherwise("Mensalidade TRIO")) \
        .otherwise(F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("Plano "), dmy(month), F.lit("-"), dmy(F.date_add(month, 14))))
                   .otherwise("Mensalidade"))
    text = F.concat(F.when(F.col("l_discount") > 0.08, "Sócio ").otherwise(""), F.when(F.col("l_tax") == 0.08, "Patrocínio ").otherwise(""),
                    F.when(F.col("l_quantity") == 7, "Tênis adulto ").otherwise(""), plain,
                    F.when(F.col("l_quantity") >= 48, F.concat(F.lit(" - Customer#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))).otherwise(""))
    # one stage table of lines: sales, items and payments are views of it
    lines = stage(li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", v).alias("item_key"), "l_orderkey", "l_returnflag",
        code("o_custkey").alias("customer_code"), (F.col("l_linestatus") == "F").alias("paid"),
        F.when(F.col("l_discount") == 0, F.col("l_quantity") == 2).otherwise(F.lit(False)).alias("sale_canceled"),
        F.when((F.col("l_tax") >= 0.07) & (F.col("l_returnflag") == "R"), "refund").when(F.col("l_tax") > 0, "sale").alias("tipo"),
        F.when(~((F.col("l_linestatus") == "O") & (F.col("l_quantity") < 5)), F.col("l_shipdate")).alias("pay_date"),
        F.to_date("o_orderdate").alias("data_venda"), text.alias("description"),
        F.when(F.col("l_quantity").isin(7, 8), "Outros").when(F.col("l_quantity") == 9, "Loja").otherwise("Aulas").alias("categoria"),
        F.when(F.col("l_quantity") == 11, "Avulsa - Particular").when(F.col("l_quantity") == 13, "Avulsa - Grupo Fixo").alias("subcategoria"),
        v.alias("valor_faturamento"),
        F.when(F.col("l_tax") >= 0.03, F.round(v * (F.lit(1) + money("l_tax")), 2).cast("decimal(18,2)")).alias("valor_bruto"),
        (F.col("l_quantity") == 3).alias("is_canceled")))
    sales = lines.select(F.col("item_key").alias("external_id"), "customer_code", "paid", F.col("sale_canceled").alias("is_canceled"), "tipo",
                         "pay_date", "data_venda")
    items = lines.select("item_key", F.col("item_key").alias("venda_external_id"), "description", "categoria", "subcategoria",
                         "valor_faturamento", "valor_bruto", "is_canceled")
    payments = lines.where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("booking_id"), F.col("pay_date").alias("payment_date"),
                                                        F.col("valor_faturamento").alias("amount"))
    return participants, bookings, payments, sales, items, clients


_CLASS_SQL = ", ".join(f"('{p}', '{t}', '{x}')" for p, t, x in CLASSES)
_GROSS = "coalesce(valor_bruto, valor_faturamento)"
_MEMBER = "contains(lower(description), 'sócio')"
_DOUBLE = "contains(lower(description), 'patrocínio')"
_R2 = "floor(CAST({} AS DOUBLE) * 100 + 0.5) / 100"


def _booking_teacher(t: str) -> str:
    return (f"CASE WHEN {t}.customer_code IN ('000007', '000100') THEN 'Rui' WHEN contains(lower({t}.description), 'eve  two') THEN 'Eve Two' "
            f"ELSE nullif(trim(regexp_replace(regexp_extract({t}.description, '(?i)prof[:.]?\\s*([^.(]+)', 1), '\\s+', ' ', 'g')), '') END")


_ITEM_TEACHER = """CASE WHEN customer_code IN ('000007', '000100') AND contains(lower(description), 'grupo') THEN 'Rui'
    WHEN contains(lower(description), 'aula avulsa') THEN 'Dan' WHEN contains(lower(description), 'trio') THEN 'Gus' END"""
_SLOT = """CASE WHEN regexp_matches(description, '\\(\\s*\\d+\\s*/\\s*1\\s*\\)') THEN 'INDIVIDUAL' WHEN regexp_matches(description, '\\(\\s*\\d+\\s*/\\s*2\\s*\\)') THEN 'DUPLA'
    WHEN regexp_matches(description, '\\(\\s*\\d+\\s*/\\s*3\\s*\\)') THEN 'TRIO' WHEN regexp_matches(description, '\\(\\s*\\d+\\s*/\\s*[456789]\\d*\\s*\\)') THEN 'GRUPO'
    WHEN booking_type = 'clase_suelta' THEN 'INDIVIDUAL' ELSE 'GRUPO' END"""

SQL = f"""
WITH k(prio, start_time, txt) AS (VALUES {_CLASS_SQL}),
li AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, v) AS item_key, * FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, lpad(o_custkey::VARCHAR, 6, '0') AS sale_customer, l_linestatus = 'F' AS paid,
    l_discount = 0 AND l_quantity = 2 AS sale_canceled, CASE WHEN l_tax >= 0.07 AND l_returnflag = 'R' THEN 'refund' WHEN l_tax > 0 THEN 'sale' END AS tipo,
    CASE WHEN NOT (l_linestatus = 'O' AND l_quantity < 5) THEN l_shipdate END AS pay_date, o_orderdate::DATE AS data_venda,
    CASE WHEN l_discount > 0.08 THEN 'Sócio ' ELSE '' END || CASE WHEN l_tax = 0.08 THEN 'Patrocínio ' ELSE '' END || CASE WHEN l_quantity = 7 THEN 'Tênis adulto ' ELSE '' END ||
    CASE WHEN l_returnflag = 'N' THEN CASE WHEN o_orderstatus = 'P' THEN 'Aula avulsa ' || strftime(o_orderdate, '%d/%m/%Y') || ' ' || k.start_time ELSE 'Mensalidade GRUPO' END
      WHEN l_returnflag = 'R' THEN CASE WHEN o_orderstatus = 'F' THEN 'Plano DUPLA ' || strftime(date_trunc('month', l_shipdate), '%d/%m/%Y') || '-' || strftime(last_day(l_shipdate), '%d/%m/%Y')
        ELSE 'Mensalidade TRIO' END
      ELSE CASE WHEN o_orderstatus = 'O' THEN 'Plano ' || strftime(date_trunc('month', l_shipdate), '%d/%m/%Y') || '-' || strftime(date_trunc('month', l_shipdate) + INTERVAL 14 DAY, '%d/%m/%Y')
        ELSE 'Mensalidade' END END || CASE WHEN l_quantity >= 48 THEN ' - Customer#' || lpad(l_suppkey::VARCHAR, 9, '0') ELSE '' END AS description,
    CASE WHEN l_quantity IN (7, 8) THEN 'Outros' WHEN l_quantity = 9 THEN 'Loja' ELSE 'Aulas' END AS categoria,
    CASE WHEN l_quantity = 11 THEN 'Avulsa - Particular' WHEN l_quantity = 13 THEN 'Avulsa - Grupo Fixo' END AS subcategoria,
    v, v AS valor_faturamento, CASE WHEN l_tax >= 0.03 THEN round(v * (1 + l_tax::DECIMAL(18,2)), 2)::DECIMAL(18,2) END AS valor_bruto, l_quantity = 3 AS is_canceled
  FROM (SELECT *, round(l_extendedprice::DECIMAL(18,2) * 0.01, 2)::DECIMAL(18,2) AS v FROM lineitem) l
  JOIN orders ON l_orderkey = o_orderkey JOIN k ON prio = o_orderpriority)),
booked AS (SELECT o_orderkey AS booking_id, o_orderdate::DATE AS booking_date, start_time,
    CASE WHEN o_orderstatus = 'P' THEN 'clase_suelta' ELSE 'clase_colectiva' END AS booking_type,
    CASE WHEN NOT (prio = '5-LOW' AND o_orderstatus = 'O') THEN txt END AS description, 'club' AS venue, 'Court ' || prio[1] AS resource_name,
    lpad(o_custkey::VARCHAR, 6, '0') AS customer_code, c_name AS participant_name
  FROM orders JOIN k ON prio = o_orderpriority JOIN customer ON c_custkey = o_custkey WHERE NOT (prio = '5-LOW' AND o_orderstatus = 'P')),
pb AS (SELECT *, {_booking_teacher('booked')} AS tb, {_SLOT} AS cls, date_trunc('month', booking_date)::DATE AS plan_month, isodow(booking_date) AS dow
  FROM booked WHERE NOT contains(lower(description), 'reserva mensal')),
pay AS (SELECT l_orderkey AS booking_id, pay_date AS payment_date, v AS amount FROM li WHERE l_returnflag = 'A'),
lcm AS (SELECT pb.booking_id, pb.customer_code, i.item_key, i.v AS payment_value,
    CASE WHEN {_MEMBER.replace('description', 'i.description')} THEN coalesce(i.valor_bruto, i.v) WHEN {_DOUBLE.replace('description', 'i.description')} THEN i.v * 2 ELSE i.v END AS value_c,
    {_MEMBER.replace('description', 'i.description')} OR {_DOUBLE.replace('description', 'i.description')} AS is_socio, i.paid, coalesce(fp.first_pay, i.pay_date) AS pay_date,
    {_ITEM_TEACHER.replace('description', 'i.description').replace('customer_code', 'i.sale_customer')} AS professor
  FROM pb JOIN li i ON i.sale_customer = pb.customer_code LEFT JOIN (SELECT booking_id, min(payment_date) AS first_pay FROM pay GROUP BY 1) fp USING (booking_id)
  WHERE pb.booking_type = 'clase_suelta' AND NOT i.is_canceled AND NOT i.sale_canceled AND i.v > 0 AND i.categoria IN ('Aulas', 'Outros')
    AND (contains(i.description, strftime(pb.booking_date, '%d/%m/%Y')) AND contains(i.description, pb.start_time)
      OR EXISTS (SELECT 1 FROM pay WHERE pay.booking_id = pb.booking_id AND pay.payment_date = i.pay_date AND pay.amount = i.v))),
up AS (SELECT c_name AS pname, min(lpad(o_custkey::VARCHAR, 6, '0')) AS pcust FROM orders JOIN customer ON c_custkey = o_custkey WHERE length(c_name) > 5 GROUP BY 1),
txts AS (SELECT DISTINCT description FROM li WHERE contains(description, 'Customer#')),
named AS (SELECT t.description, arg_min(pcust, pname) AS pcust FROM txts t JOIN up ON contains(lower(t.description), lower(pname)) GROUP BY 1),
rf AS (SELECT li.* EXCLUDE (v), li.v, coalesce(n.pcust, sale_customer) AS customer_code,
    contains(lower(li.description), 'aula avulsa') OR coalesce(subcategoria IN ('Avulsa - Grupo Fixo', 'Avulsa - Particular'), false) AS is_avulsa,
    contains(lower(li.description), 'aula avulsa - grupo fixo') OR coalesce(subcategoria = 'Avulsa - Grupo Fixo', false) AS is_fixed,
    {_MEMBER.replace('description', 'li.description')} AS member, {_DOUBLE.replace('description', 'li.description')} AS double
  FROM li LEFT JOIN named n USING (description)
  WHERE (categoria = 'Aulas' OR categoria = 'Outros' AND contains(lower(li.description), 'tênis') AND contains(lower(li.description), 'adulto'))
    AND NOT is_canceled AND NOT sale_canceled AND coalesce(tipo, '') <> 'refund' AND li.v > 0 AND subcategoria IS DISTINCT FROM 'Avulsa - Particular'),
spans AS (SELECT *, nullif(regexp_extract(description, '(\\d{{2}}/\\d{{2}}/\\d{{4}})-(\\d{{2}}/\\d{{2}}/\\d{{4}})', 1), '') AS s1,
    nullif(regexp_extract(description, '(\\d{{2}}/\\d{{2}}/\\d{{4}})-(\\d{{2}}/\\d{{2}}/\\d{{4}})', 2), '') AS s2 FROM rf WHERE NOT is_avulsa),
dated AS (SELECT *, strptime(s1, '%d/%m/%Y')::DATE AS sd, strptime(s2, '%d/%m/%Y')::DATE AS ed FROM spans),
full_values AS (SELECT *, CASE WHEN sd IS NULL THEN {_GROSS}::DOUBLE ELSE
    ((({_GROSS} * 100)::BIGINT * day(last_day(sd)) * 2 + greatest(datediff('day', sd, ed) + 1, 1)) // (2 * greatest(datediff('day', sd, ed) + 1, 1))) / 100.0 END AS fv FROM dated),
prices(ord, kind, price) AS (VALUES (0, 'INDIVIDUAL', 720.0::DOUBLE), (1, 'DUPLA', 430.0), (2, 'TRIO', 395.0), (3, 'GRUPO', 335.0), (4, 'GRUPO', 245.0)),
cand AS (SELECT item_key, kind, row_number() OVER (PARTITION BY item_key ORDER BY CASE WHEN fv / price <= 1.05 THEN 1 ELSE 2 END,
    abs(round(fv / (CASE WHEN fv / price > 1.3 THEN 2.0::DOUBLE ELSE 1.0 END * price) * 20) - fv / (CASE WHEN fv / price > 1.3 THEN 2.0::DOUBLE ELSE 1.0 END * price) * 20), ord) AS rn
  FROM full_values CROSS JOIN prices WHERE fv >= 50 AND (fv / price BETWEEN 0.15 AND 1.05 OR fv / (2.0::DOUBLE * price) BETWEEN 0.85 AND 1.15)),
pi AS (SELECT f.item_key, f.customer_code, f.paid, f.pay_date, f.member OR f.double AS is_socio, f.is_avulsa, f.is_fixed,
    date_trunc('month', coalesce(sd, f.pay_date, f.data_venda))::DATE AS plan_month,
    CASE WHEN contains(lower(description), 'dupla') THEN 'DUPLA' WHEN contains(lower(description), 'trio') THEN 'TRIO' WHEN contains(lower(description), 'grupo') THEN 'GRUPO'
      ELSE coalesce(c.kind, 'OUTRO') END AS kind, f.v, CASE WHEN f.double THEN f.v * 2 WHEN f.member THEN {_GROSS} ELSE f.v END AS b,
    CASE WHEN f.member OR f.double THEN {_GROSS} ELSE f.v END AS m
  FROM full_values f LEFT JOIN cand c ON c.item_key = f.item_key AND c.rn = 1),
slots AS (SELECT *, CASE cls WHEN 'INDIVIDUAL' THEN 720 WHEN 'DUPLA' THEN 430 WHEN 'TRIO' THEN 395 ELSE 335 END
    * CASE WHEN customer_code IN ('000602', '000100') THEN n ELSE 1 END AS w,
    EXISTS (SELECT 1 FROM pi WHERE pi.customer_code = g.customer_code AND pi.plan_month = g.plan_month AND pi.kind = g.cls) AS covered
  FROM (SELECT customer_code, plan_month, dow, start_time, tb, cls, count(*) AS n FROM pb WHERE booking_type = 'clase_colectiva' GROUP BY ALL) g),
sums AS (SELECT *, sum(w) OVER (PARTITION BY customer_code, plan_month, cls) AS w_type, sum(w) OVER (PARTITION BY customer_code, plan_month) AS w_all,
    sum(CASE WHEN covered THEN 0 ELSE w END) OVER (PARTITION BY customer_code, plan_month) AS w_open FROM slots),
pairs AS (SELECT s.*, p.* EXCLUDE (customer_code, plan_month), bool_or(p.kind = s.cls) OVER (PARTITION BY p.item_key) AS matched
  FROM sums s JOIN pi p ON p.customer_code = s.customer_code AND p.plan_month = s.plan_month),
shares AS (SELECT *, CASE WHEN matched THEN CASE WHEN kind = cls THEN w_type END WHEN w_open > 0 THEN CASE WHEN NOT covered THEN w_open END ELSE w_all END AS den FROM pairs),
st AS (SELECT customer_code, plan_month, dow, start_time, tb, cls, n, paid, sum(coalesce(v::DOUBLE * w / den, 0)) AS sv, sum(coalesce(b::DOUBLE * w / den, 0)) AS sb,
    sum(coalesce(m::DOUBLE * w / den, 0)) AS sm, max(CASE WHEN den IS NOT NULL AND v > 0 THEN pay_date END) AS spay, bool_or(is_socio) AS ss, bool_or(is_avulsa) AS sa,
    bool_or(is_fixed) AS sf FROM shares GROUP BY ALL),
fb AS (SELECT pb.booking_id, pb.booking_date, pb.booking_type, pb.start_time, pb.venue, pb.resource_name, pb.description, coalesce(pb.tb, l.professor, 'Sem professor') AS professor,
    pb.customer_code, pb.participant_name, CASE WHEN single THEN coalesce(payment_value::DOUBLE, 0) ELSE coalesce(sv / n, 0) END AS bv,
    CASE WHEN single THEN coalesce(value_c::DOUBLE, 0) ELSE coalesce(sb / n, 0) END AS cb, coalesce(l.is_socio, ss, false) AS socio,
    CASE WHEN single THEN coalesce(l.paid, false) ELSE coalesce(st.paid, false) END AS is_paid, CASE WHEN single THEN l.pay_date ELSE spay END AS pay_date,
    CASE WHEN single THEN 0 ELSE coalesce(sv / n, 0) END AS bm, CASE WHEN single THEN 0 ELSE coalesce(sm / n, 0) END AS cm,
    single OR coalesce(sa, false) AS is_avulsa, single AND coalesce(sf, false) AS is_fixed
  FROM (SELECT *, booking_type = 'clase_suelta' AS single FROM pb) pb LEFT JOIN lcm l ON l.booking_id = pb.booking_id AND l.customer_code = pb.customer_code
  LEFT JOIN st ON NOT single AND st.customer_code = pb.customer_code AND st.plan_month = pb.plan_month AND st.dow = pb.dow AND st.start_time = pb.start_time
    AND st.cls = pb.cls AND st.tb = pb.tb),
un AS (SELECT * FROM rf WHERE item_key NOT IN (SELECT item_key FROM lcm UNION SELECT item_key FROM pairs)),
near AS (SELECT item_key, arg_min(coalesce({_booking_teacher('b')}, 'Sem professor'),
    (abs(datediff('day', b.booking_date, coalesce(un.pay_date, un.data_venda)::DATE)), b.booking_date, b.booking_id)) AS professor
  FROM un JOIN booked b ON b.customer_code = un.customer_code AND b.booking_type = 'clase_colectiva' GROUP BY 1),
split AS (SELECT * EXCLUDE (professor), professor, 1.0::DOUBLE AS f FROM fb WHERE NOT (isodow(booking_date) = 6 AND start_time = '10:00' AND professor = 'Dan')
  UNION ALL SELECT * EXCLUDE (professor), unnest(['Dan', 'Hal']), 0.5::DOUBLE FROM fb WHERE isodow(booking_date) = 6 AND start_time = '10:00' AND professor = 'Dan')
SELECT booking_id, booking_date, booking_type, start_time, venue, resource_name, description, professor, customer_code, participant_name,
  {_R2.format('bv * f')} AS booking_value, {_R2.format('cb * f')} AS booking_commission_base, socio AS is_socio_benefit, is_paid, pay_date,
  {_R2.format('bm * f')} AS booking_value_monthly, {_R2.format('cm * f')} AS booking_commission_base_monthly, is_avulsa, is_fixed AS is_avulsa_grupo_fixo FROM split
UNION ALL
SELECT NULL, coalesce(pay_date, data_venda)::DATE, 'unallocated_payment', '00:00', 'club', 'N/A', description,
  coalesce({_ITEM_TEACHER}, CASE WHEN is_avulsa THEN 'Sem professor' END, near.professor, 'Sem professor'), customer_code, upper(c_name),
  {_R2.format('v')}, {_R2.format('CASE WHEN member OR double THEN valor_bruto ELSE v END')}, member OR double, paid, pay_date,
  {_R2.format('v')}, {_R2.format('CASE WHEN member OR double THEN valor_bruto ELSE v END')}, is_avulsa, is_fixed
FROM un LEFT JOIN near USING (item_key) LEFT JOIN customer ON lpad(c_custkey::VARCHAR, 6, '0') = customer_code
"""


@register("commission_view", sql=SQL)
def commission_view(spark, d):
    """RP-1 whole: loose matches, names in texts, three-tier allocation, split and unallocated lines, all columns."""
    out = commission_detail(*club_tables(spark, d), RULES)
    for c in ("booking_value", "booking_commission_base", "booking_value_monthly", "booking_commission_base_monthly"):
        out = out.withColumn(c, round2(c))
    return out


# Fixed values of the test mapping: the five orders in which the commission view names a teacher, as five rulesets of one
# table. A rule of several conditions takes several rows.
_PEOPLE = [("Rui", "patrocínio"), ("Dan", "aula avulsa"), ("Gus", "trio"), ("Eve Two", "dupla"), ("Ida", "grupo")]
_DATED = [("customer_code", "equals", "000100", "1997-07-01", "1998-06-30"), ("customer_code", "starts", "0002", "1999-01-01", None)]


def _ruleset(name, order, *first):
    rows = [(name, p, *cond) for p, conds in enumerate(first) for cond in conds]
    return rows + [(name, 10 + p, "description", "contains", word, None, None, who) for p, (who, word) in enumerate(order)]


TEACHER_RULES = [
    # lessons matched to a line: a customer in a period, or one line's text; then people
    *_ruleset("loose", _PEOPLE, [(*_DATED[0], "Joe")], [("description", "starts", "sócio patrocínio", None, None, "Joe")]),
    # weekly slots: the same customer, and a text with a period; people in another order
    *_ruleset("schedule", _PEOPLE[::-1], [(*_DATED[0], "Joe")], [(*_DATED[1], "Joe"), ("description", "contains", "plano", "1999-01-01", None, "Joe")]),
    # bookings: a period alone comes after the people
    *_ruleset("booking", _PEOPLE, [(*_DATED[1], "Joe"), ("description", "contains", "mensalidade", None, None, "Joe")]),
    ("booking", 90, None, "always", None, "2000-01-01", "2000-03-31", "Pat"),
    # lines used nowhere: one more spelling
    *_ruleset("unallocated", [*_PEOPLE[2:], ("Dan", "avulsa"), ("Rui", "patrocínio")], [(*_DATED[0], "Joe")]),
    # the nearest booking: the customer in the period, then people
    *_ruleset("nearest", [_PEOPLE[3], _PEOPLE[0]], [(*_DATED[0], "Joe")]),
    ("nearest", 99, None, "always", None, None, None, "Sem professor"),
]


def _rules_sql(name: str) -> str:
    """The ruleset as one CASE."""
    rules: dict = {}
    for _, p, column, predicate, pattern, since, upto, label in (r for r in TEACHER_RULES if r[0] == name):
        test = {"equals": f"{column} = '{pattern}'", "contains": f"contains(lower({column}), '{pattern}')",
                "starts": f"starts_with(lower({column}), '{pattern}')", "always": "true"}[predicate]
        test += f" AND day >= DATE '{since}'" if since else ""
        test += f" AND day <= DATE '{upto}'" if upto else ""
        rules.setdefault(p, (label, []))[1].append(test)
    return "CASE " + " ".join(f"WHEN {' AND '.join(t)} THEN '{who}'" for _, (who, t) in sorted(rules.items())) + " END"


RULESETS = ["loose", "schedule", "booking", "unallocated", "nearest"]


@register("teacher_rules", sql=SQL[:SQL.index("booked AS (")].rstrip().rstrip(",") + f"""
SELECT sale_customer AS customer_code, description, day, count(*) AS n, {", ".join(f"{_rules_sql(r)} AS {r}" for r in RULESETS)}
FROM (SELECT *, sale_customer AS customer_code, pay_date::DATE AS day FROM li) GROUP BY sale_customer, customer_code, description, day
""")
def teacher_rules(spark, d):
    """CL-1: the five orders of the commission view as rulesets of one dated table over two columns of the sale lines."""
    _, _, _, sales, items, _ = club_tables(spark, d)
    lines = items.join(sales.select(F.col("external_id").alias("item_key"), "customer_code", "pay_date"), "item_key") \
        .groupBy("customer_code", "description", F.to_date("pay_date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    rules = rule_table(spark, [(*r[:5], *[x and dt.date.fromisoformat(x) for x in r[5:7]], r[7]) for r in TEACHER_RULES], RULES_SCHEMA)
    return label_by_rules(lines, rules, ["customer_code", "description"], "day", RULESETS)
