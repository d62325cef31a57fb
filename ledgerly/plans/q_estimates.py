"""Estimate queries on events as bookings: AL-9 (with CL-2, CL-4, CL-12, CL-13,
CL-15, CA-1, WN-7) and AL-10 (with AG-21, CL-14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerly.functions.num import round2
from ledgerly.operators import estimate as X
from ledgerly.operators.agg import latest_month_sum
from ledgerly.plans.registry import register
from ledgerly.sources.tables import table


def event_bookings(spark, d):
    """Events as bookings: the description is built from ``props.k`` (kids, baby,
    free, member words and an ``(1 / m)`` capacity), signups are single lessons,
    values above 300 are member bookings, purchases are paid."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    word = (F.when(k < 10, "Aula KIDS ").when(k < 15, "Aula BABY ").when(k < 20, "REPOSIÇÃO ")
             .when(k < 25, "Aula SÓCIO ").otherwise("Aula "))
    desc = F.concat(word, F.lit("(1 / "), (k % 5 + 1).cast("string"), F.lit(")"))
    return e.select(F.col("user_id").alias("student"), F.col("event_id").alias("booking_id"),
                    F.to_date("ts").alias("booking_date"), F.hour("ts").alias("hour"),
                    F.concat(F.lpad(F.hour("ts").cast("string"), 2, "0"), F.when(F.minute("ts") < 30, ":00").otherwise(":30"))
                     .alias("start_time"),
                    desc.alias("description"),
                    F.when(F.col("event_type") == "signup", "clase_suelta").otherwise("clase_colectiva")
                     .alias("booking_type"),
                    (F.col("value") > 300).alias("is_socio"), F.col("event_type"), F.col("value"))


SQL_EVENT_BOOKINGS = """
  eb AS (
    SELECT user_id AS student, event_id AS booking_id, CAST(ts AS DATE) AS booking_date, hour(ts) AS hour,
           lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || CASE WHEN minute(ts) < 30 THEN ':00' ELSE ':30' END AS start_time,
           CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 10 THEN 'Aula KIDS '
                WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 15 THEN 'Aula BABY '
                WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 20 THEN 'REPOSIÇÃO '
                WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 25 THEN 'Aula SÓCIO ' ELSE 'Aula ' END
             || '(1 / ' || CAST(CAST(json_extract(props, '$.k') AS INTEGER) % 5 + 1 AS VARCHAR) || ')' AS description,
           CASE WHEN event_type = 'signup' THEN 'clase_suelta' ELSE 'clase_colectiva' END AS booking_type,
           value > 300 AS is_socio, event_type, value
    FROM events),
  pb AS (
    SELECT *, CAST(date_trunc('month', booking_date) AS DATE) AS month, dayofweek(booking_date) AS dow,
           (booking_type = 'clase_suelta' OR contains(upper(description), 'REPOSIÇÃO') OR contains(upper(description), 'REPOSICAO')
            OR contains(upper(description), 'EXPERIMENTAL') OR contains(upper(description), 'CORTESIA')
            OR contains(upper(description), 'TESTE')) AS is_free,
           CASE WHEN regexp_extract(description, '\\(\\s*\\d+\\s*/\\s*(\\d+)\\s*\\)', 1) <> ''
                THEN CAST(regexp_extract(description, '\\(\\s*\\d+\\s*/\\s*(\\d+)\\s*\\)', 1) AS INTEGER)
                WHEN booking_type = 'clase_suelta' THEN 1 ELSE 4 END AS cap,
           contains(upper(description), 'KIDS') OR contains(upper(description), 'BABY') AS kids
    FROM eb),
  pc AS (
    SELECT *,
           CASE WHEN kids AND (cap = 1 OR contains(upper(description), 'INDIVIDUAL')) THEN 'Kids Individual'
                WHEN kids AND contains(upper(description), 'BABY') THEN 'Baby Tennis'
                WHEN kids THEN 'Kids Normal'
                WHEN booking_type = 'clase_suelta' THEN 'Adulto Avulso'
                WHEN cap = 1 THEN 'Adulto Individual' WHEN cap = 2 THEN 'Adulto Dupla'
                WHEN cap = 3 THEN 'Adulto Trio' ELSE 'Adulto Grupo' END AS category,
           CASE WHEN kids AND (cap = 1 OR contains(upper(description), 'INDIVIDUAL')) THEN 450.0
                WHEN kids THEN 255.0 WHEN booking_type = 'clase_suelta' THEN 120.0
                WHEN cap = 1 THEN 720.0 WHEN cap = 2 THEN 430.0 WHEN cap = 3 THEN 395.0 ELSE 335.0 END::DOUBLE AS unit_price,
           NOT (NOT kids AND booking_type = 'clase_suelta') AS is_monthly
    FROM pb)"""


@register("estimate_pending", sql=f"""
WITH {SQL_EVENT_BOOKINGS},
b AS (SELECT * FROM pc WHERE event_type <> 'purchase'),
s AS (SELECT student, month, dow, start_time, hour, category, unit_price, is_monthly, count(*) AS n
      FROM b WHERE NOT is_free GROUP BY ALL),
ns AS (SELECT student, month, count(*) AS n_slots FROM s GROUP BY 1, 2),
cal AS (SELECT month, dayofweek(day) AS dow, count(*) AS occ
        FROM (SELECT month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day
              FROM (SELECT DISTINCT month FROM s)) GROUP BY 1, 2),
v AS (SELECT s.*, ns.n_slots,
             CASE WHEN is_monthly THEN n / cal.occ * unit_price ELSE n * unit_price END AS pro,
             dow BETWEEN 1 AND 5 AND hour BETWEEN 10 AND 15 AS off
      FROM s JOIN ns USING (student, month) LEFT JOIN cal USING (month, dow)),
f AS (SELECT *, CASE WHEN off THEN pro * 0.88::DOUBLE
                     ELSE pro * (1.0::DOUBLE - CASE WHEN n_slots = 2 THEN 0.05 WHEN n_slots >= 3 THEN 0.07 ELSE 0.0 END::DOUBLE) END AS slot_value
      FROM v),
pbk AS (SELECT b.student, b.month, b.is_socio,
               CASE WHEN b.is_free THEN 0.0 ELSE f.slot_value / f.n END AS est
        FROM b LEFT JOIN f ON f.student = b.student AND f.month = b.month AND f.dow = b.dow AND f.start_time = b.start_time
                          AND f.category = b.category),
per AS (SELECT student, month, count(*) AS n_bookings,
               sum(CAST(CASE WHEN is_socio THEN est * 2 ELSE est END AS DECIMAL(24,6))) AS cb,
               bool_or(is_socio) AS is_socio FROM pbk GROUP BY 1, 2),
bill AS (SELECT student, month, sum(CAST(slot_value AS DECIMAL(24,6))) AS total_billed, max(n_slots) AS n_slots
         FROM f GROUP BY 1, 2)
SELECT per.student AS user_id, per.month, per.n_bookings, coalesce(bill.n_slots, 0) AS n_slots,
       CAST(round(coalesce(bill.total_billed, 0), 2) AS DOUBLE) AS total_billed,
       CAST(round(CASE WHEN per.cb = 0 THEN coalesce(bill.total_billed, 0) ELSE per.cb END, 2) AS DOUBLE) AS commission_base,
       per.is_socio
FROM per LEFT JOIN bill USING (student, month)
""")
def estimate_pending(spark, d):
    """AL-9: expected billing and commission base of each user's unpaid bookings in the month."""
    b = event_bookings(spark, d).where(F.col("event_type") != "purchase")
    _, per_s = X.estimate_pending(b)
    return per_s.select(F.col("student").alias("user_id"), "month", "n_bookings", "n_slots",
                        F.round("total_billed", 2).cast("double").alias("total_billed"),
                        F.round("commission_base", 2).cast("double").alias("commission_base"), "is_socio")


@register("recurring_price", sql=f"""
WITH {SQL_EVENT_BOOKINGS},
hm AS (SELECT user_id AS student, CAST(date_trunc('month', ts) AS DATE) AS m,
              sum(CAST(value AS DECIMAL(18,2))) AS s
       FROM events WHERE event_type = 'purchase' AND value > 300 GROUP BY 1, 2),
hist AS (SELECT student, arg_max(s, m) AS latest_sum FROM hm GROUP BY 1),
b AS (SELECT *, (contains(upper(description), 'SÓCIO') OR contains(upper(description), 'SOCIO') OR coalesce(is_socio, false)) AS mem,
             (contains(upper(description), 'HORA LIGHT') OR (dow BETWEEN 1 AND 5 AND hour BETWEEN 10 AND 15)) AS offp
      FROM pc WHERE booking_type <> 'clase_suelta'),
fl AS (SELECT student, bool_or(mem) AS has_member, bool_or(NOT mem AND offp) AS has_off FROM b GROUP BY 1),
ns AS (SELECT student, count(*) AS n_slots FROM (SELECT DISTINCT student, dow, start_time FROM b WHERE NOT is_free) GROUP BY 1),
mc AS (SELECT student, arg_min(category, (booking_date, start_time, booking_id)) AS main_category FROM b WHERE NOT is_free GROUP BY 1),
nw AS (SELECT ns.student, ns.n_slots, mc.main_category,
              CASE WHEN contains(main_category, 'Individual') THEN (CASE WHEN n_slots = 1 THEN 720.0 WHEN n_slots = 2 THEN 1296.0 ELSE 1836.0 END)
                   WHEN contains(main_category, 'Dupla') THEN (CASE WHEN n_slots = 1 THEN 430.0 WHEN n_slots = 2 THEN 774.0 ELSE 1096.50 END)
                   WHEN contains(main_category, 'Trio') THEN (CASE WHEN n_slots = 1 THEN 395.0 WHEN n_slots = 2 THEN 711.0 ELSE 1007.25 END)
                   ELSE (CASE WHEN n_slots = 1 THEN 335.0 WHEN n_slots = 2 THEN 603.0 ELSE 854.25 END) END::DOUBLE
              * (1.0::DOUBLE - CASE WHEN fl.has_member THEN 0.5 WHEN fl.has_off THEN 0.12 ELSE 0.0 END::DOUBLE) AS package_price
       FROM ns JOIN mc USING (student) JOIN fl USING (student)),
st AS (SELECT DISTINCT student FROM b)
SELECT st.student AS user_id, hist.latest_sum IS NOT NULL AS is_historical,
       floor(CASE WHEN hist.latest_sum IS NOT NULL THEN (CASE WHEN hist.latest_sum > 0 THEN CAST(hist.latest_sum AS DOUBLE) END)
                  ELSE nw.package_price END * 100 + 0.5) / 100 AS monthly_price,
       CASE WHEN hist.latest_sum IS NULL THEN nw.n_slots END AS n_slots,
       CASE WHEN hist.latest_sum IS NULL THEN nw.main_category END AS main_category
FROM st LEFT JOIN hist USING (student) LEFT JOIN nw USING (student)
""")
def recurring_price(spark, d):
    """AL-10: each user's monthly price: latest paid month's sum, else a package price less discounts."""
    b = event_bookings(spark, d)
    paid = b.where((F.col("event_type") == "purchase") & (F.col("value") > 300)) \
            .select("student", F.trunc("booking_date", "MM").alias("m"),
                    F.col("value").cast("decimal(18,2)").alias("v"))
    hist = latest_month_sum(paid, "student", "m", "v")
    r = X.recurring_price(b, hist)
    return r.select(F.col("student").alias("user_id"), "is_historical", round2("monthly_price").alias("monthly_price"),
                    F.col("n_slots").cast("bigint").alias("n_slots"), "main_category")
