"""Monthly filter reports and small aggregates: FL-3, FL-4, FL-5, FL-10, AG-20, AG-22, AG-28.

The month and the as-of date are report parameters (the feature of these
operators); every query still scans the whole tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerly.functions import dates as D
from ledgerly.functions.num import money, round2
from ledgerly.operators import filters as FL
from ledgerly.plans.registry import register
from ledgerly.sources.tables import table

# Fixed values of the test mapping: report month and as-of date.
REPORT_MONTH, AS_OF = "1998-08-01", "1998-08-15"


def _lines(spark, d):
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey)


@register("in_month_any", sql="""
SELECT l.l_returnflag, count(*) AS n_lines, CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE (o.o_orderdate >= DATE '1998-08-01' AND o.o_orderdate < DATE '1998-09-01')
   OR (l.l_shipdate >= DATE '1998-08-01' AND l.l_shipdate < DATE '1998-09-01')
GROUP BY 1
""")
def in_month_any(spark, d):
    """FL-3: lines whose order date or ship date is in the report month."""
    x = FL.in_month_any(_lines(spark, d), REPORT_MONTH, ["o_orderdate", "l_shipdate"])
    return x.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_lines"),
                                         F.sum(money("l_extendedprice")).cast("double").alias("value"))


@register("paid_pending", sql="""
WITH x AS (SELECT l.l_extendedprice,
                  CASE WHEN l.l_linestatus = 'F' AND l.l_shipdate >= DATE '1998-08-01' AND l.l_shipdate < DATE '1998-09-01' THEN 'paid'
                       WHEN NOT (l.l_linestatus = 'F') AND o.o_orderdate >= DATE '1998-08-01' AND o.o_orderdate < DATE '1998-09-01' THEN 'pending'
                  END AS status
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT status, count(*) AS n_lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM x WHERE status IS NOT NULL GROUP BY 1
""")
def paid_pending(spark, d):
    """FL-5: paid in the month (by pay date) and pending in the month (by event date)."""
    x = _lines(spark, d).withColumn("paid", F.col("l_linestatus") == "F")
    x = FL.paid_pending(x, REPORT_MONTH, "paid", "l_shipdate", "o_orderdate").where(F.col("status").isNotNull())
    return x.groupBy("status").agg(F.count(F.lit(1)).alias("n_lines"),
                                   F.sum(money("l_extendedprice")).cast("double").alias("value"))


@register("due_buckets", sql="""
WITH x AS (SELECT o_totalprice, CAST(o_orderdate AS DATE) + 30 AS due, o_orderstatus = 'F' AS paid FROM orders),
y AS (SELECT o_totalprice, CASE WHEN NOT paid AND due < DATE '1998-08-15' THEN 'overdue'
                                WHEN NOT paid AND due >= DATE '1998-08-15' AND due <= DATE '1998-08-31' THEN 'upcoming' END AS bucket
      FROM x)
SELECT bucket, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM y WHERE bucket IS NOT NULL GROUP BY 1
""")
def due_buckets(spark, d):
    """FL-10: unpaid orders (due 30 days after ordering) overdue or upcoming at the as-of date."""
    o = table(spark, d, "orders").select("o_totalprice", F.date_add(F.to_date("o_orderdate"), 30).alias("due"),
                                         (F.col("o_orderstatus") == "F").alias("paid"))
    x = FL.due_buckets(o, "due", "paid", AS_OF, REPORT_MONTH)
    return x.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"),
                                   F.sum(money("o_totalprice")).cast("double").alias("value"))


@register("open_items", sql="""
WITH x AS (SELECT o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) + 30 AS due, o_orderstatus = 'F' AS paid FROM orders)
SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM x WHERE (due >= DATE '1998-08-01' AND due <= DATE '1998-08-31') OR (NOT paid AND due < DATE '1998-08-01')
GROUP BY 1
""")
def open_items(spark, d):
    """FL-4: obligations due in the month, or unpaid and due before it."""
    o = table(spark, d, "orders").select("o_orderstatus", "o_totalprice",
                                         F.date_add(F.to_date("o_orderdate"), 30).alias("due"),
                                         (F.col("o_orderstatus") == "F").alias("paid"))
    x = FL.open_items(o, "due", "paid", "1998-08-01", "1998-08-31")
    return x.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"),
                                          F.sum(money("o_totalprice")).cast("double").alias("value"))


@register("slot_avg", sql="""
SELECT user_id, dayofweek(ts) AS js_dow, hour(ts) AS hour,
       floor(coalesce(CAST(sum(CASE WHEN value > 0 THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE)
                      / count(CASE WHEN value > 0 THEN 1 END), 0.0) * 100 + 0.5) / 100 AS avg_value
FROM events GROUP BY 1, 2, 3
""")
def slot_avg(spark, d):
    """AG-22: average of positive values per user and weekly slot (weekday, hour)."""
    e = table(spark, d, "events")
    pos = F.when(F.col("value") > 0, money("value"))
    g = e.groupBy("user_id", D.js_dow("ts").cast("bigint").alias("js_dow"), F.hour("ts").cast("bigint").alias("hour")) \
         .agg(F.sum(pos).alias("s"), F.count(pos).alias("n"))
    return g.select("user_id", "js_dow", "hour",
                    round2(F.coalesce(F.try_divide(F.col("s").cast("double"), F.col("n")), F.lit(0.0))).alias("avg_value"))


@register("hours_by_court", sql="""
SELECT o_orderpriority AS court,
       count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS productive,
       count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS maintenance
FROM orders GROUP BY 1
""")
def hours_by_court(spark, d):
    """AG-28: hours per court split into productive and maintenance (pivot on a fixed class list)."""
    o = table(spark, d, "orders").withColumn(
        "kind", F.when(F.col("o_orderstatus") == "P", "maintenance").otherwise("productive"))
    p = o.groupBy(F.col("o_orderpriority").alias("court")).pivot("kind", ["productive", "maintenance"]).count()
    return p.select("court", *[F.coalesce(F.col(k), F.lit(0)).cast("bigint").alias(k)
                               for k in ("productive", "maintenance")])


@register("settlement_mix", sql="""
WITH p AS (SELECT CAST(o_totalprice AS DECIMAL(18,2)) AS amt,
                  CASE o_orderpriority WHEN '1-URGENT' THEN 'tarjeta' WHEN '2-HIGH' THEN 'Cartão Crédito'
                       WHEN '3-MEDIUM' THEN 'Cartão Débito' ELSE 'pix' END AS method FROM orders)
SELECT floor(coalesce(CAST(sum(CASE WHEN method IN ('pix', 'Cartão Débito') THEN amt ELSE 0 END) AS DOUBLE) * 100
                      / CAST(sum(amt) AS DOUBLE), 0.0) * 100 + 0.5) / 100 AS immediate_pct,
       floor(coalesce(CAST(sum(CASE WHEN method IN ('tarjeta', 'Cartão Crédito') THEN amt ELSE 0 END) AS DOUBLE) * 100
                      / CAST(sum(amt) AS DOUBLE), 0.0) * 100 + 0.5) / 100 AS d30_pct
FROM p
""")
def settlement_mix(spark, d):
    """AG-20: immediate (pix, debit) and 30-day (credit) settlement shares in one global aggregate."""
    from ledgerly.plans.q_reports import TEST_PAY_METHODS
    o = table(spark, d, "orders")
    cc = F.col("o_orderpriority")
    method = F.coalesce(*[F.when(cc == k, F.lit(v)) for k, v in TEST_PAY_METHODS], F.lit("pix"))
    x = o.select(money("o_totalprice").alias("amt"), method.alias("m"))
    z = F.lit(0).cast("decimal(18,2)")
    g = x.agg(F.sum(F.when(F.col("m").isin("pix", "Cartão Débito"), F.col("amt")).otherwise(z)).alias("imm"),
              F.sum(F.when(F.col("m").isin("tarjeta", "Cartão Crédito"), F.col("amt")).otherwise(z)).alias("d30"),
              F.sum("amt").alias("tot"))
    pct = lambda c: round2(F.coalesce(F.try_divide(F.col(c).cast("double") * 100, F.col("tot").cast("double")),
                                      F.lit(0.0)))
    return g.select(pct("imm").alias("immediate_pct"), pct("d30").alias("d30_pct"))
