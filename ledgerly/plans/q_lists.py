"""Queries for ordered lists, pick lists and calendar rules: SO-1, SO-2, SO-6, SO-7, SR-5, ST-4, CA-6, CA-7, CL-2, CL-6.

Ordered results carry ``place``, their position, so that the order itself is compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerly.functions import dates as D
from ledgerly.functions.num import money
from ledgerly.operators import rules as R
from ledgerly.operators import setops as S
from ledgerly.plans.q_extra import sale_lines
from ledgerly.plans.registry import register
from ledgerly.sources import io
from ledgerly.sources.tables import table


def placed(df: DataFrame) -> DataFrame:
    """An ordered report with its positions, from 1. Reports are short; one task numbers them."""
    at = F.monotonically_increasing_id()
    return df.withColumn("__at", at).withColumn("place", F.row_number().over(Window.orderBy("__at"))).drop("__at")


def nation_balances(spark, d) -> DataFrame:
    return table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation")) \
        .agg(F.sum(money("c_acctbal")).alias("balance"))


@register("ordered_balances", sql="""
SELECT c_nationkey AS nation, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance,
       CAST(row_number() OVER (ORDER BY sum(CAST(c_acctbal AS DECIMAL(18,2))) DESC) AS INTEGER) AS place
FROM customer GROUP BY 1
""")
def ordered_balances(spark, d):
    """SO-1: nations by the sum of their customers' balances, largest first."""
    return placed(S.order_by_amount(nation_balances(spark, d), "balance")).withColumn("balance", F.col("balance").cast("double"))


@register("pick_list", sql="""
SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY o_orderpriority = '3-MEDIUM', o_orderpriority) AS INTEGER) AS place
FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL)
""")
def pick_list(spark, d):
    """SR-5 / SO-6: the distinct priorities in order, one of them last."""
    return placed(S.distinct_values(table(spark, d, "orders"), "o_orderpriority", last="3-MEDIUM"))


@register("month_value_order", sql="""
WITH v AS (SELECT o_orderpriority AS name, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS value
           FROM orders WHERE o_orderdate >= TIMESTAMP '1997-11-01' AND o_orderdate < TIMESTAMP '1998-02-01' GROUP BY 1, 2),
p AS (SELECT name, sum(value) AS total, sum(CASE WHEN month = DATE '1998-01-01' THEN value END) AS mv FROM v GROUP BY 1)
SELECT name, CAST(total AS DOUBLE) AS total, CAST(row_number() OVER (ORDER BY mv DESC NULLS LAST, name) AS INTEGER) AS place FROM p
""")
def month_value_order(spark, d):
    """SO-2: rows of a pivot in the order of one month's values; all rows of a name stand together."""
    o = table(spark, d, "orders").where((F.col("o_orderdate") >= F.lit("1997-11-01").cast("timestamp_ntz"))
                                        & (F.col("o_orderdate") < F.lit("1998-02-01").cast("timestamp_ntz")))
    v = o.groupBy(F.col("o_orderpriority").alias("name"), F.trunc(F.to_date("o_orderdate"), "MM").alias("month")) \
         .agg(F.sum(money("o_totalprice")).alias("value"))
    rows = placed(S.order_by_month_value(v, "name", "month", "value", "1998-01-01"))
    names = rows.groupBy("name").agg(F.sum("value").cast("double").alias("total"), F.min("place").alias("__p"))
    return names.select("name", "total", F.row_number().over(Window.orderBy("__p")).alias("place"))


@register("page_of_orders", sql="""
SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS place
FROM (SELECT * FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 50)
""")
def page_of_orders(spark, d):
    """SO-7: the third page of 25 orders by amount."""
    return placed(io.read_table(spark, f"{d}/orders.parquet", ["o_orderkey", "o_totalprice"], F.col("o_orderstatus") == "F",
                                order=[F.col("o_totalprice").desc(), F.col("o_orderkey")], limit=25, offset=50))


@register("distinct_names", sql="""
SELECT c_mktsegment AS name FROM customer UNION SELECT o_orderpriority FROM orders UNION SELECT r_name FROM region
""")
def distinct_names(spark, d):
    """ST-4: the distinct names of three tables."""
    return S.union_distinct(table(spark, d, "customer").select(F.col("c_mktsegment").alias("name")),
                            table(spark, d, "orders").select(F.col("o_orderpriority").alias("name")),
                            table(spark, d, "region").select(F.col("r_name").alias("name")))


@register("last_days", sql="""
SELECT o_orderpriority, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '1998-03-31' - 30 AND CAST(o_orderdate AS DATE) <= DATE '1998-03-31' GROUP BY 1
""")
def last_days(spark, d):
    """CA-7: orders of the thirty days up to a date."""
    day, end = F.to_date("o_orderdate"), F.lit("1998-03-31").cast("date")
    o = table(spark, d, "orders").where((day >= D.days_back(end, 30)) & (day <= end))
    return o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).cast("double").alias("total"))


@register("open_days", sql="""
WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders)
SELECT month, CASE WHEN last_day(month) < DATE '1998-08-10' THEN 0
                   ELSE last_day(month) - greatest(month, DATE '1998-08-10') + 1 END AS n_days,
       CASE WHEN last_day(month) >= DATE '1998-08-10' THEN greatest(month, DATE '1998-08-10') END AS first_day
FROM m
""")
def open_days(spark, d):
    """CA-6: days still to come of past, current and later months, as of 10 August 1998."""
    days = D.open_days("month", F.lit("1998-08-10"))
    m = table(spark, d, "orders").select(F.trunc(F.to_date("o_orderdate"), "MM").alias("month")).distinct()
    return m.select("month", F.size(days).cast("long").alias("n_days"), F.try_element_at(days, F.lit(1)).alias("first_day"))


@register("class_sizes", sql=r"""
WITH e AS (SELECT CASE event_id % 7 WHEN 0 THEN 'Aula' WHEN 6 THEN NULL ELSE 'Aula (1 / ' || (event_id % 7) || ')' END AS descr,
                  CASE WHEN event_type = 'signup' THEN 'clase_suelta' ELSE 'clase_colectiva' END AS kind FROM events)
SELECT CASE WHEN descr LIKE '%/ 1)' THEN 'INDIVIDUAL' WHEN descr LIKE '%/ 2)' THEN 'DUPLA' WHEN descr LIKE '%/ 3)' THEN 'TRIO'
            WHEN regexp_matches(coalesce(descr, ''), '/ [4-9]') THEN 'GRUPO' WHEN kind = 'clase_suelta' THEN 'INDIVIDUAL' ELSE 'GRUPO' END AS size_class,
       count(*) AS n FROM e GROUP BY 1
""")
def class_sizes(spark, d):
    """CL-2: class size from the capacity in the text, else from the booking type."""
    k = F.col("event_id") % 7
    e = table(spark, d, "events").select(
        F.when(k == 0, "Aula").when(k == 6, F.lit(None)).otherwise(F.concat(F.lit("Aula (1 / "), k.cast("string"), F.lit(")"))).alias("description"),
        F.when(F.col("event_type") == "signup", "clase_suelta").otherwise("clase_colectiva").alias("booking_type"))
    return e.groupBy(R.capacity_class("description", "booking_type").alias("size_class")).agg(F.count(F.lit(1)).alias("n"))


@register("revenue_ops", sql="""
WITH s AS (SELECT CASE l_returnflag WHEN 'A' THEN 'AULA AVULSA avulsa' WHEN 'N' THEN 'AULA AVULSA - GRUPO FIXO' ELSE 'Mensalidade' END AS descr,
                  CASE WHEN l_quantity < 10 THEN 'Aulas' WHEN l_quantity < 40 THEN 'Outros' ELSE 'Bar' END AS cat,
                  CASE WHEN l_linestatus = 'O' THEN 'Avulsa - Particular' END AS sub,
                  CASE WHEN l_linenumber = 5 THEN 'Reserva Mensal Quadra 1' END AS prod, CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem)
SELECT CASE WHEN contains(lower(coalesce(sub, '')), 'reserva mensal') OR contains(lower(coalesce(prod, '')), 'reserva mensal') THEN 'Locação - Reserva Mensal'
            WHEN lower(cat) = 'locação' THEN 'Locação - Quadra Avulsa'
            WHEN (lower(cat) = 'aulas' OR contains(lower(descr), 'aula')) AND (contains(lower(descr), 'avulsa') OR contains(lower(coalesce(sub, '')), 'avulsa'))
            THEN 'Aulas - Avulsas'
            WHEN lower(cat) = 'aulas' OR contains(lower(descr), 'aula') THEN 'Aulas - Regular' ELSE 'Lanchonete' END AS revenue_class,
       count(*) AS n, CAST(sum(v) AS DOUBLE) AS value
FROM s GROUP BY 1
""")
def revenue_ops(spark, d):
    """CL-6: sale lines by the operational revenue classes."""
    lines = sale_lines(spark, d).withColumn("product", F.when(F.col("l_linenumber") == 5, "Reserva Mensal Quadra 1"))
    return lines.groupBy(R.revenue_class(R.REVENUE_OPS, R.REVENUE_OPS_DEFAULT).alias("revenue_class")) \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("value"))
