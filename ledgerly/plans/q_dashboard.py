"""Commission dashboards over the commission detail (RP-2, RP-22) with FL-5,
CL-16, CL-17, AG-8 and the N1 fall-through of values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerly.functions import dates as D
from ledgerly.functions.num import js_or
from ledgerly.operators import rules as R
from ledgerly.plans.q_alloc import SQL_COMMISSION, commission_detail
from ledgerly.plans.registry import register

# Fixed values of the test mapping: report month, commission rate, one dated
# multiplier rule (both name parts, start date, factor).
DASH_MONTH, DASH_RATE = "1998-08-01", "0.10"
MULTIPLIERS = [("prof", "1-urgent", "1998-08-15", 0.88)]


def paid_rows(detail, month: str, period_col: str):
    """FL-5 paid side: paid with pay date in the month and a positive value;
    base falls back to the value (N1); CL-16 multiplier; CL-17 period."""
    m = F.lit(month).cast("date")
    x = detail.where(F.col("is_paid") & D.in_month(F.to_date("pay_date"), m))
    val = js_or("booking_value", 0.0)
    x = x.withColumn("val", val).where(F.col("val") > 0)
    base = js_or("commission_base", F.col("val"))
    mult = R.dated_multiplier(MULTIPLIERS, "professor", "booking_date")
    return x.withColumn("base", (base.cast("decimal(18,2)") * F.lit(mult).cast("decimal(4,2)"))) \
            .withColumn("val", F.col("val").cast("decimal(18,2)")) \
            .withColumn("period", D.period_of(period_col))


def _dash(x):
    z = F.lit(0).cast("decimal(22,4)")
    rate = F.lit(DASH_RATE).cast("decimal(3,2)")
    p1 = F.col("period") == 1
    g = x.groupBy("professor").agg(
        F.count(F.lit(1)).alias("n_classes"), F.countDistinct("cust_key").alias("n_students"),
        F.sum("val").alias("paid_value"), F.sum("base").alias("paid_base"),
        F.sum(F.when(p1, F.col("val")).otherwise(z)).alias("p1_value"),
        F.sum(F.when(p1, F.col("base")).otherwise(z)).alias("p1_base"),
        F.sum(F.when(~p1, F.col("val")).otherwise(z)).alias("p2_value"),
        F.sum(F.when(~p1, F.col("base")).otherwise(z)).alias("p2_base"))
    money_cols = ["paid_value", "paid_base", "p1_value", "p1_base", "p2_value", "p2_base"]
    return g.select("professor", "n_classes", "n_students",
                    *[F.round(c, 2).cast("double").alias(c) for c in money_cols],
                    F.round(F.col("paid_base") * rate, 2).cast("double").alias("commission"))


def _dash_sql(period_expr: str) -> str:
    return f"""
WITH detail AS ({SQL_COMMISSION}),
x AS (SELECT professor, cust_key, booking_date,
             coalesce(nullif(booking_value, 0), 0.0) AS val0,
             coalesce(nullif(commission_base, 0), coalesce(nullif(booking_value, 0), 0.0)) AS base0, pay_date
      FROM detail
      WHERE is_paid AND pay_date >= DATE '{DASH_MONTH}' AND pay_date < DATE '{DASH_MONTH}' + INTERVAL 1 MONTH),
y AS (SELECT professor, cust_key, CAST(val0 AS DECIMAL(18,2)) AS val,
             CAST(base0 AS DECIMAL(18,2)) * CAST(CASE WHEN contains(lower(professor), 'prof') AND contains(lower(professor), '1-urgent')
                                                      AND booking_date >= DATE '1998-08-15' THEN 0.88 ELSE 1.0 END AS DECIMAL(4,2)) AS base,
             CASE WHEN day({period_expr}) <= 20 THEN 1 ELSE 2 END AS period
      FROM x WHERE val0 > 0)
SELECT professor, count(*) AS n_classes, count(DISTINCT cust_key) AS n_students,
       CAST(round(sum(val), 2) AS DOUBLE) AS paid_value, CAST(round(sum(base), 2) AS DOUBLE) AS paid_base,
       CAST(round(sum(CASE WHEN period = 1 THEN val ELSE 0 END), 2) AS DOUBLE) AS p1_value,
       CAST(round(sum(CASE WHEN period = 1 THEN base ELSE 0 END), 2) AS DOUBLE) AS p1_base,
       CAST(round(sum(CASE WHEN period = 2 THEN val ELSE 0 END), 2) AS DOUBLE) AS p2_value,
       CAST(round(sum(CASE WHEN period = 2 THEN base ELSE 0 END), 2) AS DOUBLE) AS p2_base,
       CAST(round(sum(base) * 0.10, 2) AS DOUBLE) AS commission
FROM y GROUP BY 1
"""


@register("commission_dashboard", sql=_dash_sql("booking_date"))
def commission_dashboard(spark, d):
    """RP-2 (paid side): per teacher, paid classes of the month, periods by class date, commission."""
    return _dash(paid_rows(commission_detail(spark, d), DASH_MONTH, "booking_date"))


@register("paid_dashboard", sql=_dash_sql("pay_date"))
def paid_dashboard(spark, d):
    """RP-22: the earlier dashboard: paid only, periods by pay date, one rate."""
    return _dash(paid_rows(commission_detail(spark, d), DASH_MONTH, "pay_date"))
