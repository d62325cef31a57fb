"""Adapters from the test tables to the shapes the operators take.

The reference works on bookings, sale items and ledgers; the test tables are
orders, line items, customers and events. These functions state the mapping
once so every query reads it the same way:

* a *booking slot* is (customer, order month, order priority), typed by the
  order status through a class map;
* a *sale item* is a line item of the customer's order, paid in its ship
  month, typed by its return flag; ``l_linestatus = 'F'`` means paid and a
  discount above 8% marks a member line (commission base = gross with tax:
  the PJ-1 gross/net choice);
* items reach their customer through the order (JN-1 bridge join, JN-3
  chain); slots are counted by several computed keys (AG-3) and carry the
  customer's segment through a left join (JN-2);
* an *event* is a booking of a user at ``ts``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerly.functions.num import money
from ledgerly.operators.common import rule_table
from ledgerly.sources.tables import table

# Fixed values for the test mapping: order status -> slot class, class weights.
STATUS_CLASS = [("F", "R"), ("O", "N"), ("P", "A")]
CLASS_WEIGHTS = [("A", 720), ("N", 430), ("R", 395)]
DEFAULT_WEIGHT = 335
COUNT_WEIGHTED_SEGMENT = "BUILDING"
MEMBER_DISCOUNT = 0.08


def slot_class(col: str = "o_orderstatus"):
    c = F.col(col)
    return F.when(c == "F", "R").when(c == "O", "N").otherwise("A")


def booking_slots(spark: SparkSession, d: str) -> DataFrame:
    """Orders grouped into slots with a booking count and a class type."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    s = (o.select(F.col("o_custkey").alias("cust_key"),
                  F.trunc(F.to_date("o_orderdate"), "MM").alias("plan_month"),
                  F.col("o_orderpriority").alias("slot"),
                  slot_class().alias("slot_type"))
          .groupBy("cust_key", "plan_month", "slot", "slot_type")
          .agg(F.count(F.lit(1)).alias("bookings_count")))
    return s.join(c, s.cust_key == c.c_custkey, "left").drop("c_custkey")


def sale_items(spark: SparkSession, d: str, preaggregate: bool = False) -> DataFrame:
    """Line items as paid sale items of the order's customer.

    With ``preaggregate`` the lines are first summed per (order, month, type,
    paid, member) before the join to orders. Off by default: the allocation
    aggregates per (customer, month, type, paid) map-side right after the
    join, and the join already shuffles the lines once by order key, so a
    second shuffle of the lines costs more than it saves.
    """
    li = table(spark, d, "lineitem")
    member = F.col("l_discount") > MEMBER_DISCOUNT
    v = money("l_extendedprice")
    items = li.select(
        F.col("l_orderkey"),
        F.trunc(F.to_date("l_shipdate"), "MM").alias("plan_month"),
        F.col("l_returnflag").alias("item_type"),
        (F.col("l_linestatus") == "F").alias("paid"),
        member.alias("is_socio"),
        v.alias("value"),
        F.when(member, v * (F.lit(1) + money("l_tax"))).otherwise(v).alias("base"),
        F.col("l_shipdate").alias("pay_date"))
    if preaggregate:
        items = items.groupBy("l_orderkey", "plan_month", "item_type", "paid", "is_socio") \
                     .agg(F.sum("value").alias("value"), F.sum("base").alias("base"),
                          F.max("pay_date").alias("pay_date"))
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("cust_key"))
    return items.join(o, items.l_orderkey == o.o_orderkey, "inner").drop("o_orderkey")


def class_weights(spark: SparkSession) -> DataFrame:
    return rule_table(spark, CLASS_WEIGHTS, "slot_type string, weight bigint")
