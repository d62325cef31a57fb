"""Join queries on the test tables: JN-4, 5, 9, 10, 11, 12, 14, 15, AG-1, AG-17, ST-2."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerly.functions.num import MONEY, money
from ledgerly.operators import joins as J
from ledgerly.operators.common import rule_table
from ledgerly.plans.registry import register
from ledgerly.sources.tables import table


def _items(spark, d):
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner")


@register("nearest_asof", sql="""
WITH a AS (SELECT row_number() OVER () AS rid, l.l_orderkey, l.l_linenumber, o.o_custkey AS cust_key,
                  CAST(l.l_shipdate AS DATE) AS ship_date
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
c AS (SELECT a.*, b.o_orderkey AS nearest_order, b.o_orderpriority AS nearest_priority,
             abs(datediff('day', CAST(b.o_orderdate AS DATE), a.ship_date)) AS nearest_days,
             row_number() OVER (PARTITION BY a.rid ORDER BY abs(datediff('day', CAST(b.o_orderdate AS DATE), a.ship_date)),
                                b.o_orderdate, b.o_orderkey) AS rn
      FROM a LEFT JOIN orders b ON b.o_custkey = a.cust_key)
SELECT l_orderkey, l_linenumber, cust_key, ship_date, nearest_order, nearest_priority, nearest_days
FROM c WHERE rn = 1
""")
def nearest_asof(spark, d):
    """JN-10: each paid line's nearest order of the same customer, in days, either direction."""
    x = _items(spark, d).select("l_orderkey", "l_linenumber", F.col("o_custkey").alias("cust_key"),
                                F.to_date("l_shipdate").alias("ship_date"))
    b = table(spark, d, "orders").select(F.col("o_custkey").alias("cust_key"), "o_orderdate",
                                         "o_orderkey", "o_orderpriority")
    r = J.nearest(x, b, ["cust_key"], "ship_date", "o_orderdate", ["o_orderkey", "o_orderpriority"],
                  "o_orderkey")
    return r.select("l_orderkey", "l_linenumber", "cust_key", "ship_date",
                    F.col("o_orderkey").alias("nearest_order"),
                    F.col("o_orderpriority").alias("nearest_priority"),
                    F.col("nearest_days").cast("bigint").alias("nearest_days"))


def cost_rows(spark, d):
    """Dated unit costs derived from parts: three validity ranges per part."""
    p = table(spark, d, "part")
    k = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k")
    c = p.select("p_partkey", "p_name", "p_retailprice", k)
    factor = F.when(F.col("k") == 0, F.lit(0.5)).when(F.col("k") == 1, F.lit(0.6)).otherwise(F.lit(0.7)) \
              .cast("decimal(2,1)")
    return c.select(
        (F.col("p_partkey") * 3 + F.col("k")).alias("ord"),
        F.lpad(F.col("p_partkey").cast("string"), 6, "0").alias("sku"),
        F.concat(F.lit("  "), F.regexp_replace(F.upper("p_name"), " ", "  "), F.lit(" ")).alias("descr"),
        F.when(F.col("k") == 1, F.lit("1997-01-01").cast("date"))
         .when(F.col("k") == 2, F.lit("1999-07-01").cast("date")).alias("s"),
        F.when(F.col("k") == 0, F.lit("1996-12-31").cast("date"))
         .when(F.col("k") == 1, F.lit("1999-06-30").cast("date")).alias("e"),
        (money("p_retailprice") * factor).alias("unit_cost"))


@register("effective_cost", sql="""
WITH costs AS (
  SELECT p_partkey * 3 + k AS ord, lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS sku,
         '  ' || replace(upper(p_name), ' ', '  ') || ' ' AS descr,
         CASE k WHEN 1 THEN DATE '1997-01-01' WHEN 2 THEN DATE '1999-07-01' END AS s,
         CASE k WHEN 0 THEN DATE '1996-12-31' WHEN 1 THEN DATE '1999-06-30' END AS e,
         CAST(p_retailprice AS DECIMAL(18,2)) * CASE k WHEN 0 THEN 0.5 WHEN 1 THEN 0.6 ELSE 0.7 END AS unit_cost
  FROM part, (VALUES (0), (1), (2)) t(k)),
f AS (SELECT row_number() OVER () AS rid, l.l_partkey, l.l_shipdate, l.l_quantity, p.p_name
      FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
m AS (SELECT f.rid, min(c.ord) AS ord FROM f JOIN costs c
        ON (ltrim(c.sku, '0') = ltrim(CAST(f.l_partkey AS VARCHAR), '0')
            OR lower(trim(regexp_replace(c.descr, '\\s+', ' ', 'g'))) = lower(trim(regexp_replace(f.p_name, '\\s+', ' ', 'g'))))
       AND (c.s IS NULL OR CAST(f.l_shipdate AS DATE) >= c.s)
       AND (c.e IS NULL OR CAST(f.l_shipdate AS DATE) <= c.e)
      GROUP BY f.rid)
SELECT CAST(date_trunc('month', f.l_shipdate) AS DATE) AS ship_month, count(*) AS n_lines,
       count(m.ord) AS n_costed,
       CAST(sum(c.unit_cost * coalesce(nullif(CAST(f.l_quantity AS DECIMAL(18,2)), 0), 1)) AS DOUBLE) AS cogs
FROM f LEFT JOIN m ON m.rid = f.rid LEFT JOIN costs c ON c.ord = m.ord
GROUP BY 1
""")
def effective_cost(spark, d):
    """JN-12 with AG-17: dated unit cost by code or by name, first cost row wins; monthly COGS."""
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part").select("p_partkey", "p_name")
    facts = li.join(p, li.l_partkey == p.p_partkey, "inner")
    costs = cost_rows(spark, d)
    x = J.effective_lookup(facts, costs, "l_partkey", "p_name", "l_shipdate", "sku", "descr",
                           "s", "e", "ord", ["unit_cost"])
    qty = F.coalesce(F.nullif(money("l_quantity"), F.lit(0).cast(MONEY)), F.lit(1).cast(MONEY))
    return (x.groupBy(F.trunc(F.to_date("l_shipdate"), "MM").alias("ship_month"))
             .agg(F.count(F.lit(1)).alias("n_lines"), F.count("cost_ordinal").alias("n_costed"),
                  F.sum(F.col("unit_cost") * qty).cast("double").alias("cogs")))


# Names looked up both ways in part names (test mapping of JN-14).
FUZZY_NAMES = [("Red",), ("hot plate",), ("Small Ring Deluxe",), ("GEAR",), ("Ólder Rod",), ("",),
               ("Řed bolţ",), ("bl\u0301u\u0308e",), ("Ťǻble Ẅidget",), ("ĸolt",)]


@register("fuzzy_contains", sql="""
WITH w(name) AS (VALUES ('Red'), ('hot plate'), ('Small Ring Deluxe'), ('GEAR'), ('Ólder Rod'), (''), ('Řed bolţ'), ('bl\u0301u\u0308e'), ('Ťǻble Ẅidget'), ('ĸolt')),
p AS (SELECT p_partkey, p_name, upper(trim(strip_accents(coalesce(p_name, '')))) AS a FROM part),
n AS (SELECT name, upper(trim(strip_accents(coalesce(name, '')))) AS b FROM w)
SELECT p.p_partkey, p.p_name, n.name
FROM p JOIN n ON length(a) > 0 AND length(b) > 0 AND (contains(a, b) OR contains(b, a))
""")
def fuzzy_contains(spark, d):
    """JN-14: part names and a name list matched by containment either way, accents and case folded."""
    p = table(spark, d, "part").select("p_partkey", "p_name")
    names = rule_table(spark, FUZZY_NAMES, "name string")
    return J.fuzzy_contains(p, "p_name", names, "name").select("p_partkey", "p_name", "name")


@register("unused_anti", sql="""
WITH items AS (SELECT l.l_orderkey * 100 + l.l_linenumber AS item_key, l.l_orderkey, l.l_linenumber,
                      o.o_custkey AS cust_key, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS ship_month,
                      CAST(date_trunc('month', o.o_orderdate) AS DATE) AS order_month, o.o_orderstatus,
                      l.l_extendedprice
               FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
slots AS (SELECT DISTINCT o_custkey AS cust_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)
SELECT item_key, cust_key, ship_month, l_extendedprice AS value
FROM items
WHERE NOT (item_key IN (
    SELECT DISTINCT item_key FROM items WHERE ship_month = order_month AND o_orderstatus = 'F' AND item_key IS NOT NULL
    UNION
    SELECT DISTINCT i.item_key FROM items i JOIN slots s ON s.cust_key = i.cust_key AND s.m = i.ship_month
    WHERE i.item_key IS NOT NULL))
""")
def unused_anti(spark, d):
    """JN-9 with ST-2: line items neither matched to their own order nor allocated to a slot."""
    x = _items(spark, d).select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("item_key"),
        F.col("o_custkey").alias("cust_key"),
        F.trunc(F.to_date("l_shipdate"), "MM").alias("ship_month"),
        F.trunc(F.to_date("o_orderdate"), "MM").alias("order_month"),
        "o_orderstatus", F.col("l_extendedprice").alias("value"))
    slots = table(spark, d, "orders").select(F.col("o_custkey").alias("cust_key"),
                                             F.trunc(F.to_date("o_orderdate"), "MM").alias("ship_month")).distinct()
    x = J.with_exists(x, slots, ["cust_key", "ship_month"], "has_slot")
    matched = (F.col("ship_month") == F.col("order_month")) & (F.col("o_orderstatus") == "F")
    return J.unused_flagged(x, "item_key", matched | F.col("has_slot")).select("item_key", "cust_key", "ship_month", "value")


@register("contains_join", sql="""
WITH a AS (SELECT doc_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS t FROM documents),
b AS (SELECT item_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS t FROM benchmark)
SELECT DISTINCT a.doc_id, b.item_id FROM a JOIN b ON length(b.t) > 0 AND contains(a.t, b.t)
""")
def contains_join(spark, d):
    """JN-5: benchmark passages found inside whole documents (spaces and case folded)."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    bench = table(spark, d, "benchmark").select("item_id", F.col("text").alias("btext"))
    return J.contains_join(docs, "doc_id", "text", bench, "item_id", "btext").distinct()


@register("contains_names", sql="""
WITH b AS (SELECT DISTINCT p_name FROM part)
SELECT p.p_partkey, b.p_name AS name FROM part p JOIN b ON contains(lower(p.p_type || ' Set: ' || p.p_name || ' of ' || p.p_brand), lower(b.p_name))
""")
def contains_names(spark, d):
    """JN-5 with names of two words, most of which share a word with others, as patterns."""
    p = table(spark, d, "part")
    texts = p.select("p_partkey", F.concat("p_type", F.lit(" Set: "), "p_name", F.lit(" of "), "p_brand").alias("text"))
    names = p.select(F.col("p_name").alias("name")).distinct()
    return J.contains_join(texts, "p_partkey", "text", names, "name", "name")


@register("has_any", sql="""
SELECT c.c_custkey, c.c_mktsegment,
       EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT') AS has_urgent
FROM customer c
""")
def has_any(spark, d):
    """JN-15 (JN-6 form): does the customer have any urgent order."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    urgent = table(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT") \
                                      .select(F.col("o_custkey").alias("c_custkey"))
    return J.with_exists(c, urgent, ["c_custkey"], "has_urgent")


@register("lookup_one", sql="""
SELECT o.o_orderkey, o.o_custkey,
       (SELECT c.c_name FROM customer c WHERE c.c_custkey = o.o_custkey ORDER BY c.c_name LIMIT 1) AS cust_name
FROM orders o
""")
def lookup_one(spark, d):
    """JN-11: one name per customer key (lowest name on ties), left-joined to orders."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    return J.lookup_one(o, c, "o_custkey", "c_custkey", "c_name", out="cust_name")


@register("first_per", sql="""
SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey AS first_order, CAST(o_orderdate AS DATE) AS first_date
FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey
""")
def first_per(spark, d):
    """AG-1 (with AG-2): the first order per customer, ties broken by key."""
    o = table(spark, d, "orders")
    best = F.min(F.struct(F.col("o_orderdate"), F.col("o_orderkey")))
    return o.groupBy("o_custkey").agg(best.alias("b")).select(
        "o_custkey", F.col("b.o_orderkey").alias("first_order"), F.to_date("b.o_orderdate").alias("first_date"))


@register("override_overlay", sql="""
WITH base AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS due, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
                     o_orderpriority AS name, o_orderstatus AS st, o_orderdate, o_totalprice FROM orders),
v1 AS (SELECT id AS k, o_orderdate + INTERVAL 1 DAY AS ts, name = '1-URGENT' AS is_deleted,
              CASE WHEN name = '2-HIGH' THEN amount * 2 END AS custom_amount,
              CASE WHEN name = '3-MEDIUM' THEN due + 40 END AS custom_due, CAST(NULL AS VARCHAR) AS custom_name
       FROM base WHERE st = 'P'),
v2 AS (SELECT id AS k, o_orderdate + INTERVAL 2 DAY AS ts, name = '2-HIGH' AS is_deleted,
              CAST(NULL AS DECIMAL(18,2)) AS custom_amount, CAST(NULL AS DATE) AS custom_due,
              CASE WHEN name = '4-NOT SPECIFIED' THEN 'renamed' END AS custom_name
       FROM base WHERE st = 'P' AND (name = '4-NOT SPECIFIED' OR (name = '2-HIGH' AND o_totalprice > 200000))),
u AS (SELECT * FROM v1 UNION ALL SELECT * FROM v2),
m AS (SELECT k, arg_max_null(custom_amount, ts) FILTER (WHERE NOT is_deleted) AS custom_amount,
             arg_max_null(custom_due, ts) FILTER (WHERE NOT is_deleted) AS custom_due,
             arg_max_null(custom_name, ts) FILTER (WHERE NOT is_deleted) AS custom_name,
             arg_max(is_deleted, ts) AS is_deleted
      FROM u GROUP BY k)
SELECT b.id, coalesce(m.custom_due, b.due) AS due,
       CAST(date_trunc('month', coalesce(m.custom_due, b.due)) AS DATE) AS month,
       CAST(coalesce(m.custom_amount, b.amount) AS DOUBLE) AS amount, coalesce(m.custom_name, b.name) AS name
FROM base b LEFT JOIN m ON m.k = b.id WHERE NOT coalesce(m.is_deleted, false)
UNION ALL
SELECT -id, due, CAST(date_trunc('month', due) AS DATE), 100.0, 'manual' FROM base WHERE st = 'P' AND name = '5-LOW'
""")
def override_overlay(spark, d):
    """JN-13 with SK-4: two override versions merged per key (the latest row wins,
    tombstones keep its columns), overlaid on ledger rows, manual rows appended."""
    o = table(spark, d, "orders")
    base = o.select(F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("due"),
                    money("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("name"))
    p = o.where(F.col("o_orderstatus") == "P")
    pri = F.col("o_orderpriority")
    v1 = p.select(F.col("o_orderkey").alias("k"), (F.col("o_orderdate") + F.expr("interval 1 day")).alias("ts"),
                  (pri == "1-URGENT").alias("is_deleted"),
                  F.when(pri == "2-HIGH", money("o_totalprice") * 2).alias("custom_amount"),
                  F.when(pri == "3-MEDIUM", F.date_add(F.to_date("o_orderdate"), 40)).alias("custom_due"),
                  F.lit(None).cast("string").alias("custom_name"))
    v2 = p.where((pri == "4-NOT SPECIFIED") | ((pri == "2-HIGH") & (F.col("o_totalprice") > 200000))) \
          .select(F.col("o_orderkey").alias("k"), (F.col("o_orderdate") + F.expr("interval 2 days")).alias("ts"),
                  (pri == "2-HIGH").alias("is_deleted"), F.lit(None).cast("decimal(29,2)").alias("custom_amount"),
                  F.lit(None).cast("date").alias("custom_due"),
                  F.when(pri == "4-NOT SPECIFIED", F.lit("renamed")).alias("custom_name"))
    merged = J.merge_overrides(v1, v2, "k", "ts", ["custom_amount", "custom_due", "custom_name"]) \
              .withColumn("is_manual", F.lit(False))
    manual = p.where(pri == "5-LOW").select((-F.col("o_orderkey")).alias("id"), F.to_date("o_orderdate").alias("due"),
                                           F.lit(100).cast("decimal(18,2)").alias("amount"), F.lit("manual").alias("name"))
    out = J.apply_overrides(base, merged.withColumnRenamed("k", "id"), "id",
                            {"amount": "custom_amount", "due": "custom_due", "name": "custom_name"},
                            "is_deleted", "is_manual", manual_rows=manual)
    return out.select("id", "due", F.trunc("due", "MM").alias("month"), F.col("amount").cast("double").alias("amount"),
                      "name")


@register("match_either", sql="""
WITH bk AS (SELECT o_orderkey AS booking_id, o_custkey AS cust_key, CAST(o_orderdate AS DATE) AS bdate,
                   lpad(CAST(7 + o_orderkey % 14 AS VARCHAR), 2, '0') || ':00' AS btime FROM orders),
it AS (SELECT l.l_orderkey * 100 + l.l_linenumber AS item_key, o.o_custkey AS cust_key, l.l_shipdate AS pay_date,
              l.l_extendedprice AS value,
              CASE l.l_returnflag
                   WHEN 'N' THEN 'Aula ' || strftime(o.o_orderdate, '%d/%m/%Y') || ' ' || lpad(CAST(7 + o.o_orderkey % 14 AS VARCHAR), 2, '0') || ':00'
                   WHEN 'A' THEN 'Aula ' || strftime(o.o_orderdate, '%d/%m/%Y') ELSE 'Pacote' END AS txt
       FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
pay AS (SELECT l_orderkey AS booking_id, l_shipdate AS payment_date, l_extendedprice AS amount
        FROM lineitem WHERE l_returnflag = 'R')
SELECT DISTINCT bk.booking_id, it.item_key, it.cust_key
FROM bk JOIN it ON it.cust_key = bk.cust_key
WHERE (it.txt LIKE '%' || strftime(bk.bdate, '%d/%m/%Y') || '%' AND it.txt LIKE '%' || bk.btime || '%')
   OR EXISTS (SELECT 1 FROM pay WHERE pay.booking_id = bk.booking_id AND pay.payment_date = it.pay_date
              AND pay.amount = it.value)
""")
def match_either(spark, d):
    """JN-4: single-lesson payments matched to bookings by date-and-time text or by a payment row."""
    o = table(spark, d, "orders")
    btime = F.concat(F.lpad((F.lit(7) + F.col("o_orderkey") % 14).cast("string"), 2, "0"), F.lit(":00"))
    bk = o.select(F.col("o_orderkey").alias("booking_id"), F.col("o_custkey").alias("cust_key"),
                  F.to_date("o_orderdate").alias("bdate"), btime.alias("btime"))
    li = table(spark, d, "lineitem")
    x = li.join(o.select("o_orderkey", "o_custkey", "o_orderdate"), li.l_orderkey == o.o_orderkey)
    dtxt = F.date_format("o_orderdate", "dd/MM/yyyy")
    txt = F.when(F.col("l_returnflag") == "N", F.concat(F.lit("Aula "), dtxt, F.lit(" "), btime)) \
           .when(F.col("l_returnflag") == "A", F.concat(F.lit("Aula "), dtxt)).otherwise(F.lit("Pacote"))
    it = x.select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("item_key"),
                  F.col("o_custkey").alias("cust_key"), F.col("l_shipdate").alias("pay_date"),
                  F.col("l_extendedprice").alias("value"), txt.alias("txt"))
    pay = li.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("booking_id"),
                                                        F.col("l_shipdate").alias("payment_date"),
                                                        F.col("l_extendedprice").alias("amount"))
    return J.match_payments(bk, it, pay, "booking_id", "cust_key", "bdate", "btime", "item_key", "cust_key", "txt",
                            "pay_date", "value", "booking_id", "payment_date", "amount")
