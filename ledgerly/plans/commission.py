"""RP-1 on the domain tables: the commission detail (bookings x payments).

This is the booking-level commission view of the reference expressed with the
library's operators, on the reference's own table shapes (see FIXTURES.md):
``participants``, ``bookings``, ``booking_payments``, ``sales``, ``items`` and
``clients``. Every club-specific constant (people, customer codes, words,
prices, weights, split rules) is a parameter in :class:`CommissionRules`.

The active bookings with their participants, the names found in texts, the
lesson lines joined to their sales and the loose matches are stage tables: each
is computed once, written to the shared checkpoint folder, and read by all
branches. Items are read twice, for their texts and as rows. A line is shuffled
whole with its sale and, if it stays unused, to meet the bookings of its
customer; elsewhere only the lines that may meet something are
(:func:`ledgerly.operators.joins.may_meet`).

Steps (in plan order):

1. unique participants by name (AG-1) and first payment per booking (AG-2);
2. the customer an item's text names, by participant-name containment (JN-5);
   lesson lines with their flags (CL-18) and period (AL-8);
3. single lessons matched to sale items by date-and-time text or a payment
   row (JN-4), with the commission base (PJ-1) and a teacher (CL-1);
4. weekly slots of group classes (AG-3, CL-2, CL-1) with weights (AL-1);
5. plan items: valid lines (FL-2), plan type by keyword or by price (CL-3,
   AL-5, AL-7);
6. the three-tier allocation (AL-2);
7. bookings with their values (JN-8, AL-3) and the share split (ST-5);
8. items used by neither path (JN-9) labelled by rule, else by the nearest
   group booking of the customer (JN-10), as their own rows (AL-4, PJ-2, ST-1).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerly.functions import dates as D
from ledgerly.operators import alloc as A
from ledgerly.operators import joins as J
from ledgerly.operators import rules as R
from ledgerly.session import stage


@dataclass
class CommissionRules:
    """Parameters of the commission detail. Rule lists use the condition
    language of :mod:`ledgerly.operators.rules`."""
    item_teacher_rules: list = field(default_factory=list)      # over description, customer_code, pay_date
    booking_teacher_rules: list = field(default_factory=list)   # over description, customer_code, booking_date, booking_id
    member_patterns: list = field(default_factory=list)         # description words of member lines
    double_patterns: list = field(default_factory=list)         # sponsor lines: commission on twice the value
    count_weighted_customers: list = field(default_factory=list)
    # Class weights, the plan price list, and the class keywords.
    weights: list = field(default_factory=lambda: [("INDIVIDUAL", 720), ("DUPLA", 430), ("TRIO", 395)])
    default_weight: int = 335
    prices: list = field(default_factory=lambda: [("INDIVIDUAL", 720.0), ("DUPLA", 430.0), ("TRIO", 395.0),
                                                  ("GRUPO", 335.0), ("GRUPO", 245.0)])
    plan_keywords: list = field(default_factory=lambda: [("AULA AVULSA", "OUTRO"), ("INDIVIDUAL", "INDIVIDUAL"),
                                                         ("DUPLA", "DUPLA"), ("TRIO", "TRIO"), ("GRUPO", "GRUPO"),
                                                         ("QUARTETO", "GRUPO")])
    default_plan: str = "OUTRO"
    # (iso weekday, start time, teacher, partner, factor): rows split in two
    split_rules: list = field(default_factory=list)
    active_status: str = "ACTIVE"
    group_type: str = "clase_colectiva"
    single_type: str = "clase_suelta"
    deny_patterns: list = field(default_factory=lambda: ["RESERVA MENSAL"])
    lesson_categories: list = field(default_factory=lambda: ["Aulas", "Outros"])
    other_needs: list = field(default_factory=lambda: ["TÊNIS", "ADULTO"])   # 'Outros' lines count with both words
    excluded_sub: str = "Avulsa - Particular"
    no_teacher: str = R.NO_TEACHER
    unallocated_venue: str = "N/A"
    min_name_len: int = 5


def _ilike(col: str, pattern: str) -> Column:
    return F.coalesce(F.contains(F.lower(F.col(col)), F.lit(pattern.lower())), F.lit(False))


def _lesson_line(r: CommissionRules) -> Column:
    other = F.lit(True)
    for w in r.other_needs:
        other = other & _ilike("description", w)
    return (F.col("categoria") == r.lesson_categories[0]) | ((F.col("categoria") == r.lesson_categories[1]) & other)


def _any(col: str, patterns) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | _ilike(col, p)
    return out


def _teacher(rules, fallback_col: str | None) -> Column:
    """CL-1: rules, else ``Prof: name`` from the text."""
    return R.resolve_label(rules, fallback_col, R.TEACHER_FALLBACK_RE if fallback_col else None).cast("string")


def commission_detail(participants: DataFrame, bookings: DataFrame, booking_payments: DataFrame,
                      sales: DataFrame, items: DataFrame, clients: DataFrame,
                      r: CommissionRules = CommissionRules()) -> DataFrame:
    # 1. unique participants (AG-1, N10 tie-break) and first payment per booking (AG-2)
    uniq = participants.where(F.col("participant_name").isNotNull() & (F.length("participant_name") > r.min_name_len)) \
        .groupBy("participant_name").agg(F.min("customer_code").alias("customer_code"))
    first_pay = booking_payments.groupBy("booking_id").agg(F.min("payment_date").alias("min_payment_date"))

    # every active booking of a participant is a stage table; like NOT ILIKE, a
    # null text drops the row (N3) from all but the nearest-booking candidates
    booked = stage(participants.select("booking_id", "customer_code", "participant_name")
                         .join(bookings, "booking_id").where(F.col("status") == r.active_status))
    pb = booked.where(F.col("description").isNotNull() & ~_any("description", r.deny_patterns))

    # 2. names in the texts of items (JN-5): the customer a text names
    lesson_like = _lesson_line(r)
    texts = items.where(lesson_like & F.col("description").isNotNull()).select("description").distinct()
    names = uniq.select(F.col("participant_name").alias("pname"), F.col("customer_code").alias("pcust"))
    hit = stage(J.contains_join(texts, "description", "description", names, "pname", "pname")
                 .join(names, "pname").groupBy("description").agg(F.min_by("pcust", F.col("pname")).alias("pcust")))

    # lesson lines with their sales are a stage table, with their flags (CL-18) and month (AL-8) instead of what these are read from
    member = _any("description", r.member_patterns)
    double = _any("description", r.double_patterns)
    avulsa, fixed = R.line_flags("description", "subcategoria")
    plain = F.col("subcategoria").isNull() | (F.col("subcategoria") != r.excluded_sub)
    lines = items.where((F.col("is_canceled") == F.lit(False)) & (F.col("valor_faturamento") > 0) & F.col("categoria").isin(r.lesson_categories)) \
        .select("item_key", "venda_external_id", "description", "valor_faturamento", "valor_bruto", avulsa.alias("is_avulsa"),
                fixed.alias("is_avulsa_grupo_fixo"), (lesson_like & plain).alias("__valid"))
    sold = J.left_join_met(lines, hit, ["description"]).join(
        sales.where(F.col("is_canceled") == F.lit(False)).select(
            F.col("external_id").alias("venda_external_id"), "customer_code", "paid", "pay_date", "data_venda",
            (F.coalesce(F.col("tipo"), F.lit("")) != "refund").alias("__sold")), "venda_external_id")
    lesson_items = stage(A.item_period(sold, "description", "pay_date", "data_venda").withColumn("__valid", F.col("__valid") & F.col("__sold"))
                          .drop("venda_external_id", "__sold", "item_start", "item_end"))

    # 3. loose matches of single lessons (JN-4)
    singles = pb.where(F.col("booking_type") == r.single_type)
    m = J.match_payments(singles, lesson_items, booking_payments, "booking_id", "customer_code", "booking_date",
                         "start_time", "item_key", "customer_code", "description", "pay_date", "valor_faturamento",
                         "booking_id", "payment_date", "amount")
    m = stage(m.join(first_pay, "booking_id", "left"))
    matched = J.may_meet(lesson_items.drop("customer_code"), m, ["item_key"]).where("__may").drop("__may")
    lcm = stage(m.join(matched, "item_key").select(
        "booking_id", "customer_code", "item_key",
        F.col("valor_faturamento").alias("payment_value"),
        F.when(member, F.coalesce("valor_bruto", "valor_faturamento"))
         .when(double, F.col("valor_faturamento") * 2).otherwise(F.col("valor_faturamento")).alias("payment_value_comissao"),
        (member | double).alias("is_socio"), F.col("paid").alias("is_paid"),
        F.coalesce("min_payment_date", "pay_date").alias("pay_date"),
        _teacher(r.item_teacher_rules, None).alias("professor")))

    # valid lines (FL-2) under the customer that their text names, else their sale's
    rf = lesson_items.where("__valid").withColumn("customer_code", F.coalesce("pcust", "customer_code")).drop("pcust", "__valid")

    # 4. weekly slots of group classes (AG-3, CL-2, CL-1) and weights (AL-1)
    cls = R.capacity_class("description", "booking_type", r.single_type)
    teacher_b = _teacher(r.booking_teacher_rules, "description")
    groups = pb.where(F.col("booking_type") == r.group_type).select(
        "customer_code", F.trunc("booking_date", "MM").alias("plan_month"), D.isodow("booking_date").alias("day_of_week"),
        "start_time", teacher_b.alias("professor"), cls.alias("booking_class_type"))
    slots = groups.groupBy("customer_code", "plan_month", "day_of_week", "start_time", "professor",
                           "booking_class_type").agg(F.count(F.lit(1)).alias("bookings_count"))
    spark = participants.sparkSession
    weights = spark.createDataFrame(r.weights or [("", 0)], "t string, w bigint")
    slots = A.with_weight(slots, "booking_class_type", weights, "bookings_count",
                          F.col("customer_code").isin(r.count_weighted_customers) if r.count_weighted_customers
                          else F.lit(False), "w", r.default_weight)
    months = stage(slots.select("customer_code", "plan_month").distinct())

    # 5. plan items (AL-7, AL-5, CL-3) of the months in which their customer has slots
    gross = F.coalesce("valor_bruto", "valor_faturamento")
    pi = J.may_meet(rf.where(~F.col("is_avulsa")), months, ["customer_code", "plan_month"]).where("__may").drop("__may")
    pi = A.to_full_month(pi.withColumn("__gross", gross), "__gross", "description", "__full")
    kw = R.classify([(k, ("contains", "description", w)) for w, k in r.plan_keywords])
    pi = pi.withColumn("plan_class_type", F.coalesce(kw, A.infer_plan("__full", r.prices), F.lit(r.default_plan)))
    pi = pi.select("item_key", "customer_code", "plan_month", "paid", "pay_date", "plan_class_type",
                   "is_avulsa", "is_avulsa_grupo_fixo", (member | double).alias("is_socio"),
                   F.col("valor_faturamento").alias("v"),
                   F.when(double, F.col("valor_faturamento") * 2).otherwise(gross).alias("b"), gross.alias("g"))
    # the monthly base takes a sponsor line once, the commission base twice (PJ-1)
    pi = pi.withColumn("base", F.when(F.col("is_socio"), F.col("b")).otherwise(F.col("v"))) \
           .withColumn("monthly", F.when(F.col("is_socio"), F.col("g")).otherwise(F.col("v")))

    # 6. three-tier allocation (AL-2)
    st = A.allocate(slots, pi, ["customer_code", "plan_month"],
                    ["day_of_week", "start_time", "professor", "booking_class_type", "bookings_count"],
                    "booking_class_type", "plan_class_type", "w", ["v", "base", "monthly"], carry=["paid"],
                    date_col="pay_date", flags=["is_socio", "is_avulsa", "is_avulsa_grupo_fixo"])

    # 7. bookings with their values (JN-8 with N4, AL-3) and the split (ST-5)
    fb = pb.where(F.col("booking_type").isin(r.group_type, r.single_type)).select(
        "booking_id", "booking_date", "booking_type", "start_time", "venue", "resource_name", "description",
        "customer_code", "participant_name",
        F.trunc("booking_date", "MM").alias("plan_month"), D.isodow("booking_date").alias("day_of_week"),
        cls.alias("booking_class_type"), teacher_b.alias("__tb"))
    fb = J.left_join_met(fb, lcm.withColumnRenamed("professor", "__lp").withColumnRenamed("pay_date", "__lpay")
                                .withColumnRenamed("is_socio", "__ls").withColumnRenamed("is_paid", "__lpaid").drop("item_key"),
                         ["booking_id", "customer_code"])
    stg = st.select("customer_code", "plan_month", "day_of_week", "start_time", "booking_class_type",
                    F.col("professor").alias("__tb"), "bookings_count", F.col("paid").alias("__spaid"),
                    F.col("v").alias("__sv"), F.col("base").alias("__sb"), F.col("monthly").alias("__sm"), F.col("pay_date").alias("__spay"),
                    F.col("is_socio").alias("__ss"), F.col("is_avulsa").alias("__sa"),
                    F.col("is_avulsa_grupo_fixo").alias("__sf"))
    # only group bookings have slots to meet
    grouped = F.col("booking_type") == r.group_type
    fb = fb.where(grouped).join(stg, ["customer_code", "plan_month", "day_of_week", "start_time", "booking_class_type", "__tb"], "left") \
           .unionByName(fb.where(~grouped), allowMissingColumns=True)
    is_single = F.col("booking_type") == r.single_type
    per = lambda c: F.coalesce(F.try_divide(F.col(c).cast("double"), F.nullif(F.col("bookings_count"), F.lit(0))),
                               F.lit(0.0))
    out = fb.select(
        "booking_id", "booking_date", "booking_type", "start_time", "venue", "resource_name", "description",
        F.coalesce("__tb", "__lp", F.lit(r.no_teacher)).alias("professor"), "customer_code", "participant_name",
        F.when(is_single, F.coalesce(F.col("payment_value").cast("double"), F.lit(0.0))).otherwise(per("__sv"))
         .alias("booking_value"),
        F.when(is_single, F.coalesce(F.col("payment_value_comissao").cast("double"), F.lit(0.0)))
         .otherwise(per("__sb")).alias("booking_commission_base"),
        F.coalesce("__ls", "__ss", F.lit(False)).alias("is_socio_benefit"),
        F.when(is_single, F.coalesce("__lpaid", F.lit(False))).otherwise(F.coalesce("__spaid", F.lit(False)))
         .alias("is_paid"),
        F.when(is_single, F.col("__lpay")).otherwise(F.col("__spay")).alias("pay_date"),
        F.when(~is_single, per("__sv")).otherwise(F.lit(0.0)).alias("booking_value_monthly"),
        F.when(~is_single, per("__sm")).otherwise(F.lit(0.0)).alias("booking_commission_base_monthly"),
        F.when(is_single, F.lit(True)).otherwise(F.coalesce("__sa", F.lit(False))).alias("is_avulsa"),
        F.when(~is_single, F.lit(False)).otherwise(F.coalesce("__sf", F.lit(False))).alias("is_avulsa_grupo_fixo"))
    measures = ["booking_value", "booking_commission_base", "booking_value_monthly", "booking_commission_base_monthly"]
    for dow, start, teacher, partner, factor in r.split_rules:
        cond = (D.isodow("booking_date") == dow) & (F.col("start_time") == start) & (F.col("professor") == teacher)
        out = A.share_split(out, cond, "professor", partner, measures, factor)

    # 8. unallocated items (JN-9, AL-4): rule, else sentinel for single lessons,
    #    else the nearest group booking of the customer (JN-10), else sentinel
    allocated = pi.join(months, ["customer_code", "plan_month"], "left_semi").select("item_key")
    un = J.unused(rf.drop("plan_month"), "item_key", lcm.select("item_key"), allocated) \
          .withColumn("__d", F.to_date(F.coalesce(F.col("pay_date"), F.col("data_venda").cast("timestamp"))))
    # candidates go by status and type alone: a booking without a text, or a denied one, may be the nearest
    near_src = booked.where(F.col("booking_type") == r.group_type).select(
        "customer_code", "booking_date", "booking_id",
        F.coalesce(_teacher(r.booking_teacher_rules, "description"), F.lit(r.no_teacher)).alias("__np"))
    un = J.nearest(un, near_src, ["customer_code"], "__d", "booking_date", ["__np"], "booking_id")
    prof = F.coalesce(_teacher(r.item_teacher_rules, None),
                      F.when(F.col("is_avulsa"), F.lit(r.no_teacher)), F.col("__np"), F.lit(r.no_teacher))
    un = J.lookup_one(un, clients, "customer_code", "customer_code", "name", out="participant_name")
    base_u = F.when(member | double, F.col("valor_bruto")).otherwise(F.col("valor_faturamento")).cast("double")
    un_rows = un.select(
        F.lit(None).cast(out.schema["booking_id"].dataType).alias("booking_id"), F.col("__d").alias("booking_date"),
        F.lit("unallocated_payment").alias("booking_type"), F.lit("00:00").alias("start_time"),
        F.lit(r.unallocated_venue).alias("venue"), F.lit("N/A").alias("resource_name"), "description",
        prof.alias("professor"), "customer_code", "participant_name",
        F.col("valor_faturamento").cast("double").alias("booking_value"), base_u.alias("booking_commission_base"),
        (member | double).alias("is_socio_benefit"), F.coalesce("paid", F.lit(False)).alias("is_paid"), "pay_date",
        F.col("valor_faturamento").cast("double").alias("booking_value_monthly"),
        base_u.alias("booking_commission_base_monthly"), "is_avulsa", "is_avulsa_grupo_fixo")
    return out.unionByName(un_rows)
